"""Guides: documents compiled from a declarative spec into one plan per block over all scopes.

A spec names sections, and a section its blocks. A block shows the rows of a named
frame through a template; a section that repeats has one instance per row of its
scope frame. Nothing loops over scopes: the scope is a join column of the block's
frame, so a block is one join and one sort whatever the number of scopes, and a
frame that several blocks name is computed once. The result is one row per line of
the document, so no section, however long, is gathered anywhere.

Spec: ``id``, ``title``, ``sections``, and optionally ``dek``, ``audience``,
``rule``, ``schema_version`` 1. Section: ``id``, ``heading`` (a template over the
scope's columns), ``blocks``, optionally ``repeat`` (the scope frame). Block: see
``SHAPES``. Templates hold ``{column}``; a column is text or a number, a link
(struct<text, entity>), an array of these, or struct<runs> of ready-made runs.

A block without rows shows its ``empty`` text, vanishes if ``optional``, and fails
the job otherwise. A section that shows no block vanishes, unless its id is
``sources``. Rows with a null in a shown column fail the job, too.
"""

from __future__ import annotations

import json
import re
import string
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.operators.packing import ordered
from lodestack.session import cut

ROW_KINDS = ("list", "checklist", "steps", "table", "definitions")
#: The form of an entity's key, and of a name in a template.
ENTITY = "^e-[0-9a-fA-F]{32}$"
NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")
RUNS = "array<struct<text:string,entity:string>>"


class GuideError(ValueError):
    """A spec that cannot be compiled; the message begins with the place."""


@dataclass(frozen=True)
class Frame:
    """Rows for blocks or scopes, in the order of ``order``, which is unique within ``scope``: the columns shared with the scope."""

    rows: DataFrame
    order: tuple[str, ...]
    scope: tuple[str, ...] = ()


@dataclass(frozen=True)
class Shape:
    """What a block of a kind must and may have."""

    must: frozenset[str]
    may: frozenset[str] = field(default_factory=frozenset)


def _shapes() -> dict[str, Shape]:
    any_block, rows = {"title", "empty", "optional"}, {"group_by", "limit_per_group", "more"}
    made = {kind: Shape(frozenset({"query", "columns" if kind == "table" else "item"}), frozenset(any_block | rows)) for kind in ROW_KINDS}
    made["sentence"] = Shape(frozenset({"query", "template"}), frozenset(any_block))
    made["sources"] = Shape(frozenset({"template"}), frozenset(any_block))
    return made


SHAPES = _shapes()


def _text(value: object) -> str | None:
    return None if isinstance(value, str) and value else "expected a text that is not empty"


def names_in(template: str) -> list[tuple[str, str | None]]:
    """(literal, name or None) parts; anything but plain names in braces is an error."""
    parts = []
    for literal, name, form, conversion in string.Formatter().parse(template):
        if name is not None and (form or conversion or not NAME.fullmatch(name)):
            raise ValueError(f"not a plain name: {name!r}")
        parts.append((literal, name))
    return parts


def _template(value: object) -> str | None:
    if wrong := _text(value):
        return wrong
    try:
        names_in(value)
    except ValueError as e:
        return f"invalid template: {e}"
    return None


def _columns(value: object) -> str | None:
    fine = isinstance(value, list) and value and all(isinstance(c, str) and c for c in value) and len({*value}) == len(value)
    return None if fine else "expected a list of different names"


_CHECKS: dict[str, Callable[[object], str | None]] = {
    **dict.fromkeys(("id", "query", "repeat", "title", "group_by", "empty"), _text),
    **dict.fromkeys(("heading", "template", "item", "more"), _template),
    **dict.fromkeys(("dek", "audience", "rule"), lambda v: None if isinstance(v, str) else "expected a text"),
    **dict.fromkeys(("sections", "blocks"), lambda v: None if isinstance(v, list) else "expected a list"),
    "columns": _columns,
    "optional": lambda v: None if isinstance(v, bool) else "expected true or false",
    "limit_per_group": lambda v: None if type(v) is int and v > 0 else "expected a positive whole number",
    "schema_version": lambda v: None if type(v) is int and v == 1 else "unsupported version",
}


def _object(value: object, must: set[str], may: set[str], where: str) -> None:
    if not isinstance(value, dict):
        raise GuideError(f"{where}: expected an object")
    if odd := sorted({*value} - must - may):
        raise GuideError(f"{where}: unknown keys {', '.join(odd)}")
    if gone := sorted(must - {*value}):
        raise GuideError(f"{where}: missing keys {', '.join(gone)}")
    for key, v in value.items():
        if key in _CHECKS and (wrong := _CHECKS[key](v)):
            raise GuideError(f"{where}, {key}: {wrong}")


def load(spec: str | dict) -> dict:
    """A checked spec from JSON text or an object."""
    if isinstance(spec, str):
        try:
            spec = json.loads(spec)
        except ValueError as e:
            raise GuideError(f"spec: {e}") from e
    _object(spec, {"id", "title", "sections"}, {"dek", "audience", "rule", "schema_version"}, "guide")
    seen = set()
    for section in spec["sections"]:
        _object(section, {"id", "heading", "blocks"}, {"repeat"}, "section")
        name = f"section {section['id']}"
        if section["id"] in seen:
            raise GuideError(f"{name}: the id occurs twice")
        seen.add(section["id"])
        for k, block in enumerate(section["blocks"]):
            where = f"{name}, block {k}"
            kind = block.get("type") if isinstance(block, dict) else None
            if not isinstance(kind, str) or kind not in SHAPES:
                raise GuideError(f"{where}: unknown type {kind!r}")
            _object(block, SHAPES[kind].must | {"type"}, SHAPES[kind].may, where)
            for needs, needed in (("limit_per_group", "group_by"), ("more", "limit_per_group")):
                if needs in block and needed not in block:
                    raise GuideError(f"{where}: {needs} needs {needed}")
    return spec


def _run(text: Column, entity: Column | None = None) -> Column:
    return F.struct(text.cast("string").alias("text"), (F.lit(None) if entity is None else entity).cast("string").alias("entity"))


def _failing(value: Column, message: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("string"))


def _is_link(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and sorted(kind.names) == ["entity", "text"] and all(isinstance(f.dataType, T.StringType) for f in kind)


def pieces(value: Column, kind: T.DataType, where: str) -> Column:
    """The runs of a value by its type."""
    if isinstance(kind, (T.StringType, T.NumericType)):
        return F.array(_run(_failing(value.cast("string"), f"{where}: null in a template")))
    if _is_link(kind):
        sound = F.when(value["entity"].rlike(ENTITY), value["entity"])
        return F.array(_run(_failing(value["text"], f"{where}: null in a template"), _failing(sound, f"{where}: invalid link")))
    if isinstance(kind, T.ArrayType):
        comma = _run(F.lit(", "))
        return F.flatten(F.transform(value, lambda x, i: F.concat(F.when(i > 0, F.array(comma)).otherwise(F.array().cast(RUNS)), pieces(x, kind.elementType, where))))
    if isinstance(kind, T.StructType) and kind.names == ["runs"] and isinstance(kind[0].dataType, T.ArrayType) and _is_link(kind[0].dataType.elementType):
        return F.transform(value["runs"], lambda r: _run(r["text"], r["entity"]))
    raise GuideError(f"{where}: a template cannot show {kind.simpleString()}")


def joined(runs: Column) -> Column:
    """Without empty runs, neighbours without a link as one; linear in the runs."""
    one = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  binds a value to a name

    def merge(rs: Column, starts: Column) -> Column:
        stop = lambda k: F.coalesce(F.get(starts, k + 1), F.size(rs))
        text = lambda s, k: F.array_join(F.transform(F.slice(rs, s + 1, stop(k) - s), lambda r: r["text"]), "")
        return F.transform(starts, lambda s, k: _run(text(s, k), F.get(rs, s)["entity"]))

    begins = lambda rs, i: (i == 0) | F.get(rs, i)["entity"].isNotNull() | F.get(rs, i - 1)["entity"].isNotNull()
    places = lambda rs: F.when(F.size(rs) > 0, F.sequence(F.lit(0), F.size(rs) - 1)).otherwise(F.array().cast("array<int>"))
    return one(F.filter(runs, lambda r: r["text"] != ""), lambda rs: one(F.filter(places(rs), lambda i: begins(rs, i)), lambda starts: merge(rs, starts)))


def fill(template: str, schema: T.StructType, where: str, value: Callable[[str], Column] = F.col) -> Column:
    """The runs of a template over columns of a schema."""
    parts = []
    for literal, name in names_in(template):
        if literal:
            parts.append(F.array(_run(F.lit(literal))))
        if name is not None:
            if name not in schema.names:
                raise GuideError(f"{where}: no column {name!r}")
            parts.append(pieces(value(name), schema[name].dataType, where))
    return joined(F.concat(*parts) if parts else F.array().cast(RUNS))


def plain(runs: Column) -> Column:
    """Runs as text; links as [text](entity)."""
    link = lambda r: F.concat(F.lit("["), r["text"], F.lit("]("), r["entity"], F.lit(")"))
    return F.array_join(F.transform(runs, lambda r: F.when(r["entity"].isNull(), r["text"]).otherwise(link(r))), "")


LINE = ("section", "scope", "block", "grp", "item", "part", "kind", "runs")


def _line(rows: DataFrame, **values: Column | int | str) -> DataFrame:
    """Lines with these values; places that are not named are -1, before all that are."""
    made = {"scope": F.col("scope"), "grp": -1, "item": -1, "part": -1} | values
    out = []
    for name in LINE:
        v = made[name] if isinstance(made[name], Column) else F.lit(made[name])
        out.append((v.cast("string") if name == "kind" else v if name == "runs" else v.cast("long")).alias(name))
    return rows.select(*out)


class _Compiler:
    def __init__(self, frames: dict[str, Frame], snapshot: dict[str, str], often: set[str]):
        self.frames, self.often, self.snapshot = frames, often, snapshot
        self.cuts: dict[str, Frame] = {}

    def frame(self, name: str, where: str) -> Frame:
        if name not in self.frames:
            raise GuideError(f"{where}: unknown query {name!r}")
        if name in self.often and name not in self.cuts:
            f = self.frames[name]
            self.cuts[name] = Frame(cut(f.rows), f.order, f.scope)
        return self.cuts.get(name, self.frames[name])

    def section(self, no: int, section: dict, spark) -> list[DataFrame]:
        where = f"section {section['id']}"
        if "repeat" in section:
            frame = self.frame(section["repeat"], where)
            scopes = cut(ordered(frame.rows, list(frame.order), "scope"))
        else:
            frame, scopes = None, spark.range(1).select(F.col("id").alias("scope"))
        heading = fill(section["heading"], scopes.drop("scope").schema, where)
        lines, shown, always = [], [], section["id"] == "sources"
        for k, block in enumerate(section["blocks"]):
            made, here = self.block(no, k, block, frame, scopes, f"{where}, block {k}")
            lines += made
            if here is None:
                always = True
            else:
                shown.append(here)
        if not always and not shown:
            return []
        if not always:
            seen = shown[0]
            for more in shown[1:]:
                seen = seen.union(more)
            scopes = scopes.join(seen.distinct(), "scope", "left_semi")
        return [_line(scopes, section=no, block=-1, kind="heading", runs=heading), *lines]

    def block(self, no: int, k: int, block: dict, repeat: Frame | None, scopes: DataFrame, where: str) -> tuple[list[DataFrame], DataFrame | None]:
        """The block's lines and the scopes that show it; None: all of them."""
        at = {"section": no, "block": k}
        one = lambda text: joined(F.array(_run(F.lit(text))))
        titled = lambda rows: [_line(rows, **at, kind="title", runs=one(block["title"]))] if "title" in block else []
        every = scopes.select("scope")
        if block["type"] == "sources":
            schema = T.StructType([T.StructField(n, T.StringType()) for n in self.snapshot])
            runs = fill(block["template"], schema, where, lambda name: F.lit(self.snapshot[name]))
            return [*titled(every), _line(every, **at, item=0, kind="text", runs=runs)], None
        frame = self.frame(block["query"], where)
        rows = frame.rows
        if repeat is not None:
            if not frame.scope:
                raise GuideError(f"{where}: the rows of {block['query']!r} belong to no scope")
            if gone := [c for c in frame.scope if c not in repeat.rows.columns]:
                raise GuideError(f"{where}: the scope has no column {gone[0]!r}")
            rows = rows.join(scopes.select("scope", *frame.scope), list(frame.scope))
        else:
            rows = rows.withColumn("scope", F.lit(0).cast("long"))
        schema = frame.rows.schema
        ranked = cut(ordered(rows, ["scope", *frame.order], "rank"))
        counts = ranked.groupBy("scope").count()
        out = []
        if block["type"] == "sentence":
            most = F.when(F.col("count") > 1, F.raise_error(F.lit(f"{where}: more than one row for a sentence")).cast("long")).otherwise(0)
            out.append(_line(ranked.join(counts, "scope"), **at, item=most, kind="text", runs=fill(block["template"], schema, where)))
        elif "group_by" not in block:
            out.append(self.items(block, ranked, schema, at, where))
        else:
            out += self.groups(block, ranked, schema, at, where)
        if not block.get("optional") or "empty" in block:
            bare = every.join(counts, "scope", "left_anti")
            runs = one(block["empty"]) if "empty" in block else F.raise_error(F.lit(f"{where}: no rows")).cast(RUNS)
            return [*titled(every), *out, _line(bare, **at, item=0, kind="text", runs=runs)], None
        here = counts.select("scope")
        return [*titled(here), *out], here

    def items(self, block: dict, rows: DataFrame, schema: T.StructType, at: dict, where: str, **more: Column) -> DataFrame:
        if block["type"] != "table":
            return _line(rows, **at, **more, item=F.col("rank"), kind="item", runs=fill(block["item"], schema, where))
        cells = F.array(*(fill(f"{{{c}}}", schema, where) for c in block["columns"]))
        each = rows.select("*", F.posexplode(cells).alias("cell_no", "cell"))
        return _line(each, **at, **more, item=F.col("rank"), part=F.col("cell_no"), kind="cell", runs=F.col("cell"))

    def groups(self, block: dict, ranked: DataFrame, schema: T.StructType, at: dict, where: str) -> list[DataFrame]:
        name = block["group_by"]
        if name not in schema.names:
            raise GuideError(f"{where}: no column {name!r} to group by")
        label = joined(pieces(F.col(name), schema[name].dataType, where))
        rows = ranked.withColumn("label", label).withColumn("shown", F.array_join(F.transform("label", lambda r: r["text"]), ""))
        heads = rows.groupBy("scope", "shown").agg(F.min("rank").alias("grp"), F.count("*").alias("many"), F.min_by("label", "rank").alias("label"))
        heads = cut(heads)
        limit = block.get("limit_per_group")
        kept = rows.drop("label")
        if limit:
            # Spark limits groups before the shuffle, so a hot one costs ``limit`` rows a task.
            kept = kept.withColumn("in_group", F.row_number().over(Window.partitionBy("scope", "shown").orderBy("rank"))).filter(F.col("in_group") <= limit)
        kept = kept.join(heads.select("scope", "shown", "grp"), ["scope", "shown"])
        out = [
            _line(heads, **at, grp=F.col("grp"), kind="group", runs=F.col("label")),
            self.items(block, kept, schema, at, where, grp=F.col("grp")),
        ]
        if limit:
            left = T.StructType([T.StructField("remaining", T.LongType())])
            runs = fill(block.get("more", "{remaining} more"), left, where, lambda _: F.col("many") - limit)
            # Behind all items of the group.
            out.append(_line(heads.filter(F.col("many") > limit), **at, grp=F.col("grp"), item=F.lit((1 << 63) - 1), kind="more", runs=runs))
        return out


def render(spec: str | dict, frames: dict[str, Frame], snapshot: dict[str, str]) -> DataFrame:
    """Lines (section, section_id, scope, block, grp, item, part, kind, runs); in that order they are the document.

    Places: ``scope`` counts the instances of a section, ``grp`` and ``item`` grow
    in the order of rows, ``part`` is a table's column; -1 stands before all.
    """
    spec = load(spec)
    named = [s["repeat"] for s in spec["sections"] if "repeat" in s] + [b["query"] for s in spec["sections"] for b in s["blocks"] if "query" in b]
    spark = next(iter(frames.values())).rows.sparkSession
    compiler = _Compiler(frames, snapshot, {n for n in named if named.count(n) > 1})
    lines, ids = [], []
    for no, section in enumerate(spec["sections"]):
        name = F.lit(section["id"])
        ids.append(F.when(F.col("section") == no, F.concat(name, F.lit("-"), "scope") if "repeat" in section else name))
        lines += compiler.section(no, section, spark)
    if not lines:
        return spark.createDataFrame([], "section long, section_id string, scope long, block long, grp long, item long, part long, kind string, runs " + RUNS)
    out = lines[0]
    for more in lines[1:]:
        out = out.unionByName(more)
    return out.select("section", F.coalesce(*ids).alias("section_id"), *LINE[1:])
