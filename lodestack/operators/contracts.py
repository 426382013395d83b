"""Field contracts over JSON text: typed projections and the drift that they report.

A contract is closed: each field is declared or excluded and everything else is
an issue. Values stay in the JVM; a field's JSON kind is read from a VARIANT, so
a boolean never passes as a number.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # "number" or "text"
    required: bool = True


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    excluded: tuple[str, ...] = ()
    #: At least one of these sets of keys must be complete.
    layouts: tuple[tuple[str, ...], ...] = field(default=())


NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")
SQL_TYPE = {"number": "double", "text": "string"}


def kind_of(value: Column, name: str) -> Column:
    """number, text, null, other, or SQL null if the key is absent."""
    member = F.try_variant_get(value, f"$['{name}']", "variant")
    kind = F.schema_of_variant(member)
    return (
        F.when(member.isNull(), None).when(F.is_variant_null(member), "null")
        .when(kind.isin(*NUMBERS) | kind.startswith("DECIMAL"), "number").when(kind == "STRING", "text").otherwise("other")
    )


def parsed(text: Column) -> Column:
    """VARIANT of the JSON text; null if it does not parse."""
    return F.try_parse_json(text)


def project(df: DataFrame, json: str, contract: Contract, keys: list[str]) -> DataFrame:
    """keys plus one typed column per declared field; values of another kind become null."""
    value = parsed(F.col(json))
    rows = df.select(*keys, value.alias("_v"))
    columns = [
        F.when(kind_of(F.col("_v"), f.name) == f.kind, F.try_variant_get("_v", f"$['{f.name}']", SQL_TYPE[f.kind])).alias(f.name)
        for f in contract.fields
    ]
    return rows.select(*keys, *columns)


def drift(df: DataFrame, json: str, contract: Contract, keys: list[str]) -> DataFrame:
    """keys plus (code, field): one row per issue of a document."""
    known = F.array(*[F.lit(f.name) for f in contract.fields], *[F.lit(x) for x in contract.excluded])
    rows = df.select(*keys, parsed(F.col(json)).alias("_v"), F.json_object_keys(F.col(json)).alias("_k"))
    issue = lambda code, name: F.struct(F.lit(code).alias("code"), F.lit(name).alias("field"))
    single = []
    for f in contract.fields:
        kind = kind_of(F.col("_v"), f.name)
        absent = F.when(kind.isNull(), issue("missing-field", f.name)) if f.required else F.lit(None)
        single.append(F.coalesce(absent, F.when(kind != f.kind, issue("unsupported-field-type", f.name))))
        if f.kind == "number":
            number = F.try_variant_get("_v", f"$['{f.name}']", "double")
            single.append(F.when(F.isnan(number) | (F.abs(number) == float("inf")), issue("invalid-number", f.name)))
    if contract.layouts:
        complete = [F.forall(F.array(*[F.lit(k) for k in layout]), lambda k: F.array_contains("_k", k)) for layout in contract.layouts]
        single.append(F.when(~F.array_contains(F.array(*complete), True), issue("no-complete-layout", "")))
    new = F.transform(
        F.array_except(F.coalesce("_k", F.array().cast("array<string>")), known),
        lambda k: F.struct(F.lit("new-field").alias("code"), k.alias("field")),
    )
    return rows.select(*keys, F.explode(F.concat(F.array_compact(F.array(*single)), new)).alias("_i")).select(*keys, "_i.code", "_i.field")


def sentinel_number(value: Column) -> Column:
    """struct<value double, marker string> of a VARIANT: a number, or the name of a special value spelled {"float": name}."""
    kind = F.schema_of_variant(value)
    number = kind.isin(*NUMBERS) | kind.startswith("DECIMAL")
    return F.struct(F.when(number, F.try_variant_get(value, "$", "double")).alias("value"), F.try_variant_get(value, "$['float']", "string").alias("marker"))


def definition_issues(
    df: DataFrame, json: str, keys: list[str], required: tuple[str, ...], kinds: tuple[str, ...], lists: dict[str, tuple[int, int]]
) -> DataFrame:
    """keys plus (code): what is wrong with definitions that have these keys and no others, an owned kind, and lists within bounds."""
    rows = df.select(*keys, parsed(F.col(json)).alias("_v"), F.coalesce(F.json_object_keys(F.col(json)), F.array().cast("array<string>")).alias("_k"))
    wanted = F.array(*[F.lit(k) for k in required])
    issues = [
        F.when(F.size(F.array_except(wanted, F.col("_k"))) > 0, "missing-field"),
        F.when(F.size(F.array_except(F.col("_k"), wanted)) > 0, "new-field"),
        F.when(~F.try_variant_get("_v", "$.kind", "string").isin(*kinds), "unowned-kind"),
    ]
    for name, (low, high) in lists.items():
        n = F.size(F.try_variant_get("_v", f"$['{name}']", "array<variant>"))
        issues.append(F.when(n < low, "too-few").when(n > high, "too-many"))
    return rows.select(*keys, F.explode(F.array_compact(F.array(*issues))).alias("code"))
