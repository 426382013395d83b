"""Column functions for names, formats and text; Python only where SQL has no Unicode normal forms."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What readers should not see, in order of precedence; an identifier is a token with an inner underscore or capital.
JARGON = {
    "path": r"(?iU)(?<!\w)bundles/[^\s,;)}\]]+|::serialized|(?<![\w.])(?:[\w.-]+[/\\])*[\w.-]+\.[A-Za-z][A-Za-z0-9]{0,7}(?!\w)",
    "raw_float": r"(?U)(?<![\w.])[+-]?(?:\d+)?\.\d{5,}(?![\w.])",
    "hex": r"(?i)(?<![A-Za-z0-9])(?:e-)?(?=[0-9a-f]*[a-f])[0-9a-f]{8,}(?![A-Za-z0-9])|(?<![A-Za-z0-9])e-[0-9a-f]+(?![A-Za-z0-9])",
    "identifier": r"[A-Za-z0-9_]+",
}
UNDERSCORED = r"^_+[A-Za-z0-9]|[A-Za-z0-9]_[A-Za-z0-9]"
HUMPED = r"[a-z][A-Z]|[A-Z][a-z]+[A-Z]"
CODE = f"{UNDERSCORED}|{HUMPED}"
#: An identifier as one pattern: only tokens that are code match, so prose gives no matches to look through.
CODED = r"(?<![A-Za-z0-9_])(?=_+[A-Za-z0-9]|[A-Za-z0-9_]*?(?:[A-Za-z0-9]_[A-Za-z0-9]|[a-z][A-Z]|[A-Z][a-z]+[A-Z]))[A-Za-z0-9_]+"
#: Where words of a name part, and words that name a file rather than a thing.
HUMPS = r"([a-z0-9])([A-Z])|([A-Z])([A-Z][a-z])"
SEPARATORS = r"[_/\\-]+"
FILE_WORDS = r"(?i)(?<!\S)(?:sm|prefab)(?!\S)"
LAST_LEVEL = r"(?i)(?<!\S)lod\d+\s*$"
LAST_HIT_SET = r"(?i)(?<!\S)hit\s+set\s*$"
COPY_NUMBER = r"\$\d+$"
#: Elements that are never closed by another one's tag.
NESTED = ("article", "section", "main", "div", "u", "code")


def humanize(name: Column, scenery: bool = False) -> Column:
    """An identifier as a phrase: its words in small letters, the first letter a capital.

    A last "hit set" says nothing. Names of scenery come from files: the number of a
    copy, words that name the file and a last level of detail say nothing either,
    whether they stand between separators or only between humps.
    """
    without = lambda text, *patterns: reduce(lambda t, p: F.regexp_replace(t, p, ""), patterns, text)
    phrase = F.regexp_replace(without(name, COPY_NUMBER) if scenery else name, SEPARATORS, " ")
    said_by_files = (FILE_WORDS, LAST_LEVEL) if scenery else ()
    phrase = F.regexp_replace(without(phrase, *said_by_files), HUMPS, "$1$3 $2$4")
    low = F.lower(F.trim(F.regexp_replace(without(phrase, LAST_HIT_SET, *said_by_files), r"\s+", " ")))
    return F.when(low == "", "Unnamed record").otherwise(F.concat(F.upper(F.left(low, F.lit(1))), F.substring(low, F.lit(2), F.length(low))))


def word_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(F.split(a, " "), F.split(b, " "))) == 0


def thousands(n: Column) -> Column:
    return F.format_number(n.cast("long"), 0)


def fill(template: str) -> Column:
    """Literal pieces and {column} fields."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.col(p).cast("string") if k % 2 else F.lit(p) for k, p in enumerate(pieces) if p])


def join_and(names: Column) -> Column:
    n = F.size(names)
    return F.when(n <= 1, F.array_join(names, "")).otherwise(
        F.concat(F.array_join(F.slice(names, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(names, -1))
    )


def escape_markdown(text: Column) -> Column:
    out = text
    for raw, safe in (("*", "\\*"), ("_", "\\_"), ("<", "&lt;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def balanced(page: Column, tags: tuple[str, ...]) -> Column:
    """Whether the tags of these elements nest: a fold over the tags with the open elements as a text, the innermost first."""
    names = "|".join(tags)
    events = F.regexp_extract_all(F.lower(page), F.lit(f"<(/?(?:{names}))(?=[ \\t\\r\\n/>])"), F.lit(1))

    def step(state: Column, tag: Column) -> Column:
        opens = ~tag.startswith("/")
        closed = F.concat(F.substring(tag, F.lit(2), F.length(tag)), F.lit(" "))
        fits = state["open"].startswith(closed)
        left = F.when(opens, F.concat(tag, F.lit(" "), state["open"])).when(fits, F.substring(state["open"], F.length(closed) + 1, F.length(state["open"]))).otherwise(state["open"])
        return F.struct(left.alias("open"), (state["ok"] & (opens | fits)).alias("ok"))

    start = F.struct(F.lit("").alias("open"), F.lit(True).alias("ok"))
    return F.aggregate(events, start, step, lambda s: s["ok"] & (s["open"] == ""))


def article_state(page: Column) -> Column:
    """struct<state, reason> of a page's body, by what is left without tags."""
    body = F.regexp_replace(F.regexp_replace(page, "(?s)<(script|style|nav|footer|head)[ >].*?(</\\1>|\\z)", ""), "(?s)<[^>]*>", " ")
    words = F.size(F.filter(F.split(body, r"\s+"), lambda w: F.length(w) > 0))
    state = F.when(page.isNull(), "unavailable").when(words < 5, "empty").otherwise("populated")
    reason = F.when(page.isNull(), "no body").when(words < 5, "no text").when(~balanced(page, NESTED), "unbalanced tags").otherwise("text")
    return F.struct(state.alias("state"), reason.alias("reason"))


@F.pandas_udf(StringType())
def fold(text: pd.Series) -> pd.Series:
    """Lower case, compatibility decomposition, marks stripped, white space collapsed."""

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", s.replace("_", " ").casefold()) if not unicodedata.combining(c))
        return " ".join(plain.split())

    return text.map(one)


@F.pandas_udf(StringType())
def search_form(text: pd.Series) -> pd.Series:
    """Lower case, compatibility decomposition, accents stripped; SQL has no normal forms."""
    return text.map(lambda s: None if s is None else re.sub("[\u0300-\u036f]", "", unicodedata.normalize("NFKD", s.lower())))


@F.pandas_udf(StringType())
def title_key(text: pd.Series) -> pd.Series:
    """Compatibility composition, underscores and white space to one space, case folded."""
    return text.map(lambda s: None if s is None else " ".join(unicodedata.normalize("NFKC", s).replace("_", " ").split()).casefold())


NO_SPANS = "array<struct<start:int,end:int,rule:string,match:string>>"


def _hits(text: Column, rule: str) -> Column:
    return F.regexp_extract_all(text, F.lit(CODED if rule == "identifier" else JARGON[rule]), F.lit(0))


def _spans(text: Column, hits: Column, rule: str) -> Column:
    """array<struct<start, end, rule, match>> of a rule's matches: their places follow from the gaps between them."""
    both = F.arrays_zip(F.split(text, CODED if rule == "identifier" else JARGON[rule], -1).alias("gap"), hits.alias("hit"))
    none = F.array().cast(NO_SPANS)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(rule).alias("rule"), x["hit"].alias("match")))
        return F.struct(end.alias("at"), F.when(x["hit"].isNotNull(), F.concat(state["out"], span)).otherwise(state["out"]).alias("out"))

    found = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(hits) == 0, none).otherwise(found)


def jargon_spans(rows: DataFrame, coded: Column | None = None) -> DataFrame:
    """rows(id, text) -> (id, rule, start, end, match): a finding that overlaps one of an earlier rule is suppressed.

    A whole text that is a bare integer is a raw enum where ``coded`` says that the field holds codes.
    """
    text = F.coalesce("text", F.lit(""))
    spans = rows.select("id", "text", F.array().cast(NO_SPANS).alias("spans"), (coded if coded is not None else F.lit(False)).alias("coded"))
    for rule in JARGON:
        # Projections of their own: hits and the spans so far are one column each to what follows, and texts without hits are not split.
        spans = spans.withColumn("hits", _hits(text, rule)).withColumn("more", _spans(text, F.col("hits"), rule))
        free = F.filter("more", lambda x: ~F.exists("spans", lambda s: (x["start"] < s["end"]) & (s["start"] < x["end"])))
        spans = spans.withColumn("spans", F.concat("spans", free)).drop("more", "hits")
    enum = F.struct(F.lit(0).alias("start"), F.length("text").alias("end"), F.lit("raw_enum").alias("rule"), F.trim("text").alias("match"))
    bare = F.col("coded") & F.coalesce(F.col("text").rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False))
    spans = spans.withColumn("spans", F.when(bare, F.concat("spans", F.array(enum))).otherwise(F.col("spans")))
    return spans.select("id", F.explode("spans").alias("x")).select("id", "x.rule", F.col("x.start").cast("long").alias("start"), F.col("x.end").cast("long").alias("end"), "x.match")
