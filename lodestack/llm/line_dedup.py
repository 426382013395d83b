"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop, reassemble by position.

Everything is DataFrame code. The line table holds no text: a 128-bit key hash,
the document and the position. Counting is two-level (key and document first,
then key), so a line that a third of all documents share is summed before the
shuffle and never gathered. The lines over the threshold are written once. Those
that hold more than a share of 1 in ``MOST_HOT`` of all their occurrences are at
most ``MOST_HOT`` by that very bound, whatever the corpus: they are broadcast, so
no task receives a hot line's occurrences. The others, none of which is hot, are
joined by a shuffle. Back to the documents goes one array of dropped positions
per document, at most as long as its own lines; the rest is put together by
position in time linear in the lines.

Defined cases: a null or empty text is one empty line; an empty table gives no
rows. Rows with a null doc_id count as one document that is smaller than any
other; rows that repeat a doc_id count as one document, and all of them keep the
line if they hold the largest id. Extra columns pass through untouched, but one
that is called ``line_dedup`` is replaced; the operator's own columns cannot clash
with others because the rows travel inside one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.llm.text import ascii_lower
from lodestack.session import cut

#: Fixed value: the characters stripped from both ends of a line.
STRIPPED = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
#: Lines that are broadcast at most, 24 bytes each.
MOST_HOT = 50_000


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(STRIPPED)))


def key_hash(key: Column) -> Column:
    """128 bits of SHA-256, as 16 bytes."""
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    most_hot: int = MOST_HOT,
) -> DataFrame:
    """All columns of ``docs`` plus ``line_dedup`` struct<kept string, n_lines long, n_dropped long>."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.split(text, "\n", -1).alias("lines"))
    lines = (
        row.select("id", "th", F.posexplode("lines").alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
        .select("id", "th", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("id", "th", "pos", key_hash(F.col("key")).alias("h"))
    )
    frequent = cut(
        lines.groupBy("h", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h")
        .agg(F.count("one").alias("n"), F.max("id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
    )
    keys, total = frequent.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    is_hot = F.lit(keys <= most_hot) | (F.col("n") * most_hot > total)
    hit = lines.join(F.broadcast(frequent.filter(is_hot).select("h", "keeper")), "h")
    if keys > most_hot:
        hit = hit.union(lines.join(frequent.filter(~is_hot).select("h", "keeper"), "h"))
    dropped = (
        hit.filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("drop"))
    )
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != "line_dedup"]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    own = own.withColumns({"key_id": F.col("row")[id_col], "key_th": F.xxhash64(text)})
    joined = own.join(
        dropped, F.col("key_id").eqNullSafe(F.col("id")) & (F.col("key_th") == F.col("th")), "left"
    )
    lines = F.split(text, "\n", -1)
    # The lines are split once and bound to a name; an expression in the inner function would be split again for each of them.
    positions = lambda ls: F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("drop"))
    kept = F.transform(F.array(lines), lambda ls: F.concat_ws("\n", F.transform(positions(ls), lambda i: F.get(ls, i))))
    out = joined.select(
        "row",
        F.struct(
            F.when(F.col("drop").isNull(), text).otherwise(F.get(kept, F.lit(0))).alias("kept"),
            F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size(F.col("drop")), F.lit(0)).cast("long").alias("n_dropped"),
        ).alias("line_dedup"),
    )
    return out.select("row.*", "line_dedup")
