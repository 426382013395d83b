"""Spelling variants: words at one edit from each other, by a bit-sliced position index.

Words are runs of letters over whole texts, counted with map-side sums. Two words
at one edit share either the first or the second half of the shorter one, so every
word goes to a bucket for each half, once as the shorter and once as the longer
word. A bucket keeps the words that agree on their first ``a`` and last ``b``
letters, and it answers for the pairs whose first difference lies before letter
``c`` only, so that no pair is found twice. A bucket of more than ``CROWDED`` words
is split again in the same way, on the letters that are still free; with one free
letter it is bounded by the alphabet.

Inside a bucket each (position, letter) has a bitset over the bucket's words. A
word reads its letters from left to right and carries four sets at once: the words
without an error so far, and those with one letter replaced, one letter more or
one letter fewer, which are matched at the same, the preceding or the following
position. One pass of word-parallel operations finds all partners. Words are
numbered by falling frequency, so the lowest bit is the best partner and the
number of bits the number of partners; pairs are never listed.

Defined cases: a null or empty text has no words; a null id counts as an empty one
where letters are deleted; rows that repeat each other count each; equally frequent
partners: the smallest in code-point order is the form; an empty table gives no
rows; extra columns are ignored. Words may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.llm.text import ascii_lower
from lodestack.session import cut, shuffle_partitions

#: Fixed value: what a word is made of.
LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_CHARS = 7
MIN_COUNT = 2
#: A form is at least so many times as frequent.
TIMES = 10
#: Of all runs, one in so many loses a letter.
NOISE = 31
CROWDED = 2048
NO_BOUND = 1 << 30
OUT_ROWS = 50_000


def noisy(run: Column, doc_id: Column) -> Column:
    """The run, or, where the checksum of id and run says so, the run without one of its letters."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % NOISE == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least min_chars letters that occur min_count times or more, with one run in NOISE made noisy."""
    # A run never grows, so shorter runs are not even taken out; a match is maximal, as it begins where a run begins.
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS}{{{min_chars},}})"), F.lit(1))
    each = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
    words = each.select(noisy(ascii_lower(F.col("run")), F.col("id")).alias("word")).filter(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _bucket(m: Column, a: Column, b: Column, c: Column) -> Column:
    key = F.concat_ws(" ", m, a, b, c, F.substring("word", F.lit(1), a), F.when(b > 0, F.substring("word", F.length("word") - b + 1, b)).otherwise(F.lit("")))
    return F.struct(m.alias("m"), a.alias("a"), b.alias("b"), c.alias("c"), key.alias("key"))


def _halves(m: Column, a: Column, b: Column, c: Column) -> tuple[Column, Column]:
    """The two buckets that split one: by the first half of its free letters, and by the second."""
    half = (m - a - b) / 2
    split = a + F.floor(half).cast("int")
    return _bucket(m, split, b, c), _bucket(m, a, m - split, F.least(c, split))


def buckets(words: DataFrame, crowded: int = CROWDED, shortest: int = 1) -> DataFrame:
    """words(word, n), of ``shortest`` letters or more -> (word, n, m, a, b, c, key): every pair at one edit meets in just one bucket."""
    none, most = F.lit(0), F.lit(NO_BOUND)
    size = F.length("word")
    whole = [x for m in (size, size - 1) for x in _halves(m, none, none, most)]
    rest = words.select("word", "n", F.explode(F.array(*whole)).alias("at")).select("word", "n", "at.*").filter(F.col("m") >= shortest)
    out = None
    while True:
        rest = cut(rest)
        splits = F.col("m") - F.col("a") - F.col("b") > 1
        full = cut(rest.filter(splits).groupBy("key").count().filter(F.col("count") > crowded).select("key"))
        if full.isEmpty():
            return rest if out is None else out.union(rest)
        done = rest.join(full, "key", "left_anti").select(*rest.columns)
        out = done if out is None else out.union(done)
        again = F.explode(F.array(*_halves(*(F.col(x) for x in "mabc")))).alias("at")
        rest = rest.join(full, "key", "left_semi").select("word", "n", again).select("word", "n", "at.*")


def partners(words: list[str], m: int, a: int, b: int, c: int) -> Iterator[tuple[int, int, int]]:
    """(word, partners, least partner) by their numbers, of the words of one bucket, for those that have any."""
    at: list[dict[str, int]] = [{} for _ in range(m + 2)]
    short = long = 0
    for k, word in enumerate(words):
        bit = 1 << k
        if len(word) == m:
            short |= bit
        else:
            long |= bit
        for i in range(a, len(word)):
            letters = at[i]
            letters[word[i]] = letters.get(word[i], 0) | bit
    every = short | long
    for k, word in enumerate(words):
        exact, one, size = every, 0, len(word)
        if size == m:
            replaced = more = 0  # more: the partner has a letter more
            for i in range(a, size - b):
                letter = word[i]
                same = at[i].get(letter, 0)
                differ = exact & ~same if i < c else 0
                replaced = replaced & same | differ
                more = (more | differ) & at[i + 1].get(letter, 0)
                exact &= same
                if not (exact or replaced or more):
                    break
            one = replaced & short | more & long
            if size < c:
                one |= exact & long
        elif short:
            fewer = 0  # the partner has a letter fewer
            for i in range(a, size - b):
                letter = word[i]
                same = at[i].get(letter, 0)
                fewer = (fewer & at[i - 1].get(letter, 0) if i > a else 0) | (exact & ~same if i < c else 0)
                exact &= same
                if not (exact or fewer):
                    break
            one = fewer & short
        if one:
            yield k, one.bit_count(), (one & -one).bit_length() - 1


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and, in it, by falling n and word; a bucket may run over batches."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    out: list[tuple] = []

    def close(rows: list[tuple]) -> None:
        if len(rows) > 1:
            _, m, a, b, c, _, _ = rows[0]
            words = [r[5] for r in rows]
            out.extend((words[k], near, rows[j][6], words[j]) for k, near, j in partners(words, m, a, b, c))

    def emit() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(columns, schema)], schema=schema)

    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in ("key", "m", "a", "b", "c", "word", "n"))):
            if group and row[0] != group[0][0]:
                close(group)
                group = []
                if len(out) >= OUT_ROWS:
                    yield emit()
            group.append(row)
    close(group)
    yield emit()


def near_words(words: DataFrame, crowded: int = CROWDED, shortest: int = 1) -> DataFrame:
    """words(word, n), distinct -> (word, n_near, best_n, best) for words with a partner at one edit."""
    parts = shuffle_partitions(words.sparkSession)
    dealt = buckets(words, crowded, shortest).repartition(parts, "key").sortWithinPartitions("key", F.col("n").desc(), "word")
    found = dealt.select("key", "m", "a", "b", "c", "word", "n").mapInArrow(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("least"))
    return near.select("word", "n_near", (-F.col("least.n")).alias("best_n"), F.col("least.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """forms(word, form) without cycles -> (word, root): pointers are doubled until none moves."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onto = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = cut(now.join(onto, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(words: DataFrame, times: int = TIMES, crowded: int = CROWDED, shortest: int = 1) -> DataFrame:
    """words(word, n), distinct -> (word, form, root, n, n_near, form_n): partners at one edit, the form among them and the end of its chain."""
    words = cut(words.select("word", "n"))
    near = near_words(words, crowded, shortest)
    is_form = F.col("best_n") >= F.col("n") * times
    known = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
    ))
    ends = roots(known.filter("form IS NOT NULL").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
