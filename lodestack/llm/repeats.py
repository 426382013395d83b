"""Suffix-array dedup: remove bytes covered by 200-byte strings that occur elsewhere.

Partition. Every 200-byte window is named by the least hash among its 48-byte
grams; equal windows have equal names. Consecutive windows of one name form a
segment, so each window start lies in exactly one segment, and all occurrences
of a window lie in segments of one name. Names that occur in one segment only
(unless its gram recurs inside) are dropped after a count with map-side sums;
equal segments collapse. What remains are names with different segments, where
copies begin, end or differ.

Method. The segments of a batch of names are joined with separators, their
suffixes sorted, and the Burrows-Wheeler transform read off. From the interval of
the empty string, intervals are extended backwards by one character at a time,
breadth first; the first interval to end before a row fixes the row's longest
common prefix, so prefixes come in increasing order. The search stops at 200:
rows still open share 200 bytes or more with the row before, and both are
repeats. Every interval that goes on has fixed a row, so the work is linear.

Scale. Documents cross the network once, for the text of the segments that must
be compared and for the final removal; other shuffles carry fixed-width numbers.
A name whose different segments hold more than ``HOT_BYTES`` bytes would be one
transform too large for a task: its windows are counted by a 128-bit hash of their
own instead, with map-side sums, so a passage that a third of all documents share
with different surroundings fills no task. Joins salt the names and segments that
hold more than 1 in ``MOST_HOT`` of the rows; there are fewer than that many.

Defined cases: a null text is an empty one; texts below 200 bytes lose nothing;
rows that repeat each other are copies, and ties need no choice, as every copy
goes; a null id is carried as it is; an empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.session import cut, shuffle_partitions

LENGTH = 200
GRAM = 48
#: Windows a segment has at most; longer runs, as in periodic text, are cut.
LONGEST = 512
HOT_BYTES = 2 << 20
MOST_HOT = 1000
SALTS = 64
SLICE = 1 << 20
BATCH_BYTES = 1 << 20
#: Odd multipliers of the gram hash and its mixer.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of every run of ``gram`` bytes, by doubling."""
    out, width = None, 0
    power, size = data.astype(np.uint64) + np.uint64(1), 1
    base = BASE
    rest = gram
    while rest:
        if rest & 1:
            if out is None:
                out, width = power, size
            else:  # the part found so far follows this one
                n = len(data) - width - size + 1
                shift = np.uint64(pow(int(BASE), width, 1 << 64))
                out, width = power[:n] * shift + out[size : size + n], width + size
        rest >>= 1
        if rest:
            n = len(power) - size
            power = power[:n] * base + power[size : size + n]
            base, size = np.uint64(int(base) ** 2 % (1 << 64)), size * 2
    out = out ^ (out >> np.uint64(32))
    out = out * MIX
    return out ^ (out >> np.uint64(29))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by block prefixes and suffixes."""
    n = len(values)
    blocks = -(-n // width)
    table = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    table[:n] = values
    table = table.reshape(blocks, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def segments(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """(name, first window, windows, whether the gram recurs) of the segments over the valid window starts."""
    width = LENGTH - GRAM + 1
    grams = gram_hashes(data, GRAM)
    least = window_minima(grams, width)
    at = np.flatnonzero(valid[: len(least)])
    if not len(at):
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    name = least[at]
    new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (name[1:] != name[:-1])))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    if count.max() > LONGEST:
        first = np.concatenate([np.arange(a, a + n, LONGEST) for a, n in zip(first, count)])
        count = np.diff(np.append(first, len(at)))
    start, name = at[first], name[first]
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    again = np.zeros(len(start), dtype=np.int64)
    for k in range(0, len(start), 2048):
        cut_ = slice(k, k + 2048)
        left = (views[start[cut_]] == name[cut_, None]).argmax(axis=1) + start[cut_]
        end = start[cut_] + count[cut_] - 1
        right = end + width - 1 - (views[end][:, ::-1] == name[cut_, None]).argmax(axis=1)
        again[cut_] = left != right
    return name, start, count, again


def _slices(column: pa.Array) -> Iterator[tuple[int, int, memoryview, list[tuple[int, int]]]]:
    """Pieces of about SLICE bytes as (first row, offset in that row, bytes, [(row start, row end)])."""
    texts: list[bytes] = []
    size = first = 0

    def packed(row: int, offset: int, parts: list[bytes]):
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        return row, offset, memoryview(b"".join(parts)), list(zip(ends[:-1], ends[1:]))

    for k, value in enumerate(column):
        raw = (value.as_py() or "").encode("utf-8", "replace")
        if len(raw) > SLICE:  # windows are dealt to pieces; pieces overlap by what a window needs
            if texts:
                yield packed(first, 0, texts)
            for offset in range(0, len(raw) - LENGTH + 1, SLICE):
                yield packed(k, offset, [raw[offset : offset + SLICE + LENGTH - 1]])
            texts, size, first = [], 0, k + 1
            continue
        texts.append(raw)
        size += len(raw)
        if size > SLICE:
            yield packed(first, 0, texts)
            texts, size, first = [], 0, k + 1
    if texts:
        yield packed(first, 0, texts)


SEGMENT = "id long, th long, name long, sh long, first long, n int, again int"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1)
        for row, offset, raw, rows in _slices(batch.column(2)):
            data = np.frombuffer(raw, dtype=np.uint8)
            if len(data) < LENGTH:
                continue
            valid = np.zeros(len(data) + 1, dtype=np.int8)
            for a, b in rows:
                if b - a >= LENGTH:
                    valid[a] += 1
                    valid[b - LENGTH + 1] -= 1
            name, start, count, again = segments(data, np.cumsum(valid[:-1]) > 0)
            digest = xxhash.xxh64_intdigest
            sh = np.array([digest(raw[a:b]) for a, b in zip(start.tolist(), (start + count + LENGTH - 1).tolist())], dtype=np.uint64)
            begins = np.array([a for a, _ in rows], dtype=np.int64)
            of = np.searchsorted(begins, start, side="right") - 1
            # empty rows share their begin with the next row; the last one of them holds the bytes
            take = pa.array(of + row)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(take), hashes.take(take), pa.array(name.view(np.int64)), pa.array(sh.view(np.int64)),
                    pa.array(start - begins[of] + offset), pa.array(count.astype(np.int32)), pa.array(again.astype(np.int32)),
                ],
                names=[x.split()[0] for x in SEGMENT.split(", ")],
            )


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes by their first ``depth`` or more characters, ties by place. Characters are below 512."""
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, dtype=np.uint64)])
    rank = np.zeros(n, dtype=np.uint64)
    for k in range(7):
        rank = (rank << np.uint64(9)) | padded[k : k + n]
    known = 7
    while True:
        order = np.argsort(rank, kind="stable")
        step = np.concatenate(([0], np.cumsum(rank[order[1:]] != rank[order[:-1]])))
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = step.astype(np.uint64)
        if known >= depth or step[-1] == n - 1:
            place = np.empty(n, dtype=np.int64)
            place[order] = np.arange(n)
            return order, place
        later = np.zeros(n, dtype=np.uint64)
        later[: max(0, n - known)] = rank[known:] + np.uint64(1)
        rank = rank * np.uint64(n + 2) + later
        known *= 2


def long_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether the row shares at least ``length`` characters with the row before)."""
    n = len(text)
    order, place = suffix_order(text, length + 1)
    before = np.where(order > 0, order - 1, n - 1)
    char = text[before].astype(np.int64)  # the transform
    to = place[before]  # where a row goes when its suffix grows by that character
    open_ = np.ones(n + 1, dtype=bool)
    open_[0] = open_[n] = False
    low, high = np.zeros(1, dtype=np.int64), np.full(1, n - 1, dtype=np.int64)
    for _ in range(length):
        size = high - low + 1
        one = size == 1
        new_low, new_high = [to[low[one]]], [to[low[one]]]
        if not one.all():
            many, wide = low[~one], size[~one]
            ends = np.cumsum(wide)
            owner = np.repeat(np.arange(len(wide)), wide)
            rows = np.arange(ends[-1]) - np.repeat(ends - wide, wide) + np.repeat(many, wide)
            target, letter = to[rows], char[rows]
            by = np.lexsort((target, letter, owner))
            owner, target, letter = owner[by], target[by], letter[by]
            edge = np.flatnonzero((owner[1:] != owner[:-1]) | (letter[1:] != letter[:-1]))
            new_low.append(target[np.concatenate(([0], edge + 1))])
            new_high.append(target[np.concatenate((edge, [len(target) - 1]))])
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        fresh = open_[high + 1]
        low, high = low[fresh], high[fresh]
        # Two intervals of one level may end at one row only if they are the same.
        high, at = np.unique(high, return_index=True)
        low = low[at]
        open_[high + 1] = False
        if not len(low):
            break
    return order, open_[:n]


def repeated_windows(parts: list[bytes], length: int) -> list[list[int]]:
    """Runs [a, b, a, b, ...] of window starts of each part that occur elsewhere in the parts."""
    sizes = np.array([len(p) + 1 for p in parts])
    text = np.zeros(int(sizes.sum()), dtype=np.uint16)
    begins = np.cumsum(sizes) - sizes
    joined = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    text[:] = joined.astype(np.uint16) + 1
    text[begins + sizes - 1] = 0
    order, shared = long_prefixes(text, length)
    twice = np.zeros(len(text) + 1, dtype=bool)
    rows = np.flatnonzero(shared)
    twice[order[rows]] = True
    twice[order[rows - 1]] = True
    room = np.repeat(begins + sizes - 1, sizes) - np.arange(len(text))
    twice[:-1] &= room >= length  # not across separators
    edges = np.flatnonzero(np.diff(np.concatenate(([0], twice.astype(np.int8)))))
    out: list[list[int]] = [[] for _ in parts]
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        k = int(np.searchsorted(begins, a, side="right")) - 1
        out[k] += [a - int(begins[k]), b - int(begins[k])]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, sh, bytes) sorted by name -> (name, sh, runs) of rows with repeats."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def work() -> pa.RecordBatch:
        runs = repeated_windows([x[2] for x in held], LENGTH)
        found = [(x[0], x[1], r) for x, r in zip(held, runs) if r]
        return pa.RecordBatch.from_arrays(
            [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))],
            names=["name", "sh", "runs"],
        )

    for batch in batches:
        for name, sh, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if size > BATCH_BYTES and held[-1][0] != name:
                yield work()
                held, size = [], 0
            held.append((name, sh, raw))
            size += len(raw)
    if held:
        yield work()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, [(first, n, name, sh)]) -> (name, sh, bytes)."""
    for batch in batches:
        name, sh, raw = [], [], []
        for text, wanted in zip(batch.column(0), batch.column(1)):
            data = (text.as_py() or "").encode("utf-8", "replace")
            for w in wanted.as_py():
                name.append(w["name"])
                sh.append(w["sh"])
                raw.append(data[w["first"] : w["first"] + w["n"] + LENGTH - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(name, pa.int64()), pa.array(sh, pa.int64()), pa.array(raw, pa.binary())], names=["name", "sh", "raw"]
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of hot names: (name, sh, raw) -> (name, sh, k, two hashes)."""
    for batch in batches:
        for name, sh, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
            n = len(raw) - LENGTH + 1
            both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[k : k + LENGTH]) for k in range(n)]), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, name)), pa.array(np.full(n, sh)), pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                ],
                names=["name", "sh", "k", "h", "g"],
            )


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for doc, text, ranges in zip(batch.column(0), batch.column(1), batch.column(2)):
            data = (text.as_py() or "").encode("utf-8", "replace")
            flat = np.sort(np.array([(r["a"], r["b"]) for r in ranges.as_py() or []], dtype=np.int64).reshape(-1, 2), axis=0)
            kept, spans, at = [], 0, 0
            if len(flat):
                top = np.maximum.accumulate(flat[:, 1])
                first = np.concatenate(([True], flat[1:, 0] > top[:-1]))
                starts = flat[first, 0].tolist()
                ends = top[np.append(np.flatnonzero(first)[1:] - 1, len(flat) - 1)].tolist()
                spans = len(starts)
                for a, b in zip(starts, ends):
                    kept.append(data[at:a])
                    at = b
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((doc.as_py(), len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=names)


def _salted(rows: DataFrame, small: DataFrame, keys: list[str], hot_key: str, hot: list[int]) -> DataFrame:
    """rows joined with small(keys...): those of hot keys are dealt over salts, each with a copy of its small row."""
    if not hot:
        return rows.join(small, keys)
    is_hot = F.col(hot_key).isin(hot)
    rows = rows.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("id", "th", "first"), F.lit(SALTS))).otherwise(0).cast("int"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.join(small.withColumn("salt", F.explode(salts)), [*keys, "salt"]).drop("salt")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_BYTES, most: int = MOST_HOT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept binary) of every row."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("th"), F.col(text_col).alias("text")
    )
    found = rows.mapInArrow(_find, SEGMENT)
    names = (
        found.groupBy("name")
        .agg(F.count("*").alias("c"), F.max("again").alias("again"), F.min("sh").alias("lo"), F.max("sh").alias("hi"))
        .filter("c > 1 or again = 1")
        .select("name", F.expr("lo != hi or c = 1").alias("mixed"), "c")
    )
    # Segments of repeated names, a share of all: numbers only.
    names = cut(names)
    total = names.agg(F.sum("c")).first()[0] or 0
    hot_names = [r["name"] for r in names.filter(F.col("c") * most > total).select("name").collect()]  # fewer than ``most``
    known = cut(_salted(found, names.drop("c"), ["name"], "name", hot_names).select("id", "th", "name", "sh", "first", "n", "mixed"))
    mixed = known.filter("mixed")
    # A sketch over the written numbers names every segment with more than 1 in ``most`` of the rows.
    top = mixed.agg(F.expr(f"approx_top_k(sh, {most}, {4 * most})").alias("top"), F.count("*").alias("n")).first()
    hot_segments = [x["item"] for x in top["top"] or [] if x["count"] * most > top["n"]]
    distinct = mixed.groupBy("name", "sh").agg(
        F.count("*").alias("c"), F.min(F.struct("id", "th", "first", "n")).alias("at")
    )
    wanted = distinct.groupBy(F.col("at.id").alias("id"), F.col("at.th").alias("th")).agg(
        F.collect_list(F.struct("at.first", "at.n", "name", "sh")).alias("wanted")
    )
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("id", "th")]
    texts = rows.alias("d").join(wanted.hint("shuffle_hash").alias("w"), same("d", "w")).select("d.text", "w.wanted")
    raw = texts.mapInArrow(_cut_out, "name long, sh long, raw binary")
    crowded = distinct.groupBy("name").agg(F.sum(F.col("at.n") + LENGTH - 1).alias("bytes")).filter(F.col("bytes") > hot).select("name")
    calm = raw.join(crowded, "name", "left_anti")
    compared = (
        calm.repartition(shuffle_partitions(spark), "name")
        .sortWithinPartitions("name", "sh")
        .mapInArrow(_compare, "name long, sh long, runs array<int>")
        .select("name", "sh", F.expr("transform(sequence(0, size(runs) - 2, 2), i -> struct(runs[i] AS a, runs[i + 1] AS b))").alias("runs"))
    )
    windows = cut(raw.join(crowded, "name", "left_semi").mapInArrow(_windows, "name long, sh long, k int, h long, g long"))
    often = windows.groupBy("h", "g").count().filter("count > 1").select("h", "g")
    single = windows.join(often, ["h", "g"], "left_semi").groupBy("name", "sh").agg(
        F.collect_list(F.struct(F.col("k").alias("a"), (F.col("k") + 1).alias("b"))).alias("runs")
    )
    runs = compared.unionByName(single).alias("r")
    of = distinct.alias("x").join(runs, [F.col("x.name") == F.col("r.name"), F.col("x.sh") == F.col("r.sh")], "left")
    of = of.select("x.name", "x.sh", "x.c", "r.runs").filter("c > 1 or runs is not null").select("name", "sh", F.expr("c > 1").alias("copied"), "runs")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    partly = _salted(mixed, of, ["name", "sh"], "sh", hot_segments).select("id", "th", "first", F.when(F.col("copied"), whole).otherwise(F.col("runs")).alias("runs"))
    marks = known.filter("not mixed").select("id", "th", "first", whole.alias("runs")).union(partly)
    ranges = (
        marks.select("id", "th", "first", F.explode("runs").alias("r"))
        .select("id", "th", F.struct((F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b") + LENGTH - 1).alias("b")).alias("r"))
        .groupBy("id", "th")
        .agg(F.collect_list("r").alias("ranges"))
    )
    joined = rows.alias("d").join(ranges.hint("shuffle_hash").alias("g"), same("d", "g"), "left").select("d.id", "d.text", "g.ranges")
    return joined.mapInArrow(
        _remove, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
