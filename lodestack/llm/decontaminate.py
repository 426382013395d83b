"""Benchmark decontamination by SimHash windows of the items' own sizes.

A document window of as many words as a benchmark item is contaminated when its
five-word shingles, weighted by how often they occur, overlap the item's by 0.8
or more: sum of the smaller weights over the larger of the two totals (two
windows of one size have equal totals, so this is the share of the item found).

Windows get 64-bit SimHash fingerprints by prefix sums of their shingles' bits.
Fingerprints are cut into four blocks of 16 bits; differences of at most
``RADIUS`` = 23 bits leave at most five on some block, so looking up every block
value within five bits finds all items within the radius. Candidates are then
verified on the words themselves. Only windows that share a shingle with an item
of their size are fingerprinted: others have similarity zero.

Documents are scanned once, whatever the size of the benchmark. One of up to
``SMALL_BENCHMARK`` bytes (measured) goes to every task and documents are matched
where they are read. A larger one is dealt into blocks of about ``BLOCK_BYTES``;
its shingles, with their blocks, are an index. Up to ``MOST_SHINGLES`` of them
(counted) go to every task, so the scan emits a document once for each block that
it shares a shingle with; beyond that the scan has a bitmap of 2^27 bits, and the
hits that pass it meet the index in a shuffle join. Documents of a block then meet
its items in tasks of about ``DOCS`` documents, each with a copy of the block, so
an item that a third of all documents hold fills no task.

Fingerprints of windows of similarity 0.8 lie within the radius with a probability
of about 0.999 (a bit differs with probability arccos(0.8) / pi), above 0.8 with
more; tests/llm measures it.

Defined cases: null or empty texts and items match nothing; an item of fewer
than five words is one shingle of that length; repeated rows of an item report
once, equal texts under different ids each under its own; of equally similar
windows the first is named; null ids are carried as they are; empty tables give
no rows; extra columns are ignored, and keep_clean() passes them through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestack.session import cut, shuffle_partitions

WORDS = re.compile(r"[^\W_]+")
SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 4
SMALL_BENCHMARK = 4 << 20
BLOCK_BYTES = 1 << 20
MOST_SHINGLES = 4_000_000
BITMAP = 1 << 27
DOCS = 5_000
KNOWN_WORDS = 500_000
#: Fixed value: an odd multiplier for rolling shingle hashes.
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def overlap(a: list[str], b: list[str], size: int) -> float:
    """Exact weighted-shingle similarity."""
    x, y = (Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) for w in (a, b))
    return sum((x & y).values()) / max(x.total(), y.total(), 1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * STEP + words[k : k + n]
    out ^= out >> np.uint64(29)
    out *= STEP
    return out ^ (out >> np.uint64(32))


def simhashes(shingles: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of every window of ``width`` consecutive shingles."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    ones = sums[width:] - sums[:-width]
    return np.packbits(2 * ones > width, axis=1).view("<u8").ravel()


class Items:
    """One block of items: shingle lookup, fingerprints and the multi-index."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids, self.words = [], []
        for item, text in rows:
            if words := words_of(text):
                self.ids.append(item)
                self.words.append(words)
        self.known: dict[str, int] = {}
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.fps = np.zeros(len(self.words), dtype=np.uint64)
        #: shingle length -> (sorted distinct hashes, item sizes that have each)
        self.shingles: dict[int, tuple[np.ndarray, list[set[int]]]] = {}
        found: dict[int, dict[int, set[int]]] = {}
        for k, words in enumerate(self.words):
            size = min(SHINGLE, len(words))
            hashes = shingle_hashes(self.hashed(words), size)
            self.fps[k] = simhashes(hashes, len(hashes))[0]
            for h in hashes.tolist():
                found.setdefault(size, {}).setdefault(h, set()).add(len(words))
        for size, of in found.items():
            keys = np.array(sorted(of), dtype=np.uint64)
            self.shingles[size] = keys, [of[h] for h in keys.tolist()]
        self.parts = self._parts(self.fps)
        self.near: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def _parts(fps: np.ndarray) -> np.ndarray:
        return np.stack([(fps >> np.uint64(16 * b)) & np.uint64(0xFFFF) for b in range(BLOCKS)]).astype(np.uint16)

    def hashed(self, words: list[str]) -> np.ndarray:
        known = self.known
        if new := [w for w in set(words) if w not in known]:
            if len(known) + len(new) > KNOWN_WORDS:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
        return np.array([known[w] for w in words], dtype=np.uint64)

    def candidates(self, fps: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) within the radius, through blocks that differ in few bits."""
        each = RADIUS // BLOCKS
        parts = self._parts(fps)
        for w in range(len(fps)):
            met = []
            for b in range(BLOCKS):
                key = b, int(parts[b, w])
                if key not in self.near:
                    if len(self.near) > 1 << 18:
                        self.near.clear()
                    self.near[key] = np.flatnonzero(np.bitwise_count(self.parts[b] ^ np.uint16(key[1])) <= each)
                met.append(self.near[key])
            items = np.unique(np.concatenate(met))
            for k in items[np.bitwise_count(self.fps[items] ^ fps[w]) <= RADIUS]:
                yield w, int(k)

    def matches(self, text: str | None) -> dict[int, tuple[float, int]]:
        """item index -> (similarity, first word) of its best window."""
        words = words_of(text)
        best: dict[int, tuple[float, int]] = {}
        if not words or not self.shingles:
            return best
        hashed = self.hashed(words)
        for size, (keys, of) in self.shingles.items():
            mine = shingle_hashes(hashed, size)
            at = np.searchsorted(keys, mine)
            at[at == len(keys)] = 0
            hits = np.flatnonzero(keys[at] == mine)
            starts: dict[int, list[int]] = {}
            for p in hits.tolist():
                for length in of[at[p]]:
                    starts.setdefault(length, []).append(p)
            for length, places in starts.items():
                if length > len(words):
                    # A document shorter than the item is one window.
                    for _, k in self.candidates(simhashes(mine, len(mine))):
                        if self.size[k] == length:
                            s = overlap(words, self.words[k], size)
                            if s >= SIMILARITY and s > best.get(k, (0.0, 0))[0]:
                                best[k] = s, 0
                    continue
                width = length - size + 1
                for lo, hi in _zones(places, width, len(mine)):
                    fps = simhashes(mine[lo:hi], width)
                    for w, k in self.candidates(fps):
                        if self.size[k] == length:
                            s = overlap(words[lo + w : lo + w + length], self.words[k], size)
                            if s >= SIMILARITY and s > best.get(k, (0.0, 0))[0]:
                                best[k] = s, lo + w
        return best


def _zones(places: list[int], width: int, end: int) -> Iterator[tuple[int, int]]:
    """Shingle ranges that hold every whole window with a hit, merged where they overlap."""
    lo = hi = -1
    for p in places:
        a, b = max(0, p - width + 1), min(end, p + width)
        if a <= hi:
            hi = max(hi, b)
            continue
        if hi - lo >= width:
            yield lo, hi
        lo, hi = a, b
    if hi - lo >= width:
        yield lo, hi


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    small: int | None = None, most_shingles: int | None = None,
) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, first_word): every document and item that match, at their best window."""
    small = SMALL_BENCHMARK if small is None else small
    most_shingles = MOST_SHINGLES if most_shingles is None else most_shingles
    items = benchmark.select("item_id", "text").filter("text is not null").distinct()
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    types = (source.schema["id"].dataType, items.schema["item_id"].dataType)
    kinds = [t.simpleString() for t in types]
    found = f"doc_id {kinds[0]}, text_hash long, item_id {kinds[1]}, similarity double, first_word long"
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size <= small:
        rows = [(r["item_id"], r["text"]) for r in items.collect()]  # up to SMALL_BENCHMARK bytes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Items(rows)
            for batch in batches:
                yield _matched(block, batch.column(0), batch.column(1), batch.column(2).to_pylist(), types)

        return source.mapInArrow(run, found)
    n_blocks = -(-size // BLOCK_BYTES)
    items = cut(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)).cast("int")))
    index = cut(items.select("block", "text").mapInArrow(_item_shingles, "h long, block int, size int").distinct())
    sizes = [r["size"] for r in index.select("size").distinct().collect()]  # at most SHINGLE
    near = cut(_near(source, index, sizes, most_shingles))
    parts = near.groupBy("block").agg(F.ceil(F.count("*") / DOCS).cast("int").alias("of"))
    part = F.pmod(F.xxhash64("th", F.lit("part")), F.col("of")).cast("int")
    asked = near.join(F.broadcast(parts), "block") if n_blocks <= DOCS else near.join(parts, "block")
    asked = asked.select("block", part.alias("part"), F.lit(1).alias("kind"), "id", "th", "text", F.lit(None).cast(kinds[1]).alias("item"))
    copies = items.join(parts, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast(kinds[0]).alias("id"),
        F.lit(0).cast("long").alias("th"), "text", F.col("item_id").alias("item"),
    )
    dealt = asked.union(copies).repartition(shuffle_partitions(docs.sparkSession), "block", "part").sortWithinPartitions("block", "part", "kind")
    return dealt.mapInArrow(lambda batches: _by_block(batches, types), found)


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, text) -> (h, block, size): shingle hashes of items."""
    for batch in batches:
        words = Items([])
        found = [(block, x, shingle_hashes(words.hashed(x), min(SHINGLE, len(x)))) for block, t in zip(batch.column(0).to_pylist(), batch.column(1)) if (x := words_of(t.as_py()))]
        h = np.concatenate([hs for _, _, hs in found] or [np.zeros(0, dtype=np.uint64)]).view(np.int64)
        columns = [np.repeat(np.array(values, dtype=np.int32), [len(hs) for _, _, hs in found]) for values in ([b for b, _, _ in found], [min(SHINGLE, len(x)) for _, x, _ in found])]
        yield pa.RecordBatch.from_arrays([pa.array(h), *map(pa.array, columns)], names=["h", "block", "size"])


def _near(source: DataFrame, index: DataFrame, sizes: list[int], most: int) -> DataFrame:
    """(id, th, text, block) for every block that a document shares a shingle with."""
    kind = source.schema["id"].dataType.simpleString()
    if index.count() <= most:
        rows = index.select("h", "block").toPandas().sort_values("h")  # up to MOST_SHINGLES rows of 12 bytes
        shared = source.sparkSession.sparkContext.broadcast((rows["h"].to_numpy(), rows["block"].to_numpy()))

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, of = shared.value
            words = Items([])
            for batch in batches:
                made = []
                for t in batch.column(2):
                    hs = _all_shingles(words, t.as_py(), sizes)
                    lo, hi = np.searchsorted(keys, hs, "left"), np.searchsorted(keys, hs, "right")
                    made.append(sorted({int(b) for a, z in zip(lo[hi > lo], hi[hi > lo]) for b in of[a:z]}))
                yield _with_list(batch, made, pa.int32(), "blocks")

        found = source.mapInArrow(blocks, f"id {kind}, th long, text string, blocks array<int>")
        return found.select("id", "th", "text", F.explode("blocks").alias("block"))
    spot = F.pmod("h", F.lit(BITMAP))
    bits = index.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number(F.col("spot") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("spot") + 1)).alias("bits"))
    wide = np.zeros((BITMAP >> 15, 4096), dtype=np.uint8)
    for r in bits.collect():  # 2^27 bits at most
        wide[r["bucket"] - 1] = np.frombuffer(r["bits"], dtype=np.uint8)
    filled = source.sparkSession.sparkContext.broadcast(wide.ravel())

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bitmap = Items([]), filled.value
        for batch in batches:
            made = []
            for t in batch.column(2):
                hs = np.unique(_all_shingles(words, t.as_py(), sizes))
                at = hs % BITMAP
                made.append(hs[bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1].tolist())
            yield _with_list(batch, made, pa.int64(), "hs")

    found = cut(source.mapInArrow(hits, f"id {kind}, th long, text string, hs array<long>"))
    met = found.select("id", "th", F.explode("hs").alias("h")).join(index, "h").select(F.col("id").alias("i"), F.col("th").alias("t"), "block").distinct()
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))
    return found.join(met, same).select("id", "th", "text", "block")


def _all_shingles(words: Items, text: str | None, sizes: list[int]) -> np.ndarray:
    hashed = words.hashed(words_of(text))
    return np.concatenate([shingle_hashes(hashed, n) for n in sizes] or [np.zeros(0, dtype=np.uint64)]).view(np.int64)


def _with_list(batch: pa.RecordBatch, made: list[list[int]], kind: pa.DataType, name: str) -> pa.RecordBatch:
    """The rows whose list is not empty, with the list."""
    take = pa.array([k for k, x in enumerate(made) if x], pa.int64())
    lists = pa.array([x for x in made if x], pa.list_(kind))
    return pa.RecordBatch.from_arrays([*(c.take(take) for c in batch.columns), lists], names=["id", "th", "text", name])


def _matched(block: Items, ids: pa.Array, hashes: pa.Array, texts: list[str | None], types: tuple) -> pa.RecordBatch:
    made = [(k, item, s, at) for k, text in enumerate(texts) for item, (s, at) in block.matches(text).items()]
    take = pa.array([m[0] for m in made], pa.int64())
    columns = [
        ids.take(take), hashes.take(take), pa.array([block.ids[m[1]] for m in made], to_arrow_type(types[1])),
        pa.array([m[2] for m in made], pa.float64()), pa.array([m[3] for m in made], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "item_id", "similarity", "first_word"])


def _by_block(batches: Iterator[pa.RecordBatch], types: tuple) -> Iterator[pa.RecordBatch]:
    """Rows (block, part, kind, id, th, text, item) sorted so that a block's items come before its documents."""
    group, rows, block = None, [], None
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
        texts, items = batch.column(5).to_pylist(), batch.column(6).to_pylist()
        at = 0
        while at < len(keys):
            end = next((k for k in range(at, len(keys)) if keys[k] != keys[at]), len(keys))
            if keys[at][2] == 0:
                if keys[at][:2] != group:
                    group, rows = keys[at][:2], []
                rows += zip(items[at:end], texts[at:end])
                block = None
            else:
                block = block or Items(rows)
                part = batch.slice(at, end - at)
                yield _matched(block, part.column(3), part.column(4), texts[at:end], types)
            at = end


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    found = leaks(docs, benchmark, id_col, text_col).select("doc_id", "text_hash").distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")).alias("r")
    same = [F.col("r.row")[id_col].eqNullSafe(F.col("f.doc_id")), F.xxhash64(F.col("r.row")[text_col]) == F.col("f.text_hash")]
    return rows.join(found.alias("f"), same, "left_anti").select("row.*")
