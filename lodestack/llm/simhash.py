"""SimHash near-dedup with deletion-variant signatures.

A document's 64-bit fingerprint takes the majority of its shingle hashes bit by
bit. Two fingerprints within radius 4 agree, up to one bit, on at least one of
three segments (21, 21 and 22 bits), because four differences cannot put two on
each. So every distinct fingerprint is indexed under each of its 64 one-wildcard
segment variants, equal variants meet in a shuffle, and pairs are verified on
all 64 bits. A pair is reported by exactly one of the variants it shares.

Copies collapse first: only distinct fingerprints are indexed. A bucket reports
links along a spanning search, never all of its pairs. Buckets are counted with
map-side sums, and one of more than ``BLOCK`` rows, whatever its share, is split into pairs of blocks that are compared in tasks of
their own, so no task holds an unbounded group. Splitting never changes results.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; rows with a null id take part and can only be named by other rows of
their group; repeated rows are copies of each other; an empty table gives no
rows; extra columns are ignored, and keep_one() passes them through; of rows with
equal ids and texts keep_one() keeps one, and of equal ids the least text hash
comes first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestack.llm.components import connected_components
from lodestack.llm.text import words_of
from lodestack.session import cut, shuffle_partitions

RADIUS = 4
#: First bit and width of each segment. Differences of less than twice their number leave one at most somewhere.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
FOUR_SEGMENTS = ((0, 16), (16, 16), (32, 16), (48, 16))
Segments = tuple[tuple[int, int], ...]
BLOCK = 4096
#: Roots are hot if they have more than this share of the rows; there are fewer of them.
MOST_HOT = 1000
#: Names of large buckets that are broadcast at most, 12 bytes each; more are joined by a shuffle.
MOST_NAMED = 100_000
#: Components of so many fingerprints may be hot.
LARGE_ROOT = 256
SMALL = 48
STEP = 1 << 15
#: Bands of min-hashes: a pair of similarity 0.8 shares none with probability (1 - 0.8 ** 4) ** 32, less than 5 in 10^8.
BANDS, WIDTH = 32, 4
SPREAD = np.array([xxhash.xxh64_intdigest(b"spread %d" % k) | 1 for k in range(BANDS * WIDTH)], dtype=np.uint64)
MIX = np.array([xxhash.xxh64_intdigest(b"mix %d" % k) | 1 for k in range(BANDS * WIDTH)], dtype=np.uint64).reshape(BANDS, WIDTH)
#: Hashes that a task remembers at most of texts it has met.
REMEMBERED = 1 << 22


def _digests(words: list[bytes], size: int, seed: int = 42) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of that size, repeats included, some at a time; of all words where there are fewer."""
    if not words:
        return
    n = max(1, len(words) - size + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[size - 1 :] - 1).tolist() if n > 1 else [len(line)]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, STEP):
        yield np.array([digest(line[a:b], seed) for a, b in zip(starts[at : at + STEP], ends[at : at + STEP])], dtype="<u8")


def _majority(digests: list[np.ndarray]) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for got in digests:
        ones += np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > sum(map(len, digests))).view("<i8")[0])


def fingerprint(words: list[bytes], size: int, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles of that size, repeats included."""
    return _majority(list(_digests(words, size, seed)))


def marks(digests: list[np.ndarray]) -> np.ndarray:
    """One number per band; two sets of Jaccard similarity s agree on a band with probability s ** WIDTH."""
    least = np.full(BANDS * WIDTH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for got in digests:
        for at in range(0, len(got), 256):
            np.minimum(least, (got[at : at + 256, None] * SPREAD).min(axis=0), out=least)
    return (least.reshape(BANDS, WIDTH) * MIX).sum(axis=1, dtype=np.uint64) if digests else np.zeros(0, dtype=np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, marked: bool = False) -> DataFrame:
    """(id, th, fp) of every row; if marked, also the marks of each text where a task meets it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fps, found = [], []
            for th, t in zip(batch.column(1).to_pylist(), batch.column(2)):
                digests = list(_digests(words_of(t.as_py()), size))
                fps.append(_majority(digests))
                if marked:
                    found.append([] if th in seen else marks(digests).view(np.int64))
                    if len(seen) < REMEMBERED:
                        seen.add(th)
            columns = [*batch.columns[:2], pa.array(fps, pa.int64())] + ([pa.array(found, pa.list_(pa.int64()))] if marked else [])
            yield pa.RecordBatch.from_arrays(columns, names=["id", "th", "fp", "marks"][: len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, th long, fp long" + (", marks array<long>" if marked else ""))


def large_buckets(keys: DataFrame, block: int) -> DataFrame:
    """keys(key) -> (key, blocks): the buckets of more than ``block`` rows, counted with map-side sums, and the blocks that they make."""
    found = cut(keys.groupBy("key").count().filter(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    return F.broadcast(found) if found.count() <= MOST_NAMED else found


def marked_links(rows: DataFrame) -> DataFrame:
    """rows(fp, marks) -> links (a, b) from each fingerprint to the least one that shares a mark with it.

    The least one is a map-side minimum, one row per mark; a mark that many share gathers nowhere.
    """
    met = rows.select(F.explode("marks").alias("mark"), "fp")
    least = met.groupBy("mark").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a != z").select("mark", "a")
    return met.join(least, "mark").select("a", F.col("fp").alias("b")).filter("a != b").distinct()


def _first_shared(x: np.ndarray, segments: Segments) -> np.ndarray:
    """For differences x within the radius: the variant that reports the pair."""
    out = np.full(len(x), 99, dtype=np.int64)
    for start, width in reversed(segments):
        part = (x >> np.uint64(start)) & np.uint64((1 << width) - 1)
        one = np.bitwise_count(part) == 1
        bit = np.where(one, np.bitwise_count(part - np.uint64(1)), 0)
        out = np.where(part == 0, start, np.where(one, start + bit, out))
    return out


def _pairs_small(
    fp: np.ndarray, group: np.ndarray, bit: np.ndarray, radius: int, segments: Segments
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs within runs of equal group, by shifts of the sorted rows."""
    at = np.arange(len(fp) - 1)
    shift = 1
    while len(at):
        at = at[at + shift < len(fp)]
        at = at[group[at] == group[at + shift]]
        x = fp[at] ^ fp[at + shift]
        near = (x != 0) & (np.bitwise_count(x) <= radius)
        hit = at[near]
        hit = hit[_first_shared(x[near], segments) == bit[hit]]
        yield fp[hit], fp[hit + shift]
        shift += 1


def _spanning_large(fp: np.ndarray, bit: int, radius: int, segments: Segments) -> tuple[np.ndarray, np.ndarray]:
    """Links of a search forest over one large bucket: at most one per fingerprint."""
    left, a, b = np.unique(fp), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            x = left ^ u
            near = np.bitwise_count(x) <= radius
            near[near] = _first_shared(x[near], segments) == bit
            found = left[near]
            a.append(np.full(len(found), u, dtype=np.uint64))
            b.append(found)
            queue.extend(found)
            left = left[~near]
    empty = np.zeros(0, dtype=np.uint64)
    return np.concatenate(a or [empty]), np.concatenate(b or [empty])


def _compare(batches: Iterator[pa.RecordBatch], radius: int, segments: Segments) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j); a group may run over several batches."""
    rest: list[np.ndarray] = []

    def work(rows: np.ndarray) -> pa.RecordBatch:
        new = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
        group = np.concatenate(([0], np.cumsum(new)))
        fp, bit = np.ascontiguousarray(rows[:, 3]).view(np.uint64), rows[:, 0] >> 22
        sizes = np.bincount(group)
        small = (sizes <= SMALL)[group]
        found = list(_pairs_small(fp[small], group[small], bit[small], radius, segments))
        for g in np.flatnonzero(sizes > SMALL):
            lo, hi = np.searchsorted(group, [g, g + 1])
            found.append(_spanning_large(fp[lo:hi], int(bit[lo]), radius, segments))
        a, b = (np.concatenate([x[k] for x in found] or [fp[:0]]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)
        if not len(rows):
            continue
        if rest and np.array_equal(rows[0, :3], rows[-1, :3]) and np.array_equal(rest[-1][-1, :3], rows[0, :3]):
            rest.append(rows)
            continue
        rows = np.concatenate([*rest, rows])
        last = int(np.flatnonzero(np.any(rows[:, :3] != rows[-1, :3], axis=1)).max(initial=-1)) + 1
        rest = [rows[last:]]
        if last:
            yield work(rows[:last])
    if rest:
        yield work(np.concatenate(rest))


def near_links(fps: DataFrame, radius: int = RADIUS, segments: Segments = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """fps(fp), distinct -> links (a, b) that connect every pair within the radius, through a chain at least."""
    if radius >= 2 * len(segments):
        raise ValueError("more differences than segments can leave one at most on")
    start = F.element_at(F.array(*[F.lit(a) for a, n in segments for _ in range(n)]), F.col("bit") + 1)
    width = F.element_at(F.array(*[F.lit(n) for _, n in segments for _ in range(n)]), F.col("bit") + 1)
    segment = F.expr("shiftrightunsigned(fp, start) & (shiftleft(1L, width) - 1)")
    keys = (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
        .withColumns({"start": start, "width": width})
        .select("fp", "bit", segment.alias("segment"), F.expr("bit - start").alias("wild"))
        .select(
            F.expr("shiftleft(cast(bit AS long), 22) | (segment & ~shiftleft(1L, cast(wild AS int)))").alias("key"), "fp"
        )
    )
    keys = keys.join(large_buckets(keys, block), "key", "left")
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.when(blocks.isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j"))
        )
    )
    spread = keys.select("key", "fp", F.explode(pairs).alias("p")).select("key", "p.i", "p.j", "fp")
    dealt = spread.repartition(shuffle_partitions(fps.sparkSession), "key", "i", "j")
    # Fingerprints alone in their bucket stay in the JVM; the count keeps to the partitions at hand.
    met = dealt.selectExpr("key", "i", "j", "fp", "count(*) OVER (PARTITION BY key, i, j) AS n").filter("n > 1").drop("n")
    return met.sortWithinPartitions("key", "i", "j").mapInArrow(lambda it: _compare(it, radius, segments), "a long, b long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = RADIUS, segments: Segments = SEGMENTS,
    marked: bool = False,
) -> DataFrame:
    """(id, th, fp, component_id) of every row; component_id is the smallest id reachable over links, th hashes the text.

    If marked, texts that share a band of min-hashes are linked too, however far their fingerprints lie apart.
    """
    rows = cut(fingerprints(docs, id_col, text_col, size, marked))
    least = rows.groupBy("fp").agg(F.min("id").alias("id"))
    links = near_links(least.select("fp"), radius, segments)
    roots = connected_components(links.union(marked_links(rows)) if marked else links)
    named = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    component = named.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    large = cut(component.filter(F.col("n") > LARGE_ROOT))
    total = large.agg(F.sum("n")).first()[0]
    if total is None:
        named = named.join(component, "root")
    else:  # at most MOST_HOT roots hold more than that share of the fingerprints in large groups
        hot = F.broadcast(large.filter(F.col("n") * MOST_HOT > total).select("root", F.col("component_id").alias("hot_id"), F.lit(True).alias("hot")))
        told = named.join(hot, "root", "left")
        rest = told.filter("hot IS NULL").join(component, "root").select("fp", "component_id")
        named = told.filter("hot").select("fp", F.col("hot_id").alias("component_id")).union(rest)
    return rows.join(named.select("fp", "component_id"), "fp").select("id", "th", "fp", "component_id")


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's word shingles, sorted."""
    words = words_of(text)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[k : k + size])) for k in range(len(words) and max(1, len(words) - size + 1))], dtype=np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def prefix(shingles: np.ndarray, similarity: float) -> np.ndarray:
    """The least hashes of a set; two sets of that similarity or more share one of them. Empty sets share zero."""
    n = len(shingles)
    return shingles[: n - math.ceil(similarity * n - 1e-9) + 1] if n else np.zeros(1, dtype=np.uint64)


def _resembling(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """(id, th, text, asked, group...) sorted by group and asked -> (id, th) of rows asked about that resemble one not asked about."""
    group, kept, index = None, [], {}
    for batch in batches:
        near = []
        asked = batch.column(3).to_pylist()
        for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4, batch.num_columns)))):
            if key != group:
                group, kept, index = key, [], {}
            mine = shingle_hashes(batch.column(2)[k].as_py(), size)
            first = prefix(mine, similarity).tolist()
            if not asked[k]:
                for h in first:
                    index.setdefault(h, []).append(len(kept))
                kept.append(mine)
            elif any(jaccard(mine, kept[x]) >= similarity for x in {x for h in first for x in index.get(h, ())}):
                near.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(near, pa.int64())) for c in (0, 1)], names=["id", "th"])


def _greedy(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """(id, th, text, group...) sorted by group and rank -> (id, th) of rows unlike every row kept before in their group."""
    group, kept, index = None, [], {}
    for batch in batches:
        stay = []
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(3, batch.num_columns))))
        for k, key in enumerate(keys):
            if key != group:
                group, kept, index = key, [], {}
            mine = shingle_hashes(batch.column(2)[k].as_py(), size)
            first = prefix(mine, similarity).tolist()
            if all(jaccard(mine, kept[x]) < similarity for x in {x for h in first for x in index.get(h, ())}):
                for h in first:
                    index.setdefault(h, []).append(len(kept))
                kept.append(mine)
                stay.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(stay, pa.int64())) for c in (0, 1)], names=["id", "th"])


#: Groups of at most so many texts are settled by one task each, and the largest head of a larger group.
SMALL_GROUP = 512
LARGEST_HEAD = 16_384


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8,
    radius: int = 7, segments: Segments = FOUR_SEGMENTS, small_group: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near duplicates keeps its row of the smallest id.

    Groups are components of links within the radius and of links between texts
    that share a band of min-hashes; the latter miss a pair of that similarity
    with a probability below 5 in 10^8 at 0.8 and less above, so settling groups
    is settling all rows. In the order of ids, a row
    stays if its shingles' Jaccard similarity to every row that stays before it
    in its group is below ``similarity``; equal texts are similar. Groups of up
    to ``small_group`` texts are settled in one pass over sorted rows. Of larger
    ones the first ``small_group`` rows are settled so; the others are dealt into
    parts that each meet a copy of the rows that stay, go if one is similar, and
    the next round has what is left, until groups are small. A head is twice as
    large each round, up to ``LARGEST_HEAD``, so a group of N texts that are all
    unlike takes about N / LARGEST_HEAD rounds.
    Null ids come last.
    """
    small_group = small_group or SMALL_GROUP
    groups = cut(near_groups(docs, id_col, text_col, size, radius, segments, marked=True))
    # One row per group and text; null ids (kept apart by a flag) sort last.
    rank = F.struct(F.col("id").isNull().alias("none"), "id")
    texts = groups.groupBy(F.col("fp").alias("any_fp"), "th").agg(F.min(rank).alias("rank"), F.first("component_id").alias("c"))
    texts = cut(texts.select(F.coalesce("c", "any_fp").alias("c"), F.col("c").isNull().alias("loose"), "th", "rank"))
    group = ["c", "loose"]
    several = texts.groupBy(*group).count().filter("count > 1").select(*group)
    alone = texts.join(several, group, "left_anti").select("rank.id", "th")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    unsure = texts.join(several, group).select(*group, "th", "rank", "rank.id")
    own = own.alias("d").join(unsure.alias("u"), [F.col("d.id").eqNullSafe(F.col("u.id")), F.col("d.th") == F.col("u.th")])
    one = own.select("u.*", "d.text").withColumn("k", F.expr("row_number() OVER (PARTITION BY id, th ORDER BY rank)")).filter("k = 1")
    pending = cut(one.select(*group, "id", "th", F.struct("rank", "th").alias("rank"), "text"))
    chosen, parts = alone, shuffle_partitions(docs.sparkSession)
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("id", "th")]

    def settled(rows: DataFrame) -> DataFrame:
        order = rows.repartition(parts, *group).sortWithinPartitions(*group, "rank")
        return cut(order.select("id", "th", "text", *group).mapInArrow(lambda it: _greedy(it, size, similarity), "id long, th long"))

    head_size = small_group
    while True:
        sizes = pending.groupBy(*group).count()
        small = pending.join(sizes.filter(F.col("count") <= small_group).select(*group), group, "left_semi")
        chosen = chosen.union(settled(small))
        large = cut(pending.join(sizes.filter(F.col("count") > small_group).select(*group), group, "left_semi"))
        if large.isEmpty():
            break
        # The first rows of each part of a group hold the first of the group; texts are not sorted.
        parts_of = sizes.select(*group, F.ceil(F.col("count") / (16 * head_size)).cast("int").alias("of"))
        order = large.select(*group, "rank", "id", "th").join(parts_of, group)
        order = order.withColumn("part", F.pmod(F.xxhash64("id", "th"), F.col("of")).cast("int"))
        for keys in ([*group, "part"], group):
            order = order.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))).filter(F.col("place") <= head_size)
        last = cut(order.groupBy(*group).agg(F.max("rank").alias("last")))
        head = cut(large.join(F.broadcast(last) if last.count() <= MOST_HOT else last, group).filter(F.col("rank") <= F.col("last")).drop("last"))
        head_size = min(2 * head_size, LARGEST_HEAD)
        stay = settled(head)
        chosen = chosen.union(stay)
        kept = head.alias("a").join(stay.alias("b"), same("a", "b"), "left_semi").select("a.*")
        tail = large.join(last, group).filter(F.col("rank") > F.col("last")).drop("last")
        # The rest of a group is dealt into parts of about small_group rows, each with a copy of the rows that stay.
        parts_of = sizes.select(*group, F.ceil(F.col("count") / small_group).cast("int").alias("of"))
        part = F.pmod(F.xxhash64("id", "th"), F.col("of")).cast("int")
        asked = tail.join(parts_of, group).select("id", "th", "text", F.lit(True).alias("asked"), *group, part.alias("part"))
        copies = F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("part")
        known = kept.join(parts_of, group).select("id", "th", "text", F.lit(False).alias("asked"), *group, copies)
        dealt = asked.union(known).repartition(parts, *group, "part").sortWithinPartitions(*group, "part", "asked")
        gone = cut(dealt.mapInArrow(lambda it: _resembling(it, size, similarity), "id long, th long"))
        pending = cut(tail.alias("t").join(gone.alias("g"), same("t", "g"), "left_anti").select("t.*"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row")[id_col].cast("long").alias("id"), F.xxhash64(F.col("row")[text_col]).alias("th"))
    kept = rows.alias("r").join(chosen.alias("c"), [F.col("r.id").eqNullSafe(F.col("c.id")), F.col("r.th") == F.col("c.th")], "left_semi")
    first = kept.selectExpr("r.*", "row_number() OVER (PARTITION BY r.id, r.th ORDER BY r.th) AS k").filter("k = 1")
    return first.select("row.*")
