import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lodestack.llm import merkle, registry

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    told = [None if row[c] is None else str(row[c]) for c in NAMES]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in told))


def climb(digests, fan_out):
    """Root and, for each place, the levels' (before, after)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // fan_out * fan_out
            paths[k].append(("".join(level[run:i]), "".join(level[i + 1 : run + fan_out])))
        level = [h(*level[i : i + fan_out]) for i in range(0, len(level), fan_out)]
        at = [i // fan_out for i in at]
    return level[0], paths


def brute(rows, fan_out=2):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = []
    for lang in langs:
        own = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        made.append((own, *climb([leaf(r) for r in own], fan_out)))
    if not made:
        return []
    root, tops = climb([x[1] for x in made], fan_out)
    out = []
    for (own, subroot, paths), top in zip(made, tops):
        for r, path in zip(own, paths):
            path = path + top
            changed = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                changed["n_chars"] += 1
            folded = leaf(changed)
            for before, after in path:
                folded = h(before, folded, after)
            proof = h(*(a + b for a, b in path))
            out.append((r["doc_id"], leaf(r), subroot, root, proof, folded, folded == root))
    return out


def rows_of(n, langs=("en", "de", None, "fr", "é", "zz")):
    share = lambda k: langs[0] if k % 3 else langs[k // 3 % len(langs)]  # noqa: E731  two thirds and more in one group
    return [dict(zip(NAMES, (k * 7 % n, f"s{k % 3}" if k % 5 else None, share(k), k if k % 11 else None, "té\n" * (k % 4) if k % 13 else None))) for k in range(n)]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def made(df, fan_out, span):
    told = {c: F.col(c) for c in NAMES}
    out = merkle.manifest(df, merkle.leaf(*told.values()), F.col("lang"), F.col("doc_id"), {"doc_id": F.col("doc_id")}, fan_out, span)
    proof = F.sha2(merkle.proof_text(F.col("path")), 256)
    return sorted(map(str, map(tuple, out.select("doc_id", "leaf", "subroot", "root", proof, merkle.fold(F.col("leaf"), F.col("path"))).collect())))


@pytest.mark.parametrize("fan_out,span", [(2, 2), (2, 8), (3, 9), (4, 4), (5, 25), (2, 1024)])
def test_every_fan_out_and_span(spark, fan_out, span):
    rows = rows_of(157)
    df = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], SCHEMA).repartition(5)
    want = sorted(str((*r[:5], r[3])) for r in brute(rows, fan_out))
    assert made(df, fan_out, span) == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9])
def test_small_trees(spark, n):
    rows = rows_of(n, ("en",))
    df = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], SCHEMA)
    assert made(df, 2, 4) == sorted(str((*r[:5], r[3])) for r in brute(rows))


def test_query_over_odd_rows(spark, odd, odd_rows, tmp_path):
    base = [dict(zip(NAMES, (i, None, lang, len(t) if t else None, t))) for i, t, lang in odd_rows]
    base += [dict(zip(NAMES, (k, "s", "en", (1 << 63) - 1 if k == 21 else k, f"text {k}"))) for k in range(20, 60)]
    df = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in base], SCHEMA).withColumns({"leaf": F.lit(1), "path": F.lit("x")})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op11_merkle"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute(base)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert 0 < sum(not r[-1] for r in want) < len(want)


def test_empty(spark, empty):
    assert merkle.manifest(empty, merkle.leaf(F.col("doc_id")), F.col("lang"), F.col("doc_id"), {}).count() == 0


def test_copies_are_dealt_over_ranges(spark):
    rows = [(1, None, "en", 1, "copy")] * 4000 + [(k, None, "de", 1, "x") for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    nodes = df.select(F.col("lang").alias("mk_g"), F.col("doc_id").alias("mk_k"), F.lit("d").alias("mk_d"))
    placed = merkle.positions(nodes)
    assert placed.groupBy("mk_g").agg(F.count_distinct("mk_p"), F.max("mk_p"), F.max("mk_n")).sort("mk_g").collect() == [("de", 200, 199, 200), ("en", 4000, 3999, 4000)]


def test_span_has_to_be_a_power(spark, odd):
    with pytest.raises(ValueError):
        merkle.manifest(odd, merkle.leaf(F.col("doc_id")), F.col("lang"), F.col("doc_id"), {}, 2, 12)
