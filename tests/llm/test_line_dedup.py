import time
from collections import defaultdict

from pyspark.sql import functions as F

from lodestack.llm import line_dedup


def brute(rows, min_chars, min_docs):
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(strip).translate(lower)
            if len(key) >= min_chars:
                holders[key].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(strip).translate(lower)
            have = holders.get(key, ())
            top = max((x for x in have if x is not None), default=None)
            if len(have) < min_docs or i == top:
                kept.append(line)
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_against_brute_force(odd, odd_rows):
    for chars, docs in ((40, 5), (5, 2)):
        got = line_dedup.drop_repeated_lines(odd, min_chars=chars, min_docs=docs)
        assert got.columns == [*odd.columns, "line_dedup"]
        x = got.select("doc_id", "line_dedup.*").collect()
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in x) == brute([r[:2] for r in odd_rows], chars, docs)


def test_empty(empty):
    assert line_dedup.drop_repeated_lines(empty).select(F.col("line_dedup.kept")).count() == 0


def test_hot_and_other_lines_join_alike(odd):
    whole = line_dedup.drop_repeated_lines(odd, min_chars=5, min_docs=2)
    split = line_dedup.drop_repeated_lines(odd, min_chars=5, min_docs=2, most_hot=2)
    rows = lambda df: sorted(map(str, df.select("doc_id", "line_dedup").collect()))
    assert rows(whole) == rows(split)


def test_many_lines_are_put_together_in_linear_time(spark):
    shared = "A license line that several documents share, word for word."
    many = "\n".join([shared, *(f"line {k}" for k in range(300_000)), shared])
    rows = [(k, shared) for k in range(5)] + [(9, shared), (3, many), (4, shared + "\n" + many)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line_dedup", F.lit(1))
    began = time.monotonic()
    got = {(r.doc_id, r.line_dedup.n_lines): r.line_dedup for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert time.monotonic() - began < 30
    x = got[4, 300_003]
    assert x.n_dropped == 3 and x.kept == "\n".join(f"line {k}" for k in range(300_000))
    assert got[9, 1].kept == shared and got[0, 1].kept == ""
