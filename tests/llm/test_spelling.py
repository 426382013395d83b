import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lodestack.llm import registry, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """One letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_words(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            x = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if x % 31 == 0:
                k = x % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def brute_variants(count):
    out, forms = [], {}
    for w, n in count.items():
        mates = [x for x in count if near(w, x)]
        best = min(mates, key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= 10 * n:
            forms[w] = best
        out.append((w, len(mates)))
    rows = []
    for w, k in out:
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, count[w], k, count.get(forms.get(w))))
    return sorted(rows)


def test_words(spark, odd_rows):
    text = " ".join(f"Straße{'xyz' * (k % 3)} Überfälle×÷ façades Naïveté{k % 4} wordwordword" for k in range(200))
    rows = [r[:2] for r in odd_rows] + [(k, text) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit(2), "run": F.lit("x")})
    got = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert got == brute_words(rows)
    assert any(w not in text.translate(LOWER) for w in got)


def words_of(seed, many, letters, sizes):
    rng = random.Random(seed)
    words = set()
    while len(words) < many:
        w = "".join(rng.choice(letters) for _ in range(rng.choice(sizes)))
        words |= {w, w[: (k := rng.randrange(len(w)))] + rng.choice(letters) + w[k:], w[:k] + w[k + 1 :] or w}
    return {w: rng.choice([2, 3, 5, 20, 50, 500, 5000]) for w in words}


def got(spark, count, crowded):
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    return sorted(map(tuple, spelling.variants(df, crowded=crowded).collect()))


def test_against_brute_force(spark):
    for seed, letters, sizes in ((1, "ab", (7, 8, 9)), (2, "abcdéÿ", (7, 8)), (3, "abc", (1, 2, 3, 4, 5, 30))):
        count = words_of(seed, 400, letters, sizes)
        want = brute_variants(count)
        for crowded in (1, 20, 5000):
            assert got(spark, count, crowded) == want, (seed, crowded)


def test_one_bucket_of_a_third_of_all_words_is_split(spark):
    rng = random.Random(5)
    count = {"prefix" + "".join(rng.choice("abcdefgh") for _ in range(4)): rng.choice([2, 30, 900]) for _ in range(1500)}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    most = spelling.buckets(df, 200).groupBy("key").count().agg(F.max("count")).first()[0]
    assert most <= 200
    assert got(spark, count, 200) == brute_variants(count)


def test_chains_and_ties(spark):
    count = {"abcdefgh": 5000, "abcdefg": 400, "abcdef": 30, "abcde": 2, "zbcdefgh": 5000, "xabcdefgh": 500, "qqqqqqq": 2}
    rows = {r[0]: r[1:] for r in got(spark, count, 100)}
    assert rows["abcde"] == ("abcdef", "abcdefgh", 2, 1, 30)
    assert rows["xabcdefgh"][:2] == ("abcdefgh", "abcdefgh")  # of equally frequent ones the smallest
    assert rows["qqqqqqq"] == (None, "qqqqqqq", 2, 0, None)


def test_query(spark, tmp_path, odd_rows):
    rng = random.Random(9)
    stems = ["".join(rng.choice("aeinrst") for _ in range(rng.choice([7, 8, 9]))) for _ in range(60)]
    rows = [r[:2] for r in odd_rows] + [(k, " ".join(rng.choice(stems).capitalize() for _ in range(300))) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    out = registry.QUERIES["op12_spelling"](spark, str(tmp_path))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(brute_words(rows))
    assert sorted(map(tuple, out.collect())) == want
    assert sum(r[1] is not None for r in want) > 20


def test_empty(empty):
    assert spelling.variants(spelling.vocabulary(empty)).count() == 0
