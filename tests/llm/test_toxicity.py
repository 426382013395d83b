import math
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestack.llm import toxicity
from lodestack.session import table

SF = "/root/testdata/sf0.1"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=30))
def test_maximal_segments(scores):
    found = toxicity.maximal_segments([float(s) for s in scores])
    assert all(sum(scores[a:b]) == s > 0 for a, b, s in found)
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
    best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
    assert max((s for _, _, s in found), default=0) == max(best, 0)
    # no positive score outside a segment, and no two segments that would gain by joining
    inside = {k for a, b, _ in found for k in range(a, b)}
    assert all(k in inside for k, s in enumerate(scores) if s > 0)


def test_scale():
    import numpy as np

    s, n = np.array([1.0, -1.0]), np.array([1.0, 2.0])
    x = toxicity.gumbel(s, n)
    assert np.average(np.exp(x * s), weights=n) == pytest.approx(1, abs=1e-6)


def test_long_texts_of_many_segments_take_linear_time():
    falling = [1.0, -2.0] * 300_000
    nested = [100.0] + [-1.0] * 50 + [0.5, -1.0] * 300_000
    began = time.monotonic()
    assert len(toxicity.maximal_segments(falling)) == 300_000
    assert toxicity.maximal_segments(nested)[0] == (0, 1, 100.0)
    assert time.monotonic() - began < 20


def test_whole_words_of_any_length_are_looked_up():
    long = "unverantwortungsvollerweise"
    scorer = toxicity.Scorer(toxicity.Model(scores={long + "$": 3.0, long[:16]: 1.0, "u": -1.0}))
    assert scorer.token(long) == 3.0 - toxicity.COST and scorer.token(long + "r") == 1.0 - toxicity.COST and scorer.token("ux") == -1.0 - toxicity.COST


@pytest.mark.parametrize("one", [0, 1])
def test_calibration_part_of_one_class(spark, one):
    rows = [(k, ("good words here " if k % 3 else "viledung viles here ") * 5, int(k % 3 == 0)) for k in range(60)]
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows] + [(100, ""), (101, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    part = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(5))
    model = toxicity.fit(docs, labels.filter((part != 0) | (F.col("toxic") == one)))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[100] == got[101] < toxicity.THRESHOLD and got[1] < toxicity.THRESHOLD < got[0]


def test_score_by_the_definition():
    """Evidence by all ways to cut a text into maximal segments, against the scan."""
    rng = random.Random(2)
    model = toxicity.Model(scores={"a": 2.0, "b": 0.3, "c": -1.0}, scale=0.7, log_k=-0.5, slope=1.3, shift=-1.0)
    for _ in range(200):
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        s = [model.scores.get(w, 0.0) - toxicity.COST for w in words]
        passages, rest = [], [(0, len(s))]
        while rest:  # the best segment of a stretch is maximal; what is left and right of it is cut again
            lo, hi = rest.pop()
            best = max(((sum(s[a:b]), a - b, -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
            if best[0] > 1e-12:
                a, b = -best[2], -best[2] - best[1]
                passages.append(best[0])
                rest += [(lo, a), (b, hi)]
        evidence = sum(max(0.0, model.scale * x - model.log_k - math.log(max(1, len(s)))) for x in passages)
        want = 1 / (1 + math.exp(-(model.slope * math.log1p(evidence) + model.shift)))
        assert toxicity.Scorer(model).document(" ".join(words))[0] == pytest.approx(want, abs=1e-9)


def test_learns_and_leaves_clean(spark):
    rng = random.Random(0)
    words = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 5 == 0
        text = [rng.choice(words) for _ in range(60)] + ["viledung" + rng.choice(["", "s", "er"])] * (2 if toxic else 0)
        rng.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = toxicity.is_held_out(F.col("doc_id"))
    model = toxicity.fit(docs, known.filter(~held))
    got = toxicity.score(docs, model).join(known, "doc_id").filter(held).collect()
    right = sum((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in got)
    assert right / len(got) > 0.95


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd.select("doc_id", "text"), labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty, model).count() == 0
    one = toxicity.fit(odd.select("doc_id", "text"), labels.filter("toxic = 5"))
    assert one.scores == {}


def test_held_out_accuracy(spark):
    held = toxicity.is_held_out(F.col("doc_id"))
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs.select("doc_id", "text"), labels.filter(~held))
    got = toxicity.score(docs, model).join(labels, "doc_id").filter(held).select("score", "toxic").collect()
    bad = [r.score for r in got if r.toxic]
    good = [r.score for r in got if not r.toxic]
    above = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert above > 0.95


def test_a_tiny_sample_still_tells_classes_apart(spark):
    rows = [(0, "awful nasty swine", 1), (1, "horrid vile rat", 1), (2, "beastly foul toad", 1), (3, "gentle summer rain", 0), (4, "quiet morning light", 0), (5, "green garden path", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(got[k] for k in (0, 1, 2)) > max(got[k] for k in (3, 4, 5))


def test_the_sample_is_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(k, f"{'bad' if k % 2 else 'good'} word{k % 7} " * 20) for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    whole, part, none = (toxicity.fit(docs, labels, most_bytes=n) for n in (1 << 20, 20_000, 10))
    assert part.scores and whole.scores != part.scores and not none.scores
