import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestack.llm import repeats as R


def brute(rows, length=200):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (key, _), b in zip(rows, raw):
        spans = []
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept, at = b"", 0
        for a, z in spans:
            kept, at = kept + b[at:a], z
        kept += b[at:]
        out.append((str(key), len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(df, **kw):
    return sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(df, **kw).collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=6), st.integers(2, 9))
def test_interval_search(parts, length):
    parts = [p.encode() for p in parts]
    count = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
    for p, runs in zip(parts, R.repeated_windows(parts, length)):
        got = [i for a, b in zip(runs[::2], runs[1::2]) for i in range(a, b)]
        assert got == [i for i in range(len(p) - length + 1) if count[p[i : i + length]] > 1]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    plain = [text(150) for _ in range(20)]
    shared = text(90)
    out = [(k, t) for k, t in enumerate(plain)]
    out += [(100 + k, text(rng.randrange(30)) + shared + text(rng.randrange(30))) for k in range(12)]
    out += [(200, plain[0]), (201, plain[1][1:]), (202, plain[2][:300] + "!" + plain[2][300:]), (203, plain[3][:200]), (204, plain[3][:199])]
    out += [(300, "a" * 201), (301, "a" * 200), (302, "ab" * 400), (303, None), (304, ""), (305, "é漢" * 90), (306, "é漢" * 45), (None, plain[4])]
    return out


@pytest.mark.parametrize("hot,most", [(R.HOT_BYTES, R.MOST_HOT), (900, 1), (R.HOT_BYTES, 30)])
def test_against_brute_force(spark, rows, hot, most):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, hot=hot, most=most) == brute(rows)


def test_slices_do_not_lose_windows(spark, rows, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 500)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(odd, odd_rows, empty):
    assert run(odd) == brute([r[:2] for r in odd_rows])
    assert R.remove_repeats(empty).count() == 0
