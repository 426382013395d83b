import re
from collections import Counter

from lodestack.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_counts(odd, odd_rows, empty):
    want = sorted((str(i), *brute(t)) for i, t, _ in odd_rows)
    got = sorted((str(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.quality(odd).collect())
    assert got == want
    assert quality.quality(empty).count() == 0 and quality.keep_good(empty).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


def test_repeat_words_exactly():
    import random

    import numpy as np

    rng = random.Random(0)
    for _ in range(200):
        words = [rng.choice("abc") for _ in range(rng.randrange(12))]
        ids = np.array(["abc".index(w) for w in words], dtype=np.int64)
        assert quality.repeat_words(ids, 3) == brute(" ".join(words))[4]


def test_tokens_are_the_whole_texts(odd_rows):
    tokens = quality.WordTokens(quality.Vocabularies.read())
    for text in ("The quick brown fox, twice: quick!", "漢字 💩 x"):
        got = quality.stats_of(text, tokens)
        assert got[5] == len(tokens.model.encode(text)) and got[8] == len(tokens.many.encode_ordinary(" " + text))


def test_repeated_rows_share_their_verdict(odd):
    twice = [(r.id, r.th, r.kept) for r in quality.quality(odd.union(odd)).collect()]
    assert all(n % 2 == 0 for n in Counter(twice).values())


def test_bands_keep_clean_and_reject_noise(spark):
    import random

    rng = random.Random(3)
    words = "the house of a large family stood near old water and people came there every summer with many small children".split()
    good = [(k, " ".join(rng.choice(words) for _ in range(120)), "en") for k in range(300)]
    bad = [(1000 + k, " ".join("".join(rng.choice("qxzjkvwpy0189") for _ in range(9)) for _ in range(120)), "en") for k in range(5)]
    got = {r.id: r.kept for r in quality.quality(spark.createDataFrame(good + bad, "doc_id long, text string, lang string")).collect()}
    assert not any(got[k] for k, _, _ in bad)
    assert sum(got[k] for k, _, _ in good) > 290
