"""Toxicity by maximum-scoring segments over token log-odds.

Tokens are lower-cased words. A token's score is the log-odds of its occurring
in toxic rather than in other labelled documents, under Dirichlet priors that
are informed step by step: the prior of a word prefix is the estimate of the
prefix one letter shorter, up to the whole word, so rare and unseen inflections
are judged by their stem. A linear scan (all maximal scoring subsequences) finds
every passage whose scores outweigh a cost per token. Scores of passages are
calibrated by extreme-value statistics: for clean text the best passage of n
tokens follows a Gumbel law whose scale solves sum p(s) exp(lambda s) = 1, which
turns a passage into -log of its expected count by chance. A document's evidence
is the sum over its significant passages; a logistic fit maps it to 0..1.

Fitting uses at most ``SAMPLE`` labelled documents, those with the smallest hash
of their id, and of these the first ones that have at most ``SAMPLE_BYTES``
together (documented bounds), whole texts; the model has the prefixes that
``LEAST`` of them hold, so its size follows the sample, not the corpus. Four in
five of them give the token counts, the others the calibration: the Gumbel scale
from all their clean tokens, its location from the best passage of every clean
one, the logistic fit from the same evidence that scoring sums up. If one class is
missing there, all of the sample calibrates. Scoring is one map over all whole
texts with the model as a broadcast.

Defined cases: null and empty texts have no passage and get the score of no
evidence; an empty table gives no rows; unlabelled rows and rows whose label is
null are scored but not learned from; of several labels of one id the greatest
counts; with no positive or no negative training label, or without any word in
the texts of one of the two, every score is the share of positive labels. If the
sample is so small that no word is in ``LEAST`` texts of a class, every word of all
its texts counts. Repeated rows get equal scores. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestack.session import cut

SAMPLE = 20_000
SAMPLE_BYTES = 256 << 20
#: Below so many texts, every word may count.
SMALL_SAMPLE = 200
#: Texts that a prefix's parent counts for, and the least texts of a prefix that is kept.
PRIOR = 4.0
LEAST = 4
#: What a token must bring to lengthen a passage, and the cap on one token's score.
COST = 0.7
CAP = 6.0
LONGEST_PREFIX = 16
#: Width of a cell of token scores in the calibration.
CELL = 0.01
KNOWN_WORDS = 400_000
WORDS = re.compile(r"[^\W_]+")
THRESHOLD = 0.3


def tokens_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


@dataclass
class Model:
    base: float = 0.0
    scores: dict[str, float] = field(default_factory=dict)
    scale: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def token(self, word: str) -> float:
        scores = self.model.scores
        if (s := scores.get(word + "$")) is not None:
            return s - COST
        for k in range(min(len(word), LONGEST_PREFIX), 0, -1):
            if (s := scores.get(word[:k])) is not None:
                return s - COST
        return -COST

    def scores(self, words: list[str]) -> list[float]:
        known = self.known
        try:
            return [known[w] for w in words]
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self.token(w)
            return [known[w] for w in words]

    def passages(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Every maximal scoring passage as (first word, end, evidence), significant ones only."""
        scores = self.scores(words)
        log_n = math.log(max(1, len(words)))
        out = []
        for a, b, s in maximal_segments(scores):
            evidence = self.model.scale * s - self.model.log_k - log_n
            if evidence > 0:
                out.append((a, b, evidence))
        return out

    def document(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        found = self.passages(tokens_of(text))
        x = self.model.slope * evidence_of(found) + self.model.shift
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x)))), found


def evidence_of(passages: list[tuple[int, int, float]]) -> float:
    return math.log1p(sum(e for _, _, e in passages))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences in linear time: (start, end, score)."""
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum through, nearest earlier one that starts lower
    total = 0.0
    for k, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, left, at = k, before, len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= left:
                at = found[at][4]
            if at < 0 or found[at][3] >= total:
                break
            start, _, left, _, lower = found[at]
            del found[at:]
            at = lower
        found.append((start, k + 1, left, total, at))
    return [(a, b, r - l) for a, b, l, r, _ in found]


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts that hold each word prefix; a whole word ends with $."""
    for batch in batches:
        parts: list[Counter] = [Counter(), Counter()]
        for text, toxic in zip(batch.column(0), batch.column(1)):
            words = set(tokens_of(text.as_py()))
            found = {w[:k] for w in words for k in range(1, min(len(w), LONGEST_PREFIX) + 1)}
            found.update([w + "$" for w in words])
            parts[toxic.as_py()].update(found)
        keys = list(parts[0].keys() | parts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *(pa.array([parts[s][k] for k in keys], pa.int64()) for s in (0, 1))],
            names=["feature", "other", "toxic"],
        )


def log_odds(counts: list[tuple[str, int, int]], other: int, toxic: int) -> dict[str, float]:
    """Scores of prefixes whose estimate moves away from their parent's."""
    base = toxic / (toxic + other)
    logit = lambda r: math.log(r / (1 - r))
    rate: dict[str, float] = {}
    out: dict[str, float] = {}
    for key, n0, n1 in sorted(counts, key=lambda x: (len(x[0].rstrip("$")), x[0].endswith("$"))):
        stem = key[:-1] if key.endswith("$") else key
        up = stem if key.endswith("$") else stem[:-1]
        while up and up not in rate:
            up = up[:-1]
        prior = rate.get(up, base)
        rate[key] = min(1 - 1e-6, max(1e-6, (n1 + PRIOR * prior) / (n0 + n1 + PRIOR)))
        score = max(-CAP, min(CAP, logit(rate[key]) - logit(base)))
        if not up or abs(score - max(-CAP, min(CAP, logit(prior) - logit(base)))) > 0.05:
            out[key] = score
    return out


def gumbel(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive scale that solves mean(exp(scale * s)) = 1, for scores whose mean is negative."""
    if not counts.sum() or (values * counts).sum() >= 0 or values[counts > 0].max() <= 0:
        return 1.0
    mean = lambda scale: float(np.average(np.exp(np.minimum(scale * values, 50)), weights=counts))
    lo, hi = 1e-3, 1.0
    while mean(hi) < 1 and hi < 50:
        hi *= 2
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    return hi


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit with a light ridge, by Newton steps."""
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(h, a.T @ (y - p) - np.array([1e-2, 1e-6]) * w)
        w += np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Model:
    """docs(doc_id, text), labels(doc_id, toxic); labels that are held out must have been removed."""
    chosen = (
        labels.filter("toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # The sample's texts are read by five passes, so they are written once.
    part = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(5))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").filter("text is not null")
    rows = cut(rows.select("text", "toxic", part.alias("part"), F.xxhash64("doc_id").alias("turn"), F.octet_length("text").alias("bytes")))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    if total > most_bytes:  # at most SAMPLE rows of sizes
        sizes = rows.groupBy("turn").agg(F.sum("bytes").alias("bytes"))
        running = sizes.withColumn("so_far", F.sum("bytes").over(Window.orderBy("turn")))
        last = running.filter(F.col("so_far") <= most_bytes).agg(F.max("turn")).first()[0]
        rows = rows.filter(F.col("turn") <= last) if last is not None else rows.filter("false")
    model = Model()

    def counted(of: DataFrame, least: int) -> tuple[list[tuple], int, int]:
        features = (
            of.select("text", "toxic").mapInArrow(_counts, "feature string, other long, toxic long")
            .groupBy("feature")
            .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        )
        # What so many of the sampled documents hold: bounded by the sample.
        counts = [tuple(r) for r in features.filter(F.col("other") + F.col("toxic") >= least).collect()]
        return counts, *(sum(c[k] for c in counts if c[0].endswith("$")) for k in (1, 2))

    counts, other, toxic = counted(rows.filter("part != 0"), LEAST)
    if (not other or not toxic) and rows.count() < SMALL_SAMPLE:
        counts, other, toxic = counted(rows, 1)
    if not other or not toxic:
        share = chosen.agg(F.avg("toxic")).first()[0] or 0.0
        model.shift = math.log((share + 1e-6) / (1 - share + 1e-6))
        return model
    model.base = toxic / (toxic + other)
    model.scores = log_odds(counts, other, toxic)
    check = rows.filter("part = 0").select("text", "toxic")
    if check.agg(F.count_distinct("toxic")).first()[0] < 2:
        check = rows.select("text", "toxic")
    tokens, best, evidence = _calibrators(model)
    clean = check.filter("toxic = 0").select("text")
    cells = clean.mapInArrow(tokens, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most one per cell
    model.scale = gumbel(np.array([r["cell"] * CELL for r in cells]), np.array([r["n"] for r in cells], dtype=float))
    # Mean of a Gumbel law: log K plus Euler's constant.
    mean = clean.mapInArrow(best, "best double, log_n double").agg(F.avg(F.lit(model.scale) * F.col("best") - F.col("log_n"))).first()[0]
    model.log_k = (mean or 0.0) - 0.5772156649
    seen = check.mapInArrow(evidence, "x double, y double").collect()  # two numbers a calibrating document
    model.slope, model.shift = logistic(np.array([r["x"] for r in seen]), np.array([r["y"] for r in seen]))
    return model


def _calibrators(model: Model) -> tuple:
    """Maps over calibrating texts: token scores in cells, the best passage of each text, and its evidence."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0):
                found.update([round(s / CELL) for s in scorer.scores(tokens_of(text.as_py()))])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["cell", "n"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = [scorer.scores(w) for t in batch.column(0) if (w := tokens_of(t.as_py()))]
            top = [max((s for _, _, s in maximal_segments(x)), default=0.0) for x in texts]
            sizes = [math.log(len(x)) for x in texts]
            yield pa.RecordBatch.from_arrays([pa.array(top, pa.float64()), pa.array(sizes, pa.float64())], names=["best", "log_n"])

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            x = [evidence_of(scorer.passages(tokens_of(t.as_py()))) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1).cast(pa.float64())], names=["x", "y"])

    return tokens, best, evidence


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, passages): passages are array<struct<first_word, end_word, evidence>>."""
    shared = docs.sparkSession.sparkContext.broadcast(asdict(model))  # as large as the sample makes it
    passage = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("evidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(**shared.value))
        for batch in batches:
            made = [scorer.document(t.as_py()) for t in batch.column(1)]
            found = [[{"first_word": a, "end_word": b, "evidence": e} for a, b, e in p] for _, p in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in made], pa.float64()), pa.array(found, passage)],
                names=["doc_id", "score", "passages"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, passages array<struct<first_word:int,end_word:int,evidence:double>>"
    )
