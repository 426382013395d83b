"""Quality rules with tokeniser fertility.

Base counts (words, symbols, repeated lines, repeated three-word windows) and
figures of two public vocabularies are taken from every whole text in one pass.
One, a merge vocabulary with byte fallback, measures characters per token, the
share of byte-fallback tokens and token entropy in bits, the last as a share of
what that many tokens could have at most; the other, a byte-level vocabulary for
many languages, measures characters per token again. A language's band around its own median follows from the spread of all
its documents that pass the base rules: the deviation a document may have is
``BAND`` robust standard deviations of a text with that many tokens (short texts
vary more), and never less than the least half-width of the figure. A document
outside any band is rejected. Languages with fewer than ``MIN_BAND_DOCS``
documents share one band.

The vocabulary's pieces never cross white space, so a text's tokens are its
words' tokens; words are encoded once per task and remembered in a bounded table.
The driver reads the vocabularies; tasks get them with the job. Bands are one row
per language: up to ``MOST_BROADCAST`` of them (counted) are broadcast, so no task
receives a language. Defined cases: a null or empty text has no words, fails the
base rules and is not kept; null languages form a language of their own; rows
that repeat each other get equal verdicts, each of its own; a figure on the edge
of its band is inside; an empty table gives no rows; extra columns are ignored,
and keep_good() passes them through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.session import cut

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MANY_LANGUAGES = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the byte-level vocabulary cuts a word before it merges bytes.
WORD_PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Half-width of a band in scaled deviations, and the least half-width of each figure.
BAND = 5.0
LEAST = {"chars_per_token": 0.06, "chars_per_token_multi": 0.06, "byte_share": 0.05, "entropy_share": 0.25}
MIN_BAND_DOCS = 100
MOST_BROADCAST = 10_000
KNOWN_WORDS = 250_000
LONGEST_KNOWN = 64

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, n_byte_tokens long, entropy double, n_tokens_multi long"
)


def repeat_words(ids: np.ndarray, kinds: int) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(ids) - 2
    if n < 2:
        return 0
    pair = ids[:-2] * kinds + ids[1:-1]
    if kinds >= 1 << 20:  # keep the third product within 64 bits, exactly
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair * kinds + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        cover[k : k + n] |= twice
    return int(cover.sum())


@dataclass
class Vocabularies:
    """What the driver reads and tasks get: a model's bytes, and ranks of byte strings."""

    pieces: bytes
    ranks: dict[bytes, int]

    @classmethod
    def read(cls, pieces: str = VOCABULARY, many: str = MANY_LANGUAGES) -> Vocabularies:
        with open(pieces, "rb") as f:
            model = f.read()
        with open(many, "rb") as f:
            return cls(model, {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class WordTokens:
    """Token ids of words, as bytes of 16-bit numbers, and their number in the second vocabulary; remembered up to a bound."""

    def __init__(self, vocabularies: Vocabularies):
        import sentencepiece
        import tiktoken

        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.pieces)
        self.many = tiktoken.Encoding("many languages", pat_str=WORD_PARTS, mergeable_ranks=vocabularies.ranks, special_tokens={})
        first = self.model.piece_to_id("<0x00>")
        self.bytes = (first, first + 255) if self.model.is_byte(first) else (1, 0)
        self.known: dict[bytes, tuple[bytes, int]] = {}

    def of(self, words: list[bytes]) -> list[tuple[bytes, int]]:
        """Both of each of these distinct words."""
        known = self.known
        new = [w for w in words if w not in known]
        if not new:
            return [known[w] for w in words]
        texts = [w.decode("utf-8", "replace") for w in new]
        found, many = self.model.encode(texts, num_threads=1), self.many.encode_ordinary
        made = {w: (np.array(x, dtype="<u2").tobytes(), len(many(" " + t))) for w, x, t in zip(new, found, texts)}
        out = [made[w] if w in made else known[w] for w in words]
        if len(known) + len(made) > KNOWN_WORDS:
            known.clear()
        known.update((w, x) for w, x in made.items() if len(w) <= LONGEST_KNOWN)
        return out


def stats_of(text: str | None, tokens: WordTokens) -> tuple:
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    seen: set[bytes] = set()
    repeated = 0
    for line in raw.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line and not line.isspace():
            seen.add(line)
    both = tokens.of(list(index))
    each = [x for x, _ in both]
    often = np.bincount(ids, minlength=len(index))
    got = np.frombuffer(b"".join(each), dtype="<u2")
    times = np.repeat(often, [len(x) // 2 for x in each]) if words else ids
    n_tokens, entropy = int(times.sum()), 0.0
    if n_tokens:
        share = np.bincount(got, weights=times)
        share = share[share > 0] / n_tokens
        entropy = float(-(share * np.log2(share)).sum())
    lo, hi = tokens.bytes
    return (
        len(words),
        len(b"".join(words).decode("utf-8")),
        sum(raw.count(s) for s in [SYMBOLS[k : k + 1] for k in range(len(SYMBOLS))]),
        repeated,
        repeat_words(ids, max(1, len(index))),
        n_tokens,
        int(times[(got >= lo) & (got <= hi)].sum()),
        entropy,
        int((often * np.array([n for _, n in both], dtype=np.int64)).sum()),
    )


def text_stats(rows: DataFrame, text_col: str = "text", vocabularies: Vocabularies | None = None) -> DataFrame:
    """All columns of ``rows`` but the text, plus the columns of ``STATS``."""
    vocabularies = vocabularies or Vocabularies.read()
    keep = [c for c in rows.columns if c != text_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep] + [STATS])
    names = [x.split()[0] for x in STATS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(vocabularies)
        for batch in batches:
            rows = [stats_of(t.as_py(), tokens) for t in batch.column(len(keep))]
            made = [
                pa.array([r[k] for r in rows], pa.float64() if name == "entropy" else pa.int64())
                for k, name in enumerate(names)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[*keep, *names])

    return rows.select(*keep, text_col).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: The figures, as SQL over the counts.
FIGURES = {
    "chars_per_token": "word_chars / n_tokens",
    "chars_per_token_multi": "word_chars / n_tokens_multi",
    "byte_share": "n_byte_tokens / n_tokens",
    "entropy_share": "entropy / log2(n_tokens)",
}


def verdicts(stats: DataFrame) -> DataFrame:
    """stats(lang, ...) plus base_failed, kept and the figures. ``stats`` is read four times: pass a checkpointed table."""
    stats = stats.withColumns(
        {name: F.when(F.col("n_tokens") > 1, F.expr(rule)) for name, rule in FIGURES.items()}
        | {"base_failed": base_failed()}
    )
    good = stats.filter(~F.col("base_failed"))
    size = good.groupBy("lang").agg(F.count("*").alias("n"))
    # Languages with few documents share one band, here called the rest.
    size = size.select(F.col("lang").alias("of_lang"), (F.col("n") >= MIN_BAND_DOCS).alias("own"))

    def named(rows: DataFrame) -> DataFrame:
        rows = rows.join(size, rows["lang"].eqNullSafe(size["of_lang"]), "left")
        own = F.coalesce("own", F.lit(False))
        return rows.withColumn("band", F.when(own, F.concat(F.lit("lang:"), F.coalesce("lang", F.lit("")))).otherwise("rest"))

    def small(bands: DataFrame) -> DataFrame:
        """One row per language; a corpus with more languages than fit a broadcast joins by shuffle."""
        bands = cut(bands)
        return F.broadcast(bands) if bands.count() <= MOST_BROADCAST else bands

    middle = small(named(good).groupBy("band").agg(*[F.percentile_approx(n, 0.5, 10_000).alias(f"mid_{n}") for n in FIGURES]))
    off = {n: F.abs(F.col(n) - F.col(f"mid_{n}")) for n in FIGURES}
    spread = (
        named(good)
        .join(middle, "band")
        .groupBy("band")
        .agg(*[F.percentile_approx(off[n] * F.sqrt("n_tokens"), 0.5, 10_000).alias(f"mad_{n}") for n in FIGURES])
    )
    bands = small(middle.join(spread, "band"))
    rows = named(stats).join(bands, "band", "left")
    inside = F.lit(True)
    for n in FIGURES:
        wide = BAND * F.col(f"mad_{n}") / 0.6745 / F.sqrt("n_tokens")
        inside &= F.coalesce(off[n] <= F.greatest(F.lit(LEAST[n]), wide), F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & inside).select(*stats.columns, "kept")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, with all their columns."""
    bad = quality(docs, id_col, text_col, lang_col).filter(~F.col("kept")).select("id", "th").distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")).alias("r")
    same = [F.col("r.row")[id_col].eqNullSafe(F.col("b.id")), F.xxhash64(F.col("r.row")[text_col]) == F.col("b.th")]
    return rows.join(bad.alias("b"), same, "left_anti").select("row.*")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, a text hash that tells repeated ids apart, figures and verdict."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    return verdicts(cut(text_stats(rows)))
