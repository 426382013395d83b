"""SentencePiece encoding and decoding of a public merge vocabulary, as a max-plus scan.

Encoding gives the ids that the vocabulary's own merges give: spaces become
U+2581, one is put in front, and of all neighbours the pair whose union has the
best score is merged, leftmost first, until none is left; what no piece covers
becomes its UTF-8 bytes.

Merges are local, so a sequence of pieces is the encoding exactly if every two
neighbours are the encoding of the two together. This makes encoding a best-path
problem: a piece followed by a neighbour that it stands with scores 0, any other
pair minus infinity, and the only path with a finite sum is the encoding. No
piece has a word mark after another character, so words are independent; they
are merged once and remembered in a bounded table. Texts of at most ``GIANT``
characters are one map over their words.

Longer texts are scanned in parallel. They are split into chunks; at a chunk's
border the state is the piece that begins before it and ends at or behind it, and
both sides list the same states, because they see the same few characters. A
chunk yields its transfer matrix between states (best sum from state to state).
Matrices are multiplied in max-plus algebra, which is associative: first within
blocks of ``BLOCK`` chunks, then over the blocks of a text, then from the known
vector at a block's start to the start of each of its chunks. With that vector a
chunk is backtraced on its own, once for every state it may end in; these paths
soon merge, so a chunk returns one shared path, short ends and the state each end
comes from. Chaining the states from the end picks the ends.

Defined cases: a null or empty text has no tokens; an empty table gives no rows;
repeated rows are solved once if giant and come back as often as they were;
equal scores merge leftmost first; extra columns are ignored, whatever their
names; U+2581 in a text is a space to the vocabulary, so such a text decodes with
spaces (SentencePiece cannot tell them apart), every other text decodes to
itself. The vocabulary must be read by the driver; tasks get its pieces with the
job.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.session import cut

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 32_768
CHUNK = 16_384
BLOCK = 256
MARK = "▁"
#: Minus infinity of the max-plus algebra; sums of two stay within 64 bits.
DEAD = -(1 << 61)
NO_MERGE = 1 << 30
KNOWN_WORDS = 120_000
KNOWN_PAIRS = 50_000
#: Rows of an Arrow batch; a row of tokens is longer than the row counts that Spark's default is made for.
BATCH_ROWS = 1000
LONGEST_KNOWN = 64

Span = tuple[int, int]


class Vocabulary:
    """Pieces with the order of their merges, ids and byte pieces of a model file."""

    def __init__(self, path: str = VOCABULARY):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.out: list[bytes] = []
        self.bytes = [0] * 256
        scores: dict[str, float] = {}
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            text = piece.replace(MARK, " ").encode()
            if model.is_byte(k):
                self.bytes[int(piece[3:5], 16)] = k
                text = bytes([int(piece[3:5], 16)])
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                text = b""
            else:
                self.ids[piece], scores[piece] = k, model.get_score(k)
            self.out.append(text)
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Pieces by the order in which they are merged; equal scores have equal places.
        self.order = {p: order[s] for p, s in scores.items()}
        self.longest = max(map(len, self.ids))
        self._tables()
        if len(self.out) > 1 << 16:
            raise ValueError("ids are kept as 16-bit numbers")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses words; words cannot be solved apart")


    def _tables(self) -> None:
        """The same as arrays: ids of characters, and of pairs of pieces the piece they merge to."""
        self.char = np.zeros(0x10000, dtype=np.int32)  # 0: no piece
        for p, k in self.ids.items():
            if len(p) == 1 and ord(p) < len(self.char):
                self.char[ord(p)] = k
        of, pairs = self.ids, {}
        for p, k in of.items():
            for i in range(1, len(p)):
                if (a := of.get(p[:i])) is not None and (b := of.get(p[i:])) is not None:
                    pairs[a << 16 | b] = k
        self.pair = np.array(sorted(pairs), dtype=np.uint32)
        self.pair_to = np.array([pairs[x] for x in self.pair.tolist()], dtype=np.int32)
        self.rank = np.full(len(self.out) + 1, NO_MERGE, dtype=np.int32)  # the last one for no piece
        for p, k in of.items():
            self.rank[k] = self.order[p]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}
        self.stands: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        # A line break that no piece holds stands alone, so words at line ends are known words.
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in vocabulary.ids))
        self.word = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|[{alone}]" if alone else ""))
        self.reach: dict[str, int] = {}
        for p in vocabulary.ids:
            self.reach[p[:2]] = max(self.reach.get(p[:2], 0), len(p))

    def merged(self, s: str) -> list[str]:
        """Pieces and single characters that are left when nothing can be merged."""
        if len(s) > LONGEST_KNOWN:
            return self._merged_long(s)
        get = self.v.order.get
        parts = list(s)
        ranks = [get(a + b, NO_MERGE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_MERGE:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = get(parts[k] + parts[k + 1], NO_MERGE)
            if k:
                ranks[k - 1] = get(parts[k - 1] + parts[k], NO_MERGE)
        return parts

    def _merged_long(self, s: str) -> list[str]:
        """The same with a heap of pairs and linked neighbours."""
        get, n = self.v.order.get, len(s)
        parts: list[str | None] = list(s)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, s[k : k + 2]) for k in range(n - 1) if (r := get(s[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, text = heapq.heappop(heap)
            j = right[k]
            if parts[k] is None or j >= n or len(parts[k]) + len(parts[j]) != len(text):
                continue  # one of the two has been merged meanwhile
            parts[k], parts[j] = text, None
            right[k] = j = right[j]
            if j < n:
                left[j] = k
                if (r := get(text + parts[j])) is not None:
                    heapq.heappush(heap, (r, k, text + parts[j]))
            if (i := left[k]) >= 0 and (r := get(parts[i] + text)) is not None:
                heapq.heappush(heap, (r, i, parts[i] + text))
        return [p for p in parts if p is not None]

    def merged_together(self, words: list[str]) -> list[bytes]:
        """Ids of many words whose characters are all pieces: in each round every word merges its best pair."""
        v, none = self.v, len(self.v.out)
        raw = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        s, of = v.char[raw], np.repeat(np.arange(len(words)), [len(w) for w in words])

        def union(at: np.ndarray) -> np.ndarray:
            """What the symbols at these places merge to with the next one of their word."""
            key = (s[at].astype(np.uint32) << np.uint32(16)) | s[at + 1].astype(np.uint32)
            k = np.searchsorted(v.pair, key)
            k[k == len(v.pair)] = 0
            return np.where((v.pair[k] == key) & (of[at] == of[at + 1]), v.pair_to[k], none)

        to = np.full(len(s), none)
        to[:-1] = union(np.arange(len(s) - 1))
        rank = v.rank[to]
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(s):
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            sizes = np.diff(np.append(starts, len(s)))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            live = best < NO_MERGE
            if not live.all():
                ended.append((of[~live], s[~live]))
                s, of, to, rank, best = s[live], of[live], to[live], rank[live], best[live]
                if not len(s):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.concatenate(([True], of[at[1:]] != of[at[:-1]]))]
            s[at] = to[at]
            stay = np.ones(len(s), dtype=bool)
            stay[at + 1] = False
            s, of, to, rank = s[stay], of[stay], to[stay], rank[stay]
            at -= np.arange(len(at))
            near = np.concatenate((at, at[at > 0] - 1))
            last = near == len(s) - 1
            to[near[last]] = none
            to[near[~last]] = union(near[~last])
            rank[near] = v.rank[to[near]]
        word, ids = (np.concatenate([x[k] for x in ended]) for k in (0, 1))
        data = ids[np.argsort(word, kind="stable")].astype("<u2").tobytes()
        ends = (2 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, those of short ones remembered."""
        known, char = self.known, self.v.char
        if len(known) + len(words) > KNOWN_WORDS:
            known.clear()
        made: dict[str, bytes] = {}
        short = [w for w in words if len(w) <= LONGEST_KNOWN]
        raw = np.minimum(np.frombuffer("".join(short).encode("utf-32-le"), dtype="<u4"), len(char) - 1)
        ends = np.cumsum([len(w) for w in short])
        covered = np.add.reduceat(char[raw] == 0, np.concatenate(([0], ends[:-1]))) == 0 if short else []
        plain = [w for w, x in zip(short, covered) if x]
        if plain:
            made.update(zip(plain, self.merged_together(plain)))
        for w in words:
            if w not in made:
                made[w] = array("H", self.spelled(self.merged(w))).tobytes()
        known.update((w, made[w]) for w in short)
        return made

    def spelled(self, parts: list[str]) -> list[int]:
        """Ids of pieces; a character that is none becomes its bytes."""
        ids, out = self.v.ids, []
        for p in parts:
            k = ids.get(p)
            if k is None:
                out += [self.v.bytes[b] for b in p.encode("utf-8", "replace")]
            else:
                out.append(k)
        return out

    def is_piece(self, s: str) -> bool:
        """Whether s can be a part of an encoding: a single character, or a piece that its own merges lead to."""
        if len(s) == 1:
            return True
        if s not in self.v.ids:
            return False
        if (known := self.stands.get(s)) is None:
            known = self.stands[s] = self.merged(s) == [s]
        return known

    def compatible(self, a: str, b: str) -> bool:
        """Whether two pieces stand side by side; an empty one stands with any."""
        if not a:
            return True
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) > KNOWN_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return known

    def states(self, s: str, border: int) -> list[Span]:
        """Pieces that begin before the border and end at or behind it, in an order that both sides of it agree on."""
        most = self.v.longest
        return [
            (i, j)
            for i in range(border - 1, max(-1, border - most - 1), -1)
            for j in range(border, min(len(s), i + most) + 1)
            if self.is_piece(s[i:j])
        ]

    def flow(self, s: str, begin: int, end: int, entry: list[Span]) -> tuple[dict[Span, Span | None], dict[Span, int]]:
        """Pieces on paths from the entries over pieces that begin before ``end``: where each comes from, and a bit for each entry it comes from."""
        comes: dict[Span, Span | None] = {}
        masks: dict[Span, int] = {}
        ending: dict[int, list[Span]] = {}
        for r, span in enumerate(entry):
            comes[span], masks[span] = None, 1 << r
            ending.setdefault(span[1], []).append(span)
        for p in range(begin, end):
            before = ending.pop(p, None)
            if before is None:
                continue
            for q in range(p + 1, min(len(s), p + max(1, self.reach.get(s[p : p + 2], 1))) + 1):
                piece = s[p:q]
                if not self.is_piece(piece):
                    continue
                mask, last = 0, None
                for i, j in before:
                    if self.compatible(s[i:j], piece):
                        mask, last = mask | masks[i, j], (i, j)
                if mask:
                    comes[p, q], masks[p, q] = last, mask
                    ending.setdefault(q, []).append((p, q))
        return comes, masks

    @staticmethod
    def borders(s: str, begin: int, end: int) -> Span | None:
        """First and last place of [begin, end) where a word begins, so that every path passes there."""
        first = next((p for p in range(max(1, begin), end) if s[p] == MARK and s[p - 1] != MARK), None)
        if first is None:
            return None
        return first, next(p for p in range(end - 1, first - 1, -1) if s[p] == MARK and s[p - 1] != MARK)

    def transfer(self, before: str, chunk: str, ahead: str) -> np.ndarray:
        """Max-plus matrix from the states at the chunk's start to those at its end."""
        s, begin = before + chunk + ahead, len(before)
        end = begin + len(chunk)
        entry = self.states(s, begin) if begin else [(0, 0)]
        out = self.states(s, end)
        if (at := self.borders(s, begin, end)) is not None:
            # All paths pass the borders, so the matrix is an outer sum of what lies before and after.
            head = 0
            for span, mask in self.flow(s, begin, at[0], entry)[1].items():
                head |= mask if span[1] == at[0] else 0
            reached = self.flow(s, at[1], end, [(at[1], at[1])])[0]
            heads = np.array([0 if head >> r & 1 else DEAD for r in range(len(entry))], dtype=np.int64)
            tails = np.array([0 if x in reached else DEAD for x in out], dtype=np.int64)
            return np.maximum(heads[:, None] + tails[None, :], DEAD)
        masks = self.flow(s, begin, end, entry)[1]
        return np.array([[0 if masks.get(x, 0) >> r & 1 else DEAD for x in out] for r in range(len(entry))], dtype=np.int64)

    def ends(self, before: str, chunk: str, ahead: str, vector: list[int]) -> tuple[list[int], list[int], list[list[int]]]:
        """Shared ids, and for each state at the end the state at the start and the ids after the shared ones."""
        s, begin = before + chunk + ahead, len(before)
        end = begin + len(chunk)
        entry = self.states(s, begin) if begin else [(0, 0)]
        alive = [x for x, v in zip(entry, vector) if v > DEAD]
        number = {x: r for r, x in enumerate(entry)}
        common: list[int] = []
        start = None
        if (at := self.borders(s, begin, end)) is not None:
            comes = self.flow(s, begin, at[0], alive)[0]
            node = next((x for x in reversed(comes) if x[1] == at[0]), None)
            parts = []
            while node is not None and comes[node] is not None:
                parts.append(s[slice(*node)])
                node = comes[node]
            start = -1 if node is None else number[node]
            common = self.spelled(parts[::-1]) + self.words(s[at[0] : at[1]]).tolist()
            alive = [(at[1], at[1])]
        comes = self.flow(s, at[1] if at else begin, end, alive)[0]
        routes: list[list[Span]] = []
        for x in self.states(s, end):
            route = [x] if x in comes else []
            while route and comes[route[-1]] is not None:
                route.append(comes[route[-1]])
            routes.append(route[::-1])
        real = [x for x in routes if x]
        same = 0
        if real and all(x[0] == real[0][0] for x in real):
            same = next((k for k, x in enumerate(zip(*real)) if len(set(x)) > 1), min(map(len, real))) - 1
        spell = lambda nodes: self.spelled([s[i:j] for i, j in nodes])
        common = common + (spell(real[0][1 : same + 1]) if real else [])
        first = [-1 if not x else number[x[0]] if start is None else start for x in routes]
        return common, first, [spell(x[same + 1 :]) for x in routes]

    def words(self, s: str) -> np.ndarray:
        """Ids of a marked text that starts and ends between words."""
        return self.texts([s])[0]

    def texts(self, marked: list[str]) -> list[np.ndarray]:
        """Ids of several such texts; words that are new to any of them are merged together, once."""
        lists = [self.word.findall(s) for s in marked]
        known = self.known
        new = list({w for words in lists for w in set(words) if w not in known})
        if new:
            if len(known) + len(new) > KNOWN_WORDS:
                new = list({w for words in lists for w in words})
            made = self.learn(new)
            long_ = {w: x for w, x in made.items() if len(w) > LONGEST_KNOWN}
            if long_:
                return [np.frombuffer(b"".join([long_.get(w) or known[w] for w in words]), dtype=np.uint16) for words in lists]
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype=np.uint16) for words in lists]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        return self.texts([MARK + t.replace(" ", MARK) if t else "" for t in texts])


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker is sent at a time, for this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def sliced(batch: pa.RecordBatch, rows: int = 250) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task makes at a time stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def maxplus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in max-plus algebra."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), DEAD)


def prefixes(matrices: list[np.ndarray], vector: np.ndarray) -> list[np.ndarray]:
    """The vector before each matrix of a chain."""
    out = [vector]
    for m in matrices[:-1]:
        out.append(maxplus(out[-1], m))
    return out


def packed(m: np.ndarray) -> bytes:
    """A matrix as bytes, its number of rows first."""
    return np.concatenate([[m.shape[0]], m.ravel()]).astype("<i8").tobytes()


def unpacked(x: bytes) -> np.ndarray:
    flat = np.frombuffer(x, dtype="<i8")
    return flat[1:].reshape(int(flat[0]), -1)


KEY = ["id", "th"]


def _giant_tokens(rows: DataFrame, v: Vocabulary, chunk: int, block: int) -> DataFrame:
    """rows(id, th, text) -> (id, th, tokens) of every distinct row."""
    if chunk < v.longest:
        raise ValueError("a chunk must hold the longest piece")
    pieces = F.regexp_extract_all(F.col("marked"), F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    edge = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
    parts = F.transform(
        pieces,
        lambda p, k: F.struct(
            F.right(edge(k - 1), F.lit(v.longest)).alias("before"), p.alias("own"), F.substring(edge(k + 1), 1, v.longest).alias("ahead")
        ),
    )
    marked = rows.select(*KEY, F.concat(F.lit(MARK), F.translate("text", " ", MARK)).alias("marked"))
    # Two plans below read the chunks, so they are written once.
    chunks = cut(
        marked.select(*KEY, F.posexplode(parts).alias("k", "part"))
        .select(*KEY, "k", "part.before", "part.own", "part.ahead")
        .dropDuplicates([*KEY, "k"])
    )

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v)
        for batch in batches:
            for part in sliced(batch, 100):
                made = [packed(encoder.transfer(*x)) for x in zip(*(part.column(k).to_pylist() for k in (3, 4, 5)))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(made, pa.binary())], names=[*KEY, "k", "m"])

    key = f"id {rows.schema['id'].dataType.simpleString()}, th long"
    # A matrix is small and dear, and two plans below read it: it is written once.
    transfer = cut(chunks.mapInArrow(matrices, f"{key}, k int, m binary").withColumn("b", F.floor(F.col("k") / block).cast("int")))

    def product(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("k")
        out = unpacked(p["m"].iloc[0])
        for m in p["m"].iloc[1:]:
            out = maxplus(out, unpacked(m))
        return pd.DataFrame({"id": p["id"].iloc[:1], "th": p["th"].iloc[:1], "b": p["b"].iloc[:1], "m": [packed(out)]})

    def borders(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("b")
        made = [packed(x) for x in prefixes([unpacked(m) for m in p["m"]], np.zeros((1, 1), dtype=np.int64))]
        return pd.DataFrame({"id": p["id"], "th": p["th"], "b": p["b"], "entry": made})

    def inner(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("k")
        made = [packed(x) for x in prefixes([unpacked(m) for m in p["m"]], unpacked(p["entry"].iloc[0]))]
        return pd.DataFrame({"id": p["id"], "th": p["th"], "k": p["k"], "entry": made})

    by_block = [*KEY, "b"]
    blocks = transfer.groupBy(*by_block).applyInPandas(product, f"{key}, b int, m binary")
    starts = blocks.groupBy(*KEY).applyInPandas(borders, f"{key}, b int, entry binary")
    entries = (
        transfer.alias("t")
        .join(starts.alias("e"), [F.col(f"t.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by_block])
        .select("t.*", "e.entry")
        .groupBy(*by_block)
        .applyInPandas(inner, f"{key}, k int, entry binary")
    )
    known = (
        chunks.alias("c")
        .join(entries.alias("s"), [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*KEY, "k"]])
        .select("c.*", "s.entry")
    )

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v)
        kinds = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())))
        for batch in batches:
            for part in sliced(batch, 40):
                before, own, ahead, entry = (part.column(k).to_pylist() for k in (3, 4, 5, 6))
                made = [encoder.ends(*x, unpacked(e)[0].tolist()) for *x, e in zip(before, own, ahead, entry)]
                columns = [pa.array([m[k] for m in made], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names=[*KEY, "k", "common", "comes", "tails"])

    def chain(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("k", ascending=False)
        # Of the pieces that end with the text, one is on a path.
        state, parts = int(np.argmax(np.asarray(p["comes"].iloc[0]) >= 0)), []
        for common, comes, tails in zip(p["common"], p["comes"], p["tails"]):
            parts += [tails[state], common]
            state = int(comes[state])
        tokens = np.concatenate([np.asarray(x, dtype=np.int32) for x in reversed(parts)])
        return pd.DataFrame({"id": p["id"].iloc[:1], "th": p["th"].iloc[:1], "tokens": [tokens]})

    paths = known.mapInArrow(backtrace, f"{key}, k int, common array<int>, comes array<int>, tails array<array<int>>")
    return paths.groupBy(*KEY).applyInPandas(chain, f"{key}, tokens array<int>")


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    giant: int = GIANT, chunk: int = CHUNK, block: int = BLOCK,
) -> DataFrame:
    """(id, th, tokens array<int>) of every row; th is a hash of the text that tells repeated ids apart."""
    v = Vocabulary(vocabulary)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    is_giant = F.coalesce(F.length("text") > giant, F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v)
        for batch in batches:
            for part in sliced(batch):
                made = encoder.encode_many(part.column(2).to_pylist())
                ends = np.cumsum([0, *map(len, made)], dtype=np.int32)
                values = pa.array(np.concatenate(made).astype(np.int32))
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], tokens], names=[*KEY, "tokens"])

    plain = rows.filter(~is_giant).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, th long, tokens array<int>")
    giants = rows.filter(is_giant)
    copies = giants.groupBy(*KEY).count()
    solved = _giant_tokens(giants, v, chunk, block)
    again = (
        solved.alias("s")
        .join(copies.alias("c"), [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in KEY])
        .select("s.*", F.explode(F.sequence(F.lit(1), F.col("c.count").cast("int"))).alias("copy"))
    )
    return plain.union(again.drop("copy"))


def decode(rows: DataFrame, tokens_col: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``rows`` but the tokens, plus ``decoded`` string."""
    out = Vocabulary(vocabulary).out
    small_batches(rows.sparkSession)
    keep = [c for c in rows.columns if c != tokens_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep] + ["decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                texts = []
                for t in part.column(len(keep)):
                    ids = t.values.to_numpy(zero_copy_only=False).tolist() if t.is_valid and len(t) else []
                    texts.append(b"".join([out[k] for k in ids])[1:].decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return rows.select(*keep, tokens_col).mapInArrow(run, schema)
