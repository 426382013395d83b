"""Packing of token sequences into windows of a fixed length: bounded-space online best fit.

Every partition is packed as a stream. A document's ids are cut into whole windows
as long as they fill them; the rest goes, in one piece, to the open window that it
fills best. When it fits into none and ``OPEN`` windows are open, the fullest one
is topped up with the head of the piece and emitted, so that it needs no padding,
and what is left of the piece opens a window in its place. At the end of a
partition its open windows are laid end to end and cut into whole sequences, which
leaves less than one; these leftovers are merged in the same way, ``MERGED``
partitions at a time, level by level, so no task ever holds more than
``MERGED`` windows. What the last level leaves is cut into sequences whose lengths
are powers of two, which need no padding.

Ids are those of a public vocabulary whose pieces do not cross white space: a text
is split at ASCII white space, and of the texts that are encoded together each
different word is encoded once. The driver reads the vocabulary; tasks get it with
the job. A partition's result depends on its rows alone, so a lost task repeats it.

Defined cases: a null or empty text is the end id alone; documents that repeat each
other are packed each on its own; equally good windows: the one opened first; an
empty table gives no rows; extra columns are ignored, whatever their names. A
document of any length is cut; its ids are held by one task while it is packed.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm.pieces import small_batches
from lodestack.session import scratch

VOCABULARY = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
OPEN = 32
MERGED = 256
#: Bytes of texts that are encoded together, and of an Arrow batch that goes out.
SLICE = 8 << 20
OUT_BYTES = 4 << 20
#: Words encoded as one text.
TOGETHER = 1000
WHITE = re.compile(rb"[\x20\x09-\x0D]")
#: What stands behind a letter or digit, and cannot belong to its piece.
TAIL = ".,;:!?"

PIECES = "array<struct<id:{},start:long,length:long,offset:long,doc_tokens:long>>"


def _gather(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``order`` of those that lie end to end in ``flat``, and where each of them ends, after a first 0."""
    each = sizes[order]
    ends = np.zeros(len(each) + 1, dtype=np.int32)
    np.cumsum(each, out=ends[1:])
    # Entry t of a list that begins at place e of the output stands at place first + t - e of ``flat``.
    first = np.cumsum(sizes, dtype=np.int32) - sizes
    shift = np.repeat(first[order] - ends[:-1], each)
    shift += np.arange(len(shift), dtype=np.int32)
    return flat[shift], ends


class WordIds:
    """Ids of texts as arrays of 32-bit numbers."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_str(vocabulary)
        self.ends = np.zeros(self.model.get_vocab_size(), dtype=bool)
        self.ends[[k for p, k in self.model.get_vocab().items() if p.endswith("</w>")]] = True
        # For words that are letters of U+00FF at most, in lower case: nothing to normalize, and no rule splits them.
        self.letters = Tokenizer(self.model.model)
        apart = [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(apart)

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, end to end, and how many each has: many are one text, in which a piece with a word's end closes each."""
        names = words.to_pylist()
        texts = [" ".join(names[k : k + TOGETHER]) for k in range(0, len(names), TOGETHER)]
        found = [np.array(x.ids, dtype="<u4") for x in self.letters.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(found) if found else np.zeros(0, dtype="<u4")
        return flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1).astype(np.int32)

    def _other(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(x.ids, dtype="<u4") for x in self.model.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.concatenate([*found, np.zeros(0, dtype="<u4")]), np.fromiter(map(len, found), dtype=np.int32, count=len(found))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin, with the end of the last."""
        index = lambda coded: coded.indices.to_numpy(zero_copy_only=False)
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        # Behind letters, what stands at the end is a piece of its own; up to U+00FF a letter and its lower case are
        # one character each, which no composition changes.
        core = pc.utf8_rtrim(words.dictionary, characters=TAIL)
        is_plain = pc.and_(pc.utf8_is_alpha(core), pc.match_substring_regex(core, "^[\\x{00}-\\x{ff}]*$"))
        plain = is_plain.to_numpy(zero_copy_only=False)
        cores = pc.utf8_lower(core.filter(is_plain)).dictionary_encode()
        tails = pc.replace_substring_regex(words.dictionary.filter(is_plain), f"^.*[^{TAIL}]", "").dictionary_encode()
        others = words.dictionary.filter(pc.invert(is_plain))
        lists = [self._plain(cores.dictionary), self._other(tails.dictionary), self._other(others)]
        flat, sizes = (np.concatenate([x[k] for x in lists]) for k in (0, 1))
        # Each word is two lists: letters and what stands behind them, or the word itself and nothing.
        nothing = len(sizes)
        both = np.full((len(plain), 2), nothing, dtype=np.int64)
        first = len(cores.dictionary)
        both[plain, 0], both[plain, 1] = index(cores), first + index(tails)
        both[~plain, 0] = first + len(tails.dictionary) + np.arange(len(others))
        flat, ends = _gather(flat, np.append(sizes, np.int32(0)), both.reshape(-1))
        flat, ends = _gather(flat, ends[2::2] - ends[:-1:2], index(words))
        bounds = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        return flat, ends[bounds]


def slices(raw: bytes, most: int = SLICE) -> Iterator[bytes]:
    """A text in parts that end before white space."""
    at = 0
    while len(raw) - at > most and (stop := WHITE.search(raw, at + most)):
        yield raw[at : stop.start()]
        at = stop.start()
    yield raw[at:]


class Window:
    """An open sequence: its pieces and their ids."""

    def __init__(self) -> None:
        self.used, self.pieces, self.ids = 0, [], []

    def add(self, doc: object, total: int, start: int, ids: bytes) -> None:
        n = len(ids) // 4
        self.pieces.append((doc, start, n, self.used, total))
        self.ids.append(ids)
        self.used += n


def _end_to_end(windows: Iterable[Window], size: int) -> Iterator[Window]:
    """Windows laid end to end, cut into whole ones; the last is shorter, if any is left."""
    now = Window()
    for w in windows:
        raw = b"".join(w.ids)
        for doc, start, length, offset, total in w.pieces:
            while length:
                n = min(length, size - now.used)
                now.add(doc, total, start, raw[offset * 4 : (offset + n) * 4])
                start, offset, length = start + n, offset + n, length - n
                if now.used == size:
                    yield now
                    now = Window()
    if now.used:
        yield now


def powers_of_two(window: Window) -> Iterator[Window]:
    """A window cut into parts whose lengths are powers of two, longest first."""
    parts, raw = [], b"".join(window.ids)
    pieces, left = list(window.pieces), window.used
    while left:
        part = Window()
        while part.used < 1 << (left.bit_length() - 1):
            doc, start, length, offset, total = pieces.pop(0)
            n = min(length, (1 << (left.bit_length() - 1)) - part.used)
            part.add(doc, total, start, raw[offset * 4 : (offset + n) * 4])
            if n < length:
                pieces.insert(0, (doc, start + n, length - n, offset + n, total))
        left -= part.used
        parts.append(part)
    yield from parts


class Packer:
    """Best fit with a fixed number of open windows; whole windows are handed out as they fill up."""

    def __init__(self, size: int = WINDOW, most_open: int = OPEN):
        self.size, self.most_open = size, most_open
        self.open: list[Window] = []

    def add(self, doc: object, ids: bytes) -> Iterator[Window]:
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            whole = Window()
            whole.add(doc, total, at, ids[at * 4 : (at + self.size) * 4])
            yield whole
            at += self.size
        n = total - at
        if not n:
            return
        best = max((w for w in self.open if w.used + n <= self.size), key=lambda w: w.used, default=None)
        if best is None:
            if len(self.open) >= self.most_open:
                fullest = max(self.open, key=lambda w: w.used)
                gap = self.size - fullest.used
                fullest.add(doc, total, at, ids[at * 4 : (at + gap) * 4])
                at += gap
                self.open.remove(fullest)
                yield fullest
            best = Window()
            self.open.append(best)
        best.add(doc, total, at, ids[at * 4 :])
        if best.used == self.size:
            self.open.remove(best)
            yield best

    def close(self) -> Iterator[Window]:
        yield from _end_to_end(sorted(self.open, key=lambda w: -w.used), self.size)
        self.open = []


class _Rows:
    """Sequences on their way out as Arrow batches."""

    def __init__(self, kind: pa.DataType, base: int, size: int):
        piece = pa.struct([("id", kind), *((f, pa.int64()) for f in ("start", "length", "offset", "doc_tokens"))])
        self.schema = pa.schema(
            [("task", pa.int64()), ("whole", pa.bool_()), ("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("pieces", pa.list_(piece))]
        )
        self.base, self.size, self.count, self.held, self.rows = base, size, 0, 0, []

    def put(self, window: Window, task: int, whole: bool) -> None:
        ids = b"".join(window.ids)
        self.rows.append((task, whole, self.base + self.count, window.used, ids, window.pieces))
        self.count += 1
        self.held += len(ids)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 6
        pieces = [[dict(zip(("id", "start", "length", "offset", "doc_tokens"), p)) for p in ps] for ps in columns[5]]
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip([*columns[:5], pieces], self.schema)], schema=self.schema)


_models: dict[int, WordIds] = {}


def _model(vocabulary: str) -> WordIds:
    """One model per worker process."""
    # A task has one core; threads of the library's own would only add memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = hash(vocabulary)
    if key not in _models:
        _models.clear()
        _models[key] = WordIds(vocabulary)
    return _models[key]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of batches that have ``SLICE`` bytes together: the more texts, the more often their words repeat."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > SLICE:
            yield tuple(pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1))
            held = []
        held.append(batch)
    if held:
        yield tuple(pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1))


def encoded(texts: pa.Array, model: WordIds, end_id: int = END_ID) -> Iterator[bytes]:
    """Ids of each text with the end id, as bytes; texts are taken together up to ``SLICE`` bytes, longer ones in parts."""
    texts = texts.fill_null("")
    end = int(end_id).to_bytes(4, "little")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        many = int(np.searchsorted(sizes, before + SLICE, side="right")) - at
        if many:
            ids, ends = model.of(texts.slice(at, many))
            for k in range(many):
                yield ids[ends[k] : ends[k + 1]].tobytes() + end
        else:
            many = 1
            yield b"".join(model.of(pa.array([part.decode()]))[0].tobytes() for part in slices(texts[at].as_py().encode())) + end
        at += many


def vocabulary_text(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        return f.read()


def _merging(level: int, last: bool, merged: int, size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Leftovers of up to ``merged`` tasks -> whole sequences and, but for the last level, one leftover."""
    names = ("id", "start", "length", "offset", "doc_tokens")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["task"].iloc[0]) // merged
        windows, found = [], []
        for ids, pieces in frame.sort_values("task")[["ids", "pieces"]].itertuples(index=False):
            w = Window()
            w.used, w.ids, w.pieces = len(ids) // 4, [bytes(ids)], [tuple(p[x] for x in names) for p in pieces]
            windows.append(w)
        for w in _end_to_end(windows, size):
            for x in powers_of_two(w) if last and w.used < size else [w]:
                found.append((group, last or w.used == size, x.used, b"".join(x.ids), [dict(zip(names, p)) for p in x.pieces]))
        out = pd.DataFrame(found, columns=["task", "whole", "n_tokens", "ids", "pieces"])
        out["sequence_id"] = (level << 58) + (group << 32) + np.arange(len(out))
        return out[["task", "whole", "sequence_id", "n_tokens", "ids", "pieces"]]

    return merge


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID,
    size: int = WINDOW, most_open: int = OPEN, merged: int = MERGED, folder: str | None = None,
) -> DataFrame:
    """(sequence_id, n_tokens, ids binary of little-endian 32-bit numbers, pieces array<struct<id, start, length, offset, doc_tokens>>).

    The sequences are written to ``folder``, the training set; the default is a new
    folder under the shared one, which lasts as long as the driver.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType
    text = vocabulary_text(vocabulary)
    shipped = spark.sparkContext.broadcast(text)  # one vocabulary, 2 MB, whatever the corpus
    schema = f"task long, whole boolean, sequence_id long, n_tokens long, ids binary, pieces {PIECES.format(kind.simpleString())}"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        model, packer, rows = _model(shipped.value), Packer(size, most_open), None
        for ids, texts in _gathered(batches):
            rows = rows or _Rows(ids.type, task << 32, size)
            for doc, tokens in zip(ids.to_pylist(), encoded(texts, model, end_id)):
                for window in packer.add(doc, tokens):
                    rows.put(window, task, True)
                    if rows.held >= OUT_BYTES:
                        yield rows.batch()
        if rows:
            for window in packer.close():
                rows.put(window, task, window.used == size)
            yield rows.batch()

    small_batches(spark)
    home = folder or scratch(spark, "packed")
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(first, schema)
    write = lambda df, level: df.write.option("compression", "zstd").parquet(f"{home}/level={level}")
    write(packed, 0)
    whole, level = spark.read.parquet(f"{home}/level=0"), 0
    rest = whole.filter(~F.col("whole"))
    out = whole.filter("whole")
    tasks = (rest.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        level, last = level + 1, tasks <= merged

        write(rest.groupBy(F.expr(f"task div {merged}")).applyInPandas(_merging(level, last, merged, size), schema), level)
        made = spark.read.parquet(f"{home}/level={level}")
        out = out.unionByName(made.filter("whole"))
        if last:
            return out.select("sequence_id", "n_tokens", "ids", "pieces")
        rest, tasks = made.filter(~F.col("whole")), (tasks + merged - 1) // merged


def pieces_of(sequences: DataFrame) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece, with the checksum of its ids."""
    each = sequences.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    part = F.substring("ids", (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return each.select("p.id", "p.start", "p.length", F.crc32(part).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset")
