"""Documents packed into token sequences of one size with little padding, by best-fit decreasing.

A document's tokens are cut into full windows, which are sequences by themselves, and a rest. The rests of some documents, the
longest first, each go to the open window with the least room that still holds them; a segment tree over the room left finds
it. Where windows keep more than ``slack`` free tokens after that (no rest was small enough), the emptiest are dissolved and
what they held is cut to the gaps of the fullest. The tokens of the one window that then remains are cut into lengths that are powers of two, which
are not padded.

Everything happens as texts stream through a task: it holds at most about ``HELD_TOKENS`` tokens and one batch of texts, and
nothing is shuffled. A longer input makes more tasks and more such portions, not larger ones.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow

WINDOW = 4096
END = 2
SLACK = 8
HELD_TOKENS = 1 << 23
#: Tokens of one batch handed back, bytes of text encoded at once, words whose ids a worker remembers.
SENT_TOKENS = 1 << 21
SLICE_BYTES = 1 << 22
MOST_WORDS = 600_000
#: Longer words are encoded anew in each slice.
LONGEST_WORD = 64


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file is; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


# --- tokens ---------------------------------------------------------------------------------------------------------


class WordCoder:
    """Ids of texts under a tokenizer whose tokens never reach over white space: each distinct word is encoded once.

    The tokenizer's own library encodes the words. Ids are those of the whole text, as white space separates for it in every
    step (normalisation, splitting and added tokens).
    """

    def __init__(self, path: str, end: int = END):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.bank = [np.array([self.end], np.uint32)]  # word 0 ends a document
        self.sizes = [np.array([1], np.int64)]
        self.words = 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with the end's id behind, and where each text begins. A null is empty."""
        words = pc.ascii_split_whitespace(_apart(texts))
        own = words.flatten().dictionary_encode()
        here = own.dictionary.to_pylist()
        if self.words > MOST_WORDS:
            self.clear()
        place = np.array([self.place.get(w, -1) for w in here], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            # A-Z is lower-cased by the tokenizer too, so spellings with capitals are looked up once more; an added token may stand behind "<"
            lower = [w if "<" in (w := here[i]) else w.lower() if w.isascii() else w.translate(_LOWER) for i in new.tolist()]
            spelt = dict.fromkeys(w for w in lower if w not in self.place)
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(list(spelt), add_special_tokens=False)]
            self.bank.append(np.array([x for ids in coded for x in ids], np.uint32))
            self.sizes.append(np.array([len(ids) for ids in coded], np.int64))
            self.place.update(zip(spelt, range(self.words, self.words + len(coded))))
            self.words += len(coded)
            place[new] = [self.place[w] for w in lower]
            self.place.update((w, k) for w, k in zip([here[i] for i in new.tolist()], place[new].tolist()) if len(w) <= LONGEST_WORD)
            for w in spelt:
                if len(w) > LONGEST_WORD:
                    del self.place[w]
            self.bank, self.sizes = [np.concatenate(self.bank)], [np.concatenate(self.sizes)]
        bank, sizes = self.bank[0], self.sizes[0]
        starts = np.cumsum(sizes) - sizes
        ends = np.asarray(words.offsets).astype(np.int64)
        ends = ends[1:] - ends[0]
        codes = np.insert(place[np.asarray(own.indices)] if len(own) else np.zeros(0, np.int64), ends, 0)
        many = sizes[codes]
        at = np.cumsum(many)
        pick = np.repeat(starts[codes] - (at - many), many)
        pick += np.arange(len(pick))
        bounds = np.zeros(len(ends) + 1, np.int64)
        bounds[1:] = at[ends + np.arange(len(ends))]
        return bank[pick], bounds


#: Letters of one byte, and marks that never stand in one token with a letter before them.
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_MARK = np.array([chr(b) in ".,;:!?)" for b in range(256)])
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _apart(texts: pa.Array) -> pa.Array:
    """The texts, nulls as empty, with a space between a letter and a mark behind it: the tokens stay, but words repeat more often.

    Only A-Z, a-z and U+00C0 - U+00FF (without the two signs among them) count as letters here; others stay with their mark.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return texts
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.zeros(len(data), bool)
    cut[1:] = letter[:-1] & _MARK[data[1:]]
    cut[at[:-1][at[:-1] < len(data)]] = False
    where = np.flatnonzero(cut)
    out = np.insert(data, where, 32)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(at + np.searchsorted(where, at, side="left")), pa.py_buffer(out)])


_coders: dict[tuple[str, int], WordCoder] = {}


def coder_of(path: str, end: int) -> WordCoder:
    """The coder of this worker, with the words that earlier tasks have met."""
    if (path, end) not in _coders:
        _coders[path, end] = WordCoder(path, end)
    return _coders[path, end]


# --- windows --------------------------------------------------------------------------------------------------------


class OpenWindows:
    """Windows by the room they have left: a segment tree whose leaves are the rooms 0 .. size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)  # windows below each node
        self.at: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, window: int, room: int) -> None:
        self.at[room].append(window)
        i = room + self.leaves
        while i:
            self.tree[i] += 1
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that a window has."""
        tree, i = self.tree, need + self.leaves
        if not tree[i]:
            while i > 1 and (i & 1 or not tree[i + 1]):  # up, until a right neighbour has windows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        return i - self.leaves

    def take(self, room: int) -> int:
        i = room + self.leaves
        while i:
            self.tree[i] -= 1
            i >>= 1
        return self.at[room].pop()


def best_fit(lengths: np.ndarray, size: int = WINDOW) -> list[list[int]]:
    """Which of the ``lengths``, none over ``size``, each window holds: best-fit decreasing, equal ones in their order."""
    windows: list[list[int]] = []
    free = OpenWindows(size)
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = sizes[i]
        room = free.tightest(need)
        if room is None:
            room = size
            windows.append([i])
            free.add(len(windows) - 1, size - need)
        else:
            w = free.take(room)
            windows[w].append(i)
            free.add(w, room - need)
    return windows


def arrange(lengths: np.ndarray, size: int = WINDOW, slack: int = SLACK) -> list[list[tuple[int, int, int]]]:
    """Sequences of (which, from, to) over the ``lengths``: every token once, all sequences of ``size`` less ``slack`` at least, or a power of two."""
    windows = [[(i, 0, int(lengths[i])) for i in w] for w in best_fit(lengths, size)]
    fill = [sum(b - a for _, a, b in w) for w in windows]
    order = sorted(range(len(windows)), key=lambda w: -fill[w])
    out, lo, hi = [windows[w] for w in order if fill[w] >= size - slack], 0, 0
    rest = [w for w in order if fill[w] < size - slack]  # the fullest first
    lo, hi = 0, len(rest) - 1
    while lo < hi:
        w, donor = windows[rest[lo]], windows[rest[hi]]
        gap = size - fill[rest[lo]]
        while gap and donor:
            i, a, b = donor.pop()
            take = min(gap, b - a)
            w.append((i, a, a + take))
            gap -= take
            fill[rest[hi]] -= take
            if a + take < b:
                donor.append((i, a + take, b))
        fill[rest[lo]] = size - gap
        if not donor:
            hi -= 1
        if gap <= slack:
            out.append(w)
            lo += 1
    if lo == hi and windows[rest[lo]]:
        out += _powers(windows[rest[lo]])
    return out


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces in sequences whose lengths are the powers of two that their total consists of, the largest first."""
    left, out = sum(b - a for _, a, b in pieces), []
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            i, a, b = pieces.pop()
            take = min(room, b - a)
            out[-1].append((i, a, a + take))
            room -= take
            if a + take < b:
                pieces.append((i, a + take, b))
    return out


# --- a task's documents ---------------------------------------------------------------------------------------------

_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])


class _Portion:
    """Documents whose tokens wait for being packed."""

    def __init__(self, sequence: int, size: int, slack: int):
        self.next, self.size, self.slack = sequence, size, slack
        self.clear()

    def clear(self) -> None:
        self.ids: list[np.ndarray] = []
        self.doc: list[int | None] = []
        self.tokens = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.doc.append(doc)
        self.tokens += len(ids)

    def pack(self) -> Iterator[pa.RecordBatch]:
        size = self.size
        total = np.array([len(x) for x in self.ids], np.int64)
        full = total // size
        rest = np.flatnonzero(total % size)
        sequences = [[(i, k * size, (k + 1) * size)] for i in np.flatnonzero(full).tolist() for k in range(int(full[i]))]
        begin = (full * size)[rest].tolist()
        which = rest.tolist()
        sequences += [[(which[i], begin[i] + a, begin[i] + b) for i, a, b in s] for s in arrange((total % size)[rest], size, self.slack)]
        rows: list[tuple[int, int, int, int, int]] = []
        tokens = 0
        for s in sequences:
            offset = 0
            for i, a, b in s:
                rows.append((i, a, b, self.next, offset))
                offset += b - a
            self.next += 1
            tokens += offset
            if tokens >= SENT_TOKENS:
                yield self._batch(rows, total)
                rows, tokens = [], 0
        if rows:
            yield self._batch(rows, total)
        self.clear()

    def _batch(self, rows: list[tuple[int, int, int, int, int]], total: np.ndarray) -> pa.RecordBatch:
        i, a, b, sequence, offset = np.array(rows, np.int64).T
        data = np.concatenate([self.ids[k][x:y] for k, x, y, _, _ in rows])
        at = np.r_[0, np.cumsum(b - a)] * 4
        ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data.astype("<u4"))])
        return arrow(_ARROW, doc_id=pa.array([self.doc[k] for k in i.tolist()], pa.int64()), start=a, length=b - a, doc_tokens=total[i], sequence_id=sequence, offset=offset, ids=ids)


def _slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Neighbouring rows of about SLICE_BYTES each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    at, lo = np.r_[0, np.cumsum(sizes)], 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE_BYTES, side="right")) - 1)
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, slack: int = SLACK, held: int = HELD_TOKENS, end: int = END) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): every piece of every document, with its ids as bytes.

    ``ids`` are little-endian unsigned 32-bit numbers; see :func:`numbers`. A null or empty text is the end's id alone, repeated rows are
    documents of their own, a null id stays null, an empty table gives no rows; columns other than the two named are ignored. Sequence ids are
    distinct and not gapless: a task numbers its own.
    """
    path = path or vocabulary_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path, end)
        portion = _Portion(TaskContext.get().partitionId() << 33, size, slack)
        for batch in batches:
            own = batch.column(0).to_pylist()
            for lo, texts in _slices(batch.column(1)):
                ids, at = coder.encode(texts)
                for k in range(len(texts)):
                    portion.add(own[lo + k], ids[at[k]:at[k + 1]])
                if portion.tokens >= held:
                    yield from portion.pack()
        yield from portion.pack()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _PIECES)


def numbers(ids) -> list[int]:
    """The token ids of a piece's bytes."""
    return np.frombuffer(ids, "<u4").tolist()


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of each sequence in their order; a sequence has a window's tokens at most."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(own, F.lit(b""), lambda got, x: F.concat(got, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def op11(docs: DataFrame) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with the checksum of their ids."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
