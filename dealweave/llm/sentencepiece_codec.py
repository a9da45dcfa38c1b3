"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

A model file (the public ``.model`` format) gives pieces, scores and normaliser switches; nothing is trained here, and the
scores are taken as they stand, whatever made them. Text is encoded in chunks that no piece can straddle: a white-space
marker run with what follows it, and characters that no piece holds. A best path over the whole text is the best paths of
its chunks one after another, so each worker encodes a distinct chunk once and keeps it in a cache of bounded size.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)  # piece types of the format
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 100_000  # of either age
SLICE_BYTES = 1 << 18  # text solved at once
LONG_CHUNK = 64  # characters; longer chunks are solved one by one


def _fields(raw: bytes):
    """(number, value) of each field of a protocol-buffer message; embedded messages as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield key >> 3, raw[at:at + size]
            at += size
        else:
            size = varint()
            yield key >> 3, raw[at:at + size]
            at += size


@dataclass
class DoubleArray:
    """A trie of byte strings: state s goes by byte b to base[s] + b, if check there is s; value is a key's number or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, keys: dict[bytes, int]) -> DoubleArray:
        names = sorted(keys)
        size = 4096 + 3 * sum(map(len, names))
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        # states with one child fill holes from below; the others go near the end, where room is found at once
        todo, low, end = [(0, 0, len(names), 0)], 256, 256
        for state, lo, hi, depth in todo:  # grows while it is walked
            if lo < hi and len(names[lo]) == depth:
                value[state] = keys[names[lo]]
                lo += 1
            if lo == hi:
                continue
            cuts = [lo, *(i for i in range(lo + 1, hi) if names[i][depth] != names[i - 1][depth]), hi]
            labels = [names[i][depth] for i in cuts[:-1]]
            if len(labels) == 1:
                while check[low] >= 0:
                    low += 1
                at = low - labels[0]
            else:
                at = max(1, end - 256)
                while any(check[at + b] >= 0 for b in labels):
                    at += 1
            base[state] = at
            for b, first, last in zip(labels, cuts, cuts[1:]):
                check[at + b] = state
                end = max(end, at + b)
                todo.append((at + b, first, last, depth + 1))
        used = end + 257
        return cls(*(np.array(x[:used], np.int32) for x in (base, check, value)))


class Model:
    """Pieces and switches of a model file, and the trie of its pieces."""

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.dummy_prefix = self.squeeze = self.escape = True
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models that rewrite characters are not supported")
                self.dummy_prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        able = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER)]
        top = max((self.scores[i] for i in able), default=0.0)
        self.least = min((self.scores[i] for i in able), default=0.0) - UNKNOWN_PENALTY
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.bytes_at = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        # a user-defined piece always wins, by a bonus for its length
        self.weights = [len(p) * top - 0.1 if k == USER else s for p, s, k in zip(self.pieces, self.scores, self.kinds)]
        self.trie = DoubleArray.of({self.pieces[i].encode(): i for i in able})
        held = set("".join(self.pieces[i] for i in able))
        inner = any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in able)
        alone = "".join(c for c in "\n\t\r" if c not in held)
        skip = re.escape(alone)
        self.chunks = re.compile(f"{MARK}*[^{MARK}{skip}]+|{MARK}+" + (f"|[{skip}]" if alone else "") if not inner else f"[^{skip}]+|[{skip}]" if alone else r"(?s:.+)")
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    def _surface(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        return b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else self.pieces[i].replace(MARK, " ").encode()

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if text and self.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.escape else text

    def best(self, chunk: str) -> tuple[int, ...]:
        """Ids of the path of the highest sum of scores; characters without a piece become bytes, or the unknown piece.

        Among equal sums the path that reached a place first stays, that is, the one whose last piece is longest.
        """
        data = chunk.encode()
        base, check, value = self._lists
        weights, n = self.weights, len(data)
        score: list[float | None] = [None] * (n + 1)
        came, by = [0] * (n + 1), [-1] * (n + 1)
        score[0] = 0.0
        at = 0
        while at < n:
            head = data[at]
            size = 1 if head < 128 else 2 if head < 224 else 3 if head < 240 else 4
            here, state, whole = score[at], 0, False
            for end in range(at, n):
                to = base[state] + data[end]
                if check[to] != state or to == 0:
                    break
                state = to
                piece = value[state]
                if piece >= 0:
                    got = here + weights[piece]
                    if score[end + 1] is None or got > score[end + 1]:
                        score[end + 1], came[end + 1], by[end + 1] = got, at, piece
                    whole |= end + 1 - at == size
            if not whole:
                got = here + self.least
                if score[at + size] is None or got > score[at + size]:
                    score[at + size], came[at + size], by[at + size] = got, at, -1
            at += size
        path: list[int] = []
        at = n
        while at:
            if by[at] >= 0:
                path.append(by[at])
            elif self.bytes_at:
                path += [self.bytes_at[b] for b in reversed(data[came[at]:at])]
            else:
                path.append(self.unknown)
            at = came[at]
        return tuple(path[::-1])

    def best_of(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """As :meth:`best` for many chunks at once: all walk the trie side by side, and all paths grow a byte at a time."""
        if not chunks:
            return []
        data = np.frombuffer("".join(chunks).encode(), np.uint8).astype(np.int64)
        sizes = np.array([len(c.encode()) for c in chunks], np.int64)
        first = np.cumsum(sizes) - sizes
        stop = np.repeat(first + sizes, sizes)  # where each byte's chunk ends
        place = np.arange(len(data)) - np.repeat(first, sizes)  # in its chunk
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        width = _width_at(data, heads)
        starts, ends, pieces = [], [], []
        at, state, depth = heads, np.zeros(len(heads), np.int64), 0
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        while len(at):
            at, state = at[at + depth < stop[at]], state[at + depth < stop[at]]
            to = base[state] + data[at + depth]
            ok = (check[to] == state) & (to != 0)
            at, state = at[ok], to[ok]
            depth += 1
            hit = value[state] >= 0
            starts.append(at[hit])
            ends.append(at[hit] + depth)
            pieces.append(value[state[hit]].astype(np.int64))
        start, end, piece = (np.concatenate(x) for x in (starts, ends, pieces))
        alone = np.zeros(len(data) + 1, bool)  # a character that is a piece by itself
        alone[start[end - start == _width_at(data, start)]] = True
        lost = heads[~alone[heads]]
        start, end, piece = np.r_[start, lost], np.r_[end, lost + width[~alone[heads]]], np.r_[piece, np.full(len(lost), -1)]
        weight = np.where(piece >= 0, np.array(self.weights)[piece], self.least)
        # scores stand at the byte before an end, so that neighbouring chunks do not share a place
        score, came, by = np.full(len(data), -np.inf), np.zeros(len(data), np.int64), np.full(len(data), -1)
        # by place; arcs of one chunk that leave one place end in different ones, so their order is free
        order = np.argsort(place[start].astype(np.uint16), kind="stable")
        start, end, piece, weight = start[order], end[order], piece[order], weight[order]
        turns = np.searchsorted(place[start], np.arange(int(sizes.max()) + 1))
        for lo, hi in zip(turns, turns[1:]):
            if lo < hi:  # all arcs that leave this place of any chunk; they end in different places
                a, b = start[lo:hi], end[lo:hi] - 1
                got = weight[lo:hi] if place[a[0]] == 0 else score[a - 1] + weight[lo:hi]
                better = got > score[b]
                b = b[better]
                score[b], came[b], by[b] = got[better], a[better], piece[lo:hi][better]
        # all paths are walked back at once, a piece at a time; chunks whose path has a lost character are done again alone
        at, live, back = first + sizes, np.arange(len(chunks)), []
        count, whole = np.zeros(len(chunks), np.int64), np.ones(len(chunks), bool)
        while len(live):
            own = by[at - 1]
            back.append((live, own))
            count[live] += 1
            whole[live[own < 0]] = False
            at = came[at - 1]
            on = at > first[live]
            at, live = at[on], live[on]
        stops = np.cumsum(count)
        flat = np.zeros(int(stops[-1]), np.int64)
        for k, (live, own) in enumerate(back):
            flat[stops[live] - 1 - k] = own
        flat = flat.tolist()
        return [tuple(flat[a:b]) if ok else self.best(c) for a, b, ok, c in zip((stops - count).tolist(), stops.tolist(), whole.tolist(), chunks)]

    @functools.cached_property
    def _lists(self):
        return self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()

    @functools.cached_property
    def cache(self) -> _Cache:
        return _Cache(self)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the chunks that are new to the cache are solved together, but for very long ones."""
        lists = [self.chunks.findall(self.normalised(t)) for t in texts]
        self.cache.provide(set(itertools.chain.from_iterable(lists)))
        return [self._ids(chunks) for chunks in lists]

    def encode(self, text: str) -> np.ndarray:
        return self._ids(self.chunks.findall(self.normalised(text)))

    def _ids(self, chunks: list[str]) -> np.ndarray:
        ids = np.fromiter(itertools.chain.from_iterable(map(self.cache.__getitem__, chunks)), np.int32)
        if not self.bytes_at and len(ids):  # neighbouring unknowns are one
            ids = ids[np.r_[True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)]]
        return ids

    def decode(self, ids) -> str:
        """The text of some ids: markers become spaces, the dummy prefix goes, bytes join to characters."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and self.escape and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _width_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes of the character that begins at each place."""
    b = data[at]
    return 1 + (b >= 0xC0).astype(np.int64) + (b >= 0xE0) + (b >= 0xF0)


class _Cache(dict):
    """chunk -> ids of the newer chunks; what is older is kept until as many are newer, or used again."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.older = model, {}

    def provide(self, chunks: set[str]) -> None:
        """Make room for ``chunks`` and solve those that are not known."""
        fresh = chunks - self.keys()
        if len(self) + len(fresh) > CACHE_ENTRIES:
            self.older, fresh = dict(self), chunks
            self.clear()
        for c in fresh & self.older.keys():
            self[c] = self.older[c]
        new = [c for c in fresh if c not in self and len(c) <= LONG_CHUNK]
        self.update(zip(new, self.model.best_of(new)))

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = self[chunk] = self.model.best(chunk)
        return ids


@functools.lru_cache(maxsize=2)
def _model(raw: bytes) -> Model:
    return Model(raw)


def load(path: str = MODEL) -> bytes:
    """A model file's bytes, read on the driver; a vocabulary's size bounds what is sent to the workers."""
    with open(SparkFiles.get(path[len("files:"):]) if path.startswith("files:") else path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of each text (replacing a column of that name); none for an empty text, null for null."""
    docs = docs.drop(ids_col)
    schema = T.StructType([*docs.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches):
        own = _model(model)
        for batch in batches:
            for part in texts(batch.column(batch.schema.get_field_index(text_col)), SLICE_BYTES):
                ids = [None if none else got for none, got in zip(part.null, own.encode_all([part.row(i).decode() for i in range(len(part))]))]
                yield pa.RecordBatch.from_arrays([*(c.slice(part.first, len(part)) for c in batch.columns), pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, ids_col])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in ``text_col`` (replacing a column of that name); null for null."""
    encoded = encoded.drop(text_col)
    schema = T.StructType([*encoded.schema, T.StructField(text_col, T.StringType())])

    def run(batches):
        own = _model(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            flat, at = column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(column.value_lengths().fill_null(0))]
            text = [own.decode(flat[a:b].tolist()) if ok else None for a, b, ok in zip(at, at[1:], column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(run, schema)


def op5(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_ids, n_byte_ids and round_trip of every document: its ids, and whether they decode to its text.

    A null text has null ids and counts as its own round trip.
    """
    model = load(path)
    schema = "doc_id long, ids array<int>, n_ids long, n_byte_ids long, round_trip boolean"

    def run(batches):
        own = _model(model)
        is_byte = np.array([k == BYTE for k in own.kinds])
        for batch in batches:
            doc_id, column = batch.column(0), batch.column(1)
            for part in texts(column, SLICE_BYTES):
                ids, same = [], []
                text = [part.row(i).decode() for i in range(len(part))]
                for none, t, got in zip(part.null, text, own.encode_all(text)):
                    same.append(bool(none) or own.decode(got.tolist()) == t)
                    ids.append(None if none else got)
                sizes = [0 if x is None else len(x) for x in ids]
                fell = [0 if x is None else int(is_byte[x].sum()) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(part.first, len(part)), pa.array(ids, pa.list_(pa.int32())), pa.array(sizes, pa.int64()), pa.array(fell, pa.int64()), pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "n_byte_ids", "round_trip"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
