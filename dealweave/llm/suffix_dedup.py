"""Removal of byte strings that occur twice, over a logarithmic family of suffix indexes.

Every string of ``WIDTH`` bytes is indexed at one suffix: its anchor, the position with the least hash of ``KEY`` bytes among
those that lie inside the string. Equal strings have their anchors at equal places, so sampling loses no match, and it keeps
about one suffix in 85. An index level is a table of suffix keys in sorted buckets. A new batch of documents gets its own
sorted table, is merge-scanned against every level for keys that both hold, and becomes a level; levels of equal size merge,
so n batches leave at most log2(n) + 1 of them. All tables share their buckets, so scans and merges move no rows.

Suffixes are sorted by the hash of their first ``KEY`` bytes, not by the bytes: a suffix array of all positions would take
eight bytes for each byte of text. What the family reports are keys that occur twice. Their suffixes are then located and
compared by the whole stretch of strings they stand for: equal stretches are repeats as a whole. Only where one key has
different stretches is one place of each cut into blocks of ``BLOCK`` strings, which are compared in the same way by the bytes
that all strings of a block share; and only blocks that differ are compared string by string. Groups are told apart by
hashes of 128 bits, and by the repeats' own bytes: no step lists pairs.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, mix, release, remove, scratch, settle, texts

WIDTH = 200
KEY = 64
BLOCK = 8
BATCHES = 4
#: A longer text is worked on in pieces that overlap by WIDTH - 1 bytes.
PIECE_BYTES = 4 << 20
#: Largest bitmap, in bits, that tells scans which suffixes to look at. It only saves work: a full one would let all through.
MOST_BITS = 1 << 27

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def pieces(part: Texts):
    """(part, offset in its text) with long texts cut into overlapping pieces."""
    size = len(part.data)
    if len(part) > 1 or size <= PIECE_BYTES:
        yield part, 0
        return
    for lo in range(0, size - WIDTH + 1, PIECE_BYTES):
        data = part.data[lo:lo + PIECE_BYTES + WIDTH - 1]
        yield Texts(part.first, data, np.array([0, len(data)]), part.null), lo


class Anchors:
    """The anchors of a slice: key, row, and the first and last start of the strings each stands for."""

    def __init__(self, part: Texts):
        data, at = part.data, part.at
        n = len(data)
        self.at = at
        x = np.zeros(n + WIDTH, np.uint64)
        x[:n] = data
        x[:-1] |= x[1:] << np.uint64(8)
        x[:-2] |= x[2:] << np.uint64(16)
        x[:-4] |= x[4:] << np.uint64(32)
        self.h8 = mix(x * _C1 + _C2)
        h = self.h8.copy()
        h[:-8] = mix(h[:-8] * _C2 + h[8:])
        h[:-16] = mix(h[:-16] * _C3 + h[16:])
        self.h32 = h
        span = WIDTH - KEY + 1
        valid = np.zeros(n + 2, np.int8)
        long = np.flatnonzero(np.diff(at) >= WIDTH)
        valid[at[long]] += 1
        valid[at[long + 1] - WIDTH + 1] -= 1
        starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)  # where a string starts
        if not len(starts):
            self.first = self.last = self.anchor = starts
        else:
            order = (h[: n + WIDTH] & np.uint64(0xFFFFFFFF00000000)) | np.arange(n + WIDTH, dtype=np.uint64)
            blocks = -(-len(order) // span)
            padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
            padded[: len(order)] = order
            grid = padded.reshape(blocks, span)
            before = np.minimum.accumulate(grid, axis=1).ravel()
            after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
            least = (np.minimum(after[starts], before[starts + span - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            edge = np.r_[True, (np.diff(least) != 0) | (np.diff(starts) != 1)]
            self.first, self.anchor = starts[edge], least[edge]
            self.last = starts[np.r_[edge[1:], True]]
        self.key = self.spell(self.anchor, KEY)
        self.row = np.searchsorted(at, self.first, side="right") - 1

    def spell(self, p: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` (32 or more) bytes from each of ``p``."""
        out = self.h32[p + size - 32]
        for k in range(0, size - 32, 32):
            out = mix(out * _C3 + self.h32[p + k])
        return out

    def stretch(self, first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Hash of all bytes of the strings that start from ``first`` to ``last``, and of their anchor's place."""
        ends = mix(self.spell(first, WIDTH) * _C1 + self.spell(last, WIDTH))
        return mix(ends + ((last - first) << 32 | (anchor - first)).astype(np.uint64))

    def blocks(self, of: np.ndarray) -> tuple[np.ndarray, ...]:
        """The blocks of some anchors: index in ``of``, first and last string, and the hash of the bytes all its strings share.

        Blocks are aligned with the anchor, so that equal strings stand at equal places of their blocks.
        """
        a, lo, hi = self.anchor[of], self.first[of], self.last[of]
        j0, j1 = (lo - a) // BLOCK, (hi - a) // BLOCK
        at, nth = _each(j1 - j0 + 1)
        start = a[at] + (j0[at] + nth) * BLOCK
        core = self.spell(start + BLOCK - 1, WIDTH - BLOCK + 1)
        return at, np.maximum(start, lo[at]), np.minimum(start + BLOCK - 1, hi[at]), core


def _each(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and running number of each of ``many`` things."""
    at = np.repeat(np.arange(len(many)), many)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _scan(docs: DataFrame, emit, schema: str) -> DataFrame:
    """Run ``emit(anchors, ids, hashes, offset)`` over each slice of ``docs`` (__id, __hash, __text) and collect its columns."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            ids, hashes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for whole in texts(batch.column(2)):
                cut = slice(whole.first, whole.first + len(whole))
                for part, offset in pieces(whole):
                    a = Anchors(part)
                    if len(a.key):
                        columns = emit(a, ids[cut], hashes[cut], offset)
                        if len(columns[0]):
                            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(run, schema)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__id, __hash, __text): id with 0 for null, a hash of id and text that tells rows apart, and the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("__id"), F.xxhash64(F.col(id_col).isNull(), F.col(id_col), text).alias("__hash"), text.alias("__text"))


class SuffixFamily:
    """Index levels under one folder. ``add`` a batch at a time; ``matches`` holds the keys that occurred twice."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.levels: list[tuple[int, str]] = []  # (batches, table), largest first
        self.found: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"drop table {name}")
        remove(self.spark, f"{self.folder}/{name}")

    def add(self, batch: DataFrame) -> None:
        """Index a batch of :func:`keyed` documents, scan it against all levels and merge levels of equal size."""
        def emit(a, ids, hashes, offset):
            key, n = np.unique(a.key, return_counts=True)  # repeats in a slice meet before the shuffle
            return [_signed(key), np.minimum(n, 2).astype(np.int32)]

        # n says once (1) or more often (2)
        rows = _scan(batch, emit, "key long, n int").repartition(self.buckets, "key").groupBy("key").agg(F.least(F.sum("n"), F.lit(2)).cast("int").alias("n"))
        new = self._write(rows)
        hits = [self.spark.table(new).filter("n > 1").select("key")]
        hits += [self.spark.table(new).join(self.spark.table(level), "key").select("key") for _, level in self.levels]
        for i, hit in enumerate(hits):
            self.found.append(f"{self.folder}/found-{len(self.found)}")
            hit.write.parquet(self.found[-1])
        self.levels.append((1, new))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels.pop(), self.levels.pop()
            both = self.spark.table(a).union(self.spark.table(b)).groupBy("key").agg(F.least(F.sum("n"), F.lit(2)).cast("int").alias("n"))
            self.levels.append((n + m, self._write(both)))
            self._drop(a)
            self._drop(b)

    def matches(self) -> DataFrame:
        return self.spark.read.schema("key long").parquet(*self.found)

    def close(self) -> None:
        for _, table in self.levels:
            self._drop(table)
        self.levels = []


def _bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for each value's leading bits, as many as MOST_BITS at most: whatever the rows, a bounded array on the driver."""
    bits = 16
    count = hashes.count()
    while 1 << bits < min(MOST_BITS, 16 * count):
        bits += 1
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = hashes.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast({} & 63 as int))".format(f"shiftrightunsigned({column}, {64 - bits})")).alias("bit")).groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toPandas()
    words = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def _marked(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = np.uint64(64 - int(np.log2(len(words) * 64)))
    place = hashes >> bits
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def repeated_spans(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """(__id, __hash, lo, hi): byte ranges of :func:`keyed` documents that repeated strings cover."""
    spark = docs.sparkSession
    own = keyed(docs, id_col, text_col)
    family = SuffixFamily(spark, folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for b in range(batches):
        family.add(own.filter(F.pmod(F.xxhash64("__hash"), F.lit(batches)) == b))
    marks = _bitmap(family.matches().distinct(), "key")
    family.close()
    release(spark)

    def locate(a, ids, hashes, offset):
        keep = np.flatnonzero(_marked(marks, a.key))
        lo, hi = a.first[keep], a.last[keep]
        return _rows(a, a.key[keep], a.stretch(lo, hi, a.anchor[keep]), a.row[keep], lo, hi, ids, hashes, offset)

    whole, looked = _compare(_scan(own, locate, _ROWS), f"{folder}/stretches")

    def cut(a, ids, hashes, offset):
        keep = np.flatnonzero(_marked(marks, a.key))
        keep = keep[_marked(looked, _place(hashes, a, a.row[keep], a.first[keep], offset))]
        at, lo, hi, core = a.blocks(keep)
        return keep[at], lo, hi, core

    def locate_blocks(a, ids, hashes, offset):
        at, lo, hi, core = cut(a, ids, hashes, offset)
        return _rows(a, core, a.stretch(lo, hi, a.anchor[at]), a.row[at], lo, hi, ids, hashes, offset)

    some, looked_blocks = _compare(_scan(own, locate_blocks, _ROWS), f"{folder}/blocks")

    def locate_strings(a, ids, hashes, offset):
        at, lo, hi, core = cut(a, ids, hashes, offset)
        keep = _marked(looked_blocks, _place(hashes, a, a.row[at], lo, offset))
        at, lo, hi, core = at[keep], lo[keep], hi[keep], core[keep]
        of, nth = _each(hi - lo + 1)
        p = lo[of] + nth
        return _rows(a, core[of], a.spell(p, WIDTH), a.row[at[of]], p, p, ids, hashes, offset)

    single, _ = _compare(_scan(own, locate_strings, _ROWS), f"{folder}/strings", deeper=False)
    return whole.union(some).union(single)


_ROWS = "key long, stretch long, __id long, __hash long, lo long, hi long, place long"


def _rows(a: Anchors, key, stretch, row, lo, hi, ids, hashes, offset) -> list:
    base = a.at[row] - offset
    return [_signed(key), _signed(stretch), ids[row], hashes[row], lo - base, hi - base, _signed(_place(hashes, a, row, lo, offset))]


def _compare(rows: DataFrame, folder: str, deeper: bool = True) -> tuple[DataFrame, np.ndarray | None]:
    """Byte ranges of rows whose (key, stretch) occurs twice, and a bitmap of one place of each stretch of mixed keys.

    Counts are summed where the rows are before they are shuffled, and the join back can be split where a key is hot.
    """
    located = settle(rows, f"{folder}/located")
    kinds = settle(located.groupBy("key", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("one")), f"{folder}/kinds")
    twice = kinds.filter("n > 1").select("key", "stretch")
    alike = settle(located.join(twice, ["key", "stretch"]).select("__id", "__hash", "lo", (F.col("hi") + WIDTH).alias("hi")), f"{folder}/alike")
    looked = None
    if deeper:
        several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("key")
        looked = _bitmap(kinds.join(several, "key").select("one"), "one")
    for done in ("located", "kinds"):
        remove(rows.sparkSession, f"{folder}/{done}")
    release(rows.sparkSession)
    return alike, looked


def _place(hashes: np.ndarray, a: Anchors, row: np.ndarray, lo: np.ndarray, offset: int) -> np.ndarray:
    """A hash of a row and a place in its text."""
    return mix(hashes[row].view(np.uint64) * _C2 + (lo - a.at[row] + offset).astype(np.uint64))


def _bytes_of(batch, text_col: str):
    """(text bytes, removed ranges, kept bytes) of each row; ranges are merged and do not touch."""
    column = batch.schema.get_field_index
    spans = batch.column(column("__spans")).to_pylist()
    for part in texts(batch.column(column(text_col))):
        for i in range(len(part)):
            raw, merged = part.row(i), []
            for s in sorted((s["lo"], s["hi"]) for s in spans[part.first + i] or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(s[1], merged[-1][1])
                else:
                    merged.append(list(s))
            ends, starts = [0, *(b for _, b in merged)], [*(a for a, _ in merged), len(raw)]
            yield raw, merged, b"".join(raw[a:b] for a, b in zip(ends, starts))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, folder: str | None = None) -> DataFrame:
    """``docs`` with ``__spans``, the (unmerged) repeated ranges of each row, at most one for each of its bytes; null for none.

    Rows that share id and text are repeats of each other and get the same ranges. Texts under WIDTH bytes have none.
    """
    folder = folder or scratch(docs.sparkSession, "suffixes")
    spans = repeated_spans(docs, folder, id_col, text_col, batches).groupBy("__id", "__hash").agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))
    spans = settle(spans, f"{folder}/spans")
    release(docs.sparkSession)
    named = keyed(docs, id_col, text_col).columns[:2]
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)), "__hash": F.xxhash64(F.col(id_col).isNull(), F.col(id_col), text)})
    return hashed.join(spans, named, "left").select(*docs.columns, "__spans")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """``docs`` without the bytes that repeated strings cover, all copies included.

    A character that loses some of its bytes goes as a whole. n_chars follows the text where it exists; null texts stay null.
    """
    found = with_spans(docs, id_col, text_col, batches)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            null = batch.column(at).is_null().to_pylist()
            now = [None if none else kept.decode("utf-8", "ignore") for none, (_, _, kept) in zip(null, _bytes_of(batch, text_col))]
            columns = list(batch.columns)
            columns[at] = pa.array(now, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = found.mapInArrow(run, found.schema).select(*docs.columns)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op9(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = with_spans(docs.select("doc_id", "text"), batches=batches)
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256", T.StringType())])

    def run(batches):
        for batch in batches:
            rows = [(len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()) for raw, merged, kept in _bytes_of(batch, "text")]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.select("doc_id", "text", "__spans").mapInArrow(run, schema)
