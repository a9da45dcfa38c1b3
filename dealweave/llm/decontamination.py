"""Benchmark decontamination.

Test items become windows of ten normalised words (an item of fewer words is one window). Their hashes are a sorted array
that is broadcast in blocks of a fixed size; each training text's word windows are hashed in numpy and looked up, and every
hit is verified against the window's words. Matched words can be reported, cut out, or made a reason to drop the document.
There is no shuffle unless the test set needs more than one block.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, WORD_BYTES, Texts, mix, scratch, settle, span_hashes, texts, word_bounds

WINDOW = 10
#: Bytes of item text in one broadcast block. A larger test set is scanned for in several passes, block by block.
BLOCK_BYTES = 16 << 20
#: A document with at least this share of its words in test passages is dropped by :func:`decontaminate`.
DROP_SHARE = 0.8
ADDED = ("n_words", "n_hit", "hit_items", "hit_spans")

_Q = np.uint64(0xD6E8FEB86659FD93)


class Windows:
    """The windows of some items: per length a sorted array of hashes, and the exact words with their items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = defaultdict(set)
        lengths: dict[int, set[bytes]] = defaultdict(set)
        for name, text in items:
            data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends = word_bounds(WORD_BYTES[data], np.array([0, len(data)]))
            words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                key = b" ".join(words[i:i + size])
                lengths[size].add(key)
                owners[key] |= {name} - {None}
        self.owners = dict(owners)
        self.hashes = {}
        for size, keys in sorted(lengths.items()):
            data = np.frombuffer(b" ".join(sorted(keys)), np.uint8)
            starts, ends = word_bounds(WORD_BYTES[data], np.array([0, len(data)]))
            self.hashes[size] = np.unique(rolling(span_hashes(data, starts, ends), size)[::size])


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` neighbouring word hashes."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _Q + words[i:i + n]
    return mix(out)


def _marks(hashes: np.ndarray) -> np.ndarray:
    """A bit per hash prefix, which tells most windows apart from all of ``hashes``."""
    marks = np.zeros(1 << 16, bool)
    marks[(hashes >> np.uint64(48)).astype(np.int64)] = True
    return marks


def hits(part: Texts, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, set[str]]]:
    """Word starts, word ends, the row of each word, whether it is hit, and the items found per row."""
    data = LOWER[part.data]
    starts, ends = word_bounds(WORD_BYTES[data], part.at)
    row = np.searchsorted(part.at, starts, side="right") - 1
    words = span_hashes(data, starts, ends)
    edge = np.zeros(len(starts) + 1, np.int64)
    found: dict[int, set[str]] = defaultdict(set)
    for size, known in windows.hashes.items():
        if len(starts) < size:
            continue
        got = rolling(words, size)
        maybe = np.flatnonzero(_marks(known)[(got >> np.uint64(48)).astype(np.int64)])
        maybe = maybe[row[maybe] == row[maybe + size - 1]]
        at = np.minimum(np.searchsorted(known, got[maybe]), len(known) - 1)
        for i in maybe[known[at] == got[maybe]]:
            key = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i:i + size], ends[i:i + size]))
            if key in windows.owners:
                edge[i] += 1
                edge[i + size] -= 1
                found[row[i]] |= windows.owners[key]
    return starts, ends, row, np.cumsum(edge[:-1]) > 0, found


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_BYTES):
    """Lists of (id as text, text) of at most ``most`` bytes each (one item at least); one block for an empty table.

    Only one block is on the driver at a time.
    """
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col))
    block, size, given = [], 0, False
    for name, text in rows.toLocalIterator():
        cost = len((text or "").encode())
        if block and size + cost > most:
            yield block
            block, size, given = [], 0, True
        block.append((name, text))
        size += cost
    if block or not given:
        yield block


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def scan(docs: DataFrame, items: list, text_col: str = "text", window: int = WINDOW, drop_share: float | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted) and hit_spans: [start, end) in bytes, from one block of items.

    Columns of those names in ``docs`` are replaced. A null or wordless text has no words and no hits; rows keep no state, so
    repeated rows give repeated results. With ``drop_share`` the same pass cuts the spans out of the text and drops the rows
    with at least that share of their words hit; the columns are then those of ``docs``.
    """
    windows = Windows(items, window)
    docs = docs.drop(*ADDED)
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("hit_spans", _SPAN)]
    schema = docs.schema if drop_share is not None else T.StructType([*docs.schema, *added])

    def run(batches):
        for batch in batches:
            n_words, n_hit, names, spans = [], [], [], []
            for part in texts(batch.column(batch.schema.get_field_index(text_col))):
                starts, ends, row, hit, found = hits(part, windows)
                n_words.append(np.bincount(row, minlength=len(part)))
                n_hit.append(np.bincount(row[hit], minlength=len(part)))
                own: list[list] = [[] for _ in range(len(part))]
                turn = np.flatnonzero(hit)
                first = turn[np.r_[True, (np.diff(turn) > 1) | (np.diff(row[turn]) > 0)]] if len(turn) else turn
                last = turn[np.r_[(np.diff(turn) > 1) | (np.diff(row[turn]) > 0), True]] if len(turn) else turn
                for a, b in zip(first, last):
                    base = part.at[row[a]]
                    own[row[a]].append({"start": int(starts[a] - base), "end": int(ends[b] - base)})
                spans += own
                names += [sorted(found.get(i, ())) for i in range(len(part))]
            whole = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            if drop_share is not None:
                hit, words = whole(n_hit), whole(n_words)
                yield _cut(batch, text_col, spans).filter(pa.array((hit == 0) | (hit < drop_share * words)))
                continue
            added = [pa.array(whole(n_words), pa.int64()), pa.array(whole(n_hit), pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *ADDED])

    return docs.mapInArrow(run, schema)


def match(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As :func:`scan`, against a whole test set of any size.

    A set of more than one block is looked for in one pass after another, each written to the shared folder; hit words are
    counted again from the merged spans, which begin and end with words.
    """
    blocks = item_blocks(benchmark, most=block_bytes)
    out = scan(docs, next(blocks), text_col, window)
    base = [c for c in docs.columns if c not in ADDED]
    for block in blocks:
        kept = [F.col("hit_items").alias("__items"), F.col("hit_spans").alias("__spans")]
        before = settle(out.select(*base, *kept), scratch(docs.sparkSession, "decontaminate"))
        now = scan(before, block, text_col, window)
        items = F.array_sort(F.array_union("__items", "hit_items"))
        out = now.select(*base, "n_words", "n_hit", items.alias("hit_items"), F.concat("__spans", "hit_spans").alias("hit_spans"))
        out = _recount(out, text_col)
    return out


def _recount(df: DataFrame, text_col: str) -> DataFrame:
    """Merge overlapping spans and count the words in them."""
    def run(batches):
        for batch in batches:
            field = batch.schema.get_field_index
            text, spans, counts = batch.column(field(text_col)).to_pylist(), [], []
            for t, own in zip(text, batch.column(field("hit_spans")).to_pylist()):
                merged: list[dict] = []
                for s in sorted(own, key=lambda x: x["start"]):
                    if merged and s["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(s["end"], merged[-1]["end"])
                    else:
                        merged.append(dict(s))
                raw = np.frombuffer((t or "").encode(), np.uint8)
                counts.append(sum(len(word_bounds(WORD_BYTES[raw[s["start"]:s["end"]]], np.array([0, s["end"] - s["start"]]))[0]) for s in merged))
                spans.append(merged)
            columns = list(batch.columns)
            columns[field("n_hit")] = pa.array(counts, pa.int64())
            columns[field("hit_spans")] = pa.array(spans, columns[field("hit_spans")].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "spans", text_col: str = "text", drop_share: float = DROP_SHARE) -> DataFrame:
    """``docs`` without test passages, in its own columns.

    "spans" cuts the hit words, and what stands between hit neighbours, out of the text, and drops documents with at least
    ``drop_share`` of their words hit; "documents" drops every document with a hit. n_chars follows the text where it exists.
    """
    if action not in ("spans", "documents"):
        raise ValueError(f"no such action: {action}")
    clash = [c for c in docs.columns if c in ADDED]
    if clash:
        plain = decontaminate(docs.withColumnsRenamed({c: f"__own_{c}" for c in clash}), benchmark, action, text_col, drop_share)
        return plain.withColumnsRenamed({f"__own_{c}": c for c in clash})
    blocks = item_blocks(benchmark)
    first = next(blocks)
    if action == "spans" and next(blocks, None) is None:
        return _counted(scan(docs, first, text_col, drop_share=drop_share), docs, text_col)
    found = match(docs, benchmark, text_col)
    if action == "documents":
        return found.filter("n_hit = 0").select(*docs.columns)
    kept = found.filter((F.col("n_hit") == 0) | (F.col("n_hit") < drop_share * F.col("n_words")))

    def run(batches):
        for batch in batches:
            yield _cut(batch, text_col, batch.column(batch.schema.get_field_index("hit_spans")).to_pylist())

    return _counted(kept.mapInArrow(run, kept.schema).select(*docs.columns), docs, text_col)


def _cut(batch: pa.RecordBatch, text_col: str, spans: list) -> pa.RecordBatch:
    """The batch with the spans cut out of its texts."""
    at = batch.schema.get_field_index(text_col)
    column = batch.column(at)
    now = column.to_pylist()
    for i, own in enumerate(spans):
        if own:
            raw = now[i].encode()
            ends = [0, *(s["end"] for s in own)]
            starts = [*(s["start"] for s in own), len(raw)]
            now[i] = b"".join(raw[a:b] for a, b in zip(ends, starts)).decode()
    return pa.RecordBatch.from_arrays([pa.array(now, column.type) if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)


def _counted(cut: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    return cut.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def op1(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    out = match(docs.select("doc_id", "text"), benchmark)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def digest(names: list[str]) -> str:
    """items_sha256 of some item ids."""
    return hashlib.sha256(",".join(sorted(set(names))).encode()).hexdigest()
