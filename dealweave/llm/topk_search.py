"""Exact top-k by inner product, a block of documents at a time.

Vectors are ordered by their nearest pivot and cut into blocks of neighbouring rows. A block keeps its vectors as a forward
index and, for every component ("term"), its largest and smallest value. The sum of the larger products of these with a
query's components bounds every score in the block. Each query takes a group's blocks by falling bound and stops at the
first whose bound is below its k-th score. Queries come in blocks too; a query block meets each group of document blocks in
one row of an equi-join on the group's number, so neither side is ever in one place as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import first_by_hash, scratch, settle

SCALE = 1024
TOP = 10
BLOCK = 256  # vectors whose components share bounds
GROUP = 8192  # vectors of one forward-index row
QUERY_BLOCK = 512
PIVOTS = 64
MOST_LANES = 1024  # copies of the query blocks that the join sends out, and its keys
#: Vectors (by smallest hash of the id) from which a first lower bound of each query's k-th score is taken.
SEED_VECTORS = 4096

_RAW = "vec_id long, parts array<double>"


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, parts) with floor(1024 x) of each component, without null vectors, components or ids, or ones not finite."""
    parts = F.col(vec_col).cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(parts, lambda x: F.floor(x * SCALE).cast("double"))
    return vectors.filter(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).filter(~bad).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("parts"))


def _matrix(column: pd.Series | list, width: int | None = None) -> np.ndarray:
    """Rows of components, the shorter filled up with zeros."""
    rows = [np.asarray(v, dtype=np.float64) for v in column]
    width = max([width or 0, *(len(v) for v in rows)])
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _pack(m: np.ndarray) -> bytes:
    return np.ascontiguousarray(m, dtype=np.float64).tobytes()


def _unpack(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.float64).reshape(rows, -1)


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole-numbered rows, as int64 (limits of the type, where they would leave it)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = np.abs(a).max() * np.abs(b).max() * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], dtype=object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _groups(batches):
    """Rows in order -> rows of up to GROUP vectors: ids, vectors, and the bounds of each BLOCK of them."""
    ids: list[int] = []
    rows: list = []

    def out():
        m = _matrix(rows)
        cuts = np.arange(0, len(ids), BLOCK)
        return pd.DataFrame([{
            "n": len(ids), "ids": np.array(ids, np.int64).tobytes(), "vectors": _pack(m),
            "most": _pack(np.maximum.reduceat(m, cuts) if m.size else m[cuts]), "least": _pack(np.minimum.reduceat(m, cuts) if m.size else m[cuts]),
        }])

    for pdf in batches:
        for i, v in zip(pdf["vec_id"], pdf["parts"]):
            ids.append(i)
            rows.append(v)
            if len(ids) == GROUP:
                yield out()
                ids, rows = [], []
    if ids:
        yield out()


def forward_index(rows: DataFrame, pivots: np.ndarray, partitions: int) -> DataFrame:
    """Groups of document blocks in pivot order. Ranges of (pivot, id) split a pivot that holds many rows."""
    def nearest(batches):
        for pdf in batches:
            m = _matrix(pdf["parts"], pivots.shape[1] if pivots.size else None)
            own = _wide(pivots, m.shape[1]) if pivots.size else np.zeros((1, m.shape[1]))
            scored = m @ own.T - (own**2).sum(axis=1) / 2
            yield pdf.assign(pivot=np.argmax(scored, axis=1).astype(np.int32))

    marked = rows.mapInPandas(nearest, f"{_RAW}, pivot int")
    ranged = marked.repartitionByRange(partitions, "pivot", "vec_id").sortWithinPartitions("pivot", "vec_id")
    return ranged.mapInPandas(_groups, "n int, ids binary, vectors binary, most binary, least binary")


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.lexsort((ids, -scores))[:top]
    return ids[keep], scores[keep]


def _scan(q_id: int, q: np.ndarray, floor: int | None, ids, docs, most, least, top: int):
    """One query against one group of blocks: by falling bound, until a bound is below the k-th score."""
    bound = np.maximum(q * most, q * least).sum(axis=1)
    near, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in np.argsort(-bound, kind="stable"):
        kth = max(score[-1] if len(score) == top else -np.inf, -np.inf if floor is None else floor)
        if bound[b] < kth:
            break
        cut = slice(b * BLOCK, (b + 1) * BLOCK)
        got = products(q[None, :], docs[cut])[0]
        ok = (ids[cut] != q_id) & (got >= kth if np.isfinite(kth) else True)
        near, score = _best(np.concatenate([near, ids[cut][ok]]), np.concatenate([score, got[ok]]), top)
    return near, score


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` highest inner products with rows of another id.

    Ties go to the smaller id; a query with fewer candidates gets them all. Shorter vectors count as filled up with zeros. A
    repeated id is repeated in the results. Rows that :func:`valid` leaves out take no part; empty tables give no rows.
    """
    spark = vectors.sparkSession
    rows = valid(vectors, id_col, vec_col)
    asked = valid(queries, id_col, vec_col)
    # bounded samples by hash of the id: SEED_VECTORS rows reach the driver, whatever the input's size
    seed = first_by_hash(rows, "vec_id", SEED_VECTORS).toPandas()
    seed_ids, seeds = seed["vec_id"].to_numpy(np.int64), _matrix(seed["parts"])
    parts = max(1, -(-rows.select("vec_id").count() // GROUP))
    lanes = min(MOST_LANES, parts)
    folder = scratch(spark, "topk")
    index = forward_index(rows, seeds[:PIVOTS], parts).withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(lanes)))
    groups = settle(index, f"{folder}/groups")

    def pack_queries(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), QUERY_BLOCK):
                part = pdf.iloc[lo:lo + QUERY_BLOCK]
                m = _matrix(part["parts"], seeds.shape[1] if seeds.size else None)
                floors = []
                own = products(m, _wide(seeds, m.shape[1])) if len(seeds) else np.zeros((len(part), 0), np.int64)
                for q, got in zip(part["vec_id"], own):
                    got = np.sort(got[seed_ids != q])
                    floors.append(int(got[-top]) if len(got) >= top else -(2**63))
                yield pd.DataFrame([{"q_n": len(part), "q_ids": part["vec_id"].to_numpy(np.int64).tobytes(), "q_vectors": _pack(m), "floors": np.array(floors, np.int64).tobytes()}])

    asked = asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK)))
    blocks = settle(asked.mapInPandas(pack_queries, "q_n int, q_ids binary, q_vectors binary, floors binary"), f"{folder}/queries")
    # a copy of each query block goes to every lane of groups and meets the lane's groups there, one row at a time; the copies
    # are shuffled, since a plan made from the size of the blocks' files would send all of them through the driver
    sent = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).hint("merge").join(groups, "lane")

    def score(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                ids, docs, qs = np.frombuffer(r.ids, np.int64), _unpack(r.vectors, r.n), _unpack(r.q_vectors, r.q_n)
                width = max(docs.shape[1], qs.shape[1])
                most, least = _unpack(r.most, -(-r.n // BLOCK)), _unpack(r.least, -(-r.n // BLOCK))
                docs, qs, most, least = (_wide(x, width) for x in (docs, qs, most, least))
                out = []
                for q_id, q, floor in zip(np.frombuffer(r.q_ids, np.int64), qs, np.frombuffer(r.floors, np.int64)):
                    near, got = _scan(q_id, q, None if floor == -(2**63) else int(floor), ids, docs, most, least, top)
                    out.append(pd.DataFrame({"query_id": q_id, "vec_id": near, "score": got}))
                yield pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = sent.mapInPandas(score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
