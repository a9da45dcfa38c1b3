"""Sharding over fixed virtual slots.

A record's hash puts it into one of a few thousand virtual slots for good. What moves between shards is slots: a versioned
map says which shard holds each, and rebalancing writes a new version that differs from the last only in the slots it moves.
Bytes and rows are summed per slot, so the driver sees a table of ``slots`` rows, whatever the input's size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, settle

SLOTS = 8192
SHARDS = 16
#: Rebalancing stops when the fullest and the emptiest shard differ by less than this share of the mean.
TOLERANCE = 0.0005


def with_slots(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__size`` (UTF-8 bytes plus one), ``__crc`` and ``__slot``.

    A null text has size 1 and the checksum of the empty text. The slot hashes id and checksum, so rows that share an id
    (or have none) still spread; rows equal in both share a slot.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.withColumn("__size", F.octet_length(text).cast("long") + 1)
        .withColumn("__crc", F.crc32(text.cast("binary")))
        .withColumn("__slot", F.pmod(F.xxhash64(F.col(id_col), F.col("__crc")), F.lit(slots)).cast("int"))
    )


def slot_totals(placed: DataFrame) -> pd.DataFrame:
    """Bytes and rows per virtual slot; at most one row a slot."""
    return placed.groupBy("__slot").agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows")).toPandas()


def even_map(slots: int = SLOTS, shards: int = SHARDS) -> np.ndarray:
    """Version 1: equal ranges of slots."""
    return np.arange(slots, dtype=np.int64) * shards // slots


def rebalance(held: np.ndarray, load: np.ndarray, shards: int = SHARDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """The map after moving slots from full to empty shards until their bytes are near equal.

    First every shard above the mean gives up small slots that fit into what it has too much, and the freed slots go,
    largest first, to the emptiest shard. Then single slots, or pairs that trade places, level the fullest and the emptiest.
    ``held`` may name fewer shards than ``shards``: new ones start empty and are filled.
    """
    held, load = held.copy(), load.astype(np.int64)
    total = np.bincount(held, weights=load, minlength=shards).astype(np.int64)
    mean = total.sum() / shards
    freed: list[int] = []
    for shard in range(shards):
        over = total[shard] - mean
        own = np.flatnonzero((held == shard) & (load > 0))
        for slot in own[np.argsort(-load[own], kind="stable")]:
            if 0 < load[slot] <= over:
                freed.append(int(slot))
                over -= load[slot]
                total[shard] -= load[slot]
    for slot in sorted(freed, key=lambda x: (-load[x], x)):
        to = int(np.argmin(total))
        held[slot] = to
        total[to] += load[slot]
    stuck = np.zeros(shards, bool)  # full shards that nothing more can leave, such as one very long text's
    for _ in range(64 * shards):
        top, low = int(np.argmax(np.where(stuck, -1, total))), int(np.argmin(total))
        gap = int(total[top] - total[low])
        if gap <= max(1, tolerance * mean):
            break
        mine, theirs = np.flatnonzero((held == top) & (load > 0)), np.flatnonzero((held == low) & (load > 0))
        # what leaves the fullest, less what comes back for it (0: nothing), nearest to half the gap
        back = np.concatenate([[0], np.sort(load[theirs])])
        ids = np.concatenate([[-1], theirs[np.argsort(load[theirs], kind="stable")]])
        at = np.clip(np.searchsorted(back, load[mine] - gap / 2), 0, len(back) - 1)
        at = np.concatenate([at, np.maximum(at - 1, 0)])
        give = np.concatenate([mine, mine])
        moved = load[give] - back[at]
        good = np.flatnonzero((moved > 0) & (moved < gap))
        if not len(good):
            stuck[top] = True
            continue
        best = good[np.argmin(np.abs(moved[good] - gap / 2))]
        held[give[best]] = low
        if ids[at[best]] >= 0:
            held[ids[at[best]]] = top
        total[top] -= moved[best]
        total[low] += moved[best]
    return held


def store_map(spark: SparkSession, folder: str, version: int, held: np.ndarray, totals: pd.DataFrame) -> DataFrame:
    """Write one version of the map (version, slot, shard, bytes, rows, first): ``first`` is the slot's place in its shard."""
    frame = pd.DataFrame({"version": version, "slot": np.arange(len(held)), "shard": held}).merge(totals.rename(columns={"__slot": "slot"}), on="slot", how="left").fillna({"bytes": 0, "rows": 0}).astype("int64")
    frame["first"] = frame.groupby("shard")["rows"].cumsum() - frame["rows"]
    schema = "version long, slot long, shard long, bytes long, rows long, first long"
    return settle(spark.createDataFrame(frame, schema), f"{folder}/version={version}").withColumn("version", F.lit(version))


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """All rows of ``docs`` with ``__size``, ``__crc``, ``__slot``, ``__shard`` and ``__place`` (gapless from 0 in the shard).

    Sizes per shard are near equal ("bytes"). The place is the slot's first place, from the map, plus the row's number in
    its slot, so no task sorts a whole shard. Empty input gives no rows. Equal rows get neighbouring places; an input column
    that already bears one of the new names is replaced.
    """
    spark = docs.sparkSession
    placed = with_slots(docs, slots, id_col, text_col)
    totals = slot_totals(placed.select("__slot", "__size"))
    load = np.zeros(slots, np.int64)
    load[totals["__slot"].to_numpy()] = totals["bytes"].to_numpy()
    folder = folder or scratch(spark, "slot-map")
    first = even_map(slots, shards)
    store_map(spark, folder, 1, first, totals)
    current = store_map(spark, folder, 2, rebalance(first, load, shards), totals)
    in_slot = F.row_number().over(Window.partitionBy("__slot").orderBy(id_col, "__crc"))
    # the map has one row a slot: a bounded side
    known = F.broadcast(current.select(F.col("slot").cast("int").alias("__slot"), F.col("shard").cast("int").alias("__shard"), F.col("first").alias("__first")))
    return placed.withColumn("__n", in_slot).join(known, "__slot").withColumn("__place", F.col("__first") + F.col("__n") - 1).drop("__n", "__first")


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder a shard, rows dealt by slot so that each shard is written by many tasks."""
    sharded.repartition("__shard", F.pmod("__slot", F.lit(64))).write.partitionBy("__shard").parquet(folder)


def op4(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    out = shard(docs.select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("__shard").alias("shard"),
        F.col("__place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("__slot").alias("virtual_slot"),
    )
