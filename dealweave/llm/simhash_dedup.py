"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints are 64-bit majorities of shingle hashes. The anchors are the words of a perfect Hamming code on 63 bits, with
the last bit free: every point is within 1 bit of an anchor. If two fingerprints differ in at most 2 bits, some point lies
within 1 bit of both, and that point's anchor within 1 + 1 = 2 bits of both. So each distinct fingerprint goes to its (2 or
33) anchors within 2 bits, and every link is found at a common anchor. An anchor has at most 2,081 points within 2 bits, which
bounds each group whatever the data; fingerprints of copies count once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import remove, scratch, settle, texts

SHINGLE, SEED, DISTANCE = 3, 42, 2
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes) -> list[int]:
    """XXH64 of each shingle of the lower-cased words, repeats included; the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return [digest(line[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1:].tolist())]


def majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per row the 64 bits that are set in over half of its hashes (zero for none). Bits are summed eight lanes at a time."""
    out = np.zeros(len(counts), np.uint64)
    if not len(hashes):
        return out
    # no more than 255 hashes to a sum, so that a lane of 8 bits holds it
    pieces = -(-counts // 255)
    row = np.repeat(np.arange(len(counts)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = (np.cumsum(counts) - counts)[row] + 255 * nth
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, cuts)
        for lane in range(8):
            ones = np.bincount(row, weights=((lanes >> np.uint64(8 * lane)) & np.uint64(255)).astype(float), minlength=len(counts))
            out |= (2 * ones > counts).astype(np.uint64) << np.uint64(8 * lane + shift)
    return out


def fingerprints(docs: DataFrame, column: str = "__fp", text_col: str = "text") -> DataFrame:
    """``docs`` with the fingerprint as a signed long; zero for a text without words."""
    schema = T.StructType([*docs.schema, T.StructField(column, T.LongType())])

    def run(batches):
        for batch in batches:
            got = []
            for part in texts(batch.column(batch.schema.get_field_index(text_col))):
                own = [shingle_hashes(part.row(i)) for i in range(len(part))]
                counts = np.fromiter(map(len, own), np.int64, len(own))
                flat = np.fromiter((h for hs in own for h in hs), np.uint64, int(counts.sum()))
                got.append(majorities(flat, counts).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got) if got else [], pa.int64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


#: For each syndrome of the 63-bit code, the flips of at most 2 of 64 bits that lead to an anchor.
def _flips() -> list[list[int]]:
    signed = lambda bits: int(np.uint64(sum(1 << b for b in bits)).astype(np.int64))
    table = []
    for s in range(64):  # bit p - 1 is position p; the flipped positions' XOR must be s; bit 63 is free
        near = [()] if s == 0 else [(s - 1,), *((p - 1, (p ^ s) - 1) for p in range(1, 64) if p < p ^ s)]
        table.append([signed(x) for f in near for x in ((f, (*f, 63)) if len(f) < DISTANCE else (f,))])
    return table


FLIPS = _flips()
_CHECKS = [int(np.uint64(sum(1 << (p - 1) for p in range(1, 64) if p >> j & 1)).astype(np.int64)) for j in range(6)]


def anchored(points: DataFrame) -> DataFrame:
    """(fp, anchor) for each anchor within 2 bits of each fingerprint."""
    syndrome = sum((F.bit_count(F.col("fp").bitwiseAND(F.lit(m))).bitwiseAND(F.lit(1)) * (1 << j) for j, m in enumerate(_CHECKS)), F.lit(0))
    table = F.array(*(F.array(*(F.lit(x).cast("long") for x in flips)) for flips in FLIPS))
    return points.select("fp", F.explode(F.element_at(table, syndrome.cast("int") + 1)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("anchor"))


def _star(values: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges that join what is linked within a group: each fingerprint and its component's least in the group."""
    label = np.arange(len(values))
    bits = values.view(np.uint64)
    for i in range(len(values)):
        near = np.bitwise_count(bits ^ bits[i]) <= most
        low = label[near]
        label[np.isin(label, low)] = low.min()
    least = {}
    for v, k in zip(values.tolist(), label.tolist()):
        least[k] = min(v, least.get(k, v))
    return [(v, least[k]) for v, k in zip(values.tolist(), label.tolist()) if v != least[k]]


def links(points: DataFrame, most: int = DISTANCE) -> DataFrame:
    """Distinct (a, b), a > b: enough links between distinct fingerprints ``fp`` to join all that differ in ``most`` bits at most."""
    if most > DISTANCE:
        raise ValueError("anchors cover two bits at most")
    groups = anchored(points).groupBy("anchor").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")

    def run(batches):
        for pdf in batches:
            pairs = [e for fps in pdf["fps"] for e in _star(np.asarray(fps, np.int64), most)]
            yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64").drop_duplicates()

    return groups.mapInPandas(run, "a long, b long").distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (a, b) reaches.

    Alternates large-star and small-star steps until a round changes nothing; each round is written to ``folder``.
    """
    spark = edges.sparkSession
    turn, now = 0, settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/0")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        turn += 1
        after = settle(small, f"{folder}/{turn}")
        same = after.exceptAll(now).isEmpty() and now.exceptAll(after).isEmpty()
        remove(spark, f"{folder}/{turn - 1}")
        now = after
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = DISTANCE) -> DataFrame:
    """(id, __key, __fp, __component, __root) for every row: the smallest id reachable by links of at most ``most`` differing bits.

    Empty and null texts have fingerprint zero and link like any other. A component without any id has a null one; ``__root``,
    its least fingerprint, names it all the same. ``__key`` hashes text and id. Copies share a fingerprint, so they meet as
    one point. Ids and hashes, not texts, are shuffled.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "simhash")
    own = docs.select(id_col, text_col, _key(id_col, text_col).alias("__key"))
    marked = settle(fingerprints(own, text_col=text_col).select(id_col, "__key", "__fp"), f"{folder}/fingerprints")
    points = settle(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(id_col).alias("low")), f"{folder}/points")
    root = components(links(points.select("fp"), most), f"{folder}/components")
    rooted = points.join(root, points.fp == root.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("__component"))
    known = settle(rooted.join(least, "root").select(F.col("fp").alias("__fp"), "__component", F.col("root").alias("__root")), f"{folder}/known")
    return marked.join(known, "__fp").select(id_col, "__key", "__fp", "__component", "__root")


def _key(id_col: str, text_col: str):
    """Tells rows apart that share an id."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(text_col).isNull(), F.col(text_col))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: one of its smallest id, or any one where it has no id.

    Which of several rows of that id stays is settled by a hash of the text; of rows equal in both, the first seen stays.
    """
    found = near_duplicates(docs, id_col, text_col)
    first = found.groupBy("__root").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col), F.lit(0)).alias("__id"), F.col("__key"))).alias("k"))
    keep = first.select("k.__id", "k.__key")
    keyed = docs.withColumns({"__id": F.coalesce(F.col(id_col), F.lit(0)), "__key": _key(id_col, text_col)})
    one = F.row_number().over(Window.partitionBy("__id", "__key").orderBy(F.lit(0)))
    return keyed.join(keep, ["__id", "__key"], "left_semi").withColumn("__n", one).filter("__n = 1").drop("__n", "__id", "__key")


def op10(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), F.col("__component").alias("component_id"))
