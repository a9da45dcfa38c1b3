"""Language identification of mixed-language text.

Code points are cut into words of letters. A word's script, from ranges of code points, narrows the languages that can own
it; each of these scores the word by the log-probabilities of its character trigrams; and a Viterbi pass with a penalty for
switching labels the words, so that a text becomes spans of one language each. The pass runs over all texts of a slice side
by side, one word of each at a step. Scoring is one pass over the table without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, texts, word_bounds
from .labelled import remainder

#: The bound on training documents per language; their trigram counts are what reaches the driver.
SAMPLE_PER_LANGUAGE = 1500
BUCKETS = 1 << 16
SWITCH = 12.0  # log-probability that a change of language must win
UNKNOWN = "und"
MODULUS, HELD_OUT = 5, 0
#: A language may own words of a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Larger samples are joined by shuffle instead of broadcast.
BROADCAST_ROWS = 100_000
SALTS = 128

# First code points of script ranges (fixed values of the Unicode standard), by script number; 0 takes what has no range.
SCRIPTS = ["other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "bengali", "tamil", "thai", "georgian", "hangul", "kana", "han"]
_RANGES = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x02B0, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6),
    (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0B80, 9), (0x0C00, 0), (0x0E00, 10), (0x0E80, 0), (0x10A0, 11), (0x1100, 12), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
    (0x3040, 13), (0x3100, 0), (0x3400, 14), (0xA000, 0), (0xAC00, 12), (0xD7B0, 0), (0xF900, 14), (0xFB00, 0), (0xFF66, 13), (0xFFA0, 0), (0x20000, 14), (0x32000, 0),
]
_FIRST, _SCRIPT = np.array([a for a, _ in _RANGES]), np.array([b for _, b in _RANGES])
_PLANE = 1 << 16
_tables: dict[str, np.ndarray] = {}


def _letters_and_lower() -> tuple[np.ndarray, np.ndarray]:
    """For the first 65,536 code points: is it a letter; its lower case, where that is one code point."""
    if not _tables:
        chars = [chr(i) for i in range(_PLANE)]
        _tables["letter"] = np.array([c.isalpha() for c in chars])
        _tables["lower"] = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(chars)], dtype=np.uint32)
    return _tables["letter"], _tables["lower"]


@dataclass
class Words:
    row: np.ndarray
    start: np.ndarray  # in code points of its row
    end: np.ndarray
    script: np.ndarray
    bucket: np.ndarray  # trigram bucket of each letter
    first: np.ndarray  # index of each word's first letter in ``bucket``


def words(part: Texts) -> Words:
    raw = part.data.tobytes()
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.r_[0, np.cumsum((part.data & 0xC0) != 0x80)]
    at = heads[part.at]
    letter, lower = _letters_and_lower()
    low = np.minimum(points, _PLANE - 1)
    inside = letter[low]
    far = np.flatnonzero(points >= _PLANE)
    if len(far):
        kinds, back = np.unique(points[far], return_inverse=True)
        inside[far] = np.array([chr(int(c)).isalpha() for c in kinds])[back]
    starts, ends = word_bounds(inside, at)
    row = np.searchsorted(at, starts, side="right") - 1
    script = _SCRIPT[np.searchsorted(_FIRST, points[starts], side="right") - 1]
    place = np.flatnonzero(inside)
    c = np.where(points[place] < _PLANE, lower[low[place]], points[place]).astype(np.uint32)
    size = ends - starts
    first = np.cumsum(size) - size
    before, after = np.r_[np.uint32(0), c[:-1]], np.r_[c[1:], np.uint32(0)]
    if len(first):
        before[first] = 0
        after[first + size - 1] = 0
    h = (before * np.uint32(0x9E3779B1)) ^ (c * np.uint32(0x85EBCA6B)) ^ (after * np.uint32(0xC2B2AE35))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return Words(row, starts - at[row], ends - at[row], script, (h >> np.uint32(16)).astype(np.int64), first)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages, log-probabilities
    allowed: np.ndarray  # scripts x languages


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Trigram tables from up to ``per_language`` documents of each non-null lang, the first by a hash of the id.

    Documents of the held-out fifth, or without id, teach nothing. The sample is chosen by ids alone and then fetched.
    """
    spark = docs.sparkSession
    able = docs.filter(F.col("lang").isNotNull() & (remainder("doc_id", MODULUS) != HELD_OUT))
    # first among equals in a salt, so that what one language's window sorts is SALTS x per_language ids at most
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    salted = able.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SALTS)).alias("salt"))
    few = salted.withColumn("n", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("n") <= per_language)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    chosen = few.withColumn("n", turn).filter(F.col("n") <= per_language).select("doc_id", F.col("lang").alias("own")).distinct().toPandas()
    if not len(chosen):
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    ids = spark.createDataFrame(chosen)
    seen = able.select("doc_id", "lang", "text").join(F.broadcast(ids) if len(chosen) <= BROADCAST_ROWS else ids, "doc_id").filter("lang = own").select("lang", "text")

    def run(batches):
        for batch in batches:
            names = np.asarray(batch.column(0).to_pylist(), object)
            for part in texts(batch.column(1)):
                w = words(part)
                own = names[part.first:part.first + len(part)]
                sizes = w.end - w.start
                for lang in set(own):
                    mine = (own == lang)[w.row]
                    keys = np.r_[w.bucket[np.repeat(mine, sizes)], BUCKETS + np.repeat(w.script[mine], sizes[mine])]
                    bucket, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(bucket, pa.int64()), pa.array(n, pa.int64())], names=["lang", "bucket", "n"])

    counts = seen.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(chosen["own"]))
    table = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    table[counts["bucket"], np.searchsorted(languages, counts["lang"])] = counts["n"]
    scripts, table = table[BUCKETS:], table[:BUCKETS]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word: ``scores`` is words x labels, ``counts`` the words of each text, texts in a row."""
    order = np.argsort(-counts, kind="stable")
    base, many = (np.cumsum(counts) - counts)[order], counts[order]
    steps = int(many[0]) if len(many) else 0
    active = len(many) - np.searchsorted(many[::-1], np.arange(steps), side="right")  # texts with more than t words
    label = np.zeros(len(scores), np.int16)
    stays, jump = np.ones(scores.shape, bool), np.zeros(len(scores), np.int16)
    best = np.zeros((len(counts), scores.shape[1]), np.float64)
    for t in range(steps):
        k = active[t]
        at = base[:k] + t
        own = best[:k]
        if t:
            top = own.argmax(axis=1)
            least = own[np.arange(k), top] - switch
            stays[at] = own >= least[:, None]
            jump[at] = top
            own = np.maximum(own, least[:, None])
        best[:k] = own + scores[at]
    now = np.zeros(len(counts), np.int64)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = base[:k] + t
        ended = many[:k] == t + 1
        now[:k][ended] = best[:k][ended].argmax(axis=1)
        label[at] = now[:k]
        now[:k] = np.where(stays[at, now[:k]], now[:k], jump[at])
    return label


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
ADDED = ("lang_pred", "score", "lang_spans")


def label(docs: DataFrame, model: Model, text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """``docs`` with lang_pred, score and lang_spans; columns of those names are replaced.

    lang_pred is the language of most letters, the first by name among equals, and score its share of the letters.
    lang_spans are [start, end, lang) in code points, from a span's first word to its last. A text that is null or has no
    letter, or a model without languages, gives "und", 0 and no spans.
    """
    docs = docs.drop(*ADDED)
    schema = T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_spans", _SPANS)])
    names, count = np.array([*model.languages, UNKNOWN], object), len(model.languages)
    most = (2 << 20) * 8 // max(8, count)  # the score array is letters x languages

    def run(batches):
        for batch in batches:
            pred, score, spans = [], [], []
            for part in texts(batch.column(batch.schema.get_field_index(text_col)), most):
                w = words(part) if count else None
                letters = np.zeros((len(part), count + 1))
                own: list[list] = [[] for _ in range(len(part))]
                if count and len(w.row):
                    s = np.add.reduceat(model.table[w.bucket], w.first)
                    s = np.where(model.allowed[w.script], s, np.float32(-1e6))
                    got = viterbi(s, np.bincount(w.row, minlength=len(part)), switch)
                    np.add.at(letters, (w.row, got), w.end - w.start)
                    edge = np.flatnonzero(np.r_[True, (w.row[1:] != w.row[:-1]) | (got[1:] != got[:-1])])
                    for a, b in zip(edge, np.r_[edge[1:], len(got)] - 1):
                        own[w.row[a]].append({"start": int(w.start[a]), "end": int(w.end[b]), "lang": names[got[a]]})
                total = letters.sum(axis=1)
                top = np.where(total > 0, letters.argmax(axis=1), count)
                pred += names[top].tolist()
                score.append(letters[np.arange(len(part)), top] / np.maximum(total, 1))
                spans += own
            added = [pa.array(pred, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64()), pa.array(spans, _SPANS_ARROW)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *ADDED])

    return docs.mapInArrow(run, schema)


def op2(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans of every document."""
    out = label(docs.select("doc_id", "text"), train(docs))
    held = F.coalesce(remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("lang_spans").cast("long").alias("n_spans"))
