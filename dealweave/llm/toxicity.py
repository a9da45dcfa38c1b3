"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, reported speech, other. Which words insult, and how much, is learned
from labelled documents (whole words and word beginnings, weighted by log-odds); the closed classes are short fixed lists.
Transducers for negation and reported speech rewrite the insult and threat symbols in their reach, and a scorer that knows
whether a target was named sums up weights. The three are composed once into one machine, which runs over each clause that
holds an insult or a threat. A logistic curve, fitted to other labelled documents, turns clause weights into a score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, WORD_BYTES, Texts, mix, span_hashes, texts, word_bounds
from .labelled import logistic, remainder, sampled_documents, sigmoid

#: The bound on labelled rows: half teach the lexicon, half the curve.
SAMPLE_ROWS = 16_000
#: The most entries, and the least documents and log-odds of one.
LEXICON, LEAST_DOCS, LEAST_ODDS = 5000, 4, 2.5
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that can be an entry
PREDICT = 0.7
MODULUS, HELD_OUT = 3, 1

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "I", "T", "G", "N", "R", "O"
# Closed word classes in English, German, French and Spanish.
CLOSED = {
    TARGET: ["you", "your", "he", "she", "they", "them", "those", "people", "du", "ihr", "euch", "sie", "tu", "vous", "ils", "elles", "usted", "ustedes", "ellos", "ellas"],
    NEGATION: ["not", "no", "never", "isn", "aren", "wasn", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "jamás", "tampoco"],
    REPORT: ["said", "says", "called", "calls", "wrote", "quoted", "alleged", "claimed", "sagte", "schrieb", "nannte", "dit", "écrit", "dijo", "escribió", "llamó"],
    THREAT: ["kill", "murder", "hurt", "beat", "stab", "shoot", "töten", "umbringen", "schlagen", "tuer", "frapper", "matar", "golpear"],
}
THREAT_WEIGHT = 4.0
_BREAK = np.array([chr(b) in ".!?;:\n" for b in range(256)])


@dataclass
class Machine:
    """A deterministic weighted transducer. ``arcs[state][symbol]`` is (next state, output symbol, factor)."""

    arcs: list[dict[str, tuple[int, str, float]]]
    final: list[float] = field(default_factory=list)  # factor on the sum, by last state

    def alphabet(self) -> set[str]:
        return {s for state in self.arcs for s in state}


def compose(a: Machine, b: Machine) -> Machine:
    """The machine that feeds a's output to b: factors multiply, states are the pairs that can be reached."""
    number, arcs, final, todo = {(0, 0): 0}, [{}], [], [(0, 0)]
    for p, q in todo:  # grows while it is walked
        here = {}
        for symbol, (p2, out, f) in a.arcs[p].items():
            q2, out2, g = b.arcs[q][out]
            if (p2, q2) not in number:
                number[p2, q2] = len(number)
                arcs.append({})
                todo.append((p2, q2))
            here[symbol] = (number[p2, q2], out2, f * g)
        arcs[number[p, q]] = here
        final.append((a.final[p] if a.final else 1.0) * (b.final[q] if b.final else 1.0))
    return Machine(arcs, final)


def negation(reach: int = 3, factor: float = 0.25) -> Machine:
    """An insult or threat within ``reach`` words after a negation loses weight."""
    arcs = []
    for left in range(reach + 1):
        after = max(0, left - 1)
        arcs.append({s: (after, s, factor if left and s in (INSULT, THREAT) else 1.0) for s in (INSULT, THREAT, TARGET, REPORT, OTHER)} | {NEGATION: (reach, NEGATION, 1.0)})
    return Machine(arcs)


def reported(factor: float = 0.5) -> Machine:
    """What follows a verb of speech in its clause is someone else's."""
    same = (INSULT, THREAT, TARGET, NEGATION, OTHER)
    return Machine([
        {s: (0, s, 1.0) for s in same} | {REPORT: (1, REPORT, 1.0)},
        {s: (1, s, factor if s in (INSULT, THREAT) else 1.0) for s in same} | {REPORT: (1, REPORT, 1.0)},
    ])


def scorer(target_bonus: float = 1.3, idle_threat: float = 0.1) -> Machine:
    """Sums insults; a threat counts in full in a clause whose target is named before it, and a named target adds to all."""
    rest = {s: (0, s, 1.0) for s in (INSULT, NEGATION, REPORT, OTHER)} | {THREAT: (0, THREAT, idle_threat), TARGET: (1, TARGET, 1.0)}
    named = {s: (1, s, 1.0) for s in (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)}
    return Machine([rest, named], [1.0, target_bonus])


GRAMMAR = compose(compose(negation(), reported()), scorer())
SYMBOLS = [OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]
_ARCS = [[state[s] for s in SYMBOLS] for state in GRAMMAR.arcs]


def clause_weight(symbols: list[int], weights: list[float]) -> float:
    """The grammar's weight of one clause; ``symbols`` index :data:`SYMBOLS`."""
    state, total = 0, 0.0
    for s, w in zip(symbols, weights):
        state, _, factor = _ARCS[state][s]
        total += factor * w
    return total * GRAMMAR.final[state]


@dataclass
class Lexicon:
    """Sorted hashes with symbol and weight: of whole words, and per length of beginnings."""

    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, insults: dict[tuple[int, bytes], float]) -> Lexicon:
        """``insults``: (0 or length of beginning, bytes) -> weight. The closed classes win over insults."""
        entries: dict[int, dict[bytes, tuple[int, float]]] = {n: {} for n in (0, *BEGINNINGS)}
        for (n, word), w in insults.items():
            entries[n][word] = (1, w)
        for symbol, own in CLOSED.items():
            for word in own:
                entries[0][word.encode()] = (SYMBOLS.index(symbol), THREAT_WEIGHT if symbol == THREAT else 0.0)
        tables = {}
        for n, own in entries.items():
            if own:
                data = np.frombuffer(b"".join(own), np.uint8)
                ends = np.cumsum([len(w) for w in own])
                h = span_hashes(data, np.r_[0, ends[:-1]], ends)
                order = np.argsort(h)
                tables[n] = (h[order], np.array([s for s, _ in own.values()])[order], np.array([w for _, w in own.values()])[order])
        return cls(tables)

    def read(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and weight of each word; whole words before longer and shorter beginnings."""
        symbol, weight = np.zeros(len(starts), np.int64), np.zeros(len(starts))
        for n in sorted(self.tables, reverse=True):
            known, s, w = self.tables[n]
            some = np.flatnonzero(ends - starts > n) if n else np.arange(len(starts))
            h = span_hashes(data, starts[some], starts[some] + n if n else ends)
            marks = np.zeros(1 << 16, bool)
            marks[(known >> np.uint64(48)).astype(np.int64)] = True
            maybe = np.flatnonzero(marks[(h >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            hit = known[at] == h[maybe]
            rows, at = some[maybe[hit]], at[hit]
            better = (w[at] > weight[rows]) | (n == 0)
            symbol[rows[better]], weight[rows[better]] = s[at[better]], w[at[better]]
        return symbol, weight


FEATURES = ("log_sum", "strongest", "per_word", "clauses")


def clause_features(part: Texts, lexicon: Lexicon) -> np.ndarray:
    """Per text: log of its clauses' weight, the strongest clause, weight per 100 words, and log of matched clauses."""
    data, rows = LOWER[part.data], len(part)
    starts, ends = word_bounds(WORD_BYTES[data], part.at)
    row = np.searchsorted(part.at, starts, side="right") - 1
    symbol, weight = lexicon.read(data, starts, ends)
    breaks = np.r_[0, np.cumsum(_BREAK[data])]
    clause = breaks[starts] + row  # both only grow, so a new row is a new clause
    total, top, count = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    for c in np.unique(clause[(symbol == 1) | (symbol == 2)]):
        lo, hi = np.searchsorted(clause, [c, c + 1])
        w = clause_weight(symbol[lo:hi].tolist(), weight[lo:hi].tolist())
        r = row[lo]
        total[r] += w
        top[r] = max(top[r], w)
        count[r] += 1
    words = np.maximum(np.bincount(row, minlength=rows), 1)
    return np.column_stack([np.log1p(total), np.minimum(top, 20), np.log1p(100 * total / words), np.log1p(count)])


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, part: Texts) -> np.ndarray:
        return sigmoid(clause_features(part, self.lexicon) @ self.weights[:-1] + self.weights[-1])


def learn_lexicon(seen: DataFrame) -> dict[tuple[int, bytes], float]:
    """Words and beginnings of ``seen`` (doc_id, text, y) by log-odds of the documents that hold them."""
    def run(batches):
        for batch in batches:
            y = np.asarray(batch.column(2))
            for part in texts(batch.column(1)):
                data = LOWER[part.data]
                starts, ends = word_bounds(WORD_BYTES[data], part.at)
                row = np.searchsorted(part.at, starts, side="right") - 1
                label = y[part.first:part.first + len(part)][row]
                for n in (0, *BEGINNINGS):
                    some = np.flatnonzero(ends - starts > n)
                    stop = starts[some] + n if n else ends
                    h = span_hashes(data, starts[some], stop)
                    once = np.unique(mix(h + mix(row[some].astype(np.uint64) + np.uint64(1))), return_index=True)[1]
                    _, first, back = np.unique(h[once], return_index=True, return_inverse=True)
                    ones = np.bincount(back, weights=label[some][once])
                    alls = np.bincount(back)
                    token = [data[starts[some][i]:stop[i]].tobytes() for i in once[first]]
                    yield pa.RecordBatch.from_arrays([pa.array([n] * len(token), pa.int32()), pa.array(token, pa.binary()), pa.array(ones.astype(np.int64)), pa.array(alls.astype(np.int64))], names=["n", "token", "ones", "alls"])

    size = seen.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    counts = seen.mapInArrow(run, "n int, token binary, ones long, alls long").groupBy("n", "token").agg(F.sum("ones").alias("ones"), F.sum("alls").alias("alls"))
    odds = F.log((F.col("ones") + 0.5) / (size.p + 1)) - F.log((F.col("alls") - F.col("ones") + 0.5) / (size.n - size.p + 1))
    best = counts.filter(F.col("ones") >= LEAST_DOCS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    return {(r.n, bytes(r.token)): r.odds for r in best.orderBy(F.desc("odds"), "n", "token").limit(LEXICON).collect()}


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and curve from a bounded sample of labelled documents outside the held-out third.

    Without labels of both kinds the curve is flat: half, or the share of ones.
    """
    seen = sampled_documents(docs, labels, "toxic", sample_rows, MODULUS, HELD_OUT)
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    lexicon = Lexicon.of(learn_lexicon(seen.filter(half == 0)))

    def run(batches):
        for batch in batches:
            for part in texts(batch.column(1)):
                x = clause_features(part, lexicon)
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(part.first, len(part)), *(pa.array(c) for c in x.T)], names=["y", *FEATURES])

    rest = seen.filter(half == 1).mapInArrow(run, "y int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    rest = rest.sort_values(list(rest.columns))
    return Model(lexicon, logistic(rest[list(FEATURES)].to_numpy(float), rest["y"].to_numpy(float)))


def score(docs: DataFrame, model: Model, column: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 in ``column`` (replacing one of that name). Null texts score as empty ones."""
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema, T.StructField(column, T.DoubleType())])

    def run(batches):
        for batch in batches:
            got = [model.score(part) for part in texts(batch.column(batch.schema.get_field_index(text_col)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got) if got else [], pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = score(docs.select("doc_id", "text"), train(docs, labels)).drop("text")
    held = F.coalesce(remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
