"""Spelling variants of the words of a corpus: words one edit apart, grouped under the most frequent spelling.

Two words one edit apart agree before the edit and behind it. Cut the shorter word in two: one half of it is free of the
edit, so the pair agrees on the first half as a prefix or on the second as a suffix. Words therefore meet only in groups that
share a length class and such a half; a group of over ``MOST_WORDS`` words is cut again, what is left free of it in two, and
so on, until at most one character is free. Every pair is judged in one group only.

Within a group, what its words do not share is sorted, and neighbours' common prefixes (LCPs) say which rows of the edit
matrix stay: a row is kept for a prefix, all words of the range that shares it go on from there, and a range whose shared
prefix is already more than one edit from the asking word is skipped. Rows are three cells wide, as no other can be at most
one. The asking words of all groups of a batch go through their ranges a character at a time, side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, scratch, settle

LETTERS = r"[A-Za-zÀ-ÿ]+"
SHORTEST = 5
LEAST = 3
RATIO = 2
MOST_WORDS = 2048
#: Pairs of an asking word and a range that one step holds, before it goes on with part of them.
MOST_PAIRS = 1 << 20
DAMAGE = 97

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run) of every maximal run of letters of every whole text, A-Z lower-cased. A null or empty text has none."""
    text = F.translate(F.col(text_col), _UPPER, _LOWER)
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))


def damaged(doc_id: Column, run: Column, modulus: int = DAMAGE) -> Column:
    """The run, less its character h mod length if ``modulus`` divides h, the crc32 of "id:run"; a null id is empty there."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % modulus == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): the distinct words of at least ``shortest`` characters with at least ``least`` occurrences."""
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


# --- who meets whom -------------------------------------------------------------------------------------------------

_GROUP = ["m", "front", "back", "part"]


def _halves(m: Column, front: Column, back: Column, bound: Column) -> Column:
    """The two groups into which a group is cut. ``bound``: pairs that agree on so many first characters are judged elsewhere."""
    half = ((m - front - back) / 2).cast("int")
    head = F.struct(m.alias("m"), (front + half).alias("front"), back.alias("back"), bound.alias("bound"))
    tail = F.struct(m.alias("m"), front.alias("front"), (m - front - half).alias("back"), F.least(bound, front + half).alias("bound"))
    return F.array(head, tail)


def _keyed(rows: DataFrame) -> DataFrame:
    """(word, n, m, front, back, bound, part): ``part`` is what the words of the group share."""
    g, word = F.col("g"), F.col("word")
    part = F.concat(F.substring(word, F.lit(1), g["front"]), F.substring(word, F.length(word) - g["back"] + 1, g["back"]))
    return rows.select("word", "n", "g.*", part.alias("part"))


def groups(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Each word in all its groups, none of over ``most`` words unless one character at most is free there."""
    length = F.length("word")
    whole = F.explode(F.array(length, length - 1)).alias("m")  # the length of the shorter word of a pair
    zero = F.lit(0)
    rows = _keyed(words.select("word", "n", whole).select("word", "n", F.explode(_halves(F.col("m"), zero, zero, F.lit(1 << 30))).alias("g")))
    done = []
    while True:
        sizes = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("__size"))
        large = sizes.filter((F.col("__size") > most) & (F.col("m") - F.col("front") - F.col("back") > 1)).drop("__size")
        if large.isEmpty():
            break
        done.append(rows.join(large, _GROUP, "left_anti"))
        cut = _halves(F.col("m"), F.col("front"), F.col("back"), F.col("bound"))
        rows = _keyed(rows.join(large, _GROUP, "left_semi").select("word", "n", F.explode(cut).alias("g")))
    for x in done:
        rows = rows.unionByName(x)
    return rows


# --- the scan -------------------------------------------------------------------------------------------------------

_FOUND = "word string, n_near long, best_n long, best string"
_FOUND_ARROW = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


class _Ranges:
    """The ranges of sorted words that share a first part, by its length, and which ranges a range consists of."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, group: np.ndarray):
        n, width = codes.shape
        same = np.zeros(n, np.int64)  # the LCP with the word before; -1 where a group begins
        if n > 1:
            differ = codes[1:] != codes[:-1]
            same[1:] = np.where(differ.any(1), differ.argmax(1), width)
            same[1:][group[1:] != group[:-1]] = -1
        same[:1] = -1
        self.first, self.kids, self.kid_at = [], [], []
        for depth in range(width + 1):  # a range of this depth begins where the LCP is less; words that ended before are in none
            self.first.append(np.flatnonzero((same < depth) & (sizes >= depth)))
        for depth in range(width):
            owner = np.searchsorted(self.first[depth], self.first[depth + 1], side="right") - 1
            self.kid_at.append(np.searchsorted(owner, np.arange(len(self.first[depth]) + 1)))
        self.codes, self.sizes = codes, sizes


def _near(codes: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking row, found row) of one group at distance one. Rows are sorted by group and then by what is in ``codes``.

    ``codes`` has a row's characters, then zeros. Equal rows of a group must not occur, except that words may be equal in
    what is free of them only if they are one word.
    """
    r = _Ranges(codes, sizes, group)
    ask, found = [], []
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = np.pad(codes, ((0, 0), (1, 2)), constant_values=0)  # x[j - 1] of any cell can be read; zero equals no character
    top = np.searchsorted(group[r.first[0]], group)  # each row asks in the one range of depth 0 of its group
    rows = np.arange(len(codes))
    # cells of edits(prefix of length k of the range, prefix of length k - 1, k, k + 1 of the asking word), at most 2
    todo = [(0, rows, top, np.full(len(rows), 2, np.int8), np.zeros(len(rows), np.int8), np.ones(len(rows), np.int8))]
    while todo:
        k, q, node, a, b, c = todo.pop()
        if len(q) > MOST_PAIRS:
            half = len(q) // 2
            todo += [(k, q[half:], node[half:], a[half:], b[half:], c[half:]), (k, q[:half], node[:half], a[:half], b[:half], c[:half])]
            continue
        at = r.first[k][node]  # the first word of a range is the one that may end there
        ends = r.sizes[at] == k
        gap = r.sizes[q] - k
        hit = ends & (((gap == -1) & (a == 1)) | ((gap == 0) & (b == 1)) | ((gap == 1) & (c == 1)))
        ask.append(q[hit])
        found.append(at[hit])
        if k == codes.shape[1]:
            continue
        lo, hi = r.kid_at[k][node], r.kid_at[k][node + 1]
        many = hi - lo
        rep = np.repeat(np.arange(len(q)), many)
        if not len(rep):
            continue
        node = np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many) + lo[rep]
        q, a, b, c = q[rep], a[rep], b[rep], c[rep]
        letter = codes[r.first[k + 1][node], k]
        a2 = np.minimum(a + (wide[q, k] != letter), b + 1)
        b2 = np.minimum(np.minimum(b + (wide[q, k + 1] != letter), c + 1), a2 + 1)
        c2 = np.minimum(c + (wide[q, k + 2] != letter), b2 + 1)
        go = np.minimum(np.minimum(a2, b2), c2) <= 1
        todo.append((k + 1, q[go], node[go], *(np.minimum(x[go], 2).astype(np.int8) for x in (a2, b2, c2))))
    return np.concatenate(ask), np.concatenate(found)


def _free(words: pa.Array, front: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word between its first ``front`` and last ``back`` ones, zero-filled; and how many they are."""
    sizes = np.asarray(pc.utf8_length(words)).astype(np.int64)
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int32)
    first, free = np.cumsum(sizes) - sizes, sizes - front - back
    width = int(free.max(initial=0))
    place = np.arange(width)
    inside = place < free[:, None]
    out = np.zeros((len(sizes), width), np.int32)
    out[inside] = flat[((first + front)[:, None] + place)[inside]]
    return out, free


def _judge(rows: pa.Table) -> pa.RecordBatch:
    """What the words of some whole groups find in them: one row for each word and group with a near word."""
    m, front, back, bound, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("m", "front", "back", "bound", "n"))
    word = rows.column("word").combine_chunks()
    group = np.asarray(rows.column("__g").combine_chunks().dictionary_encode().indices).astype(np.int64)
    codes, sizes = _free(word, front, back)
    order = np.lexsort((*(codes[:, i] for i in range(codes.shape[1] - 1, -1, -1)), group))
    q, y = _near(codes[order], sizes[order], group[order])
    q, y = order[q], order[y]
    length = sizes + front + back
    agree = np.minimum.accumulate(codes[q] == codes[y], axis=1).sum(1) if len(q) else np.zeros(0, np.int64)
    keep = (np.minimum(length[q], length[y]) == m[q]) & (front[q] + agree < bound[q])
    q, y = q[keep], y[keep]
    rank = np.empty(len(word), np.int64)
    rank[np.asarray(pc.sort_indices(word))] = np.arange(len(word))
    by = np.lexsort((rank[y], -n[y], q))
    q, y = q[by], y[by]
    heads = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    count = np.diff(np.r_[heads, len(q)])
    return arrow(_FOUND_ARROW, word=word.take(pa.array(q[heads])), n_near=count, best_n=n[y[heads]], best=word.take(pa.array(y[heads])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        g = rows.column("__g")
        last = g[rows.num_rows - 1]
        cut = pc.index(g, last).as_py()  # the last group may go on in the next batch
        if cut:
            yield _judge(rows.slice(0, cut))
        held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield _judge(pa.Table.from_batches(held))


def near_words(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words with near words; ``best`` is the one of largest n, ties to the smallest."""
    g = F.concat_ws(" ", "m", "front", "back", "part")
    met = groups(words, most).select(g.alias("__g"), "m", "front", "back", "bound", "word", "n")
    met = met.repartition("__g").sortWithinPartitions("__g")
    found = met.mapInArrow(_scan, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return out.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of words with a form: where following forms ends. Each round doubles the steps taken.

    A form has ``RATIO`` times the occurrences of its word, so there are no rings and few rounds.
    """
    steps, k = settle(forms.select("word", F.col("form").alias("root")), f"{folder}/0"), 0
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        k += 1
        moved = settle(moved, f"{folder}/{k}")
        steps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return steps


def variants(words: DataFrame, ratio: float = RATIO, most: int = MOST_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each (word, n).

    Near words differ by one inserted, deleted or replaced character. ``form`` is the near word of largest n, ties to the
    smallest in code-point order, if it has ``ratio`` times the word's n; else null, and so is ``form_n``. ``root`` is where
    following forms ends, the word itself without any. Words must be distinct and not null; no words give no rows.
    """
    folder = scratch(words.sparkSession, "variants")
    words = settle(words.select("word", "n"), f"{folder}/words")
    near = near_words(words, most)
    out = words.join(near, "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    out = settle(out, f"{folder}/forms")
    ends = roots(out.filter("form is not null"), f"{folder}/roots")
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(docs: DataFrame) -> DataFrame:
    """The variants of the words of ``docs`` (doc_id, text), some of whose runs lost a character by a hash. Other columns,
    whatever their names, are ignored; rows repeated in the table count as often as they occur."""
    words = runs(docs).select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    return variants(vocabulary(words))
