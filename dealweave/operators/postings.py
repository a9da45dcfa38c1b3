"""Where known phrases stand in texts: postings of text pieces, probed by one piece of each phrase.

A text is cut at its word boundaries. Wherever a phrase stands in it, the phrase's inner pieces are pieces of the text, its
first piece ends one and its last piece begins one. So a phrase is looked for at one of its pieces only, its anchor: the one that
the fewest phrases have, so that a text's piece meets few phrases however many share their beginnings. What a piece of text can be
for an anchor (equal, or for the outer pieces: ending, beginning or containing it) is settled once per distinct piece of all texts, by
an equi-join on the anchor's rarest gram. Postings carry a few pieces to either side, by which a meeting is verified; texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces to either side that a posting carries at most; longer phrases are verified on the texts of their few candidates.
REACH = 12
#: Up to so many pairs of a piece of text and a phrase are sent to the texts; more of them meet postings in a shuffle.
SENT_PAIRS = 50_000
GRAM = 3
_WORD = r"^\w$"
_LETTER = r"[\p{L}\p{N}]"


def pieces(text: Column) -> Column:
    """Text cut at every word boundary: words and the runs between them."""
    return F.filter(F.split(text, r"\b"), lambda p: p != "")


def _blank(piece: Column) -> Column:
    return F.trim(piece) == ""


def _cut(texts: DataFrame) -> DataFrame:
    """(id, all, pos, piece) of every piece that is not blank, with all pieces of its text: only for what stays in place."""
    cut = texts.filter("text is not null").select("id", pieces(F.col("text")).alias("all"))
    return cut.select("id", "all", F.posexplode("all").alias("pos", "piece")).filter(~_blank(F.col("piece")))


def postings(texts: DataFrame, reach: int) -> DataFrame:
    """(id, piece, place, near) of every piece that is not blank; ``near`` has ``reach`` pieces on either side, "" beyond the text."""
    pad = F.array_repeat(F.lit(""), reach)
    padded = F.concat(pad, F.col("all"), pad)
    near = F.slice(padded, F.col("pos") + 1, F.lit(2 * reach + 1))
    return _cut(texts).select("id", "piece", F.col("pos").alias("place"), near.alias("near"))


def anchors(phrases: DataFrame, inside_words: bool) -> DataFrame:
    """(entry, phrase, parts, k, i, anchor, mode): where each phrase is looked for. ``i`` is the anchor's place among the ``k`` parts.

    ``mode`` is what a piece of text must do: equal the anchor, or end with, begin with or hold it. With ``inside_words`` false all
    must be equal.
    """
    cut = phrases.filter("phrase is not null").select("entry", "phrase", pieces(F.col("phrase")).alias("parts"))
    cut = cut.withColumn("k", F.size("parts")).filter("k > 0")
    each = cut.select("entry", "k", F.posexplode("parts").alias("i", "anchor")).filter(~_blank(F.col("anchor")))
    if inside_words:  # an outer piece can be within a longer one; a long phrase has an inner one
        each = each.filter((F.col("k") <= REACH) | F.col("i").between(1, F.col("k") - 2))
    usage = each.groupBy("anchor").agg(F.count("*").alias("__uses"))
    order = F.struct("__uses", -F.length("anchor"), "i")
    best = each.join(usage, "anchor").groupBy("entry").agg(F.min_by(F.struct("i", "anchor"), order).alias("b"))
    out = cut.join(best, "entry").select("entry", "phrase", "parts", "k", F.col("b.i").alias("i"), F.col("b.anchor").alias("anchor"))
    if not inside_words:
        return out.withColumn("mode", F.lit("equal"))
    mode = F.when(F.col("k") == 1, "hold").when(F.col("i") == 0, "end").when(F.col("i") == F.col("k") - 1, "begin").otherwise("equal")
    return out.withColumn("mode", mode)


def _grams(text: Column, width: Column) -> Column:
    """The distinct grams of a text; none if it is shorter than the width."""
    places = F.sequence(F.lit(1), F.length(text) - width + 1)
    every = F.transform(places, lambda i: F.substring(text, i, width))
    return F.when(F.length(text) >= width, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _held(pieces_: DataFrame, probes: DataFrame) -> DataFrame:
    """(piece, anchor, mode, offset): distinct pieces of text that end with, begin with or hold an anchor, and where in them it begins."""
    width = F.least(F.lit(GRAM), F.length("anchor"))
    own = probes.select("anchor", "mode").distinct().select("anchor", "mode", F.explode(_grams(F.col("anchor"), width)).alias("gram"))
    usage = own.groupBy("gram").agg(F.count("*").alias("__uses"))
    own = own.join(usage, "gram").groupBy("anchor", "mode").agg(F.min_by("gram", F.struct("__uses", "gram")).alias("gram"))
    widths = F.explode(F.array(*[F.lit(w) for w in range(1, GRAM + 1)])).alias("w")
    there = pieces_.select("piece", widths).select("piece", F.explode(_grams(F.col("piece"), F.col("w"))).alias("gram"))
    met = there.join(own, "gram").filter(F.contains("piece", F.col("anchor")))
    room = F.length("piece") - F.length("anchor") + 1
    places = F.filter(F.sequence(F.lit(1), room), lambda i: F.substring(F.col("piece"), i, F.length("anchor")) == F.col("anchor"))
    at = F.when(F.col("mode") == "hold", places).when(F.col("mode") == "end", F.filter(F.array(room), lambda i: F.endswith("piece", F.col("anchor"))))
    at = at.otherwise(F.filter(F.array(F.lit(1)), lambda i: F.startswith("piece", F.col("anchor"))))
    return met.select("piece", "anchor", "mode", F.explode(at).alias("offset"))


def find(texts: DataFrame, phrases: DataFrame, inside_words: bool = True) -> DataFrame:
    """(id, entry, whole, alone) of every text of (id, text) and phrase of (entry, phrase) that it holds.

    ``whole``: some place of the phrase has word boundaries at both ends. ``alone``: its first place has no letter or digit before or
    behind it. Compared as they are, so both sides must be in one case. Null texts and phrases hold and are nothing; ids and entries must be
    unique. With ``inside_words`` false only places where the phrase's words are words of the text are found, which is enough for ``whole``.
    """
    probes = anchors(phrases, inside_words).persist()  # read several times below
    size = probes.agg(F.max("k").alias("longest"), F.count(F.lit(1)).alias("n")).first()
    longest = size["longest"] or 1
    reach = min(longest, REACH)
    short = probes.filter(F.col("k") <= REACH)
    held = short.filter("mode = 'equal'").select(F.col("anchor").alias("piece"), "anchor", "mode", F.lit(1).alias("offset")).distinct()
    if inside_words:
        distinct = _cut(texts).select("piece").distinct()
        held = held.unionByName(_held(distinct, short.filter("mode <> 'equal'")))
    known = held.join(short, ["anchor", "mode"]).drop("anchor", "mode")
    i, k = F.col("i"), F.col("k")
    few = known.limit(SENT_PAIRS + 1).persist() if size["n"] <= SENT_PAIRS else None
    if few is not None and few.count() <= SENT_PAIRS:
        # the pairs go to the texts, and pieces beside a match are read where the text is
        met = _cut(texts).join(F.broadcast(few), "piece").filter((F.col("pos") >= i) & (F.col("pos") - i + k <= F.size("all")))
        first = F.col("pos") - i
        met = met.select("id", "entry", "phrase", "parts", "k", "offset", first.alias("first"), F.slice("all", F.greatest(first + 1, F.lit(1)), k).alias("window"), F.get("all", first - 1).alias("prev"), F.get("all", first + k).alias("next"))
    else:
        met = postings(texts, reach).join(known, "piece")
        at = F.lit(reach) - i  # of the window in near, from 0
        met = met.select("id", "entry", "phrase", "parts", "k", "offset", (F.col("place") - i).alias("first"), F.slice("near", F.greatest(at + 1, F.lit(1)), k).alias("window"), F.get("near", at - 1).alias("prev"), F.get("near", at + k).alias("next"))
    met = met.withColumn("text", F.array_join("window", ""))
    start = F.when(k == 1, F.col("offset")).otherwise(F.length(F.element_at("window", 1)) - F.length(F.element_at("parts", 1)) + 1)
    met = met.withColumn("start", start).filter("start >= 1")
    met = met.filter(F.substring("text", F.col("start"), F.length("phrase")) == F.col("phrase"))
    behind = F.col("start") + F.length("phrase")
    before = F.when(F.col("start") > 1, F.substring("text", F.col("start") - 1, F.lit(1))).otherwise(F.right(F.coalesce("prev", F.lit("")), F.lit(1)))
    after = F.when(behind <= F.length("text"), F.substring("text", behind, F.lit(1))).otherwise(F.left(F.coalesce("next", F.lit("")), F.lit(1)))
    met = met.select("id", "entry", (F.col("first").cast("long") * (1 << 31) + F.col("start")).alias("at"), *_stands(before, after, F.col("phrase")))
    out = met.groupBy("id", "entry").agg(F.bool_or("whole").alias("whole"), F.min_by("alone", "at").alias("alone"))
    if longest > REACH:
        out = out.unionByName(_find_long(texts, probes.filter(F.col("k") > REACH), inside_words))
    return out


def _stands(before: Column, after: Column, phrase: Column) -> list[Column]:
    word = lambda c: c.rlike(_WORD)
    opens = word(before) != word(F.left(phrase, F.lit(1)))
    closes = word(after) != word(F.right(phrase, F.lit(1)))
    return [(opens & closes).alias("whole"), (~before.rlike(_LETTER) & ~after.rlike(_LETTER)).alias("alone")]


def _find_long(texts: DataFrame, probes: DataFrame, inside_words: bool) -> DataFrame:
    """As :func:`find`, of phrases of more pieces than a posting carries: candidates by the anchor, verified on their texts."""
    met = _cut(texts).select("id", "piece").join(probes.select(F.col("anchor").alias("piece"), "entry", "phrase"), "piece").select("id", "entry", "phrase").distinct()
    both = met.join(texts, "id").withColumn("__at", F.instr("text", F.col("phrase"))).filter("__at > 0")
    before = F.when(F.col("__at") > 1, F.substring(F.col("text"), F.col("__at") - 1, F.lit(1))).otherwise("")
    after = F.substring(F.col("text"), F.col("__at") + F.length("phrase"), F.lit(1))
    whole = F.regexp_like("text", F.concat(F.lit(r"\b\Q"), F.col("phrase"), F.lit(r"\E\b")))
    rows = both.select("id", "entry", whole.alias("whole"), _stands(before, after, F.col("phrase"))[1])
    return rows if inside_words else rows.filter("whole")
