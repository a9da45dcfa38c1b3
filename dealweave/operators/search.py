"""Vector search over companies, rounds and events, and the text that is embedded."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_once


def cosine(vector: Column, query: list[float]) -> Column:
    """Cosine to a fixed query; 0 on length mismatch or a zero vector."""
    q = F.array(*[F.lit(float(v)) for v in query])
    norm_q = float(sum(v * v for v in query)) ** 0.5
    v = F.transform(vector, lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)) * norm_q
    usable = (F.size(vector) == len(query)) & (norm > 0)
    return F.when(usable, dot / norm).otherwise(0.0)


def top_k(rows: DataFrame, query: list[float], boost: Column, k: int) -> DataFrame:
    """Best ``k`` rows by cosine plus boost, clamped to 1, ties by id."""
    scored = rows.withColumn("score", F.least(F.lit(1.0), cosine(F.col("embedding"), query) + boost))
    return scored.orderBy(F.desc("score"), "id").limit(k)


def company_boost() -> Column:
    return F.coalesce("company_score", F.lit(0.0)) * 0.05


def funding_boost() -> Column:
    return F.least(F.lit(0.1), F.coalesce("amount_usd", F.lit(0)) / 1e10)


def event_boost() -> Column:
    return F.coalesce(F.nullif("confidence", F.lit(0.0)), F.lit(0.5)) * 0.05


def unified(parts: list[DataFrame], k: int = 15) -> DataFrame:
    """Parts (kind, id, score) merged into one top list."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy(F.desc("score"), "kind", "id").limit(k)


def company_text() -> Column:
    some = lambda c, prefix="", suffix="": F.when(
        F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(prefix), F.col(c).cast("string"), F.lit(suffix)))
    return F.concat_ws(
        " ", "name", some("description_long"), some("business_model", "Business model: "), some("tech_stack", "Tech: "),
        some("headquarters", "HQ: "), some("team_size", "Team: ", " people"),
    )


def dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def round_text() -> Column:
    has = lambda c: F.coalesce(F.col(c), F.lit(0)) != 0
    return F.concat_ws(
        " ", "name", "round_type", F.when(has("amount_usd"), dollars(F.col("amount_usd"))),
        F.when(has("valuation_usd"), F.concat(F.lit("at "), dollars(F.col("valuation_usd")), F.lit(" valuation"))),
        F.when(F.coalesce("lead_investor", F.lit("")) != "", F.concat(F.lit("led by "), "lead_investor")),
    )


def event_text() -> Column:
    return F.concat_ws(
        " ", F.coalesce("name", F.lit("Unknown")), "event_type",
        F.when(F.coalesce("amount_usd", F.lit(0)) != 0, dollars(F.col("amount_usd"))), F.concat(F.lit("from "), "source"),
    )


#: Parts of a hashed term vector.
TERM_PARTS = 64


def terms(text: Column) -> Column:
    """Lower-cased words and numbers of a text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def _part(term: Column, parts: int) -> Column:
    return F.conv(F.left(F.md5(term), F.lit(4)), 16, 10).cast("int") % parts


def term_counts(rows: DataFrame, text: Column, parts: int = TERM_PARTS) -> DataFrame:
    """Rows with ``embedding``, how often terms of each of ``parts`` hash classes occur: a model without weights, all in expressions."""
    own = F.transform(terms(text), lambda w: _part(w, parts))
    counts = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.size(F.filter("__parts", lambda p: p == i)).cast("double"))
    return with_once(rows, __parts=own).withColumn("embedding", counts).drop("__parts")  # not once for each of the parts


def query_vector(text: str, parts: int = TERM_PARTS) -> list[float]:
    """The vector of a query's text, as :func:`term_counts` makes it."""
    out = [0.0] * parts
    for w in re.findall("[a-z0-9]+", text.lower()):
        out[int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % parts] += 1
    return out


def embed(rows: DataFrame, text: str, model: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """Rows with an ``embedding`` from a pluggable model, called per Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(embedding=model(pdf[text].tolist()))

    schema = ", ".join(f"`{n}` {k}" for n, k in rows.dtypes) + ", embedding array<float>"
    return rows.mapInPandas(run, schema)
