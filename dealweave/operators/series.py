"""Changes of a reading over time, against the newest reading that is old enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days).cast("int")


def growth(readings: DataFrame, key: str, day: str, values: list[str], days: int = 30) -> DataFrame:
    """(key, day, values, <value>_growth): each day's values less those of the newest day at or before ``days`` days earlier; null without one.

    ``readings``: one row a key and day. Days are cut into buckets of ``days``, so the day asked for lies in the bucket before, or
    the last reading of an earlier one answers. A bucket has ``days`` readings of a key at most, and only buckets are ordered per key:
    however often a key is read, no task holds all its readings, and none are paired.
    """
    row = F.struct(F.col(day).alias("day"), *values)
    buckets = readings.filter(F.col(day).isNotNull()).groupBy(key, _bucket(F.col(day), days).alias("__b")).agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    order = Window.partitionBy(key).orderBy("__b")
    last = F.element_at("__rows", -1)
    buckets = buckets.select(
        key, "__rows", (F.lag("__b").over(order) == F.col("__b") - 1).alias("__next"), F.lag("__rows").over(order).alias("__before"), F.lag(last, 2).over(order).alias("__older"),
    )
    each = buckets.select(key, F.explode("__rows").alias("r"), "__next", "__before", "__older")
    due = F.date_sub(F.col("r.day"), days)
    within = F.filter("__before", lambda x: x["day"] <= due)
    base = F.when(F.col("__next"), F.when(F.size(within) > 0, F.element_at(within, -1)).otherwise(F.col("__older"))).otherwise(F.element_at("__before", -1))
    each = each.withColumn("b", base)
    return each.select(key, F.col("r.day").alias(day), *[F.col(f"r.{v}").alias(v) for v in values], *[(F.col(f"r.{v}") - F.col(f"b.{v}")).alias(f"{v}_growth") for v in values])
