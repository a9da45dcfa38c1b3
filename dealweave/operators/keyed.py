"""Keep-one, keep-n and merge operators on declared keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order``.

    An aggregate rather than a window: copies of a hot key are combined on the map side, so a
    key that holds a third of the rows still shuffles one row per input partition.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the largest by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None):
    """First ``n`` rows per key.

    ``row_number() <= n`` is planned with a group limit below the shuffle, so each input
    partition sends at most ``n`` rows of a key, however many it holds.
    """
    column = rank or "__rank"
    out = df.withColumn(column, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(column) <= n)
    return out if rank else out.drop(column)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]):
    """Target plus the first source row of every key the target does not hold."""
    fresh = keep_first(source, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


#: What a column takes when both the old row ``t`` and the new row ``s`` exist.
POLICIES = {
    "overwrite": lambda t, s: s,
    "keep": lambda t, s: t,
    "coalesce": lambda t, s: F.coalesce(s, t),
    "max": lambda t, s: F.greatest(t, s),
    "or": lambda t, s: t | s,
    "fill": lambda t, s: F.coalesce(t, s),
}


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], policy: dict[str, str],
    default: str = "overwrite",
) -> DataFrame:
    """Upsert as a new snapshot: full outer join on unique keys, one policy per column. Rows whose key is null match none and stay."""
    t, s = target.withColumn("__old", F.lit(True)).alias("t"), source.withColumn("__new", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    is_old, is_new = F.col("t.__old").isNotNull(), F.col("s.__new").isNotNull()
    out = []
    for name in target.columns:
        old = F.col(f"t.{name}")
        if name in keys:
            out.append(F.coalesce(old, F.col(f"s.{name}")).alias(name))
            continue
        if name not in source.columns:
            out.append(old.alias(name))
            continue
        new = F.col(f"s.{name}")
        merged = POLICIES[policy.get(name, default)](old, new)
        out.append(F.when(is_old & is_new, merged).when(is_new, new).otherwise(old).alias(name))
    return both.select(*out)


def fold(rows: DataFrame, keys: list[str], order: str, policy: dict[str, str], default: str = "keep") -> DataFrame:
    """All reports of a key, upserted one after another by ``order``, in one aggregate with a policy per column."""
    at = F.col(order)
    first = lambda c: F.min_by(c, at)
    takes = {
        "overwrite": lambda c: F.max_by(c, at), "keep": first, "max": F.max, "or": F.bool_or,
        "coalesce": lambda c: F.max_by(c, F.when(c.isNotNull(), at)), "fill": lambda c: F.min_by(c, F.when(c.isNotNull(), at)),
    }
    rest = [takes[policy.get(c, default)](F.col(c)).alias(c) for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*rest).select(*rows.columns)


def replace_or_drop(source: DataFrame, owners: DataFrame, key: str) -> DataFrame:
    """The source is the new snapshot; owners it does not name drop out."""
    return source.join(owners.select(key).distinct(), key, "left_semi")


def patch_claims(claims: DataFrame, patches: DataFrame, floor: float = 0.85) -> DataFrame:
    """Patch claims by id, else by URL: patch values win where given, confidence is lifted."""
    fields = [c for c in patches.columns if c not in ("claim_id", "source_url")]
    by_id = patches.filter("claim_id is not null").select(F.col("claim_id").alias("id"), *fields)
    by_url = patches.filter("claim_id is null and source_url is not null")
    by_url = by_url.select(F.trim("source_url").alias("source_url"), *fields)
    by_url = by_url.join(claims.select("id", "source_url"), "source_url").select("id", *fields)
    found = by_id.unionByName(by_url).withColumn("__hit", F.lit(True)).alias("p")
    both = claims.alias("c").join(found, F.col("c.id") == F.col("p.id"), "left")
    out = []
    for name in claims.columns:
        col = F.col(f"c.{name}")
        if name == "extraction_confidence":
            lifted = F.greatest(F.coalesce(col, F.lit(0.0)), F.lit(floor))
            col = F.when(F.col("p.__hit"), lifted).otherwise(col)
        elif name in fields:
            col = F.coalesce(F.col(f"p.{name}"), col)
        out.append(col.alias(name))
    return both.select(*out)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of duplicated keys and of rows a clean-up would delete."""
    groups = df.groupBy(*keys).count().filter("count > 1")
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("rows_to_delete"),
    )
