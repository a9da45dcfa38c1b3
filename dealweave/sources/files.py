"""Readers of landed files. Each starts from ``spark.read``, keeps file name and time, and sets unreadable content aside.

Json payloads of any vendor may lie in one folder: a payload is parsed once into a variant, and its shape says whose it is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import entities
from ..functions.text import filled, strip_tags
from ..operators import social
from ..session import shared_folder
from . import landed

_BAD = "_corrupt_record"
FROM_FILE = ["file", "modified"]


@dataclass
class Read:
    """Rows that could be read, with ``file`` and ``modified``; content that could not, as text; how many of either, once both are written or counted."""

    rows: DataFrame
    unreadable: DataFrame


def _origin() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")]


def _split(df: DataFrame, columns: list[str]) -> Read:
    """Good rows and corrupt ones, these with what could be read of them (Spark reads no corrupt record without another column)."""
    df = df.select(*columns, _BAD, *_origin())
    bad = F.col(_BAD).isNotNull()
    return Read(df.filter(~bad).drop(_BAD), df.filter(bad).select(F.col(_BAD).alias("content"), F.struct(*columns).alias("partial"), *FROM_FILE))


def read_json(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = True) -> Read:
    """Json files of a declared schema: a document or an array of them per file (``multi_line``), or one per line."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = StructType([*kind.fields]).add(_BAD, StringType())
    reader = spark.read.schema(with_bad).option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
    return _split(reader.json(path), kind.names)


def read_csv(spark: SparkSession, path: str, schema: str | StructType, **options) -> Read:
    """Csv files with a header and a declared schema; lines of another number or kind of values are unreadable."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = StructType([*kind.fields]).add(_BAD, StringType())
    reader = spark.read.schema(with_bad).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).options(**options)
    return _split(reader.csv(path), kind.names)


def quarantine(read: Read, folder: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write good rows and unreadable content to tables of their own; both, and their numbers, counted while they are written."""
    out, counts = [], {}
    for name, df in (("rows", read.rows), ("unreadable", read.unreadable)):
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{folder}/{name}")
        out.append(df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}"))
        counts[name] = seen.get["n"]
    return out[0], out[1], counts


# -- vendor payloads ------------------------------------------------------------------------------


def payloads(spark: SparkSession, path: str, whole_files: bool = False) -> Read:
    """(payload variant, shape, file, modified) of json payloads, one per line or per file; blank lines are none."""
    df = spark.read.option("wholetext", whole_files).text(path).select("value", *_origin()).filter(F.trim("value") != "")
    df = df.withColumn("payload", once(F.try_parse_json("value")))
    good = df.filter("payload is not null").select("payload", shape_of(F.col("payload")).alias("shape"), *FROM_FILE)
    return Read(good, df.filter("payload is null").select(F.col("value").alias("content"), *FROM_FILE))


def once(value: Column) -> Column:
    """A column worked out once a row: Spark puts the expression itself into every filter on a plain column, again for each place that names it."""
    return F.explode(F.array(value))


def _at(payload: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(payload, path, kind)


def shape_of(payload: Column) -> Column:
    """Whose payload it is, by the fields that only one vendor has; null for none."""
    has = lambda path: _at(payload, path, "variant").isNotNull()
    return (
        F.when(has("$.hits"), "search_hits").when(has("$.data") | has("$.includes"), "social_search")
        .when(has("$.jobs[0].absolute_url"), "greenhouse").when(has("$.jobs[0].jobUrl") | has("$.jobs[0].applyUrl"), "ashby").when(has("$[0].hostedUrl") | has("$[0].applyUrl"), "lever")
        .when(has("$.id") & (has("$.kids") | has("$.type")), "thread_item")
    )


ITEM = "struct<id:bigint,type:string,title:string,text:string,url:string,kids:array<bigint>,descendants:bigint>"
HITS = "array<struct<objectID:string,title:string,url:string,story_text:string,points:bigint,num_comments:bigint>>"


def _typed(rows: DataFrame, shape: str, path: str, kind: str) -> DataFrame:
    return rows.filter(F.col("shape") == shape).withColumn("p", once(_at(F.col("payload"), path, kind))).drop("payload", "shape")


def thread_stories(rows: DataFrame) -> DataFrame:
    """Story rows of item payloads, with their comments, and of search hits, which have none.

    Stories, their replies and hits are read from one table of what the payloads hold, so that each payload is parsed once.
    """
    kinds = {"item": ("thread_item", "$", ITEM), "hits": ("search_hits", "$.hits", HITS)}
    held = [F.when(F.col("shape") == shape, _at(F.col("payload"), path, kind)).alias(name) for name, (shape, path, kind) in kinds.items()]
    folder = f"{shared_folder(rows.sparkSession)}/dealweave-payloads/{uuid.uuid4().hex}"
    parsed = rows.filter(F.col("shape").isin([shape for shape, _, _ in kinds.values()])).select("shape", *held)
    parsed.write.parquet(folder)
    parsed = rows.sparkSession.read.schema(parsed.schema).parquet(folder)
    items = parsed.filter("shape = 'thread_item'").select("item.*")
    hit = parsed.filter("shape = 'search_hits'").select(F.explode("hits").alias("h"))
    page = F.concat(F.lit(landed.THREAD_LINK), F.col("h.objectID"))
    title = F.trim(F.coalesce("h.title", F.lit("")))
    hits = hit.select(
        F.col("h.objectID").try_cast("bigint").alias("id"), title.alias("title"), strip_tags(F.coalesce("h.story_text", F.lit(""))).alias("text"), F.coalesce(filled(F.col("h.url")), page).alias("url"),
        page.alias("discussion_url"), social.story_type(title).alias("story_type"), F.array().cast("array<string>").alias("comments"),
        entities.headline_entities(title).alias("provisional_entities"), F.lit("hn_algolia_show").alias("kind"), F.coalesce("h.points", F.lit(0)).alias("points"),
    )
    stories = landed.hn_stories(items).withColumn("kind", F.lit("hackernews")).withColumn("points", F.lit(None).cast("bigint"))
    return stories.unionByName(hits)


def social_posts(rows: DataFrame) -> DataFrame:
    """Posts of search payloads; their authors are looked up within the payload, in a map of its users."""
    got = _typed(rows, "social_search", "$", f"struct<{landed.SEARCH_SCHEMA}>")
    users = F.map_from_entries(F.transform(_first_by(F.coalesce("p.includes.users", F.array().cast("array<struct<id:string,username:string>>"))), lambda u: F.struct(u["id"], u["username"])))
    return landed.posts_of(got.select(F.explode("p.data").alias("t"), users.alias("__users")).withColumn("author", F.element_at("__users", F.col("t.author_id"))))


def _first_by(users: Column) -> Column:
    """Users with an id, the first of each: a map takes no id twice."""
    named = F.filter(users, lambda u: u["id"].isNotNull())
    ids = F.transform(named, lambda u: u["id"])
    return F.filter(named, lambda u, i: F.array_position(ids, u["id"]) == i + 1)


def job_shapes(rows: DataFrame) -> DataFrame:
    """Postings of the three board shapes as one; a board's slug is its file's name."""
    name = F.regexp_extract("file", r"([^/]+?)(?:\.[a-z]+)*$", 1)
    parts = []
    for board, kind in landed.BOARD_SCHEMAS.items():
        path, item = ("$", kind) if board == "lever" else ("$.jobs", kind.removeprefix("jobs "))
        parts.append(landed.board_shape(_typed(rows, board, path, item).select(name.alias("slug"), F.explode("p").alias("j")), board))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
