"""Streams over landed files: dedup, classification, resolution, alerts, velocity and page changes.

What must hold for ever (a key seen once, an alert sent once, the last snapshot of a site) is state of the engine, kept per key in
a disk-backed store under the query's checkpoint: a batch reads and writes the keys it touches, and no watermark drops a late row.
Before the shuffle by key each batch of rows shrinks to one a key, so a hot key sends few. Results go to the engine's file sink, or to
a folder per batch that a replay overwrites, so a restarted query neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from ..functions import classify
from ..functions.money import amount_usd
from ..operators import alerts, resolve
from ..sources.snapshots import SnapshotTable

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _batch(folder: str, batch_id: int) -> str:
    return f"{folder}/batch={batch_id}"


def _on_disk(spark: SparkSession) -> None:
    """State on the executors' disks, saved to the checkpoint as changes of each batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run_to_files(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Process everything available into the engine's file sink, which holds each batch once."""
    _on_disk(stream.sparkSession)
    query = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query.option("checkpointLocation", checkpoint).option("path", folder).start().awaitTermination()


def run_batches(stream: DataFrame, step, checkpoint: str, mode: str = "append") -> None:
    """Process everything available, batch by batch."""
    query = (
        stream.writeStream.outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).foreachBatch(step).start()
    )
    query.awaitTermination()


def _first_of_each(keys: list[str], order: list[str]):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            yield rows.sort_values(order, kind="stable").drop_duplicates(keys)

    return run


def unseen(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The stream's first row of every key, however late a key comes. Of a key's rows in one batch, one that is smallest by ``order`` among its neighbours."""
    first = stream.mapInPandas(_first_of_each(keys, order), stream.schema)
    return first.dropDuplicates(keys)


def classified_stream(signals: DataFrame, companies: DataFrame) -> DataFrame:
    """Label, confidence, amount and company by host, without state: the company side is static."""
    rows = classify.classify(signals, "text", "source")
    rows = rows.withColumn("event_type", classify.label_title(F.col("label"))).withColumn("amount_usd", amount_usd(F.col("text")))
    index = resolve.domain_index(companies).select("domain", F.col("company_id").alias("by_host"))
    host = resolve.link_host(F.col("url"))
    return rows.withColumn("domain", host).join(index, "domain", "left").drop("domain")


def write_batches(folder: str):
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch(folder, batch_id))

    return step


def unsent_alerts(events: DataFrame, rules: list[dict], channel: str) -> DataFrame:
    """(event_id, channel, alert_type): alerts that the stream of events has not sent on the channel before."""
    hits = alerts.match_rules(events, rules).select(F.col("id").alias("event_id"), F.lit(channel).alias("channel"), "alert_type")
    return unseen(hits, ["event_id", "channel"], ["event_id"])


def daily_count_step(folder: str, key: str, at: str):
    """Batch step: the batch's own counts per key and day. Batches add up, so nothing is kept between them."""

    def step(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(key, F.date_trunc("day", at).alias("day")).agg(F.count("*").alias("events"))
        counts.write.mode("overwrite").parquet(_batch(folder, batch_id))

    return step


def velocity(counts: DataFrame, key: str, days: int = 30) -> DataFrame:
    """Events per key in each window of ``days`` days that holds any, by its first day, from daily counts of all batches."""
    daily = counts.groupBy(key, "day").agg(F.sum("events").alias("events"))
    starts = F.explode(F.sequence(F.col("day") - F.expr(f"interval {days - 1} days"), F.col("day"), F.expr("interval 1 day")))
    return daily.withColumn("start", starts).groupBy(key, "start").agg(F.sum("events").alias("events"))


class _LastSnapshot(StatefulProcessor):
    """The last snapshot of a site; every later one is compared with the one before it."""

    def __init__(self, state: StructType, out: list[str], at: str):
        self.fields, self.out, self.at = state, out, at

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(self.at, kind="stable")
        names = list(self.fields.names)
        held = pd.DataFrame([self.last.get()], columns=names) if self.last.exists() else new.iloc[:0][names]
        if len(held):  # what is older than the last snapshot has no known one before it
            new = new[new[self.at] > held[self.at].iloc[0]]
        chain = pd.concat([held, new[names]]) if len(held) else new[names]
        if not len(new):
            return
        before = chain.shift(1).iloc[1:]
        now = chain.iloc[1:]
        differs = {c: ~((now[c] == before[c]) | (now[c].isna() & before[c].isna())) for c in ("hash", "title", "meta_description")}
        out = pd.DataFrame({
            self.out[0]: key[0], self.out[1]: now[self.at], "content_changed": differs["hash"], "title_changed": differs["title"],
            "description_changed": differs["meta_description"], "title_from": before["title"], "title_to": now["title"],
        })
        end = chain.iloc[-1]
        self.last.update(tuple(None if pd.isna(end[c]) else end[c].item() if hasattr(end[c], "item") else end[c] for c in names))
        out = out[out["content_changed"] | out["title_changed"] | out["description_changed"]]
        if len(out):
            yield out

    def close(self) -> None:
        pass


def page_changes(stream: DataFrame, key: str, at: str) -> DataFrame:
    """What changed against the snapshot before, of every snapshot newer than the last one known of its site.

    The engine keeps one row a site. First and unchanged snapshots give nothing; one older than the last known gives nothing either, as
    what stood before it is not kept. ``at`` must order a site's snapshots and be a number or a time.
    """
    _on_disk(stream.sparkSession)
    columns = [at, "hash", "title", "meta_description"]
    state = stream.select(*columns).schema
    kind = dict(stream.dtypes)
    out = f"{key} {kind[key]}, {at} {kind[at]}, content_changed boolean, title_changed boolean, description_changed boolean, title_from string, title_to string"
    processor = _LastSnapshot(state, [key, at], at)
    return stream.select(key, *columns).groupBy(key).transformWithStateInPandas(processor, out, "Append", "None")


def resolve_step(folder: str, companies: SnapshotTable):
    """Batch step: signals (id, text, url, source) with label, amount and company, the latter by host, else by an alias in the text.

    The companies are the newest version at the time of each batch, so one added today is found in tomorrow's batch by a query that
    never stopped. The version used is written beside each row.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        version = companies.newest()
        known = companies.read(version)
        rows = classify.classify(batch, "text", "source")
        rows = rows.withColumn("event_type", classify.label_title(F.col("label"))).withColumn("amount_usd", amount_usd(F.col("text")))
        host = resolve.by_domain(batch.select("id", "url"), known).select("id", F.col("company_id").alias("by_host"))
        open_ = batch.select("id", F.col("text").alias("title")).join(host, "id", "left_anti")
        alias = resolve.by_title_alias(open_, known).select("id", F.col("company_id").alias("by_alias"))
        out = rows.join(host, "id", "left").join(alias, "id", "left")
        out = out.withColumn("company_id", F.coalesce("by_host", "by_alias"))
        out = out.withColumn("method", F.when(F.col("by_host").isNotNull(), "domain").when(F.col("by_alias").isNotNull(), "alias"))
        out.drop("by_host", "by_alias").withColumn("company_version", F.lit(version)).write.mode("overwrite").parquet(_batch(folder, batch_id))

    return step
