"""Streams over several batches: late keys, repeats across batches, restarts, replays, companies added between batches."""

from __future__ import annotations

import datetime as dt

from dealweave.sources.snapshots import SnapshotTable
from dealweave.streaming import streams

DAY = dt.datetime(2024, 6, 1)
SIGNAL = "id long, source string, signal_type string, detected_at timestamp"


def signals(spark, rows):
    return spark.createDataFrame([(i, s, k, DAY + dt.timedelta(days=d)) for i, s, k, d in rows], SIGNAL)


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def opened(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_late_keys_repeats_and_restarts(spark, tmp_path):
    landed, log, cp = (str(tmp_path / x) for x in ("landed", "log", "cp"))

    def run():
        rows = opened(spark, landed, SIGNAL)
        streams.run_to_files(streams.unseen(rows, ["source", "signal_type"], ["detected_at", "id"]), log, cp)

    # each batch is followed by a restart from the checkpoint; the last key is 150 days late
    for rows in ([(1, "a", "x", 0), (2, "a", "x", 1)], [(3, "a", "y", 1), (4, "a", "x", 2)], [(5, "b", "x", -150), (6, "a", "y", 9), (7, None, "x", 0), (8, None, "x", 1)]):
        land(signals(spark, rows), landed)
        run()
    run()  # nothing new
    assert sorted(r.id for r in spark.read.parquet(log).collect()) == [1, 3, 5, 7]
    land(signals(spark, [(9, "b", "x", 150), (10, None, "x", 0)]), landed)  # a key seen long ago
    run()
    assert sorted(r.id for r in spark.read.parquet(log).collect()) == [1, 3, 5, 7]


def test_a_hot_key_shrinks_before_the_shuffle():
    import pandas as pd

    rows = pd.DataFrame({"k": ["a"] * 1000 + ["b"], "id": range(1001, 0, -1)})
    (got,) = streams._first_of_each(["k"], ["id"])([rows])
    assert got.values.tolist() == [["b", 1], ["a", 2]]


def test_alerts_are_sent_once(spark, tmp_path):
    from dealweave import views
    from dealweave.catalog.rank_q import RULES

    rows = views.table(spark, "/root/testdata/sf0.001", "v_events")
    landed, ledger, cp = (str(tmp_path / x) for x in ("landed", "ledger", "cp"))
    for _ in range(3):
        land(rows, landed)
        streams.run_to_files(streams.unsent_alerts(opened(spark, landed, rows.schema), RULES, "chat"), ledger, cp)
    sent = spark.read.parquet(ledger)
    assert sent.count() == sent.select("event_id", "channel").distinct().count() > 0


def test_daily_counts_add_up_over_batches(spark, tmp_path):
    step = streams.daily_count_step(str(tmp_path), "source", "detected_at")
    step(signals(spark, [(1, "a", "x", 0), (2, "a", "x", 0), (3, "b", "x", 3)]), 0)
    step(signals(spark, [(4, "a", "x", 0), (5, "a", "x", -400)]), 1)
    got = {(r.source, r.start.date()): r.events for r in streams.velocity(spark.read.parquet(str(tmp_path)), "source", 2).collect()}
    day = DAY.date()
    assert got[("a", day)] == 3 and got[("a", day - dt.timedelta(days=1))] == 3 and got[("a", day - dt.timedelta(days=400))] == 1 and len(got) == 6


def test_page_changes_across_batches(spark, tmp_path):
    schema = "page_id long, host string, hash string, title string, meta_description string"
    landed, changes, cp = (str(tmp_path / x) for x in ("landed", "changes", "cp"))
    batches = [[(1, "a"), (2, "a")], [(3, "b")], [(5, "c"), (4, "b")], [(2, "late")], [(6, None)], [(7, None)]]
    for rows in batches:
        land(spark.createDataFrame([(i, "h", h, "t", None) for i, h in rows], schema), landed)
        streams.run_to_files(streams.page_changes(opened(spark, landed, schema), "host", "page_id"), changes, cp)
    got = sorted((r.page_id, r.content_changed, r.title_changed, r.description_changed) for r in spark.read.parquet(changes).collect())
    assert got == [(3, True, False, False), (5, True, False, False), (6, True, False, False)]


def test_a_company_added_between_two_batches_is_found(spark, tmp_path):
    company = "company_id long, name string, slug string, website string, x_handle string"
    table = SnapshotTable(spark, str(tmp_path / "companies"), ["company_id"], buckets=4)
    table.create(spark.createDataFrame([(1, "Acme Robots", "acme-robots", "https://acme.io", None)], company))
    schema = "id long, text string, url string, source string"
    landed, out, cp = (str(tmp_path / x) for x in ("landed", "out", "cp"))
    news = [("Globex raises $5 million", "https://news.example.org/a"), ("Something new", "https://blog.acme.io/b"), ("Nothing", None)]
    land(spark.createDataFrame([(i, *n, "rss") for i, n in enumerate(news)], schema), landed)

    def then(batch, batch_id):
        streams.resolve_step(out, table)(batch, batch_id)
        if batch_id == 0:  # while the query goes on
            table.merge(spark.createDataFrame([(2, "Globex", "globex", "https://globex.com", "@globex")], company))
            land(spark.createDataFrame([(i + 10, *n, "rss") for i, n in enumerate(news)], schema), landed)

    rows = opened(spark, landed, schema)
    streams.run_batches(rows, then, cp)
    streams.run_batches(rows, then, cp)
    got = {r.id: (r.company_id, r.method, r.company_version) for r in spark.read.parquet(out).collect()}
    assert got == {0: (None, None, 1), 1: (1, "domain", 1), 2: (None, None, 1), 10: (2, "alias", 2), 11: (1, "domain", 2), 12: (None, None, 2)}


def test_a_batch_of_landed_rows_keeps_all_cores_busy(spark, tmp_path):
    from dealweave.catalog import plan_q
    from dealweave.catalog.registry import Tables

    rows = spark.range(3000).selectExpr("id", "id % 50 as host")
    seen = []
    streams.run_batches(plan_q.landed(Tables(spark, ""), rows, "id", "host"), lambda batch, i: seen.append((batch.rdd.getNumPartitions(), batch.agg({"id": "min"}).first()[0], batch.count())), str(tmp_path / "cp"))
    assert sum(n for _, _, n in seen) == 3000 and len(seen) == plan_q.BATCHES
    assert all(n == spark.sparkContext.defaultParallelism for n, _, _ in seen)
    assert [low for _, low, _ in seen] == sorted(low for _, low, _ in seen)
