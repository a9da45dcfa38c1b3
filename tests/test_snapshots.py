"""Versions of a keyed table: merges in a row, readers of old versions, killed and competing merges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dealweave.operators import keyed
from dealweave.sources.snapshots import Conflict, SnapshotTable

COLUMNS = "k long, name string, score double, flag boolean"


def rows(spark, *data):
    return spark.createDataFrame(list(data), COLUMNS)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def base(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    assert table.create(rows(spark, *[(i, f"n{i}", float(i), False) for i in range(40)])) == 1
    return table


def test_two_merges_in_a_row(spark, base):
    policy = {"name": "fill", "score": "max", "flag": "or"}
    first = rows(spark, (3, "x", 1.0, True), (50, "new", None, None))
    second = rows(spark, (3, "y", 9.0, False), (50, None, 2.0, True))
    want1 = content(keyed.merge_upsert(base.read(1), first, ["k"], policy))
    assert base.merge(first, policy) == 2
    want2 = content(keyed.merge_upsert(base.read(2), second, ["k"], policy))
    assert base.merge(second, policy) == 3
    assert content(base.read(2)) == want1 and content(base.read()) == want2 and base.read(1).count() == 40
    assert {r.k: tuple(r)[1:] for r in base.read().filter("k in (3, 50)").collect()} == {3: ("n3", 9.0, True), 50: ("new", 2.0, True)}


def test_only_touched_buckets_are_written(spark, base):
    one = rows(spark, (7, "seven", 0.0, True))
    base.merge(one)
    own = one.select(base._bucket_of(8)).first()[0]
    assert base.changed(1, 2) == [own]
    files = base.read(2).select(F.input_file_name()).distinct().count()
    assert files <= base.read(1).select(F.input_file_name()).distinct().count()


def test_reader_of_version_one_during_version_two(spark, base):
    reader = base.read(1).filter("k < 10")
    base.merge(rows(spark, *[(i, "changed", 0.0, True) for i in range(40)]))
    base.delete(rows(spark, (0, None, None, None)).select("k"))
    assert {r.name for r in reader.collect()} == {f"n{i}" for i in range(10)}
    assert base.read().count() == 39 and base.versions() == [1, 2, 3]


def test_a_killed_merge_leaves_version_one(spark, base, monkeypatch):
    before = content(base.read())

    def die(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(base, "_publish", die)
    with pytest.raises(KeyboardInterrupt):
        base.merge(rows(spark, (1, "lost", 0.0, True)))
    monkeypatch.undo()
    assert base.versions() == [1] and content(base.read()) == before
    assert len(base._names("data")) == 2
    base.vacuum()
    assert len(base._names("data")) == 1 and content(base.read()) == before
    assert base.merge(rows(spark, (1, "kept", 0.0, True))) == 2


def test_the_second_of_two_competing_merges_is_refused(spark, base, monkeypatch):
    other = SnapshotTable(spark, base.folder, ["k"])
    real, once = SnapshotTable._publish, []

    def late(self, version, text):
        if not once:
            once.append(1)
            other.merge(rows(spark, (2, "other", 0.0, True)))
        real(self, version, text)

    monkeypatch.setattr(SnapshotTable, "_publish", late)
    with pytest.raises(Conflict):
        base.merge(rows(spark, (2, "mine", 0.0, True)))
    assert base.read().filter("k = 2").first().name == "other"


def test_reports_in_order_and_missing_columns(spark, base):
    reports = spark.createDataFrame([(5, "b", 2), (5, "a", 1), (60, "c", 3)], "k long, name string, at int")
    base.merge(reports, {"name": "overwrite"}, order="at")
    got = {r.k: (r.name, r.score) for r in base.read().filter("k in (5, 60)").collect()}
    assert got == {5: ("b", 5.0), 60: ("c", None)}


def test_replace_drops_what_the_source_lacks(spark, base):
    base.replace(rows(spark, (1, "one", 1.0, True), (2, "two", 1.0, True)), spark.createDataFrame([(2,)], "k long"), "k")
    assert content(base.read()) == [(2, "two", 1.0, True)] and base.read(1).count() == 40


def test_null_keys_empty_sources_and_vacuum(spark, base):
    base.merge(rows(spark, (None, "nobody", 1.0, True)))
    base.merge(rows(spark))
    assert base.read().count() == 41 and base.read().filter("k is null").first().name == "nobody"
    assert base.changed(2, 3) == []
    assert base.vacuum(1) == [1, 2] and base.versions() == [3] and base.read().count() == 41
    with pytest.raises(FileNotFoundError):
        SnapshotTable(spark, base.folder + "-none", ["k"]).read()
