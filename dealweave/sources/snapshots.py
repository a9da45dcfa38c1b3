"""A keyed table kept as versions, merged by rewriting only the buckets that a merge touches.

Rows lie in folders by a hash of their key. A version is a manifest, one small file that names the folder of every bucket; the
folders themselves never change. A merge writes new folders for the buckets its source has keys in and then, last, the manifest of
the next version, which takes all other buckets over by name. Whoever reads an older version goes on reading its folders, and
a merge that dies before its manifest leaves nothing but folders that no version names, until ``vacuum`` removes them.

One merge runs at a time: it refuses to write a version that another has written meanwhile.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import keyed

BUCKETS = 64
_BUCKET = "__snapshot_bucket"


class Conflict(RuntimeError):
    """Another merge has written the version meanwhile."""


class SnapshotTable:
    """Versions of a table with unique ``keys`` under ``folder``, which all executors share.

    ``buckets`` counts for a new table only and then stays; it should leave a bucket at some hundred MB. A bucket may consist of
    several files, so that no task has to write a large one alone. Rows whose key is null match no other row.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), list(keys), buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- versions ---------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Versions that can be read, the oldest first."""
        names = [n for n in self._names("versions") if n.startswith("v") and n.endswith(".json")]
        return sorted(int(n[1:-5]) for n in names)

    def newest(self) -> int | None:
        return max(self.versions(), default=None)

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, the newest by default; of some buckets only, if they are named."""
        held = self._manifest(self._known(version))
        schema = StructType.fromJson(held["schema"])
        paths = [f"{self.folder}/{p}" for b, p in held["paths"].items() if buckets is None or int(b) in buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def changed(self, old: int, new: int) -> list[int]:
        """Buckets that two versions do not share."""
        a, b = self._manifest(old)["paths"], self._manifest(new)["paths"]
        return sorted(int(k) for k in {*a, *b} if a.get(k) != b.get(k))

    # -- changes ----------------------------------------------------------------------------------

    def create(self, rows: DataFrame) -> int:
        """Version 1; the rows' keys must be unique."""
        if self.versions():
            raise Conflict(f"{self.folder} has versions already")
        return self._commit(None, rows.schema, rows, None)

    def merge(self, source: DataFrame, policy: dict[str, str] | None = None, default: str = "overwrite", order: str | None = None) -> int:
        """Upsert ``source`` with a policy per column (see ``keyed.POLICIES``), as the next version.

        Several reports of a key are upserted one after another by ``order``; without it, keys must be unique. Columns that only the
        source has are left out, and those that it lacks keep their values. ``insert_ignore`` is the default policy "keep".
        """
        version = self._known(None)
        policy = policy or {}
        if order is not None:
            source = keyed.fold(source, self.keys, order, policy, default)
        held = self._manifest(version)
        schema = StructType.fromJson(held["schema"])
        source = source.select(*[c for c in schema.names if c in source.columns])
        staged, touched = self._stage(source)
        old = self.read(version, touched)
        merged = keyed.merge_upsert(old, staged, self.keys, policy, default)
        types = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        return self._commit(version, schema, merged.select(*types), touched)

    def delete(self, keys: DataFrame) -> int:
        """The next version, without the rows of these keys."""
        version = self._known(None)
        staged, touched = self._stage(keys.select(*self.keys).distinct())
        old = self.read(version, touched)
        return self._commit(version, old.schema, old.join(staged, self.keys, "left_anti").select(*old.columns), touched)

    def replace(self, source: DataFrame, owners: DataFrame, owner: str) -> int:
        """The next version is the source, less rows whose owner is gone; buckets that stay empty lose their folder."""
        version = self._known(None)
        rows = keyed.replace_or_drop(source, owners, owner)
        schema = StructType.fromJson(self._manifest(version)["schema"])
        return self._commit(version, schema, rows.select(*schema.names), None)

    def vacuum(self, keep: int = 2) -> list[int]:
        """Forget all but the newest ``keep`` versions and delete the folders that no remaining one names; gives the versions forgotten.

        Not to be called while a merge runs: its folders have no name yet.
        """
        known = self.versions()
        gone = known[:-keep] if keep else known
        for v in gone:
            self._files.delete(self._path(self._manifest_path(v)), False)
        used = {p.split("/")[1] for v in known if v not in gone for p in self._manifest(v)["paths"].values()}
        for top in ("data", "staged"):
            for name in self._names(top):
                if top == "staged" or name not in used:
                    self._files.delete(self._path(f"{self.folder}/{top}/{name}"), True)
        return gone

    # -- files ------------------------------------------------------------------------------------

    def _known(self, version: int | None) -> int:
        version = self.newest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"{self.folder} has no version")
        return version

    def _names(self, below: str) -> list[str]:
        path = self._path(f"{self.folder}/{below}")
        return [s.getPath().getName() for s in self._files.listStatus(path)] if self._files.exists(path) else []

    def _manifest_path(self, version: int) -> str:
        return f"{self.folder}/versions/v{version:012d}.json"

    def _manifest(self, version: int) -> dict:
        return json.loads(self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0])

    def _bucket_of(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _stage(self, source: DataFrame) -> tuple[DataFrame, list[int]]:
        """The source written once, and the buckets it has keys in: a list of at most as many numbers as there are buckets."""
        held = self._manifest(self._known(None))
        name = f"staged/{uuid.uuid4().hex}"
        source.withColumn(_BUCKET, self._bucket_of(held["buckets"])).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.folder}/{name}")
        touched = sorted(int(n.split("=")[1]) for n in self._names(name) if n.startswith(f"{_BUCKET}="))
        paths = [f"{self.folder}/{name}/{_BUCKET}={b}" for b in touched]
        staged = self.spark.read.schema(source.schema).parquet(*paths) if paths else self.spark.createDataFrame([], source.schema)
        return staged, touched

    def _commit(self, version: int | None, schema: StructType, rows: DataFrame, touched: list[int] | None) -> int:
        """Write ``rows`` as the buckets ``touched`` (None: all) and name the result the version after ``version``."""
        held = {"paths": {}, "buckets": self.buckets} if version is None else self._manifest(version)
        data = f"data/{uuid.uuid4().hex}"
        rows = rows.withColumn(_BUCKET, self._bucket_of(held["buckets"])).hint("rebalance", _BUCKET)
        rows.write.partitionBy(_BUCKET).parquet(f"{self.folder}/{data}")
        paths = {b: p for b, p in held["paths"].items() if touched is not None and int(b) not in touched}
        for n in self._names(data):
            if n.startswith(f"{_BUCKET}="):
                paths[n.split("=")[1]] = f"{data}/{n}"
        new = (version or 0) + 1
        body = {"version": new, "keys": self.keys, "buckets": held["buckets"], "schema": json.loads(schema.json()), "paths": paths}
        self._publish(new, json.dumps(body))
        return new

    def _publish(self, version: int, text: str) -> None:
        """The one step that makes a version: a finished file takes its name, unless there is one already."""
        final, draft = self._path(self._manifest_path(version)), self._path(f"{self.folder}/drafts/{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        self._files.mkdirs(final.getParent())
        if self._files.exists(final) or not self._files.rename(draft, final):
            raise Conflict(f"version {version} of {self.folder} is there already")
