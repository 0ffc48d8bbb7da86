"""A table in key buckets, changed copy-on-write, with every version readable.

Parquet has no MERGE. Here a table is split by a hash of its key into buckets, one folder
of files each. A change rewrites only the buckets that hold its keys, into a new folder,
and then publishes a new version: one small manifest file that names, for every bucket,
the folder with its rows. Readers take the newest manifest; a writer that fails before
it publishes leaves nothing visible, and old versions stay readable as long as their
folders are kept.

* The manifest is the only pointer. It is one file, which Spark's committer moves into
  place when its job commits; a version that already exists is never overwritten.
* A change reads the buckets it touches, not the table. What reaches the driver is one
  row per bucket (manifest, touched buckets); choose ``buckets`` so that one is a few
  hundred MB.
* Unchanged buckets share their files with the version before, so what changed between two
  versions (:meth:`VersionedTable.changes`) is read from the differing buckets only.

One writer at a time: a second one that publishes the same version fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.dedup import upsert
from strata.session import scratch_path

_BUCKET = "table_bucket"
_MANIFEST = "bucket int, folder string, rows long, row_schema string, writer string"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class VersionedTable:
    """``path`` holds the table; rows belong to the bucket of their ``key`` (NULL is a key)."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # ------------------------------------------------------------ versions

    def _manifests(self) -> DataFrame:
        return self.spark.read.schema(_MANIFEST + ", version long").parquet(f"{self.path}/versions")

    def versions(self) -> list[int]:
        """Numbers of the published versions."""
        try:
            return sorted(r[0] for r in self._manifests().select("version").distinct().collect())
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def current(self) -> int:
        """The newest version (0: none yet)."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """Folder of each bucket that has rows (at most one entry per bucket)."""
        return self._at(version)[0]

    def schema(self, version: int | None = None) -> StructType:
        return self._at(version)[1]

    def _rows(self, version: int | None) -> list:
        version = self.current() if version is None else version
        rows = self._manifests().where(F.col("version") == version).collect() if version else []
        if not rows:
            raise ValueError(f"{self.path} has no version {version}")
        return rows

    def _at(self, version: int | None) -> tuple[dict[int, str], StructType]:
        """Folders by bucket, and the schema, of a version."""
        rows = self._rows(version)
        return {r.bucket: r.folder for r in rows if r.rows}, StructType.fromJson(json.loads(rows[0].row_schema))

    # ------------------------------------------------------------ reading

    def _read(self, folders: dict[int, str], schema: StructType) -> DataFrame:
        paths = [f"{self.path}/data/{folder}/{_BUCKET}={bucket}" for bucket, folder in sorted(folders.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (default: the newest)."""
        return self._read(*self._at(version))

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of ``keys`` (the key column, no NULLs), read from their buckets only."""
        touched = {r[0] for r in keys.select(self._bucket()).distinct().collect()}  # at most ``buckets`` numbers
        folders, schema = self._at(version)
        found = self._read({b: f for b, f in folders.items() if b in touched}, schema)
        return found.join(keys.select(self.key), self.key, "left_semi")

    def changes(self, before: int, after: int) -> DataFrame:
        """Rows of ``after`` that ``before`` lacks (``_sign`` 1) and the reverse (-1), with
        multiplicity; only buckets that differ are read."""
        old = self.manifest(before) if before else {}
        new, schema = self._at(after)
        differ = {b for b in old.keys() | new.keys() if old.get(b) != new.get(b)}
        sides = [
            self._read({b: f for b, f in side.items() if b in differ}, schema).withColumn("_sign", F.lit(sign))
            for side, sign in ((old, -1), (new, 1))
        ]
        counted = sides[0].unionByName(sides[1]).groupBy(*schema.names).agg(F.sum("_sign").alias("_sign"))
        copies = F.array_repeat(F.signum("_sign").cast("int"), F.abs("_sign").cast("int"))
        return counted.where("_sign <> 0").select(*schema.names, F.explode(copies).alias("_sign"))

    # ------------------------------------------------------------ writing

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _publish(self, version: int, rows: list[tuple], schema: StructType) -> int:
        writer = uuid.uuid4().hex
        text = schema.json()
        listed = [(b, f, n, text, writer) for b, f, n in rows] or [(0, "", 0, text, writer)]
        manifest = self.spark.createDataFrame(listed, _MANIFEST).coalesce(1)
        manifest.write.mode("errorifexists").parquet(f"{self.path}/versions/version={version}")
        if {r.writer for r in self._rows(version)} != {writer}:
            raise RuntimeError(f"another writer published version {version} of {self.path}")
        return version

    def _write(self, df: DataFrame) -> list[tuple]:
        """Write rows into a new folder, one or more files per bucket; (bucket, folder, rows).

        Rows are placed by bucket; a bucket that is large for one task is dealt to several.
        """
        folder = uuid.uuid4().hex[:16]
        out = f"{self.path}/data/{folder}"
        placed = df.withColumn(_BUCKET, self._bucket()).hint("rebalance", F.col(_BUCKET))
        placed.write.partitionBy(_BUCKET).parquet(out)
        schema = StructType.fromDDL(f"{_BUCKET} int")
        counts = self.spark.read.schema(schema).parquet(out).groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
        return [(r[0], folder, r[1]) for r in counts]

    def create(self, df: DataFrame) -> int:
        """Publish ``df`` as the whole table."""
        return self._publish(self.current() + 1, self._write(df), df.schema)

    def _commit(self, rows: DataFrame, keys: DataFrame | None, merge: Merge) -> int:
        """A new version: ``merge(base, rows)`` in the buckets that ``rows`` or ``keys`` touch."""
        version = self.current()
        listed = self._rows(version)
        schema = StructType.fromJson(json.loads(listed[0].row_schema))
        change = staged(rows)  # computed once
        touching = change.select(self.key) if keys is None else change.select(self.key).union(keys.select(self.key))
        touched = {r[0] for r in touching.select(self._bucket()).distinct().collect()}  # at most ``buckets`` numbers
        before = {r.bucket: (r.folder, r.rows) for r in listed if r.rows}
        base = self._read({b: before[b][0] for b in touched if b in before}, schema)
        merged = merge(base, change).select(*schema.names)
        kept = [(b, f, n) for b, (f, n) in before.items() if b not in touched]
        return self._publish(version + 1, kept + self._write(merged) if touched else kept, schema)

    def upsert(self, changes: DataFrame, version: str, delete_flag: str | None = None) -> int:
        """Publish the table with the newest row of each key, see ``operators.dedup.upsert``."""
        return self._commit(changes, None, lambda base, new: upsert(base, new, self.key, version, delete_flag))

    def replace(self, rows: DataFrame, keys: DataFrame) -> int:
        """Publish the table with all rows of ``keys`` gone and ``rows`` in their place."""
        keys = staged(keys.select(self.key).distinct())

        def merge(base: DataFrame, new: DataFrame) -> DataFrame:
            gone = keys.unionByName(new.select(self.key)).distinct().withColumnRenamed(self.key, "_gone")
            return base.join(gone, F.col(self.key).eqNullSafe(F.col("_gone")), "left_anti").unionByName(new)

        return self._commit(rows, keys, merge)


    def add(self, delta: DataFrame, sums: Sequence[str], present: str) -> int:
        """Publish the table with ``delta`` added to the ``sums`` of its keys (both have one row per
        key and the same columns); a key whose ``present`` sum reaches 0 leaves the table."""

        def merge(base: DataFrame, new: DataFrame) -> DataFrame:
            types = {f.name: f.dataType for f in base.schema.fields}
            total = base.unionByName(new.select(*base.columns)).groupBy(self.key).agg(
                *[F.sum(c).cast(types[c]).alias(c) for c in sums]
            )
            return total.where(F.col(present) != 0)

        return self._commit(delta, None, merge)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, "change")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
