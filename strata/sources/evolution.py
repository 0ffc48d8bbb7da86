"""Reading a table whose files were written with different schemas.

``read_evolving`` merges file schemas by column *name*: added columns survive.
``MappedTable`` identifies columns by Parquet *field id* instead. A log of schema versions
gives every column an id that is never used again, so renamed, reordered, dropped and
widened columns are read right from files of any age, without rewriting one.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

_FIELD_ID = "parquet.field.id"
_READ_IDS = "spark.sql.parquet.fieldId.read.enabled"


def read_evolving(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Union of all file schemas; columns missing from older files read as NULL."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


class MappedTable:
    """``path/loads`` holds the files of each load, ``path/schemas`` one schema per version.

    A column that was added later is NULL in older loads; a dropped one is no longer read,
    and a new column of the same name does not see its values. Widening is what Parquet
    readers convert (int to long, float to double, ...); narrowing fails.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ schema log

    def create(self, schema: StructType) -> StructType:
        return self._log(1, [StructField(f.name, f.dataType, True, {_FIELD_ID: i}) for i, f in enumerate(schema, 1)], len(schema.fields))

    def _log(self, version: int, fields: Sequence[StructField], used: int) -> StructType:
        schema = StructType(list(fields))
        row = self.spark.createDataFrame([(schema.json(), used)], "fields string, used long").coalesce(1)
        row.write.mode("errorifexists").parquet(f"{self.path}/schemas/version={version}")
        return schema

    def _latest(self) -> tuple[int, StructType, int]:
        log = self.spark.read.schema("fields string, used long, version long").parquet(f"{self.path}/schemas")
        newest = log.orderBy(F.desc("version")).first()
        return newest.version, StructType.fromJson(json.loads(newest.fields)), newest.used

    @property
    def schema(self) -> StructType:
        return self._latest()[1]

    def evolve(
        self,
        rename: Mapping[str, str] | None = None,
        widen: Mapping[str, DataType] | None = None,
        drop: Sequence[str] = (),
        add: Mapping[str, DataType] | None = None,
        order: Sequence[str] | None = None,
    ) -> StructType:
        """Log the next schema. Keys are names of the current one; ``order`` lists the new names."""
        version, schema, used = self._latest()
        rename, widen, add = rename or {}, widen or {}, add or {}
        unknown = (set(rename) | set(widen) | set(drop)) - set(schema.names)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        fields = [
            StructField(rename.get(f.name, f.name), widen.get(f.name, f.dataType), True, f.metadata)
            for f in schema
            if f.name not in drop
        ]
        for i, (name, kind) in enumerate(add.items(), used + 1):
            fields.append(StructField(name, kind, True, {_FIELD_ID: i}))
        names = [f.name for f in fields]
        if len({n.lower() for n in names}) < len(names) or (order and sorted(order) != sorted(names)):
            raise ValueError(f"columns {names}, order {order}")
        if order:
            fields.sort(key=lambda f: list(order).index(f.name))
        return self._log(version + 1, fields, used + len(add))

    # ------------------------------------------------------------ data

    def append(self, df: DataFrame, load: str) -> None:
        """Write a load under the newest schema; writing it again replaces it."""
        schema = self.schema
        if sorted(df.columns) != sorted(schema.names):
            raise ValueError(f"load has {df.columns}, the table {schema.names}")
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema]
        df.select(*columns).write.mode("overwrite").parquet(f"{self.path}/loads/load={load}")

    def read(self) -> DataFrame:
        """All loads under the newest schema. The frame belongs to a session of its own, in which
        Parquet columns are matched by id."""
        session = self.spark.newSession()
        for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
            session.conf.set(key, self.spark.conf.get(key))
        session.conf.set(_READ_IDS, "true")
        return session.read.schema(self.schema).parquet(f"{self.path}/loads").select(*self.schema.names)
