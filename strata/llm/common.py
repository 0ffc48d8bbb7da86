"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: ASCII white space that separates words; everything else is part of a word.
SPACE = r"[\x20\x09-\x0D]"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+", -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words (null: 0), without keeping the words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE + "+", -1))).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(df: DataFrame, prefix: str) -> str:
    """A column name starting with ``prefix`` that ``df`` does not use (in any letter case)."""
    used = {c.lower() for c in df.columns}
    name = prefix
    while name.lower() in used:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the session's shared scratch folder and read it back: cuts the
    lineage, so a lost executor repeats nothing that came before."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, wherever it was imported from."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        archive = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}_package.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema)
