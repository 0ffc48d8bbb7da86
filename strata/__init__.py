"""strata: layered (raw -> validated -> mart) retail analytics on Spark DataFrames.

Every transform is a pure ``DataFrame -> DataFrame`` function; only the
``sources`` sinks/readers, ``streaming`` and ``plans.layers`` touch storage.

Entry points:

* ``strata.queries.REGISTRY`` – every registered query, ``(spark, sf_dir) -> DataFrame``;
* ``strata.plans.layers.run_all`` – the on-disk run of all layers (also ``python -m strata``);
* ``strata.plans.gold`` / ``strata.plans.metrics`` – the marts and metrics as functions of tables;
* ``strata.operators`` – quality rules, dedup/upsert, skew-aware joins, balanced windows;
* ``strata.streaming.events`` – stream ingestion, dedup and windowed counts.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
