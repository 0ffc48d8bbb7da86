"""Quality rules: split rows into valid / rejected, metrics and gates.

A rule is a named predicate that is true when a row fails. Rejected rows
carry one reason per table (``_dq_reason``); ``failed_rules`` lists every
rule a row breaks. The split uses ``total`` predicates, so each input row
lands on exactly one side, whatever NULLs it holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.predicates import is_missing, total
from strata.schemas import DATASETS

REJECTED_FLAG = "_dq_rejected"
REASON = "_dq_reason"
FAILED_RULES = "_dq_failed_rules"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def rules_for(dataset: str, schema: StructType | None = None) -> list[Rule]:
    """The declared rules per table; tables without rules pass everything.

    ``schema`` is that of the rows to judge: text ids (as in CSV sources) must
    not be blank, integer ids only not NULL.
    """
    schema = schema if schema is not None else DATASETS[dataset].schema

    def missing(column: str) -> Rule:
        return Rule(f"{column}_missing", is_missing(column, schema[column].dataType))

    if dataset == "customers":
        return [missing("customer_id"), missing("email")]
    if dataset == "order_items":
        q, p = F.col("quantity"), F.col("unit_price")
        return [
            missing("order_item_id"),
            missing("order_id"),
            missing("product_id"),
            Rule("quantity_not_positive", q.isNull() | (q <= 0)),
            # NaN < 0 is false in Spark, so a NaN price passes, as 0 does.
            Rule("unit_price_negative", p.isNull() | (p < 0)),
        ]
    return []


# Fixed reject reasons per table (one reason per table).
REASONS = {
    "customers": "missing_required_customer_fields",
    "order_items": "invalid_order_item",
}


def rejected_flag(rules: list[Rule]) -> Column:
    if not rules:
        return F.lit(False)
    any_failed = rules[0].fails
    for rule in rules[1:]:
        any_failed = any_failed | rule.fails
    return total(any_failed)


def failed_rules(rules: list[Rule]) -> Column:
    """array<string> of the names of the rules a row breaks (empty if none)."""
    if not rules:
        return F.array().cast("array<string>")
    return F.filter(
        F.array(*[F.when(total(r.fails), F.lit(r.name)) for r in rules]),
        lambda x: x.isNotNull(),
    )


def flag(df: DataFrame, dataset: str) -> DataFrame:
    """Adds the boolean ``_dq_rejected`` column."""
    return df.withColumn(REJECTED_FLAG, rejected_flag(rules_for(dataset, df.schema)))


def split_by_quality(
    df: DataFrame, dataset: str, with_failed_rules: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows get ``_dq_reason`` and, on request,
    ``_dq_failed_rules`` (every rule the row breaks)."""
    rules = rules_for(dataset, df.schema)
    bad = rejected_flag(rules)
    valid = df.where(~bad)
    extra = {REASON: F.lit(REASONS.get(dataset, "rejected"))}
    if with_failed_rules:
        extra[FAILED_RULES] = failed_rules(rules)
    rejected = df.where(bad).withColumns(extra)
    return valid, rejected


def quality_metrics(df: DataFrame, dataset: str, batch_id: str) -> DataFrame:
    """One metrics row for a raw table, in a single aggregation pass.

    ``valid_records`` counts rows *after* dedup of the valid side (distinct
    keys; all NULL keys collapse into one row, as dedup does), so
    ``input = valid + rejected + duplicates``.
    """
    key = F.col(DATASETS[dataset].key)
    bad = rejected_flag(rules_for(dataset, df.schema))
    agg = df.select(key.alias("_k"), bad.alias("_bad")).agg(
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(F.col("_bad")).alias("rejected_records"),
        (
            F.count_distinct(F.when(~F.col("_bad"), F.col("_k")))
            + F.max(F.when(~F.col("_bad") & F.col("_k").isNull(), 1).otherwise(0))
        ).alias("valid_records"),
    )
    valid = F.coalesce(F.col("valid_records"), F.lit(0)).cast("bigint")
    return agg.select(
        F.lit(dataset).alias("dataset"),
        "input_records",
        valid.alias("valid_records"),
        "rejected_records",
        (F.col("input_records") - valid - F.col("rejected_records")).alias("duplicate_records"),
        F.coalesce(F.try_divide(valid, F.col("input_records")), F.lit(0.0)).alias("quality_rate"),
        F.lit(batch_id).alias("batch_id"),
    )


def rule_failures(df: DataFrame, dataset: str) -> DataFrame:
    """Per rule: rows failing it, and its failure rate (one pass, one row per rule)."""
    rules = rules_for(dataset, df.schema)
    if not rules:
        return df.sparkSession.createDataFrame([], "dataset string, rule string, failures bigint, rate double")
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(total(r.fails)).alias(r.name) for r in rules],
    )
    stacked = counts.select(
        "_n",
        F.explode(
            F.array(
                *[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("failures")) for r in rules]
            )
        ).alias("r"),
    )
    return stacked.select(
        F.lit(dataset).alias("dataset"),
        F.col("r.rule").alias("rule"),
        F.col("r.failures").alias("failures"),
        F.coalesce(F.try_divide(F.col("r.failures"), F.col("_n")), F.lit(0.0)).alias("rate"),
    )


def quality_gate(metrics: DataFrame, min_quality_rate: float) -> DataFrame:
    """Adds ``passed``; a batch fails when any table's rate is below the bar."""
    return metrics.withColumn("passed", F.col("quality_rate") >= F.lit(min_quality_rate))


def enforce_gate(metrics: DataFrame, min_quality_rate: float) -> DataFrame:
    """Like :func:`quality_gate` but the job fails (``raise_error``) on a breach."""
    return quality_gate(metrics, min_quality_rate).withColumn(
        "passed",
        F.when(F.col("passed"), F.lit(True)).otherwise(
            F.raise_error(
                F.concat(
                    F.lit("quality gate failed for "),
                    F.col("dataset"),
                    F.lit(": quality_rate="),
                    F.col("quality_rate").cast("string"),
                )
            ).cast("boolean")
        ),
    )
