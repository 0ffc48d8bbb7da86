import re
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions.ids import batch_id_from_time, composed_key, display_id
from strata.functions.money import line_amount, safe_ratio


def test_ids(spark):
    r = spark.range(1).selectExpr("42 AS k", "7 AS n").select(
        display_id("CUST-", "k", 6).alias("d"), composed_key("k", "n").alias("c"), batch_id_from_time().alias("b")
    ).first()
    assert r.d == "CUST-000042" and r.c == "42-7" and re.fullmatch(r"\d{8}T\d{6}Z", r.b)


def test_money_is_exact(spark):
    df = spark.createDataFrame([(100.005, 0.1), (10.0, -0.0)], "p double, d double")
    got = [r.a for r in df.select(line_amount("p", "d").alias("a")).collect()]
    assert got == [Decimal("90.0090"), Decimal("10.0000")]
    r = spark.range(1).select(safe_ratio(F.lit(1), F.lit(0)).alias("x"), safe_ratio(F.lit(1), F.lit(0), 0.0).alias("y")).first()
    assert r.x is None and r.y == 0.0


def test_batch_id_is_utc_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        # 2024-01-01 09:30 in Tokyo is 00:30 UTC
        ts = F.to_timestamp(F.lit("2024-01-01 09:30:00"))
        assert spark.range(1).select(batch_id_from_time(ts).alias("b")).first().b == "20240101T003000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
