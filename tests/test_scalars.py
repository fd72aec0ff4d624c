import pytest
from pyspark.sql import functions as F

from affinity.functions import scalars


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def reference_hash(text):
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i:i + 2], "big")) % 2**32
    return h - 2**32 if h >= 2**31 else h


@pytest.mark.parametrize("text, expected", [
    ("abc", 96354), ("", 0), ("polygenelubricants", -2147483648)])
def test_string_hash_known_values(spark, text, expected):
    assert one(spark, scalars.java_string_hash(F.lit(text))) == expected


@pytest.mark.parametrize("text", ["鼠标", "naïve", "\U0001f600 smile", "Customer#000000001"])
def test_string_hash_beyond_ascii(spark, text):
    assert one(spark, scalars.java_string_hash(F.lit(text))) == reference_hash(text)


@pytest.mark.parametrize("ts, month", [
    (1395676800, 201403), (0, 197001), (1704067199, 202312), (1704067200, 202401), (-1, 196912)])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_year_month_is_utc_in_any_zone(spark, ts, month, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, scalars.year_month(F.lit(ts).cast("long"))) == month
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("ten, five", [(10.0, 5.0), (7.0, 3.5), (9.35, 4.68)])
def test_score_halving(spark, ten, five):
    assert one(spark, scalars.score_normalize(F.lit(ten))) == five


def test_milliseconds_become_seconds(spark):
    assert one(spark, scalars.to_seconds(F.lit(1556436808123).cast("long"))) == 1556436808
    assert one(spark, scalars.to_seconds(F.lit(1556436808).cast("long"))) == 1556436808


def test_recode_repairs_mojibake(spark):
    broken = "鼠标".encode("utf-8").decode("latin-1")
    assert one(spark, scalars.recode_latin1_utf8(F.lit(broken))) == "鼠标"


def test_cosine(spark):
    arr = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, scalars.cosine_sim(arr(1, 0), arr(1, 1))) == pytest.approx(0.5 ** 0.5)
    assert one(spark, scalars.cosine_sim(arr(0, 0), arr(1, 1))) is None


def test_epoch_seconds_of_both_timestamp_kinds(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.9' AS a, "
                   "TIMESTAMP'2024-01-01 00:00:07.9' AS b")
    got = df.select(scalars.epoch_seconds(df, "a").alias("a"),
                    scalars.epoch_seconds(df, "b").alias("b")).first()
    assert (got.a, got.b) == (1704067207, 1704067207)
