"""Dates are read once and without a formatter, with the results of one."""

from pyspark.sql import functions as F

from ledgerline.functions import normalize as N
from ledgerline.plans import specs
from ledgerline.sources import landing as S

ODD = [None, "", "0", "2023", "2023010", "202301011", "2023-1-1", " 2023010", "2023010a", "٢٠230101", "+2023010", "20230101\n"]


def test_dates_as_by_formatter(spark):
    values = ODD + [f"{y:04}{m:02}{d:02}" for y in (0, 1, 1582, 1899, 1900, 2023, 2024, 2026, 9999) for m in range(14) for d in range(33)]
    plain = F.when(F.col("v").rlike(r"^[0-9]{8}\z"), F.try_to_date("v", "yyyyMMdd"))
    table = spark.createDataFrame([(v,) for v in values], "v string")
    text = lambda c: c.cast("string")
    rows = table.select("v", text(plain).alias("want"), text(N.to_date_or_null(F.col("v"))).alias("found"))
    assert rows.where("not (want <=> found)").collect() == [] and rows.where("found is not null").count() > 3000
    (name,) = specs.FAMILIES["SOCIOCSV"].dates
    in_range = F.when(N.date_in_range(plain, "2026-01-01").isNotNull(), F.col("v"))
    cleaned = S.clean_dates(table.withColumn("want", in_range).withColumn(name, F.col("v")), "SOCIOCSV", "2026-01-01")
    assert cleaned.where(f"not (want <=> {name})").collect() == [] and cleaned.where("want is not null").count() > 1000


def test_each_date_is_read_once(spark):
    (name,) = specs.FAMILIES["SOCIOCSV"].dates
    table = spark.createDataFrame([("20230101",)], f"{name} string")
    plan = S.clean_dates(table, "SOCIOCSV", "2026-01-01")._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("rlike") == 1 and "yyyymmdd" not in plan.lower()


def test_nul_characters_go(spark):
    table = spark.createDataFrame([("a\u0000b\u0000",), ("é",), ("",), (None,)], "v string")
    assert [r[0] for r in table.select(N.strip_nul(F.col("v"))).collect()] == ["ab", "é", "", None]
