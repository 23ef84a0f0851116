"""A stored panel read by period: the rows, and what the scan leaves out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from citymotion.sources.panel_store import MONTH, read_period, write_panel

COLUMNS = ["route_id", "ts_local", "date", "delay_s"]


@pytest.fixture(scope="module")
def panel(spark):
    hours = spark.range(24 * 120).select(F.expr("timestamp_ntz '2023-11-20 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("ts_local"), "id")
    rows = hours.crossJoin(spark.createDataFrame([("a",), ("b",), (None,)], "route_id string"))
    # a year as from a file's name, so not always that of the date
    rows = rows.select("route_id", "ts_local", F.col("ts_local").alias("ts_utc"), F.to_date("ts_local").alias("date"), (F.col("id") * 1.5).alias("delay_s"), F.lit(2023).alias("year"))
    none = spark.createDataFrame([("c", 1.0, 2023)], "route_id string, delay_s double, year int")
    return rows.unionByName(none, allowMissingColumns=True)


def wanted(panel, start, end):
    rows = panel.select(*COLUMNS).collect()
    return sorted(map(str, (r for r in rows if r.date is not None and (start is None or str(r.date) >= start) and (end is None or str(r.date) <= end))))


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value(), plan.toString()


@pytest.mark.parametrize("start,end", [("2023-12-30", "2024-01-02"), ("2024-02-01", None), (None, "2023-11-21"), ("2024-01-05", dt.date(2024, 1, 5)), ("2030-01-01", "2030-01-02")])
def test_rows_of_a_period_by_each_way(spark, panel, tmp_path, start, end):
    want = wanted(panel, start, str(end) if end else None)
    forms = {
        "date": panel, "no date": panel.drop("date"), "text": panel.withColumn("date", F.col("date").cast("string")),
        "timestamp": panel.withColumn("date", F.col("date").cast("timestamp_ntz")), "date only": panel.withColumn("ts_local", F.col("ts_local").cast("string")),
    }
    for name, form in forms.items():
        path = write_panel(form, str(tmp_path / name.replace(" ", "_")))
        got = read_period(spark, path, COLUMNS, start, end).withColumn("ts_local", F.col("ts_local").cast("timestamp_ntz"))
        assert got.columns == COLUMNS
        assert sorted(map(str, got.collect())) == want, name


def test_the_scan_opens_few_months_and_row_groups(spark, panel, tmp_path):
    spark.conf.set("parquet.block.size", str(1 << 12))
    try:
        path = write_panel(panel, str(tmp_path / "p"))
        bare = write_panel(panel.drop("date"), str(tmp_path / "bare"))
    finally:
        spark.conf.unset("parquet.block.size")
    total = panel.count()
    n, plan = scanned_rows(read_period(spark, path, COLUMNS, "2024-01-09", "2024-01-10"))
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan and "GreaterThanOrEqual(date,2024-01-09)" in plan
    assert "delay_s" in plan.split("ReadSchema")[1] and "year" not in plan.split("ReadSchema")[1].split("\n")[0]
    in_month = panel.where("date between '2024-01-01' and '2024-01-31'").count()
    assert 2 * 24 * 3 <= n < in_month < total  # row groups of other days are skipped
    m, plan = scanned_rows(read_period(spark, bare, COLUMNS, "2024-01-09", "2024-01-10"))
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan and 2 * 24 * 3 <= m <= in_month


def test_empty_and_refused(spark, panel, tmp_path):
    path = write_panel(panel.limit(0), str(tmp_path / "none"))
    assert read_period(spark, path, COLUMNS, "2024-01-01", "2024-01-02", schema=panel.schema).count() == 0
    full = write_panel(panel, str(tmp_path / "full"))
    assert read_period(spark, full, COLUMNS).count() == panel.count()
    with pytest.raises(ValueError):
        read_period(spark, full, COLUMNS, "2024-01-02", "2024-01-01")
    with pytest.raises(KeyError):
        read_period(spark, full, ["absent"])
    with pytest.raises(KeyError):
        read_period(spark, write_panel(panel.drop("date", "ts_local"), str(tmp_path / "bare")), ["delay_s"])
