from pyspark.sql import functions as F

from tests.shapes import dbf_bytes, write_zip


def test_with_ordinal_across_partitions(spark):
    from citymotion.sources.common import with_ordinal

    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "v")
    rows = with_ordinal(df).collect()
    assert sorted(r.ordinal for r in rows) == list(range(1000))
    assert all(r.ordinal == r.v for r in rows)  # scan order = generation order here


def test_measured_side_respects_limit(spark):
    from citymotion.session import measured_side

    side = spark.range(10).withColumn("name", F.lit("x" * 100))
    for limit, hinted in ((10_000, True), (1_000, False)):
        j = spark.range(1_000_000).join(measured_side(side, "t", limit), "id")
        assert ("strategy=broadcast" in j._jdf.queryExecution().analyzed().toString()) is hinted
        assert j.count() == 10


def test_preview_zip_and_dbf(spark, tmp):
    from citymotion.sources.preview import dbf_summary, preview_zip

    z = write_zip(tmp / "a.zip", {"__MACOSX/._x.csv": "junk", "data/x.csv": "a,b,c,d\n1,2,3,4\n5,6,7,8\n"})
    p = preview_zip(spark, str(z), n=1)
    assert p["columns"] == ["a", "b", "c", "d"] and p["rows"] == [["1", "2", "3", "4"]]
    d = dbf_bytes([("resultId", "C", 8, 0), ("n", "N", 3, 0)], [("A_B", "1"), ("C_D", "2")])
    z2 = write_zip(tmp / "b.zip", {"r.dbf": d})
    q = preview_zip(spark, str(z2))
    assert q["columns"] == ["resultId", "n"] and q["n_records"] == 2
    (tmp / "r.dbf").write_bytes(d)
    assert dbf_summary(str(tmp / "r.dbf")) == {"fields": ["resultId", "n"], "n_records": 2}


def test_year_from_name(spark):
    from citymotion.sources.archives import year_from_name

    df = spark.createDataFrame([("/x/travel-time-2016.zip",), ("/x/travel-time-2014-2015.zip",), ("/x/travel-time.zip",), ("/x/t-20160.zip",)], "path string")
    assert [r.y for r in df.select(year_from_name("path").alias("y")).collect()] == [2016, 2014, None, None]
