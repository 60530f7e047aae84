"""One station's rows are read without every row group."""

import datetime as dt

from pyspark.sql import functions as F

from stationlake.sources.tables import read_table, replace_days


def rows_read(df):
    """Rows that the scan handed on, which are those of the row groups it did not skip."""
    df.collect()
    found = []

    def walk(node):
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        for inner in ("executedPlan", "child"):
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" and inner == "executedPlan":
                walk(node.executedPlan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())

    walk(df._jdf.queryExecution().executedPlan())
    assert found
    return sum(found)


def test_bloom_filters_skip_row_groups_of_other_stations(spark, workdir):
    n, files = 400_000, 8
    # ids spread over the whole range in every file, too many for a dictionary page
    ids = spark.range(n).select((F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))).alias("station_id"), F.col("id").cast("double").alias("v"),
                                F.lit(dt.date(2024, 1, 1)).alias("observation_date")).repartition(files)
    read = {}
    for name, bloom in (("with", ("station_id",)), ("without", ())):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            replace_days(ids, f"{workdir}/{name}", "observation_date", ["2024-01-01"], bloom=bloom)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        table = read_table(spark, f"{workdir}/{name}")
        assert len(table.inputFiles()) >= files // 2
        one = ids.where("v = 4242").first().station_id
        got = table.where(F.col("station_id") == one)
        assert [r.v for r in got.collect()] == [4242.0]
        read[name] = rows_read(table.where(F.col("station_id") == one))
    assert read["without"] > n / 2 and read["with"] < n / 2
    print(read)
