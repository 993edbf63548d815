import datetime as dt

from civicflow.streaming import incremental

SCHEMA = "k string, v long, t timestamp"
DAY = dt.datetime(2024, 1, 1)


def rows(*parts):
    return [(k, v, DAY + dt.timedelta(days=d)) for k, v, d in parts]


def drain(spark, df, name):
    df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return [tuple(r) for r in spark.table(name).collect()]


def test_windows_close_behind_the_watermark(spark, tmp_path):
    for i, part in enumerate([rows(("a", 1, 0), ("a", 2, 0), ("b", 5, 0)), rows(("a", 7, 5)), rows(("a", 100, 0), ("a", 1, 9))]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        stream = incremental.read_files(spark, str(tmp_path / "in/*"), SCHEMA)
        out = incremental.running_totals(stream, ["k"], "v", "t").select("window.start", "k", "n", "total")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got >= {(DAY, "a", 2, 3), (DAY, "b", 1, 5)} and (DAY, "a", 3, 103) not in got  # what is late is left out


def test_first_seen_in_the_watermark(spark, tmp_path):
    spark.createDataFrame(rows(("a", 1, 0), ("a", 2, 0), ("b", 3, 0)), SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/0"))
    stream = incremental.read_files(spark, str(tmp_path / "in/*"), SCHEMA)
    out = drain(spark, incremental.first_seen(stream, ["k"], "t").select("k"), "firsts")
    assert sorted(out) == [("a",), ("b",)]
