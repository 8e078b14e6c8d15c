"""Line simplification, and the windowed counts over a stream."""

from pyspark.sql import functions as F

from geoloom.functions import lines
from geoloom.streaming import windows


def test_simplified(spark):
    assert lines.simplified_points([(0, 0), (1, 0.05), (2, 0), (3, 2), (4, 0)], 0.1) == [(0, 0), (2, 0), (3, 2), (4, 0)]
    assert lines.simplified_points([(0, 0), (1, 1), (0, 0)], 0.5) == [(0, 0), (1, 1), (0, 0)]
    df = spark.createDataFrame([([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)],), (None,)], "g array<struct<x:double,y:double>>")
    assert [r.n for r in df.select(F.size(lines.simplified(F.col("g"), 0.1)).alias("n")).collect()] in ([2, -1], [2, None])


def test_windows_of_a_stream(spark, tmp_path):
    rows = spark.sql("SELECT timestamp'2024-01-01 10:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) AS ts, id % 2 AS k FROM range(48)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = windows.windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "ts", ["k"])
    run = stream.writeStream.format("memory").queryName("daily").outputMode("complete").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    found = sorted(map(tuple, spark.table("daily").collect()))
    assert found == sorted(map(tuple, windows.windowed_counts(rows, "ts", ["k"]).collect())) and sum(r[2] for r in found) == 48
