"""The live board as a stream equals the batch report."""

from checks.fixtures import Inputs
from checks.queries import MONTH_SESSIONS
from skuloom.functions.numeric import total
from skuloom.plans.live import live_lines
from skuloom.streaming.live import live_hours

SF = "/root/testdata/sf0.01"


def test_hours_match_the_batch(spark, tmp_path):
    x = Inputs(spark, SF)
    lines = x["live_sales"]
    lines.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(lines.schema).parquet(str(tmp_path / "in"))
    query = (
        live_hours(stream, "purchase", MONTH_SESSIONS)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("live_hours")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.table("live_hours").collect()))
    want = (
        live_lines(x, "purchase", MONTH_SESSIONS).filter("session is not null")
        .groupBy("style_code", "hour").agg(total("sold_qty").alias("sold_qty"))
    )
    assert got == sorted(map(tuple, want.collect())) and len(got) > 10
