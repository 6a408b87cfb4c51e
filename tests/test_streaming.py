from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from segmentry.plans import performance
from segmentry.sources.schemas import AUDIENCES
from segmentry.streaming import outbox, weekly
from tests.conftest import rows

EVENT = "event_id bigint, campaign_id string, channel string, event_type string, event_timestamp timestamp_ntz, revenue double"
START = datetime(2024, 5, 30, 23, 59)  # a Thursday


def write(spark, path, numbers):
    kinds = ["send", "open", "click", "convert", "bounce"]
    data = [(i, f"C{i % 2}", "email", kinds[i % 5], START + timedelta(hours=7 * i), None) for i in numbers]
    spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(path)


def batch_result(spark, path):
    library = spark.createDataFrame([], "campaign_id string, campaign_name string, campaign_type string")
    owned = performance.owned_metrics(spark.read.parquet(path), library)
    return rows(owned.select("period", "campaign_id", "channel", "sends", "opens", "clicks", "conversions"))


def test_weekly_counts_follow_the_batch_result(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    for numbers in (range(200, 240), range(0, 40), range(230, 231)):  # months out of time order
        write(spark, source, numbers)
        weekly.run(spark.readStream.schema(EVENT).parquet(source), state)
        assert rows(weekly.current(spark, state)) == batch_result(spark, source)


def test_weeks_start_on_monday_in_any_session_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        check_weeks(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def check_weeks(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    write(spark, source, range(50))
    weekly.run(spark.readStream.schema(EVENT).parquet(source), state)
    assert {r.period.weekday() for r in weekly.current(spark, state).collect()} == {0}
    assert rows(weekly.current(spark, state)) == batch_result(spark, source)


def test_a_table_may_be_a_file_or_a_folder(spark, tmp_path):
    folder = tmp_path / "tables"
    write(spark, str(folder / "orders.parquet"), range(30))
    file_ = tmp_path / "files"
    file_.mkdir()
    (part,) = [p for p in (folder / "orders.parquet").iterdir() if p.name.startswith("part-")]
    (file_ / "orders.parquet").write_bytes(part.read_bytes())
    for source in (folder, file_):
        state = str(tmp_path / f"state-{source.name}")
        schema = spark.read.parquet(f"{source}/orders.parquet").schema
        weekly.run(weekly.arriving(spark, str(source), "orders", schema), state)
        assert rows(weekly.current(spark, state)) == batch_result(spark, str(folder / "orders.parquet"))


def test_outbox_delivers_each_row_once(spark, tmp_path):
    source, target = str(tmp_path / "staged"), str(tmp_path / "sent")

    def stage(first, last):
        ids = spark.range(first, last).select(
            F.col("id").alias("customer_id"), F.lit(1).alias("segment_id"), F.lit("s").alias("segment_name"),
            F.lit("c").alias("campaign_name"), F.when(F.col("id") % 2 == 0, "email").otherwise("sms").alias("preferred_channel"),
            F.when(F.col("id") % 5 == 0, "activated").otherwise("pending").alias("status"),
        )
        AUDIENCES.fill(ids).write.mode("append").parquet(source)

    schema = AUDIENCES.ddl()
    for first, last in ((0, 20), (20, 35)):
        stage(first, last)
        outbox.deliver(spark.readStream.schema(schema).parquet(source), target)
    outbox.deliver(spark.readStream.schema(schema).parquet(source), target)  # nothing new
    got = outbox.delivered(spark, target, schema)
    assert rows(got.select("customer_id")) == sorted(((i,) for i in range(35) if i % 5), key=repr)
    assert rows(got.filter("preferred_channel = 'sms'").select("customer_id")) == sorted(
        ((i,) for i in range(35) if i % 5 and i % 2), key=repr)
