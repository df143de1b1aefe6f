"""Registered streaming query: events upserted by an availableNow stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..session import new_scratch_path
from ..sinks.keyed_table import read_keyed_table
from ..sources.retail import table
from ..streaming.incremental import upsert_stream
from .registry import register

# The two event drops.  The first holds days up to CUTOFF; the
# second the later days plus corrected values (doubled) of some earlier events.
CUTOFF = date(2024, 1, 15)
FIRST_DROP, SECOND_DROP = date(2024, 1, 16), date(2024, 1, 31)
CORRECTED_MOD = 10

EVENTS_BRONZE = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string, ingestion_date date"
)


def _drops(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    early = F.col("ts").cast("date") <= F.lit(str(CUTOFF)).cast("date")
    first = ev.filter(early).withColumn("ingestion_date", F.lit(str(FIRST_DROP)).cast("date"))
    corrected = ev.filter(early & (F.col("event_id") % CORRECTED_MOD == 0)).withColumn("value", F.col("value") * 2)
    second = ev.filter(~early).unionByName(corrected).withColumn("ingestion_date", F.lit(str(SECOND_DROP)).cast("date"))
    return first, second


def _streamed(spark, drops):
    root = new_scratch_path(spark, "events-stream")
    landing, target, checkpoint = f"{root}/landing", f"{root}/silver_events", f"{root}/_checkpoint"
    for drop in drops:
        drop.write.mode("append").parquet(landing)
        upsert_stream(spark, landing, EVENTS_BRONZE, target, "event_id", checkpoint)
    return read_keyed_table(spark, target)


@register()
def stream_events_upsert(spark, sf_dir):
    return _streamed(spark, _drops(spark, sf_dir))


@register()
def stream_late_version(spark, sf_dir):
    """The drops in the wrong order: the first one's older versions arrive late and
    replace nothing."""
    return _streamed(spark, reversed(_drops(spark, sf_dir)))
