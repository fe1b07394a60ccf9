"""Compares ways to compute the five indicators over a larger lake.

The given events are repeated BENCH_COPIES times, each copy a millisecond later, into a
JSON and a Parquet lake under BENCH_SCRATCH; then each way is timed once after a warm-up.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bench import SF_DIR, session
from roadpulse.functions.traffic import congested, event_hour
from roadpulse.operators import kpis, summary
from roadpulse.plans.follow import start_following
from roadpulse.plans.refresh import Refresh, store_kpis
from roadpulse.plans.road_events import road_events
from roadpulse.sinks.lake import write_lake
from roadpulse.sources.lake import read_lake
from roadpulse.streaming.session import scratch

COPIES = int(os.environ.get("BENCH_COPIES", "50"))


def consume(table: DataFrame) -> None:
    table.write.format("noop").mode("overwrite").save()


def one_by_one(events: DataFrame) -> None:
    for indicator in (
        kpis.traffic_by_zone,
        kpis.speed_by_road,
        kpis.hourly_stats,
        kpis.critical_zones,
    ):
        consume(indicator(events))


def persisted(events: DataFrame) -> None:
    kept = events.drop("sensor_id", "road_id").persist()
    one_by_one(kept)
    kept.unpersist(blocking=True)


def grouping_sets(events: DataFrame) -> None:
    hours = events.withColumn("hour", event_hour())
    sets = [[F.col("zone")], [F.col("road_type")], [F.col("hour")]]
    consume(
        hours.groupingSets(sets, "zone", "road_type", "hour").agg(
            F.avg("vehicle_count"),
            F.avg("average_speed"),
            F.count("*"),
            F.count_if(congested()),
        )
    )


def one_summary(events: DataFrame) -> None:
    consume(summary.summarize(events))


def follow(spark, paths: Refresh) -> None:
    start_following(spark, paths).awaitTermination()


def main() -> None:
    spark = session()
    root_of_all = os.environ.get("BENCH_SCRATCH") or scratch(spark, "layouts")
    copies = road_events(spark, SF_DIR).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    )
    shifted = copies.withColumn(
        "event_time", F.expr("event_time + make_dt_interval(0, 0, 0, copy / 1000)")
    ).drop("copy")
    times = {}

    def timed(name: str, work, *arguments) -> None:
        start = time.perf_counter()
        work(*arguments)
        times[name] = round(time.perf_counter() - start, 3)

    for fmt in ("json", "parquet"):
        root = f"{root_of_all}/{fmt}"
        timed(f"{fmt}: write lake", write_lake, shifted, root, fmt)
        events = read_lake(spark, root, fmt)
        one_summary(events)
        timed(f"{fmt}: infer schema and read", _inferred, spark, root, fmt)
        timed(f"{fmt}: four aggregates one by one", one_by_one, events)
        timed(f"{fmt}: four aggregates, persisted", persisted, events)
        timed(f"{fmt}: grouping sets", grouping_sets, events)
        timed(f"{fmt}: one summary", one_summary, events)
        paths = Refresh(root, f"{root_of_all}/followed-{fmt}", fmt)
        timed(f"{fmt}: all five stored", store_kpis, spark, events, f"{root_of_all}/store-{fmt}")
        one_date = [spark.sql("SELECT DATE '2024-01-15'").first()[0]]
        timed(
            f"{fmt}: one date refreshed",
            store_kpis,
            spark,
            events,
            f"{root_of_all}/store-{fmt}",
            one_date,
        )
        timed(f"{fmt}: followed from the start", follow, spark, paths)
        write_lake(road_events(spark, SF_DIR), root, fmt)
        timed(f"{fmt}: followed, one copy more", follow, spark, paths)
    print(json.dumps({"events": COPIES * road_events(spark, SF_DIR).count(), "seconds": times}))
    spark.stop()


def _inferred(spark, root: str, fmt: str) -> None:
    consume(kpis.traffic_by_zone(spark.read.format(fmt).load(root)))


if __name__ == "__main__":
    main()
