"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.codec import iso_text
from roadpulse.functions.traffic import congested
from roadpulse.operators import checks, drift, ingest, kpis, panels, summary, windows
from roadpulse.plans import refresh
from roadpulse.plans.follow import start_following
from roadpulse.plans.road_events import (
    road_event_stream,
    road_events,
    with_defects,
    with_wrong_road,
)
from roadpulse.schema import EVENT_COLUMNS
from roadpulse.sinks.lake import write_lake
from roadpulse.sinks.store import compact
from roadpulse.sources import commits, versions
from roadpulse.sources.lake import (
    read_document_ranges,
    read_documents,
    read_extra,
    read_lake,
    read_rejects,
    stream_lake,
)
from roadpulse.sources.store import read_dated_alerts, read_summary, read_table, register_views
from roadpulse.streaming import live
from roadpulse.streaming.ingest import (
    ONCE,
    start_conversion,
    start_ingest,
    start_report,
)
from roadpulse.streaming.session import scratch, stream_session

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- indicators ---------------------------------------------------------------


@_query
def traffic_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.traffic_by_zone(road_events(spark, sf_dir))


@_query
def speed_by_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.speed_by_road(road_events(spark, sf_dir))


@_query
def congestion_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = kpis.flag_congestion(road_events(spark, sf_dir, "event_id"))
    return flagged.select("event_id", "is_congested")


@_query
def congestion_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.congestion_alerts(road_events(spark, sf_dir))


@_query
def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.hourly_stats(road_events(spark, sf_dir))


@_query
def critical_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.critical_zones(road_events(spark, sf_dir))


@_query
def event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summarize(road_events(spark, sf_dir))


@_query
def day_period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.day_period_stats(road_events(spark, sf_dir))


# ---- dashboard ----------------------------------------------------------------


@_query
def panel_traffic_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.traffic_by_hour(hourly_stats(spark, sf_dir))


@_query
def panel_speed_by_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.speed_by_road(speed_by_road(spark, sf_dir))


@_query
def panel_traffic_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.traffic_by_zone(traffic_by_zone(spark, sf_dir))


@_query
def panel_critical_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.critical_zones(critical_zones(spark, sf_dir))


@_query
def panel_critical_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.critical_zones(critical_zones(spark, sf_dir), k=3)


@_query
def panel_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.latest_alerts(congestion_alerts(spark, sf_dir))


@_query
def hourly_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty rows of a table in order."""
    return panels.preview(panels.traffic_by_hour(hourly_stats(spark, sf_dir)))


# ---- checks -------------------------------------------------------------------


@_query
def gate_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_count(traffic_by_zone(spark, sf_dir), "zones")


@_query
def implausible_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.implausible_events(road_events(spark, sf_dir, "event_id"))
    return found.select("event_id", "road_type", "violations")


@_query
def plausibility_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.plausibility_report(road_events(spark, sf_dir))


@_query
def sensor_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = road_events(spark, sf_dir, "user_id", "event_type")
    return checks.sensor_conflicts(with_wrong_road(events))


# ---- messages -----------------------------------------------------------------


@_query
def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value as text."""
    messages = ingest.encode(road_events(spark, sf_dir, "event_id"), "event_id")
    return messages.select(
        "event_id", F.col("key").cast("string"), F.col("value").cast("string")
    )


def _defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = road_events(spark, sf_dir, "event_id", "event_type")
    return with_defects(ingest.encode(events, "event_id", "event_type"))


@_query
def decode_skip_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = ingest.accepted(ingest.decode(_defective(spark, sf_dir)), "event_id")
    return ingest.typed(good)


@_query
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = ingest.rejected(ingest.decode(_defective(spark, sf_dir)), "event_id")
    return bad.select("event_id", "reason")


@_query
def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON documents, arrays of at most 2,000, and read back."""
    path = scratch(spark, "documents")
    events = road_events(spark, sf_dir, "event_id").withColumn("event_time", iso_text())
    # The id is unique, so a range of 2,000 ids bounds what a document collects.
    documents = events.groupBy(F.floor(F.col("event_id") / 2000).alias("document")).agg(
        F.to_json(F.collect_list(F.struct(*EVENT_COLUMNS)), {"pretty": "true"}).alias("value")
    )
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_documents(spark, path).select(*EVENT_COLUMNS)


@_query
def document_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as arrays of up to 200,000, an event a line, and read back by ranges of the files."""
    path = scratch(spark, "documents")
    events = road_events(spark, sf_dir, "event_id").withColumn("event_time", iso_text())
    numbered = events.withColumn("document", F.floor(F.col("event_id") / 200_000))
    order = Window.partitionBy("document").orderBy("event_id")
    opening = F.when(F.lag("event_id").over(order).isNull(), "[").otherwise(",")
    closing = F.when(F.lead("event_id").over(order).isNull(), "\n]").otherwise("")
    lines = numbered.select("document", F.concat(opening, F.to_json(F.struct(*EVENT_COLUMNS)), closing).alias("value"))
    lines.write.partitionBy("document").text(path)
    return read_document_ranges(spark, path).select(*EVENT_COLUMNS)


# ---- lake ---------------------------------------------------------------------


def _lake(spark: SparkSession, sf_dir: str, fmt: str = "json") -> DataFrame:
    """The events written to a new lake and read back."""
    root = scratch(spark, "lake")
    write_lake(road_events(spark, sf_dir), root, fmt)
    return read_lake(spark, root, fmt)


@_query
def lake_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.partition_counts(_lake(spark, sf_dir))


@_query
def lake_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    return lake.filter("date = DATE '2024-01-03' AND zone = 'Downtown'").select(
        "sensor_id", "vehicle_count", "average_speed", "occupancy_rate"
    )


@_query
def lake_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event back from a Parquet lake, with its date."""
    return _lake(spark, sf_dir, "parquet")


@_query
def lake_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a JSON lake after its conversion to Parquet."""
    source, root = scratch(spark, "lake"), scratch(spark, "lake")
    write_lake(road_events(spark, sf_dir), source)
    converted = start_conversion(
        stream_lake(spark, source), root, scratch(spark, "checkpoint"), trigger=ONCE
    )
    converted.awaitTermination()
    return read_lake(spark, root, "parquet")


_AS_OF = datetime(2024, 1, 15, 12)


@_query
def last_hour_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.traffic_by_zone(windows.last_hour(road_events(spark, sf_dir), _AS_OF))


@_query
def lake_last_hour_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the lake, where only one date is opened."""
    return kpis.traffic_by_zone(windows.last_hour(_lake(spark, sf_dir), _AS_OF))


# ---- streams ------------------------------------------------------------------


def _message_stream(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return ingest.encode(road_event_stream(spark, sf_dir, *keep), *keep)


@_query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed into a lake; events per partition."""
    root, checkpoint = scratch(spark, "lake"), scratch(spark, "checkpoint")
    messages = _message_stream(spark, sf_dir)
    start_ingest(messages, root, checkpoint, trigger=ONCE).awaitTermination()
    return ingest.partition_counts(read_lake(spark, root))


def _both_outputs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A lake and its rejects, of one ingest of defective messages."""
    root, path, checkpoint = (scratch(spark, x) for x in ("lake", "rejects", "checkpoint"))
    messages = with_defects(_message_stream(spark, sf_dir, "event_type"))
    start_ingest(messages, root, checkpoint, trigger=ONCE, rejects=path).awaitTermination()
    return root, path


@_query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective messages streamed into the dataset of rejects; records per reason."""
    root, path = _both_outputs(spark, sf_dir)
    rejects = read_rejects(spark, path, root)
    return rejects.groupBy("reason").agg(F.count("*").alias("records"))


@_query
def stream_both_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one ingest put into the lake, by date and zone, and into the rejects, by reason."""
    root, path = _both_outputs(spark, sf_dir)
    last = commits.done(spark, root)
    lake = ingest.partition_counts(read_lake(spark, root, last=last))
    rejects = read_rejects(spark, path, root, last).groupBy("reason").agg(F.count("*").alias("events"))
    return lake.unionByName(rejects, allowMissingColumns=True)


@_query
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that each batch of ingest was committed with."""
    root, _ = _both_outputs(spark, sf_dir)
    return commits.read_commits(spark, root).select("number", "messages", "accepted", "rejected")


@_query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = scratch(spark, "alerts"), scratch(spark, "checkpoint")
    events = road_event_stream(spark, sf_dir)
    live.start_alerts(events, path, checkpoint, trigger=ONCE).awaitTermination()
    return spark.read.parquet(path).drop("date")


@_query
def lake_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts from the lake as a stream: ingest and alerts one after the other."""
    root, path = scratch(spark, "lake"), scratch(spark, "alerts")
    ingested = start_ingest(
        _message_stream(spark, sf_dir), root, scratch(spark, "checkpoint"), "parquet", trigger=ONCE
    )
    ingested.awaitTermination()
    events = stream_lake(spark, root, "parquet")
    live.start_alerts(events, path, scratch(spark, "checkpoint"), ONCE).awaitTermination()
    return spark.read.parquet(path).drop("date")


@_query
def stream_hourly_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = scratch(spark, "hours"), scratch(spark, "checkpoint")
    events = road_event_stream(spark, sf_dir)
    live.start_hourly_table(events, path, checkpoint, trigger=ONCE).awaitTermination()
    return live.read_hours(spark, path).drop("window_end")


@_query
def stream_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly traffic and alerts by zone and hour, of one query that reads the source once."""
    alerts, hours = scratch(spark, "alerts"), scratch(spark, "hours")
    events = road_event_stream(spark, sf_dir)
    live.start_live(events, alerts, hours, scratch(spark, "checkpoint"), ONCE).awaitTermination()
    keys = ["window_start", "zone"]
    found = spark.read.parquet(alerts).groupBy(windows.hour_start().alias(keys[0]), keys[1])
    found = found.agg(F.count("*").alias("alerts"))
    traffic = live.read_hours(spark, hours).select(*keys, "events")
    return traffic.join(found, keys, "left").fillna(0, ["alerts"])


@_query
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by batch, date and zone of a lake that grew twice."""
    events = road_events(spark, sf_dir)
    root, path, checkpoint = (scratch(spark, x) for x in ("lake", "report", "checkpoint"))
    early = F.coalesce(F.col("event_time") < "2024-01-15 12:00:00", F.lit(True))
    for period in (early, ~early):
        write_lake(events.filter(period), root, "parquet")
        arrived = stream_lake(spark, root, "parquet")
        start_report(arrived, path, checkpoint, ONCE).awaitTermination()
    return spark.read.parquet(path)


@_query
def stream_closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that late events can no longer change, sent once each."""
    path, checkpoint = scratch(spark, "hours"), scratch(spark, "checkpoint")
    events = road_event_stream(stream_session(spark), sf_dir)
    live.start_hourly(events, path, checkpoint, trigger=ONCE).awaitTermination()
    return spark.read.parquet(path).select("window_start", "zone", "avg_vehicles", "events")


# ---- stored tables ------------------------------------------------------------


def _store(spark: SparkSession, sf_dir: str) -> str:
    """The five tables computed from the events, stored and checked."""
    store = scratch(spark, "store")
    refresh.store_kpis(spark, road_events(spark, sf_dir), store)
    refresh.verify(spark, store)
    return store


@_query
def stored_traffic_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _store(spark, sf_dir), "traffic_by_zone")


@_query
def stored_speed_by_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _store(spark, sf_dir), "speed_by_road")


@_query
def stored_congestion_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _store(spark, sf_dir), "congestion_alerts")


@_query
def stored_hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _store(spark, sf_dir), "hourly_stats")


@_query
def stored_critical_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _store(spark, sf_dir), "critical_zones")


@_query
def stored_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.latest_alerts(spark, _store(spark, sf_dir))


@_query
def stored_panel_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard SQL as written, over views of the stored tables."""
    session = spark.newSession()
    register_views(session, _store(spark, sf_dir))
    return session.sql(
        "SELECT hour, AVG(avg_vehicles) AS avg_vehicles FROM hourly_stats "
        "GROUP BY hour ORDER BY hour"
    )


@_query
def lake_to_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: messages, lake, stored and checked tables, critical zones."""
    root, store = scratch(spark, "lake"), scratch(spark, "store")
    messages = _message_stream(spark, sf_dir)
    start_ingest(messages, root, scratch(spark, "checkpoint"), trigger=ONCE).awaitTermination()
    refresh.run(spark, refresh.Refresh(lake=root, store=store))
    return panels.critical_zones(read_table(spark, store, "critical_zones"))


@_query
def refresh_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored summary after one date was computed again: the same as from all events."""
    store = _store(spark, sf_dir)
    refresh.store_kpis(spark, road_events(spark, sf_dir), store, [date(2024, 1, 15)])
    return read_summary(spark, store)


@_query
def refresh_shrunk_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, congested ones and stored alerts by date, after a refresh of two dates of which
    one has lost its congestion and the other all its events."""
    store, events = _store(spark, sf_dir), road_events(spark, sf_dir)
    day, quiet, empty = F.to_date("event_time"), date(2024, 1, 15), date(2024, 1, 16)
    left = events.filter((day != empty) & ((day != quiet) | ~F.coalesce(congested(), F.lit(False))))
    refresh.store_kpis(spark, left, store, [quiet, empty])
    sums = read_summary(spark, store).groupBy("date")
    sums = sums.agg(F.sum("events").alias("events"), F.sum("congested").alias("congested"))
    alerts = read_dated_alerts(spark, store).groupBy("date").agg(F.count("*").alias("alerts"))
    return sums.join(alerts, "date", "full").fillna(0, ["alerts"])


@_query
def follow_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a store that followed a lake while it grew."""
    events = road_events(spark, sf_dir)
    paths = refresh.Refresh(scratch(spark, "lake"), scratch(spark, "store"), "parquet")
    early = F.coalesce(F.col("event_time") < "2024-01-15 12:00:00", F.lit(True))
    for period in (early, ~early):
        write_lake(events.filter(period), paths.lake, "parquet")
        start_following(spark, paths).awaitTermination()
    return read_summary(spark, paths.store)


@_query
def follow_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a store that followed a lake in three steps, after its parts were joined."""
    events, day = road_events(spark, sf_dir), F.dayofmonth("event_time") % 3
    paths = refresh.Refresh(scratch(spark, "lake"), scratch(spark, "store"), "parquet")
    for step in range(3):
        # The last step adds to the dates of those before it.
        also = (F.col("vehicle_count") % 2 == 0) if step < 2 else F.lit(True)
        seen = F.coalesce(day == step, F.lit(step == 2)) & also
        rest = F.coalesce(day < 2, F.lit(False)) & (F.coalesce(F.col("vehicle_count") % 2 != 0, F.lit(True)))
        write_lake(events.filter(seen | rest if step == 2 else seen), paths.lake, "parquet")
        start_following(spark, paths).awaitTermination()
    compact(spark, paths.store, most_parts=1)
    return read_summary(spark, paths.store)


@_query
def stored_pinned_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored alerts by zone as a reader sees them that read the version before a refresh."""
    store = _store(spark, sf_dir)
    before = versions.pinned(spark, store)
    quiet = road_events(spark, sf_dir).filter(~F.coalesce(congested(), F.lit(False)))
    refresh.store_kpis(spark, quiet, store)
    alerts = read_table(spark, store, "congestion_alerts", before)
    zones = read_table(spark, store, "critical_zones", before)
    counted = alerts.groupBy("zone").agg(F.count("*").alias("alerts"))
    return zones.join(counted, "zone", "left").fillna(0, ["alerts"])


_MIDNIGHT = "2024-01-15 00:00:00"


def _in_two_steps(events: DataFrame, root: str, late_first: bool):
    """Writes a lake in two steps, cut at a time; events without one come with the earlier ones."""
    early = F.coalesce(F.col("event_time") < _MIDNIGHT, F.lit(True))
    for period in (~early, early) if late_first else (early, ~early):
        write_lake(events.filter(period), root, "parquet")
        yield stream_lake(events.sparkSession, root, "parquet")


def _hour_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, path, checkpoint = (scratch(spark, x) for x in ("lake", "hours", "checkpoint"))
    for events in _in_two_steps(road_events(spark, sf_dir), root, late_first=True):
        live.start_hours(events, path, checkpoint, trigger=ONCE).awaitTermination()
    return live.read_parts(spark, path)


@_query
def stream_late_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed, late and open hours by zone, where the earlier half of the events comes last."""
    return _hour_parts(spark, sf_dir).select("window_start", "zone", "part", "vehicles", "events")


@_query
def stream_late_hours_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same added up: the traffic of all events."""
    return windows.added_hours(_hour_parts(spark, sf_dir)).drop("window_end")


@_query
def follow_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor conflicts over a lake that grew twice, reading new events only."""
    root, path, checkpoint = (scratch(spark, x) for x in ("lake", "sensors", "checkpoint"))
    events = with_wrong_road(road_events(spark, sf_dir, "user_id", "event_type"))
    for arrived in _in_two_steps(events, root, late_first=False):
        live.start_sensor_check(arrived, path, checkpoint, ONCE).awaitTermination()
    return live.read_conflicts(spark, path)


@_query
def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that messages hold beside those of an event, by date, from the lake they came into."""
    root, _ = _both_outputs(spark, sf_dir)
    return drift.unknown_fields(read_extra(spark, root))
