"""What messages hold beside the fields of an event: which fields, of which types, since when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.schema import EVENT_COLUMNS, EXTRA


def unknown_fields(extra: DataFrame) -> DataFrame:
    """(date, field, type, messages) of the kept messages (``sources.lake.read_extra``).

    ``type`` covers all values of the field on that date: BIGINT, OBJECT<...>, or VARIANT where they
    have nothing in common. Messages that name a field twice, which have no one reading, count as the
    NULL field, of type VOID. Combined in each task before the shuffle: one row a date and field goes on.
    """
    fields = extra.sparkSession.tvf.variant_explode_outer(F.col("parsed").outer())
    named = extra.withColumn("parsed", F.try_parse_json(EXTRA)).lateralJoin(fields)
    unknown = named.filter(F.col("key").isNull() | ~F.col("key").isin(EVENT_COLUMNS))
    return unknown.groupBy("date", F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("messages")
    )
