"""Messages to events and back: JSON text in, JSON text out, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.traffic import wall_time
from roadpulse.schema import EVENT_COLUMNS, WHOLE, WIRE_EVENT

BLANK = "blank"
NOT_OBJECT = "not_object"
MALFORMED = "malformed"
BAD_EVENT_TIME = "bad_event_time"
MISSING_ZONE = "missing_zone"
#: White space as JSON defines it.
JSON_SPACE = " \t\r\n"
REASONS = [BLANK, NOT_OBJECT, MALFORMED, BAD_EVENT_TIME, MISSING_ZONE]

# The message is parsed as one field of a wrapper whose last field must arrive, so
# that the parser cannot skip what follows the first JSON object without a word.
# That the message is no more than this object is seen by ``is_one_object``.
_WRAPPER = T.StructType(
    [
        T.StructField("event", WIRE_EVENT),
        T.StructField("complete", T.BooleanType()),
        T.StructField("broken", T.StringType()),
    ]
)
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "broken",
    "allowSingleQuotes": "false",
}


def parse_message(text: Column) -> Column:
    """Struct ``(event, complete, broken)`` of one message; never fails."""
    wrapped = F.concat(F.lit('{"event":'), text, F.lit(',"complete":true}'))
    return F.from_json(wrapped, _WRAPPER, _JSON_OPTIONS)


def is_one_object(text: Column) -> Column:
    """Whether text that ``parse_message`` takes for an object and more is one object only.

    As the first of two elements of an array the text may go on after its object with a comma and
    a value alone; as a field of the wrapper, with a comma, a name and a colon. No text does both,
    hence nothing follows. NaN and Infinity, which JSON does not know, are refused as well.
    """
    elements = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce(elements == 2, F.lit(False))


def whole(reading: Column) -> Column:
    """A reading as a whole number, halves rounded up; NULL if no BIGINT can hold it."""
    return F.round(reading).try_cast("bigint")


def _lost(event: str) -> Column:
    """Whether a reading is too large, or no number, for a whole number."""
    found = F.lit(False)
    for name in WHOLE:
        reading = F.col(f"{event}.{name}")
        found = found | (reading.isNotNull() & whole(reading).isNull())
    return found


def whole_event(event: str = "event") -> Column:
    """The parsed event with whole readings."""
    fields = [whole(F.col(f"{event}.{x}")) if x in WHOLE else F.col(f"{event}.{x}") for x in EVENT_COLUMNS]
    return F.struct(*(field.alias(name) for field, name in zip(fields, EVENT_COLUMNS)))


def holds_more(text: Column, event: str = "event") -> Column:
    """Whether a message has fields the event has not, or readings that were rounded."""
    unknown = F.array_except(F.json_object_keys(text), F.array(*map(F.lit, EVENT_COLUMNS)))
    found = F.coalesce(F.size(unknown) > 0, F.lit(False))
    for name in WHOLE:
        reading = F.col(f"{event}.{name}")
        found = found | F.coalesce(F.round(reading) != reading, F.lit(False))
    return found


def reject_reason(text: Column) -> Column:
    """Why a message cannot enter the lake, or NULL when it can.

    Reads the columns of ``parse_message`` and the text they came from. The order
    matters: each test presumes that the ones before it passed.
    """
    trimmed = F.btrim(text, F.lit(JSON_SPACE))
    return (
        F.when(text.isNull() | (trimmed == ""), BLANK)
        .when(~trimmed.startswith("{"), NOT_OBJECT)
        .when(
            F.col("broken").isNotNull()
            | F.col("complete").isNull()
            | ~F.is_valid_utf8(text)
            | _lost("event")
            | ~is_one_object(text),
            MALFORMED,
        )
        .when(
            # A calendar date in front: "2026" alone would otherwise be read as New Year.
            wall_time("event.event_time").isNull()
            | ~F.col("event.event_time").rlike(r"^\d{4}-\d{2}-\d{2}"),
            BAD_EVENT_TIME,
        )
        .when(F.col("event.zone").isNull() | (F.col("event.zone") == ""), MISSING_ZONE)
    )


def iso_text(column: str = "event_time") -> Column:
    """Time as ISO text with all six digits.

    Made from the plain cast rather than by ``date_format``, which would move
    the hour when the session time zone skips it.
    """
    text = wall_time(column).cast("string")
    # The cast leaves out zeros at the end, and the point with them.
    pointed = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
    return F.rpad(F.replace(pointed, F.lit(" "), F.lit("T")), 26, "0")


def event_json() -> Column:
    """The event columns as one JSON object."""
    return F.to_json(F.struct(*EVENT_COLUMNS))
