"""Declared schemas: the flat tick, the raw quote response and the sink tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Flat tick message value: {"from", "to", "timestamp", "rate"}.
# Declared non-nullable like the original; from_json still yields nullable fields.
TICK = T.StructType(
    [
        T.StructField("from", T.StringType(), False),
        T.StructField("to", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("rate", T.DoubleType(), False),
    ]
)

# Same message with the event time kept as text (it is copied verbatim from the
# quote's ``last_updated`` when the message is built).
TICK_TEXT = T.StructType(
    [
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("rate", T.DoubleType()),
    ]
)

# One target-currency quote inside a raw response.
QUOTE = T.StructType(
    [
        T.StructField("price", T.DoubleType()),
        T.StructField("last_updated", T.StringType()),
    ]
)

# Raw quote response:
#   {"status": {"error_code": 0, "error_message": null},
#    "data": {"<SYM>": [ {"quote": {"<CUR>": {"price": .., "last_updated": ".."}}} ]}}
RAW_RESPONSE = T.StructType(
    [
        T.StructField(
            "status",
            T.StructType(
                [
                    T.StructField("error_code", T.StringType()),  # a number, or a number as text
                    T.StructField("error_message", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "data",
            T.MapType(
                T.StringType(),
                T.ArrayType(
                    T.StructType(
                        [T.StructField("quote", T.MapType(T.StringType(), QUOTE))]
                    )
                ),
            ),
        ),
    ]
)

# Sink tables ("timestamp without time zone" -> TIMESTAMP_NTZ).
SINK_PRICE = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("window_end", T.TimestampNTZType(), True),
        T.StructField("from_currency", T.StringType(), False),
        T.StructField("to_currency", T.StringType(), False),
        T.StructField("rate", T.DoubleType(), False),
    ]
)

SINK_HLA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("window_end", T.TimestampNTZType(), False),
        T.StructField("from_currency", T.StringType(), False),
        T.StructField("to_currency", T.StringType(), False),
        T.StructField("high_rate", T.DoubleType(), False),
        T.StructField("low_rate", T.DoubleType(), False),
        T.StructField("avg_rate", T.DoubleType(), False),
    ]
)

# Key of every windowed table (the original keyed on window_start and
# from_currency only; the target currency is added so a second target cannot
# collide).
SINK_KEY = ("window_start", "from_currency", "to_currency")


def sink_schema_for(aggs: dict) -> T.StructType:
    """The sink schema matching an aggregate layout."""
    if list(aggs) == ["rate"]:
        return SINK_PRICE
    if list(aggs) == ["high_rate", "low_rate", "avg_rate"]:
        return SINK_HLA
    fields = SINK_HLA.fields[:4] + [
        T.StructField(name, T.LongType() if fn == "count" else T.DoubleType(), False)
        for name, fn in aggs.items()
    ]
    return T.StructType(fields)
