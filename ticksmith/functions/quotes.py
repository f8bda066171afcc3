"""Raw quote responses -> ticks, with a reason for every response set aside.

A response document looks like::

    {"status": {"error_code": 0, "error_message": null},
     "data": {"BTC": [ {"quote": {"EUR": {"price": 41235.75,
                                           "last_updated": "2023-03-08T09:17:42.000Z"}}} ]}}

With the requested symbol and currency known (one request per row), the quote
is looked up by key; only the first element of the symbol's array counts.
Without them every (symbol, currency) quote in the document is emitted.

Each step is a null-tolerant SQL function (``try_element_at``, ``get``,
``map_contains_key``, ``try_to_timestamp``), so one broken response never
fails the batch: it gets a ``_reason`` instead.  A NULL or text price is a bad
record, never a price of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.functions.ticks_json import fenced, is_blank, is_number
from ticksmith.schema import RAW_RESPONSE

R_EMPTY = "empty response"
R_FORMAT = "API error: unknown response format"
R_API = "API error: "
R_NO_PRICE = "price missing or not a number"
R_NO_UPDATED = "last_updated missing"
R_BAD_UPDATED = "last_updated is not a timestamp"
R_NO_REQUEST = "requested symbol or currency unknown"


def parse_response(body: str | Column) -> Column:
    """The raw response struct (``status``, ``data``) from JSON text."""
    c = F.col(body) if isinstance(body, str) else body
    return F.from_json(c.cast("string"), RAW_RESPONSE)


def to_instant(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP (offsets honoured), NULL when unparseable."""
    return F.try_to_timestamp(text)


def _status_reason(r: Column) -> Column:
    return F.when(r.isNull() | (r["status"].isNull() & r["data"].isNull()), F.lit(R_FORMAT)).when(
        r["status"].isNull(), F.lit(R_FORMAT)
    ).when(
        ~r["status"]["error_code"].try_cast("double").eqNullSafe(F.lit(0.0)),
        F.concat(F.lit(R_API), F.coalesce(r["status"]["error_message"], F.lit(""))),
    )


def _quote_reason(price: Column, updated: Column, ts: Column) -> Column:
    return (
        F.when(~is_number(price), F.lit(R_NO_PRICE))
        .when(updated.isNull(), F.lit(R_NO_UPDATED))
        .when(ts.isNull(), F.lit(R_BAD_UPDATED))
    )


def flatten_requested(
    df: DataFrame,
    body_col: str = "body",
    symbol_col: str = "symbol",
    currency_col: str = "currency",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One tick per (response, requested symbol, requested currency).

    Output: keep..., ``from, to, timestamp, timestamp_text, rate, _reason``.
    """
    parsed = df.select(
        *[F.col(c) for c in keep],
        F.col(symbol_col).alias("from"),
        F.col(currency_col).alias("to"),
        F.col(body_col).cast("string").alias("_body"),
        fenced(parse_response(body_col)).alias("_r"),
    )
    r = F.col("_r")
    sym, cur = F.col("from"), F.col("to")
    entries = F.try_element_at(r["data"], sym)
    first = F.get(entries, 0)
    quote = F.try_element_at(first["quote"], cur)
    price, updated = quote["price"], quote["last_updated"]
    ts = to_instant(updated)
    reason = (
        F.when(F.col("_body").isNull(), F.lit(R_EMPTY))
        .when(is_blank(sym) | is_blank(cur), F.lit(R_NO_REQUEST))
        .otherwise(_status_reason(r))
    )
    reason = F.coalesce(
        reason,
        F.when(
            r["data"].isNull() | ~F.map_contains_key(r["data"], sym),
            F.concat(F.lit("data."), sym, F.lit(" not found")),
        )
        .when(first.isNull(), F.concat(F.lit("data."), sym, F.lit(" is empty")))
        .when(
            first["quote"].isNull() | ~F.map_contains_key(first["quote"], cur),
            F.concat(F.lit("quote."), cur, F.lit(" not found")),
        ),
        _quote_reason(price, updated, ts),
    )
    return parsed.select(
        *[F.col(c) for c in keep],
        sym.alias("from"),
        cur.alias("to"),
        ts.alias("timestamp"),
        updated.alias("timestamp_text"),
        price.alias("rate"),
        reason.alias("_reason"),
    )


def flatten_all(df: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every (symbol, currency) quote of every response, first array element only.

    Responses with a bad status, or without data, keep one row with NULL
    symbol/currency and a reason, so they are counted in the quarantine.
    """
    parsed = df.select(
        *[F.col(c) for c in keep],
        F.col(body_col).cast("string").alias("_body"),
        fenced(parse_response(body_col)).alias("_r"),
    )
    r = F.col("_r")
    head_reason = F.when(F.col("_body").isNull(), F.lit(R_EMPTY)).otherwise(_status_reason(r))
    syms = parsed.select(
        *[F.col(c) for c in keep],
        head_reason.alias("_head"),
        F.explode_outer(F.when(head_reason.isNull(), r["data"])).alias("from", "_entries"),
    )
    first = F.get(F.col("_entries"), 0)
    quotes = syms.select(
        *[F.col(c) for c in keep],
        "_head",
        "from",
        first.isNull().alias("_empty"),
        F.explode_outer(first["quote"]).alias("to", "_q"),
    )
    q = F.col("_q")
    price, updated = q["price"], q["last_updated"]
    ts = to_instant(updated)
    reason = F.coalesce(
        F.col("_head"),
        F.when(F.col("from").isNull(), F.lit("data missing")),
        F.when(F.col("_empty"), F.concat(F.lit("data."), F.col("from"), F.lit(" is empty"))),
        F.when(F.col("to").isNull(), F.concat(F.lit("data."), F.col("from"), F.lit(" has no quote"))),
        _quote_reason(price, updated, ts),
    )
    return quotes.select(
        *[F.col(c) for c in keep],
        "from",
        "to",
        ts.alias("timestamp"),
        updated.alias("timestamp_text"),
        price.alias("rate"),
        reason.alias("_reason"),
    )
