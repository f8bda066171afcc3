"""Landed raw quote responses (one JSON document per request).

The poller of the original application called a quote service once per
symbol and minute.  Here the responses are *landed* first (files, a table, a
topic) and read by Spark in bulk, so parsing and validation run in parallel
over all of them.

* :func:`read_landed` -- batch or stream scan of response files.  The request
  (symbol, currency) is taken from the file name ``<SYM>_<CUR>[...].json``
  when present.
* :func:`land_responses` -- build response documents from ticks (the shape a
  quote service returns); used to land test data derived from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.functions.documents import documents
from ticksmith.functions.ticks_json import JSON_TS_FORMAT

API_ERROR_CODE = 1001
API_ERROR_MESSAGE = "This API Key is invalid."

_NAME_RE = r"^([^_/]+)_([A-Za-z0-9]+)"


def read_landed(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    one_document_per_file: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """``symbol, currency, body, source_file, document`` for every landed response.

    ``one_document_per_file`` reads each file whole (``wholetext``) and takes
    the request from the file name; a file with more documents than one gives a row for each (``document``
    counts them from 0, see :func:`~ticksmith.functions.documents.split_documents`).  Otherwise every line
    is one document (JSON lines) and the output is ``body, source_file``.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("text").option("wholetext", str(one_document_per_file).lower())
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    name = F.col("_metadata.file_name")
    if not one_document_per_file:
        # JSON lines carry no request; every quote in a document is used.
        return df.select(F.col("value").alias("body"), name.alias("source_file"))
    sym = F.regexp_extract("source_file", _NAME_RE, 1)
    cur = F.regexp_extract("source_file", _NAME_RE, 2)
    df = df.select(documents(F.col("value")).alias("_documents"), name.alias("source_file"))
    return df.select("source_file", F.posexplode("_documents").alias("document", "body")).select(
        F.when(sym != "", sym).alias("symbol"),
        F.when(cur != "", cur).alias("currency"),
        "body",
        "source_file",
        "document",
    )


def response_body(
    symbol: Column,
    currency: Column,
    price: Column,
    last_updated: Column,
    failed: Column | None = None,
) -> Column:
    """The JSON text a quote service returns for one (symbol, currency) request."""
    ok_status = F.struct(F.lit(0).alias("error_code"), F.lit(None).cast("string").alias("error_message"))
    data = F.create_map(
        symbol,
        F.array(
            F.struct(
                F.create_map(
                    currency,
                    F.struct(price.alias("price"), last_updated.alias("last_updated")),
                ).alias("quote")
            )
        ),
    )
    if failed is None:
        status = ok_status
    else:
        err_status = F.struct(
            F.lit(API_ERROR_CODE).alias("error_code"), F.lit(API_ERROR_MESSAGE).alias("error_message")
        )
        status = F.when(failed, err_status).otherwise(ok_status)
        data = F.when(~failed, data)
    return F.to_json(F.struct(status.alias("status"), data.alias("data")))


def land_responses(ticks: DataFrame, failed: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``symbol, currency, body`` per tick; ``failed`` marks requests the service
    answered with an error status (no data)."""
    updated = F.date_format(F.col("timestamp"), JSON_TS_FORMAT)
    return ticks.select(
        *[F.col(c) for c in keep],
        F.col("from").alias("symbol"),
        F.col("to").alias("currency"),
        response_body(F.col("from"), F.col("to"), F.col("rate"), updated, failed).alias("body"),
    )
