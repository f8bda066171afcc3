"""Tab-separated bulk loads (PostgreSQL ``COPY ... FROM stdin`` text format).

Rows are tab separated, ``\\N`` is NULL, timestamps are ``yyyy-MM-dd HH:mm:ss``
with optional fractional seconds, and tabs, line ends and backslashes in texts are
written with a backslash.  Two forms are read, each in parallel by file split:

* :func:`load_copy_text`: files of rows alone (with or without a last ``\\.`` line).
* :func:`read_copy_dump`: dumps, in which blocks of several tables stand one after another, each
  between ``COPY <table> (<columns>) FROM stdin;`` and ``\\.``.  Columns go by the block's header.

Rows that do not fit the schema (short rows, bad numbers) are set aside with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = "\\N"
TS_READ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TS_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_OPTIONS = {
    "sep": "\t",
    "header": "false",
    "nullValue": NULL_TOKEN,
    "quote": "\u0000",
    "escape": "\u0000",
    "timestampNTZFormat": TS_READ_FORMAT,
    "timestampFormat": TS_READ_FORMAT,
    "mode": "PERMISSIVE",
}

_HEADER = r'^COPY\s+(?:"?\w+"?\.)?"?(\w+)"?\s*\((.*)\)\s+FROM\s+stdin\b.*;\s*$'
_ESCAPES = {"b": "08", "f": "0C", "n": "0A", "r": "0D", "t": "09", "v": "0B"}


def unescaped(text: Column) -> Column:
    """The text that a field stands for: ``\\t`` and the like, bytes as ``\\ooo`` or ``\\xhh``, any other ``\\c`` is c."""
    # a byte may be part of a character, so the parts are joined as bytes
    parts = F.regexp_extract_all(text, F.lit(r"(?s)\\(?:[0-7]{1,3}|x[0-9A-Fa-f]{1,2}|.)|[^\\]+|\\$"), F.lit(0))

    def as_hex(part: Column) -> Column:
        mark, body = F.substring(part, 2, 1), F.substr(part, F.lit(2))
        out = F.when(~part.startswith("\\") | (F.length(part) == 1), F.hex(F.encode(part, "UTF-8")))
        out = out.when(mark.between("0", "7"), F.lpad(F.conv(body, 8, 16), 3, "0").substr(2, 2))
        out = out.when((mark == "x") & (F.length(part) > 2), F.lpad(F.substr(part, F.lit(3)), 2, "0"))
        for letter, code in _ESCAPES.items():
            out = out.when(mark == letter, F.lit(code))
        return out.otherwise(F.hex(F.encode(body, "UTF-8")))

    joined = F.decode(F.unhex(F.array_join(F.transform(parts, as_hex), "")), "UTF-8")
    return F.when(F.instr(text, "\\") > 0, joined).otherwise(text)


def escaped(text: Column) -> Column:
    for raw, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def _written_time(value: Column) -> Column:
    """Seconds, and a fraction of six digits where there is one."""
    seconds = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_format(value, "SSSSSS") == "000000", seconds).otherwise(F.date_format(value, TS_WRITE_FORMAT))


def _field_rows(lines: DataFrame, value: Column, names: Column, schema: T.StructType) -> DataFrame:
    """The typed columns of lines whose fields have these names, and ``_reason``."""
    fields = F.split(value, "\t")
    lines = lines.select(fields.alias("_fields"), names.alias("_names"))
    texts = []
    for f in schema.fields:
        text = F.get(F.col("_fields"), F.array_position(F.col("_names"), f.name).cast("int") - 1)
        text = F.when(text != NULL_TOKEN, text)
        texts.append((unescaped(text) if isinstance(f.dataType, T.StringType) else text).alias(f.name))
    texts = lines.select(*texts, (F.size("_fields") != F.size("_names")).alias("_uneven"), F.size("_names").alias("_n"))
    reason = F.when(F.col("_uneven"), F.concat(F.lit("expected "), F.col("_n").cast("string"), F.lit(" fields")))
    for f in schema.fields:
        reason = reason.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"{f.name} malformed"))
        if not f.nullable:
            reason = reason.when(F.col(f.name).isNull(), F.lit(f"{f.name} is null"))
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], reason.alias("_reason"))



def read_copy_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the COPY text files at ``path`` plus ``_reason`` (NULL = loadable).

    A row is rejected when a column declared NOT NULL came out NULL (missing,
    ``\\N``, or not parseable as its type).
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    df = (
        spark.read.options(**_OPTIONS)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .schema(with_corrupt)
        .csv(path)
    )
    required = [f.name for f in schema.fields if not f.nullable]
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed row"))
    for name in reversed(required):
        reason = F.when(F.col(name).isNull(), F.lit(f"{name} is null or malformed")).otherwise(reason)
    return df.withColumn("_reason", reason).drop("_corrupt")


def load_copy_text(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(loadable rows in ``schema``, rejected rows with ``reason``)."""
    tagged = read_copy_text(spark, path, schema)
    good = tagged.where(F.col("_reason").isNull()).select(*[
        unescaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])
    bad = tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def write_copy_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` in the same text format (one file per partition)."""
    copy_lines(df).write.mode(mode).text(path)


def copy_lines(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``value``: each row as a line, its columns in order; after the columns of ``keep``, which are not written."""
    def text(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return _written_time(F.col(f.name))
        plain = F.col(f.name).cast("string")
        return escaped(plain) if isinstance(f.dataType, T.StringType) else plain

    fields = [F.coalesce(text(f), F.lit(NULL_TOKEN)) for f in df.schema.fields if f.name not in keep]
    return df.select(*keep, F.concat_ws("\t", *fields).alias("value"))


def _dump_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines with their place: file, start of the file's split, and a number that rises within the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"), F.regexp_replace("value", "\r$", "").alias("value"))


def copy_blocks(lines: DataFrame) -> DataFrame:
    """``file, table, columns, first, last``: where each block begins and ends, from the marks alone.

    A line that looks like a header is one only outside a block: after a ``\\.`` or as a file's first mark.
    Without a last ``\\.`` (a dump cut short) a block goes on to the file's end: ``last`` is null.
    """
    header = F.col("value").rlike(_HEADER)
    marks = lines.where(F.col("value").startswith("COPY") & header | (F.col("value") == "\\.")).select(
        "_file", F.struct("_split", "_line").alias("at"), "value", (F.col("value") == "\\.").alias("end"))
    in_file = Window.partitionBy("_file").orderBy("at")
    marks = marks.select(
        "*", F.lag("end").over(in_file).alias("before"),
        F.first(F.when(F.col("end"), F.col("at")), ignorenulls=True).over(in_file.rowsBetween(1, Window.unboundedFollowing)).alias("last"))
    names = F.transform(F.split(F.regexp_extract("value", _HEADER, 2), ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    return marks.where(~F.col("end") & F.coalesce("before", F.lit(True))).select(
        F.col("_file").alias("file"), F.regexp_extract("value", _HEADER, 1).alias("table"), names.alias("columns"),
        F.col("at").alias("first"), "last")


def read_copy_dump(spark: SparkSession, path: str, table: str, schema: T.StructType, ordered: bool = False) -> DataFrame:
    """The rows of all blocks of ``table`` in the dumps at ``path`` (a file or a folder), plus ``_reason``.

    Two scans, neither of which brings a file together: the first keeps the marks of blocks, of which the blocks' places in each
    file follow; in the second each line joins the block that it lies in (one row a block: Spark broadcasts
    them while they are few).  A column that a header does not name is NULL, one that the schema does not have is ignored.
    ``ordered``: rows as they stand in the dumps (a sort).
    """
    lines = _dump_lines(spark, path)
    blocks = copy_blocks(lines).where(F.col("table") == table)
    at = F.struct("_split", "_line")
    inside = lines.join(blocks, (F.col("_file") == F.col("file")) & (at > F.col("first")) & (F.col("last").isNull() | (at < F.col("last"))))
    if ordered:
        inside = inside.orderBy("_file", "_split", "_line")
    return _field_rows(inside, F.col("value"), F.col("columns"), schema)


def load_copy_dump(spark: SparkSession, path: str, table: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(loadable rows in ``schema``, rejected rows with ``reason``) of :func:`read_copy_dump`."""
    tagged = read_copy_dump(spark, path, table, schema)
    good = tagged.where(F.col("_reason").isNull()).select(*schema.fieldNames())
    return good, tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")


def read_copy_block(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """:func:`read_copy_dump` in the order of the dump, which must hold the table: without a block of it this is an error."""
    if copy_blocks(_dump_lines(spark, path)).where(F.col("table") == table).isEmpty():
        raise ValueError(f"no COPY block for table {table!r} in {path}")
    return read_copy_dump(spark, path, table, schema, ordered=True)
