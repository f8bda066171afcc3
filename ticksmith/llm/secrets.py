"""Secret scans by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the matches of the kinds below.  Every candidate's value is hashed, and over
the whole corpus each hash is counted by distinct owners.  A value of one owner
(``max_owners``) looks like a live credential, in however many of its owner's rows it stands;
one that more owners hold is a copied example.  The exact kinds (``assign``, ``access``,
``hex``) are always reported, with that class; the broad kind ``token`` (long runs of mixed
characters, which prose identifiers, paths and copied samples also give) is reported only where
its value is owner-specific.

Counts are of distinct (hash, owner), combined before each shuffle, so a value held by a third
of all rows is no hot group; candidates are joined to the live values on (hash, salt), as the
rows of one owner may be many.

Defined results: a null text is empty; a document without candidates has empty arrays; null
owners count as one owner; repeated rows each keep their own result row; columns of ``docs`` keep their names and the
result is one struct column, so no name can clash but ``result_col`` itself.  Positions are
code points, end exclusive, found as lengths of the text between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.session import staged

#: The base kinds and their patterns, in their order; the value's group; its least length.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # a maximal run; shorter runs fail
}
#: The broad kind: a run of 28 or more of these, with a digit, a capital and a small letter.  Dots
#: count between others (one at the end closes a sentence), up to two ``=`` at the end as padding.
TOKEN = ("token", r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{24,}[A-Za-z0-9+/_-]={0,2}", 0, 28)
SALTS = 8

_SPANS = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"


def _found(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """All matches of one kind with a long enough value: the gaps between matches give their places."""
    empty = F.array().cast(_SPANS)
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        at = acc["at"] + m["gap"]
        end = at + F.coalesce(F.length(m["whole"]), F.lit(0))
        one = F.struct(at.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value"))
        keep = F.coalesce(F.length(m["value"]) >= least, F.lit(False))
        return F.struct(end.cast("bigint").alias("at"), F.when(
            keep, F.concat(acc["spans"], F.array(one).cast(_SPANS))).otherwise(acc["spans"]).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda acc: acc["spans"])).otherwise(empty)


def _mixed(span: Column) -> Column:
    v = span["value"]
    return v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]")


def candidates(text: Column) -> Column:
    """The candidate spans of a text, by start and then kind; kinds number in the order of BASE, TOKEN last."""
    body = F.coalesce(text, F.lit(""))
    found = [_found(body, i, *spec) for i, spec in enumerate(BASE.values())]
    found.append(F.filter(_found(body, len(BASE), *TOKEN[1:]), _mixed))
    both = F.concat(*found)
    key = F.transform(both, lambda s: F.struct(s["start"], s["kind"], s["end"], s["value"]))
    return F.array_sort(key)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners) of a frame (hash, owner): distinct holders over the whole corpus."""
    return found.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))


def scan(
    docs: DataFrame, *, text_col: str = "text", owner_col: str = "source", carry: list[str] | None = None,
    max_owners: int = 1, result_col: str = "secrets",
) -> DataFrame:
    """The columns ``carry`` (default: all) with a struct column ``result_col`` of ``base`` and ``spans``.

    Both are arrays of (start, kind, end, value, live), kind being a name; ``spans`` adds the
    owner-specific tokens to the base spans.  Candidates are written to the shared folder
    once; what reads them again after a lost executor finds the same row numbers.
    """
    carry = docs.columns if carry is None else carry
    kept = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(carry)]) if carry else F.lit(None)
    rows = staged(docs.select(
        kept.alias("kept"), docs[owner_col].cast("string").alias("owner"),
        candidates(docs[text_col]).alias("found"), F.monotonically_increasing_id().alias("row")), "secrets")
    names = F.array(*[F.lit(k) for k in [*BASE, TOKEN[0]]])
    each = rows.select("row", "owner", F.explode("found").alias("s")).withColumn(
        "hash", F.sha2(F.col("s.value"), 256))
    live = ownership(each).filter(F.col("n_owners") <= max_owners).select(
        F.col("hash").alias("live_hash"), F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("live_salt"))
    salted = each.withColumn("salt", (F.col("row") % SALTS).cast("int"))
    judged = salted.join(
        live, (salted["hash"] == live["live_hash"]) & (salted["salt"] == live["live_salt"]), "left").select(
        "row", F.struct(
            F.col("s.start").alias("start"), F.col("s.kind").alias("k"), F.col("s.end").alias("end"),
            F.col("s.value").alias("value"), F.col("live_hash").isNotNull().alias("live")).alias("s"))
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("s")).withColumnRenamed("row", "judged_row")

    def out(spans: Column, keep) -> Column:
        return F.transform(F.filter(spans, keep), lambda s: F.struct(
            s["start"], F.element_at(names, s["k"] + 1).alias("kind"), s["end"], s["value"], s["live"]))

    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint,value:string,live:boolean>>")
    with_any = rows.filter(F.size("found") > 0).join(per_row, F.col("row") == F.col("judged_row"), "left").select("kept", "s")
    spans = with_any.unionByName(rows.filter(F.size("found") == 0).select("kept", none.alias("s")))
    s = F.coalesce(F.col("s"), none)
    result = F.struct(
        out(s, lambda x: x["k"] < len(BASE)).alias("base"),
        out(s, lambda x: (x["k"] < len(BASE)) | x["live"]).alias("spans"))
    return spans.select(*[F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(carry)], result.alias(result_col))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[kind]``; spans that overlap become one, named by the first."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(spans) > 0, F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))).otherwise(text)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
