"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The symbols of the search are words.  Test strings are the windows of ``window``
consecutive words of each benchmark item (a shorter item is one window).  All test
strings of one length share a block shift table: the last block of words under the
search position tells how far no test string can end, so most positions are skipped.
A shift of zero leads to the bucket of test strings with that suffix and prefix block,
and a direct comparison confirms each occurrence.

The benchmark is a stated set of test items.  It is cut into blocks of at most
``block_mb`` of text, found by running totals over the whole set; each block's tables are
broadcast (bounded by that parameter) and every document is searched against every block.
No document is shuffled.

Defined results: a null or empty text, or one without words, has no words and no hits; a
null or wordless item has no window; repeated rows each give their own result; repeated
items and null item ids count their windows, the id list holds distinct non-null ids; an
empty benchmark hits nothing; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.llm.common import text_bytes
from ticksmith.session import staged

_TO_LOWER = bytes(range(65, 91))
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(_TO_LOWER + _SEPARATORS, _TO_LOWER.lower() + b" " * len(_SEPARATORS))

RESULT = "n_words bigint, n_hit bigint, spans array<struct<start: bigint, end: bigint>>, items array<bigint>"


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


class _Group:
    """Wu-Manber tables for test strings of one length in words."""

    def __init__(self, length: int, block: int):
        self.length, self.block = length, min(block, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple[list[bytes], list[int]]]]] = {}

    def add(self, words: list[bytes], ids: list[int]) -> None:
        k, b = self.length, self.block
        for end in range(b, k + 1):
            key = tuple(words[end - b:end])
            self.shift[key] = min(self.shift.get(key, self.default), k - end)
        suffixes = self.buckets.setdefault(tuple(words[k - b:]), {})
        suffixes.setdefault(tuple(words[:b]), []).append((words, ids))

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        k, b, n = self.length, self.block, len(words)
        shift, default, buckets = self.shift.get, self.default, self.buckets
        end = k
        while end <= n:
            key = (words[end - 2], words[end - 1]) if b == 2 else tuple(words[end - b:end])
            skip = shift(key, default)
            if skip:
                end += skip
                continue
            start = end - k
            for pattern, ids in buckets[key].get(tuple(words[start:start + b]), ()):
                if words[start:end] == pattern:
                    yield start, end, ids
            end += 1


class WordSearch:
    """All test strings of a block of items, one group of tables for each length."""

    def __init__(self, items: Iterable[tuple[int | None, bytes | None]], window: int = 10, block: int = 2):
        patterns: dict[tuple[bytes, ...], list[int]] = {}
        for item, text in items:
            words = words_of(text)
            k = min(window, len(words))
            for i in range(len(words) - k + 1 if words else 0):
                ids = patterns.setdefault(tuple(words[i:i + k]), [])
                if item is not None and item not in ids[-1:]:
                    ids.append(item)
        self.groups: dict[int, _Group] = {}
        for pattern, ids in patterns.items():
            k = len(pattern)
            self.groups.setdefault(k, _Group(k, block)).add(list(pattern), ids)

    def search(self, text: bytes | None) -> tuple[int, int, list[tuple[int, int]], list[int]]:
        """Word count, hit words, merged hit spans in words, and the items with occurring windows."""
        words = words_of(text)
        found, items = [], set()
        for group in self.groups.values():
            for start, end, ids in group.scan(words):
                found.append((start, end))
                items.update(ids)
        spans: list[list[int]] = []
        for start, end in sorted(found):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end])
        return len(words), sum(e - s for s, e in spans), spans, sorted(items)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_mb: float) -> Iterator[list]:
    """The benchmark in blocks of about ``block_mb``; a larger item is a block of its own.

    Running totals are taken over groups of rows of a hash first, so no window holds the whole set.
    """
    limit = int(block_mb * 1e6)
    rows = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(text_col).alias("text"))
    rows = rows.withColumn("g", F.pmod(F.xxhash64("item", "text"), F.lit(1 << 16)))
    sizes = rows.groupBy("g").agg(F.sum(F.octet_length("text") + 16).alias("size"))
    total = F.sum("size").over(Window.orderBy("g"))
    blocks = sizes.select("g", F.floor(total / limit).alias("block")).groupBy("block").agg(
        F.min("g").alias("lo"), F.max("g").alias("hi"))
    for lo, hi in blocks.orderBy("block").select("lo", "hi").collect():
        part = rows.filter(F.col("g").between(lo, hi)).orderBy("item", "text")
        yield [(r.item, r.text.encode() if r.text is not None else None) for r in part.select("item", "text").collect()]


def _search_column(docs: DataFrame, text_col: str, search: WordSearch):
    held = docs.sparkSession.sparkContext.broadcast(search)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        for texts in parts:
            found = [own.search(t) for t in text_bytes(texts)]
            yield pa.array(
                [{"n_words": n, "n_hit": h, "spans": [{"start": s, "end": e} for s, e in spans], "items": items}
                 for n, h, spans, items in found], type=_KIND)

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RESULT).asNondeterministic()(F.col(text_col))


_KIND = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64()))])


def search_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = 10, block: int = 2, block_mb: float = 32, result_col: str = "hits",
) -> DataFrame:
    """``docs`` with a struct column ``result_col``: n_words, n_hit, merged hit spans in words, item ids.

    ``block_mb`` bounds each broadcast (the tables take some 20 times the text).  With several
    blocks each adds to what the ones before it found, in a pass of its own over a staged copy.
    """
    out = docs
    blocks = _blocks(benchmark, item_col, item_text_col, block_mb)
    search = WordSearch(next(blocks, []), window, block)
    out = out.withColumn(result_col, _search_column(out, text_col, search))
    for items in blocks:
        search = WordSearch(items, window, block)
        out = staged(out, "decontam")  # a pass of its own: a worker holds one block's tables
        out = out.withColumn("__next", _search_column(out, text_col, search))
        out = out.withColumn(result_col, _merged(F.col(result_col), F.col("__next"))).drop("__next")
    return out


def _merged(a, b):
    """The union of two blocks' findings for one document."""
    both = F.array_sort(F.concat(a["spans"], b["spans"]))
    spans = F.aggregate(
        both, F.array().cast("array<struct<start: bigint, end: bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                 F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(x))))
    return F.struct(
        a["n_words"].alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"]).alias("n_hit"),
        spans.alias("spans"),
        F.array_sort(F.array_union(a["items"], b["items"])).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Only the documents without any occurring window, with their own columns."""
    found = search_benchmark(docs, benchmark, result_col="__hits", **kw)
    return found.filter(F.col("__hits.n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
