"""Which folders of a streamed table count, where some have been compacted.

A manifest is a small numbered file in ``<table>/_manifest``; the highest number holds.  For each compacted
date it names the folder with the date's compacted rows (``run``) and the batch folders that these replace.
It appears by one rename, which fails if another compaction took the number: a reader sees a date before or after its
compaction, never half of it, and a crash before the rename leaves the table as it was.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ticksmith.session import list_names, put_text, read_text

FOLDER, COMPACTED = "_manifest", "_compacted"


def latest(spark: SparkSession, table: str) -> tuple[int, dict]:
    """(number, {date: {"run": ..., "replaced": [...]}}) of the manifest that holds; (0, {}) without one."""
    numbers = [int(n[:-5]) for n in list_names(spark, f"{table}/{FOLDER}") if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        return 0, {}
    return max(numbers), json.loads(read_text(spark, f"{table}/{FOLDER}/{max(numbers):012d}.json"))


def commit(spark: SparkSession, table: str, number: int, days: dict) -> bool:
    """Write manifest ``number``; False if there is one already."""
    return put_text(spark, f"{table}/{FOLDER}/{number:012d}.json", json.dumps(days, sort_keys=True), replace=False)


def change(spark: SparkSession, table: str, update) -> dict:
    """Commit ``update(days)`` as the next manifest, again from the newest one if another commit came first."""
    while True:
        number, days = latest(spark, table)
        found = update(days)
        if found == days or commit(spark, table, number + 1, found):
            return found
