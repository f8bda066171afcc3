"""Documents of concatenated JSON, by nesting depth and string state.

A file of landed responses may hold one document or several, pretty-printed or one after another without
a separator.  Where one ends and the next begins shows in the brackets outside strings alone, so no
document is parsed here: a small scan per file, which Spark runs over many files at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK = re.compile(r'"(?:[^"\\]|\\.)*"?|[{}\[\]]', re.DOTALL)


def split_documents(text: str) -> list[str]:
    """The documents of a text in order; what stands between them (but white space and commas) is one of its own.

    A document that is not closed goes on to the end.  Nothing is lost: a text without a document is one itself.
    """
    out, depth, start = [], 0, 0

    def stray(upto: int) -> None:
        between = text[start:upto].strip(" \t\r\n,")
        if between:
            out.append(between)

    for mark in _MARK.finditer(text):
        if mark.group() in "{[":
            if not depth:
                stray(mark.start())
                start = mark.start()
            depth += 1
        elif mark.group() in "}]" and depth:
            depth -= 1
            if not depth:
                out.append(text[start:mark.end()])
                start = mark.end()
    stray(len(text))
    return out or [text]


def documents(text: Column) -> Column:
    """:func:`split_documents` as a column of arrays; null stays null."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([None if t is None else split_documents(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<string>")(text)
