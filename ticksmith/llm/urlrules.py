"""URL filters by a bit-parallel wildcard automaton (multiword Shift-And).

All rules become globs over one canonical form of a URL, ``.host/path`` (host lower-cased A-Z,
no query, no fragment), and all globs are packed one after another into the bits of as many
64-bit words as they need.  A byte moves all of them at once:
``D = ((D << 1 | first) & B[byte]) | (D & S[byte])``, where ``B`` holds the places a byte may
enter and ``S`` those it may stay in (stars).  In a glob ``*`` stands for any run without
``/`` and ``**`` for any run; a glob must fit the whole canonical URL.

A path rule (host, path) is the glob ``*.host`` + path + ``**``: the host itself and all its
subdomains, paths that start with the rule's.  The longest rule (host and path together)
that fits wins; between equally long ones the longer host, then block.  Where none fits, the
verdict is block if any of the ``blocked`` globs fits, else allow.

A batch of URLs runs side by side, byte by byte; a URL leaves once its automaton can change no
more, so a very long one costs only as far as a glob still lives.  Defined results: null or a
URL without ``://`` has an empty host and path and fits no rule (globs see ``.``); an empty
path fits no rule; repeated rows are judged alike; an empty rule set allows everything; columns
of the frame stay, the result is one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import lower_az, text_bytes

_STAR, _STARS = -1, -2


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return "*." + _literal(self.host) + _literal(self.path) + "**"


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("*", "\\*")


def _symbols(glob: str) -> list[int]:
    """Bytes, and negative numbers for stars; a backslash takes the next character as it is."""
    out, i = [], 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            out += glob[i + 1].encode()
            i += 2
        elif glob.startswith("**", i):
            out.append(_STARS)
            i += 2
        elif glob[i] == "*":
            out.append(_STAR)
            i += 1
        else:
            out += glob[i].encode()
            i += 1
    return out


class Automaton:
    """All globs in one row of bits.  Bit ``p`` of a glob says: its first ``p`` letters have been read."""

    def __init__(self, globs: list[str]):
        # place 0 is "nothing read"; a star gives its place a loop instead of a place of its own
        enter: list[tuple[int, int]] = []  # (bit, byte)
        loops: list[tuple[int, int]] = []  # (bit, star)
        starts, self.accepts, at = [], [], 0
        for glob in globs:
            starts.append(at)
            for s in _symbols(glob):
                if s < 0:
                    loops.append((at, s))
                else:
                    at += 1
                    enter.append((at, s))
            self.accepts.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.begin = self._mask(starts)
        self.b, self.s = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        for bit, byte in enter:
            self.b[byte] |= self._mask([bit])
        for bit, star in loops:
            stay = self._mask([bit])
            for byte in range(256):
                if star == _STARS or byte != ord("/"):
                    self.s[byte] |= stay
        every = {bit for bit, star in loops if star == _STARS}
        self.final = self._mask([a for a in self.accepts if a in every])  # accepting for good

    def _mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for bit in bits:
            out[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return out

    def run(self, texts: list[bytes]) -> np.ndarray:
        """(texts, globs) booleans: which globs fit the whole of each text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        first = np.cumsum(lengths) - lengths
        done = np.tile(self.begin, (len(texts), 1))
        rows, state, at = np.arange(len(texts)), done.copy(), 0
        one, top = np.uint64(1), np.uint64(63)
        while True:
            live = (lengths[rows] > at) & (state & ~self.final).any(axis=1)
            if not live.all():
                done[rows[~live]] = state[~live]
                rows, state = rows[live], state[live]
            if not len(rows):
                break
            byte = flat[first[rows] + at]
            moved = state << one
            moved[:, 1:] |= state[:, :-1] >> top
            state = (moved & self.b[byte]) | (state & self.s[byte])
            at += 1
        acc = np.array(self.accepts, np.int64)
        return (done[:, acc // 64] >> (acc % 64).astype(np.uint64) & one).astype(bool)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_az(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(
    pages: DataFrame, rules: list[Rule], *, blocked: list[str] | None = None, url_col: str = "url", result_col: str = "judged",
) -> DataFrame:
    """``pages`` with a struct column ``result_col`` of host, path, rule and verdict."""
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name))
    automaton = Automaton([r.glob for r in order] + list(blocked or []))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for urls in batches:
            names, verdicts = [None] * len(urls), ["allow"] * len(urls)
            texts = list(text_bytes(urls))
            found = automaton.run(texts) if texts else np.zeros((0, 0), bool)
            fits = found.any(axis=1) if found.size else np.zeros(len(texts), bool)
            for i in np.flatnonzero(fits):
                best = int(found[i].argmax())
                if best < len(order):
                    names[i], verdicts[i] = order[best].name, order[best].verdict
                else:
                    verdicts[i] = "block"
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(verdicts, pa.string())], names=["rule", "verdict"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    host, path = host_of(pages[url_col]), path_of(pages[url_col])
    code = F.arrow_udf(run, "rule string, verdict string")(F.concat(F.lit("."), host, path))
    held = pages.select("*", F.struct(host.alias("host"), path.alias("path"), code.alias("found")).alias(result_col))
    r = F.col(result_col)
    return held.withColumn(result_col, F.struct(r["host"], r["path"], r["found"]["rule"].alias("rule"), r["found"]["verdict"].alias("verdict")))
