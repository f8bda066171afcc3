"""Packing of documents into token sequences by minimum bin slack.

A document is its token ids and an end id.  Whole windows of ``capacity`` ids are cut from the
front of a long one; what remains goes into a pool.  Once the pool holds ``pool_tokens`` ids,
windows are filled from it: the longest piece opens a window, and a subset-sum dynamic
programme over a bitset (bit t: t ids can be reached; a length that occurs c times enters in
steps of 1, 2, 4, ... copies) picks the multiset of remaining lengths that comes closest to the
capacity; the counts are traced back through the bitsets, and the pattern is used as often as
its lengths last.  Windows that are not quite full wait in the pool for more pieces.

Every task packs its own rows as a stream, with a pool of bounded size, without a shuffle.
At the end of its rows the remaining pieces are filled in the same way, and what is still
left of a last, unfilled window is cut into sequences whose lengths are powers of two, which
need no padding.  So only pieces at a task's end are cut beyond the cut at ``capacity``.

Sequence numbers are the task's number times 2**33 plus a count: a repeated task reads the
same rows and gives the same numbers.

Defined results: a null text is empty and has the end id alone; texts of any length are
encoded whole; repeated rows and null ids are packed like others; an empty table gives no
rows; other columns are ignored but for the one named as id.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = ("start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long")
CAPACITY = 4096


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths (with counts at most ``counts``) whose sum is closest to ``room`` from below."""
    if room <= 0:
        return {}
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            k = min(copies, left)
            grown = (reach | reach << (length * k)) & mask
            if grown != reach:
                steps.append((length, k, reach))
                reach = grown
            left, copies = left - k, copies * 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:  # cannot be reached without these copies
            out[length] = out.get(length, 0) + k
            at -= length * k
    return out


class Packer:
    """Packs pieces (doc, start, ids, doc_tokens) that come one by one; yields (piece, sequence, offset)."""

    def __init__(self, first: int, capacity: int = CAPACITY, pool_tokens: int = 1 << 20):
        self.next, self.capacity, self.limit = first, capacity, pool_tokens
        self.pool: dict[int, deque] = {}
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, cap = len(ids), self.capacity
        for at in range(0, total - total % cap, cap):
            yield (doc, at, ids[at:at + cap], total), self.next, 0
            self.next += 1
        at = total - total % cap
        if at < total:
            self.pool.setdefault(total - at, deque()).append((doc, at, ids[at:].copy(), total))
            self.held += total - at
        if self.held >= self.limit:
            yield from self.drain(self.limit // 4, wait=True)

    def _emit(self, lengths: list[int]) -> Iterator[tuple]:
        offset = 0
        for length in lengths:
            pieces = self.pool[length]
            yield pieces.popleft(), self.next, offset
            if not pieces:
                del self.pool[length]
            offset += length
            self.held -= length
        self.next += 1

    def drain(self, down_to: int, wait: bool) -> Iterator[tuple]:
        """Fill windows until ``down_to`` ids are left; with ``wait`` only full ones, unless too few can be filled."""
        strict = wait
        while self.held > down_to and self.pool:
            passed = 0
            for seed in sorted(self.pool, reverse=True):
                while seed in self.pool and self.held > down_to:
                    counts = {x: len(p) - (x == seed) for x, p in self.pool.items()}
                    fill = best_fill(counts, self.capacity - seed)
                    fill[seed] = fill.get(seed, 0) + 1
                    short = self.capacity - sum(x * n for x, n in fill.items())
                    if short and (strict or (not wait and self.held <= 2 * self.capacity)):
                        break
                    lengths = [x for x, n in sorted(fill.items(), reverse=True) for _ in range(n)]
                    for _ in range(min(len(self.pool[x]) // n for x, n in fill.items())):
                        if self.held > down_to:
                            yield from self._emit(lengths)
                            passed += 1
            if not passed:
                if not strict:
                    return
                strict = False

    def finish(self) -> Iterator[tuple]:
        """All that is left: windows as full as can be, then powers of two without padding."""
        yield from self.drain(0, wait=False)
        rest = [p for length in sorted(self.pool, reverse=True) for p in self.pool[length]]
        left, at, offset = sum(len(p[2]) for p in rest), 0, 0
        size = min(self.capacity, 1 << max(left.bit_length() - 1, 0))
        for doc, start, ids, total in rest:
            at = 0
            while at < len(ids):
                n = min(len(ids) - at, size - offset)
                yield (doc, start + at, ids[at:at + n], total), self.next, offset
                at, offset, left = at + n, offset + n, left - n
                if offset == size:
                    self.next, offset = self.next + 1, 0
                    size = min(self.capacity, 1 << max(left.bit_length() - 1, 0))
        self.pool, self.held = {}, 0


#: The normalizer and the split of the vocabularies whose words stand alone, as their files have them.
_WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Letters that no normal form joins or changes when alone, then marks that no contraction begins with.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿА-ЯЁа-яё]+)([.,;:!?]*)")
_MARKS = re.compile("[.,;:!?]+")


class _Levels(dict):
    """Code points to the characters that byte-level vocabularies write their bytes as, for ``str.translate``."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.level = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        found = self[code] = self.level.pre_tokenize_str(chr(code))[0][0]
        return found


class _Words(dict):
    """The ids of words, encoded when first met; at most ``limit`` words of at most 64 characters are remembered.

    A plain word (letters, then marks) is two tokens of the split, which go to the vocabulary's
    merges directly; any other one goes through the whole tokenizer.
    """

    def __init__(self, tokenizer, limit: int):
        super().__init__()
        self.tokenizer, self.limit, self.levels, self.merged = tokenizer, limit, _Levels(), tokenizer.model.tokenize

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain:
            letters, marks = plain.groups()
            low = letters.lower()
            if low != word:  # the same word stands elsewhere without marks and capitals
                found = self[low] + (self[marks] if marks else b"")
            else:
                found = self._packed([t.id for t in self.merged(low.translate(self.levels))])
        elif _MARKS.fullmatch(word):
            found = self._packed([t.id for t in self.merged(word)])
        else:
            found = self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = found
        return found


@functools.lru_cache(maxsize=2)
def _encoder(path: str, end: int, memo_words: int = 1 << 20):
    """Texts to id arrays; the file is read, and words are remembered, once per worker.

    A vocabulary whose file has the split above drops white space and never joins across it, so a
    text's ids are those of its words (between spaces or line feeds), one after another.  With
    any other vocabulary whole texts are encoded.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    spec, last = json.loads(tokenizer.to_str()), np.array([end], "<i4").tobytes()
    if spec["normalizer"] != _WORD_NORMALIZER or spec["pre_tokenizer"] != _WORD_SPLIT or spec["post_processor"]:
        return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], np.int32)
    known = _Words(tokenizer, memo_words)

    def encode(text: str | None) -> np.ndarray:
        words = (text or "").replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(known.__getitem__, words)) + last, np.int32)

    return encode


def pack(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end: int = 2,
    capacity: int = CAPACITY, pool_tokens: int = 1 << 20, memo_words: int = 1 << 20,
) -> DataFrame:
    """One row per piece: the id column, start, length, ids, doc_tokens, sequence_id and offset.

    ``memo_words`` bounds the words whose ids a worker remembers (some 200 bytes each); it
    trades memory for time and changes no result.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _encoder(tokenizer_path, end, memo_words)
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, pool_tokens)
        kinds = None

        def placed() -> Iterator[tuple]:
            nonlocal kinds
            for batch in batches:
                kinds = batch.column(0).type
                for at in range(0, batch.num_rows, 512):
                    for doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)):
                        yield from packer.add(doc, encode(text))
            yield from packer.finish()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            pieces = [r[0] for r in rows]
            lengths = [len(p[2]) for p in pieces]
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(np.concatenate([p[2] for p in pieces])))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pieces], kinds), pa.array([p[1] for p in pieces], pa.int64()), pa.array(lengths, pa.int64()), ids,
                 pa.array([p[3] for p in pieces], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        held, size = [], 0
        for row in placed():
            held.append(row)
            size += len(row[0][2])
            if size > 1 << 19 or len(held) >= 5000:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {id_type}, {PIECES}")


def crc_of(ids):
    """The unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in parts:
            flat, at = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            yield pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.int64())

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(ids)
