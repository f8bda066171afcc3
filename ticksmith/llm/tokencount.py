"""Exact token counts at every prefix of a text, by dynamic programming.

For a byte-pair vocabulary the tokens of a text are fixed by a local rule: a row of tokens is the
encoding of its text if, and only if, every two neighbours are the encoding of their own joined
text.  So the encoding of a prefix is that of a shorter prefix and one last token, and there is
just one token that ends at the prefix and may follow the last token of what comes before it:

    count(prefix) = count(prefix without its last token) + 1

The programme runs over the bytes of each piece that the vocabulary's split makes of a text, and
remembers pieces and prefixes of pieces, which the words of a corpus share.  Pieces are then laid
one after another.  Where a cut makes the split fall otherwise than in the whole text, the count
is that of the cut text: white space at the end of a prefix is one piece with all white space
before it, a contraction that is cut is a mark and letters, and a control string that is cut is
ordinary text.

With the counts at all prefixes a question is a look-up: the tokens of any head of the text
(:func:`tokens_of_head`), or the longest head within a budget (``longest``, counts may fall from one
prefix to the next, as when a letter completes a longer token).  Nothing is encoded again.

Defined results: a null text is empty (0 bytes, 0 tokens, one prefix); control strings inside texts are
single tokens, as the library's default has it; texts of any length are counted whole, in time
linear in their length; repeated rows and null ids are kept; an empty table gives no rows; all columns
pass through as they are, and one named like the result is an error.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.llm.common import in_runs

#: The split of the vocabularies served, as their files have it, and its white space.
_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028-\u2029\u202f\u205f\u3000"
#: Contractions whose first letter alone makes no contraction.
_CUT = ("'re", "'ve", "'ll")
#: Characters on whose kind all versions of Unicode agree; a text with any other is split by the library.
_PLAIN = (r"[\x00-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u04ff\u2000-\u2064\u2066-\u206f\u20a0-\u20bf\u2190-\u21ff"
          r"\u3000-\u3002\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")


def _plain_pieces() -> str:
    """``_PIECES`` for plain texts, with their letters and numbers written out: the standard library splits faster."""
    import regex

    plain = "".join(c for c in map(chr, range(0x10000)) if regex.fullmatch(_PLAIN, c))

    def spans(kind: str) -> str:
        """All characters of a kind as ranges, to stand inside brackets."""
        found = [m.span() for m in regex.finditer(rf"\p{{{kind}}}+", plain)]
        chars = [plain[k] for a, b in found for k in range(a, b)]
        runs = [[c for _, c in run] for _, run in itertools.groupby(enumerate(chars), lambda x: ord(x[1]) - x[0])]
        return "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)

    letters, numbers = spans("L"), spans("N")
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{_SPACE}{letters}{numbers}]+"
            rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


_INT = np.dtype("<i4")
#: Pieces of at most so many bytes are remembered, with a byte for each count.
SHORT = 64


class Counter:
    """Counts at every code point of a text, for one vocabulary file.

    ``memo`` bounds the pieces, the prefixes and the pairs of tokens that are remembered
    (some 200 bytes each); it trades memory for time and changes no result.
    """

    def __init__(self, path: str, memo: int = 1 << 19):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        model = spec["model"]
        if (spec["pre_tokenizer"] != _SPLIT or spec["normalizer"] or model["type"] != "BPE" or model["dropout"]
                or model["ignore_merges"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"]):
            raise ValueError(f"not a byte-level pair vocabulary with the plain split: {path}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"control strings that take in what is beside them: {path}")
        self.merged, self.memo = self.tokenizer.model.tokenize, memo
        # only a token that is the encoding of its own text can stand in an encoding
        self.ids = {t: i for t, i in model["vocab"].items() if [m.id for m in self.merged(t)] == [i]}
        self.texts = {i: t for t, i in self.ids.items()}
        self.states, self.ends = self._automaton()
        self.fronts, self.steps = list(self.states), {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.level = functools.lru_cache(1 << 15)(lambda c: level.pre_tokenize_str(c)[0][0])
        self.split, self.plain = re.compile(_plain_pieces()).findall, regex.compile(_PLAIN).fullmatch
        self.gaps = regex.compile(f"[{_SPACE}]{{2,}}(?=[^{_SPACE}])").finditer
        controls = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.controls = regex.compile("|".join(map(regex.escape, controls))) if controls else None
        self.pairs: dict[int, bool] = {}
        self.heads: dict[str, list[tuple[int, int, int]]] = {}
        self.known: dict[str, bytes] = {}

    def _automaton(self) -> tuple[dict[str, int], list[tuple[tuple[int, int], ...]]]:
        """The state of every string that begins a token, and for each: (length, id) of all tokens that end it, the longest first."""
        states, ends = {"": 0}, [()]
        for front in sorted({t[:k] for t in self.ids for k in range(1, len(t) + 1)}, key=len):
            shorter = next(front[k:] for k in range(1, len(front) + 1) if front[k:] in states)
            own = self.ids.get(front)
            ends.append((((len(front), own),) if own is not None else ()) + ends[states[shorter]])
            states[front] = len(states)
        return states, ends

    def _step(self, state: int, char: str) -> int:
        """The state of the longest end that begins a token, one character further."""
        front = self.fronts[state] + char
        while front not in self.states:
            front = front[1:]
        if len(self.steps) >= self.memo:
            self.steps.clear()
        found = self.steps[state << 9 | ord(char)] = self.states[front]
        return found

    def _follows(self, a: int, b: int) -> bool:
        """Whether two tokens are the encoding of their joined text."""
        if len(self.pairs) >= self.memo:
            self.pairs.clear()
        found = self.pairs[a << 17 | b] = [m.id for m in self.merged(self.texts[a] + self.texts[b])] == [a, b]
        return found

    def _rows(self, piece: str) -> list[tuple[int, int, int]]:
        """(count, last token, state) of each prefix of a piece (a string of a character for each byte), the empty one first.

        Rows of pieces of at most SHORT bytes are kept under each of their prefixes, for all pieces that begin so.
        """
        heads, ends, pairs, steps, size = self.heads, self.ends, self.pairs, self.steps, len(piece)
        known, rows = 0, [(0, -1, 0)]
        if size <= SHORT:
            if len(heads) >= self.memo:
                heads.clear()
            for known in range(size, 0, -1):
                if (found := heads.get(piece[:known])) is not None:
                    rows = found[:known + 1]
                    break
            else:
                known = 0
        state = rows[-1][2]
        for end in range(known + 1, size + 1):
            char = piece[end - 1]
            then = steps.get(state << 9 | ord(char))
            state = self._step(state, char) if then is None else then
            for length, token in ends[state]:
                count, last, _ = rows[end - length]
                if not count:
                    break
                follows = pairs.get(last << 17 | token)
                if follows is None:
                    follows = self._follows(last, token)
                if follows:
                    break
            else:
                raise AssertionError(f"no token ends {piece[:end]!r}")
            rows.append((count + 1, token, state))
            if size <= SHORT:
                heads[piece[:end]] = rows
        return rows

    def _piece(self, word: str) -> bytes | np.ndarray:
        """The counts after each code point of a piece: a byte each, or numbers if it has more than SHORT bytes."""
        found = self.known.get(word)
        if found is None:
            if word.isascii() and word.isprintable():  # written as they are, but for the space
                mapped, piece = word, word.replace(" ", self.level(" "))
            else:
                mapped = list(map(self.level, word))
                piece = "".join(mapped)
            counts = [r[0] for r in self._rows(piece)]
            if len(piece) > SHORT:
                return np.array(counts, _INT)[np.cumsum([len(x) for x in mapped])]
            if word in _CUT:
                counts[2] = counts[1] + self._rows(piece[1])[1][0]
            elif len(piece) > len(word):
                counts = [counts[k] for k in itertools.accumulate(map(len, mapped), initial=0)]
            found = bytes(counts[1:])
            if len(self.known) >= self.memo:
                self.known.clear()
            self.known[word] = found
        return found

    def _ordinary(self, text: str) -> np.ndarray:
        """The count at each prefix, the empty one first, of a text without control strings."""
        out = np.zeros(len(text) + 1, _INT)
        if not text:
            return out
        if self.plain(text):
            pieces = self.split(text)
        else:
            pieces = [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        rows, short = list(map(self.known.get, pieces)), True
        if None in rows:
            for i, found in enumerate(rows):
                if found is None:
                    rows[i] = found = self._piece(pieces[i])
                    short = short and type(found) is bytes
        sizes = np.array(list(map(len, pieces)))
        if short:
            inner = np.frombuffer(b"".join(rows), np.uint8).astype(_INT)
        else:
            inner = np.concatenate([np.frombuffer(r, np.uint8) if type(r) is bytes else r for r in rows]).astype(_INT)
        whole = inner[np.cumsum(sizes) - 1]
        out[1:] = inner + np.repeat(np.cumsum(whole) - whole, sizes)
        for gap in self.gaps(text):  # cut at their end, these are one piece; in the whole text the last character is not
            a, b = gap.span()
            out[b] = out[a] + self._piece(text[a:b])[-1]
        return out

    def at_prefixes(self, text: str | None) -> np.ndarray:
        """The count of tokens of the first k code points of ``text``, for each k from 0."""
        text = text or ""
        parts = [m.span() for m in self.controls.finditer(text)] if self.controls else []
        if not parts:
            return self._ordinary(text)
        out, total, at = [np.zeros(1, _INT)], 0, 0
        for a, b in parts:
            # up to its last character a control string is ordinary text
            counts = self._ordinary(text[at:b - 1])[1:] + total
            total += 1 + (counts[a - at - 1] - total if a > at else 0)
            out += [counts, np.array([total], _INT)]
            at = b
        return np.concatenate([*out, self._ordinary(text[at:])[1:] + total]).astype(_INT)


    def of_all(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """:meth:`at_prefixes` of each text; no cycles are made, and the collector would walk through all that is remembered."""
        running = gc.isenabled()
        gc.disable()
        try:
            return [self.at_prefixes(t) for t in texts]
        finally:
            if running:
                gc.enable()


@functools.lru_cache(maxsize=2)
def _counter(path: str, memo: int) -> Counter:
    return Counter(path, memo)


def count_prefixes(
    docs: DataFrame, tokenizer_path: str, *, text_col: str = "text", carry: Sequence[str] | None = None,
    budgets: Sequence[int] = (), result_col: str = "tokens", memo: int = 1 << 19,
) -> DataFrame:
    """The columns ``carry`` (default: all) with a struct column:

    ``n_bytes`` of the text in UTF-8, ``prefixes`` (the count of tokens of the first k code points, for each
    k from 0), and ``longest`` (for each budget the code points of the longest prefix with that many tokens or less).
    """
    carry = list(docs.columns if carry is None else carry)
    if result_col in carry:
        raise ValueError(f"a column is named like the result: {result_col}")
    limits = [int(b) for b in budgets]
    found = T.StructType.fromDDL("n_bytes long, prefixes array<int>, longest array<long>")
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(result_col, found)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path, memo)
        for batch in batches:
            texts, at = batch.column(batch.num_columns - 1), 0
            for some in in_runs((t.as_py() or "" for t in texts), len, 1 << 20):
                counts = counter.of_all(some)
                ends = np.concatenate([[0], np.cumsum([len(c) for c in counts])]).astype(np.int32)
                longest = [int(np.flatnonzero(c <= b)[-1]) if b >= 0 else -1 for c in counts for b in limits]
                each = np.arange(len(some) + 1, dtype=np.int32) * len(limits)
                result = pa.StructArray.from_arrays([
                    pa.array([len(t.encode()) for t in some], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(counts))),
                    pa.ListArray.from_arrays(pa.array(each), pa.array(longest, pa.int64()))], ["n_bytes", "prefixes", "longest"])
                rest = batch.slice(at, len(some)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*rest, result], [*carry, result_col])
                at += len(some)

    return docs.select(*[docs[c] for c in carry], docs[text_col].cast("string").alias("__text")).mapInArrow(run, schema)


def tokens_of(counted: Column) -> Column:
    """The tokens of the whole text: the count at its last prefix."""
    return F.element_at(counted["prefixes"], -1).cast("long")


def tokens_of_head(counted: Column, n_chars: Column | int) -> Column:
    """The tokens of the first ``n_chars`` code points (of the whole text, if it is shorter)."""
    n = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    return F.element_at(counted["prefixes"], F.least(n.cast("int") + 1, F.size(counted["prefixes"]))).cast("long")


def cut_to(text: Column, counted: Column, budget: int) -> Column:
    """The longest head of ``text`` that keeps to the budget of that number among those counted (the first is 0)."""
    return F.substring(text, F.lit(1), counted["longest"][budget].cast("int"))
