"""Language identification by prediction by partial matching (PPM).

For each language a variable-order byte context tree is counted from labelled texts.  A
context seen ``n`` times with ``q`` different next bytes codes a seen byte with count ``c``
in ``-log2(c / (n + q))`` bits and escapes to the next shorter context at
``-log2(q / (n + q))`` bits; below the empty context every byte costs 8 bits.  With the
statistics frozen, the cost of a byte depends on its context alone, so the whole tree is
unrolled once into a table (context, byte) -> bits per language and the exact code length of
a text is a sum over its bytes.  The shortest code names the language.

Fitting (``fit``): the labelled texts are a sample of about ``docs_per_lang`` documents per language
(a documented bound; all, where there are fewer), taken by a hash of the document id, whose
n-gram counts are summed by Spark.  At most ``max_contexts`` contexts of the highest order,
the most frequent, are kept; the others fall back to the next shorter order, as if never seen
(that bounds the table at max_contexts x byte classes x languages x 4 bytes).
Bytes not in the sample share one class.

Whether a text fits a language (``judge``): rows are parted in halves by a hash of the id, and all
labelled rows of each half teach a model for the other one, so no text, garble neither, is judged by
what it taught.  Spark sums and prunes their n-gram counts; what is left of them is bounded by contexts and bytes.  Runs of anything but letters count as one space there: marks, digits and numbers
tell nothing of a language.  From the bits per byte of all labelled rows of the other half under the best language
(in steps of 1/10,000) comes a limit for each language, the greater of 2.5 medians and the upper quartile plus
8 times its distance from the median.  A text fits if its code is not more than 512 bits longer
than that limit allows (some 25 to 60 unknown bytes), so a key, a number or a name in a short text is no
garble.  A language with fewer than 20 such rows has the limit of all rows together; with fewer than 20 in all, nothing is over a limit.

Texts are folded with ``str.lower`` before they are coded, and coding starts after a run of
line ends.  Long texts are coded in slices that overlap by one context, never cut short.

Defined results: a null text, or one without a letter, is ``und`` with score 0 (also if no
language could be learned); ties go to the language that sorts first; the score is the
posterior of the chosen language under equal priors; rows with a null label teach nothing;
repeated rows are coded alike; ``bits`` is null where nothing is coded; a null text, or one
without a letter, fits no language; if no language could be learned every text fits; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.llm.common import in_runs
from ticksmith.session import staged

ORDER = 3
_LETTER = regex.compile(r"\p{L}")
_START = b"\n" * ORDER
UNKNOWN = "und"
_LEAST_ROWS = 20  # that a limit is fitted on
_SPARE_BITS = 512.0  # over the limit that any text may cost


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _grams(data: np.ndarray) -> np.ndarray:
    """The code of the ORDER + 1 bytes that end at each position of a text (its run of line ends first)."""
    data = data.astype(np.uint32)
    return (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n): how often each run of ORDER + 1 bytes occurs in the texts of each language."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            frame = part.to_pandas()
            for lang, texts in frame.groupby("lang", sort=True)["text"]:
                held: list[bytes] = []
                for text in [*texts, None]:
                    if text is not None:
                        held.append(_START + folded(text))
                    if held and (text is None or sum(map(len, held)) > 4 << 20):
                        grams = [_grams(np.frombuffer(h, np.uint8)) for h in held]
                        codes, n = np.unique(np.concatenate(grams), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)),
                             pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])
                        held = []

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    return rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _shares(docs: DataFrame, lang_col: str) -> list:
    """(language, rows), one row per language label."""
    share = docs.filter(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()
    # more labels than this are not languages
    if len(share) > 1000:
        raise ValueError(f"{len(share)} different language labels")
    return share


def sample(docs: DataFrame, id_col: str, lang_col: str, docs_per_lang: int) -> DataFrame:
    """About ``docs_per_lang`` rows of each language, all where there are fewer, by a hash of the id."""
    space = 1 << 20
    share = _shares(docs, lang_col)
    limits = F.create_map(*[F.lit(x) for r in share for x in (r[0], min(space, -(-space * docs_per_lang // r[1])))])
    if not share:
        return docs.limit(0)
    ticket = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("language sample")), F.lit(space))
    return docs.filter(F.col(lang_col).isNotNull() & (ticket < limits[F.col(lang_col)]))


@dataclass
class Model:
    langs: list[str]
    classes: np.ndarray  # byte -> class; class 0 for bytes not in the sample
    contexts: np.ndarray  # code of ORDER classes -> the longest kept context that serves it
    bits: np.ndarray  # (langs, contexts x classes)
    limits: dict[str, float] = field(default_factory=dict)  # language -> bits per byte that a text may cost

    def _slots(self, data: bytes) -> np.ndarray:
        """For each byte from the ORDER-th on, its place in a row of ``bits``."""
        k = int(self.classes.max()) + 1
        cls = self.classes[np.frombuffer(data, np.uint8)]
        return self.contexts[(cls[:-3] * k + cls[1:-2]) * k + cls[2:-1]] * k + cls[3:]

    def lengths(self, data: bytes, chunk: int = 1 << 20) -> np.ndarray:
        """The exact code length in bits of a folded text after its run of line ends, for each language."""
        total = np.zeros(len(self.langs))
        for at in range(0, len(data) - ORDER, chunk):
            slots = self._slots(data[at:at + chunk + ORDER])
            total += [row[slots].sum(dtype=np.float64) for row in self.bits]
        return total

    def _lengths_of_all(self, datas: list[bytes]) -> np.ndarray:
        """Code lengths of several texts at once; bytes whose context spans two texts do not count."""
        if len(datas) == 1:
            return self.lengths(datas[0])[None, :]
        sizes = np.array([len(d) for d in datas])
        ends = np.cumsum(sizes)
        # slot p codes byte p + ORDER: a text that starts at s and ends at e owns the slots s .. e - ORDER
        bounds = np.stack([ends - sizes, ends - ORDER], axis=1).ravel()[:-1]
        slots = self._slots(b"".join(datas))
        return np.stack([np.add.reduceat(row[slots], bounds, dtype=np.float64)[::2] for row in self.bits], axis=1)

    def predict(self, texts: list[str | None], limit: int = 1 << 20) -> list[tuple[str, float]]:
        """(language, score) of each text; texts are coded together up to ``limit`` bytes."""
        return [found[:2] for found in self.judge(texts, limit)]

    def judge(self, texts: list[str | None], limit: int = 1 << 20) -> list[tuple[str, float, float | None, bool]]:
        """(language, score, bits per byte, whether it fits) of each text."""
        out = [(UNKNOWN, 0.0, None, not self.langs)] * len(texts)
        if self.langs:
            some = ((i, _START + folded(t)) for i, t in enumerate(texts) if t is not None and _LETTER.search(t))
            for run in in_runs(some, lambda x: len(x[1]), limit):
                for (i, data), lengths in zip(run, self._lengths_of_all([d for _, d in run])):
                    best = int(np.argmin(lengths))
                    score = 1.0 / np.exp2(np.maximum(lengths[best] - lengths, -1000.0)).sum()
                    lang, n = self.langs[best], len(data) - ORDER
                    bits = float(lengths[best] / n)
                    out[i] = (lang, float(score), bits, bits <= self.limits.get(lang, np.inf) + _SPARE_BITS / n)
        return out


def _level(ctx: np.ndarray, row: np.ndarray, x, lang, n, base) -> np.ndarray:
    """Bits (contexts, classes, langs) of one order; ``base`` gives those of the next shorter contexts.

    ``row`` is the place in ``ctx`` of each counted gram.  Contexts are taken some at a time to bound memory.
    """
    order = np.argsort(row, kind="stable")
    row, x, lang, n = row[order], x[order], lang[order], n[order]
    out = []
    for at in range(0, len(ctx), 1000):
        under = base(np.arange(at, min(at + 1000, len(ctx))))
        lo, hi = np.searchsorted(row, [at, at + 1000])
        seen = np.zeros(under.shape)
        np.add.at(seen, (row[lo:hi] - at, x[lo:hi], lang[lo:hi]), n[lo:hi])
        total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            coded, escaped = -np.log2(seen / (total + kinds)), -np.log2(kinds / (total + kinds)) + under
        out.append(np.where(total == 0, under, np.where(seen > 0, coded, escaped)).astype(np.float32))
    return np.concatenate(out)


def pruned(counts: DataFrame, max_contexts: int) -> DataFrame:
    """(lang, gram, n) as ``build`` needs them of summed counts: runs of ORDER + 1 bytes whose context it keeps, the
    others added up without their first byte, which is then written -1."""
    context = F.shiftright("gram", 8).alias("context")
    kept = counts.groupBy(context).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "context").limit(max_contexts)
    marked = counts.select("*", context).join(kept.select("context", F.lit(True).alias("kept")), "context", "left")
    short = F.lit(-1 << 24) + F.col("gram").bitwiseAND(F.lit((1 << 24) - 1))
    return marked.select("lang", F.when(F.col("kept"), F.col("gram")).otherwise(short).alias("gram"), "n").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


def build(counts: pd.DataFrame, max_contexts: int) -> Model:
    """The model of a frame (lang, gram, n) of summed counts of runs of ORDER + 1 bytes, or of those ``pruned``."""
    langs = sorted(counts["lang"].unique())
    if not langs:
        return Model([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((0, 1), np.float32))
    lang = np.searchsorted(np.array(langs, object), counts["lang"].to_numpy(object))
    gram, n = counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    seen = np.union1d(gram & 255, [_START[0]])
    classes = np.zeros(256, np.int64)
    classes[seen] = np.arange(1, len(seen) + 1)
    k = len(seen) + 1
    a, b, c, x = (classes[(gram >> s) & 255] for s in (24, 16, 8, 0))
    code = (a * k + b) * k + c
    whole = gram >= 0
    # contexts of 0, 1 and 2 bytes, all that were seen, and the most frequent of 3
    often = pd.Series(n[whole]).groupby(code[whole]).sum().sort_index().sort_values(ascending=False, kind="stable")
    orders = [np.zeros(1, np.int64), np.unique(c), np.unique(b * k + c),
              np.sort(often.index.to_numpy(np.int64)[:max_contexts])]
    held = whole & np.isin(code, orders[3])
    levels: list[np.ndarray] = []
    for j, ctx in enumerate(orders):
        use = held if j == ORDER else np.ones(len(n), bool)
        row = np.searchsorted(ctx, code[use] % k**j)
        if j == 0:
            def base(at):
                return np.full((len(at), k, len(langs)), 8.0)
        else:
            under = np.searchsorted(orders[j - 1], ctx % k ** (j - 1))

            def base(at, above=levels[j - 1], under=under):
                return above[under[at]].astype(np.float64)
        levels.append(_level(ctx, row, x[use], lang[use], n[use], base))
    # the longest context kept for every code of three classes: each order overrules the shorter one
    contexts, first = np.zeros(1, np.int32), 0
    for j, ctx in enumerate(orders):
        contexts = np.tile(contexts, k) if j else contexts
        contexts[ctx] = first + np.arange(len(ctx), dtype=np.int32)
        first += len(ctx)
    bits = np.concatenate(levels).reshape(-1, len(langs)).T
    return Model(langs, classes, contexts, np.ascontiguousarray(bits))


def _half(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("halves")), F.lit(2))


def letters(text: Column) -> Column:
    """The text with all that is no letter as single spaces."""
    return F.regexp_replace(text, r"[^\p{L}\p{M}]+", " ")


def _limits(model: Model, rows: DataFrame, text_col: str) -> dict[str, float]:
    """The limit of each language from the bits per byte of rows that ``model`` has not seen."""
    coded = predict(rows.select(text_col), model, text_col=text_col).select("language.lang", F.round("language.bits", 4).alias("bits"))
    each = staged(coded.dropna().groupBy("lang", "bits").agg(F.count(F.lit(1)).alias("n")), "language", "bits")
    both = each.unionByName(each.groupBy("bits").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string")))
    # a language has at most as many different values as there are steps, whatever the number of rows
    upto = Window.partitionBy("lang").orderBy("bits")
    ranked = both.select(
        "lang", "bits", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy("lang")).alias("n"))
    at = [F.min(F.when(F.col("upto") >= F.col("n") * share, F.col("bits"))) for share in (0.5, 0.75)]
    marks = ranked.groupBy("lang").agg(F.array(*at).alias("q"), F.first("n").alias("n")).collect()
    found = {r.lang: max(2.5 * r.q[0], r.q[1] + 8 * (r.q[1] - r.q[0])) for r in marks if r.n >= _LEAST_ROWS}
    # the row without a language stands for all of them
    return {lang: found.get(lang, found[None]) for lang in model.langs} if None in found else {}


def fit(
    labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    docs_per_lang: int = 2000, max_contexts: int = 12000,
) -> Model:
    """Learn from a table with language labels; only text and label are looked at (the id draws the sample)."""
    rows = labelled.select(F.col(id_col), F.col(text_col), F.col(lang_col))
    chosen = sample(rows, id_col, lang_col, docs_per_lang)
    return build(gram_counts(chosen, text_col, lang_col).toPandas(), max_contexts)


def fit_halves(
    labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_contexts: int = 12000,
) -> list[Model]:
    """The models that judge the rows of each half, learned from all labelled rows of the other one, with their limits."""
    rows = labelled.select(F.col(id_col), F.col(text_col), F.col(lang_col)).filter(F.col(lang_col).isNotNull())
    _shares(rows, lang_col)
    rows = rows.withColumn("__half", _half(id_col)).withColumn(text_col, letters(F.col(text_col)))
    counts = staged(
        gram_counts(rows.withColumn(lang_col, F.concat(F.col("__half").cast("string"), lang_col)), text_col, lang_col).select(
            F.substring("lang", 1, 1).alias("half"), F.expr("substring(lang, 2)").alias("lang"), "gram", "n"), "language", "grams")

    def model_of(part: DataFrame) -> Model:
        return build(pruned(part.select("lang", "gram", "n"), max_contexts).toPandas(), max_contexts)

    models = [model_of(counts.filter(F.col("half") == other)) for other in "10"]
    if not all(m.langs for m in models):  # one of them has learned nothing: no limits
        return [next((m for m in models if m.langs), models[0])] * 2
    for h, model in enumerate(models):
        model.limits = _limits(model, rows.filter(F.col("__half") == h), text_col)
    return models


def _judged(docs: DataFrame, models: list[Model], which: Column, text: Column, result_col: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = held.value
        for texts, chosen in parts:
            found, texts, chosen = [None] * len(texts), texts.to_pylist(), chosen.to_pylist()
            for w, model in enumerate(own):
                at = [i for i, c in enumerate(chosen) if c == w]
                for i, judged in zip(at, model.judge([texts[i] for i in at])):
                    found[i] = judged
            langs, scores, bits, fits = zip(*found) if found else ((), (), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64()), pa.array(map(bool, fits), pa.bool_())],
                names=["lang", "score", "bits", "fits"])

    run.__annotations__ = {"parts": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    code: Column = F.arrow_udf(run, "lang string, score double, bits double, fits boolean").asNondeterministic()(text, which)
    return docs.withColumn(result_col, code)


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", result_col: str = "language") -> DataFrame:
    """``docs`` with a struct column ``result_col`` of lang, score (0 to 1), bits (per byte) and fits."""
    return _judged(docs, [model], F.lit(0).cast("bigint"), F.col(text_col), result_col)


def judge(
    docs: DataFrame, models: list[Model], *, id_col: str = "doc_id", text_col: str = "text", result_col: str = "language",
) -> DataFrame:
    """As ``predict``, by the models of ``fit_halves``, each row by that of its half."""
    return _judged(docs, models, _half(id_col), letters(F.col(text_col)), result_col)
