import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticksmith.llm import tokencount
from ticksmith.llm.queries import op12_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    whole = Tokenizer.from_file(PATH)
    return lambda text: len(whole.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_count_of_its_own_encoding(library):
    rng = random.Random(5)
    pieces = ["a", "B", "é", "é", " ", "  ", "\n", "\n\n", "\t", " ", "\x1c", "\x85", " ", "'s", "'re", "'ve", "'ll", "'", "1", "23",
              "!", "!!", "😀", "Σ", "ß", "ﬁ", "<|endoftext|>", "<|endof", "|>", "the", " the", "ing", "‍", "각", "日本", "\r\n", "x" * 70,
              "=" * 40, " " * 20, "don't", "they're", "½", "²", "ऀ", "\U0001e6c0"]
    for memo in (3, 1 << 18):
        counter = tokencount.Counter(PATH, memo)
        for _ in range(400):
            text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
            assert counter.at_prefixes(text).tolist() == [library(text[:k]) for k in range(len(text) + 1)], repr(text)


def test_plain_texts_are_split_as_the_library_does():
    """Each plain character among letters, numbers, marks and white space, and steps that are forgotten all the time."""
    counter, one = tokencount.Counter(PATH), tokencount.Counter(PATH, 1)
    plain = [c for c in map(chr, range(0x10000)) if counter.plain(c)]
    assert len(plain) > 30_000
    for k in range(0, len(plain), 100):
        text = "".join(f"a{c}b {c} 1{c}1{c}{c}\n {c}  !{c}'{c}" for c in plain[k:k + 100])
        assert counter.split(text) == [text[a:b] for _, (a, b) in counter.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    assert one.at_prefixes("the others' theory 12 été").tolist() == counter.at_prefixes("the others' theory 12 été").tolist()


def test_long_runs_are_counted_whole(library):
    counter = tokencount.Counter(PATH)
    for text in ("a" * 200_000, " " * 100_000 + "x", "ab" * 100_000, "0123456789abcdef" * 20_000, "日本語" * 30_000):
        assert counter.at_prefixes(text)[-1] == library(text)


def test_another_kind_of_vocabulary_is_refused():
    with pytest.raises(ValueError):
        tokencount.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_nulls_repeats_empty_tables_and_other_columns(spark, library):
    rows = [(1, None, "k"), (2, "", None), (None, "two words", "k"), (3, "they're <|endoftext|>", "k"), (3, "they're <|endoftext|>", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, prefixes string")
    found = tokencount.count_prefixes(docs, PATH, budgets=[0, 1, 3])
    assert found.columns == ["doc_id", "text", "prefixes", "tokens"]
    got = found.select(*found.columns, tokencount.tokens_of(F.col("tokens")).alias("n"), tokencount.tokens_of_head(F.col("tokens"), 4).alias("head"),
                       tokencount.cut_to(F.col("text"), F.col("tokens"), 1).alias("cut")).collect()
    assert sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, rows))
    for r in got:
        text = r.text or ""
        want = [library(text[:k]) for k in range(len(text) + 1)]
        assert r.tokens.prefixes == want and r.n == want[-1] and r.tokens.n_bytes == len(text.encode())
        assert r.tokens.longest == [max(k for k, n in enumerate(want) if n <= b) for b in (0, 1, 3)]
        assert r.head == want[min(4, len(text))] and (r.cut or "") == text[:r.tokens.longest[1]]
    assert tokencount.count_prefixes(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        tokencount.count_prefixes(docs, PATH, result_col="prefixes")


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = op12_token_counts(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    for r in got:
        n = library(docs[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(docs[r.doc_id].encode()), n > 512)
        assert library(docs[r.doc_id][:r.chars_in_limit]) <= 512
        assert r.over_limit or r.chars_in_limit == len(docs[r.doc_id])
