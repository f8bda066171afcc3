import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ticksmith.llm import packing
from ticksmith.llm.queries import op4_pack


def test_best_fill_is_the_best():
    rng = random.Random(1)
    for _ in range(300):
        items = [rng.randint(1, 30) for _ in range(rng.randint(0, 10))]
        room = rng.randint(0, 60)
        sums = {0}
        for i in items:
            sums |= {s + i for s in sums}
        got = packing.best_fill(Counter(items), room)
        assert all(n <= items.count(x) for x, n in got.items())
        assert sum(x * n for x, n in got.items()) == max(s for s in sums if s <= room)


def check(rows, want, capacity, little):
    """rows: (doc, start, length, crc, total, sequence, offset); want: list of (doc, ids). Returns the padding."""
    byseq, bydoc = {}, {}
    for doc, start, length, crc, total, seq, offset in rows:
        byseq.setdefault(seq, []).append((offset, length))
        bydoc.setdefault(doc, []).append((start, length, crc, total))
    fill = []
    for pieces in byseq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        fill.append(at)
    for doc, ids in want:
        at = 0
        for start, length, crc, total in sorted(bydoc.pop(doc)):
            assert start == at and total == len(ids)
            assert crc == zlib.crc32(np.array(ids[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    assert not bydoc
    padding = sum(capacity - f for f in fill if f & (f - 1))
    assert padding <= little * max(1, sum(fill))


def test_packer_keeps_every_id_once():
    rng = random.Random(2)
    for n, pool in ((0, 100), (1, 100), (400, 900), (400, 10**9)):
        docs = [(i, np.arange(rng.choice([1, 2, rng.randint(1, 63), rng.randint(1, 400)])) % 997) for i in range(n)]
        packer = packing.Packer(0, 64, pool)
        out = [r for d, ids in docs for r in packer.add(d, ids)] + list(packer.finish())
        rows = [(p[0], p[1], len(p[2]), zlib.crc32(p[2].astype("<u4").tobytes()), p[3], s, o) for p, s, o in out]
        check(rows, [(d, ids.tolist()) for d, ids in docs], 64, 0.02)


def _ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_words_give_the_ids_of_the_whole_text():
    rng = random.Random(8)
    path = public_tokenizers.path("word_bpe_49k.json")
    for memo in (4, 1 << 18):
        encode = packing._encoder(path, 2, memo)
        chars = ["a", "B", "é", "e\u0301", "\u0301", " ", "\n", "\t", "\u00a0", "\x1c", "\u2003", "'s", "'", "1", "!", "😀", "Σ", "ß", "ﬁ", "</w>",
                 "<|endoftext|>", "the", "\u200d", "İ", "각", "\u1100", "\u1161", "\r\n", "\x85", "x" * 300]
        texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
        assert [encode(t).tolist() for t in texts] == _ids(texts)


def test_nulls_long_special_and_empty(spark):
    texts = [None, "", "<|endoftext|> é 😀", "word " * 30000, "a"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int")
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    rows = [(r.doc_id, r.start, r.length, zlib.crc32(np.array(r.ids, "<u4").tobytes()), r.doc_tokens, r.sequence_id, r.offset) for r in found.collect()]
    check(rows, list(enumerate(_ids(texts))), 4096, 0)
    assert packing.pack(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [tuple(r)[:7] for r in op4_pack(spark, sf).collect()]
    check(rows, list(zip([d.doc_id for d in docs], _ids([d.text for d in docs]))), 4096, 0.01)


def test_remembered_words_give_the_ids_of_the_whole_text():
    rng = random.Random(3)
    pieces = ["Ünd", "straße", "ÉTÉ", "don't", "it's.", "x", "Привет,", "Ёлка!", "ét", "J̌", "İs", "ΟΔΟΣ", "a1b22", "½", "::", "?!...", "'s", "",
              "<|endoftext|>", "日本語", "tab\tword", " ", "\r\n", "naïve;", "ﬁn", "Å", "×÷", "end.'s", "a.b", "\U0001f600", "ªº", "́", "ǅ"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        whole = Tokenizer.from_file(path)
        encode = packing._encoder(path, 2)
        for _ in range(400):
            text = "".join(rng.choice(pieces) + rng.choice([" ", "\n", "  ", ""]) for _ in range(rng.randint(0, 12)))
            assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_control_strings_in_texts_are_single_tokens():
    encode = packing._encoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    assert encode("a <|endoftext|> b").tolist() == [320, 49407, 321, 2]
    assert encode("x<|startoftext|>y").tolist() == _ids(["x<|startoftext|>y"])[0]
