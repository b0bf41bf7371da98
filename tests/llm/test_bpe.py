import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from simtrail.llm import bpe, packing
from simtrail.llm.queries import TOKENIZER, op5_bpe, op10_packing

ODD = [
    "", " ", None, "Hello World's 123 ñ É  x<|endoftext|>y !!!", "á İ   b\tc\n\n", "it's we'LL 'x ' 'tis 're",
    "日本語 テスト", "x\x00y ﻿ z", "<|startoftext|> q<|endoftext|>", "!! The&amp;", "½ ² ① ٣", "_foo__bar_", "a b\x1cc\x1fd",
    "ǅ ﬁ ß ẞ Σς ΑΣ ΟΔΟΣ", "été ̀ ä", "<|endoftext", "\u0085x　y", "👩‍👩‍👧 🇩🇪 done", "aaaaaaaaaaaaaaaaaaaa", "of " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def coder():
    with open(TOKENIZER, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def test_odd_texts_as_the_library(coder, library):
    for text, got in zip(ODD, coder.encode(ODD), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_random_words_as_the_library(coder, library):
    rng = random.Random(5)
    stock = ["th", "er", "ing", "an", "é", "ß", "tion", "!!", "$$$", "x", "q", "zz", "ou", "1", "'s", "’", "ñ", "ll", "-", "日"]
    texts = [" ".join("".join(rng.choices(stock, k=rng.randint(1, 9))) for _ in range(40)) for _ in range(200)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 1000), rng.randint(0x3040, 0x30FF)])) for _ in range(200)) for _ in range(100)]
    for text, got in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert 0 < coder.merged_words  # some guesses fail and are merged exactly


def test_query_against_the_library(spark, sf, library):
    rows = op5_bpe(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_frames_with_nulls_clashing_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 7, "k"), (1, "a b", 8, None)], "doc_id long, text string, n_tokens int, keep string")
    out = bpe.encode(df, TOKENIZER).orderBy("keep")
    assert out.columns == ["doc_id", "text", "keep", "token_ids", "n_tokens"]
    assert [r.n_tokens for r in out.collect()] == [2, 0]
    assert [r.decoded for r in bpe.decode(out, TOKENIZER).collect()] == ["a</w> b</w>", ""]
    assert bpe.encode(df.limit(0), TOKENIZER, decoded_col="d").count() == 0
    assert packing.pack(df.limit(0), TOKENIZER).count() == 0


def check_packing(rows, docs, library):
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # full or a power of two
    assert set(pieces) == set(docs)
    for key, text in docs.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_query(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_packing(op10_packing(spark, sf).collect(), docs, library)


def test_packing_equal_lengths_long_and_empty_texts(spark, library):
    docs = {i: "of " * 1499 for i in range(40)} | {100: None, 101: "", 102: "of " * 10_000, 103: "of " * 2047}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").coalesce(1)
    from simtrail.llm.queries import packed_digest

    rows = packed_digest(packing.pack(df, TOKENIZER)).collect()
    check_packing(rows, docs, library)


def test_closest_subset_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(4)}
        room = rng.randint(0, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        got = packing.closest_subset(counts, room)
        assert sum(k * v for k, v in got.items()) == max(s for s in sums if s <= room)
        assert all(v <= counts[k] for k, v in got.items())


def test_merging_many_words_at_once_equals_merging_each(coder):
    rng, alphabet = np.random.default_rng(3), bpe.byte_alphabet()
    common = "etaoinshr"
    words = ["", "a", "中", "the", "aaaaaaaaaaaaaaaaa", "th中e"]
    words += ["".join(rng.choice(list(common), rng.integers(1, 14))) for _ in range(1500)]
    words += ["".join(rng.choice(alphabet, rng.integers(1, 9))) for _ in range(300)] + ["ab" * 700]
    ends = rng.random(len(words)) < 0.7
    ids, begin = coder.merge_all(words, ends)
    got = [ids[a:b].tolist() for a, b in zip(begin, begin[1:], strict=False)]
    assert got == [coder.merge(w, bool(e)) for w, e in zip(words, ends, strict=True)]
    ids, begin = coder.merge_all([], np.zeros(0, bool))
    assert ids.size == 0 and begin.tolist() == [0]


def test_older_words_are_asked_for_one_by_one():
    """What is asked for moves to the younger half, without a walk through the older one."""

    class Asked(dict):
        def __iter__(self):
            raise AssertionError("walked through")

        keys = items = values = __iter__

    memory = bpe.Memory()
    assert memory.missing({"a"}) == {"a"}
    memory.old = Asked(a=b"1", b=b"2")
    memory.now = {"d": b"4"}
    assert memory.missing({"a", "c"}) == {"c"}
    assert memory.now == {"d": b"4", "a": b"1"}


def test_words_with_marks_behind(coder, library):
    texts = ['Word. word, word); "word" word.) wo.rd... wórd. \x01x. don\'t. \'s. 9. a1! !a .', "a.b.", "?!", "x" * 40 + ":\x1c;y.", None]
    got = coder.encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
