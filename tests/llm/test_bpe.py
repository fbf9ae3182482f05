"""The automaton, and encoding and decoding against the library on odd texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t", "Hello, World's  best\x0btest", "<|endoftext|>", "a<|startoftext|>b<|endoftext|>c <|endoftext", "naïve ÉCOLE Straße ΣΑΣ İstanbul",
    "é café ́start", "中文字符 日本語 12345", "x\x1cy\x1dz \x85 \xa0q w", "🙂🙂 emoji!!", "can't WON'T they've I'm", "a" * 5000, "ab" * 3000 + "é" * 40,
    "՘ ꟋᲉ \U00010d50", "0" * 300, "!" * 200, "﻿bom ​ zero", "a\u0000b", "ﬁ ½ ²", "_under_score_ 1st 2nd",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def agree(spark, library, texts, size=500):
    d = rows(spark, texts)
    got = {r.doc_id: r for r in bpe.encode(d, PATH, bpe.fit_lexicon(d, PATH, size=size), decode=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids, repr(t)[:80]
        assert got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_odd_texts(spark, library):
    agree(spark, library, ODD)


def test_random_texts(spark, library):
    rng = random.Random(5)
    parts = ["the", "The", "ing", " ", "  ", "\n", ".", ",", "'s", "é", "ß", "Σ", "<|", "|>", "7", "中", "́", "ed", "xq", "-", "<|endoftext|>", "Ᲊ", "\x1f"]
    agree(spark, library, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(600)])


def test_documents_against_the_library(spark, library):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    for r in bpe.round_trip(d, PATH).select("doc_id", "lang", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("sha")).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == np.array(ids, "<u4").tobytes()
        assert r.sha == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_automaton_is_minimal_and_numbers_words():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode() for _ in range(700)} | {"é".encode()})
    outputs = [[i, i + 1][: 1 + i % 2] for i in range(len(words))]
    flat = bpe.compile_words(words, outputs)
    lex = bpe.Lexicon(flat)
    assert lex.numbers(words).tolist() == list(range(len(words)))
    assert lex.look_up(words) == [np.array(o, "<u4").tobytes() for o in outputs]
    others = [w for w in (b"", b"x", b"ab" * 40, b"cccccccc", b"aaab\x00") if w not in words]
    assert set(lex.numbers(others).tolist()) == {-1}
    # minimal: as many states as there are different sets of endings
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(lex.finals) == len(endings)


def test_automaton_of_nothing():
    lex = bpe.Lexicon(bpe.compile_words([], []))
    assert lex.look_up([b"a", b""]) == [None, None]


def test_extra_columns_empty_table_and_decode(spark, library):
    d = rows(spark, ["a b", None]).withColumn("ids", F.lit("mine")).withColumn("n", F.array(F.lit(1), F.lit(2)))
    out = bpe.round_trip(d, PATH)
    assert out.columns == ["doc_id", "text", "n", "ids", "n_tokens", "decoded"]
    assert {tuple(r.n) for r in out.collect()} == {(1, 2)}
    assert bpe.round_trip(d.limit(0), PATH).count() == 0
    again = bpe.decode(out.drop("decoded"), PATH).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in out.collect())
