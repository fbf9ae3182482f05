"""Token counts against the library on odd and random texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", "\n", " \n ", "a", " a", "a ", "  a  b  ", "a\nb", "a \nb", "a\n b", "a\n\nb", "it's  I'm 'tis ''s", "<|endoftext|>",
    " <|endoftext|> <|endoftext|>x", "a<|endoftext|>\n b <|endoftext", "中文 字符 12345 ١٢٣", "\xa0a \xa0 b\x1c c\x85 d", "🙂🙂 emoji!! 👩‍👩‍👧", "x" * 5000,
    "é" * 3000 + " " * 300 + "q", "՘ ꟋᲉ \U00010d50 ok", "\t\t tab\t", "a\u0000b ​ c", " wide  space",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def agree(spark, library, texts, **options):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in tokens.count_tokens(d, PATH, **options).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].n_tokens == len(library.encode(t or "", add_special_tokens=False).ids), repr(t)[:80]
        assert got[i].n_bytes == len((t or "").encode())


def test_odd_texts_any_table(spark, library):
    agree(spark, library, ODD)
    agree(spark, library, ODD * 3, summary=5, size=3)


def test_random_texts(spark, library):
    rng = random.Random(9)
    parts = ["the", "The", "ing", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "é", "7", "中", "\xa0", "\x1c", "\x85", "<|endoftext|>", "<|", "　", "xq"]
    agree(spark, library, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(1500)])


def test_documents_and_extra_columns(spark, library):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("N_tokens", F.lit("mine"))
    out = tokens.count_tokens(d, PATH)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_bytes", "n_tokens"]
    for r in out.collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert tokens.count_tokens(d.limit(0), PATH).count() == 0


def test_frequent_pretokens_are_found(spark):
    d = spark.createDataFrame([(" ".join(["hot"] * 50 + [f"w{i}x{j}" for j in range(20)]),) for i in range(60)], "text string")
    top = tokens.frequent_pretokens(d, PATH, summary=20, size=1).collect()
    assert top[0].pretoken == " hot"
