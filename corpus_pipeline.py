"""A training corpus from raw documents: five stages, each one operator of ``strata.llm``.

1. quality classifier: documents scored below the threshold go
2. MinHash near-dedup: one document of each class of near duplicates stays
3. substring dedup: words in 20-word windows that also start earlier are cut out;
   a document that loses words has the others joined by one space, every other
   document keeps its text as it was
4. mixing: sources taken to their targets, documents repeated up to twice
5. BPE: every text encoded to token ids, and decoded again

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.  NULL, empty and
repeated rows, empty tables and extra columns are handled as each
operator's module states; a document that loses all its words stays, with an
empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, minhash, mixing, quality, substring
from strata.llm.common import held_out, ship, stored

TOKENIZER = "word_bpe_49k.json"

#: No SQL: the first stage scores with a trained network.
ORACLE_SQL = None


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").where(~held_out())
    return quality.keep_good(docs, quality.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    place = {c: f"d{i}" for i, c in enumerate(docs.columns)}  # free of the names the operator adds
    cut = substring.remove_repeats(docs.select(*[F.col(f"`{c}`").alias(d) for c, d in place.items()]), id_col=place["doc_id"], text_col=place["text"])
    lost = F.col("n_removed") > 0
    changed = {"text": F.when(lost, F.col("kept")).otherwise(F.col(place["text"]))}
    if "n_chars" in place:
        changed["n_chars"] = F.when(lost, F.length("kept").cast("long")).otherwise(F.col(place["n_chars"]))
    return cut.select(*[changed.get(c, F.col(d)).alias(c) for c, d in place.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): ids as little-endian unsigned 32-bit integers."""
    ship(spark)
    out = bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), keep=["doc_id"])
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_good_quality),
    ("minhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing to target weights", mix_sources),
    ("bpe encoding and decoding", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {}
