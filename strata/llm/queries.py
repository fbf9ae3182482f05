"""The registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from strata.llm import alignment, bpe, importance, langid, mainhtml, minhash, mixing, quality, rules, substring, tokens, topk, toxicity
from strata.llm.common import held_out, ship


def _table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix_sources(spark, sf_dir):
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_bpe_round_trip(spark, sf_dir):
    out = bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_quality_rules(spark, sf_dir):
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    out = rules.apply_rules(_table(spark, sf_dir, "documents"), good, keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op4_substring_dedup(spark, sf_dir):
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_exact_top_k(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op6_near_duplicates(spark, sf_dir):
    out = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), F.col("class").alias("class_id"))


def op7_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    weights = quality.learn(docs, _table(spark, sf_dir, "labels").where(~held_out()))
    return quality.score(docs, weights, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~held_out()))
    return langid.predict(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_token_counts(spark, sf_dir):
    out = tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op11_html_extraction(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return mainhtml.extract(pages, mainhtml.learn(pages), keep=["page_id", "url"])


def op12_tokenizer_alignment(spark, sf_dir):
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_corpus(_table(spark, sf_dir, "documents"), a, b)


def op13_importance_resampling(spark, sf_dir):
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.rows.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source IS NULL AS snull, coalesce(source, '') AS sname,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('{mixing.SEED}' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
n AS (SELECT greatest({mixing.SALTS}, count(*) // {mixing.DOCS_PER_SALT}) AS salts FROM documents),
e AS (SELECT d.*, length(bin(size)) AS cls, ('0x' || substr(h, 1, 8))::BIGINT % n.salts AS salt FROM d, n),
s AS (SELECT snull, sname, sum(size)::BIGINT AS source_size FROM e GROUP BY ALL),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY snull, encode(sname)) - 1) % 3 + 1)::INT]::DOUBLE AS w,
             (2 * source_size)::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE * 1.5 AS total FROM s),
r AS (SELECT *, cap / w AS ratio FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS lvl FROM r
      WINDOW b AS (ORDER BY ratio, snull, encode(sname) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap, coalesce((SELECT lvl FROM l WHERE lvl <= ratio ORDER BY ratio, lvl LIMIT 1) * w, cap)) AS target FROM l),
p AS (SELECT e.doc_id, e.size, t.source_size, t.target,
             row_number() OVER (PARTITION BY e.snull, e.sname ORDER BY e.cls, e.salt, e.size, e.h) AS pos,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('{mixing.SEED}' || e.snull::VARCHAR || '|' || e.sname), 1, 4))::BIGINT / 65536.0::DOUBLE AS u
      FROM e JOIN t USING (snull, sname))
SELECT doc_id, size, source_size, target, ((floor(pos * rate + u) - floor((pos - 1) * rate + u)) * size)::BIGINT AS taken FROM p
"""


OP4_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - {substring.K - 2})) AS pos FROM d WHERE len(w) >= {substring.K}),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(list_slice(w, pos, pos + {substring.K - 1}), ' ') ORDER BY doc_id, pos) AS turn FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {substring.K})) AS pos FROM f WHERE turn > 1),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
k AS (SELECT t.doc_id, count(*) AS kept, string_agg(word, ' ' ORDER BY t.pos) AS text
      FROM t ANTI JOIN g ON t.doc_id = g.doc_id AND t.pos = g.pos GROUP BY t.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def queries():
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}

    def shipped(f):
        def run(spark, sf_dir):
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {k: shipped(f) for k, f in sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0]))}


def oracle_sql():
    return {"op1_mix_sources": OP1_SQL, "op4_substring_dedup": OP4_SQL, "op5_exact_top_k": OP5_SQL}
