"""Queries of the training-data operators, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from radspark.llm import gam, html_blocks, langid, licenses, minhash, mixing, packing, pii, tiff, vectors
from radspark.llm.common import small_batches


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_media(_read(spark, sf_dir, "documents"))


def op2_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return gam.score(docs, gam.learn(docs, _read(spark, sf_dir, "labels")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op4_graph_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op5_ipf_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weigh(_read(spark, sf_dir, "documents"))


def op7_lstm_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_read(spark, sf_dir, "pages"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(_read(spark, sf_dir, "documents"))


def op10_backoff_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op9_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), _tokenizer())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tiff_pages": op1_tiff_pages,
    "op2_gam_quality": op2_gam_quality,
    "op3_license_scan": op3_license_scan,
    "op4_graph_neardup": op4_graph_neardup,
    "op5_ipf_mixing": op5_ipf_mixing,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_lstm_main_text": op7_lstm_main_text,
    "op8_weak_pii": op8_weak_pii,
    "op9_ffd_packing": op9_ffd_packing,
    "op10_backoff_langid": op10_backoff_langid,
}

#: Components: pairs of nodes that reach one another, from symmetric links (a, b).
_REACH = "r as (select a n, a c from l union select r.n, l.b from r join l on r.c = l.a), k as (select n, min(c) c from r group by 1)"

OP4_SQL = f"""with recursive v as (select vec_id, label, embedding::double[] e from embeddings where label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
and list_max(list_transform(embedding, lambda x: abs(x))) > 0),
l as (select x.vec_id a, y.vec_id b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.93::double), {_REACH}
select vec_id, coalesce(n, 0)::bigint n_links, coalesce(c, vec_id) component_id, coalesce(c, vec_id) = vec_id kept, 1.0::double audit_recall
from embeddings left join (select a vec_id, count(*) n from l group by 1) using (vec_id) left join (select n vec_id, c from k) using (vec_id)"""

OP6_SQL = f"""with recursive w as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
s as materialized (select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i : i + 4], ' '))) g from w where len(w) > 0),
n as (select doc_id, count(*) n from s group by 1),
p as (select x.doc_id a, y.doc_id b, count(*) m from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
l as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * m >= 75 * (x.n + y.n - m)), {_REACH}
select doc_id, coalesce(n.n, 0)::bigint n_shingles, coalesce(c, doc_id) component_id, coalesce(c, doc_id) = doc_id kept
from documents left join n using (doc_id) left join (select n doc_id, c from k) using (doc_id)"""

ORACLE_SQL: dict[str, str] = {"op4_graph_neardup": OP4_SQL, "op5_ipf_mixing": mixing.oracle_sql(), "op6_minhash_dedup": OP6_SQL}
