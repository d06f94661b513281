"""The registered queries of the operators, and SQL with the same results where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.alignment import align_documents
from tablesync.llm.common import table
from tablesync.llm.exact_dedup import exact_duplicates
from tablesync.llm.hard_negatives import hard_negatives, labelled_vectors
from tablesync.llm.langid import predict_languages
from tablesync.llm.licenses import scan_licenses
from tablesync.llm.line_dedup import drop_shared_lines
from tablesync.llm.metric_tree import integer_vectors, top_k
from tablesync.llm.minhash import near_duplicates
from tablesync.llm.mixing import REST, SEED, SOURCE_WEIGHTS, mix_sources
from tablesync.llm.packing import pack_documents
from tablesync.llm.sharding import kd_shards
from tablesync.llm.surrogates import replace_personal_data
from tablesync.llm.suffix_tree import score_texts

SHARDS = 40


def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents repeated to the weights: one row for each copy."""
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "source", "copy", "n_copies", F.round("repeat_rate", 9).alias("repeat_rate"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    )


def op5_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_duplicates(docs, carry=[]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_metric_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op8_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, words=2, percent=80).drop("text_key")


def op9_marginal_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict_languages(docs, carry=["doc_id"])


def op10_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(table(spark, sf_dir, "embeddings"), moved)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_tree_scores": op1_suffix_tree_scores,
    "op2_surrogates": op2_surrogates,
    "op3_license_scan": op3_license_scan,
    "op4_poisson_mix": op4_poisson_mix,
    "op5_chunk_recipes": op5_chunk_recipes,
    "op6_kd_tree_shards": op6_kd_tree_shards,
    "op7_metric_tree_search": op7_metric_tree_search,
    "op8_super_minhash": op8_super_minhash,
    "op9_marginal_language_id": op9_marginal_language_id,
    "op10_residual_packing": op10_residual_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_line_dedup": op12_line_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

_WEIGHTS_SQL = ", ".join(f"('{s}', {w!r}::double)" for s, w in SOURCE_WEIGHTS.items())

ORACLE: dict[str, str] = {
    "op4_poisson_mix": f"""
with weights(pool, weight) as (values {_WEIGHTS_SQL}, ('', {REST!r}::double)),
pooled as (
    select *, case when source in (select pool from weights where pool <> '') then source else '' end as pool,
        octet_length(encode(coalesce(text, ''))) + 1 as size
    from documents),
sizes as (select pool, sum(size)::double as size from pooled group by pool),
live as (select pool, weight, size from weights join sizes using (pool)),
rates as (
    select pool, weight / (select sum(weight) from live) * (select sum(size) from live) / size as rate from live),
terms as (
    select pool, rate, k::bigint as k, exp(k * ln(rate) - rate - lgamma(k + 1)) as term
    from rates, range(200) t(k)),
steps as (select pool, rate, k, sum(term) over (partition by pool order by k) as p from terms),
drawn as (
    select d.doc_id, d.source, d.pool, md5(coalesce(d.text, '')) as text_md5,
        (('0x' || substr(md5(concat_ws(chr(1), '{SEED}', coalesce(doc_id::varchar, chr(0)), coalesce(source, chr(0)),
            md5(coalesce(text, '')))), 1, 13))::bigint + 0.5) / 4503599627370496.0 as u
    from pooled d),
counted as (
    select doc_id, d.source, text_md5, s.rate as repeat_rate, count(*) filter (where s.p < d.u) as n
    from drawn d join steps s using (pool) group by all)
select doc_id, source, unnest(range(n))::integer as copy, n::integer as n_copies, round(repeat_rate, 9) as repeat_rate, text_md5
from counted where n > 0""",
    "op5_chunk_recipes": """
with norm as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
    from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from norm window same as (partition by norm)""",
    "op7_metric_tree_search": """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, v.vec_id, list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2]))::bigint as score
    from vectors q join vectors v on q.vec_id % 50 = 0 and v.vec_id <> q.vec_id)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score
from scored qualify rank <= 5""",
    "op12_line_dedup": """
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from split),
keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines),
shared as (
    select key, max(doc_id) as best from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5)
select doc_id, count(*) as n_lines, count(*) filter (where best <> doc_id) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where best is null or best = doc_id), '')) as kept_sha256
from keyed left join shared using (key) group by doc_id""",
    "op13_hard_negatives": """
with vectors as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, v.vec_id, v.label = a.label as alike,
        list_sum(list_transform(list_zip(a.x, v.x), lambda p: p[1] * p[2]))::bigint as score
    from vectors a join vectors v on a.vec_id % 100 = 0 and v.vec_id <> a.vec_id),
positives as (
    select * from scored where alike
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
matched as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
        (row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id))::integer as rank
    from positives p join scored n on n.anchor_id = p.anchor_id and not n.alike
        and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from matched where rank <= 5""",
}
