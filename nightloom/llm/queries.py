"""The opN_ queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decision_lists,
    decontamination,
    exact_dedup,
    hard_negatives,
    html_extraction,
    jaccard_join,
    license_scan,
    line_dedup,
    packing,
    paragraph_dedup,
    sharding,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_bytes")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), ids=False).drop("ids")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).select("doc_id", "held_out", "score", "predicted", "raw_score")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(table(spark, sf_dir, "pages")).drop("host")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_groups(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeats(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decision_lists.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *base, "base_failed", "kept", "rule")


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", turned), F.col("vec_id") % 50 == 0)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_toxicity, op3_exact_dedup, op4_ngram_jaccard_join, op5_sharding, op6_packing, op7_benchmark_decontamination, op8_license_scan, op9_html_extraction, op10_paragraph_dedup, op11_quality_rules, op12_hard_negative_mining, op13_embedding_whitening)}

ORACLE_SQL = {
    "op3_exact_dedup": """
        with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as x from documents)
        select doc_id, min(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size,
               doc_id = min(doc_id) over (partition by x) as kept, sha256(x) as text_sha256
        from t""",
    "op4_ngram_jaccard_join": """
        with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
        s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w),
        n as (select doc_id, count(*) as n from s group by 1),
        c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
        l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
        e as (select a, b from l union all select b, a from l),
        r(doc_id, reached) as (select doc_id, doc_id from documents union select r.doc_id, e.b from r join e on r.reached = e.a)
        select r.doc_id, coalesce(max(n), 0) as n_shingles, min(reached) as component_id from r left join n on n.doc_id = r.doc_id group by 1""",
    "op12_hard_negative_mining": """
        with u as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda c: floor(256 * c::double)) as x
                   from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
        s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_dot_product(a.x, b.x)::bigint as score
              from u a join u b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
        p as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5),
        n as (select p.a, p.b, p.score, s.b as neg, s.score as neg_score, row_number() over (partition by p.a, p.b order by s.score desc, s.b) as rank
              from p join s on s.a = p.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
        select a as anchor_id, b as positive_id, rank::integer as rank, neg as negative_id, score as positive_score, neg_score as negative_score from n where rank <= 3""",
    "op8_license_scan": license_scan.oracle_sql(),
}
