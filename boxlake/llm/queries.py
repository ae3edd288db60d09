"""The queries of these operators over their whole tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm import bpe, hardneg, histpack, langid, linededup, neardup, packing, private, quality, secrets, urlfilter, vectors, whitening
from boxlake.session import table


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.find_secrets(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = private.find_private(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_context")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs.withColumn("held_out", langid.held_out()), langid.dictionaries(docs), keep=["held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op11_histpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histpack.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def _weight(names: tuple[str, ...], weight: int) -> str:
    """Weight of the terms of a list that stand in ``low``, each once, with a plural s where it has one."""
    terms = ", ".join(f"'{t}{'s?' if urlfilter.plural(t) else ''}'" for t in names)
    return f"{weight} * len(list_filter([{terms}], lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE_SQL: dict[str, str] = {
    "op4_lines": """
with l as (select r, host, unnest(string_split(text, chr(10))) as line from (select row_number() over () as r, coalesce(source, '') as host, text from documents) d),
n as (select host, trim(line, ' ') as line, count(distinct r) as n from l where trim(line, ' ') <> '' group by 1, 2),
t as (select coalesce(source, '') as host, count(*) as pages from documents group by 1),
b as (select n.host, n.line from n join t on n.host = t.host where n >= 3 and n > 0.1 * pages),
g as (select host, list(line) as lines from b group by host)
select doc_id, coalesce(len(string_split(text, chr(10))), 0)::bigint as n_lines,
  coalesce(len(string_split(text, chr(10))) - len(list_filter(string_split(text, chr(10)), lambda x: not list_contains(coalesce(lines, []), trim(x, ' ')))), 0)::bigint as n_dropped,
  array_to_string(list_filter(string_split(text, chr(10)), lambda x: not list_contains(coalesce(lines, []), trim(x, ' '))), chr(10)) as text
from documents left join g on coalesce(source, '') = host""",
    "op9_urls": f"""
with p as (select page_id, url, translate(coalesce(url, ''), {_AZ}) as low,
  translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), {_AZ}) as host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(verdict, rule, rh, rp) as (values {", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in urlfilter.RULES)}),
m as (select page_id, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict from (select distinct page_id, host, path from p) q join r
  on (q.host = rh or q.host like '%.' || rh) and starts_with(q.path, rp) group by page_id)
select p.page_id, p.host, p.path, m.rule, coalesce(m.verdict,
  case when {_weight(urlfilter.STRICT, 4)} + {_weight(urlfilter.STRONG, 3)} + {_weight(urlfilter.WEAK, 1)} >= 4 then 'block' else 'allow' end) as verdict
from p left join m on p.page_id = m.page_id""",
    "op12_hardneg": """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding::double[], lambda c: cast(floor(256 * c) as bigint)) as x from embeddings
  where label is not null and vec_id is not null and embedding is not null and len(list_filter(embedding::double[], lambda c: c is null or not isfinite(c))) = 0),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])) as bigint) as score from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select * from (select a, b, score, row_number() over (partition by a order by score desc, b) as r from s where same) where r <= 5),
n as (select p.a as anchor_id, p.b as positive_id, row_number() over (partition by p.a, p.b order by s.score desc, s.b) as r, s.b as negative_id, p.score as positive_score, s.score as negative_score
  from p join s on s.a = p.a and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor_id, positive_id, cast(r as integer) as rank, negative_id, positive_score, negative_score from n where r <= 5""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_lines": op4_lines,
    "op5_bpe": op5_bpe,
    "op6_private": op6_private,
    "op7_packing": op7_packing,
    "op8_langid": op8_langid,
    "op9_urls": op9_urls,
    "op10_minhash": op10_minhash,
    "op11_histpack": op11_histpack,
    "op12_hardneg": op12_hardneg,
    "op13_whitening": op13_whitening,
}
