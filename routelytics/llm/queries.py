"""Registered queries of the training-data operators and their SQL twins.

Each query applies one operator, with production parameters, to its whole
table and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from routelytics.llm import (byte_bpe, decontaminate, importance, line_dedup, lm_scores, near_dedup, pii,
                             quality_classifier, quality_rules, token_counts, toxicity, warc, whitening)
from routelytics.session import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.digest(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(_table(spark, sf_dir, "pages"), checkpoint_dir(spark))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(_table(spark, sf_dir, "documents"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score(_table(spark, sf_dir, "documents"), lm_scores.good_ids(_table(spark, sf_dir, "labels")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_counts": op2_token_counts,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_warc": op8_warc,
    "op9_near_dedup": op9_near_dedup,
    "op10_lm_scores": op10_lm_scores,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_line_dedup": op12_line_dedup,
    "op13_whitening": op13_whitening,
}

_OP9_SQL = r"""
with recursive
toks as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
sets as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
           else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) s from toks),
-- documents of one set stand for each other
classes as (select min(doc_id) rep, s from sets where len(s) > 0 group by s),
grams as (select rep, len(s) n, unnest(s) g from classes),
links as (select a.rep a, b.rep b from grams a join grams b on a.g = b.g and a.rep < b.rep
          group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
sym as (select a, b from links union select b, a from links),
walk as (select rep a, rep b from classes union select w.a, t.b from walk w join sym t on t.a = w.b),
lowest as (select a rep, min(b) component from walk group by a)
select d.doc_id, cast(len(d.s) as bigint) n_shingles, coalesce(l.component, d.doc_id) component_id,
       d.doc_id = coalesce(l.component, d.doc_id) kept
from sets d left join classes c on c.s = d.s left join lowest l on l.rep = c.rep
"""

_OP8_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) x from pages),
d as (select *, max(page_id) over (partition by x) last,
             list_transform(range(8), lambda i: cast('0x' || x[i * 5 + 1:i * 5 + 5] as integer)) v from p)
select page_id, payload_bytes,
       list_aggregate(list_transform(v, lambda n:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // 32768) % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // 1024) % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // 32) % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', n % 32 + 1, 1)), 'string_agg', '') payload_digest,
       case when page_id = last then 'response' else 'revisit' end record_type,
       case when page_id <> last then last end refers_to,
       case when page_id = last then payload_bytes end stored_bytes,
       case when page_id = last then payload_digest end stored_digest
from d
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_OP12_SQL = f"""
with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) v from documents),
lines as (select doc_id, unnest(v) line, generate_subscripts(v, 1) pos from parts),
keyed as (select *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from lines),
frequent as (select k, max(doc_id) last from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (select x.*, coalesce(doc_id <> last, false) gone from keyed x left join frequent using (k))
select doc_id, count(*) n_lines, cast(count_if(gone) as bigint) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
"""

ORACLE_SQL: dict[str, str] = {"op8_warc": _OP8_SQL, "op9_near_dedup": _OP9_SQL, "op12_line_dedup": _OP12_SQL}
