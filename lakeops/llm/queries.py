"""The registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import gif, hard_negatives, importance, mixing, url_filter
from lakeops.llm.bpe import encode_documents
from lakeops.llm.html_extract import extract_main_text
from lakeops.llm.language_id import language_predictions
from lakeops.llm.near_dedup import near_duplicate_classes
from lakeops.llm.packing import pack_documents
from lakeops.llm.quality import quality_verdicts
from lakeops.llm.storage import table
from lakeops.llm.substring_dedup import remove_repeated_windows
from lakeops.llm.toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op4_substring_dedup(spark, sf_dir):
    return remove_repeated_windows(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL["op4_substring_dedup"] = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as k
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)),
firsts as (select k, min(doc_id) as first_doc from windows group by k),
gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as j
  from windows join firsts using (k) where first_doc < doc_id),
spans as (select doc_id, list(j) as js, count(*) as n from gone group by doc_id),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) as j from d),
kept as (
  select p.doc_id, string_agg(w[j], ' ' order by j) as t
  from places p anti join gone using (doc_id, j) group by p.doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(s.n, 0)::bigint as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from d left join spans s using (doc_id) left join kept k using (doc_id)
"""


@query
def op8_minhash_near_dedup(spark, sf_dir):
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


@query
def op1_quality_outliers(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents"))


@query
def op3_byte_bpe(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op7_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


SQL["op7_mix_sources"] = mixing.SQL


@query
def op5_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.RULES)


SQL["op5_url_filter"] = url_filter.SQL


@query
def op10_gif_media(spark, sf_dir):
    return gif.payload_digests(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark, sf_dir):
    return language_predictions(table(spark, sf_dir, "documents"))


@query
def op6_toxicity_neighbours(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_importance_resampling"] = importance.SQL


@query
def op13_hard_negatives(spark, sf_dir):
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), "embedding", 256)
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


SQL["op13_hard_negatives"] = hard_negatives.SQL


@query
def op2_html_main_text(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))


SQL["op8_minhash_near_dedup"] = r"""
with recursive d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
bags as (select doc_id, g, count(*) as n from shingles group by doc_id, g),
totals as (select doc_id, sum(n) as total from bags group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, sum(least(x.n, y.n)) as shared
  from bags x join bags y on x.g = y.g and x.doc_id < y.doc_id group by x.doc_id, y.doc_id),
links as (
  select a, b from common join totals ta on ta.doc_id = a join totals tb on tb.doc_id = b
  where shared / (ta.total + tb.total - shared) >= 0.8 - 1e-9),
ways as (select a, b from links union all select b, a from links),
reached(doc_id, root) as (
  select doc_id, doc_id from d
  union select ways.b, root from reached join ways on ways.a = reached.doc_id where root < ways.b),
classes as (select doc_id, min(root) as class_id from reached group by doc_id)
select d.doc_id, class_id, d.doc_id = class_id as kept from d join classes using (doc_id)
"""
