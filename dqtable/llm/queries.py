"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dqtable.llm.byte_bpe import encoded
from dqtable.llm.common import read_table
from dqtable.llm.decontaminate import decontaminated
from dqtable.llm.hard_negatives import hard_negatives
from dqtable.llm.lm_scoring import language_scores
from dqtable.llm.minhash_dedup import minhash_components
from dqtable.llm.pii import personal_data
from dqtable.llm.quality import quality_verdicts
from dqtable.llm.simhash_dedup import simhash_components
from dqtable.llm.spelling import spelling_variants
from dqtable.llm.substring_dedup import without_repeats
from dqtable.llm.suffix_dedup import without_repeated_bytes
from dqtable.llm.token_counts import token_counts
from dqtable.llm.warc import archive_round_trip


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_bytes(read_table(spark, sf_dir, "documents"), window=100, kept=False)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    return decontaminated(read_table(spark, sf_dir, "documents"), benchmark, window=10).drop("hit_runs")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents"), window=20, texts=False)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own."""
    return token_counts(read_table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(read_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages
),
k as (select *, max(page_id) over (partition by body) as kept from p)
select page_id, n as payload_bytes, sha1(body) as payload_digest,
  case when n >= 1000 and page_id is distinct from kept and kept is not null
    then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id is distinct from kept then kept end as refers_to
from k
"""

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
with i as (select item_id, {_ITEM_WORDS} as w from benchmark),
iw as (
  select item_id, least(len(w), 10) as l, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as s
  from (select *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as k from i where len(w) > 0)
),
d as (select doc_id, {_ITEM_WORDS} as w from documents),
dw as (
  select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as k
  from d join (select distinct l from iw) x on len(w) >= l
),
found as (
  select doc_id, k, dw.l, item_id from dw
  join iw on iw.l = dw.l and iw.s = array_to_string(w[k:k + dw.l - 1], ' ')
),
hit as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(k, k + l)) as p from found)
  group by doc_id
),
item as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(hit.n, 0) as n_hit, coalesce(item.n, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, hit.n is not null as contaminated
from d left join hit on d.doc_id = hit.doc_id left join item on d.doc_id = item.doc_id
"""

SUBSTRINGS_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
x as (
  select doc_id, k, array_to_string(w[k:k + 19], ' ') as s
  from (select *, unnest(range(1, len(w) - 18)) as k from d where len(w) >= 20)
),
again as (
  select doc_id, k from (
    select doc_id, k, row_number() over (partition by s order by doc_id, k) as r from x
  ) where r > 1
),
gone as (select distinct doc_id, unnest(range(k, k + 20)) as p from again),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as words from (
    select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d
  ) anti join gone using (doc_id, p) group by doc_id
)
select d.doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed,
  sha256(coalesce(words, '')) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id
"""

MINHASH_SQL = rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[k:k + 2], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) as k from d)
),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select x.doc_id as a, y.doc_id as b, count(*) as k
  from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2
),
l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * k >= 85 * (x.n + y.n - k)
),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as other from d union select node, b from r join e on other = a),
c as (select node, min(other) as least from r group by node)
select d.doc_id, coalesce(n, 0) as n_shingles, least as component_id, d.doc_id = least as kept
from d left join n on d.doc_id = n.doc_id join c on d.doc_id = node
"""

NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
    cast(list_inner_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
p as (
  select anchor_id, other as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, other) as integer) as rank,
  other as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""

#: The others have no SQL form; tests hold them against plain readings of their contracts.
LLM_ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": DECONTAMINATION_SQL,
    "op5_substring_dedup": SUBSTRINGS_SQL,
    "op10_warc": WARC_SQL,
    "op12_minhash_dedup": MINHASH_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
