"""The ``opN_<name>`` queries over the whole ``documents`` table, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import (
    conversations, exact, heapbpe, lines, lm, mixing, ngrams, packing, prefixbpe, quality, shards, substrings, whitening,
)
from tabwright.llm.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(plan: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[plan.__name__] = plan
    return plan


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return heapbpe.token_counts(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.near_duplicates(read_table(spark, sf_dir, "documents"))


SQL["op2_ngram_jaccard_join"] = r"""
with recursive d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as ws from documents),
g as (
  select distinct doc_id, array_to_string(ws[s:s + 4], ' ') as g from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as s from d where len(ws) >= 5)
  union all select doc_id, array_to_string(ws, ' ') from d where len(ws) between 1 and 4
),
n as (select doc_id, count(*) as n from g group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as k from g a join g b using (g) where a.doc_id <> b.doc_id group by all),
l as (
  select x, y from p join n a on x = a.doc_id join n b on y = b.doc_id where 5 * k >= 4 * (a.n + b.n - k)
  union select a.doc_id, b.doc_id from d a join d b on a.t = b.t and a.doc_id <> b.doc_id
),
c(x, c) as (select doc_id, doc_id from d union select l.y, c.c from c join l on c.x = l.x where c.c < l.y)
select d.doc_id, (select min(c.c) from c where c.x = d.doc_id) as class_id, (select count(*) from l where l.x = d.doc_id) as n_links from d
"""


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read_table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.packed(docs, ranks, public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removal_report(read_table(spark, sf_dir, "documents"))


SQL["op4_line_dedup"] = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as k from documents
),
s as (select doc_id, k, line, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as ws from l),
e as (select doc_id, k, ws, len(ws) as n from s where len(ws) >= 1),
t as (select doc_id, k, n, unnest(ws) as w from e),
f as (select w, count(*) as f from t group by w),
p as (select doc_id, k, n, w from t join f using (w) qualify row_number() over (partition by doc_id, k order by f, w) <= n - (4 * n + 4) // 5 + 1),
c as (
  select distinct a.doc_id, a.k, b.doc_id as earlier, b.k as at from p a join p b using (w)
  where (b.doc_id, b.k) < (a.doc_id, a.k) and 5 * b.n >= 4 * a.n and 5 * a.n >= 4 * b.n
),
r as (
  select distinct c.doc_id, c.k from c join e a on c.doc_id = a.doc_id and c.k = a.k join e b on c.earlier = b.doc_id and c.at = b.k
  where 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (a.n + b.n)
)
select s.doc_id, count(*) as n_lines, count(r.k) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by s.k) filter (r.k is null), '')) as kept_sha256
from s left join r on s.doc_id = r.doc_id and s.k = r.k group by s.doc_id
"""


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(read_table(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return prefixbpe.round_trips(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_report(read_table(spark, sf_dir, "documents"))


SQL["op8_substring_dedup"] = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
v as (select doc_id, ws, unnest(range(1, len(ws) - 18)) as s from d where len(ws) >= 20),
k as (select doc_id, s, array_to_string(ws[s:s + 19], ' ') as t from v),
r as (select doc_id, s from (select doc_id, s, min((doc_id, s)) over (partition by t) as first from k) where first <> (doc_id, s)),
c as (select distinct doc_id, unnest(range(s, s + 20)) as i from r),
n as (select doc_id, count(*) as n_removed from c group by doc_id),
u as (select doc_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from d),
t as (select doc_id, string_agg(w, ' ' order by i) as t from u anti join c using (doc_id, i) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join n using (doc_id) left join t using (doc_id)
"""


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.balanced_shards(read_table(spark, sf_dir, "documents"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_groups(read_table(spark, sf_dir, "documents"))


SQL["op10_exact_dedup"] = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_repairs(read_table(spark, sf_dir, "conversations"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


@query
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read_table(spark, sf_dir, "documents"))


SQL["op13_source_mixing"] = r"""
with recursive d as (select source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
c as (select *, row_number() over (partition by source, doc_id, size) - 1 as copy from d),
k as (select *, md5(concat_ws(':', coalesce(doc_id::varchar, ''), size, copy // 1000)) as key from c),
s as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from d group by source
),
l(level) as (
  select sum(source_size)::double / sum(weight)::double from s
  union
  select ((select sum(source_size) from s) - coalesce(sum(3 * source_size) filter (level * weight > 3 * source_size), 0))::double
         / (sum(weight) filter (not level * weight > 3 * source_size))::double
  from l, s group by level
),
t as (
  select source, source_size,
         case when level * weight > 3 * source_size then (3 * source_size)::double else level * weight end as target
  from s, (select max(level) as level from l)
),
b as (
  select source, source_size, target, case when source_size > 0 then floor(target)::bigint // source_size else 0 end as epochs,
         case when source_size > 0 then floor(target)::bigint % source_size else 0 end as rest from t
),
p as (
  select *, coalesce(sum(size) over (partition by source order by key, doc_id nulls first, size, copy
                                     rows between unbounded preceding and 1 preceding), 0) as before from k
)
select doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::bigint as taken
from p join b on p.source is not distinct from b.source
"""
