"""The queries of the corpus operators, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.chat_format import render_chats
from tidemark.llm.common import table, with_package
from tidemark.llm.decontaminate import contaminated_docs
from tidemark.llm.exact_dedup import exact_dedup, fresh_index
from tidemark.llm.html_text import extract_text
from tidemark.llm.jaccard_join import jaccard_join
from tidemark.llm.mixing import mix_documents
from tidemark.llm.prefix_trie import prefix_trie
from tidemark.llm.quality import score_quality, train_quality
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_alignment import align_tokenizers
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.url_filter import filter_urls
from tidemark.llm.warc import archive_pages
from tidemark.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(with_package(spark), sf_dir)
    return fn


@_query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), fresh_index(spark))


ORACLES["op5_exact_dedup"] = r"""
with digests as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), groups as (
  select text_sha256, min(doc_id) as keep_id, count(*) as group_size from digests group by text_sha256
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from digests join groups using (text_sha256)
"""


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, new_folder(spark, "token-cache"))


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


@_query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


@_query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@_query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


# What the archives must give back.
ORACLES["op9_warc"] = r"""
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), first as (
  select payload_digest, max(page_id) as response_id from payloads where payload_bytes >= 1000 group by payload_digest
)
select page_id, payload_bytes, payload_digest,
       case when page_id is distinct from coalesce(response_id, page_id) then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from coalesce(response_id, page_id) then response_id end as refers_to
from payloads left join first using (payload_digest)
"""


@_query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_chats(table(spark, sf_dir, "conversations"))


ORACLES["op6_chat_format"] = r"""
with clean as (
  select conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations
), turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as position from clean
), speakers as (
  select distinct conv_id as of_conv, role as perspective from clean where role <> 'system'
), told as (
  select conv_id, perspective, position // 256 as part, position, role = perspective as own,
         '<|' || case when role = perspective then 'assistant' when role = 'system' then 'system' else 'user name=' || role end
           || '|>' || chr(10) as head,
         text
  from turns join speakers on conv_id is not distinct from of_conv
), pieces as (
  select *, head || text || '<|end|>' || chr(10) as piece from told
), placed as (
  select *, coalesce(sum(length(piece)) over (partition by conv_id, perspective, part order by position
                     rows between unbounded preceding and 1 preceding), 0)::bigint + length(head) as begin_at
  from pieces
)
select conv_id, perspective, part, count(*) as n_turns, string_agg(piece, '' order by position) as text,
       coalesce(string_agg(begin_at || '-' || (begin_at + length(text) + 7), ',' order by position) filter (own), '') as mask
from placed group by conv_id, perspective, part
"""


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


ORACLES["op8_mixing"] = r"""
with recursive docs as materialized (
  select doc_id, coalesce(source, 'unknown') as source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens,
         coalesce(doc_id::varchar, 'null') as identity
  from documents
), totals as materialized (
  select source, count(*) as n_docs, sum(n_tokens)::bigint as n_tokens,
         sum(n_tokens) / sum(sum(n_tokens)) over () as share
  from docs where n_tokens > 0 group by source having sum(n_tokens) > 0
), goal as (
  select 0.95 * ln(count(*)) as entropy from totals
), search as (
  select 0 as step, 0.0::double as low, 1.0::double as high
  union all
  select step + 1,
         case when flat then (low + high) / 2 else low end,
         case when flat then high else (low + high) / 2 end
  from (
    select step, low, high,
           (select ln(sum(pow(share, (low + high) / 2)))
                   - sum(pow(share, (low + high) / 2) * ln(pow(share, (low + high) / 2))) / sum(pow(share, (low + high) / 2))
            from totals) > (select entropy from goal) as flat
    from search where step < 32
  )
), ends as (
  select (select ln(count(*)) from totals) > (select entropy from goal) as flat_at_0,
         (select -sum(share * ln(share)) from totals) > (select entropy from goal) as flat_at_1
), exponent as (
  select case when flat_at_1 then 1.0 when not flat_at_0 then 0.0
              else (select high from search where step = 32) end as e from ends
), weights as (
  select source, n_docs, n_tokens, pow(share, e) / sum(pow(share, e)) over () as weight,
         sum(n_tokens) over () as all_tokens
  from totals, exponent
), budgets as materialized (
  select source, n_tokens as epoch_tokens, weight, ceil(n_docs / 4096.0)::bigint as blocks,
         floor(round(weight * all_tokens, 3))::bigint as budget
  from weights
), blocked as (
  select doc_id, identity, source, n_tokens, epoch_tokens, weight, budget,
         ('0x' || substr(md5('mix-1|block|' || identity), 1, 15))::bigint % blocks as block
  from docs join budgets using (source) where n_tokens > 0 and budget > 0
), taken as materialized (
  select *, unnest(range(0, (budget - 1) // epoch_tokens + 1)) as epoch from blocked
), last as materialized (
  select *, budget - epoch * epoch_tokens as left_over from taken where (epoch + 1) * epoch_tokens > budget
), blocks as (
  select source, epoch, block, sum(n_tokens) as block_tokens,
         ('0x' || substr(md5('mix-1|order|' || epoch || '|' || block), 1, 15))::bigint as place
  from last group by source, epoch, block
), ahead as (
  select source, block, coalesce(sum(block_tokens) over (partition by source order by place, block
         rows between unbounded preceding and 1 preceding), 0) as before_block
  from blocks
), placed as (
  select last.*, before_block + coalesce(sum(n_tokens) over (partition by source, block
         order by ('0x' || substr(md5('mix-1|doc|' || epoch || '|' || identity), 1, 15))::bigint, doc_id, n_tokens
         rows between unbounded preceding and 1 preceding), 0) as before
  from last join ahead using (source, block)
)
select doc_id, source, epoch, block, n_tokens, round(weight, 6) as weight from taken where (epoch + 1) * epoch_tokens <= budget
union all
select doc_id, source, epoch, block, n_tokens, round(weight, 6) as weight from placed where before < left_over
"""


@_query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_docs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    sides = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(table(spark, sf_dir, "documents"), *sides)


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = r"""
with recursive clean as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as place from clean
), checked as (
  select conv_id, count(*) as own, conv_id - conv_id % 100 as leader,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
               lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, 3988292384 * (crc & 1)) end), 4294967295) % 6 as h
  from turns group by conv_id
), convs as (
  select c.conv_id, c.own, c.leader, c.h, least(c.h, coalesce(l.own, 0)) as taken from checked c left join checked l on l.conv_id = c.leader
), rebuilt as (
  select conv_id, place - h + taken as at, role, text from turns join convs using (conv_id) where place >= h
  union all
  select c.conv_id, t.place, t.role, t.text from convs c join turns t on t.conv_id = c.leader where t.place < c.taken
), lengths as (
  select conv_id, taken + greatest(own - h, 0) as length from convs
), paths as (
  select conv_id, 0::bigint as depth, sha256('') as node, null::varchar as up, 0::bigint as chars from lengths
  union all
  select p.conv_id, p.depth + 1, sha256(p.node || length(r.role) || ':' || r.role || r.text), p.node, length(r.text)
  from paths p join rebuilt r on r.conv_id = p.conv_id and r.at = p.depth
), nodes as (
  select node, any_value(depth) as depth, any_value(up) as up, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs
  from paths group by node
), family as (
  select n.*, coalesce(k.n_children, 0) as n_children
  from nodes n left join (select up, count(*) as n_children from nodes where up is not null group by up) k on k.up = n.node
), below as (
  select p.node, count(*) filter (f.n_children = 0) as n_leaves, sum((f.n_convs - 1) * f.chars) as saved_tokens
  from family f join paths p on p.conv_id = f.conv_id and p.depth <= f.depth group by p.node
), ends as (
  select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from paths join lengths using (conv_id) where depth = length group by node
)
select f.conv_id, f.depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens::bigint as saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from family f join below b using (node) left join nodes u on u.node = f.up left join ends e on e.node = f.node
"""


@_query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
