"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, media, mixing, ngram_join, quality, sharding, suffix_dedup, toxicity, url_filter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_column(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"), keep=fold(3) != 1)
    scored = toxicity.score_toxicity(docs, net)
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "windows", "worst_start", "worst_end")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"), keep=fold(5) != 0)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "replica", "shuffle_key")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_media, op2_url_filter, op3_toxicity, op4_warc, op5_decontaminate, op6_quality, op7_sharding, op8_ngram_join, op9_mixing, op10_suffix_dedup)
    return {f.__name__: f for f in own}


_OP2 = """
with parsed as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest
  from pages
), sites as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from parsed
), rules(rule, rhost, rpath, verdict) as (
  values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
    ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')
), fits as (
  select page_id, host, path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from (select distinct page_id, host, path, rule, verdict from sites
        join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
  group by page_id, host, path
)
select s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from sites s left join fits f on s.page_id = f.page_id and s.host = f.host and s.path = f.path
"""

_OP4 = """
with p as (
  select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as digest from pages
), g as (
  select digest, max(page_id) as last_id from p where n >= 1000 group by digest
)
select page_id, n as payload_bytes, p.digest as payload_digest,
  case when n >= 1000 and page_id <> last_id then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> last_id then last_id end as refers_to
from p left join g on p.digest = g.digest
"""

#: The checksum's table of 256 comes from its rule.
_OP7 = """
with recursive crc_steps as (
  select range as i, range as v, 0 as k from range(256)
  union all
  select i, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from crc_steps where k < 8
), crc_table as (
  select list(v order by i) as t from crc_steps where k = 8
), d as (
  select doc_id, coalesce(text, '') as txt, strlen(coalesce(text, '')) + 1 as size, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::bigint as h from documents
), crcs as (
  select txt, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(txt)), '..'), lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) as crc
  from (select distinct txt from d), crc_table
), placed as (
  select doc_id, size, crc, coalesce(sum(size) over (order by h, doc_id, crc rows between unbounded preceding and 1 preceding), 0)::bigint as before, sum(size) over ()::bigint as total, row_number() over (order by h, doc_id, crc) as place
  from d join crcs on crcs.txt = d.txt
), cut as (
  select *, least(floor((before + size / 2.0::double) * 16 / total), 15)::int as shard from placed
)
select doc_id, size, crc as text_crc32, 'bytes' as law, shard, place - min(place) over (partition by shard) as slot, null::int as grown_shard from cut
"""

_OP8 = """
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents
), sets as (
  select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i+4], ' '))) end as s
  from w
), sizes as (select doc_id, len(s) as n from sets),
tokens as (select doc_id, md5(unnest(s)) as t from sets),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as both_have from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2
), links as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * both_have >= 80 * (p.n + q.n - both_have)
), reach as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, l.y from reach r join links l on r.y = l.x
)
select s.doc_id, n as n_shingles, least_id as component_id
from sizes s join (select x, min(y) as least_id from reach group by x) c on c.x = s.doc_id
"""

_OP9 = """
with recursive d as (
  select doc_id, source, strlen(coalesce(text, '')) as size, md5(coalesce(text, '~')) as h from documents
), stats as (
  select source, sum(size) as bytes, pow(sum(size)::double, 0.5) as raw from d group by source
), rates as (
  select source, case when bytes > 0 then raw / (select sum(raw) from stats) * (select sum(bytes) from stats)::double / bytes else 1.0 end as rate from stats
), cdf as (
  select source, rate, 0 as k, exp(-rate) as p, exp(-rate) as c from rates
  union all
  select source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) from cdf where k < ceil(rate + 12 * sqrt(rate) + 24)
), drawn as (
  select doc_id, source, h, (('0x' || substr(md5('17:' || coalesce(doc_id::varchar, '~') || ':' || h), 1, 12))::bigint::double + 0.5) / 281474976710656.0 as u from d
), counts as (
  select d.doc_id, d.source, d.h, count(*) filter (where c.c < d.u) as n
  from drawn d join cdf c on c.source is not distinct from d.source group by d.doc_id, d.source, d.h, d.u
)
select doc_id, source, replica::int as replica, md5('17:deal:' || coalesce(doc_id::varchar, '~') || ':' || h || ':' || replica::varchar) as shuffle_key
from (select doc_id, source, h, unnest(generate_series(1, n)) as replica from counts where n > 0)
"""

_OP10 = """
with d as (
  select doc_id, encode(coalesce(text, '')) as b from documents
), n as (
  select doc_id, b, octet_length(b) as n, row_number() over () as k from d
), w as (
  select k, p, hash(b[p:p + 399]) as h from (select k, b, unnest(generate_series(1, n - 399)) as p from n)
), m as (
  select k, p, md5(s) as h from (select w.k, p, b[p:p + 399] as s from (select * from w qualify count(*) over (partition by h) > 1) w join n on n.k = w.k)
), hit as (
  select k, p from (select k, p, count(*) over (partition by h) as c from m) where c > 1
), runs as (
  select k, min(p) as a, max(p) + 399 as z from (
    select k, p, sum(case when p <= prev + 400 then 0 else 1 end) over (partition by k order by p) as run
    from (select k, p, lag(p) over (partition by k order by p) as prev from hit)
  ) group by k, run
), kept as (
  select k, string_agg(hex(b[lo:hi]), '' order by lo) as body from (
    select r.k, n.b, coalesce(lag(z) over (partition by r.k order by a), 0) + 1 as lo, a - 1 as hi from runs r join n on n.k = r.k
    union all
    select r.k, any_value(n.b), max(z) + 1, any_value(n.n) from runs r join n on n.k = r.k group by r.k
  ) where lo <= hi group by k
), spans as (
  select k, count(*) as n_spans, sum(z - a + 1)::bigint as n_removed from runs group by k
)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  case when n_spans is null then sha256(b) else sha256(unhex(coalesce(body, ''))) end as kept_sha256
from n left join spans s on s.k = n.k left join kept c on c.k = n.k
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": _OP2, "op4_warc": _OP4, "op7_sharding": _OP7, "op8_ngram_join": _OP8, "op9_mixing": _OP9, "op10_suffix_dedup": _OP10}
