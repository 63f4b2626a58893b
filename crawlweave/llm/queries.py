"""The registered queries of this package and the SQL that some of them are held against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.llm import (
    bpe_codec, decontaminate, divergence, html_extract, lattice, license_scan, lm_score, minhash, quality_rules, sharding,
    token_count, url_filter, vector_codes,
)
from crawlweave.llm.common import table

RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SHARDS = 16
TOKEN_LIMIT = 1024


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], settled=True)


def op3_bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe_codec.digests(spark, docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = docs.withColumns(
        {"law": F.lit("key"), "shard": sharding.shard_of(SHARDS, F.col("doc_id")), "grown_shard": sharding.shard_of(SHARDS + 1, F.col("doc_id"))}
    )
    return sharding.number(placed, "shard").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", license_scan.scan("text", license_scan.learn(docs)).alias("s"))
    return found.select(
        "doc_id", F.col("s.n").alias("n_paragraphs"), F.size(F.array_distinct("s.found.line")).cast("long").alias("n_licensed"),
        F.array_join(F.array_sort(F.array_distinct("s.found.family")), ",").alias("families"),
    )


def op6_token_count(spark: SparkSession, folder: str) -> DataFrame:
    count = token_count.token_counter(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    docs = table(spark, folder, "documents").select("doc_id", "text", count("text").alias("n_tokens"))
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op8_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    scores = html_extract.learn(pages)
    texts = pages.select("page_id", "url", html_extract.text_of("html", scores).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontaminate.judge(docs, table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform(F.coalesce("items", F.array()), lambda i: i.cast("string")))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated",
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.learn(docs, table(spark, folder, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents").select("text", "lang", "source"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


def op13_lattice_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_lm_score, op3_bpe_roundtrip, op4_sharding, op5_license_scan, op6_token_count, op7_minhash,
        op8_html_extract, op9_decontamination, op10_quality_rules, op11_source_divergence, op12_vector_codes,
        op13_lattice_dedup,
    )
}


def _lloyd_sql() -> str:
    """Four rounds written out: nearest entries ``a``, codebooks ``c``; sums and floors over whole numbers."""
    near = """a{r} as materialized (
  select id, k, part, min(d).e as e, min(d).d as d from (
    select id, p.k, p.part, {{'d': list_sum(list_transform(list_zip(part, c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), 'e': e}} as d
    from p join c{b} as c on p.k = c.k) group by id, k, part)"""
    mean = """c{r} as materialized (
  select b.k, b.e, coalesce(n.c, b.c) as c from c{b} as b left join (
    select k, e, list(((s - ((s % n) + n) % n) // n) order by i) as c from (
      select k, e, i, sum(part[i])::bigint as s, count(*) as n from (select k, e, part, unnest(range(1, len(part) + 1)) as i from a{r}) group by k, e, i)
    group by k, e) as n on b.k = n.k and b.e = n.e)"""
    rounds = ",\n".join(x.format(r=r, b=r - 1) for r in range(1, 5) for x in (near, mean))
    return f"""
with q as (select vec_id as id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select id, k, list_slice(q, k * len(q) // 4 + 1, (k + 1) * len(q) // 4) as part from q, range(4) as t(k)),
c0 as (select k, row_number() over (partition by k order by id) - 1 as e, part as c from p qualify e < 256),
{rounds},
{near.format(r=5, b=4)},
h as (select sha256(string_agg(array_to_string(c, ','), ',' order by k, e)) as h from c4),
v as (select id, string_agg(lower(printf('%02x', e)), '' order by k) as code, sum(d)::bigint as error from a5 group by id)
select id as vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h as codebooks_sha256
from v join q using (id), h"""


_HOST = "translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
_SPLIT = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op1_url_filter": f"""
with r(h, p, v) as (values {", ".join(map(str, RULES))}),
u as (select row_number() over () as n, page_id, {_HOST} as host, {_PATH} as path from pages),
m as (select n, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as v
      from u join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by n)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from u left join m using (n)""",
    "op9_decontamination": f"""
with d as (select row_number() over () as n, doc_id, coalesce({_SPLIT}, []) as w from documents),
i as (select item_id, {_SPLIT} as w from benchmark),
iw as (select distinct item_id, least(13, len(w)) as m, w[k:k + least(13, len(w)) - 1] as g
       from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k from i where len(w) > 0)),
ms as (select distinct m from iw),
dw as (select n, m, k, w[k:k + m - 1] as g from (select n, m, w, unnest(range(1, len(w) - m + 2)) as k from d, ms where len(w) >= m)),
hit as (select n, item_id, k, dw.m from dw join iw on dw.m = iw.m and dw.g = iw.g),
cov as (select n, count(distinct p) as n_hit from (select n, unnest(range(k, k + m)) as p from hit) group by n),
its as (select n, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as names from hit group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from d left join cov using (n) left join its using (n)""",
    "op12_vector_codes": _lloyd_sql(),
    "op11_source_divergence": r"""
with d as (select row_number() over () as n, coalesce(lang, '') as lang, coalesce(source, '') as source,
  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), []) as w from documents),
o as materialized (select n, lang, source, unnest(w) as t from d),
kept as materialized (select lang, t from o group by lang, t having count(distinct n) >= 3),
v as (select lang, count(*)::hugeint as v from kept group by lang),
c as materialized (select lang, source, t, count(*)::hugeint as c from o join kept using (lang, t) group by lang, source, t),
g as materialized (select lang, source, coalesce(s, 0)::hugeint as s from (select distinct lang, source from d) left join
  (select lang, source, sum(c) as s from c group by lang, source) using (lang, source)),
p as materialized (select lang, source, t, coalesce(c, 0) as c, 1 + 1000000000::hugeint * (coalesce(c, 0) + 1) // (s + v) as p
  from g join v using (lang) join kept using (lang) left join c using (lang, source, t)),
q as (select lang, t, 1 + 1000000000::hugeint * (lc + 1) // (ls + v) as q from (select lang, t, sum(c)::hugeint as lc from c group by lang, t)
  join (select lang, sum(s)::hugeint as ls from g group by lang) using (lang) join v using (lang)),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from p as a join p as b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by a.lang, a.source, b.source),
every as (select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value from g as a join g as b on a.lang = b.lang and a.source <> b.source
  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
strays as (select lang, source, t as item, ((p - q) * (p - q) // q)::bigint as value from p join q using (lang, t) where c > 0 and p > q)
select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, encode(item))::int as rank from every
union all
select lang, source, 'term', item, value, (row_number() over (partition by lang, source order by value desc, encode(item)))::int as rank from strays
qualify rank <= 200""",
    "op13_lattice_dedup": """
with recursive v as materialized (select vec_id, label, embedding::double[] as e from embeddings where label is not null
  and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (select a.vec_id as x, b.vec_id as y from v as a join v as b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select vec_id as x, vec_id as y from embeddings union select r.x, l.y from reach as r join links as l on r.y = l.x),
found as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0)::bigint as n_links, c as component_id, vec_id = c as kept
from embeddings left join found on x = vec_id join (select x as id, min(y) as c from reach group by x) on id = vec_id""",
}
