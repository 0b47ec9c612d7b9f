"""One query for each operator over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontamination, licenses, lm, minhash, quality, repeats, search, secrets, sharding, spelling, token_counts, vectors
from .common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(table(spark, sf_dir, "documents"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: ~s["kind"].contains("@"))
    return found.select("doc_id", *[number(k).alias(f"n_{k}") for k in secrets.KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measured(table(spark, sf_dir, "documents"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), drop_every=199)


QUERIES = {f.__name__: f for f in (op1_sharding, op2_token_counts, op3_minhash, op4_licenses, op5_suffix_dedup, op6_secrets, op7_quality, op8_lm_scores, op9_bpe, op10_decontamination, op11_vectors, op12_search, op13_spelling)}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE_SQL = {
    "op7_quality": rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {_WORDS} as w from documents),
g as (select r, i, sum(1) over (partition by r, g) as n from (
  select r, i, array_to_string(w[i:i + 7], ' ') as g from (select r, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8))),
c as (select r, count(distinct i + k) as n from (select r, i, unnest(range(0, 8)) as k from g where n > 1) group by r),
m as (select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
  cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
  cast(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as bigint) as n_dup_lines,
  cast(coalesce(c.n, 0) as bigint) as n_repeat_words from d left join c using (r))
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 10 * n_symbols > 2 * n_words
       or word_chars < 2 * n_words or word_chars > 14 * n_words or 20 * n_dup_lines > n_words) as kept from m""",
    "op11_vectors": """
with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join l on l.a = r.b),
c as (select a as vec_id, min(b) as component_id from reach group by 1), n as (select a as vec_id, count(*) as n from l group by 1)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, vec_id = component_id as kept from c left join n using (vec_id)""",
    "op12_search": r"""
with words as (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
d as (select r, doc_id, cast(len(w) as bigint) as n, w from words where len(w) > 0),
s as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from d),
p as (select r, t, count(*) as tf from (select r, unnest(w) as t from d) group by 1, 2), f as (select t, count(*) as df from p group by 1),
i as (select row_number() over () as item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
q as (select item, any_value(item_id) as item_id, t, count(*) as c from (select item, item_id, unnest(w) as t from i) group by item, t),
wt as (select item, item_id, t, c * cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1))) as bigint) as w from q join f using (t), s),
m as (select r, doc_id, 75 + (25 * n * big_n) // big_l as m from d, s),
scored as (select item, any_value(item_id) as item_id, any_value(doc_id) as doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score from wt join p using (t) join m using (r) group by item, r)
select item_id, cast(rank as int) as rank, doc_id, score from (select *, row_number() over (partition by item order by score desc, doc_id) as rank from scored where score > 0) where rank <= 20""",
    "op13_spelling": r"""
with recursive t as (select list(x order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as x from (select unnest(range(256)) as i))),
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as w from documents),
each as (select doc_id, w, count(*) as c from runs where length(w) >= 6 group by 1, 2),
keyed as (select *, hex(encode(concat(doc_id, ':', w))) as x from each),
crc as (select w, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: cast('0x' || x[2 * i + 1:2 * i + 2] as bigint))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h from keyed, t),
cut as (select case when h % 199 = 0 then w[:h % length(w)] || w[h % length(w) + 2:] else w end as word, c from crc),
v as (select word, cast(sum(c) as bigint) as n from cut where length(word) >= 6 group by 1 having sum(c) >= 5),
"""
    + """k as (select word, n, length(word) as l, translate(word, array_to_string(list_transform(range(192, 256), lambda i: chr(cast(i as int))), ''), array_to_string(list_transform(range(33, 97), lambda i: chr(cast(i as int))), '')) as one from v),
near as (select a.word, a.n, b.word as other, b.n as m from k a join k b on b.l between a.l - 1 and a.l + 1 and a.word <> b.word where levenshtein(a.one, b.one) = 1),
best as (select word, any_value(n) as n, count(*) as n_near, min({'neg': -m, 'word': other}) as b from near group by 1),
links as (select word, b.word as form, -b.neg as form_n from best where -b.neg >= 5 * n),
walk(word, top) as (select word, word from v union all select walk.word, links.form from walk join links on links.word = walk.top),
ends as (select word, top as root from walk where top not in (select word from links))
select v.word, links.form, ends.root, v.n, cast(coalesce(n_near, 0) as bigint) as n_near, cast(links.form_n as bigint) as form_n from v join ends using (word) left join best using (word) left join links using (word)""",
}
