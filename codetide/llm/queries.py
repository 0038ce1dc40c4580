"""The operators applied to their whole tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide.llm import embedding_dedup, filter_audit, fingerprint, hard_negatives, language_id, licenses, mixing, ngram_join, packing, quality, sharding, suffix_dedup, token_files
from codetide.llm.common import HELD_OUT, fold, numbered, table
from codetide.session import StagingArea

ORACLES: dict[str, str] = {}
SHARDS = 24
# words of lower-cased text, as the license contract has them
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"), StagingArea(spark))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = StagingArea(spark)
    got = quality.classify(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        F.coalesce(fold() == HELD_OUT, F.lit(False)),
        fold() != HELD_OUT,
        area,
    )
    area.release()  # the model is in hand
    return got


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), StagingArea(spark))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, F.coalesce(fold() == HELD_OUT, F.lit(False)), fold() != HELD_OUT)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS, StagingArea(spark))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = table(spark, sf_dir, "documents").select("doc_id", packing.n_tokens().alias("n_tokens"))
    return packing.pack(lengths, StagingArea(spark))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = StagingArea(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("chars"), "text")
    copies = mixing.replicate(docs, area).drop("text").withColumn("place", mixing.place())
    placed = numbered(copies, ["place", "doc_id", "copy"], area)
    return placed.select("position", "doc_id", "source", "chars", "copy", "copies", F.round("rate", 9).alias("rate"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_files.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), StagingArea(spark))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), StagingArea(spark))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), StagingArea(spark))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        hard_negatives.quantised("embedding").alias("vector"),
        (vec_id % 100 == 0).alias("anchor"),
    )
    return hard_negatives.mine(vectors, StagingArea(spark))


ORACLES["op7_licenses"] = rf"""
with low as (
  select doc_id, row_number() over () as row, translate(coalesce(text, ''), '{licenses.CAPITALS}', '{licenses.CAPITALS.lower()}') as low
  from documents
), worded as (
  select *, regexp_extract_all(low, '{WORD}') as words from low
), phrases as (
  select unnest([{", ".join(repr(p.split()) for p in licenses.PHRASES)}]) as phrase,
         unnest([{", ".join(repr(v) for v in licenses.PHRASES.values())}]) as label
), base as (
  select row, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list(distinct label) as labels
  from (select row, words, unnest(range(len(words))) as spot from worded), phrases
  where words[spot + 1 : spot + len(phrase)] = phrase
  group by row
), templates as (
  select unnest([{", ".join(repr(k) for k in licenses.TEMPLATES)}]) as label,
         unnest([{", ".join(repr(sorted(set(t.split()))) for t in licenses.TEMPLATES.values())}]) as held
), blocks as (
  select row, list_distinct(regexp_extract_all(unnest(regexp_split_to_array(low, '{licenses.BLOCK_END}')), '{WORD}')) as held from worded
), hits as (
  select b.row, list(distinct t.label) as labels, max(len(list_intersect(b.held, t.held)) / len(t.held)) as share
  from blocks b, templates t
  where len(list_intersect(b.held, t.held)) >= ceil({licenses.CONTAINMENT} * len(t.held) - 1e-9)
  group by b.row
)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(hits.labels, [])))), ',') as labels,
       case when n_base > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from worded left join base using (row) left join hits using (row)
"""

ORACLES["op8_mixing"] = f"""
with per_source as (
  select source, sum(coalesce(length(text), 0) + 1)::bigint as chars from documents group by source
), totals as (
  select sum(chars)::double as all_chars, count(*)::double as all_weight from per_source
), rated as (
  select source, all_chars * 1.0::double / all_weight / chars as rate from per_source, totals
), parted as (
  select *, greatest(ceil(rate / {mixing.PART}), 1)::int as parts from rated
), mass as (
  select source, k, exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)) as mass
  from parted, unnest(range({mixing.TERMS})) as t(k)
), cdf as (
  select source, k, sum(mass) over (partition by source order by k) as cdf from mass
), drawn as (
  select d.doc_id, d.source, length(d.text) as chars, p.rate, part,
         ('0x' || substr(md5('{mixing.SEED}|' || coalesce(d.doc_id::varchar, 'null') || '|' || part), 1, 13))::bigint / {float(1 << 52)} as u
  from documents d join parted p on d.source is not distinct from p.source, unnest(range(1, p.parts + 1)) as t(part)
), counted as (
  select doc_id, drawn.source, chars, rate, count(k)::int as copies
  from drawn left join cdf on drawn.source is not distinct from cdf.source and cdf.cdf <= u
  group by doc_id, drawn.source, chars, rate
), copied as (
  select *, unnest(range(1, copies + 1))::int as copy from counted
)
select row_number() over (order by md5('{mixing.SEED}|order|' || coalesce(doc_id::varchar, 'null') || '|' || copy), doc_id, copy) - 1 as position,
       doc_id, source, chars::int as chars, copy, copies, round(rate, 9) as rate
from copied
"""

ORACLES["op12_filter_audit"] = r"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), firsts as (
  select body, min(doc_id) as first from docs group by body
), marks as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id
), masks as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
         + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body))::int
         + 8 * regexp_matches(body, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int as mask
  from docs left join firsts using (body) left join marks using (doc_id)
), counts as (
  select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by part, mask
), filters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit
), orders as (
  select [a.bit, b.bit, c.bit, d.bit, e.bit] as bits, a.f || b.f || c.f || d.f || e.f as filter_order
  from filters a, filters b, filters c, filters d, filters e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps as (
  select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1 : step - 1]), 0)::int as before
  from orders, unnest([1, 2, 3, 4, 5]) as t(step)
), each as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (where mask & own = 0 and mask & before = 0), 0)::bigint as kept,
         coalesce(sum(n) filter (where mask & own <> 0 and mask & before = 0), 0)::bigint as removed,
         coalesce(sum(n) filter (where mask & own <> 0 and mask & before <> 0), 0)::bigint as redundant,
         coalesce(sum(n) filter (where mask = own), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (where mask & own <> 0 and mask & before = 0), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (where mask & own <> 0 and mask & before = 0), 0)::bigint as toxic_lost
  from counts, steps group by part, filter_order, step, own
)
select * exclude (own), sum(removed) over (partition by part, own)::bigint as shapley from each
"""

ORACLES["op13_hard_negatives"] = """
with vecs as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x::double)]) = 0
), scored as (
  select a.row as anchor, a.vec_id as anchor_id, a.label = b.label as same, b.row, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
  from vecs a join vecs b on a.row <> b.row where a.vec_id % 100 = 0
), good as (
  select * from scored where same qualify row_number() over (partition by anchor order by score desc, vec_id, row) <= 5
), bad as (
  select g.anchor_id, g.vec_id as positive_id, s.vec_id as negative_id, g.score as positive_score, s.score as negative_score,
         row_number() over (partition by g.anchor, g.row order by s.score desc, s.vec_id, s.row)::int as rank
  from good g join scored s on g.anchor = s.anchor and not s.same and 80 * g.score <= 100 * s.score and s.score <= g.score
)
select * from bad where rank <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_quality": op2_quality,
    "op3_ngram_join": op3_ngram_join,
    "op4_language": op4_language,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_licenses": op7_licenses,
    "op8_mixing": op8_mixing,
    "op9_fingerprint": op9_fingerprint,
    "op10_token_files": op10_token_files,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}
