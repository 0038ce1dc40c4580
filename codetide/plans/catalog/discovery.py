"""Ids, file facts and file selection, on documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide.functions import ids, paths, text as facts
from codetide.operators import discovery
from codetide.plans.catalog.common import hash_sql, table, text
from codetide.session import stage
from codetide.sources.corpus import first_files, restrict

# keep/exclude rules in words and names that web pages and prose do hold
PAGE_RULES = paths.DiscoveryRules(
    test_dirs=("de",),
    test_names=("404",),
    test_prefixes=("9",),
    test_suffixes=("7",),
    setup_names=("", "index"),
    generated_names=("100", "200"),
    generated_suffixes=(".html",),
    markers=("spam-farm", "&pound;", "ad 7"),
)
PROSE_RULES = paths.DiscoveryRules(markers=("mit license", "all rights reserved", "copyright"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        ids.stable_hash("d", c("source"), c("lang"), ids.Number(c("doc_id"))).alias("plain_id"),
        ids.node_id(c("source"), c("lang"), c("lang"), "Document", c("text"), c("n_chars")).alias("node_id"),
        ids.external_symbol_id(c("source"), c("lang"), c("text")).alias("symbol_id"),
        ids.edge_id("CALL", c("source"), c("lang"), c("text")).alias("edge_id"),
        ids.file_id(c("source"), c("lang")).alias("file_id"),
    )


def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        ids.file_id(c("source"), c("doc_id").cast("string")).alias("file_id"),
        ids.content_sha256(c("text")).alias("content_sha256"),
        facts.line_count(c("text")).alias("loc"),
        facts.byte_count(c("text")).alias("size_bytes"),
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1)
    return discovery.classify(pages.withColumn("file_path", path), PAGE_RULES, text=F.col("html"))


def discovery_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("file_path")
    return _pages(spark, sf_dir).select(
        "page_id",
        paths.normalise(path).alias("normal_path"),
        paths.stays_inside(path, "/srv/pages").alias("inside"),
        paths.is_source_path(path, "html").alias("is_html"),
        F.array_join("exclude_reasons", ",").alias("reasons"),
        "excluded",
    )


def discovery_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", paths.has_generated_marker(F.col("text"), PROSE_RULES).alias("marked"))


def discovery_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers found in bytes, of which one is not valid inside the first word ``icense``."""
    before, after = F.substring_index("text", "icense", 1), F.expr("substring(text, locate('icense', text) + 6)")
    broken = F.concat(before.cast("binary"), F.unhex(F.lit("69FF63656E7365")), after.cast("binary"))
    content = F.when(F.col("text").contains("icense"), broken).otherwise(F.col("text").cast("binary"))
    files = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("file_path"), content.alias("content"))
    classified = discovery.classify(files, PROSE_RULES)
    return classified.select("doc_id", F.array_contains("exclude_reasons", "auto-generated").alias("marked"))


def discovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = _pages(spark, sf_dir)
    totals = discovery.summary(classified).unpivot(
        [], ["total_files", "kept_files", "excluded_files"], "what", "n"
    )
    reasons = discovery.reason_counts(classified)
    return totals.unionByName(reasons.select(F.concat(F.lit("reason:"), "reason").alias("what"), F.col("files").alias("n")))


def discovery_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sorting samples its input first: contents are read once, before it
    classified = stage(_pages(spark, sf_dir).select("file_path", "exclude_reasons", "excluded"), "classified")
    kept = discovery.kept(classified).withColumn("reasons", F.lit(""))
    out = discovery.excluded(classified).select("file_path", F.array_join("exclude_reasons", ",").alias("reasons"))
    return kept.unionByName(out)


def manifest_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred labelled documents."""
    manifest = first_files(table(spark, sf_dir, "labels").select("doc_id"), 100, "doc_id")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return restrict(documents, manifest, "doc_id")


QUERIES = {
    "stable_ids": stable_ids,
    "source_metadata": source_metadata,
    "discovery_classify": discovery_classify,
    "discovery_markers": discovery_markers,
    "discovery_bytes": discovery_bytes,
    "discovery_summary": discovery_summary,
    "discovery_listing": discovery_listing,
    "manifest_limit": manifest_limit,
}


def _head(column: str) -> str:
    unified = f"replace(replace({column}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return f"lower(array_to_string(list_slice(string_split({unified}, chr(10)), 1, 40), chr(10)))"


_PAGES = f"""
  select page_id, path,
    list_contains(parts, 'de') or name = '404' or starts_with(name, '9') or ends_with(name, '7') as is_test,
    name in ('', 'index') as is_setup,
    name in ('100', '200') or ends_with(name, '.html') or contains(head, 'spam-farm')
      or contains(head, '&pound;') or contains(head, 'ad 7') as is_generated,
    parts, name
  from (
    select page_id, path, string_split(path, '/') as parts, list_last(string_split(path, '/')) as name, head
    from (select page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) as path, {_head('html')} as head from pages))
"""
_REASONS = (
    "concat_ws(',', case when is_test then 'test' end, case when is_setup then 'setup' end,"
    " case when is_generated then 'auto-generated' end)"
)
_OUT = "(is_test or is_setup or is_generated)"

ORACLES = {
    "stable_ids": f"""
        select doc_id,
          {hash_sql('d', text('source'), text('lang'), 'doc_id')} as plain_id,
          {hash_sql('n', text('source'), text('lang'), text('lang'), text("'Document'"), text('text'), 'n_chars')} as node_id,
          {hash_sql('n', text('source'), text('lang'), text("'external-symbol'"), text('text'))} as symbol_id,
          {hash_sql('e', text("'CALL'"), text('source'), text('lang'), text('text'))} as edge_id,
          {hash_sql('f', text('source'), text('lang'))} as file_id
        from documents""",
    "source_metadata": f"""
        select doc_id, {hash_sql('f', text('source'), text('doc_id'))} as file_id, sha256(text) as content_sha256,
          (length(text) - length(replace(text, chr(10), ''))
            + case when text = '' or ends_with(text, chr(10)) then 0 else 1 end)::int as loc,
          strlen(text)::bigint as size_bytes
        from documents""",
    "discovery_classify": f"""
        select page_id,
          array_to_string(list_filter(parts, lambda s: s <> '' and s <> '.'), '/') as normal_path,
          not list_contains(parts, '..') as inside,
          length(name) > 5 and ends_with(lower(name), '.html') as is_html,
          {_REASONS} as reasons, {_OUT} as excluded
        from ({_PAGES})""",
    "discovery_markers": f"""
        select doc_id, contains(head, 'mit license') or contains(head, 'all rights reserved')
               or contains(head, 'copyright') as marked
        from (select doc_id, {_head('text')} as head from documents)""",
    "discovery_summary": f"""
        with p as ({_PAGES})
        select 'total_files' as what, count(*) as n from p
        union all select 'kept_files', count(*) from p where not {_OUT}
        union all select 'excluded_files', count(*) from p where {_OUT}
        union all select 'reason:test', count(*) from p where is_test having count(*) > 0
        union all select 'reason:setup', count(*) from p where is_setup having count(*) > 0
        union all select 'reason:auto-generated', count(*) from p where is_generated having count(*) > 0""",
    "discovery_listing": f"select path as file_path, {_REASONS} as reasons from ({_PAGES})",
    "manifest_limit": """
        select doc_id, lang, n_chars from documents
        where doc_id in (select doc_id from labels order by doc_id limit 100)""",
}

ORACLES["discovery_bytes"] = ORACLES["discovery_markers"]
