"""Incremental runs over two revisions of the documents.

Revision 1 is the table as it is.  In revision 2 every German document of more
than one line has lost its first line, and where that had an odd number of characters a byte
that is no text has come in at the end.  The run finds such files by their bytes; they fail
and keep their old state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide.functions import ids
from codetide.functions.text import byte_count, line_count
from codetide.operators import changelog, checks, delta
from codetide.operators.control_flow import next_in_block
from codetide.operators.edges import file_metadata
from codetide.operators.syntax import FILE, with_occurrence
from codetide.plans.catalog.common import hash_sql, table, text
from codetide.session import fresh_path, stage
from codetide.sources.state import StateTables

EVENT_TIME = "2024-02-01T00:00:00.000Z"


def _corpus(spark: SparkSession, sf_dir: str, revision: int, damaged: bool = False) -> DataFrame:
    """Documents as files; ``damaged`` lets the byte in that is no text."""
    body = content = F.col("text")
    if revision == 2:
        at = F.locate("\n", body)
        cut = (F.col("lang") == "de") & (at > 0)
        content = F.when(cut, F.substring(body, at + 1, F.length(body))).otherwise(body)
        if damaged:
            odd = cut & (F.pmod(at - 1, F.lit(2)) == 1)
            whole = F.encode(content, "utf-8")
            content = F.when(odd, F.concat(whole, F.unhex(F.lit("FF")))).otherwise(whole).cast("string")
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("repository"),
        F.concat("lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("file_path"),
        content.alias("content"),
        "lang",
    )


@dataclass
class LineGraph:
    nodes: DataFrame
    edges: DataFrame


def _line_graph(corpus: DataFrame) -> LineGraph:
    """Lines as nodes and line order as edges: one file is one input row, so groups stay small."""
    c = F.col
    lines = corpus.select(*FILE, "lang", F.posexplode(F.split("content", "\n")).alias("pos", "line"))
    # one exchange by file serves both windows
    counted = with_occurrence(lines.repartition(*[c(k) for k in FILE]), [*FILE, "line"], ["pos"])
    named = counted.withColumn(
        "node_id", ids.node_id(c("repository"), c("file_path"), c("lang"), "Line", c("line"), c("occurrence"))
    )
    # several branches read the ids: work them out once
    identified = stage(next_in_block(named, FILE, ["pos"], "node_id", "dst_node_id"), "lines")
    nodes = identified.select(
        *FILE,
        "pos",
        "node_id",
        F.lit("Line").alias("node_type"),
        c("line").alias("name"),
        c("lang").alias("scope"),
        (c("pos") + 1).alias("start_line"),
        (c("pos") + 1).alias("end_line"),
        F.lit(0).alias("start_col"),
        F.length("line").alias("end_col"),
        F.struct(F.lit("text").alias("language"), "occurrence").alias("properties"),
    )
    edges = identified.filter("dst_node_id is not null").select(
        *FILE,
        ids.edge_id("CFG", c("node_id"), c("dst_node_id"), "NEXT").alias("edge_id"),
        F.lit("CFG").alias("edge_type"),
        c("node_id").alias("src_node_id"),
        "dst_node_id",
        F.struct(F.lit("NEXT").alias("branch")).alias("properties"),
    )
    return LineGraph(nodes, edges)


@dataclass
class Run:
    compared: DataFrame
    skipped: DataFrame
    errors: DataFrame
    metadata: DataFrame
    old: LineGraph
    new: LineGraph
    removed_nodes: DataFrame
    removed_edges: DataFrame


def _run(spark: SparkSession, sf_dir: str) -> Run:
    """The incremental run from revision 1 to revision 2."""
    before, after = _corpus(spark, sf_dir, 1), _corpus(spark, sf_dir, 2, damaged=True)
    state = before.select(*FILE, ids.content_sha256(F.col("content")).alias("content_sha256"))
    compared = delta.compare_content(after, state)
    todo = delta.changed_only(after, compared)
    readable = F.is_valid_utf8("content")
    failures = todo.filter(~readable).select(
        *FILE,
        ids.content_sha256(F.col("content")).alias("content_sha256"),
        F.lit("UnicodeDecodeError").alias("error_type"),
        F.lit("invalid byte").alias("error_message"),
        F.array(F.lit("UnicodeDecodeError"), F.lit("UnicodeError"), F.lit("ValueError")).alias("error_classes"),
    )
    processed = todo.filter(readable)
    old = _line_graph(before)
    new = _line_graph(processed)
    files = processed.select(
        *FILE,
        line_count(F.col("content")).alias("loc"),
        byte_count(F.col("content")).alias("size_bytes"),
        ids.content_sha256(F.col("content")).alias("content_sha256"),
        F.lit(None).cast("double").alias("parse_duration_ms"),
    )
    metadata = stage(file_metadata(files, new.nodes, new.edges), "metadata")
    return Run(
        compared,
        compared.filter("unchanged"),
        delta.error_rows(failures),
        metadata,
        old,
        new,
        delta.removed_ids(old.nodes, new.nodes, [*FILE, "node_id"], metadata),
        delta.removed_ids(old.edges, new.edges, [*FILE, "edge_id"], metadata),
    )


def skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _corpus(spark, sf_dir, 1), _corpus(spark, sf_dir, 2, damaged=True)
    state = before.select(*FILE, ids.content_sha256(F.col("content")).alias("content_sha256"))
    return delta.compare_content(after, state).select(*FILE, "content_sha256", "unchanged")


def id_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (_line_graph(_corpus(spark, sf_dir, r)) for r in (1, 2))
    out = None
    for what, a, b, key in (("node", old.nodes, new.nodes, "node_id"), ("edge", old.edges, new.edges, "edge_id")):
        for change, df in (
            ("removed", delta.removed_ids(a, b, [*FILE, key])),
            ("added", delta.added_ids(a, b, [*FILE, key])),
        ):
            part = df.select(F.lit(what).alias("what"), F.lit(change).alias("change"), *FILE, F.col(key).alias("id"))
            out = part if out is None else out.unionByName(part)
    return out


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    log = changelog.build_log(
        nodes=run.new.nodes,
        edges=run.new.edges,
        metadata=run.metadata,
        removed_nodes=run.removed_nodes,
        removed_edges=run.removed_edges,
        errors=run.errors,
        run_id=2,
        event_time=F.lit(EVENT_TIME),
    )
    return changelog.with_sequence(log).select(
        *FILE, "seq", "topic", "key", changelog.message_value(log).alias("value")
    )


def state_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node state after two committed runs; the second covers only what it processed."""
    run = _run(spark, sf_dir)
    before = _corpus(spark, sf_dir, 1).select(*FILE, ids.content_sha256(F.col("content")).alias("content_sha256"))
    state = StateTables(spark, fresh_path(spark, "state"))
    state.commit(1, before, run.old.nodes, run.old.edges)
    state.commit(2, run.metadata, run.new.nodes, run.new.edges)
    return state.ids("nodes")


def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    return delta.file_outcomes(run.metadata, run.removed_nodes, run.removed_edges, run.errors, run.skipped)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.run_summary(file_outcomes(spark, sf_dir))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (_line_graph(_corpus(spark, sf_dir, r)).nodes for r in (1, 2))
    key = [*FILE, "node_id"]
    return checks.reconcile(old, delta.removed_ids(old, new, key), delta.added_ids(old, new, key), new, FILE)


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sorted into error classes by plain predicates."""
    c = F.col
    classes = (
        F.when(c("text").contains("|"), F.array(F.lit("IndentationError"), F.lit("SyntaxError")))
        .when(~c("text").contains("\n"), F.array(F.lit("UnicodeDecodeError"), F.lit("UnicodeError"), F.lit("ValueError")))
        .when(c("lang") == "de", F.array(F.lit("PermissionError"), F.lit("OSError")))
        .when(c("lang") == "es", F.array(F.lit("RecursionError"), F.lit("RuntimeError")))
    )
    failures = (
        table(spark, sf_dir, "documents")
        .withColumn("error_classes", classes)
        .filter(c("error_classes").isNotNull())
        .select(
            c("source").alias("repository"),
            c("doc_id").cast("string").alias("file_path"),
            ids.content_sha256(c("text")).alias("content_sha256"),
            F.element_at("error_classes", 1).alias("error_type"),
            F.concat_ws(" ", "lang", "n_chars").alias("error_message"),
            "error_classes",
        )
    )
    return delta.error_rows(failures)


QUERIES = {
    "skip_unchanged": skip_unchanged,
    "id_diff": id_diff,
    "change_log": change_log,
    "state_commit": state_commit,
    "file_outcomes": file_outcomes,
    "run_summary": run_summary,
    "reconcile": reconcile,
    "error_events": error_events,
}

_NODE = hash_sql("n", text("repository"), text("file_path"), text("lang"), text("'Line'"), text("line"), "occurrence")
_EDGE = hash_sql("e", text("'CFG'"), text("src_node_id"), text("dst_node_id"), text("'NEXT'"))


def _revision(n: int) -> str:
    return f"""
  l{n} as (select repository, file_path, lang, unnest(string_split(t{n}, chr(10))) as line,
             generate_subscripts(string_split(t{n}, chr(10)), 1) - 1 as pos from docs),
  n{n} as (select *, {_NODE} as node_id from (
             select *, row_number() over (partition by repository, file_path, line order by pos) - 1 as occurrence from l{n})),
  e{n} as (select *, {_EDGE} as edge_id from (
             select repository, file_path, node_id as src_node_id,
               lead(node_id) over (partition by repository, file_path order by pos) as dst_node_id from n{n})
           where dst_node_id is not null)"""


_BASE = f"""
with docs as (
  select source as repository, lang || '/' || doc_id || '.txt' as file_path, lang, doc_id, text as t1,
    case when lang = 'de' and contains(text, chr(10)) then substr(text, strpos(text, chr(10)) + 1) else text end as t2,
    lang = 'de' and contains(text, chr(10)) and (strpos(text, chr(10)) - 1) % 2 = 1 as damaged
  from documents),
  bytes as (select *, case when damaged then sha256(encode(t2) || '\\xFF'::blob) else sha256(t2) end as sha2 from docs),
  facts as (select *, sha256(t1) <> sha2 as changed, damaged as failed from bytes),
  done as (select * from facts where changed and not failed),
  {_revision(1)}, {_revision(2)},
  nn as (select n2.* from n2 semi join done using (repository, file_path)),
  en as (select e2.* from e2 semi join done using (repository, file_path)),
  rn as (select n1.* from n1 semi join done using (repository, file_path) where not exists (
           select 1 from n2 where n2.repository = n1.repository and n2.file_path = n1.file_path and n2.node_id = n1.node_id)),
  re as (select e1.* from e1 semi join done using (repository, file_path) where not exists (
           select 1 from e2 where e2.repository = e1.repository and e2.file_path = e1.file_path and e2.edge_id = e1.edge_id))
"""


def _absent(kind: str, key: str, a: int, b: int) -> str:
    return f"""select x.* from {kind}{a} x anti join {kind}{b} y
      on x.repository = y.repository and x.file_path = y.file_path and x.{key} = y.{key}"""


_HEAD = f"'{{\"schema_version\":\"1.0.0\",\"event_time\":\"{EVENT_TIME}\",\"event_type\":\""


def _message(kind: str, *fields: str) -> str:
    """JSON text of an event: envelope, file path, then ``fields`` (SQL texts ready to join)."""
    return f"{_HEAD}{kind}\",\"file_path\":' || to_json(file_path)::varchar" + "".join(f" || {f}" for f in fields) + " || '}'"


def _json(name: str, expr: str) -> str:
    return f"',\"{name}\":' || to_json({expr})::varchar"


_ERROR_ID = hash_sql(
    "err", text("repository"), text("file_path"), text("content_sha256"), text("stage"), text("error_type"), text("error_message")
)
_STACK = hash_sql("stack", text("error_type"), text("error_message"), text("stage"))
_FILE_ID = hash_sql("f", text("repository"), text("file_path"))

_LOG = f"""{_BASE},
  md as (select d.repository, d.file_path, t2, {_FILE_ID} as file_id, sha256(t2) as content_sha256,
           (length(t2) - length(replace(t2, chr(10), '')) + case when t2 = '' or ends_with(t2, chr(10)) then 0 else 1 end) as loc,
           strlen(t2) as size_bytes,
           (select count(*) from nn where nn.repository = d.repository and nn.file_path = d.file_path) as n_nodes,
           (select count(*) from en where en.repository = d.repository and en.file_path = d.file_path) as n_edges
         from done d),
  er as (select *, {_ERROR_ID} as error_id, {_STACK} as stack_hash from (
           select repository, file_path, sha2 as content_sha256, 'UnicodeDecodeError' as error_type, 'invalid byte' as error_message,
                  'decode' as stage from facts where failed)),
  log as (
    select repository, file_path, 0 as phase, null as pos, edge_id as id, 'cpg.edge.events' as topic, src_node_id as key,
      {_message('edge_delete', _json('edge_id', 'edge_id'), _json('src_node_id', 'src_node_id'))} as value from re
    union all
    select repository, file_path, 1, null, node_id, 'cpg.node.events', file_path,
      {_message('node_delete', _json('node_id', 'node_id'))} from rn
    union all
    select repository, file_path, 2, pos, node_id, 'cpg.node.events', file_path,
      {_message('node_upsert', _json('node_id', 'node_id'), _json('node_type', "'Line'"), _json('name', 'line'),
                _json('scope', 'lang'), _json('start_line', 'pos + 1'), _json('end_line', 'pos + 1'),
                _json('start_col', '0'), _json('end_col', 'length(line)'),
                "',\"properties\":{\"language\":\"text\",\"occurrence\":' || occurrence || '}'")} from nn
    union all
    select repository, file_path, 3, null, edge_id, 'cpg.edge.events', src_node_id,
      {_message('edge_upsert', _json('edge_id', 'edge_id'), _json('edge_type', "'CFG'"),
                _json('src_node_id', 'src_node_id'), _json('dst_node_id', 'dst_node_id'),
                "',\"properties\":{\"branch\":\"NEXT\"}'")} from en
    union all
    select repository, file_path, 4, null, file_id, 'cpg.source.metadata.events', file_path,
      {_message('source_upsert', _json('repository', 'repository'), _json('language', "'python'"),
                _json('parser', "'python-ast'"), _json('parser_service_version', "'1.0.0'"), _json('file_id', 'file_id'),
                _json('loc', 'loc'), _json('size_bytes', 'size_bytes'), _json('content_sha256', 'content_sha256'),
                "',\"counts\":{\"nodes\":' || n_nodes || ',\"edges\":' || n_edges || ',\"ast_child_edges\":0,\"cfg_edges\":' || n_edges || ',\"dfg_edges\":0,\"call_edges\":0}'")} from md
    union all
    select repository, file_path, 5, null, error_id, 'cpg.parser.error.events', file_path,
      {_message('parse_error', _json('repository', 'repository'), _json('error_id', 'error_id'),
                _json('content_sha256', 'content_sha256'), _json('error_type', 'error_type'),
                _json('error_message', 'error_message'), _json('stage', 'stage'), _json('severity', "'error'"),
                _json('stack_hash', 'stack_hash'))} from er)
"""
_OUTCOMES = f"""{_BASE},
  outcomes as (
    select f.repository, f.file_path,
      case when not changed then 'skipped' when failed then 'failed' else 'succeeded' end as status,
      coalesce(nc, 0) as nodes, coalesce(ec, 0) as edges, coalesce(dn, 0) as deleted_nodes, coalesce(de, 0) as deleted_edges,
      case when failed then 'invalid byte' end as error
    from facts f
    left join (select repository, file_path, count(*) as nc from nn group by all) using (repository, file_path)
    left join (select repository, file_path, count(*) as ec from en group by all) using (repository, file_path)
    left join (select repository, file_path, count(*) as dn from rn group by all) using (repository, file_path)
    left join (select repository, file_path, count(*) as de from re group by all) using (repository, file_path))
"""

ORACLES = {
    "skip_unchanged": f"{_BASE} select repository, file_path, sha2 as content_sha256, not changed as unchanged from facts",
    "id_diff": f"""{_BASE}
        select 'node' as what, 'removed' as change, repository, file_path, node_id as id from ({_absent('n', 'node_id', 1, 2)})
        union all select 'node', 'added', repository, file_path, node_id from ({_absent('n', 'node_id', 2, 1)})
        union all select 'edge', 'removed', repository, file_path, edge_id from ({_absent('e', 'edge_id', 1, 2)})
        union all select 'edge', 'added', repository, file_path, edge_id from ({_absent('e', 'edge_id', 2, 1)})""",
    "change_log": f"""{_LOG}
        select repository, file_path,
          row_number() over (partition by repository, file_path order by phase, pos nulls last, id)::int as seq,
          topic, key, value from log""",
    "state_commit": f"""{_BASE}
        select n1.repository, n1.file_path, n1.node_id from n1 anti join done using (repository, file_path)
        union all select repository, file_path, node_id from nn""",
    "file_outcomes": f"{_OUTCOMES} select * from outcomes",
    "run_summary": f"""{_OUTCOMES}
        select count(*) as files_total, count(*) filter (status = 'succeeded') as succeeded,
          count(*) filter (status = 'failed') as failed, count(*) filter (status = 'skipped') as skipped,
          sum(nodes)::bigint as nodes, sum(edges)::bigint as edges, sum(deleted_nodes)::bigint as deleted_nodes,
          sum(deleted_edges)::bigint as deleted_edges, coalesce(bool_or(status = 'failed'), false) as run_failed
        from outcomes""",
    "reconcile": f"""{_BASE},
        parts as (
          select repository, file_path, 1 as b, 0 as r, 0 as a, 0 as f from n1
          union all select repository, file_path, 0, 1, 0, 0 from ({_absent('n', 'node_id', 1, 2)})
          union all select repository, file_path, 0, 0, 1, 0 from ({_absent('n', 'node_id', 2, 1)})
          union all select repository, file_path, 0, 0, 0, 1 from n2)
        select repository, file_path, sum(b)::bigint as before, sum(r)::bigint as removed, sum(a)::bigint as added,
          sum(f)::bigint as after, sum(b) - sum(r) + sum(a) = sum(f) as balanced
        from parts group by repository, file_path""",
    "error_events": f"""
        select repository, file_path, {_ERROR_ID} as error_id, content_sha256, error_type, error_message, stage,
          'error' as severity, {_STACK} as stack_hash
        from (
          select source as repository, doc_id::varchar as file_path, sha256(text) as content_sha256,
            lang || ' ' || n_chars as error_message,
            case when contains(text, '|') then 'IndentationError' when not contains(text, chr(10)) then 'UnicodeDecodeError'
                 when lang = 'de' then 'PermissionError' when lang = 'es' then 'RecursionError' end as error_type,
            case when contains(text, '|') then 'ast_parse' when not contains(text, chr(10)) then 'decode'
                 when lang = 'de' then 'read_source' when lang = 'es' then 'parser_service' end as stage
          from documents)
        where error_type is not null""",
}
