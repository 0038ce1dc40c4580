"""Views folded from the events table, and the lookups run against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide import contract
from codetide.operators import checks, fold
from codetide.plans.catalog.common import table
from codetide.streaming.views import document_view

ORDER = ["ts", "event_id"]
RING = 200  # edges lead from a user to another one so many numbers on


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def node_events(events: DataFrame) -> DataFrame:
    """Any event describes its user, an error deletes the user."""
    kind = F.when(F.col("event_type") == "error", "gone").otherwise(contract.NODE_UPSERT)
    return events.select(
        *ORDER,
        kind.alias("event_type"),
        contract.event_time(F.col("ts")).alias("event_time"),
        F.concat(F.lit("u"), "user_id").alias("node_id"),
        F.lit("User").alias("node_type"),
        F.col("event_type").alias("name"),
        F.concat(F.lit("users/"), "user_id").alias("file_path"),
        F.when(F.col("event_type") != "view", F.lit("<module>")).alias("scope"),
        F.col("k").alias("start_line"),
        (F.col("k") + 1).alias("end_line"),
        F.lit(0).alias("start_col"),
        F.length("props").alias("end_col"),
        F.create_map(
            F.concat(F.lit("last_"), "event_type"), F.col("event_id").cast("string"),
            F.lit("k"), F.col("k").cast("string"),
            F.lit("high"), F.when(F.col("k") > 50, "yes"),
        ).alias("properties"),
    )


def edge_events(events: DataFrame) -> DataFrame:
    """Clicks and views link two users, a sign-up cuts the link."""
    src = F.concat(F.lit("u"), "user_id")
    dst = F.concat(F.lit("u"), F.pmod(F.col("user_id") + F.col("k"), F.lit(RING)))
    kind = F.when(F.col("event_type").isin("click", "view"), contract.EDGE_UPSERT).otherwise(contract.EDGE_DELETE)
    return events.filter(F.col("event_type").isin("click", "view", "signup")).select(
        *ORDER,
        kind.alias("event_type"),
        contract.event_time(F.col("ts")).alias("event_time"),
        F.concat_ws(">", src, dst).alias("edge_id"),
        F.lit("CALL").alias("edge_type"),
        src.alias("src_node_id"),
        dst.alias("dst_node_id"),
        F.concat(F.lit("users/"), "user_id").alias("file_path"),
    )


def split_topics(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Purchases and errors speak of nodes, the other types of edges."""
    return node_events(events.filter(F.col("event_type").isin("purchase", "error"))), edge_events(events)


def node_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.node_view(fold.node_accumulators(node_events(_events(spark, sf_dir)), None, ORDER))


def property_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = node_events(_events(spark, sf_dir))
    return fold.live_properties(fold.property_accumulators(events, ORDER), fold.node_deletes(events, ORDER))


def graph_rows(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Both halves of a graph view in one shape."""
    none = F.lit(None).cast("string")
    return nodes.select(
        F.lit("node").alias("what"), F.col("node_id").alias("id"), none.alias("src"), none.alias("dst"),
        "name", "updated_at", "is_stub",
    ).unionByName(
        edges.select(
            F.lit("edge").alias("what"), F.col("edge_id").alias("id"), F.col("src_node_id").alias("src"),
            F.col("dst_node_id").alias("dst"), none.alias("name"), "updated_at", F.lit(False).alias("is_stub"),
        )
    )


def graph_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = split_topics(_events(spark, sf_dir))
    return graph_rows(*fold.graph_view(nodes, edges, ORDER))


def graph_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = split_topics(_events(spark, sf_dir))
    return checks.totals(*fold.graph_view(nodes, edges, ORDER))


def doc_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents from the first half of the month, replaced by the second half's."""
    events = _events(spark, sf_dir).withColumn("_id", F.col("user_id").cast("string"))
    first = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    second = events.filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp"))
    keep = ["event_id", "event_type", "k"]
    stored = document_view(first, ORDER, keep)
    return document_view(second, ORDER, keep, stored)


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return fold.latest_by_key(events, ["user_id"], ORDER).select("user_id", "event_id", "event_type")


def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys: line items have some, orders have none."""
    lines = fold.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    orders = fold.duplicates(table(spark, sf_dir, "orders"), ["o_orderkey"])
    return lines.select(
        F.lit("lineitem").alias("table"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("key"), "n"
    ).unionByName(orders.select(F.lit("orders").alias("table"), F.col("o_orderkey").cast("string").alias("key"), "n"))


def top_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    top = checks.top_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 3)
    return top.select("user_id", "event_id", contract.event_time(F.col("ts")).alias("updated_at"), "rank")


def edge_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 300 edges of the folded graph, in id order."""
    nodes, edges = split_topics(_events(spark, sf_dir))
    _, view = fold.graph_view(nodes, edges, ORDER)
    return checks.first_rows(view.select("edge_id", "src_node_id", "dst_node_id"), [F.col("edge_id")], 300)


def lookup_and_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document by its key next to the number of documents."""
    docs = latest_event(spark, sf_dir)
    one = docs.filter(F.col("user_id") == 7).select(F.lit("user 7").alias("what"), F.col("event_id").alias("n"))
    return one.unionByName(docs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("documents").alias("what"), "n"))


QUERIES = {
    "node_fold": node_fold,
    "property_merge": property_merge,
    "graph_fold": graph_fold,
    "graph_totals": graph_totals,
    "doc_replace": doc_replace,
    "latest_event": latest_event,
    "uniqueness": uniqueness,
    "top_updates": top_updates,
    "edge_sample": edge_sample,
    "lookup_and_count": lookup_and_count,
}

_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')"
_EVENTS = f"""
  ev as (select *, json_extract(props, '$.k')::int as k, row_number() over (order by ts, event_id) as seq,
           {_TIME} as iso, 'u' || user_id as uid from events)
"""
GRAPH_SQL = f"""
with {_EVENTS},
  node_ev as (select * from ev where event_type in ('purchase', 'error')),
  edge_ev as (select *, uid as src, 'u' || ((user_id + k) % {RING}) as dst, event_type <> 'signup' as up
              from ev where event_type in ('click', 'view', 'signup')),
  gone as (select uid, max(seq) as seq from node_ev where event_type = 'error' group by uid),
  up as (select uid, max(seq) as seq, arg_max(event_type, seq) as name, arg_max(iso, seq) as iso
         from node_ev where event_type <> 'error' group by uid),
  touch as (select uid, max(seq) as seq from (
              select src as uid, seq from edge_ev where up union all select dst, seq from edge_ev where up) group by uid),
  state as (select uid, coalesce(up.seq, 0) as u, coalesce(gone.seq, 0) as g, coalesce(touch.seq, 0) as t, up.name, up.iso
            from up full join gone using (uid) full join touch using (uid)),
  nodes as (select uid, u > g as real, name, iso from state where greatest(u, t) > g),
  last_edge as (select src || '>' || dst as id, src, dst, arg_max(up, seq) as up, arg_max(iso, seq) as iso, max(seq) as seq
                from edge_ev group by src, dst),
  edges as (select * from last_edge e where up
            and not exists (select 1 from gone where gone.uid in (e.src, e.dst) and gone.seq > e.seq))
"""
GRAPH_ROWS_SQL = """
select 'node' as what, uid as id, null::varchar as src, null::varchar as dst, case when real then name end as name,
  case when real then iso end as updated_at, not real as is_stub from nodes
union all
select 'edge', id, src, dst, null, iso, false from edges
"""

ORACLES = {
    "node_fold": f"""
        with {_EVENTS}
        select uid as node_id, 'User' as node_type, event_type as name, 'users/' || user_id as file_path,
          case when event_type <> 'view' then '<module>' end as scope, k as start_line, k + 1 as end_line,
          0 as start_col, length(props)::int as end_col, iso as updated_at, false as is_stub
        from ev qualify row_number() over (partition by user_id order by seq desc) = 1 and event_type <> 'error'""",
    "property_merge": f"""
        with {_EVENTS},
          written as (
            select uid, seq, 'last_' || event_type as property, event_id::varchar as value from ev where event_type <> 'error'
            union all select uid, seq, 'k', k::varchar from ev where event_type <> 'error'
            union all select uid, seq, 'high', case when k > 50 then 'yes' end from ev where event_type <> 'error'),
          gone as (select uid, max(seq) as seq from ev where event_type = 'error' group by uid),
          latest as (select * from written qualify row_number() over (partition by uid, property order by seq desc) = 1)
        select uid as node_id, property, value from latest left join gone using (uid)
        where value is not null and latest.seq > coalesce(gone.seq, 0)""",
    "graph_fold": GRAPH_SQL + GRAPH_ROWS_SQL,
    "graph_totals": GRAPH_SQL + """
        select 'nodes' as what, count(*) as n from nodes union all select 'edges', count(*) from edges""",
    "doc_replace": f"""
        with {_EVENTS}
        select user_id::varchar as _id, event_id, event_type, k from ev
        qualify row_number() over (partition by user_id order by seq desc) = 1""",
    "latest_event": """
        select user_id, event_id, event_type from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "uniqueness": """
        select 'lineitem' as "table", l_orderkey || '/' || l_linenumber as key, count(*) as n
        from lineitem group by l_orderkey, l_linenumber having count(*) > 1
        union all
        select 'orders', o_orderkey::varchar, count(*) from orders group by o_orderkey having count(*) > 1""",
    "top_updates": f"""
        select user_id, event_id, {_TIME} as updated_at, rank::int as rank from (
          select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rank from events)
        where rank <= 3""",
    "edge_sample": GRAPH_SQL + """
        select id as edge_id, src as src_node_id, dst as dst_node_id from edges order by id limit 300""",
    "lookup_and_count": """
        with latest as (select user_id, event_id from events
          qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
        select 'user 7' as what, event_id as n from latest where user_id = 7
        union all select 'documents', count(*) from latest""",
}
