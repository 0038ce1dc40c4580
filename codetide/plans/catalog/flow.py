"""Order, structure and resolution operators on ordinary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from codetide.functions import ids
from codetide.operators import calls, checks, edges
from codetide.operators.carry import carry, next_value
from codetide.operators.syntax import link_parents, with_occurrence
from codetide.plans.catalog.common import hash_sql, table, text

ROLES = ("user", "assistant", "system")


def document_lines(documents: DataFrame) -> DataFrame:
    """One row per line; a line's peers all lie within one document, that is one input row."""
    return documents.select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )


def occurrence_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(table(spark, sf_dir, "documents"))
    numbered = with_occurrence(lines, ["doc_id", "line"], ["pos"])
    return numbered.select("doc_id", "pos", "line", "occurrence")


def tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region - nation - customer as a tree with hashed ids."""
    node = lambda kind, key: ids.stable_hash("n", kind, ids.Number(F.col(key)))
    regions = table(spark, sf_dir, "region").select("r_regionkey", node("region", "r_regionkey").alias("id"))
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("child_key"), "n_nationkey", "n_regionkey",
        node("nation", "n_nationkey").alias("dst_node_id"), F.lit("nation").alias("child_kind"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("child_key"), "c_nationkey", node("customer", "c_custkey").alias("dst_node_id"),
        F.lit("customer").alias("child_kind"),
    )
    below_region = link_parents(nations, regions, {"n_regionkey": "r_regionkey"}, "id")
    below_nation = link_parents(customers, nations, {"c_nationkey": "n_nationkey"}, "dst_node_id")
    linked = below_region.unionByName(below_nation, allowMissingColumns=True)
    anchor = F.concat_ws(":", "child_kind", "child_key")
    return linked.select(
        "child_kind", "child_key", "src_node_id", "dst_node_id",
        ids.edge_id("AST_CHILD", F.col("src_node_id"), F.col("dst_node_id"), anchor).alias("edge_id"),
    )


def cfg_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn leads to the next of its conversation; a system turn ends the flow."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    ahead = next_value(turns, ["conv_id"], ["turn"], F.col("turn"), "next_turn")
    return ahead.filter((F.col("role") != "system") & F.col("next_turn").isNotNull()).select(
        "conv_id", "turn", "next_turn"
    )


def branch_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next turn of the same role, else whatever turn comes next."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    values = {f"next_{r}": F.when(F.col("role") == r, F.col("turn")) for r in ROLES}
    ahead = carry(turns, ["conv_id"], ["turn"], {**values, "next_any": F.col("turn")}, forward=False)
    same = F.coalesce(*[F.when(F.col("role") == r, F.col(f"next_{r}")) for r in ROLES])
    return ahead.select(
        "conv_id", "turn", same.alias("same_role_turn"), F.coalesce(same, "next_any").alias("follow_turn")
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")


def def_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the user's last sign-up or view before them."""
    defines = F.when(F.col("event_type").isin("signup", "view"), F.col("event_id"))
    seen = carry(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"def_event_id": defines})
    uses = (F.col("event_type") == "purchase") & F.col("def_event_id").isNotNull()
    return seen.filter(uses).select("event_id", "user_id", "def_event_id")


def aug_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``def_use``, but a click both uses the value and defines it anew."""
    defines = F.when(F.col("event_type").isin("signup", "view", "click"), F.col("event_id"))
    seen = carry(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"def_event_id": defines})
    user = F.col("user_id").cast("string")
    anchor = F.when(F.col("event_type") == "click", F.concat(F.lit("aug:"), user)).otherwise(user)
    uses = F.col("event_type").isin("click", "purchase") & F.col("def_event_id").isNotNull()
    return seen.filter(uses).select("event_id", "def_event_id", anchor.alias("anchor"))


def _resolved_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as definitions and calls: full name, brand and name, bare name."""
    names = F.array(
        F.concat_ws(".", "p_brand", "p_type", "p_name"), F.concat_ws(".", "p_brand", "p_name"), F.col("p_name")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", names.alias("names"))
    unique = calls.unique_symbols(parts, [], F.col("names"), "p_partkey")
    return calls.resolve_ranked(parts, unique, [], ["p_partkey"], ["p_name"], "names")


def symbol_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved_parts(spark, sf_dir).select(
        "p_partkey", F.col("definition_id").alias("target_partkey")
    )


def external_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = _resolved_parts(spark, sf_dir).filter(F.col("definition_id").isNull())
    target = outside.select(
        F.lit("parts").alias("repository"),
        F.lit("catalogue").alias("file_path"),
        F.col("p_name").alias("target"),
        ids.external_symbol_id(F.lit("parts"), F.lit("catalogue"), F.col("p_name")).alias("dst_node_id"),
    )
    return calls.external_nodes(target).select(
        "node_id", "node_type", "name", "scope", F.col("properties.resolved").alias("resolved")
    )


def _line_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_returnflag").alias("edge_type"),
        ids.stable_hash("o", ids.Number(F.col("l_orderkey"))).alias("src_node_id"),
        ids.stable_hash("p", ids.Number(F.col("l_partkey"))).alias("dst_node_id"),
        F.col("l_linenumber").cast("string").alias("anchor"),
    )
    edge = ids.edge_id(F.col("edge_type"), F.col("src_node_id"), F.col("dst_node_id"), F.col("anchor"))
    return edges.deduplicate(items.select("l_suppkey", "edge_type", edge.alias("edge_id")), ["l_suppkey"])


def edge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.count_by_type(_line_edges(spark, sf_dir), ["l_suppkey"], types=("A", "N", "R", "X"))


def edges_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.count_by(_line_edges(spark, sf_dir), "edge_type").orderBy("edge_type")


QUERIES = {
    "occurrence_number": occurrence_number,
    "tree_edges": tree_edges,
    "cfg_next": cfg_next,
    "branch_follow": branch_follow,
    "def_use": def_use,
    "aug_flow": aug_flow,
    "symbol_resolve": symbol_resolve,
    "external_symbols": external_symbols,
    "edge_counts": edge_counts,
    "edges_by_type": edges_by_type,
}

_REGION = hash_sql("n", text("'region'"), "r_regionkey")
_NATION = hash_sql("n", text("'nation'"), "n_nationkey")
_CUSTOMER = hash_sql("n", text("'customer'"), "c_custkey")
_TREE_EDGE = hash_sql("e", text("'AST_CHILD'"), text("src_node_id"), text("dst_node_id"),
                      text("child_kind || ':' || child_key"))
_LAST_DEF = """
  select *, last_value(case when {defs} then event_id end ignore nulls) over (
      partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as def_event_id
  from events
"""
_SYMBOLS = """
  with names as (
    select p_partkey, p_name, unnest([p_brand || '.' || p_type || '.' || p_name, p_brand || '.' || p_name, p_name]) as symbol,
           unnest([0, 1, 2]) as rank
    from part),
  single as (select symbol, min(p_partkey) as target from names group by symbol having count(*) = 1),
  resolved as (
    select n.p_partkey, any_value(n.p_name) as p_name, arg_min(s.target, n.rank) filter (where s.target is not null) as target_partkey
    from names n left join single s using (symbol) group by n.p_partkey)
"""
_EDGE = hash_sql("e", text("l_returnflag"), text(hash_sql("o", "l_orderkey")), text(hash_sql("p", "l_partkey")),
                 text("l_linenumber"))
_LINE_EDGES = f"select distinct l_suppkey, l_returnflag as edge_type, {_EDGE} as edge_id from lineitem"

ORACLES = {
    "occurrence_number": """
        select doc_id, pos::int as pos, line,
          (row_number() over (partition by doc_id, line order by pos) - 1)::int as occurrence
        from (select doc_id, unnest(string_split(text, chr(10))) as line,
                     generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)""",
    "tree_edges": f"""
        select *, {_TREE_EDGE} as edge_id from (
          select 'nation' as child_kind, n_nationkey::bigint as child_key, {_REGION} as src_node_id, {_NATION} as dst_node_id
          from nation join region on n_regionkey = r_regionkey
          union all
          select 'customer', c_custkey, {_NATION}, {_CUSTOMER} from customer join nation on c_nationkey = n_nationkey)""",
    "cfg_next": """
        select conv_id, turn, next_turn from (
          select *, lead(turn) over (partition by conv_id order by turn) as next_turn from conversations)
        where role <> 'system' and next_turn is not null""",
    "branch_follow": """
        select conv_id, turn, same_role_turn, coalesce(same_role_turn, next_turn) as follow_turn from (
          select *, lead(turn) over (partition by conv_id, role order by turn) as same_role_turn,
                 lead(turn) over (partition by conv_id order by turn) as next_turn from conversations)""",
    "def_use": f"""
        select event_id, user_id, def_event_id from ({_LAST_DEF.format(defs="event_type in ('signup', 'view')")})
        where event_type = 'purchase' and def_event_id is not null""",
    "aug_flow": f"""
        select event_id, def_event_id,
          case when event_type = 'click' then 'aug:' || user_id else user_id::varchar end as anchor
        from ({_LAST_DEF.format(defs="event_type in ('signup', 'view', 'click')")})
        where event_type in ('click', 'purchase') and def_event_id is not null""",
    "symbol_resolve": f"{_SYMBOLS} select p_partkey, target_partkey from resolved",
    "external_symbols": f"""
        {_SYMBOLS} select distinct
          {hash_sql('n', text("'parts'"), text("'catalogue'"), text("'external-symbol'"), text('p_name'))} as node_id,
          'ExternalSymbol' as node_type, p_name as name, '<external>' as scope, false as resolved
        from resolved where target_partkey is null""",
    "edge_counts": f"""
        select l_suppkey, count(*)::int as edges, (count(*) filter (edge_type = 'A'))::int as a_edges,
          (count(*) filter (edge_type = 'N'))::int as n_edges, (count(*) filter (edge_type = 'R'))::int as r_edges,
          (count(*) filter (edge_type = 'X'))::int as x_edges
        from ({_LINE_EDGES}) group by l_suppkey""",
    "edges_by_type": f"select edge_type, count(*) as n from ({_LINE_EDGES}) group by edge_type order by edge_type",
}
