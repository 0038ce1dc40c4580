"""Control flow from block structure.

A statement flows to its next sibling.  The last statement of a block flows to
what the block's role says (a loop body back to its loop, a try body to its
``else`` or ``finally``), else to wherever the statement that owns the block
flows, and so on outwards.

Every statement has an address: parent, field of the parent, index in the field.
The flattener records with each statement the places of its enclosing blocks,
so where it flows to is an address worked out by a projection, and one join
turns all addresses of all edges into ids.  No recursion, no repeated joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from codetide.operators.syntax import FILE, lookup

# fixed values: which statements open blocks, and what their blocks mean
LOOPS = ("For", "AsyncFor", "While")
WITHS = ("With", "AsyncWith")
LOOP_BODIES = tuple(f"{loop}.body" for loop in LOOPS)
BLOCK_ROLES = (
    "If.body",
    "If.orelse",
    *LOOP_BODIES,
    *(f"{loop}.orelse" for loop in LOOPS),
    *(f"{w}.body" for w in WITHS),
    "Try.body",
    "Try.handlers",
    "Try.orelse",
    "Try.finalbody",
    "ExceptHandler.body",
)
SILENT = ("Return", "Raise")


def next_in_block(df: DataFrame, block: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The following row of the same block, null at its end."""
    return df.withColumn(name, F.lead(value).over(Window.partitionBy(*block).orderBy(*order)))


def flow_rows(rows: DataFrame) -> DataFrame:
    """Statements and handlers that take part in control flow.

    Blocks of kinds outside ``BLOCK_ROLES`` (match cases, ``except*``) stay opaque,
    as do lambda bodies, which hold no statements.
    """
    known = F.forall("path", lambda p: p["role"].isin(*BLOCK_ROLES))
    return rows.filter(F.col("path").isNotNull() & known)


def flow_statements(rows: DataFrame) -> DataFrame:
    """What control flow needs of its statements and handlers."""
    return flow_rows(rows).select(
        *FILE, "pos", "parent_pos", "field", "idx", "kind", "node_id", "is_last", "has_else", "has_final", "path"
    )


# The address arithmetic is SQL text: one expression per branch of the rule table, and
# one call to build each, where column objects would take hundreds.
def _in(names: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _address(parent: str, field: str, idx: str) -> str:
    return f"named_struct('parent_pos', {parent}, 'field', {field}, 'idx', {idx})"


def _own(place: str) -> str:
    """Address of the owner of a block, or of the loop a statement sits in."""
    return _address(f"{place}.parent_pos", f"{place}.field", f"{place}.idx")


def _sibling(place: str = "") -> str:
    """Address of the statement after ``place``; null when it is the last of its block."""
    dot = f"{place}." if place else ""
    return f"if({dot}is_last, null, {_address(f'{dot}parent_pos', f'{dot}field', f'{dot}idx + 1')})"


def _first(pos: str, field: str) -> str:
    return _address(pos, f"'{field}'", "0")


# Where the end of an enclosing block b leads, before asking further out.  A handler's
# neighbour is another handler, never a target: its try decides.
_LEAVING = f"""
  case
    when b.role in {_in(LOOP_BODIES)} then {_own('b')}
    when b.role = 'ExceptHandler.body' then null
    when b.role = 'Try.body' and b.has_else then {_first('b.pos', 'orelse')}
    when b.role in ('Try.body', 'Try.orelse', 'Try.handlers') and b.has_final then {_first('b.pos', 'finalbody')}
    else {_sibling('b')}
  end"""


def _outwards(path: str) -> str:
    """The first answer from the enclosing blocks, innermost first."""
    return f"try_element_at(filter(transform({path}, b -> {_LEAVING}), a -> a is not null), 1)"


_PLACES = {
    # where a statement flows on to
    "follow": f"coalesce(if(kind = 'ExceptHandler', null, {_sibling()}), {_outwards('path')})",
    "else_or_follow": f"if(has_else, {_first('pos', 'orelse')}, follow)",
    "body": _first("pos", "body"),
    # depth and block of the innermost loop body around a statement
    "depth": f"cast(array_position(transform(path, b -> b.role in {_in(LOOP_BODIES)}), true) as int)",
    "loop": "try_element_at(path, nullif(depth, 0))",
    "after_loop": f"coalesce({_sibling('loop')}, {_outwards('slice(path, depth + 1, size(path))')})",
    "head": "try_element_at(path, 1)",
}


def _link(to: str, label: str, into: bool = False) -> str:
    return f"named_struct('to', {to}, 'branch', '{label}', 'into', {str(into).lower()})"


_LINKS = f"""
  case
    when kind = 'If' then array({_link('body', 'TRUE')}, {_link('else_or_follow', 'FALSE')})
    when kind in {_in(LOOPS)} then array({_link('body', 'LOOP_BODY')}, {_link('else_or_follow', 'LOOP_EXIT')})
    when kind in {_in(WITHS)} then array({_link('body', 'ENTER')})
    when kind = 'Try' then array({_link('body', 'TRY')})
    when kind = 'ExceptHandler' then array({_link(_own('head'), 'EXCEPT', into=True)}, {_link('body', 'HANDLE')})
    when kind = 'Break' and depth > 0 then array({_link('after_loop', 'BREAK')})
    when kind = 'Continue' and depth > 0 then array({_link(_own('loop'), 'CONTINUE')})
    when kind not in {_in(('Break', 'Continue', *SILENT))} then array({_link('follow', 'NEXT')})
  end"""


# a statement's own address, among its links
_HERE = f"array(named_struct('to', {_address('parent_pos', 'field', 'idx')}, 'branch', cast(null as string), 'into', false))"


def flow_addresses(statements: DataFrame, links: str = _LINKS) -> DataFrame:
    """One row per edge: own id, address of the other end, branch, and which end is the source."""
    for name, sql in _PLACES.items():
        statements = statements.withColumn(name, F.expr(sql))
    return (
        statements.select(*FILE, "node_id", F.explode(F.expr(links)).alias("l"))
        .select(*FILE, "node_id", "l.to.*", "l.branch", "l.into")
        .filter(F.col("parent_pos").isNotNull())
    )


def local_flow_edges(rows: DataFrame) -> DataFrame:
    """``control_flow_edges`` where a file's key is its own: one pass over ``rows``, one shuffle.

    Statements and the links that lead to them meet in a group per address.  ``node_id`` may be any value.
    """
    c = F.col
    met = flow_addresses(flow_statements(rows), f"concat({_HERE}, coalesce({_LINKS}, array()))")
    address = [*FILE, "parent_pos", "field", "idx"]
    at = Window.partitionBy(F.xxhash64(*address), *address)
    found = met.withColumn("other_id", F.max(F.when(c("branch").isNull(), c("node_id"))).over(at))
    return _oriented(found.filter(c("branch").isNotNull() & c("other_id").isNotNull()))


def control_flow_edges(rows: DataFrame) -> DataFrame:
    """CFG edges; an address that holds no statement gives none."""
    c = F.col
    statements = flow_statements(rows)
    where = statements.select(*FILE, "parent_pos", "field", "idx", c("node_id").alias("other_id"))
    return _oriented(lookup(flow_addresses(statements), where, [*FILE, "parent_pos", "field", "idx"]))


def _oriented(found: DataFrame) -> DataFrame:
    c = F.col
    return found.select(
        *FILE,
        F.lit("CFG").alias("edge_type"),
        F.when(c("into"), c("other_id")).otherwise(c("node_id")).alias("src_node_id"),
        F.when(c("into"), c("node_id")).otherwise(c("other_id")).alias("dst_node_id"),
        c("branch").alias("anchor"),
        "branch",
    )
