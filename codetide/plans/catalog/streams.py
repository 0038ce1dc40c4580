"""Streaming jobs over events that land in drops."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from codetide import contract
from codetide.operators import checks
from codetide.plans.catalog import folds, messages
from codetide.plans.catalog.common import table
from codetide.session import fresh_path
from codetide.sources.events import ORDER_FIELDS, envelope_line, open_envelopes, read_landed, read_landing, sweep, write_lines
from codetide.sources.files import tree
from codetide.streaming.log import REQUIRED_FIELDS, MessageLog, judged, start_log
from codetide.streaming.views import DocumentSnapshots, GraphSnapshots, document_rows, document_view

CUT = "2024-01-16"
TOPIC = "user.events"
DOCUMENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("at", T.StringType()),
    ]
)
REQUIRED = {**REQUIRED_FIELDS, TOPIC: {"*": ["user_id"]}}


def _before() -> Column:
    return F.col("ts") < F.lit(CUT).cast("timestamp")


def _drop(lines: DataFrame, landing: str, number: int) -> None:
    """Land lines as new files: a file source never rereads a path it has seen."""
    lines.select("line").write.text(f"{landing}/drop={number}")


def _drain(spark: SparkSession, landing: str, log: MessageLog, checkpoint: str, archive: str | None = None) -> list[int]:
    """Consume all that has landed, then stop; returns the batches that ran."""
    arriving = open_envelopes(read_landing(spark, landing, archive=archive))
    query = start_log(arriving, log, checkpoint, required=REQUIRED, once=True)
    query.awaitTermination()
    return [p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0]


def _user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their envelope lines; the microsecond is the run, the event number the phase."""
    events = table(spark, sf_dir, "events")
    value = F.to_json(
        F.struct("user_id", "event_id", "event_type", contract.event_time(F.col("ts")).alias("at"), "props")
    )
    order = {"run_id": F.unix_micros(F.col("ts").cast("timestamp")), "phase": F.col("event_id").cast("int")}
    return events.withColumn("line", envelope_line(F.lit(TOPIC), F.col("user_id").cast("string"), value, order))


def _user_log(spark: SparkSession, sf_dir: str) -> MessageLog:
    """Three starts of one query: a drop, a second drop, and nothing new."""
    lines = _user_lines(spark, sf_dir)
    root = fresh_path(spark, "user-stream")
    log = MessageLog(spark, f"{root}/log", time="at")
    for number, part in ((1, lines.filter(_before())), (2, lines.filter(~_before()))):
        _drop(part, f"{root}/landing", number)
        _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
    idle = _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
    if idle:
        raise RuntimeError(f"a restart without new input ran batches {idle}")
    return log


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document view after both drops."""
    rows = document_rows(_user_log(spark, sf_dir).read([TOPIC]), DOCUMENT, "user_id")
    return document_view(rows, ["batch_id", "at", "event_id"], ["event_id", "event_type", "at"])


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages each batch added to the log."""
    return checks.batch_deltas(_user_log(spark, sf_dir).read([TOPIC]))


def _graph_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node and edge events in the shape of a change log: the microsecond is the run, the event number the phase."""
    nodes, edges = folds.split_topics(folds._events(spark, sf_dir))

    def part(rows: DataFrame, topic: str, key: str, entity: str, group: str) -> DataFrame:
        body = [c for c in rows.columns if c not in (*folds.ORDER, "event_type", "event_time", "file_path")]
        return rows.select(
            "ts", "event_type", "event_time", "file_path",
            F.lit(topic).alias("topic"),
            F.col(key).alias("key"),
            F.lit(contract.SCHEMA_VERSION).alias("schema_version"),
            F.unix_micros(F.col("ts").cast("timestamp")).alias("run_id"),
            F.col("event_id").cast("int").alias("phase"),
            F.lit(None).cast("int").alias("pos"),
            F.col(entity).alias("entity_id"),
            F.struct(*body).alias(group),
        )

    return part(nodes, contract.NODE_TOPIC, "file_path", "node_id", "node").unionByName(
        part(edges, contract.EDGE_TOPIC, "src_node_id", "edge_id", "edge"), allowMissingColumns=True
    )


def stream_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph view from the library's own lines: a snapshot after the first drop, then newer batches.

    The later half of the month lands first, so the fold also meets late events.
    """
    every = _graph_log(spark, sf_dir)
    root = fresh_path(spark, "graph-stream")
    log = MessageLog(spark, f"{root}/log")
    snapshots = GraphSnapshots(spark, f"{root}/snapshots")
    for number, part in ((1, every.filter(~_before())), (2, every.filter(_before()))):
        write_lines(part, f"{root}/landing/drop={number}")
        _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
        if number == 1:
            snapshots.compact(log, 0)
    view_nodes, view_edges, _ = snapshots.view(log)
    return folds.graph_rows(view_nodes, view_edges)


def published_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per topic and key of the lines written: events, and how often one stands before an earlier one."""
    path = f"{fresh_path(spark, 'published')}/lines"
    write_lines(_graph_log(spark, sf_dir), path)
    # a file is read in blocks; inside a block Spark's increasing id counts on
    lines = open_envelopes(read_landed(spark, path)).withColumn("line", F.monotonically_increasing_id())
    placed = lines.select("topic", "key", "source", "block", "line", F.struct(*ORDER_FIELDS).alias("at"))
    before = F.lag("at").over(Window.partitionBy("topic", "key").orderBy("source", "block", "line"))
    return placed.withColumn("down", F.col("at") < before).groupBy("topic", "key").agg(
        F.count("*").alias("events"), F.count_if("down").alias("descents")
    )


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored document view: a snapshot after the first drop, replaced by key with what came later."""
    log = _user_log(spark, sf_dir)
    documents = DocumentSnapshots(spark, fresh_path(spark, "user-documents"), list(ORDER_FIELDS), TOPIC, DOCUMENT, "user_id")
    documents.compact(log, 0)
    return documents.view(log).select("_id", "event_id", "event_type", "at")


def _bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as envelope lines, of which many cannot be applied; two drops by date.

    Views are told as edge upserts, of which two in three lack an end; purchases lack their user, errors are cut off.
    """
    events = table(spark, sf_dir, "events")
    kind, turn = F.col("event_type"), F.pmod(F.col("event_id"), F.lit(3))
    is_edge = kind == "view"
    edge = F.to_json(
        F.struct(
            F.lit(contract.EDGE_UPSERT).alias("event_type"),
            F.col("event_id").cast("string").alias("edge_id"),
            F.when(turn != 0, F.lit("a")).alias("src_node_id"),
            F.when(turn != 1, F.lit("b")).alias("dst_node_id"),
        )
    )
    value = (
        F.when(is_edge, edge)
        .when(kind == "error", F.lit('{"user_id":'))
        .when(kind == "purchase", F.to_json(F.struct("event_id")))
        .otherwise(F.to_json(F.struct("event_id", "user_id")))
    )
    topic = F.when(is_edge, F.lit(contract.EDGE_TOPIC)).otherwise(F.lit(TOPIC))
    fields = F.struct(topic.alias("topic"), F.col("event_id").cast("string").alias("key"), "run_id", "phase", value.alias("value"))
    # a task writes one file: each line tells the number of its task and its own number in the file
    number = F.monotonically_increasing_id()
    numbered = events.withColumns(
        {"run_id": F.shiftright(number, 33), "phase": (number.bitwiseAND((1 << 33) - 1) + 1).cast("int")}
    )
    return numbered.select("event_id", "ts", F.to_json(fields).alias("line"))


def _bad_log(spark: SparkSession, sf_dir: str) -> tuple[MessageLog, str]:
    """The lines above, drained as one drop, and the folder of the stream."""
    root = fresh_path(spark, "bad-stream")
    log = MessageLog(spark, f"{root}/log")
    _drop(_bad_lines(spark, sf_dir), f"{root}/landing", 1)
    _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
    return log, root


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that cannot be applied end up in the log's dead-letter topic, with a reason."""
    log, _ = _bad_log(spark, sf_dir)
    return log.dead_letters().select(F.col("key").cast("bigint").alias("event_id"), "reason", "source_topic")


def dead_letter_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters with where they stood: whether file and line are those that the line itself tells."""
    log, _ = _bad_log(spark, sf_dir)
    letters = log.dead_letters()
    task = F.regexp_extract("source", r"/drop=1/part-(\d+)", 1).try_cast("bigint")
    return letters.select(
        F.col("key").cast("bigint").alias("event_id"),
        "reason",
        "batch_id",
        F.coalesce(task == F.col("run_id"), F.lit(False)).alias("right_file"),
        F.coalesce(F.col("line") == F.col("phase"), F.lit(False)).alias("right_line"),
        F.col("arrived").isNotNull().alias("has_time"),
    )


def letters_redriven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases get their user back and land again: how often each event is in the log, and whether its letter is open.

    The same re-drive is called twice and a second one names the same letters again.
    """
    log, root = _bad_log(spark, sf_dir)
    letters = log.dead_letters().filter(F.col("reason") == "missing user_id")
    users = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), "event_id", "user_id")
    repaired = letters.join(users, "key").select(
        "letter", F.col("source_topic").alias("topic"), "key", F.to_json(F.struct("event_id", "user_id")).alias("value"), *ORDER_FIELDS
    )
    for number in (1, 1, 2):
        log.redrive(repaired, f"{root}/landing", number)
        _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
    landed = log.read([TOPIC, contract.EDGE_TOPIC]).groupBy("key").agg(F.count("*").alias("landed"))
    waiting = log.dead_letters(open_only=True).groupBy("key").agg(F.count("*").alias("open_letters"))
    none = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    return landed.join(waiting, "key", "full").select(F.col("key").cast("bigint").alias("event_id"), none("landed"), none("open_letters"))


def offset_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last offset of each batch per topic and partition, after its second batch was written again."""
    log = _user_log(spark, sf_dir)
    again = open_envelopes(read_landed(spark, f"{log.root.removesuffix('/log')}/landing/drop=2"))
    log.write_batch(judged(again, REQUIRED), 1)
    keys = ["batch_id", "topic", "partition"]
    seen = log.placed(log.read()).groupBy(*keys).agg(
        F.min("offset").alias("least"), F.max("offset").alias("most"), F.count_distinct("offset").alias("different")
    )
    dense = (F.col("least") == F.col("first_offset")) & (F.col("most") == F.col("last_offset")) & (F.col("different") == F.col("messages"))
    return log.offsets().join(seen, keys, "left").select(
        *keys, "first_offset", "last_offset", "messages", F.coalesce(dense, F.lit(False)).alias("dense")
    )


def compacted_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph view after four drops, the latest first, with a compaction by buckets after each of the first three."""
    every = _graph_log(spark, sf_dir)
    root = fresh_path(spark, "compacted-stream")
    log = MessageLog(spark, f"{root}/log")
    snapshots = GraphSnapshots(spark, f"{root}/snapshots")
    for number, (begin, end) in enumerate(((23, 32), (15, 23), (8, 15), (1, 8))):
        day = F.dayofmonth("ts")
        write_lines(every.filter((day >= begin) & (day < end)), f"{root}/landing/drop={number}")
        _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
        if number < 3:
            snapshots.compact(log, number)
            snapshots.vacuum()
            log.expire(number)
    view_nodes, view_edges, _ = snapshots.view(log)
    return folds.graph_rows(view_nodes, view_edges)


def log_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a log of one topic per event type when the days beyond each topic's window are gone."""
    events = table(spark, sf_dir, "events")
    value = F.to_json(F.struct("event_id", "user_id", contract.event_time(F.col("ts")).alias("event_time")))
    line = envelope_line(F.col("event_type"), F.col("user_id").cast("string"), value)
    root = fresh_path(spark, "aged-stream")
    log = MessageLog(spark, f"{root}/log")
    # both batches hold old and new days
    for number, odd in enumerate((False, True)):
        _drop(events.filter((F.pmod("user_id", F.lit(2)) == 1) == odd).select(line.alias("line")), f"{root}/landing", number)
        _drain(spark, f"{root}/landing", log, f"{root}/checkpoint")
    log.expire_days(datetime.datetime.fromisoformat(messages.NOW), messages.RETENTION)
    return log.read().select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), F.col("topic").alias("event_type"), "batch_id")


def landing_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document view of three drops and a restart whose consumed files were archived; the landing folder is empty."""
    lines = _user_lines(spark, sf_dir)
    root = fresh_path(spark, "archived-stream")
    landing, archive = f"{root}/landing", f"{root}/archive"
    log = MessageLog(spark, f"{root}/log", time="at")
    for number, (begin, end) in enumerate(((1, 11), (11, 21), (21, 32))):
        day = F.dayofmonth("ts")
        _drop(lines.filter((day >= begin) & (day < end)), landing, number)
        _drain(spark, landing, log, f"{root}/checkpoint", archive)
    if _drain(spark, landing, log, f"{root}/checkpoint", archive):
        raise RuntimeError("a restart without new input ran a batch")
    sweep(spark, landing, archive, log.pieces())
    kept, left = len(tree(spark, archive)), tree(spark, landing)
    consumed = log.pieces().select("source").distinct().count()
    if left or kept < consumed:
        raise RuntimeError(f"{len(left)} files still land, {kept} of {consumed} are archived")
    rows = document_rows(log.read([TOPIC]), DOCUMENT, "user_id")
    return document_view(rows, list(ORDER_FIELDS), ["event_id", "event_type", "at"])


QUERIES = {
    "stream_resume": stream_resume,
    "stream_batches": stream_batches,
    "stream_graph": stream_graph,
    "published_order": published_order,
    "stored_documents": stored_documents,
    "stream_dead_letters": stream_dead_letters,
    "dead_letter_context": dead_letter_context,
    "letters_redriven": letters_redriven,
    "offset_deltas": offset_deltas,
    "compacted_graph": compacted_graph,
    "log_expiry": log_expiry,
    "landing_archive": landing_archive,
}

_REASON_SQL = """case when event_type = 'error' then 'malformed' when event_type = 'purchase' then 'missing user_id'
               when event_id % 3 = 0 then 'missing src_node_id' else 'missing dst_node_id' end"""
_BAD_SQL = "(event_type in ('error', 'purchase') or (event_type = 'view' and event_id % 3 < 2))"
_LATEST_SQL = """
    select user_id::varchar as _id, event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as at from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""

ORACLES = {
    "stream_resume": _LATEST_SQL,
    "stored_documents": _LATEST_SQL,
    "landing_archive": _LATEST_SQL,
    "published_order": f"""
        select topic, key, count(*) as events, 0::bigint as descents
        from (select case when event_type in ('purchase', 'error') then '{contract.NODE_TOPIC}' else '{contract.EDGE_TOPIC}' end as topic,
                     case when event_type in ('purchase', 'error') then 'users/' else 'u' end || user_id as key
              from events) group by topic, key""",
    "stream_batches": f"""
        select (case when ts < timestamp '{CUT}' then 0 else 1 end)::bigint as batch_id, count(*) as messages
        from events group by 1""",
    "stream_graph": folds.GRAPH_SQL + folds.GRAPH_ROWS_SQL,
    "compacted_graph": folds.GRAPH_SQL + folds.GRAPH_ROWS_SQL,
    "dead_letter_context": f"""
        select event_id, {_REASON_SQL} as reason, 0::bigint as batch_id, true as right_file, true as right_line, true as has_time
        from events where {_BAD_SQL}""",
    "letters_redriven": f"""
        select event_id, (event_type = 'purchase' or not ({_BAD_SQL}))::bigint as landed,
               (event_type <> 'purchase' and {_BAD_SQL})::bigint as open_letters
        from events""",
    "offset_deltas": f"""
        with counted as (
          select (case when ts < timestamp '{CUT}' then 0 else 1 end)::bigint as batch_id,
                 (('0x' || substr(md5(user_id::varchar), 1, 8))::bigint % 3)::int as partition, count(*)::bigint as messages
          from events group by all
        ), ended as (
          select *, sum(messages) over (partition by partition order by batch_id)::bigint as reached from counted
        )
        select batch_id, '{TOPIC}' as topic, partition, reached - messages as first_offset, reached - 1 as last_offset, messages, true as dense
        from ended""",
    "log_expiry": f"""
        select event_id, event_type, (user_id % 2)::bigint as batch_id from events
        where date_trunc('day', ts) + interval 1 day > timestamp '{messages.NOW}' - to_days(
          case event_type {" ".join(f"when '{t}' then {d}" for t, d in messages.RETENTION.items())} else 36500 end)""",
    "stream_dead_letters": f"""
        select event_id, {_REASON_SQL} as reason, case when event_type = 'view' then '{contract.EDGE_TOPIC}' else '{TOPIC}' end as source_topic
        from events where {_BAD_SQL}""",
}
