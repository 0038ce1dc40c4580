"""Envelopes, decoding, routing, retention, dead letters, on the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from codetide import contract
from codetide.operators import checks
from codetide.plans.catalog.common import table
from codetide.sources.events import bad_message_reason, decode, envelope_line, retained

PROPS = T.StructType([T.StructField("k", T.IntegerType())])
# an event stream of our own: type -> (topic, key column)
ROUTES = {
    "signup": ("users", "user_id"),
    "view": ("activity", "user_id"),
    "click": ("activity", "user_id"),
    "purchase": ("sales", "event_id"),
    "error": ("faults", "user_id"),
}
EXPECTED_TOPICS = ("activity", "audit", "faults", "sales", "users")
RETENTION = {"view": 7, "click": 7, "purchase": 14, "error": 21}
NOW = "2024-01-31 00:00:00"


def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    payload = events.select("event_id", F.col("props").cast("binary").alias("value"))
    rows = decode(payload, PROPS).filter(F.col("k").isNotNull())
    return rows.select(F.col("k").cast("string").alias("_id"), "event_id", "k")


def event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    head = contract.envelope(F.col("event_type"), contract.event_time(F.col("ts")))
    return events.select("event_id", *head)


def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that break a contract which knows no ``error`` and needs a decodable file path."""
    events = table(spark, sf_dir, "events")
    path = F.concat(F.lit("u/"), F.get_json_object("props", "$.k"))
    head = contract.envelope(F.col("event_type"), contract.event_time(F.col("ts")))
    rows = events.select("event_id", *head, path.alias("file_path"))
    bad = contract.violations(rows, ("signup", "view", "click", "purchase"))
    return bad.select("event_id", "event_type", "event_time")


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    key = contract.key_of(kind, ROUTES)
    return events.select(
        "event_id",
        contract.topic_of(kind, ROUTES).alias("topic"),
        key.alias("key"),
        contract.key_partition(key).alias("partition"),
    )


def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.batch_deltas(_routed(spark, sf_dir), "topic", ["partition"])


def topic_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = spark.createDataFrame([(t,) for t in EXPECTED_TOPICS], "topic string")
    return checks.missing_topics(expected, _routed(spark, sf_dir))


def key_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key with its partition; lowest and highest are equal when a key never moves."""
    routed = _routed(spark, sf_dir)
    return routed.groupBy("topic", "key").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("partition").alias("partition"),
        (F.max("partition") - F.min("partition") + 1).alias("partitions_used"),
    )


def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    kept = retained(events, F.lit(NOW).cast("timestamp"), RETENTION, time="ts", topic="event_type")
    return kept.select("event_id", "event_type")


def dlq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads damaged by type: cut short for errors, without the key for purchases."""
    events = table(spark, sf_dir, "events")
    props = F.col("props")
    damaged = (
        F.when(F.col("event_type") == "error", F.substring(props, F.lit(1), F.length(props) - 1))
        .when(F.col("event_type") == "purchase", F.replace(props, F.lit('"k"'), F.lit('"x"')))
        .otherwise(props)
    )
    parsed = decode(events.select("event_id", damaged.alias("raw"), damaged.alias("value")), PROPS)
    judged = parsed.withColumn("reason", bad_message_reason(F.col("raw"), F.col("k")))
    good = F.col("reason").isNull()
    return judged.select(
        "event_id", F.when(good, "good").otherwise("bad").alias("status"), "reason", F.when(good, F.col("k")).alias("k")
    )


def envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    head = contract.envelope(F.col("event_type"), contract.event_time(F.col("ts")))
    value = F.to_json(F.struct(*head, "event_id", "user_id"))
    kind = F.col("event_type")
    line = envelope_line(contract.topic_of(kind, ROUTES), contract.key_of(kind, ROUTES), value)
    return events.select("event_id", line.alias("line"))


QUERIES = {
    "event_decode": event_decode,
    "event_envelope": event_envelope,
    "contract_check": contract_check,
    "topic_route": topic_route,
    "topic_presence": topic_presence,
    "key_partitions": key_partitions,
    "retention_filter": retention_filter,
    "dlq_split": dlq_split,
    "envelope_lines": envelope_lines,
}

_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')"
_TOPIC = (
    "case event_type when 'signup' then 'users' when 'view' then 'activity' when 'click' then 'activity'"
    " when 'purchase' then 'sales' when 'error' then 'faults' end"
)
_KEY = "(case when event_type = 'purchase' then event_id else user_id end)::varchar"
_ROUTED = f"""
  select event_id, topic, key, (('0x' || substr(md5(key), 1, 8))::bigint % 3)::int as partition
  from (select event_id, {_TOPIC} as topic, {_KEY} as key from events)
"""

ORACLES = {
    "event_decode": """
        select k::varchar as _id, event_id, k
        from (select event_id, json_extract(props, '$.k')::int as k from events)
        where k is not null""",
    "event_envelope": f"""
        select event_id, '1.0.0' as schema_version, {_TIME} as event_time, event_type from events""",
    "contract_check": f"""
        select event_id, event_type, {_TIME} as event_time from events
        where event_type not in ('signup', 'view', 'click', 'purchase')
           or json_extract(props, '$.k') is null""",
    "topic_route": f"select topic, partition, count(*) as messages from ({_ROUTED}) group by topic, partition",
    "topic_presence": f"""
        select t.topic, exists (select 1 from ({_ROUTED}) r where r.topic = t.topic) as present
        from (values ('activity'), ('audit'), ('faults'), ('sales'), ('users')) t(topic)""",
    "key_partitions": f"""
        select topic, key, count(*) as messages, min(partition) as partition,
               count(distinct partition)::int as partitions_used
        from ({_ROUTED}) group by topic, key""",
    "retention_filter": f"""
        select event_id, event_type from events
        where ts >= timestamp '{NOW}' - to_days(case event_type when 'view' then 7 when 'click' then 7
                when 'purchase' then 14 when 'error' then 21 else 36500 end)""",
    "dlq_split": """
        select event_id,
               case when event_type in ('error', 'purchase') then 'bad' else 'good' end as status,
               case event_type when 'error' then 'malformed' when 'purchase' then 'missing key' end as reason,
               case when event_type not in ('error', 'purchase') then json_extract(props, '$.k')::int end as k
        from events""",
    "envelope_lines": f"""
        select event_id,
               '{{"topic":"' || {_TOPIC} || '","key":"' || {_KEY} || '","value":{{"schema_version":"1.0.0","event_time":"'
               || {_TIME} || '","event_type":"' || event_type || '","event_id":' || event_id || ',"user_id":'
               || user_id || '}}}}' as line
        from events""",
}
