"""Message streams in and out: landing folders, Kafka, envelopes, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from codetide import contract
from codetide.operators.changelog import message_value
from codetide.sources.files import address, file_path, is_empty, rename, tree

# what puts the events of a key in order, with types; carried beside topic and key
ORDER_FIELDS = {"run_id": "bigint", "phase": "int"}
# where a message comes from: file and start of the block it was read in, or the broker's partition and offset
SOURCE_FIELDS = {"source": "string", "block": "bigint", "source_offset": "bigint"}

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def read_landing(spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """Stream of envelope lines from a folder, with their file and block.  A revision must land as a new file.

    ``archive`` names a folder outside ``path`` that consumed files are moved to, below their own path, so
    that each trigger lists what has not been consumed yet; ``sweep`` moves the ones that a stopped query left.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_place(reader.load(path))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The same lines as an ordinary table: to write a batch again, or to look into a file."""
    return _with_place(spark.read.option("recursiveFileLookup", "true").text(path))


def _with_place(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"))


def sweep(spark: SparkSession, landing: str, archive: str, consumed: DataFrame) -> int:
    """Move files of the landing folder that a log has consumed to the archive, as its reader does; returns how many.

    ``consumed`` has their paths in ``source``.  Only what still lies there is listed and looked up.  An empty file
    holds no message that a log could tell of; it goes too, as files land whole and so it stays empty.
    """
    left = tree(spark, landing)
    if not left:
        return 0
    there = spark.createDataFrame([(path, address(spark, path)) for path in left], "path string, source string")
    reported = consumed.select(F.regexp_replace("source", "^([^:/]+):///+", "$1:/").alias("source"))
    done = [r["path"] for r in there.join(reported, "source", "left_semi").collect()]
    done += [path for path in sorted({*left} - {*done}) if is_empty(spark, path)]
    for path in done:
        rename(spark, path, archive.rstrip("/") + file_path(spark, path))
    return len(done)


def read_kafka(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    """Stream of (topic, key, value, order fields) from a broker; needs the Kafka package on the class path."""
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("includeHeaders", "true")
        .load()
    )
    header = lambda name: F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"].cast("string")
    return source.select("topic", F.col("key").cast("string"), F.col("value").cast("string"),
                         *[header(name).try_cast(kind).alias(name) for name, kind in ORDER_FIELDS.items()],
                         F.concat_ws("/", "topic", F.col("partition").cast("string")).alias("source"),
                         F.col("offset").alias("source_offset"))


def open_envelopes(lines: DataFrame, column: str = "value", extra: dict[str, str] | None = None) -> DataFrame:
    """Envelope text to (topic, key, value); ``value`` stays JSON text.

    ``extra`` names further top-level fields, with their types; left out, the
    order fields that ``write_lines`` puts there.  The source fields of ``lines`` come along.
    """
    text = F.col(column).cast("string")
    extra = ORDER_FIELDS if extra is None else extra
    return lines.select(
        *[F.get_json_object(text, f"$.{name}").alias(name) for name in ("topic", "key", "value")],
        *[F.get_json_object(text, f"$.{name}").try_cast(kind).alias(name) for name, kind in extra.items()],
        *[name for name in SOURCE_FIELDS if name in lines.columns],
    )


def decode(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text or bytes to the columns of ``schema``.

    Unknown fields are dropped, a wrong-typed field becomes null, a malformed
    message becomes a row of nulls.  A field takes the place of a column of its name.
    """
    parsed = F.from_json(F.col(column).cast("string"), schema)
    return messages.withColumn("data", parsed).select(
        *[c for c in messages.columns if c not in schema.names], "data.*"
    )


def split_bad(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the reason (null reason = good)."""
    tagged = df.withColumn("reason", reason)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def bad_message_reason(value: Column, parsed_key: Column) -> Column:
    """Why a message cannot be applied: no JSON object, or no key in it."""
    is_object = F.coalesce(F.try_parse_json(value).isNotNull(), F.lit(False))
    return F.when(~is_object, F.lit("malformed")).when(parsed_key.isNull(), F.lit("missing key"))


def missing_field(topic: Column, value: Column, required: dict[str, dict[str, list[str]]]) -> Column:
    """``missing <field>`` for the first field that an event lacks, else null.

    ``required`` names fields per topic and event type; type ``*`` stands for any.
    """
    reason = F.lit(None).cast("string")
    kind = F.get_json_object(value, "$.event_type")
    needs = [(t, k, field) for t, by_type in required.items() for k, fields in by_type.items() for field in fields]
    for name, event_type, field in reversed(needs):
        applies = (topic == name) & (F.lit(True) if event_type == "*" else F.coalesce(kind == event_type, F.lit(False)))
        absent = F.get_json_object(value, f"$.{field}").isNull()
        reason = F.when(applies & absent, F.lit(f"missing {field}")).otherwise(reason)
    return reason


def envelope_line(topic: Column, key: Column, value: Column, extra: dict[str, Column] | None = None) -> Column:
    """``{"topic":…,"key":…,"value":…}`` with the JSON text of ``value`` put in as it stands."""
    more = [column.alias(name) for name, column in (extra or {}).items()]
    head = F.to_json(F.struct(topic.alias("topic"), key.alias("key"), *more))
    return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"value":'), value, F.lit("}"))


def _in_order(log: DataFrame, spread) -> DataFrame:
    """Rows sorted by topic, key and the order of the key's events, after ``spread`` has dealt them."""
    return spread(log).sortWithinPartitions("topic", "key", *ORDER_FIELDS, "pos", "entity_id")


def envelope_lines(log: DataFrame) -> DataFrame:
    """One JSON line per event of a change log, with its topic and partition number.

    The line carries the order fields, and the dense ``seq`` if the log has one.
    """
    carried = {name: F.col(name) for name in [*ORDER_FIELDS, "seq"] if name in log.columns}
    return log.select(
        "topic",
        "key",
        contract.key_partition(F.col("key")).alias("partition"),
        envelope_line(F.col("topic"), F.col("key"), message_value(log), carried).alias("line"),
    )


def write_lines(log: DataFrame, path: str) -> None:
    """Envelope lines as text, one folder per topic, in order of key and event.

    Files are ranges of that order, so a key with very many events goes on in the
    next file; read by file name and line, every key's events are in order.
    """
    order = ["topic", "key", *ORDER_FIELDS, "pos", "entity_id"]
    ordered = _in_order(log, lambda rows: rows.repartitionByRange(*order))
    # topic leads the sort, so writing one folder per topic needs no sort of its own
    envelope_lines(ordered).select("topic", F.col("line").alias("value")).write.partitionBy("topic").mode(
        "overwrite"
    ).text(path)


def kafka_records(log: DataFrame) -> DataFrame:
    """Records (topic, key, value, headers) of a log; all of one key in one task, in order."""
    ordered = _in_order(log, lambda rows: rows.repartition("topic", "key"))
    header = lambda name: F.struct(F.lit(name).alias("key"), F.col(name).cast("string").cast("binary").alias("value"))
    return ordered.select(
        "topic", "key", message_value(ordered).alias("value"), F.array(*map(header, ORDER_FIELDS)).alias("headers")
    )


def write_kafka(log: DataFrame, servers: str) -> None:
    """Publish a log; the write returns once every message is acknowledged."""
    kafka_records(log).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "includeHeaders", "true"
    ).option("kafka.acks", "all").save()


def capture(messages: DataFrame, name: str) -> StreamingQuery:
    """Collect a stream into an in-memory table, for assertions on small inputs."""
    return messages.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()


def discard(df: DataFrame) -> None:
    """Run everything, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def retained(log: DataFrame, now: Column, days: dict[str, int] = contract.RETENTION_DAYS,
             time: str = "event_time", topic: str = "topic") -> DataFrame:
    """Log rows younger than their topic's window."""
    return log.filter(contract.within_retention(F.to_timestamp(time), F.col(topic), now, days))
