"""An append-only log of messages, with the place each came from and its offset.

A micro-batch is one folder of messages, parted by topic and by the day of the event, and overwrites
whatever an interrupted attempt left there.  Good and bad messages alike are in that one write.  Two small
tables go with it:

* ``pieces``: a row per run of messages that one task wrote for one topic, day, source block and
  partition.  A message keeps its number among those of its task, as read and as written; what the
  piece adds to it gives the line in its source file and its offset in (topic, partition).
* ``offsets``: where each (topic, partition) stands after the batch, written last.  Offsets go on
  from the batch before, by day, source and line, so they are dense, and the same when a batch is repeated.

Nothing is shuffled for this but the rows of the small tables.  Dead letters stay in the log; repaired
ones come back as new lines of the landing folder, each once.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from codetide import contract
from codetide.functions.ids import stable_hash
from codetide.sources.events import ORDER_FIELDS, SOURCE_FIELDS, bad_message_reason, envelope_line, missing_field
from codetide.sources.files import delete, exists, move, names

_GROUP = ["topic", "day", "source", "block", "partition"]
_PIECE = "topic string, day date, source string, block bigint, partition int, piece int, first_pos bigint, rows bigint, first_at bigint"
_ENDS = "topic string, partition int, first_offset bigint, next_offset bigint"


def _number(name: str) -> int:
    return int(name.split("=")[1])


def _piece(position: str) -> Column:
    """The task that numbered a row: Spark's increasing id is (task, place in the task)."""
    return F.shiftright(position, 33).cast("int")


class MessageLog:
    """Batches of (topic, key, value, order fields) messages under one folder.

    ``time`` names the field of a message's JSON that holds its time; a message without one has no
    day and is never dropped by age.
    """

    def __init__(
        self, spark: SparkSession, root: str, extra: dict[str, str] | None = None, time: str = "event_time",
        partitions: int = contract.PARTITIONS_PER_TOPIC,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.time, self.partitions = time, partitions
        self.fields = {
            "key": "string", "value": "string", "reason": "string", **(ORDER_FIELDS if extra is None else extra), **SOURCE_FIELDS
        }
        own = {"source_topic": "string", "partition": "int", "at": "bigint", "pos": "bigint"}
        stored = ", ".join(f"{name} {kind}" for name, kind in {**self.fields, **own}.items())
        self.schema = f"{stored}, batch_id bigint, topic string, day date"

    # --- appending ------------------------------------------------------------------------------
    def write_batch(self, messages: DataFrame, batch_id: int) -> None:
        # a message of no topic at all still has to land somewhere
        topic = F.when(F.col("reason").isNotNull(), contract.DEAD_LETTER_TOPIC).otherwise(F.col("topic"))
        absent = {n: F.lit(None).cast(kind) for n, kind in self.fields.items() if n not in messages.columns}
        rows = messages.withColumns({**absent, "at": F.monotonically_increasing_id()}).select(
            *self.fields,
            F.col("topic").alias("source_topic"),
            F.coalesce(contract.key_partition(F.col("key"), self.partitions), F.lit(0)).alias("partition"),
            "at",
            topic.alias("topic"),
            F.to_date(F.try_to_timestamp(F.get_json_object("value", f"$.{self.time}"))).alias("day"),
        )
        # sorted as the folders ask; equal groups end up side by side, in the order they were read
        ordered = rows.sortWithinPartitions(*_GROUP, "at").withColumn("pos", F.monotonically_increasing_id())
        ordered.write.mode("overwrite").partitionBy("topic", "day").parquet(f"{self.root}/messages/batch_id={batch_id}")
        self._number_batch(batch_id)

    def _number_batch(self, batch_id: int) -> None:
        written = self.read().filter(F.col("batch_id") == batch_id)
        parts = written.groupBy(*_GROUP, _piece("pos").alias("piece")).agg(
            F.min("pos").alias("first_pos"), F.count("*").alias("rows"), F.min("at").alias("first_at")
        )
        # lines of a file: those of its earlier blocks, then those of the block in the order they were read
        block = Window.partitionBy("source", "block", "piece")
        parts = parts.withColumns({"block_at": F.min("first_at").over(block), "in_block": F.sum("rows").over(block)})
        once = F.row_number().over(block.orderBy("first_pos")) == 1
        earlier = Window.partitionBy("source").orderBy("block", "piece").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        lines = F.sum(F.when(F.col("once"), F.col("in_block")).otherwise(0)).over(earlier) - F.col("in_block")
        parts = parts.withColumn("once", once).withColumn("first_line", F.when(F.col("source").isNotNull(), lines))
        before = self._ends_before(batch_id).select("topic", "partition", F.col("next_offset").alias("base"))
        so_far = Window.partitionBy("topic", "partition").orderBy("day", "source", "block", "piece")
        offset = F.coalesce("base", F.lit(0)) + F.sum("rows").over(so_far) - F.col("rows")
        pieces = parts.join(before, ["topic", "partition"], "left").withColumns(
            {"first_offset": offset, "arrived": F.current_timestamp()}
        )
        path = f"{self.root}/pieces/batch_id={batch_id}"
        pieces.drop("base", "once", "in_block").write.mode("overwrite").parquet(path)
        reached = self.pieces().filter(F.col("batch_id") == batch_id).groupBy("topic", "partition").agg(
            F.min("first_offset").alias("first_offset"), F.max(F.col("first_offset") + F.col("rows")).alias("next_offset")
        )
        # one row per topic and partition, those at rest too, so that the next batch reads this folder only
        ends = reached.join(before, ["topic", "partition"], "full").select(
            "topic", "partition", F.coalesce("first_offset", "base").alias("first_offset"), F.coalesce("next_offset", "base").alias("next_offset")
        )
        ends.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/offsets/batch_id={batch_id}")

    def _ends_before(self, batch_id: int) -> DataFrame:
        done = [_number(n) for n in names(self.spark, f"{self.root}/offsets") if n.startswith("batch_id=")]
        last = max((b for b in done if b < batch_id), default=None)
        if last is None:
            return self.spark.createDataFrame([], _ENDS)
        return self.spark.read.schema(_ENDS).parquet(f"{self.root}/offsets/batch_id={last}")

    # --- reading --------------------------------------------------------------------------------
    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def read(self, topics: list[str] | None = None, after_batch: int | None = None) -> DataFrame:
        log = self._table("messages", self.schema)
        if topics:
            log = log.filter(F.col("topic").isin(*topics))
        return log if after_batch is None else log.filter(F.col("batch_id") > after_batch)

    def pieces(self) -> DataFrame:
        return self._table("pieces", f"{_PIECE}, block_at bigint, first_line bigint, first_offset bigint, arrived timestamp, batch_id bigint")

    def placed(self, messages: DataFrame) -> DataFrame:
        """Messages of this log with ``line`` (in a source file, from 1), ``offset`` and ``arrived``."""
        found = self.pieces().select(*[F.col(c).alias(f"__{c}") for c in self.pieces().columns])
        same = F.lit(True)
        for name in [*_GROUP, "batch_id"]:
            same &= F.col(name).eqNullSafe(F.col(f"__{name}"))
        joined = messages.join(found, same & (_piece("pos") == F.col("__piece")), "left")
        return joined.select(
            *messages.columns,
            (F.col("__first_line") + F.col("at") - F.col("__block_at") + 1).alias("line"),
            (F.col("__first_offset") + F.col("pos") - F.col("__first_pos")).alias("offset"),
            F.col("__arrived").alias("arrived"),
        )

    def offsets(self) -> DataFrame:
        """Per batch, topic and partition: first and last offset and number of the messages it added."""
        ends = self._table("offsets", f"{_ENDS}, batch_id bigint").filter("next_offset > first_offset")
        count = F.col("next_offset") - F.col("first_offset")
        return ends.select("batch_id", "topic", "partition", "first_offset", (F.col("next_offset") - 1).alias("last_offset"), count.alias("messages"))

    # --- dead letters -----------------------------------------------------------------------------
    def dead_letters(self, open_only: bool = False) -> DataFrame:
        """Messages that could not be applied: reason, batch and its time, and file and line or the broker's place.

        ``letter`` names one for good.  ``open_only`` leaves out those sent back by ``redrive``.
        """
        letters = self.placed(self.read([contract.DEAD_LETTER_TOPIC]))
        place = F.coalesce("source_offset", "line", "offset")
        letter = stable_hash("letter", F.coalesce("source", F.concat(F.lit("batch "), F.col("batch_id").cast("string"))), place)
        letters = letters.withColumn("letter", letter)
        return letters.join(self._redriven(), "letter", "left_anti") if open_only else letters

    def _redriven(self, before: int | None = None) -> DataFrame:
        back = self._table("redriven", "letter string, number bigint")
        return (back if before is None else back.filter(F.col("number") < before)).select("letter").distinct()

    def redrive(self, repaired: DataFrame, landing: str, number: int) -> int:
        """Land repaired letters (letter, topic, key, value and order fields) as new lines; returns the files moved.

        Re-drive ``number`` fixes its letters once, without those of smaller numbers; its lines are
        written aside and moved into the landing folder file by file.  Called again, it moves what is left, so
        every letter lands once however often the call dies or is repeated.
        """
        kept, lines = f"{self.root}/redriven/number={number}", f"{self.root}/redriven-lines/number={number}"
        if not exists(self.spark, f"{kept}/_SUCCESS"):
            fresh = repaired.join(self._redriven(number), "letter", "left_anti").dropDuplicates(["letter"])
            fresh.select("letter", "topic", "key", "value", *[c for c in ORDER_FIELDS if c in repaired.columns]).write.mode("overwrite").parquet(kept)
        if not exists(self.spark, f"{lines}/_SUCCESS"):
            rows = self.spark.read.parquet(kept)
            carried = {c: F.col(c) for c in [*ORDER_FIELDS, "letter"] if c in rows.columns}
            line = envelope_line(F.col("topic"), F.col("key"), F.col("value"), carried)
            rows.select(line.alias("line")).write.mode("overwrite").text(lines)
        return move(self.spark, lines, f"{landing.rstrip('/')}/redrive={number}")

    # --- letting go ---------------------------------------------------------------------------------
    def batches(self) -> list[int]:
        return sorted(_number(n) for n in names(self.spark, f"{self.root}/messages") if n.startswith("batch_id="))

    def expire(self, up_to_batch: int) -> list[int]:
        """Delete batches that a snapshot covers, dead letters too; returns the ones that went.

        Reading lists the folders that are left, so its cost follows what arrived since the snapshot.
        """
        gone = [b for b in self.batches() if b <= up_to_batch]
        for batch in gone:
            delete(self.spark, f"{self.root}/messages/batch_id={batch}")
            delete(self.spark, f"{self.root}/pieces/batch_id={batch}")
        return gone

    def expire_days(
        self, now: datetime.datetime, days: dict[str, int] = contract.RETENTION_DAYS, up_to_batch: int | None = None
    ) -> list[tuple[int, str, datetime.date]]:
        """Drop whole days that are older than their topic's window; returns (batch, topic, day) of each.

        Only folders go, no file is rewritten: the day that the window ends in stays whole (``retained``
        cuts it to the moment), as do messages without a day and topics without a window.
        ``up_to_batch`` spares batches that no snapshot holds yet.
        """
        gone = []
        for batch in self.batches():
            if up_to_batch is not None and batch > up_to_batch:
                continue
            for topic, width in days.items():
                folder = f"{self.root}/messages/batch_id={batch}/topic={topic}"
                for name in sorted(names(self.spark, folder)):
                    if not name.startswith("day=") or name.startswith("day=__"):
                        continue
                    day = datetime.date.fromisoformat(name.split("=")[1])
                    if datetime.datetime.combine(day, datetime.time()) + datetime.timedelta(days=1) <= now - datetime.timedelta(days=width):
                        delete(self.spark, f"{folder}/{name}")
                        gone.append((batch, topic, day))
        return gone


# per topic and event type; an edge cannot be stored without both ends
REQUIRED_FIELDS = {
    contract.NODE_TOPIC: {"*": ["node_id"]},
    contract.EDGE_TOPIC: {"*": ["edge_id"], contract.EDGE_UPSERT: ["src_node_id", "dst_node_id"]},
    contract.METADATA_TOPIC: {"*": ["file_path"]},
    contract.ERROR_TOPIC: {"*": ["file_path"]},
}


def judged(messages: DataFrame, required: dict[str, dict[str, list[str]]] | None = None, reason: Column | None = None) -> DataFrame:
    """Messages with the reason they cannot be applied for, null for good ones.

    ``required`` names, per topic and event type, the fields an event cannot do
    without; left out, those of the contract.
    """
    value = F.col("value")
    if reason is None:
        fields = missing_field(F.col("topic"), value, REQUIRED_FIELDS if required is None else required)
        reason = F.when(F.col("topic").isNull(), F.lit("no topic")).otherwise(
            F.coalesce(bad_message_reason(value, F.lit("")), fields)
        )
    return messages.withColumn("reason", reason)


def start_log(
    messages: DataFrame,
    log: MessageLog,
    checkpoint: str,
    *,
    required: dict[str, dict[str, list[str]]] | None = None,
    reason: Column | None = None,
    once: bool = False,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Stream ``messages(topic, key, value)`` into ``log``; ``judged`` says which are dead letters."""
    writer = judged(messages, required, reason).writeStream.foreachBatch(log.write_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stop(query: StreamingQuery) -> None:
    """Stop after the batch in hand; the checkpoint makes the next start resume."""
    query.stop()
