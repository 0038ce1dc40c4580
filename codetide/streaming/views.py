"""Views over the message log.

Views are folds over the log: batch folders not yet compacted plus the last
snapshot.  A micro-batch therefore costs what arrived, however large the view has
grown, and so does a snapshot: it is parted by buckets of ids, and a compaction
merges the buckets that arrivals touch and leaves the files of all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from codetide import contract
from codetide.operators import fold
from codetide.session import StagingArea, stage
from codetide.sources.events import ORDER_FIELDS, decode
from codetide.sources.files import delete, exists, names
from codetide.streaming.log import REQUIRED_FIELDS, MessageLog, start_log, stop

__all__ = ["REQUIRED_FIELDS", "MessageLog", "start_log", "stop"]


def document_rows(
    messages: DataFrame, schema: T.StructType = contract.METADATA_SCHEMA, key: str = "file_path"
) -> DataFrame:
    """Decoded documents with ``_id``; a message without the key is no document."""
    return decode(messages, schema).filter(F.col(key).isNotNull()).withColumn("_id", F.col(key).cast("string"))


def document_view(
    rows: DataFrame, order: list[str], keep: list[str] | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """One document per ``_id``: the last arrival replaces the whole document."""
    return fold.replace_documents(stored, rows, "_id", order, keep)


def graph_events(messages: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Node and edge events of a message log, decoded."""
    part = lambda topic, schema: decode(
        messages.filter(F.col("topic") == topic).select("value", *order), schema
    )
    return part(contract.NODE_TOPIC, contract.NODE_SCHEMA), part(contract.EDGE_TOPIC, contract.EDGE_SCHEMA)


class _Snapshots:
    """Tables parted by buckets of ids; a pointer per table and bucket, written last, makes its files current.

    A compaction writes new files for the buckets that arrivals touch and points to them; the
    other buckets keep their files and pointers.
    """

    # table -> the columns that identify its rows; the first one gives the bucket
    KEYS: dict[str, list[str]] = {}

    def __init__(self, spark: SparkSession, root: str, order: list[str] | None = None, buckets: int = 16) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.order = list(ORDER_FIELDS) if order is None else order
        self._wanted = buckets

    @property
    def buckets(self) -> int:
        """As stored by the first compaction."""
        path = f"{self.root}/layout"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            layout = self.spark.range(1).select(F.lit(self._wanted).alias("buckets"))
            layout.coalesce(1).write.mode("overwrite").parquet(path)
        return self.spark.read.schema("buckets int").parquet(path).first()[0]

    def _bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(self.KEYS[table][0]), F.lit(self.buckets)).cast("int")

    def _pointers(self) -> DataFrame:
        path = f"{self.root}/pointers"
        schema = "name string, bucket int, batch bigint"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def latest(self) -> int | None:
        """Batch of the last complete compaction."""
        return self._pointers().agg(F.max("batch")).first()[0]

    def current(self) -> dict[str, dict[int, int]]:
        """Per table and bucket, the batch whose files hold it: at most tables times buckets."""
        last = self._pointers().filter("name is not null").groupBy("name", "bucket").agg(F.max("batch").alias("batch"))
        found: dict[str, dict[int, int]] = {}
        for r in last.collect():
            found.setdefault(r["name"], {})[r["bucket"]] = r["batch"]
        return found

    def _folder(self, table: str, bucket: int, batch: int) -> str:
        return f"{self.root}/{table}/at={batch}/bucket={bucket}"

    def _read(self, table: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame | None:
        """The stored rows of all buckets or of some; none if there are none."""
        held = self.current().get(table, {})
        paths = [self._folder(table, k, at) for k, at in sorted(held.items()) if only is None or k in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def _merge(self, table: str, fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
        raise NotImplementedError

    def _fresh(self, log: MessageLog | _Until) -> dict[str, DataFrame]:
        """What arrived since the last compaction, one frame per table."""
        raise NotImplementedError

    def _tables(self, log: MessageLog) -> dict[str, DataFrame]:
        """The whole tables as of now: stored rows merged with what arrived since."""
        return {name: self._merge(name, fresh, self._read(name, fresh.schema)) for name, fresh in self._fresh(log).items()}

    def compact(self, log: MessageLog, batch: int) -> dict[str, list[int]]:
        """Merge what arrived up to ``batch`` into the buckets it touches, then point to them; returns those buckets."""
        previous = self.latest()
        if previous is not None and previous >= batch:
            return {}
        area = StagingArea(self.spark)
        touched: dict[str, list[int]] = {}
        for name, rows in self._fresh(_Until(log, batch)).items():
            fresh = stage(rows, name, area)
            touched[name] = sorted(r[0] for r in fresh.select(self._bucket(name)).distinct().collect())
            if touched[name]:
                merged = self._merge(name, fresh, self._read(name, fresh.schema, touched[name]))
                parted = merged.withColumn("bucket", self._bucket(name)).hint("rebalance", "bucket")
                parted.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{name}/at={batch}")
        # the row without a name says that the batch is in, even if it touched nothing
        rows = [(name, k, batch) for name, buckets in touched.items() for k in buckets] + [(None, None, batch)]
        pointers = self.spark.createDataFrame(rows, "name string, bucket int, batch bigint")
        pointers.coalesce(1).write.mode("append").parquet(f"{self.root}/pointers")
        area.release()
        return touched

    def vacuum(self) -> list[str]:
        """Delete files that no pointer names any more; views made before must have been read."""
        held, gone = self.current(), []
        for table in self.KEYS:
            for at in names(self.spark, f"{self.root}/{table}"):
                for bucket in names(self.spark, f"{self.root}/{table}/{at}"):
                    if bucket.startswith("bucket="):
                        batch, number = int(at.split("=")[1]), int(bucket.split("=")[1])
                        if held.get(table, {}).get(number, batch) > batch:
                            gone.append(self._folder(table, number, batch))
                            delete(self.spark, gone[-1])
        return gone


class DocumentSnapshots(_Snapshots):
    """The stored document view: replaced by key with what arrived since."""

    KEYS = {"documents": ["_id"]}

    def __init__(self, spark: SparkSession, root: str, order: list[str] | None = None, topic: str = contract.METADATA_TOPIC,
                 schema: T.StructType = contract.METADATA_SCHEMA, key: str = "file_path", buckets: int = 16) -> None:
        super().__init__(spark, root, order, buckets)
        self.topic, self.schema, self.key = topic, schema, key

    def _fresh(self, log: MessageLog | _Until) -> dict[str, DataFrame]:
        rows = document_rows(log.read([self.topic], self.latest()).select("value", *self.order), self.schema, self.key)
        return {"documents": document_view(rows, self.order, self.schema.names)}

    def _merge(self, table: str, fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
        # arrivals are down to one row per document already, and all beat what is stored
        return fold.replace_documents(stored, fresh.withColumn("rank", F.lit(0)), "_id", ["rank"], self.schema.names)

    def view(self, log: MessageLog) -> DataFrame:
        return self._tables(log)["documents"]


class GraphSnapshots(_Snapshots):
    """Compacted fold state, so that reading a view does not refold the whole log.

    A snapshot holds accumulators, not views: merging them with newer events gives
    the same result as folding everything, late events included.
    """

    KEYS = {"nodes": ["node_id"], "edges": ["edge_id"], "properties": ["node_id", "property"]}
    MERGE = {
        "nodes": fold.merge_node_accumulators,
        "edges": fold.merge_edge_accumulators,
        "properties": fold.merge_property_accumulators,
    }

    def _fresh(self, log: MessageLog | _Until) -> dict[str, DataFrame]:
        nodes, edges = graph_events(log.read([contract.NODE_TOPIC, contract.EDGE_TOPIC], self.latest()), self.order)
        return {
            "nodes": fold.node_accumulators(nodes, edges, self.order),
            "edges": fold.edge_accumulators(edges, self.order),
            "properties": fold.property_accumulators(nodes, self.order),
        }

    def _merge(self, table: str, fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
        return fresh if stored is None else self.MERGE[table](fresh.unionByName(stored))

    def accumulators(self, log: MessageLog) -> dict[str, DataFrame]:
        return self._tables(log)

    def view(self, log: MessageLog) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Current nodes, edges and properties."""
        state = self.accumulators(log)
        deletes = fold.accumulated_deletes(state["nodes"])
        return (
            fold.node_view(state["nodes"]),
            fold.edge_view(state["edges"], deletes),
            fold.live_properties(state["properties"], deletes),
        )


class _Until:
    """A message log as it stood after one batch."""

    def __init__(self, log: MessageLog, batch: int) -> None:
        self.log, self.batch = log, batch

    def read(self, topics: list[str], after_batch: int | None) -> DataFrame:
        return self.log.read(topics, after_batch).filter(F.col("batch_id") <= self.batch)
