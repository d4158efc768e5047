"""The diff of a whole change feed, kept per key while the feed arrives in batches.

collapse_changes gives the diff of the rows it is handed. Here the first and last record of every key are streaming state, so
however a feed is cut into micro-batches, in whatever order they come, the newest diff of a key is that of all its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tillwork.operators.changes import FEED_COLUMNS

#: What a query on this state is started with. Nothing waits for a timer, so a batch without data has nothing to do; with
#: expiry Spark would run such batches for ever and a run over what is available would never end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
FIRST_KINDS, LAST_KINDS = ("insert", "update_preimage", "delete"), ("insert", "update_postimage", "delete")


class _FirstAndLast(StatefulProcessor):
    """State per key: (version, rank, kind, record) of its first and of its last row; records are kept pickled, whatever their types."""

    def __init__(self, names: list[str], ttl_ms: int):
        self.names, self.ttl_ms = names, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        end = T.StructType().add("version", T.LongType()).add("rank", T.IntegerType()).add("kind", T.StringType()).add("record", T.BinaryType())
        self.first = handle.getValueState("first", end, self.ttl_ms)
        self.last = handle.getValueState("last", end, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = tuple(self.first.get()) if self.first.exists() else None
        last = tuple(self.last.get()) if self.last.exists() else None
        known = first, last
        for row in rows:
            end = (row["_commit_version"], row["_rank"], row["_change_type"], row["_record"])  # pickled below, once
            if end[2] in FIRST_KINDS and (first is None or end[:2] < first[:2]):
                first = end
            if end[2] in LAST_KINDS and (last is None or end[:2] > last[:2]):
                last = end
        # both are written, so that both expire at the same time after the key's last change
        for state, end, before in ((self.first, first, known[0]), (self.last, last, known[1])):
            if end is not None:
                state.update(end if end is before else (*end[:3], pickle.dumps(end[3])))
        previous = _record(first, known[0]) if first is not None and first[2] != "insert" else None
        current = _record(last, known[1]) if last is not None and last[2] != "delete" else None
        yield Row(**dict(zip(self.names, (*key, previous, current), strict=True)))

    def close(self) -> None:
        pass


def _record(end: tuple, before: tuple | None) -> object:
    """The record of a row: still pickled if it came from the state."""
    return pickle.loads(end[3]) if end is before else end[3]


def _ends_of_batches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Only a key's first and last rows of each Arrow batch, so that a hot key is reduced before the shuffle."""
    for batch in batches:
        slim = pa.table({**{k: batch.column(k) for k in keys}, "v": batch.column("_commit_version"), "r": batch.column("_rank"), "kind": batch.column("_change_type")})
        slim = slim.append_column("i", pa.array(range(batch.num_rows), pa.int64()))
        kept: set[int] = set()
        for kinds, direction in ((FIRST_KINDS, "ascending"), (LAST_KINDS, "descending")):
            some = slim.filter(pc.is_in(slim["kind"], pa.array(kinds))).sort_by([("v", direction), ("r", direction)])
            kept.update(some.group_by(keys, use_threads=False).aggregate([("i", "first")])["i_first"].to_pylist())
        yield batch.take(pa.array(sorted(kept), pa.int64()))


def _kept_ends(rows: DataFrame, named: list[str]) -> DataFrame:
    kind, when = F.col("_change_type"), F.struct("_commit_version", "_rank")
    end = F.struct("_change_type", "_record")
    ends = rows.groupBy(*named).agg(
        F.min_by(end, F.when(kind.isin(*FIRST_KINDS), when)).alias("first"), F.max_by(end, F.when(kind.isin(*LAST_KINDS), when)).alias("last")
    )
    return ends.select(
        *named, F.when(F.col("first._change_type") != "insert", F.col("first._record")).alias("previous_record"),
        F.when(F.col("last._change_type") != "delete", F.col("last._record")).alias("current_record"),
    )


def keyed_diffs(changes: DataFrame, keys: list[str], forget_after: int | None = None) -> DataFrame:
    """A stream of _k_<key>, previous_record, current_record: per micro-batch the newest diff of each key it holds.

    Both records are null where nothing is left to tell (inserted and deleted again): a consumer drops the key then. A key's rows
    are told apart by version, at equal versions a delete comes before an insert; rows of unknown kinds count for nothing.
    Replayed rows change nothing. forget_after: seconds after a key's last change when its state is dropped, so that
    later rows start a new diff; None keeps it. Null keys are one key. Start it with SETTINGS in the session, as maintain_diffs does.

    State that is kept is a streaming aggregation of the first and the last row: no Python, rows are reduced before the shuffle.
    Spark expires no such state by processing time, so with forget_after a processor keeps it; keys must then be of types that Arrow can
    group by. The two are different states: a checkpoint goes on only with the one that it was made with.
    """
    missing = [c for c in FEED_COLUMNS if c not in changes.columns]
    if missing:
        raise ValueError(f"not a change feed, no column {missing}")
    fields = [c for c in changes.columns if c not in (*FEED_COLUMNS, "_commit_timestamp")]
    kind = F.col("_change_type")
    named = [f"_k_{k}" for k in keys]
    rows = changes.select(
        *[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], kind, F.col("_commit_version").cast("bigint").alias("_commit_version"),
        F.when(kind.isin("insert", "update_postimage"), 1).otherwise(0).alias("_rank"), F.struct(*fields).alias("_record"),
    )
    if forget_after is None:
        return _kept_ends(rows, named)
    ends = rows.mapInArrow(lambda batches: _ends_of_batches(batches, named), rows.schema)
    record = rows.schema["_record"].dataType
    out = T.StructType([rows.schema[n] for n in named]).add("previous_record", record).add("current_record", record)
    return ends.groupBy(*named).transformWithState(_FirstAndLast(out.names, forget_after * 1000), out, "update", "processingTime")


def maintain_diffs(changes: DataFrame, keys: list[str], target: str, checkpoint: str, forget_after: int | None = None) -> StreamingQuery:
    """Write each batch's newest diffs below target; read_diffs gives one per key. A replayed batch replaces its own files."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    conf = changes.sparkSession.conf
    before = {name: conf.get(name) for name in SETTINGS}
    stream = keyed_diffs(changes, keys, forget_after).writeStream.outputMode("update")
    ready = stream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    try:
        for name, value in SETTINGS.items():
            conf.set(name, value)
        return ready.start()  # a started query has a session of its own
    finally:
        for name, value in before.items():
            conf.set(name, value)


def read_diffs(spark: SparkSession, target: str) -> DataFrame:
    """previous_record, current_record of the newest diff of every key that has one left."""
    stored = spark.read.parquet(target)
    named = [c for c in stored.columns if c.startswith("_k_")]
    newest = stored.groupBy(*named).agg(F.max_by(F.struct("previous_record", "current_record"), "batch").alias("diff"))
    return newest.select("diff.*").filter(F.col("previous_record").isNotNull() | F.col("current_record").isNotNull())
