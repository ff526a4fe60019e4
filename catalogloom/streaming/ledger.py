"""Continuous ledger intake (an extension: the batch operators do without it).

Decisions arrive as a stream; late ones within the watermark count, repeats are dropped by their id. ``latest_by_key`` keeps the
newest decision of each key in the engine's keyed state; ``merge_latest`` keeps it as files where other jobs read it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def without_repeats(stream: DataFrame, id_col: str, time: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([id_col])


def counts_by_window(stream: DataFrame, time: str, key: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Decisions per key and window of event time."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def latest_by_key(stream: DataFrame, keys: list[str], order: list[str], late: str | None = None, expire_ms: int | None = None) -> DataFrame:
    """A stream of each key's newest decision, emitted when it changes (output mode ``update``).

    ``order``: the columns that say which of two decisions is newer, time first and then file and line, as the batch
    operator has them; a decision that equals the kept one in all of them changes nothing, so a batch that is played again emits nothing.
    State is a row for each key. With ``late`` (a watermark on the first of ``order``) and ``expire_ms``, a key without news for that
    long after its newest decision leaves the state.
    """
    kind = StructType([stream.schema[c] for c in stream.columns if c not in keys])
    rest, out = kind.names, StructType([stream.schema[c] for c in keys] + list(kind.fields))
    at = [rest.index(c) for c in order]

    def newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = state.get if state.exists else None
        best, rank = before, None if before is None else tuple(before[i] for i in at)
        for frame in frames:
            top = frame.sort_values(order, kind="stable").iloc[-1]
            mine = tuple(top[c].to_pydatetime() if isinstance(top[c], pd.Timestamp) else top[c] for c in order)
            if rank is None or mine > rank:
                rank = mine
                best = tuple(top[c].to_pydatetime() if isinstance(top[c], pd.Timestamp) else top[c].item() if hasattr(top[c], "item") else top[c] for c in rest)
        if best is not before:
            state.update(best)
            yield pd.DataFrame([[*key, *best]], columns=out.names)
        if expire_ms is not None:
            state.setTimeoutTimestamp(max(int(rank[0].timestamp() * 1000) + expire_ms, state.getCurrentWatermarkMs() + 1))

    timed = stream.withWatermark(order[0], late) if late else stream
    timeout = GroupStateTimeout.EventTimeTimeout if expire_ms is not None else GroupStateTimeout.NoTimeout
    return timed.groupBy(*keys).applyInPandasWithState(newest, out, kind, "update", timeout)


def merge_latest(path: str, keys: list[str], time: str, line: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: writes the state after each batch as ``path/batch=<n>``; a batch that runs again overwrites its own.

    Of two decisions of one time the later ``line`` wins. The states before the last one are deleted.
    """
    from ..operators.ledger import latest

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if n:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/batch={n - 1}").unionByName(batch)
        latest(rows.withColumn("_line", F.col(line)), keys, time, "_line").select(*batch.columns).write.mode("overwrite").parquet(f"{path}/batch={n}")
        if n > 1:
            sc = spark.sparkContext
            old = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={n - 2}")
            old.getFileSystem(sc._jsc.hadoopConfiguration()).delete(old, True)

    return merge
