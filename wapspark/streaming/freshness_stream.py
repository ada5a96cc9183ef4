"""O1 / O2 as a stream: a feed's class changes when nothing comes, too.

The batch monitor looks at the newest arrival when it is run. Here every feed
(a table, a source, whatever the key is) has a state. An arrival makes it
FRESH; it is STALE ``FRESH_HOURS`` and MISSING ``STALE_HOURS`` after its newest
arrival. Each change is one row with the moment at which it took place, reported
by an event-time timer once the watermark has passed that moment, so nothing
that may still arrive in time can contradict it: the rows are the same whenever
the job runs and however arrivals were cut into micro-batches.

The state of a feed are its spans of arrivals with no gap over ``FRESH_HOURS``
whose changes are not all reported yet (start and end each, so a busy feed is
one span). It goes when the feed is MISSING: its next arrival begins anew, so
the state holds the feeds of the last ``STALE_HOURS`` alone. Arrivals older than
the watermark (``delay`` behind the newest of all) are late and left out. Rows
without a feed or a time are no arrivals.

Feeds are many and most have little to tell, so a state is that of a bucket of
feeds (by a hash of the name): one call steps all of them with array operations.
A bucket's next call is due when the first of its feeds is. ``buckets`` is fixed
by the stream's first start, like the number of its state partitions; give it
more for more feeds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wapspark.operators.observability import FRESH_HOURS, STALE_HOURS
from wapspark.session import ensure_checkpoint_dir

_HOUR = 3_600_000_000  # microseconds
_TO_STALE, _TO_MISSING = FRESH_HOURS * _HOUR, STALE_HOURS * _HOUR
FRESH, STALE, MISSING = "FRESH", "STALE", "MISSING"


def spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined over gaps of at most ``FRESH_HOURS``, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(starts[1:] - reach[:-1] > _TO_STALE)
    return starts[np.concatenate(([0], cut + 1))], reach[np.concatenate((cut, [len(reach) - 1]))]


def settle(status: str, starts: list[int], ends: list[int], passed) -> tuple:
    """Changes whose moment has ``passed``: (changes, status, spans left, the
    next change's moment or None). Unless ``status`` is MISSING, the first span
    is the one that it tells of."""
    out, k, due = [], 0, None
    while k < len(starts):
        if status == MISSING:
            due, then = starts[k], FRESH
        elif status == FRESH:
            due, then = ends[k] + _TO_STALE, STALE
        else:
            due, then = ends[k] + _TO_MISSING, MISSING
            if k + 1 < len(starts) and starts[k + 1] <= due:
                due, then = starts[k + 1], FRESH
        if not passed(due):
            return out, status, starts[k:], ends[k:], due
        out.append((then, due))
        k += status == STALE  # on to the next span, after MISSING as well
        status = then
    return out, status, [], [], None


def joined(feeds: np.ndarray, starts: np.ndarray, ends: np.ndarray, told: np.ndarray) -> tuple:
    """``spans`` for many feeds at once: spans by feed and start. ``told`` is how
    many of a span's first two changes are reported; what joins a span keeps it."""
    codes, names = pd.factorize(feeds)
    order = np.lexsort((starts, codes))
    codes, starts, told = codes[order], starts[order], told[order]
    reach = pd.Series(ends[order]).groupby(codes).cummax().to_numpy(np.int64)
    first = np.ones(len(codes), bool)
    first[1:] = (codes[1:] != codes[:-1]) | (starts[1:] - reach[:-1] > _TO_STALE)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(codes)) - 1
    return names[codes[at]], starts[at], reach[last], np.maximum.reduceat(told, at)


def settled(feeds: np.ndarray, starts: np.ndarray, ends: np.ndarray, told: np.ndarray, passed) -> tuple:
    """``settle`` for many feeds at once, from what ``joined`` gives: (changes as
    feeds, statuses and moments), (spans left), the least next moment or None."""
    another = np.append(feeds[1:] == feeds[:-1], False)
    following = np.append(starts[1:], 0)
    stale, missing = ends + _TO_STALE, ends + _TO_MISSING
    back = another & (following <= missing)  # FRESH again before it is MISSING
    end = np.where(back, following, missing)
    fresh_now, stale_now, ended = (told < 1) & passed(starts), (told < 2) & passed(stale), passed(end)
    tell = ((FRESH, fresh_now, starts), (STALE, stale_now, stale), (MISSING, ended & ~back, missing))
    out = (np.concatenate([feeds[which] for _, which, _ in tell]),
           np.repeat([status for status, _, _ in tell], [which.sum() for _, which, _ in tell]),
           np.concatenate([moment[which] for _, which, moment in tell]))
    left = ~ended
    told = np.maximum(told, passed(starts).astype(np.int64) + passed(stale))[left]
    due = np.choose(told, (starts[left], stale[left], end[left]))
    return out, (feeds[left], starts[left], ends[left], told), int(due.min()) if len(due) else None


def _step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = state.get if state.exists else ([], [], [], [])
    feeds = np.array(held[0], dtype=object)
    starts, ends, told = (np.array(x, np.int64) for x in held[1:])
    if not state.hasTimedOut:
        for f in frames:
            times = f["at"].to_numpy(np.int64)
            if len(times):  # a frame at a time: spans, not arrivals, add up
                feeds, starts, ends, told = joined(
                    np.concatenate((feeds, f["feed"].to_numpy(object))), np.concatenate((starts, times)),
                    np.concatenate((ends, times)), np.concatenate((told, np.zeros_like(times))))
    mark = state.getCurrentWatermarkMs()
    out, left, due = settled(feeds, starts, ends, told, lambda moment: moment // 1000 + 1 < mark)
    if due is None:
        state.remove()
    else:
        state.update(tuple(x.tolist() for x in left))
        state.setTimeoutTimestamp(max(due // 1000 + 1, mark + 1))
    if len(out[0]):
        yield pd.DataFrame(dict(zip(("feed", "status", "at"), out)))


def freshness_changes(arrivals: DataFrame, feed_col: str, ts_col: str, delay: str = "10 minutes",
                      buckets: int = 1024) -> DataFrame:
    """Streaming frame of ``feed``, ``status`` and ``changed_at``."""
    rows = (arrivals.select(F.col(feed_col).cast("string").alias("feed"),
                            F.col(ts_col).cast("timestamp").alias("ts")).dropna()
            .withWatermark("ts", delay).withColumn("at", F.unix_micros("ts"))
            .withColumn("bucket", F.pmod(F.xxhash64("feed"), F.lit(buckets)).cast("int")))
    found = rows.groupBy("bucket").applyInPandasWithState(
        _step, "feed string, status string, at long",
        "feeds array<string>, starts array<long>, ends array<long>, told array<long>", "append",
        GroupStateTimeout.EventTimeTimeout)
    return found.select("feed", "status", F.timestamp_micros("at").cast("timestamp_ntz").alias("changed_at"))


def watch_freshness(spark: SparkSession, source_path: str, schema: str, feed_col: str, ts_col: str,
                    out_path: str, checkpoint_path: str, delay: str = "10 minutes",
                    oldest_file: str = "3650d", buckets: int = 1024) -> StreamingQuery:
    """Follow Parquet files that land under ``source_path``; changes are written
    under ``out_path`` by micro-batch, a replayed one replaces its own."""
    ensure_checkpoint_dir(spark)
    arrivals = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                .option("maxFileAge", oldest_file).parquet(source_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return (freshness_changes(arrivals, feed_col, ts_col, delay, buckets).writeStream.foreachBatch(write)
            .outputMode("append").option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
