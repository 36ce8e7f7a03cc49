"""Extensions on streams: the reference work has none, these use the same operators on arriving files.

event_counts   tumbling or sliding windows with late data, by watermark
stale_keys     keys whose state has not changed for a time, by state with timers
store_stream   envelopes that arrive in a folder, merged into a results store batch by batch
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyforge.sources.envelopes import parse_envelopes
from tallyforge.sources.result_store import ResultStore


def event_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Number and sum of values per window; works on a batch table as well."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = events.withWatermark(ts, late).groupBy(span.alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def stale_keys(events: DataFrame, key: str, state_column: str, ts: str, seconds: int, late: str = "10 minutes") -> DataFrame:
    """A row for each key whose state did not change for `seconds` of event time."""

    def follow(k, batches, state: GroupState):
        value, since, last = state.get if state.exists else (None, 0, 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"key": [str(k[0])], "state": [value], "since_ms": [since], "last_ms": [last]})
            return
        for rows in batches:
            for s, t in rows.sort_values(ts)[[state_column, ts]].itertuples(index=False):
                at = int(t.timestamp() * 1000)
                if s != value:
                    value, since = s, at
                last = max(last, at)
        state.update((value, since, last))
        state.setTimeoutTimestamp(max(since + seconds * 1000, state.getCurrentWatermarkMs() + 1))

    return events.withWatermark(ts, late).groupBy(key).applyInPandasWithState(follow, "key string, state string, since_ms long, last_ms long", "state string, since long, last long", "append", GroupStateTimeout.EventTimeTimeout)


def store_stream(spark: SparkSession, folder: str, store: ResultStore, checkpoint: str, name: str = "intake", lines: bool = False, glob: str = "*", per_trigger: int = 1_000, order: tuple[str, ...] = ("file_name",)):
    """Starts a query that upserts the JSON envelopes arriving in `folder` and stops when all is read.

    A file holds an object or an array of them, or one in each line. The store
    notes the number of each batch under `name` in the same manifest that publishes
    the batch, so a batch that is replayed after a failure changes nothing. Texts
    are shuffled by task id once and parsed after that, on as many cores as there are.
    """
    reader = spark.readStream.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_trigger)
    rows = reader.text(folder, wholetext=not lines).select("value", F.col("_metadata.file_name").alias("file_name"))

    def merge(batch: DataFrame, number: int) -> None:
        store.upsert(parse_envelopes(batch, parts=store.parts), order=order, batch=(name, number))

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
