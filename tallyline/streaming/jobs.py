"""Structured Streaming forms of what is incremental by nature."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyline.operators.registry import KEY, daily_counts
from tallyline.sources import sinks

#: The state store that stateful processors need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE = "1 hour"


def ingest_stream(spark: SparkSession, path: str, schema: str, most_files: int | None = None, kind: str = "parquet", **options) -> DataFrame:
    """Parquet or CSV files (with a header) of a folder, each once, as they come. ``sources.ledger`` also repairs gaps."""
    reader = spark.readStream.schema(schema)
    reader = reader if most_files is None else reader.option("maxFilesPerTrigger", most_files)
    return reader.csv(path, header=True, **options) if kind == "csv" else reader.parquet(path)


def first_hits(events: DataFrame, keys: list[str], client: Column, ts: str = "ts") -> DataFrame:
    """The first event of each client, day and key; the day's later ones are dropped while the state remembers (25 hours)."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("day", F.to_date(ts)).withColumn("client_", client).withWatermark(ts, "25 hours")
    return rows.dropDuplicatesWithinWatermark([*keys, "day", "client_"])


def distinct_clients_stream(events: DataFrame, keys: list[str], client: Column, ts: str = "ts") -> DataFrame:
    """``keys``, day, clients: how many different clients a UTC day has, once the watermark has passed the day.

    Two stateful steps in a row: a client's first hit of a day is let through, and these hits are counted by day. Both forget: clients after 25 hours,
    a day's counts when they are given out.
    """
    hits = first_hits(events, keys, client, ts)
    counts = hits.groupBy(F.window(ts, "1 day").alias("w"), *keys).count()
    return counts.select(*keys, F.to_date("w.start").alias("day"), F.col("count").alias("clients"))


def daily_counts_stream(events: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Counts by UTC day and keys; rows later than the watermark are left out."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, LATE).groupBy(F.window(ts, "1 day").alias("w"), *keys).count()
    return rows.select(F.to_date("w.start").alias("day"), *keys, F.col("count").alias("n"))


def start_daily_counts(events: DataFrame, keys: list[str], path: str, checkpoint: str, every: str | None = None):
    """Run the counts into a Parquet folder: a day is appended once the watermark has passed it. Without ``every``, what is there now."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return daily_counts_stream(events, keys).writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger).format("parquet").start(path)


def update_day_summary(store: str, path: str):
    """For foreachBatch: merge a batch of changes into ``store``, then count the days that it touches anew, from the store.

    So a day may come in any number of batches, and a batch may come twice. A day is touched if the batch has rows of it, or rows that take the place
    of some of it: a correction moves a change to the day of its own file. These days are noted under ``path``.touched before the store
    changes, as after a crash the store no longer tells them. Other days stay as they are; a day without rows goes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, note = batch.sparkSession, f"{path}.touched/batch={batch_id}"
        touched = batch.select(F.col("file_date").alias("day"))
        if sinks.exists(spark, store):
            same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
            replaced = spark.read.parquet(store).alias("s").join(batch.select(*KEY).distinct().alias("b"), same, "left_semi")
            touched = touched.unionByName(replaced.select(F.col("file_date").alias("day")))
        touched.where("day is not null").distinct().write.mode("append").parquet(note)
        sinks.write_changes(batch, store)
        days = spark.read.parquet(note).distinct()
        rows = spark.read.parquet(store).join(days, F.col("file_date") == F.col("day"), "left_semi")
        counts = daily_counts(rows)
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        for r in days.join(rows.select(F.col("file_date").alias("day")).distinct(), "day", "left_anti").collect():  # days of one batch that are empty now
            sinks._delete(spark, f"{path}/day={r.day}")

    return write


class PostingTracker(StatefulProcessor):
    """State of one board: its postings with first and last sighting, misses and status. Input rows are crawls with the ids seen.

    A posting that has been closed for ``keep_days`` of crawls is forgotten. All of a board go that is not crawled for as long: by event time, with a timer,
    or with ``clock`` by the clock, as entries that no crawl touches outlive their TTL.
    """

    keep_days, clock = 400.0, False

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = "first_seen string, last_seen string, misses int, status string, closed_at string"
        self.postings = handle.getMapState("postings", "job_id string", fields, int(self.keep_days * 86_400_000) if self.clock else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        crawls = pd.concat(list(rows)).sort_values("day", kind="stable")
        known = {k[0]: tuple(v) for k, v in self.postings.iterator()}  # read once: first_seen, last_seen, misses, status, closed_at
        changed = set()
        for crawl in crawls.itertuples():
            if crawl.outcome == "failed":
                continue
            seen = set(crawl.job_ids) if crawl.outcome == "ok" and crawl.job_ids is not None else set()
            if crawl.outcome == "unchanged":
                seen = {j for j, v in known.items() if v[3] == "open" and v[2] == 0}
            for j, v in known.items():
                if j not in seen and v[3] == "open":
                    misses = v[2] + 1
                    known[j] = (v[0], v[1], misses, "closed" if misses >= 2 else "open", crawl.day if misses == 1 else v[4])
                    changed.add(j)
            for j in seen:
                known[j] = (known[j][0] if j in known else crawl.day, crawl.day, 0, "open", None)
                changed.add(j)
        for j in changed:
            self.postings.updateValue((j,), known[j])
        day = dt.datetime.fromisoformat(str(crawls.day.iloc[-1])[:10]).replace(tzinfo=dt.timezone.utc)
        last = (day - dt.timedelta(days=self.keep_days)).date().isoformat()
        for j in [j for j, v in known.items() if v[3] == "closed" and v[4] is not None and v[4] < last]:
            self.postings.removeKey((j,))
        if not self.clock:
            end = int((day + dt.timedelta(days=self.keep_days)).timestamp() * 1000)
            held = list(self.handle.listTimers())
            for t in [t for t in held if t < end]:
                self.handle.deleteTimer(t)
            if not any(t >= end for t in held):
                self.handle.registerTimer(end)
        out = [(key[0], j, *known[j]) for j in sorted(changed)]
        yield pd.DataFrame(out, columns=["board", "posting", "first_seen", "last_seen", "misses", "status", "closed_at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.postings.clear()
        yield pd.DataFrame({c: pd.Series(dtype="int32" if c == "misses" else "str") for c in ("board", "posting", "first_seen", "last_seen", "misses", "status", "closed_at")})

    def close(self) -> None:
        pass


def track_postings(crawls: DataFrame, keep_days: float = 400, clock: bool = False, late: str = "7 days") -> DataFrame:
    """Changed postings of each micro-batch. crawls: board, day (ISO text), outcome, job_ids (array); one row is one whole crawl.

    Crawls that come later than ``late`` behind the newest day are left out. With ``clock`` none is, and state ends by the clock instead; such a
    query runs until it is stopped.
    """
    processor = type("Tracker", (PostingTracker,), {"keep_days": keep_days, "clock": clock})()
    rows = crawls.select("board", "day", "outcome", "job_ids")
    if not clock:
        rows = rows.withColumn("at", F.to_timestamp("day")).withWatermark("at", late)
    out = "board string, posting string, first_seen string, last_seen string, misses int, status string, closed_at string"
    return rows.groupBy("board").transformWithStateInPandas(processor, out, "Update", "ProcessingTime" if clock else "EventTime")


class FixedWindow(StatefulProcessor):
    """State of one client: start of its window and requests in it, until event time has passed the window's end."""

    limit, seconds = 60, 60

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "start long, n int")

    def _end(self, start: int) -> int:
        """The first millisecond after a window that began at ``start`` microseconds."""
        return -(-(start + self.seconds * 1_000_000) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.window.get() if self.window.exists() else None
        start, n = (held[0], held[1]) if held else (None, 0)
        out = []
        for r in pd.concat(list(rows)).sort_values(["t", "request_id"], kind="stable").itertuples():
            if start is None or r.t - start >= self.seconds * 1_000_000:
                start, n = int(r.t), 0
            n += 1
            wait = max(1, -((int(r.t) - start - self.seconds * 1_000_000) // 1_000_000))
            out.append((key[0], r.request_id, n <= self.limit, max(self.limit - n, 0), wait))
        if start is not None and start != (held[0] if held else None):
            if held:
                self.handle.deleteTimer(self._end(held[0]))
            self.handle.registerTimer(self._end(start))
        if start is not None:
            self.window.update((start, n))
        yield pd.DataFrame(out, columns=["client", "request_id", "allowed", "remaining", "retry_after"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.window.get() if self.window.exists() else None
        if held and self._end(held[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.window.clear()
        yield pd.DataFrame({"client": [], "request_id": [], "allowed": [], "remaining": [], "retry_after": []}).astype(
            {"client": str, "request_id": "int64", "allowed": bool, "remaining": "int32", "retry_after": "int64"}
        )

    def close(self) -> None:
        pass


def window_verdicts(requests: DataFrame, limit: int = 60, seconds: int = 60, late: str = LATE) -> DataFrame:
    """Verdict of each request of a stream (client, ts, request_id) in windows that begin with a client's first request.

    A client's state goes once the watermark has passed its window's end. Requests that come later than ``late`` behind the newest are left out.
    """
    processor = type("Window", (FixedWindow,), {"limit": limit, "seconds": seconds})()
    rows = requests.select(F.col("client"), F.col("request_id"), F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late)
    rows = rows.withColumn("t", F.unix_micros("ts"))
    return rows.groupBy("client").transformWithStateInPandas(processor, "client string, request_id long, allowed boolean, remaining int, retry_after long", "Append", "EventTime")
