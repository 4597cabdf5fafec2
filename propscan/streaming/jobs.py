"""Structured Streaming over files and events. Times are instants (cast from zone-less times first)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from propscan.sources.snapshots import exploded


def land(spark: SparkSession, folder: str, target: str, checkpoint: str):
    """Land new snapshot files as one row a listing; runs through what is there and stops."""
    raw = spark.readStream.option("wholetext", True).text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    rows = exploded(raw).where("listing_key is not null")
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def first_seen(stream: DataFrame, key: str, ts: str, delay: str = "14 days") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, kind: str, width: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Counts a window and kind: weekly statistics, error rates of logs."""
    t = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return t.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def sessions(stream: DataFrame, ts: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    t = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return t.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """A key's records of one batch as tuples without the key, by their times, those without one first; unknown values are None."""
    rows = pd.concat(list(frames)).drop(columns="listing_id").sort_values("scraped_at", kind="stable", na_position="first")
    columns = [[None if n else v for v, n in zip(rows[c].tolist(), rows[c].isna().tolist(), strict=True)] for c in rows]
    return zip(*columns, strict=True)


def changes(stream: DataFrame, drop: float = -0.03, ttl: str | None = None) -> DataFrame:
    """``listing_id, change, price`` against the last announced state: new, price_drop or new_deadline.

    ``stream``: ``listing_id, price, deadline, scraped_at`` (a long or a time). State is one announced record a listing and the
    time of the latest record seen; a price or deadline that is unknown (null or NaN) changes nothing, and the last known one
    stays and is told. Records of a batch are taken in the order of their times; one that is older than what a batch before
    held is late and says nothing new, so it is left out. With ``ttl`` the state of a listing ends so long (of processing time)
    after its last record, and it is new then; such a query looks for ended states without end, so it needs a trigger that goes on.
    """
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000) if ttl else None

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        if state.hasTimedOut:
            state.remove()
        else:
            was = state.get if state.exists else None
            for price, deadline, at in _in_order(frames):
                at = -(1 << 63) if at is None else int(at)
                if was is not None and at < was[2]:
                    continue
                change = None
                if was is None:
                    change, was = "new", (None, None, at)
                elif price is not None and was[0] and price / was[0] - 1 <= drop:
                    change = "price_drop"
                elif deadline is not None and deadline != was[1]:
                    change = "new_deadline"
                told = change is not None
                was = (price if price is not None and (told or was[0] is None) else was[0], deadline if told and deadline is not None else was[1], at)
                if told:
                    out.append((key[0], change, was[0]))
            state.update(was)
            if ttl_ms:
                state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame(out, columns=["listing_id", "change", "price"])

    rows = stream.select("listing_id", F.nanvl(F.col("price").cast("double"), F.lit(None)).alias("price"), F.col("deadline").cast("string").alias("deadline"), F.col("scraped_at").cast("long").alias("scraped_at"))
    kind = "price double, deadline string, seen long"
    return rows.groupBy("listing_id").applyInPandasWithState(run, "listing_id string, change string, price double", kind, "append", GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout)


def rechecks(stream: DataFrame, wait: str = "90 days", delay: str = "1 day") -> DataFrame:
    """``listing_id, event, deadline`` of auctions that ended: ``again`` when a later record has a later deadline, ``lapsed`` when
    ``wait`` after the deadline nothing came.

    ``stream``: ``listing_id, deadline, scraped_at`` (times). A timer on event time ends the wait and the state, which is one
    deadline a listing. A deadline that is moved before it has passed is no re-listing and only moves the timer.
    """
    wait_ms = int(pd.Timedelta(wait).total_seconds() * 1000)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        if state.hasTimedOut:
            out.append((key[0], "lapsed", pd.Timestamp(state.get[0], unit="ms")))
            state.remove()
        else:
            held = state.get[0] if state.exists else None
            for at, deadline in _in_order(frame[["listing_id", "scraped_at", "deadline"]] for frame in frames):
                if deadline is None:
                    continue
                deadline = int(deadline.value // 1_000_000)
                if held is not None and deadline > held and at is not None and held < int(at.value // 1_000_000):
                    out.append((key[0], "again", pd.Timestamp(deadline, unit="ms")))
                held = deadline if held is None else max(held, deadline)
            if held is not None:
                state.update((held,))
                state.setTimeoutTimestamp(max(held + wait_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["listing_id", "event", "deadline"])

    rows = stream.withColumns({c: F.col(c).cast("timestamp") for c in ("deadline", "scraped_at")}).withWatermark("scraped_at", delay)
    return rows.groupBy("listing_id").applyInPandasWithState(run, "listing_id string, event string, deadline timestamp", "deadline long", "append", GroupStateTimeout.EventTimeTimeout)


def with_last_good(stream: DataFrame, loads: DataFrame) -> DataFrame:
    """Stream-static join: each row with its source's last good load date."""
    good = loads.where("ok").groupBy("source").agg(F.max("run_date").alias("last_good"))
    return stream.join(good, "source", "left")
