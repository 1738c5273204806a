"""Idle-time sessions, tumbling and sliding windows, and late-row rejection over event time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import tracker
from ..session import ship


def stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New Parquet files below a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def sessions(df: DataFrame, key: str, at: str = "ts", gap: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(key, start, end, n): rows of a key at most `gap` apart; a session leaves when it has been idle that long."""
    w = df.withWatermark(at, late).groupBy(F.col(key), F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"))
    return w.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windows(df: DataFrame, key: str, at: str = "ts", size: str = "30 minutes", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """(key, start, n) over tumbling windows, or sliding ones if `slide` is given."""
    w = df.withWatermark(at, late).groupBy(F.col(key), F.window(at, size, slide or size).alias("w")).agg(F.count("*").alias("n"))
    return w.select(key, F.col("w.start").alias("start"), "n")


def once(df: DataFrame, keys: list[str], at: str = "ts", late: str = "1 hour") -> DataFrame:
    """Every key once within the watermark; rows later than it are dropped."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def track_arrays(df: DataFrame, at: str = "ts", gap: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(track_id, frame_id, projected): the arrays of a track that has been idle for `gap`, of rows (track_id, frame, x, y, at)."""
    w = df.withWatermark(at, late).groupBy("track_id", F.session_window(at, gap).alias("w"))
    g = w.agg(F.array_sort(F.collect_list(F.struct(F.col("frame").alias("f"), F.array("x", "y").alias("p")))).alias("i"))
    return g.select("track_id", F.transform("i", lambda s: s["f"]).alias("frame_id"), F.transform("i", lambda s: s["p"]).alias("projected"))


class _Keyed(StatefulProcessor):
    """State of a key that goes when event time has passed its last row by `idle` milliseconds: one timer a key, set anew with every batch.

    `step(key, rows)` gives the rows that leave, `clear()` drops the key's state."""

    def __init__(self, by: list[str], at: str, idle: int):
        self.by, self.at, self.idle = by, at, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "due long")
        self.open(handle)

    def handleInputRows(self, key, rows, timerValues):
        table = pd.concat(list(rows))
        due = self.timer.get()[0] if self.timer.exists() else None
        new = int(table["event_ms"].max()) + self.idle
        if due is None or new > due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(new)
            self.timer.update((new,))
        yield self.step(key, table)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        self.clear()
        return iter(())

    def keyed(self, key, n: int) -> dict:
        return {c: [k] * n for c, k in zip(self.by, key)}

    def close(self) -> None:
        pass


def _stateful(df: DataFrame, processor: _Keyed, late: str, schema: T.StructType) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    # the store that holds typed state and timers
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = df.withColumn("event_ms", F.unix_millis(processor.at)).withWatermark(processor.at, late)
    return rows.groupBy(*processor.by).transformWithStateInPandas(processor, schema, "append", "eventtime")


def _schema(df: DataFrame, by: list[str], more: str) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in by], *T.StructType.fromDDL(more).fields])


class _Tracks(_Keyed):
    """The tracks alive, one entry each, and (next, first, last): the next number, the first frame and the last."""

    def __init__(self, by, at, idle, p):
        super().__init__(by, at, idle)
        self.p = p

    def open(self, handle):
        self.tracks = handle.getMapState("tracks", "id long", "seen long, hits long, mean array<double>, cov array<double>")
        self.frames = handle.getValueState("frames", "next long, first long, last long")

    def step(self, key, table):
        held, last = tracker.Tracker(self.p), None
        if self.frames.exists():
            held.next, held.first, last = self.frames.get()
            held.tracks = [tracker._Track.unpacked(k[0], *v) for k, v in self.tracks.iterator()]
        before = {t.id for t in held.tracks}
        rows = table.sort_values(["frame", "conf", *tracker.BOX], ascending=[True, False, True, True, True, True], kind="stable")
        if last is not None:
            rows = rows[rows["frame"] > last]
        ids = [np.empty(0, int)]
        for f, g in rows.groupby("frame", sort=True):
            ids.append(held.update(int(f), g[tracker.BOX].to_numpy(float), g["conf"].to_numpy(float)))
            last = int(f)
        for number in before - {t.id for t in held.tracks}:
            self.tracks.removeKey((number,))
        for t in held.tracks:
            self.tracks.updateValue((t.id,), t.packed())
        if last is not None:
            self.frames.update((held.next, held.first, last))
        ids = np.concatenate(ids)
        out = pd.DataFrame(self.keyed(key, len(rows))).assign(**{c: rows[c].to_numpy() for c in ("frame", *tracker.BOX, "conf")})
        return out.assign(track=pd.array([None if t < 0 else int(t) for t in ids], dtype="Int64"))

    def clear(self):
        self.tracks.clear()
        self.frames.clear()


def _milliseconds(spark: SparkSession, interval: str) -> int:
    """A length of time as whole milliseconds."""
    return int(float(spark.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {interval})").first()[0]))


def tracked(df: DataFrame, by: list[str], p: tracker.Association = tracker.Association(), at: str = "ts", late: str = "10 seconds", fps: float = 30.0) -> DataFrame:
    """(by, frame, x1, y1, x2, y2, conf, track) of a stream of boxes with event time `at`; track is null for boxes that belong to none.

    The state of a key, such as (file, class), is its tracks alive, an entry each, and three numbers; another file is another key, so state
    never passes from one to the next. When event time has passed a key's last row by the time for which a lost track is kept (p.buffer
    frames at `fps`), all its state goes; should the key come again later, its numbers begin anew. Frames not beyond the last one are late
    and dropped, and so are rows older than the watermark (`late`).
    """
    out = _schema(df, by, "frame bigint, x1 double, y1 double, x2 double, y2 double, conf double, track bigint")
    return _stateful(df, _Tracks(by, at, int(1000 * p.buffer / fps), p), late, out)


class _Ring(_Keyed):
    """tracker.Ring: its counters and the frames held."""

    def __init__(self, by, at, idle, sizes):
        super().__init__(by, at, idle)
        self.sizes = sizes

    def open(self, handle):
        self.state = handle.getValueState("ring", "clip long, left long, wait long, held array<bigint>")

    def step(self, key, table):
        ring = tracker.Ring(*self.sizes)
        if self.state.exists():
            ring.clip, ring.left, ring.wait, held = self.state.get()
            ring.held.extend(held)
        rows = table.sort_values("frame", kind="stable")
        found = [r for f, t in zip(rows["frame"], rows["trigger"]) for r in ring.push(int(f), bool(t))]
        self.state.update((ring.clip, ring.left, ring.wait, list(ring.held)))
        return pd.DataFrame([(*key, *r) for r in found], columns=[*self.by, "clip", "frame"])

    def clear(self):
        self.state.clear()


def ring_clips(df: DataFrame, by: list[str], before: int = 150, after: int = 150, skip: int = 900, at: str = "ts", late: str = "10 seconds", idle: str = "10 minutes") -> DataFrame:
    """(by, clip, frame) of a stream of (by, frame, trigger, at): tracker.Ring is the state of a key, such as a file; it goes when the key has
    been `idle` so long."""
    processor = _Ring(by, at, _milliseconds(df.sparkSession, idle), (before, after, skip))
    return _stateful(df, processor, late, _schema(df, by, "clip bigint, frame bigint"))


class _Ascending(_Keyed):
    """The greatest frame so far."""

    def open(self, handle):
        self.top = handle.getValueState("top", "frame long")

    def step(self, key, table):
        top = self.top.get()[0] if self.top.exists() else None
        kept = []
        for f in table["frame"]:
            if top is None or f > top:
                top = int(f)
                kept.append((*key, top))
        if top is not None:
            self.top.update((top,))
        return pd.DataFrame(kept, columns=[*self.by, "frame"])

    def clear(self):
        self.top.clear()


def ascending(df: DataFrame, by: list[str], at: str = "ts", late: str = "10 seconds", idle: str = "10 minutes") -> DataFrame:
    """(by, frame) of a stream of (by, frame, at): only frames beyond every one of the key that came before, as long as the key isn't `idle`;
    late ones are rejected."""
    return _stateful(df, _Ascending(by, at, _milliseconds(df.sparkSession, idle)), late, _schema(df, by, "frame bigint"))


def drain(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now and gives its rows as a table in memory; for tests and small results."""
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)
