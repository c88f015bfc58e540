"""The review log and folder as streams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.review import DECISIONS

LOG = "video_id string, current_path string, status string, motion_score double, discovered_order long, seen_order long, line_no long"


def watched_log(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Rows of JSON-Lines files as they appear in a folder."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def latest(log: DataFrame) -> DataFrame:
    """Latest row of each video; for update or complete mode. line_no orders rows, also within a micro-batch."""
    row = F.struct("status", "current_path", "motion_score", "seen_order")
    return log.groupBy("video_id").agg(
        F.max_by(row, "line_no").alias("r"),
        F.max_by("discovered_order", F.when(F.col("discovered_order") != 0, F.col("line_no"))).alias("discovered_order"),
        F.max("line_no").alias("line_no"),
    ).select("video_id", "r.*", "discovered_order", "line_no")


def first_seen(log: DataFrame, time: str | None = None, late: str = "1 day") -> DataFrame:
    """Each video once, as it first appears. With the name of a time column, a video is remembered until the watermark has
    passed its row by as much as late, so what is kept is bounded; without one (or on a table) it is remembered for ever."""
    if time is None:
        return log.dropDuplicates(["video_id"])
    return log.withWatermark(time, late).dropDuplicatesWithinWatermark(["video_id"])


class Deciding(StatefulProcessor):
    """What :func:`cliploom.operators.review.decided` gives, as actions come in, in whatever order: by video the last decision, the
    first view and the last leave. With idle, a video that is seen and pending counts as left when no action on it has come
    for so many milliseconds of event time."""

    FIELDS = "base string, said string, said_no long, viewed long, gone long, latest long, timer long"
    OUT = "video_id string, status string, seen boolean, action_no long"
    #: The number of a leave by timer.
    IDLE = 2**62

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("video", self.FIELDS)

    def _state(self) -> dict:
        names = [f.split()[0] for f in self.FIELDS.split(", ")]
        return dict(zip(names, self.kept.get(), strict=True)) if self.kept.exists() else {n: None for n in names} | {"base": "pending"}

    def _row(self, key: tuple, s: dict) -> Row:
        left = s["base"] == "pending" and s["viewed"] is not None and s["gone"] is not None and s["gone"] > s["viewed"]
        status = DECISIONS[s["said"]] if s["said"] else "accepted" if left else s["base"]
        return Row(video_id=key[0], status=status, seen=s["viewed"] is not None, action_no=s["latest"])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.kept.update(tuple((self._state() | {"base": initialState.status or "pending"}).values()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s, at = self._state(), None
        for r in rows:
            no = -(2**63) if r.action_no is None else r.action_no
            s["latest"] = no if s["latest"] is None else max(s["latest"], no)
            if r.action in DECISIONS and (s["said"] is None or (no, r.action) > (s["said_no"], s["said"])):
                s["said"], s["said_no"] = r.action, no
            elif r.action == "view":
                s["viewed"] = no if s["viewed"] is None else min(s["viewed"], no)
            elif r.action == "leave":
                s["gone"] = no if s["gone"] is None else max(s["gone"], no)
            if self.idle is not None and r.at is not None:
                at = max(at or 0, int(r.at.timestamp() * 1000))
        out = self._row(key, s)
        if self.idle is not None:
            if s["timer"] is not None and (at is not None or out.status != "pending"):
                self.handle.deleteTimer(s["timer"])
                s["timer"] = None
            if at is not None and out.seen and out.status == "pending":
                s["timer"] = max(at + self.idle, timerValues.getCurrentWatermarkInMs() + 1)
                self.handle.registerTimer(s["timer"])
        self.kept.update(tuple(s.values()))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self._state() | {"gone": self.IDLE, "timer": None}
        self.kept.update(tuple(s.values()))
        yield self._row(key, s)

    def close(self) -> None:
        pass


def decisions(actions: DataFrame, states: DataFrame | None = None, idle: int | None = None, late: str = "10 minutes") -> DataFrame:
    """A stream of actions (video_id, action, action_no; with idle also at, their time) as a stream of states: a row for every
    video that a micro-batch has actions on, or that is left by timer; the last row of a video is its state. states: video_id
    and status to begin with. Needs the RocksDB state store, so state lies on disk and is restored from the checkpoint."""
    timed = actions.withWatermark("at", late) if idle is not None else actions
    begun = states.select("video_id", "status").groupBy("video_id") if states is not None else None
    return timed.groupBy("video_id").transformWithState(
        statefulProcessor=Deciding(idle), outputStructType=Deciding.OUT, outputMode="Update", timeMode="EventTime" if idle is not None else "None", initialState=begun
    )


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """events: ts, event_type. Counts by window and type; rows later than late are dropped."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("cnt"))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "cnt")


def run_once(stream: DataFrame, name: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Processes what is there, into a table in memory, and stops."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
