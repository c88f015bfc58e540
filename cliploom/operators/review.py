"""The review log: latest state of every video, the order of the queue, where to start, neighbours, scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.media import coerced_state
from .ordering import numbered, walked


def latest_states(log: DataFrame) -> DataFrame:
    """log: video_id, status, motion_score, discovered_order, seen_order, line_no. The last row of each video, but a
    discovery order once given stays; videos without one are numbered behind the others, by first appearance."""
    fields = [c for c in log.columns if c not in ("video_id", "line_no", "discovered_order")]
    state = log.groupBy("video_id").agg(
        *[F.max_by(F.struct(c), "line_no")[c].alias(c) for c in fields],
        F.max_by(F.when(F.col("discovered_order") != 0, F.col("discovered_order")), F.when(F.col("discovered_order") != 0, F.col("line_no"))).alias("discovered_order"),
        F.min("line_no").alias("_first"),
    )
    top = state.agg(F.coalesce(F.max("discovered_order"), F.lit(0)).alias("_top")).withColumn("k", F.lit(1))
    # only videos that have no order at all are numbered here, one after the other
    new = numbered(state.where("discovered_order is null").select("video_id", "_first"), [F.col("_first"), F.col("video_id")], "_n").drop("_first")
    out = state.join(new, "video_id", "left").withColumn("k", F.lit(1)).join(F.broadcast(top), "k")
    out = out.withColumn("discovered_order", F.coalesce("discovered_order", F.col("_top") + F.col("_n")).cast("long")).select("video_id", *fields, "discovered_order")
    # what is no status of a video counts as pending
    return out.withColumn("status", coerced_state(F.col("status"))) if "status" in fields else out


def order_marks(states: DataFrame) -> DataFrame:
    return states.agg(F.coalesce(F.max("discovered_order"), F.lit(0)).alias("max_discovered"), F.coalesce(F.max("seen_order"), F.lit(0)).alias("max_seen"))


def queue_key(seen: Column, motion: Column, discovered: Column, video: Column) -> Column:
    """Sorts seen videos as seen, then the others by motion (unknown last), discovery and id."""
    unseen = seen.isNull()
    return F.struct(
        unseen.alias("unseen"),
        F.coalesce(seen, F.lit(0)).alias("seen"),
        (unseen & motion.isNull()).alias("no_motion"),
        F.when(unseen, F.coalesce(motion, F.lit(0.0))).otherwise(0.0).alias("motion"),
        discovered.alias("discovered"),
        video.alias("video"),
    )


def queue(states: DataFrame) -> DataFrame:
    """position (1, 2, ...) and video_id in the order of the queue. Ranges are sorted apart and then counted through."""
    key = queue_key(F.col("seen_order"), F.col("motion_score"), F.col("discovered_order"), F.col("video_id"))
    return numbered(states.withColumn("_k", key), [F.col("_k")], "position").drop("_k")


def neighbours(queued: DataFrame) -> DataFrame:
    """previous and next video of each, itself at the ends; positions are joined, so no task holds the queue."""
    at = queued.select("position", "video_id")
    back = at.select((F.col("position") + 1).alias("position"), F.col("video_id").alias("previous"))
    ahead = at.select((F.col("position") - 1).alias("position"), F.col("video_id").alias("next"))
    out = at.join(back, "position", "left").join(ahead, "position", "left")
    return out.select("position", "video_id", F.coalesce("previous", "video_id").alias("previous"), F.coalesce("next", "video_id").alias("next"))


def preview_candidates(queued: DataFrame, position: int, size: int = 8) -> DataFrame:
    """What to preload around a position: it, then +1, -1, +2, -2, ..."""
    gap = F.col("position") - position
    near = queued.where(F.abs(gap) <= size)
    return near.orderBy(F.abs(gap), gap < 0).limit(size).select("position", "video_id")


def start(states: DataFrame) -> DataFrame:
    """The first pending video not yet seen, else the first seen pending one, else the last of the queue."""
    key = queue_key(F.col("seen_order"), F.col("motion_score"), F.col("discovered_order"), F.col("video_id"))
    pending, unseen = F.col("status") == "pending", F.col("seen_order").isNull()
    seen_key = F.struct(F.coalesce(F.nullif("seen_order", F.lit(0)), F.lit(2**62)), "discovered_order", "video_id")
    return states.agg(
        F.coalesce(
            F.min_by("video_id", F.when(pending & unseen, key)),
            F.min_by("video_id", F.when(pending & ~unseen, seen_key)),
            F.max_by("video_id", key),
        ).alias("video_id")
    )


def scanned(states: DataFrame, listing: DataFrame) -> DataFrame:
    """A scan merged into the states: pending videos take their current path from the listing (video_id, path)."""
    first = listing.groupBy("video_id").agg(F.min("path").alias("_path"))
    known = states.join(first, "video_id", "left")
    return known.withColumn("current_path", F.when((F.col("status") == "pending") & F.col("_path").isNotNull(), F.col("_path")).otherwise(F.col("current_path"))).drop("_path")


def newly_found(states: DataFrame, listing: DataFrame) -> DataFrame:
    """Listed videos that have no state yet; of those with one id, the first path."""
    return listing.join(states, "video_id", "left_anti").groupBy("video_id").agg(F.min("path").alias("path"))


def status_summary(rows: DataFrame, column: str = "status") -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("cnt"))


def motion_scores(frames: DataFrame) -> DataFrame:
    """frames: video_id, frame, luma (array). Mean over neighbouring frames of the mean absolute difference, by 255;
    0 with fewer than two frames."""
    w = Window.partitionBy("video_id").orderBy("frame")
    pairs = frames.withColumn("before", F.lag("luma").over(w))
    gap = F.aggregate(F.zip_with("luma", "before", lambda a, b: F.abs(a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x) / F.size("luma")
    scored = pairs.withColumn("gap", F.when(F.col("before").isNotNull(), gap))
    return scored.groupBy("video_id").agg((F.coalesce(F.avg("gap"), F.lit(0.0)) / 255).alias("motion_score"))


DECISIONS = {"accept": "accepted", "reject": "rejected", "error": "error"}


def decided(states: DataFrame, actions: DataFrame) -> DataFrame:
    """states: video_id and status; actions: video_id, action and action_no. Gives video_id, status and seen after the actions
    of each video in order: viewing marks it as seen; accepting, rejecting or an error set its status, also against an earlier
    decision; leaving a video that is seen and pending accepts it. Other actions change nothing; videos without actions stay.

    So the last decision counts; without one, a pending video is accepted if it was left after it was first viewed. These are
    partial aggregates: a video with most of all actions is one row a task. An action without a number is before all others."""
    no = F.coalesce("action_no", F.lit(-(2**63)).cast("long"))
    said = actions.groupBy("video_id").agg(
        F.max_by("action", F.when(F.col("action").isin(*DECISIONS), F.struct(no.alias("n"), F.col("action")))).alias("said"),
        F.min(F.when(F.col("action") == "view", no)).alias("viewed"),
        F.max(F.when(F.col("action") == "leave", no)).alias("gone"),
    )
    to = F.coalesce(*[F.when(F.col("said") == k, v) for k, v in DECISIONS.items()])
    left = F.when((F.col("status") == "pending") & (F.col("gone") > F.col("viewed")), "accepted")
    return states.select("video_id", "status").join(said, "video_id", "left").select("video_id", F.coalesce(to, left, "status").alias("status"), F.col("viewed").isNotNull().alias("seen"))


#: How far an action takes a reviewer along the queue.
STEPS = {"accept": 1, "reject": 1, "next": 1, "previous": -1}


def session_queue(states: DataFrame) -> DataFrame:
    """position, video_id and current, of a session's queue: where it starts counts as seen, the last of those that are."""
    begin = start(states).select(F.col("video_id").alias("_begin"))
    top = states.agg((F.coalesce(F.max("seen_order"), F.lit(0)) + 1).alias("_top"))
    at = begin.withColumn("k", F.lit(1)).join(top.withColumn("k", F.lit(1)), "k")  # one row
    current = F.col("video_id").eqNullSafe(F.col("_begin"))
    marked = states.withColumn("k", F.lit(1)).join(F.broadcast(at), "k").withColumn("seen_order", F.when(current, F.coalesce("seen_order", "_top")).otherwise(F.col("seen_order")))
    return queue(marked.withColumn("current", current)).select("position", "video_id", "current")


def replayed(states: DataFrame, actions: DataFrame) -> DataFrame:
    """A session's actions (action_no, action) in order: action_no, action, the video that it was done to, and moved_to, the
    video that is shown after it. Accepting and rejecting go on to the next video of the queue, next and previous go one along;
    at an end they stay; others stay, too. A video that is gone on to counts as seen from then on, behind those that are, and so keeps its
    place: the order is fixed, and where the reviewer stands is a walk between its ends. No videos: no rows."""
    queued = session_queue(states)
    size = queued.count()
    if not size:
        return actions.limit(0).select("action_no", "action", F.lit(None).cast("string").alias("video_id"), F.lit(None).cast("string").alias("moved_to"))
    begin = queued.where("current").first()["position"]
    step = F.coalesce(*[F.when(F.col("action") == k, v) for k, v in STEPS.items()], F.lit(0))
    rows = walked(actions.select("action_no", "action"), [F.col("action_no"), F.col("action")], step, begin, 1, size, "position")
    after = F.least(F.greatest(F.col("position") + step, F.lit(1)), F.lit(size)).cast("long")
    at, to = (queued.select(F.col("position").alias(p), F.col("video_id").alias(v)) for p, v in (("position", "video_id"), ("_after", "moved_to")))
    return rows.withColumn("_after", after).join(at, "position").join(to, "_after").select("action_no", "action", "video_id", "moved_to")


def session_states(states: DataFrame, replay: DataFrame) -> DataFrame:
    """video_id, status and seen after a replayed session: what was decided, and what was left while pending is accepted."""
    begin = start(states).select("video_id", F.lit("view").alias("action"), F.lit(None).cast("long").alias("action_no"))
    moved = ~F.col("video_id").eqNullSafe(F.col("moved_to"))
    done = replay.select("video_id", F.when(F.col("action").isin("next", "previous"), F.when(moved, "leave")).otherwise(F.col("action")).alias("action"), "action_no")
    views = replay.where(moved).select(F.col("moved_to").alias("video_id"), F.lit("view").alias("action"), "action_no")
    return decided(states, begin.unionByName(done).unionByName(views))


def existing_sources(states: DataFrame, listing: DataFrame, folders: tuple[str, str, str]) -> DataFrame:
    """states: video_id, current_path, relative_path, original_path; listing: path of files that exist; folders: of input, kept
    and rejected videos. Gives video_id and source_path: the first of the present path, the relative one below each folder, and
    the original path that exists; null if none does."""
    below = [F.concat(F.lit(f.rstrip("/") + "/"), "relative_path") for f in folders]
    asked = states.select("video_id", F.posexplode(F.array("current_path", *below, "original_path")).alias("k", "path"))
    found = asked.join(listing.select("path").distinct(), "path").groupBy("video_id").agg(F.min_by("path", "k").alias("source_path"))
    return states.select("video_id").join(found, "video_id", "left")
