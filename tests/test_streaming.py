"""The review log as a stream: batches of files give the same states as the log read at once."""

from __future__ import annotations

import json
import random

import pytest
from cliploom.operators import review
from cliploom.sources import feed, jsonl
from cliploom.streaming import review as stream


def write(path, rows):
    names = ["video_id", "current_path", "status", "motion_score", "discovered_order", "seen_order", "line_no"]
    path.write_text("".join(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in rows))


def test_latest_states(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    write(folder / "1.json", [("a", "/a", "pending", 0.5, 1, None, 1), ("b", "/b", "pending", None, 2, None, 2)])
    write(folder / "2.json", [("a", "/keep/a", "accepted", 0.5, 0, 1, 3)])
    rows = stream.watched_log(spark, str(folder), 1)
    stream.run_once(stream.latest(rows), "states", str(tmp_path / "c1"), "complete")
    got = {r["video_id"]: (r["status"], r["current_path"], r["discovered_order"]) for r in spark.table("states").collect()}
    assert got == {"a": ("accepted", "/keep/a", 1), "b": ("pending", "/b", 2)}


def test_first_seen(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    write(folder / "1.json", [("a", "/1", "pending", None, 1, None, 1)])
    write(folder / "2.json", [("a", "/2", "pending", None, 1, None, 2), ("b", "/b", "pending", None, 2, None, 3)])
    stream.run_once(stream.first_seen(stream.watched_log(spark, str(folder), 1)), "firsts", str(tmp_path / "c2"), "append")
    assert sorted(r["video_id"] for r in spark.table("firsts").collect()) == ["a", "b"]


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, old)


ACTIONS = "video_id string, action string, action_no long, at timestamp"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(dict(zip(["video_id", "action", "action_no", "at"], r, strict=False))) + "\n" for r in rows))


def states_of(sink):
    """The last row of each video, as the sink's table has them batch by batch."""
    return {r["video_id"]: (r["status"], r["seen"]) for r in sink}


def run_decisions(spark, folder, checkpoint, seen, **how):
    rows = spark.readStream.schema(ACTIONS).option("maxFilesPerTrigger", 1).json(str(folder))
    query = (
        stream.decisions(rows, **how).writeStream.outputMode("update").option("checkpointLocation", str(checkpoint)).trigger(availableNow=True)
        .foreachBatch(lambda df, k: seen.extend(df.orderBy("action_no").collect())).start()
    )
    query.awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_decisions_of_shuffled_batches(spark, tmp_path, rocks, seed):
    """Whatever batch an action comes in, and over a restart, the stream ends with what all actions give at once."""
    rng = random.Random(seed)
    actions = [(f"v{rng.randrange(6)}", rng.choice(["view", "leave", "accept", "reject", "error", "dance"]) if rng.random() < 0.3 else rng.choice(["view", "leave"]), k) for k in range(60)]
    states = spark.createDataFrame([(f"v{k}", ["pending", "rejected"][k % 4 == 3]) for k in range(7)], "video_id string, status string")
    want = {r["video_id"]: (r["status"], r["seen"]) for r in review.decided(states, spark.createDataFrame(actions, "video_id string, action string, action_no long")).collect()}
    rng.shuffle(actions)
    seen: list = []
    for k in range(2):
        put(tmp_path / "in", f"{k}", actions[15 * k : 15 * k + 15])
    run_decisions(spark, tmp_path / "in", tmp_path / "c", seen, states=states)
    for k in (2, 3):
        put(tmp_path / "in", f"{k}", actions[15 * k : 15 * k + 15])
    run_decisions(spark, tmp_path / "in", tmp_path / "c", seen, states=states)
    got = states_of(seen)
    assert got == {v: want[v] for v in {a[0] for a in actions}}


def test_decisions_by_timer(spark, tmp_path, rocks):
    put(tmp_path / "in", "0", [("a", "view", 1, "2024-01-01T00:00:00Z"), ("b", "view", 2, "2024-01-01T00:00:30Z"), ("b", "reject", 3, "2024-01-01T00:00:40Z")])
    put(tmp_path / "in", "1", [("c", "view", 4, "2024-01-01T01:00:00Z")])
    put(tmp_path / "in", "2", [("d", "dance", 5, "2024-01-01T01:00:01Z")])
    seen: list = []
    run_decisions(spark, tmp_path / "in", tmp_path / "c", seen, idle=60_000, late="1 second")
    assert states_of(seen) == {"a": ("accepted", True), "b": ("rejected", True), "c": ("pending", True), "d": ("pending", False)}


def test_first_seen_is_forgotten(spark, tmp_path):
    """State rows stay few although every batch brings new videos; the first path is kept."""
    folder = tmp_path / "log"
    folder.mkdir()
    for k in range(12):
        rows = [{"video_id": f"v{k}-{i}", "path": f"/{k}/{j}", "at": f"2024-01-{k + 1:02d}T00:00:0{j}Z"} for i in range(20) for j in range(2)]
        (folder / f"{k:02d}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    log = spark.readStream.schema("video_id string, path string, at timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    query = stream.run_once(stream.first_seen(log.coalesce(1), "at", "1 hour"), "bounded", str(tmp_path / "c4"), "append")
    assert spark.table("bounded").count() == 240 and spark.table("bounded").where("path like '%/0'").count() == 240
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 60


def shaky(folder):
    class Shaky(feed.Recorded):
        """Fails twice for each page before it gives it."""

        def get(self, page):
            from pathlib import Path

            tries = Path(self.folder) / f"tries-{page}"
            n = len(tries.read_text()) if tries.exists() else 0
            tries.write_text("x" * (n + 1))
            if n < 2:
                raise ConnectionError("again")
            return super().get(page)

    return Shaky(folder)


def test_feed_as_a_source(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()

    def page(k, n):
        (pages / f"page-{k}.xml").write_text("<posts>" + "".join(f'<post id="{100 * k + i}" file_ext="mp4" file_url="u"/>' for i in range(n)) + "</posts>")

    page(1, 2), page(2, 2)
    got = feed.read_feed(spark, feed.Recorded(str(pages)), 5)
    assert got.rdd.getNumPartitions() == 5 and sorted(r["page"] for r in got.collect()) == [1, 2]
    assert sorted(r["id"] for r in jsonl.posts(got).collect()) == [100, 101, 200, 201]
    assert sorted(r["page"] for r in feed.read_feed(spark, shaky(str(pages)), 3, name="shaky", wait=0.01).collect()) == [1, 2]
    assert (pages / "tries-1").read_text() == "xxx"
    for p in pages.glob("tries-*"):
        p.unlink()
    with pytest.raises(Exception, match="again"):
        feed.read_feed(spark, shaky(str(pages)), 3, name="shakier", attempts=2, wait=0.01).collect()
    seen: list = []

    def follow():
        rows = feed.watch_feed(spark, feed.Recorded(str(pages)), name="watched")
        rows.writeStream.option("checkpointLocation", str(tmp_path / "c5")).trigger(availableNow=True).foreachBatch(lambda df, k: seen.append(sorted(r["page"] for r in df.collect()))).start().awaitTermination()

    follow()
    page(3, 1)
    follow()
    assert [x for x in seen if x] == [[1, 2], [3]]


def test_windowed_counts(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = tmp_path / "events"
    events.write.parquet(str(source))
    rows = spark.readStream.schema(events.schema).parquet(str(source))
    stream.run_once(stream.windowed_counts(rows), "windows", str(tmp_path / "c3"), "update")
    assert spark.table("windows").groupBy().sum("cnt").first()[0] >= events.count()
