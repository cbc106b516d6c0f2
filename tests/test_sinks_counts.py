from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vecshelf.operators.compare import arm_metrics
from vecshelf.operators.counts import RunCounts
from vecshelf.operators.embed import HashingEncoder
from vecshelf.plans.baseline import baseline_lists, baseline_tokens
from vecshelf.plans.deep import deep_lists
from vecshelf.sinks import records as R


def at(day):
    return F.lit(datetime(2024, 1, day))


def test_publish_twice_and_expire(spark, tmp_path):
    path = str(tmp_path / "records")
    first = spark.createDataFrame([(1, "2,3"), (2, "1")], "id int, value string")
    later = spark.createDataFrame([(1, "4")], "id int, value string")
    R.publish(first, None, at(1), path=path, ttl_s=3 * 86400)
    R.publish(later, None, at(3), path=path, ttl_s=3 * 86400)
    R.publish(later, None, at(3), path=path, ttl_s=3 * 86400)  # a repeated run
    stored = spark.read.parquet(path)
    seen = lambda day: {r["key"]: r["value"] for r in R.live(stored, at(day)).collect()}
    assert seen(3) == {"dj_similar:1": "4", "dj_similar:2": "1"}
    assert seen(4) == {"dj_similar:1": "4"}  # expiry is at the instant itself
    assert seen(6) == {}
    row = R.latest(stored).where("key = 'dj_similar:1'").first()
    assert row["expires_at"] - row["written_at"] == timedelta(days=3)


def test_models_do_not_overwrite_each_other(spark):
    lists = spark.createDataFrame([(1, "2")], "id int, value string")
    keys = [R.records(lists, m, at(1)).first()["key"] for m in ("deep", "baseline", None)]
    assert keys == ["dj_similar:deep:1", "dj_similar:baseline:1", "dj_similar:1"]


def test_writer_gets_batches(spark, tmp_path):
    lists = spark.range(25).select("id", F.lit("x").alias("value")).coalesce(1)
    folder = str(tmp_path)

    def open_store():
        import uuid

        def write(batch):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(key for key, value, expires_at in batch))

        return write

    R.publish(lists, "m", at(1), writer=open_store, batch=10)
    batches = [p.read_text().split("\n") for p in tmp_path.iterdir()]
    assert max(map(len, batches)) <= 10
    assert sorted(k for b in batches for k in b) == sorted(f"dj_similar:m:{i}" for i in range(25))


def test_counts(spark):
    catalogue = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "id int, name string")
    counts = RunCounts()
    lists, rejects = deep_lists(catalogue, lambda: HashingEncoder(4), 4, counts=counts)
    assert {r["id"] for r in lists.collect()} == {1, 3, 4}
    assert rejects.count() == 1
    row = counts.summary(spark, parts=("embedded", "rejected")).first()
    assert row.asDict() == {
        "loaded": 4, "cleaned": 3, "embedded": 3, "rejected": 1, "searched": 3, "balanced": True,
    }
    counts.check()
    with pytest.raises(ValueError):
        counts.check(parts=("embedded",))
    with pytest.raises(ValueError):
        counts.watch("loaded", catalogue)


def test_baseline_keeps_ids_with_their_lists(spark):
    """A name the segmenter fails on goes to the rejects and shifts nothing."""

    def cut(text):
        if "bad" in text:
            raise ValueError
        return text.split()

    catalogue = spark.createDataFrame(
        [(1, "aa bb"), (2, "bad"), (3, "aa bb"), (4, "cc dd"), (5, "cc dd"), (6, None), (7, "unknown")], "id int, name string"
    )
    words = spark.createDataFrame([("aa", [1.0, 0.0]), ("bb", [1.0, 0.0]), ("cc", [0.0, 1.0]), ("dd", [0.0, 5.0])], "token string, vec array<float>")
    tokens, rejects = baseline_tokens(catalogue, [], cut)
    assert tokens.count() == 5
    assert {(r["id"], r["reason"]) for r in rejects.collect()} == {(2, "segmenter_failed"), (6, "null_name")}
    lists = {r["id"]: r["value"] for r in baseline_lists(catalogue, words, [], cut, dim=2, k=1)[0].collect()}
    assert lists == {1: "3", 3: "1", 4: "5", 5: "4", 7: "1"}
    fewer, left = baseline_lists(catalogue, words, [], cut, dim=2, k=1, skip_empty=True)
    assert {r["id"]: r["reason"] for r in left.collect()} == {2: "segmenter_failed", 6: "null_name", 7: "no_known_word"}
    assert {r["id"] for r in fewer.collect()} == {1, 3, 4, 5}


def test_arms_are_stable_per_user(spark):
    events = spark.createDataFrame(
        [(u, "view", float(u % 5)) for u in range(200) for _ in range(2)], "user_id bigint, event_type string, value double"
    )
    rows = arm_metrics(events, arms=3).collect()
    assert sum(r["users"] for r in rows) == 200
    assert all(r["events"] == 2 * r["users"] for r in rows)
    assert {r["arm"] for r in rows} == {0, 1, 2}
