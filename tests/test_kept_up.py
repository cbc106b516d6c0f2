"""What is kept up from run to run: versions, stored vectors, snapshot differences, repaired lists, streams."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecshelf.checks.registered import scratch
from vecshelf.operators import neighbours, repair, tree
from vecshelf.operators.difference import difference, fingerprints
from vecshelf.operators.embed import HashingEncoder, embed, embed_stored
from vecshelf.plans.daily import run_changes, run_snapshot
from vecshelf.sinks.shelf import Conflict, Shelf
from vecshelf.streaming.publish import publish_stream

def NOW():
    return F.lit("2024-01-08 00:00:00").cast("timestamp")



def pairs(spark, rows):
    return spark.createDataFrame(rows, "id bigint, value string")


def put(shelf, rows, gone=None, tag=None):
    change = shelf.begin(tag)
    touched = change.upsert("t", ["id"], rows, gone)
    change.commit()
    return touched


def held(shelf):
    return sorted(map(tuple, shelf.read("t").collect()))


def test_upserts_and_versions(spark):
    path = scratch(spark)
    shelf = Shelf(spark, path, buckets=8)
    assert shelf.read("t") is None and shelf.version == 0
    put(shelf, pairs(spark, [(i, "a") for i in range(40)]))
    put(shelf, pairs(spark, [(3, "b"), (99, "c")]), spark.range(5, 7))
    wanted = [(i, "b" if i == 3 else "a") for i in range(40) if i not in (5, 6)] + [(99, "c")]
    assert held(shelf) == wanted == held(Shelf(spark, path))
    put(shelf, pairs(spark, []), spark.range(0, 100))
    assert held(shelf) == []


def test_a_run_that_ends_early_changes_nothing(spark, monkeypatch):
    path = scratch(spark)
    shelf = Shelf(spark, path, buckets=4)
    put(shelf, pairs(spark, [(1, "a"), (2, "b")]))
    change = shelf.begin()
    change.upsert("t", ["id"], pairs(spark, [(1, "z")]))  # written, but never committed
    assert held(Shelf(spark, path)) == [(1, "a"), (2, "b")] == held(shelf)
    put(Shelf(spark, path), pairs(spark, [(2, "y")]))
    with pytest.raises(Conflict):
        change.commit()  # another run was faster
    assert held(Shelf(spark, path)) == [(1, "a"), (2, "y")]


def test_only_touched_buckets_are_read(spark, monkeypatch):
    shelf = Shelf(spark, scratch(spark), buckets=16)
    put(shelf, pairs(spark, [(i, "a") for i in range(200)]))
    reads = []
    real = Shelf.read
    monkeypatch.setattr(Shelf, "read", lambda self, name, buckets=None: reads.append(buckets) or real(self, name, buckets))
    touched = put(shelf, pairs(spark, [(7, "b"), (8, "b")]))
    assert 1 <= len(touched) <= 2 and reads == [touched]
    folders = shelf.state["tables"]["t"]["folders"]
    assert sum(len(f) for f in folders.values()) == 16 and len({f for b in folders.values() for f in b}) == 2


def test_compaction_merges_full_buckets_only(spark):
    shelf = Shelf(spark, scratch(spark), buckets=4)
    for i in range(4):
        change = shelf.begin()
        change.append("t", ["id"], pairs(spark, [(j, str(i)) for j in range(100 * i, 100 * i + 60)]))
        change.commit()
    rows, first = held(shelf), shelf.state["tables"]["t"]["folders"]["0"]
    change = shelf.begin()
    change.append("t", ["id"], pairs(spark, [(j, "x") for j in range(1000, 1400)]).where(shelf.bucket(["id"]) == 1))
    change.commit()
    assert shelf.compact(most=4) == 1
    folders = shelf.state["tables"]["t"]["folders"]
    assert len(folders["1"]) == 1 and folders["0"] == first
    assert len(held(shelf)) > len(rows) and shelf.compact(most=4) == 0


def test_second_run_encodes_new_texts_only(spark):
    calls = spark.sparkContext.accumulator(0)

    class Counting(HashingEncoder):
        def __call__(self, texts):
            calls.add(len(texts))
            return super().__call__(texts)

    shelf, rows = Shelf(spark, scratch(spark), buckets=4), [(i, f"text {i % 30}") for i in range(90)]
    df = spark.createDataFrame([*rows, (None, "text 1"), (91, None)], "id bigint, text string")

    def run(df, version="a"):
        before = calls.value
        found = embed_stored(df, "id", "text", lambda: Counting(8), 8, shelf, version).collect()
        return calls.value - before, sorted((repr((r.id, r.text, r.embedding)) for r in found))

    plain = sorted(repr((r.id, r.text, r.embedding)) for r in embed(df, "id", "text", lambda: HashingEncoder(8), 8).collect())
    assert run(df) == (30, plain)
    assert run(df) == (0, plain)
    more = df.union(spark.createDataFrame([(200, "text 1"), (201, "other")], df.schema))
    assert run(more)[0] == 1
    assert run(more, "b")[0] == 31  # another encoder
    assert run(df.limit(0))[0] == 0


def test_difference_edges(spark):
    schema = "id bigint, name string, n int"
    before = [(1, "a", 1), (1, "a", 1), (1, "b", 1), (2, None, 1), (3, "x", None), (4, "p|q", 1), (5, "gone", 1), (None, "n", 1)]
    after = [(1, "b", 1), (1, "a", 1), (2, "", 1), (3, "x", None), (3, "x", None), (4, "p", 1), (6, "new", 1), (None, "m", 2)]
    found = difference(*(fingerprints(spark.createDataFrame(rows, schema)) for rows in (before, after)))
    assert {r.id: r.change for r in found.collect()} == {2: "changed", 4: "changed", 5: "gone", 6: "new"}
    empty = fingerprints(spark.createDataFrame([], schema))
    assert difference(empty, empty).collect() == []


def full(spark, state, k):
    return neighbours.knn_lists(frame(spark, state), k=k)


def frame(spark, state):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in state.items()], "id bigint, embedding array<float>")


def as_dict(df):
    return {r.id: [(e.neighbour_id, round(e.d2, 6)) for e in r.neighbours] for r in df.collect()}


@pytest.mark.parametrize("rows", [None, 12])
def test_repaired_lists_equal_a_full_run(spark, monkeypatch, rows):
    monkeypatch.setattr(tree, "FANOUT", 6)
    rng, draw, k = np.random.default_rng(3), random.Random(3), 4
    centres = rng.normal(size=(12, 3)) * 30

    def vector():
        return np.float32(centres[draw.randrange(12)] + np.round(rng.normal(size=3), 1))

    state = {i: vector() for i in range(120)}
    lists = as_dict(full(spark, state, k))
    for step in range(2):
        gone = set(draw.sample(sorted(state), 4))
        changed = {i: vector() for i in draw.sample(sorted(set(state) - gone), 3)} | {500 + 10 * step + i: vector() for i in range(4)}
        before = frame(spark, state)
        exact = full(spark, state, k)  # distances as they were found, not rounded
        touched = repair.repaired_lists(
            before, exact, frame(spark, changed), spark.createDataFrame([(i,) for i in gone], "id bigint"), k, block_rows=rows
        ).drop("cause")
        state = {i: x for i, x in state.items() if i not in gone} | changed
        found = as_dict(touched)
        lists = {i: x for i, x in lists.items() if i not in gone} | found
        assert lists == as_dict(full(spark, state, k))
        assert len(changed) <= len(found) < len(state) - 20


def test_short_lists_and_empty_batches(spark):
    """Lists shorter than k take whatever comes; a batch that changes nothing touches nothing."""
    state = {1: [0, 0], 2: [1, 0]}
    lists = full(spark, state, 5)
    none = spark.createDataFrame([], "id bigint")
    assert repair.repaired_lists(frame(spark, state), lists, frame(spark, state).limit(0), none, 5).collect() == []
    found = repair.repaired_lists(frame(spark, state), lists, frame(spark, {3: [9, 9]}), none, 5)
    assert {r.id: (len(r.neighbours), r.cause) for r in found.collect()} == {1: (2, "entered"), 2: (2, "entered"), 3: (2, "new")}
    found = repair.repaired_lists(frame(spark, state), lists, frame(spark, {1: [5, 5]}), spark.createDataFrame([(2,)], "id bigint"), 5)
    assert {r.id: len(r.neighbours) for r in found.collect()} == {1: 0}


def names(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string")


def published(shelf):
    return {r.key: r.value for r in shelf.read("records").collect()}


def test_daily_runs_and_replays(spark):
    path, encoder = scratch(spark), lambda: HashingEncoder(8)
    first = [(i, f"name {i % 7} {i % 3}") for i in range(30)] + [(None, "x"), (31, None)]
    second = [(i, "other words" if i in (5, 6) else n) for i, n in first[5:]] + [(50, "name 1 1"), (50, "a second name")]
    shelf = Shelf(spark, path, buckets=4)
    assert run_snapshot(shelf, names(spark, first), encoder, "v", NOW(), 8, 3, tag=0) is not None
    made = run_snapshot(shelf, names(spark, second), encoder, "v", NOW(), 8, 3, tag=1)
    fresh = Shelf(spark, scratch(spark), buckets=4)
    run_snapshot(fresh, names(spark, second), encoder, "v", NOW(), 8, 3)
    assert published(shelf) == published(fresh) and made.count() <= len(published(fresh))
    version = shelf.version
    assert run_snapshot(shelf, names(spark, first), encoder, "v", NOW(), 8, 3, tag=1) is None
    assert run_changes(shelf, names(spark, first), spark.range(0), encoder, "v", NOW(), 8, 3, tag=0) is None
    assert shelf.version == version == Shelf(spark, path).version


def test_stream_equals_one_batch_and_replays_change_nothing(spark):
    schema = "id bigint, name string, status string, at int"
    drops = [
        [(i, f"n {i % 5} w{i % 4}", "UP", 1) for i in range(20)],
        [(3, "n 1", "DOWN", 2), (4, "moved on", "UP", 2), (4, "n 4", "UP", 1), (None, "z", "UP", 2)],
        [(3, "back again", "UP", 3), (40, "n 2 w2", "UP", 3), (7, None, None, 3)],
    ]
    source, path, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    encoder = lambda: HashingEncoder(8)

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        publish_stream(stream, path, checkpoint, encoder, "v", NOW(), 8, 3).awaitTermination()
        return Shelf(spark, path)

    for rows in drops:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        shelf = run(checkpoint)
    last = {i: n for rows in drops for i, n, s, _ in sorted(rows, key=lambda r: (r[3], r[0] is None)) if i is not None}
    last = {i: n for i, n in last.items() if i != 7}
    fresh = Shelf(spark, scratch(spark), buckets=4)
    run_snapshot(fresh, names(spark, list(last.items())), encoder, "v", NOW(), 8, 3)
    assert published(shelf) == published(fresh)
    version = shelf.version
    again = run(scratch(spark))  # a stream that starts over replays the batches it has committed
    assert again.version == version and published(again) == published(fresh)
