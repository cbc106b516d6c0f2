import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecshelf.constants import CLS_ID, SEP_ID, UNK_ID
from vecshelf.operators import batching, encode
from vecshelf.operators.ordering import with_position


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, ["b", "a", "b"]), (2, ["a", "zz", "c", "b", "a"]), (3, []), (4, None), (5, ["[SEP]", "c"])]
    return spark.createDataFrame(rows, "id int, tokens array<string>")


def test_vocab_order(spark, texts):
    vocab = {r["token"]: (r["id"], r["count"]) for r in encode.build_vocab(texts).collect()}
    assert vocab == {
        "[PAD]": (0, 0), "[UNK]": (1, 0), "[CLS]": (2, 0), "[SEP]": (3, 0),
        "a": (4, 3), "b": (5, 3), "c": (6, 2), "zz": (7, 1),
    }
    assert encode.build_vocab(texts, min_count=2).count() == 7


@pytest.mark.parametrize("limit", [1000, 0])
def test_encode(spark, texts, limit):
    """Both ways of looking ids up give the same."""
    vocab = encode.build_vocab(texts, min_count=2)
    coded = encode.encode(texts, "id", "tokens", vocab, max_seq_len=5, broadcast_bytes=limit)
    out = {r["id"]: (r["input_ids"], r["token_type_ids"]) for r in coded.collect()}
    assert out[1] == ([CLS_ID, 5, 4, 5, SEP_ID], [0] * 5)
    assert out[2] == ([CLS_ID, 4, UNK_ID, 6, SEP_ID], [0] * 5)
    assert out[3] == out[4] == ([CLS_ID, SEP_ID], [0, 0])
    assert out[5] == ([CLS_ID, SEP_ID, 6, SEP_ID], [0] * 4)


def longest_first(a, b, room):
    while a + b > room:
        if a > b:
            a -= 1
        else:
            b -= 1
    return a, b


@pytest.mark.parametrize("limit", [1000, 0])
def test_pairs_cut_the_longer_side(spark, limit):
    sizes = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in range(9) for b in range(9))]
    df = spark.createDataFrame(sizes, "id int, na int, nb int").select(
        "id", "na", "nb",
        F.array_repeat(F.lit("a"), F.col("na")).alias("a"), F.array_repeat(F.lit("b"), F.col("nb")).alias("b"),
    )
    vocab = spark.createDataFrame([("a", 10), ("b", 11)], "token string, id bigint")
    for room in (0, 7, 8):
        coded = encode.encode(
            df, "id", "a", vocab, b="b", max_seq_len=room + 3, keep=["na", "nb"], broadcast_bytes=limit
        )
        for r in coded.collect():
            na, nb = longest_first(r["na"], r["nb"], room)
            assert r["input_ids"] == [2, *[10] * na, 3, *[11] * nb, 3]
            assert r["token_type_ids"] == [0] * (na + 2) + [1] * (nb + 1)


def test_too_short(spark, texts):
    with pytest.raises(ValueError):
        encode.encode(texts, "id", "tokens", encode.build_vocab(texts), max_seq_len=1)


@pytest.mark.parametrize("parts", [1, 7])
def test_positions(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    placed, n = with_position(df.repartition(parts), F.desc("g"), F.asc("k"))
    rows = placed.orderBy("pos").collect()
    assert n == 1000
    assert [r["pos"] for r in rows] == list(range(1000))
    assert [(-r["g"], r["k"]) for r in rows] == sorted((-r["g"], r["k"]) for r in rows)


def test_positions_of_nothing(spark):
    placed, n = with_position(spark.range(0), F.asc("id"))
    assert n == 0
    assert placed.columns == ["id", "pos"]
    assert batching.batches(spark.range(0), "id", 4, shuffle=True).count() == 0


def sampled(n, size, world):
    """Rank shares as the sampler's documentation gives them, on positions."""
    total = math.ceil(n / world) * world
    order = [i % n for i in range(total)]
    last = total % (size * world)
    shares = {r: [] for r in range(world)}
    for r in range(world):
        for start in range(r * size, total - last, size * world):
            shares[r].append(order[start : start + size])
        tail = order[total - last :]
        part = tail[r * (last // world) : (r + 1) * (last // world)]
        if part:
            shares[r].append(part)
    return shares


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 40), st.integers(1, 6), st.integers(1, 4))
def test_shuffled_batches(spark, n, size, world):
    placed = batching.batches(spark.range(n), "id", size, shuffle=True, seed=3, epoch=2, world=world)
    rows = placed.orderBy("pos").collect()
    order = [r["id"] for r in rows[:n]]
    assert sorted(order) == list(range(n))
    got = {r: {} for r in range(world)}
    for row in rows:
        got[row["rank"]].setdefault(row["batch_id"], []).append(row["id"])
    for rank, parts in sampled(n, size, world).items():
        found = [got[rank][b] for b in sorted(got[rank])]
        assert found == [[order[p] for p in part] for part in parts]
        assert all(b % world == rank for b in got[rank])


def test_epochs_differ_and_partitions_do_not_matter(spark):
    def order(epoch, parts):
        df = spark.range(50).repartition(parts)
        placed = batching.batches(df, "id", 8, shuffle=True, seed=1, epoch=epoch)
        return [r["id"] for r in placed.orderBy("pos").collect()]

    assert order(0, 1) == order(0, 5) != order(1, 1)


def test_pad_and_collate(spark):
    df = spark.createDataFrame(
        [(i, list(range(1, i + 2)), [i]) for i in range(5)], "id int, ids array<bigint>, label array<int>"
    )
    placed = batching.batches(df, "id", 2)
    rows = batching.collate(batching.pad(placed, {"ids": 9}), ["ids", "label"]).orderBy("batch_id").collect()
    assert [r["ids"] for r in rows] == [[[1, 9], [1, 2]], [[1, 2, 3, 9], [1, 2, 3, 4]], [[1, 2, 3, 4, 5]]]
    assert [r["label"] for r in rows] == [[[0], [1]], [[2], [3]], [[4]]]


def test_map_batches(spark):
    def double(frames):
        for frame in frames:
            yield frame * 2

    out = batching.map_batches(spark.range(3), double, "id bigint")
    assert sorted(r["id"] for r in out.collect()) == [0, 2, 4]
