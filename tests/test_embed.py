import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vecshelf.functions import vectors as V
from vecshelf.operators.embed import HashingEncoder, check_dim, embed, sentence_vectors


def test_each_text_is_encoded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    class Counting(HashingEncoder):
        def __call__(self, texts):
            calls.add(len(texts))
            return super().__call__(texts)

    df = spark.createDataFrame([(i, f"text {i % 4}") for i in range(200)], "id int, t string")
    out = embed(df, "id", "t", lambda: Counting(8), 8).collect()
    assert len(out) == 200
    assert calls.value == 4
    whole = {r["id"]: r["embedding"] for r in embed(df, "id", "t", lambda: HashingEncoder(8), 8, distinct=False).collect()}
    assert whole == {r["id"]: r["embedding"] for r in out}


def test_wrong_dimension_fails(spark):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    with pytest.raises(PySparkException, match="expected"):
        embed(df, "id", "t", lambda: HashingEncoder(8), 9).collect()
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, embedding array<double>")
    with pytest.raises(ValueError):
        check_dim(rows, 2)
    assert check_dim(rows.where("id = 1"), 2).count() == 1


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(
        [("a", [3.0, 4.0]), ("b", [0.0, 2.0]), ("z", [0.0, 0.0])], "token string, vec array<float>"
    )


TOKENS = [
    (1, ["a", "b", "b"]), (2, ["z", "a"]), (3, ["none"]), (4, []), (5, ["z"]), (6, ["a"]), (6, ["b"]),
]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_sentence_vectors(spark, words, limit):
    df = spark.createDataFrame(TOKENS, "id int, tokens array<string>")
    rows = sentence_vectors(df, "id", "tokens", words, 2, broadcast_bytes=limit).collect()
    out = sorted((r["id"], [round(v, 9) for v in r["embedding"]], r["is_empty"]) for r in rows)
    assert out == [
        (1, [0.2, round(2.8 / 3, 9)], False),
        (2, [0.6, 0.8], False),
        (3, [0.0, 0.0], True),
        (4, [0.0, 0.0], True),
        (5, [0.0, 0.0], True),
        (6, [0.0, 1.0], False),
        (6, [0.6, 0.8], False),
    ]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_sentence_vectors_with_end_marker(spark, words, limit):
    df = spark.createDataFrame(TOKENS, "id int, tokens array<string>")
    rows = sentence_vectors(
        df, "id", "tokens", words, 2, "supervised", [1.0, 1.0], broadcast_bytes=limit
    ).collect()
    out = sorted((r["id"], [round(v, 9) for v in r["embedding"]], r["is_empty"]) for r in rows)
    assert out == [
        (1, [1.0, 2.25], False),
        (2, [round(4 / 3, 9), round(5 / 3, 9)], False),
        (3, [1.0, 1.0], False),
        (4, [1.0, 1.0], False),
        (5, [0.5, 0.5], False),
        (6, [0.5, 1.5], False),
        (6, [2.0, 2.5], False),
    ]


def test_many_words_are_summed_in_slices(spark, monkeypatch):
    from vecshelf.operators import embed as E

    monkeypatch.setattr(E, "GATHER_VALUES", 6)
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(7, 2))
    row = np.sort(rng.integers(0, 5, 60))
    word = rng.integers(0, 7, 60)
    expected = np.zeros((5, 2))
    np.add.at(expected, row, matrix[word])
    assert np.allclose(E._sum_words(row, word, matrix, 5), expected)


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    out = [r["u"] for r in df.select(V.l2_normalise(F.col("v")).alias("u")).collect()]
    assert out == [[0.0, 0.0], [0.6, 0.8]]


def test_dropout(spark):
    df = spark.range(200).select("id", F.array_repeat(F.lit(1.0), 50).alias("v"))

    def mask(parts, step=1, seed=5):
        dropped = df.repartition(parts).select("id", V.dropout(F.col("v"), F.col("id"), 0.1, seed, step).alias("v"))
        return {r["id"]: r["v"] for r in dropped.collect()}

    one = mask(1)
    values = np.array(list(one.values()))
    assert set(np.round(np.unique(values), 9)) == {0.0, round(1 / 0.9, 9)}
    assert 0.08 < (values == 0).mean() < 0.12
    assert one == mask(5)
    assert one != mask(1, step=2)
    assert one != mask(1, seed=6)


def test_project(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<float>")
    out = df.select(V.project(F.col("v"), np.array([[1.0, 0.0, 2.0], [0.0, 1.0, 1.0]]), np.array([0, 0, 1])).alias("o"))
    assert out.first()["o"] == [1.0, 2.0, 5.0]


def test_null_vector_is_an_error(spark):
    df = spark.createDataFrame([([1.0],), (None,)], "v array<double>").coalesce(1)
    with pytest.raises(PySparkException, match="null vector"):
        df.select(V.l2_normalise(F.col("v"))).collect()
