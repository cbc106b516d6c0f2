import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vecshelf.constants import MARGIN
from vecshelf.operators import fit
from vecshelf.operators import head as H
from vecshelf.sinks.heads import load_head, save_head


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = []
    for i in range(120):
        label = int(rng.integers(0, 4))
        rows.append((i, [float(v) for v in centres[label] + rng.normal(size=6) * 0.8], label))
    return spark.createDataFrame(rows, "id bigint, embedding array<double>, label bigint").repartition(3).persist()


@pytest.fixture(scope="module")
def weights():
    return np.random.default_rng(4).normal(size=(4, 6))


def local(data):
    rows = data.orderBy("id").collect()
    return np.array([r["embedding"] for r in rows]), np.array([r["label"] for r in rows])


def mean_loss(x, y, w, easy=False, s=64.0, m=MARGIN):
    """Written out from the definition, independently of the package."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    w = w / np.linalg.norm(w, axis=1, keepdims=True)
    total = 0.0
    for row, label in zip(x, y):
        z = []
        for j, c in enumerate(w @ row):
            if j == label:
                if easy:
                    c = math.cos(math.acos(c) + m) if c > 0 else c
                else:
                    c = math.cos(math.acos(c) + m) if c > math.cos(math.pi - m) else c - m * math.sin(m)
            z.append(s * c)
        top = max(z)
        total += top + math.log(sum(math.exp(v - top) for v in z)) - z[label]
    return total / len(x)


def test_margin_branches():
    c = np.array([0.5, -0.9, -0.95, 0.0])
    moved, slope = H.margin_terms(c, 0.4)
    assert moved[0] == pytest.approx(0.5 * math.cos(0.4) - math.sqrt(0.75) * math.sin(0.4))
    assert moved[1] == pytest.approx(math.cos(math.acos(-0.9) + 0.4))
    assert moved[2] == pytest.approx(-0.95 - 0.15577, abs=1e-5)
    assert slope[2] == 1.0
    easy, slope = H.margin_terms(c, 0.4, easy=True)
    assert easy[1:].tolist() == c[1:].tolist()
    assert slope[1:].tolist() == [1.0, 1.0, 1.0]


def test_target_logit_lies_below_the_plain_one(spark, data, weights):
    w = H.cosine_logits(data, weights, out="cos")
    rows = H.arc_logits(w, weights, out="z").collect()
    for r in rows:
        assert r["z"][r["label"]] < 64 * r["cos"][r["label"]]
        others = [j for j in range(4) if j != r["label"]]
        assert [r["z"][j] for j in others] == pytest.approx([64 * r["cos"][j] for j in others])


def test_feature_axis():
    w = np.array([[3.0, 0.0], [4.0, 2.0]])
    assert H.unit_classes(w, "feature").tolist() == [[0.6, 0.0], [0.8, 1.0]]
    assert H.unit_classes(w)[0].tolist() == [1.0, 0.0]
    with pytest.raises(ValueError):
        H.unit_classes(w, "rows")


@pytest.mark.parametrize("easy", [False, True])
def test_gradient_against_differences(spark, data, weights, easy):
    x, y = local(data)
    found = np.zeros_like(weights)
    for r in fit.grad_step(data, weights, easy=easy).collect():
        found[r["class"], r["dim"]] = r["g"]
    h = 1e-6
    for j, d in [(0, 0), (1, 3), (2, 5), (3, 1)]:
        up, down = weights.copy(), weights.copy()
        up[j, d] += h
        down[j, d] -= h
        numeric = (mean_loss(x, y, up, easy) - mean_loss(x, y, down, easy)) / (2 * h)
        assert found[j, d] == pytest.approx(numeric, rel=1e-5, abs=1e-6)


def test_losses_and_accuracy(spark, data, weights):
    x, y = local(data)
    loss = H.cross_entropy(H.arc_logits(data, weights)).agg(F.avg("loss")).first()[0]
    assert loss == pytest.approx(mean_loss(x, y, weights))
    ux = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = ux @ (weights / np.linalg.norm(weights, axis=1, keepdims=True)).T
    per_row = np.log(np.exp(cos).sum(axis=1)) - cos[np.arange(len(y)), y]
    e = H.evaluate(data, weights, "id", batch_size=50).first()
    assert e["n"] == 120
    assert e["loss_row_mean"] == pytest.approx(per_row.mean())
    assert e["loss_batch_mean"] == pytest.approx(np.mean([per_row[:50].mean(), per_row[50:100].mean(), per_row[100:].mean()]))
    assert e["accuracy"] == pytest.approx((cos.argmax(axis=1) == y).mean())
    assert [r["predicted"] for r in H.predict(data, weights).orderBy("id").collect()] == cos.argmax(axis=1).tolist()


def test_ties_go_to_the_lowest_class(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 1)], "logits array<double>, label int")
    assert df.select(H.top_class("logits").alias("c")).first()["c"] == 1
    assert H.accuracy(df).first()["accuracy"] == 1.0


def test_large_logits_do_not_overflow(spark):
    df = spark.createDataFrame([([1000.0, 999.0], 0)], "logits array<double>, label int")
    assert H.cross_entropy(df).first()["loss"] == pytest.approx(math.log(1 + math.exp(-1)))


def test_bad_labels_and_classes(spark, data, weights):
    wrong = data.withColumn("label", F.lit(4))
    with pytest.raises(PySparkException, match="label outside"):
        H.arc_logits(wrong, weights).collect()
    gap = spark.createDataFrame([(0, [1.0]), (2, [1.0])], "class bigint, w array<double>")
    with pytest.raises(ValueError, match="classes"):
        H.class_matrix(gap)


def test_rate():
    rates = [fit.rate_at(t, 8, 1.0, 0.25) for t in range(9)]
    assert rates == pytest.approx([0, 0.5, 1, 5 / 6, 4 / 6, 3 / 6, 2 / 6, 1 / 6, 0])


def test_adamw():
    state = fit.HeadState(np.array([[1.0, -2.0]]))
    moved = fit.adamw(state, np.array([[0.5, -0.25]]), 0.1, 0.01)
    # In the first step the corrected moments are the gradient and its square.
    assert moved.weights == pytest.approx(np.array([[1.0 * 0.999 - 0.1, -2.0 * 0.999 + 0.1]]), abs=1e-6)
    kept = fit.adamw(state, np.zeros((1, 2)), 0.1, 0.01, name="norm.bias")
    assert kept.weights.tolist() == state.weights.tolist()
    assert not fit.decays("layer_norm.weight")


@pytest.fixture(scope="module")
def estimator():
    return fit.ArcHead(n_classes=4, dim=6, epochs=4, lr=0.05, dropout=0.1, sub_batches=2, log_every=2, save_every=4)


def test_fit_improves_and_ignores_partitioning(spark, data, estimator):
    one = estimator.fit(data.coalesce(1))
    many = estimator.fit(data.repartition(8))
    assert np.abs(one.weights - many.weights).max() < 1e-9
    before = H.evaluate(data, fit.ArcHead(4, 6)._start(spark, None).weights, "id").first()
    after = H.evaluate(data, one.weights, "id").first()
    assert after["loss_scaled"] < before["loss_scaled"]
    history = one.history_table(spark).collect()
    assert [h["step"] for h in history] == [2, 4, 6, 8]
    assert history[0]["epoch"] == 0
    assert one.transform(data).columns[-1] == "predicted"


def test_save_resume(spark, data, estimator, tmp_path):
    path = str(tmp_path / "heads")
    vocab = spark.createDataFrame([("a", 4, 1)], "token string, id bigint, count bigint")
    assert load_head(spark, path) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_head(spark, path, missing="fail")
    whole = estimator.fit(data, save_path=path, vocab=vocab, dev=data)
    assert [h["step"] for h in whole.history if "dev_loss" in h] == [4, 8]
    half = load_head(spark, path, step=4)
    resumed = estimator.fit(data, init=half)
    assert np.abs(whole.weights - resumed.weights).max() < 1e-9
    assert load_head(spark, path).step == 8
    assert spark.read.parquet(f"{path}/vocab/step=8").count() == 1
    save_head(spark, half, path)
    assert load_head(spark, path, step=4).weights.tolist() == half.weights.tolist()


def test_initial_weights_are_bounded_and_repeatable(spark):
    classes = spark.range(5).withColumnRenamed("id", "class")
    a = H.class_matrix(H.initial_weights(classes, 24, 9))
    b = H.class_matrix(H.initial_weights(classes.repartition(3), 24, 9))
    assert a.tolist() == b.tolist()
    assert np.abs(a).max() <= math.sqrt(6 / 24)
    assert H.class_matrix(H.initial_weights(classes, 24, 10)).tolist() != a.tolist()
