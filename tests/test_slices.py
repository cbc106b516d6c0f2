"""Batches and word tables are taken in parts of bounded size, with the same results."""

import numpy as np
import pyarrow as pa

from vecshelf.operators import clean, embed, index


def test_slices_cover_all_rows():
    texts = pa.array(["x" * 100, None, "", "y" * 100, "z"])
    parts = list(index.sliced(texts, 90))
    assert len(parts) > 1 and pa.concat_arrays(parts).equals(texts)
    assert list(index.sliced(pa.array([], pa.string()), 90)) == []


def test_segmenter_holds_few_texts(spark, monkeypatch):
    monkeypatch.setattr(clean, "SLICE_BYTES", 1)
    rows = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "c")], "id int, name string")
    found = clean.tokenize(rows.coalesce(1), "name", lambda t: t.split(" "))
    assert {r["id"]: r["tokens"] for r in found.collect()} == {1: ["a", "b"], 2: None, 3: [""], 4: ["c"]}


def test_encoder_gets_parts_of_a_batch():
    seen = []

    def encoder(texts):
        seen.append(len(texts))
        return np.ones((len(texts), 2))

    run = embed._encoding(["t"], lambda: encoder, 2, "v")
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1_000_000] * 10)], names=["t"])
    assert sum(b.num_rows for b in run(iter([batch]))) == 10 == sum(seen) and len(seen) > 1


def test_words_are_joined_block_by_block(spark, monkeypatch):
    """Several blocks of few rows give what the broadcast gives, for ids that repeat or are missing, too."""
    monkeypatch.setattr(embed, "BLOCK_TOKENS", (4, 4))
    rows = [(i if i % 5 else None, [f"w{(i * j) % 7}" for j in range(i % 4)] + ["no", None]) for i in range(40)] + [(3, None)]
    docs = spark.createDataFrame(rows, "id int, tokens array<string>").coalesce(2)
    words = spark.createDataFrame([(f"w{i}", [float(i), 1.0]) for i in range(7)], "token string, vec array<double>")
    for mode, eos in (("unsupervised", None), ("supervised", [0.5, 0.25])):
        both = [
            sorted(
                (str(r["id"]), [round(v, 9) for v in r["embedding"]], r["is_empty"])
                for r in embed.sentence_vectors(docs, "id", "tokens", words, 2, mode, eos, broadcast_bytes=limit).collect()
            )
            for limit in (0, 1 << 20)
        ]
        assert both[0] == both[1] and len(both[0]) == 41
    plan = embed.sentence_vectors(docs, "id", "tokens", words, 2, broadcast_bytes=0)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Summarizer" not in plan
