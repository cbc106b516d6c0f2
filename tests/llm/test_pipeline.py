"""The corpus pipeline: stages against brute force on documents of their own."""

import random

import corpus_pipeline
from vecshelf.session import durable


def make(spark, folder):
    rng = random.Random(12)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(160):
        text = [rng.choice(words) for _ in range(60)]
        if i % 4 == 0:
            text[7], text[30] = "rotten", "vilest"
        rows.append((i, " ".join(text), "en", f"src{i % 3}"))
        if i < 120:
            labels.append((i, 1, int(i % 4 == 0)))
    exact = [(200 + i, rows[i][1].replace(" ", "\n ", 3), "en", "src1") for i in (1, 2, 3)]
    near = [(300 + i, rows[i][1] + " tail", "en", None) for i in (5, 6, 7)]
    odd = [(400, None, None, None), (401, "", "en", "src0")]
    docs = [(*r, len(r[1] or "")) for r in rows + exact + near + odd]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    rows = make(spark, folder)
    clean = {r[0] for r in rows if not (r[0] < 160 and r[0] % 4 == 0)}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = [clean, clean - {201, 202, 203, 401}, clean - {201, 202, 203, 401, 305, 306, 307}]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "source_mix", "bpe"]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, want):
        kept = durable(stage(spark, docs, folder))
        assert kept.columns == docs.columns, name
        found = [r.doc_id for r in kept.collect()]
        assert sorted(found) == sorted(ids), name
        docs = kept
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert mixed.columns == docs.columns
    taken = [r.doc_id for r in mixed.collect()]
    assert set(taken) <= want[-1] and max(map(taken.count, set(taken))) <= 2
    size = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    assert abs(sum(size[i] for i in taken) - 1.5 * sum(size.values())) <= 61 * 4
    tokens = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(taken)
    assert all(r.n_tokens == len(r.ids) for r in tokens)


CLASHING = "_group string, _group_sha int, _group_keep int, _position double, _positions string, _mixed_id int, kept string, score string, component_id int"


def test_stages_with_clashing_columns(spark, tmp_path):
    """Names that operators use inside come through every filtering stage with their types and values."""
    folder = str(tmp_path)
    make(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = spark.createDataFrame([("g", 1, 2, 2.5, "p", 3, "k", "s", 4)], CLASHING)
    wide = durable(docs.crossJoin(extra))
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], corpus_pipeline.STAGES):
        found = stage(spark, wide, folder)
        assert found.schema == wide.schema, name
        rows = found.collect()
        assert {tuple(r)[5:] for r in rows} == {tuple(extra.first())}, name
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain[1](spark, docs, folder).collect()), name
    assert corpus_pipeline.encode(spark, wide, folder).count() == wide.count()


def test_stages_on_empty_repeated_and_long(spark, tmp_path):
    folder = str(tmp_path)
    make(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    long = " ".join(f"long{i}" for i in range(40_000))
    more = spark.createDataFrame([(500, long, "en", "src0", len(long)), (500, long, "en", "src0", len(long)), (None, "no id here", None, None, 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == [], name
        ids = [r.doc_id for r in stage(spark, docs.union(more), folder).collect()]
        assert 500 in ids and (None in ids or name == "near_dedup"), name
        if name == "exact_dedup":
            assert ids.count(500) == 1 and ids.count(None) == 1
