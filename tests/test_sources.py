import pytest
from pyspark.errors import PySparkException

from vecshelf.sources.labelled import FIELDS_TSV, parse_labelled, read_labelled, read_lines
from vecshelf.sources.lists import read_stopwords, read_word_vectors


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_header_is_dropped_by_place_not_by_text(spark, tmp_path):
    write(tmp_path / "a.csv", "query,label\nx,1\nquery,label\n\n")
    write(tmp_path / "b.csv", "query,label\nquery,label\ny,2")
    lines = sorted(r["value"] for r in read_lines(spark, str(tmp_path)).collect())
    assert lines == ["", "query,label", "query,label", "x,1", "y,2"]


def test_header_with_files_cut_into_blocks(spark, tmp_path):
    body = "".join(f"line {i},{i % 3}\nq,l\n" for i in range(200))
    for name in "ab":
        write(tmp_path / f"{name}.csv", "q,l\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10
        assert lines.count() == 800
        assert lines.where("value = 'q,l'").count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_rejects(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'query,label\na,1\na,b,2\n\n,0\nab"c,3\nend,\n')
    good, rejects = read_labelled(spark, path, mode="reject")
    assert sorted(tuple(r) for r in good.collect()) == [("", "0"), ("a", "1"), ('ab"c', "3"), ("end", "")]
    assert sorted(tuple(r) for r in rejects.collect()) == [("", "field_count"), ("a,b,2", "field_count")]
    with pytest.raises(PySparkException, match="expected 2 fields"):
        read_labelled(spark, path).collect()
    with pytest.raises(PySparkException, match="expected 2 fields"):
        read_labelled(spark, path).count()


def test_tsv(spark, tmp_path):
    path = write(tmp_path / "a.tsv", "q\tt\tl\na,b\tskip\t4\r\nx\t1\n")
    good, rejects = read_labelled(spark, path, "\t", FIELDS_TSV, mode="reject")
    assert [tuple(r) for r in good.collect()] == [("a,b", "4")]
    assert rejects.count() == 1


def test_separator_is_literal(spark):
    lines = spark.createDataFrame([("a|b",)], "value string")
    assert tuple(parse_labelled(lines, "|").first()) == ("a", "b")
    with pytest.raises(ValueError):
        parse_labelled(lines, mode="skip")


def test_stopwords(spark, tmp_path):
    path = write(tmp_path / "stop.txt", '$\n若果 \n"\n\nword\textra\n')
    assert [r[0] for r in read_stopwords(spark, path).collect()] == ["$", "若果 ", '"', "word"]
    assert [r[0] for r in read_stopwords(spark, path, strip=True).collect()][1] == "若果"


def test_word_vectors(spark, tmp_path):
    path = write(tmp_path / "v.vec", "2 3\n苹果 1 0.5 -2 \nb 0 0 1e-3\n")
    rows = {r["token"]: r["vec"] for r in read_word_vectors(spark, path).collect()}
    assert rows["苹果"] == [1.0, 0.5, -2.0]
    assert rows["b"] == pytest.approx([0, 0, 1e-3])
