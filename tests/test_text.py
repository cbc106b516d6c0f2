"""Cleaning, tokens, stopwords, labels; expectations worked out by hand from the rules."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecshelf.functions import text as X
from vecshelf.operators import clean
from vecshelf.sources.catalogue import named, read_catalogue


def one(spark, values, fn):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, t string")
    return [r["o"] for r in df.select("id", fn(F.col("t")).alias("o")).orderBy("id").collect()]


def test_bracket_spans(spark):
    given_ = {
        "a[b]c[d](e)[f]g": "a(e)g",
        "x[1](y)[1]z": "x(y)z",
        "[ab": "[ab",
        "][": "][",
        "[[a]]b]c": "c",
        "[a](x)[b[a]]": "(x)[b]",
        "plain": "plain",
    }
    assert one(spark, given_, X.remove_bracket_spans) == list(given_.values())


def test_markers_then_strip(spark):
    given_ = {
        "　【1元秒杀】源本 苹果　": "苹果",
        "【新品】苹果": "新品苹果",
        "【直播专用1元秒杀】a": "a",
        "源【】本b": "b",
    }
    out = one(spark, given_, lambda c: X.strip_unicode(X.remove_markers(c)))
    assert out == list(given_.values())


BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def test_strip_equals_python(spark):
    values = [BLANKS, f"{BLANKS}a{BLANKS}b{BLANKS}", "​x​", "", "a\n", "\x00 a", "﻿a "]
    assert one(spark, values, X.strip_unicode) == [v.strip() for v in values]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=BLANKS + "ab苹[]()【】", max_size=12), min_size=1, max_size=30))
def test_text_properties(spark, values):
    assert one(spark, values, X.strip_unicode) == [v.strip() for v in values]
    spans = one(spark, values, X.remove_bracket_spans)
    again = one(spark, spans, X.remove_bracket_spans)
    assert all(len(a) <= len(s) <= len(v) for v, s, a in zip(values, spans, again))


def tokens_of(spark, values, **options):
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    return [r["tokens"] for r in clean.tokenize(df, "t", **options).orderBy("id").collect()]


def test_tokenize(spark):
    assert tokens_of(spark, ["Hello, 苹果手机abc x 好 été12", "", "  ", "果"]) == [
        ["hello", "苹果", "果手", "手机", "abc", "x", "été12"], [], [], [],
    ]
    assert tokens_of(spark, ["Ab 한국"], lower=False) == [["Ab", "한국"]]


def test_keep_tokens(spark):
    df = spark.createDataFrame([(["a", "苹果", "😀", "bb", "the", "bb", "果"],)], "t array<string>")
    kept = df.select(X.keep_tokens(F.col("t"), 2, ["the"]).alias("t")).first()["t"]
    assert kept == ["苹果", "bb", "bb"]


def test_stopwords_by_list_and_by_join_agree(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1, ["aa", "bb", "aa", "cc"]), (2, ["bb"]), (3, []), (4, ["dd", "aa"])], "id int, tokens array<string>"
    )
    stop = spark.createDataFrame([("bb",), ("dd",)], "stopword string")
    small = {r["id"]: r["tokens"] for r in clean.drop_stopwords(df, "id", "tokens", stop).collect()}
    monkeypatch.setattr(clean, "INLINE_STOPWORDS", 1)
    large = {r["id"]: r["tokens"] for r in clean.drop_stopwords(df, "id", "tokens", stop).collect()}
    assert small == large == {1: ["aa", "aa", "cc"], 2: [], 3: [], 4: ["aa"]}


def test_user_segmenter_and_its_failures(spark):
    def cut(text):
        if "bad" in text:
            raise ValueError(text)
        return text.split("|")

    df = spark.createDataFrame([(1, "aa|b|cc"), (2, "bad|x")], "id int, name string")
    out = {r["id"]: (r["tokens"], r["clean"]) for r in clean.clean_baseline(df, "name", segmenter=cut).collect()}
    assert out == {1: (["aa", "cc"], "aa cc"), 2: (None, None)}


def test_labels(spark):
    df = spark.createDataFrame(
        [(v,) for v in ["3 ", "x", " 0", "30", "31", "-1", "3.7", "", None, "+2", "99999999999999999999"]], "label string"
    )
    out = [r["label"] for r in clean.parse_label(df, n_classes=31).collect()]
    assert out == [3, None, 0, 30, None, None, None, None, None, 2, None]


def test_catalogue(spark):
    df = spark.createDataFrame(
        [(1, "a", "UP"), (1, "a", "UP"), (1, "b", "UP"), (2, "c", "up"), (3, "d", None), (4, None, "UP")],
        "spu_sn int, spu_name string, status string",
    )
    rows = {tuple(r) for r in read_catalogue(df).collect()}
    assert rows == {(1, "a"), (1, "b"), (4, None)}
    assert {tuple(r) for r in read_catalogue(df, one_row_per_id=True).collect()} == {(1, "a"), (4, None)}
    df.createOrReplaceTempView("shelf")
    assert read_catalogue("shelf").count() == 3
    good, rejects = named(read_catalogue(df))
    assert good.count() == 2
    assert [tuple(r) for r in rejects.collect()] == [(4, None, "null_name")]


def test_first_check_names_the_reject(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    checks = {"one": F.lit(None).cast("boolean"), "two": F.lit(True), "three": F.lit(True)}
    good, rejects = clean.split_rejects(df, "id", "t", checks)
    assert good.count() == 0
    assert rejects.first()["reason"] == "two"


def test_drop_label(spark):
    assert clean.drop_label(spark.range(1).selectExpr("id", "id as label")).columns == ["id"]


@pytest.mark.parametrize("profile", ["deep", "baseline"])
def test_profiles(spark, profile):
    df = spark.createDataFrame([(1, "　【福利秒杀】Big [x]Apple the pie ")], "id int, name string")
    if profile == "deep":
        assert clean.clean_deep(df, "name").first()["clean"] == "Big [x]Apple the pie"
    else:
        row = clean.clean_baseline(df, "name", ["the"]).first()
        assert (row["clean"], row["tokens"]) == ("big apple pie", ["big", "apple", "pie"])
