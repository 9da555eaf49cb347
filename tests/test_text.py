import pytest
from pyspark.sql import functions as F

from quillwork.functions import text as tx


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("href", "want"), [("C++%20(lang)", "c++ (lang)"), ("File:x.png", None), ("wikt:word", None), ("A#b", None), ("", None), ("100%_pure", "100%_pure"), (None, None)])
def test_link_target(spark, href, want):
    assert one(spark, tx.link_target(F.col("h")), h=href) == want


def test_tokens(spark):
    assert one(spark, tx.tokens(F.col("t")), t="Ünï-X 20th") == ["n", "x", "20th"]
    assert one(spark, tx.word_count(F.col("t")), t="  a  b ") == 2
    assert one(spark, tx.word_count(F.col("t")), t=None) == 0


@pytest.mark.parametrize(("a", "kind"), [("1969", "numeric"), ("-3.5", "numeric"), ("May 4", "date"), ("1/2/2003", "date"), ("Yes", "boolean"), ("Marie Curie", "entity"), ("low pressure", "phrase"), ("", "empty")])
def test_answer_type(spark, a, kind):
    assert one(spark, tx.answer_type(F.col("a")), a=a) == kind


def test_normal_answer(spark):
    assert one(spark, tx.normal_answer(F.col("a")), a="the U.S. Army") == "u s army"


def test_path_id(spark):
    for ids in (["doc_000124", "doc_000021"], ["doc_000021", "doc_000124"]):
        assert one(spark, tx.path_id(F.col("d"), F.lit("near-earth object")), d=ids) == "p_2c1ad1602042"


def test_jaccard(spark):
    assert one(spark, tx.jaccard(F.col("a"), F.col("b")), a="red fox", b="red dog") == pytest.approx(1 / 3)
    assert one(spark, tx.jaccard(F.col("a"), F.col("b")), a="the", b="the") == 0


@pytest.mark.parametrize(("t", "want"), [('```json\n{"a":1}\n```', 1), ('xx {"a":1} yy', 1), ("{bad", None)])
def test_lenient_json(spark, t, want):
    got = one(spark, tx.lenient_json(F.col("t"), "a int"), t=t)
    assert (got and got["a"]) == want
