import pytest
from pyspark.sql import functions as F

from sievemill.operators import sampling, validate


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "answer,article,issues",
    [
        ("It costs $10,000.", "about 10,000", ["$10,000"]), ("15% or 15", "15%", ["15"]), ("3 steps, $3", "none", ["$3"]), ("5% and 5", "", ["5%"]), ("I CANNOT find 7; the Article States 7", "7", ["marker: I cannot find", "marker: the article states"]),
        ("plain", "", []), ("9 then 8", "", ["8", "9"]),
    ],
)
def test_grounding(spark, answer, article, issues):
    assert value(spark, validate.grounding_issues(F.lit(answer), F.lit(article))) == issues


@pytest.mark.parametrize("q,a,error", [("abcd", "x" * 20, "Question too short: 4 < 5"), ("x" * 501, "", "Question too long: 501 > 500"), ("abcde", "x" * 19, "Answer too short: 19 < 20"), ("abcde", "x" * 2001, "Answer too long: 2001 > 2000"), ("     ", "x" * 20, None), ("\U0001f600" * 5, "x" * 2000, None)])
def test_lengths(spark, q, a, error):
    df = spark.createDataFrame([(q, a)], "question string, answer string")
    assert df.select(validate.length_error().alias("e")).first()["e"] == error


@pytest.mark.parametrize("q,error", [("", "Empty question"), (" \t", "Empty question"), ("Commission rates", None), ("x" * 31, "Long question should end with '?'"), ("x" * 31 + "? ", None), ("Doing " + "x" * 31, None), ("How " + "x" * 31, None)])
def test_question_format(spark, q, error):
    assert value(spark, validate.question_error(F.lit(q))) == error


def test_sample_size_and_order(spark):
    assert [sampling.sample_size(n, 0.1) for n in (0, 1, 9, 536)] == [0, 1, 1, 53]
    df = spark.range(100).select(F.col("id").cast("string").alias("qa_id"), F.col("id").alias("ord"))
    one = {r.qa_id for r in sampling.fixed_sample(df, 0.1).collect()}
    assert len(one) == 10 and one == {r.qa_id for r in sampling.fixed_sample(df.repartition(7), 0.1).collect()}
    assert sampling.head(df, 0).count() == 100 and [r.ord for r in sampling.head(df, 3).collect()] == [0, 1, 2]
