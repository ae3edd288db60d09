import pytest
from pyspark.sql import functions as F

from boxlake.functions import grammar as G
from boxlake.operators import parse


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "line string")


NUMBERS = {"0.0": 0.0, "1e0": 1.0, "1.": 1.0, ".5": 0.5, "+1": 1.0, "1_0": 10.0, "1.0d": None, "1f": None, "nan": None, "inf": None, "abc": None, "-0.7": -0.7, "": None, "1e999": None, "1__0": None, ".": None}


@pytest.mark.parametrize("token", NUMBERS)
def test_numbers(spark, token):
    assert lines(spark, token).select(G.number(F.col("line"))).first()[0] == NUMBERS[token]


def test_truncation_and_strict_integers(spark):
    df = lines(spark, "-0.7", "2.9", "3", "1.0", "x", "99999999999")
    assert [r[0] for r in df.select(G.truncated(F.col("line"))).collect()] == [0, 2, 3, 1, None, None]
    assert [r[0] for r in df.select(G.strict_integer(F.col("line"))).collect()] == [None, None, 3, None, None, None]


def test_arity_by_variant(spark):
    rows = ["0 .1 .2 .3", "0 .1 .2 .3 .4", "0 .1 .2 .3 .4 .5", "a .1 .2 .3 .4", "1 a b c d", "", "  \t ", "2 .1\t.2  .3 .4", "1 nan .2 .3 .4"]
    count = lambda v: parse.parse_labels(lines(spark, *rows), v).count()
    assert count(parse.Variant.STRICT_COUNT) == 4
    assert count(parse.Variant.LENIENT_COUNT) == 5
    assert count(parse.Variant.LENIENT_BOX) == 3
    assert count(parse.Variant.STRICT_BOX) == 2
    assert count(parse.Variant.CROP_BOX) == 3


def test_pose_keeps_a_tail_of_any_length_and_rejects_bad_tokens(spark):
    rows = ["0 .5 .5 1 1 .1 .2 2 .3 .4 1 .9", "0 .5 .5 1 1 x", "0 .5 .5 1", "1 .5 .5 1 1"]
    out = parse.parse_pose(lines(spark, *rows)).collect()
    assert [len(r.kpts) for r in out] == [7, 0]


def test_crop_names_round_trip(spark):
    df = spark.createDataFrame([("a_b_c", 1, 0.5, 0.25, 0.125, 1.0), ("x", 0, 0.0, 0.0, 0.1, 0.2)], "b string, k int, x double, y double, w double, h double")
    named = df.withColumn("crop_name", parse.crop_name(*[F.col(c) for c in df.columns]))
    for r in parse.decode_crop(named).collect():
        assert (r.base, r.cls, r.xc, r.yc) == (r.b, r.k, r.x, r.y)


@pytest.mark.parametrize(("name", "base", "strict"), [("a_0_1_1_1_1.jpg", "a", 0), ("0_1_1_1_1.jpg", None, 0), ("a_0.0_1_1_1_1.jpg", "a", None), ("a_x_1_1_1_1.jpg", None, None), (".a_1_1_1_1_1", ".a", 1), ("dir\\a_2_.1_.2_.3_.4.png", "a", 2), ("nothing", None, None)])
def test_decoding(spark, name, base, strict):
    df = spark.createDataFrame([(name,)], "crop_name string")
    assert parse.decode_crop(df).first().base == base
    assert df.select(parse.crop_class(F.col("crop_name"))).first()[0] == strict


def test_review_policies(spark):
    df = lines(spark, "a\\b.jpg 1", "a/c.jpg 9", "a/d.jpg x", "a/e.jpg 2 tail", "only", "")
    rows = lambda p: {(r.relkey, r.status) for r in parse.parse_reviews(df, p).collect()}
    assert rows(parse.StatusPolicy.LOAD) == {("a/b.jpg", 1), ("a/c.jpg", 0), ("a/e.jpg", 2)}
    assert rows(parse.StatusPolicy.APPLY) == {("a/b.jpg", 1), ("a/e.jpg", 2)}
    assert rows(parse.StatusPolicy.PURGE) == {("a/b.jpg", 1), ("a/c.jpg", 9), ("a/e.jpg", 2)}
