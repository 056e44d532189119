"""Key bitmaps: no key is lost, others mostly go, sizes stay bounded."""

from keepcurve.operators.bloom import flag_keys, key_bitmap, prefilter


def test_no_key_is_lost_and_most_others_go(spark):
    df = spark.range(20_000).selectExpr("id AS k", "cast(id % 7 AS string) AS s")
    keys = df.where("k % 50 = 0")
    got = prefilter(df, keys, ["k", "s"])
    assert got.columns == df.columns
    assert got.where("k % 50 = 0").count() == 400
    assert got.count() < 400 + 40


def test_flags_nulls_and_crowded_bitmap(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    keys = spark.createDataFrame([(1,), (None,)], "k long")
    got = {r["k"]: r["hit"] for r in flag_keys(df, key_bitmap(keys, ["k"]), ["k"], "hit").collect()}
    assert got[1] is True and got[None] is False
    many = spark.range(5000).selectExpr("id AS k")
    assert key_bitmap(many, ["k"], words=8).count() <= 8
    assert prefilter(many, many, ["k"], words=8).count() == 5000
    assert prefilter(many, many.limit(0), ["k"]).count() == 0
