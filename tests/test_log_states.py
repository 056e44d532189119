"""States per delivery give the features of the raw logs, for any cutoff."""

from pyspark.sql import functions as F

from keepcurve.operators import features as fe
from keepcurve.operators import log_states as ls


def logs(spark):
    return spark.range(6000).select((F.col("id") % 97).cast("string").alias("msno"),
                                 F.date_add(F.lit("2016-08-01").cast("date"), (F.xxhash64("id") % 120 + 100).cast("int")).alias("log_date"),
                                 *[(F.xxhash64("id", F.lit(k)) % 5 + 5).cast("int").alias(c) for k, c in enumerate((*fe.PLAY_COLUMNS, "num_unq"))],
                                 (F.col("id") % 11 * 0.5).alias("total_secs"))


CUTOFFS = {"a": "2016-10-01", "b": "2016-12-24", "c": "2017-03-01"}


def test_equals_the_raw_features_for_three_cutoffs(spark, tmp_path):
    raw = logs(spark)
    path = str(tmp_path / "state")
    # the second delivery shares days with the first; a third replaces one that was written wrongly
    parts = {"one": raw.where("log_date < '2016-11-20' AND num_unq > 6"), "two": raw.where("log_date < '2016-11-20' AND num_unq <= 6"),
             "three": raw.where("log_date >= '2016-11-20'")}
    ls.write_log_state(raw, path, "three")
    for name, part in parts.items():
        ls.write_log_state(part, path, name)
    got = ls.log_features_from_state(ls.read_log_state(spark, path), CUTOFFS)
    for period, cutoff in CUTOFFS.items():
        want = fe.user_log_features(raw, cutoff)
        mine = got.where(F.col("period") == period).drop("period").select(want.columns)
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, want.collect()))


def test_cohort_and_empty_state(spark):
    state = ls.log_state(logs(spark))
    cohort = spark.createDataFrame([("a", "3"), ("c", "5")], "period string, msno string")
    got = ls.log_features_from_state(state, CUTOFFS, cohort=cohort)
    assert {(r["period"], r["msno"]) for r in got.collect()} <= {("a", "3"), ("c", "5")} and got.count() == 2
    assert ls.log_features_from_state(state.limit(0), CUTOFFS).count() == 0
