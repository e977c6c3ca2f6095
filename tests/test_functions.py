import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardstat.functions import metrics as X
from wardstat.functions.conversions import to_double, to_number, to_work_date
from wardstat.functions.names import rename_all, sanitized, standardized


def column_of(df):
    return [row[0] for row in df.collect()]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def test_work_date_from_text(spark, either_mode):
    df = texts(spark, ["20240401", "2024-04-01", " 20240401 ", "2024-04-01 07:30:00", "junk",
                       "2024-04-01T07:30:00.5Z", "20240431", "", None, "2024051", "2024", "2024-05",
                       "2024-05-01Tjunk", "2024-05-01 ", "2024-5-1", "+20240501"])
    day = dt.date(2024, 4, 1)
    assert column_of(df.select(to_work_date(F.col("s")))) == [
        day, day, day, day, None, day, *[None] * 7, dt.date(2024, 5, 1), None, None]


def test_work_date_from_other_types(spark, either_mode):
    df = spark.sql("SELECT 20240401 AS i, DATE'2024-04-01' AS d, TIMESTAMP'2024-04-01 10:00:00' AS t,"
                   " TIMESTAMP_NTZ'2024-04-01 10:00:00' AS n")
    row = df.select([to_work_date(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert set(row) == {dt.date(2024, 4, 1)}


def test_number_coercion(spark, either_mode):
    good = {" 12 ": 12.0, "1e3": 1000.0, "-0.5": -0.5, "+5.": 5.0, ".5": 0.5, "1E-2": 0.01,
            "\t7\n": 7.0, "inf": math.inf, "-Infinity": -math.inf}
    bad = ["abc", "1d", "1f", "2.D", "1_000", "NaN", "1,000", "0x10", "0x1p3", "", " ", "1e", "--1",
           "1e400", "+ 1", "1 2", None]
    df = texts(spark, [*good, *bad])
    assert column_of(df.select(to_number(F.col("s")))) == [*good.values()] + [None] * len(bad)


def test_number_coercion_agrees_with_pandas(spark):
    """Short texts made of the characters that numbers are made of."""
    rng = random.Random(3)
    letters = "0123456789.+-eE dDfF_xX,nai\t"
    values = list({"".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(4000)})
    expected = [pd.to_numeric(pd.Series([v], dtype=object), errors="coerce").iloc[0] for v in values]
    got = column_of(texts(spark, values).select(to_number(F.col("s"))))
    for value, ours, theirs in zip(values, got, expected):
        if pd.isna(theirs):
            assert ours is None, value
        else:
            assert ours == pytest.approx(float(theirs), rel=1e-12), value


def test_number_coercion_of_numbers(spark, either_mode):
    df = spark.sql("SELECT 1 AS i, 2.5BD AS d, double('NaN') AS n")
    row = df.select([to_number(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert tuple(row) == (1.0, 2.5, None)


def test_double_cast_never_fails(spark, either_mode):
    df = texts(spark, ["1.5", "abc", "", None])
    assert column_of(df.select(to_double(F.col("s")))) == [1.5, None, None, None]


def test_rounding_is_half_up(spark, either_mode):
    df = spark.createDataFrame([(v, 1.0) for v in (1.005, 2.675, 0.125, -0.125)], "a double, b double")
    assert column_of(df.select(X.guarded_ratio("a", "b"))) == [1.01, 2.68, 0.13, -0.13]


def test_guarded_ratio(spark, either_mode):
    rows = [(40.0, None), (40.0, 0.0), (40.0, -1.0), (None, 4.0), (None, 0.0), (1.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert column_of(df.select(X.guarded_ratio("a", "b", 100))) == [0, 0, 0, None, 0, 33.33]


def test_mean_of_present(spark, either_mode):
    rows = [(4.0, None, 5.0), (None, None, None), (1.0, 2.0, 2.0), (None, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert column_of(df.select(X.mean_of_present("a", "b", "c"))) == [4.5, None, 1.67, 3.0]


def test_null_safe_sum(spark, either_mode):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert column_of(df.select(X.null_safe_sum("a", "b"))) == [1.0, 0.0]


@pytest.mark.parametrize("values, expected", [
    ([0.1, 0.2, 0.6, None], 0.3),
    ([None, None], None),
    ([], None),
    ([0.004, 0.004], 0.004),
    ([1e300, 1.0], 5e299),
    ([math.inf, 1.0], math.inf),
    ([math.inf, math.nan, 1.0], math.nan),
])
def test_exact_mean(spark, either_mode, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = df.agg(X.exact_mean("a")).first()[0]
    assert got == expected or math.isnan(got) and math.isnan(expected)


def test_exact_mean_does_not_depend_on_order(spark):
    values = [round(i * 0.37, 2) for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    means = {df.repartition(n).agg(X.exact_mean("a")).first()[0] for n in (1, 3, 7)}
    assert len(means) == 1


def test_sums_do_not_depend_on_the_partitions(spark):
    df = spark.range(20000).selectExpr("id % 20 AS k", "round((id * 7919 % 9973) * 0.01, 2) AS v")
    totals = [sorted(tuple(r) for r in df.repartition(n).groupBy("k").agg(X.exact_sum("v")).collect())
              for n in (3, 11)]
    assert totals[0] == totals[1]
    assert all(round(total, 2) == total for _, total in totals[0])


def test_names():
    raw = "CMS Certification Number (CCN)"
    assert sanitized(raw) == "CMS_Certification_Number_CCN"
    assert standardized(raw) == "CMS_CERTIFICATION_NUMBER_(CCN)"
    assert sanitized(" a;b,{c}\n\t=d ") == "a_b_c_d"
    assert standardized("  state name ") == "STATE_NAME"


def test_colliding_names_are_refused(spark):
    df = spark.sql("SELECT 1 AS `a b`, 2 AS `a,b`")
    with pytest.raises(ValueError, match=r"a b.*a,b"):
        rename_all(df, sanitized)
