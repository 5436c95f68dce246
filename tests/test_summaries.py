import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile, summaries

NAN = float("nan")
DDL = "part string, n_rows double, month string, columns int"


@pytest.fixture
def rows(frame):
    return frame(
        [
            ("a", 1.5, "2024-01", 1),
            ("b", NAN, "2024-01", 10),
            (None, None, "2024-01", 9),
            ("a", -2.0, "2024-02", None),
            ("c", 10.0, None, 2),
            ("c", 9.0, None, 2),
        ],
        DDL,
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_parts_merge_to_the_exact_profile_of_the_whole(rows):
    names = ["part", "n_rows", "columns"]
    parts = summaries.part_profiles(rows, F.col("month"), *names)
    whole = summaries.profile_rows(summaries.merged_profiles(parts)).drop("part")
    exact = profile.column_profile(rows, *names).select(*whole.columns)
    assert found(whole) == found(exact)


def test_months_and_a_month_of_null(rows):
    parts = summaries.part_profiles(rows, F.col("month"), "n_rows")
    assert found(summaries.profile_rows(parts)) == [
        ("2024-01", "n_rows", 1, "1.5", "1.5", 2, 3),
        ("2024-02", "n_rows", 1, "-2.0", "-2.0", 0, 1),
        (None, "n_rows", 2, "9.0", "10.0", 0, 2),
    ]


def test_loads_of_one_part_merge(rows):
    one = summaries.part_profiles(rows, F.col("month"))
    cuts = ("columns > 5", "not columns > 5", "columns is null")
    loads = [summaries.part_profiles(rows.where(c), F.col("month")) for c in cuts]
    merged = summaries.merged_profiles(loads[0].unionByName(loads[1]).unionByName(loads[2]), F.col("part"))
    assert found(summaries.profile_rows(merged)) == found(summaries.profile_rows(one))


def test_years_of_months(rows):
    parts = summaries.part_profiles(rows, F.col("month"), "columns")
    years = summaries.merged_profiles(parts, F.substring("part", 1, 4))
    assert found(summaries.profile_rows(years)) == [
        ("2024", "columns", 3, "1", "10", 1, 4),
        (None, "columns", 1, "2", "2", 0, 2),
    ]


def test_no_rows(rows):
    parts = summaries.part_profiles(rows.limit(0), F.col("month"), "columns")
    assert parts.count() == 0
    whole = summaries.profile_rows(summaries.merged_profiles(parts))
    assert found(whole) == [(None, "columns", 0, None, None, 0, 0)]


def test_estimates_of_many_values(spark):
    df = spark.range(60_000).selectExpr("id % 20000 AS value", "id % 7 AS part")
    parts = summaries.part_profiles(df, F.col("part"), "value")
    estimate = summaries.profile_rows(summaries.merged_profiles(parts)).first().n_distinct
    assert abs(estimate - 20_000) < 0.05 * 20_000


def test_parts_combine_before_the_shuffle(rows):
    plan = summaries.part_profiles(rows, F.col("month"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and "partial_min" in plan
