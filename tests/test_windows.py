import datetime as dt
import random
import warnings

import pytest
from pyspark.sql import functions as F

from tidemark import guards
from tidemark.operators.payloads import form_headers
from tidemark.operators.windows import date_window

DAYS = ["2018-07-16", "2018-07-17", "2018-07-18"]
INSTANTS = [
    "2021-03-09T16:11:20.000-05:00",
    "2021-03-09T16:11:20.487-05:00",
    "2021-03-10T08:30:52.694-05:00",
    "2021-03-10T08:45:19-05:00",
]


@pytest.fixture(params=["date", "timestamp_ntz", "timestamp"])
def filings(frame, request):
    rows = frame([(d,) for d in DAYS], "day string")
    if request.param == "timestamp":
        # A filing day kept as an instant is midnight in New York.
        return rows.select(F.to_utc_timestamp("day", "America/New_York").alias("filing_date"), "day")
    return rows.select(F.col("day").cast(request.param).alias("filing_date"), "day")


def days(df):
    return sorted(r["day"] for r in df.collect())


@pytest.mark.parametrize(
    "start, end",
    [
        ("2018-07-17T00:00:00-00:00", "2018-07-18T00:00:00-00:00"),
        ("2018-07-17T12:00:00+00:00", "2018-07-18T22:00:00+00:00"),
    ],
)
def test_publication_bounds_are_cut_to_days_and_half_open(filings, start, end):
    assert days(date_window(filings, start, end, "publication_date")) == ["2018-07-17"]


def test_publication_day_of_a_bound_is_its_utc_day(filings):
    found = date_window(filings, "2018-07-16T22:00:00-05:00", None, "publication_date")
    assert days(found) == ["2018-07-17", "2018-07-18"]


def test_one_bound_alone_and_none_at_all(filings):
    assert days(date_window(filings, None, "2018-07-17T09:00:00+0000", "publication_date")) == DAYS[:1]
    assert days(date_window(filings)) == DAYS


@pytest.mark.parametrize("zoneless", [False, True])
def test_knowledge_window_compares_instants(frame, zoneless):
    rows = frame([(t,) for t in INSTANTS], "text string").select(
        F.col("text").cast("timestamp").alias("form_availability_timestamp"), "text"
    )
    if zoneless:
        rows = rows.withColumn(
            "form_availability_timestamp", F.col("form_availability_timestamp").cast("timestamp_ntz")
        )
    found = date_window(
        rows, "2021-03-09T21:11:20+00:00", "2021-03-10T13:45:19+00:00", "knowledge_date"
    )
    assert sorted(r["text"] for r in found.collect()) == INSTANTS[:3]


@pytest.mark.parametrize(
    "start, end, mode",
    [
        (None, None, "publication_date"),
        ("2020-01-01T00:00:00+00:00", None, None),
        ("2020-01-01T00:00:00+00:00", None, "filing_date"),
        ("2020-01-02T00:00:00+00:00", "2020-01-01T00:00:00+00:00", "knowledge_date"),
        ("2020-01-01", None, "knowledge_date"),
        ("2020-01-01T00:00:00", None, "knowledge_date"),
    ],
)
def test_wrong_windows_raise(start, end, mode):
    with pytest.raises(ValueError):
        guards.check_window(start, end, mode)


def test_empty_window_is_no_error(filings):
    same = "2018-07-17T00:00:00+00:00"
    found = date_window(filings, same, same, "publication_date")
    assert found.count() == 0 and found.columns == filings.columns


def test_id_and_form_guards():
    assert guards.clean_ids("cik", 5) == [5]
    assert guards.clean_ids("cik", None) is None
    with pytest.warns(UserWarning):
        assert guards.clean_ids("cik", [3, 1, 3]) == [1, 3]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert guards.clean_ids("cusip", ["b", "a"]) == ["a", "b"]
    for wrong in (0, -1, "33115", True):
        with pytest.raises(ValueError):
            guards.clean_filers(wrong)
    with pytest.raises(ValueError):
        guards.check_form_types(["3", "99"])
    with pytest.raises(ValueError):
        guards.check_exclusive(cik=1, cusip="x")
    with pytest.raises(ValueError):
        guards.check_facet("UNITS")


def test_headers_filter_and_order(frame):
    day = dt.date(2020, 1, 2)
    rows = frame(
        [
            ("b", 2, day, "4"),
            ("a", 2, day, "4"),
            ("c", 1, day, "4"),
            ("d", 1, dt.date(2020, 1, 1), "3"),
            ("e", 1, day, "8-K"),
            ("f", 9, day, "4"),
        ],
        "uuid string, cik bigint, filing_date date, form_type string",
    )
    found = form_headers(rows, form_type=["3", "4"], cik=[2, 1])
    assert [r["uuid"] for r in found.collect()] == ["d", "c", "a", "b"]
    assert form_headers(rows, cik=777).count() == 0
    with pytest.raises(ValueError):
        form_headers(rows, form_type="nonsense")


def test_random_windows_equal_brute_force(frame):
    rng = random.Random(11)
    zero = dt.datetime(2020, 3, 1, tzinfo=dt.timezone.utc)

    def moment():
        return zero + dt.timedelta(minutes=rng.randrange(60 * 24 * 60))

    instants = [moment() for _ in range(300)]
    rows = frame(
        [(i, t.date(), t.replace(tzinfo=None)) for i, t in enumerate(instants)],
        "id int, filing_date date, form_availability_timestamp timestamp_ntz",
    ).cache()
    for _ in range(12):
        low, high = sorted([moment(), moment()])
        zone = dt.timezone(dt.timedelta(hours=rng.randrange(-5, 6)))
        bounds = [b.astimezone(zone).strftime(guards.INSTANT_FORMAT) for b in (low, high)]
        known = {r["id"] for r in date_window(rows, *bounds, "knowledge_date").collect()}
        assert known == {i for i, t in enumerate(instants) if low <= t < high}
        published = {r["id"] for r in date_window(rows, *bounds, "publication_date").collect()}
        assert published == {
            i for i, t in enumerate(instants) if low.date() <= t.date() < high.date()
        }


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("filing_date"), "id"
    ).write.parquet(path)
    found = date_window(
        spark.read.parquet(path), "2020-01-03T05:00:00+00:00", "2020-01-05T05:00:00+00:00",
        "publication_date",
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(filing_date" in pushed and "LessThan(filing_date" in pushed
    assert [r["id"] for r in found.orderBy("id").collect()] == [2, 3]
