import datetime as dt

import pytest

from tidemark.functions import periods

# Period strings and their dates.
CASES = {
    "2020-12": "2020-12-31",
    "2020/12": "2020-12-31",
    "2020.02": "2020-02-29",
    "2021-Q1": "2021-03-31",
    "2021Q1": "2021-03-31",
    "2021": "2021-12-31",
    "September 2020": "2020-09-30",
    "Sep 2020": "2020-09-30",
    "Sept 2020": "2020-09-30",
    "may 2019": "2019-05-31",
    "2020 February": "2020-02-29",
    "2021-M2": "2021-02-28",
    "2021.M12": "2021-12-31",
    "1959M01": "1959-01-31",
    "Q1 2020": "2020-03-31",
    "Q4 2020": "2020-12-31",
    "2020-W14": "2020-04-11",
    "2018-W0": None,
    "2020-S1": "2020-06-30",
    "2020-S2": "2020-12-31",
    "2020-B1": "2020-01-01",
    "2020-B6": "2020-11-01",
    "2020-05-31": "2020-05-31",
    "2020-05-31T10:00:00": "2020-05-31",
    "010101": "2001-01-01",
    "991231": "1999-12-31",
    "junk": None,
    "2020-13": None,
    "2020-1": None,
    "2020-02-30": None,
    "2020-Q5": None,
    "2020-B7": None,
    "Smarch 2020": None,
    "": None,
}


def test_known_formats(frame):
    df = periods.with_period(frame([(p,) for p in CASES], "original_period string"))
    got = {r["original_period"]: r["period"] and r["period"].isoformat() for r in df.collect()}
    assert got == CASES


def test_weeks_agree_with_the_calendar(frame):
    rows, expected = [], {}
    for year in range(1990, 2031):
        for week in range(54):
            if week == 0 and dt.date(year, 1, 1).weekday() == 0:
                continue
            text = f"{year}-W{week:02d}"
            rows.append((text,))
            expected[text] = dt.datetime.strptime(text + "-6", "%Y-W%W-%w").date()
    got = periods.with_period(frame(rows, "original_period string")).collect()
    assert {r["original_period"]: r["period"] for r in got} == expected


def test_rejects_by_shape(frame):
    texts = [("FY2020",), ("FY1999",), ("n/a",), ("2020",), (None,)]
    got = periods.rejected_periods(frame(texts, "original_period string")).collect()
    assert {(r["shape"], r["n_rows"]) for r in got} == {("AA9999", 2), ("A/A", 1)}


@pytest.mark.parametrize("value", [None])
def test_null_stays_null(frame, value):
    assert periods.with_period(frame([(value,)], "original_period string")).first()["period"] is None


def test_full_dates_and_outer_blanks(frame):
    texts = {
        "2020/05/31": "2020-05-31", "2020.05.31": "2020-05-31", "20200531": "2020-05-31",
        "May 31, 2020": "2020-05-31", "September 3, 1999": "1999-09-03", "Sep. 03,1999": "1999-09-03",
        " 2020-12": "2020-12-31", "2020-12-30 ": "2020-12-30", "2020/05.31": None, "20201331": None,
        "May 32, 2020": None, "2020/13/01": None, "31 May 2020": None,
    }
    df = frame([(t,) for t in texts], "p string")
    got = {r["p"]: r["d"] for r in df.select("p", periods.period_date("p").cast("string").alias("d")).collect()}
    assert got == texts
