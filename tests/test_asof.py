import datetime as dt
import random

import pytest

from tidemark.operators import asof
from tidemark.store import KeyMapper


@pytest.fixture
def id_map(frame):
    return frame(
        [
            ("0000033115", dt.datetime(2006, 4, 28), dt.datetime(2007, 11, 14, 23, 59, 59), "004416"),
            ("0000033115", dt.datetime(2007, 11, 15), dt.datetime(2100, 12, 31), "014477"),
            ("0000940800", dt.datetime(2006, 4, 28), dt.datetime(2100, 12, 31), "061411"),
        ],
        "cik string, effdate timestamp_ntz, thrudate timestamp_ntz, gvk string",
    )


def test_mapping_by_either_key(id_map):
    mapper = KeyMapper(id_map)
    (row,) = mapper.get_gvk_from_cik(33115, "2007-01-01T00:00:00").collect()
    assert (row["cik"], row["gvk"]) == ("0000033115", "004416")
    assert mapper.get_gvk_from_cik(33115).count() == 2
    assert mapper.get_gvk_from_cik(33115, "2007-11-14T23:59:59").first()["gvk"] == "004416"
    assert mapper.get_gvk_from_cik(33115, "1999-01-01").count() == 0
    (row,) = mapper.get_cik_from_gvk(61411, "2007-03-14T00:00:00").collect()
    assert row["cik"] == "0000940800" and row["thrudate"] == dt.datetime(2100, 12, 31)


@pytest.mark.parametrize("how, days", [("left", 365), ("inner", 1), ("left", 30)])
def test_attach_as_of_equals_brute_force(frame, how, days):
    """Overlapping intervals, gaps, unknown keys and one key with a third of the facts."""
    rng = random.Random(7)
    start = dt.datetime(1998, 1, 1)

    def moment():
        return start + dt.timedelta(hours=rng.randrange(24 * 365 * 6))

    mapping = []
    for i in range(120):
        low = moment()
        high = dt.datetime(2100, 12, 31) if i % 9 == 0 else low + dt.timedelta(days=rng.randrange(900))
        mapping.append((f"k{rng.randrange(20)}", low, high, f"g{i}"))
    facts = [(i, "k1" if i % 3 == 0 else f"k{rng.randrange(25)}", moment()) for i in range(600)]
    found = asof.attach_as_of(
        frame(facts, "id int, cik string, at timestamp_ntz"),
        frame(mapping, "cik string, effdate timestamp_ntz, thrudate timestamp_ntz, gvk string"),
        "cik",
        "at",
        how,
        days,
    )
    expected = []
    for i, key, at in facts:
        hits = [g for k, low, high, g in mapping if k == key and low <= at <= high]
        expected += [(i, g) for g in hits] or ([(i, None)] if how == "left" else [])
    got = [(r["id"], r["gvk"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_padded_keys(frame):
    row = asof.padded_keys(frame([(33115, 4416)], "cik bigint, gvk bigint"), gvk="gvk").first()
    assert tuple(row) == ("0000033115", "004416")
