"""Argument checks, raised on the driver before any plan is built."""

from __future__ import annotations

import datetime as dt
import warnings
from collections import Counter

from tidemark import schemas

INSTANT_FORMAT = "%Y-%m-%dT%H:%M:%S%z"


def parse_instant(text: str) -> dt.datetime:
    """Aware UTC datetime of a bound such as `2021-03-05T19:41:02-05:00`."""
    try:
        return dt.datetime.strptime(text, INSTANT_FORMAT).astimezone(dt.timezone.utc)
    except (TypeError, ValueError):
        raise ValueError(f"bound {text!r} is not of the form YYYY-MM-DDTHH:MM:SS+ZZ:ZZ") from None


def check_window(start, end, mode):
    """Parsed (start, end); either may be None, both are when no window is asked."""
    if not start and not end:
        if mode:
            raise ValueError("date_mode needs start_datetime or end_datetime")
        return None, None
    if mode is None:
        raise ValueError("start_datetime and end_datetime need a date_mode")
    if mode not in schemas.DATE_MODES:
        raise ValueError(f"date_mode must be one of {schemas.DATE_MODES}")
    low = parse_instant(start) if start else None
    high = parse_instant(end) if end else None
    if low and high and low > high:
        raise ValueError("start_datetime lies after end_datetime")
    return low, high


def as_list(value):
    if value is None:
        return None
    return list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]


def clean_ids(name: str, value):
    """What a filter on `name` means: None is no filter, one id is a list of it, and a list stands
    for the set of its ids, given in order. A repeated id is worth a warning."""
    if value is None:
        return None
    times = Counter(as_list(value))
    repeated = [i for i, n in times.items() if n > 1]
    if repeated:
        warnings.warn(f"{name}: {len(repeated)} ids are given more than once", stacklevel=3)
    return sorted(times)


def clean_filers(value):
    """Filer ids are positive integers."""
    ids = clean_ids("cik", value)
    wrong = [i for i in ids or [] if isinstance(i, bool) or not isinstance(i, int) or i <= 0]
    if wrong:
        raise ValueError(f"cik must be a positive integer: {wrong}")
    return ids


def check_form_types(value, valid=None):
    valid = schemas.FORM_TYPES if valid is None else valid
    forms = as_list(value)
    unknown = sorted(set(forms or []) - set(valid))
    if unknown:
        raise ValueError(f"unknown form types {unknown}; known are {list(valid)}")
    return forms


def check_exclusive(**given):
    names = [name for name, value in given.items() if value is not None]
    if len(names) > 1:
        raise ValueError(f"give only one of {names}")


def check_facet(facet: str) -> str:
    if facet not in schemas.FACETS:
        raise ValueError(f"{facet} is not one of {list(schemas.FACETS)}")
    return schemas.FACETS[facet]
