"""Row order as a column, so that a comparison of row bags covers it."""

from __future__ import annotations

from tidemark.operators.paging import with_position

__all__ = ["with_position"]
