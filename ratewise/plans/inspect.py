"""Plan inspection helpers: the text of ``explain`` for checks on plan shape
(which operators Catalyst chose, what reached the scan)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_operator(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator (e.g. ``Exchange``) in the plan tree."""
    tree = plan_text(df, "simple")
    return sum(1 for line in tree.splitlines() if name in line.split("[")[0])
