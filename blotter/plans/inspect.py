"""Plan inspection for tests and tuning: the text of ``explain`` and simple counts over it."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, node: str) -> int:
    """Occurrences of a physical operator name (e.g. ``Exchange``) in the simple plan."""
    return len(re.findall(rf"\b{re.escape(node)}\b", plan_text(df, "simple")))


def scan_summary(df: DataFrame) -> list[dict[str, str]]:
    """For every file scan: pushed filters, partition filters and the read schema."""
    out = []
    for block in plan_text(df, "formatted").split("\n\n"):
        if "Scan parquet" not in block or "ReadSchema" not in block:
            continue
        info = {}
        for key in ("PushedFilters", "PartitionFilters", "ReadSchema", "Location"):
            m = re.search(rf"{key}: (.*)", block)
            if m:
                info[key] = m.group(1).strip()
        out.append(info)
    return out
