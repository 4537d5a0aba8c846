"""What a physical plan holds, for tests and the bench."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


_INDENT = re.compile(r"[\s:+\-]*")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The explained plan of ``df``; after an action it is the plan that ran, without the ones adaptive execution started from."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    kept, skipped_below = [], None
    for line in out.getvalue().splitlines():
        depth = _INDENT.match(line).end()
        if skipped_below is not None and depth >= skipped_below:
            continue
        skipped_below = None
        if "== Initial Plan ==" in line:
            skipped_below = depth
        else:
            kept.append(line)
    return "\n".join(kept)


def count_nodes(df: DataFrame, node: str) -> int:
    """How often an operator name such as ``Exchange`` stands at the start of a plan node."""
    pattern = rf"^[\s:+\-|]*(?:\*\(\d+\) )?{re.escape(node)}\b(?! *(?:Stage|QueryStage))"
    return len(re.findall(pattern, plan_text(df), re.MULTILINE))
