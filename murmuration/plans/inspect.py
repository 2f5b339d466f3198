"""Read a DataFrame's physical plan as text (the same text ``explain`` prints)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
             "PythonUDF")


def plan_string(df: DataFrame, mode: str = "formatted") -> str:
    """``explain(mode)`` output as a string (``simple``, ``extended``,
    ``formatted``, ``cost`` or ``codegen``)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def operator_names(df: DataFrame) -> list[str]:
    """Operator names of the physical plan, in plan order."""
    text = plan_string(df, "simple")
    return re.findall(r"(?:^|[+:-]\s|\*\(\d+\)\s)([A-Z][A-Za-z]+)", text, flags=re.M)


def python_nodes(df: DataFrame) -> list[str]:
    """Plan nodes that run Python (UDF evaluation, pandas map / apply)."""
    text = plan_string(df, "simple")
    return [n for n in _PY_NODES if n in text]


def scan_details(df: DataFrame) -> list[dict[str, str]]:
    """For every file scan: its ``PushedFilters`` and ``ReadSchema``."""
    text = plan_string(df, "formatted")
    out = []
    for block in re.split(r"\n\(\d+\) ", text):
        if not block.startswith("Scan "):
            continue
        info = {"scan": block.splitlines()[0]}
        for key in ("PushedFilters", "ReadSchema", "Location"):
            m = re.search(rf"^{key}: (.*)$", block, flags=re.M)
            if m:
                info[key] = m.group(1)
        out.append(info)
    return out


def _content_col(line: str) -> int:
    m = re.search(r"[A-Za-z*(=]", line)
    return m.start() if m else len(line)


def _drop_initial_plans(text: str) -> str:
    """Keep only the adaptive final plans: drop every ``== Initial Plan ==``
    subtree (the main query's and each subquery's)."""
    out, skip_above = [], None
    for line in text.splitlines():
        col = _content_col(line)
        if skip_above is not None:
            # the subtree's lines start at the marker's column or deeper
            if col >= skip_above:
                continue
            skip_above = None
        if "== Initial Plan ==" in line:
            skip_above = col
            continue
        out.append(line)
    return "\n".join(out)


def plan_summary(df: DataFrame, execute: bool = False) -> dict[str, int]:
    """Counts of the physical plan's costly parts: shuffles (distinct
    exchanges), broadcasts, sort-merge / broadcast hash joins, file scans
    and Python evaluation nodes.

    With ``execute`` the query runs first and the adaptive
    *final* plan is read, where exchange and subquery reuse have been
    applied; otherwise the initial plan is read.
    """
    before = plan_string(df, "simple")  # scans are fixed before execution
    scans = set(re.findall(r"FileScan \w+ \[([^\]]*)\][^\n]*Location: [^\[]*\[([^\]]*)\]",
                           before))
    if execute:
        # run this DataFrame's own execution (a write would plan anew); only
        # a row count comes back to the driver
        df._jdf.queryExecution().toRdd().count()
    text = _drop_initial_plans(plan_string(df, "simple"))
    exchanges = set(re.findall(
        r"Exchange (?:hashpartitioning|SinglePartition|rangepartitioning|RoundRobinPartitioning)"
        r"[^\n]*plan_id=(\d+)", text))
    return {
        "shuffles": len(exchanges),
        "broadcasts": len(set(re.findall(r"BroadcastExchange [^\n]*plan_id=(\d+)", text))),
        "sort_merge_joins": text.count("SortMergeJoin"),
        "broadcast_hash_joins": text.count("BroadcastHashJoin"),
        "scans": len(scans),
        "python_nodes": len(python_nodes(df)),
    }
