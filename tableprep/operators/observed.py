"""Reports gathered while the job's own pass runs (`DataFrame.observe`).

A metric next to the scan costs no scan of its own, but Spark adds a task's numbers
again when a lost executor makes it repeat the task before a shuffle. Metrics behind
the last shuffle are added once per task. So each report that is taken before the
merge has a control: the rows that came through the merge, counted behind it. Where
the two differ the report is counted again from its table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tableprep.operators.profile import null_count_expr


class Watch:
    """Named metrics of tables that pass; read after the job that wrote them."""

    def __init__(self):
        self.seen: dict[str, tuple[Observation, DataFrame, list]] = {}
        self.earlier: list[dict] = []  # of passes before the current one

    def next_pass(self) -> None:
        """The same metrics will be taken of further rows; all are counts, and are added up."""
        if self.seen:
            self.earlier.append(self.seen)
            self.seen = {}

    def rows(self, df: DataFrame, name: str, *exprs) -> DataFrame:
        """``df``, with ``exprs`` (aliased aggregates) and its number of rows taken."""
        exprs = [F.count(F.lit(1)).alias('rows'), *exprs]
        o = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        self.seen[name] = (o, df, exprs)
        return df.observe(o, *exprs)

    def get(self, name: str, rows: int | None = None) -> dict:
        """The metrics; where ``rows`` (the control) says that rows were taken twice,
        they are counted again from the table."""
        parts = [seen[name] for seen in (*self.earlier, self.seen) if name in seen]
        found = _added(o.get for o, _, _ in parts)
        if rows is not None and found['rows'] != rows:
            found = _added(df.agg(*exprs).first().asDict() for _, df, exprs in parts)
        return found


def _added(counts) -> dict:
    out: dict = {}
    for part in counts:
        out = {k: out.get(k, 0) + v for k, v in part.items()}
    return out


def missing_exprs(cols) -> list:
    """Missing cells by column, and rows by their number of missing cells."""
    n = null_count_expr(cols)
    return [*[F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast('long')), F.lit(0)).alias(f"missing__{i}") for i, c in enumerate(cols)],
            *[F.coalesce(F.sum((n == k).cast('long')), F.lit(0)).alias(f"with__{k}") for k in range(len(cols) + 1)]]


def missing_counts(found: dict, cols) -> dict:
    return {c: int(found[f"missing__{i}"]) for i, c in enumerate(cols)}


def _nth(counts: list[int], n: int) -> int:
    """The n-th smallest (from 0) of values 0, 1, ... that occur ``counts`` times."""
    for value, c in enumerate(counts):
        if n < c:
            return value
        n -= c
    raise IndexError(n)


def missing_per_row(found: dict, cols) -> dict:
    """B5 from rows by number of missing cells: as many numbers as columns, whatever the rows."""
    counts = [int(found[f"with__{k}"]) for k in range(len(cols) + 1)]
    n = sum(counts)
    if not n:
        return {'count': 0.0}
    total = sum(k * c for k, c in enumerate(counts))
    out = {'count': float(n), 'mean': total / n}
    if n > 1:
        out['std'] = ((sum(k * k * c for k, c in enumerate(counts)) - total * total / n) / (n - 1)) ** 0.5
    for name, p in (('min', 0.0), ('p25', 0.25), ('p50', 0.5), ('p75', 0.75), ('max', 1.0)):
        at = p * (n - 1)
        low, high = _nth(counts, int(at)), _nth(counts, min(int(at) + 1, n - 1))
        out[name] = low + (at - int(at)) * (high - low)
    return out
