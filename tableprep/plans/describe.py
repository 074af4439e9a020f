"""P2 — descriptive-statistics job: parse raw text columns, one aggregate for
every statistic of every variable, write the statistics table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tableprep.operators import profile
from tableprep.sources import io

LISTING_SPEC = {'Price': ('price', 'digits'), 'Property Size': ('property_size', 'digits'),
                'Bedroom': ('bedroom', 'first_decimal'), 'Bathroom': ('bathroom', 'first_decimal'),
                'Completion Year': ('completion_year', 'first_decimal'),
                'Floors': ('floors', 'first_decimal'), 'Total Units': ('total_units', 'first_decimal'),
                'Parking Lot': ('parking_lot', 'first_decimal')}


def describe_job(raw: DataFrame, spec: dict = LISTING_SPEC, path: str | None = None) -> DataFrame:
    out = profile.describe_table(raw, spec)
    if path:
        io.write_stats(out, path)
    return out
