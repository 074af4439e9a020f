"""Fixed-rule feature engineering (H1-H6, plus E12/E14 as columns).

Nothing here is fitted: every function is a row-local projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.functions import text as X


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def flag_name(col: str) -> str:
    return 'Has_' + col.replace(' ', '_')


def age(c, ref: int = C.REFERENCE_YEAR) -> Column:
    """H1: ref − year; negative (off-plan) and missing → missing."""
    a = F.lit(ref) - X.col(c)
    return F.when(a >= 0, a)


def is_after(c, ref: int = C.REFERENCE_YEAR) -> Column:
    """H4: 1 when year > ref, 0 when not, missing when the year is missing."""
    return (X.col(c) > ref).cast('int')


def presence(cols, name=flag_name) -> dict:
    return {name(c): _q(c).isNotNull().cast('int') for c in cols}


def presence_flags(df: DataFrame, cols, name=flag_name) -> DataFrame:
    """H2: 0/1 'value recorded' flags."""
    return df.withColumns(presence(cols, name))


def row_sum(cols) -> Column:
    """H5: sum of columns (missing propagates)."""
    return sum((_q(c) for c in cols[1:]), _q(cols[0]))


def safe_ratio(a, b) -> Column:
    """H6: a / b, missing for b = 0 or missing."""
    return F.try_divide(X.col(a), X.col(b))


def columns(address: str, year: str, facilities: str, nearby, states=C.VALID_STATES, ref: int = C.REFERENCE_YEAR) -> dict:
    """{name: expression}: state (E12), property age (H1), facility count (E14), Has_X flags (H2)."""
    return {
        'state': X.last_segment_match(_q(address), states),
        'property_age': age(_q(year), ref),
        'listed_facility_count': X.list_count(_q(facilities)),
        **presence(nearby),
    }


def engineer(df: DataFrame, address: str, year: str, facilities: str, nearby,
             states=C.VALID_STATES, ref: int = C.REFERENCE_YEAR) -> DataFrame:
    """State (E12), Property Age (H1), facility count (E14), Has_X flags (H2)."""
    return df.withColumns(columns(address, year, facilities, nearby, states, ref))


def engineering_report(df: DataFrame, address: str, year: str, facilities: str,
                       by: str = 'split', ref: int = C.REFERENCE_YEAR) -> DataFrame:
    """H3: per split: missing sources, unmatched states, off-plan, result ranges."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias('rows'),
        F.sum(_q(address).isNull().cast('long')).alias('address_missing'),
        F.sum((_q(address).isNotNull() & F.col('state').isNull()).cast('long')).alias('state_unmatched'),
        F.sum(F.col('state').isNull().cast('long')).alias('state_missing'),
        F.sum(_q(year).isNull().cast('long')).alias('year_missing'),
        F.coalesce(F.sum((_q(year) > ref).cast('long')), F.lit(0)).alias('off_plan'),
        F.sum(F.col('property_age').isNull().cast('long')).alias('age_missing'),
        F.sum(_q(facilities).isNull().cast('long')).alias('facilities_missing'),
        F.min('listed_facility_count').alias('facility_count_min'),
        F.max('listed_facility_count').alias('facility_count_max'))
