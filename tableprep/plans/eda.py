"""P3 — EDA report on the training snapshot (A6): ten small tables, or one long one.

eda_report() needs two of the snapshot's columns; eda_long() writes those two once, so
the snapshot and what leads up to it run one time for all ten reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep.operators import clean, stats
from tableprep.session import materialize

MAJOR_CATEGORIES = ['Condominium', 'Apartment', 'Service Residence', 'Flat']


def eda_report(snapshot: DataFrame, label: str = 'price', by: str = 'property_type',
               categories=MAJOR_CATEGORIES) -> dict:
    major, excluded = clean.keep_categories(snapshot, by, categories)
    summary = stats.grouped_summary(major, by, label)
    return {
        'central': stats.central(snapshot, label),                       # K1
        'skew': stats.skew(snapshot, label),                             # K2
        'skew_compare': stats.skew_compare(snapshot, label),             # K3
        'histogram': stats.histogram(snapshot, label, 50),               # K6
        'kde': stats.kde(snapshot, label, 200),                          # K7
        'excluded_categories': excluded,                                 # C11
        'grouped_summary': summary,                                      # K4
        'highest_median': stats.arg_max(summary, by, 'median'),          # K5
        'highest_spread': stats.arg_max(summary, by, 'std'),             # K5
        'box': stats.box_stats(major, by, label),                        # K8
    }


#: What the long table shows of each report: (item column or None, numbers, texts).
LONG = {
    'central': (None, ['count', 'mean', 'median', 'std', 'min', 'max', 'mode', 'mode_rows'], []),
    'skew': (None, ['skewness'], ['direction']),
    'skew_compare': (None, ['skew_raw', 'skew_log10'], []),
    'histogram': ('bin', ['lower', 'upper', 'count'], []),
    'kde': ('point', ['x', 'density'], []),
    'excluded_categories': ('value', ['count'], []),
    'grouped_summary': ('{by}', ['count', 'mean', 'median', 'iqr', 'min', 'max', 'std'], []),
    'highest_median': ('group', ['value'], []),
    'highest_spread': ('group', ['value'], []),
    'box': ('{by}', ['q1', 'median', 'q3', 'whisker_low', 'whisker_high', 'outliers'], []),
}


def _rows(report: str, df: DataFrame, item: str | None, numbers, texts) -> DataFrame:
    def cell(metric: str, value: Column, text: Column) -> Column:
        return F.struct(F.lit(metric).alias('metric'), value.cast('double').alias('value'), text.cast('string').alias('text'))

    none = F.lit(None)
    cells = [cell(m, F.col(m), none) for m in numbers] + [cell(m, none, F.col(m)) for m in texts]
    return df.select(F.lit(report).alias('report'), (F.col(f"`{item}`").cast('string') if item else none.cast('string')).alias('item'),
                     F.explode(F.array(*cells)).alias('r')).select('report', 'item', 'r.*')


def eda_long(snapshot: DataFrame, label: str = 'price', by: str = 'property_type', categories=MAJOR_CATEGORIES) -> DataFrame:
    """All ten reports as (report, item, metric, value, text)."""
    narrow = materialize(snapshot.select(by, label), 'eda')
    made = eda_report(narrow, label, by, categories)
    return reduce(DataFrame.unionByName, [
        _rows(name, made[name], item and item.format(by=by), numbers, texts) for name, (item, numbers, texts) in LONG.items()])
