"""Categorical encoding.

Fixed maps are `when` chains without `otherwise` (unmatched and missing stay
missing). The rare merge joins rows to a fitted table of any size. A column per
category is made of literal expressions in one projection. A table has no room for
more than `max_categories` such columns: fit_items() and fit_rare_one_hot() then give
a fitted table and one sparse column instead (vocabulary.py), fit_multi_hot() and
fit_one_hot(), which promise wide columns, raise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep.functions import text as X
from tableprep.operators import vocabulary as V
from tableprep.session import materialize

#: Columns that one encoder may add to a wide table.
MAX_CATEGORIES = 1000


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def merge_values(c, mapping: dict) -> Column:
    """Rename some categories into others; everything else unchanged."""
    out = X.col(c)
    expr = None
    for a, b in mapping.items():
        expr = (F.when(out == a, F.lit(b)) if expr is None else expr.when(out == a, F.lit(b)))
    return expr.otherwise(out) if expr is not None else out


def binary_map(c, mapping: dict) -> Column:
    """Value map; unmatched and missing → missing (no `otherwise`)."""
    c = X.col(c)
    items = list(mapping.items())
    expr = F.when(c == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(c == k, F.lit(v))
    return expr


def ordinal_map(c, order) -> Column:
    """Position (1-based) in `order`, else missing."""
    return binary_map(c, {v: i + 1 for i, v in enumerate(order)})


def known_flag(c, order) -> Column:
    """I4: 1 when the value is one of the known categories, else 0."""
    return F.coalesce(X.col(c).isin(list(order)), F.lit(False)).cast('int')


def safe_name(prefix: str, value: str) -> str:
    return f"{prefix}_{value}".replace(' ', '_')


def column_names(prefix: str, values, taken=()) -> list[str]:
    """A name of its own for each value, in their order: safe_name(), and where that
    is gone (names are compared without case, as Spark does) with the least free
    number from 2. `taken` are other columns' names."""
    used, out = {t.lower() for t in taken}, []
    for v in values:
        name, k = safe_name(prefix, v), 2
        while name.lower() in used:
            name, k = f"{safe_name(prefix, v)}_{k}", k + 1
        used.add(name.lower())
        out.append(name)
    return out


def _collect_categories(values: DataFrame, what: str, limit: int):
    rows = values.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} categories; raise max_categories "
                         "or encode in long form")
    return sorted(r[0] for r in rows)


# --- I5 multi-hot ---------------------------------------------------------------

@dataclass(frozen=True)
class MultiHotParams:
    vocabulary: tuple
    prefix: str = 'Has'
    taken: tuple = ()      # names that other columns have

    @property
    def width(self) -> int:
        return len(self.vocabulary)

    def columns(self):
        return column_names(self.prefix, self.vocabulary, self.taken)


def fit_multi_hot(train: DataFrame, list_col: Column, prefix: str = 'Has',
                  max_categories: int = MAX_CATEGORIES) -> MultiHotParams:
    """Sorted vocabulary of list items seen in the training rows."""
    items = train.select(F.explode(list_col).alias('item')).distinct()
    return MultiHotParams(tuple(_collect_categories(items, 'multi_hot', max_categories)), prefix)


def fit_items(train: DataFrame, list_col: Column, prefix: str = 'Has', taken=(), max_categories: int = MAX_CATEGORIES):
    """I5 fit for any vocabulary: MultiHotParams up to `max_categories` items, else SparseParams."""
    items = materialize(train.select(F.explode(list_col).alias('item')).distinct(), 'items')
    if items.count() > max_categories:
        return V.fit_sparse(items, '', prefix)
    return MultiHotParams(tuple(_collect_categories(items, 'multi_hot', max_categories)), prefix, tuple(taken))


def apply_items(df: DataFrame, key: str, list_col: Column, p) -> DataFrame:
    """I5 with either kind of fit; `key` is used by the sparse one only."""
    return V.apply_items(df, key, list_col, p) if isinstance(p, V.SparseParams) else apply_multi_hot(df, list_col, p)


def apply_multi_hot(df: DataFrame, list_col: Column, p: MultiHotParams) -> DataFrame:
    lst = F.col('__items')
    out = df.withColumn('__items', list_col)
    return out.withColumns({n: F.array_contains(lst, v).cast('int')
                            for n, v in zip(p.columns(), p.vocabulary)}).drop('__items')


def unseen_items(df: DataFrame, list_col: Column, p: MultiHotParams) -> DataFrame:
    """Items present in `df` but not in the fitted vocabulary (with counts)."""
    items = df.select(F.explode(list_col).alias('item'))
    if isinstance(p, V.SparseParams):
        unseen = items.join(p.table, F.col('item') == F.col('value'), 'left_anti')
    else:
        unseen = items.filter(~F.col('item').isin(list(p.vocabulary)))
    return unseen.groupBy('item') \
        .agg(F.count(F.lit(1)).alias('count'))


# --- I6 rare merge ----------------------------------------------------------------

def rare_table(train: DataFrame, col: str, min_count: int) -> DataFrame:
    """I6 fit: table of the categories (non-missing) with fewer than `min_count` training rows."""
    return train.filter(_q(col).isNotNull()).groupBy(_q(col).alias('rare')).agg(F.count(F.lit(1)).alias('n')) \
        .filter(F.col('n') < min_count).select('rare')


def merge_rare(df: DataFrame, rare: DataFrame, col: str, other: str = 'Other') -> DataFrame:
    """Categories of rare_table() become `other`, by a join, so there may be any number."""
    r = rare.select(F.col('rare').alias('__rare'))
    return df.join(r, _q(col) == F.col('__rare'), 'left') \
        .withColumn(col, F.when(F.col('__rare').isNotNull(), F.lit(other)).otherwise(_q(col))).drop('__rare')


@dataclass(frozen=True)
class RareParams:
    """The rare categories as a tuple, or as a `table` (rare) where they are many."""
    column: str
    rare: tuple
    other: str = 'Other'
    table: DataFrame | None = None


def fit_rare(train: DataFrame, col: str, min_count: int, other: str = 'Other',
             max_categories: int = MAX_CATEGORIES) -> RareParams:
    """rare_table() as parameters, for rows that are encoded with one column per category."""
    counts = rare_table(train, col, min_count)
    return RareParams(col, tuple(_collect_categories(counts, 'rare_merge', max_categories)), other)


def apply_rare(df: DataFrame, p: RareParams) -> DataFrame:
    c = _q(p.column)
    if p.table is not None:
        return merge_rare(df, p.table, p.column, p.other)
    if not p.rare:
        return df
    return df.withColumn(p.column, F.when(c.isin(list(p.rare)), F.lit(p.other)).otherwise(c))


# --- I7 one-hot -------------------------------------------------------------------

@dataclass(frozen=True)
class OneHotParams:
    column: str
    categories: tuple      # sorted training categories; the first is the reference
    prefix: str

    @property
    def width(self) -> int:
        return max(len(self.categories) - 1, 0)

    def columns(self):
        return column_names(self.prefix, self.categories[1:])


def fit_one_hot(train: DataFrame, col: str, prefix: str,
                max_categories: int = MAX_CATEGORIES) -> OneHotParams:
    cats = train.filter(_q(col).isNotNull()).select(_q(col)).distinct()
    return OneHotParams(col, tuple(_collect_categories(cats, 'one_hot', max_categories)), prefix)


def apply_one_hot(df: DataFrame, p: OneHotParams) -> DataFrame:
    """Drop-first one-hot; values unseen in training give all zeros."""
    if isinstance(p, V.SparseParams):
        return V.apply_category(df, p)
    c = _q(p.column)
    return df.withColumns({n: F.coalesce(c == v, F.lit(False)).cast('int')
                           for n, v in zip(p.columns(), p.categories[1:])})


# --- I6 + I7 fitted together ----------------------------------------------------------

def fit_rare_one_hot(train: DataFrame, spec: dict, other: str = 'Other',
                     max_categories: int = MAX_CATEGORIES):
    """Rare lists and one-hot categories for several columns from ONE grouped
    count over the training rows. `spec` = {column: (min_count, prefix)}.

    The one-hot categories after the merge are the frequent values plus
    `other` when anything was merged, sorted — no second pass needed.
    Returns {column: (RareParams, OneHotParams or SparseParams)}: lists of up to
    `max_categories` are read, longer ones stay tables.
    """
    cells = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias('column'), _q(c).cast('string').alias('value')) for c in spec])).alias('r')) \
        .select('r.*').filter(F.col('value').isNotNull())
    counts = materialize(cells.groupBy('column', 'value').agg(F.count(F.lit(1)).alias('n')), 'category-counts')
    out = {}
    for c, (min_count, prefix) in spec.items():
        own = counts.filter(F.col('column') == c)
        rare, kept = own.filter(F.col('n') < min_count).select('value'), own.filter(F.col('n') >= min_count).select('value')
        some = rare.limit(max_categories + 1).collect()
        merged = RareParams(c, tuple(sorted(r[0] for r in some)), other) if len(some) <= max_categories \
            else RareParams(c, (), other, rare.select(F.col('value').alias('rare')))
        if some:
            kept = kept.union(rare.select(F.lit(other).alias('value')).limit(1)).distinct()
        head = kept.limit(max_categories + 1).collect()
        out[c] = (merged, OneHotParams(c, tuple(sorted(r[0] for r in head)), prefix) if len(head) <= max_categories
                  else V.fit_sparse(kept, c, prefix, reference=True))
    return out
