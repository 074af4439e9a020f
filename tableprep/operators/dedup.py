"""Duplicates and record merging.

Everything is an aggregate with map-side partial aggregation, so a hot key (a
third of all rows under one key) is combined on every map task before the
shuffle. Rows are brought back to their groups with joins against the (small
per-group) group table; AQE's skew-join split handles a hot group on the row
side. No window over a group, no self-join emitting pairs.

`apart` counts the keys by themselves first: a row with a key of its own has no copy,
no conflict and nothing to merge, so it need not be shuffled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep.operators.profile import duplicate_rows, shared_hashes
from tableprep.session import in_passes, materialize, pass_count


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(__key): the keys of more than one row, missing ones included (NULL == NULL).
    Only the key is read and shuffled; the table is written, so that Spark joins by its
    true size."""
    n = df.groupBy(_q(key).alias('__key')).agg(F.count(F.lit(1)).alias('n'))
    return materialize(n.filter('n > 1').select('__key'), 'repeated-keys')


def apart(df: DataFrame, key: str):
    """(rows whose key no other row has, the other rows)."""
    keys = repeated_keys(df, key)
    same = _q(key).eqNullSafe(F.col('__key'))
    return df.join(keys, same, 'left_anti'), df.join(keys, same, 'left_semi')


def drop_exact(df: DataFrame, key: str | None = None) -> DataFrame:
    """Exact duplicate rows removed (all columns equal, NULL == NULL). With `key`
    only rows that share theirs are compared."""
    if key is None:
        return df.dropDuplicates()
    alone, rest = apart(df, key)
    return alone.unionByName(rest.dropDuplicates())


def duplicate_keys(df: DataFrame, key: str):
    """(group table key→n for keys seen more than once, rows of those keys)."""
    groups = materialize(df.filter(_q(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias('n'))
                         .filter('n > 1'), 'duplicate-keys')
    rows = df.join(groups.select(key), key, 'left_semi')
    return groups, rows


def key_conflicts(df: DataFrame, key: str) -> DataFrame:
    """D3: per duplicate key, columns with more than one distinct non-missing value.

    Long form (key, column, value, n_values): cells are unpivoted as text and
    de-duplicated by (key, column, value) before anything is grouped by key, so
    a hot key never gathers its rows in one task or one array. A key of one row
    has no second value, so its cells are not unpivoted.
    """
    cols = [c for c in df.columns if c != key]
    kept = apart(df.filter(_q(key).isNotNull()), key)[1]
    # a column is its number until the end
    cells = kept.select(key, F.explode(F.array(*[
        F.struct(F.lit(i).cast('short').alias('__c'), _q(c).cast('string').alias('value')) for i, c in enumerate(cols)]))
        .alias('r')).select(key, 'r.*').filter(F.col('value').isNotNull()).distinct()
    n = cells.groupBy(key, '__c').agg(F.count(F.lit(1)).alias('n_values')).filter('n_values > 1')
    names = F.array(*[F.lit(c) for c in cols])
    return cells.join(n, [key, '__c'], 'inner').select(key, names[F.col('__c')].alias('column'), 'value', 'n_values')


def completeness(cols) -> Column:
    """Number of non-missing cells of the row."""
    return sum((_q(c).isNotNull().cast('int') for c in cols), F.lit(0))


def row_fingerprint(cols) -> Column:
    """Engine-independent total order of a row: md5 of its cells as text."""
    return F.md5(F.concat_ws(chr(1), *[F.coalesce(_q(c).cast('string'), F.lit(chr(2))) for c in cols]))


def row_order(cols) -> Column:
    """Merge priority of a row, smaller is preferred: the fuller row, then the
    smaller whole md5 fingerprint. The same for tables of any width."""
    return F.struct((-completeness(cols)).alias('c'), row_fingerprint(cols).alias('t'))


def row_rank(cols) -> Column:
    """row_order() as bytes of a fixed length that compare alike: the number of missing
    cells, then the md5's 16 bytes."""
    width = 2 * ((len(cols).bit_length() + 7) // 8)
    return F.unhex(F.concat(F.lpad(F.hex(F.lit(len(cols)) - completeness(cols)), width, '0'), row_fingerprint(cols)))


def merge_by_key(df: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """One row per key; each column takes the first non-missing value in
    (completeness desc, fingerprint asc) order. NULL keys are dropped. `count` names
    a further column for the number of rows merged.

    One aggregation: `min_by` ignores rows whose ordering is NULL, which is how
    a value-less row is skipped for that column only. The row priority is
    computed once, before the shuffle, with map-side partial aggregation. Every
    column's state holds it, so it is kept short.
    """
    cols = [c for c in df.columns if c != key]
    ranked = df.filter(_q(key).isNotNull()).withColumn('__order', row_rank(df.columns))
    merged = ranked.groupBy(key).agg(*[
        F.min_by(_q(c), F.when(_q(c).isNotNull(), F.col('__order'))).alias(c) for c in cols],
        *([F.count(F.lit(1)).alias(count)] if count else []))
    return merged.select(*df.columns, *([count] if count else []))


def merge_repeated(df: DataFrame, key: str) -> DataFrame:
    """D5 for a table that is cheap to read twice: rows with a key of their own pass as
    they are, so less is shuffled; the others go through `merge_by_key`."""
    alone, rest = apart(df.filter(_q(key).isNotNull()), key)
    return alone.unionByName(merge_by_key(rest, key))


def merge_evidence(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Original rows of merged keys next to their merged row, tagged by stage."""
    groups, rows = duplicate_keys(before, key)
    merged = after.join(groups.select(key), key, 'left_semi')
    return rows.withColumn('stage', F.lit('before')) \
        .unionByName(merged.withColumn('stage', F.lit('after_merge'))) \
        .select('stage', *before.columns)


def near_duplicate_count(df: DataFrame, ignore) -> DataFrame:
    """Duplicate rows when the `ignore` columns are left out."""
    subset = [c for c in df.columns if c not in set(ignore)]
    return duplicate_rows(materialize(df.select(*[_q(c) for c in subset]), 'near-duplicates'), subset)


def _by_likeness(df: DataFrame, subset, *kinds: str):
    """`df` with its rows' hash over `subset` in `__hash`, and of its rows those whose hash
    another row shares ('left_semi', all near duplicates are among them) or does not
    ('left_anti'). What leads up to `df` and the hash run once."""
    marked = materialize(df.withColumn('__hash', F.xxhash64(*[_q(c) for c in subset])), 'near-duplicates')
    shared, n = shared_hashes(marked), pass_count(marked)
    return marked, *[in_passes(marked, ['__hash'], lambda part: part.join(shared, '__hash', kind), 'by-likeness', n) for kind in kinds]


def near_duplicate_group_table(df: DataFrame, ignore, text: str, key: str) -> DataFrame:
    """Groups of more than one row."""
    subset = [c for c in df.columns if c not in set(ignore)]
    return df.groupBy(*[_q(c) for c in subset]).agg(
        F.count(F.lit(1)).alias('group_size'),
        F.min(_q(key)).alias('group_id'),
        (F.count_distinct(_q(text)) + F.max(_q(text).isNull().cast('int'))).alias('__n_text'),
    ).filter('group_size > 1').withColumn('description_identical', F.col('__n_text') <= 1) \
        .drop('__n_text')


def _tag_groups(df: DataFrame, groups: DataFrame, subset, how: str) -> DataFrame:
    """Join rows to their group row, NULL-safe on every subset column. The group
    table's columns are renamed first, so the self-derived join is unambiguous."""
    g = groups.select(*[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(subset)],
                      *[c for c in groups.columns if c not in set(subset)])
    cond = [_q(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(subset)]
    out = df.join(g, cond, how)
    return out.drop(*[f"__g{i}" for i in range(len(subset))])


def near_duplicate_groups(df: DataFrame, ignore, text: str, key: str) -> DataFrame:
    """Rows of near-duplicate groups with group id (= smallest key of the
    group), group size and whether the ignored text is identical in the group
    (missing counts as one value)."""
    subset = [c for c in df.columns if c not in set(ignore)]
    alike = materialize(_by_likeness(df, subset, 'left_semi')[1], 'alike')

    def make(part):
        part = part.drop('__hash')
        return _tag_groups(part, near_duplicate_group_table(part, ignore, text, key), subset, 'inner')
    return in_passes(alike, ['__hash'], make, 'near-duplicate-groups').select(
        'group_id', 'description_identical', 'group_size', *df.columns)


def torn_groups(df: DataFrame, cols, split: str = 'split', sides=None) -> DataFrame:
    """Groups equal on `cols` that have rows on more than one side of the split. Where
    the split's only two values are given as `sides`, flags stand for them: a group then
    has fixed-length state, and Spark hashes instead of sorting wide rows."""
    if sides is None:
        torn = F.min(_q(split)) != F.max(_q(split))
    else:
        torn = F.max(_q(split) == sides[0]) & F.max(_q(split) == sides[1])
    g = df.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias('n'), torn.alias('torn'))
    return g.agg(F.coalesce(F.sum(F.when(F.col('torn'), 1)), F.lit(0))
                 .cast('long').alias('torn_groups'),
                 F.coalesce(F.sum(F.when(F.col('n') > 1, 1)), F.lit(0)).cast('long').alias('identical_groups'))


def identical_groups(df: DataFrame, cols, label: str) -> DataFrame:
    """Groups of rows identical on `cols`: count, rows, label agreement."""
    g = df.groupBy(*[_q(c) for c in cols]).agg(
        F.count(F.lit(1)).alias('n'),
        (F.min(_q(label)).eqNullSafe(F.max(_q(label)))).alias('same_label')).filter('n > 1')
    return g.agg(F.count(F.lit(1)).alias('groups'),
                 F.coalesce(F.sum('n'), F.lit(0)).cast('long').alias('rows'),
                 F.coalesce(F.sum(F.col('same_label').cast('int')), F.lit(0)).cast('long')
                 .alias('groups_same_label'))


def duplicate_impact(df: DataFrame, by: str, ignore) -> DataFrame:
    """Near-duplicate surplus rows per category, relative to its row count."""
    subset = [c for c in df.columns if c not in set(ignore) or c == by]
    df, alike = _by_likeness(df.select(*[_q(c) for c in subset]), subset, 'left_semi')

    def make(part):
        groups = part.groupBy(*[_q(c) for c in subset]).agg(F.count(F.lit(1)).alias('__n'))
        return groups.groupBy(_q(by).alias(by)).agg(F.sum(F.col('__n') - 1).alias('__surplus'))
    none = F.lit(0).cast('long')
    out = df.groupBy(_q(by).alias(by)).agg(F.count(F.lit(1)).alias('__rows')).withColumn('__surplus', none) \
        .unionByName(in_passes(materialize(alike, 'alike'), ['__hash'], make, 'duplicate-impact').withColumn('__rows', none)) \
        .groupBy(_q(by).alias(by)).agg(F.sum('__rows').alias('rows'), F.sum('__surplus').alias('surplus'))
    return out.select(by, 'rows', 'surplus', F.round(F.col('surplus') * 100.0 / F.col('rows'), 2).alias('surplus_pct'))


def collapse_near_duplicates(df: DataFrame, ignore, text: str, key: str, exempt: DataFrame = None) -> DataFrame:
    """Near-duplicate groups whose text is identical collapse to one row
    (the column-wise merge of D5 keyed by group id); exempt group ids and
    groups with differing text are kept whole."""
    subset = [c for c in df.columns if c not in set(ignore)]
    _, alike, others = _by_likeness(df, subset, 'left_semi', 'left_anti')
    alike = materialize(alike, 'alike')
    n = pass_count(alike)

    def make(part):
        part = part.drop('__hash')
        g = materialize(near_duplicate_group_table(part, ignore, text, key).filter('description_identical'), 'near-duplicate-groups')
        if exempt is not None:
            g = g.join(exempt.select(F.col(exempt.columns[0]).alias('group_id')), 'group_id', 'left_anti')
        return _tag_groups(part, g.select('group_id', *subset), subset, 'left')
    tagged = in_passes(alike, ['__hash'], make, 'near-duplicates-tagged', n)
    members = tagged.filter(F.col('group_id').isNotNull())
    rest = others.drop('__hash').unionByName(tagged.filter(F.col('group_id').isNull()).drop('group_id'))
    merged = in_passes(members.withColumn(key, F.col('group_id')).drop('group_id'), [key],
                       lambda part: merge_by_key(part, key), 'collapsed', n)
    return rest.unionByName(merged)
