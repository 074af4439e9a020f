"""Query registry: one Spark query per operator ID, with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprep.plans import prepare as PP
from tableprep.session import in_passes, materialize, pass_count
from tableprep.sources import fixtures

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Presentation rounding of every double column (both engines compute the
    same value up to the last bits; the check compares rounded values)."""
    return df.withColumns({f.name: F.round(F.col(f"`{f.name}`"), digits)
                           for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)})


def rnd(sql: str, cols, digits: int = 6) -> str:
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql})"


# --- Spark stages (memoised per session + folder within one call chain) ------------

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.listings(spark, sf)


def by_key(spark: SparkSession, sf: str, make, name: str) -> DataFrame:
    """make(listings), where `make` brings together only rows of one key: in passes over
    the keys where the listings are many."""
    return in_passes(raw(spark, sf), ['ad_id'], make, name)


def exact(r: DataFrame) -> DataFrame:
    return PP.dedup.drop_exact(PP.cleaned(r), 'ad_id')


def stage(spark: SparkSession, sf: str, name: str, cols=None, whole: bool = False) -> DataFrame:
    """A stage's table. The fitted stages are written on the way, where Spark can't see which
    columns are read on: `cols` says so. The merge ranks whole rows all the same, but carries
    and writes these columns and the outlier rules' alone. Queries that read most columns of
    a merged table say `whole`: it is then written pass by pass where the listings are many,
    instead of being shuffled at once with the columns that Spark finds are read."""
    r = raw(spark, sf)
    if name == 'clean':
        return PP.cleaned(r)
    if name == 'exact':
        return by_key(spark, sf, exact, 'exact')
    made = {
        'merged': PP.merged,
        'scoped': PP.scoped,
        'typed': lambda r: PP.typed(r)[0],
        'corrected': lambda r: PP.corrected(PP.typed(r)[0])[0],
        'recovered': lambda r: PP.recovered(PP.corrected(PP.typed(r)[0])[0])[0],
        'splitted': lambda r: PP.until_split(r)[0],
    }
    if name in made:
        return by_key(spark, sf, made[name], name) if whole else made[name](r)
    if name == 'outl':
        # fitted stages start from the split table written to the checkpoint
        # folder, so each fit scans it instead of replaying the merge
        def make(r):
            done = PP.until_split(r)[0]
            return done if cols is None else done.select(*dict.fromkeys([*PP.rule_columns(), *cols]))
        n = pass_count(r)
        done = materialize(make(r), 'split-stage') if n == 1 else in_passes(r, ['ad_id'], make, 'split-stage', n)
        return PP.outlier_rules(done, PP.PrepareConfig())[0]
    if name == 'feat':
        outl = stage(spark, sf, 'outl', cols and PP.feature_inputs(cols))
        return PP.fixed_features(outl, only=cols)
    raise KeyError(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fixtures.table(spark, sf, name)
