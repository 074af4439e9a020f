"""Outlier screens and evidence rules.

`fit_*` runs one aggregate over the training rows and collects a single row of
parameters (bounded by the number of columns); `apply`/flag functions are
row-local projections, so they run on train, test or a stream alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.functions import text as X
from tableprep.operators.quantile import exact_quantiles
from tableprep.session import materialize


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def chi2_cutoff_df2(p: float) -> float:
    """χ² quantile for 2 degrees of freedom (closed form: −2·ln(1−p))."""
    return -2.0 * math.log(1.0 - p)


# --- F1 z-score ---------------------------------------------------------------

@dataclass(frozen=True)
class ZParams:
    mean: dict
    std: dict


def fit_zscore(train: DataFrame, cols) -> ZParams:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(_q(c)).alias(f"m{i}"), F.stddev_samp(_q(c)).alias(f"s{i}")]
    r = train.agg(*aggs).first()
    return ZParams({c: r[f"m{i}"] for i, c in enumerate(cols)},
                   {c: r[f"s{i}"] for i, c in enumerate(cols)})


def zscore_expr(c: str, mean, std) -> Column:
    return F.try_divide(_q(c) - F.lit(mean), F.lit(std))  # missing where nothing varies


def zscore_flags(df: DataFrame, params: ZParams, t: float = C.Z_THRESHOLD, suffix='_z_outlier') -> DataFrame:
    """|z| > t flag per column (missing value → not flagged)."""
    return df.withColumns({
        f"{c}{suffix}": F.coalesce(F.abs(zscore_expr(c, params.mean[c], params.std[c])) > t,
                                   F.lit(False))
        for c in params.mean})


def zscore_by_group(df: DataFrame, col: str, by: str) -> DataFrame:
    """z of `col` against each group's own mean/std (fit_scope='each'). The per-group
    table is written, so that Spark picks the join by its true size: by an estimate from
    the rows it shuffles whole rows by group, which may be two."""
    g = df.groupBy(by).agg(F.avg(_q(col)).alias('__m'), F.stddev_samp(_q(col)).alias('__s'))
    return df.join(materialize(g, 'group-moments'), by, 'left').withColumn(
        '__z', F.try_divide(_q(col) - F.col('__m'), F.col('__s'))).drop('__m', '__s')


# --- F2/F3 IQR ----------------------------------------------------------------

@dataclass(frozen=True)
class IQRParams:
    q1: dict
    q3: dict
    k: float

    def lo(self, c):
        return None if self.q1[c] is None else self.q1[c] - self.k * (self.q3[c] - self.q1[c])

    def hi(self, c):
        return None if self.q1[c] is None else self.q3[c] + self.k * (self.q3[c] - self.q1[c])


def fit_iqr(train: DataFrame, cols, k: float = C.IQR_K) -> IQRParams:
    q = exact_quantiles(train, cols, [0.25, 0.75])
    return IQRParams({c: q[c][0] for c in cols}, {c: q[c][1] for c in cols}, k)


def iqr_flags(df: DataFrame, p: IQRParams, suffix='_iqr_outlier') -> DataFrame:
    return df.withColumns({
        f"{c}{suffix}": F.coalesce((_q(c) < F.lit(p.lo(c))) | (_q(c) > F.lit(p.hi(c))), F.lit(False))
        for c in p.q1})


def iqr_table(df: DataFrame, cols, k: float = C.IQR_K) -> DataFrame:
    """F2 + F3 as one report: quartiles, fences, degenerate flag, outlier count.

    Quartiles are a fit of a row per column; the counts against the fences
    are one aggregate."""
    df = materialize(df.select(*[_q(c) for c in cols]), 'iqr')  # what leads up to it runs once
    p = fit_iqr(df, cols, k)
    counts = []
    for i, c in enumerate(cols):
        out = (_q(c) < F.lit(p.lo(c))) | (_q(c) > F.lit(p.hi(c)))
        counts.append(F.coalesce(F.sum(out.cast('long')), F.lit(0)).alias(f"n{i}"))
    n = df.agg(*counts)
    return n.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias('column'), F.lit(p.q1[c]).cast('double').alias('q1'),
                 F.lit(p.q3[c]).cast('double').alias('q3'), F.lit(p.lo(c)).cast('double').alias('lower'),
                 F.lit(p.hi(c)).cast('double').alias('upper'), F.lit(p.q1[c] == p.q3[c]).alias('degenerate'),
                 F.col(f"n{i}").alias('outliers'))
        for i, c in enumerate(cols)])).alias('r')).select('r.*')


# --- F4/F5 Mahalanobis (two columns) -----------------------------------------------

@dataclass(frozen=True)
class MahalanobisParams:
    x: str
    y: str
    mx: float
    my: float
    vx: float
    vy: float
    cxy: float
    n: int
    cutoff: float


def fit_mahalanobis(train: DataFrame, x: str, y: str, p: float = C.CHI2_P) -> MahalanobisParams:
    pair = train.filter(_q(x).isNotNull() & _q(y).isNotNull())
    r = pair.agg(F.avg(_q(x)).alias('mx'), F.avg(_q(y)).alias('my'),
                 F.var_samp(_q(x)).alias('vx'), F.var_samp(_q(y)).alias('vy'),
                 F.covar_samp(_q(x), _q(y)).alias('cxy'), F.count(F.lit(1)).alias('n')).first()
    return MahalanobisParams(x, y, r['mx'], r['my'], r['vx'], r['vy'], r['cxy'], r['n'],
                             chi2_cutoff_df2(p))


def mahalanobis_sq(p: MahalanobisParams) -> Column:
    """Squared distance with the closed-form inverse of the 2×2 covariance."""
    det = None if p.cxy is None else p.vx * p.vy - p.cxy * p.cxy
    dx = _q(p.x) - F.lit(p.mx)
    dy = _q(p.y) - F.lit(p.my)
    return F.try_divide(dx * dx * F.lit(p.vy) - F.lit(2.0 * p.cxy) * dx * dy + dy * dy * F.lit(p.vx), F.lit(det))


def mahalanobis_flags(df: DataFrame, p: MahalanobisParams, out: str = 'mahalanobis_outlier') -> DataFrame:
    d2 = mahalanobis_sq(p)
    return df.withColumn('mahalanobis_d2', d2).withColumn(out, F.coalesce(d2 > p.cutoff, F.lit(False)))


def mahalanobis_table(df: DataFrame, x: str, y: str, p: float = C.CHI2_P) -> DataFrame:
    """F4 as one report: moments of the complete pairs (one-row fit), then the
    flagged count in one more aggregate."""
    mp = fit_mahalanobis(df, x, y, p)
    pair = df.filter(_q(x).isNotNull() & _q(y).isNotNull())
    return pair.agg(F.lit(mp.n).cast('long').alias('pairs'), F.lit(mp.cutoff).alias('cutoff'),
                    F.coalesce(F.sum((mahalanobis_sq(mp) > mp.cutoff).cast('long')), F.lit(0)).alias('outliers'))


# --- F4 for any number of columns ----------------------------------------------------

def _lower_gamma(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    term = total = 1.0 / a
    k = a
    while term > total * 1e-17:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi2_cutoff(p: float, dof: int) -> float:
    """χ² quantile for any degrees of freedom, by halving."""
    if dof == 2:
        return chi2_cutoff_df2(p)
    low, high = 0.0, 1.0
    while _lower_gamma(dof / 2, high / 2) < p:
        high *= 2
    while high - low > 1e-14 * high:
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if _lower_gamma(dof / 2, mid / 2) < p else (low, mid)
    return (low + high) / 2


@dataclass(frozen=True)
class DistanceParams:
    """Means and the covariance's lower Cholesky factor, row by row; None where the
    covariance has no inverse (a constant column, or one that follows from others)."""
    cols: tuple
    mean: tuple
    factor: tuple | None
    n: int
    cutoff: float


def _cholesky(cov: list[list[float]]) -> tuple | None:
    """Lower factor, or None where a pivot is nothing beside its column's own variance."""
    rows: list[list[float]] = []
    for i, c in enumerate(cov):
        rows.append([])
        for j in range(i):
            rows[i].append((c[j] - sum(a * b for a, b in zip(rows[i], rows[j]))) / rows[j][j])
        left = c[i] - sum(a * a for a in rows[i])
        if not left > 1e-12 * c[i] or not math.isfinite(left):
            return None
        rows[i].append(math.sqrt(left))
    return tuple(tuple(r) for r in rows)


def fit_distance(train: DataFrame, cols, p: float = C.CHI2_P) -> DistanceParams:
    """F4 fit: means, variances and covariances of the rows complete in `cols`, one
    aggregate whose row has a number per pair of columns."""
    cols = list(cols)
    whole = train.filter(' AND '.join(f"`{c}` IS NOT NULL" for c in cols))
    r = whole.agg(F.count(F.lit(1)).alias('n'), *[F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.covar_samp(_q(cols[i]), _q(cols[j])).alias(f"c{i}_{j}") for i in range(len(cols)) for j in range(i + 1)]).first()
    factor = None
    if r['n'] > 1:
        factor = _cholesky([[r[f"c{max(i, j)}_{min(i, j)}"] for j in range(len(cols))] for i in range(len(cols))])
    return DistanceParams(tuple(cols), tuple(r[f"m{i}"] for i in range(len(cols))), factor, r['n'], chi2_cutoff(p, len(cols)))


def distance_sq(p: DistanceParams) -> Column:
    """Squared Mahalanobis distance by forward substitution; missing for rows that aren't
    complete and where the covariance has no inverse."""
    if p.factor is None:
        return F.lit(None).cast('double')
    z: list[Column] = []
    for i, (c, row) in enumerate(zip(p.cols, p.factor)):
        left = _q(c) - F.lit(p.mean[i])
        for k in range(i):
            left = left - F.lit(row[k]) * z[k]
        z.append(left / F.lit(row[i]))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def distance_table(df: DataFrame, cols, p: float = C.CHI2_P) -> DataFrame:
    """F4 as one report for any number of columns."""
    dp = fit_distance(df, cols, p)
    d2 = distance_sq(dp)
    return df.agg(F.lit(dp.n).cast('long').alias('rows'), F.lit(dp.cutoff).alias('cutoff'),
                  F.coalesce(F.sum((d2 > dp.cutoff).cast('long')), F.lit(0)).alias('outliers'), F.avg(d2).alias('mean_d2'))


def distance_review(train: DataFrame, cols, key: str, p: float = C.CHI2_P, every: bool = False) -> DataFrame:
    """key and columns of the rows beyond the cutoff, with their squared distance; with
    `every`, of all complete rows, those beyond marked."""
    dp = fit_distance(train, cols, p)
    out = train.withColumn('d2', distance_sq(dp)).withColumn('outlier', F.col('d2') > dp.cutoff)
    out = out.filter(F.col('d2').isNotNull() if every else F.col('outlier'))
    return out.select(key, *cols, 'd2', *(['outlier'] if every else []))


def ellipse(p: MahalanobisParams) -> dict:
    """confidence-ellipse centre, angle (degrees), width and height."""
    a, b, c = p.vx, p.cxy, p.vy
    mid, rad = (a + c) / 2.0, math.sqrt(((a - c) / 2.0) ** 2 + b * b)
    l1, l2 = mid + rad, mid - rad
    angle = math.degrees(math.atan2(l1 - a, b)) if (b or l1 != a) else 0.0
    if angle > 90:
        angle -= 180
    elif angle <= -90:
        angle += 180
    return {'center_x': p.mx, 'center_y': p.my, 'angle': angle,
            'width': 2 * math.sqrt(max(l1, 0) * p.cutoff),
            'height': 2 * math.sqrt(max(l2, 0) * p.cutoff)}


def ellipse_expr(vx: Column, vy: Column, cxy: Column, cutoff: float) -> dict:
    """F5 as Spark expressions over an aggregate row (eigenvalues in closed form)."""
    mid = (vx + vy) / 2
    rad = F.sqrt(F.pow((vx - vy) / 2, 2) + cxy * cxy)
    l1, l2 = mid + rad, mid - rad
    raw = F.degrees(F.atan2(l1 - vx, cxy))
    angle = F.when(raw > 90, raw - 180).when(raw <= -90, raw + 180).otherwise(raw)
    return {'angle': angle, 'width': 2 * F.sqrt(F.greatest(l1, F.lit(0.0)) * cutoff),
            'height': 2 * F.sqrt(F.greatest(l2, F.lit(0.0)) * cutoff)}


# --- F6 review ------------------------------------------------------------------

def review(df: DataFrame, flag: str, cols, key: str) -> DataFrame:
    return df.filter(_q(flag)).select(key, *cols)


# --- F7 size rule -----------------------------------------------------------------

def resolve_size_outliers(df: DataFrame, col: str, text: str, key: str, by: str = 'split',
                          z: float = C.Z_THRESHOLD, zparams: ZParams = None):
    """for rows with |z| > z: Land Area figure if present; else a
    description figure that is ~10/100/1000× off (digit shift); no evidence →
    missing; otherwise the original is confirmed. Returns (df, log).

    zparams=None re-fits mean/std per `by` group (fit_scope='each', as the
    original code does); pass train parameters for fit_scope='train'."""
    if zparams is None:
        staged = zscore_by_group(df, col, by)
    else:
        staged = df.withColumn('__z', zscore_expr(col, zparams.mean[col], zparams.std[col]))
    flagged = F.coalesce(F.abs(F.col('__z')) > z, F.lit(False))
    staged = staged.withColumn('__ev', F.when(flagged, X.extract_size_source(_q(text))))  # of flagged rows alone
    orig, val, land = _q(col), F.col('__ev.value'), F.col('__ev.is_land')
    ratio = F.when(val != 0, orig / val)
    shift = F.lit(False)
    for f in C.DIGIT_SHIFT_FACTORS:
        shift = shift | (F.abs(ratio / f - 1) < C.DIGIT_SHIFT_TOLERANCE)
    shift = F.coalesce((ratio > 0) & shift, F.lit(False))
    reason = (F.when(val.isNull(), 'no_evidence').when(land, 'land_area')
              .when(shift, 'digit_shift').otherwise('confirmed'))
    new = (F.when(val.isNull(), F.lit(None).cast('double')).when(land | shift, F.bround(val, 0))
           .otherwise(orig))
    staged = staged.withColumn('__flag', flagged).withColumn('__reason', reason).withColumn('__new', new)
    log = staged.filter('__flag').select(
        _q(key).alias('key'), _q(by).alias(by) if by in df.columns else F.lit(None).alias(by),
        orig.cast('double').alias('original'), val.alias('evidence'), land.alias('is_land'),
        F.col('__new').alias('final'), F.col('__reason').alias('reason'))
    out = staged.withColumn(col, F.when(F.col('__flag'), F.col('__new')).otherwise(orig)) \
        .select(*df.columns)
    return out, log


# --- F8 bedroom rule ----------------------------------------------------------------

def resolve_room_outliers(df: DataFrame, col: str, text: str, key: str, limit: float = C.BEDROOM_LIMIT):
    """F8: rows with `col` ≥ limit take the strict-pattern count from the text
    when it differs; no match or same value → unchanged. Returns (df, log)."""
    flagged = F.coalesce(_q(col) >= limit, F.lit(False))
    ev = F.when(flagged, X.extract_bedrooms_strict(_q(text)))
    staged = df.withColumn('__ev', ev).withColumn('__flag', flagged)
    reason = (F.when(F.col('__ev').isNull(), 'no_evidence')
              .when(F.col('__ev') != _q(col), 'corrected').otherwise('confirmed'))
    new = F.when(F.col('__flag') & F.col('__ev').isNotNull() & (F.col('__ev') != _q(col)),
                 F.col('__ev')).otherwise(_q(col))
    log = staged.filter('__flag').select(_q(key).alias('key'), _q(col).alias('original'),
                                         F.col('__ev').alias('evidence'), new.alias('final'),
                                         reason.alias('reason'), *[c for c in ['split'] if c in df.columns])
    return staged.withColumn(col, new).select(*df.columns), log


# --- F9 ratio screen -------------------------------------------------------------

def ratio_screen(df: DataFrame, a: str, b: str, max_ratio: float, key: str) -> DataFrame:
    """rows whose a/b ratio exceeds a plausibility limit."""
    r = F.try_divide(_q(a), _q(b))
    return df.filter(r > max_ratio).select(key, a, b, r.alias('ratio'))
