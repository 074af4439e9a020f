"""p-values of t and F statistics as column expressions: the regularised incomplete
beta function by its continued fraction, worked in whole rows of an `aggregate` over a
sequence. No Python runs; inputs are columns of any numeric type.

The logarithm of the complete beta function comes from Stirling's series after both
arguments are raised by ten, in a form whose large terms don't cancel. The fraction
itself loses digits as degrees of freedom grow: results are good to 1e-9 of their value
up to a million degrees and to 1e-6 up to 1e9.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RAISE = 10
TINY = 1e-300


def _stirling(x: Column) -> Column:
    """lgamma(x) - ((x - 0.5) ln x - x + 0.5 ln 2 pi) for x >= 10: the series' first terms."""
    y = F.lit(1.0) / (x * x)
    terms = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]
    out = F.lit(terms[-1])
    for t in reversed(terms[:-1]):
        out = out * y + F.lit(t)
    return out / x


def log_beta(a: Column, b: Column) -> Column:
    """ln B(a, b) for positive a, b."""
    up_a, up_b = a + RAISE, b + RAISE
    low, high = F.least(up_a, up_b), F.greatest(up_a, up_b)
    whole = (F.lit(0.5 * math.log(2 * math.pi)) - 0.5 * F.log(high) + _stirling(low) + _stirling(high) - _stirling(low + high)
             + (low - 0.5) * F.log(low / (low + high)) - high * F.log1p(low / high))
    for i in range(RAISE):
        whole = whole + F.log1p(b / (a + i)) + F.log1p(up_a / (b + i))
    return whole


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of I_x(a, b) by Lentz's method, for x below its turning
    point. The number of steps follows the smaller argument; a step that changes
    nothing any more ends the work."""
    one, safe = F.lit(1.0), lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)
    d = one / safe(one - (a + b) * x / (a + 1))
    start = F.struct(one.alias('c'), d.alias('d'), d.alias('h'), F.lit(False).alias('end'))

    def step(s: Column, m: Column) -> Column:
        m = m.cast('double')
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d1, c1 = one / safe(one + even * s['d']), safe(one + even / s['c'])
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d2, c2 = one / safe(one + odd * d1), safe(one + odd / c1)
        h = s['h'] * d1 * c1 * d2 * c2
        return F.when(s['end'], s).otherwise(F.struct(c2.alias('c'), d2.alias('d'), h.alias('h'), (F.abs(d2 * c2 - 1) < 1e-15).alias('end')))

    steps = F.sequence(F.lit(1), (F.lit(200) + 5 * F.sqrt(F.least(a, b))).cast('int'))
    return F.aggregate(steps, start, step, lambda s: s['h'])


def _once(value: Column, of) -> Column:
    """``of(value)`` with ``value`` worked out one time, however often it is named."""
    return F.transform(F.array(value), of)[0]


def incomplete_beta(a: Column, b: Column, log_x: Column, log_y: Column) -> Column:
    """I_x(a, b), from ln x and ln y with y = 1 - x, each given without cancellation.
    Missing where an argument is missing or not positive."""
    def value(s: Column) -> Column:
        a, b, lx, ly, direct = s['a'], s['b'], s['lx'], s['ly'], s['direct']
        # the side of the turning point decides which of the two is worked out
        p, q = F.when(direct, a).otherwise(b), F.when(direct, b).otherwise(a)
        v = F.exp(F.when(direct, lx).otherwise(ly))
        body = _once(F.struct(p.alias('p'), q.alias('q'), v.alias('v')),
                     lambda r: F.exp(a * lx + b * ly - log_beta(a, b)) * _fraction(r['p'], r['q'], r['v']) / r['p'])
        inside = F.when(lx < -745, 0.0).when(ly < -745, 1.0).when(direct, body).otherwise(1 - body)
        return F.when((a > 0) & (b > 0) & lx.isNotNull() & ly.isNotNull(), inside)

    a, b = a.cast('double'), b.cast('double')
    return _once(F.struct(a.alias('a'), b.alias('b'), log_x.alias('lx'), log_y.alias('ly')), lambda s: _once(
        F.struct(s['a'].alias('a'), s['b'].alias('b'), s['lx'].alias('lx'), s['ly'].alias('ly'),
                 (F.exp(s['lx']) < (s['a'] + 1) / (s['a'] + s['b'] + 2)).alias('direct')), value))


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided p of a t statistic. Missing without degrees of freedom."""
    t, dof = t.cast('double'), dof.cast('double')
    ratio = F.try_divide(t * t, dof)
    return F.when(t.isNull() | F.isnan(t) | (dof <= 0), F.lit(None).cast('double')).when(t == 0, 1.0).otherwise(
        incomplete_beta(dof / 2, F.lit(0.5), -F.log1p(ratio), F.log(ratio) - F.log1p(ratio)))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    """Upper p of an F statistic. Missing without degrees of freedom or below 0."""
    f, d1, d2 = (c.cast('double') for c in (f, d1, d2))
    ratio = F.try_divide(d1 * f, d2)
    return F.when(f.isNull() | F.isnan(f) | (f < 0) | (d1 <= 0) | (d2 <= 0), F.lit(None).cast('double')).when(f == 0, 1.0).otherwise(
        incomplete_beta(d2 / 2, d1 / 2, -F.log1p(ratio), F.log(ratio) - F.log1p(ratio)))
