"""Scalar building blocks. Columns stay JVM expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation of the normal quantile, algorithm AS 241
# (Wichura 1988), numerator and denominator by rising power, relative error 1e-16.
_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3),
)
_SHOULDER = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9),
)
_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15),
)

# Rational approximation of erf / erfc (Cody 1969), by falling power.
_ERF_NEAR = (
    (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2,
     3.77485237685302021e2, 3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3,
     2.84423683343917062e3),
)
_ERFC_MID = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0,
     6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2,
     1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2,
     1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3,
     3.43936767414372164e3, 1.23033935480374942e3),
)


def clean(c: Column) -> Column:
    """NaN becomes NULL, so that aggregates skip it."""
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    """As double; NaN and infinite values become NULL (NaN sorts above infinity)."""
    value = c.cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ratio(a: Column, b: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def _rising(coefficients, x):
    """Polynomial by rising power; ``x`` is a Column or an array."""
    out = coefficients[-1]
    for k in reversed(coefficients[:-1]):
        out = out * x + k
    return out


def _falling(coefficients, x):
    return _rising(coefficients[::-1], x)


def _fraction(parts, x, polynomial=_rising):
    return polynomial(parts[0], x) / polynomial(parts[1], x)


def erfinv(x: Column) -> Column:
    """Inverse error function on (-1, 1), through the normal quantile at (1 + x) / 2.

    ``x`` occurs many times in the result, so it should be a plain column.
    """
    q = x / 2
    r = F.sqrt(-F.log(F.lit(0.5) - F.abs(q)))
    centre = q * _fraction(_CENTRE, F.lit(0.180625) - q * q)
    outer = F.when(r <= 5, _fraction(_SHOULDER, r - 1.6)).otherwise(_fraction(_TAIL, r - 5))
    z = F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * outer)
    return F.when(F.abs(x) < 1, z / F.sqrt(F.lit(2.0)))


def erf(x: Column) -> Column:
    """Error function, absolute error below 1e-14; beyond |x| = 6 it is +-1 in double precision."""
    a = F.abs(x)
    near = x * _fraction(_ERF_NEAR, x * x, _falling)
    mid = F.signum(x) * (1 - F.exp(-(x * x)) * _fraction(_ERFC_MID, a, _falling))
    return F.when(a <= 0.46875, near).when(a <= 6, mid).otherwise(F.signum(x))


def erfinv_array(x: np.ndarray) -> np.ndarray:
    """``erfinv`` for Arrow batches."""
    with np.errstate(all="ignore"):
        q = x / 2
        r = np.sqrt(-np.log(0.5 - np.abs(q)))
        centre = q * _fraction(_CENTRE, 0.180625 - q * q)
        outer = np.where(r <= 5, _fraction(_SHOULDER, r - 1.6), _fraction(_TAIL, r - 5))
        z = np.where(np.abs(q) <= 0.425, centre, np.sign(q) * outer)
        return np.where(np.abs(x) < 1, z / np.sqrt(2.0), np.nan)


def erf_array(x: np.ndarray) -> np.ndarray:
    """``erf`` for Arrow batches."""
    with np.errstate(all="ignore"):
        a = np.abs(x)
        near = x * _fraction(_ERF_NEAR, x * x, _falling)
        mid = np.sign(x) * (1 - np.exp(-(x * x)) * _fraction(_ERFC_MID, a, _falling))
        return np.where(a <= 0.46875, near, np.where(a <= 6, mid, np.sign(x)))
