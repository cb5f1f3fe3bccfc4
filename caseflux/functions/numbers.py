"""Ratios, lights, bands and coordinates (SC33-SC39)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def ratio(n: Column | str, d: Column | str, scale: float = 1.0) -> Column:
    """scale * n / d, NULL when the denominator is 0 or missing."""
    return F.lit(float(scale)) * as_col(n).cast("double") / F.nullif(as_col(d).cast("double"), F.lit(0.0))


def pct(n: Column | str, d: Column | str) -> Column:
    return ratio(n, d, 100.0)


def pct_change(now: Column | str, before: Column | str) -> Column:
    """Relative change in %; 0 when both are 0, NULL when only the earlier value is 0 or missing."""
    a, b = as_col(now).cast("double"), as_col(before).cast("double")
    return F.when((b == 0) & (a == 0), F.lit(0.0)).otherwise(100.0 * (a - b) / F.nullif(b, F.lit(0.0)))


def light_change(v: Column | str, tol: float = 5.0) -> Column:
    x = as_col(v)
    return (
        F.when(x.isNull(), "Cinza").when(x > tol, "Vermelho").when(x < -tol, "Verde").otherwise("Amarelo")
    )


def light_ref(v: Column | str, ref: Column | float, higher_better: bool = True, tol: float = 5.0) -> Column:
    x = as_col(v)
    r = ref if isinstance(ref, Column) else F.lit(ref)
    good, fair = (x >= r, x >= r - tol) if higher_better else (x <= r, x <= r + tol)
    return (
        F.when(x.isNull() | r.isNull(), "Cinza").when(good, "Verde").when(fair, "Amarelo").otherwise("Vermelho")
    )


def clip_null(c: Column | str, lo: float, hi: float) -> Column:
    x = as_col(c)
    return F.when(x.between(lo, hi), x)


def band(c: Column | str, cuts, labels, missing: str | None = None, inclusive: bool = False) -> Column:
    """labels[i] for the first cut above the value, the last label beyond all cuts."""
    x = as_col(c)
    out = F.when(x.isNull(), F.lit(missing))
    for cut, label in zip(cuts, labels):
        out = out.when((x <= cut) if inclusive else (x < cut), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def p_band(p: Column | str, alpha: float = 0.05) -> Column:
    return band(p, [alpha], ["significant", "not significant"], "not available")


def or_magnitude(v: Column | str) -> Column:
    x = as_col(v)
    return (
        F.when(x.isNull(), "not estimable")
        .when(x < 0.67, "strongly protective")
        .when(x < 0.90, "mildly protective")
        .when(x <= 1.10, "near null")
        .when(x <= 1.50, "moderate increase")
        .otherwise("strong increase")
    )


def or_reading(v: Column | str, lo: Column | str, hi: Column | str, p: Column | str) -> Column:
    x, a, b, q = as_col(v), as_col(lo), as_col(hi), as_col(p)
    return (
        F.when(x.isNull(), "no reading")
        .when((a <= 1) & (b >= 1), "interval crosses 1")
        .when(q >= 0.05, "not significant")
        .when(x > 1, "risk")
        .when(x < 1, "protection")
        .otherwise("neutral")
    )


def cramer_band(v: Column | str) -> Column:
    return band(v, [0.1, 0.3, 0.5], ["very small", "small", "moderate", "strong"])


def r_band(r: Column | str) -> Column:
    return band(F.abs(as_col(r)), [0.10, 0.30, 0.50], ["negligible", "weak", "moderate", "strong"], "undefined")


def fix_coord(c: Column | str, kind: str, box: tuple[float, float]) -> Column:
    """Degrees from a badly scaled value: the first of v, v/10 ... v/10^6 inside the box, else in range."""
    limit = 90.0 if kind == "lat" else 180.0
    text = F.regexp_replace(F.regexp_replace(as_col(c).cast("string"), ",", "."), " ", "")
    v = text.try_cast("double")
    steps = F.array(*[v / F.lit(float(10**k)) for k in range(7)])
    ok = F.filter(steps, lambda x: F.abs(x) <= limit)
    inside = F.filter(ok, lambda x: x.between(*box))
    return F.coalesce(F.get(inside, F.lit(0)), F.get(ok, F.lit(0)))


def haversine(lat1, lon1, lat2, lon2) -> Column:
    a1, o1, a2, o2 = (F.radians(x if isinstance(x, Column) else F.lit(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2 * 6371.0 * F.atan2(F.sqrt(h), F.sqrt(1 - h))
