"""Randomness that depends on a seed and a row key only.

``rand()`` changes with the partitioning and with a task retry.  A hash of the
key does not, so a split, a fold or a bootstrap weight stays the same when an
executor is lost and its rows are computed again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 13 hex digits = 52 bits, what a double holds exactly


def seeded_hash(seed: int, *keys: Column | str) -> Column:
    """md5 of ``seed:key[:key...]`` as 32 hex digits; also the shuffling order."""
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash52(seed: int, *keys: Column | str) -> Column:
    """A whole number below 2**52 for each key."""
    return F.conv(F.substring(seeded_hash(seed, *keys), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def uniform(seed: int, *keys: Column | str) -> Column:
    """A uniform double in [0, 1) for each key."""
    return hash52(seed, *keys) / F.lit(float(2 ** (4 * _HEX_DIGITS)))


def uniform_below(seed: int, share: float, *keys: Column | str) -> Column:
    """``uniform(...) < share``, by comparing hex digits instead of parsing them."""
    if share >= 1.0:
        return F.lit(True)
    bound = f"{math.ceil(max(share, 0.0) * 2 ** (4 * _HEX_DIGITS)):0{_HEX_DIGITS}x}"
    return F.substring(seeded_hash(seed, *keys), 1, _HEX_DIGITS) < F.lit(bound)


def gaussian(seed: int, *keys: Column | str) -> Column:
    """A standard normal for each key (Box-Muller on two uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(seed, *keys)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(seed + 1, *keys))


def poisson_thresholds(mean: float = 1.0) -> list[float]:
    """The distribution function of a Poisson variable, until it reaches 1 in doubles."""
    cumulative, term, out, j = 0.0, math.exp(-mean), [], 0
    while cumulative + term > cumulative:
        cumulative += term
        out.append(cumulative)
        j += 1
        term *= mean / j
    return [c for c in out if c < 1.0]


def poisson_weight(seed: int, *keys: Column | str, mean: float = 1.0) -> Column:
    """How often a bootstrap sample of ``mean`` times the size draws this key (a Poisson variable)."""
    bounds = F.array(*[F.lit(t) for t in poisson_thresholds(mean)])
    # The one-element array binds the uniform to a variable, so that it is hashed once per row.
    counts = F.transform(
        F.array(uniform(seed, *keys)),
        lambda u: F.aggregate(bounds, F.lit(0).cast("bigint"), lambda n, t: n + (u >= t).cast("bigint")),
    )
    return counts[0]


def _col(key: Column | str) -> Column:
    return F.col(key) if isinstance(key, str) else key
