"""Column-expression helpers shared by the operators.

Everything here returns a ``Column`` built from Spark SQL built-ins, so it
stays inside whole-stage code generation. Scores that decide an order are
carried as fixed-point ``BIGINT`` so that sums do not depend on summation
order and agree exactly with a SQL engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that results depend on (must stay equal to the original
# pipeline's constants).
# Event type names and ids: clicks 0, carts 1, orders 2.
TYPE_NAMES = ["clicks", "carts", "orders"]
TYPE_IDS = {"clicks": 0, "carts": 1, "orders": 2}
# Type weights used by the cart co-visitation matrix and by history re-ranking.
TYPE_WEIGHTS = {0: 0.5, 1: 9.0, 2: 0.5}
# Recall weights per target type.
RECALL_WEIGHTS = {"clicks": 0.10, "carts": 0.30, "orders": 0.60}
# Score bonus per co-visitation occurrence in cart re-ranking.
COVISIT_BONUS = 0.03
# Position-weight exponents: 2^(a + (1-a) * i/(n-1)) - 1, a per target.
POSITION_WEIGHT_START = {"clicks": 0.1, "carts": 0.5}
# Window sizes of the co-visitation matrices in days, neighbours kept, and
# the number of most recent events per session used for pairs.
DAY_SECONDS = 86400
RECENT_EVENTS = 30
# ---------------------------------------------------------------------------

# Fixed-point scales. Position weights are kept in micro-units; type weights
# in milli-units, so a history term is in 1e-9 units.
MICRO = 1_000_000
MILLI = 1_000


def type_name_to_id(col: Column | str) -> Column:
    """Encode ``clicks|carts|orders`` to 0/1/2; any other name raises."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, idx in TYPE_IDS.items():
        expr = F.when(c == name, F.lit(idx)) if expr is None else expr.when(c == name, F.lit(idx))
    return expr.otherwise(F.raise_error(F.concat(F.lit("unknown event type: "), c.cast("string")))).cast("int")


def type_id_to_name(col: Column | str) -> Column:
    """Decode 0/1/2 to the type name; any other id raises."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, idx in TYPE_IDS.items():
        expr = F.when(c == idx, F.lit(name)) if expr is None else expr.when(c == idx, F.lit(name))
    return expr.otherwise(F.raise_error(F.concat(F.lit("unknown event type id: "), c.cast("string"))))


def weight_map(col: Column | str, weights: Mapping[int, float], default: float | None = None) -> Column:
    """``CASE col WHEN k THEN w ... END`` over a small literal map."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, w in sorted(weights.items()):
        expr = F.when(c == k, F.lit(w)) if expr is None else expr.when(c == k, F.lit(w))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def milli_weight_map(col: Column | str, weights: Mapping[int, float]) -> Column:
    """Type weights as integer milli-units (``0.5 -> 500``)."""
    return weight_map(col, {k: int(round(w * MILLI)) for k, w in weights.items()}).cast("long")


def to_micro(x: Column) -> Column:
    """Round a double to integer micro-units."""
    return F.round(x * F.lit(float(MICRO))).cast("long")


def position_weight(i: Column, n: Column, start: float) -> Column:
    """Log-spaced weight of event ``i`` (0-based, time order) out of ``n``.

    ``2^(start + (1 - start) * i / (n - 1)) - 1``; a single event gets
    ``2^start - 1`` (the first point of the spacing).
    """
    frac = F.when(n <= 1, F.lit(0.0)).otherwise(i.cast("double") / (n - 1).cast("double"))
    return F.pow(F.lit(2.0), F.lit(start) + F.lit(1.0 - start) * frac) - F.lit(1.0)


def epoch_seconds(col: Column | str) -> Column:
    """Whole epoch seconds of a wall-clock timestamp (time-zone independent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_timestamp(c.cast("timestamp_ntz")).cast("long")


def hash_cutoff(session: Column, n: Column, seed: int = 42, mult: int = 7919) -> Column:
    """Deterministic cutoff in ``[1, n-1]`` from the session id (needs n >= 2)."""
    m = (n - 1).cast("long")  # the id is reduced first, so that large ids do not overflow
    return (F.lit(1) + F.pmod(F.pmod(session.cast("long"), m) * F.lit(mult) + F.lit(seed), m)).cast("long")


def hash_unit(key: Column, mult: int = 2654435761, seed: int = 42, modulus: int = 1_000_003) -> Column:
    """Arithmetic hash of an integer key mapped to ``[0, 1)``.

    A plain multiply-add-modulo so that a SQL engine can reproduce it; it is
    used for repeatable sampling decisions (no ``rand()``).
    """
    k = F.pmod(key.cast("long"), F.lit(modulus))
    return F.pmod(k * F.lit(mult) + F.lit(seed), F.lit(modulus)).cast("double") / F.lit(float(modulus))
