"""Severity, anomaly and rounding expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions.text import strip


def _literal(value: Any) -> Column:
    return F.array(*map(F.lit, value)) if isinstance(value, (list, tuple)) else F.lit(value)


def lookup(key: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Value of ``key`` in a small literal mapping, else ``default``.

    The mapping becomes a literal of the plan: no join, no shuffle.
    """
    table = F.create_map(*chain.from_iterable((F.lit(k), _literal(v)) for k, v in mapping.items()))
    found = F.try_element_at(table, key)
    return found if default is None else F.coalesce(found, _literal(default))


def severity_weight(
    violation_type: Column,
    weights: Mapping[str, int] = C.SEVERITY_WEIGHTS,
    default: int = C.DEFAULT_SEVERITY,
) -> Column:
    """Severity points of a violation type; unknown and null types get ``default``."""
    return lookup(strip(violation_type), weights, default)


def round_half_even(value: Column, digits: int) -> Column:
    """Round as ``rint(value * 10^digits) / 10^digits``; never returns negative zero."""
    scale = float(10**digits)
    return F.rint(value * scale) / F.lit(scale) + F.lit(0.0)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 when the whole is zero or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def anomaly_level(
    z: Column,
    critical: float = C.CRITICAL_Z,
    elevated: float = C.ELEVATED_Z,
    low: float = C.LOW_Z,
) -> Column:
    """Class of a rounded z-score."""
    return (
        F.when(z >= critical, C.CRITICAL)
        .when(z >= elevated, C.ELEVATED)
        .when(z <= low, C.LOW)
        .otherwise(C.NORMAL)
    )


def is_anomaly(z: Column, threshold: float = C.ELEVATED_Z) -> Column:
    """Whether a rounded z-score lies outside the normal band."""
    return F.abs(z) >= threshold


def patrol_action(level: Column) -> Column:
    """Recommended action of an anomaly class."""
    return lookup(level, C.PATROL_ACTIONS, C.DEFAULT_ACTION)


def density_share(count: Column) -> Column:
    """Width of the density bar in percent: 15 per incident, at most 100."""
    return F.least(F.lit(100).cast("bigint"), F.least(count, F.lit(7)) * 15)
