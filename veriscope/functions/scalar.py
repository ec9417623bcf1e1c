"""Scalar functions of the models."""

from __future__ import annotations

from collections.abc import Sequence

from ..schemas import COMPASS, LEAD_HALF_WIDTH, LEAD_HOURS
from .clock import seconds_between

# Fixed value: text which stands for NULL inside a surrogate key.
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def exact(x: str) -> str:
    """A double as a decimal on which rounding is well defined; NULL if it is too large for one."""
    return f"try_cast({x} AS decimal(38, 12))"


def pg_round(x: str, digits: int) -> str:
    """Round half away from zero on the decimal value, back as a double.

    A double too large for the decimal has no digits behind the point, so it stays as it is; so do
    infinity and NaN.
    """
    return f"coalesce(cast(round({exact(x)}, {digits}) AS double), cast({x} AS double))"


def number_or_null(text: str) -> str:
    """The number a text spells, else NULL; a letter behind it, as in ``12d``, makes it no number."""
    spelled = f"rlike(trim({text}), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?(nan|inf|infinity)$')"
    return f"CASE WHEN {spelled} THEN try_cast({text} AS double) END"


def ms_to_kph(x: str) -> str:
    return f"({x} * 3.6D)"


def kph_to_ms(x: str) -> str:
    return f"({x} / 3.6D)"


def m_to_km(x: str) -> str:
    return f"({x} / 1000.0D)"


def c_to_f(x: str) -> str:
    return pg_round(f"{x} * 9.0D / 5.0D + 32", 1)


def wind_cardinal(degrees: str) -> str:
    """Compass point of a wind direction; NULL and impossible angles are 'Unknown'."""
    whens = " ".join(f"WHEN {degrees} BETWEEN {low}D AND {high}D THEN '{name}'" for low, high, name in COMPASS)
    return f"CASE {whens} ELSE 'Unknown' END"


def lead_hours(forecast_time: str, created_at: str) -> str:
    """Hours from creation to the forecast time, not below 0; an unknown gap counts as 0."""
    return f"greatest(0.0D, cast({seconds_between(created_at, forecast_time)} AS double) / 3600.0D)"


def bucket_horizon(
    hours: str, centers: Sequence[int] = tuple(LEAD_HOURS), half_width: float = LEAD_HALF_WIDTH
) -> str:
    """The lead time within ``half_width`` hours, both ends included, else NULL."""
    whens = " ".join(f"WHEN {hours} BETWEEN {c - half_width}D AND {c + half_width}D THEN {c}" for c in centers)
    return f"CASE {whens} END"


def surrogate_key(*columns: str) -> str:
    """md5 over the text of all columns joined with '-', NULL written as a fixed text."""
    parts = ", ".join(f"coalesce(cast({c} AS string), '{KEY_NULL}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def ratio(numerator: str, denominator: str) -> str:
    """A quotient that is NULL over zero."""
    return f"(cast({numerator} AS double) / nullif(cast({denominator} AS double), 0))"


def at_path(root: str, path: str) -> str:
    """The field at an ``a.b`` / ``a[0].b`` path of a parsed struct; missing steps give NULL."""
    node = root
    for step in path.split("."):
        node = f"get({node}.{step[:-3]}, 0)" if step.endswith("[0]") else f"{node}.{step}"
    return node
