"""Thresholds and column roles that parameterise every operator.

``Thresholds`` says how strict a check is, ``Roles`` says which columns it applies to. Both are plain frozen
dataclasses: their values end up as literals in the query plan.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

# Result parity depends on these exact patterns, limits, weights and rule switches.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DEFAULT_MAX_NULL_RATE = 0.10
DEFAULT_WEIGHT = 0.2
RATE_PASS = 0.02
RATE_ZERO_SCORE = 0.05
ACCURACY_MAX_SHIFT = 0.10
ACCURACY_MIN_SCORE = 0.85
RECENT_DAYS = 30
RECENT_MIN_RATIO = 0.50
EPSILON = 1e-10

_NULL_RATES = {
    "customer_email": 0.15,
    "unit_price": 0.10,
    "shipping_city": 0.08,
    "customer_age": 0.05,
    "payment_method": 0.05,
}
_RANGES = {"quantity": (1.0, 10.0), "unit_price": (0.0, 500000.0), "customer_age": (0.0, 120.0)}
_QUALITY_WEIGHTS = {
    "completeness": 0.25,
    "uniqueness": 0.20,
    "validity": 0.25,
    "consistency": 0.15,
    "timeliness": 0.15,
}
ANOMALY_WEIGHTS = {
    "anomaly_iqr": 0.25,
    "anomaly_zscore": 0.25,
    "anomaly_drift": 0.25,
    "anomaly_iforest": 0.25,
}
_ALERT_RULES = {"critical_score": True, "any_failures": False, "drift_events": True, "daily_summary": True}


@dataclass(frozen=True)
class Thresholds:
    """Pass/fail limits of the quality checks, dimension weights and report severity."""

    # The default limits, and below the names of sections and keys of a threshold file.

    max_null_rate: Mapping[str, float] = field(default_factory=lambda: dict(_NULL_RATES))
    default_max_null_rate: float = DEFAULT_MAX_NULL_RATE
    min_completeness: float = 0.85
    max_duplicate_rate: float = 0.03
    min_uniqueness: float = 0.95
    min_format_rate: float = 0.90
    max_future_rate: float = 0.02
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=lambda: dict(_RANGES))
    min_validity: float = 0.85
    min_reference_rate: float = 0.98
    min_consistency: float = 0.90
    max_age_hours: float = 48.0
    min_timeliness: float = 0.90
    min_accuracy: float = ACCURACY_MIN_SCORE
    weights: Mapping[str, float] = field(default_factory=lambda: dict(_QUALITY_WEIGHTS))
    critical: float = 0.50
    warning: float = 0.75

    @classmethod
    def from_mapping(cls, sections: Mapping) -> Thresholds:
        """Build from nested sections (completeness, uniqueness, …); missing keys keep the defaults."""
        completeness = dict(sections.get("completeness", {}))
        null_rates = dict(completeness.get("max_null_rate", {}))
        uniqueness = sections.get("uniqueness", {})
        validity = sections.get("validity", {})
        consistency = sections.get("consistency", {})
        timeliness = sections.get("timeliness", {})
        scoring = sections.get("scoring", {})
        severity = scoring.get("severity", {})
        given = {
            "default_max_null_rate": null_rates.pop("_default", None),
            "max_null_rate": null_rates,
            "min_completeness": completeness.get("min_completeness_score"),
            "max_duplicate_rate": uniqueness.get("max_duplicate_rate"),
            "min_uniqueness": uniqueness.get("min_uniqueness_score"),
            "min_format_rate": validity.get("email_validity_rate"),
            "max_future_rate": validity.get("future_date_rate"),
            "ranges": {c: (b.get("min"), b.get("max")) for c, b in validity.get("range_checks", {}).items()},
            "min_validity": validity.get("min_validity_score"),
            "min_reference_rate": consistency.get("referential_integrity_rate"),
            "min_consistency": consistency.get("min_consistency_score"),
            "max_age_hours": timeliness.get("max_data_freshness_hours"),
            "min_timeliness": timeliness.get("min_timeliness_score"),
            "weights": dict(scoring.get("dimension_weights", {})),
            "critical": severity.get("critical"),
            "warning": severity.get("warning"),
        }
        return cls(**{name: value for name, value in given.items() if value is not None})

    @classmethod
    def load(cls, path: str) -> Thresholds:
        """Read a local JSON (or, where PyYAML is installed, YAML) threshold file; a missing one gives the defaults."""
        if "://" in path:
            raise ValueError(f"thresholds are read from local files, not from {path!r}")
        file = Path(path)
        if not file.exists():
            return cls()
        if file.suffix.lower() == ".json":
            return cls.from_mapping(json.loads(file.read_text()))
        try:
            import yaml
        except ImportError as error:
            raise ImportError("YAML threshold files need PyYAML; use a .json file instead") from error
        return cls.from_mapping(yaml.safe_load(file.read_text()) or {})

    def with_(self, **changes) -> Thresholds:
        return dataclasses.replace(self, **changes)


@dataclass(frozen=True)
class Arithmetic:
    """``total`` should equal ``expression`` (SQL over ``inputs``) within a relative tolerance."""

    name: str
    total: str
    inputs: tuple[str, ...]
    expression: str
    tolerance: float = 0.005


@dataclass(frozen=True)
class Lookup:
    """``value`` is determined by ``key`` through a mapping frame with the columns ``key`` and ``value``."""

    name: str
    key: str
    value: str


@dataclass(frozen=True)
class Roles:
    """Which columns play which part. Columns a table lacks are skipped when the plan is built."""

    keys: tuple[str, ...] = ("order_id",)
    formats: Mapping[str, tuple[str, str]] = field(
        default_factory=lambda: {"customer_email": ("email_format", EMAIL_PATTERN)}
    )
    event_time: str = "order_date"
    time_formats: tuple[str, ...] = ()
    reference: tuple[str, str] = ("referential_integrity_customer", "customer_id")
    arithmetic: tuple[Arithmetic, ...] = (
        Arithmetic("amount_calculation", "total_amount", ("quantity", "unit_price"), "quantity * unit_price"),
    )
    lookup: Lookup = Lookup("city_state_mapping", "shipping_city", "shipping_state")
    snapshot: str = "day"
    drift_nulls: tuple[str, ...] = ("customer_email", "unit_price", "customer_age")
    sentinels: Mapping[str, float] = field(default_factory=lambda: {"quantity": 999, "unit_price": 999999})
    category: str = "product_category"
    amount: str = "total_amount"


def alert_rules(overrides: Mapping[str, bool] | str | None = None) -> dict[str, bool]:
    """Alert rule switches: defaults with the given ones on top, a mapping or the path of a JSON file.

    A file holds the switches, alone or under the key ``rules``, as true or false or as {"enabled": …}.
    """
    if isinstance(overrides, str):
        found = json.loads(Path(overrides).read_text())
        found = found.get("rules", found)
        overrides = {name: bool(v.get("enabled", True) if isinstance(v, Mapping) else v) for name, v in found.items()}
    unknown = set(overrides or {}) - set(_ALERT_RULES)
    if unknown:
        raise ValueError(f"unknown alert rules {sorted(unknown)}; known: {sorted(_ALERT_RULES)}")
    return {**_ALERT_RULES, **(overrides or {})}
