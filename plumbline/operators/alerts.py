"""Alert rules over a report and its drift events. Delivery is left to the caller."""

from __future__ import annotations

from collections.abc import Mapping

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import Thresholds, alert_rules
from plumbline.functions import sqltext as sql

# One alert; a field that does not apply to its type is null.
_FIELDS = {
    "metric": sql.string(None),
    "event_count": "CAST(NULL AS BIGINT)",
    "overall_score": sql.double(None),
}


def _alert(kind: str, **values: str) -> dict[str, str]:
    return {"type": sql.string(kind), **_FIELDS, **values}


def _columns(alert: dict[str, str]) -> list[str]:
    return [sql.alias(expression, name) for name, expression in alert.items()]


def alerts(
    report: DataFrame,
    drift_events: DataFrame | None = None,
    rules: Mapping[str, bool] | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Alerts that fire: (type, metric, event_count, overall_score).

    ``daily_summary`` fires only when nothing else does. All inputs are report-sized.
    """
    active = alert_rules(rules)
    low, failed = f"overall_score < {sql.double(limits.critical)}", "num_failed > 0"
    on_report = []
    if active["critical_score"]:
        on_report.append((low, _alert("critical_score", overall_score="overall_score")))
    if active["any_failures"]:
        on_report.append((failed, _alert("any_failures", event_count="num_failed")))
    found = []
    if on_report:
        # All rules on the report are read off its one row, so that it is evaluated once.
        fired = [f"CASE WHEN {condition} THEN {sql.struct(alert)} END" for condition, alert in on_report]
        found.append(report.selectExpr(sql.inline_present(fired)))
    if active["drift_events"] and drift_events is not None:
        per_metric = drift_events.groupBy("metric").agg(F.expr("count(*) AS event_count"))
        found.append(per_metric.selectExpr(*_columns(_alert("drift_events", metric="metric", event_count="event_count"))))
    quiet = _alert("daily_summary")
    if not found:
        nothing = report.selectExpr(*_columns(quiet)).limit(1)
        return nothing if active["daily_summary"] else nothing.limit(0)
    fired = reduce(DataFrame.unionByName, found)
    if not active["daily_summary"]:
        return fired
    # Gathered into one array, as there are at most a few alerts per metric: this tells whether anything fired.
    gathered = fired.selectExpr("collect_list(struct(type, metric, event_count, overall_score)) AS fired")
    return gathered.selectExpr(f"inline(CASE WHEN size(fired) > 0 THEN fired ELSE array({sql.struct(quiet)}) END)")
