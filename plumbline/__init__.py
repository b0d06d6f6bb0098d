"""Data-quality checks, profiling and anomaly detection as Spark DataFrame operators."""

from plumbline.config import Roles, Thresholds

__all__ = ["Roles", "Thresholds"]
