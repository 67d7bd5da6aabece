"""Thresholds and weights. Fixed values that decide results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SensorLimits:
    """Quality gate (open intervals) and the thresholds of the silver flags."""

    temperature_low: float = 0.0
    temperature_high: float = 200.0
    vibration_low: float = 0.0
    vibration_high: float = 500.0
    overheating_above: float = 95.0
    vibration_anomaly_above: float = 80.0
    fault_status: str = "FAULT"


@dataclass(frozen=True)
class RiskWeights:
    """Weight of each flag in the risk score, its ceiling and the alarm level."""

    fault: float = 0.4
    overheating: float = 0.3
    vibration: float = 0.3
    ceiling: float = 1.0
    high_risk_above: float = 0.30


@dataclass(frozen=True)
class DeliveryPolicy:
    """Publishing limits: rows per request, retries after the first send, pause."""

    batch_rows: int = 500
    max_retries: int = 4
    backoff_base_seconds: float = 0.1


LIMITS = SensorLimits()
WEIGHTS = RiskWeights()
DELIVERY = DeliveryPolicy()
