"""Threshold classes: a value's class is the highest step it reaches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dashboards' steps, (lower bound, class).
RADIATION_BASE = "dark-green"
RADIATION_STEPS = (
    (5, "green"),
    (10, "super-light-green"),
    (15, "yellow"),
    (20, "orange"),
    (40, "super-light-red"),
    (60, "dark-red"),
)
AIR_BASE = "super-light-green"
AIR_STEPS = (
    (1, "light-yellow"),
    (4, "light-blue"),
    (10, "light-orange"),
    (20, "super-light-red"),
)
CELL_BASE = "green"
CELL_STEPS = ((80, "red"),)
LATENCY_BASE = "Excellent"
LATENCY_STEPS = ((100, "Good"), (500, "Moderate"))
LATENCY_POOR = (2000, "Poor")


def step_class(value: Column, base: str, steps: Sequence[tuple[float, str]]) -> Column:
    ladder = None
    for bound, name in reversed(steps):
        reached = value >= F.lit(bound)
        ladder = F.when(reached, name) if ladder is None else ladder.when(reached, name)
    return F.lit(base) if ladder is None else ladder.otherwise(base)


def classify_radiation(cpm: Column) -> Column:
    return step_class(cpm, RADIATION_BASE, RADIATION_STEPS)


def classify_air(pm25: Column) -> Column:
    return step_class(pm25, AIR_BASE, AIR_STEPS)


def classify_cell(value: Column) -> Column:
    return step_class(value, CELL_BASE, CELL_STEPS)


def classify_latency(millis: Column) -> Column:
    """Rating of a query time; the last band starts above its bound."""
    bound, name = LATENCY_POOR
    return F.when(millis > bound, name).otherwise(step_class(millis, LATENCY_BASE, LATENCY_STEPS))
