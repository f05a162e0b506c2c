"""Derived features that depend on one another."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.upkeep import backfill
from tidemark.sinks.days import DayTable

Days = tuple[date, date]


@dataclass(frozen=True)
class Step:
    """How a feature is derived: from which features, and from how many earlier days of them."""

    output: str
    inputs: tuple[str, ...]
    derive: Callable[[DataFrame], DataFrame]
    look_back: int = 0


def layers(steps: list[Step]) -> list[list[Step]]:
    """Steps in layers, each of which needs only the layers before it and raw features; a cycle is refused."""
    names = [step.output for step in steps]
    if len(set(names)) < len(names):
        raise ValueError("a feature is derived twice")
    waiting, found = list(steps), []
    while waiting:
        open_names = {step.output for step in waiting}
        ready = [step for step in waiting if not open_names & set(step.inputs)]
        if not ready:
            raise ValueError(f"features depend on one another in a cycle: {', '.join(sorted(open_names))}")
        found.append(ready)
        waiting = [step for step in waiting if step not in ready]
    return found


def touched(steps: list[Step], changed: dict[str, Days]) -> dict[str, Days]:
    """The days, first to before last, of every derived feature that changed days of other features reach.

    A step that looks back n days is reached up to n days after a change. Features that nothing reaches are left out.
    """
    reached = dict(changed)
    for layer in layers(steps):
        for step in layer:
            ranges = [reached[name] for name in step.inputs if name in reached]
            if ranges:
                until = max(end for _, end in ranges) + timedelta(days=step.look_back)
                first = min(start for start, _ in ranges)
                if step.output in reached:
                    first, until = min(first, reached[step.output][0]), max(until, reached[step.output][1])
                reached[step.output] = (first, until)
    return {step.output: reached[step.output] for step in steps if step.output in reached}


def recompute(log: DataFrame, steps: list[Step], table: DayTable, changed: dict[str, Days]) -> list[str]:
    """Derive anew what lies downstream of the changed features and days, layer after layer.

    ``log`` holds the raw features, ``table`` the derived ones; both have the same columns. Each feature's days are
    replaced in one step. Returns the features that were derived, in their order.
    """
    days, done = touched(steps, changed), []
    derived = {step.output for step in steps}
    for layer in layers(steps):
        for step in layer:
            if step.output not in days:
                continue
            first, until = days[step.output]
            inputs = log.filter(F.col("feature_name").isin(*step.inputs))
            own = [name for name in step.inputs if name in derived]
            if own:
                held = table.read().filter(F.col("feature_name").isin(*own)).select(*log.columns)
                inputs = inputs.unionByName(held)
            back = F.make_dt_interval(F.lit(step.look_back))
            backfill(inputs, first, until, step.derive, table, back, [step.output])
            done.append(step.output)
    return done
