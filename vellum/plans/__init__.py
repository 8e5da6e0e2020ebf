"""Whole plans: steps put together, the folder run, the catalogue of queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def run_steps(source: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Each step over the result of the one before; nothing runs until an action asks."""
    return reduce(lambda df, step: df.transform(step), steps, source)
