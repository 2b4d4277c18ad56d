"""Counts taken while a frame is written (V3, V6, V7, V9, P16, L5): no scan of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Watch:
    """Aggregates over the rows that pass one point of a plan.

    Put :meth:`on` between the source and *one* action; :meth:`get` gives the values once that action
    has run. The aggregates must stand where no shuffle follows, or a stage that runs
    again counts twice: place them as close to the write as the counted values allow.
    """

    def __init__(self, *aggregates: Column):
        self._aggregates = aggregates
        self._observation = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *self._aggregates)

    def get(self) -> dict:
        return self._observation.get
