"""As-of parameters of an analysis run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AnalysisParams:
    """Everything is computed as of ``period_end``; values reach plans as literals,
    so date filters can be pushed to the scan."""

    period_start: datetime
    period_end: datetime
    dormancy_days: int = 90
    period_id: int = 1

    def __post_init__(self) -> None:
        if self.period_id != 1:
            raise ValueError("there is exactly one analysis period, period_id = 1")
        if self.period_end < self.period_start:
            raise ValueError("period_end lies before period_start")

    @property
    def end(self) -> Column:
        return timestamp(self.period_end)

    def end_minus(self, days: int) -> Column:
        return timestamp(self.period_end - timedelta(days=days))

    @property
    def first_month(self) -> date:
        return self.period_start.date().replace(day=1)

    def as_view(self, spark: SparkSession) -> DataFrame:
        """The one-row parameter table, for ad-hoc SQL."""
        return spark.range(1).select(
            F.lit(self.period_id).alias("period_id"),
            timestamp(self.period_start).alias("period_start"),
            self.end.alias("period_end"),
            F.lit(self.dormancy_days).alias("dormancy_days"),
        )


def timestamp(moment: datetime) -> Column:
    """Zone-less timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
