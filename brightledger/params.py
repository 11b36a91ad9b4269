"""Run parameters shared by every plan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from brightledger.functions.dates import moment


@dataclass(frozen=True)
class RunParams:
    """``as_of`` stands for "today": ages, tenures and trailing windows hang on it."""

    as_of: dt.date = dt.date(2024, 2, 1)

    @property
    def now(self) -> str:
        """Midnight of ``as_of`` as expression text."""
        return moment(self.as_of)

    @property
    def today(self) -> Column:
        return F.lit(self.as_of)

    @property
    def stamp(self) -> Column:
        """Load stamp: midnight of ``as_of``, so that a rerun gives the same rows."""
        return F.expr(self.now)

    def days_ago(self, days: int) -> str:
        return moment(self.as_of - dt.timedelta(days=days))
