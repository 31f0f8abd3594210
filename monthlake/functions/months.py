"""Month arithmetic and the lake layout, as plain values and as columns."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True, order=True)
class Month:
    first: date

    @classmethod
    def of(cls, text: str) -> Month:
        if not re.fullmatch(r"\d{4}-\d{2}", text):
            raise ValueError(f"not a YYYY-MM month: {text!r}")
        return cls(date.fromisoformat(f"{text}-01"))

    def __str__(self) -> str:
        return f"{self.first:%Y-%m}"

    def plus(self, months: int) -> Month:
        years, month0 = divmod(self.first.year * 12 + self.first.month - 1 + months, 12)
        return Month(date(years, month0 + 1, 1))


def month_path(root: str, zone: str, month: Month) -> str:
    """Where one month of one zone lives; a pure function of the month."""
    return f"{root.rstrip('/')}/{zone}/year={month.first:%Y}/month={month.first:%m}"


def layout_columns(month: Column) -> dict[str, Column]:
    """The two directory columns of `month_path`, for partitionBy."""
    return {"year": F.date_format(month, "yyyy"), "month": F.date_format(month, "MM")}


def month_start(day: Column) -> Column:
    """First day of the month as DATE (date_trunc on a wall clock would give a TIMESTAMP)."""
    return F.trunc(day, "month")


def month_spine(bounds: DataFrame, first: str, last: str, name: str = "month_start") -> DataFrame:
    """Every month from first to last inclusive, per row of `bounds`.

    Bounds that run backwards are an error at run time, as a typo must not become an empty run.
    """
    backwards = F.col(last) < F.col(first)
    checked = F.when(
        backwards,
        F.raise_error(F.format_string("month range runs backwards: %s > %s", first, last)).cast(
            "date"
        ),
    ).otherwise(F.trunc(last, "month"))
    return bounds.select(
        F.explode(
            F.sequence(F.trunc(first, "month"), checked, F.expr("interval 1 month"))
        ).alias(name)
    )
