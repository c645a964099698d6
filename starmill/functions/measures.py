"""Sums and averages of a measure; fixed point, on request, makes them independent of the order of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted
from starmill.functions.schema_rules import field

# Decimal places of money, for callers that ask for fixed point.
MONEY_SCALE = 2


@dataclass(frozen=True)
class Measure:
    """A measure as the number that is added up, and how many of its units make one.

    Adding doubles gives another last digit for every partitioning or retried task. Whole units do
    not, and adding them costs no more than adding doubles. A total beyond the range of bigint
    raises, as ANSI arithmetic does.
    """

    amount: Column
    units: int

    def value(self, total: Column) -> Column:
        return total.cast("double") / F.lit(float(self.units))

    def mean(self, total: Column, n_values: Column) -> Column:
        """Average over the non-NULL values; NULL for a group without any."""
        return F.try_divide(self.value(total), n_values.cast("double"))


def measure_of(df: DataFrame, name: str, scale: int | None = None) -> Measure:
    """The measure in a column, whatever case its name is in; no value loses a digit.

    Decimals and integers add up as they are. So do doubles, NaN included, unless ``scale`` is
    given: then they are added as whole units of that many decimal places, and a value that has
    more of them (or is no finite number) raises.
    """
    found = field(df.schema, name)
    column = quoted(found.name)
    if isinstance(found.dataType, T.DecimalType):
        return Measure(column, 1)
    if isinstance(found.dataType, T.IntegralType):
        return Measure(column.cast("bigint"), 1)
    value = column.cast("double")
    if scale is None:
        return Measure(value, 1)
    units = 10**scale
    whole = F.rint(value * units)
    # Division is correctly rounded, so only the double next to that decimal comes back unchanged.
    misfit = F.raise_error(
        F.concat(F.lit(f"not a number of {scale} decimal places in {found.name}: "), column)
    )
    return Measure(
        F.when(value.isNull() | (whole / units == value), whole.cast("bigint")).otherwise(
            misfit.cast("bigint")
        ),
        units,
    )
