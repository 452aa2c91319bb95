"""The data model: a series is a DataFrame with an explicit order.

Every operator takes one or more :class:`Series`. Order is ``(ts, seq)``; ``seq``
is a unique number that settles equal timestamps. With ``by`` every key is a
stream of its own; without it the whole frame is one stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Series:
    """``(ts, seq, values...)`` plus optional key columns of a DataFrame."""

    df: DataFrame
    ts: str = "ts"
    seq: str = "seq"
    values: tuple[str, ...] = ("value",)
    by: tuple[str, ...] = ()
    #: Of a series without a key that was written in slices: (time as a number, seq) of the first row of each, and how many rows it has. They
    #: say where to cut; results do not depend on them.
    bounds: tuple[tuple[tuple, int], ...] | None = field(default=None, compare=False)

    def __post_init__(self):
        for name in ("values", "by"):
            given = getattr(self, name)
            object.__setattr__(self, name, (given,) if isinstance(given, str) else tuple(given))

    @property
    def value(self) -> str:
        return self.values[0]

    @property
    def columns(self) -> list[str]:
        return [*self.by, self.ts, self.seq, *self.values]

    @property
    def order(self) -> list[str]:
        return [self.ts, self.seq]

    def rows(self) -> DataFrame:
        """Only the columns that belong to the series."""
        return self.df.select(*self.columns)

    def timed(self) -> DataFrame:
        """The rows that windows and joins work on: those with a time."""
        return self.rows().where(F.col(self.ts).isNotNull())

    def with_df(self, df: DataFrame) -> Series:
        """The same columns of another frame, which may be cut elsewhere."""
        return replace(self, df=df, bounds=None)

    def where(self, condition: Column) -> Series:
        """Some of the rows; where to cut stays."""
        return replace(self, df=self.df.where(condition))

    def ticks(self) -> Column:
        return ticks(self.df, self.ts)


def ticks(df: DataFrame, name: str) -> Column:
    """Time as a number: whole microseconds, or the clock itself if it is numeric.

    Distances between timestamps are taken on these, so equal distances stay equal.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long") * 86_400_000_000
    return F.col(name)


def mean(total: Column, count: Column) -> Column:
    """``total / count`` as a double; exact up to the division when total is a decimal."""
    return total.cast("double") / count
