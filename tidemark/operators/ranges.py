"""Ranges of time with about as many rows each: what a dense hour holds is dealt over many tasks, a quiet week over one."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges for each parallel task, so that they even out.
PER_TASK = 4
MOST = 1 << 14


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


@dataclass(frozen=True)
class TimeRanges:
    """Bounds in microseconds, ascending; k bounds make the ranges 0 to k. A time that many rows have is a bound several times."""

    bounds: tuple[int, ...] = ()

    @classmethod
    def of(cls, *frames: DataFrame, time: str = "event_timestamp_utc", ranges: int | None = None) -> TimeRanges:
        """Ranges of the rows of all frames, from approximate quantiles: one scan of their times, one row to the driver.

        Where a bound lies bears on balance alone, never on results. Frames without times have one range.
        """
        spark = frames[0].sparkSession
        ranges = ranges or min(MOST, PER_TASK * parallelism(spark))
        times = reduce(DataFrame.union, [f.select(micros(F.col(time)).alias("us")) for f in frames])
        shares = [k / ranges for k in range(1, ranges)]
        found = times.agg(F.percentile_approx("us", shares, 10 * ranges)).first()[0] if shares else None
        return cls(tuple(sorted(found or ())))

    def _below(self, us: str, less: str) -> str:
        """SQL of how many bounds are less than us (< or <=), by halving; 0 for a null."""
        bounds = f"CAST(split('{','.join(map(str, self.bounds))}', ',') AS ARRAY<BIGINT>)"
        widths = ", ".join(str(1 << k) for k in range(len(self.bounds).bit_length() - 1, -1, -1))
        return f"aggregate(array({widths}), 0, (at, width) -> IF(get({bounds}, at + width - 1) {less} {us}, at + width, at))" if self.bounds else "0"

    def of_time(self, us: str) -> Column:
        """The range of a time, a column's name: of several that it could lie in the first."""
        return F.expr(self._below(us, "<"))

    def dealt(self, us: str, key: list[str]) -> Column:
        """A range in which a row of this time may lie: the hash of its key picks one where there are several; any for a null time."""
        first, h = self._below(us, "<"), f"xxhash64({', '.join(key)})"
        return F.expr(f"CAST(IF({us} IS NULL, pmod({h}, {self.count}), {first} + pmod({h}, {self._below(us, '<=')} - {first} + 1)) AS INT)")

    @property
    def count(self) -> int:
        return len(self.bounds) + 1


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
