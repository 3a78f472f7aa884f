"""Row numbers, running sums and maxima in sequence order, without one task per shard.

A window over a whole shard runs in one task, so one shard with a third of the log stops the job.
Where a shard is too large for that, it is cut at prefixes of the sequence number. A prefix never goes
down when the string goes up, so the sum before a row is the sum of the buckets before its bucket plus
the sum before it inside its bucket. The first part needs one row per bucket; those rows are summed in
the same way, which cuts them again if there are too many of them.

Buckets are counted, and those that are still too large are cut further. Where prefixes do not cut well, as with
numbers of which nearly each has a prefix of its own, rows are cut at measured values instead: they are
dealt out by range, sorted and written, and every partition is cut into buckets by the places of its rows. There are as
many ranges as tasks need, however small the buckets are. Only rows that are equal in order and ties stay in one range,
and within a shard there should be none.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardstream.operators.shards import join_small
from shardstream.session import settle, store

# Rows that one task may number in one go.
WINDOW_ROWS = 200_000

# How many times more buckets one more character is taken to give: for digits, and for other text.
DIGITS = 10
TEXT = 16

# Measured ranges are made for this part of the rows that a task may number, as samples place them roughly; and
# for no fewer rows than this, so that there are always far fewer ranges, and buckets of them, than rows.
RANGE_SHARE = 3
LEAST_RANGE = 4

# ``monotonically_increasing_id`` has the place of a row in its partition in this many bits.
PLACE_BITS = 33

SUM = "sum"
MAX = "max"


@dataclass(frozen=True)
class Scan:
    """A value and how it is put together over rows: any operation that may be grouped freely."""

    value: Column
    op: str = SUM

    def total(self) -> Column:
        return (F.sum if self.op == SUM else F.max)(self.value)

    def over(self, window) -> Column:
        """Over no rows a sum is 0 and a maximum null."""
        return F.coalesce(F.sum(self.value).over(window), F.lit(0)) if self.op == SUM else F.max(self.value).over(window)

    def joined(self, before: Column, after: Column) -> Column:
        return before + after if self.op == SUM else F.greatest(before, after)


def _scans(sums: Mapping[str, Column | Scan]) -> dict[str, Scan]:
    return {name: value if isinstance(value, Scan) else Scan(value) for name, value in sums.items()}


def sums_before(
    rows: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Mapping[str, Column | Scan],
    ties: Sequence[str] = (),
    window_rows: int | None = None,
) -> DataFrame:
    """``rows`` with, per name in ``sums``, the sum over the rows before it in ``order`` within ``by``; the largest value
    of these for a ``Scan`` of maxima, null if there are none.

    Rows equal in ``order`` come in the order of ``ties``. Columns in ``by`` must not be null. Counts
    the rows first, so it is for tables and micro-batches, not for a stream as such. ``window_rows`` is the
    most rows that one task numbers in one go (default: ``WINDOW_ROWS``); results do not depend on it.
    """
    return _sums_before(rows, by, order, _scans(sums), ties, math.inf, window_rows or WINDOW_ROWS)


def _sums_before(
    rows: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Mapping[str, Scan],
    ties: Sequence[str],
    former: float,
    limit: int,
) -> DataFrame:
    """As above, where cutting brought the largest group down from ``former`` rows."""
    value = F.col(order)
    groups = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.max(F.length(value)).alias("width")
    )
    largest, low, high, width, n = groups.agg(
        F.coalesce(F.max("n"), F.lit(0)), F.min("low"), F.max("high"), F.max("width"), F.sum("n")
    ).first()
    if largest <= limit or largest < 2 * LEAST_RANGE:
        return _window_sums(rows, by, [order, *ties], sums)

    bucket = f"_{order.removeprefix('_')}_bucket"
    keys = [*by, bucket]
    length = _first_prefix(low, high, width, largest, limit) if largest < former / 2 else 0
    if length:
        bucketed, totals = _cut(rows, by, order, bucket, length, sums, limit)
    else:
        bucketed, totals = _range(rows, by, [order, *ties], bucket, sums, limit, n)
    carried = {f"_start_{name}": Scan(F.col(f"_total_{name}"), scan.op) for name, scan in sums.items()}
    starts = _sums_before(totals, by, bucket, carried, (), largest, limit)
    starts = starts.select(*keys, F.lit(True).alias("_known"), *carried)
    # The window comes first: its sort order already is what a sort-merge join with `starts` needs.
    inside = _window_sums(bucketed, keys, [order, *ties], sums).join(starts, keys, "left")
    placed = [scan.joined(_counted(f"_start_{name}", "_known"), F.col(name)).alias(name) for name, scan in sums.items()]
    return inside.select(*rows.columns, *placed)


def _counted(start: str, known: str | None = None) -> Column:
    """What comes before a row's bucket. A bucket that was not there when buckets were counted stops the job."""
    changed = F.raise_error(F.lit("the rows changed while they were numbered: read them from something that stays the same"))
    return F.when(F.col(known or start).isNull(), changed).otherwise(F.col(start))


def _range(
    rows: DataFrame, by: Sequence[str], order: list[str], bucket: str, sums: Mapping[str, Scan], limit: int, n: int
) -> tuple[DataFrame, DataFrame]:
    """Rows dealt out by range, sorted and written, with the bucket of their place, and the totals of every bucket.

    The buckets of a partition hold ``limit`` rows each (``LEAST_RANGE`` at least), and are in the order of the rows. A
    range is for a task, not for a bucket: a small ``limit`` does not make more ranges than ``WINDOW_ROWS`` asks for. Where
    a sample has placed the ranges badly there are more the next time, until no partition is too large or more do not help.
    """
    keys = [*by, bucket]
    task, size = max(limit, WINDOW_ROWS), max(limit, LEAST_RANGE)
    parts = max(2, min(math.ceil(RANGE_SHARE * n / task), n // LEAST_RANGE))
    former = math.inf
    while True:
        ranged = rows.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
        placed = store(ranged.withColumn(bucket, F.monotonically_increasing_id()), "ranges")
        part, place = F.shiftright(bucket, PLACE_BITS), F.col(bucket).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        largest = placed.agg(F.max(place)).first()[0] + 1
        if largest <= task or largest >= former or parts >= n // LEAST_RANGE:
            break
        former, parts = largest, min(2 * parts, n // LEAST_RANGE)
    chunk = F.floor(place / F.lit(size)).cast("bigint")
    digits = [F.lpad(x.cast("string"), len(str(most)), "0") for x, most in ((part, parts), (chunk, largest // size))]
    bucketed = placed.withColumn(bucket, F.concat(*digits))
    return bucketed, settle(_totals(bucketed, keys, sums))


def _totals(bucketed: DataFrame, keys: Sequence[str], sums: Mapping[str, Scan]) -> DataFrame:
    totals = [scan.total().alias(f"_total_{name}") for name, scan in _scans(sums).items()]
    return bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *totals)


def _first_prefix(low: str | None, high: str | None, width: int | None, largest: int, limit: int) -> int:
    """A prefix length that cuts numbers without large gaps into buckets that are small enough.

    Leaves a character off; 0 if there is none to leave.
    """
    if width is None or width < 2:
        return 0
    base = DIGITS if low.isdigit() and high.isdigit() else TEXT
    more = math.ceil(math.log(largest / limit, base))
    return min(len(commonprefix([low, high])) + more, width - 1)


def _cut(
    rows: DataFrame, by: Sequence[str], order: str, bucket: str, length: int, sums: Mapping[str, Scan], limit: int
) -> tuple[DataFrame, DataFrame]:
    """Rows with their bucket, and the totals of every bucket.

    A bucket that is still too large is cut again, further to the right of what its own strings share.
    Only strings that are all equal stay together.
    """
    keys = [*by, bucket]
    value = F.coalesce(F.col(order), F.lit(""))
    bucketed = rows.withColumn(bucket, F.substring(value, 1, length))
    while True:
        totals = settle(_totals(bucketed, keys, sums))
        large = totals.where(F.col("_rows") > limit).select(*keys, "_rows")
        if large.isEmpty():
            return bucketed, totals
        inside = join_small(bucketed.select(*keys, order), large, keys, "inner", salt_by=order, settled=True, sizes=large)
        ends = inside.groupBy(*keys, "_rows").agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        more = F.ceil(F.log(float(TEXT), F.col("_rows") / F.lit(limit)))
        next_length = (_shared(F.col("_low"), F.col("_high")) + more).cast("int").alias("_next")
        deeper = settle(ends.where(F.col("_low") < F.col("_high")).select(*keys, next_length))
        if deeper.isEmpty():
            return bucketed, totals
        bucketed = join_small(bucketed, deeper, keys, salt_by=order, settled=True, sizes=large)
        cut = F.when(F.col("_next").isNull(), F.col(bucket)).otherwise(F.substring(value, F.lit(1), F.col("_next")))
        bucketed = bucketed.withColumn(bucket, cut).drop("_next")


def _shared(low: Column, high: Column) -> Column:
    """Number of characters two strings have in common from the left."""
    lengths = F.sequence(F.lit(0), F.least(F.length(low), F.length(high)))
    return F.array_max(F.filter(lengths, lambda n: F.substring(low, F.lit(1), n) == F.substring(high, F.lit(1), n)))


def _window_sums(rows: DataFrame, keys: Sequence[str], order: list[str], sums: Mapping[str, Scan]) -> DataFrame:
    groups = Window.partitionBy(*(keys or [F.lit(0)]))
    before = groups.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({name: scan.over(before) for name, scan in sums.items()})


def with_position(
    rows: DataFrame,
    by: Sequence[str] = ("shard_id",),
    order: str = "sequence_number",
    also: Mapping[str, Column] | None = None,
    into: str = "position",
    ties: Sequence[str] = (),
    window_rows: int | None = None,
) -> DataFrame:
    """``rows`` with their 0-based position in ``order`` within ``by``, and further running sums.

    ``order`` is compared as a string, so unpadded numbers come as 0, 1, 10, 100.
    """
    return sums_before(rows, by, order, {into: F.lit(1).cast("bigint"), **(also or {})}, ties, window_rows)


def rank_by_sequence(
    records: DataFrame, order: str = "sequence_number", into: str = "sequence_rank", window_rows: int | None = None
) -> DataFrame:
    """The place of every record in the string order of all sequence numbers, from 1.

    Records of different shards may carry the same number; they come in the order of their shards.
    """
    ties = [c for c in ("shard_id",) if c in records.columns]
    ranked = with_position(records, (), order, into=into, ties=ties, window_rows=window_rows)
    return ranked.withColumn(into, F.col(into) + 1)
