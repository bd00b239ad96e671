"""LAG over partitions of any size.

``lag(value) over (partition by entity order by at, value, ...)`` puts all rows of an entity
into one task; payments without a subscription form one such entity of most rows. The same
result is reached in four bounded steps:

1. equal rows are counted, map side first; a copy's predecessor is its equal, so only the
   first copy needs a look back;
2. rows go to their (entity, period). A row that stands for one in each of many months goes there
   once per period, not once per month, and is repeated behind the shuffle;
3. one row per (entity, period) holds the period's last value; a window over an entity's
   periods hands it to all rows of the next one;
4. a window per (entity, period) finds the predecessor inside the period.

A task then holds the rows of one entity and period, or the periods of one entity.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custarc.functions.temporal import add_months_ts, month_bit

# What rows are spread by; all are non-null, so windows and joins share one partitioning. The hash of the
# others comes first, as sorts then compare it before any text; its last bit says whether there is an entity.
SPREAD = ("_hash", "_entity", "_period")
_NO_PERIOD = 2**31 - 1


# The period of a moment; the second argument says whether the row has an entity.
PeriodOf = Callable[[Column, Column], Column]


class YearOr:
    """The year for rows with an entity, the number that ``short`` gives a moment for the others. The years
    that months reach follow from numbers, so no moment is worked out for every month of a row."""

    def __init__(self, short: Callable[[Column], Column]):
        self._short = short

    def __call__(self, at: Column, known: Column) -> Column:
        return F.when(known, F.year(at)).otherwise(self._short(at))


def day_number(at: str | Column) -> Column:
    return F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date"))


def hour_number(at: str | Column) -> Column:
    return day_number(at) * 24 + F.hour(at)


def month_number(at: str | Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def _by_entity(df: DataFrame, entity: str) -> DataFrame:
    known = F.col(entity).isNotNull()
    return df.withColumns({"_known": known, "_entity": F.coalesce(F.col(entity), F.lit(""))}).drop(entity)


def _spread(df: DataFrame) -> DataFrame:
    hashed = F.xxhash64("_entity", "_period").bitwiseAND(~1).bitwiseOR(F.col("_known").cast("long"))
    return df.withColumn("_hash", hashed).drop("_known").repartition(*SPREAD)


def _is_known() -> Column:
    return F.col("_hash").bitwiseAND(1) == 1


# Longest array of months that is read as one integer, a bit per month. Longer ones, and rows without an entity
# or a moment, take functions of array elements, which are slow.
_BITS = 16


def _with_rows(months: str) -> Column:
    """Bit m is set where element m of an array of at most _BITS counts is above 0."""
    bits = [F.when(F.get(F.col(months), F.lit(m)) > 0, 1 << m).otherwise(0) for m in range(_BITS)]
    return reduce(Column.bitwiseOR, bits)


def _between(bits: Column, first: Column, last: Column) -> Column:
    up_to = F.call_function("shiftleft", F.lit(2), last) - 1
    below = F.call_function("shiftleft", F.lit(1), first) - 1
    return bits.bitwiseAND(up_to).bitwiseAND(F.bitwise_not(below))


def _pieces(df: DataFrame, at: str, months: str, period: PeriodOf) -> DataFrame:
    """One row per period that the months of a row reach; ``_from`` and ``_to`` are the first and last
    offset in there."""

    def place(m: Column) -> Column:
        moment = add_months_ts(F.col(at), m)
        found = F.coalesce(period(moment, F.col("_known")), F.lit(_NO_PERIOD))
        return F.when(F.get(F.col(months), m) > 0, found)

    size = F.size(months)
    offsets = F.sequence(F.lit(0), size - 1)
    by_year = F.lit(False)
    if isinstance(period, YearOr):
        by_year = F.col("_known") & F.col(at).isNotNull() & size.between(1, _BITS)
    # The months are read again behind the shuffle. That they are there is said here, or one of the
    # readers would want it below the shuffle, and they would not share it.
    year, before = F.year(at), F.month(at) - 1
    each = df.where(F.col(months).isNotNull()).withColumns(
        {
            "_places": F.when(~by_year, F.transform(offsets, place)),
            "_offsets": F.when(by_year, _with_rows(months)),
            "_years": F.when(by_year, F.sequence(year, year + F.floor((before + size - 1) / 12).cast("int"))),
        }
    )
    periods = F.coalesce("_years", F.array_distinct("_places"))
    each = each.select("*", F.explode(periods).alias("_period")).where("_period IS NOT NULL")
    # A year holds twelve offsets, of which those with rows count; the lowest and the highest bit are the ends.
    january = (F.col("_period") - year) * 12 - before
    in_year = _between(F.col("_offsets"), F.greatest(january, F.lit(0)), F.least(january + 11, size - 1))
    each = each.withColumn("_in_year", in_year).where("_in_year IS NULL OR _in_year <> 0")
    lowest = F.bit_count(F.col("_in_year").bitwiseAND(-F.col("_in_year")) - 1)
    highest = F.floor(F.log2(F.col("_in_year") + 0.5)).cast("int")
    first = F.array_position("_places", F.col("_period")).cast("int") - 1
    behind = F.array_position(F.reverse("_places"), F.col("_period")).cast("int")
    ends = {"_from": F.coalesce(lowest, first), "_to": F.coalesce(highest, F.size("_places") - behind)}
    return each.withColumns(ends).drop("_places", "_offsets", "_years", "_in_year")


def months_seen(at: str, months: str, first: Column | None = None, last: Column | None = None) -> Column:
    """The month numbers of a row's ``months`` from offset ``first`` to ``last``, one bit each; months on are counted
    round the year."""
    first = F.lit(0) if first is None else first
    last = F.size(months) - 1 if last is None else last
    before = F.month(at) - 1
    turned = F.call_function("shiftleft", _between(_with_rows(months), first, last), before)
    year = lambda n: F.shiftright(turned, 12 * n).bitwiseAND(0xFFF)
    few = F.call_function("shiftleft", year(0).bitwiseOR(year(1)).bitwiseOR(year(2)), F.lit(1))
    ahead = lambda m: F.pmod(before + m, F.lit(12)) + 1
    bit = lambda m: F.when(F.get(F.col(months), m) > 0, F.call_function("shiftleft", F.lit(1), ahead(m)))
    of_offset = lambda seen, m: seen.bitwiseOR(F.coalesce(bit(m), F.lit(0)))
    many = F.aggregate(F.sequence(first, last), F.lit(0), of_offset)
    return F.coalesce(F.when(F.size(months) <= _BITS, few).otherwise(many), F.lit(0))


def _repeated(pieces: DataFrame, at: str, months: str, weight: str, new: str | None = None) -> DataFrame:
    """The rows that pieces stand for; periods never fall, so all offsets from first to last are theirs. Rows
    without a moment keep the bits ``new`` in the first one only, as their months are none."""
    one = pieces.select("*", F.explode(F.sequence("_from", "_to")).alias("_m"))
    count = F.get(F.col(months), F.col("_m"))
    shifted = {at: add_months_ts(F.col(at), F.col("_m")), weight: F.col(weight) * count}
    if new:
        shifted[new] = F.when(F.col(at).isNull() & (F.col("_m") > F.col("_from")), 0).otherwise(F.col(new))
    return one.where(count > 0).withColumns(shifted).drop("_m", "_from", "_to", months)


def months_by_entity(
    df: DataFrame, entity: str, at: str, months: str, weight: str, period: PeriodOf
) -> DataFrame:
    """Every row repeated for its ``months``: element m of the array times ``weight`` rows at ``at``
    plus m months. Rows are shuffled before they are repeated; the result is distributed by the SPREAD
    columns, which it keeps, so grouping by these and more needs no shuffle."""
    pieces = _spread(_pieces(_by_entity(df, entity), at, months, period))
    named = F.when(_is_known(), F.col("_entity")).alias(entity)
    return _repeated(pieces, at, months, weight).select(named, "*")


def previous_value(
    df: DataFrame,
    entity: str,
    at: str,
    value: str,
    ties: Sequence[str],
    weight: str,
    out: str,
    period: Column | PeriodOf,
    counted_before: bool = False,
    month_rank: str | None = None,
    first_month: str | None = None,
    months: str | None = None,
    once: str | None = None,
    once_by: Sequence[str] = (),
) -> DataFrame:
    """Weighted rows (entity, at, value, *ties, out, copies) with the preceding value.

    Rows are ordered by ``at``, then ``value``, then ``ties``, NULLs last; rows equal in all
    of these are interchangeable. ``weight`` is the number of equal rows an input row stands
    for, ``copies`` that of an output row; equal rows may stay several weighted rows. ``months`` names an
    array column: element m, times ``weight``, is the number of rows at ``at`` plus m months; such rows are
    repeated behind the shuffle.

    ``period`` is an integer that never falls as ``at`` grows within an entity; with ``months`` it is a
    function of the moment and whether the row has an entity. Rows without an entity should have short
    periods, as there may be many of them. Set ``counted_before`` when the input has few equal rows left:
    they are then not counted before the shuffle by entity and period. ``month_rank`` names
    an extra column: the 0-based dense rank, within the entity, of the month of ``at``
    (January = 1, whatever the year). ``first_month`` names another: the first day of the
    entity's first month, NULL if it has no row with a time. ``once`` names a third: 1 for one of an entity's
    rows per period, month of ``at`` and ``once_by``, which are some of the ties, and 0 for the others, so that
    entities are counted by a sum. A period must not be longer than a year.

    The result is distributed by the SPREAD columns, which it keeps; ``_known`` says whether a row has an
    entity.
    """
    if months is None:
        df = df.withColumn("_period", F.coalesce(period, F.lit(_NO_PERIOD)))
    spread = _by_entity(df, entity)
    same_row = ["_known", "_entity", at, value, *ties, months or "_period"]
    rows = spread.select(*same_row, F.col(weight).alias("_n"))
    if not counted_before:
        rows = rows.groupBy(*same_row).agg(F.sum("_n").alias("_n"))
    if months:
        rows = _pieces(rows, at, months, period)
        first, last = (add_months_ts(F.col(at), F.col(m)) for m in ("_from", "_to"))
        seen = months_seen(at, months, F.col("_from"), F.col("_to"))
    else:
        first = last = F.col(at)
        seen = month_bit(first)
    rows = _spread(rows)

    # The last row of a period stands for it. It holds every column, so that both readers of the rows
    # want the same ones and share one shuffle.
    others = [c for c in rows.columns if c not in (*SPREAD, value)]
    end = F.struct(last.isNull(), last, F.col(value).isNull(), F.col(value).alias("_latest"), *others)
    periods = rows.groupBy(*SPREAD).agg(
        F.max(end).alias("_end"),
        F.bit_or(seen).alias("_months_seen"),
        F.min(F.trunc(F.to_date(first), "MM")).alias("_first"),
    )
    periods = periods.withColumn("_known", _is_known())
    of_entity = Window.partitionBy("_known", "_entity")
    found = [F.lag("_end._latest").over(of_entity.orderBy("_period")).alias("_carry")]
    if month_rank:
        found.append(F.bit_or("_months_seen").over(of_entity).alias("_year"))
    if first_month:
        found.append(F.min("_first").over(of_entity).alias(first_month))
    carried = periods.select(*[F.col(k).alias(f"{k}_r") for k in SPREAD], *found)
    if months:
        # Adaptive execution would join partitions by their size before the rows are repeated, and the
        # sorts behind it would spill. It leaves a join alone where one side has a given number of them.
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        carried = carried.repartition(partitions, *[f"{k}_r" for k in SPREAD])
    same = [F.col(k) == F.col(f"{k}_r") for k in SPREAD]
    joined = rows.join(carried, same[0] & same[1] & same[2]).drop(*[f"{k}_r" for k in SPREAD])
    if once:
        # The months of a row that no row before it has. They are found before the months are written out.
        bits = F.when(F.col(at).isNull(), 1).otherwise(seen)
        before = Window.partitionBy(*SPREAD, *once_by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.bit_or("_bits").over(before), F.lit(0))
        joined = joined.withColumn("_bits", bits).withColumn("_new", F.col("_bits").bitwiseAND(F.bitwise_not(earlier)))
        joined = joined.drop("_bits")
    each = _repeated(joined, at, months, "_n", "_new" if once else None) if months else joined
    if month_rank:
        # The entity's months before the row's; a row without a time is behind them all.
        below = F.coalesce(month_bit(F.col(at)) - 1, F.lit(-1))
        before = F.bit_count(F.coalesce("_year", F.lit(0)).bitwiseAND(below))
        each = each.withColumn(month_rank, before.cast("long"))

    in_period = Window.partitionBy(*SPREAD).orderBy(*[F.col(c).asc_nulls_last() for c in (at, value, *ties)])
    stepped = each.withColumns(
        {"_before": F.lag(value).over(in_period), "_pos": F.row_number().over(in_period)}
    )
    old = F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_before"))
    one = [old.alias("old"), F.lit(1).cast("long").alias("n")]
    rest = [F.col(value).alias("old"), (F.col("_n") - 1).alias("n")]
    names = [out, "copies"]
    if once:
        is_new = F.col("_new").bitwiseAND(F.coalesce(month_bit(F.col(at)), F.lit(1))) != 0
        one.append(is_new.cast("int").alias("once"))
        rest.append(F.lit(0).alias("once"))
        names.append(once)
    copies = F.when(F.col("_n") > 1, F.array(F.struct(*one), F.struct(*rest))).otherwise(F.array(F.struct(*one)))
    return stepped.select(
        *SPREAD,
        _is_known().alias("_known"),
        F.when(_is_known(), F.col("_entity")).alias(entity),
        at,
        value,
        *ties,
        *[name for name in (month_rank, first_month) if name],
        F.inline(copies).alias(*names),
    )
