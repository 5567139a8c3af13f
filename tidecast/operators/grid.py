"""Time-grid operators: infer frequency, regularise with forward fill, future spine.

Frequencies use pandas-style codes.  A step is a number of months (``MS``, ``M``, ``QS``, ``Q``, ``AS``), of
business days (``B``) or a fixed number of seconds (``H``, ``D``…).  Weeks may be anchored at a weekday (``W-MON``),
quarters and years at a month (``QS-FEB``, ``A-JUN``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import seasonal_period
from ..schema import DEFAULT_COLS, SeriesCols
from ..session import written
from . import windows

# Frequency codes and their step (months or seconds).
MONTH_CODES = {"MS": 1, "M": 1, "QS": 3, "Q": 3, "AS": 12, "A": 12}
SECOND_CODES = {"S": 1, "T": 60, "H": 3600, "D": 86400, "W": 604800}
MONTH_END_CODES = {"M", "Q", "A"}
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
GRID_BLOCK = 4096
#: Observations from which on a series without weekend rows counts as business-daily where gaps are allowed.
BUSINESS_ROWS = 20


def _parts(freq: str) -> tuple[int, str, str | None]:
    m = re.fullmatch(r"(\d*)([A-Z]+)(?:-([A-Z]{3}))?", freq.upper())
    if not m:
        raise ValueError(f"unknown frequency {freq!r}")
    code, anchor = m[2], m[3]
    if anchor and anchor not in (WEEKDAYS if code == "W" else MONTHS if MONTH_CODES.get(code, 1) > 1 else ()):
        raise ValueError(f"unknown frequency {freq!r}")
    return int(m[1] or 1), code, anchor


def parse_freq(freq: str) -> tuple[int, int, bool]:
    """``(months, seconds, month_end)`` of a code such as ``'D'``, ``'2H'``, ``'MS'``; all zero for business days."""
    k, code, _ = _parts(freq)
    if code in MONTH_CODES:
        return k * MONTH_CODES[code], 0, code in MONTH_END_CODES
    if code in SECOND_CODES:
        return 0, k * SECOND_CODES[code], False
    if code == "B":
        return 0, 0, False
    raise ValueError(f"unknown frequency {freq!r}")


# Business days are numbered without gaps; a weekend shares its Friday's number.  Day 4 of 1970 was a Monday's day 0.
def _business_number(ts: Column) -> Column:
    days = F.unix_date(F.to_date(ts)) + 3
    return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(4))


def _business_day(number: Column) -> Column:
    return F.date_from_unix_date((F.floor(number / 5) * 7 + F.pmod(number, F.lit(5)) - 3).cast("int"))


def _time_of_day(ts: Column) -> Column:
    return ts - F.to_date(ts).cast("timestamp_ntz")


def shift(ts: Column, freq: str, steps: Column | int) -> Column:
    """``ts + steps × freq``; the time of day stays.

    Month codes lead to month starts (``MS``, ``QS``, ``AS``) or month ends (``M``, ``Q``, ``A``): from a day
    off the anchor, step 1 is the next one for the monthly codes.  Quarter and year codes keep the month of ``ts``.
    Business days lead from a weekend to the Monday with step 1.
    """
    months, seconds, month_end = parse_freq(freq)
    n = steps if isinstance(steps, Column) else F.lit(steps)
    ts = ts.cast("timestamp_ntz")
    if months:
        off = _off_month(ts, True).cast("int") if month_end else F.lit(0)
        day = F.add_months(F.trunc(ts, "month"), (n * months - off).cast("int"))
        if month_end:
            day = F.last_day(day)
        return (day.cast("timestamp_ntz") + _time_of_day(ts)).cast("timestamp_ntz")
    if not seconds:
        day = _business_day(_business_number(ts) + n * _parts(freq)[0])
        return (day.cast("timestamp_ntz") + _time_of_day(ts)).cast("timestamp_ntz")
    return (ts + F.make_dt_interval(secs=(n * seconds).cast("decimal(18,6)"))).cast("timestamp_ntz")


def _off_month(ts: Column, month_end: bool) -> Column:
    return F.to_date(ts) != (F.last_day(ts) if month_end else F.trunc(ts, "month"))


def first_step(ts: Column, freq: str) -> Column:
    """Where a grid from ``ts`` begins: ``ts`` itself, or the next month start or end, business day or anchor of the code."""
    months, seconds, month_end = parse_freq(freq)
    _, code, anchor = _parts(freq)
    ts = ts.cast("timestamp_ntz")
    if code == "B":
        return F.when(F.weekday(ts) > 4, shift(ts, "B", 1)).otherwise(ts)
    if code == "W" and anchor:
        return (ts + F.make_dt_interval(days=F.pmod(F.lit(WEEKDAYS.index(anchor)) - F.weekday(ts), F.lit(7)).cast("int"))).cast("timestamp_ntz")
    if not months:
        return ts
    first = F.when(_off_month(ts, month_end), shift(ts, "M" if month_end else "MS", 1)).otherwise(ts)
    if anchor:
        cycle = MONTH_CODES[code]
        first = shift(first, "M" if month_end else "MS", F.pmod(F.lit(MONTHS.index(anchor) + 1) - F.month(first), F.lit(cycle)))
    return first


def step_at_or_after(lo: Column, ts: Column, freq: str) -> Column:
    """Number of the first step of the grid from ``lo`` (see :func:`first_step`) that is not before ``ts``."""
    months, seconds, _ = parse_freq(freq)
    if months:
        apart = 12 * (F.year(ts) - F.year(lo)) + F.month(ts) - F.month(lo)
        k = F.floor(apart / months).cast("long")
        return F.when(shift(lo, freq, k) < ts, k + 1).otherwise(k)
    if not seconds:
        k = F.floor((_business_number(ts) - _business_number(lo)) / _parts(freq)[0]).cast("long")
        return F.when(shift(lo, freq, k) < ts, k + 1).otherwise(k)
    apart, width = F.timestamp_diff("MICROSECOND", lo, ts), F.lit(seconds * 1_000_000)
    over = F.pmod(apart, width)
    return ((apart - over) / width).cast("long") + (over > 0).cast("long")


# ---------------------------------------------------------------- G1 / X13
def infer_frequency(df: DataFrame, cols: SeriesCols = DEFAULT_COLS, strict: bool = True,
                    **kw) -> DataFrame:
    """Frequency code per series: ``(series_id, freq, seasonal_period, n_obs)``.

    ``strict`` (the reference's rule): a code only when every gap is the same
    (or every step is one calendar month/quarter/year on an anchored day, or one business day: ``'B'``);
    fewer than 3 observations or an irregular index → ``'D'``.
    Non-strict: the most frequent gap decides; month starts or ends the least number of months between two of them, and
    days of which none is on a weekend (``BUSINESS_ROWS`` of them at least) are business days.
    """
    s, t = cols.series, cols.ts
    prev = windows.halo_window(df.select(s, t, cols.value),
                               lambda w: {"_prev": F.lag(F.col(t), 1).over(w)}, 1, cols, **kw)
    g = prev.select(
        s, t,
        F.timestamp_diff("SECOND", F.col("_prev"), F.col(t)).alias("_gap"),
        (F.weekday(t) > 4).alias("_weekend"), (shift(F.col("_prev"), "B", 1) == F.col(t)).alias("_business"),
        (F.months_between(F.col(t), F.col("_prev"))).alias("_mdiff"),
        ((F.dayofmonth(t) == 1) & (F.to_date(t).cast("timestamp_ntz") == F.col(t))).alias("_ms"),
        ((F.to_date(t) == F.last_day(t)) & (F.to_date(t).cast("timestamp_ntz") == F.col(t))).alias("_me"))
    agg = g.groupBy(s).agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.min("_gap").alias("_gmin"), F.max("_gap").alias("_gmax"),
        F.min("_mdiff").alias("_mmin"), F.max("_mdiff").alias("_mmax"),
        F.bool_and("_ms").alias("_all_ms"), F.bool_and("_me").alias("_all_me"),
        F.bool_or("_weekend").alias("_any_weekend"), F.bool_and("_business").alias("_all_business"))
    if not strict:
        # most frequent gap in two partial aggregations (count per gap, then the max):
        # no per-series map of all distinct gaps is ever built
        per_gap = (g.where(F.col("_gap").isNotNull()).groupBy(s, "_gap")
                    .agg(F.count(F.lit(1)).alias("_c")))
        mode = per_gap.groupBy(s).agg(
            F.max_by("_gap", F.struct(F.col("_c"), -F.col("_gap"))).alias("_gmode"))
        agg = agg.join(mode, s, "left")
    gap = F.col("_gmin") if strict else F.col("_gmode")
    regular = (F.col("_gmin") == F.col("_gmax")) if strict else F.lit(True)
    month_reg = (F.col("_mmin") == F.col("_mmax")) if strict else F.lit(True)
    business = ~F.col("_any_weekend") & ((F.col("_all_business") & (F.col("_gmin") < F.col("_gmax"))) if strict else (
        (gap == 86400) & (F.col("n_obs") >= BUSINESS_ROWS)))

    def seconds_code(x: Column) -> Column:
        return (F.when(x % 604800 == 0, F.when(x == 604800, "W").otherwise(F.concat((x / 604800).cast("long").cast("string"), F.lit("W"))))
                 .when(x % 86400 == 0, F.when(x == 86400, "D").otherwise(F.concat((x / 86400).cast("long").cast("string"), F.lit("D"))))
                 .when(x % 3600 == 0, F.when(x == 3600, "H").otherwise(F.concat((x / 3600).cast("long").cast("string"), F.lit("H"))))
                 .when(x % 60 == 0, F.when(x == 60, "T").otherwise(F.concat((x / 60).cast("long").cast("string"), F.lit("T"))))
                 .otherwise(F.when(x == 1, "S").otherwise(F.concat(x.cast("string"), F.lit("S")))))

    month_code = (F.when(F.col("_mmin") == 1, F.when(F.col("_all_ms"), "MS").otherwise("M"))
                   .when(F.col("_mmin") == 3, F.when(F.col("_all_ms"), "QS").otherwise("Q"))
                   .when(F.col("_mmin") == 12, F.when(F.col("_all_ms"), "AS").otherwise("A")))
    anchored = (F.col("_all_ms") | F.col("_all_me")) & month_reg & F.col("_mmin").isin(1.0, 3.0, 12.0)
    freq = (F.when(F.col("n_obs") < 3, F.lit("D"))
             .when(anchored, month_code)
             .when(business, F.lit("B"))
             .when(regular & (gap > 0), seconds_code(gap))
             .otherwise(F.lit("D")))
    return agg.select(s, freq.alias("freq"), seasonal_period(freq).alias("seasonal_period"),
                      F.col("n_obs").cast("long").alias("n_obs"))


# ---------------------------------------------------------------- G2 / W7
def regularise(df: DataFrame, freq: str, cols: SeriesCols = DEFAULT_COLS,
               fill: str = "ffill", block: int = GRID_BLOCK,
               with_position: bool = False) -> DataFrame:
    """Complete grid ``min..max`` per series at ``freq``; missing values forward-filled.

    A value observed between two steps is carried to the later one; without filling it has no place.
    A month grid begins at the first month start or end; a series that ends before has that one step.

    Every observation is spread over the steps since the one before it: neither a grid nor a join with one is needed.
    The observation before is found inside blocks of ``block`` steps by window, and across blocks in a table with
    one row a block.  No series is ever handled by a single task.  Adds ``filled`` (1 unless observed at that very step)
    and, with ``with_position``, ``pos``/``n_rows`` (the grid step index, for free).
    """
    s, t, v = cols.series, cols.ts, cols.value
    rows = written(df.select(s, t, v), "regularise")
    bounds = rows.groupBy(s).agg(first_step(F.min(t), freq).alias("_lo"), F.max(t).alias("_hi"))
    up = step_at_or_after(F.col("_lo"), F.col("_hi"), freq)
    n_steps = F.greatest(up - (shift(F.col("_lo"), freq, up) > F.col("_hi")).cast("long"), F.lit(0).cast("long"))
    bounds = bounds.select(s, "_lo", n_steps.alias("_last"))
    obs = F.struct(F.col(t).alias("_t"), F.col(v).alias("_v"))
    seen = rows.where(F.col(v).isNotNull()).join(bounds, s).select(s, "_lo", "_last", step_at_or_after(F.col("_lo"), F.col(t), freq).alias("_k"), obs.alias("_obs"))
    # the first and the last step are there even if nothing was observed
    ends = bounds.select(s, "_lo", "_last", F.explode(F.array_distinct(F.array(F.lit(0).cast("long"), "_last"))).alias("_k")).withColumn(
        "_obs", F.lit(None).cast(seen.schema["_obs"].dataType))
    # every observation belongs to the first step not before it; the latest of a step counts
    steps = seen.where("_k <= _last").unionByName(ends).groupBy(s, "_k").agg(F.first("_lo").alias("_lo"), F.first("_last").alias("_last"), F.max("_obs").alias("_obs"))
    steps = steps.withColumn("_blk", F.floor(F.col("_k") / block))
    at = F.struct(F.col("_k").alias("k"), F.col("_obs._v").alias("v"))
    by_block = Window.partitionBy(s).orderBy("_blk")
    before = steps.groupBy(s, "_blk").agg(F.max_by(at, "_k").alias("_end")).select(s, "_blk", F.lag("_end").over(by_block).alias("_carry"))
    inside = steps.withColumn("_prev", F.lag(at).over(Window.partitionBy(s, "_blk").orderBy("_k")))
    d = inside.join(before, [s, "_blk"]).withColumn("_prev", F.coalesce("_prev", "_carry"))
    # long gaps are spread in two turns, so that no array is longer than a block
    d = d.withColumn("_from", F.coalesce(F.col("_prev.k") + 1, F.col("_k"))).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_k") - F.col("_from")) / block))))
    start = F.col("_from") + F.col("_part") * block
    d = d.withColumn("_j", F.explode(F.sequence(start, F.least(start + (block - 1), F.col("_k")))))
    when = shift(F.col("_lo"), freq, F.col("_j"))
    here = F.col("_j") == F.col("_k")
    exact = F.coalesce(here & (F.col("_obs._t") == when), F.lit(False))
    if fill == "ffill":
        value = F.when(here & F.col("_obs").isNotNull(), F.col("_obs._v")).otherwise(F.col("_prev.v"))
    else:
        value = F.when(exact, F.col("_obs._v"))
    pos_cols = [(F.col("_j") + 1).alias(windows.POS), (F.col("_last") + 1).alias(windows.N_ROWS)] if with_position else []
    return d.select(s, when.alias(t), value.alias(v), (~exact).cast("int").alias("filled"), *pos_cols)


# ---------------------------------------------------------------- G3
def future_spine(df: DataFrame, horizon: int, freq: str | None = None,
                 freq_df: DataFrame | None = None, cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
    """``(series_id, step, timestamp)``: the next ``horizon`` steps after each series' end.

    The frequency is either fixed (``freq``) or per series from ``freq_df``
    (output of :func:`infer_frequency`) for the codes it can produce.
    """
    s, t = cols.series, cols.ts
    last = df.groupBy(s).agg(F.max(t).alias("_last"))
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    if freq is not None:
        ts = shift(F.col("_last"), freq, F.col("step"))
        return steps.select(s, "step", ts.alias(t))
    f = steps.join(freq_df.select(s, "freq"), s, "left")
    code = F.coalesce(F.col("freq"), F.lit("D"))
    expr = None
    for c in ("MS", "M", "QS", "Q", "AS", "A", "W", "B", "D", "H", "T", "S"):
        e = shift(F.col("_last"), c, F.col("step"))
        expr = F.when(code == c, e) if expr is None else expr.when(code == c, e)
    # multiples such as "2D": number × base step in seconds
    num = F.regexp_extract(code, r"^(\d+)", 1)
    unit = F.regexp_extract(code, r"([A-Z]+)$", 1)
    secs = (F.when(unit == "W", 604800).when(unit == "D", 86400).when(unit == "H", 3600)
             .when(unit == "T", 60).otherwise(1))
    mult = (F.col("_last") + F.make_dt_interval(
        secs=(F.col("step") * num.cast("long") * secs).cast("decimal(18,6)"))).cast("timestamp_ntz")
    expr = expr.otherwise(mult)
    return f.select(s, "step", expr.alias(t))
