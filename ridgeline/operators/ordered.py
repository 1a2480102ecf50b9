"""Order-dependent work on keyed series, spread over tasks within each key.

``Window.partitionBy(key).orderBy(time)`` puts a whole key into one task, which
fails once one key holds a large share of the rows.  Both forms here first count
the rows per key and time bucket (a small, map-side combined aggregate) and work
on pieces of a key afterwards:

* ``split`` packs consecutive buckets into parts of about ``rows`` rows and
  copies the rows shortly before (and after) a part into it, so windows with a
  bounded frame see all they need.  Copies carry ``_home = false`` and are
  dropped by ``merge``.
* ``fill`` needs an unbounded look back; it works inside single buckets and
  takes from the bucket table what earlier (later) buckets hand over.

``lay`` does the count once for several steps on the same rows: it stores them with
their bucket and returns a ``Layout`` that the steps take as ``laid``.

Without it both run the count as a job of its own and store its result.  Spark then plans
the join with the bucket table by its real size: a small one is broadcast and the
rows are shuffled once, to their parts.  A bucket is named by where it begins.
Buckets are joined until one holds a fair number of rows on average, so the table
of them stays short; those of a key whose rows lie dense there are cut again, and
only they, so one dense key does not change the layout of the others.

A series is identified by non-NULL key columns and a non-NULL time, unique
within the key; rows without them belong to no series and are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.columns import cell_start, names, time_place, time_width
from ridgeline.session import settle

ROWS = 32_768
DOUBLINGS = 40
SHORT = 1_024  # buckets; a table of fewer needs no wider ones
_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


BUCKET = "_bucket"


@dataclass(frozen=True)
class Layout:
    """Where rows that carry their bucket belong: the keys, and the stored table of buckets with ``_n`` rows each.

    It also fits what is left of the rows after some were dropped at the ends of a series, and, for steps
    that look back one row or to the last known value, after any were dropped.
    """

    keys: tuple[str, ...]
    sizes: DataFrame
    total: int


def lay(df: DataFrame, k, t: str, width: float | None = None, rows: int = ROWS) -> tuple[DataFrame, Layout]:
    """The rows, stored with their ``_bucket``, and the layout they have; runs the count and stores each row once."""
    keys = names(k)
    tagged, sizes, total = _laid_out(df.drop(BUCKET), keys, t, width, rows)
    return settle(tagged), Layout(tuple(keys), sizes if sizes.inputFiles() else settle(sizes), total)


def _count(df: DataFrame, keys: list[str], t: str, width: float | None, rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their bucket, and the table of buckets with ``_n`` rows each."""
    return _laid_out(df, keys, t, width, rows)[:2]


def _laid_out(df: DataFrame, keys: list[str], t: str, width: float | None, rows: int,
              collect: Callable[[Column | str, Column | str], Column] | None = None,
              laid: Layout | None = None) -> tuple[DataFrame, DataFrame, int]:
    """The rows with their bucket, the table of buckets with ``_n`` rows each, and the number of all rows (or more).

    ``collect(value, order)`` is an aggregate that also gives ``_left``, the ``_value`` a
    bucket leaves behind.
    """
    if laid is not None:
        if set(laid.keys) - set(keys):
            raise ValueError(f"laid out by {laid.keys}, not by {keys}")
        if collect is None:
            return df, laid.sizes, laid.total
        order = F.when(F.col("_value").isNotNull(), F.col(t))
        handed = df.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"), collect("_value", order).alias("_left"))
        return df, handed, laid.total
    place = time_place(df, t)
    whole = df.select(place.alias("p")).schema["p"].dataType == T.LongType()
    width = time_width(df, t, width)
    left = [] if collect is None else [collect("_value", F.when(F.col("_value").isNotNull(), F.col(t))).alias("_left")]
    tagged = df.withColumn("_place", place).filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ["_place", *keys]]))

    def counted(rows_: DataFrame) -> DataFrame:
        return rows_.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), *left)

    # The tasks that store the buckets add them up as well.
    seen = Observation()
    first = counted(tagged.withColumn("_bucket", cell_start(F.col("_place"), F.lit(width), whole)))
    sizes = stored = settle(first.observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.max("_n").alias("largest"),
                                          F.count(F.lit(1)).alias("cells")))
    total, largest, cells = (seen.get[c] for c in ("total", "largest", "cells"))
    several = 1
    if cells > SHORT + 16 * total / rows:
        # Widths are doubled until buckets hold a sixteenth of a part on average, or keys have one or two each.
        wider = [F.approx_count_distinct(F.struct(*keys, F.floor(F.col("_bucket") / (width * 8.0 ** p)))) for p in range(DOUBLINGS // 3)]
        n_keys, *found = sizes.agg(F.approx_count_distinct(F.struct(*keys)), *wider).first()
        fair = SHORT + 16 * total / rows + 2 * n_keys
        several = 8 ** next((p for p, n in enumerate(found) if n <= fair), DOUBLINGS // 3 - 1)
    width = width * several
    tagged = tagged.withColumn("_bucket", cell_start(F.col("_place"), F.lit(width), whole))
    if several > 1:
        kept = [] if collect is None else [collect("_left", F.when(F.col("_left").isNotNull(), F.col("_bucket"))).alias("_left")]
        sizes = sizes.groupBy(*keys, cell_start(F.col("_bucket"), F.lit(width), whole).alias("_bucket")).agg(
            F.sum("_n").alias("_n"), *kept)
    # No joined bucket can be too full if this many of the fullest would not be.
    crowded = (largest or 0) * several > 2 * rows
    finest = 1 if whole else width * 2.0 ** -40
    at = F.lit(width)
    while crowded:
        finer = F.greatest(F.lit(finest), F.floor(at * rows / F.col("_n")) if whole else at * rows / F.col("_n"))
        dense = settle(sizes.filter((F.col("_n") > 2 * rows) & (at > finest))
                       .select(*keys, "_bucket", finer.alias("_width")))
        if dense.isEmpty():
            break
        joined = tagged.join(dense, [*keys, "_bucket"], "left")
        inside = F.col("_bucket") + cell_start(F.col("_place") - F.col("_bucket"), F.col("_width"), whole)
        tagged = joined.withColumn("_bucket", F.coalesce(inside, F.col("_bucket")))
        again = tagged.filter(F.col("_width").isNotNull())
        cut = settle(again.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.first("_width").alias("_width"), *left))
        sizes = sizes.drop("_width").join(dense, [*keys, "_bucket"], "left_anti").unionByName(cut, allowMissingColumns=True)
        tagged, at = tagged.drop("_width"), F.coalesce("_width", F.lit(finest))
    return tagged.drop("_place"), sizes if sizes is stored else sizes.drop("_width"), total


def split(df: DataFrame, k, t: str, before: int = 0, ahead: bool = False,
          width: int | None = None, rows: int | None = ROWS, laid: Layout | None = None) -> DataFrame:
    """Add ``_part`` and ``_home``; each part also gets at least the ``before``
    rows preceding it and, with ``ahead``, the bucket following it.

    ``rows=None`` leaves every key whole, which saves the count and a shuffle
    where all keys are known to be short.  So are all if the whole table has no more rows than a part.
    """
    keys = names(k)
    if rows is None:
        return df.withColumns({"_part": F.lit(0), "_home": F.lit(True)})
    tagged, sizes, total = _laid_out(df, keys, t, width, rows, laid=laid)
    if total <= rows:
        return tagged.select(*df.columns, F.lit(0).cast("long").alias("_part"), F.lit(True).alias("_home"))
    keys = list(laid.keys) if laid else keys
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    placed = (
        sizes.withColumn("_end", F.sum("_n").over(by_bucket.rowsBetween(_FIRST, 0)))
        .withColumn("_own", F.expr(f"(_end - _n) div {rows}"))
        .withColumns({
            "_prior": F.lag("_own").over(by_bucket),
            "_top": F.max("_own").over(Window.partitionBy(*keys)),
        })
    )
    place = [F.array(F.struct(F.col("_own").alias("_part"), F.lit(True).alias("_home")))]
    if before > 0:
        # The next bucket starts at row _end, so a later part that reaches back
        # into this bucket is numbered from _end div rows on.
        low = F.greatest(F.col("_own") + 1, F.expr(f"_end div {rows}"))
        high = F.least(F.col("_top"), F.expr(f"(_end + {before - 1}) div {rows}"))
        copies = F.transform(F.sequence(low, high), lambda p: F.struct(
            p.alias("_part"), F.lit(False).alias("_home")))
        place.append(F.when(low <= high, copies).otherwise(F.array()))
    if ahead:
        copy = F.array(F.struct(F.col("_prior").alias("_part"), F.lit(False).alias("_home")))
        place.append(F.when(F.col("_prior") < F.col("_own"), copy).otherwise(F.array()))
    placed = placed.select(*keys, "_bucket", F.concat(*place).alias("_places"))
    return (
        tagged.join(placed, [*keys, "_bucket"])
        .select(*df.columns, F.inline("_places"))
    )


def attach(df: DataFrame, per_key: DataFrame, k) -> DataFrame:
    """Join one row per key to all rows of the key.

    The rows per key are stored, so Spark knows their size: it sends a short
    table to all tasks, and splits the partition of a key that holds a large
    share of the rows otherwise.
    """
    return df.join(settle(per_key), names(k))


def window(k, t: str) -> WindowSpec:
    """Rows of one part in time order."""
    return Window.partitionBy(*names(k), "_part").orderBy(t)


def merge(df: DataFrame, original: DataFrame) -> DataFrame:
    """Drop the copied rows and the helper columns the original did not have."""
    return df.filter("_home").drop(*[c for c in df.columns if c.startswith("_") and c not in original.columns])


def over_series(df: DataFrame, k, t: str, before: int, step: Callable[[DataFrame, WindowSpec], DataFrame],
                ahead: bool = False, **layout) -> DataFrame:
    """Apply ``step(parts, window)``, whose frames reach back at most ``before`` rows."""
    return merge(step(split(df, k, t, before, ahead, **layout), window(k, t)), df)


def fill(df: DataFrame, k, t: str, x: str, out: str | None = None, direction: str = "forward",
         width: int | None = None, tie: str | None = None) -> DataFrame:
    """Replace a missing ``x`` by the nearest earlier (``"backward"``: later) value of its key.

    ``tie`` orders rows of equal time, for inputs that mix two kinds of rows.
    """
    return hand_over(df, k, t, F.col(x), out or x, direction=direction, width=width, tie=tie)


def hand_over(df: DataFrame, k, t: str, value: Column, out: str, start: Column | None = None,
              shifted: str | None = None, direction: str = "forward",
              width: int | None = None, tie: str | None = None, laid: Layout | None = None) -> DataFrame:
    """Running "latest known ``value``" of each key, ``start`` before there is any.

    ``shifted`` names a second output: the result of the preceding row.
    """
    if direction not in ("forward", "backward"):
        raise ValueError("direction is 'forward' or 'backward'")
    keys, forward = names(k), direction == "forward"
    tagged, left, total = _laid_out(df.withColumn("_value", value), keys, t, width, ROWS, F.max_by if forward else F.min_by, laid)
    step = F.asc if forward else F.desc
    if total <= ROWS and width is None:
        # No more rows than a part has: nothing is handed from one bucket to another.
        return _inside(tagged, Window.partitionBy(*keys).orderBy(*[step(c) for c in ([t, tie] if tie else [t])]), [], out, start, shifted).drop(
            "_value", *([] if laid else [BUCKET]))
    by_bucket = Window.partitionBy(*keys).orderBy(step("_bucket"))
    handed = left.select(
        *keys, "_bucket",
        F.last("_left", ignorenulls=True).over(by_bucket.rowsBetween(_FIRST, -1)).alias("_handed"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*[step(c) for c in ([t, tie] if tie else [t])])
    result = _inside(tagged.join(handed, [*keys, "_bucket"]), inside, [F.col("_handed")], out, start, shifted)
    return result.drop("_value", "_handed", *([] if laid else [BUCKET]))


def _inside(rows: DataFrame, inside: WindowSpec, handed: list[Column], out: str, start: Column | None, shifted: str | None) -> DataFrame:
    """Latest known ``_value`` by a window, then what was ``handed`` on from before it, then ``start``."""
    others = [*handed, *([] if start is None else [start])]
    result = rows.withColumn(out, F.coalesce(F.last("_value", ignorenulls=True).over(inside.rowsBetween(_FIRST, 0)), *others))
    if shifted:
        result = result.withColumn(shifted, F.coalesce(F.lag(out).over(inside), *others))
    return result
