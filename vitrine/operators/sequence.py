"""Occurrence counters and last-write-wins.

``with_event_seq`` numbers rows that share a key (0, 1, 2, ...) in physical file
order. A plain window puts every key group into one task; a group that holds a large
share of the rows (a stuck counter, a broken clock) would then be sorted by a single
task. With ``split_col`` (the file split a row came from) the numbering is done in two
levels instead: rows are numbered inside their own split, and an offset equal to the
number of rows of the same group in earlier splits is added. Each window then covers
at most one split of one group, so no task ever holds more than a split's worth of
one key, and the result is exactly the same as the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["with_event_seq", "last_write_wins", "mark_last_write", "null_safe_keys"]


def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def null_safe_keys(df: DataFrame, keys, prefix: str = "_k"):
    """Add non-null stand-ins for nullable key columns: (value-or-default, is-null flag).

    Plain equality and hash partitioning on the stand-ins behave like ``<=>`` on the
    originals, so joins on them can reuse an existing partitioning.
    """
    names = []
    for i, k in enumerate(keys):
        dt = df.schema[k].dataType
        default = F.lit(0).cast(dt) if dt.typeName() not in ("string",) else F.lit("")
        if dt.typeName() in ("timestamp_ntz", "timestamp", "date"):
            default = F.lit("1970-01-01").cast(dt)
        v, n = f"{prefix}{i}v", f"{prefix}{i}n"
        df = df.withColumn(v, F.coalesce(F.col(k), default)).withColumn(n, F.col(k).isNull())
        names += [v, n]
    return df, names


def with_event_seq(df: DataFrame, keys, order_cols, scope_cols=(), split_col: str | None = None,
                   out: str = "event_seq", parts: int | None = None) -> DataFrame:
    """0-based occurrence number of each row within (scope, keys), ordered by ``order_cols``.

    ``order_cols`` must be a total order inside a scope (e.g. split start, row position).
    NULL key values form one group, like any other value.

    ``parts`` (with ``split_col``): tasks over which the rows, then the group sizes, are dealt
    before they are sorted or counted, so that a caller can let their number follow the input.
    """
    keys, scope = list(keys), list(scope_cols)
    order = _order(order_cols)
    if split_col is None:
        w = Window.partitionBy(*scope, *keys).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))

    base, gk = null_safe_keys(df, scope + keys, prefix="_sq")
    # A key travels as its stand-ins alone and is put back at the end, unless the order reads it.
    spare = [] if any(not isinstance(c, str) for c in order_cols) else \
        [i for i, k in enumerate(scope + keys) if k not in {*order_cols, split_col}]
    base = base.drop(*[(scope + keys)[i] for i in spare])
    back = {(scope + keys)[i]: F.when(~F.col(gk[2 * i + 1]), F.col(gk[2 * i])) if df.schema[(scope + keys)[i]].nullable
            else F.col(gk[2 * i]) for i in spare}
    # The flag of a column that is never null would be a constant, on which the optimizer deals anew.
    gk = [c for j, c in enumerate(gk) if not j % 2 or df.schema[(scope + keys)[j // 2]].nullable]
    part = gk + [split_col]
    if parts:
        base = base.repartition(parts, *part)
    w_local = Window.partitionBy(*part).orderBy(*order)
    numbered = base.withColumn("_sq_local", F.row_number().over(w_local) - 1)
    # Group sizes per split: grouping on the window's own keys needs no new shuffle.
    sizes = numbered.groupBy(*part).agg(F.count(F.lit(1)).alias("_sq_n"))
    if parts:
        sizes = sizes.repartition(parts, *gk)
    # Rows of the same group in earlier splits; only continuing groups get an offset.
    w_prev = Window.partitionBy(*gk).orderBy(split_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_sq_off", F.sum("_sq_n").over(w_prev)) \
        .where(F.col("_sq_off") > 0).drop("_sq_n")
    # Merged, never broadcast: with many continuing groups the offsets are as many as the rows,
    # while the optimizer guesses their size from that of the files.
    joined = numbered.join(offsets.hint("merge"), part, "left")
    res = joined.withColumn(out, (F.col("_sq_local") + F.coalesce(F.col("_sq_off"), F.lit(0)))
                            .cast("bigint"))
    return res.select(*[back[c].alias(c) if c in back else F.col(c) for c in df.columns if c != out], out)


def mark_last_write(df: DataFrame, keys, order_cols, out: str = "is_last") -> DataFrame:
    """All rows, with whether ``last_write_wins`` would keep the row."""
    w = Window.partitionBy(*keys).orderBy(*_order(order_cols))
    return df.withColumn(out, F.row_number().over(w) == 1)


def last_write_wins(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep one row per key: the first by ``order_cols`` (put the latest load first)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order_cols))
    return df.withColumn("_lww", F.row_number().over(w)).where(F.col("_lww") == 1).drop("_lww")
