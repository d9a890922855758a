"""Keyed upsert / insert-ignore and schema conforming.

Parquet has no MERGE, so an upsert is expressed as ``staged UNION ALL (existing
LEFT ANTI JOIN staged)`` with null-safe keys, restricted by the caller to the
partitions the batch touches. The anti join is left to the planner: with AQE on, a
staged side that turns out small at run time becomes a broadcast, otherwise both
sides are shuffled on the key.

``change_set`` says what a batch of files does to a table before anything is written, as
applying the files one after the other would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators.sequence import last_write_wins

__all__ = ["upsert", "insert_ignore", "conform", "anti_join_keys", "change_set", "changes_per_file"]


def anti_join_keys(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Rows of ``left`` whose key (null-safe) has no match in ``right``."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, "left_anti")


def upsert(existing: DataFrame, staged: DataFrame, keys, dedupe_order=None) -> DataFrame:
    """ON CONFLICT (keys) DO UPDATE: staged rows replace existing rows with the same key.

    ``dedupe_order``: when the batch may hold one key several times (several files),
    keep the first row by this order (put the latest file first).
    """
    keys = list(keys)
    if dedupe_order is not None:
        staged = last_write_wins(staged, keys, dedupe_order)
    staged = staged.select(*existing.columns)
    kept = anti_join_keys(existing, staged, keys)
    return staged.unionByName(kept)


def insert_ignore(existing: DataFrame, staged: DataFrame, keys, dedupe_order=None) -> DataFrame:
    """ON CONFLICT (keys) DO NOTHING: existing rows win, new keys are appended."""
    keys = list(keys)
    if dedupe_order is not None:
        staged = last_write_wins(staged, keys, dedupe_order)
    staged = staged.select(*existing.columns)
    new = anti_join_keys(staged, existing, keys)
    return existing.unionByName(new)


def change_set(existing: DataFrame, staged: DataFrame, keys, order, ignore=(), mode: str = "update") -> DataFrame:
    """``staged`` (all rows of all files, none left out as overwritten) with a column ``change``:

    * ``inserted``: the key is new to the table and to the rows applied before;
    * ``updated`` / ``unchanged``: the key is there already, with other or equal values;
    * ``ignored`` in place of these two when ``mode`` is 'ignore' (DO NOTHING).

    ``order`` puts rows in the order they are applied. Values of ``ignore`` columns (load times)
    and columns that the table lacks are not compared. Keys compare null-safe; ``existing``
    holds a key at most once. A key is at most once in a file, so a window holds one row a file.
    """
    keys = list(keys)
    values = [c for c in existing.columns if c not in keys and c not in ignore]
    content = F.xxhash64(F.lit(0), *[F.struct(F.col(c).isNull(), F.col(c)) for c in values])
    stored = existing.select(*[F.col(k).alias(f"_e_{k}") for k in keys], content.alias("_stored"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys])
    by = Window.partitionBy(*keys).orderBy(*order)
    rows = staged.withColumn("_content", content).withColumn("_before", F.lag("_content").over(by))
    before = F.coalesce("_before", "_stored")
    there = F.lit("ignored") if mode == "ignore" else F.when(before == F.col("_content"), F.lit("unchanged")).otherwise(F.lit("updated"))
    return (rows.join(stored, same, "left").withColumn("change", F.when(before.isNull(), F.lit("inserted")).otherwise(there))
            .select(*staged.columns, "change"))


def changes_per_file(changes: DataFrame, file_col: str = "file_key") -> DataFrame:
    """Per file: staged rows, by what they did, and ``rows``, the number that a statement applying
    the file would report (every row but the ignored ones)."""
    kinds = ("inserted", "updated", "unchanged", "ignored")
    count = {k: F.count_if(F.col("change") == k).cast("bigint") for k in kinds}
    return changes.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("staged"), *[n.alias(k) for k, n in count.items()],
        (count["inserted"] + count["updated"] + count["unchanged"]).alias("rows"))


def conform(df: DataFrame, schema: T.StructType, extra=()) -> DataFrame:
    """Select and cast to the target schema, in target order (the staging step)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *extra)
