"""Reconciliation of log IDs against table rows, for any number of lines and days.

Inputs are two long DataFrames:
  log_keys   (line, audited_date, key)   one row per log record that passed the filters
  table_rows (line, audited_date, key)   one row per table row; key may be NULL

Both sides go through one aggregation to one row per (line, day, key), which holds whether
the log and how often the table has the key: a full outer join of the two key sets without
sorting either. Every per-day number is a partial aggregation (map-side combine). The ID samples and the ID text need only the first 20 / 2001 keys of a day in string
order. They are ranked in two levels: first within one of ``RANK_SALTS`` hash shares of the
day, then among the shares' survivors, so a day with millions of differing IDs never lands
in one task as a whole, whatever limit the optimizer puts on ranks before a shuffle.

Semantics kept from the source audit:
  * total_log counts distinct log keys, total_db counts table rows (NULL keys too);
  * ok needs divergence 0 and equal key sets; divergence >= 0 -> missing_in_db,
    otherwise excess_in_db;
  * the stored ID text always lists log keys missing from the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.clean import bounded_text, py_list_text
from vitrine.spec import (IDS_TEXT_LIMIT, NOTE_LIMIT, NOTE_OK, SAMPLE_SIZE,
                          STATUS_EXCESS, STATUS_MISSING, STATUS_NO_LOG, STATUS_NO_RESULT,
                          STATUS_OK)

__all__ = ["key_pairs", "missing_keys", "excess_keys", "only_left", "except_keys", "reconcile_counts",
           "classify", "first_ranks", "ranked_keys", "audit_results", "audit_results_of_pairs", "audit_summary", "audited_days", "expected_lines",
           "RESULT_COLUMNS"]

DAY = ["line", "audited_date"]
RESULT_COLUMNS = ["line", "audited_date", "total_log", "total_db", "divergence", "ids_missing",
                  "status", "note"]
# A key is at least one character, so 2001 sorted keys always reach past 2000 characters.
IDS_TEXT_RANKS = IDS_TEXT_LIMIT + 1
# Shares of one (line, day, kind) that are ranked on their own first.
RANK_SALTS = 64


def key_pairs(log_keys: DataFrame, table_rows: DataFrame, parts: int | None = None) -> DataFrame:
    """(line, audited_date, key, in_log, n_db) over the union of both key sets.

    NULL table keys never match; they stay as table-only rows and count in total_db.

    ``parts``: deal the rows over so many tasks before they are aggregated, for inputs whose
    keys are nearly all distinct. The hash tables then hold a part's keys each; combining
    before the shuffle would keep one with the keys of a whole file split, to no avail.
    """
    whole = F.col("line").isNotNull() & F.col("audited_date").isNotNull()

    def side(rows, n, in_log, n_db):
        # a NULL line or day equals nothing, so such rows group within their own side only
        return rows.select(*DAY, "key", F.when(whole, F.lit(0)).otherwise(F.lit(n)).alias("_side"),
                           F.lit(in_log).cast("boolean").alias("in_log"), F.lit(n_db).cast("bigint").alias("n_db"))

    both = side(log_keys.where(F.col("key").isNotNull()), 1, True, None).unionByName(side(table_rows, 2, None, 1))
    if parts:
        both = both.repartition(parts, *DAY, "key", "_side")
    return both.groupBy(*DAY, "key", "_side").agg(F.max("in_log").alias("in_log"), F.sum("n_db").alias("n_db")) \
        .drop("_side")


def missing_keys(pairs: DataFrame) -> DataFrame:
    """Log keys the table lacks (log - table)."""
    return pairs.where(F.col("in_log") & F.col("n_db").isNull()).select(*DAY, "key")


def excess_keys(pairs: DataFrame) -> DataFrame:
    """Table keys the log lacks (table - log), NULL keys excluded."""
    return pairs.where(F.col("in_log").isNull() & F.col("key").isNotNull()).select(*DAY, "key")


def only_left(left: DataFrame, right: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks: the one-sided form, an anti join by the
    aggregation of both sides."""
    return missing_keys(key_pairs(left, right, parts))


def except_keys(log_keys: DataFrame, table_rows: DataFrame) -> DataFrame:
    """Set difference in EXCEPT form; must equal ``missing_keys``."""
    a = log_keys.select(*DAY, "key").where(F.col("key").isNotNull())
    b = table_rows.select(*DAY, "key").where(F.col("key").isNotNull())
    return a.subtract(b)


def reconcile_counts(pairs: DataFrame) -> DataFrame:
    """Per (line, day): totals, differing key counts and divergence."""
    in_log = F.col("in_log").isNotNull()
    in_db = F.col("n_db").isNotNull() & F.col("key").isNotNull()
    g = pairs.groupBy(*DAY).agg(
        F.count_if(in_log).cast("bigint").alias("total_log"),
        F.coalesce(F.sum("n_db"), F.lit(0)).cast("bigint").alias("total_db"),
        F.count_if(in_db).cast("bigint").alias("distinct_db"),
        F.count_if(in_log & F.col("n_db").isNull()).cast("bigint").alias("n_missing"),
        F.count_if(in_db & ~in_log).cast("bigint").alias("n_extra"),
    )
    return g.withColumn("divergence", F.col("total_log") - F.col("total_db"))


def classify(counts: DataFrame) -> DataFrame:
    ok = (F.col("divergence") == 0) & (F.col("n_missing") == 0) & (F.col("n_extra") == 0)
    status = F.when(ok, F.lit(STATUS_OK)) \
        .when(F.col("divergence") >= 0, F.lit(STATUS_MISSING)) \
        .otherwise(F.lit(STATUS_EXCESS))
    return counts.withColumn("status", status)


def ranked_keys(keys: DataFrame, k: int, parts: int | None = None) -> DataFrame:
    """First ``k`` keys per (line, day) in string order, as a sorted array."""
    top = first_ranks(keys, DAY, k, parts)
    return top.groupBy(*DAY).agg(F.array_sort(F.collect_list("key")).alias("keys"))


def first_ranks(keys: DataFrame, by: list[str], k: int, parts: int | None = None) -> DataFrame:
    """Rows whose key is among the first ``k`` of its group, with their rank ``_r``: ranked
    within hash shares of the group, then among the (at most RANK_SALTS * k) survivors. The
    shares are dealt first (over ``parts`` tasks), so that no sort joins the aggregation that
    made the keys in a task; so are their survivors."""
    salted = keys.withColumn("_s", F.pmod(F.xxhash64("key"), F.lit(RANK_SALTS)))
    salted = salted.repartition(*([parts] if parts else []), *by, "_s")
    part = Window.partitionBy(*by, "_s").orderBy("key")
    few = salted.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= k).drop("_s", "_r")
    if parts:
        few = few.repartition(parts, *by)
    whole = Window.partitionBy(*by).orderBy("key")
    return few.withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= k)


def audit_results(log_keys: DataFrame, table_rows: DataFrame, key_labels: DataFrame,
                  expected: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """The stored audit row per (line, day), from log keys and table rows."""
    return audit_results_of_pairs(key_pairs(log_keys, table_rows, parts), key_labels, expected, parts)


def audit_results_of_pairs(pairs: DataFrame, key_labels: DataFrame,
                           expected: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """The stored audit row per (line, day), from ``key_pairs``.

    key_labels: (line, key_label) small per-line table used in notes.
    expected:   optional (line, audited_date, has_log) grid; lines/days without any log
                file become ``no_log`` with 0/0 totals, as the source audit stores them.
    """
    counts = classify(reconcile_counts(pairs))
    # Missing and extra keys ranked by one window, then folded into one row per day.
    diff = pairs.select(*DAY, "key", F.when(F.col("in_log") & F.col("n_db").isNull(), F.lit("m"))
                        .when(F.col("in_log").isNull() & F.col("key").isNotNull(), F.lit("x"))
                        .alias("kind")).where(F.col("kind").isNotNull())
    ranked = first_ranks(diff, [*DAY, "kind"], IDS_TEXT_RANKS, parts)
    lists = ranked.groupBy(*DAY).agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "m", F.col("key")))).alias("miss_keys"),
        F.array_sort(F.collect_list(F.when((F.col("kind") == "x") & (F.col("_r") <= SAMPLE_SIZE),
                                           F.col("key")))).alias("extra_sample"))
    lists = lists.select(*DAY, bounded_text(F.array_join("miss_keys", ",")).alias("ids_missing"),
                         F.slice("miss_keys", 1, SAMPLE_SIZE).alias("miss_sample"), "extra_sample")
    # Put beside the counts by one more aggregation of a row or two a day. A join would infer
    # filters on the lists' side, and the two sides could not share the shuffle of the keys.
    r = counts.unionByName(lists, allowMissingColumns=True).groupBy(*DAY) \
        .agg(*[F.max(c).alias(c) for c in [*counts.columns, *lists.columns] if c not in DAY])
    dated = F.col("audited_date").isNotNull()  # a NULL day has counts only
    r = r.select(*DAY, *[F.when(dated, F.col(c)).alias(c) if c in lists.columns else F.col(c)
                         for c in r.columns if c not in DAY]).join(key_labels, "line", "left")
    empty = F.array().cast("array<string>")
    miss_list = py_list_text(F.coalesce("miss_sample", empty))
    extra_list = py_list_text(F.coalesce("extra_sample", empty))
    note = F.when(F.col("status") == STATUS_OK, F.lit(NOTE_OK)) \
        .when(F.col("status") == STATUS_MISSING, F.format_string(
            "Divergence of %d record(s). %d IDs in log missing from DB. %s sample: %s",
            F.col("divergence"), F.col("n_missing"), F.col("key_label"), miss_list)) \
        .otherwise(F.format_string(
            "DB has %d extra record(s). %d IDs in DB absent from log. %s sample: %s",
            F.abs(F.col("divergence")), F.col("n_extra"), F.col("key_label"), extra_list))
    r = r.select(*DAY, "total_log", "total_db", "divergence",
                 F.when(F.col("status") == STATUS_OK, F.lit(""))
                  .otherwise(F.coalesce(F.col("ids_missing"), F.lit(""))).alias("ids_missing"),
                 "status", F.substring(note, 1, NOTE_LIMIT).alias("note"),
                 "distinct_db", "n_missing", "n_extra")
    if expected is None:
        return r
    grid = expected.select(*DAY, "has_log", "no_log_note")
    g = grid.join(r, DAY, "left")
    no_log = ~F.col("has_log")
    zero = F.lit(0).cast("bigint")
    return g.select(
        *DAY,
        F.when(no_log, zero).otherwise(F.coalesce("total_log", zero)).alias("total_log"),
        F.when(no_log, zero).otherwise(F.coalesce("total_db", zero)).alias("total_db"),
        F.when(no_log, zero).otherwise(F.coalesce("divergence", zero)).alias("divergence"),
        F.when(no_log, F.lit("")).otherwise(F.coalesce("ids_missing", F.lit(""))).alias("ids_missing"),
        F.when(no_log, F.lit(STATUS_NO_LOG)).otherwise(F.coalesce("status", F.lit(STATUS_OK)))
         .alias("status"),
        F.when(no_log, F.col("no_log_note")).otherwise(F.coalesce("note", F.lit(NOTE_OK)))
         .alias("note"),
        F.when(no_log, zero).otherwise(F.coalesce("distinct_db", zero)).alias("distinct_db"),
        F.when(no_log, zero).otherwise(F.coalesce("n_missing", zero)).alias("n_missing"),
        F.when(no_log, zero).otherwise(F.coalesce("n_extra", zero)).alias("n_extra"),
    )


def audited_days(log_keys: list[DataFrame], table_rows: list[DataFrame]) -> DataFrame:
    """Distinct days with a log key or a table row of any line, as ``reconcile_counts`` has them.
    Each line's days are made distinct on their own, so that its counters need not be worked out."""
    days = [rows.where(F.col("key").isNotNull()) for rows in log_keys] + table_rows
    return reduce(DataFrame.union, [rows.select("audited_date").distinct() for rows in days]).distinct()


def expected_lines(days: DataFrame, lines) -> DataFrame:
    """Every (line, audited_date) that should have a result: each audited day exploded
    into the configured line names (a literal list, so the output grows only with the
    number of days)."""
    return days.select(F.explode(F.array(*[F.lit(x) for x in lines])).alias("line"),
                       "audited_date")


def audit_summary(results: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per expected (line, day): stored status, or ``no_result`` when the line
    produced none; plus whether the day failed. Ordered by line."""
    r = expected.select(*DAY).join(results.select(*DAY, "total_log", "total_db", "divergence",
                                                 "status"), DAY, "left")
    r = r.withColumn("status", F.coalesce("status", F.lit(STATUS_NO_RESULT)))
    w = Window.partitionBy("audited_date")
    bad = (F.col("status") != STATUS_OK).cast("int")
    return r.withColumn("day_failed", F.max(bad).over(w) == 1).orderBy("audited_date", "line")

