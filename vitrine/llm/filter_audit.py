"""Filter interaction audit: what every order of applying the filters removes at every step.

Every document gets a mask with one bit per failed filter; documents are then counted per cell
(part, mask), so that all later work is on at most 2^filters cells a part. A recursive common
table expression walks the orders: each level extends every prefix by each unused letter. It
joins the mask cells' moves on (mask, applied bits), carries the new applied bits on and emits
what this step does to the cell: kept, removed, or redundant because an earlier filter removed
it. The walk depends on the masks alone (at most 2^5 masks x 325 prefixes), never on the number
of documents or parts, so it is small enough to broadcast to the cells of all parts.

Filters of ``document_masks`` (failure conditions): A under 100 words; B 100 * distinct words
< 80 * words; C 100 * [A-Z] characters > 10 * code points; D holds one of ``# $ % & * |``;
E identical to the text of any smaller doc_id, whichever part that is in.

Defined results: a null text is the empty text, a null lang the part named by the empty string.
A null doc_id is neither smaller nor larger than any other, so such a row never fails E, and it
has no label. Rows that repeat an id count as documents of their own; a text that repeats under
one id only does not fail E. Of several label rows of one id, one with quality = 1 (toxic = 1)
is enough; labels without a document say nothing. Every part has all its order steps, with
zeros; an empty table gives an empty result. Very long texts are taken whole. Columns beside
those named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import table, written

LETTERS = "ABCDE"
SPACES = r"[ \t-\r]+"


def text_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask, text_key): the bits of A to D, and a digest that equal texts share."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    words = F.filter(F.split("t", SPACES), lambda w: w != "")
    n, distinct = F.size("ws"), F.size(F.array_distinct("ws"))
    fails = [n < 100, 100 * distinct < 80 * n,
             100 * F.length(F.regexp_replace("t", "[^A-Z]+", "")) > 10 * F.length("t"), F.col("t").rlike("[#$%&*|]")]
    mask = sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)), F.lit(0))
    return src.withColumn("ws", words).select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("t", 256)).alias("text_key"))


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents with all five bits and their labels, counted by
    (id, part, text) first, so that neither a hot text nor a hot id is gathered."""
    rows = written(text_masks(docs).groupBy("doc_id", "part", "mask", "text_key").agg(F.count(F.lit(1)).alias("n")), "audit-masks")
    named = rows.where("doc_id is not null")
    first = named.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    flags = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    out = (named.join(first, ["text_key", "doc_id"], "left").join(flags, "doc_id", "left")
           .select("part", F.when(F.col("is_first"), F.col("mask")).otherwise(F.col("mask").bitwiseOR(F.lit(1 << 4))).alias("mask"),
                   F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n"))
    return out.unionByName(rows.where("doc_id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n"))


#: The walk over the orders. ``moves``: (mask, applied, letter, bit), the letters still unused.
WALK = """
WITH RECURSIVE walk(mask, filter_order, applied, step, before, bit) AS (
  SELECT mask, CAST('' AS STRING), 0, 0, 0, 0 FROM {masks}
  UNION ALL
  SELECT w.mask, concat(w.filter_order, m.letter), w.applied | m.bit, w.step + 1, w.applied, m.bit
  FROM walk w JOIN {moves} m ON w.mask = m.mask AND w.applied = m.applied
)
SELECT mask, filter_order AS prefix, step, right(filter_order, 1) AS letter,
       mask & applied = 0 AS is_kept,
       mask & bit <> 0 AND mask & before = 0 AS is_removed,
       mask & bit <> 0 AND mask & before <> 0 AS is_redundant,
       mask = bit AS is_unique
FROM walk WHERE step > 0
"""


def walk(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """What each step of each order does to each mask, by recursion over the prefixes."""
    spark = masks.sparkSession
    bits = F.array(*[F.struct(F.lit(x).alias("letter"), F.lit(1 << k).alias("bit")) for k, x in enumerate(letters)])
    moves = (masks.select("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(letters)) - 1))).alias("applied"))
             .select("mask", "applied", F.explode(bits).alias("m")).where("applied & m.bit = 0").select("mask", "applied", "m.letter", "m.bit"))
    return spark.sql(WALK, masks=masks, moves=moves)


def audit(documents: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, filter order and step, from counted documents (part, mask, good, toxic, n)."""
    n, good, toxic = F.col("n"), F.when(F.col("good"), F.col("n")).otherwise(0), F.when(F.col("toxic"), F.col("n")).otherwise(0)
    cells = written(documents.groupBy("part", "mask").agg(F.sum(n).alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic")), "audit-cells")
    steps = written(walk(cells.select("mask").distinct(), letters), "audit-walk")  # at most 32 masks x 325 prefixes

    def total(flag: str, of: str):
        return F.sum(F.when(F.col(flag), F.col(of)).otherwise(0)).cast("long")

    at = (cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "letter")
          .agg(total("is_kept", "n").alias("kept"), total("is_removed", "n").alias("removed"), total("is_redundant", "n").alias("redundant"),
               total("is_unique", "n").alias("unique_fails"), total("is_removed", "good").alias("good_lost"), total("is_removed", "toxic").alias("toxic_lost")))
    # a prefix stands in as many orders as its unused letters can follow in
    shapley = (at.groupBy("part", "letter").agg(F.sum(F.col("removed") * F.factorial(F.lit(len(letters)) - F.col("step"))).cast("long").alias("shapley")))
    orders = (steps.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
              .select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("k"))
              .select("filter_order", F.substring("filter_order", F.lit(1), F.col("k")).alias("prefix")))
    return (at.join(F.broadcast(orders), "prefix").join(shapley, ["part", "letter"])
            .select("part", "filter_order", "step", "letter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(document_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


#: Every document against every order and step, without masks or recursion.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
lowest AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
f AS (
  SELECT w.part,
         concat(CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN w.doc_id > lowest.low THEN 'E' ELSE '' END) AS fails,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w JOIN lowest ON w.t = lowest.t LEFT JOIN lab ON w.doc_id = lab.doc_id),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT concat(a.x, b.x, c.x, e.x, g.x) AS filter_order
      FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x)
      JOIN l g ON g.x NOT IN (a.x, b.x, c.x, e.x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
e AS (
  SELECT part, filter_order, step, letter, good, toxic,
         contains(fails, letter) AS failing,
         fails <> '' AND regexp_matches(fails, concat('[', earlier, '-]')) AS gone,
         fails = letter AS alone
  FROM f, s),
r AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT gone AND NOT failing THEN 1 ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failing THEN 1 ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failing THEN 1 ELSE 0 END) AS redundant,
         sum(CASE WHEN alone THEN 1 ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM e GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
