"""Exact top-k search of binary codes by incremental multi-index hashing.

A 64-bit code is cut into m segments of about log2(number of codes) - 2 bits (at most 16), each an
index of its own, so that a probe finds some four codes. Round ``s`` probes, for every open query, all segment values at distance
exactly ``s`` in every index, and verifies the full Hamming distance of what it finds. After
round ``s`` every code within ``m s + m - 1`` is found, because a code further than ``s`` away in
all m segments is at least ``m s + m`` away. A query closes when its k-th verified distance is
within that radius; the rest go on. The round of the segment's width covers every code, so every
query closes with the exact answer.

Open queries are dealt over the session's tasks before their probes are made, and probes meet
the index in a shuffled merge join by (segment, value): nothing that grows with the queries, the
probes or the codes is broadcast.

A pair of codes turns up in exactly one probe (the first of its nearest segments), so nothing
needs to be made distinct. Codes are grouped first and carry their k + 1 smallest ids; the
limits on ranks are applied before the shuffle, so no bucket and no hot code is gathered.

Defined results: ties go to the smaller id; a row is not its own neighbour; rows that repeat an
id and its code count once; an id with several codes is searched for by each of them, and found
at each of them, and the k nearest of these pairs are its answer; rows with a null id are neither queries nor neighbours; a vector
that is null, is not 64 long, or holds a null, NaN or infinite component has no code and takes
no part; with fewer than k others a query returns them all; an empty table gives an empty
result; columns beside the id and the vector are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import table, written

BITS = 64
#: Bits of a segment, at least and at most.
LEAST_WIDTH, WIDTH = 8, 16
K = 10
#: One row in this many is a query.
QUERY_EVERY = 100


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, code): bit i of the code is set where component i is positive."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    sound = (F.size("v") == BITS) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    code = F.aggregate(F.transform("v", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))),
                       F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return src.where(F.col("vec_id").isNotNull() & sound).select("vec_id", code.alias("code")).distinct()


def segments(n: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments for n codes."""
    m = -(-BITS // min(WIDTH, max(LEAST_WIDTH, round(math.log2(max(n, 2))) - 2)))
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _masks(width: int, s: int) -> Column:
    """All values of ``width`` bits with ``s`` of them set (at most 12,870)."""
    values = ",".join(str(sum(1 << b for b in bits)) for bits in combinations(range(width), s))
    return F.split(F.lit(values), ",").cast("array<int>") if values else F.array().cast("array<int>")


FOUND = "array<struct<distance:int,first:bigint,ids:array<bigint>>>"


def top_k(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, distance). ``codes``: vec_id, code, distinct rows; ``queries``:
    the same columns."""
    spark = codes.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    items = written(codes.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("code")
                    .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "search-codes")
    size = codes.count()
    cut = segments(items.count())
    index = items.select("code", "ids", F.posexplode(F.array(*[_segment(F.col("code"), *c) for c in cut])).alias("seg", "val"))
    own = codes.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own")).withColumnRenamed("vec_id", "query_id")
    state = written(queries.select(F.col("vec_id").alias("query_id"), F.col("code").alias("q")).distinct().join(own, "query_id", "left")
                    .select("query_id", "q", F.least(F.lit(k), F.lit(size) - F.coalesce("own", F.lit(0))).alias("need"), F.array().cast(FOUND).alias("found")), "search-state")
    closed: list[DataFrame] = [state.where("need < 1").select("query_id", "found")]
    state = state.where("need >= 1")
    for s in range(max(w for _, w in cut) + 1):
        if state.isEmpty():
            break
        open_ = state.repartition(tasks, "query_id", "q")
        near = F.array(*[F.struct(F.lit(g).alias("seg"), _segment(F.col("q"), *c).alias("own"), _masks(c[1], s).alias("masks")) for g, c in enumerate(cut)])
        probes = (open_.select("query_id", "q", F.explode(near).alias("p")).select("query_id", "q", "p.seg", "p.own", F.explode("p.masks").alias("mask"))
                  .select("query_id", "q", "seg", F.col("own").bitwiseXOR(F.col("mask")).alias("val")))
        weights = F.array(*[F.bit_count(_segment(F.col("q").bitwiseXOR(F.col("code")), *c)) for c in cut])
        hits = (probes.hint("merge").join(index, ["seg", "val"])
                .where((F.array_min(weights) == s) & (F.array_position(weights, F.array_min(weights)) == F.col("seg") + 1))
                .select("query_id", "q", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).alias("distance"),
                        F.array_remove("ids", F.col("query_id")).alias("ids"))
                .where(F.size("ids") > 0).select("query_id", "q", "distance", F.element_at("ids", 1).alias("first"), "ids"))
        kept = state.select("query_id", "q", F.explode("found").alias("f")).select("query_id", "q", "f.distance", "f.first", "f.ids")
        best = (hits.unionByName(kept)
                .withColumn("r", F.row_number().over(Window.partitionBy("query_id", "q").orderBy("distance", "first")))
                .where(F.col("r") <= k).groupBy("query_id", "q")
                .agg(F.collect_list(F.struct("distance", "first", "ids")).alias("now")))
        reach = len(cut) * (s + 1) - 1
        sure = F.aggregate(F.filter("found", lambda f: f["distance"] <= reach), F.lit(0), lambda a, f: a + F.size(f["ids"]))
        after = written(state.drop("found").join(best, ["query_id", "q"], "left")
                        .select("query_id", "q", "need", F.coalesce("now", F.array().cast(FOUND)).alias("found"))
                        .withColumn("done", sure >= F.col("need")), "search-state")
        closed.append(after.where("done").select("query_id", "found"))
        state = after.where("not done").drop("done")
    every = reduce(lambda a, b: a.unionByName(b), [*closed, state.select("query_id", "found")])
    rows = (every.select("query_id", F.explode("found").alias("f"))
            .select("query_id", "f.distance", F.explode("f.ids").alias("vec_id")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "vec_id", F.col("distance").cast("long").alias("distance"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest other codes of every row whose id is divisible by 100."""
    codes = written(sign_codes(table(spark, sf_dir, "embeddings")), "sign-codes")
    return top_k(codes, codes.where(F.col("vec_id") % QUERY_EVERY == 0), K)


ORACLE_SQL = """
WITH c AS (
  SELECT DISTINCT vec_id,
         CAST(list_aggregate(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), 'string_agg', '') AS BIT) AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
d AS (
  SELECT q.vec_id AS query_id, b.vec_id, CAST(bit_count(xor(q.code, b.code)) AS BIGINT) AS distance
  FROM c q JOIN c b ON q.vec_id % 100 = 0 AND b.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
