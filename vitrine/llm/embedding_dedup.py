"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised; cosine ``c`` is then the distance ``sqrt(2 - 2c)``. Each of ``tables``
hash tables quantises ``projections`` Gaussian projections with a random shift into cells of
``width``, and the cells of one table name a bucket. Vectors that share a bucket are compared
by their exact cosine in double precision. A pair is counted only in the first table in which
its vectors meet, so link counts need no list of pairs; each bucket returns a count per vector
and a spanning forest of its links. Equal vectors are grouped first and travel as one row.
Buckets above ``block`` vectors are cut into blocks, and every pair of blocks is its own group.

With the defaults a pair at cosine 0.95 meets with probability 0.95, one at 0.98 with 0.999.

Defined results: a vector that is null, empty, zero, or holds a null, NaN or infinite component
links with nothing and is its own component; vectors of different lengths never link; repeated
rows are vectors of their own that link to each other; a null vec_id takes part in links, and
its component is the smallest id that is not null (null if there is none); an empty table gives
an empty result; columns beside the id and the vector are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import connected_components, table, written

THRESHOLD = 0.95
TABLES, PROJECTIONS, WIDTH, SEED = 24, 16, 2.0, 20240
BLOCK = 2048


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long, null-free lists as a 2-d double array."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest component first avoids overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def signatures(x: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """Bucket names (int64) by vector and table."""
    rng = np.random.default_rng([seed, x.shape[1]])
    a = rng.standard_normal((tables * projections, x.shape[1]))
    shift = rng.random(tables * projections) * width
    # einsum keeps the order of additions fixed whatever the batch; a matrix product does not
    cells = np.floor((np.einsum("ij,kj->ik", x, a) + shift) / width).astype(np.int64)
    cells = cells.reshape(len(x), tables, projections).astype(np.uint64)
    odd = rng.integers(1, 2**63, projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = (cells * odd).sum(axis=2, dtype=np.uint64)
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def bucket_links(x: np.ndarray, sigs: np.ndarray, copies: np.ndarray, side: np.ndarray, t: int,
                 threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weighted link counts and a spanning forest of one bucket of table ``t``. ``side``: -1
    compares all vectors with each other, 0 and 1 compare the two sides only."""
    n = len(x)
    counts = np.zeros(n, np.int64)
    seen = np.arange(n)  # forest by label propagation over linked rows
    links: list[tuple[int, int]] = []

    def find(k):
        while seen[k] != k:
            seen[k] = seen[seen[k]]
            k = seen[k]
        return k

    left = np.arange(n) if side[0] < 0 else np.flatnonzero(side == 0)
    right = np.arange(n) if side[0] < 0 else np.flatnonzero(side == 1)
    for lo in range(0, len(left), 256):
        rows = left[lo:lo + 256]
        i, j = np.nonzero(x[rows] @ x[right].T >= threshold - 1e-9)
        i, j = rows[i], right[j]
        ok = i < j if side[0] < 0 else np.ones(len(i), bool)
        i, j = i[ok], j[ok]
        for a in range(0, len(i), 50_000):
            p, q = i[a:a + 50_000], j[a:a + 50_000]
            fresh = ~(sigs[p, :t] == sigs[q, :t]).any(axis=1)
            p, q = p[fresh], q[fresh]
            exact = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
            p, q = p[exact], q[exact]
            np.add.at(counts, p, copies[q])
            np.add.at(counts, q, copies[p])
            for u, v in zip(p.tolist(), q.tolist()):
                ru, rv = find(u), find(v)
                if ru != rv:
                    seen[max(ru, rv)] = min(ru, rv)
                    links.append((u, v))
    return counts, links


def embedding_groups(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES,
                     projections: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED,
                     block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("vec"))
    sound = (F.col("vec").isNotNull() & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
             & F.exists("vec", lambda v: v != 0.0))
    good = F.coalesce(sound, F.lit(False))
    rows = src.withColumn("good", good).withColumn("vec", F.transform("vec", lambda v: v + F.lit(0.0)))  # -0.0 is 0.0
    distinct = written(rows.where("good").groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                       .withColumn("k", F.monotonically_increasing_id()), "distinct-vectors")

    def hash_rows(batches):
        for b in batches:
            size = np.diff(b.column("vec").offsets.to_numpy())
            for n in np.unique(size):
                own = b.take(pa.array(np.flatnonzero(size == n)))
                for lo in range(0, own.num_rows, 500):
                    part = own.slice(lo, 500)
                    x = unit(_matrix(part.column("vec")))
                    sig = signatures(x, tables, projections, width, seed)
                    m = len(x)
                    take = pa.array(np.repeat(np.arange(m), tables))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), m)), pa.array(sig.ravel()),
                        part.column("k").take(take), part.column("copies").take(take), part.column("vec").take(take)],
                        names=["t", "bucket", "k", "copies", "vec"])

    dealt = distinct.select("k", "copies", "vec").mapInArrow(hash_rows, "t int, bucket long, k long, copies long, vec array<double>")
    dealt = dealt.withColumn("dims", F.size("vec"))
    place = ["t", "bucket", "dims"]
    sizes = dealt.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunked = (dealt.join(sizes, place)
               .withColumn("m", F.ceil(F.col("n") / F.lit(block)).cast("int"))
               .withColumn("own", F.pmod(F.xxhash64("k"), F.col("m")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
               .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
    keys = [*place, "lo", "hi"]

    def compare(batches):
        held = None
        for b in batches:
            b = pa.Table.from_batches([b])
            if held is not None:
                b = pa.concat_tables([held, b])
            names = np.stack([b.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            first = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(axis=1)])
            for lo, hi in zip(first[:-1], first[1:]):
                yield from one(b.slice(lo, hi - lo))
            held = b.slice(first[-1]).combine_chunks()
        if held is not None:
            yield from one(held)

    def one(g):
        if g.num_rows < 2:
            return
        x = unit(_matrix(g.column("vec").combine_chunks()))
        k, copies = g.column("k").to_numpy(), g.column("copies").to_numpy()
        lo, hi = g.column("lo")[0].as_py(), g.column("hi")[0].as_py()
        own = g.column("own").to_numpy()
        side = np.full(len(x), -1) if lo == hi else (own == hi).astype(int)
        t = g.column("t")[0].as_py()
        counts, links = bucket_links(x, signatures(x, tables, projections, width, seed)[:, :t], copies, side, t, threshold)
        some = np.flatnonzero(counts)
        if len(some):
            yield batch(k[some], None, counts[some])
        if links:
            u, v = np.array(links).T
            yield batch(k[u], k[v], np.zeros(len(u), np.int64))

    def batch(a, b, n):
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])

    found = written(chunked.select(*keys, "own", "k", "copies", "vec").repartition(*keys).sortWithinPartitions(*keys)
                    .mapInArrow(compare, "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("others"))
    groups = connected_components(found.where("b is not null").select("a", "b"), "vector-components")
    rooted = (distinct.join(groups, distinct.k == groups.node, "left").join(counts, "k", "left")
              .select("vec", "first_id", F.coalesce("root", "k").alias("root"),
                      (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_vec = rooted.join(least, "root").select("vec", "n_links", "component_id")
    linked = rows.where("good").select("vec_id", "vec").join(by_vec, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


#: All pairs by exact cosine, then the smallest id that links reach.
ORACLE_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
         embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS sound
  FROM embeddings),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.sound AND b.sound AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, CAST(coalesce(links.n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN links ON links.a = v.vec_id
"""
