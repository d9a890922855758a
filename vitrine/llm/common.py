"""Helpers shared by the training-data operators: table access, written intermediates,
text batches for Arrow functions, and distributed connected components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import fresh_dir

#: Words are maximal runs of bytes outside this class; it equals what bytes.split() strips.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: later stages and
    retried tasks read the files, so no lineage (and no executor) is needed again."""
    spark = df.sparkSession
    path = fresh_dir(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(col: str, mod: int) -> Column:
    """crc32(value as text) mod ``mod``; null stays null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(mod)


def slices(batches: Iterator[pa.RecordBatch], text_col: str, max_bytes: int = 4 << 20
           ) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds at most ``max_bytes`` of text, or one row
    when that row alone is longer. Bounds a task's Python memory whatever the row sizes."""
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lens)
        lo = 0
        while lo < n:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


_HELD: dict[str, Callable[[], None]] = {}
_OWNER: list[str] = []


def claim(owner: str, release: Callable[[], None] | None = None) -> None:
    """Called by an operator's code in a Python worker: workers outlive stages, so what other
    operators keep there goes now; ``release`` drops what this one is about to keep."""
    for other in [o for o in _HELD if o != owner]:
        _HELD.pop(other)()
    if release is not None:
        _HELD[owner] = release
    if _OWNER != [owner]:
        _OWNER[:] = [owner]
        trim()


def trim() -> None:
    """Hand what this process has freed back to the system, which its allocators would keep."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


class Generations:
    """A cache of one Python worker, bounded in bytes. Entries live in a young generation; when
    it is full it becomes the old one, and what is not asked for during a whole generation goes.
    Common entries so stay while rare ones pass through."""

    #: Bytes an entry takes besides its key and value.
    ENTRY = 200

    def __init__(self, room: int):
        self.room, self.used = room // 2, 0
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: Iterable) -> list:
        """The keys that are in neither generation; the others are in the young one after this."""
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                v = old.get(k)
                if v is None:
                    out.append(k)
                else:
                    self.put(k, v)
        return out

    def put(self, key, value) -> None:
        self.young[key] = value
        self.used += self.ENTRY + len(key) + len(value)

    def turn(self) -> None:
        """Between two slices: let the old generation go when the young one is full."""
        if self.used > self.room:
            self.old, self.young, self.used = self.young, {}, 0


def connected_components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """Components of the undirected graph ``edges(a, b)`` (longs, a <> b): rows
    ``(node, root)`` with root = the smallest node, for every node except the roots.

    Alternating large-star and small-star rounds: a node only ever asks for the minimum of its
    neighbours, which Spark combines before the shuffle, and no neighbour list is collected.
    Every round is written to the shared folder. Stops when a round changes nothing.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), label)
    mark = _mark(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = written(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(least.select("u", F.col("m").alias("v")))
                    .where("u <> v").distinct(), label)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(e: DataFrame) -> tuple:
    """Count and order-free hash of an edge set: equal marks mean a settled round."""
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return (r["n"], r["x"])
