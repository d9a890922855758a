"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a perfect one-error-correcting (Hamming) code over the low
``2**order - 1`` fingerprint bits: every fingerprint is within the covering radius (1) of
exactly one anchor, its home. A fingerprint at distance ``max_bits`` or less from another is
within ``1 + max_bits`` of the other's home, so every fingerprint is replicated to all anchors
in that radius (156 for 31 bits and distance 2) and each anchor compares its home fingerprints
with everything it received. Distinct fingerprints only are replicated, so a group of copies
costs one row; an anchor returns a spanning forest of its links, never all pairs.

Defined results: null or empty texts (no words) have fingerprint zero and are linked like any
other; texts shorter than the shingle are one shingle; repeated rows give repeated result rows;
a null doc_id gets its group's id (null when the whole group has none); an empty table gives
an empty result; columns beside the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import claim, connected_components, slices, table, written

SEED = 42


def fingerprint_slice(texts: list, shingle: int) -> np.ndarray:
    """64-bit fingerprints of whole texts (uint64)."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        if len(words) <= shingle:
            hashes.append(digest(b" ".join(words), SEED))
            counts[k] = 1
            continue
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        hashes += [digest(flat[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
        counts[k] = len(starts)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.cumsum(counts[some]) - counts[some]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        packed = np.packbits(ones * 2 > counts[some][:, None], axis=1, bitorder="little")
        out[some] = np.ascontiguousarray(packed).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, fp) of every row; rid tells rows that share a doc_id apart by their text."""
    def run(batches):
        claim("simhash")
        for b in slices(batches, "text", 1 << 20):
            fp = fingerprint_slice(b.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("rid"), pa.array(fp.view(np.int64))], names=["doc_id", "rid", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.withColumn("rid", F.xxhash64("text")).mapInArrow(run, "doc_id long, rid long, fp long")


class HammingAnchors:
    """The covering code: syndromes, and for each syndrome the error patterns that lead from a
    word to all anchors within ``radius``. The pattern of least weight leads to the home."""

    def __init__(self, order: int, radius: int):
        n = (1 << order) - 1
        self.mask = np.uint64((1 << n) - 1)
        self.checks = [np.uint64(sum(1 << (p - 1) for p in range(1, n + 1) if p >> j & 1)) for j in range(order)]
        by = [[] for _ in range(n + 1)]
        for weight in range(radius + 1):
            for places in combinations(range(1, n + 1), weight):
                s = 0
                for p in places:
                    s ^= p
                by[s].append(sum(1 << (p - 1) for p in places))
        width = max(map(len, by))
        # weights 0 and 1 come first, so column 0 is the way home; short rows repeat it
        self.patterns = np.array([x + [x[0]] * (width - len(x)) for x in by], np.uint64)

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        s = np.zeros(len(words), np.int64)
        for j, check in enumerate(self.checks):
            s |= (np.bitwise_count(words & check) & 1).astype(np.int64) << j
        return s

    def replicas(self, fps: np.ndarray) -> np.ndarray:
        """Anchors by fingerprint; column 0 is the home."""
        low = fps & self.mask
        return low[:, None] ^ self.patterns[self.syndrome(low)]


def anchor_links(fps: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between an anchor's home fingerprints and all that it
    received. Breadth first: homes look at everything, the others only at homes."""
    homes = fps[home]
    fresh = np.ones(len(fps), bool)
    links = []
    for start in np.flatnonzero(home):
        if not fresh[start]:
            continue
        fresh[start] = False
        queue = [start]
        while queue:
            x = queue.pop()
            if home[x]:
                near = np.flatnonzero(fresh & (np.bitwise_count(fps ^ fps[x]) <= max_bits))
            else:
                at = np.flatnonzero(home)[np.bitwise_count(homes ^ fps[x]) <= max_bits]
                near = at[fresh[at]]
            fresh[near] = False
            links += [(x, y) for y in near]
            queue += near.tolist()
    return links


def fingerprint_links(distinct: DataFrame, max_bits: int = 2, order: int = 5) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``max_bits`` of each other.
    ``distinct``: column fp, no duplicates."""
    def deal(batches):
        code = HammingAnchors(order, 1 + max_bits)
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                fp = b.column("fp").slice(lo, 2000).to_numpy(zero_copy_only=False)
                anchors = code.replicas(fp.view(np.uint64))
                own = np.zeros(anchors.shape, bool)
                own[:, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors.ravel().view(np.int64)), pa.array(np.repeat(fp, anchors.shape[1])), pa.array(own.ravel())],
                    names=["anchor", "fp", "home"])

    def compare(batches):
        held = None
        for b in batches:
            a, f, h = (b.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "home"))
            if held is not None:
                a, f, h = (np.concatenate(x) for x in zip(held, (a, f, h)))
            if not len(a):
                continue
            cut = int(np.searchsorted(a, a[-1]))  # the last anchor may go on in the next batch
            yield from found(a[:cut], f[:cut], h[:cut])
            held = (a[cut:], f[cut:], h[cut:])
        if held is not None:
            yield from found(*held)

    def found(a, f, h):
        if not len(a):
            return
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        size = np.diff(np.r_[first, len(a)])
        some = (size > 1) & (np.add.reduceat(h.astype(np.int64), first) > 0)
        left, right = [], []
        for lo, n in zip(first[some].tolist(), size[some].tolist()):
            fp = f[lo:lo + n].view(np.uint64)
            for x, y in anchor_links(fp, h[lo:lo + n], max_bits):
                left.append(f[lo + x])
                right.append(f[lo + y])
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    # a fixed number of tasks: sized by its few input bytes, the dealing would run in one or two
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.select("fp").repartition(tasks, "fp").mapInArrow(deal, "anchor long, fp long, home boolean")
    near = dealt.repartition("anchor").sortWithinPartitions("anchor")
    return near.mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2, order: int = 5,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint hex, component_id, rid) of every row: the smallest doc_id reachable
    over links between fingerprints that differ in at most ``max_bits`` bits."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    groups = connected_components(fingerprint_links(distinct, max_bits, order), "simhash-components")
    rooted = distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "rid")


def one_of_each_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each group the row with its component's
    id, once if that id is repeated. Groups without any id stay whole: nothing names them."""
    stay = (groups.where("doc_id <=> component_id").groupBy("component_id", "rid").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("rid")).alias("of"))
            .agg(F.min("rid").alias("k_rid"), F.sum("n").alias("k_n")).select(F.col("component_id").alias("k_id"), "k_rid", "k_n"))
    named = docs.withColumn("k_text", F.xxhash64(F.col(text_col).cast("string")))
    kept = named.join(stay.hint("shuffle_hash"), F.col(id_col).cast("long").eqNullSafe(F.col("k_id")) & (F.col("k_text") == F.col("k_rid")))
    alone = F.col("k_id").isNull() | (F.col("k_n") == 1)
    return kept.where(alone).unionByName(kept.where(~alone).dropDuplicates(["k_id"])).select(*docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
