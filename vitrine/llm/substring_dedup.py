"""Removal of word windows that repeat across documents, behind a count-min prefilter.

1. Every partition hashes its windows into a count-min sketch. The sketch key of a window is
   its minimizer (the least hash among the shorter word runs inside the window), counted once
   per document: equal windows have equal minimizers, so the count of a window's key is never
   below the number of documents that hold the window, and neighbouring windows share one key.
   Partition sketches are merged cell by cell into saturating counters.
2. A second pass keeps only the windows whose every sketch row says "two or more", as runs of
   neighbouring windows. Equal runs (copies, shared passages) are grouped first: every holder
   but the one with the smallest doc_id loses the run. One holder of each distinct run then
   sends its windows, which are grouped exactly by their hashes: the smallest doc_id of each
   window, joined back to the runs of larger ids. A window that the sketch overestimates just
   forms a group of one.
3. Documents meet their covered positions and lose the words there.

The sketch has a fixed size chosen from the input's size (``MAX_CELLS`` at most, 1 bit per cell
once merged); past that it only prefilters less, and the result stays exact.

Defined results: words are judged on the input; null or empty texts have no words (hash of the
empty string); documents shorter than a window lose nothing; rows that repeat a doc_id never
cover each other and are cleaned alike; a null doc_id counts as larger than every other and
null ids never cover each other; an empty table gives an empty result; columns beside the id
and the text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import claim, SPACE_CLASS, slices, table, written

WINDOW = 50
#: Words of the runs among which a window's minimizer is chosen.
RUN = 38
DEPTH = 2
#: Windows in one run row; longer runs are cut at multiples of it from their start.
RUN_WINDOWS = 4096
#: Cells of the bitmap of documents that lose words (a fixed 4 MB).
LOST_CELLS = 1 << 25
CLEANED = ["doc_id", "n_words", "n_removed", "kept", "rest"]
MIN_CELLS, MAX_CELLS = 1 << 18, 1 << 28
#: Cells of one row that are merged together; also the unit of the broadcast.
CHUNK = 1 << 16
#: Word hashes kept per Python worker; a full cache is dropped.
CACHE_WORDS = 150_000
#: Text bytes handled at a time by one task, and keys counted at a time.
SLICE, KEYS = 1 << 20, 1_000_000

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_ROWS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


_HASHES = _WordHashes()
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _forget() -> None:
    _HASHES.clear()
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64 (at least n of each)."""
    if len(_POWERS[0]) < n:
        inverse = pow(_ODD, -1, 1 << 64)
        for k, m in enumerate((_ODD, inverse)):
            steps = np.full(max(n, 1 << 18), m, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _run_hashes(prefix: np.ndarray, inverse: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, from prefix sums of a polynomial modulo 2**64."""
    return _mixed((prefix[size:] - prefix[:-size]) * inverse[:len(prefix) - size])


def _sliding_min(a: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while span * 2 <= size:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[:len(a) - (size - span)], a[size - span:]) if size > span else a


def split_words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def slice_windows(words: list[list[bytes]], window: int, run: int):
    """(document index, start, window hash, minimizer, place) of all windows of a slice of
    documents, and a function from places and ends to the hash of the words between them."""
    size = np.array([len(w) for w in words], np.int64)
    total = int(size.sum())
    if not total or size.max() < window:
        z = np.zeros(0, np.uint64)
        none = np.zeros(0, np.int64)
        return (none, none, z, z, none), None
    h = np.fromiter((x for w in words for x in map(_HASHES.__getitem__, w)), np.uint64, total)
    power, inverse = _powers(total + 1)
    prefix = np.zeros(total + 1, np.uint64)
    np.cumsum(h * power[:total], out=prefix[1:])
    whole = _run_hashes(prefix, inverse, window)
    least = _sliding_min(_run_hashes(prefix, inverse, run), window - run + 1)
    first = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(words)), size)
    start = np.arange(total) - first[doc]
    ok = np.flatnonzero(start[:len(whole)] + window <= size[doc[:len(whole)]])
    return (doc[ok], start[ok], whole[ok], least[ok], ok), lambda a, b: _mixed((prefix[b] - prefix[a]) * inverse[a])


def _cells(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    return ((keys * np.uint64(_ROWS[row])) >> np.uint64(20)) & np.uint64(cells - 1)


def sketch_cells(total_bytes: int, window: int = WINDOW, run: int = RUN) -> int:
    """Cells per row: four for each expected key (about six bytes a word), a power of two."""
    keys = total_bytes / 6 * 2 / (window - run + 2)
    cells = 1 << max(0, int(4 * keys)).bit_length()
    return min(MAX_CELLS, max(MIN_CELLS, cells))


def window_sketch(src: DataFrame, cells: int, window: int, run: int, depth: int) -> DataFrame:
    """Merged sketch as (chunk, bits): chunk = row * (cells / CHUNK) + part, one bit per cell,
    set where the cell counted two documents or more. ``src``: rid, text."""
    per_row = cells // CHUNK

    def count(batches):
        claim("substring_dedup", _forget)
        held: list[np.ndarray] = []
        for b in slices(batches, "text", SLICE):
            (doc, _, _, key, _), _ = slice_windows([split_words(x) for x in b.column("text").to_pylist()], window, run)
            if not len(key):
                continue
            # once per document: neighbours mostly share a key, so drop runs, then sort per document
            keep = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
            doc, key = doc[keep], key[keep]
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            held.append(key[np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]])
            if sum(map(len, held)) > KEYS:
                yield from flush(held)
                held = []
        yield from flush(held)

    def flush(held):
        if not held:
            return
        keys = np.concatenate(held)
        for row in range(depth):
            cell, n = np.unique(_cells(keys, row, cells), return_counts=True)
            part = (cell // CHUNK).astype(np.int64)
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[first[1:], len(part)]
            low, n = (cell % CHUNK).astype("<u2"), np.minimum(n, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                pa.array(row * per_row + part[first]),
                pa.array([low[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                pa.array([n[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
                names=["chunk", "cell", "n"])

    def merge(batches):
        # rows come sorted by chunk: one dense counter array at a time
        chunk, total = None, np.zeros(CHUNK, np.int64)
        for b in batches:
            for c, cell, n in zip(*(b.column(x).to_pylist() for x in ("chunk", "cell", "n"))):
                if c != chunk:
                    if chunk is not None:
                        yield bits(chunk, total)
                    chunk = c
                    total[:] = 0
                total[np.frombuffer(cell, "<u2")] += np.frombuffer(n, np.uint8)
        if chunk is not None:
            yield bits(chunk, total)

    def bits(chunk, total):
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], names=["chunk", "bits"])

    return (src.select("text").mapInArrow(count, "chunk long, cell binary, n binary")
            .repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk long, bits binary"))


RUNS = "rh long, h0 long, n int, rid long, doc_id long, start int, h array<long>, key array<long>"


def candidate_runs(src: DataFrame, cells: int, bits, window: int, run: int, depth: int) -> DataFrame:
    """Runs of neighbouring windows that every sketch row calls repeated: hash of the run's
    words, of its first window, number of windows, place, and the windows' hashes."""
    per_row = cells // CHUNK

    def pick(batches):
        table_bits = np.frombuffer(bits.value, np.uint8)
        for b in slices(batches, "text", SLICE):
            (doc, pos, whole, key, place), between = slice_windows(
                [split_words(x) for x in b.column("text").to_pylist()], window, run)
            keep = np.ones(len(key), bool)
            for row in range(depth):
                at = _cells(key, row, cells).astype(np.int64) + row * per_row * CHUNK
                keep &= (table_bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            doc, pos, whole, key, place = (x[keep] for x in (doc, pos, whole, key, place))
            if not len(doc):
                continue
            new = np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)]
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            first = np.flatnonzero((np.arange(len(doc)) - head) % RUN_WINDOWS == 0)
            ends = np.r_[first[1:], len(doc)]
            offsets = pa.array(np.r_[first, len(doc)].astype(np.int32))
            at = pa.array(doc[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(between(place[first], place[ends - 1] + window).view(np.int64)), pa.array(whole[first].view(np.int64)),
                 pa.array((ends - first).astype(np.int32)), b.column("rid").take(at), b.column("doc_id").take(at),
                 pa.array(pos[first].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(whole.view(np.int64))),
                 pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64)))],
                names=["rh", "h0", "n", "rid", "doc_id", "start", "h", "key"])

    return src.mapInArrow(pick, RUNS)


def row_key(text: Column) -> Column:
    """Tells rows that repeat a doc_id with different texts apart."""
    return F.xxhash64(text)


def covered_starts(docs: DataFrame, window: int = WINDOW, run: int = RUN, depth: int = DEPTH) -> DataFrame:
    """(doc_id, rid, starts): where windows start that a smaller doc_id also holds.
    ``docs``: doc_id, text, rid."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = sketch_cells(size, window, run)
    per_row = cells // CHUNK
    dense = bytearray(cells * depth // 8)
    for r in window_sketch(docs, cells, window, run, depth).toLocalIterator(prefetchPartitions=True):
        dense[r["chunk"] * CHUNK // 8:(r["chunk"] + 1) * CHUNK // 8] = r["bits"]
    assert len(dense) == depth * per_row * CHUNK // 8
    bits = spark.sparkContext.broadcast(bytes(dense))  # at most DEPTH * MAX_CELLS / 8 bytes
    runs = written(candidate_runs(docs, cells, bits, window, run, depth), "repeated-runs")
    bits.destroy()  # the runs are written; nothing reads the sketch again
    name = ["rh", "h0", "n"]
    # each distinct run, with the smallest doc_id that holds it (null if it has none)
    holders = runs.groupBy(*name).agg(F.min("doc_id").alias("least"))
    distinct = runs.groupBy(*name).agg(F.min("doc_id").alias("least"), F.first("h").alias("h"), F.first("key").alias("key"))
    windows = (distinct.select(*name, "least", F.posexplode(F.arrays_zip("h", "key")).alias("at", "w"))
               .select(*name, "least", "at", "w.h", "w.key"))
    # written, so that both sides of the join below are shuffled for it alone and Spark can split
    # the windows of a very common passage over several tasks
    starts = written(windows.groupBy("h", "key").agg(F.min("least").alias("first_id"), F.count(F.lit(1)).alias("k"))
                     .where("k > 1").select("h", "key", "first_id"), "repeated-windows")
    covered = (windows.join(starts, ["h", "key"]).where("first_id < least or (least is null and first_id is not null)")
               .groupBy(*name).agg(F.collect_set("at").alias("covered")))
    # a holder of the smallest id loses the covered windows, any other holder the whole run
    places = runs.select(*name, "rid", "doc_id", "start")
    lost = (places.join(holders, name).join(covered, name, "left")
            .withColumn("whole", F.expr("not (doc_id <=> least)")).where("whole or covered is not null"))
    # a set: rows that repeat an id and a text name the same places, which one document bounds
    return lost.groupBy("doc_id", "rid").agg(F.collect_set(F.struct(
        "start", F.when(F.col("whole"), F.col("n")).otherwise(0).alias("n"),
        F.when(~F.col("whole"), F.col("covered")).alias("covered"))).alias("starts"))


def kept_mask(n: int, lost: list[dict], window: int) -> np.ndarray:
    """Which of n words no covered window reaches. ``lost``: whole runs (start, n windows) or
    covered windows relative to a start."""
    edge = np.zeros(n + 1, np.int64)
    for x in lost:
        if x["n"]:
            edge[x["start"]] += 1
            edge[x["start"] + x["n"] - 1 + window] -= 1
        else:
            at = np.array(x["covered"], np.int64) + x["start"]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:n]) == 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, depth: int = DEPTH,
                   id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the kept words of every document, joined by one
    space; a document that loses nothing keeps its text as it was (``kept`` null if null).
    With ``carry`` those columns of the document follow in the struct ``rest``."""
    rest = F.struct(*carry) if carry else F.lit(None).cast("int")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), rest.alias("rest"))
    kind = src.schema["rest"].dataType.simpleString()
    src = src.withColumn("rid", row_key(F.col("text")))
    lost = written(covered_starts(src.drop("rest"), window, run, depth), "lost-windows")
    src = src.withColumn("cell", F.xxhash64("doc_id", "rid").bitwiseAND(F.lit(LOST_CELLS - 1)))
    bits = src.sparkSession.sparkContext.broadcast(lost_cells(lost))  # LOST_CELLS / 8 bytes

    def meets(b):
        cell = b.column("cell").to_numpy()
        return (np.frombuffer(bits.value, np.uint8)[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)

    # slices are filtered one by one: a filter copies what it keeps
    def untouched(batches):
        claim("substring_dedup words")
        for b in slices(batches, "text", SLICE):
            s = b.filter(pa.array(~meets(b)))
            n = [len(split_words(x)) for x in s.column("text").to_pylist()]
            if n:
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.zeros(len(n), np.int64)), s.column("text"), s.column("rest")],
                    names=CLEANED)

    def suspects(batches):
        claim("substring_dedup words")
        for b in slices(batches, "text", SLICE):
            s = b.filter(pa.array(meets(b)))
            if s.num_rows:
                yield s.select(["doc_id", "rid", "text", "rest"])

    def clean(batches):
        claim("substring_dedup words")
        for b in slices(batches, "text", SLICE):
            n, gone, kept = [], [], []
            for text, at in zip(b.column("text").to_pylist(), b.column("starts").to_pylist()):
                words = split_words(text)
                n.append(len(words))
                if at:
                    keep = kept_mask(len(words), at, window)
                    text = b" ".join([words[k] for k in np.flatnonzero(keep).tolist()]).decode()
                    gone.append(int(len(words) - keep.sum()))
                else:
                    gone.append(0)
                kept.append(text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.string()), b.column("rest")], names=CLEANED)

    shape = f"doc_id long, n_words long, n_removed long, kept string, rest {kind}"
    named = lost.select(F.col("doc_id").alias("s_id"), F.col("rid").alias("s_rid"), "starts")
    both = src.mapInArrow(suspects, f"doc_id long, rid long, text string, rest {kind}").join(
        named.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("rid") == F.col("s_rid")), "left")
    out = src.mapInArrow(untouched, shape).unionByName(both.select("doc_id", "text", "starts", "rest").mapInArrow(clean, shape))
    return out if carry else out.drop("rest")


def lost_cells(lost: DataFrame) -> bytes:
    """One bit per hash cell of the documents that lose words: documents in other cells need
    not be shuffled to learn that they keep everything."""
    cell = F.xxhash64("doc_id", "rid").bitwiseAND(F.lit(LOST_CELLS - 1))
    part = 1 << 15  # bits of one bitmap value
    dense = bytearray(LOST_CELLS // 8)
    for r in (lost.select((cell / F.lit(part)).cast("long").alias("part"), (cell % F.lit(part)).alias("bit"))
              .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator()):
        dense[r["part"] * part // 8:(r["part"] + 1) * part // 8] = r["bits"]
    return bytes(dense)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of what each document keeps; the hash is over the words joined by one space."""
    words = F.trim(F.regexp_replace(F.coalesce("kept", F.lit("")), SPACE_CLASS + "+", " "))
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT s, min(doc_id) AS least FROM x GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM x JOIN f USING (s) WHERE least < doc_id),
k AS (SELECT doc_id, k, word FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS word FROM w)
      ANTI JOIN c USING (doc_id, k)),
g AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS kept FROM k GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g ON g.doc_id = w.doc_id
"""
