"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. In each window of ``seq_len`` tokens a queue
may send its target share; what the whole-token rounding leaves is its deficit, carried into
the next window. Served in virtual time ``v`` (rounds of the robin), queue ``s`` with share
``p`` has sent ``floor(v * p)`` tokens, or all it has; window ``w`` ends at the least ``v`` at
which all queues together sent ``w * seq_len`` tokens, and ties at that instant go in queue
order. The state after any window (served tokens, hence deficits) so follows from ``w``
alone: every partition resumes the robin at the windows it needs, without waiting for another,
and a hot source is never gathered anywhere. Queues that run dry leave their share to the rest,
so only the last window of all is short.

Jobs: encode once and write ids with per-partition positions; one small sum per (source,
partition); cut documents into pieces from the written ids. The driver holds one total per
source (mixture components), never a document.

Defined results: a null or empty text is the end token alone; a null source is a queue of its
own; repeated rows are packed as rows of their own; a null doc_id is packed under null; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import string
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.byte_bpe import text_chunks
from vitrine.llm.common import claim, slices, table, written

SEQ_LEN = 1024
END_ID = 0
#: Bytes kept per Python worker in the cache of chunks and words, counting ``ENTRY`` bytes an
#: entry besides its key and value; a full cache is dropped.
CACHE_BYTES, ENTRY = 176 << 20, 180
#: Marks that are one match of the pattern behind a word (the apostrophe may begin another).
MARKS = string.punctuation.replace("'", "")
#: Windows solved at a time; how many such blocks a task keeps at least, and up to how many bytes of
#: them: sources that alternate in the rows may each be in a block of their own.
BLOCK, BLOCKS_HELD, BLOCKS_BYTES = 2048, 6, 32 << 20


class ByteLevelEncoder:
    """Whole-text ids of a byte-level BPE file of the tokenizers library. Texts are cut where
    the pre-tokenizer always cuts; new words go to the library's BPE model, once each."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path) as f:
            spec = json.load(f)
        self.wide = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.words = regex.compile(pattern).findall
        self.model = self.tok.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        size = np.dtype(self.wide).itemsize
        self.coded = [k.to_bytes(size, "little") for k in range(self.tok.get_vocab_size())]
        # chunks and words in one: a word that is a chunk is one match, with the same ids
        self.known: dict[str, bytes] = {}
        self.room = CACHE_BYTES

    def _keep(self, text: str, ids: bytes) -> bytes:
        self.known[text] = ids
        self.room -= ENTRY + len(text) + len(ids)
        return ids

    def _word(self, word: str) -> bytes:
        got = self.known.get(word)
        if got is None:
            if word.isascii() and word.isprintable():  # all letters of their own, but the space
                spelled = word.replace(" ", self.letters[32])
            else:
                spelled = word.encode().decode("latin-1").translate(self.letters)
            coded = self.coded
            got = self._keep(word, b"".join([coded[t.id] for t in self.model.tokenize(spelled)]))
        return got

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk that is not in the cache."""
        if "\n" in chunk:
            lines = chunk.split("\n")
            if all(x and not x[-1].isspace() for x in lines) and not any(x[0].isspace() for x in lines[1:]):
                # a line end between other characters is a match of its own
                return self._word("\n").join([self.known.get(x) or self._chunk(x) for x in lines])
        head = chunk.rstrip(MARKS)
        if head[1:].isalpha() and (head[0] == " " or head[0].isalpha()):  # one match of the pattern
            if len(head) == len(chunk):
                return self._word(chunk)
            return self._keep(chunk, self._word(head) + self._word(chunk[len(head):]))
        words = self.words(chunk)
        return self._word(chunk) if words == [chunk] else self._keep(chunk, b"".join(map(self._word, words)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of type ``wide``."""
        if not self.by_word:
            return [np.array(e.ids, self.wide).tobytes() for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        out = []
        for text in texts:
            chunks = text_chunks(text)
            if self.room < 0:
                self.known.clear()
                self.room = CACHE_BYTES
            ids = self.known
            got = list(map(ids.get, chunks))
            if None in got:
                for k, x in enumerate(got):
                    if x is None:
                        c = chunks[k]
                        got[k] = ids.get(c) or self._chunk(c)
            out.append(b"".join(got))
        return out


_ENCODERS: dict[tuple[str, str], ByteLevelEncoder] = {}


def encoder(path: str, pattern: str) -> ByteLevelEncoder:
    """One encoder per Python worker process."""
    claim("packing", _ENCODERS.clear)
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = ByteLevelEncoder(path, pattern)
    return _ENCODERS[path, pattern]


class Robin:
    """Tokens each queue has sent by the end of each window."""

    def __init__(self, totals: list[int], weights: list[float], seq_len: int):
        self.totals = np.array(totals, np.int64)
        share = np.array(weights, np.float64)
        if len(share) != len(totals) or not (share > 0).all():
            raise ValueError("every source needs a positive target")
        self.share = share / share.sum()
        self.seq_len = seq_len
        self.tokens = int(self.totals.sum())
        self.windows = -(-self.tokens // seq_len)
        self.last = float((self.totals / self.share).max()) * (1 + 1e-9) + 1 if self.windows else 0.0
        self.blocks: dict[int, np.ndarray] = {}
        self.held = max(BLOCKS_HELD, BLOCKS_BYTES // (8 * (BLOCK + 1) * max(1, len(totals))))

    def sent_at(self, v: np.ndarray) -> np.ndarray:
        return np.minimum(self.totals, np.floor(v[:, None] * self.share).astype(np.int64))

    def sent(self, windows: np.ndarray) -> np.ndarray:
        """By window count (0: nothing) and queue; rows add up to windows * seq_len exactly."""
        goal = np.minimum(windows.astype(np.int64) * self.seq_len, self.tokens)
        lo, hi = np.full(len(goal), -1.0), np.full(len(goal), self.last)
        while True:
            mid = (lo + hi) / 2
            if ((mid <= lo) | (mid >= hi)).all():
                break
            enough = self.sent_at(np.maximum(mid, 0.0)).sum(axis=1) >= goal
            hi, lo = np.where(enough, mid, hi), np.where(enough, lo, mid)
        before, after = self.sent_at(np.maximum(lo, 0.0)), self.sent_at(np.maximum(hi, 0.0))
        spare = after - before
        earlier = np.cumsum(spare, axis=1) - spare
        rest = (goal - before.sum(axis=1))[:, None]
        out = before + np.clip(rest - earlier, 0, spare)
        out[goal == 0] = 0
        return out

    def block(self, k: int) -> np.ndarray:
        """Rows for window counts k * BLOCK to (k + 1) * BLOCK, both included."""
        if k not in self.blocks:
            if len(self.blocks) >= self.held:
                self.blocks.pop(next(iter(self.blocks)))
            counts = np.arange(k * BLOCK, min((k + 1) * BLOCK, self.windows) + 1)
            self.blocks[k] = self.sent(counts)
        return self.blocks[k]

    def pieces(self, queue: int, start: int, end: int):
        """(from, to, window, offset in window) of the queue's tokens start to end."""
        out = []
        k = int(self.sent_at(np.array([start / self.share[queue]])).sum()) // self.seq_len // BLOCK
        k = min(k, (self.windows - 1) // BLOCK)
        while k and self.block(k)[0, queue] > start:
            k -= 1
        while self.block(k)[-1, queue] <= start:
            k += 1
        at = start
        while at < end:
            rows = self.block(k)
            own = rows[:, queue]
            first = int(np.searchsorted(own, at, side="right")) - 1
            stop = min(int(np.searchsorted(own, end, side="left")), len(own) - 1)
            w = np.arange(first, stop)
            w = w[own[w + 1] > own[w]]
            a, b = np.maximum(own[w], at), np.minimum(own[w + 1], end)
            ahead = (rows[w + 1, :queue] - rows[w, :queue]).sum(axis=1)
            out.append((a, b, k * BLOCK + w, ahead + a - own[w]))
            at = int(b[-1]) if len(b) else at
            k += 1
        return [np.concatenate(x) for x in zip(*out)]


def token_rows(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, cols: tuple[str, str, str]) -> DataFrame:
    """(doc_id, source, part, begin, n, ids): each row's ids with the end id, and its place in
    its source's queue among the rows of its partition."""
    def run(batches):
        enc = encoder(tokenizer, pattern)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], enc.wide).tobytes()
        width = len(end)
        queue: dict = {}
        for b in slices(batches, "text", 1 << 20):
            ids = [x + end for x in enc.encode([x or "" for x in b.column("text").to_pylist()])]
            n = [len(x) // width for x in ids]
            begin = []
            for s, k in zip(b.column("source").to_pylist(), n):
                begin.append(queue.get(s, 0))
                queue[s] = begin[-1] + k
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), pa.array([part] * len(n), pa.int32()), pa.array(begin, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "source", "part", "begin", "n", "ids"])

    id_col, text_col, source_col = cols
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(source_col).cast("string").alias("source"))
    return src.mapInArrow(run, "doc_id long, source string, part int, begin long, n long, ids binary")


PIECES = T.StructType([T.StructField(n, T.LongType()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [
    T.StructField("source", T.StringType()), T.StructField("ids", T.BinaryType())])


def pack(docs: DataFrame, tokenizer: str, pattern: str, targets: Mapping[str | None, float] | None = None,
         seq_len: int = SEQ_LEN, end_id: int = END_ID, cols: tuple[str, str, str] = ("doc_id", "text", "source"),
         with_ids: bool = True) -> DataFrame:
    """Pieces of all documents in sequences of ``seq_len`` tokens. ``targets``: relative share
    of each source; by default the sources' own shares of all tokens. ``ids`` holds a piece's
    ids as little-endian unsigned 32-bit numbers (null unless ``with_ids``)."""
    spark = docs.sparkSession
    rows = written(token_rows(docs, tokenizer, pattern, end_id, cols), "packing-ids")
    sums = rows.groupBy("source", "part").agg(F.sum("n").alias("n"))
    totals = sorted(((r["source"], r["n"]) for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()),
                    key=lambda x: (x[0] is not None, x[0] or ""))
    names, counts = [s for s, _ in totals], [n for _, n in totals]
    weights = [float(n) for n in counts] if targets is None else [float(targets[s]) for s in names]
    queues = spark.createDataFrame([(s, k) for k, s in enumerate(names)], "q_source string, queue int")
    before = "sum(n) over (partition by source order by part rows between unbounded preceding and 1 preceding)"
    base = (sums.select("source", "part", F.coalesce(F.expr(before), F.lit(0)).alias("base"))
            .join(queues, F.col("source").eqNullSafe(F.col("q_source")))
            .select(F.col("q_source"), F.col("part").alias("q_part"), "base", "queue"))
    # a row per source and partition; merged, all ids would be shuffled, and a task would get them
    # in an order that leaps between blocks of windows
    placed = (rows.join(F.broadcast(base), rows.source.eqNullSafe(base.q_source) & (rows.part == base.q_part))
              .select("doc_id", "source", "queue", (F.col("base") + F.col("begin")).alias("begin"), "n", "ids"))

    def cut(batches):
        robin = Robin(counts, weights, seq_len)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                yield from cut_rows(robin, b.slice(lo, 500))

    def cut_rows(robin, b):
        at, cols, crc, data = [], [], [], []
        for k, (queue, begin, n, ids) in enumerate(zip(*(b.column(c).to_pylist() for c in ("queue", "begin", "n", "ids")))):
            a, e, window, offset = robin.pieces(queue, begin, begin + n)
            a, e = a - begin, e - begin
            raw = memoryview(np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4").tobytes())
            at += [k] * len(a)
            cols.append((a, e - a, np.full(len(a), n), window, offset))
            cuts = list(zip((4 * a).tolist(), (4 * e).tolist()))
            crc += [zlib.crc32(raw[x:y]) for x, y in cuts]
            data += [raw[x:y].tobytes() if with_ids else None for x, y in cuts]
        start, length, n, window, offset = (np.concatenate(x) for x in zip(*cols))
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(at), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n),
             pa.array(window), pa.array(offset), b.column("source").take(at), pa.array(data, pa.binary())], names=PIECES.names)

    return placed.mapInArrow(cut, PIECES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return pack(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.PATTERN, with_ids=False).drop("ids")
