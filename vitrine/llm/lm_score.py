"""Document log-likelihood by a gated recurrent language model with class-factored output.

``P(word | history) = P(class | state) * P(member | class, state)``: two softmax layers over the
state. A class is the document end, one of the heaviest two-letter word endings, or the rest; its
members are its most frequent words and one tail for all its other words, which share the tail's
probability by their exact counts in all learning documents. The tail also holds one unknown
word, so the probabilities of all words add up to one. The state comes from a gated recurrent
network over members, learned by truncated backpropagation in numpy. Scoring carries the state
through the whole document, window after window.

Spark's part: documents are packed into blocks of bounded text, written once. Every block sends
its distinct words, dealt by hash into shards; a shard adds up each word's counts over all
blocks and answers every block with totals in the order in which it asked, so the vocabulary is
never broadcast or collected. Blocks learn from the same start on all their learning
documents and their parameters are averaged by Spark, round after round; the driver
holds one parameter vector and the class tables, whose size the constants bound.

Defined results: a null or empty text is the end token alone; a null doc_id counts as held out;
repeated rows give repeated result rows and are counted as often as they occur; with nothing to
learn from every word is unknown; words of equal count are members in the order of their bytes;
a very long text is a block of its own and scored whole; an empty table gives an empty result;
columns beside the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import slices, table, written

FOLDS = 10
SMOOTHING = 0.1
#: Text bytes in a block (a longer document is a block of its own), and text bytes per shard.
BLOCK_BYTES, SHARD_BYTES = 6 << 20, 48 << 20
#: Classes (end, rest, endings), and members of a class (its tail, then words).
CLASSES, MEMBERS = 64, 32
END, REST, TAIL = 0, 1, 0
HIDDEN, LANES, STEPS = 16, 512, 16
#: Learning rounds.
ROUNDS, RATE, SEED = 1, 0.03, 7
#: A member that a class does not have.
NEVER = -1e9
HIGHEST = 60.0
#: Steps between which the scorer sums up (the state goes on), documents side by side, rows of a softmax.
SCORE_STEPS, SCORE_DOCS, SCORE_ROWS = 64, 512, 4096


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


# --- blocks -----------------------------------------------------------------------------------

BLOCKS = "block long, doc_id array<long>, size array<int>, data binary"


def blocks(docs: DataFrame) -> DataFrame:
    """Documents packed in blocks: ids, text sizes and compressed texts."""
    import zstandard

    def run(batches):
        part = TaskContext.get().partitionId()
        for k, b in enumerate(slices(batches, "text", BLOCK_BYTES)):
            texts = [(x or "").encode() for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k]), pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([[len(x) for x in texts]], pa.list_(pa.int32())),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], pa.binary())],
                names=["block", "doc_id", "size", "data"])

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def unpacked(batches):
    """(block, doc_ids, texts, row) of every block row."""
    import zstandard

    for b in batches:
        for k in range(b.num_rows):
            row = b.slice(k, 1)
            sizes = row.column("size")[0].as_py()
            data = zstandard.ZstdDecompressor().decompress(row.column("data")[0].as_py(), max_output_size=sum(sizes) + 1)
            ends = np.cumsum(sizes).tolist()
            yield row.column("block")[0].as_py(), row.column("doc_id")[0].as_py(), [data[e - n:e] for e, n in zip(ends, sizes)], row


def shards_of(words: list[bytes], shards: int) -> list[list[bytes]]:
    """The words dealt by hash, each shard in order: a block asks and reads answers alike."""
    import xxhash

    out: list[list[bytes]] = [[] for _ in range(shards)]
    for w in sorted(words):
        out[xxhash.xxh64_intdigest(w, 3) % shards].append(w)
    return out


def word_requests(packed: DataFrame, shards: int) -> DataFrame:
    """(shard, block, words, counts): a block's distinct words with their counts in learning documents."""
    def run(batches):
        for block, ids, texts, _ in unpacked(batches):
            counts: Counter = Counter()
            every: set = set()
            for i, text in zip(ids, texts):
                words = words_of(text)
                if is_held_out(i):
                    every.update(words)
                else:
                    counts.update(words)
            every.update(counts)
            asked = [(s, w) for s, w in enumerate(shards_of(list(every), shards)) if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in asked], pa.int32()), pa.array([block] * len(asked), pa.int64()),
                 pa.array([zlib.compress(b"\n".join(w), 1) for _, w in asked], pa.binary()),
                 pa.array([np.array([counts[x] for x in w], "<i4").tobytes() for _, w in asked], pa.binary())],
                names=["shard", "block", "words", "counts"])

    return packed.mapInArrow(run, "shard int, block long, words binary, counts binary")


def word_totals(requests: DataFrame) -> DataFrame:
    """(shard, block, words, totals): an answer per request (words null), and one row per shard
    (block null) with its whole vocabulary."""
    def run(batches):
        shard, held = None, []
        for b in batches:
            for k in range(b.num_rows):
                s = b.column("shard")[k].as_py()
                if s != shard and held:
                    yield from answer(shard, held)
                    held = []
                shard = s
                held.append(tuple(b.column(c)[k].as_py() for c in ("block", "words", "counts")))
        if held:
            yield from answer(shard, held)

    def answer(shard, held):
        total: dict[bytes, int] = {}
        for _, words, counts in held:
            for w, n in zip(zlib.decompress(words).split(b"\n"), np.frombuffer(counts, "<i4").tolist()):
                total[w] = total.get(w, 0) + n
        for block, words, _ in held:
            yield row(shard, block, None, [total[w] for w in zlib.decompress(words).split(b"\n")])
        known = [w for w, n in total.items() if n]
        yield row(shard, None, zlib.compress(b"\n".join(known), 1), [total[w] for w in known])

    def row(shard, block, words, totals):
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([block], pa.int64()), pa.array([words], pa.binary()),
             pa.array([np.array(totals, "<i8").tobytes()], pa.binary())], names=["shard", "block", "words", "totals"])

    return (requests.repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(run, "shard int, block long, words binary, totals binary"))


# --- classes ----------------------------------------------------------------------------------

def ending(word: bytes) -> bytes:
    """The last two characters of a word, or all of it."""
    return word.decode(errors="replace")[-2:].encode()


@dataclass
class Classes:
    """Class and member tables. A member's id is class * MEMBERS + place, the tail's place is 0.
    By class: the learning tokens of every member, and the distinct learning words of the tail."""

    endings: dict[bytes, int]
    words: dict[bytes, int]
    tokens: np.ndarray
    types: np.ndarray

    def class_of(self, word: bytes) -> int:
        return self.endings.get(ending(word), REST)

    def of(self, word: bytes) -> int:
        k = self.words.get(word)
        return k if k is not None else self.class_of(word) * MEMBERS + TAIL

    def inside(self, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 P(word | member): the share of a word in its tail, 1 for the others."""
        c = ids // MEMBERS
        share = np.log10((counts + SMOOTHING) / (self.tokens[c, TAIL] + SMOOTHING * (self.types[c] + 1)))
        return np.where((ids % MEMBERS == TAIL) & (c != END), share, 0.0)

    def start(self) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of the classes, and of the members within each class."""
        total = self.tokens.sum(axis=1)
        of_class = np.log((total + SMOOTHING) / (total + SMOOTHING).sum())
        there = self.tokens > 0
        there[:, TAIL] = True
        n = np.where(there, self.tokens + SMOOTHING, 1)
        return of_class, np.where(there, np.log(n / (n * there).sum(axis=1, keepdims=True)), NEVER)


def vocabulary(totals: DataFrame, measure, shape: str) -> DataFrame:
    """``measure``(words, counts) -> columns, of every shard's vocabulary."""
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                words = zlib.decompress(b.column("words")[k].as_py()).split(b"\n")
                n = np.frombuffer(b.column("totals")[k].as_py(), "<i8")
                if len(n):
                    yield pa.RecordBatch.from_pydict(measure(words, n))

    return totals.where("block is null").mapInArrow(run, shape)


def learn_classes(totals: DataFrame, documents: int) -> Classes:
    """Class tables from all learning words. ``documents``: learning documents (end tokens)."""
    def heavy(words, n):
        by: Counter = Counter()
        for w, c in zip(words, n.tolist()):
            by[ending(w)] += c
        return {"key": list(by), "n": list(by.values())}

    sums = vocabulary(totals, heavy, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.desc("n"), "key").limit(CLASSES - 2).collect()
    classes = Classes({bytes(r["key"]): 2 + k for k, r in enumerate(top)}, {}, np.zeros((CLASSES, MEMBERS)), np.zeros(CLASSES))

    def members(words, n):
        """The most frequent words of every class in a shard, and what its classes hold in all (key null)."""
        c = np.array([classes.class_of(w) for w in words])
        order = sorted(range(len(words)), key=lambda k: (c[k], -n[k], words[k]))
        place = np.arange(len(order)) - np.searchsorted(c[order], c[order])
        kept = [k for k, at in zip(order, place.tolist()) if at < MEMBERS - 1]
        return {"class": c[kept].tolist() + list(range(CLASSES)), "key": [words[k] for k in kept] + [None] * CLASSES,
                "n": n[kept].tolist() + np.bincount(c, n, CLASSES).astype(int).tolist(),
                "types": [1] * len(kept) + np.bincount(c, minlength=CLASSES).tolist()}

    found = written(vocabulary(totals, members, "class long, key binary, n long, types long"), "lm-members")
    for r in found.where("key is null").groupBy("class").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).collect():
        classes.tokens[r["class"], TAIL], classes.types[r["class"]] = r["n"], r["types"]
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("n"), "key"))
    for r in found.where("key is not null").withColumn("place", rank).where(F.col("place") < MEMBERS).collect():
        c = r["class"]
        classes.words[bytes(r["key"])] = c * MEMBERS + r["place"]
        classes.tokens[c, r["place"]] = r["n"]
        classes.tokens[c, TAIL] -= r["n"]
        classes.types[c] -= 1
    classes.tokens[END, TAIL] = documents
    return classes


# --- the network ------------------------------------------------------------------------------

def exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of the logits, in place, and its sums by row. The few that pass ``HIGHEST`` are cut
    there, which keeps float32 finite without a pass for each row's maximum."""
    np.exp(np.minimum(logits, HIGHEST, out=logits), out=logits)
    return logits, logits @ np.ones(logits.shape[1], np.float32)


def columns(x: np.ndarray) -> np.ndarray:
    """The last two axes exchanged, in a contiguous copy."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


class Network:
    """Gated recurrent unit over member ids; input weights are rows of a table, outputs a softmax
    over the classes and one over the members of each class. States are columns: the lanes side
    by side in each of the hidden rows."""

    def __init__(self, classes: int, members: int, hidden: int, vector: np.ndarray | None = None, start: tuple | None = None):
        self.n, self.members, self.hidden = classes, members, hidden
        self.shapes = {"x": (classes * members, 3 * hidden), "u": (hidden, 3 * hidden), "v": (hidden, classes),
                       "vm": (classes, hidden, members), "b": (classes,), "bm": (classes, members)}
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        if vector is None:
            vector = np.random.default_rng(SEED).normal(0, 0.1, size)
            vector[-classes * (members + 1):] = np.concatenate([np.ravel(x) for x in start])
        self.vector = np.array(vector, np.float32)
        at = 0
        for name, shape in self.shapes.items():
            setattr(self, name, self.vector[at:at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))

    def logits(self, flat: np.ndarray, goal: np.ndarray):
        """Logits by state row of the classes and, for rows in the order of their goals' classes,
        of the members of that class; that order, the rows in it, and the bounds of its classes."""
        cls = (goal // self.members).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        bounds = np.r_[0, np.cumsum(np.bincount(cls, minlength=self.n))].tolist()
        ordered = flat[order]
        inner = np.empty((len(flat), self.members), np.float32)
        for c, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            if hi > lo:
                np.matmul(ordered[lo:hi], self.vm[c], out=inner[lo:hi])
                inner[lo:hi] += self.bm[c]
        return flat @ self.v + self.b, inner, order, ordered, bounds

    def log_prob(self, flat: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """log P(member) of each state row's goal."""
        outer, inner, order, _, _ = self.logits(flat, goal)
        at = np.arange(len(goal))
        out = np.minimum(outer[at, goal // self.members], HIGHEST)
        out -= np.log(exponentials(outer)[1])
        out[order] += np.minimum(inner[at, goal[order] % self.members], HIGHEST)
        out[order] -= np.log(exponentials(inner)[1])
        return out

    def step(self, h: np.ndarray, x: np.ndarray):
        return self._step(h, self.x[x].T)

    def _step(self, h: np.ndarray, a: np.ndarray):
        k = self.hidden
        w = self.u.T @ h
        gates = 1 / (1 + np.exp(-(a[:2 * k] + w[:2 * k])))
        z, r = gates[:k], gates[k:]
        new = np.tanh(a[2 * k:] + r * w[2 * k:])
        return new + z * (h - new), z, r, new, w[2 * k:]

    def window_gradient(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray):
        """Gradient of the mean loss over one window (steps x lanes), and the state to carry.
        The state restarts where the input is the end of a document; targets below 0 are padding
        and do not count."""
        k = self.hidden
        grad = Network(self.n, self.members, k, np.zeros_like(self.vector))
        steps, lanes = inputs.shape
        keep = (inputs != END)[:, None, :].astype(np.float32)
        ahead = columns(self.x[inputs])
        before, states, z, r, new, un = np.empty((6, steps, k, lanes), np.float32)
        for t in range(steps):
            before[t] = h * keep[t]
            h, z[t], r[t], new[t], un[t] = self._step(before[t], ahead[t])
            states[t] = h
        flat, goal = columns(states).reshape(-1, k), targets.ravel()
        real = np.flatnonzero(goal >= 0)
        goal = goal[real]
        outer, inner, order, ordered, bounds = self.logits(flat[real], goal)
        at = np.arange(len(goal))
        for part in (outer, inner):
            _, total = exponentials(part)
            part *= (1 / total)[:, None]
        outer[at, goal // self.members] -= 1
        inner[at, goal[order] % self.members] -= 1
        outer *= np.float32(1 / max(1, len(goal)))
        inner *= np.float32(1 / max(1, len(goal)))
        grad.v += flat[real].T @ outer
        grad.b += outer.sum(axis=0)
        from_inner = np.empty_like(ordered)
        for c, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            if hi == lo:
                continue
            grad.vm[c] = ordered[lo:hi].T @ inner[lo:hi]
            grad.bm[c] = inner[lo:hi].sum(axis=0)
            np.matmul(inner[lo:hi], self.vm[c].T, out=from_inner[lo:hi])
        back = outer @ self.v.T
        back[order] += from_inner
        from_out = np.zeros_like(flat)
        from_out[real] = back
        from_out = columns(from_out.reshape(steps, lanes, k))
        by_new, by_z, by_r = (1 - z) * (1 - new * new), (before - new) * z * (1 - z), un * r * (1 - r)
        back = np.zeros_like(h)
        d_u = np.empty((steps, 3 * k, lanes), np.float32)
        d_new = np.empty_like(states)
        for t in range(steps - 1, -1, -1):
            d = from_out[t] + back
            n = np.multiply(d, by_new[t], out=d_new[t])
            np.multiply(d, by_z[t], out=d_u[t, :k])
            np.multiply(n, by_r[t], out=d_u[t, k:2 * k])
            np.multiply(n, r[t], out=d_u[t, 2 * k:])
            back = (d * z[t] + self.u @ d_u[t]) * keep[t]
        grad.u += columns(before).reshape(-1, k).T @ columns(d_u).reshape(-1, 3 * k)
        d_u[:, 2 * k:] = d_new
        rows = inputs.ravel()
        order = np.argsort(rows, kind="stable")
        used, first = np.unique(rows[order], return_index=True)
        grad.x[used] = np.add.reduceat(columns(d_u).reshape(len(rows), -1)[order], first, axis=0)
        return grad.vector, h

    def fit(self, sequences: list[np.ndarray], rate: float) -> int:
        """Adam over truncated windows of parallel lanes, the last lanes padded; returns the
        tokens seen, which are all tokens with the documents' ends."""
        if not sequences:
            return 0
        stream = np.concatenate([np.r_[END, s] for s in sequences])
        target = np.concatenate([np.r_[s, END] for s in sequences])
        lanes = min(LANES, max(1, len(stream) // STEPS))
        steps = -(-len(stream) // lanes)
        inputs, targets = (np.append(a, np.full(steps * lanes - len(a), pad)).reshape(lanes, steps).T
                           for a, pad in ((stream, END), (target, -1)))
        h = np.zeros((self.hidden, lanes), np.float32)
        m, s = np.zeros_like(self.vector), np.zeros_like(self.vector)
        for k, lo in enumerate(range(0, steps, STEPS), 1):
            g, h = self.window_gradient(inputs[lo:lo + STEPS], targets[lo:lo + STEPS], h)
            g *= min(1.0, 1.0 / (np.sqrt(g @ g) + 1e-12))
            m *= 0.9
            m += 0.1 * g
            g *= g
            s *= 0.99
            g *= 0.01
            s += g
            np.sqrt(s, out=g)
            g += 1e-8
            np.divide(m, g, out=g)
            g *= rate * np.sqrt(1 - 0.99**k) / (1 - 0.9**k)
            self.vector -= g
        return len(stream)

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each member sequence and its end, documents side by side, the
        state carried from window to window."""
        size = np.array([len(s) + 1 for s in sequences], np.int64)
        order = np.argsort(-size, kind="stable")
        out = np.zeros(len(sequences))
        for a in range(0, len(order), SCORE_DOCS):  # documents of like size, longest first
            self._score(sequences, size, order[a:a + SCORE_DOCS], out)
        return out / np.log(10)

    def _score(self, sequences: list[np.ndarray], size: np.ndarray, order: np.ndarray, out: np.ndarray) -> None:
        """Add the log probabilities of the documents ``order`` to ``out``."""
        h = np.zeros((self.hidden, len(order)), np.float32)
        for lo in range(0, int(size[order[0]]), SCORE_STEPS):
            live = order[:int((size[order] > lo).sum())]
            h = h[:, :len(live)]
            steps = int(min(SCORE_STEPS, size[live[0]] - lo))
            x = np.zeros((steps + 1, len(live)), np.int64)
            for k, d in enumerate(live):
                part = sequences[d][max(lo - 1, 0):lo + steps]
                at = 0 if lo else 1
                x[at:at + len(part), k] = part
            ahead = columns(self.x[x[:-1]])
            states = np.zeros((steps, self.hidden, len(live)), np.float32)
            left = np.searchsorted(-size[live], -(lo + np.arange(steps)), side="left").tolist()
            for t, n in enumerate(left):
                h = states[t, :, :n] = self._step(h[:, :n], ahead[t, :, :n])[0]
            inside = np.arange(lo, lo + steps)[:, None] < size[live][None, :]
            flat, goal, doc = columns(states)[inside], x[1:][inside], np.broadcast_to(live, inside.shape)[inside]
            for a in range(0, len(goal), SCORE_ROWS):
                part = slice(a, a + SCORE_ROWS)
                out += np.bincount(doc[part], self.log_prob(flat[part], goal[part]), len(out))


def fit_network(packed: DataFrame, classes: Classes) -> np.ndarray:
    """Parameters averaged over the blocks after every round; a task adds up its blocks'."""
    vector = Network(CLASSES, MEMBERS, HIDDEN, None, classes.start()).vector
    for turn in range(ROUNDS):
        start = vector.copy()

        def run(batches, start=start, rate=RATE / (1 + turn)):
            tokens, total = 0, np.zeros(len(start))
            for _, ids, texts, _ in unpacked(batches):
                net = Network(CLASSES, MEMBERS, HIDDEN, start)
                known = Known(classes)
                n = net.fit([known.ids(words_of(t)) for i, t in zip(ids, texts) if not is_held_out(i)], rate)
                tokens += n
                total += n * net.vector.astype(np.float64)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["n", "p"])

        sums = (packed.mapInArrow(run, "n long, p array<double>").select("n", F.posexplode("p").alias("k", "p"))
                .groupBy("k").agg((F.sum("p") / F.sum("n")).alias("p")).collect())
        for r in sums:
            vector[r["k"]] = r["p"]
    return vector


class Known(dict):
    """Member ids of a block's words, looked up once a word."""

    def __init__(self, classes: Classes):
        self.classes = classes

    def __missing__(self, word: bytes) -> int:
        k = self[word] = self.classes.of(word)
        return k

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-size // SHARD_BYTES))
    packed = written(blocks(src), "lm-blocks")
    totals = written(word_totals(word_requests(packed, shards)), "lm-totals")
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0
    documents = src.where(learned).count()
    classes = learn_classes(totals, documents)
    vector = fit_network(packed, classes)
    n = int(classes.tokens.sum())
    v = int(classes.types.sum()) + len(classes.words) + int(documents > 0)
    answers = totals.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("shard", "totals")).alias("answers"))

    def run(batches):
        net = Network(CLASSES, MEMBERS, HIDDEN, vector)
        for _, ids, texts, row in unpacked(batches):
            got = {a["shard"]: a["totals"] for a in row.column("answers")[0].as_py() or []}
            words = [words_of(t) for t in texts]
            every = [w for s in shards_of(list(set().union(*words)), shards) for w in s]
            counts = np.concatenate([np.frombuffer(got[s], "<i8") for s in sorted(got)]) if got else np.zeros(0, np.int64)
            index = {w: k for k, w in enumerate(every)}
            cls = np.array([classes.of(w) for w in every], np.int64)
            # the end token, member 0, is the last entry
            counts, cls = np.append(counts, documents), np.append(cls, END * MEMBERS)
            base = np.log10((counts + SMOOTHING) / (n + SMOOTHING * (v + 1)))
            inside = classes.inside(counts, cls)
            at = [np.append(np.fromiter(map(index.__getitem__, ws), np.int64, len(ws)), len(every)) for ws in words]
            recurrent = net.log10([cls[a[:-1]] for a in at])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([is_held_out(i) for i in ids]), pa.array([len(a) for a in at], pa.int64()),
                pa.array([int((counts[a] > 0).sum()) for a in at], pa.int64()), pa.array([n] * len(ids), pa.int64()),
                pa.array([float(base[a].sum()) for a in at]), pa.array([float(inside[a].sum() + x) for a, x in zip(at, recurrent)])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return packed.join(answers, "block", "left").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
