"""Language-model scoring with a small causal self-attention model trained in numpy.

Words (ASCII lower-cased, an end after the last) become subword ids of a public byte-pair vocabulary, to which
the pairs of ids that frequent words of the training texts hold most often are added as ids of their own.
One attention layer reads the ids so far and predicts the next id by a softmax of two levels: its class
(a frequent id is one by itself), then its slot in the class; ids that share a slot (rare ones) have
their smoothed shares of it. Both levels add what attention finds to a direct path from the id just read.
Exponentials are read off the bits of floats, 2^x with a straight line between whole x; the sums they
are divided by are exact, so the probabilities of all ids add up to one. A text's score is the log10
probability of all its ids and the end. Texts are read in windows of CONTEXT + CHUNK ids that overlap
by CONTEXT: the first ids of a window are only attended to, so every id is scored once. Windows of many
texts are one batch.

From the whole corpus come the counts of all words and subword ids, the base score (a smoothed unigram
model of words) and the direct path (how often each unit is followed by each class and slot; a table of
fixed size). The other weights are fitted in ``ROUNDS``: each task goes on from the weights so far with
the ids of its own texts, and the weights of all tasks are averaged by the ids they saw. A text takes
part in one round, with all its ids, so the weights see every training id once. The rule is the same
at every size. What a task learns follows the order of its rows, so scores (not the base scores) differ
slightly with how the input is split.

Each text is cut into words and ids once; the ids are written, and the direct path, the rounds and the
scoring read them. Word counts are looked up in two ways. Those above a threshold, at most ``FREQUENT_WORDS`` of them,
are sent to the tasks with the ids of their words; the rarer ones are joined.

Defined cases: null text is the end alone; a null doc_id is in no fold, so it trains; repeated rows
are scored and counted one by one; with nothing to learn from all ids are alike and the base score is
that of unseen tokens; other columns are ignored.
"""

from __future__ import annotations

import base64
import copy
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import ASCII_LOWER, map_batches, record_batch, release_memory, slices, utf8
from tradewell.session import materialise

CHUNK, CONTEXT = 16, 16
WIDTH, HIDDEN, UNITS = 16, 16, 2048
HEAD, TAIL, SLOTS = 16, 16, 128  # classes of one id, other classes, slots of these
CLASSES, CELLS = HEAD + TAIL, HEAD + TAIL * SLOTS
ROUNDS, BATCH, RATE = 4, 256, 0.014
SHARE = 1  # one of so many training ids is fitted: all are
STRENGTH = 8.0  # ids that the share over all units counts for in the direct path of one
FIT_IDS = 1 << 17  # ids of texts that a task fits at once
COUNT_IDS = 1 << 19  # and counts at once
SLICES = 8  # in which the weights are averaged
FREQUENT_WORDS = 200_000
MERGES, LEAST_MERGED = 700, 64  # most pairs of ids that become one, and how often a pair must occur
WORDS_KEPT = 500_000


# ---- subword ids

class Subwords(dict):
    """Ids of words as bytes, found on first use; emptied when full. Each of ``merges``, pairs of ids, is one more id."""

    def __init__(self, path: str, merges: tuple[tuple[int, int], ...] = ()):
        super().__init__()
        with open(path, encoding="ascii") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
        self.size = max(ranks.values()) + 1
        if merges:
            parts = {i: part for part, i in ranks.items()}
            for a, b in merges:
                if ranks.setdefault(parts[a] + parts[b], self.size) == self.size:
                    self.size += 1
        self.codec = tiktoken.Encoding("words", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __missing__(self, word: bytes) -> bytes:
        self[word] = found = array("H", self.codec.encode_single_piece(b" " + word)).tobytes()
        return found

    def bytes_of(self, words: list[bytes]) -> bytes:
        return b"".join(self.pieces(words))

    def pieces(self, words: list[bytes]) -> list[bytes]:
        if len(self) > WORDS_KEPT:
            self.clear()
        return list(map(self.__getitem__, words))

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(self.bytes_of(words), np.uint16)


@lru_cache(1)
def _subwords(path: str, merges: tuple[tuple[int, int], ...] = ()) -> Subwords:
    return Subwords(path, merges)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ASCII_LOWER).split()


# ---- the model

def class_of(cells: np.ndarray) -> np.ndarray:
    return np.where(cells < HEAD, cells, (cells - HEAD) // SLOTS + HEAD)


class Vocabulary:
    """Input units and output cells of the ids; the last id is the end.

    The first HEAD cells are the most frequent ids. The others, by falling count, are cut into TAIL classes
    of equal shares of the corpus, and each class likewise into SLOTS cells, one an id where they suffice.
    """

    def __init__(self, counts: np.ndarray):
        mass = counts + 0.5
        order = np.argsort(-mass, kind="stable")
        sizes, rank = mass[order], np.arange(len(mass))
        upto = np.cumsum(sizes[HEAD:])
        tail = np.minimum((upto / upto[-1] * TAIL - 1e-9).astype(np.int64), TAIL - 1)
        first = np.searchsorted(tail, np.arange(TAIL))[tail]  # of the class of each
        before = np.concatenate(([0], upto))[first]
        total = np.bincount(tail, sizes[HEAD:], TAIL)[tail]
        slots = np.clip((upto - before) / total * SLOTS - 1e-9, 0, SLOTS - 1).astype(np.int64)
        few = np.bincount(tail, minlength=TAIL)[tail] <= SLOTS
        slots = np.where(few, rank[:len(tail)] - first, slots)
        cells = np.concatenate((rank[:HEAD], HEAD + tail * SLOTS + slots))
        self.cell_mass = np.bincount(cells, sizes, CELLS)
        self.cells, self.inside, self.units = np.empty(len(mass), np.int32), np.empty(len(mass)), np.empty(len(mass), np.int32)
        self.cells[order] = cells
        self.inside[order] = np.log10(sizes / self.cell_mass[cells])
        self.units[order] = np.where(rank < UNITS, rank, UNITS + class_of(cells))

    def pairs(self, texts: list[np.ndarray]) -> np.ndarray:
        """unit * CELLS + cell at every place of the texts: what is read there and what follows."""
        end = len(self.cells) - 1
        ends = np.array([end], np.uint16)
        told = np.concatenate([x for t in texts for x in (t, ends)])
        read = np.concatenate((ends, told[:-1]))
        return self.units[read].astype(np.int64) * CELLS + self.cells[told]


class Direct:
    """Probability of each class after each unit, and of each slot after each unit, within its class.

    Most classes hold far fewer ids than SLOTS. ``groups`` has the slots again, of neighbouring classes that need a like
    number of them, and no more than these: first class, the class after the last, slots, table by unit and class.
    """

    def __init__(self, cell_mass: np.ndarray, pairs: np.ndarray, n: np.ndarray):
        told = np.zeros((UNITS + CLASSES) * CELLS, np.float32)
        told[pairs] = n
        told = told.reshape(UNITS + CLASSES, CELLS)
        mass = cell_mass.astype(np.float32)
        least, strength = np.float32(1e-30), np.float32(STRENGTH)  # least: of cells without ids

        slots = told[:, HEAD:].reshape(-1, TAIL, SLOTS)
        of_slots = mass[HEAD:].reshape(TAIL, SLOTS)
        by_class = np.concatenate((told[:, :HEAD], slots.sum(axis=2)), axis=1)
        of_class = np.concatenate((mass[:HEAD], of_slots.sum(axis=1)))
        self.classes = np.maximum((by_class + strength * of_class / of_class.sum()) / (by_class.sum(axis=1, keepdims=True) + strength), least)
        slots = slots + strength * of_slots / np.maximum(of_class[HEAD:, None], least)
        slots /= by_class[:, HEAD:, None] + strength
        np.maximum(slots, least, out=slots)
        self.slots = slots.reshape(-1, SLOTS)
        used = np.where(of_slots > 0, np.arange(1, SLOTS + 1), 1).max(axis=1)
        wide = np.minimum(1 << np.ceil(np.log2(np.maximum(used, 8))).astype(int), SLOTS)
        ends = [*(np.flatnonzero(np.diff(wide)) + 1).tolist(), TAIL]
        self.groups = [(a, b, int(wide[a]), slots[:, a:b, :wide[a]].reshape(-1, wide[a])) for a, b in zip([0, *ends], ends)]


# Floats whose bits are a number of SCALE * x + BIAS are about e^x.
SCALE, BIAS = np.float32(2 ** 23 / np.log(2)), np.float32(127 * 2 ** 23 - 366_393)
MOST = BIAS + 60 * SCALE


def powers(scaled: np.ndarray, least: np.float32 = BIAS - 60 * SCALE) -> np.ndarray:
    np.clip(scaled, least, MOST, out=scaled)
    return scaled.astype(np.int32).view(np.float32)


def windows(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids read and ids to predict in chunks of CHUNK, which places count, and which chunks begin a text."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    chunks = -(-sizes // CHUNK)
    first = np.cumsum(chunks) - chunks
    read = np.full(int(chunks.sum()) * CHUNK, end, np.int64)
    told = read.copy()
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first * CHUNK, sizes)
    flat = np.concatenate([x for t in texts for x in (t, np.array([end], np.uint16))]) if texts else np.zeros(0, np.int64)
    told[place] = flat
    inner = np.ones(len(place), bool)
    inner[np.cumsum(sizes) - sizes] = False  # a text's first place reads the end
    read[place[inner]] = told[place[inner] - 1]
    counted = np.zeros(len(read), bool)
    counted[place] = True
    begins = np.zeros(int(chunks.sum()), bool)
    begins[first] = True
    return read.reshape(-1, CHUNK), told.reshape(-1, CHUNK), counted.reshape(-1, CHUNK), begins


_DISTANCE = np.arange(CHUNK)[:, None] + CONTEXT - np.arange(CONTEXT + CHUNK)[None, :]
_CAUSAL = _DISTANCE >= 0


class Attention:
    """One layer of masked attention with relative places, then a small network over classes and slots."""

    def __init__(self, direct: Direct, seed: int = 7):
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.direct = direct
        self.p = {"embed": (rng.standard_normal((UNITS + CLASSES, WIDTH)) * 0.5).astype(np.float32),
                  "q": normal(WIDTH, WIDTH), "k": normal(WIDTH, WIDTH), "v": normal(WIDTH, WIDTH),
                  "near": np.zeros(CONTEXT + CHUNK, np.float32),
                  "w1": normal(WIDTH, HIDDEN), "b1": np.zeros(HIDDEN, np.float32),
                  "w2": np.zeros((HIDDEN + 1, CLASSES), np.float32), "slots": np.zeros((TAIL, HIDDEN + 1, SLOTS), np.float32)}

    @staticmethod
    def with_context(x: np.ndarray) -> np.ndarray:
        """Each chunk with the last CONTEXT places of the chunk before it."""
        out = np.empty((len(x), CONTEXT + CHUNK, x.shape[2]), x.dtype)
        out[:, CONTEXT:] = x
        out[1:, :CONTEXT] = x[:-1, CHUNK - CONTEXT:]
        out[:1, :CONTEXT] = 0
        return out

    def hidden(self, units: np.ndarray, begins: np.ndarray) -> tuple:
        """What the network finds at each place, and a one; then what its gradients need."""
        p = self.p
        near = np.where(_CAUSAL, p["near"][np.maximum(_DISTANCE, 0)] * SCALE + BIAS, np.float32(-1e12)).astype(np.float32)
        x = p["embed"].take(units, axis=0)
        q = (p["embed"] @ p["q"] * (SCALE / np.float32(np.sqrt(WIDTH)))).take(units, axis=0)
        # k, v and a one, which gives the sum of the weights
        kv = np.concatenate((p["embed"] @ p["k"], p["embed"] @ p["v"], np.ones((len(p["embed"]), 1), np.float32)), axis=1)
        kv = self.with_context(kv.take(units, axis=0))
        weight = q @ kv[:, :, :WIDTH].transpose(0, 2, 1)
        weight += near
        weight = powers(weight, np.float32(0))  # what is masked weighs 0
        weight[begins, :, :CONTEXT] = 0
        found = weight @ kv[:, :, WIDTH:]
        total = np.maximum(found[:, :, WIDTH:], np.float32(1e-30))
        found = found[:, :, :WIDTH] / total
        h = (x + found).reshape(-1, WIDTH)
        z = np.empty((len(h), HIDDEN + 1), np.float32)
        z[:, HIDDEN] = 1
        inner = h @ p["w1"]
        inner += p["b1"]
        np.maximum(inner, 0, out=z[:, :HIDDEN])
        return z, (x, q, kv, weight, found, total, h)

    @staticmethod
    def scaled(weights: np.ndarray) -> np.ndarray:
        out = weights * SCALE
        out[..., -1, :] += BIAS
        return out

    @staticmethod
    def sorted_by_class(classes: np.ndarray) -> tuple:
        """Places in order of the class told, these classes, and where each class of several slots begins, with the end."""
        order = np.argsort(classes.astype(np.int8), kind="stable")
        classes = classes.take(order)
        return order, classes, np.searchsorted(classes, np.arange(HEAD, CLASSES + 1)).tolist()

    def levels(self, z: np.ndarray, units: np.ndarray, classes: np.ndarray, slots: np.ndarray, bounds: list[int]) -> Iterator[tuple]:
        """Shares, not yet divided by their sum, of the classes at all places and of the slots of each group of classes.

        Places come in order of class. With the shares: which places, the column told, and name, index, weights and
        places of each matrix that gave them.
        """
        found = powers(z @ self.scaled(self.p["w2"]))
        found *= self.direct.classes.take(units, axis=0)
        yield found, slice(0, len(z)), classes, [("w2", ..., self.p["w2"], slice(0, len(z)))]
        scaled = self.scaled(self.p["slots"])
        for a, b, wide, table in self.direct.groups:
            first, end = bounds[a], bounds[b]
            if first == end:
                continue
            logits = np.empty((end - first, wide), np.float32)
            pieces = [("slots", (c, slice(None), slice(wide)), self.p["slots"][c, :, :wide], slice(bounds[c] - first, bounds[c + 1] - first))
                      for c in range(a, b) if bounds[c] < bounds[c + 1]]
            mine = z[first:end]
            for _, at, _, part in pieces:
                np.matmul(mine[part], scaled[at], out=logits[part])
            found = powers(logits)
            found *= table.take(units[first:end] * (b - a) + (classes[first:end] - (HEAD + a)), axis=0)
            yield found, slice(first, end), slots[first:end], pieces

    def log_cells(self, units: np.ndarray, cells: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log probability of the cell told at each place."""
        z, _ = self.hidden(units, begins)
        cells = cells.ravel()
        order, classes, bounds = self.sorted_by_class(class_of(cells))
        logs = np.zeros(len(z), np.float32)
        for found, rows, told, _ in self.levels(z.take(order, axis=0), units.ravel().take(order), classes,
                                                (cells.take(order) - HEAD) % SLOTS, bounds):
            logs[rows] += np.log(found[np.arange(len(found)), told] / (found @ np.ones(found.shape[1], np.float32)))
        out = np.empty(units.shape, np.float32)
        out.ravel()[order] = logs
        return out

    def gradients(self, units: np.ndarray, cells: np.ndarray, counted: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log probability over the counted places."""
        p = self.p
        z, (x, q, kv, weight, found, total, h) = self.hidden(units, begins)
        flat_units, cells = units.ravel(), cells.ravel()
        size = counted.ravel().astype(np.float32) / np.float32(max(1, counted.sum()))
        # Both levels in order of the class told: the places of a class lie together.
        order, classes, bounds = self.sorted_by_class(class_of(cells))
        size, sorted_z = size.take(order), z.take(order, axis=0)
        g = {"w2": np.empty_like(p["w2"]), "slots": np.zeros_like(p["slots"])}
        back = np.zeros((len(z), HIDDEN), np.float32)
        for d, rows, told, pieces in self.levels(sorted_z, flat_units.take(order), classes, (cells.take(order) - HEAD) % SLOTS, bounds):
            # The slope is (d less its sum at what is told) * size / sum: the factor goes to the narrow sides of the products.
            of_all = d @ np.ones(d.shape[1], np.float32)
            d[np.arange(len(d)), told] -= of_all
            factor = (size[rows] / of_all)[:, None]
            mine, dz = sorted_z[rows] * factor, np.empty((len(d), HIDDEN), np.float32)
            for name, at, weights, part in pieces:
                np.matmul(mine[part].T, d[part], out=g[name][at])
                np.matmul(d[part], weights[:HIDDEN].T, out=dz[part])
            dz *= factor
            back[rows] += dz
        dz = np.empty((len(back), HIDDEN), np.float32)
        dz[order] = back
        dz *= z[:, :HIDDEN] > 0
        g["w1"], g["b1"] = h.T @ dz, np.ones(len(dz), np.float32) @ dz
        dh = (dz @ p["w1"].T).reshape(x.shape)
        # Weights are not divided by their sums here either: what comes back is.
        back = np.empty((*dh.shape[:2], WIDTH + 1), np.float32)
        np.divide(dh, total, out=back[:, :, :WIDTH])
        found *= back[:, :, :WIDTH]
        np.negative(found.sum(axis=2), out=back[:, :, WIDTH])
        dscore = back @ kv[:, :, WIDTH:].transpose(0, 2, 1)
        dscore *= weight
        by_place = np.ones(len(dscore), np.float32) @ dscore.reshape(len(dscore), -1)
        g["near"] = np.bincount(np.maximum(_DISTANCE, 0).ravel(), by_place * _CAUSAL.ravel(), CONTEXT + CHUNK).astype(np.float32)
        dkv = np.empty((len(x), CONTEXT + CHUNK, 2 * WIDTH), np.float32)
        np.matmul(dscore.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
        np.matmul(weight.transpose(0, 2, 1), back[:, :, :WIDTH], out=dkv[:, :, WIDTH:])
        dqkv = np.empty((*x.shape[:2], 3 * WIDTH), np.float32)
        np.matmul(dscore, kv[:, :, :WIDTH], out=dqkv[:, :, :WIDTH])
        dqkv[:, :, WIDTH:] = dkv[:, CONTEXT:]  # from a place's own window, then from the next
        dqkv[:-1, CHUNK - CONTEXT:, WIDTH:] += dkv[1:, :CONTEXT]
        dqkv = dqkv.reshape(-1, 3 * WIDTH)
        factors = np.repeat(np.array([1 / np.sqrt(WIDTH), 1 / SCALE, 1], np.float32), WIDTH)
        of_all = x.reshape(-1, WIDTH).T @ dqkv
        of_all *= factors
        g["q"], g["k"], g["v"] = np.split(of_all, 3, axis=1)
        dx = dqkv @ (np.concatenate((p["q"], p["k"], p["v"]), axis=1) * factors).T
        dx += dh.reshape(-1, WIDTH)
        order = np.argsort(flat_units.astype(np.int16), kind="stable")
        read = flat_units.take(order)
        first = np.flatnonzero(np.diff(read, prepend=-1))
        g["embed"] = np.zeros_like(p["embed"])
        g["embed"][read[first]] = np.add.reduceat(dx.take(order, axis=0), first, axis=0)
        return g

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.p.values()])

    def set_flat(self, weights: np.ndarray) -> None:
        at = 0
        for n, w in self.p.items():
            self.p[n] = weights[at:at + w.size].reshape(w.shape).astype(np.float32, copy=False)
            at += w.size


class Fit:
    """Adam over batches of neighbouring chunks in random order; texts may come in any number of calls."""

    def __init__(self, attention: Attention, rate: float, seed: int = 7):
        self.attention, self.rate, self.step = attention, rate, 0
        self.rng = np.random.default_rng(seed)
        self.mean, self.square = np.zeros((2, attention.flat().size), np.float32)

    def learn(self, units: np.ndarray, cells: np.ndarray, counted: np.ndarray, begins: np.ndarray) -> int:
        """Learn from all chunks; how many places that were."""
        weights, mean, square = self.attention.flat(), self.mean, self.square
        self.attention.set_flat(weights)  # as views, so that a step moves them all
        firsts = np.arange(0, len(units), BATCH)
        for r in self.rng.permutation(len(firsts)):
            part = slice(firsts[r], firsts[r] + BATCH)
            if not counted[part].any():
                continue
            self.step += 1
            first = begins[part].copy()
            first[0] = True
            found = self.attention.gradients(units[part], cells[part], counted[part], first)
            g = np.concatenate([found[n].ravel() for n in self.attention.p])
            # Sums that fade; their factors are in the last step.
            mean *= np.float32(0.9)
            mean += g
            g *= g
            square *= np.float32(0.99)
            square += g
            np.sqrt(square, out=g)
            g += np.float32(1e-8 * np.sqrt((1 - 0.99 ** self.step) / 0.01))
            np.divide(mean, g, out=g)
            g *= np.float32(self.rate * 0.1 / (1 - 0.9 ** self.step) * np.sqrt((1 - 0.99 ** self.step) / 0.01))
            weights -= g
        return int(counted.sum())


class Model:
    """Vocabulary, weights and the counts of frequent words: all that a scoring task needs."""

    def __init__(self, vocabulary: Vocabulary, direct: Direct):
        self.end = len(vocabulary.cells) - 1
        self.vocabulary = vocabulary
        self.attention = Attention(direct)

    def learn(self, fit: Fit, texts: list[np.ndarray]) -> int:
        """Learn from these texts; how many ids, ends included, that were."""
        read, told, counted, begins = windows(texts, self.end)
        return fit.learn(self.vocabulary.units[read], self.vocabulary.cells[told], counted, begins)

    def score(self, texts: list[np.ndarray], most_chunks: int = 256) -> np.ndarray:
        """log10 probability of each text with its end."""
        if not texts:
            return np.zeros(0)
        read, told, counted, begins = windows(texts, self.end)
        units, cells = self.vocabulary.units[read], self.vocabulary.cells[told]
        inside = self.vocabulary.inside[told]
        chunk = np.empty(len(read))
        for a in range(0, len(read), most_chunks):
            back = 1 if a and not begins[a] else 0  # the chunk before, only for its last places
            part = slice(a - back, a + most_chunks)
            first = begins[part].copy()
            first[0] = True
            found = self.attention.log_cells(units[part], cells[part], first)[back:]
            mine = slice(a, a + most_chunks)
            chunk[mine] = ((found / np.log(10) + inside[mine]) * counted[mine]).sum(axis=1)
        return np.add.reduceat(chunk, np.flatnonzero(begins))


# ---- what the corpus gives

def word_counts(training: DataFrame) -> DataFrame:
    """word, n over all training texts: counted in the tasks first, a bounded number of words at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in utf8(batch.column("text")):
                counts.update(words_of(text))
                if len(counts) > WORDS_KEPT:
                    yield record_batch(word=pa.array(counts.keys(), pa.binary()), n=pa.array(counts.values(), pa.int64()))
                    counts.clear()
            release_memory()
        if counts:
            yield record_batch(word=pa.array(counts.keys(), pa.binary()), n=pa.array(counts.values(), pa.int64()))

    return training.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_pairs(words: DataFrame, path: str) -> tuple[tuple[int, int], ...]:
    """The MERGES pairs of neighbouring ids that the counted words hold most often, if LEAST_MERGED times at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _subwords(path)
        for batch in batches:
            sums: Counter[tuple[int, int]] = Counter()
            for word, n in zip(*(c.to_pylist() for c in batch.columns)):
                found = subwords.codec.encode_single_piece(b" " + word)
                for pair in zip(found, found[1:]):
                    sums[pair] += n
            yield record_batch(a=[a for a, _ in sums], b=[b for _, b in sums], n=pa.array(sums.values(), pa.int64()))

    counted = words.select("word", "n").mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    most = counted.where(F.col("n") >= LEAST_MERGED).orderBy(F.desc("n"), "a", "b").limit(MERGES)
    return tuple((row["a"], row["b"]) for row in most.collect())


def id_counts(words: DataFrame, path: str, merges: tuple[tuple[int, int], ...] = ()) -> np.ndarray:
    """Count of every subword id over the counted words; as many numbers as the vocabulary has reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _subwords(path, merges)
        sums = np.zeros(subwords.size, np.int64)
        for batch in batches:
            found = [subwords.codec.encode_single_piece(b" " + w) for w in batch.column("word").to_pylist()]
            n = np.repeat(batch.column("n").to_numpy(zero_copy_only=False), [len(f) for f in found])
            sums += np.bincount(np.array([i for f in found for i in f], np.int64), n, subwords.size).astype(np.int64)
        used = np.flatnonzero(sums)
        yield record_batch(id=used, n=sums[used])

    out = np.zeros(_subwords(path, merges).size + 1, np.int64)
    for row in words.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


def frequent_from(words: DataFrame, most: int = FREQUENT_WORDS) -> int:
    """The least count such that at most ``most`` words have that or more."""
    left, least = most, None
    for row in words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        left -= row["words"]
        if left < 0:
            break
        least = row["n"]
    return least if least is not None else (1 << 62)


def _ids_in(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[np.ndarray]]:
    """The ids of texts, about ``most`` at a time."""
    for batch in batches:
        for piece in slices(batch, 2 * most, "ids"):
            yield [np.frombuffer(v, np.uint16) for v in piece.column("ids").to_pylist()]
            del piece
        del batch
        release_memory()


def direct_path(training: DataFrame, vocabulary: Vocabulary) -> Direct:
    """Counts of what follows each unit in all ``ids``. At most (UNITS + CLASSES) * CELLS numbers reach the driver, packed."""
    size = (UNITS + CLASSES) * CELLS
    sent = training.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = sent.value, np.zeros(size, np.int64)
        for texts in _ids_in(batches, COUNT_IDS):
            sums += np.bincount(known.pairs(texts), minlength=size)
        used = np.flatnonzero(sums)
        for a in range(0, len(used), 1 << 16):
            yield record_batch(pair=used[a:a + (1 << 16)], n=sums[used[a:a + (1 << 16)]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield record_batch(pairs=[pair.astype(np.int32).tobytes()], n=[n.astype(np.float32).tobytes()])

    counted = training.select("ids").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = counted.mapInArrow(pack, "pairs binary, n binary").collect()
    sent.unpersist()
    return Direct(vocabulary.cell_mass, np.frombuffer(b"".join(r["pairs"] for r in rows), np.int32),
                  np.frombuffer(b"".join(r["n"] for r in rows), np.float32))


WEIGHTS = "slice int, task int, n bigint, weights binary"


def _fit_tasks(sent: Broadcast, rate: float):
    """Per task: the weights after its own texts and how many ids they have, in slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = copy.copy(sent.value)
        model.attention = copy.copy(model.attention)
        model.attention.p = copy.deepcopy(model.attention.p)
        fit = Fit(model.attention, rate)
        seen = sum(model.learn(fit, texts) for texts in _ids_in(batches, FIT_IDS))
        if seen:
            parts = np.array_split(model.attention.flat(), SLICES)
            yield record_batch(slice=pa.array(range(SLICES), pa.int32()), task=pa.array([TaskContext.get().partitionId()] * SLICES, pa.int32()),
                               n=pa.array([seen] * SLICES, pa.int64()), weights=[p.tobytes() for p in parts])
    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of each slice over the tasks, by the ids they saw, added in the order of the tasks."""
    found: dict[int, list[tuple[int, int, bytes]]] = {}
    for batch in batches:
        for k, task, n, data in zip(*(c.to_pylist() for c in batch.columns)):
            found.setdefault(k, []).append((task, n, data))
    for k, rows in found.items():
        total = sum(n for _, n, _ in rows)
        mean = sum(np.frombuffer(data, np.float32).astype(np.float64) * (n / total) for _, n, data in sorted(rows))
        yield record_batch(slice=pa.array([k], pa.int32()), task=pa.array([0], pa.int32()), n=pa.array([total], pa.int64()),
                           weights=[mean.astype(np.float32).tobytes()])


def fit(model: Model, training: DataFrame) -> int:
    """Fit the weights on ``ids``, by ``round``; how many ids, ends included, that were. Only weights reach the driver."""
    seen = 0
    for k in range(ROUNDS):
        sent = training.sparkSession.sparkContext.broadcast(model)
        texts = training.where(F.col("round") == k).select("ids")
        fitted = texts.mapInArrow(_fit_tasks(sent, RATE * (1 - k / ROUNDS)), WEIGHTS)
        rows = sorted(fitted.repartition(SLICES, "slice").mapInArrow(_averaged, WEIGHTS).collect(), key=lambda r: r["slice"])
        if rows:
            model.attention.set_flat(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in rows]))
            seen += rows[0]["n"]
        sent.unpersist()
    return seen


ENCODED = ("doc_id bigint, held_out boolean, round int, n_tokens bigint, known bigint, base double, rare array<binary>, ids binary")


class Frequent:
    """Number, base logarithm and ids of each frequent word."""

    def __init__(self, rows: list, bottom: float):
        self.number = {bytes(r["word"]): k for k, r in enumerate(rows)}
        self.logs = np.log10((np.array([r["n"] for r in rows], np.float64) + 0.5) / bottom)
        self.ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in rows), np.uint16)
        self.sizes = np.array([len(r["ids"]) // 2 for r in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes


def frequent_words(words: DataFrame, path: str, merges: tuple[tuple[int, int], ...], bottom: float) -> Frequent:
    """Of counted words, at most ``FREQUENT_WORDS``; their ids are found in the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _subwords(path, merges)
        for batch in batches:
            yield batch.append_column("ids", pa.array(subwords.pieces(batch.column("word").to_pylist()), pa.binary()))

    return Frequent(list(words.select("word", "n").mapInArrow(run, "word binary, n bigint, ids binary").toLocalIterator()), bottom)


def _encode(sent: Broadcast, path: str, merges: tuple[tuple[int, int], ...]):
    """Base counts of the frequent words, the other words, and the ids of each text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        frequent, end_log, end_known = sent.value
        words = [words_of(text) for text in utf8(batch.column("text"))]
        size = np.fromiter(map(len, words), np.int64, len(words))
        words = list(chain.from_iterable(words))
        number = np.fromiter(map(frequent.number.get, words, repeat(-1)), np.int64, len(words))
        common, missing = number >= 0, np.flatnonzero(number < 0)
        rare = [words[k] for k in missing.tolist()]
        del words

        def bounds(before: np.ndarray) -> np.ndarray:
            """Where each text begins and the last ends, from a running sum over words."""
            return before[np.concatenate(([0], np.cumsum(size)))]

        known = np.concatenate(([0], np.cumsum(common)))
        logs, at = frequent.logs[number[common]], bounds(known).tolist()
        # Ids of frequent words lie in one array, those of the others behind them.
        pieces = _subwords(path, merges).pieces(rare)
        lengths, starts = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
        lengths[common], starts[common] = frequent.sizes[number[common]], frequent.starts[number[common]]
        others = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 2
        lengths[missing], starts[missing] = others, len(frequent.ids) + np.cumsum(others) - others
        before = np.concatenate(([0], np.cumsum(lengths)))
        ids = np.concatenate((frequent.ids, np.frombuffer(b"".join(pieces), np.uint16)))
        ids = ids[np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])]
        known_here = bounds(known)
        return record_batch(
            doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), round=batch.column("round"), n_tokens=size + 1,
            known=np.diff(known_here) + end_known, base=[float(logs[a:b].sum()) + end_log for a, b in zip(at, at[1:])],
            rare=pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))) - known_here, pa.int32()), pa.array(rare, pa.binary())),
            ids=pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((2 * bounds(before)).astype(np.int32)), pa.py_buffer(ids)]))
    return work


def _score(sent: Broadcast):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [np.frombuffer(v, np.uint16) for v in batch.column("ids").to_pylist()]
        at = batch.schema.get_field_index("ids")
        return batch.remove_column(at).append_column("score", pa.array(sent.value.score(texts), pa.float64()))
    return work


def score(docs: DataFrame, held: Column, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    ``held`` says which rows are kept out of training; ``path`` is a vocabulary file on every worker.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("bigint"), held.alias("held_out"), "text",
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int").alias("round"))
    training = plain.where(~F.col("held_out"))
    words = materialise(word_counts(training), "word-counts")
    told = words.agg(F.count("*"), F.sum("n")).first()
    n_train = training.count()
    distinct, total = told[0] + (n_train > 0), (told[1] or 0) + n_train
    bottom = total + 0.5 * (distinct + 1)
    least = frequent_from(words)
    often = words.where(F.col("n") >= least)
    merges = frequent_pairs(often, path)
    ids = id_counts(words, path, merges)
    ids[-1] = n_train
    sent = spark.sparkContext.broadcast((frequent_words(often, path, merges, bottom), float(np.log10((n_train + 0.5) / bottom)), int(n_train > 0)))
    encoded = map_batches(plain, _encode(sent, path, merges), ENCODED, 2 << 20).withColumn("row", F.monotonically_increasing_id())
    encoded = materialise(encoded, "lm-ids")
    sent.unpersist()
    learnt = encoded.where(~F.col("held_out"))
    vocabulary = Vocabulary(ids)
    model = Model(vocabulary, direct_path(learnt, vocabulary))
    fit(model, learnt)
    rarer = words.where(F.col("n") < least)
    looked_up = (encoded.select("row", F.explode("rare").alias("word")).join(rarer, "word", "left")
                 .groupBy("row").agg(F.count("n").alias("more_known"),
                                     F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.5) / bottom)).alias("more_base")))
    scored = map_batches(encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "ids"),
                         _score(spark.sparkContext.broadcast(model)),
                         "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double",
                         1 << 20, "ids")
    return scored.join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score")
