"""LM scoring: a log-bilinear model of words, and an add-one unigram beside it.

The model predicts a token from the two before it. Every broadcast word has vectors of its own as a context, one for
each place; they are summed. First comes the token's class, then the word in its class: the most frequent words are
classes by themselves, the next ones share classes of SIZE words and have vectors of their own there, the others are
bands of like frequency in which each word has its add-one share, whatever the context. Words that aren't broadcast are
one context and the last class. Scores are normalised over all classes and over the words of a class, by matrix
products over many tokens at a time.

Both steps are trained by noise-contrastive estimation in numpy, over every training token. Tokens share noise: its
classes with neighbours, its words with tokens of the same class; the draws of a step are spread evenly. Exponentials are
taken once per distinct word or context of many tokens. Documents are dealt out by
hash to shards of some million tokens, whose number follows from the corpus alone, and read in an order of their own. A
shard begins each round with the same vectors; a vector becomes the mean of the shards', weighted by how often they used
it. So scores do not depend on how the table is cut or on the cluster. Word counts grow with the corpus: the most
frequent words are broadcast, their number is fixed; tokens of all other words are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import documents, flat, id_bucket, staged, text_bytes

END = "\n"  # no word has one
#: Words that are broadcast; those of them that are a class of their own; classes of words with vectors, and their size.
HEAD, ALONE, SHARED, SIZE = 1 << 17, 64, 128, 256
#: Classes in all: those, bands of the other broadcast words, and one for the remaining words.
BANDS = 31
CLASSES = ALONE + SHARED + BANDS + 1
RARE = CLASSES - 1
OWN = ALONE + SHARED * SIZE
DIM, SEED = 24, 9
#: Noise classes and noise words of a token, how many tokens share them, and tokens of a step.
NOISE, NOISE_WORDS, TOGETHER, TOGETHER_WORDS, CHUNK = 32, 24, 128, 16, 1 << 13
GOLDEN = (5**0.5 - 1) / 2
#: Tokens that are scored at a time, rows of a matrix product, and words whose exponentials a scoring task keeps.
SCORED, TILE, KEPT = 1 << 18, 512, 1 << 15
#: The rate, and what the sums of squares begin with.
RATE, SQUARE = 0.25, 1.0
#: Tokens of a shard in all rounds.
SHARD, ROUNDS = 1 << 23, 2
#: Words a task counts before it hands them on, and bytes of texts that it splits at a time.
FLUSH, PORTION = 1 << 21, 1 << 22


def portions(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Shorter batches, with about so many bytes in a column, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
            yield batch.slice(at, max(upto, at + 1) - at)
            at = max(upto, at + 1)


def words_of(body: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, A-Z in lower case, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(body.cast(pa.binary()).view(pa.string())))
    words = split.flatten().view(pa.binary())
    there = pc.binary_length(words).to_numpy() > 0  # blanks at an end leave an empty word there
    upto = np.append(0, np.cumsum(there))
    begin = split.offsets.to_numpy()
    return words if there.all() else words.filter(pa.array(there)), np.diff(upto[begin - begin[0]])


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Array] = []
    ends = 0

    def counted() -> pa.RecordBatch:
        seen = pa.chunked_array(held, pa.binary()).value_counts()
        return pa.record_batch(seen.flatten(), ["word", "n"])

    for batch in portions(batches, "body", PORTION):
        held.append(words_of(batch.column("body"))[0])
        ends += batch.num_rows
        if sum(map(len, held)) > FLUSH:
            yield counted()
            held.clear()
    if held:
        yield counted()
        yield pa.record_batch([pa.array([END.encode()], pa.binary()), pa.array([ends], pa.int64())], ["word", "n"])


@dataclass
class Vocabulary:
    """The broadcast words by place, the end first: their class and log10 of count + 1."""

    listed: pa.Array
    kind: np.ndarray
    log_count: np.ndarray
    #: Words and tokens of each class; the last has the words that aren't broadcast.
    words: np.ndarray
    tokens: np.ndarray

    def log_share(self) -> np.ndarray:
        """log10 of a class's tokens plus words, and one for an unknown word in the last."""
        size = self.tokens + self.words
        size[RARE] += 1
        return np.log10(np.maximum(size, 1))


def vocabulary(rows: list[tuple[bytes, int]], tokens: int, words: int) -> Vocabulary:
    """rows: the most frequent words and their counts, most frequent first; tokens and words: of the whole corpus."""
    rows = [(END.encode(), next((n for w, n in rows if w == END.encode()), 0))] + [r for r in rows if r[0] != END.encode()]
    counts = np.array([n for _, n in rows], np.int64)
    kind = np.arange(len(rows))
    kind[ALONE:OWN] = ALONE + (kind[ALONE:OWN] - ALONE) // SIZE
    rest = counts[OWN:].astype(float)
    if len(rest):
        kind[OWN:] = ALONE + SHARED + np.minimum((np.cumsum(rest) - rest) / rest.sum() * BANDS, BANDS - 1).astype(int)
    held = np.bincount(kind, counts, CLASSES)
    known = np.bincount(kind, counts > 0, CLASSES)
    held[RARE], known[RARE] = tokens - counts.sum(), words - (counts > 0).sum()
    return Vocabulary(pa.array([w for w, _ in rows], pa.binary()), kind, np.log10(counts + 1.0), known, held)


def with_contexts(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values two before and one before each token; before a text there are ends, which are 0."""
    first = np.cumsum(sizes) - sizes
    one, two = np.roll(values, 1), np.roll(values, 2)
    one[first] = 0
    two[first] = 0
    second = (first + 1)[sizes > 1]
    two[second] = 0
    return two, one


#: Exponentials of frequent words, by where their contexts begin.
Held = dict[int, tuple[np.ndarray, np.ndarray]]


class LogBilinear:
    """All vectors in one table: contexts two before and one before (by place; words that aren't broadcast come last),
    classes, and the words of shared classes. The last column of the latter two is a bias, that of a context adds to 1.
    """

    def __init__(self, v: Vocabulary) -> None:
        """At the start contexts say nothing, and biases are those of the add-one unigram."""
        rng = np.random.default_rng(SEED)
        self.kind = np.append(v.kind, RARE)
        contexts = len(self.kind)
        self.one, self.classes = contexts, 2 * contexts
        self.words = self.classes + CLASSES
        size = v.tokens + v.words
        size[RARE] += 1
        self.used = size > 0
        log_class = np.log(np.maximum(size, 1) / size.sum())
        #: Words before this place that have no class of their own have vectors in theirs.
        self.own = own = min(OWN, contexts - 1)
        self.rows = np.zeros((self.words + max(0, own - ALONE), DIM + 2), np.float32)
        self.rows[self.one : self.classes, DIM] = 1
        self.rows[self.classes :, :DIM] = rng.normal(0, 0.1, (len(self.rows) - self.classes, DIM))
        self.rows[self.classes : self.words, DIM] = np.where(self.used, log_class, -1e4)
        self.noise = np.where(self.used, np.exp(log_class), 0)
        shared = np.arange(ALONE, own)
        self.rows[self.words :, DIM] = v.log_count[shared] * np.log(10) - np.log(np.maximum(size[v.kind[shared]], 1))
        #: What a word has in its class whatever the context: nothing to add for those with vectors or alone.
        bands = np.flatnonzero(self.kind[:-1] >= ALONE + SHARED)
        self.share = np.zeros(contexts)
        self.share[bands] = (v.log_count[bands] - v.log_share()[v.kind[bands]]) * np.log(10)
        #: Of shared classes where their words begin, and how many there are.
        self.size = np.bincount(v.kind[shared] - ALONE, minlength=SHARED) if len(shared) else np.zeros(SHARED, np.int64)

    def hidden(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        return self.rows.take(two, 0) + self.rows.take(one + self.one, 0)

    def log_probabilities(self, two: np.ndarray, one: np.ndarray, words: np.ndarray, held: Held | None = None) -> np.ndarray:
        """Natural logs, of words after two others; of the last word, which stands for many, its class's.

        held keeps from call to call what is made once, as long as the vectors stay as they are.
        """
        out = np.zeros(len(words))
        for at in range(0, len(words), SCORED):
            part = slice(at, at + SCORED)
            w, before, after = words[part], two[part], one[part]
            kind = self.kind[w]
            hidden = self.hidden(before, after)
            own = np.where((w >= ALONE) & (w < self.own), w - ALONE + self.words, 0)
            inside = np.flatnonzero(own)
            done = self.share[w]
            for cut in range(0, len(w), CHUNK):
                tile = slice(cut, cut + CHUNK)
                done[tile] += np.einsum("nd,nd->n", hidden[tile], self.rows.take(kind[tile] + self.classes, 0))
            for cut in range(0, len(inside), CHUNK):
                tile = inside[cut : cut + CHUNK]
                done[tile] += np.einsum("nd,nd->n", hidden.take(tile, 0), self.rows.take(own[tile], 0))
            # Equal contexts are normalised once: over all classes, and over the words of each class they come before.
            pair = after * self.one + before
            some, which = distinct(pair)
            done -= self.log_sums(before[some], after[some], held)[which]
            some, which = distinct((kind[inside] - ALONE) * self.one**2 + pair[inside])
            some = inside[some]
            norms = np.empty(len(some))
            begin = np.searchsorted(kind[some], np.arange(ALONE, ALONE + SHARED + 1))
            for k in range(SHARED):
                of = self.rows[self.words + k * SIZE : self.words + k * SIZE + self.size[k]].T.copy()
                for cut in range(begin[k], begin[k + 1], TILE):
                    tile = slice(cut, min(cut + TILE, begin[k + 1]))
                    norms[tile] = log_sum_exp(hidden.take(some[tile], 0) @ of)
            done[inside] -= norms[which]
            out[part] = done
        return out

    def log_sums(self, two: np.ndarray, one: np.ndarray, held: Held | None) -> np.ndarray:
        """Logs of the sums over all classes. e^(a + b) is e^a times e^b, so exponentials are taken once per distinct word."""
        classes = self.rows[self.classes : self.words].T.copy()
        first, top, i = self._powers(two, 0, classes, held)
        second, top_second, j = self._powers(one, self.one, classes, held)
        total = np.empty(len(two), np.float32)
        for at in range(0, len(two), TILE):
            part = slice(at, at + TILE)
            np.einsum("nd,nd->n", first.take(i[part], 0), second.take(j[part], 0), out=total[part])
        out = np.log(np.maximum(total, 1e-20).astype(np.float64)) + top[i] + top_second[j]
        for part in np.array_split(np.flatnonzero(total < 1e-20), 1 + len(two) // TILE):  # their tops lie far apart
            out[part] = log_sum_exp(self.hidden(two[part], one[part]) @ classes)
        return out

    def _powers(self, places: np.ndarray, begin: int, classes: np.ndarray, held: Held | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each distinct word the exponentials of its context, which begin there, scaled by the largest, whose log comes
        next; then which is whose. Those of the most frequent words are held.
        """
        kept = 0 if held is None else min(KEPT, self.one)
        there = np.zeros(self.one, bool)
        there[places] = True
        there[:kept] = True
        mine = np.flatnonzero(there)
        if kept and begin in held:
            powers, tops = held[begin]
            first = kept
        else:
            room = min(kept + SCORED, self.one) if kept else len(mine)
            powers, tops = np.empty((room, CLASSES), np.float32), np.empty(room, np.float32)
            first = 0
            if kept:
                held[begin] = powers, tops
        for at in range(first, len(mine), TILE):
            part = slice(at, min(at + TILE, len(mine)))
            score = np.matmul(self.rows.take(begin + mine[part], 0), classes, out=powers[part])
            score -= score.max(1, out=tops[part])[:, None]
            np.exp(score, out=score)
        return powers, tops, (np.cumsum(there) - 1)[places]


def log_sum_exp(score: np.ndarray) -> np.ndarray:
    """Of each row."""
    most = score.max(1, initial=-np.inf, keepdims=True)
    score -= most
    return most[:, 0] + np.log(np.exp(score, out=score).sum(1, dtype=np.float32).astype(np.float64))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key first stands, by key, and for each key which of them it is. Keys are below 2^44."""
    bits = max(1, len(keys) - 1).bit_length()
    order = np.sort((keys << bits) | np.arange(len(keys)))
    keys, order = order >> bits, order & ((1 << bits) - 1)
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def sums(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, the sums of their rows, which begin anew where they end, and how many they were.

    Two columns are added as one complex number, which is faster.
    """
    order = np.sort((ids << 24) | np.arange(len(ids)))
    ids, order = order >> 24, order & ((1 << 24) - 1)
    begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    found = np.add.reduceat(rows.take(order, 0, mode="wrap").view(np.complex64), begin).view(np.float32)
    return ids[begin], found, np.diff(np.append(begin, len(ids)))


def _sigmoid(x: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Of x - expected, in place of x."""
    np.subtract(expected, x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Training:
    """A shard's own vectors: noise-contrastive steps, scaled by each vector's squares so far."""

    def __init__(self, model: LogBilinear, shard: int, part: int) -> None:
        self.model = model
        self.rows = model.rows.copy()
        self.squares = np.full(len(self.rows), SQUARE, np.float32)
        self.times = np.zeros(len(self.rows), np.int64)
        self.rng = np.random.default_rng([SEED, shard, part])
        self.upto = np.cumsum(model.noise) / model.noise.sum()
        self.log_noise = np.log(np.maximum(NOISE * model.noise, 1e-30)).astype(np.float32)

    def step(self, two: np.ndarray, one: np.ndarray, words: np.ndarray) -> None:
        """Tokens after two others. Each class is told from noise by frequency, each word from noise words of its class.

        Neighbours share noise classes, and tokens of a class share noise words.
        """
        m, rows = self.model, self.rows
        one = one + m.one
        n = len(words)
        hidden = np.zeros((n // TOGETHER * TOGETHER + TOGETHER, rows.shape[1]), np.float32)  # one after the last at least is empty
        np.add(rows.take(two, 0), rows.take(one, 0), out=hidden[:n])
        kind = m.kind[words]
        groups = hidden.reshape(-1, TOGETHER, rows.shape[1])
        drawn = np.searchsorted(self.upto, self.strata(len(groups), NOISE)).clip(max=CLASSES - 1)
        pull, from_noise = self.from_noise(groups, drawn + m.classes, self.log_noise[drawn])
        more, towards = self.towards(hidden[:n], kind + m.classes, self.log_noise[kind])
        pull[:n] += more
        moves = [sums(np.append(kind, drawn) + m.classes, np.concatenate([towards, from_noise]))]
        inside = np.flatnonzero((words >= ALONE) & (words < m.own))
        if len(inside):
            k = kind[inside] - ALONE
            inside = inside[np.argsort(k.astype(np.uint8 if SHARED <= 256 else k.dtype), kind="stable")]
            k = kind[inside] - ALONE
            tokens = np.bincount(k, minlength=SHARED)
            full = -(-tokens // TOGETHER_WORDS)
            place = np.arange(len(k)) + np.repeat((np.cumsum(full) - full) * TOGETHER_WORDS - (np.cumsum(tokens) - tokens), tokens)
            groups = np.full(full.sum() * TOGETHER_WORDS, n)
            groups[place] = inside
            groups = groups.reshape(-1, TOGETHER_WORDS)
            of = np.repeat(np.arange(SHARED), full)
            size = m.size[of][:, None]
            drawn = np.minimum((self.strata(len(groups), NOISE_WORDS) * size).astype(np.int64), size - 1) + of[:, None] * SIZE
            expected = np.log(NOISE_WORDS / m.size.clip(min=1)).astype(np.float32)
            more, towards = self.towards(hidden.take(inside, 0), words[inside] - ALONE + m.words, expected[k])
            from_all, from_noise = self.from_noise(hidden.take(groups, 0), drawn + m.words, np.repeat(expected[of][:, None], NOISE_WORDS, 1))
            pull[inside] += more + from_all.take(place, 0)
            moves.append(sums(np.append(words[inside] - ALONE, drawn) + m.words, np.concatenate([towards, from_noise])))
        pull[:, DIM:] = 0
        for move in [*moves, sums(np.append(two, one), pull[:n])]:
            self.move(*move)

    def strata(self, groups: int, draws: int) -> np.ndarray:
        """Numbers from 0 to 1: a group has one in each of as many equal parts as draws, and groups are spread in a part."""
        spread = np.arange(groups)[:, None] * GOLDEN + self.rng.random(draws)
        return (spread - np.floor(spread) + np.arange(draws)) / draws

    def towards(self, before: np.ndarray, ids: np.ndarray, expected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How each token is pulled by what it is, and the other way round."""
        vectors = self.rows.take(ids, 0)
        error = 1 - _sigmoid(np.einsum("nd,nd->n", before, vectors), expected)
        vectors *= error[:, None]
        return vectors, before * error[:, None]

    def from_noise(self, before: np.ndarray, ids: np.ndarray, expected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for groups of tokens and the noise of each group, with the logs of how often it is expected."""
        vectors = self.rows.take(ids, 0)
        error = np.matmul(before, vectors.transpose(0, 2, 1))
        error = np.negative(_sigmoid(error, expected[:, None, :]), out=error)
        wide = before.shape[2]
        return np.matmul(error, vectors).reshape(-1, wide), np.matmul(error.transpose(0, 2, 1), before).reshape(-1, wide)

    def move(self, ids: np.ndarray, grads: np.ndarray, times: np.ndarray) -> None:
        """The spare column stays zero, as that of the contexts is."""
        self.times[ids] += times
        self.squares[ids] += np.einsum("nd,nd->n", grads, grads) / (DIM + 2)
        grads *= (RATE / np.sqrt(self.squares[ids]))[:, None]
        self.rows[ids] = self.rows.take(ids, 0) + grads


#: Vectors go in blocks of neighbours: their places in it, how often each was used, and how far it moved.
BLOCK, BLOCKS = 1 << 10, "block long, ids binary, n binary, moved binary"


def place_rows(shared: Broadcast):
    """Texts as the places of their tokens, an end after each text; and their words that aren't broadcast, once each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in portions(batches, "body", PORTION):
            words, sizes = words_of(batch.column("body"))
            found = pc.index_in(words, value_set=v.listed)
            other = found.is_null()
            ends = np.cumsum(sizes + 1)
            places = np.zeros(ends[-1], np.int32)
            inside = np.ones(len(places), bool)
            inside[ends - 1] = False
            places[inside] = found.fill_null(len(v.kind)).to_numpy()
            listed = words.filter(other).dictionary_encode()
            text = np.repeat(np.arange(len(sizes)), sizes)[other.to_numpy(zero_copy_only=False)]
            each, times = np.unique(text * len(listed.dictionary) + listed.indices.to_numpy(), return_counts=True)
            text, word = np.divmod(each, max(1, len(listed.dictionary)))
            left = pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)), pa.int32())
            rare = [pa.ListArray.from_arrays(left, x) for x in (listed.dictionary.take(pa.array(word)), pa.array(times))]
            begin = np.append(0, ends * places.itemsize).astype(np.int32)
            held = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(begin), pa.py_buffer(places)])
            kept = ["others", "learn", "shard", "turn"]
            yield pa.record_batch([*(batch.column(c) for c in kept), held, *rare], [*kept, "places", "word", "k"])

    return rows


def vector_rows(shared: Broadcast, part: int):
    """The vectors that a shard used, after its steps, and how often it did; rows come by shard, in their order."""

    def moved(own: Training) -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(own.times)
        for ids in np.split(used, np.flatnonzero(np.diff(used // BLOCK)) + 1) if len(used) else ():
            change = (own.rows[ids] - own.model.rows[ids]).astype(np.float16)
            row = [int(ids[0]) // BLOCK, (ids % BLOCK).astype(np.int16).tobytes(), own.times[ids].astype(np.int32).tobytes(), change.tobytes()]
            yield pa.record_batch([pa.array([x]) for x in row], ["block", "ids", "n", "moved"])

    def steps(own: Training, texts: list[np.ndarray], last: bool) -> list[np.ndarray]:
        """Whole steps, whatever batches the texts came in; what is left of them."""
        sizes = np.array([len(t) for t in texts])
        words = np.concatenate(texts).astype(np.int64)
        two, one = with_contexts(words, sizes)
        ends = np.cumsum(sizes)
        done = 0
        while done < len(texts):
            begin = ends[done - 1] if done else 0
            upto = int(np.searchsorted(ends, begin + CHUNK))  # texts that together fill a step
            if upto >= len(texts):
                if not last:
                    break
                upto = len(texts) - 1
            part = slice(int(begin), int(ends[upto]))
            for at in range(part.start, part.stop, 2 * CHUNK):
                cut = slice(at, min(part.stop, at + 2 * CHUNK))
                own.step(two[cut], one[cut], words[cut])
            done = upto + 1
        return texts[done:]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        own, shard, texts = None, None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            held = batch.column("places")
            for at in range(batch.num_rows):
                if shards[at] != shard:
                    if own is not None:
                        if texts:
                            steps(own, texts, True)
                        yield from moved(own)
                    shard, texts = shards[at], []
                    own = Training(model, int(shard), part)
                texts.append(np.frombuffer(held[at].as_buffer(), np.int32))
                if len(texts) >= 512:
                    texts = steps(own, texts, False)
        if own is not None:
            if texts:
                steps(own, texts, True)
            yield from moved(own)

    return rows


def block_means(blocks: pa.Table) -> pa.Table:
    """Of all shards' rows of a block one, with the means; n is then for all."""
    total, times = np.zeros((BLOCK, DIM + 2)), np.zeros(BLOCK, np.int64)
    for r in sorted(blocks.to_pylist(), key=lambda r: (r["ids"], r["n"], r["moved"])):  # sums in one order
        at, n = np.frombuffer(r["ids"], np.int16), np.frombuffer(r["n"], np.int32)
        total[at] += np.frombuffer(r["moved"], np.float16).reshape(-1, DIM + 2) * n[:, None].astype(float)
        times[at] += n
    some = np.flatnonzero(times)
    block = blocks.column("block")[0].as_py()
    row = [block, (some + block * BLOCK).tobytes(), times[some].tobytes(), (total[some] / times[some, None]).astype(np.float32).tobytes()]
    return pa.table([pa.array([x]) for x in row], ["block", "ids", "n", "moved"])


def train(placed: DataFrame, model: LogBilinear, shards: int) -> None:
    """Moves the model's vectors, in each round by the means over shards, which go over their share of all tokens.

    placed: places, shard (of all rounds) and turn, which tell where a text belongs.
    """
    spark = placed.sparkSession
    for part in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        mine = placed.filter(F.col("shard") % ROUNDS == part).withColumn("shard", F.floor(F.col("shard") / ROUNDS).cast("int"))
        mine = mine.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "turn", "places")
        moved = mine.mapInArrow(vector_rows(shared, part), BLOCKS)
        for r in moved.groupBy("block").applyInArrow(block_means, BLOCKS).select("ids", "moved").collect():
            model.rows[np.frombuffer(r.ids, np.int64)] += np.frombuffer(r.moved, np.float32).reshape(-1, DIM + 2)
        shared.destroy()


def score_rows(shared: Broadcast):
    """For each text its tokens, and of those that are broadcast the known ones and the sums of both models' logs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, model = shared.value
        rare = v.log_share()[RARE]
        log_counts = np.append(v.log_count, 0.0)
        held: Held = {}
        for batch in portions(batches, "places", 4 * SCORED):
            data, begin = flat(batch.column("places"))
            words = data.view(np.int32).astype(np.int64)
            sizes = np.diff(begin) // 4
            first = np.cumsum(sizes) - sizes
            there = words < len(v.kind)
            log_count = log_counts[words]
            modelled = model.log_probabilities(*with_contexts(words, sizes), words, held) / np.log(10) - np.where(there, 0.0, rare)
            added = [np.add.reduceat(x, first) for x in ((log_count > 0).astype(np.int64), log_count, modelled)]
            yield pa.record_batch(
                [batch.column("others"), pa.array(sizes), *map(pa.array, added)], ["others", "n_tokens", "n_known", "counts", "model"]
            )

    return rows


def most_frequent(counts: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """The most frequent words, `head` at most and the end, most frequent first: all words above one count.

    The count comes from a table of some thousand bands of counts, so tasks send no more than the words that are kept.
    """
    band = F.floor(F.log2("n") * 64)
    bands = counts.groupBy(band.alias("band")).agg(F.count("*").alias("k")).orderBy(F.desc("band")).collect()
    least, held = None, 0
    for r in bands:
        held += r.k
        if held > head:
            break
        least = r.band
    end = F.col("word") == F.lit(END.encode())
    kept = counts.filter(end if least is None else end | (band >= least)).collect()
    return sorted(((bytes(r.word), r.n) for r in kept), key=lambda r: (-r[1], r[0]))


def score(docs: DataFrame, training: Column, head: int = HEAD) -> DataFrame:
    """docs without text, with n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text).

    training tells the rows to learn from. A null text is empty: its only token is the end. Without training rows every
    word is unknown. Repeated rows count as often as they occur. Columns of docs with the name of a result are replaced.
    """
    spark = docs.sparkSession
    made = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made | {"text"}]
    row = F.struct(F.monotonically_increasing_id().alias("__row"), *others).alias("others")
    key = F.col("doc_id").cast("string") if "doc_id" in docs.columns else F.lit(None).cast("string")
    bodies = docs.filter(training).select(text_bytes().alias("body"))
    counts = staged(bodies.mapInArrow(count_rows, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    v = vocabulary(most_frequent(counts, head), total, distinct)
    listed = spark.sparkContext.broadcast(v)
    shards = max(1, round(total / SHARD))
    shard = F.pmod(F.xxhash64(key, text_bytes()), F.lit(shards * ROUNDS)).cast("int").alias("shard")
    turn = F.xxhash64(F.lit(1), key, text_bytes()).alias("turn")
    rows = docs.select(row, F.coalesce(training, F.lit(False)).alias("learn"), shard, turn, text_bytes().alias("body"))
    kind = f"others {rows.schema['others'].dataType.simpleString()}"
    placed = staged(rows.mapInArrow(place_rows(listed), f"{kind}, learn boolean, shard int, turn long, places binary, word array<binary>, k array<long>"), "lm-places")
    listed.destroy()
    model = LogBilinear(v)
    if total:
        train(placed.filter("learn").select("shard", "turn", "places"), model, shards)
    both = spark.sparkContext.broadcast((v, model))
    results = f"{kind}, n_tokens long, n_known long, counts double, model double"
    scored = placed.select("others", "places").mapInArrow(score_rows(both), results)
    # The words that aren't broadcast: each distinct one of a text meets its count.
    words = placed.select("others.__row", F.inline(F.arrays_zip("word", "k")))
    logs = F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more")
    rare = words.join(counts, "word").groupBy("__row").agg(logs, F.sum("k").alias("known"))
    done = scored.join(rare.withColumnRenamed("__row", "r"), F.col("others.__row") == F.col("r"), "left")
    more = F.coalesce("more", F.lit(0.0))
    base = F.col("counts") + more - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    return done.select(
        "others.*",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model") + more).alias("score"),
    ).drop("__row")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the model and the add-one unigram, both learnt from six sevenths of the documents."""
    held_out = id_bucket(7) == 2
    docs = documents(spark, sf_dir).select("doc_id", "text", held_out.alias("held_out"))
    return score(docs, ~F.col("held_out")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
