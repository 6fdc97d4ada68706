"""Quality classifier from weak labels: heuristic labellers, their accuracies, and a hashed linear scorer.

Labellers fire or not on every document; people's labels, where there are any, are three more that may abstain.
Expectation-maximisation over the counts of all firing patterns (a fixed number, whatever the size of the corpus)
estimates how often each fires on clean, junk and abusive documents. The posteriors of a bounded sample then train a
linear scorer on hashed words, word beginnings and shapes, which judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtempo.llm.common import cut, documents, flat, slices
from railtempo.llm.quality_rules import lines_of, per_text, repeated_words
from railtempo.llm.winnow import mixed, word_places

CLASSES = ["clean", "junk", "toxic"]
CLEAN, JUNK, TOXIC = range(3)
#: Two lists of words of abuse; a list is a labeller.
ABUSE = (
    "idiot stupid moron imbecile fool dumb scum vermin bastard",
    "pathetic worthless loser trash disgusting clown garbage filth jerk",
)
#: Labellers and the class that each speaks for.
LABELLERS = {
    "symbols": JUNK,
    "shouting": JUNK,
    "repeated passages": JUNK,
    "repeated lines": JUNK,
    "repeated words": JUNK,
    "few distinct words": JUNK,
    "no words": JUNK,
    "abuse, first list": TOXIC,
    "abuse, second list": TOXIC,
    "abuse, several": TOXIC,
    "plain shape": CLEAN,
    "varied words": CLEAN,
    "people: good": CLEAN,
    "people: bad": JUNK,
    "people: toxic": TOXIC,
}
#: The first of the labellers that are people: where none of them fires, they abstain.
PEOPLE = len(LABELLERS) - 3
#: How often a heuristic may fire on other classes and on its own (none sees every language), and people on others.
STRAY, OWN, SLIP = 0.03, 0.8, 1e-4
#: The scorer's training sample: at most so many documents that the weak labels hold for each class, of at most so many
#: characters; the hashed features; passes over the sample; what a weight must be worth.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 16000
BUCKETS, PASSES, RATE, SPARSE = 1 << 40, 100, 0.3, 4e-4
SHAPES, BINS, PREFIX = 7, 12, 4
MOST_THIN = 1 << 30

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 32
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LETTER = _UPPER.copy()
_LETTER[97:123] = 1
_SIGN = np.zeros(256, np.int64)
_SIGN[np.frombuffer(b"#*$%&|<>@^~=+{}[]\\_", np.uint8)] = 1
_MARK = np.zeros(256, np.int64)
_MARK[33] = 1


def word_hashes(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    return word_places(data, np.array([0, len(data)]))[0]


class Texts:
    """What labellers and scorer see of a batch of texts."""

    def __init__(self, column: pa.Array) -> None:
        data, begins = flat(column)
        folded = _FOLD[data]
        self.hashes, self.words, starts = word_places(folded, begins)
        self.beginnings, self.begun = word_beginnings(folded, starts)
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.words))
        _, raw, _ = raw_words = word_places(data, begins)
        n = np.diff(raw).astype(float)
        least = np.maximum(n, 1)
        ink = np.maximum(np.diff(begins), 1)
        lines = np.array([lines_of(b) for b in column.cast(pa.binary()).to_pylist()], float).reshape(-1, 2)
        same = np.zeros(len(raw_words[0]) + 1, np.int64)
        own = np.repeat(np.arange(len(column)), np.diff(raw))
        same[1:-1] = (raw_words[0][1:] == raw_words[0][:-1]) & (own[1:] == own[:-1])
        order = np.unique(mixed(own.astype(np.uint64) + np.uint64(1)) ^ raw_words[0], return_index=True)[1]
        self.n = n
        self.symbols = per_text(_SIGN[data], begins) / ink
        self.shouting = per_text(_UPPER[data], begins) / np.maximum(per_text(_LETTER[data], begins), 1)
        self.marks = np.minimum(per_text(_MARK[data], begins) / least, 1)
        self.passages = repeated_words(raw_words[0], raw) / least
        self.lines = lines[:, 1] / np.maximum(lines[:, 0], 1)
        self.line_count = lines[:, 1]
        self.stutter = per_text(same[:-1], raw) / least
        self.distinct = np.bincount(own[order], minlength=len(column)) / least
        self.abuse = [per_text(np.isin(self.hashes, word_hashes(a)).astype(np.int64), self.words) for a in ABUSE]

    def pattern(self) -> np.ndarray:
        """Bit i tells whether labeller i fires."""
        fires = [
            self.symbols > 0.03,
            (self.shouting > 0.35) & (self.n > 4) | (self.marks > 0.3),
            self.passages > 0.2,
            (self.lines > 0.25) & (self.line_count > 2),
            (self.stutter > 0.2) & (self.n > 9),
            (self.distinct < 0.35) & (self.n > 19),
            self.n == 0,
            self.abuse[0] > 0,
            self.abuse[1] > 0,
            self.abuse[0] + self.abuse[1] > 1,
            (self.n > 0) & (self.symbols < 0.01) & (self.shouting < 0.25) & (self.marks < 0.1),
            (self.n > 0) & (self.distinct > 0.5) & (self.stutter < 0.1) & (self.passages < 0.2),
        ]
        return sum(f.astype(np.int64) << i for i, f in enumerate(fires))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and hashed feature, with repeats: words, beginnings of words, and the bins of the shapes."""
        shapes = [self.symbols * 4, self.shouting, self.marks, self.passages, self.lines, self.stutter, 1 - self.distinct]
        bins = [np.minimum(np.sqrt(s) * BINS, BINS - 1).astype(np.int64) + i * BINS for i, s in enumerate(shapes)]
        every = np.arange(len(self.n))
        doc = np.concatenate([self.doc, self.doc[self.begun], *[every] * len(bins)])
        hashes = np.concatenate([self.hashes, self.beginnings])
        words = SHAPES * BINS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
        return doc, np.concatenate([words, *bins])


def word_beginnings(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first PREFIX bytes of the words that are longer, and which words these are."""
    padded = np.concatenate([data, np.full(PREFIX + 1, 32, np.uint8)])
    whole = np.ones(len(starts), bool)
    first = np.zeros(len(starts), np.uint64)
    for k in range(PREFIX + 1):
        byte = padded[starts + k]
        whole &= byte != 32
        if k < PREFIX:
            first = (first << np.uint64(8)) | byte
    begun = np.flatnonzero(whole)
    return mixed(first[begun] + np.uint64(1 << 40)), begun


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes, and how often each labeller fires in each class (labellers by classes)."""
    speaks = np.array(list(LABELLERS.values()))
    fires, there = votes(patterns)
    rate = np.where(speaks[:, None] == np.arange(len(CLASSES)), 0.6, 0.02)
    rate[speaks == CLEAN] = [0.9, 0.2, 0.7]
    rate[PEOPLE] = [0.9, 0.05, 0.05]
    most = np.where(speaks[:, None] == np.arange(len(CLASSES)), OWN, STRAY)
    most[speaks == CLEAN] = 1 - 1e-4
    most[PEOPLE:] = np.where(speaks[PEOPLE:, None] == np.arange(len(CLASSES)), 1 - 1e-4, SLIP)
    share = np.array([0.8, 0.1, 0.1])
    prior = rate * 2, 2.0
    for _ in range(rounds):
        weight = posterior(patterns, share, rate) * counts[:, None]
        total = weight.sum(0)
        share = (total + 1) / (total.sum() + len(CLASSES))
        rate = np.clip((fires.T @ weight + prior[0]) / (there.T @ weight + prior[1]), SLIP, most)
    return share, rate


def votes(patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Who fires, and who doesn't abstain."""
    fires = (patterns[:, None] >> np.arange(len(LABELLERS)) & 1).astype(float)
    there = np.ones_like(fires)
    there[:, PEOPLE:] = fires[:, PEOPLE:].any(1)[:, None]
    return fires, there


def posterior(patterns: np.ndarray, share: np.ndarray, rate: np.ndarray) -> np.ndarray:
    fires, there = votes(patterns)
    log = fires @ np.log(rate) + (there - fires) @ np.log(1 - rate) + np.log(share)
    log -= log.max(1, keepdims=True)
    return np.exp(log) / np.exp(log).sum(1, keepdims=True)


class Scorer:
    """A linear scorer: hashed features of some worth, sorted, and their weights for each class."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, share: np.ndarray | None = None) -> None:
        """rows: the distinct features of each text; labels: its posterior; share: of the classes among all texts.

        The sample has as many texts of each class as it can get, so the score of junk against clean is moved by what
        the sample has too much of it; that of abuse isn't, as a miss is worse there.
        """
        self.shift = np.zeros(len(CLASSES))
        if rows and share is not None:
            more = np.log(np.maximum(share, 1e-6)) - np.log(np.maximum(labels.mean(0), 1e-6))
            self.shift[JUNK] = min(0.0, more[JUNK] - more[CLEAN])
        self.features = np.zeros(0, np.int64)
        self.weights = np.zeros((0, len(CLASSES)))
        if rows:
            doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
            self.train(np.concatenate(rows), doc, labels)
        self.sieve = np.zeros(1 << 18, bool)
        self.sieve[self.features & (len(self.sieve) - 1)] = True

    def train(self, feature: np.ndarray, doc: np.ndarray, labels: np.ndarray) -> None:
        used, column, times = np.unique(feature, return_inverse=True, return_counts=True)
        # Features that one text alone has teach nothing.
        known = times > 1
        some = known[column]
        used, column, doc = used[known], (np.cumsum(known) - 1).astype(np.int32)[column[some]], doc[some]
        del feature, some
        w = np.zeros((len(used), len(CLASSES)))
        state = np.full(w.shape, 1e-6)
        for _ in range(PASSES):
            score = np.stack([np.bincount(doc, w[column, c], len(labels)) for c in range(len(CLASSES))], 1)
            error = labels - softmax(score)
            grad = np.stack([np.bincount(column, error[doc, c], len(used)) for c in range(len(CLASSES))], 1) / len(labels)
            state += grad * grad
            rate = RATE / np.sqrt(state)
            w += rate * grad
            w = np.sign(w) * np.maximum(np.abs(w) - rate * SPARSE, 0)
        worth = w.any(1)
        self.features, self.weights = used[worth], w[worth]

    def probabilities(self, texts: Texts) -> np.ndarray:
        doc, feature = texts.features()
        some = np.flatnonzero(self.sieve[feature & (len(self.sieve) - 1)])
        doc, feature = doc[some], feature[some]
        at = np.searchsorted(self.features, feature)
        found = at < len(self.features)
        found[found] = self.features[at[found]] == feature[found]
        size = len(self.features) + 1
        both = np.unique(doc[found] * size + at[found])
        doc, at = both // size, both % size
        scores = np.stack([np.bincount(doc, self.weights[at, c], len(texts.n)) for c in range(len(CLASSES))], 1)
        return softmax(scores + self.shift)


def softmax(score: np.ndarray) -> np.ndarray:
    score = score - score.max(1, keepdims=True)
    return np.exp(score) / np.exp(score).sum(1, keepdims=True)


def body_of(batch: pa.RecordBatch) -> pa.Array:
    return pc.fill_null(batch.column("text"), "")


def learn(docs: DataFrame, labels: DataFrame | None = None) -> Scorer:
    """The scorer, from the texts of docs and, where there are, labels (doc_id, quality, toxic: 0, 1 or null)."""
    spark = docs.sparkSession

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            fires = pa.array(Texts(body_of(batch)).pattern())
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "name", "size")), fires], ["doc_id", "name", "size", "pattern"])

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("name"), F.coalesce(F.length("text"), F.lit(0)).alias("size"), "text")
    rows = named.mapInArrow(patterns, "doc_id long, name long, size int, pattern long")
    if labels is not None:
        toxic, bad = F.max("toxic") == 1, F.min("quality") == 0
        said = F.when(toxic, 4).when(bad, 2).when(F.min("quality") == 1, 1).otherwise(0)
        said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.shiftleft(said, PEOPLE).alias("said"))
        rows = rows.join(said, "doc_id", "left").withColumn("pattern", F.col("pattern") + F.coalesce("said", F.lit(0)))
    rows = cut(rows.select("name", "size", "pattern"))
    found = rows.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    if not found:
        return Scorer([], np.zeros((0, len(CLASSES))))
    seen, counts = np.array([r.pattern for r in found]), np.array([r.n for r in found], float)
    share, rate = expectation_maximisation(seen, counts)
    chances = posterior(seen, share, rate)
    best = {c: [int(p) for p, k in zip(seen, chances.argmax(1), strict=True) if k == c] for c in range(len(CLASSES))}
    which = F.when(F.col("pattern").isin(best[JUNK]), JUNK).when(F.col("pattern").isin(best[TOXIC]), TOXIC).otherwise(CLEAN)
    # A hash thins out what is far more than the sample needs, so that no task ranks a whole class.
    told = F.col("pattern") >= (1 << PEOPLE)
    thin = F.lit(MOST_THIN)
    for c in best:
        for said in (False, True):
            many = sum(n for p, n in zip(seen.tolist(), counts.tolist(), strict=True) if p in best[c] and (p >= 1 << PEOPLE) == said)
            share = int(min(1.0, 4 * SAMPLE_DOCS / max(many, 1)) * MOST_THIN)
            thin = F.when((which == c) & (told == said), share).otherwise(thin)
    usable = rows.filter((F.col("size") <= SAMPLE_CHARS) & (F.pmod(F.xxhash64("name"), F.lit(MOST_THIN)) < thin))
    # Of equal texts with different labels the one of most labels counts.
    usable = usable.groupBy("name").agg(F.max("pattern").alias("pattern")).select("name", "pattern", which.alias("class"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy((F.col("pattern") < (1 << PEOPLE)).cast("int"), "name"))
    chosen = usable.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_DOCS).select("name", "pattern").collect()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            doc, feature = Texts(body_of(batch)).features()
            lists = [np.unique(feature[doc == i]).tobytes() for i in range(batch.num_rows)]
            yield pa.record_batch([batch.column("name"), pa.array(lists, pa.binary())], ["name", "features"])

    names = spark.createDataFrame([(r.name,) for r in chosen], "name long")
    sample = named.select("name", "text").join(F.broadcast(names), "name", "left_semi").dropDuplicates(["name"])
    # As bytes: numbers as objects would take four times the driver's memory.
    sample = {r.name: r.features for r in sample.mapInArrow(features, "name long, features binary").collect()}
    order = sorted((r for r in chosen if r.name in sample), key=lambda r: r.name)
    labels = chances[np.searchsorted(seen, [r.pattern for r in order])]
    return Scorer([np.frombuffer(sample.pop(r.name), np.int64) for r in order], labels, share)


def classify(docs: DataFrame, labels: DataFrame | None = None, scorer: Scorer | None = None) -> DataFrame:
    """docs with p_clean, p_junk, p_toxic, label and kept (label is clean) in place of columns of these names.

    A null text is empty; a text without words is junk as far as the corpus has such. Ties go to the first class.
    Repeated rows are judged alike. An empty table gives an empty result.
    """
    scorer = learn(docs, labels) if scorer is None else scorer
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    made = [*[f"p_{c}" for c in CLASSES], "label", "kept"]
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    rows = docs.select(F.struct(*others).alias("others"), "text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            chances = shared.value.probabilities(Texts(body_of(batch)))
            best = chances.argmax(1)
            columns = [pa.array(chances[:, c]) for c in range(len(CLASSES))]
            columns += [pa.array([CLASSES[b] for b in best], pa.string()), pa.array(best == CLEAN)]
            yield pa.record_batch([batch.column("others"), *columns], ["others", *made])

    kind = rows.schema["others"].dataType.simpleString()
    chances = ", ".join(f"p_{c} double" for c in CLASSES)
    return rows.mapInArrow(judged, f"others {kind}, {chances}, label string, kept boolean").select("others.*", *made)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of each class, the likeliest one, and whether it is kept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = classify(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return judged.select("doc_id", *[f"p_{c}" for c in CLASSES], "label", "kept")
