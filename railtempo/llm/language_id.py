"""Language ID by cross-parsing: a text is cut into the longest phrases that a language's sample holds.

The language whose sample needs fewest phrases, normalised by the size of the sample, wins. Each language's sample is a
suffix automaton over its own letters, held as a dense table or, where that is large, as a hash table with the same
content, so that numpy follows a great many pieces of text at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtempo.llm.common import documents, id_bucket, slices
from railtempo.llm.suffix_automaton import SuffixAutomaton

#: The sample of a language: at most so many documents, of longer ones a piece of so many characters, and so many letters.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LETTERS = 96, 4000, 32768
#: Cells of a language's dense table and of all together, which every task holds; the others are hash tables.
CELLS, ALL_CELLS = 1 << 22, 1 << 25
#: Letters that are parsed in one go; a phrase ends with its piece.
PIECE = 256
UNKNOWN = "und"
#: Codes: padding, a gap between words, a letter that no sample holds; letters follow.
PAD, GAP, FOREIGN, FIRST = 0, 1, 2, 3


@cache
def letter_codes() -> np.ndarray:
    """For each code point its lower-case letter's code point, 0 if it is none."""
    every = (chr(c) for c in range(0x110000))
    return np.fromiter((ord(x.lower()[0]) if x.isalpha() else 0 for x in every), np.int32, 0x110000)


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, runs of anything else as one 0, and how many each text has."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    low = letter_codes()[points]
    keep = low > 0
    keep[1:] |= (low[:-1] > 0) & (doc[1:] == doc[:-1])
    return low[keep], np.bincount(doc[keep], minlength=len(texts))


class Dense:
    """An automaton's moves: at state * size + letter twice the next state * size, odd where the phrase ended before."""

    def __init__(self, automaton: SuffixAutomaton, size: int) -> None:
        # A letter that the sample lacks is a phrase of its own: the last state, which no phrase goes on from.
        alone = len(automaton.next) * size * 2
        root = np.full(size, alone, np.int32)
        for t, state in automaton.next[0].items():
            root[t] = state * size * 2
        table = np.tile(root + 1, (len(automaton.next) + 1, 1))
        table[0] = root
        table[:, PAD] = 0
        for state, moves in enumerate(automaton.next):
            for t, there in moves.items():
                table[state, t] = there * size * 2
        self.table = table.ravel()

    def phrases(self, pieces: np.ndarray) -> np.ndarray:
        """Phrases of each column."""
        state = np.zeros(pieces.shape[1], np.int32)
        ends = np.ones(pieces.shape[1], np.int32)
        for row in pieces:
            state += row
            np.take(self.table, state, out=state, mode="clip")
            ends += state & 1
            state >>= 1
        return ends


class Sparse:
    """The same moves in a hash table, at most a quarter full, with steps to the next place."""

    def __init__(self, automaton: SuffixAutomaton, size: int) -> None:
        alone = len(automaton.next)
        self.size = size
        self.root = np.full(size, alone, np.int64)
        self.root[PAD] = 0
        for t, state in automaton.next[0].items():
            self.root[t] = state
        moves = [(state * size + t, there) for state, own in enumerate(automaton.next) for t, there in own.items()]
        bits = max(4, (4 * len(moves)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1), np.zeros(1 << bits, np.int32)
        keys, there = np.array(moves, np.int64).reshape(-1, 2).T
        at = self.place(keys)
        while len(keys):
            some = np.flatnonzero(self.keys[at] < 0)
            self.keys[at[some]], self.next[at[some]] = keys[some], there[some]
            left = self.keys[at] != keys
            keys, there, at = keys[left], there[left], (at[left] + 1) & self.mask

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def phrases(self, pieces: np.ndarray) -> np.ndarray:
        """Phrases of each column."""
        state = np.zeros(pieces.shape[1], np.int64)
        ends = np.ones(pieces.shape[1], np.int32)
        for row in pieces:
            key = state * self.size + row
            at = self.place(key)
            held = self.keys[at]
            while len(more := np.flatnonzero((held != key) & (held >= 0))):
                at[more] = (at[more] + 1) & self.mask
                held[more] = self.keys[at[more]]
            found = held == key
            ends += ~found & (state > 0) & (row != PAD)
            state = np.where(found, self.next[at], self.root[row])
        return ends


class Samples:
    """The languages' automata, in the order of their names. A sample depends on its own language's texts only."""

    def __init__(self, texts: dict[str, list[str]], cells: int = CELLS, all_cells: int = ALL_CELLS) -> None:
        found = {lang: letters(texts[lang])[0] for lang in sorted(texts)}
        found = {lang: points[:SAMPLE_LETTERS] for lang, points in found.items() if points.any()}
        alphabet = np.unique(np.concatenate([*found.values(), [0]]))[1:]
        self.codes = np.full(0x110000, FOREIGN, np.int32)
        self.codes[0] = GAP
        self.codes[alphabet] = np.arange(FIRST, len(alphabet) + FIRST)
        self.langs = list(found)
        #: For each language the codes of its own letters by the codes of all, and its moves.
        self.own, self.tables, self.bits = [], [], []
        for points in found.values():
            codes = np.unique(self.codes[points[points > 0]])
            own = np.full(len(alphabet) + FIRST, FOREIGN, np.int32)
            own[[PAD, GAP]] = PAD, GAP
            own[codes] = np.arange(FIRST, len(codes) + FIRST)
            automaton = SuffixAutomaton()
            automaton.add(own[self.codes[points]].tolist())
            size = len(codes) + FIRST
            need = (len(automaton.next) + 1) * size
            dense = need <= min(cells, all_cells)
            all_cells -= need if dense else 0
            self.own.append(own)
            self.tables.append((Dense if dense else Sparse)(automaton, size))
            self.bits.append(float(np.log2(len(points) + 1)))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that each text needs, a column for each language, and its letters."""
        low, count = letters(texts)
        lanes = -(-count // PIECE)
        first = np.cumsum(lanes) - lanes
        at = np.arange(len(low)) - np.repeat(np.cumsum(count) - count, count)
        pieces = np.zeros((PIECE, int(lanes.sum())), np.int32)
        pieces[at % PIECE, np.repeat(first, count) + at // PIECE] = self.codes[low]
        out = np.zeros((len(texts), len(self.langs)))
        some = np.flatnonzero(lanes)
        for k, table in enumerate(self.tables if len(some) else ()):
            out[some, k] = np.add.reduceat(table.phrases(self.own[k][pieces]), first[some])
        return out, count

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and a score: how much fewer normalised phrases it needs than the next."""
        needed, count = self.phrases([t or "" for t in texts])
        cost = needed * np.array(self.bits)
        langs, scores = [], []
        for row, n in zip(cost, count.tolist(), strict=True):
            if not n or not self.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            order = np.argsort(row, kind="stable")
            langs.append(self.langs[order[0]])
            scores.append(float(1 - row[order[0]] / row[order[1]]) if len(order) > 1 else 1.0)
        return langs, scores


def learn(labelled: DataFrame) -> Samples:
    """labelled: text and lang. A bounded sample of each language, chosen by a hash of the text.

    Rows without lang, or without a letter, are left out. Of a long text a piece of SAMPLE_CHARS characters is taken, from
    a place that its hash gives; runs of other characters count as one there, so every piece has letters. The samples
    come to the driver: SAMPLE_DOCS texts or pieces for each language at most.
    """
    usable = labelled.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.withColumn("name", F.xxhash64("text"))
    ranked = usable.select("lang", "name").distinct()
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("name")))
    chosen = ranked.filter(F.col("rank") <= SAMPLE_DOCS).select("lang", "name").collect()
    if not chosen:
        return Samples({})
    names = [r.name for r in chosen]
    folded = usable.filter(F.col("name").isin(names)).withColumn("text", F.regexp_replace("text", r"\P{L}+", " "))
    start = F.pmod("name", F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1)).cast("long")).cast("int") + 1
    rows = folded.withColumn("text", F.substring("text", start, F.lit(SAMPLE_CHARS))).distinct().collect()
    rows = sorted((r.lang, r.name, r.text) for r in rows if (r.lang, r.name) in {(c.lang, c.name) for c in chosen})
    return Samples({lang: [r[2] for r in own] for lang, own in groupby(rows, lambda r: r[0])})


def predict(docs: DataFrame, samples: Samples) -> DataFrame:
    """docs with lang_pred and score (0 to 1) in place of columns of these names.

    A text that is null or has no letters is "und", with score 0; so is every text if nothing was learned. Ties go to
    the language that is first by code point.
    """
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    others = [c for c in docs.columns if c.lower() not in {"lang_pred", "score"}]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others if c.lower() != "text"]).alias("others"), "text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            langs, scores = shared.value.predict(batch.column("text").to_pylist())
            columns = [batch.column("others"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, ["others", "lang_pred", "score"])

    kind = rows.schema["others"].dataType.simpleString()
    return rows.mapInArrow(label, f"others {kind}, lang_pred string, score double").select("others.*", "lang_pred", "score")


def held_out() -> Column:
    return id_bucket(3) == 1


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language and a score, learnt from two thirds of the labelled documents."""
    docs = documents(spark, sf_dir)
    samples = learn(docs.filter(~held_out()))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(rows, samples).select("doc_id", "held_out", "lang_pred", "score")
