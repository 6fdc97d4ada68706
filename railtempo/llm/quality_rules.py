"""Quality rules: counts of a text, fixed limits, and robust outliers among documents of a language and source.

The location and scatter of each language and source come from the minimum covariance determinant: concentration steps
over all its documents, where each step keeps the share nearest by Mahalanobis distance. A step is one aggregation by
group and distance bin, so a source that holds a third of all documents is summed up in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtempo.llm.common import cut, documents, flat, slices, text_bytes
from railtempo.llm.winnow import MIX, mixed, word_places

REPEAT = 5
LEAST_WORDS, REPEAT_PERCENT = 10, 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: Groups with fewer documents are judged by the estimate over all documents.
LEAST_GROUP = 50
SUBSET = 0.75
STEPS = 8
#: Squared distances beyond this, where the clean ones follow a chi-square law of four degrees, are outliers: the
#: quantile that leaves 1e-12.
CUTOFF = 62.0
#: Least standard deviation of each transformed count, so that counts that are mostly zero don't reject every other value.
FLOORS = (0.25, 0.03, 0.08, 0.08)
SIZE = len(FLOORS)

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1
_POINT = np.ones(256, np.int64)
_POINT[[9, 10, 11, 12, 13, 32, *range(0x80, 0xC0)]] = 0


def per_text(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[begins[1:]] - total[begins[:-1]]


def repeated_words(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Words of each text in windows of REPEAT words that the text has twice or more."""
    if len(hashes) < REPEAT:
        return np.zeros(len(begins) - 1, np.int64)
    doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    grams = mixed(doc.astype(np.uint64) + np.uint64(1))[: len(hashes) - REPEAT + 1]
    for k in range(REPEAT):
        grams = mixed(grams * MIX + hashes[k : len(hashes) - REPEAT + 1 + k])
    whole = np.flatnonzero(doc[: len(grams)] == doc[REPEAT - 1 :])
    order = whole[np.argsort(grams[whole])]
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(hashes) + 1, np.int64)
    found = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    np.add.at(twice, found, 1)
    np.add.at(twice, found + REPEAT, -1)
    return per_text((np.cumsum(twice)[:-1] > 0).astype(np.int64), begins)


def lines_of(body: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them are equal to an earlier one."""
    lines = [x for x in body.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1024):
        data, begins = flat(batch.column("body"))
        hashes, words, _ = word_places(data, begins)
        lines = np.array([lines_of(b) for b in batch.column("body").to_pylist()], np.int64).reshape(-1, 2)
        columns = [np.diff(words), per_text(_POINT[data], begins), per_text(_SYMBOL[data], begins), lines[:, 0], lines[:, 1], repeated_words(hashes, words)]
        yield pa.record_batch([batch.column("others"), *[pa.array(c.astype(np.int64)) for c in columns]], ["others", *COUNTS])


def text_counts(docs: DataFrame) -> DataFrame:
    """docs without text, and its counts; columns of their names are replaced."""
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {"text", *COUNTS}]
    rows = docs.select(F.struct(*others).alias("others"), text_bytes().alias("body"))
    kind = rows.schema["others"].dataType.simpleString()
    return rows.mapInArrow(count_rows, f"others {kind}, " + ", ".join(f"{c} long" for c in COUNTS)).select("others.*", *COUNTS)


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)


def vector() -> Column:
    """Word length drawn to 5 for short texts, and roots of the shares of symbols, repeated lines and repeated words."""
    n = F.col("n_words").cast("double")
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(b, F.lit(1.0)))
    shapes = [(F.col("word_chars") + 500) / (n + 100), share("n_symbols", F.col("word_chars")), share("n_dup_lines", F.col("n_lines") + 4), share("n_repeat_words", n + 20)]
    return F.array(*[x.cast("double") for x in shapes])


def factor(share: float) -> float:
    """What makes the scatter of the nearest share of normal vectors in four dimensions the scatter of all."""
    low, high = 0.0, 100.0
    for _ in range(80):
        x = (low + high) / 2
        low, high = (x, high) if 1 - exp(-x / 2) * (1 + x / 2) < share else (low, x)
    return share / (1 - exp(-low / 2) * (1 + low / 2 + low * low / 8))


def inverses(scale: float):
    """Rows of a group's sums to its centre and inverse scatter."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for g, n, total, square in zip(frame.g, frame.n, frame.total, frame.square, strict=True):
                centre = np.array(total) / n
                scatter = scale * (np.array(square).reshape(SIZE, SIZE) / n - np.outer(centre, centre))
                scatter += np.diag(np.square(FLOORS))
                out.append((g, centre.tolist(), np.linalg.inv(scatter).ravel().tolist()))
            yield pd.DataFrame(out, columns=["g", "centre", "inverse"])

    return rows


FIT = "g string, centre array<double>, inverse array<double>"


def distance() -> Column:
    z = [F.col("x")[i] - F.col("centre")[i] for i in range(SIZE)]
    return F.greatest(sum(z[i] * z[j] * F.col("inverse")[i * SIZE + j] for i in range(SIZE) for j in range(SIZE)), F.lit(0.0))


def fit(rows: DataFrame) -> DataFrame:
    """FIT rows for each g, from rows of g and x. Starts at the quartiles; every step uses all rows."""
    ranges = rows.select("g", *[F.col("x")[i].alias(f"x{i}") for i in range(SIZE)]).groupBy("g")
    ranges = ranges.agg(*[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(SIZE)])
    spread = [F.lit(1.0) / (F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.35, 2) + FLOORS[i] ** 2) for i in range(SIZE)]
    start = [spread[i] if i == j else F.lit(0.0) for i in range(SIZE) for j in range(SIZE)]
    fitted = cut(ranges.select("g", F.array(*[F.col(f"q{i}")[1] for i in range(SIZE)]).alias("centre"), F.array(*start).alias("inverse")))
    for _ in range(STEPS):
        near = rows.join(fitted, "g").withColumn("bin", F.floor(F.log2(F.greatest(distance(), F.lit(1e-6))) * 16))
        sums = [F.sum(F.col("x")[i]).alias(f"t{i}") for i in range(SIZE)]
        sums += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"s{i}{j}") for i in range(SIZE) for j in range(i, SIZE)]
        binned = near.groupBy("g", "bin").agg(F.count("*").alias("n"), *sums)
        every, upto = Window.partitionBy("g"), Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        binned = binned.withColumn("all", F.sum("n").over(every)).withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        kept = binned.filter(F.col("before") < F.ceil(F.col("all") * SUBSET)).groupBy("g").agg(*[F.sum(c).alias(c) for c in binned.columns[2:-2]])
        square = F.array(*[F.col(f"s{min(i, j)}{max(i, j)}") for i in range(SIZE) for j in range(SIZE)])
        kept = kept.select("g", "n", F.array(*[F.col(f"t{i}") for i in range(SIZE)]).alias("total"), square.alias("square"))
        fitted = cut(kept.mapInPandas(inverses(factor(SUBSET)), FIT))
    return fitted


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """docs without text, with its counts, base_failed, distance (squared Mahalanobis, null where base_failed) and kept.

    Estimates are per lang and source (null is a value of its own) over the rows that pass the fixed limits; a group
    with fewer than LEAST_GROUP such rows is judged by the estimate over all rows. A null text has no words and fails.
    Columns of docs with the name of a result are replaced. An empty table gives an empty result.
    """
    made = {"base_failed", "distance", "kept"}
    rows = text_counts(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]))
    rows = cut(rows.withColumn("base_failed", base_failed()))
    group = F.to_json(F.struct("lang", "source"))
    passed = rows.filter(~F.col("base_failed")).select(group.alias("g"), vector().alias("x"))
    sizes = passed.groupBy("g").count().filter(F.col("count") >= LEAST_GROUP).select("g")
    fitted = fit(passed.unionByName(passed.withColumn("g", F.lit("")))).join(sizes.unionByName(sizes.sparkSession.range(1).select(F.lit("").alias("g"))), "g")
    fitted = cut(fitted)
    pooled = fitted.filter("g = ''").first()
    keyed = rows.withColumn("g", group).withColumn("x", vector()).join(fitted.filter("g <> ''"), "g", "left")
    for c in ("centre", "inverse"):
        values = F.array(*[F.lit(v) for v in pooled[c]]) if pooled else F.lit(None).cast("array<double>")
        keyed = keyed.withColumn(c, F.coalesce(c, values))
    keyed = keyed.withColumn("distance", F.when(~F.col("base_failed"), distance()))
    keyed = keyed.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))
    return keyed.drop("g", "x", "centre", "inverse")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts, whether they fail, and whether the document is kept."""
    judged = judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
