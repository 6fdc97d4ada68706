"""SimHash near-dedup: fingerprints, their exact comparison within a number of bits, and the groups they form."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import NO_ID, documents, id_key, slices, staged, text_bytes, whole_groups
from railtempo.llm.components import components, merge_labels

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
#: Fingerprints of a bucket that one task compares with as many others at most.
TILE = 4096
#: Rows and columns of the tables of exclusive-ors.
BLOCK = 512


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if set in over half the shingles' hashes; without words zero."""
    words = body.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(text, SEED)
    begins = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=begins[1:])
    digest = xxhash.xxh64_digest
    n = len(words) - shingle + 1
    spans = zip(begins[:n].tolist(), (begins[shingle:] - 1).tolist(), strict=True)
    hashes = np.frombuffer(b"".join([digest(text[a:b], SEED) for a, b in spans]), np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)], axis=1).sum(0, np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_rows(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(b, shingle) for b in batch.column("body").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("v"), pa.array(prints.view(np.int64))], ["doc_id", "v", "fp"])

    return rows


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, v (a hash of the text) and fp of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("v"), text_bytes().alias("body"))
    return texts.mapInArrow(fingerprint_rows(shingle), "doc_id long, v long, fp long")


def linked(prints: np.ndarray, side: np.ndarray, radius: int) -> np.ndarray:
    """Labels of the groups that links of at most radius bits make; sides 0 and 1 are compared with each other only."""
    labels = np.arange(len(prints))
    ones = np.bitwise_count(prints).astype(np.int64)
    parts = [np.flatnonzero(side == s)[np.argsort(ones[side == s], kind="stable")] for s in (0, 1)]
    left, right = parts if len(parts[1]) else (parts[0], parts[0])
    for i in range(0, len(left), BLOCK):
        a = left[i : i + BLOCK]
        for j in range(i if left is right else 0, len(right), BLOCK):
            b = right[j : j + BLOCK]
            if ones[b[0]] - ones[a[-1]] > radius or ones[a[0]] - ones[b[-1]] > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(prints[a][:, None] ^ prints[b][None, :]) <= radius)
            labels = merge_labels(labels, a[x], b[y])
    return labels


def link_rows(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Edges (a, b) that join the fingerprints of each group as far as they are linked: at most one for each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "g", 8192):
            g, side = table.column("g").to_numpy(), table.column("side").to_numpy()
            prints = table.column("fp").to_numpy().view(np.uint64)
            edges = np.append(np.flatnonzero(np.diff(g)) + 1, len(g))
            a, b, at = [], [], 0
            for end in edges.tolist():
                if end - at > 1:
                    mine = prints[at:end]
                    labels = linked(mine, side[at:end], radius)
                    moved = labels != np.arange(len(mine))
                    a.append(mine[moved])
                    b.append(mine[labels[moved]])
                at = end
            if a:
                yield pa.record_batch([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    return rows


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of which two fingerprints within radius agree on one at least: all choices of blocks - radius blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [reduce(int.__or__, chosen) for chosen in combinations(bits, blocks - radius)]


def blocks_for(count: int, radius: int) -> int:
    """Enough blocks that a bucket holds some hundreds of `count` spread fingerprints; all choices are exact."""
    blocks = radius + 1
    while (count >> (BITS * (blocks - radius) // blocks)) > 512 and blocks < radius + 5:
        blocks += 1
    return blocks


def as_long(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")


def fingerprint_links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join all that are linked through radius bits or fewer.

    Fingerprints meet in buckets of equal bits on one of the masks, so none within the radius is missed. A bucket with
    more than `tile` is dealt out as pairs of tiles; in a task, tables whose bit counts differ by more are skipped.
    """
    masks = block_masks(radius, blocks_for(prints.count(), radius))
    rows = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(as_long(m)) for m in masks])).alias("mask", "bucket"))
    sizes = rows.groupBy("mask", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = rows.join(sizes, ["mask", "bucket"]).withColumn("tiles", tiles).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pair = F.xxhash64("mask", "bucket", F.least("t", "u"), F.greatest("t", "u"))
    dealt = rows.select("fp", pair.alias("g"), (F.col("t") > F.col("u")).cast("int").alias("side"))
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(link_rows(radius), "a long, b long")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, v, fp, root and component_id (the smallest doc_id reachable through links) of every row of docs.

    A null text, or one without words, has fingerprint zero and is linked like any other. Rows with a null doc_id take
    part, but give no component_id unless all ids of the group are null. Repeated rows are rows of the same group.
    """
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(fingerprint_links(prints.select("fp"), radius, tile))
    placed = prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(placed.join(least, "root").select("fp", "root", "component_id"), "fp")


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of docs for each group: that of the smallest doc_id (null last), and of its rows the one of least hash."""
    groups = near_groups(docs, shingle, radius)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "v")).alias("first")
    kept = groups.groupBy("root").agg(first).select(F.coalesce("first.doc_id", F.lit(NO_ID)).alias("id"), "first.v")
    keyed = docs.withColumns({"__id": id_key(), "__v": F.xxhash64("text")})
    out = keyed.join(kept, (F.col("__id") == F.col("id")) & (F.col("__v") == F.col("v")), "left_semi")
    if not groups.groupBy("doc_id", "v").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        out = out.dropDuplicates(["__id", "__v"])
    return out.drop("__id", "__v")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id that it reaches by links of four bits or fewer."""
    groups = near_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
