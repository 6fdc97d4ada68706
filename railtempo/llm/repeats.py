"""Finds the passages that need comparing across the corpus, and deals them out by content.

Both repeat removers use it: texts are only ever compared around anchors (see winnow) that occur more than once.
A document is known by its id key and a hash of its text, so repeated ids and missing ids do no harm. The hash is one that
no two texts of one id share, which is checked beforehand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtempo.llm.common import flat, id_key, slices, staged, text_bytes, whole_groups
from railtempo.llm.winnow import BYTE, anchors, word_places

DOC = ["id", "v"]
SITE = "array<struct<at:int,h:long,n:long>>"
CONTEXT = "h long, id long, v long, at int, lead int, ctx binary"
CONTEXT_NAMES = ["h", "id", "v", "at", "lead", "ctx"]
SPAN = "id long, v long, begin int, end int"
#: Hashes that are tried until no two texts of an id share theirs; one that fails at all is a rare event.
SEEDS = range(8)


@dataclass(frozen=True)
class Measure:
    """What a text is counted in, how long a repeated window is, and the length of the grams that choose anchors."""

    words: bool
    span: int
    gram: int
    #: The groups of anchors found more often than this are refined before they are dealt out.
    frequent: int
    #: Into how many ranges of windows they are refined.
    parts: int
    #: Anchors found more often than this aren't compared in one task at all, but by joins.
    hot: int


def text_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "text")


def sound_seed(docs: DataFrame) -> int:
    """The first seed with which texts of one id have different hashes; texts are told apart by length and another hash."""
    for seed in SEEDS:
        rows = docs.select(id_key().alias("id"), text_hash(seed).alias("v"), F.xxhash64(F.lit(-1), F.length("text"), "text").alias("w"))
        if rows.groupBy(*DOC).agg(F.min("w").alias("a"), F.max("w").alias("b")).filter("a <> b").isEmpty():
            return seed
    raise ValueError("texts of one doc_id share a hash with every seed")


def whole_texts(docs: DataFrame, made: set[str]) -> DataFrame:
    """id, v, body and the other columns as one struct, but for those that the result makes."""
    seed = sound_seed(docs)
    others = [c for c in docs.columns if c.lower() not in made | {"text"}]
    return docs.select(
        id_key().alias("id"),
        text_hash(seed).alias("v"),
        text_bytes().alias("body"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("others"),
    )


def anchor_rows(m: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            data, begins = flat(batch.column("body"))
            if m.words:
                units, begins, _ = word_places(data, begins)
            else:
                units = BYTE[data]
            places, hashes = anchors(units, begins, m.span, m.gram)
            doc = np.searchsorted(begins, places, "right") - 1
            yield pa.record_batch(
                {
                    "h": pa.array(hashes.view(np.int64)),
                    "id": batch.column("id").take(pa.array(doc)),
                    "v": batch.column("v").take(pa.array(doc)),
                    "at": pa.array((places - begins[doc]).astype(np.int32)),
                }
            )

    return rows


def pieces(body: bytes, m: Measure) -> list[bytes] | bytes:
    return body.split() if m.words else body


def joined(part: list[bytes] | bytes) -> bytes:
    return part if isinstance(part, bytes) else b" ".join(part)


def ranges(m: Measure) -> list[tuple[int, int]]:
    """Ranges of windows, first and last; windows are numbered by their first unit, from span - gram units before the anchor."""
    edges = [(m.span - m.gram + 1) * i // m.parts for i in range(m.parts + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def cut_rows(m: Measure, hot: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts: what all windows around an anchor hold. hot: those of the anchors that are found most often.

    Frequent anchors are cut finer: by range of windows, grouped by what all windows of the range share.
    """
    back, parts = m.span - m.gram, ranges(m)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: list[tuple] = []
            for key, v, body, sites in zip(*(batch.column(c).to_pylist() for c in ("id", "v", "body", "sites")), strict=True):
                mine = [s for s in sites or () if (s["n"] > m.hot) == hot]
                if not mine:
                    continue
                units = pieces(body, m)
                for s in mine:
                    h, at = s["h"], s["at"]
                    begin = max(0, at - back)
                    if hot or s["n"] <= m.frequent:
                        out.append((h, key, v, at, at - begin, joined(units[begin : at + m.span])))
                        continue
                    zero = at - back
                    for low, high in parts:
                        first, last = max(low, begin - zero), min(high, len(units) - m.span - zero)
                        if first <= last:
                            shared = joined(units[zero + high : zero + low + m.span])
                            name = hashlib.blake2b(b"%d %d " % (h, low) + shared, digest_size=8).digest()
                            part = joined(units[zero + first : zero + last + m.span])
                            out.append((int.from_bytes(name, "big", signed=True), key, v, at, back - first, part))
                if len(out) >= 4096:
                    yield context_batch(out)
                    out = []
            if out:
                yield context_batch(out)

    return rows


def context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], CONTEXT_NAMES)


def window_rows(m: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The single windows of contexts within a range: a hash of each (as ctx), and its place."""
    back = m.span - m.gram

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            out = []
            for h, key, v, at, lead, text, low, high in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                units = text.split(b" ") if m.words else text
                begin = back - lead
                for x in range(max(low, begin), min(high, begin + len(units) - m.span) + 1):
                    # With the group and the distance from the anchor, so that no window is its own equal.
                    part = joined(units[x - begin : x - begin + m.span])
                    name = hashlib.blake2b(b"%d %d " % (h, x) + part, digest_size=16).digest()
                    out.append((h, key, v, at - back + x, 0, name))
            if out:
                yield context_batch(out)

    return rows


def copies_of(texts: DataFrame) -> DataFrame:
    """Documents whose whole text occurs again, and whether each is the first of its copies."""
    light = texts.select(*DOC, F.md5("body").alias("name"))
    groups = light.groupBy("name").agg(F.count("*").alias("n"), F.min(F.struct(*DOC)).alias("first")).filter("n > 1")
    return light.join(groups, "name").select(*DOC, (F.struct(*DOC) == F.col("first")).alias("is_first")).distinct()


def sites_of(texts: DataFrame, m: Measure) -> tuple[DataFrame, bool]:
    """For each document, its anchors whose gram occurs again; whether some are found very often.

    Of whole copies only the first is looked at.
    """
    found = staged(texts.select(*DOC, "body").mapInArrow(anchor_rows(m), "h long, id long, v long, at int"), "anchors")
    again = staged(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "anchors-again")
    sites = found.join(again, "h").groupBy(*DOC).agg(F.collect_list(F.struct("at", "h", "n")).alias("sites"))
    return sites, not again.filter(F.col("n") > m.hot).isEmpty()


def without_equal(contexts: DataFrame, m: Measure, later_only: bool) -> tuple[DataFrame, DataFrame]:
    """Of contexts of very frequent anchors: one of each kind, for the comparison in tasks, and spans that are certain.

    Equal contexts, as of a line that a text repeats over and over, are counted with partial sums before the shuffle.
    Anchors with very many kinds of contexts, as of a short line that many documents have, aren't left to one task:
    Spark refines their groups by what a few neighbouring windows share, and counts the single windows of what is left.
    """
    named = contexts.withColumn("w", F.unhex(F.md5(F.concat(F.col("lead").cast("string").cast("binary"), F.lit(b" "), "ctx"))))
    first = F.min(F.struct(*DOC, "at", "lead")).alias("first")
    kinds = staged(named.groupBy("h", "w").agg(F.count("*").alias("n"), first, F.max("ctx").alias("ctx")), "kinds")
    length = F.size(F.split(F.col("ctx").cast("string"), " ")) if m.words else F.octet_length("ctx")
    begin = F.col("at") - F.col("lead")
    light = named.select("h", "w", *DOC, "at", begin.alias("begin"), (begin + length).alias("end"))
    equal = light.join(kinds.filter("n > 1").select("h", "w", "first"), ["h", "w"]).filter(F.col("end") - F.col("begin") >= m.span)
    if later_only:
        equal = equal.filter(F.struct(*DOC, "at") != F.struct("first.id", "first.v", "first.at"))
    sizes = kinds.groupBy("h").agg(F.count("*").alias("d"))
    row = ["h", "first.id", "first.v", "first.at", "first.lead", "ctx"]
    few = kinds.join(sizes.filter(F.col("d") <= m.hot), "h").select(*row)
    many = kinds.join(sizes.filter(F.col("d") > m.hot).select("h"), "h")
    keys = many.select("h", "w", F.explode(shared_parts(m)).alias("part"))
    again = keys.groupBy("part").agg(F.count("*").alias("d")).filter("d > 1")
    left = many.join(keys.join(again, "part"), ["h", "w"]).select(F.col("part.key").alias("h"), *row[1:], "part.low", "part.high", "d")
    few = few.unionByName(left.filter(F.col("d") <= m.hot).select("h", *CONTEXT_NAMES[1:]))
    windows = left.filter(F.col("d") > m.hot).drop("d").mapInArrow(window_rows(m), CONTEXT).select(*DOC, "at", F.col("ctx").alias("w"))
    counted = windows.groupBy("w").agg(F.count("*").alias("n"), F.min(F.struct(*DOC, "at")).alias("first")).filter("n > 1")
    again = windows.join(counted, "w")
    if later_only:
        again = again.filter(F.struct(*DOC, "at") != F.col("first"))
    certain = equal.select(*DOC, "begin", "end")
    return few, certain.unionByName(again.select(*DOC, F.col("at").alias("begin"), (F.col("at") + m.span).alias("end")))


def shared_parts(m: Measure) -> Column:
    """For each range of windows that a context has any of: the range, and a key of what all of it share."""
    back = m.span - m.gram
    units = F.split(F.col("ctx").cast("string"), " ") if m.words else F.col("ctx")
    size = F.size(units) if m.words else F.octet_length("ctx")
    begin = back - F.col("first.lead")
    parts = []
    for low, high in ranges(m):
        at, n = F.lit(high + 1) - begin, F.lit(low + m.span - high)
        shared = F.concat_ws(" ", F.slice(units, at, n)) if m.words else F.substring(units, at, n)
        key = F.xxhash64("h", F.lit(low), shared)
        has = (begin <= high) & (begin + size - m.span >= low) & (n > 0)
        parts.append(F.when(has, F.struct(F.lit(low).alias("low"), F.lit(high).alias("high"), key.alias("key"))))
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def spans_of(texts: DataFrame, m: Measure, kernel: Callable, later_only: bool) -> DataFrame:
    """For each document with repeated windows, the spans they cover, and `whole`, true for a copy of a whole text.

    kernel: gets tables of CONTEXT rows that hold whole anchor groups and gives SPAN batches.
    later_only: the first of equal windows, by id, v and place, isn't counted as repeated.
    """
    copies = copies_of(texts)
    sites, hot = sites_of(texts, m)
    sites = sites.join(copies.filter(~F.col("is_first")), DOC, "left_anti")
    placed = texts.join(sites.hint("shuffle_hash"), DOC, "left")
    contexts = placed.mapInArrow(cut_rows(m, False), CONTEXT)
    certain = None
    if hot:
        many = staged(placed.mapInArrow(cut_rows(m, True), CONTEXT), "contexts")
        more, certain = without_equal(many, m, later_only)
        contexts = contexts.unionByName(more)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "h", 8192):
            yield from kernel(table, m)

    spans = contexts.repartition("h").sortWithinPartitions("h").mapInArrow(compared, SPAN)
    if certain is not None:
        spans = spans.unionByName(certain)
    entire = copies.filter(~F.col("is_first")) if later_only else copies
    spans = spans.withColumn("whole", F.lit(False)).unionByName(
        entire.select(*DOC, F.lit(0).alias("begin"), F.lit(0).alias("end"), F.lit(True).alias("whole"))
    )
    return spans.groupBy(*DOC).agg(F.collect_list(F.struct("begin", "end")).alias("spans"), F.max("whole").alias("whole"))


def merged(spans: list[dict] | None, whole: bool, length: int, span: int) -> list[tuple[int, int]]:
    """Maximal runs covered by spans."""
    if whole:
        return [(0, length)] if length >= span else []
    runs: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
        if begin >= end:
            continue
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((begin, end))
    return runs


def without_repeats(docs: DataFrame, m: Measure, kernel: Callable, later_only: bool, made: set[str]) -> DataFrame:
    """docs' other columns, n_units, kept (bytes) and removed (array of begin, end in units)."""
    texts = whole_texts(docs, made)
    spans = spans_of(texts, m, kernel, later_only)
    both = texts.join(spans.hint("shuffle_hash"), DOC, "left").select("others", "body", "spans", "whole")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            kept, removed, counts = [], [], []
            for body, found, whole in zip(*(batch.column(c).to_pylist() for c in ("body", "spans", "whole")), strict=True):
                units = pieces(body, m)
                runs = merged(found, bool(whole), len(units), m.span)
                counts.append(len(units))
                removed.append([{"begin": a, "end": b} for a, b in runs])
                edges = [0, *(x for run in runs for x in run), len(units)]
                parts = [units[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept.append(b"".join(parts) if isinstance(units, bytes) else b" ".join(w for p in parts for w in p))
            run = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            arrays = [batch.column("others"), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(run))]
            yield pa.record_batch(arrays, ["others", "n_units", "kept", "removed"])

    others = both.schema["others"].dataType.simpleString()
    out = both.mapInArrow(finish, f"others {others}, n_units long, kept binary, removed array<struct<begin:long,end:long>>")
    return out.select("others.*", "n_units", "kept", "removed")
