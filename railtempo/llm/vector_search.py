"""Exact top-k search by inner product, with an index of vectors by nearest pivot and distance from it.

Components become whole numbers. All vectors are lifted to one length M by a further component, queries by zero, so that
score = (|q|^2 + M^2 - distance^2) / 2: the highest scores are the nearest vectors. A vector's key is its nearest pivot and
the annulus of its distance. By the triangle inequality a query at distance a of a pivot is at least b - a or a - b away
from what lies between the distances of an annulus; annuli are visited in the order of that bound until no other one can
hold a score as good as the k-th found.

Defined results: vectors that are null or hold a null or non-finite component take no part; shorter vectors count as
filled with zeros; components beyond 2^27 count as that; equal scores go to the smaller id, a null id last, then to the
earlier row; rows with equal ids are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtempo.llm.common import slices, staged, whole_groups

#: Components are multiplied by this and rounded down.
SCALE = 64
LARGEST = 1 << 27
#: Vectors that pivots are chosen from, at most so many pivots, and of each so many annuli: the directory's bound.
SAMPLE, PIVOTS, ANNULI = 4096, 256, 64
#: Vectors of a pivot on average, and of one piece of an annulus.
PER_PIVOT, PIECE = 2048, 2048
#: Queries that visit annuli together.
TOGETHER = 256
#: Annuli per query up to the first round's end; each round goes on to 16 times as many.
FIRST_ROUND = 4
#: Stands for a null id, after all others.
LAST_ID = 2**63 - 1
#: A key is the number of an annulus and, in so many bits, the piece of it.
PIECE_BITS = 40
VECTOR = "id long, asks boolean, vec binary"


def whole_numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the vectors that take part: their rows, their components one after the other, and where each begins."""
    column = batch.column("embedding")
    lists = column if isinstance(column, pa.ListArray) else column.cast(pa.list_(column.type.value_type))
    size = np.diff(lists.offsets.to_numpy())
    held = lists.values.slice(lists.offsets[0].as_py(), int(size.sum()))
    values = held.cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE
    owner = np.repeat(np.arange(size.size), size)
    good = lists.is_valid().to_numpy(zero_copy_only=False)
    good[owner[~np.isfinite(values)]] = False  # a null component is read as not a number
    rows = np.flatnonzero(good)
    values = np.clip(np.floor(values[good[owner]]), -LARGEST, LARGEST).astype(np.int64)
    return rows, values, np.append(0, np.cumsum(size[rows]))


@dataclass(frozen=True)
class Shape:
    """What all vectors have in common: their number, length, largest component and square of the greatest norm."""

    n: int
    dim: int
    peak: int
    most: float

    @property
    def stored(self) -> np.dtype:
        return np.dtype(np.int16 if self.peak < 1 << 15 else np.int32)

    @property
    def exact(self) -> type:
        """The fastest kind of number in which scores are exact."""
        top = self.dim * self.peak**2
        return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64

    @property
    def slack(self) -> float:
        """More than what rounding can take from a distance."""
        return 1e-6 * self.most**0.5

    def vectors(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.stored).reshape(-1, self.dim)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """With the further component that gives all the same length."""
        flat = vectors.astype(np.float64)
        return np.column_stack([flat, np.sqrt(np.maximum(0, self.most - (flat**2).sum(1)))])


def shape_of(vectors: DataFrame) -> Shape:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values, at = whole_numbers(batch)
            if rows.size:
                norms = np.diff(np.append(0, np.cumsum(values.astype(np.float64) ** 2))[at])
                found = [rows.size, np.diff(at).max(), np.abs(values).max(initial=0), norms.max()]
                yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in found], ["n", "dim", "peak", "most"])

    found = vectors.select("embedding").mapInArrow(run, "n double, dim double, peak double, most double")
    row = found.agg(F.sum("n"), F.max("dim"), F.max("peak"), F.max("most")).first()
    n, dim, peak, most = (x or 0 for x in row)
    return Shape(int(n), max(1, int(dim)), int(peak), most * (1 + 1e-9) + 1e-9)


def stored_vectors(vectors: DataFrame, asks: Column, shape: Shape) -> DataFrame:
    """id, whether it is a query, and the whole numbers, filled to the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            rows, values, at = whole_numbers(batch)
            out = np.zeros((rows.size, shape.dim), shape.stored)
            size = np.diff(at)
            out[np.repeat(np.arange(rows.size), size), np.arange(values.size) - np.repeat(at[:-1], size)] = values
            kept = [batch.column(c).take(pa.array(rows)) for c in ("id", "asks")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([x.tobytes() for x in out], pa.binary())], ["id", "asks", "vec"])

    chosen = vectors.select(F.col("vec_id").cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), "embedding")
    return chosen.mapInArrow(run, VECTOR)


def choose_pivots(rows: DataFrame, shape: Shape) -> np.ndarray:
    """Centres of groups of a sample, lifted: more of them with more vectors, up to PIVOTS."""
    ordered = rows.select("vec").orderBy(F.xxhash64("vec", "id"), "vec").limit(SAMPLE).toArrow()
    sample = shape.lifted(shape.vectors(b"".join(ordered.column(0).to_pylist())))
    wanted = min(PIVOTS, max(1, shape.n // PER_PIVOT), len(sample))
    centres = sample[:wanted].copy()
    for _ in range(8):
        nearest, _ = _nearest(sample, centres)
        for k in range(wanted):
            if (mine := nearest == k).any():
                centres[k] = sample[mine].mean(0)
    return centres


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distance = _distances(points, pivots)
    nearest = distance.argmin(1)
    return nearest, distance[np.arange(len(points)), nearest]


def with_keys(rows: DataFrame, shape: Shape, pivots: np.ndarray) -> DataFrame:
    """Rows with their nearest pivot and the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            points = shape.lifted(shape.vectors(b"".join(batch.column("vec").to_pylist())))
            pivot, distance = _nearest(points, pivots)
            made = [pa.array(pivot.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "pivot", "distance"])

    return rows.mapInArrow(run, f"{VECTOR}, pivot int, distance double")


@dataclass(frozen=True)
class Directory:
    """The annuli: at most PIVOTS * ANNULI of them, whatever the number of vectors."""

    pivots: np.ndarray
    pivot: np.ndarray
    least: np.ndarray
    greatest: np.ndarray
    pieces: np.ndarray

    def bounds(self, queries: np.ndarray, shape: Shape) -> np.ndarray:
        """The highest score that each query can have in each annulus."""
        flat = queries.astype(np.float64)
        norms = (flat**2).sum(1)[:, None]
        from_pivot = _distances(np.column_stack([flat, np.zeros(len(flat))]), self.pivots)[:, self.pivot]
        apart = np.maximum(from_pivot - self.greatest, self.least - from_pivot) - shape.slack
        return (norms + shape.most - np.maximum(apart, 0) ** 2) / 2 + 1e-9 * shape.most + 1


@dataclass(frozen=True)
class Cuts:
    """Per pivot the distances at which its vectors are cut into annuli."""

    at: dict[int, np.ndarray]

    def annulus(self, batch: pa.RecordBatch) -> np.ndarray:
        pivot, distance = (batch.column(c).to_numpy() for c in ("pivot", "distance"))
        out = pivot.astype(np.int64) * ANNULI
        for k in np.unique(pivot):
            mine = pivot == k
            out[mine] += np.searchsorted(self.at[int(k)], distance[mine], "left")
        return out


def annuli(keyed: DataFrame, pivots: np.ndarray) -> tuple[Directory, DataFrame]:
    """The directory, and the rows with the key of the piece of an annulus that they lie in.

    A pivot's vectors are cut at quantiles of their distance. What many equal distances leave large is cut by row into
    pieces, so no piece grows with the number of equal vectors.
    """
    steps = [k / ANNULI for k in range(1, ANNULI)]
    found = keyed.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("distance", steps, 1000).alias("at")).collect()
    wanted = {row.pivot: min(ANNULI, -(-row.n // PIECE)) for row in found}
    cuts = Cuts({r.pivot: np.unique([r.at[k * ANNULI // wanted[r.pivot] - 1] for k in range(1, wanted[r.pivot])]) for r in found})

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(cuts.annulus(batch)), batch.column("distance")], ["annulus", "distance"])

    rings = keyed.select("pivot", "distance").mapInArrow(numbered, "annulus long, distance double")
    counted = rings.groupBy("annulus").agg(F.count("*"), F.min("distance"), F.max("distance"))
    annulus, n, least, greatest = (np.array(c) for c in zip(*sorted(tuple(r) for r in counted.collect())))
    directory = Directory(pivots, annulus // ANNULI, least, greatest, -(-n // PIECE))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ring = np.searchsorted(annulus, cuts.annulus(batch))
            piece = batch.column("hash").to_numpy() % directory.pieces[ring]
            kept = [batch.column(c) for c in ("row", "id", "asks", "vec")]
            yield pa.RecordBatch.from_arrays([pa.array(ring << PIECE_BITS | piece), *kept], ["key", "row", "id", "asks", "vec"])

    hashed = keyed.withColumn("hash", F.pmod(F.xxhash64("row"), F.lit(1 << 31)))
    return directory, hashed.mapInArrow(place, f"key long, row long, {VECTOR}")


def pieces(placed: DataFrame, shape: Shape) -> DataFrame:
    """One row per piece of an annulus: key, and its rows, ids, marks and vectors as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key", PIECE):
            key = table.column("key").to_numpy()
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            row = table.column("row").to_numpy()
            ids = table.column("id").fill_null(LAST_ID).to_numpy()
            null = table.column("id").is_null().to_numpy()
            asks = table.column("asks").to_numpy(zero_copy_only=False)
            held = table.column("vec").to_pylist()
            out = []
            for x, y in zip(starts, np.append(starts[1:], key.size)):
                out.append((int(key[x]), row[x:y].tobytes(), ids[x:y].tobytes(), null[x:y].tobytes(), asks[x:y].tobytes(), b"".join(held[x:y])))
            kinds = [pa.int64()] + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], PIECE_COLUMNS)

    dealt = placed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "key long, rows binary, ids binary, nulls binary, asks binary, vecs binary")


PIECE_COLUMNS = ["key", "rows", "ids", "nulls", "asks", "vecs"]


@dataclass
class Piece:
    """The vectors of one piece."""

    rows: np.ndarray
    ids: np.ndarray
    nulls: np.ndarray
    asks: np.ndarray
    vecs: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, k: int, shape: Shape) -> Piece:
        rows, ids, nulls, asks, vecs = (batch.column(c)[k].as_py() for c in PIECE_COLUMNS[1:])
        flags = [np.frombuffer(x, bool) for x in (nulls, asks)]
        return cls(np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64), *flags, shape.vectors(vecs))

    def best(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int, shape: Shape) -> tuple[np.ndarray, ...]:
        """The k best of this piece for each query that score `least` or more, but for the query's own row.

        Returns the numbers of queries and of vectors, and the scores.
        """
        scores = (queries.astype(shape.exact) @ self.vecs.T.astype(shape.exact)).astype(np.int64)
        if self.rows.size > k + 1:  # one of them may be the query itself
            least = np.maximum(least, np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)])
        query, vector = np.nonzero(scores >= least[:, None])
        other = self.rows[vector] != own[query]
        query, vector = query[other], vector[other]
        found = scores[query, vector]
        order = np.lexsort((self.rows[vector], self.ids[vector], self.nulls[vector], -found, query))
        query = query[order]
        rank = np.arange(query.size) - np.searchsorted(query, query)
        kept = order[rank < k]
        return query[rank < k], vector[kept], found[kept]


CANDIDATE = "q_row long, q_id long, score long, id long, row long"
LOWEST = -(2**63)


def _candidates(piece: Piece, rows: np.ndarray, ids: np.ndarray, found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    query, vector, score = found
    columns = [pa.array(rows[query]), pa.array(ids[query]), pa.array(score), pa.array(piece.ids[vector], mask=piece.nulls[vector]), pa.array(piece.rows[vector])]
    return pa.RecordBatch.from_arrays(columns, ["q_row", "q_id", "score", "id", "row"])


def at_home(held: DataFrame, shape: Shape, k: int) -> DataFrame:
    """The best k for each query among the vectors of its own piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                piece = Piece.of(batch, at, shape)
                rows, ids = piece.rows[piece.asks], piece.ids[piece.asks]
                if rows.size:
                    least = np.full(rows.size, LOWEST, np.int64)
                    yield _candidates(piece, rows, ids, piece.best(piece.vecs[piece.asks], rows, least, k, shape))

    return held.mapInArrow(run, CANDIDATE)


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("id"), "row"]
    ranks = candidates.withColumn("rank", F.row_number().over(Window.partitionBy("q_row").orderBy(*order)))
    return ranks.filter(F.col("rank") <= k)


def visits(queries: DataFrame, directory: Directory, shape: Shape, first: int, last: int) -> DataFrame:
    """Blocks of queries with the pieces that they go to: for each query the annuli of ranks first to last.

    `queries` have the score of their k-th candidate, `least`; annuli that cannot reach it are not visited.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TOGETHER):
            row, home = (batch.column(c).to_numpy() for c in ("row", "key"))
            ids = batch.column("id").to_numpy()
            least = batch.column("least").fill_null(LOWEST).to_numpy()
            vecs = shape.vectors(b"".join(batch.column("vec").to_pylist()))
            bounds = directory.bounds(vecs, shape)
            chosen = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
            wanted = np.zeros(bounds.shape, bool)
            np.put_along_axis(wanted, chosen, np.take_along_axis(bounds, chosen, 1) >= least[:, None], 1)
            out = []
            for ring in np.flatnonzero(wanted.any(0)):
                for piece in range(directory.pieces[ring]):
                    key = int(ring) << PIECE_BITS | piece
                    at = np.flatnonzero(wanted[:, ring] & (home != key))
                    if at.size:
                        out.append((key, row[at].tobytes(), ids[at].tobytes(), least[at].tobytes(), vecs[at].tobytes()))
            for at in range(0, len(out), 64):
                kinds = [pa.int64()] + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 64]), kinds)], VISIT_COLUMNS)

    return queries.mapInArrow(run, "key long, q_rows binary, q_ids binary, q_least binary, q_vecs binary")


VISIT_COLUMNS = ["key", "q_rows", "q_ids", "q_least", "q_vecs"]


def visited(held: DataFrame, blocks: DataFrame, shape: Shape, k: int) -> DataFrame:
    """The best k that each query of a block finds in the piece that the block goes to.

    Sorted and merged, never broadcast: the staged pieces are compressed, by up to twenty times where vectors recur, so the
    size of their files says nothing of what the driver would have to hold. Of a key, a task then holds the piece alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows, ids, least = (np.frombuffer(batch.column(c)[at].as_py(), np.int64) for c in VISIT_COLUMNS[1:4])
                vecs = shape.vectors(batch.column("q_vecs")[at].as_py())
                piece = Piece.of(batch, at, shape)
                yield _candidates(piece, rows, ids, piece.best(vecs, rows, least, k, shape))

    return blocks.join(held.hint("merge"), "key").drop("key").mapInArrow(run, CANDIDATE)


def top_k(vectors: DataFrame, asks: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k vectors that score highest for each row that `asks` holds for.

    vectors: vec_id and embedding (numbers); a row is no candidate for itself. Pairs are only those of a block of queries
    and a piece of an annulus that can hold a better score than the k-th known to the block.
    """
    shape = shape_of(vectors)
    if not shape.n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = stored_vectors(vectors, asks, shape)
    pivots = choose_pivots(rows, shape)
    keyed = staged(with_keys(rows, shape, pivots).withColumn("row", F.monotonically_increasing_id()), "vector-keys")
    directory, placed = annuli(keyed, pivots)
    held = staged(pieces(placed, shape), "vector-pieces")
    queries = staged(placed.filter("asks").drop("asks"), "vector-queries")
    found = staged(_ranked(at_home(held, shape, k), k), "vector-found")
    first, last = 0, FIRST_ROUND
    while first < directory.pivot.size:
        kth = found.filter(F.col("rank") == k).select(F.col("q_row").alias("row"), F.col("score").alias("least"))
        near = queries.hint("merge").join(kth, "row", "left").repartition("key").sortWithinPartitions("key")
        blocks = visits(near, directory, shape, first, last)
        more = visited(held, blocks, shape, k).unionByName(found.drop("rank"))
        found = staged(_ranked(more, k), "vector-found")
        first, last = last, last * 16
    return found.select(F.col("q_id").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest scores of every vector whose id is divisible by 20, among all other rows of embeddings."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q, whole c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
