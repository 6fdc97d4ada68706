"""Mixing sources to target weights by pivotal rounding of copies. Spark functions only.

Every document has a copy probability: its source's target over its size. What is beyond whole copies is rounded by the
pivotal method: two documents meet, and mass moves from one to the other, at random, until one has none or a whole
copy. Blocks of documents are folded at once and each leaves one with a fraction; those meet in the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtempo.llm.common import BLANKS, cut, documents

#: Weights of the sources in order, repeating; what share of all words the mix has; copies a document has at most.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 10
#: Documents of a block, about.
BLOCK = 128


def word_count(text: str) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BLANKS), "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size and target, from source and size. One row a source; the ordered steps see only those rows.

    Targets go by weight, but stop at `most` times the source's size; the excess goes to the others by weight. That is
    a common level times the weight, where the level is the greatest that any number of stopped sources gives.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    filled = totals.withColumn("weight", weight).withColumn("cap", cap)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = filled.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return filled.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def chance(h: Column, turn: int, seed: int) -> Column:
    """A number from 0 to below 1 that depends on the document, the round and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(h, F.lit(turn), F.lit(seed)), 11) / F.lit(float(1 << 53))


def folded(units: str, turn: int, seed: int, kind: str) -> Column:
    """Of an array of (unit, mass, u): the last unit with a fraction, its mass, and the others with what they got."""
    done = F.array().cast(f"array<struct<unit:{kind},take:int>>")
    first = F.element_at(F.col(units), 1)
    start = F.struct(first["unit"].alias("unit"), first["mass"].alias("mass"), done.alias("done"))

    def meet(state: Column, x: Column) -> Column:
        a, b = state["mass"], x["mass"]
        low = a + b < 1
        stays = F.when(low, x["u"] * (a + b) >= b).otherwise(x["u"] * (2 - a - b) >= 1 - a)
        # below 1 the loser gets nothing; else it gets a copy, and the one that stays has the rest
        loser = F.when(stays, x["unit"]).otherwise(state["unit"])
        winner = F.when(stays, state["unit"]).otherwise(x["unit"])
        left = F.struct(loser.alias("unit"), F.when(low, 0).otherwise(1).alias("take"))
        mass = F.when(low, a + b).otherwise(a + b - 1)
        return F.struct(winner.alias("unit"), mass.alias("mass"), F.concat(state["done"], F.array(left)).alias("done"))

    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, meet)


def pivotal(units: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """source, unit and take (0 or 1) of every row of units (source, unit, mass, with 0 < mass < 1).

    Blocks are of one source and of like sizes first, so that mass moves between documents of nearly the same size; a
    source with very many documents has very many blocks. Each round leaves one unit a block, until one is left a source.
    """
    level = units.withColumn("kind", F.length(F.bin(F.col("unit.size"))))
    kind = level.schema["unit"].dataType.simpleString()
    out: list[DataFrame] = []
    turn = 0
    while True:
        parts = F.ceil(F.count("*") / block).alias("parts")
        counts = level.groupBy(F.col("source").alias("s"), F.col("kind").alias("k")).agg(parts)
        same = F.col("source").eqNullSafe(F.col("s")) & (F.col("kind") == F.col("k"))
        u = chance(F.col("unit.h"), turn, seed)
        part = F.pmod(F.xxhash64("unit.h", F.lit(seed), F.lit(turn + 1000)), F.col("parts"))
        dealt = level.join(counts, same).select("source", "kind", part.alias("part"), "unit", "mass", u.alias("u"))
        rows = F.sort_array(F.collect_list(F.struct("unit", "mass", "u")), False)
        blocks = dealt.groupBy("source", "kind", "part").agg(rows.alias("rows"))
        blocks = cut(blocks.select("source", folded("rows", turn, seed, kind).alias("f")))
        out.append(blocks.select("source", F.explode("f.done").alias("d")).select("source", "d.unit", "d.take"))
        level = blocks.select("source", F.col("f.unit").alias("unit"), F.col("f.mass").alias("mass"), F.lit(0).alias("kind"))
        turn += 1
        if level.groupBy("source").count().filter("count > 1").isEmpty():
            break
    last = chance(F.col("unit.h"), turn, seed) < F.col("mass")
    out.append(level.select("source", "unit", last.cast("int").alias("take")))
    return reduce(DataFrame.unionByName, out)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """doc_id, name, source, size, source_size, target, copies and taken of every row of docs; name is a hash of id and text.

    row: a column of whole numbers, one for each row of docs, that the result has too; it doesn't change what is chosen,
    but for rows of equal id and text.

    copies is a whole number and `most` rounded up at most; reruns agree. A null text has size 0, a null source is a
    source of its own, after the others. Documents of a source without words get no copies. Repeated rows are rows of
    their own, which may differ in copies.
    """
    name = F.xxhash64("doc_id", "text")
    own = [row] if row else []
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("name"), "source", word_count("text").alias("size"), *own))
    targets = cut(source_targets(rows, weights, share, most).withColumnRenamed("source", "s"))
    same = F.col("source").eqNullSafe(F.col("s"))
    p = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(p + 1e-9)
    unit = F.struct("size", F.xxhash64("doc_id", "name").alias("h"), "doc_id", "name", *own)
    mass = F.greatest(p - whole, F.lit(0.0))
    sized = rows.join(targets, same).select("source", unit.alias("unit"), F.when(mass < 1e-9, 0.0).otherwise(mass).alias("mass"))
    taken = pivotal(sized.filter("mass > 0"), seed, block)
    taken = taken.unionByName(sized.filter("mass = 0").select("source", "unit", F.lit(0).alias("take")))
    copies = (whole + F.col("take")).cast("long")
    columns = ["unit.doc_id", "unit.name", "source", "unit.size", "source_size", "target", *[f"unit.{c}" for c in own]]
    done = taken.join(targets, same).select(*columns, copies.alias("copies"))
    return done.withColumn("taken", F.col("copies") * F.col("size"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, its source's words and target, and the words that the mix takes."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
