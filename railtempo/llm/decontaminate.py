"""Benchmark decontamination: finds the documents' words that lie in windows of benchmark items. Spark functions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import documents, id_key

WINDOW = 10
#: Words are digits, lower-case ASCII letters and everything beyond ASCII.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word as it stands, with what follows it up to the next.
PIECES = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"
#: Words of a document that are cut into windows at a time.
BLOCK = 2048
#: What is broadcast takes fewer bytes: the windows, else their hashes, to sort out what need not be shuffled.
BROADCAST_BYTES = 32_000_000
#: Bytes of a row in a broadcast table beside its texts, and of a hash in one.
ROW_BYTES = 64
HASH_BYTES = 24
#: Every document sends one row that meets one of so many marks, so that documents without hits stay.
MARKS = 64


def words(text: str) -> Column:
    low = F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(low, GAPS), "")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """text (of a window), n (its words) and item (an id that has it, as text), each once. Items without words have none."""
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words("text").alias("w"))
    cut = cut.filter(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1))
    cut = cut.withColumn("size", F.size("w")).withColumn("at", at)
    text = F.concat_ws(" ", F.slice("w", F.col("at"), F.col("n")))
    return cut.select(text.alias("text"), "n", "item").distinct()


def _mark(number: Column) -> Column:
    """A text that no window has, as words hold no such character."""
    return F.concat(F.lit("\x00"), F.pmod(number, F.lit(MARKS)).cast("string"))


def _meet(rows: DataFrame, windows: DataFrame, n_windows: int, n_bytes: int) -> DataFrame:
    """rows joined with windows by text, which verifies every hit.

    Windows of more than BROADCAST_BYTES are not broadcast. While their hashes take less, rows whose text has none of them
    are dropped first, so what is shuffled is about the hits; beyond that all rows are.
    """
    if n_bytes < BROADCAST_BYTES:
        return rows.join(F.broadcast(windows), "text")
    if n_windows * HASH_BYTES < BROADCAST_BYTES:
        hashes = windows.select(F.xxhash64("text").alias("hash"))
        rows = rows.join(F.broadcast(hashes), F.xxhash64("text") == F.col("hash"), "left_semi")
    return rows.join(windows, "text")


def window_hits(docs: DataFrame, of_items: DataFrame, block: int = BLOCK) -> DataFrame:
    """row (a number), id, v (hash of the text), doc_id, n_words, spans and texts (the windows that occur) of every row of docs.

    Long documents are cut a block at a time; their windows meet those of the items by their words.
    """
    windows = of_items.select("text", "n").distinct()
    facts = windows.groupBy("n").agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("bytes"), F.count("*").alias("windows")).collect()
    lengths = sorted(r.n for r in facts)
    marks = windows.sparkSession.range(MARKS).select(_mark(F.col("id")).alias("text"), F.lit(0).alias("n"))
    windows = windows.unionByName(marks)
    n_windows = MARKS + sum(r.windows for r in facts)
    n_bytes = MARKS * ROW_BYTES + sum(r.bytes for r in facts)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        id_key().alias("id"),
        F.xxhash64("text").alias("v"),
        "doc_id",
        words("text").alias("w"),
    )
    longest = max(lengths, default=1)
    begins = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(block))
    blocks = F.transform(begins, lambda b: F.struct(b.alias("at"), F.slice("w", b + 1, block + longest - 1).alias("w")))
    rows = texts.select("row", "id", "v", "doc_id", F.size("w").alias("n_words"), F.explode(blocks).alias("b"))

    def cut(n: int) -> Column:
        last = F.least(F.size("b.w") - n, F.lit(block - 1))
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        found = lambda i: F.struct((F.col("b.at") + i).alias("at"), F.concat_ws(" ", F.slice("b.w", i + 1, n)).alias("text"))
        return F.transform(places, found)

    here = F.when(F.col("b.at") == 0, F.array(F.struct(F.lit(0).alias("at"), _mark(F.col("row")).alias("text"))))
    here = F.coalesce(here, F.array().cast("array<struct<at:int,text:string>>"))
    rows = rows.select("row", "id", "v", "doc_id", "n_words", F.explode(F.concat(here, *[cut(n) for n in lengths])).alias("x"))
    rows = rows.select("row", "id", "v", "doc_id", "n_words", F.col("x.at").alias("at"), F.col("x.text").alias("text"))
    hit = F.col("n") > 0
    found = _meet(rows, windows, n_windows, n_bytes).groupBy("row", "id", "v", "doc_id", "n_words").agg(
        F.collect_list(F.when(hit, F.struct(F.col("at").alias("begin"), (F.col("at") + F.col("n")).alias("end")))).alias("spans"),
        F.collect_set(F.when(hit, F.col("text"))).alias("texts"),
    )
    return found.withColumn("spans", merged("spans"))


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """id, v (hash of the text), doc_id, n_words, spans (array of begin, end in words) and items of every row of docs.

    A document's windows are joined with the set of the items' windows by their words, so a hit is a verified one; which
    items have them is looked up for the hits alone. A null text has no words; an item without words has no windows; an
    item of fewer words than a window is one window; a null item_id counts as an empty one. Repeated rows are rows of
    their own.
    """
    of_items = item_windows(items, window)
    found = window_hits(docs, of_items, block)
    owners = of_items.select("text", "item")
    size = owners.agg(F.sum(F.octet_length("text") + F.octet_length("item") + ROW_BYTES)).first()[0] or 0
    if size < BROADCAST_BYTES:
        owners = F.broadcast(owners)
    # One row per window that occurs, of which the first carries the spans.
    keys = ["row", "id", "v", "doc_id", "n_words"]
    listed = found.select(*keys, "spans", F.posexplode_outer("texts").alias("at", "text"))
    listed = listed.withColumn("spans", F.when(F.coalesce("at", F.lit(0)) == 0, F.col("spans"))).join(owners, "text", "left")
    each = listed.groupBy(*keys).agg(
        F.first("spans", ignorenulls=True).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    return each.select("id", "v", "doc_id", F.col("n_words").cast("long").alias("n_words"), "spans", "items")


def merged(spans: str) -> Column:
    """Maximal runs of an array of begin and end."""
    kind = "array<struct<begin:int,end:int>>"

    def fold(state: Column, s: Column) -> Column:
        # The run being grown stands beside those that are done.
        touches = state["end"] >= s["begin"]
        done = F.when(touches | (state["end"] < 0), state["done"]).otherwise(
            F.concat(state["done"], F.array(F.struct(state["begin"].alias("begin"), state["end"].alias("end"))))
        )
        begin = F.when(touches, state["begin"]).otherwise(s["begin"])
        end = F.when(touches, F.greatest(state["end"], s["end"])).otherwise(s["end"])
        return F.struct(begin.alias("begin"), end.alias("end"), done.alias("done"))

    start = F.struct(F.lit(-1).alias("begin"), F.lit(-1).alias("end"), F.array().cast(kind).alias("done"))

    def finish(state: Column) -> Column:
        last = F.array(F.struct(state["begin"].alias("begin"), state["end"].alias("end")))
        return F.when(state["end"] < 0, state["done"]).otherwise(F.concat(state["done"], last))

    return F.aggregate(F.array_sort(spans), start, fold, finish)


def covered(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs that hold no window of an item. Rows with null ids or texts, and repeated rows, are judged like any other."""
    found = window_hits(docs, item_windows(items, window))
    bad = found.filter(F.size("spans") > 0).select("id", "v").distinct()
    keyed = docs.withColumns({"__id": id_key(), "__v": F.xxhash64("text")})
    return keyed.join(bad, (F.col("__id") == F.col("id")) & (F.col("__v") == F.col("v")), "left_anti").drop("__id", "__v")


def without_hit_words(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the hit words, and what follows each up to the next word, cut out of text.

    Other texts, nulls among them, stay as they are; a null id is an id like any other.
    """
    found = window_hits(docs, item_windows(items, window)).filter(F.size("spans") > 0)
    bad = found.select("id", "v", F.col("spans").alias("__spans")).dropDuplicates(["id", "v"])
    keyed = docs.withColumns({"__id": id_key(), "__v": F.xxhash64("text")})
    both = keyed.join(bad, (F.col("__id") == F.col("id")) & (F.col("__v") == F.col("v")), "left")
    inside = lambda i: F.exists("__spans", lambda s: (s["begin"] <= i) & (i < s["end"]))
    kept = F.array_join(F.filter(F.regexp_extract_all("text", F.lit(PIECES), 1), lambda _, i: ~inside(i)), "")
    return both.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(kept)).select(*[f"`{c}`" for c in docs.columns])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, how many lie in windows of benchmark items, and which items those are."""
    found = benchmark_hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        covered().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_FOLDED = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
OP5_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLDED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
    FROM documents
), b AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all({_FOLDED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item, least(len(w), {WINDOW}) AS m, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS k
    FROM b, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS t(i) WHERE len(w) > 0
), dw AS (
    SELECT rid, i, m, array_to_string(w[i : i + m - 1], ' ') AS k
    FROM d, (SELECT DISTINCT m FROM bw), unnest(range(1, len(w) - m + 2)) AS t(i)
), hit AS (
    SELECT rid, i, dw.m AS m, item FROM dw JOIN bw ON dw.k = bw.k AND dw.m = bw.m
), cover AS (
    SELECT rid, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + m)) AS t(p) GROUP BY rid
), its AS (
    SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
    FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(cover.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
    sha256(coalesce(its.s, '')) AS items_sha256, cover.n IS NOT NULL AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN its USING (rid)
"""
