"""Trie of conversation prefixes, from whole sequences.

Rebuilt conversations that are equal become one weighted sequence with the list of the conversations that end it. A
sequence that is a proper prefix of another (found by anti-join) is an inner node, the others are leaves. The prefixes of
the distinct sequences, each with its weight, are then added up per node.

What a subtree holds needs no ancestor pairs: a node belongs to the sequence of its smallest member, and of one sequence's
path the nodes that belong to it are all those from some depth on. So a sequence adds, at each depth, only sums over the
rest of its own path.

Defined results: turns are ordered by turn (null first), equal turns by a hash of role and text; repeated rows are turns
of their own; null roles and texts are empty; rows without conv_id are left out; an empty table has no nodes. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import WORD, staged

#: Conversations of one family, and how many opening turns one may take from its family's first.
FAMILY, OPENINGS = 20, 4
#: Bytes of a node's name: a hash chained over the turns of the prefix.
NAME = 16
ROOT = bytes(NAME)
#: Ids of the end list that one row holds, as a power of two.
PIECE_BITS = 12
#: Over so many tasks the branches from one node are dealt out.
SALTS = 16


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, name (hash of role and text) and words of each row: all that the trie needs of it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    spelt = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(spelt.cast("binary"), 256)), 1, NAME).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, n turns, path (names of its prefixes, the root's first) and words_from of every rebuilt conversation.

    words_from[d] are the words of the turns that a prefix of d turns does not reach before its last one. A family comes
    to one task in order, its first conversation ahead; the task reads it turn by turn and holds one path and the first
    openings. So the one row that grows is a conversation's own.
    """
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS
    rows = turns.select("*", first.alias("family"), taken.cast("int").alias("taken"))
    rows = rows.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "name"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = conv = None
        done: list[tuple] = []
        opening, own, seen, skip = [], [], 0, 0

        def finish() -> None:
            name, names = ROOT, [ROOT]
            for turn, _ in own:
                name = hashlib.blake2b(name + turn, digest_size=NAME).digest()
                names.append(name)
            words = np.array([0, *[n for _, n in own]], np.int64)
            done.append((conv, len(own), b"".join(names), np.cumsum(words[::-1])[::-1].tolist()))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("family", "conv_id", "taken", "name", "words")]
            for of, now, take, name, words in zip(*columns):
                if now != conv:
                    if conv is not None:
                        finish()
                    if of != family:
                        family, opening = of, []
                    conv, seen, skip = now, 0, 0 if now == of else take
                    own = opening[:skip]
                seen += 1
                if now == of and seen < OPENINGS:
                    opening.append((name, words))
                if seen > skip:
                    own.append((name, words))
            yield _conversations(done)
            done = []
        if conv is not None:
            finish()
            yield _conversations(done)

    rows = rows.select("family", "conv_id", "taken", "name", "words")
    return rows.mapInArrow(run, "conv_id long, n int, path binary, words_from array<long>")


def _conversations(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("conv_id", pa.int64()), ("n", pa.int32()), ("path", pa.binary()), ("words_from", pa.list_(pa.int64()))]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [k for k, _ in kinds])


def _name_at(depth: Column) -> Column:
    return F.substr("path", depth * NAME + 1, F.lit(NAME))


def _end() -> Column:
    return _name_at(F.col("n"))


def weighted_sequences(conversations: DataFrame) -> DataFrame:
    """Of equal rebuilt conversations one row: end, weight, first (the smallest conv_id) and that one's path."""
    ends = conversations.groupBy(_end().alias("end")).agg(F.count("*").alias("weight"), F.min("conv_id").alias("first"))
    return conversations.join(ends, conversations["conv_id"] == ends["first"]).drop("conv_id")


def end_lists(conversations: DataFrame) -> DataFrame:
    """(end, ends_sha256): the hash of the ids, ascending and comma-joined, of the conversations that are this sequence.

    Ids are first joined within blocks of their range, so that however many share a sequence, the task that hashes them
    one after the other reads few rows and holds one block.
    """
    block = F.shiftright("conv_id", PIECE_BITS)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = conversations.groupBy(_end().alias("end"), block.alias("block")).agg(ids.alias("ids"))
    pieces = pieces.repartition("end").sortWithinPartitions("end", "block").select("end", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, state = None, None
        for batch in batches:
            done = []
            for now, text in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist()):
                if now == end:
                    state.update(b"," + text.encode())
                    continue
                if end is not None:
                    done.append((end, state.hexdigest()))
                end, state = now, hashlib.sha256(text.encode())
            yield hashed(done)
        if end is not None:
            yield hashed([(end, state.hexdigest())])

    def hashed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string()))], ["end", "ends_sha256"])

    return pieces.mapInArrow(run, "end binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, with members, children, leaves and tokens that sharing saves."""
    convs = staged(rebuilt(turn_rows(conversations)), "rebuilt")
    sequences = staged(weighted_sequences(convs), "sequences")
    names = F.transform(F.sequence(F.lit(0), "n"), _name_at)
    prefixes = sequences.select("first", "n", F.posexplode(names).alias("depth", "node"))
    nodes = prefixes.groupBy("node").agg(
        F.min("first").alias("owner"), F.min("depth").alias("depth"), F.max(F.col("n") > F.col("depth")).alias("inner")
    )
    nodes = staged(nodes, "nodes")
    inner = nodes.filter("inner")
    leaves = sequences.join(inner, sequences["end"] == inner["node"], "left_anti").select("first", F.lit(True).alias("leaf"))
    owned = nodes.groupBy(F.col("owner").alias("first")).agg(F.min("depth").alias("own_from"))
    # The topmost node of its own that a sequence has hangs below a node of another one.
    tops = sequences.join(owned.filter("own_from > 0"), "first").select(
        "first", _name_at(F.col("own_from") - 1).alias("node"), F.pmod(F.xxhash64("first"), F.lit(SALTS)).alias("salt")
    )
    dealt = inner.select("node", F.col("owner").alias("above"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    above = tops.join(dealt, ["node", "salt"]).select("first", "above")
    whole = sequences.join(owned, "first", "left").join(leaves, "first", "left").join(above, "first", "left")

    steps = whole.select("first", "weight", "n", "own_from", "leaf", "above", "words_from", F.posexplode(names).alias("depth", "node"))
    depth, own_from = F.col("depth"), F.col("own_from")
    words = F.col("weight") * F.get("words_from", depth)
    words -= F.when(own_from.isNotNull(), F.get("words_from", F.greatest(depth, own_from))).otherwise(0)
    summed = steps.withColumn("saved", words).groupBy("node").agg(
        F.max(F.when(depth >= own_from, F.col("first"))).alias("conv_id"),
        F.min(depth).cast("long").alias("depth"),
        F.max(F.when(depth > own_from, F.col("first")).when(depth == own_from, F.col("above"))).alias("parent_conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count_if((depth < F.col("n")) & (depth + 1 >= own_from)).alias("n_children"),
        F.count_if("leaf").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    ends = end_lists(convs)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    joined = summed.join(ends, summed["node"] == ends["end"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return joined.select(*columns)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per node of the trie over the whole table conversations; see the module for nulls, ties and empty tables."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP11_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
),
turns AS (
  SELECT CAST(conv_id AS BIGINT) AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT c, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(t[CAST((xor(a, b) & 255) + 1 AS INTEGER)], a >> 8)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), crc
),
parts AS (
  SELECT k.c, 0 AS part, f.pos, f.said FROM convs k JOIN turns f ON f.c = k.c - k.c % 20 AND f.pos <= k.h
  UNION ALL
  SELECT k.c, 1, o.pos, o.said FROM convs k JOIN turns o ON o.c = k.c AND o.pos > k.h
),
whole AS (
  SELECT k.c, coalesce(list(p.said ORDER BY p.part, p.pos) FILTER (WHERE p.pos IS NOT NULL), []) AS path
  FROM convs k LEFT JOIN parts p USING (c) GROUP BY k.c
),
prefixes AS (
  SELECT c, d, path[1:d] AS node, len(path) = d AS ends FROM whole, unnest(range(len(path) + 1)) AS u(d)
),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM prefixes GROUP BY node, d
),
children AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
below AS (
  SELECT node[1:u.k] AS node, u.k AS d, sum((n_convs - 1) * words) AS saved, count(*) FILTER (WHERE n IS NULL) AS leaves
  FROM (SELECT nodes.*, children.n FROM nodes LEFT JOIN children USING (node, d)), unnest(range(d + 1)) AS u(k) GROUP BY 1, 2
)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, a.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM nodes a LEFT JOIN nodes up ON up.d = a.d - 1 AND up.node = a.node[1:a.d - 1]
LEFT JOIN children k ON k.node = a.node AND k.d = a.d JOIN below b ON b.node = a.node AND b.d = a.d
"""
