"""Suffix-array dedup: every byte of a long string that occurs more than once in the corpus is removed.

Suffixes are sorted by bucket-pointer refinement: they start in buckets of equal q-grams, and a bucket is refined by
sorting on the bucket identifiers of the suffixes q later. Going from the right, those identifiers are already refined
as far as the context reaches, so one pass reuses every update and ends with the full order. Only suffixes around
anchors that occur again are sorted (see repeats); Spark deals them out by anchor, so each task sorts whole groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import documents
from railtempo.llm.repeats import Measure, without_repeats

SPAN = 200
GRAM = 32
FREQUENT = 1 << 17
HOT = 1 << 17
PARTS = 4
Q = 8
MADE = {"n_bytes", "kept", "removed", "spans"}


def repeated_windows(contexts: np.ndarray, group: np.ndarray, first: np.ndarray, last: np.ndarray, span: int) -> np.ndarray:
    """Which windows occur again in another context of the group, at the same distance from the anchor.

    contexts: a row of bytes each, aligned at the anchor and padded. A row has windows from `first` to `last`, inclusive.
    """
    rows, width = contexts.shape
    starts = width - span + 1
    found = np.zeros((rows, starts), bool)
    buckets = [np.zeros(rows, np.int64)] * Q
    gram = np.zeros(rows, np.uint64)
    lead = group.astype(np.int64) << 32
    for x in range(width - 1, -1, -1):
        gram = (gram >> np.uint64(8)) | (contexts[:, x].astype(np.uint64) << np.uint64(56))
        initial = np.unique(gram, return_inverse=True)[1]
        refined = np.unique((initial << 32) | buckets[x % Q], return_inverse=True)[1]
        buckets[x % Q] = refined  # the pointer that position x - Q will be sorted by
        if x >= starts:
            continue
        have = np.flatnonzero((first <= x) & (x <= last))
        if len(have) < 2:
            continue
        order = have[np.argsort(lead[have] | refined[have], kind="stable")]
        sorted_rows = contexts[order, x : x + span]
        same = (group[order[1:]] == group[order[:-1]]) & (sorted_rows[1:] == sorted_rows[:-1]).all(1)
        found[order[1:][same], x] = True
        found[order[:-1][same], x] = True
    return found


def compare(table: pa.Table, m: Measure) -> Iterator[pa.RecordBatch]:
    """Spans of the repeated windows of whole anchor groups."""
    back = m.span - m.gram
    width = back + m.span
    h, lead = table.column("h").to_numpy(), table.column("lead").to_numpy()
    texts = table.column("ctx").to_pylist()
    # Equal contexts are sorted once: all their windows are repeated.
    at: dict[tuple, int] = {}
    which = np.fromiter((at.setdefault(k, len(at)) for k in zip(h.tolist(), lead.tolist(), texts, strict=True)), np.int64, len(texts))
    times = np.bincount(which)
    keys = list(at)
    group = np.unique(np.fromiter((k[0] for k in keys), np.int64, len(keys)), return_inverse=True)[1]
    first = np.fromiter((back - k[1] for k in keys), np.int64, len(keys))
    last = first + np.fromiter((len(k[2]) for k in keys), np.int64, len(keys)) - m.span
    found = np.zeros((len(keys), back + 1), bool)
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(several):
        block = np.zeros((len(several), width), np.uint8)
        for i, k in enumerate(several):
            text = keys[k][2]
            block[i, first[k] : first[k] + len(text)] = np.frombuffer(text, np.uint8)
        found[several] = repeated_windows(block, group[several], first[several], last[several], m.span)
    x = np.arange(back + 1)
    found |= (times > 1)[:, None] & (first[:, None] <= x) & (x <= last[:, None])
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    run_row, run_begin = np.nonzero(edges == 1)
    run_end = np.nonzero(edges == -1)[1] - 1 + m.span
    # Back from contexts to the documents that hold them.
    order = np.argsort(which, kind="stable")
    begins = np.concatenate([[0], np.cumsum(times)])
    copies = times[run_row]
    run = np.repeat(np.arange(len(run_row)), copies)
    row = order[begins[run_row][run] + np.arange(len(run)) - np.repeat(np.cumsum(copies) - copies, copies)]
    base = table.column("at").to_numpy()[row] - back
    picked = pa.array(row)
    yield pa.record_batch(
        {
            "id": table.column("id").combine_chunks().take(picked),
            "v": table.column("v").combine_chunks().take(picked),
            "begin": pa.array((base + run_begin[run]).astype(np.int32)),
            "end": pa.array((base + run_end[run]).astype(np.int32)),
        }
    )


def remove_repeated_strings(docs: DataFrame, span: int = SPAN, gram: int = GRAM, frequent: int = FREQUENT, hot: int = HOT) -> DataFrame:
    """docs without text, and n_bytes, kept (binary: the bytes left) and removed (array of begin, end in bytes).

    A byte goes if a string of `span` bytes that covers it also starts at another place of any document, overlaps
    included; all are judged on the input. A null text is empty. Rows with the same doc_id and text are copies of each
    other and both lose their text if it is long enough; a repeated doc_id with another text is another document.
    Columns of docs that have the name of a result are replaced. An empty table gives an empty result.
    """
    m = Measure(words=False, span=span, gram=gram, frequent=frequent, parts=PARTS, hot=hot)
    return without_repeats(docs, m, compare, False, MADE).withColumnRenamed("n_units", "n_bytes")


def n_removed(removed: str = "removed") -> Column:
    return F.aggregate(removed, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes, how many go as parts of strings found elsewhere, in how many runs, and a hash of the rest."""
    done = remove_repeated_strings(documents(spark, sf_dir))
    return done.select(
        "doc_id",
        "n_bytes",
        n_removed().alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP1_SQL = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), win AS (
    SELECT rid, i, md5(b[i : i + 199]) AS k FROM d, unnest(range(1, octet_length(b) - 198)) AS t(i)
), again AS (
    SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before
    FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)
), numbered AS (
    SELECT rid, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS run FROM again
), runs AS (
    SELECT rid, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY rid, run
), gaps AS (
    SELECT rid, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 1) AS a, a AS z FROM runs
    UNION ALL
    SELECT rid, max(z), max(octet_length(b)) + 1 FROM runs JOIN d USING (rid) GROUP BY rid
), kept AS (
    SELECT rid, sha256(unhex(string_agg(hex(b[gaps.a : gaps.z - 1]), '' ORDER BY gaps.a))) AS sha FROM gaps JOIN d USING (rid) WHERE gaps.z > gaps.a GROUP BY rid
), total AS (SELECT rid, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY rid)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    CASE WHEN n_removed IS NULL THEN sha256(b) ELSE coalesce(sha, sha256('')) END AS kept_sha256
FROM d LEFT JOIN total USING (rid) LEFT JOIN kept USING (rid)
"""
