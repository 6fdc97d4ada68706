"""Substring dedup: words of long passages that occur earlier in the corpus are removed.

A shard of the reference is all passages around one anchor, dealt out by Spark: the corpus is its own reference, so
its automata have no size bound and can't be broadcast whole. Each task builds a suffix automaton of its shard while
it streams the passages in order through it: the matching statistics of a passage against the passages before it
tell which windows occurred earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtempo.llm.common import documents
from railtempo.llm.repeats import Measure, without_repeats
from railtempo.llm.suffix_automaton import SuffixAutomaton
from railtempo.llm.suffix_dedup import n_removed

SPAN = 20
GRAM = 4
FREQUENT = 4096
HOT = 1 << 17
PARTS = 2
MADE = {"n_words", "kept", "removed", "spans"}


def runs_of(ends: list[int]) -> list[list[int]]:
    """First and last of each run of numbers that follow each other."""
    runs: list[list[int]] = []
    for end in ends:
        if runs and runs[-1][1] == end - 1:
            runs[-1][1] = end
        else:
            runs.append([end, end])
    return runs


def compare(table: pa.Table, m: Measure) -> Iterator[pa.RecordBatch]:
    """Spans of the windows of whole anchor groups that occur earlier."""
    back = m.span - m.gram
    width = back + m.span
    columns = {c: table.column(c).to_numpy() for c in ("h", "id", "v", "at", "lead")}
    texts = table.column("ctx").to_pylist()
    order = np.lexsort((columns["at"], columns["v"], columns["id"], columns["h"]))
    out: list[tuple[int, int, int, int]] = []
    group, before = None, None
    ids: dict[bytes, int] = {}
    for h, key, v, at, lead, row in zip(*(columns[c][order].tolist() for c in ("h", "id", "v", "at", "lead")), order.tolist(), strict=True):
        if h != group:
            group, before = h, None
            automaton, seen, ids = SuffixAutomaton(), set(), {}
        if (key, v, at) == before:
            continue
        before = (key, v, at)
        begin = at - lead
        if (lead, texts[row]) in seen:
            out.append((key, v, begin, begin + texts[row].count(b" ") + 1))
            continue
        seen.add((lead, texts[row]))
        # A token is a word and its distance from the anchor: equal windows lie alike around their anchors.
        tokens = [ids.setdefault(w, len(ids)) * width + i for i, w in enumerate(texts[row].split(b" "), back - lead)]
        if len(tokens) < m.span:
            continue
        long = [i + 1 for i, n in enumerate(automaton.matching(tokens)) if n >= m.span]
        for run in runs_of(long):
            out.append((key, v, begin + run[0] - m.span, begin + run[1]))
        automaton.add(tokens)
    if out:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["id", "v", "begin", "end"])


def remove_earlier_passages(docs: DataFrame, span: int = SPAN, gram: int = GRAM, frequent: int = FREQUENT, hot: int = HOT) -> DataFrame:
    """docs without text, and n_words, kept (binary: words left, joined by a space) and removed (array of begin, end in words).

    A word goes if a window of `span` words that covers it also starts earlier: in a smaller doc_id, or before in the
    same document; windows are judged on the input. A null text has no words; a null doc_id is the smallest. Rows with
    the same doc_id and text count as one document; a repeated doc_id with another text is another document, ordered by
    a hash of its text. Columns of docs that have the name of a result are replaced.
    """
    m = Measure(words=True, span=span, gram=gram, frequent=frequent, parts=PARTS, hot=hot)
    return without_repeats(docs, m, compare, True, MADE).withColumnRenamed("n_units", "n_words")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, how many go as parts of passages found earlier, and a hash of the rest."""
    done = remove_earlier_passages(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", n_removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT rid, doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS k FROM d, unnest(range(1, len(w) - 18)) AS t(i)
), later AS (
    SELECT rid, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, i) > 1
), gone AS (
    SELECT DISTINCT rid, p FROM later, unnest(range(i, i + 20)) AS t(p)
), words AS (
    SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), left_over AS (
    SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid
), n AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (rid) LEFT JOIN left_over USING (rid)
"""
