"""Suffix-array dedup and substring dedup against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from railtempo.llm import repeats, substring_dedup, suffix_dedup, winnow
from railtempo.llm.suffix_automaton import SuffixAutomaton


def collected(df, first):
    removed = suffix_dedup.n_removed()
    shown = df.select("doc_id", first, removed, F.size("removed"), F.sha2("kept", 256))
    return sorted((tuple(r) for r in shown.collect()), key=str)


def test_op1_over_the_table(spark, sf_dir, table_rows):
    found = sorted((tuple(r) for r in suffix_dedup.op1_suffix_dedup(spark, sf_dir).collect()), key=str)
    assert found == brute.repeated_strings(table_rows, 200)


def test_op8_over_the_table(spark, sf_dir, table_rows):
    found = sorted((tuple(r) for r in substring_dedup.op8_substring_dedup(spark, sf_dir).collect()), key=str)
    assert found == brute.earlier_passages(table_rows, 20)


def passages(rows, span):
    """Rows with one id and text are one document, ids that recur with another text are ordered by the text's hash."""
    return sorted({(r[0], r[1]) for r in rows}, key=str)


@pytest.mark.parametrize("frequent, hot", [(10**6, 10**6), (2, 10**6), (3, 12), (2, 2)])
def test_edge_rows(spark, edge_docs, edge_rows, frequent, hot):
    limits = {"frequent": frequent, "hot": hot}
    found = collected(suffix_dedup.remove_repeated_strings(edge_docs, **limits), "n_bytes")
    assert found == brute.repeated_strings([r[:2] for r in edge_rows], 200)
    once = edge_docs.filter("doc_id IS NULL OR removed < 60").dropDuplicates(["doc_id"])
    rows = [tuple(r) for r in once.select("doc_id", "text").collect()]
    found = [(r[0], r[1], r[2], r[4]) for r in collected(substring_dedup.remove_earlier_passages(once, **limits), "n_words")]
    assert found == brute.earlier_passages(rows, 20)


@pytest.mark.parametrize("bad", [0, 3])
def test_texts_of_one_id_whose_hashes_collide(spark, monkeypatch, bad):
    """Null and repeated ids, with hashes that all texts share until a later seed."""
    rng = random.Random(9)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = prose(60)
    rows = [(1, f"{shared} a"), (None, f"{prose(3)} {shared} {prose(4)}"), (None, prose(70)), (7, prose(50)), (7, f"{shared} b")]
    rows += [(None, None), (None, ""), (7, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    whole = repeats.text_hash
    monkeypatch.setattr(repeats, "text_hash", lambda seed: F.lit(5).cast("long") if seed < bad else whole(seed))
    assert collected(suffix_dedup.remove_repeated_strings(docs), "n_bytes") == brute.repeated_strings(rows, 200)
    passages_left = {(r.doc_id, bytes(r.kept).decode()) for r in substring_dedup.remove_earlier_passages(docs.filter("doc_id IS NULL")).collect()}
    assert {t for _, t in passages_left} == {t or "" for i, t in rows if i is None}


def test_repeated_rows_are_one_document_for_passages(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    found = collected(substring_dedup.remove_earlier_passages(docs), "n_words")
    assert [(r[0], r[2]) for r in found] == [(1, 30), (1, 30), (2, 30), (None, 0)]


def test_empty_table_and_columns(spark, no_docs, edge_docs):
    assert suffix_dedup.remove_repeated_strings(no_docs).isEmpty()
    assert substring_dedup.remove_earlier_passages(no_docs).isEmpty()
    out = suffix_dedup.remove_repeated_strings(edge_docs)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "score", "n_bytes", "kept", "removed"]


def test_anchors_depend_on_the_window_alone(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 105, 3000, dtype=np.uint8)
    data[700:1100] = data[100:500]
    begins = np.array([0, 650, 650, 3000])
    places, hashes = winnow.anchors(winnow.BYTE[data], begins, 50, 8)
    own = {int(p) for p in places}
    for at in [*range(0, 601), *range(650, 2951)]:
        assert any(at <= p <= at + 42 for p in own)
    assert {p + 600 for p in own if 142 <= p < 450} == {p for p in own if 742 <= p < 1050}
    monkeypatch.setattr(winnow, "PIECE", 64)
    again, same = winnow.anchors(winnow.BYTE[data], begins, 50, 8)
    assert (again == places).all() and (same == hashes).all()


def test_word_places():
    texts = [b"", b" a bb\tccc ", b"a", b"\n", b"bb"]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes, words, _ = winnow.word_places(np.frombuffer(b"".join(texts), np.uint8), begins)
    assert words.tolist() == [0, 0, 3, 4, 4, 5]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3


def test_suffix_automaton_against_search():
    rng = random.Random(2)
    for _ in range(60):
        automaton, added = SuffixAutomaton(), []
        for _ in range(4):
            tokens = [rng.randrange(3) for _ in range(rng.randrange(1, 14))]
            expected = []
            for i in range(len(tokens)):
                runs = (n for n in range(i + 1, 0, -1) if any(tokens[i + 1 - n : i + 1] == a[k : k + n] for a in added for k in range(len(a))))
                expected.append(next(runs, 0))
            assert automaton.matching(tokens) == expected
            automaton.add(tokens)
            added.append(tokens)


def test_repeated_windows_against_search():
    rng = np.random.default_rng(5)
    for _ in range(20):
        rows, span, width = 12, 6, 10
        block = rng.integers(0, 3, (rows, width), dtype=np.uint8)
        block[1], block[2, 3:] = block[0], block[0, 3:]
        group = rng.integers(0, 2, rows)
        first = rng.integers(0, 3, rows)
        last = first + rng.integers(0, 3, rows)
        last = np.minimum(last, width - span)
        found = suffix_dedup.repeated_windows(block, group, first, last, span)
        for r in range(rows):
            for x in range(width - span + 1):
                mine = first[r] <= x <= last[r]
                twin = any(q != r and group[q] == group[r] and first[q] <= x <= last[q] and (block[q, x : x + span] == block[r, x : x + span]).all() for q in range(rows))
                assert found[r, x] == (mine and twin)
