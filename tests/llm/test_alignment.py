"""op12: lockstep merging against sets of byte offsets, counts against a plain count over the corpus."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from railtempo.llm import token_alignment as ta

pytestmark = pytest.mark.skipif(not os.path.isdir(ta.TOKENIZERS), reason="no tokenizers")
SCHEMA = "doc_id long, text string, n_a string, pairs int, row long"
TEXTS = [
    None,
    "",
    " ",
    "one",
    "Nine plain words, and <s> marks </s> <|endoftext|> too.",
    "é ß 中文字 \U0001f600 \U0001f600\U0001f3fd",
    "nul\x00byte \x1f unit \x85 \xa0",
    "▁ a block that a blank is spelt with",
    "don't we'll 123456 ''s",
    "tabs\t\tand\r\n\n\n lines   and   blanks  ",
    " " * 5000 + "x" + "\n" * 3000,
    "x" * 4000,
    "word " * 3000 + "end",
]


@pytest.fixture(scope="module")
def tokenizers():
    return ta.Tokenizers.read()


@pytest.fixture(scope="module")
def rows(edge_rows):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(i, t) for i, t, *_ in edge_rows]
    return rows + [(None, TEXTS[4]), (3, "one"), (3, "one")]


def brute(rows, tokenizers):
    """Both vocabularies' own encoders, and ends of tokens as sets."""
    import sentencepiece
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(f"{ta.TOKENIZERS}/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{ta.TOKENIZERS}/piece_bpe_32k.model")
    held, count = [], Counter()
    for _, text in rows:
        ids = [whole.encode(f" {text}", add_special_tokens=False).ids, pieces.encode(text)] if text else [[], []]
        sides = [[tokenizers.bytes_of(side)[x] for x in i] for side, i in zip("ab", ids)]
        if text and any(b"".join(s) != f" {text}".encode() for s in sides):
            ids, sides = [[], []], [[], []]
        ends = [{int(e): k for k, e in enumerate(np.cumsum([len(x) for x in s]))} for s in sides]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids[0][ends[0][c]], ids[1][ends[1][c]]) for c in cuts]
        count.update(links)
        groups, at = [], (0, 0)
        for c in cuts:
            to = ends[0][c] + 1, ends[1][c] + 1
            groups.append("|".join(",".join(map(str, i[x:y])) for i, x, y in zip(ids, at, to)))
            at = to
        held.append((ids, cuts, links, ";".join(groups)))
    best = Counter()
    for (a, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), (ids, cuts, links, groups) in zip(rows, held):
        n_best = sum(count[x] == best[x[1]] for x in links)
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((i, len(ids[0]), len(ids[1]), len(cuts), len(links), n_best, sum(count[x] for x in links), sha))
    return sorted(out, key=str)


def docs(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("head", [ta.HEAD, 40, 0])
def test_counts_and_groups(spark, rows, tokenizers, head):
    """The same result whether counts are broadcast, joined, or both."""
    from railtempo.llm.common import staged

    aligned = staged(ta.align(docs(spark, rows), tokenizers, ta.DIGEST), "aligned")
    sizes = tuple(len(tokenizers.bytes_of(x)) for x in "ab")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = ta.link_counts(aligned, sizes, head).select(*columns).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, tokenizers)


def test_positions(spark, tokenizers):
    """The real outputs: cuts are where linked tokens of both sides end."""
    for row in ta.align(docs(spark, [(k, t) for k, t in enumerate(TEXTS)]), tokenizers).collect():
        ends = [np.cumsum(tokenizers.lengths(s)[ids]) if ids else [] for s, ids in (("a", row.a_ids), ("b", row.b_ids))]
        assert [ends[0][i] for i in row.a_linked] == row.cuts == [ends[1][i] for i in row.b_linked]
        assert set(row.cuts) == set(ends[0]) & set(ends[1])
        if row.a_ids:
            assert row.cuts[-1] == len(TEXTS[row.doc_id].encode()) + 1


@pytest.mark.parametrize("lane", [1, 7, 1 << 20])
def test_lanes_do_not_matter(monkeypatch, tokenizers, lane):
    whole = ta.align_texts(TEXTS, tokenizers).partner
    monkeypatch.setattr(ta, "LANE", lane)
    assert np.array_equal(ta.align_texts(TEXTS, tokenizers).partner, whole)


def test_blank_texts_take_the_other_encoder(tokenizers):
    texts = [" " * n + "x" for n in (10, 999, 1000, 1001, 4000)]
    fast = [tokenizers._load()["fast"].encode_ordinary(t) for t in texts]
    assert tokenizers.encode_a(texts) == fast


def test_empty_table(spark, tokenizers):
    aligned = ta.align(docs(spark, []), tokenizers, ta.DIGEST)
    assert ta.link_counts(aligned, (50257, 32000)).count() == 0


def test_batches_are_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ta, "BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["a" * 6, "b" * 6, None, "c" * 30]})
    assert [b.num_rows for b in ta._bounded([batch])] == [1, 2, 1]
