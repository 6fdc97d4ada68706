"""op11: the trie against brute force over all prefixes, and what nulls, ties and empty tables give."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from railtempo.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n_convs int, node string, depth int"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0), name, (role, text)))
    said = {c: [t[2] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}
    out = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = tuple(said.get(family, [])[:h] + turns[h:])
    return out


def brute(rows):
    whole = rebuilt(rows)
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    children = defaultdict(int)
    saved, leaves = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, held in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(held) - 1) * words[p]
            leaves[p[:d]] += not children[p]
    out = []
    for p, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if whole[c] == p)
        up = min(members[p[:-1]]) if p else None
        out.append((min(held), len(p), up, len(held), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=str)


def conversations():
    rng = random.Random(11)
    said = [("user", "hello there"), ("assistant", "yes  \n no"), ("user", ""), (None, None), ("", "a b c"), ("user", "x " * 5000)]
    rows = []
    for c in rng.sample(range(-60, 400), 150):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, *rng.choice(said[: rng.choice([2, 6])])))
    rows += [(7777, t, "user", f"turn {t}") for t in range(500)]  # a long one
    rows += [(c, t, "user", "the same") for c in range(8000, 8090) for t in range(4)]  # a group of copies
    rows += [(c, 0, "user", "stem") for c in range(9000, 9060)] + [(c, 1, "user", f"branch {c}") for c in range(9000, 9060)]
    rows += [(5001, None, "user", "no turn"), (5001, 0, "user", "b"), (5001, 0, "user", "a"), (5001, 0, "user", "a")]
    return rows + [(None, 0, "user", "no conversation"), (None, None, None, None)]


def test_trie_against_all_prefixes(spark):
    rows = conversations()
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversation(spark, rows):
    assert found(spark, rows) == []


def test_conversation_left_without_turns(spark):
    c = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    assert found(spark, [(c, 0, "user", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_end_lists_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 3)
    rows = conversations()
    assert found(spark, rows) == brute(rows)


def test_no_ancestor_pairs(spark):
    """A path of n turns makes n + 1 rows, not their square."""
    df = spark.createDataFrame([(20, t, "user", f"{t}", 1, "n", 2) for t in range(3000)], SCHEMA)
    assert prefix_trie.trie(df).count() == 3001
