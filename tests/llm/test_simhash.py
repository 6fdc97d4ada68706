import brute
import numpy as np
import pytest

from railtempo.llm import components, simhash_dedup


def test_op4_over_the_table(spark, sf_dir, table_rows):
    found = sorted((tuple(r) for r in simhash_dedup.op4_simhash_dedup(spark, sf_dir).collect()), key=str)
    assert found == brute.simhash_groups(table_rows)


@pytest.mark.parametrize("tile", [4096, 3])
def test_edge_rows(spark, edge_docs, edge_rows, tile):
    found = simhash_dedup.near_groups(edge_docs, tile=tile).select("doc_id", "fp", "component_id").collect()
    found = sorted(((r[0], f"{r[1] & (1 << 64) - 1:016x}", r[2]) for r in found), key=str)
    assert found == brute.simhash_groups([r[:2] for r in edge_rows])


def test_one_row_of_each_group_stays(spark, edge_docs, edge_rows, no_docs):
    kept = simhash_dedup.one_of_each_group(edge_docs)
    groups = simhash_dedup.near_groups(edge_docs)
    assert kept.count() == groups.select("root").distinct().count()
    least = {r.component_id for r in groups.select("component_id").distinct().collect()}
    assert {r.doc_id for r in kept.collect()} == least and kept.columns == edge_docs.columns
    assert simhash_dedup.one_of_each_group(no_docs).isEmpty()


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_no_link_is_missed(spark, blocks, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, np.uint64)
    prints = set()
    for p in base.tolist():
        for bits in range(7):
            flips = rng.choice(64, bits, replace=False)
            prints.add(p ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    monkeypatch.setattr(simhash_dedup, "blocks_for", lambda count, radius: blocks)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    roots = components.components(simhash_dedup.fingerprint_links(rows, 4))
    found = {r.node & (1 << 64) - 1: r.root for r in roots.collect()}
    labels = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                old, new = max(labels[i], labels[j]), min(labels[i], labels[j])
                labels = [new if x == old else x for x in labels]
    groups = {frozenset(p for p, x in zip(prints, labels) if x == y) for y in set(labels) if labels.count(y) > 1}
    assert {frozenset(p for p in found if found[p] == r) for r in set(found.values())} == groups


def test_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(50)] + [(5, 5), (3000, 2999)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(51)} | {3000: 2999, 2999: 2999}
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)


def test_fingerprint_of_few_words():
    assert simhash_dedup.fingerprint(b"") == 0 and simhash_dedup.fingerprint(b" \n") == 0
    assert simhash_dedup.fingerprint(b"A  b") == simhash_dedup.fingerprint(b"a B\t")
    rng = np.random.default_rng(1)
    words = b" ".join(b"w%d" % x for x in rng.integers(0, 50, 40000))
    assert f"{simhash_dedup.fingerprint(words):016x}" == brute.simhash_groups([(1, words.decode())])[0][1]
