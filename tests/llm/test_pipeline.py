import importlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from railtempo.llm.common import documents
from railtempo.llm.decontaminate import benchmark_hits
from railtempo.llm.simhash_dedup import near_groups

ROOT = Path(corpus_pipeline.__file__).parent


def test_stages(spark, sf_dir):
    """Each stage's decisions hold for the next one's input."""
    docs = documents(spark, sf_dir)
    first = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns[:5] == docs.columns[:5] and out.count() == out.select("doc_id").distinct().count()
        seen[name], docs = {r.doc_id: r for r in out.collect()}, out
    assert list(seen) == ["quality_classifier", "simhash_dedup", "suffix_dedup", "decontamination", "mixing"]
    good = {i for i in first if i in labels and labels[i].quality == 1 and labels[i].toxic == 0}
    assert len(good & set(seen["quality_classifier"])) >= 0.97 * len(good)
    kept = spark.createDataFrame([(i, r.text) for i, r in seen["simhash_dedup"].items()], "doc_id long, text string")
    assert all(r.doc_id == r.component_id for r in near_groups(kept).collect())
    texts = [r.text for r in seen["suffix_dedup"].values()]
    assert all(r.n_chars == len(r.text) for r in seen["suffix_dedup"].values())
    assert sum(map(len, texts)) < sum(len(r.text) for r in seen["simhash_dedup"].values())
    left = spark.createDataFrame([(i, r.text) for i, r in seen["decontamination"].items()], "doc_id long, text string")
    assert benchmark_hits(left, items).filter("size(spans) > 0").isEmpty()
    dirty = set(seen["suffix_dedup"]) - set(seen["decontamination"])
    before = spark.createDataFrame([(i, seen["suffix_dedup"][i].text) for i in dirty], "doc_id long, text string")
    assert benchmark_hits(before, items).filter("size(spans) = 0").isEmpty()
    assert set(seen["mixing"]) == set(seen["decontamination"]) and all(r.taken <= 2 * r.size for r in seen["mixing"].values())


@pytest.mark.parametrize("kind", ["long", "int"])
def test_stages_over_odd_rows(spark, sf_dir, edge_docs, edge_rows, kind):
    """Missing and repeated ids, equal rows, and columns with the names of results: no stage makes rows, mixing loses none."""
    docs = edge_docs.select(F.col("doc_id").cast(kind).alias("doc_id"), "text", "lang", "source", "n_chars")
    before = Counter(tuple(r) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.columns[:5] == docs.columns
        found = Counter(tuple(r)[:5] for r in out.collect())
        assert found.total() <= before.total()
        if name in ("quality_classifier", "simhash_dedup", "decontamination"):
            assert found <= before
    assert found == before
    odd = docs.withColumns({"k": F.lit(1), "i": F.lit("i"), "name": F.lit("n"), "size": F.lit(-1)})
    mixed = corpus_pipeline.mix_sources(spark, odd, sf_dir).collect()
    assert Counter(tuple(r)[:8] for r in mixed) == Counter((*row, 1, "i", "n") for row in before.elements())
    assert all(r["size"] == len((r.text or "").encode().split()) and r.taken == r.copies * r["size"] for r in mixed)


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "copies", "target", "taken"} <= set(out.columns) and out.count() > 0


def test_entry_works_without_this_subpackage(tmp_path):
    import shutil

    shutil.copytree(ROOT / "railtempo", tmp_path / "railtempo", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'line_report' in e.queries() and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_every_operator_is_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in entry.queries()
