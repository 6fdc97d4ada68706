import os
import random

import pytest

SF_DIR = os.environ.get("RAILTEMPO_TESTDATA", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, removed int"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows and ids, shared passages, a repeated line, odd characters."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgéß中") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, line = prose(70), "One line that stands in many of these documents, over and over.\n"
    texts = [None, "", "  \n\t ", "one", "Ten words and no more than ten are in here .", "aaa " * 300, "x" * 3000, prose(12000)]
    texts += [prose(rng.randint(1, 150)) for _ in range(20)]
    texts += [f"{prose(rng.randint(0, 40))} {passage} {prose(rng.randint(0, 40))}" for _ in range(8)]
    texts += [prose(30) + "\n" + line * rng.randint(1, 40) for _ in range(12)]
    base = prose(120).split()
    for _ in range(8):
        base[rng.randrange(120)] = rng.choice(words)
        texts.append(" ".join(base))
    texts += [texts[9], texts[9], texts[30], "é \U0001f600 <|x|> $$$ ### * | & %", "nul\x00byte \x1f unit"]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    rows += [(None, texts[12]), (None, "no id"), (rows[9][0], rows[9][1]), (rows[9][0], rows[9][1]), (rows[10][0], prose(60))]
    langs, sources = ["en", "de", None], ["web", "bücher", None, ""]
    return [(i, t, langs[k % 3], sources[k % 4], len(t or ""), "k", "s", k) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]
