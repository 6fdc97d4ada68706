"""Operators with learnt parts: language, quality, outliers, language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railtempo.llm import language_id, lm_scoring, quality_classifier, quality_rules
from railtempo.llm.common import id_bucket


# --- language -----------------------------------------------------------------------------


def test_op3_held_out_accuracy(spark, sf_dir):
    found = language_id.op3_language_id(spark, sf_dir).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found) and len(found) == len(truth)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*truth.values(), "und"} for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def parsed(text, sample, piece=language_id.PIECE):
    """Phrases of a text, by search in the sample."""
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    low = re.sub(" +", " ", low)
    n = 0
    for at in range(0, len(low), piece):
        part, i = low[at : at + piece], 0
        while i < len(part):
            k = 1
            while i + k < len(part) and part[i : i + k + 1] in sample:
                k += 1
            i += k
            n += 1
    return n


def test_phrases_against_search():
    texts = {"x": ["the cat sat on the mat and the dog"], "y": ["der hund und die katze auf der matte"]}
    samples = language_id.Samples(texts)
    asked = ["the dog sat", "die katze", "zzz the", "ä the hat", "q", "The CAT!! sat", "", "123", "katze " * 200]
    needed, count = samples.phrases(asked)
    for row, text in zip(needed, asked):
        expected = [parsed(text, texts[l][0]) for l in ("x", "y")]
        if any(c.isalpha() for c in text):
            assert row.tolist() == expected, text
    langs, scores = samples.predict(asked + [None])
    assert langs[:2] == ["x", "y"] and langs[6:8] == ["und", "und"] and langs[9] == "und" and scores[9] == 0
    assert langs[4] == "x"  # a tie


@pytest.mark.parametrize("limits", [{}, {"cells": 0}, {"all_cells": 9000}])
def test_a_large_script_cuts_no_sample(limits):
    """Languages are parsed as each one is alone, whatever letters the others have, and by both kinds of table."""
    rng = np.random.default_rng(8)
    han = [chr(0x4E00 + i) for i in range(3000)]
    own = {
        "en": " ".join("".join(rng.choice(list("etaoinsh"), rng.integers(1, 7))) for _ in range(700)),
        "zh": "".join(rng.permutation(han)) + " ".join("".join(rng.choice(han, 20)) for _ in range(100)),
        "de": " ".join("".join(rng.choice(list("enirstaßü"), rng.integers(1, 9))) for _ in range(700)),
    }
    samples = language_id.Samples({lang: [text] for lang, text in own.items()}, **limits)
    asked = [text[at : at + 300] for text in own.values() for at in (0, 900, 2500)] + ["th中 ss", "ßé"]
    needed, _ = samples.phrases(asked)
    for row, text in zip(needed, asked):
        assert row.tolist() == [parsed(text, own[lang]) for lang in ("de", "en", "zh")], text
    assert samples.bits == [pytest.approx(math.log2(len(own[lang]) + 1)) for lang in ("de", "en", "zh")]


def test_a_language_of_long_texts_is_learnt(spark):
    """Also where a long text is mostly not letters, and texts without any come first or are many."""
    long, odd = "kala maja suur vesi " * 400, "1" * 30000 + " ja hästi " + "-" * 30000
    rows = [("en", "the cat sat on the mat and the dog ran"), ("et", long), ("xx", odd), ("00", "123 " * 2000), (None, long)]
    rows += [("xx", f"{i} {i}!" * (1 + i)) for i in range(300)]
    samples = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert samples.langs == ["en", "et", "xx"]
    assert samples.bits[1] == pytest.approx(math.log2(language_id.SAMPLE_CHARS + 1))
    assert samples.predict(["suur maja", "hästi", "the dog"])[0] == ["et", "xx", "en"]


def test_language_edges(spark, edge_docs, no_docs, edge_rows):
    samples = language_id.learn(edge_docs)
    assert samples.langs == ["de", "en"]
    out = language_id.predict(edge_docs, samples)
    assert out.columns == [c for c in edge_docs.columns if c not in ("text", "score")] + ["lang_pred", "score"]
    assert out.count() == len(edge_rows) and {r.lang_pred for r in out.collect()} == {"de", "en", "und"}
    assert language_id.predict(no_docs, samples).isEmpty()
    nothing = language_id.learn(no_docs)
    assert {r.lang_pred for r in language_id.predict(edge_docs, nothing).collect()} == {"und"}


# --- quality classifier -------------------------------------------------------------------


def test_op6_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    if not __import__("os").path.isdir(folder):
        pytest.skip("no test tables")
    found = {r.doc_id: r for r in quality_classifier.op6_quality_classifier(spark, folder).collect()}
    truth = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [r for r in truth if r.quality == 1 and r.toxic == 0]
    assert sum(found[r.doc_id].kept for r in good) >= 0.98 * len(good)
    toxic = [r for r in truth if r.toxic == 1]
    assert sum(not found[r.doc_id].kept for r in toxic) >= 0.95 * len(toxic)
    bad = [r for r in truth if r.quality == 0]
    assert sum(not found[r.doc_id].kept for r in bad) >= 0.9 * len(bad)
    assert all(abs(r.p_clean + r.p_junk + r.p_toxic - 1) < 1e-9 for r in found.values())


def test_labellers_see_planted_faults(spark):
    import pyarrow as pa

    texts = ["A plain sentence about trains and their times.", "You stupid idiot, worthless trash!", "buy ### $$$ %%% &&& now $$$ ###", "LOUD!! WORDS!! ONLY!! HERE!! ALL!!", "word " * 40, "", "same line here\n" * 9]
    patterns = quality_classifier.Texts(pa.array(texts)).pattern()
    names = list(quality_classifier.LABELLERS)
    fired = [{names[i] for i in range(len(names)) if p >> i & 1} for p in patterns.tolist()]
    assert fired[0] == {"plain shape", "varied words"}
    assert {"abuse, first list", "abuse, second list", "abuse, several"} <= fired[1]
    assert "symbols" in fired[2] and "shouting" in fired[3] and "no words" in fired[5]
    assert {"repeated words", "few distinct words"} <= fired[4] and {"repeated passages", "repeated lines"} <= fired[6]


def test_expectation_maximisation_finds_rates():
    rng = np.random.default_rng(0)
    truth = rng.choice(3, 20000, p=[0.7, 0.2, 0.1])
    speaks = np.array(list(quality_classifier.LABELLERS.values()))
    rate = np.where(speaks[:, None] == np.arange(3), 0.6, 0.01)
    rate[speaks == quality_classifier.CLEAN] = [0.95, 0.1, 0.7]
    fires = rng.random((20000, len(speaks))) < rate[:, truth].T
    fires[:, quality_classifier.PEOPLE :] = False
    patterns, counts = np.unique((fires << np.arange(len(speaks))).sum(1), return_counts=True)
    share, found = quality_classifier.expectation_maximisation(patterns, counts.astype(float))
    assert share == pytest.approx([0.7, 0.2, 0.1], abs=0.03)
    heuristics = slice(0, quality_classifier.PEOPLE)
    assert found[heuristics] == pytest.approx(rate[heuristics], abs=0.1)


def test_classifier_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(0, 1, None), (3, 0, 1), (3, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(edge_docs, labels)
    assert out.count() == len(edge_rows) and "text" in out.columns and out.schema["kept"].dataType.simpleString() == "boolean"
    assert quality_classifier.classify(edge_docs).count() == len(edge_rows)
    assert quality_classifier.classify(no_docs, labels).isEmpty()


# --- quality rules ------------------------------------------------------------------------


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    twice = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice)


def test_counts(spark, edge_docs, edge_rows):
    found = quality_rules.text_counts(edge_docs).select("removed", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {r[7]: counts_of(r[1]) for r in edge_rows}


def test_op7_over_the_table(spark, sf_dir, table_rows):
    texts = dict(table_rows)
    found = quality_rules.op7_quality_rules(spark, sf_dir).collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        n, chars, symbols, dup, twice = counts_of(texts[r.doc_id])
        failed = n < 10 or 100 * twice > 20 * n
        assert tuple(r)[1:7] == (n, chars, symbols, dup, twice, failed) and not (failed and r.kept)
    good = [r for r in found if not r.base_failed and r.doc_id in labels and labels[r.doc_id].quality == 1]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_outliers_do_not_move_the_estimate(spark):
    """A fifth of a group far away: the centre stays with the rest, and the fifth is rejected."""
    rng = np.random.default_rng(2)
    rows = [("g", [float(v) for v in rng.normal(0, 1, 4) + (40 if i % 5 == 0 else 0)]) for i in range(1000)]
    rows += [("h", [7.0, 0.0, 0.0, 1.0])] * 60
    fitted = {r.g: r for r in quality_rules.fit(spark.createDataFrame(rows, "g string, x array<double>")).collect()}
    assert np.abs(fitted["g"].centre).max() < 0.3
    scatter = np.linalg.inv(np.array(fitted["g"].inverse).reshape(4, 4)) - np.diag(np.square(quality_rules.FLOORS))
    # The scale supposes no outliers: here the nearest three quarters are nearly all that is left of the rest.
    assert np.abs(scatter - np.eye(4)).max() < 0.6
    assert fitted["h"].centre == pytest.approx([7, 0, 0, 1])


def test_rules_edges(spark, edge_docs, edge_rows, no_docs):
    out = quality_rules.judge(edge_docs)
    assert out.count() == len(edge_rows) and out.filter("kept AND base_failed").isEmpty()
    assert quality_rules.judge(no_docs).isEmpty()


# --- language model -----------------------------------------------------------------------


def unigram(rows, learns):
    counts = Counter()
    for i, t in rows:
        if learns(i):
            counts.update([*(t or "").encode().lower().split(), None])
    total, size = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in tokens)
        out.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    return out


def bucket(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def same_scores(found, expected):
    found = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=lambda r: str(r[:4]))
    expected = sorted(expected, key=lambda r: str(r[:4]))
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert sorted(r[4] for r in found) == pytest.approx(sorted(r[4] for r in expected))


def test_op9_base(spark, sf_dir, table_rows):
    found = lm_scoring.op9_lm_scoring(spark, sf_dir).collect()
    assert all(r.held_out == (bucket(r.doc_id, 7) == 2) and r.score < 0 for r in found)
    same_scores(found, unigram(table_rows, lambda i: bucket(i, 7) != 2))
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("head", [1 << 17, 60, 5])
def test_lm_edges(spark, edge_docs, edge_rows, head):
    found = lm_scoring.score(edge_docs, id_bucket(7) != 2, head=head).collect()
    same_scores(found, unigram([r[:2] for r in edge_rows], lambda i: bucket(i, 7) != 2))


def test_lm_without_rows(spark, edge_docs, no_docs):
    assert lm_scoring.score(no_docs, F.lit(True)).isEmpty()
    found = lm_scoring.score(edge_docs, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in found)


def some_vocabulary(n=9000):
    """Words alone, in shared classes and in bands, and others that are not broadcast."""
    rng = np.random.default_rng(6)
    words = sorted(((f"w{i}".encode(), int(k)) for i, k in enumerate(rng.integers(1, 90, n))), key=lambda r: -r[1])
    return lm_scoring.vocabulary([(lm_scoring.END.encode(), 7), *words], 20 * n * 90, 3 * n)


@pytest.fixture
def small_classes(monkeypatch):
    """The same model with fewer words in shared classes."""
    monkeypatch.setattr(lm_scoring, "SIZE", 16)
    monkeypatch.setattr(lm_scoring, "OWN", lm_scoring.ALONE + lm_scoring.SHARED * 16)


def test_shares_of_bands_add_up():
    v = lm_scoring.vocabulary([(b"the", 50), (lm_scoring.END.encode(), 20), (b"a", 5), (b"b", 5)], 100, 14)
    assert 10 ** -v.log_share()[lm_scoring.RARE] * (20 + 10 + 1) == pytest.approx(1)


def test_model_is_normalised(small_classes):
    """Over every broadcast word and what stands for the others, before and after vectors have moved."""
    v = some_vocabulary()
    model = lm_scoring.LogBilinear(v)
    every = np.arange(len(v.kind) + 1)
    assert set(np.unique(model.kind)) == set(range(lm_scoring.CLASSES))
    shares = 10 ** (v.log_count - v.log_share()[v.kind])
    for k in range(lm_scoring.ALONE + lm_scoring.SHARED, lm_scoring.RARE):
        assert shares[v.kind == k].sum() == pytest.approx(1)
    unigram = np.append(v.log_count - np.log10(v.tokens.sum() + v.words.sum() + 1), v.log_share()[-1] - np.log10(v.tokens.sum() + v.words.sum() + 1))
    assert model.log_probabilities(every * 0, every * 0 + 60, every) / np.log(10) == pytest.approx(unigram, abs=1e-3)
    rng = np.random.default_rng(7)
    model.rows[:, : lm_scoring.DIM + 1] += rng.normal(0, 0.2, (len(model.rows), lm_scoring.DIM + 1))
    model.rows[: model.one, lm_scoring.DIM] = 0
    model.rows[model.one : model.classes, lm_scoring.DIM] = 1
    for two, one in ((0, 0), (3, 60), (5000, len(v.kind))):
        assert np.exp(model.log_probabilities(every * 0 + two, every * 0 + one, every)).sum() == pytest.approx(1, rel=1e-4)


def test_noise_contrastive_steps_learn_classes_and_words(small_classes):
    """Words alone and words of shared classes that follow one context each."""
    v = some_vocabulary()
    model = lm_scoring.LogBilinear(v)
    own = lm_scoring.Training(model, 0, 0)
    rng = np.random.default_rng(8)
    follows = {10: 20, 11: 900, 12: 901, 13: 5}
    before = np.array(list(follows))
    after = np.array(list(follows.values()))
    start = model.log_probabilities(before * 0, before, after)
    for _ in range(150):
        pick = rng.integers(0, 4, 400)
        own.step(np.zeros(400, np.int64), before[pick], after[pick])
    model.rows[:] = own.rows
    assert (model.log_probabilities(before * 0, before, after) > np.log(0.3)).all()
    assert (model.log_probabilities(before * 0, before, after) > start + 2).all()
    assert np.exp(model.log_probabilities(np.zeros(len(v.kind) + 1, int), np.full(len(v.kind) + 1, 11), np.arange(len(v.kind) + 1))).sum() == pytest.approx(1, rel=1e-4)


@pytest.fixture
def exponentials(monkeypatch):
    """How many exponentials numpy has taken."""
    taken, exp = [0], np.exp

    def counted(x, *args, **kw):
        taken[0] += np.size(x)
        return exp(x, *args, **kw)

    monkeypatch.setattr(np, "exp", counted)
    return taken


def test_tokens_share_noise(small_classes, exponentials):
    """A step takes exponentials of the noise drawn, and not of all classes for each token."""
    v = some_vocabulary()
    own = lm_scoring.Training(lm_scoring.LogBilinear(v), 0, 0)
    two, one, words = np.random.default_rng(3).integers(0, len(v.kind) + 1, (3, 8192))
    exponentials[0] = 0
    own.step(two, one, words)
    assert 0 < exponentials[0] < 8192 * 100 < 8192 * lm_scoring.CLASSES


def test_noise_of_a_step_is_spread(small_classes):
    """Each class is drawn about as often as its frequency says."""
    own = lm_scoring.Training(lm_scoring.LogBilinear(some_vocabulary()), 0, 0)
    at = own.strata(128, lm_scoring.NOISE)
    assert ((at * lm_scoring.NOISE).astype(int) == np.arange(lm_scoring.NOISE)).all()
    drawn = np.bincount(np.searchsorted(own.upto, at.ravel()), minlength=lm_scoring.CLASSES)
    assert drawn == pytest.approx(own.model.noise / own.model.noise.sum() * at.size, abs=6)


def test_equal_contexts_are_normalised_once(small_classes, exponentials):
    v = some_vocabulary()
    model = lm_scoring.LogBilinear(v)
    two, one, words = np.random.default_rng(4).integers(0, 5000, (3, 20))
    exponentials[0] = 0
    found = model.log_probabilities(np.tile(two, 500), np.tile(one, 500), np.tile(words, 500))
    assert exponentials[0] < 20 * 3 * lm_scoring.CLASSES
    assert (found.reshape(500, 20) == found[:20]).all()


@pytest.mark.parametrize("size", [0.3, 40])
def test_model_against_softmax(small_classes, monkeypatch, size):
    """In parts, with exponentials kept from call to call, and where the sums of products leave the range of floats."""
    v = some_vocabulary()
    model = lm_scoring.LogBilinear(v)
    rng = np.random.default_rng(9)
    model.rows[: model.classes, : lm_scoring.DIM] = rng.normal(0, size, (model.classes, lm_scoring.DIM))
    two, one, words = rng.integers(0, len(v.kind) + 1, (3, 3000))
    hidden = (model.rows[two] + model.rows[one + model.one]).astype(float)

    def softmax(score, which):
        top = score.max(1, keepdims=True)
        return score[np.arange(len(which)), which] - top[:, 0] - np.log(np.exp(score - top).sum(1))

    kind = model.kind[words]
    expected = softmax(hidden @ model.rows[model.classes : model.words].T, kind) + model.share[words]
    for i in np.flatnonzero((words >= lm_scoring.ALONE) & (words < model.own)):
        k = kind[i] - lm_scoring.ALONE
        begin = k * lm_scoring.SIZE
        of = model.rows[model.words + begin : model.words + begin + model.size[k]]
        expected[i] += softmax(hidden[i : i + 1] @ of.T, [words[i] - lm_scoring.ALONE - begin])[0]
    monkeypatch.setattr(lm_scoring, "SCORED", 700)
    monkeypatch.setattr(lm_scoring, "KEPT", 100)
    held = {}
    for part in (slice(0, 2000), slice(2000, 3000)):
        found = model.log_probabilities(two[part], one[part], words[part], held)
        assert found == pytest.approx(expected[part], rel=1e-4, abs=1e-3)
    assert len(held) == 2
    assert model.log_probabilities(two, one, words) == pytest.approx(expected, rel=1e-4, abs=1e-3)


def test_words_of_odd_texts():
    """As bytes.lower and bytes.split have it, whatever portions the texts come in."""
    rng = random.Random(1)
    marks = ["a", "Z", "É", "\x85", "\xa0", "\u2003", "\x00", "\x1c", "\x1f", "\x0b", "\x0c", "\r", "\n", "\t", " ", " ", "中", "\U0001f600"]
    texts = [b"", b" ", b"\n\n", *("".join(rng.choices(marks, k=rng.randint(0, 30))).encode() for _ in range(500))]
    batch = pa.record_batch([pa.array(texts, pa.binary())], ["body"])
    for size in (1, 300, 1 << 22):
        at = 0
        for part in lm_scoring.portions([batch.slice(0, 200), batch.slice(200)], "body", size):
            words, sizes = lm_scoring.words_of(part.column("body"))
            mine = [t.lower().split() for t in texts[at : at + part.num_rows]]
            assert words.to_pylist() == sum(mine, []) and sizes.tolist() == [len(t) for t in mine]
            at += part.num_rows
        assert at == len(texts)


@pytest.mark.parametrize("shard", [1 << 23, 20_000])
def test_scores_do_not_depend_on_partitions(spark, sf_dir, monkeypatch, shard):
    """One shard, and several."""
    monkeypatch.setattr(lm_scoring, "SHARD", shard)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = []
    for parts in (4, 64):
        rows = lm_scoring.score(docs.repartition(parts), id_bucket(7) != 2).collect()
        found.append(np.array([r.score for r in sorted(rows, key=lambda r: r.doc_id)]))
        gain = sum(r.score - r.base_score for r in rows if bucket(r.doc_id, 7) == 2)
        assert gain > 0
    assert found[0] == pytest.approx(found[1], rel=1e-6)


def test_every_broadcast_word_is_a_context_of_its_own(spark):
    """300 words of one frequency, each followed by one other: the word that follows is known, any other is not."""
    rng = np.random.default_rng(5)
    pairs = [(f"a{i}", f"b{i}") for i in range(150)]
    rows = [" ".join(" ".join(pairs[k]) for k in rng.integers(0, 150, 40)) for _ in range(1500)]
    asked = [" ".join(p) for p in pairs] + [f"a{i} b{(i + 1) % 150}" for i in range(150)]
    docs = spark.createDataFrame([(i, t, i < 1500) for i, t in enumerate(rows + asked)], "doc_id long, text string, learn boolean")
    found = {r.doc_id: r.score for r in lm_scoring.score(docs, F.col("learn")).collect()}
    right, wrong = (sum(found[1500 + i] for i in range(k, k + 150)) / 150 for k in (0, 150))
    assert right > wrong + 1
