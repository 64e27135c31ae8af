"""Toxicity, quality and lattice scores on small corpora."""

import math
import random

import pytest
from pyspark.sql import functions as F

from foldboard.llm import quality_classifier, toxicity
from foldboard.llm.common import id_remainder, table
from foldboard.llm.lattice_lm import Lattice, learnt_pieces, load_lattice, score_texts, word_counts


@pytest.fixture(scope="module")
def corpus(spark):
    """500 texts, a fifth of them rude, a fifth of the others full of symbols."""
    rng = random.Random(1)
    docs, labels = [], []
    for k in range(500):
        words = [f"w{rng.randrange(80)}" for _ in range(rng.randrange(40, 90))]
        if k % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "awful", "nasty"]))
        good = k % 5 != 1
        docs.append((k, " ".join(words) if good else " ".join(w + "$$$" for w in words)))
        labels.append((k, int(k % 5 == 0), int(good)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, quality int"),
    )


def accuracy(scored, labels, name):
    rows = scored.join(labels, "doc_id").filter("doc_id % 4 = 0")
    return rows.select(F.avg((F.col("predicted") == F.col(name)).cast("double"))).first()[0]


def test_toxicity_finds_unseen_texts(corpus, edge_docs, no_docs, spark, sparse):
    docs, labels = corpus
    known = labels.filter("doc_id % 4 <> 0").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, known)
    assert accuracy(toxicity.score_toxicity(docs, model), labels, "toxic") > 0.97
    rows = toxicity.score_toxicity(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(no_docs, model).count() == 0
    # One class only, and no labels at all.
    for part in (known.filter("label = 0"), known.limit(0)):
        alone = toxicity.fit(docs, part)
        assert toxicity.score_toxicity(docs, alone).filter("predicted = 1").isEmpty()


def test_shared_backoff_cancels_for_rare_words():
    model = toxicity.ToxicityModel(words={"known": 2})
    model.lower = toxicity.np.array([[0.2, 0.1, 0.1], [0.2, 0.1, 0.4]])
    model.backoff = toxicity.np.ones((2, 3))
    model.upper = toxicity.np.zeros((2, 0))
    assert model.evidence("never seen") == 0
    assert abs(model.evidence("known") - math.log(4)) < 1e-12
    assert model.evidence("") == model.evidence(None) == 0


def test_quality_finds_unseen_texts(corpus, edge_docs, no_docs, sparse):
    docs, labels = corpus
    known = labels.filter("doc_id % 4 <> 0").select("doc_id", F.col("quality").alias("label"))
    model = quality_classifier.fit(docs, known)
    assert accuracy(quality_classifier.score_quality(docs, model), labels, "quality") > 0.97
    rows = quality_classifier.score_quality(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.score_quality(no_docs, model).count() == 0
    empty = quality_classifier.fit(no_docs.select("doc_id", "text"), known)
    assert {r["score"] for r in quality_classifier.score_quality(docs, empty).collect()} == {0.5}


def test_neighbours_are_exact(corpus):
    np = quality_classifier.np
    rng = np.random.default_rng(0)
    model = quality_classifier.QualityModel(neighbours=5)
    model.space = rng.standard_normal((quality_classifier.TERMS, 8)).astype("float32")
    texts = [f"text number {k} of some" for k in range(40)]
    model.vectors = model.project(texts)
    model.labels = (np.arange(40) % 3 == 0).astype(float)
    near = model.project(["another text here"]) @ model.vectors.T
    best = sorted(range(40), key=lambda k: -near[0, k])[:5]
    weight = np.maximum(near[0, best].astype(float), 0) ** 8
    expected = (weight * model.labels[best]).sum() / weight.sum()
    assert abs(model.scores(["another text here"])[0] - expected) < 1e-9


def segmentations(text, lattice):
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, len(text) + 1):
        if text[:n] in lattice.pieces:
            total += math.exp(lattice.pieces[text[:n]]) * segmentations(text[n:], lattice)
    spelt = math.exp(lattice.single_byte * len(text[0].encode()))
    return total + spelt * segmentations(text[1:], lattice)


def test_forward_recursion_sums_all_segmentations():
    weights = {"▁": 0.1, "a": 0.1, "b": 0.05, "ab": 0.2, "▁a": 0.1, "ba": 0.15, "é": 0.01}
    lattice = Lattice({k: math.log(v) for k, v in weights.items()}, math.log(1e-3), -5.0, 2)
    for word in ("a", "abab", "aé", "zb", "bababab"):
        assert abs(math.exp(lattice.word(word)) / segmentations("▁" + word, lattice) - 1) < 1e-9


def test_vocabulary_is_a_distribution():
    lattice = load_lattice()
    total = sum(math.exp(w) for w in lattice.pieces.values())
    total += 256 * math.exp(lattice.single_byte) + math.exp(lattice.end)
    assert abs(total - 1) < 1e-6


@pytest.mark.parametrize("share", [1 / 200_000, 0.01])
def test_scores_match_sums_over_tokens(spark, edge_docs, sparse, monkeypatch, share):
    monkeypatch.setattr("foldboard.llm.lattice_lm.HEAD_SHARE", share)
    docs = edge_docs.select("doc_id", "text", (id_remainder("doc_id", 7) != 2).alias("training"))
    lattice = load_lattice()
    rows = score_texts(docs, lattice, learn=False).collect()
    given = docs.collect()
    assert len(rows) == len(given)
    split = lambda text: [*(text or "").encode().lower().split(), None]
    counts = {}
    for r in given:
        for token in split(r["text"]) if r["training"] else []:
            counts[token] = counts.get(token, 0) + 1
    n, v = sum(counts.values()), len(counts)

    def expected(text):
        base = score = 0.0
        for token in split(text):
            c = counts.get(token, 0)
            p = lattice.end if token is None else lattice.word(token.decode())
            base += math.log10((c + 1) / (n + v + 1))
            score += math.log10((c + v * math.exp(p)) / (n + v)) if c else (math.log(v / (n + v)) + p) / math.log(10)
        known = sum(t in counts for t in split(text))
        return (len(split(text)), known, round(base, 5), round(score, 5))

    found = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5)) for r in rows)
    assert found == sorted(expected(r["text"]) for r in given)
    assert {r["train_tokens"] for r in rows} == {n}


def test_words_together_are_as_one_by_one():
    lattice = load_lattice()
    words = ["a", "there", "là", "🙂x", "", "the\x00", "thereof", "z" * 50, "there"]
    single = [lattice.word(w) for w in words]
    assert lattice.words(words) == pytest.approx(single, abs=1e-9)


def uses_by_enumeration(text, lattice):
    """Expected uses: every segmentation, written out."""
    paths = []

    def extend(at, used, weight):
        if at == len(text):
            paths.append((used, math.exp(weight)))
            return
        for stop in range(at + 1, len(text) + 1):
            piece = text[at:stop]
            if piece in lattice.pieces:
                extend(stop, [*used, piece], weight + lattice.pieces[piece])
        n = len(text[at].encode())
        extend(at + 1, [*used, *[None] * n], weight + n * lattice.single_byte)

    extend(0, [], 0.0)
    total, uses = sum(p for _, p in paths), {}
    for used, p in paths:
        for piece in used:
            uses[piece] = uses.get(piece, 0) + p / total
    return [uses.get(piece, 0.0) for piece in [*lattice.pieces, None]]


@pytest.mark.parametrize("long_word", [0, 32])
def test_expected_uses_sum_all_segmentations(monkeypatch, long_word):
    monkeypatch.setattr("foldboard.llm.lattice_lm.LONG_WORD", long_word)
    weights = {"▁": 0.1, "a": 0.1, "b": 0.05, "ab": 0.2, "▁a": 0.1, "ba": 0.15, "é": 0.01}
    lattice = Lattice({k: math.log(v) for k, v in weights.items()}, math.log(1e-3), -5.0, 2)
    words = ["abab", "aé", "zb", "babab", "abab"]
    each = [uses_by_enumeration("▁" + w, lattice) for w in words]
    assert list(lattice.uses(words)) == pytest.approx([sum(u) for u in zip(*each, strict=True)], abs=1e-9)


def test_learnt_pieces_are_a_distribution_that_predicts_new_words(spark, sf_dir, sparse):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (id_remainder("doc_id", 7) != 2).alias("training")
    )
    prior = load_lattice()
    lattice = learnt_pieces(word_counts(docs), prior)
    total = sum(math.exp(w) for w in lattice.pieces.values())
    assert abs(total + 256 * math.exp(lattice.single_byte) + math.exp(lattice.end) - 1) < 1e-6
    new = word_counts(docs).filter("count = 0").select("word").toPandas()["word"].tolist()
    assert len(new) > 100
    # More than a hundred times likelier a word than by rank.
    assert (lattice.words(new) - prior.words(new)).mean() > math.log(100)


def test_lattice_without_training_or_rows(no_docs, edge_docs, sparse):
    lattice = load_lattice()
    none = no_docs.select("doc_id", "text", F.lit(True).alias("training"))
    assert score_texts(none, lattice).count() == 0
    untrained = edge_docs.select("doc_id", "text", F.lit(False).alias("training"))
    rows = score_texts(untrained, lattice).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] < 0 for r in rows)


def test_held_out_accuracy_on_documents(spark, sf_dir, sparse):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_classifier.op5_quality_classifier(spark, sf_dir).filter("held_out")
    right = scored.join(labels, "doc_id").select(
        F.avg((F.col("predicted") == F.col("quality")).cast("double"))
    )
    assert right.first()[0] > 0.8
    assert docs.count() == quality_classifier.op5_quality_classifier(spark, sf_dir).count()


def test_lattice_leaves_texts_that_no_piece_begins_with():
    """A look-up or two per character where no piece goes on, not one per piece length."""
    from foldboard.llm.lattice_lm import Lattice

    class Counted(dict):
        asked = 0

        def get(self, *own):
            self.asked += 1
            return super().get(*own)

    pieces = {"a": -1.0, "ab": -1.5, "abcdefghij": -2.0}
    lattice, plain = Lattice(pieces, -6.0, -6.0, 10), Lattice(pieces, -6.0, -6.0, 10)
    lattice.__dict__["reach"] = counted = Counted(lattice.reach)
    words = ["z" * 20, "abzz" * 5]
    assert lattice.words(words).tolist() == pytest.approx([plain.word(w) for w in words])
    assert counted.asked < 2 * 21 * 2
