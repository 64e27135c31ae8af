import random
from collections import Counter

import numpy as np

from foldboard import scratch
from foldboard.llm import near_dedup
from foldboard.llm.near_dedup import (
    BANDS,
    bands,
    components,
    marked,
    near_duplicates,
    one_per_class,
    shingles,
    signature,
    similarity,
)


def grams(text):
    words = text.lower().split()
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_similarity(a, b):
    a, b = grams(a), grams(b)
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def families(seed=3):
    """Texts with 0 to 12 words changed, and repeated passages, so that counts matter."""
    rng = random.Random(seed)
    texts = []
    for family in range(12):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(120)]
        base = base[:60] * 2 if family % 3 == 0 else base
        for _ in range(8):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10_000)}"
            texts.append(" ".join(words))
    return texts


def plain_classes(texts):
    root = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j in range(i):
            if plain_similarity(a, texts[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def test_similarity_counts_repetitions():
    texts = families()
    for a, b in zip(texts[:40], texts[1:41], strict=True):
        assert abs(similarity(shingles(a), shingles(b)) - plain_similarity(a, b)) < 1e-12


def test_registers_agree_as_often_as_texts_are_similar():
    # Registers of one pair depend on each other little, so many pairs give the mean closely.
    texts = families(5)
    difference = []
    for a, b in zip(texts[:-1], texts[1:], strict=True):
        sa, sb = shingles(a), shingles(b)
        agree = np.mean(signature(*sa) == signature(*sb))
        difference.append(agree - similarity(sa, sb))
    assert abs(np.mean(difference)) < 0.01


def test_heavy_counts_are_thinned_without_bias():
    keys = shingles("a b c d e f g")[0]
    one, many = np.array([5, 1, 1]), np.array([3, 1, 6])
    expected = np.minimum(one, many).sum() / np.maximum(one, many).sum()
    agree = []
    for k in range(60):
        moved = keys + np.uint64(k * 7919)
        agree.append(np.mean(signature(moved, one) == signature(moved, many)))
    assert abs(np.mean(agree) - expected) < 0.03


def test_signatures_do_not_depend_on_company():
    keys, counts = shingles("some text of a few words only")
    assert len(bands(signature(keys, counts))) == BANDS
    assert (signature(keys, counts) == signature(keys.copy(), counts.copy())).all()


def test_classes_match_brute_force(spark, sparse):
    texts = families()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    assert [found[k] for k in range(len(texts))] == plain_classes(texts)


def test_leaders_are_compared_in_one_turn(spark, sparse, monkeypatch):
    texts = families(7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = []

    def recorded(df, label):
        labels.append(label)
        return scratch.written(df, label)

    monkeypatch.setattr(near_dedup, "written", recorded)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    assert [found[k] for k in range(len(texts))] == plain_classes(texts)
    assert labels.count("verified") == 2


def test_few_links_are_followed_without_shuffles(spark, sparse, monkeypatch):
    chain = [(f"{k:02}".encode(), f"{k + 1:02}".encode()) for k in range(9)] + [(b"x", b"y")]
    links = spark.createDataFrame(chain, "a binary, b binary")
    plans = []

    def recorded(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return scratch.written(df, label)

    def roots():
        plans.clear()
        return {bytes(r["node"]): bytes(r["root"]) for r in components(links).collect()}

    monkeypatch.setattr(near_dedup, "written", recorded)
    expected = {f"{k:02}".encode(): b"00" for k in range(10)} | {b"x": b"x", b"y": b"x"}
    assert roots() == expected
    assert not any("Exchange hashpartitioning" in plan for plan in plans)
    monkeypatch.setattr(scratch, "ROWS_PER_TASK", 0)
    assert roots() == expected
    assert any("Exchange hashpartitioning" in plan for plan in plans)


def test_edge_rows(edge_docs, no_docs, sparse):
    rows = near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"]))
    assert of[1] == of[2] == [(1, 3)]
    assert of[4] == [(4, 2)] * 2
    assert of[3] == [(3, 1)]
    assert sorted(of[8]) == [(1, 3), (8, 1)]
    assert near_duplicates(no_docs).count() == 0
    kept = one_per_class(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["1", "3", "4", "None", "None", "6", "7", "8"]
    )
    assert one_per_class(no_docs).count() == 0
    copies = marked(edge_docs.unionByName(edge_docs)).collect()
    assert len(copies) == 2 * edge_docs.count()
    # Rows without text all stay; of everything else one row a class, however often ids and texts are repeated.
    assert sorted(str(r["doc_id"]) for r in copies if r["kept"]) == sorted(
        ["1", "3", "3", "4", "None", "None", "None", "6", "7", "8"]
    )
    assert all(r["kept"] is not None for r in copies)
    assert marked(no_docs).count() == 0
