"""Ranked search, packing and hard negatives on small tables, against plain versions."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldboard.llm import hard_negatives, lexical_search
from foldboard.llm.best import Best
from foldboard.llm.hard_negatives import as_anchor
from foldboard.llm.lexical_search import ranked
from foldboard.llm.packing import Encoder, Lot, best_fit, cut, fewest, offsets, sequences, tokenizer_content

pytestmark = pytest.mark.usefixtures("sparse")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document."""
    split = [(doc, terms_of(text)) for doc, text in docs]
    split = [(doc, words) for doc, words in split if words]
    total, tokens = len(split), sum(len(words) for _, words in split)
    rows = []
    for item, text in items:
        scores = []
        for doc, words in split:
            score = 0
            for term in set(terms_of(text)):
                tf = words.count(term)
                if tf:
                    df = sum(term in other for _, other in split)
                    weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
                    m = 100 - 50 + 50 * len(words) * total // tokens
                    score += weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(scores)[:k], 1):
            rows.append((item, rank, None if missing else doc, -score))
    return sorted(rows, key=str)


@pytest.mark.parametrize("shard_postings", [40, 100_000])
def test_ranking_is_exact(spark, shard_postings):
    """Common and rare terms, ties, copies, missing ids and texts; many shards of few postings, and one."""
    draw = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["Ü", "7", "ab"]
    text = lambda n: " ".join(draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=n))
    docs = [(k, text(draw.randint(1, 40))) for k in range(250)]
    docs += [(300, docs[5][1]), (5, docs[5][1]), (301, None), (302, ""), (303, "-- !"), (None, docs[5][1]), (304, text(4000))]
    items = [(k, text(draw.randint(1, 25))) for k in range(9)] + [(20, "W3,w3-W9"), (21, None), (22, "nowhere"), (20, "w3 w9")]
    clash = "score string, rank string, item string, terms string, row string, wave string"
    found = ranked(
        spark.createDataFrame([(*d, *"xxxxxx") for d in docs], f"doc_id long, text string, {clash}").repartition(5),
        spark.createDataFrame([(*i, *"xxxxxx") for i in items], f"item_id long, text string, {clash}"),
        k=7,
        shard_postings=shard_postings,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_ranking(docs, items, 7)


def test_ranking_edges(edge_docs, no_docs):
    items = edge_docs.select(F.col("doc_id").alias("item_id"), F.lit("word1 two one").alias("text")).limit(2)
    found = ranked(edge_docs, items).collect()
    assert {r["doc_id"] for r in found} == {1, 2, 8, None}
    assert ranked(no_docs, items).count() == ranked(edge_docs, items.limit(0)).count() == 0


def test_optional_units_are_skipped():
    """With a bar in place the lists of common terms are not read, and what is found stays exact."""
    n = 2_000
    draw = np.random.default_rng(1)
    lists = {0: np.arange(n), 1: np.arange(0, n, 2), 2: np.arange(0, n, 3), 3: np.sort(draw.choice(n, 40, replace=False))}
    lengths = np.array([sum(d in s for s in map(set, lists.values())) for d in range(n)])
    terms = np.concatenate([[t for t in lists if d in set(lists[t])] for d in range(n)]).astype("int32")
    counts = draw.integers(1, 4, len(terms)).astype("int32")
    sizes = np.maximum(draw.integers(5, 50, n), 1)
    stats = lexical_search.Statistics(n, int(sizes.sum()), np.array([len(lists[t]) for t in range(4)]))
    queries = lexical_search.Queries([0], {}, [[0, 1, 2, 3]])
    asked = lexical_search.paired(queries, stats.weights())
    parts = lexical_search.shard(np.arange(n), sizes, lengths, terms, counts, stats, asked, 10)
    names = (*lexical_search._LISTS, *lexical_search._PAIRS)
    own = lexical_search.Shard(dict(zip(names, parts)), asked)
    every, pruned = Best(10, 1), Best(10, 1)
    own.search(asked.units[0], every)
    pruned.bar = every.bar
    read = []
    own.impacts = lambda t, f=own.impacts: (read.append(t), f(t))[1]
    own.search(asked.units[0], pruned)
    assert (pruned.found == every.found).all()
    pair = {tuple(p): k for k, p in enumerate(asked.pairs.tolist())}[0, 1]
    # A document with both gains more than one with the better of the two, but less than the sum of both maxima.
    assert max(own.most[0], own.most[1]) <= own.pair_most[pair] <= own.most[0] + own.most[1]
    assert len(own.intersection(pair)) == n // 2
    assert read[:2] == [2, 3]


HARD_TEXTS = [
    "It's 12 o'clock, I'LL wait\r\n\t x",
    "<|endoftext|> is text",
    "Grüße 𝔘𝔫 ٣٤ é 　​\x00\x85\xa0 end ",
    "",
    " ",
    "\n" * 2500 + "a" + " " * 999 + "b" + " " * 5000,
    "y" * 50_000,
    "!?" * 20_000,
]


def test_ids_are_those_of_the_named_library():
    content = tokenizer_content()
    named = Tokenizer.from_str(content)
    named.encode_special_tokens = True
    own = Encoder(content)
    for text in HARD_TEXTS:
        assert own.encode(text) == named.encode(text, add_special_tokens=False).ids
        assert own.exact(text) == own.encode(text)
    assert own._fast


def test_pieces_are_cut_from_the_end():
    assert [cut(n, 10) for n in (1, 10, 11, 20, 25)] == [[0], [0], [0, 1], [0, 10], [0, 5, 15]]


def optimal(lengths, capacity):
    """Fewest bins by trying every way."""
    best = len(lengths)

    def place(k, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if k == len(lengths):
            best = len(loads)
            return
        for number, load in enumerate(loads):
            if load + lengths[k] <= capacity:
                place(k + 1, [*loads[:number], load + lengths[k], *loads[number + 1 :]])
        place(k + 1, [*loads, lengths[k]])

    place(0, [])
    return best


def test_packings_are_near_the_optimum():
    draw = np.random.default_rng(5)
    for _ in range(30):
        lengths = draw.integers(1, 21, 9).astype("int32")
        lot = Lot(lengths, 20, [1])
        population = lot.evolved(lot.first())
        bins = population[0]
        assert (lot.loads(bins) <= 20).all() and len(lot.loads(bins)) == bins.max() + 1
        assert fewest(lengths, 20) <= optimal(lengths.tolist(), 20) <= bins.max() + 1
        assert bins.max() + 1 <= lot.packed(lengths).max() + 1
        begin = offsets(bins, lengths.astype("int64"))
        for number in range(bins.max() + 1):
            own = sorted(zip(begin[bins == number], lengths[bins == number]))
            assert [b for b, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1]


def test_best_fit_takes_the_fullest_bin():
    lengths = np.array([6, 5, 4, 5, 1], "int32")
    bins, loads = np.full(5, -1, "int32"), []
    best_fit(np.arange(5), lengths, bins, loads, 10)
    assert bins.tolist() == [0, 1, 0, 1, 2] and loads == [10, 10, 1]


def test_evolution_beats_best_fit():
    """Triplets that fill a bin exactly: best fit by length alone is far off."""
    draw = np.random.default_rng(2)
    triples = []
    for _ in range(200):
        a = int(draw.integers(700, 980))
        b = int(draw.integers(500, 2048 - a - 300))
        triples += [a, b, 2048 - a - b]
    lot = Lot(np.array(triples, "int32"), 2048, [1])
    population = lot.first()
    before = min(lot.cost(p) for p in population)
    for _ in range(6):
        population = lot.evolved(population)
    assert lot.least <= lot.cost(population[0])[0] <= before[0]
    assert lot.cost(population[0]) < before


def test_crossover_keeps_every_piece(spark):
    lot = Lot(np.random.default_rng(3).integers(1, 2048, 500).astype("int32"), 2048, [4])
    mother, father = lot.first()[:2]
    child = lot.crossed(mother, father)
    assert (child >= 0).all() and (lot.loads(child) <= 2048).all() and (lot.loads(child) > 0).all()


def check_sequences(found, capacity):
    rows = found.collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        own.sort()
        assert [b for b, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1]
        assert sum(n for _, n in own) <= capacity
    return rows, len(by_sequence)


def test_sequences_of_edge_documents(spark, edge_docs, no_docs):
    content = tokenizer_content()
    found = sequences(edge_docs, content)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows, n = check_sequences(found, 2048)
    named = Tokenizer.from_str(content)
    expected = []
    for doc, text in edge_docs.select("doc_id", "text").collect():
        ids = [*named.encode(text or "", add_special_tokens=False).ids, 0]
        at = cut(len(ids), 2048)
        for piece, (a, b) in enumerate(zip(at, [*at[1:], len(ids)])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            expected.append((doc, piece, a, b - a, crc))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    assert n == fewest(np.array([r["length"] for r in rows]), 2048)
    assert sequences(no_docs, content).count() == 0


def test_lots_and_rounds(spark, sf_dir):
    """Many small lots: what they leave open is packed again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, n = check_sequences(sequences(docs, tokenizer_content(), lot_pieces=40), 2048)
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)
    lengths = np.array([r["length"] for r in rows])
    assert fewest(lengths, 2048) <= n <= fewest(lengths, 2048) * 1.03 + 1


def plain_negatives(rows, size=64):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by comparing every pair."""
    usable = []
    for number, (ident, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vector]
        usable.append((number, ident, str(label), q + [0] * (size - len(q))))
    by_score = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    result = []
    for number, ident, label, q in usable:
        if ident is None or ident % 100:
            continue
        scores = [
            (sum(a * b for a, b in zip(q, other)), i, n, kind) for n, i, kind, other in usable if n != number
        ]
        same = sorted((s for s in scores if s[3] == label), key=by_score)[:5]
        for score, positive, *_ in same:
            fitting = [s for s in scores if s[3] != label and 30 * score <= 100 * s[0] <= 90 * score]
            for rank, s in enumerate(sorted(fitting, key=by_score)[:10], 1):
                result.append((ident, positive, rank, s[1], score, s[0]))
    return sorted(result, key=str)


def test_negatives_are_exact(spark):
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(6, 24))
    rows = []
    for k in range(600):
        vector = (centres[k % 6] + draw.normal(size=24)).tolist()
        rows.append((k * 4, vector, (k // 3) % 4))
    first = rows[0][1]
    rows += [
        (2400, first, 0),
        (0, first, 0),
        (None, first, 1),
        (None, first, 0),
        (2501, first, None),
        (2502, None, 1),
        (2503, [*first[:5], None], 1),
        (2504, [math.nan, *first], 1),
        (2505, [math.inf], 1),
        (2600, [], 2),
        (2506, [0.0] * 24, 1),
        (2507, first[:10], 1),
        (2508, [*first, *first], 2),
        (2700, [-x for x in first], 3),
    ]
    clash = "anchor string, q string, code string, row string, score string"
    table = spark.createDataFrame(
        [(*r, *"xxxxx") for r in rows], f"vec_id long, embedding array<float>, label int, {clash}"
    )
    is_anchor = F.col("vec_id") % 100 == 0
    found = hard_negatives.hard_negatives(table.repartition(4), is_anchor)
    assert sorted(map(tuple, found.collect()), key=str) == plain_negatives(rows)
    assert hard_negatives.hard_negatives(table.limit(0), is_anchor).count() == 0
    large = table.limit(3).unionByName(table.limit(1).withColumn("embedding", F.expr("array(float(3e38))")))
    assert hard_negatives.hard_negatives(large, is_anchor).filter("positive_score > 1e15").count() == 0


def test_anchors_in_blocks(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(k, draw.normal(size=8).tolist(), k % 3) for k in range(0, 1500, 5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 4 * 64 * 8)
    found = hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect()), key=str) == plain_negatives(rows)


def test_intervals_are_certain_and_narrow():
    """No row that is asked for is dropped by its codes, and of random rows most others are."""
    draw = np.random.default_rng(8)
    q = np.floor(256 * draw.normal(scale=0.12, size=(4_000, 64))).astype("int32")
    q[:50] = 0
    rest = q @ hard_negatives.rotation(64).T
    length = np.sqrt((rest * rest).sum(axis=1))
    code, along = [], []
    for _ in range(hard_negatives.LEVELS):
        signs = rest >= 0
        along.append(np.abs(rest).sum(axis=1) / 8)
        rest = rest - np.where(signs, 1.0, -1.0) * (along[-1] / 8)[:, None]
        code.append(np.packbits(signs, axis=1, bitorder="little").view("uint64"))
    along = np.stack(along)
    left = np.sqrt(np.maximum(length * length - np.cumsum(along * along, axis=0), 0) + 1e-9 * length * length)
    rows = np.arange(4_000)
    block = hard_negatives.Block(rows, rows, np.full(4_000, "a", object), q, np.stack(code), along, left)
    for a in (0, 60, 61, 62):
        anchor = as_anchor(a, "a", q[a], [], hard_negatives.rotation(64))
        scores = q.astype("int64") @ q[a].astype("int64")
        for low in np.sort(scores)[[-1, -5, -50]]:
            kept = block.surviving(anchor, rows, [(int(low), 2**62)])
            assert set(rows[scores >= low]) <= set(kept)
        if a:
            assert len(block.surviving(anchor, rows, [(int(np.sort(scores)[-5]), 2**62)])) < 1_000
