"""Ranked lexical search by MaxScore with bounds of term pairs.

The documents become an index of shards, one row each, of at most SHARD_POSTINGS postings or one document. A shard holds, for
every term of the queries, the list of its documents with their gains and the largest gain; and for pairs of terms that queries
ask for together the intersection of their lists, the largest joint impact and the k-th largest one. A query's terms are paired
by rising weight, so that pairs are what MaxScore would leave out first.

A document that has no other terms of a pair than these two gains ``max(U_a, U_b, J_ab)`` from it, U being the largest impact
of a term and J that of the pair, and not ``U_a + U_b``. Units (pairs) are sorted by that bound; as long as the bounds of the
lowest add up to less than the k-th best score so far, documents that have these alone are never looked at. The others are
scored from the remaining units, and then gain from the optional ones in turn, the largest first; a document that
cannot reach the bar any more is dropped, where its bound for a pair is J inside the intersection list and max(U_a, U_b)
outside of it. All of this is exact: the bar is a score that k documents have, and what reaches it is kept.

Shards are searched in two waves. The first takes one shard in WAVES and gives every query its bar, so that the tasks of the
second pass on little. Queries come in blocks of at most BLOCK_BYTES of terms; documents are read once per block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.llm.best import NO_ID, Best, first_rows, known
from foldboard.llm.common import UPPER, col, table
from foldboard.llm.decontamination import term_array
from foldboard.scratch import scratch_path, written

SHARD_POSTINGS = 500_000
BLOCK_BYTES = 8 << 20
WAVES = 16
#: Upper case to lower case; what is neither a letter, a digit nor beyond ASCII becomes a blank.
_FOLDED = bytes(
    b + 32 if chr(b) in UPPER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
_LISTS = ("docs", "terms", "starts", "places", "gains", "most", "kth")
_PAIRS = ("pairs", "pair_starts", "pair_places", "pair_most", "pair_kth")


@dataclass(frozen=True)
class Queries:
    """A block of queries: terms by number, and the pairs that are asked for."""

    items: list[int]
    terms: dict[bytes, int]
    by_item: list[list[int]]


@dataclass(frozen=True)
class Asked:
    """Queries with the weights of their terms. ``units`` has a row (a, b, pair) for each pair of an item, b and pair -1 for a single term."""

    items: list[int]
    weights: np.ndarray
    pairs: np.ndarray
    units: list[np.ndarray]


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, all their terms, and documents by term."""

    documents: int
    tokens: int
    frequencies: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array(
            [math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(df) + 1))) for df in self.frequencies],
            "int64",
        )


def query_blocks(items: DataFrame) -> Iterator[Queries]:
    """``items`` (item, terms) in blocks of at most about BLOCK_BYTES."""
    size = F.octet_length(F.concat_ws(" ", "terms")) + 64 * F.size("terms") + 64
    total = items.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    blocks = total // BLOCK_BYTES + 1
    for number in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).orderBy("item").collect()
        terms: dict[bytes, int] = {}
        by_item = [[terms.setdefault(t.encode(), len(terms)) for t in r["terms"]] for r in rows]
        if rows:
            yield Queries([r["item"] for r in rows], terms, by_item)


def forward(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of every document with a term; of its terms those that queries have, by number."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            ids, sizes, numbers, counts, ends = [], [], [], [], [0]
            texts = batch.column("text").cast(pa.binary())
            for ident, text in zip(batch.column("id").fill_null(NO_ID), texts):
                words = (text.as_py() or b"").translate(_FOLDED).split()
                if not words:
                    continue
                found = Counter(map(get, words))
                found.pop(None, None)
                ids.append(ident)
                sizes.append(len(words))
                numbers.extend(found)
                counts.extend(found.values())
                ends.append(len(numbers))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (numbers, counts)]
            fields = [pa.array([i.as_py() for i in ids], pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*fields, *lists], names=["id", "n", "terms", "counts"])

    schema = "id long, n long, terms array<int>, counts array<int>"
    return written(docs.select("id", "text").mapInArrow(count, schema), "forward")


def statistics(rows: DataFrame, width: int) -> Statistics:
    """Counted in arrays, so that a task passes on one row per term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width + 2, "int64")
        for batch in batches:
            if batch.num_rows:
                sums[:width] += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
                sums[width:] += [batch.num_rows, batch.column("n").to_numpy().sum()]
        there = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["term", "n"])

    counted = rows.select("n", "terms").mapInArrow(count, "term long, n long")
    sums = np.zeros(width + 2, "int64")
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        sums[row["term"]] = row["n"]
    return Statistics(int(sums[width]), int(sums[width + 1]), sums[:width])


def paired(queries: Queries, weights: np.ndarray) -> Asked:
    """Neighbours by rising weight become pairs; of an odd number the heaviest term stays alone."""
    pairs: dict[tuple[int, int], int] = {}
    units = []
    for terms in queries.by_item:
        order = sorted(terms, key=lambda t: (weights[t], t))
        own = [
            (a, b, pairs.setdefault((min(a, b), max(a, b)), len(pairs)))
            for a, b in list(pairwise(order))[::2]
        ]
        if len(order) % 2:
            own.append((order[-1], -1, -1))
        units.append(np.array(own, "int64").reshape(-1, 3))
    return Asked(queries.items, weights, np.array(list(pairs), "int64").reshape(-1, 2), units)


def lookup(places: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``values`` at the rising ``places`` that are ``wanted``, 0 elsewhere."""
    if not len(places):
        return np.zeros(len(wanted), "int64")
    at = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
    return np.where(places[at] == wanted, values[at], 0)


def kth_largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[-k]) if len(values) >= k else 0


def shard(
    ids: np.ndarray,
    sizes: np.ndarray,
    lengths: np.ndarray,
    terms: np.ndarray,
    counts: np.ndarray,
    stats: Statistics,
    asked: Asked,
    k: int,
) -> list[bytes]:
    """Lists of terms and pairs of some documents, in the order of _LISTS and _PAIRS."""
    m = 50 + 50 * sizes * stats.documents // stats.tokens
    tf = counts.astype("int64")
    places = np.repeat(np.arange(len(ids), dtype="int32"), lengths)
    gains = (1_000_000_000 * tf // (1000 * tf + 20 * m[places])).astype("int32")
    order = np.argsort(terms, kind="stable")
    terms, places, gains = terms[order], places[order], gains[order]
    there, starts = np.unique(terms, return_index=True)
    starts = np.append(starts, len(terms)).astype("int64")
    spans = [slice(a, b) for a, b in pairwise(starts)]
    most = [int(gains[s].max()) for s in spans]
    kth = [kth_largest(gains[s], k) for s in spans]

    at = dict(zip(there.tolist(), spans))
    numbers, both, tops, kths = [], [], [], []
    for number, (a, b) in enumerate(asked.pairs.tolist()):
        if a in at and b in at:
            short, long = sorted((a, b), key=lambda t: at[t].stop - at[t].start)
            own = places[at[short]]
            other = lookup(places[at[long]], gains[at[long]], own)
            inside = other > 0
            if inside.any():
                joint = asked.weights[short] * gains[at[short]][inside] + asked.weights[long] * other[inside]
                numbers.append(number)
                both.append(own[inside])
                tops.append(int(joint.max()))
                kths.append(kth_largest(joint, k))
    pair_starts = np.cumsum([0, *map(len, both)])
    parts = [ids, there.astype("int64"), starts, places, gains, np.array(most, "int64"), np.array(kth, "int64")]
    parts += [np.array(numbers, "int64"), pair_starts.astype("int64")]
    parts += [np.concatenate([np.zeros(0, "int32"), *both]), np.array(tops, "int64"), np.array(kths, "int64")]
    return [p.tobytes() for p in parts]


def index(rows: DataFrame, stats: Statistics, asked: Asked, k: int, postings: int) -> str:
    """Path of the index, parted by the wave in which a shard is searched."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((stats, asked))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            ends = batch.column("terms").offsets.to_numpy()
            terms = batch.column("terms").flatten().to_numpy()
            counts = batch.column("counts").flatten().to_numpy()
            ends = ends - ends[0]
            begin = 0
            while begin < len(ids):
                end = int(np.searchsorted(ends, ends[begin] + postings, "right")) - 1
                end = min(max(end, begin + 1), len(ids))
                inside = slice(ends[begin], ends[end])
                lengths = np.diff(ends[begin : end + 1])
                parts = shard(ids[begin:end], sizes[begin:end], lengths, terms[inside], counts[inside], *shared.value, k)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=names)
                begin = end

    names = [*_LISTS, *_PAIRS]
    shards = rows.filter(F.size("terms") > 0).mapInArrow(build, ", ".join(f"{n} binary" for n in names))
    first = F.pmod(F.xxhash64("docs", "starts"), F.lit(WAVES)) == 0
    path = scratch_path(spark, "index")
    shards.withColumn("wave", F.when(first, 0).otherwise(1)).write.partitionBy("wave").parquet(path)
    return path


class Shard:
    """One row of the index, ready for queries; impacts are gains times weights."""

    def __init__(self, row: dict[str, bytes], asked: Asked):
        kinds = {n: "int32" for n in ("places", "gains", "pair_places")}
        part = {n: np.frombuffer(row[n], kinds.get(n, "int64")) for n in (*_LISTS, *_PAIRS)}
        self.ids, self.weights = part["docs"], asked.weights
        self.places, self.gains, self.starts = part["places"], part["gains"], part["starts"]
        # By term, and one more place for "no term", which has no documents.
        self.at = np.full(len(asked.weights) + 1, -1)
        self.at[part["terms"]] = np.arange(len(part["terms"]))
        self.most, self.kth = np.zeros((2, len(asked.weights) + 1), "int64")
        self.most[part["terms"]] = part["most"] * asked.weights[part["terms"]]
        self.kth[part["terms"]] = part["kth"] * asked.weights[part["terms"]]
        self.pair_places, self.pair_starts = part["pair_places"], part["pair_starts"]
        self.pair_at = np.full(len(asked.pairs) + 1, -1)
        self.pair_at[part["pairs"]] = np.arange(len(part["pairs"]))
        self.pair_most, self.pair_kth = np.zeros((2, len(asked.pairs) + 1), "int64")
        self.pair_most[part["pairs"]] = part["pair_most"]
        self.pair_kth[part["pairs"]] = part["pair_kth"]

    def impacts(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[term]
        if at < 0:
            return self.places[:0], self.gains[:0].astype("int64")
        own = slice(self.starts[at], self.starts[at + 1])
        return self.places[own], self.gains[own] * self.weights[term]

    def intersection(self, pair: int) -> np.ndarray:
        at = self.pair_at[pair]
        return self.pair_places[self.pair_starts[at] : self.pair_starts[at + 1]] if at >= 0 else self.pair_places[:0]

    def search(self, units: np.ndarray, best: Best) -> None:
        """Add the documents of this shard that are among the best of a query."""
        a, b, pair = units.T
        single = np.maximum(self.most[a], self.most[b])
        bounds = np.maximum(single, self.pair_most[pair])
        order = np.argsort(bounds, kind="stable")
        units, single, bounds = units[order], single[order], bounds[order]
        reach = np.cumsum(bounds)
        bar = max(best.bar, 1, int(np.max([self.kth[a], self.kth[b], self.pair_kth[pair]], initial=0)))
        optional = int(np.searchsorted(reach, bar, "left"))
        if optional == len(units):
            return
        total = np.zeros(len(self.ids), "int64")
        for first, second, _ in units[optional:].tolist():
            for term in (first, second):
                places, impacts = self.impacts(term)
                total[places] += impacts
        docs = np.nonzero(total)[0]
        scores = total[docs]
        for unit in range(optional - 1, -1, -1):
            bar = max(bar, kth_largest(scores, best.k))
            keep = scores + reach[unit] >= bar
            docs, scores = docs[keep], scores[keep]
            first, second, both = units[unit].tolist()
            if bounds[unit] > single[unit]:
                inside = self.intersection(both)
                joint = lookup(inside, np.ones(len(inside), "int64"), docs) > 0
                rest = reach[unit] - bounds[unit]
                keep = scores + rest + np.where(joint, bounds[unit], single[unit]) >= bar
                docs, scores = docs[keep], scores[keep]
            if not len(docs):
                return
            for term in (first, second):
                scores = scores + lookup(*self.impacts(term), docs)
        keep = scores >= bar
        best.add(scores[keep], self.ids[docs[keep]], np.zeros(int(keep.sum()), "int64"))


def search(spark: SparkSession, path: str, wave: int, asked: Asked, bars: dict[int, int], k: int) -> DataFrame:
    """(item, id, row, score): what each task of a wave found best."""
    shared = spark.sparkContext.broadcast((asked, bars))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, bars = shared.value
        best = [Best(k, bars.get(item, 1)) for item in asked.items]
        for batch in batches:
            for row in batch.to_pylist():
                own = Shard(row, asked)
                for units, one in zip(asked.units, best):
                    if len(units):
                        own.search(units, one)
        for item, one in zip(asked.items, best):
            if len(one.found):
                score, ident, row = one.found.T
                columns = np.full(len(row), item), ident, row, score
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["item", "id", "row", "score"]
    shards = spark.read.schema(", ".join(f"{n} binary" for n in (*_LISTS, *_PAIRS)) + ", wave int").parquet(path)
    own = shards.filter(F.col("wave") == wave).drop("wave")
    return own.mapInArrow(find, ", ".join(f"{n} long" for n in names))


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """The ``k`` highest-scoring documents of every query: item_id, rank (from 1), doc_id, score.

    Missing and empty texts have no terms: such documents are found by no query and count nowhere, such queries find nothing; so do
    queries on an empty table. Texts are read whole, however long. Equal scores go by rising id, missing ids last. Repeated
    documents are documents of their own, repeated queries each have their result. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = written(
        queries.select(
            F.monotonically_increasing_id().alias("item"),
            col(item_col).alias("item_id"),
            F.array_distinct(term_array(F.coalesce(col(item_text_col), F.lit("")))).alias("terms"),
        ),
        "queries",
    )
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    found = []
    for block in query_blocks(items.select("item", "terms").filter(F.size("terms") > 0)):
        rows = forward(texts, block.terms)
        stats = statistics(rows, len(block.terms))
        if not stats.documents:
            continue
        asked = paired(block, stats.weights())
        path = index(rows, stats, asked, k, shard_postings)
        first = written(first_rows(search(spark, path, 0, asked, {}, k), ["item"], "id", k), "first-wave")
        bars = {r["item"]: r["score"] for r in first.filter(F.col("rank") == k).collect()}
        rest = search(spark, path, 1, asked, bars, k)
        found.append(first_rows(first.drop("rank").unionByName(rest), ["item"], "id", k))
    if not found:
        nothing = "item long, id long, row long, score long, rank int"
        found = [spark.createDataFrame([], nothing)]
    return (
        reduce(DataFrame.unionByName, found)
        .join(F.broadcast(items.select("item", "item_id")), "item")
        .select("item_id", "rank", known("id").alias("doc_id"), "score")
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
texts AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
sizes AS (SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS tokens FROM texts),
asked AS (
  SELECT i, item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
postings AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM postings, sizes GROUP BY term),
impacts AS (
  SELECT r, term, doc_id,
    weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total) // tokens))) AS impact
  FROM postings JOIN weights USING (term) JOIN texts USING (r), sizes),
scores AS (
  SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY i, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) <= 50"""

QUERIES = {"op11_lexical_search": op11_lexical_search}
ORACLES = {"op11_lexical_search": SEARCH_SQL}
