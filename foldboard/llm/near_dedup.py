"""Near duplicates by BagMinHash signatures, banding and exact multiset overlap.

A text is the multiset of its five-word shingles; similarity is weighted Jaccard, the sum of smaller over the sum of larger
counts. Counts are cut into dyadic levels (0, 1], (1, 2], (2, 4], ... and each (shingle, level) is a Poisson process
whose rate is the width of the level. A point has a time, a register and, in a level that a count reaches only in part,
a height that must lie below the count. A register keeps its earliest time, so two texts agree in a register with the
probability of their weighted Jaccard similarity. Only the earliest points are ever made: about registers * ln(registers)
per text.

Signatures are cut into bands; texts that share a band are candidates. Within a band everything is compared with two
leaders, not all with all: with the text that shares most bands, which joins nearly everything that belongs together,
and with another one. What then still lies in different classes of a band is compared pair by pair, so no link between
different texts is lost to the choice of a leader. Before that a prefix filter drops pairs that cannot reach the threshold: of two
similar multisets some element must lie among the rarest few of both. Any order of elements makes that exact; a sketch
of fixed size says which are rare. A pair is linked only if the exact similarity of the two whole texts reaches the threshold.
Exact copies are one text from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.llm.common import col, lower_bytes, table
from foldboard.scratch import gathered, written

SHINGLE = 5
THRESHOLD = 0.8
#: A pair at the threshold shares none of 30 bands of 5 with a probability below 1e-5.
BANDS, BAND_ROWS = 30, 5
REGISTERS = BANDS * BAND_ROWS
LEADERS = 2
#: Bits of a shingle that choose its counter in the sketch of frequencies.
SKETCH_BITS = 16
#: Keys of 16 bytes that may be broadcast; more of them are joined by shuffle.
BROADCAST_KEYS = 2_000_000

_ODD = (np.random.default_rng(11).integers(0, 1 << 63, 16, dtype="uint64") << np.uint64(1)) | np.uint64(1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_HASHES: dict[bytes, int] = {}
MAX_HASHES = 150_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixture of 64-bit numbers (the finisher of splitmix64)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shares(x: np.ndarray) -> np.ndarray:
    """Numbers evenly spread in (0, 1]."""
    return ((x >> np.uint64(11)).astype("float64") + 1) / float(1 << 53)


def _word_hash(word: bytes) -> int:
    if len(_HASHES) >= MAX_HASHES:
        _HASHES.clear()
    value = _HASHES[word] = xxhash.xxh64_intdigest(word) | 1
    return value


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their counts; a text of fewer words is one shingle, one without words has none."""
    words = lower_bytes(text).split()
    if not words:
        return np.zeros(0, "uint64"), np.zeros(0, "int64")
    get = _HASHES.get
    hashes = np.array([get(w) or _word_hash(w) for w in words], "uint64")
    width = min(SHINGLE, len(words))
    last = len(words) - width + 1
    sums = np.full(last, np.uint64(width))
    for place in range(width):
        sums = sums + hashes[place : place + last] * _ODD[place]
    return np.unique(mixed(sums), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; 0 with an empty one."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    common = np.where(a[0][at] == b[0], np.minimum(a[1][at], b[1]), 0).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def signature(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Earliest time per register, for a multiset that is not empty."""
    horizon = (np.log(REGISTERS) + 3) * REGISTERS / counts.sum()
    while True:
        times = np.full(REGISTERS, np.inf)
        level, low, high = 0, 0, 1
        while True:
            there = counts > low
            if not there.any():
                break
            _level_points(times, keys[there], counts[there], level, low, high, horizon)
            level, low, high = level + 1, high, high * 2
        if times.max() <= horizon:
            return times
        horizon *= 2


def _level_points(
    times: np.ndarray,
    keys: np.ndarray,
    counts: np.ndarray,
    level: int,
    low: int,
    high: int,
    horizon: float,
) -> None:
    """Enter the points up to ``horizon`` of one level into ``times``."""
    rate = high - low
    seeds = mixed(keys ^ mixed(np.full(1, level, "uint64")))
    partial = counts < high
    begun, place = np.zeros(len(seeds)), 0
    while len(seeds):
        expected = rate * horizon
        width = min(4096, int(expected + 2 * np.sqrt(expected)) + 1)
        number = np.arange(place + 1, place + width + 1, dtype="uint64") * _GOLDEN
        points = mixed(seeds[:, None] + number[None, :])
        steps = -np.log(shares(points)) / rate
        # Sums run from left to right, so a point has the same time in every text.
        steps[:, 0] += begun
        at = np.cumsum(steps, axis=1)
        valid = at <= horizon
        if partial.any():
            heights = low + rate * shares(mixed(points ^ _ODD[7]))
            valid &= (heights <= counts[:, None]) | ~partial[:, None]
        register = (mixed(points[valid]) >> np.uint64(33)) % np.uint64(REGISTERS)
        np.minimum.at(times, register.astype("int64"), at[valid])
        on = at[:, -1] <= horizon
        seeds, begun, counts, partial = seeds[on], at[on, -1], counts[on], partial[on]
        place += width


def bands(times: np.ndarray) -> np.ndarray:
    """One 64-bit number per band."""
    rows = times.view("uint64").reshape(BANDS, BAND_ROWS)
    sums = (mixed(rows) * _ODD[None, :BAND_ROWS]).sum(axis=1, dtype="uint64")
    return mixed(sums + np.arange(BANDS, dtype="uint64") * _ODD[9]).view("int64")


def signed(texts: DataFrame) -> DataFrame:
    """(key, weight, bands) of every distinct text with words, from (key, text)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Copies in a batch are signed once.
            rows = []
            for key, text in batch.drop_duplicates("key").itertuples(index=False):
                keys, counts = shingles(text)
                if len(keys):
                    rows.append((key, int(counts.sum()), bands(signature(keys, counts))))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "weight", "bands"])

    made = texts.mapInPandas(sign, "key binary, weight long, bands array<long>")
    return made.groupBy("key").agg(F.first("weight").alias("weight"), F.first("bands").alias("bands"))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b), the classes of those ``pairs`` (a, b, class_a, class_b) whose ``texts`` (key, text) are similar enough."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, tuple] = {}
        for batch in batches:
            linked = []
            for b, text_a, text_b in batch[["b", "text_a", "text_b"]].itertuples(index=False):
                if b not in held:
                    # The sides that many are compared with come in runs.
                    if len(held) >= 64:
                        held.clear()
                    held[b] = shingles(text_b)
                linked.append(similarity(shingles(text_a), held[b]) >= threshold)
            if any(linked):
                yield batch.loc[linked, ["class_a", "class_b"]].set_axis(["a", "b"], axis=1)

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select(
        "b", "class_a", "class_b", "text_a", "text_b"
    )
    return rows.mapInPandas(compare, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the links (a, b); the root is the smallest node that can be reached.

    Each step takes the smallest root among the neighbours and then the root of that root, so chains shorten by half.
    """
    n_links = links.count()

    def near_by(df: DataFrame) -> DataFrame:
        return gathered(df, 2 * n_links)

    ways = [F.struct(F.col(a).alias("node"), F.col(b).alias("other")) for a, b in ("ab", "ba")]
    both = near_by(written(links.select(F.inline(F.array(*ways))), "links"))
    roots = both.groupBy("node").agg(F.min("other").alias("near"))
    roots = near_by(written(roots.select("node", F.least("node", "near").alias("root")), "roots"))
    while True:
        near = (
            both.join(roots.toDF("other", "root"), "other")
            .groupBy("node")
            .agg(F.min("root").alias("near"))
        )
        lower = roots.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("up")
        )
        following = roots.toDF("up", "top")
        moved = written(
            lower.join(following, "up").select("node", "old", F.least("up", "top").alias("root")),
            "roots",
        )
        roots = near_by(moved.select("node", "root"))
        if moved.filter(F.col("old") != F.col("root")).isEmpty():
            return roots


def _similar_weight(a: str, b: str, threshold: float) -> Column:
    """The smaller multiset cannot be below the threshold times the larger one."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def text_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, class) of every text that is linked to another one, from (key, text)."""
    signatures = written(signed(docs), "signatures")
    rows = signatures.select("key", "weight", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    sharing = written(rows.join(shared, "band"), "sharing")
    wanted = written(sharing.groupBy("key").agg(F.sum("n").alias("central")), "candidates")
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    members = written(sharing.drop("n").join(wanted, "key"), "members")
    # Copies are combined before the shuffle.
    texts = docs.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    texts = written(texts, "candidate-texts")
    pairs = written(_led(members, threshold), "pairs")
    links = written(verified(pairs, texts, threshold), "verified")
    classes = written(components(links).toDF("key", "class"), "classes")
    placed = members.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key"))
    pairs = written(_rest(placed, texts, threshold), "pairs")
    links = written(verified(pairs, texts, threshold), "verified")
    found = components(links)
    # A root may itself belong to another class now; texts first linked in the second turn are new.
    moved = (
        classes.join(found.toDF("class", "root"), "class", "left")
        .select("key", F.coalesce("root", "class").alias("class"))
    )
    new = found.toDF("key", "class").join(classes.select("key"), "key", "left_anti")
    return written(moved.unionByName(new), "classes")


def _led(members: DataFrame, threshold: float) -> DataFrame:
    """Every member of a band with each of its leaders; as yet a text is a class of its own."""
    orders = [-F.col("central"), *(F.xxhash64(F.lit(n), "key") for n in range(1, LEADERS))]
    leads = [F.min(F.struct(order.alias("_order"), "key", "weight")) for order in orders]
    leaders = members.groupBy("band").agg(
        *[lead.alias(f"lead_{n}") for n, lead in enumerate(leads)]
    )
    named = [
        F.struct(F.col(f"lead_{n}.key").alias("b"), F.col(f"lead_{n}.weight").alias("weight_b"))
        for n in range(LEADERS)
    ]
    # A leader by both orders is one.
    leaders = leaders.select(
        "band", F.col("lead_0.key").alias("first"), F.inline(F.array_distinct(F.array(*named)))
    )
    return (
        members.join(leaders, "band")
        # The other leaders are compared with the first one, not that one with them again.
        .filter((F.col("key") != F.col("first")) & (F.col("key") != F.col("b")))
        .filter(_similar_weight("weight", "weight_b", threshold))
        .select(F.col("key").alias("a"), "b")
        .distinct()
        .withColumns({"class_a": F.col("a"), "class_b": F.col("b")})
    )


def _rest(placed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a band that the leaders have left in different classes and that the prefix filter lets through."""
    mixed_bands = (
        placed.groupBy("band")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .filter("low <> high")
        .select("band")
    )
    open_rows = placed.join(mixed_bands, "band").select("band", "key", "class", "weight")
    left = written(open_rows.join(_prefixes(texts, threshold), "key"), "open")
    right = left.select(
        F.col("band").alias("band_b"),
        F.col("key").alias("b"),
        F.col("class").alias("class_b"),
        F.col("weight").alias("weight_b"),
        F.col("prefix").alias("prefix_b"),
    )
    # Of weights m and n in common: at least this many, if the pair is similar enough.
    together = F.col("weight") + F.col("weight_b")
    common = F.ceil(together * (threshold / (1 + threshold)) - 1e-6).cast("int")

    def rarest(prefix: str, weight: str) -> Column:
        length = F.greatest(F.col(weight).cast("int") - common + 1, F.lit(0))
        return F.slice(prefix, F.lit(1), length)

    condition = (
        (F.col("band") == F.col("band_b"))
        & (F.col("class") < F.col("class_b"))
        & _similar_weight("weight", "weight_b", threshold)
        & F.arrays_overlap(rarest("prefix", "weight"), rarest("prefix_b", "weight_b"))
    )
    return (
        left.join(right, condition)
        .select(F.col("key").alias("a"), "b", F.col("class").alias("class_a"), "class_b")
        .distinct()
    )


def _prefixes(texts: DataFrame, threshold: float) -> DataFrame:
    """(key, prefix): the elements of each text in a common order, rare ones first, as many as the filter may need.

    An element is a shingle and the number of its occurrence, so that multisets are compared like sets.
    """
    slots = 1 << SKETCH_BITS
    shift = np.uint64(64 - SKETCH_BITS)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(slots, "int64")
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount((shingles(text)[0] >> shift).astype("int64"), minlength=slots)
        slot = np.flatnonzero(total)
        yield pd.DataFrame({"slot": slot, "n": total[slot]})

    counted = (
        texts.select("text")
        .mapInPandas(count, "slot long, n long")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    sketch = np.zeros(slots, "int64")
    sketch[counted["slot"].to_numpy("int64")] = counted["n"].to_numpy("int64")
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                keys, counts = shingles(text)
                each = np.repeat(keys, counts)
                begun = np.repeat(np.cumsum(counts) - counts, counts)
                occurrence = (np.arange(len(each)) - begun).astype("uint64")
                elements = mixed(each + occurrence * _ODD[11])
                # Overlap is at least the threshold times the weight of either side.
                length = len(each) - int(np.ceil(threshold * len(each) - 1e-6)) + 1
                order = np.lexsort((elements, shared.value[(each >> shift).astype("int64")]))
                # Half of the bits will do: a chance overlap only lets a pair through that is then compared.
                rows.append((elements[order[:length]] >> np.uint64(32)).astype("uint32").view("int32"))
            yield pd.DataFrame({"key": batch["key"], "prefix": rows})

    return texts.mapInPandas(cut, "key binary, prefix array<int>")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, key of the text, class, class_id (the smallest id of the class), class_size.

    Equal texts are always in one class, empty ones too; a missing text is alone and has neither key nor class. Ids may
    be missing or repeated: every row gets its class, and class_id is the smallest known id in it. An empty table gives no
    rows; other columns are ignored.
    """
    rows = docs.select(
        col(id_col).alias("doc_id"),
        text_key(col(text_col)).alias("key"),
        col(text_col).alias("text"),
    )
    classes = text_classes(rows.filter("key IS NOT NULL").select("key", "text"), threshold)
    by_text = (
        rows.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
        .join(classes, "key", "left")
        .withColumn("class", F.coalesce("class", "key"))
    )
    by_text = written(by_text, "texts")
    by_class = by_text.groupBy("class").agg(
        F.min("low").alias("class_id"), F.sum("n").alias("class_size")
    )
    of_text = by_text.select("key", "class").join(by_class, "class")
    return (
        rows.select("doc_id", "key")
        .join(of_text, "key", "left")
        .select(
            "doc_id",
            "key",
            "class",
            F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("class_size", F.lit(1)).alias("class_size"),
        )
    )


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of every class, with all columns: the one of the smallest id, then of the smallest text key.

    Rows without text all stay.
    """
    found = written(near_duplicates(docs, threshold), "near-duplicates")
    entry = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = (
        found.filter("key IS NOT NULL")
        .groupBy("class")
        .agg(F.min(entry).alias("first"))
        .select("class", "first.doc_id", "first.key")
    )
    return docs.transform(_keep, found, first)


def _keep(docs: DataFrame, found: DataFrame, first: DataFrame) -> DataFrame:
    rows = (
        found.filter("key IS NOT NULL")
        .groupBy("class", "doc_id", "key")
        .agg(F.count("*").alias("n"))
    )
    first = first.withColumn("stays", F.lit(True))
    same = reduce(
        Column.__and__, [rows[c].eqNullSafe(first[c]) for c in ("class", "doc_id", "key")]
    )
    verdicts = rows.join(first, same, "left").select(
        rows["doc_id"].alias("_id"), rows["key"].alias("_key"), rows["n"], first["stays"]
    )
    verdicts = written(verdicts.filter("stays IS NULL OR n > 1"), "verdicts")

    def among(condition: str) -> tuple[DataFrame, Column]:
        part = verdicts.filter(condition).select("_id", "_key")
        if part.count() <= BROADCAST_KEYS:
            part = F.broadcast(part)
        same = docs["doc_id"].eqNullSafe(part["_id"]) & (text_key(docs["text"]) == part["_key"])
        return part, same

    repeated, of_repeated = among("stays AND n > 1")
    touched, of_touched = among("true")
    once = docs.join(touched, of_touched, "left_anti")
    # Repeated rows of one id and text: the first of them, combined before the shuffle.
    firsts = docs.join(repeated, of_repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(firsts)


def marked(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, kept.

    ``kept`` holds for one row of every class: the one of the smallest id (a known id before a missing one), of equal ones
    the first written. Rows without text are alone and kept. It is never null, so ``filter(kept)`` removes the duplicates.
    """
    found = near_duplicates(docs, threshold).withColumn("row", F.monotonically_increasing_id())
    # Written, so that row numbers stay what they are.
    found = written(found, "near-duplicates")
    alone = F.col("key").isNull() | (F.col("class_size") == 1)
    entry = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = (
        found.filter(~alone)
        .groupBy("class")
        .agg(F.min(entry).alias("first"))
        .select("first.row", F.lit(True).alias("first"))
    )
    return found.join(first, "row", "left").select(
        "doc_id", "class_id", "class_size", F.coalesce("first", alone).alias("kept")
    )


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document, and which one of a class is kept."""
    return marked(table(spark, sf_dir, "documents"))


QUERIES = {"op1_minhash_near_dedup": op1_minhash_near_dedup}
ORACLES: dict[str, str] = {}
