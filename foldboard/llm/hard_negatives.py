"""Hard negatives by rotated one-bit codes and exact integer scores.

Components become integers, floor(256 x), and a score is an integer inner product. Every vector v is turned by one fixed random
rotation; the signs of what results are its code, a corner c of the unit cube's sphere, and the length of v along c (its
alignment) is stored with it. What the code leaves, the residual, is coded in the same way, LEVELS times in all. For an anchor
q of length one, turned alike, ``t = <c, q>`` comes from popcounts of a code with eight bit planes of q, up to the
rounding of the planes. A residual r is at right angles to the code before it, so by Cauchy and Schwarz::

    | <v, q> - sum of alignment * t over the levels so far |  <=  |r| sqrt(1 - t^2)

The interval is certain, not likely: a row outside of what is asked for is dropped without a loss, level by level, and every
other one is scored in integers. Anchors are broadcast in blocks, rows stay in their partitions; each task keeps the best few
rows per anchor, whose last score is the bar that intervals of later rows must reach, and only these few are shuffled.

One level alone leaves an interval of 0.6 lengths to either side, so wide that on vectors without much structure nearly every row
survives (97 % of the possible positives, 99 % of the possible negatives of 51,282 random ones of 64 components). After four
levels it is 0.17 lengths, and 5 % and 9 % survive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldboard.llm.best import ANY_SCORE, NO_ID, Best, first_rows, known
from foldboard.llm.common import col, table
from foldboard.scratch import written

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Beyond this size of a scaled component sums of products could leave 64 bits.
LARGEST = 1 << 24
#: Bits by which an anchor's turned components are rounded for the popcounts.
PLANES = 8
#: How often what a code leaves is coded again.
LEVELS = 4
#: What one block of anchors holds in bytes of its vectors.
BLOCK_BYTES = 8 << 20
KEYS = ["anchor", "pos"]
_BEST = ("anchor", "pos", "row", "id", "score")


def scaled(embedding: Column) -> Column:
    """The integer components, NULL for vectors that cannot be scored: missing, not finite or too large in a component."""
    numbers = F.transform(embedding, lambda x: x.cast("double") * SCALE)
    usable = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return F.when(usable, F.transform(numbers, lambda x: F.floor(x).cast("int")))


def rotation(size: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same for equal arguments."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def codes(
    vectors: DataFrame, id_col: str, label: Column, embedding_col: str, anchor: Column, levels: int = LEVELS
) -> tuple[DataFrame, int]:
    """Rows that take part, with row number, scaled vector, codes, alignments and length; and the common size of the vectors.

    The size is a multiple of 64; shorter vectors count as filled up with zeros.
    """
    rows = written(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            col(id_col).cast("long").alias("id"),
            label.cast("string").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
            scaled(col(embedding_col)).alias("q"),
        ).filter("label IS NOT NULL AND q IS NOT NULL"),
        "vectors",
    )
    longest = rows.agg(F.max(F.size("q"))).first()[0] or 0
    size = max(64, -(-longest // 64) * 64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(size)
        for batch in batches:
            lists = batch.column("q")
            lengths = np.diff(lists.offsets.to_numpy())
            q = np.zeros((batch.num_rows, size), "int32")
            q[np.arange(size) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            rest, code, along = q @ turn.T, [], []
            length = np.sqrt((rest * rest).sum(axis=1))
            for _ in range(levels):
                signs = rest >= 0
                along.append(np.abs(rest).sum(axis=1) / np.sqrt(size))
                rest = rest - np.where(signs, 1.0, -1.0) * (along[-1] / np.sqrt(size))[:, None]
                code.append(np.packbits(signs, axis=1, bitorder="little"))
            matrices = q, np.concatenate(code, axis=1), np.stack(along, axis=1)
            columns = [batch.column(n) for n in ("row", "id", "label", "anchor")]
            columns += [pa.array([x.tobytes() for x in m], pa.binary()) for m in matrices]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(length)], names=names)

    names = ["row", "id", "label", "anchor", "q", "code", "along", "length"]
    schema = (
        "row long, id long, label string, anchor boolean, q binary, code binary, along binary, length double"
    )
    return written(rows.mapInArrow(encode, schema), "codes"), size


@dataclass
class Anchor:
    """One query vector, ready for popcounts."""

    row: int
    label: str
    q: np.ndarray
    length: float
    low: float
    step: float
    error: float
    planes: np.ndarray
    # Of each positive: its number, the least and the greatest score of its negatives.
    ranges: list[tuple[int, int, int]]


def as_anchor(row: int, label: str, q: np.ndarray, ranges: list, turn: np.ndarray) -> Anchor:
    turned = turn @ q
    length = float(np.sqrt(turned @ turned))
    unit = turned / length if length else turned
    low, high = unit.min(), unit.max()
    step = (high - low) / (2**PLANES - 1) or 1.0
    levels = np.round((unit - low) / step).astype("uint16")
    error = float(np.linalg.norm(unit - (low + step * levels))) + 1e-9
    bits = (levels[None, :] >> np.arange(PLANES, dtype="uint16")[:, None]) & 1
    planes = np.packbits(bits.astype("uint8"), axis=1, bitorder="little").view("uint64")
    return Anchor(row, label, q.astype("int64"), length, float(low), float(step), error, planes, ranges)


@dataclass
class Block:
    """Vectors of one Arrow batch; codes by level and row, in 64-bit words."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    code: np.ndarray
    along: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Block:
        n = batch.num_rows
        matrix = lambda name, kind: np.frombuffer(
            b"".join(batch.column(name).to_pylist()), kind
        ).reshape(n, -1)
        along = matrix("along", "float64").T
        length = batch.column("length").to_numpy(zero_copy_only=False)
        left = length * length - np.cumsum(along * along, axis=0)
        return cls(
            batch.column("row").to_numpy(zero_copy_only=False),
            batch.column("id").fill_null(NO_ID).to_numpy(),
            np.array(batch.column("label").to_pylist(), dtype=object),
            matrix("q", "int32"),
            matrix("code", "uint64").reshape(n, len(along), -1).transpose(1, 0, 2),
            along,
            # Rounding of the differences must not make an interval too narrow.
            np.sqrt(np.maximum(left, 0) + 1e-9 * length * length),
        )

    def surviving(self, anchor: Anchor, of: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
        """Those of the rows ``of`` whose score with the anchor may lie within one of ``bounds``."""
        size = self.q.shape[1]
        estimate, error = np.zeros(len(of)), np.zeros(len(of))
        for code, along, rest in zip(self.code, self.along, self.rest):
            words = code[of]
            inside, total = np.zeros(len(of), "int64"), 0
            for bit, plane in enumerate(anchor.planes):
                inside += np.bitwise_count(words & plane).sum(axis=1, dtype="int64") << bit
                total += int(np.bitwise_count(plane).sum()) << bit
            ones = np.bitwise_count(words).sum(axis=1, dtype="int64")
            # Signs are 2 bit - 1, so sums over signs are twice the sum over set bits less that over all.
            t = (anchor.low * (2 * ones - size) + anchor.step * (2 * inside - total)) / np.sqrt(size)
            estimate = estimate + along[of] * t
            error = error + along[of] * anchor.error
            least = np.clip(np.abs(t) - anchor.error, 0, 1)
            reach = (error + rest[of] * np.sqrt(1 - least * least)) * anchor.length + 0.5
            lower, upper = estimate * anchor.length - reach, estimate * anchor.length + reach
            keep = np.zeros(len(of), bool)
            for low, high in bounds:
                keep |= (upper >= low) & (lower <= high)
            of, estimate, error = of[keep], estimate[keep], error[keep]
        return of


def add_positives(block: Block, anchor: Anchor, best: list[Best]) -> None:
    of = np.nonzero((block.labels == anchor.label) & (block.rows != anchor.row))[0]
    of = block.surviving(anchor, of, [(best[0].bar, ANY_SCORE)])
    best[0].add(block.q[of] @ anchor.q, block.ids[of], block.rows[of])


def add_negatives(block: Block, anchor: Anchor, best: list[Best]) -> None:
    bounds = [(max(least, one.bar), most) for (_, least, most), one in zip(anchor.ranges, best)]
    of = block.surviving(anchor, np.nonzero(block.labels != anchor.label)[0], bounds)
    scores = block.q[of] @ anchor.q
    for (least, most), one in zip(bounds, best):
        inside = (scores >= least) & (scores <= most)
        if inside.any():
            one.add(scores[inside], block.ids[of][inside], block.rows[of][inside])


def best_rows(
    coded: DataFrame, anchors: list[Anchor], k: int, add: Callable[[Block, Anchor, list[Best]], None]
) -> DataFrame:
    """(anchor, pos, row, id, score): per anchor and positive (0 if there are none yet) the best ``k`` rows of each task."""
    shared = coded.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = [[Best(k) for _ in (a.ranges or [0])] for a in asked]
        for batch in batches:
            if not batch.num_rows:
                continue
            block = Block.of(batch)
            for anchor, found in zip(asked, best):
                add(block, anchor, found)
        for anchor, found in zip(asked, best):
            for (number, *_), one in zip(anchor.ranges or [(0,)], found):
                if len(one.found):
                    score, ident, row = one.found.T
                    n = len(row)
                    columns = [np.full(n, anchor.row), np.full(n, number), row, ident, score]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_BEST)

    fields = coded.select("row", "id", "label", "q", "code", "along", "length")
    return fields.mapInArrow(search, ", ".join(f"{n} long" for n in _BEST))


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    id_col: str = "vec_id",
    label: Column | None = None,
    embedding_col: str = "embedding",
) -> DataFrame:
    """Per anchor row and each of its ``positives`` best rows of its label, the best ``negatives`` rows of other labels.

    ``anchor`` says which rows of ``vectors`` are anchors, ``label`` (the column label by default) what they are. A negative
    scores from ``least_percent`` to ``most_percent`` of its positive. Returns anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score.

    Rows without label or vector, with a component that is missing, not finite or beyond 2^24 after scaling take no part. Shorter
    vectors, the empty one too, count as filled up with zeros; there is no upper limit of their size but memory for one square
    matrix. A missing id is the largest of all ties. Ties of score go to the smaller id. Repeated rows are rows of their
    own: a copy of an anchor is one of its positives, and two equal anchors each have their result. Anchors without positives
    or negatives have no rows, so an empty table gives none. Other columns, whatever their names, are ignored.
    """
    spark = vectors.sparkSession
    coded, size = codes(vectors, id_col, F.col("label") if label is None else label, embedding_col, anchor)
    asked = coded.filter("anchor").select("row", "id", "label", "q")
    blocks = asked.count() * size * 8 // BLOCK_BYTES + 1
    part = F.pmod(F.xxhash64("row"), F.lit(blocks))
    turn = rotation(size)
    parts = []
    for number in range(blocks):
        own = [
            (r["row"], r["label"], np.frombuffer(r["q"], "int32"))
            for r in asked.filter(part == number).collect()
        ]
        near = best_rows(coded, [as_anchor(*a, [], turn) for a in own], positives, add_positives)
        near = written(first_rows(near, KEYS, "row", positives), "positives")
        ranges: dict[int, list[tuple[int, int, int]]] = {}
        for r in near.collect():
            least, most = -(-least_percent * r["score"] // 100), most_percent * r["score"] // 100
            if least <= most:
                ranges.setdefault(r["anchor"], []).append((r["rank"], least, most))
        far = best_rows(
            coded,
            [as_anchor(*a, ranges[a[0]], turn) for a in own if a[0] in ranges],
            negatives,
            add_negatives,
        )
        parts.append((near, written(first_rows(far, KEYS, "row", negatives), "negatives")))
    result = None
    for near, far in parts:
        positive = near.select(
            "anchor",
            F.col("rank").cast("long").alias("pos"),
            F.col("id").alias("positive"),
            F.col("score").alias("positive_score"),
        )
        joined = far.join(positive, KEYS)
        result = joined if result is None else result.unionByName(joined)
    own_id = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return result.join(own_id, "anchor").select(
        "anchor_id",
        known("positive").alias("positive_id"),
        "rank",
        known("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=label)


HARD_NEGATIVES_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, v.r, v.vec_id, a.label = v.label AS same,
    CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
  FROM vectors a JOIN vectors v ON a.r <> v.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, r AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM scored JOIN positives USING (anchor)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, r) <= 10"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLES = {"op13_hard_negatives": HARD_NEGATIVES_SQL}
