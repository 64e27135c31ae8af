"""Sequences of a fixed number of tokens, packed by a grouping genetic algorithm.

Documents become token ids and one end id; longer ones are cut into full pieces and a first piece of what is left over, so only
one piece of a document is ever open. Open pieces are dealt into lots of about LOT_PIECES by a hash of their row number. In a
lot a population of packings evolves: the crossover injects whole well-filled bins of one parent into the other, the
other's bins that hold the same pieces are dissolved, and what that displaces is put back by best fit, longest first. A mutation
dissolves the worst-filled bins and some others. Every lot is evolved by several islands, each a row that any task can work on;
after an epoch the best packing of each island migrates to the next one, and lots that reached the lower bound of bins rest.

What a lot cannot fill would cost up to one sequence per lot. So bins with room for more than SPARE tokens are opened
again and their pieces dealt into the lots of a next round, as long as rounds leave at most three quarters of the pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldboard.llm.common import col, table
from foldboard.scratch import written

CAPACITY = 2048
END = 0
LOT_PIECES = 4096
ISLANDS = 3
#: Rows of islands that one task works on.
ISLANDS_PER_TASK = 4
EPOCHS = 2
GENERATIONS = 12
POPULATION = 4
#: Bins with less room than this are closed, and are what a crossover injects.
SPARE = 8
TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: how this vocabulary splits texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of blanks from this length on are left to the slower library.
LONG_BLANKS = re.compile(r"\s{1000,}")


class Encoder:
    """Ids of a byte-level BPE given as the content of a tokenizers file.

    ``tiktoken`` gives the same ids several times faster if merges are ordered by id, as they are in the public file; where
    they are not, and for long runs of blanks, ``tokenizers`` itself is used. Special tokens in texts are ordinary text.
    """

    def __init__(self, content: str):
        self.content = content
        self._fast = self._exact = None

    def __getstate__(self) -> dict:
        return {"content": self.content, "_fast": None, "_exact": None}

    def exact(self, text: str) -> list[int]:
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_str(self.content)
            self._exact.encode_special_tokens = True
        return self._exact.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if self._fast is None:
            self._fast = self._fast_encoder() or False
        if not self._fast or LONG_BLANKS.search(text):
            return self.exact(text)
        return self._fast.encode_ordinary(text)

    def _fast_encoder(self):
        import tiktoken

        parts = json.loads(self.content)
        model, words = parts["model"], parts.get("pre_tokenizer") or {}
        vocabulary = model["vocab"]
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if words.get("type") != "ByteLevel" or words.get("add_prefix_space") or parts.get("normalizer"):
            return None
        if merged != sorted(merged):
            return None
        special = {token["content"] for token in parts["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in vocabulary.items()
            if token not in special
        }
        return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def byte_letters() -> dict[str, int]:
    """The byte behind every letter of a byte-level vocabulary: printable bytes stand for themselves, others follow from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def cut(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` tokens start; all but the first are full."""
    first = n % capacity or capacity
    return [0, *range(min(first, n), n, capacity)]


def pieces(docs: DataFrame, encoder: Encoder, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(encoder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            of, number, starts, lengths, sums = [], [], [], [], []
            for place, text in enumerate(batch.column("text")):
                ids = np.array([*own.encode(text.as_py() or ""), END], "<u4")
                for piece, (a, b) in enumerate(zip(at := cut(len(ids), capacity), [*at[1:], len(ids)])):
                    of.append(place)
                    number.append(piece)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(ids[a:b].tobytes()))
            columns = [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(number, pa.int32())]
            columns += [pa.array(v, pa.int64()) for v in (starts, lengths, sums)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    texts = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    cut_up = texts.mapInArrow(encode, schema)
    return written(cut_up.withColumn("row", F.monotonically_increasing_id()), "pieces")


def fewest(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of the bins: by the sum, and by pieces over half a bin, which never share one."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    least = np.arange(0, half + 1)
    # Pieces over capacity - least share a bin with none from least on, those over a half with some.
    alone = number[-1] - number[capacity - least]
    large = number[capacity - least] - number[half]
    room = large * capacity - (total[capacity - least] - total[half])
    below = np.where(least > 0, total[np.maximum(least - 1, 0)], 0)
    small = total[half] - below
    return int((alone + large + np.maximum(0, -(-(small - room) // capacity))).max())


def best_fit(order: np.ndarray, lengths: np.ndarray, bins: np.ndarray, loads: list[int], capacity: int) -> None:
    """Put pieces, in this ``order``, into the fullest bin that has room, else into a new one; changes ``bins`` and ``loads``."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for number, load in enumerate(loads):
        if load < capacity:
            by_room[capacity - load].append(number)
            rooms |= 1 << (capacity - load)
    for piece, length in zip(order.tolist(), lengths[order].tolist()):
        # Bit r of rooms says that some bin has room r; the lowest one from the length on is the best fit.
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, number = capacity, len(loads)
            loads.append(0)
        bins[piece] = number
        loads[number] += length
        if room > length:
            by_room[room - length].append(number)
            rooms |= 1 << (room - length)


class Lot:
    """Packings of one set of pieces: ``bins`` arrays that give every piece its bin."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: list[int]):
        self.lengths, self.capacity = lengths, capacity
        self.random = np.random.default_rng(seed)
        self.least = fewest(lengths, capacity)

    def loads(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, weights=self.lengths).astype("int64")

    def cost(self, bins: np.ndarray) -> tuple[int, float]:
        """Number of bins, then how evenly they are filled: full and empty ones are better than half full ones."""
        loads = self.loads(bins)
        return len(loads), -float((loads.astype("float64") ** 2).sum())

    def packed(self, keys: np.ndarray) -> np.ndarray:
        """Best fit by falling key."""
        bins = np.full(len(self.lengths), -1, "int32")
        best_fit(np.argsort(-keys, kind="stable"), self.lengths, bins, [], self.capacity)
        return bins

    def first(self) -> list[np.ndarray]:
        """Best fit by falling length, and by lengths with some noise."""
        noise = lambda: self.lengths * self.random.uniform(0.8, 1.0, len(self.lengths))
        return [self.packed(self.lengths), *[self.packed(noise()) for _ in range(POPULATION - 1)]]

    def rebuilt(self, bins: np.ndarray, free: np.ndarray) -> np.ndarray:
        """``bins`` after best fit of the ``free`` pieces, longest first, into what the others leave."""
        child = np.full(len(bins), -1, "int32")
        there, child[~free] = np.unique(bins[~free], return_inverse=True)
        loads = np.bincount(child[~free], weights=self.lengths[~free], minlength=len(there)).astype("int64").tolist()
        out = np.nonzero(free)[0]
        best_fit(out[np.argsort(-self.lengths[out], kind="stable")], self.lengths, child, loads, self.capacity)
        return child

    def crossed(self, mother: np.ndarray, father: np.ndarray) -> np.ndarray:
        """The mother with some well-filled bins of the father, every piece once."""
        loads = self.loads(father)
        full = np.nonzero(self.capacity - loads <= SPARE)[0]
        if not len(full):
            full = np.argsort(-loads, kind="stable")[: max(1, len(loads) // 4)]
        share = self.random.uniform(0.05, 0.3)
        chosen = np.zeros(len(loads), bool)
        chosen[full[self.random.random(len(full)) < share]] = True
        injected = chosen[father]
        dissolved = np.isin(mother, mother[injected])
        # Numbers of injected bins must not meet those of the mother's.
        child = np.where(injected, father + int(mother.max()) + 1, mother)
        return self.rebuilt(child, dissolved & ~injected)

    def mutated(self, bins: np.ndarray) -> np.ndarray:
        """Dissolves the worst-filled bins and some others."""
        loads = self.loads(bins)
        worst = np.argsort(loads, kind="stable")[: 1 + len(loads) // 50]
        gone = self.random.random(len(loads)) < 0.03
        gone[worst] = True
        return self.rebuilt(bins, gone[bins])

    def evolved(self, population: list[np.ndarray]) -> list[np.ndarray]:
        """The population after GENERATIONS, best first; a child takes the place of the worst if it is better."""
        ranked = sorted(((self.cost(b), k, b) for k, b in enumerate(population)), key=lambda one: one[:2])
        for number in range(GENERATIONS):
            if ranked[0][0][0] <= self.least:
                break
            mother, father = self.random.choice(len(ranked), 2, replace=False)
            child = self.crossed(ranked[mother][2], ranked[father][2])
            if number % 3 == 2:
                child = self.mutated(child)
            cost = self.cost(child)
            if cost < ranked[-1][0]:
                ranked[-1] = (cost, len(population) + number, child)
                ranked.sort(key=lambda one: one[:2])
        return [bins for _, _, bins in ranked]


def offsets(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where every piece begins in its bin."""
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    firsts = np.unique(bins[order], return_index=True)[1]
    begin = np.empty(len(bins), "int64")
    begin[order] = before - np.repeat(before[firsts], np.diff([*firsts, len(bins)]))
    return begin


_STATE = "lot long, island int, rows binary, lengths binary, others binary, elite binary, n_bins long, evenness double, least long"


def epoch(islands: DataFrame, number: int, capacity: int) -> DataFrame:
    """Every island after some generations. A row has its pieces, and from the second epoch on its population and an immigrant."""

    def evolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "int32")
                lot = Lot(lengths, capacity, [row["lot"], row["island"], number])
                if number:
                    others = np.frombuffer(row["others"], "int32").reshape(-1, len(lengths))
                    # The immigrant takes the place of the worst.
                    population = [np.frombuffer(row[n], "int32") for n in ("elite", "immigrant")] + [*others][:-1]
                else:
                    population = lot.first()
                elite, *others = lot.evolved(population)
                n_bins, evenness = lot.cost(elite)
                state = [row["lot"], row["island"], row["rows"], row["lengths"]]
                state += [b"".join(o.astype("int32").tobytes() for o in others), elite.astype("int32").tobytes()]
                state += [n_bins, evenness, lot.least]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(state, schema)], schema=schema
                )

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in _STATE.split(", "))])
    return islands.mapInArrow(evolve, _STATE)


def packed_lots(open_pieces: DataFrame, lots: int, capacity: int) -> DataFrame:
    """(lot, row, length, bin, load, begin) of ``open_pieces`` (row, length) after all epochs."""
    spark = open_pieces.sparkSession
    lot = F.pmod(F.xxhash64("row"), F.lit(lots)).alias("lot")
    listed = open_pieces.groupBy(lot).agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("pieces"))

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column("pieces").offsets.to_numpy()
            flat = batch.column("pieces").values
            values = [flat.field("row").to_numpy().astype("int64"), flat.field("length").to_numpy().astype("int32")]
            parts = [[v[a:b].tobytes() for a, b in zip(ends, ends[1:])] for v in values]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lot"), *[pa.array(p, pa.binary()) for p in parts]], names=["lot", "rows", "lengths"]
            )

    stored = written(listed.mapInArrow(as_bytes, "lot long, rows binary, lengths binary"), "lots")
    tasks = -(-lots * ISLANDS // ISLANDS_PER_TASK)
    islands = stored.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    state = written(epoch(islands.repartition(tasks, "lot", "island"), 0, capacity), "islands")
    final = [state]
    for number in range(1, EPOCHS):
        # Lots that are solved on one island rest; of the others every island takes in its neighbour's best.
        solved = state.filter(F.col("n_bins") <= F.col("least")).select("lot").distinct()
        rest = state.join(solved, "lot", "left_anti")
        immigrants = rest.select(
            "lot", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("immigrant")
        )
        both = rest.join(immigrants, ["lot", "island"]).repartition(tasks, "lot", "island")
        state = written(epoch(both, number, capacity), "islands")
        final.append(state)
    # Later epochs only improve, so the best of all islands and epochs is the lot's packing.
    order = Window.partitionBy("lot").orderBy("n_bins", "evenness", "island", F.desc("epoch"))
    results = reduce(
        DataFrame.unionByName,
        [s.select("lot", "island", "n_bins", "evenness", F.lit(k).alias("epoch")) for k, s in enumerate(final)],
    )
    best = results.withColumn("place", F.row_number().over(order)).filter("place = 1").select("lot", "island", "epoch")
    every = reduce(
        DataFrame.unionByName,
        [s.select("lot", "island", "rows", "lengths", "elite", F.lit(k).alias("epoch")) for k, s in enumerate(final)],
    )

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = np.frombuffer(row["rows"], "int64")
                lengths = np.frombuffer(row["lengths"], "int32").astype("int64")
                bins = np.frombuffer(row["elite"], "int32")
                loads = np.bincount(bins, weights=lengths).astype("int64")[bins]
                columns = np.full(len(rows), row["lot"]), rows, lengths, bins, loads, offsets(bins, lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype("int64")) for c in columns], names=["lot", "row", "length", "bin", "load", "begin"]
                )

    chosen = every.join(best, ["lot", "island", "epoch"]).select("lot", "rows", "lengths", "elite")
    layout = chosen.mapInArrow(laid_out, "lot long, row long, length long, bin long, load long, begin long")
    return written(layout, "layout")


def sequences(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    lot_pieces: int = LOT_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the content of a tokenizers file. A missing text is empty, and an empty one has its end id alone; texts are
    encoded whole, however long. Missing and repeated ids and repeated rows are documents of their own, each with its pieces.
    Equal lengths are told apart by row number. An empty table gives no rows; other columns are ignored.
    """
    cut_up = pieces(docs, Encoder(tokenizer), capacity, id_col, text_col)
    # A full piece is a sequence of its own; even numbers are theirs, odd ones belong to bins of lots.
    placed = [
        cut_up.filter(F.col("length") == capacity).select(
            "row", (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
        )
    ]
    rest = cut_up.filter(F.col("length") < capacity).select("row", F.col("length").cast("int").alias("length"))
    left, level = rest.count(), 0
    while left:
        lots = -(-left // lot_pieces)
        layout = packed_lots(rest, lots, capacity)
        closed = F.col("load") >= capacity - SPARE
        before, left = left, layout.filter(~closed).count()
        last = lots == 1 or 4 * left > 3 * before
        number = (F.col("lot") * (1 << 26) + F.lit(level << 20) + F.col("bin")) * 2 + 1
        done = layout if last else layout.filter(closed)
        placed.append(done.select("row", number.alias("sequence_id"), F.col("begin").alias("offset")))
        if last:
            break
        rest = layout.filter(~closed).select("row", F.col("length").cast("int").alias("length"))
        level += 1
    where = reduce(DataFrame.unionByName, placed)
    return cut_up.join(where, "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def tokenizer_content(path: str | None = None) -> str:
    """Content of a tokenizers file, by default of the public one; read on the driver, since executors may not have it."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as file:
        return file.read()


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return sequences(table(spark, sf_dir, "documents"), tokenizer_content())


QUERIES = {"op12_packing": op12_packing}
ORACLES: dict[str, str] = {}
