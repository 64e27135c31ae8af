"""Category indexing that also works when the categories outgrow one machine.

Indices follow falling frequency, ties by value; NULL and values not seen in
fitting share the extra index ``number of labels``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldboard.scratch import discard, scratch_path, written

# Driver-side label lists may hold this much, all columns together; beyond it labels stay a table.
MAX_LABELS = 100_000
MAX_LABEL_BYTES = 16 * 1024 * 1024
# The most frequent labels of a label table that are broadcast instead of shuffled to;
# columns share the bytes.
HEAD_LABELS = 10_000
HEAD_BYTES = 16 * 1024 * 1024
# Of the values without such a label, those with more than one in HEAVY of these rows are
# broadcast as well, so there are fewer than HEAVY of them, none longer than HEAVY_BYTES.
HEAVY = 1_000
HEAVY_BYTES = 1_024
# Values that a task tracks per column to find these: their counts are right to a fraction of one in HEAVY.
TRACKED = 10_000

# Labels of a column, the rows that have one, and the sums of their indices and of the squares of these.
IndexSums = tuple[int, int, float, float]


def count_labels(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """``(*by, position, value, n)`` for all columns in one pass.

    Counting happens before the shuffle, so a value that fills a third of the
    table arrives as one row per map task.
    """
    values = F.array(*[F.col(c) for c in columns])
    return (
        df.select(*by, F.posexplode(values).alias("position", "value"))
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "position", "value")
        .agg(F.count("*").alias("n"))
    )


def rank_labels(counts: DataFrame) -> DataFrame:
    """``(position, value, n, idx)``: the index of every label, without a single-task sort; a written table.

    The labels are sorted across partitions and written together with partition
    and place; the number of rows before each partition turns both into a rank.
    """
    spark = counts.sparkSession
    path = scratch_path(spark, "labels")
    counts.orderBy("position", F.desc("n"), "value").select(
        "position",
        "value",
        "n",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    ).write.parquet(path)
    placed = spark.read.parquet(path)
    # One row per partition and one per column: small whatever the number of labels.
    part_starts = _running_start(placed.groupBy("part").agg(F.count("*").alias("size")), "part")
    column_starts = _running_start(
        placed.groupBy("position").agg(F.count("*").alias("size")), "position"
    )
    ranked = (
        placed.join(F.broadcast(part_starts), "part")
        .join(F.broadcast(column_starts), "position")
        .select(
            "position",
            "value",
            "n",
            (F.col("part_start") + F.col("place") - F.col("position_start")).alias("idx"),
        )
    )
    table = written(ranked, "label-table")
    discard(spark, path)
    return table


def head_sizes(table: DataFrame, most: int, most_bytes: int) -> dict[int, int]:
    """Per column, how many of its most frequent labels may be broadcast: at most ``most``, in ``most_bytes``."""
    running = F.sum("bytes").over(Window.partitionBy("position").orderBy("idx"))
    return {
        row["position"]: row["size"]
        for row in table.filter(F.col("idx") < most)
        .select("position", "idx", F.octet_length("value").alias("bytes"))
        .withColumn("running", running)
        .filter(F.col("running") <= most_bytes)
        .groupBy("position")
        .agg(F.count("*").alias("size"))
        .collect()
    }


def label_sizes(labels: DataFrame) -> dict[int, tuple[int, int]]:
    """Per position, how many labels (position, value) there are and the bytes they take."""
    return {
        row["position"]: (row["labels"], row["bytes"])
        for row in labels.groupBy("position")
        .agg(F.count("*").alias("labels"), F.sum(F.octet_length("value")).alias("bytes"))
        .collect()
    }


def table_sums(table: DataFrame) -> dict[int, IndexSums]:
    """:data:`IndexSums` per position of a label table."""
    idx = F.col("idx").cast("double")
    return {
        row["position"]: (row["labels"], row["rows"], row["total"], row["squares"])
        for row in table.groupBy("position")
        .agg(
            F.count("*").alias("labels"),
            F.sum("n").alias("rows"),
            F.sum(idx * F.col("n")).alias("total"),
            F.sum(idx * idx * F.col("n")).alias("squares"),
        )
        .collect()
    }


def _running_start(sizes: DataFrame, key: str) -> DataFrame:
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        key, F.coalesce(F.sum("size").over(before), F.lit(0)).alias(f"{key}_start")
    )


class CategoryIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsWritable, DefaultParamsReadable):
    """Fits label indices for several string columns in one counting pass.

    Columns become Spark's own ``StringIndexerModel``, those with few labels first, as
    long as all their labels together stay below ``maxLabels`` and ``maxLabelBytes``;
    the others a :class:`LabelTableModel`. Both give the same indices.
    """

    maxLabels = Param(
        Params._dummy(), "maxLabels", "most labels kept as a list", TypeConverters.toInt
    )
    maxLabelBytes = Param(
        Params._dummy(), "maxLabelBytes", "most bytes kept as a list", TypeConverters.toInt
    )
    headLabels = Param(
        Params._dummy(), "headLabels", "labels of a table that are broadcast", TypeConverters.toInt
    )

    @keyword_only
    def __init__(
        self,
        *,
        inputCols=None,
        outputCols=None,
        maxLabels=MAX_LABELS,
        maxLabelBytes=MAX_LABEL_BYTES,
        headLabels=HEAD_LABELS,
    ):
        super().__init__()
        self._setDefault(
            maxLabels=MAX_LABELS, maxLabelBytes=MAX_LABEL_BYTES, headLabels=HEAD_LABELS
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        return self.fit_counts(count_labels(dataset, self.getInputCols()))[0]

    def fit_counts(self, counts: DataFrame) -> tuple[Model, dict[int, IndexSums]]:
        """The model for labels counted before (position, value, n), and what its indices add up to per position."""
        inputs, outputs = self.getInputCols(), self.getOutputCols()
        counts = counts.persist()
        try:
            sizes = label_sizes(counts)
            listed, tabled = [], []
            labels_left = self.getOrDefault(self.maxLabels)
            bytes_left = self.getOrDefault(self.maxLabelBytes)
            for position in sorted(range(len(inputs)), key=lambda p: sizes.get(p, (0, 0))):
                labels, size = sizes.get(position, (0, 0))
                if labels <= labels_left and size <= bytes_left:
                    listed.append(position)
                    labels_left, bytes_left = labels_left - labels, bytes_left - size
                else:
                    tabled.append(position)
            listed.sort()
            tabled.sort()

            models, sums = [], {}
            if listed:
                rows = counts.filter(F.col("position").isin(listed)).collect()
                models, sums = self._listed(
                    listed, [(row["position"], row["value"], row["n"]) for row in rows]
                )
            if tabled:
                table = rank_labels(counts.filter(F.col("position").isin(tabled)))
                heads = head_sizes(
                    table, self.getOrDefault(self.headLabels), HEAD_BYTES // len(tabled)
                )
                models.append(
                    LabelTableModel(
                        table=table,
                        inputCols=[inputs[p] for p in tabled],
                        outputCols=[outputs[p] for p in tabled],
                        positions=tabled,
                        labelCounts=[sizes[p][0] for p in tabled],
                        headSizes=[heads.get(p, 0) for p in tabled],
                    )
                )
                sums |= table_sums(table)
            return models[0] if len(models) == 1 else PipelineModel(models), sums
        finally:
            counts.unpersist()

    def fit_leaving_out(
        self,
        counts: DataFrame,
        part: str,
        left_out: Sequence[int | None],
        together: Callable[[list[Callable]], list],
    ) -> list[tuple[Model, dict[int, IndexSums]]]:
        """:meth:`fit_counts` without each of ``left_out`` (None: of all parts); ``counts`` has a column ``part``.

        Labels that fit the limits in all parts fit them in any choice of parts: they are collected once.
        """
        positions = list(range(len(self.getInputCols())))
        sizes = label_sizes(counts.select("position", "value").distinct())
        fits = sum(n for n, _ in sizes.values()) <= self.getOrDefault(self.maxLabels)
        if fits and sum(size for _, size in sizes.values()) <= self.getOrDefault(self.maxLabelBytes):
            rows = counts.collect()
            results = []
            for missing in left_out:
                kept: dict[tuple[int, str], int] = {}
                for row in rows:
                    if row[part] != missing:
                        key = row["position"], row["value"]
                        kept[key] = kept.get(key, 0) + row["n"]
                models, sums = self._listed(positions, [(*key, n) for key, n in kept.items()])
                results.append((models[0] if len(models) == 1 else PipelineModel(models), sums))
            return results

        def fitted(missing: int | None) -> tuple[Model, dict[int, IndexSums]]:
            own = counts if missing is None else counts.filter(F.col(part) != missing)
            return self.fit_counts(own.groupBy("position", "value").agg(F.sum("n").alias("n")))

        return together([lambda missing=missing: fitted(missing) for missing in left_out])

    def _listed(
        self, positions: list[int], counted: list[tuple[int, str, int]]
    ) -> tuple[list[Model], dict[int, IndexSums]]:
        """A model per column: label lists of unequal length would be padded to one Java matrix."""
        inputs, outputs = self.getInputCols(), self.getOutputCols()
        by_position: dict[int, list[tuple[str, int]]] = {position: [] for position in positions}
        for position, value, n in sorted(counted, key=lambda row: (-row[2], row[1])):
            by_position[position].append((value, n))
        models = [
            StringIndexerModel.from_labels(
                [value for value, _ in by_position[p]],
                inputCol=inputs[p],
                outputCol=outputs[p],
                handleInvalid="keep",
            )
            for p in positions
        ]
        sums = {
            p: (
                len(own),
                sum(n for _, n in own),
                float(sum(idx * n for idx, (_, n) in enumerate(own))),
                float(sum(idx * idx * n for idx, (_, n) in enumerate(own))),
            )
            for p, own in by_position.items()
        }
        return models, sums


class LabelTableModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """Looks indices up in a label table of any size, for all its columns at once.

    The most frequent labels reach the rows by broadcast. So do the values, seen in
    fitting or not, that fill more than one in ``HEAVY`` of the other cells of their column:
    they are found first, by sketches. Rows that need no more stay where
    they are. What is left of the others becomes (row, column, value) cells, which are joined
    with the labels in one shuffle, whatever the number of columns; no value fills a task.
    A second one brings the cells of a row together again, with the row itself, which
    travels with its first cell.
    """

    positions = Param(
        Params._dummy(), "positions", "position of each input column", TypeConverters.toListInt
    )
    labelCounts = Param(
        Params._dummy(), "labelCounts", "labels of each input column", TypeConverters.toListInt
    )
    headSizes = Param(
        Params._dummy(),
        "headSizes",
        "most frequent labels of each input column, those that are broadcast",
        TypeConverters.toListInt,
    )

    @keyword_only
    def __init__(
        self,
        *,
        table=None,
        inputCols=None,
        outputCols=None,
        positions=None,
        labelCounts=None,
        headSizes=None,
    ):
        super().__init__()
        # The label table, a DataFrame; saved next to the params.
        self.table = table
        self._set(**{k: v for k, v in self._input_kwargs.items() if k != "table" and v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = dataset.columns
        places = [
            _Place(k, *own)
            for k, own in enumerate(
                zip(
                    self.getInputCols(),
                    self.getOutputCols(),
                    self.getOrDefault(self.positions),
                    self.getOrDefault(self.labelCounts),
                    self.getOrDefault(self.headSizes),
                )
            )
        ]
        placed = dataset
        for place in places:
            head = self.table.filter(
                (F.col("position") == place.position) & (F.col("idx") < place.head_size)
            ).select(F.col("value").alias("_head"), F.col("idx").alias(place.found))
            placed = placed.join(
                F.broadcast(head), F.col(place.column) == F.col("_head"), "left"
            ).drop("_head")
        tailed = [place for place in places if place.head_size < place.labels]
        if tailed:
            heavy = self._heavy(placed, tailed)
            for place in tailed:
                own = heavy.filter(F.col("_k") == place.k).select("_value", "_idx")
                known = F.coalesce(place.found, "_idx").alias(place.found)
                others = [c for c in placed.columns if c != place.found]
                placed = placed.join(
                    F.broadcast(own), F.col(place.column) == F.col("_value"), "left"
                ).select(*others, known)
        open_cells = [place.is_open for place in tailed]
        if not open_cells:
            return placed.select(*columns, *[place.index(F.col(place.found)) for place in places])
        waiting = reduce(lambda one, other: one | other, open_cells)
        here = placed.filter(~waiting).select(*columns, *[p.index(F.col(p.found)) for p in places])
        return here.union(self._looked_up(placed.filter(waiting), columns, places, tailed))

    def _tail(self, places: list[_Place]) -> DataFrame:
        """(_k, _value, _idx): the labels that are not broadcast."""
        number = F.create_map(*[x for p in places for x in (F.lit(p.position), F.lit(p.k))])
        size = F.create_map(*[x for p in places for x in (F.lit(p.position), F.lit(p.head_size))])
        own = self.table.filter(F.col("position").isin([p.position for p in places]))
        return own.filter(F.col("idx") >= size[F.col("position")]).select(
            number[F.col("position")].alias("_k"), F.col("value").alias("_value"), F.col("idx").alias("_idx")
        )

    def _heavy(self, placed: DataFrame, tailed: list[_Place]) -> DataFrame:
        """(_k, _value, _idx) of the values that fill more than one in HEAVY of the open cells of a column."""
        # A sketch per column: what fills more than one in HEAVY of the cells is always in it, and no cell is shuffled.
        sketches = []
        for p in tailed:
            short = p.is_open & (F.octet_length(p.column) <= HEAVY_BYTES)
            top = F.call_function("approx_top_k", F.when(short, F.col(p.column)), F.lit(HEAVY + 1), F.lit(TRACKED))
            sketches.append(F.struct(F.lit(p.k).alias("k"), F.count_if(p.is_open).alias("total"), top.alias("top")))
        frequent = (
            placed.agg(F.array(*sketches).alias("columns"))
            .select(F.explode("columns").alias("column"))
            .select(F.col("column.k").alias("_k"), F.col("column.total").alias("total"), F.inline("column.top").alias("_value", "n"))
            .filter(F.col("_value").isNotNull() & (F.col("n") * HEAVY > F.col("total")))
            .select("_k", "_value")
        )
        known = self._tail(tailed).join(F.broadcast(frequent), ["_k", "_value"])
        labels = F.create_map(*[x for p in tailed for x in (F.lit(p.k), F.lit(p.labels))])
        # The limit is never reached; it keeps the filters on _k above, so that all columns share one count.
        return (
            frequent.join(F.broadcast(known), ["_k", "_value"], "left")
            .select("_k", "_value", F.coalesce("_idx", labels[F.col("_k")]).alias("_idx"))
            .limit(HEAVY * len(tailed))
        )

    def _looked_up(
        self, waiting: DataFrame, columns: list[str], places: list[_Place], tailed: list[_Place]
    ) -> DataFrame:
        """Rows with open cells: joined with the labels by cell, and put together again."""
        # A value that travels as a cell does not travel with the row as well.
        apart = {p.column: p for p in tailed}
        own = [F.when(~apart[c].is_open, F.col(c)).alias(c) if c in apart else F.col(c) for c in columns]
        row = F.struct(*own, *[F.col(p.found) for p in places])
        # Numbered before its cells go separate ways.
        numbered = waiting.select(
            F.monotonically_increasing_id().alias("_row"), row.alias("_own"), _cells(tailed).alias("_cells")
        )
        cells = numbered.select("_row", "_own", F.posexplode("_cells")).select(
            "_row",
            F.col("col.k").alias("_k"),
            F.col("col.value").alias("_value"),
            F.when(F.col("pos") == 0, F.col("_own")).alias("_own"),
        )
        found = cells.join(self._tail(tailed), ["_k", "_value"], "left")
        cell = F.struct("_value", "_idx")
        if len(tailed) > 1:
            found = found.groupBy("_row").agg(
                F.first("_own", ignorenulls=True).alias("_own"),
                F.map_from_entries(F.collect_list(F.struct(F.col("_k"), cell))).alias("_found"),
            )
        else:
            found = found.withColumn("_found", F.create_map(F.col("_k"), cell))

        def looked_up(p: _Place, name: str) -> Column:
            return F.try_element_at("_found", F.lit(p.k)).getField(name)

        of = {place.k for place in tailed}
        indices = [
            p.index(F.coalesce(F.col(f"_own.{p.found}"), looked_up(p, "_idx")))
            if p.k in of
            else p.index(F.col(f"_own.{p.found}"))
            for p in places
        ]
        values = [
            (F.coalesce(kept, looked_up(apart[c], "_value")) if c in apart else kept).alias(c)
            for c in columns
            for kept in [F.col("_own").getField(c)]
        ]
        return found.select(*values, *indices)

    def write(self) -> MLWriter:
        return _LabelTableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LabelTableReader(cls)


@dataclass(frozen=True)
class _Place:
    """One column of a lookup."""

    k: int
    column: str
    output: str
    position: int
    labels: int
    head_size: int

    @property
    def found(self) -> str:
        """Column of the index as far as it is known without a shuffle."""
        return f"_found_{self.k}"

    @property
    def is_open(self) -> Column:
        return F.col(self.column).isNotNull() & F.col(self.found).isNull()

    def index(self, known: Column) -> Column:
        """The index; missing and unseen values share the one after the last label."""
        return F.coalesce(known, F.lit(self.labels)).cast("double").alias(self.output)


def _cells(places: list[_Place]) -> Column:
    """The open cells of a row: number of the column, and value."""
    cells = [
        F.when(p.is_open, F.struct(F.lit(p.k).alias("k"), F.col(p.column).alias("value"))) for p in places
    ]
    return F.filter(F.array(*cells), lambda cell: cell.isNotNull())


class _LabelTableWriter(MLWriter):
    def __init__(self, instance: LabelTableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/labels")


class _LabelTableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LabelTableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(table=self.sparkSession.read.parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
