"""Mixing by iterative proportional fitting over source, language and topic.

Tokens are counted per cell (source, language, topic). Cell weights start at the counts and are scaled to the target
share of each margin in turn until a whole round changes no margin by more than ``tolerance``, or for ``rounds``
rounds. Weight over count, times the wanted share of all tokens, is the probability with which a document of the cell is
drawn; the draw is a hash of its id, so a rerun draws the same documents.

No probability exceeds 1: weights stop there, and the other cells of a margin are scaled up instead; the
target of a value with fewer tokens than it wants is all of them, and the other values share what is left over.

Only cells are iterated on. They stay a table that is written after every few rounds, and become a broadcast when they
are few enough. Few cells lie in one partition, so that a round needs no shuffle; more of them are dealt out by margin.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldboard.llm.common import BLANK_CLASS, col, table
from foldboard.scratch import gathered, written

MARGINS = ("source", "lang", "topic")
#: Cells that may be broadcast; more of them are joined by shuffle.
BROADCAST_CELLS = 200_000
#: Rounds in one plan between two written states.
ROUNDS_PER_STEP = 2
#: Share of all tokens that the production query draws, and the power that flattens shares of sources and topics.
KEPT_SHARE = 0.5
FLATTENING = 0.5
#: Weights are final when a step moves none by this share of all tokens, or after this many rounds.
ROUNDS, TOLERANCE = 40, 1e-6
DRAWS = 1 << 28


def token_count(text: Column) -> Column:
    """Words between blanks; none for a missing text."""
    words = F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS + "+"), ""))
    return words.cast("bigint")


def topic(text: Column) -> Column:
    """What a text is about, as far as its form tells: a table, code or markup, figures, shouting, or prose."""
    text = F.coalesce(text, F.lit(""))
    length = F.length(text)

    def count(pattern: str) -> Column:
        return length - F.length(F.regexp_replace(text, pattern, ""))

    return (
        F.when(length == 0, "empty")
        .when(20 * count("[|]") > length, "table")
        .when(20 * count("[#*$%&<>{}]") > length, "markup")
        .when(10 * count("[0-9]") > length, "figures")
        .when(2 * count("[A-Z]") > length, "shouting")
        .otherwise("prose")
    )


def draw(doc_id: Column) -> Column:
    """A number in 0..DRAWS-1 from the md5 of the id; a missing id counts as empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, margins, tokens, draw) of every row."""
    return docs.select(
        col(id_col).alias("doc_id"),
        col("source").alias("source"),
        col("lang").alias("lang"),
        topic(col(text_col)).alias("topic"),
        token_count(col(text_col)).alias("tokens"),
        draw(col(id_col)).alias("draw"),
    )


def flattened(cells: DataFrame, margin: str, power: float = FLATTENING) -> DataFrame:
    """Target shares (value, share): token shares of a margin raised to ``power``."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("n"))
    raised = sums.select("value", F.pow(F.col("n").cast("double"), F.lit(power)).alias("p"))
    return raised.select("value", (F.col("p") / raised.agg(F.sum("p")).scalar()).alias("share"))


def level(state: DataFrame, margin: str, total: float, limit: float) -> float:
    """The level at which shares of ``margin`` times it, but ``limit`` per token at most, add up to ``total``."""
    values = state.filter("weight > 0").groupBy(margin).agg(
        F.first(f"_{margin}").alias("share"), (F.sum("tokens") * limit).alias("room")
    )
    values = written(values, "margin")
    reached, full = 0.0, -1
    while True:
        short = F.col("room") <= F.col("share") * reached
        sums = values.agg(
            F.coalesce(F.sum(F.when(short, F.col("room"))), F.lit(0.0)).alias("room"),
            F.coalesce(F.sum(F.when(~short, F.col("share"))), F.lit(0.0)).alias("share"),
            F.count_if(short).alias("full"),
        ).first()
        if sums["full"] == full or not sums["share"] or sums["room"] >= total:
            return reached if sums["share"] else float("inf")
        # Values only become full from step to step.
        reached, full = max(reached, (total - sums["room"]) / sums["share"]), sums["full"]


def rake(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    rounds: int,
    tolerance: float,
    limit: float,
) -> DataFrame:
    """Cells with ``weight`` beside margins and tokens.

    ``targets`` has (value, share) per margin; shares are taken relative to each other, among the values that have a cell
    with tokens and a target in every margin. All other cells get weight 0. Missing values are values like others.
    No weight exceeds ``limit`` times the tokens of its cell.
    """
    named = cells
    for margin, target in targets.items():
        wanted = target.select(
            F.col("value").alias("_value"), F.col("share").cast("double").alias(f"_{margin}")
        )
        same = named[margin].eqNullSafe(wanted["_value"])
        named = named.join(wanted, same, "left").drop("_value").fillna(0.0, [f"_{margin}"])
    usable = F.least("tokens", *[F.ceil(f"_{m}").cast("bigint") for m in targets]) > 0
    state = written(
        named.withColumn("weight", F.when(usable, F.col("tokens")).otherwise(0).cast("double")), "cells"
    )
    n_cells = state.count()
    state = gathered(state, n_cells)
    total = state.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    most = F.col("tokens") * limit
    levels = {margin: level(state, margin, float(total), limit) for margin in targets}
    # Room counts only the cells that can be drawn.
    room = F.when(F.col("weight") > 0, most).otherwise(0.0)
    wants = {
        f"_want_{m}": F.least(F.sum(room).over(Window.partitionBy(m)), F.col(f"_{m}") * F.lit(levels[m]))
        for m in targets
    }
    state = written(state.withColumns(wants).withColumn("weight", F.least("weight", most)), "cells")
    done = 0
    while done < rounds:
        step = min(ROUNDS_PER_STEP, rounds - done)
        moving = gathered(state, n_cells).withColumn("_before", F.col("weight"))
        for _ in range(step):
            for margin in targets:
                # A window keeps the plan in one line; a join with sums would double it each time.
                group = Window.partitionBy(margin)
                held = F.sum("weight").over(group)
                wanted = F.col(f"_want_{margin}")
                full = F.sum(F.when(F.col("weight") >= most, most).otherwise(0.0)).over(group)
                # Cells at their limit stay while the margin lacks tokens, and shrink with the others else.
                growth = F.when(held > full, (wanted - full) / (held - full)).otherwise(1.0)
                factor = F.when(wanted < held, wanted / held).otherwise(growth)
                scaled = F.least(F.col("weight") * factor, most)
                moving = moving.withColumn("weight", F.when(F.col("weight") > 0, scaled).otherwise(0.0))
        moving = written(moving, "cells")
        moved = moving.agg(F.max(F.abs(F.col("weight") - F.col("_before"))).alias("most")).first()
        state = moving.drop("_before")
        done += step
        if (moved["most"] or 0.0) <= tolerance * max(total, 1):
            break
    return state.select(*targets, "tokens", "weight")


def probabilities(
    rows: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    kept_share: float = KEPT_SHARE,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(margins, tokens, weight, probability) of every cell of described ``rows``.

    Without ``targets`` the token shares of each margin are flattened. A cell without tokens has nothing to weigh and
    its documents are drawn with ``kept_share``.
    """
    cells = written(
        rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells"
    )
    cells = gathered(cells, cells.count())
    if targets is None:
        targets = {margin: flattened(cells, margin) for margin in MARGINS}
    raked = rake(cells, targets, rounds, tolerance, 1 / kept_share)
    drawn = F.least(F.lit(1.0), F.lit(kept_share) * F.col("weight") / F.col("tokens"))
    return raked.withColumn(
        "probability", F.when(F.col("tokens") > 0, drawn).otherwise(F.lit(kept_share))
    )


def with_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` with the columns of their cell, prefixed by an underscore."""
    cells = written(cells.select([F.col(c).alias(f"_{c}") for c in cells.columns]), "cells")
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    same = reduce(Column.__and__, [rows[m].eqNullSafe(cells[f"_{m}"]) for m in MARGINS])
    return rows.join(cells, same)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: id, margins, tokens, probability and whether the row is drawn.

    Missing texts have no tokens and the topic ``empty``; missing sources and languages form cells of their own. Repeated
    rows and missing ids are rows like others (equal ids draw alike). An empty table gives no rows; columns other than id,
    text, source and lang are ignored.
    """
    rows = written(described(docs), "described")
    placed = with_cells(rows, probabilities(rows, **options))
    return placed.select(
        "doc_id",
        *MARGINS,
        F.col("tokens"),
        F.col("_probability").alias("probability"),
        (F.col("draw") < F.col("_probability") * DRAWS).alias("drawn"),
    )


def drawn_documents(docs: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    rows = written(described(docs), "described")
    cells = probabilities(rows, **options)
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}
    cells = written(cells.select([F.col(c).alias(f"_cell_{c}") for c in cells.columns]), "cells")
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    same = reduce(
        Column.__and__, [value.eqNullSafe(F.col(f"_cell_{m}")) for m, value in margins.items()]
    )
    chosen = draw(F.col("doc_id")) < F.col("_cell_probability") * DRAWS
    return docs.join(cells, same & chosen, "left_semi")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and draw of every document for flattened sources, languages and topics."""
    mixed = mixed_documents(table(spark, sf_dir, "documents"))
    return mixed.withColumn("probability", F.round("probability", 9))


QUERIES = {"op4_mixing": op4_mixing}
#: Raking goes on until nothing moves, which SQL cannot say; tests compare with plain numpy.
ORACLES: dict[str, str] = {}
