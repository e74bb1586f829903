"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every row draws an exponential key, -ln(u) / weight, where u comes from a hash of the row
and weight is its quality. A source is taken in ascending order of the keys until its word
budget is used up, which is a weighted sample without replacement. Whole epochs come
first: a target of 1.3 times the source takes every row once and samples the other 0.3.

No source is sorted as a whole. Keys are mapped to 4096 slices of equal width; the words
per source and slice are summed (an aggregate with map-side partial sums), their prefix
sums name the one slice in which the budget ends, and only that slice's rows are sorted.
The outcome, the last key taken, is one row per source; a row is taken if its own key is
not above it, which each row tells for itself without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import BROADCAST_BYTES, WORDS, table, text_or_empty
from starloom.operators.lookup import look_up
from starloom.operators.numbering import number_rows
from starloom.workspace import Workspace

# of the sources in order, repeating
SOURCE_WEIGHTS = (5, 2, 1)
SHARE_OF_ALL = 1.5
MOST_REPEATS = 2
SEED = 7
SLICES = 4096

_LEAST_WEIGHT = 0.25


def quality_weight(text_col: str) -> Column:
    """From 0.25 to 1: the share of letters and white space in the text."""
    text = text_or_empty(text_col)
    share = F.try_divide(
        F.length(F.regexp_replace(text, r"[^\p{L}\s]+", "")), F.length(text)
    )
    return _LEAST_WEIGHT + (1 - _LEAST_WEIGHT) * F.coalesce(share, F.lit(0.0))


def _sized(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weight: Column, seed: int
) -> list[Column]:
    text = text_or_empty(text_col)
    # 53 bits of a hash: above 0, below 1, and the same in every run
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), text)
    uniform = (F.shiftrightunsigned(draw, 11) + 0.5) / float(1 << 53)
    return [
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("__size"),
        (-F.log(uniform) / weight).alias("__key"),
        draw.alias("__tie"),
        F.col(source_col).alias("__source"),
    ]


def _slice(key: Column) -> Column:
    return F.floor(SLICES * (1 - F.exp(-key)))


def targets(sizes: DataFrame, workspace: Workspace) -> DataFrame:
    """Source, size, target: `sizes` has the sources, null at most once, and their words.

    The weights share out the total; a source stops at `MOST_REPEATS` times its size, and
    what it leaves is shared again by weight. The driver sees one row of sums a round.
    """
    order = [F.col("__source").isNull(), F.col("__source")]
    numbered = number_rows(sizes, order, "place", workspace)
    weights = F.array(*[F.lit(w) for w in SOURCE_WEIGHTS])
    weighted = workspace.save(
        numbered.withColumn(
            "weight", F.element_at(weights, ((F.col("place") - 1) % len(SOURCE_WEIGHTS)) + 1)
        ).drop("place"),
        "weighted",
    )
    most = MOST_REPEATS * F.col("source_size")
    total = SHARE_OF_ALL * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    per_weight = 0.0
    stopped_before = -1
    while True:
        # first round: nobody has stopped
        stops = most <= F.lit(per_weight) * F.col("weight")
        if stopped_before < 0:
            stops = F.lit(False)
        stopped, used, open_weight = weighted.agg(
            F.count_if(stops),
            F.coalesce(F.sum(F.when(stops, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)),
        ).first()
        if stopped == stopped_before or open_weight == 0:
            break
        per_weight = (total - used) / open_weight
        stopped_before = stopped
    share = F.lit(float(per_weight)) * F.col("weight")
    return weighted.withColumn("target", F.least(most.cast("double"), share)).drop("weight")


def _cuts(sized: DataFrame, plan: DataFrame, workspace: Workspace) -> DataFrame:
    """Per source with a fractional part: the slice, key and tie up to which rows are taken."""
    by_source = Window.partitionBy("source_place")
    slices = (
        look_up(sized, plan.select("source_place", "budget"), ["source_place"], BROADCAST_BYTES)
        .filter("budget > 0")
        .groupBy("source_place", "budget", _slice(F.col("__key")).alias("slice"))
        .agg(F.sum("__size").alias("words"))
    )
    running = F.sum("words").over(by_source.orderBy("slice"))
    last = (
        slices.withColumn("through", running)
        .filter(F.col("through") >= F.col("budget"))
        .withColumn("first", F.row_number().over(by_source.orderBy("slice")))
        .filter("first = 1")
        .select("source_place", "slice", "budget", (F.col("through") - F.col("words")).alias("before"))
    )
    last = workspace.save(last, "last-slices")
    inside = look_up(
        sized.withColumn("slice", _slice(F.col("__key"))),
        last,
        ["source_place", "slice"],
        BROADCAST_BYTES,
    ).filter("before is not null")
    # rows with the same key and tie are equal: a unit
    units = inside.groupBy("source_place", "slice", "budget", "before", "__key", "__tie").agg(
        F.sum("__size").alias("words")
    )
    order = by_source.orderBy("__key", "__tie")
    units = units.withColumn("through", F.col("before") + F.sum("words").over(order))
    # the unit that crosses the budget is taken if that comes nearer to it
    ahead = F.col("through") - F.col("words")
    nearer = F.col("through") - F.col("budget") < F.col("budget") - ahead
    taken = units.filter(
        (F.col("through") <= F.col("budget")) | ((ahead < F.col("budget")) & nearer)
    )
    ends = taken.groupBy("source_place").agg(
        F.max(F.struct("__key", "__tie")).alias("end")
    )
    return last.join(ends, "source_place", "left").select(
        "source_place",
        F.col("slice").alias("cut_slice"),
        F.col("end.__key").alias("cut_key"),
        F.col("end.__tie").alias("cut_tie"),
    )


def _source_place(column: Column) -> Column:
    """Sources as a key that joins null with null."""
    return F.struct(column.isNull().alias("none"), F.coalesce(column, F.lit("")).alias("name"))


def _plan(sized: DataFrame, workspace: Workspace) -> DataFrame:
    sizes = sized.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    plan = targets(sizes, workspace)
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    plan = plan.select(
        _source_place(F.col("__source")).alias("source_place"),
        "source_size",
        "target",
        epochs.cast("long").alias("epochs"),
    ).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = workspace.save(plan, "plan")
    cuts = _cuts(sized, plan, workspace)
    return workspace.save(plan.join(cuts, "source_place", "left"), "cuts")


def _times() -> Column:
    """How often a row is taken: the epochs, and once more if the sample has it."""
    slice_, key, tie = _slice(F.col("__key")), F.col("__key"), F.col("__tie")
    within = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (tie <= F.col("cut_tie")))
    sampled = (slice_ < F.col("cut_slice")) | ((slice_ == F.col("cut_slice")) & within)
    return F.col("epochs") + F.coalesce(sampled, F.lit(False)).cast("long")


def mix_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    seed: int = SEED,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    `size` is the number of words, `target` the words its source is to give, `taken` the
    words the mix takes of the document: its size times 0, 1 or 2. `weight` is a column
    expression over `docs` above zero (default: `quality_weight`).

    A null text has no words; a null source is a source of its own, the last. Null ids and
    repeated rows are drawn like others; rows equal in id, source and text are taken
    together or not at all. A source without words has target zero. An empty table gives an
    empty result; other columns are not read.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    weight = quality_weight(text_col) if weight is None else weight
    sized = workspace.save(
        docs.select(
            F.col(id_col).alias("doc_id"),
            *_sized(docs, id_col, text_col, source_col, weight, seed),
        ).withColumn("source_place", _source_place(F.col("__source"))),
        "sized",
    )
    plan = _plan(sized, workspace)
    return look_up(sized, plan, ["source_place"], BROADCAST_BYTES).select(
        "doc_id",
        F.col("__size").alias("size"),
        "source_size",
        "target",
        (F.col("__size") * _times()).alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    seed: int = SEED,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The rows of `docs`, with all their columns, each as often as `mix_report` takes it.

    Rows without words are taken as often as their source has whole epochs, and once more
    if the sample has them.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    weight = quality_weight(text_col) if weight is None else weight
    drawn = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        *_sized(docs, id_col, text_col, source_col, weight, seed),
    ).withColumn("source_place", _source_place(F.col("__source")))
    sized = workspace.save(drawn.drop("row"), "sized")
    plan = _plan(sized, workspace)
    times = look_up(drawn, plan, ["source_place"], BROADCAST_BYTES).withColumn("times", _times())
    copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    return (
        times.filter("times > 0")
        .select("row", copies)
        .select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
    )


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_report(table(spark, folder, "documents"))
