"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from touchline.llm.common import WORD, stored

# Steps of the selection order to a factor of e: only a step that does not fit whole is ordered row by row. Whatever the
# probabilities, a step holds no more than a 2 048th of the documents that share one, and a source has some thousands.
STEPS = 1 << 9
_CERTAIN = -(1 << 40)


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(docs: DataFrame, weights: Sequence[float], source: str = "source") -> DataFrame:
    """``source``, ``weight``: the sources by code point, null last, take the weights in turn."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row for each source
    rank = (F.row_number().over(order) - 1) % len(weights) + 1
    names = docs.select(F.col(source).cast("string").alias("source")).distinct()
    return names.select("source", F.element_at(F.array(*map(F.lit, weights)), rank).cast("double").alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words each source shall give: ``source``, ``source_size``, ``target``.

    ``share`` times all words are dealt by weight. A target stops at ``most``
    times its source's size and the excess goes to the others by weight, until
    none is above. In order of size per weight the stopped sources come first:
    a source is stopped if what is left after those before it, dealt by weight
    among it and those after it, would reach its limit. Running sums over one
    row per source say so without iterating. A source without a weight gets 0.
    """
    s = sizes.join(weights.select(F.col("source").alias("w_source"), "weight"), F.col("source").eqNullSafe(F.col("w_source")), "left")
    s = s.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by = Window.orderBy(F.when(F.col("weight") > 0, F.col("limit") / F.col("weight")).asc_nulls_last(), F.col("source").asc_nulls_first())
    before, rest = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    s = s.withColumn("per_weight", left / F.nullif(F.sum("weight").over(rest), F.lit(0.0)))
    s = s.withColumn("stopped", (F.col("weight") > 0) & (F.col("weight") * F.col("per_weight") >= F.col("limit")))
    # after the first source that is not stopped the quotient only falls, so the largest is the level of all of them
    s = s.withColumn("level", F.max(F.when(~F.col("stopped") & (F.col("weight") > 0), F.col("per_weight"))).over(every))
    target = F.when(F.col("stopped"), F.col("limit")).otherwise(F.coalesce(F.col("weight") * F.col("level"), F.lit(0.0)))
    return s.select("source", "source_size", F.least(target, F.col("limit")).alias("target"))


def _per_source(df: DataFrame, few: int = 100_000) -> DataFrame:
    """A table of one row per source: broadcast up to a checked number of rows, joined by Spark's choice beyond."""
    return F.broadcast(df) if df.limit(few + 1).count() <= few else df


def _with(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    return rows.join(per_source.withColumnRenamed("source", "p_source"), F.col("m_source").eqNullSafe(F.col("p_source")), "left").drop("p_source")


def size_class(size: Column) -> Column:
    """Documents of one class are equally likely: the binary digits of their number of words."""
    return F.length(F.bin(size))


def levels(classes: DataFrame) -> DataFrame:
    """``source``, ``level``: what makes the probabilities add up to the words that are missing.

    ``classes`` has the ``words`` of each ``size_class`` of a source and what is
    ``missing``. A document's inclusion probability is its class times the level
    and at most 1, so longer documents are likelier, and the expected words are
    those missing. As for :func:`targets`, the classes that reach 1 come first in
    order, and running sums over the classes of a source, some dozens, tell them.
    """
    by = Window.partitionBy("source").orderBy(F.desc("size_class"))
    before, rest = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("missing") - F.coalesce(F.sum("words").over(before), F.lit(0))
    weighed = F.nullif(F.sum(F.col("size_class") * F.col("words")).over(rest), F.lit(0))
    found = classes.withColumn("level", left / weighed)
    # after the classes that are certain the quotient only falls
    return found.filter(F.col("size_class") * F.col("level") < 1).groupBy(F.col("source").alias("l_source")).agg(F.max("level").alias("level"))


def _ranked(rows: DataFrame) -> DataFrame:
    """The Pareto order: ``p`` of each row, ``m_key`` sorts the rows of a source, ``m_step`` is a coarse, monotone form of it.

    The rank is the logarithm of the odds of the uniform number over the odds of p.
    """
    rows = rows.withColumn("p", F.least(F.lit(1.0), F.col("level") * size_class(F.col("m_one"))))
    odds = F.log(F.col("m_u") / (1 - F.col("m_u"))) - F.log(F.col("p") / F.nullif(1 - F.col("p"), F.lit(0.0)))
    rank = F.when(F.col("p") >= 1, F.lit(float(_CERTAIN))).otherwise(odds)
    return rows.withColumn("m_key", F.struct(rank.alias("rank"), "m_id", "m_tie")).withColumn(
        "m_step", F.when(F.col("p") >= 1, F.lit(_CERTAIN)).otherwise(F.floor(rank * STEPS)))


def _cut(rows: DataFrame, room: str) -> DataFrame:
    """How many documents of each source fit into its ``room`` in their order: ``source``, ``step``, ``cut``, ``taken``.

    They are those of a step before ``step`` and those up to the key ``cut``, and
    have ``taken`` words; ``step`` is null if all fit. Words are summed by step,
    and only the step that does not fit whole is sorted.
    """
    steps = rows.groupBy("m_source", "m_step").agg(F.sum("m_size").alias("words"), F.max(room).alias("room"))
    upto = Window.partitionBy("m_source").orderBy("m_step").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # steps, not documents
    steps = steps.withColumn("upto", F.sum("words").over(upto))
    fits = F.coalesce(F.col("upto") <= F.col("room"), F.lit(True))
    last = stored(steps.groupBy(F.col("m_source").alias("source")).agg(
        F.min(F.when(~fits, F.col("m_step"))).alias("c_step"), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("before")), "steps")

    inside = _with(rows, _per_source(last)).filter(F.col("m_step") == F.col("c_step"))
    by = Window.partitionBy("m_source").orderBy("m_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one step of a source
    inside = inside.withColumn("upto", F.col("before") + F.sum("m_size").over(by)).filter(F.col("upto") <= F.col(room))
    cut = inside.groupBy(F.col("m_source").alias("k_source")).agg(F.max("m_key").alias("cut"), F.max("upto").alias("upto"))
    out = last.join(cut, F.col("source").eqNullSafe(F.col("k_source")), "left")
    return stored(out.select("source", F.col("c_step").alias("step"), "cut", F.coalesce("upto", "before").alias("taken")), "cut")


def _fill_type(cut: DataFrame) -> StructType:
    return StructType([StructField("room", DoubleType()), StructField("step", cut.schema["step"].dataType), StructField("cut", cut.schema["cut"].dataType)])


def pareto_mix(docs: DataFrame, weights: DataFrame, share: float = 1.5, most: float = 2.0, seed: int = 17,
               text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    Of every document of a source the whole part of target / source_size copies
    is certain. The rest is a fixed-size sample with unequal probabilities: a
    document's is in proportion to its size class, up to 1, and the expected
    words are those still missing (:func:`levels`). Pareto order sampling (Rosén
    1997) ranks the documents by the odds of a uniform number U, taken from a
    hash of id and text, over the odds of p, and takes the first. The fixed size is in
    words: documents are taken while they fit what whole copies leave of the
    target. Where the next one is too long, those of at most half of what is
    missing follow, in the same order while they fit. That leaves less than half
    missing, or no such document, and is repeated until there is none; then the
    one whose size comes nearest to what is missing joins them or takes the place
    of all that filled the gap, if that meets the target better. So a source
    misses its target by at most half of the shortest document that the filling
    leaves.

    Null texts have size 0 and are drawn like others; null sources are a source
    of their own; a source without words or weight gives no copies. Rows with
    equal id and text are drawn together. An empty table gives an empty one.
    Columns of ``docs`` with the names of the new ones are replaced. Reruns
    agree, as nothing but ids, texts and sizes decides. A hot source is not
    gathered: words are summed by step of the order, and only the one step in
    which a source reaches its target or fills a gap is sorted row by row; a
    source that needs no sample is not ranked at all. No text is shuffled.
    """
    drawn = F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text)), F.lit(seed))
    u = (F.shiftrightunsigned(drawn, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    d = docs.select(
        F.struct(*kept).alias("m_row"), size_in_words(F.col(text)).alias("m_one"), F.col(source).cast("string").alias("m_source"),
        u.alias("m_u"), F.col(doc_id).alias("m_id"), F.xxhash64(F.col(text), F.lit(seed)).alias("m_tie"))
    slim = stored(d.groupBy("m_source", "m_u", "m_id", "m_tie").agg(F.sum("m_one").alias("m_size"), F.max("m_one").alias("m_one")), "sizes")  # equal rows together
    goal = targets(slim.groupBy(F.col("m_source").alias("source")).agg(F.sum("m_size").alias("source_size")), weights, share, most)
    ratio = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    goal = goal.withColumn("whole", F.floor(ratio))
    goal = stored(goal.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    by_class = slim.groupBy("m_source", size_class(F.col("m_one")).alias("size_class")).agg(F.sum("m_size").alias("words"))
    by_class = _with(by_class, _per_source(goal)).withColumnRenamed("m_source", "source")
    goal = goal.join(levels(by_class.filter("missing > 0")), F.col("source").eqNullSafe(F.col("l_source")), "left").drop("l_source")
    goal = stored(goal.withColumn("level", F.coalesce("level", F.lit(0.0))), "levels")

    first = _cut(_ranked(_with(slim, _per_source(goal.filter("level > 0"))).filter("level > 0")), "missing")
    plan = goal.join(first.withColumnRenamed("source", "c_source"), F.col("source").eqNullSafe(F.col("c_source")), "left")
    gap = F.when(F.col("step").isNull(), F.lit(0.0)).otherwise(F.col("missing") - F.col("taken"))
    plan = stored(plan.select("source", "source_size", "target", "whole", "level", "step", "cut", gap.alias("gap"), gap.alias("left"),
                              F.array().cast(ArrayType(_fill_type(first))).alias("fills")), "cuts")

    chosen = F.when(F.col("step").isNull(), F.col("level") > 0).otherwise(
        (F.col("m_step") < F.col("step")) | F.coalesce(F.col("m_key") <= F.col("cut"), F.lit(False)))
    filler = F.exists("fills", lambda f: (F.col("m_one") > 0) & (2 * F.col("m_one") <= f["room"]) & (
        f["step"].isNull() | (F.col("m_step") < f["step"]) | F.coalesce(F.col("m_key") <= f["cut"], F.lit(False))))
    while True:
        short = _ranked(_with(slim, _per_source(plan.filter((F.col("left") > 0) & (F.col("level") > 0)))).filter("left is not null"))
        short = short.filter(~chosen & ~filler & (F.col("m_one") > 0) & (2 * F.col("m_one") <= F.col("left")))
        fill = _cut(short.select("m_source", "m_step", "m_key", "m_size", "left"), "left")
        if not fill.count():
            break
        fill = fill.select(F.col("source").alias("f_source"), F.col("taken").alias("f_taken"), F.col("step").alias("f_step"), F.col("cut").alias("f_cut"))
        plan = plan.join(fill, F.col("source").eqNullSafe(F.col("f_source")) & F.col("f_taken").isNotNull(), "left")
        more = F.array(F.struct(F.col("left").alias("room"), F.col("f_step").alias("step"), F.col("f_cut").alias("cut")))
        plan = stored(plan.select(
            "source", "source_size", "target", "whole", "level", "step", "cut", "gap", (F.col("left") - F.coalesce("f_taken", F.lit(0))).alias("left"),
            F.when(F.col("f_taken").isNull(), F.col("fills")).otherwise(F.concat("fills", more)).alias("fills")), "fills")

    # the last document joins those that filled the gap, or takes their place if it meets the target better
    rest = _ranked(_with(slim, _per_source(plan)).filter("level > 0")).filter(~chosen)
    rest = rest.withColumn("way", F.explode(F.array(
        F.struct(F.lit(False).alias("alone"), F.when(~filler, F.abs(F.col("m_size") - F.col("left"))).alias("off")),
        F.struct(F.lit(True).alias("alone"), F.abs(F.col("m_size") - F.col("gap")).alias("off")))))
    rest = rest.filter(F.col("way.off") < F.col("left"))
    close = rest.groupBy(F.col("m_source").alias("source")).agg(F.min_by(
        F.struct(F.col("m_key").alias("key"), F.col("way.alone").alias("alone")), F.struct("way.off", "way.alone", "m_key")).alias("close"))
    plan = stored(plan.join(close.withColumnRenamed("source", "n_source"), F.col("source").eqNullSafe(F.col("n_source")), "left").drop("n_source"), "mix")
    taken = chosen | (filler & ~F.coalesce("close.alone", F.lit(False))) | F.coalesce(F.col("m_key") == F.col("close.key"), F.lit(False))

    out = _ranked(_with(d, _per_source(plan)))
    extra = (F.col("level") > 0) & taken
    return out.select("m_row.*", F.col("m_one").alias("size"), "source_size", "target", (F.col("whole") + extra.cast("bigint")).alias("copies"))
