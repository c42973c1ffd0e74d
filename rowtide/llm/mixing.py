"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each document gets a rate w, the copies it would have in the ideal mix. The rates
are those nearest to one (in relative entropy within [0, ``most``]) that give each
source its target of tokens. Their form is w = most / (1 + (most - 1) exp(-l x)), x
being the document's size over its source's mean: an exponential tilt by size. The
dual is convex with one multiplier l per source; Newton steps solve it over the
table of (source, size, documents), which is what all documents of one source and
size share.

The rates become whole copies in three steps: cumulative rounding along sizes,
longest first (off by at most half a longest document), then up to ``REPAIRS`` single
copies moved where that brings a source nearer to its target, then the copies of a
(source, size) class are dealt to its documents in the order of doc_id within hashed
parts, so that a class of any number of equal documents is ranked by many tasks.

Sums are taken as decimals, so reruns agree whatever the order of partial sums.

Edge cases: a null or blank text has size 0 and takes nothing; a null source is a
source of its own and sorts last; rows with a null or repeated doc_id are documents
like any other; an empty table gives an empty mix. If a source's target is ``most``
times its size, every document of it is taken ``most`` times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import WORD, buckets, key_of, pick
from rowtide.session import materialise

STEPS = 60  # Newton steps at most; the bracket halves at least every other step
CLOSE = 1e-7  # of a source's target
REPAIRS = 8
FILES = 8  # of tables with a row per source


def sized(docs: DataFrame, *carry: str) -> DataFrame:
    """Documents with their size in words; ``carry`` columns travel as one struct ``row``."""
    df = pick(docs, *dict.fromkeys(["doc_id", "source", "text", *carry]))
    size = F.coalesce(F.expr(f"regexp_count(text, r'{WORD}')"), F.lit(0)).cast("long").alias("size")
    extra = [F.struct(*carry).alias("row")] if carry else []
    return df.select("doc_id", "source", key_of("source").alias("key"), size, *extra)


def targets(sources: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Target tokens of each source: shares by weight, filled up to ``most`` times its size.

    With sources ordered by size over weight, the shares that the uncapped ones get
    are known from running sums; the first source that stays below its cap sets the
    level. One row per source goes through the single-task windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    pattern = F.array(*map(F.lit, weights))
    weighed = sources.withColumn(
        "weight", F.element_at(pattern, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.lit(float(most)) * F.col("total"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = weighed.select(
        "*",
        (
            (F.sum("total").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after)
        ).alias("level"),
        F.row_number().over(order).alias("place"),
    )
    free = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("place", "level"))
    return levels.withColumn("level", F.min(free).over(everything)["level"]).select(
        "key", "source", "total", "n", F.least("cap", F.col("weight") * F.col("level")).alias("target")
    )


def _rate(most: int):
    tilted = F.lit(float(most)) / (1 + (most - 1) * F.exp(-F.col("l") * F.col("x")))
    return F.when(F.col("target") >= most * F.col("total"), F.lit(float(most))).otherwise(tilted)


def balance(classes: DataFrame, goal: DataFrame, most: int = 3) -> DataFrame:
    """``goal`` with the multiplier ``l`` of each source, by safeguarded Newton steps on the dual.

    ``classes`` has key, size and n (documents). Each step is one aggregation over the
    classes; only whether all sources are close comes to the driver.
    """
    state = goal.select("*", *[F.lit(v).cast("double").alias(c) for c, v in (("l", 0.0), ("lo", None), ("hi", None))])
    exact = "decimal(38,9)"
    mean = F.col("total") / F.col("n")
    for _ in range(STEPS):
        seen = classes.join(state.withColumnRenamed("n", "docs"), "key").withColumn(
            "x", F.coalesce(F.try_divide(F.col("size") * F.col("docs"), "total"), F.lit(0.0))
        )
        w = _rate(most)
        sums = seen.groupBy("key").agg(
            F.sum((F.col("n") * w * F.col("x")).cast(exact)).cast("double").alias("have"),
            F.sum((F.col("n") * w * (most - w) / most * F.col("x") * F.col("x")).cast(exact)).cast("double").alias("bend"),
        )
        gap = F.col("have") - F.col("want")
        done = (F.abs(gap) <= CLOSE * F.col("want")) | (F.col("target") >= most * F.col("total"))
        judged = state.join(sums, "key").withColumn("want", F.coalesce(F.try_divide("target", mean), F.lit(0.0)))
        judged = judged.withColumn("done", done | (F.col("total") == 0))
        judged = judged.withColumn("hi", F.when(gap > 0, F.col("l")).otherwise(F.col("hi"))).withColumn(
            "lo", F.when(gap <= 0, F.col("l")).otherwise(F.col("lo"))
        )
        step = F.col("l") - gap / F.greatest("bend", F.lit(1e-12))
        inside = (F.col("lo").isNull() | (step > F.col("lo"))) & (F.col("hi").isNull() | (step < F.col("hi")))
        far = 2 * F.greatest(F.lit(1.0), F.abs("l"))
        safe = (
            F.when(inside & (F.abs(step - F.col("l")) <= far), step)
            .when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2)
            .otherwise(F.when(gap > 0, F.col("l") - far).otherwise(F.col("l") + far))
        )
        state = judged.withColumn("l", F.when(F.col("done"), F.col("l")).otherwise(safe))
        # A row per source: few files keep the step as small as its work.
        state = materialise(state.select(*goal.columns, "l", "lo", "hi", "done").coalesce(FILES), "mix-step")
        if state.filter(~F.col("done")).isEmpty():
            break
        state = state.drop("done")
    return state.select(*goal.columns, "l")


def class_copies(classes: DataFrame, balanced: DataFrame, most: int = 3) -> DataFrame:
    """Whole copies of each (source, size) class; a source's classes are its different sizes."""
    seen = classes.join(balanced.withColumnRenamed("n", "docs"), "key").withColumn(
        "x", F.coalesce(F.try_divide(F.col("size") * F.col("docs"), "total"), F.lit(0.0))
    )
    down = Window.partitionBy("key").orderBy(F.desc("size"))
    run = F.round(F.sum(F.col("n") * _rate(most)).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    seen = seen.withColumn("run", run)
    seen = seen.withColumn("copies", (F.col("run") - F.coalesce(F.lag("run").over(down), F.lit(0.0))).cast("long"))
    top = most * F.col("n")
    seen = seen.withColumn("copies", F.greatest(F.lit(0), F.least("copies", top)).cast("long"))
    own = Window.partitionBy("key")
    for _ in range(REPAIRS):
        off = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(own)
        seen = seen.withColumn("off", off)
        more = F.when(F.col("copies") < top, F.struct(F.abs(F.col("off") - F.col("size")).alias("left"), "size", F.lit(1).alias("by")))
        less = F.when(F.col("copies") > 0, F.struct(F.abs(F.col("off") + F.col("size")).alias("left"), "size", F.lit(-1).alias("by")))
        best = F.min(F.least(more, less)).over(own)
        seen = seen.withColumn("best", best)
        move = (F.col("best.left") < F.abs("off") - 1e-6) & (F.col("best.size") == F.col("size"))
        seen = seen.withColumn("copies", F.col("copies") + F.when(move, F.col("best.by")).otherwise(0))
    return seen.select("key", "size", "n", "copies", "target", F.col("total").alias("source_size"))


def mix(docs: DataFrame, *carry: str, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Documents with doc_id, source, size, source_size, target, copies, taken (and ``row``).

    Every document is in the result, also those with no copy.
    """
    small = materialise(sized(docs), "mix-sizes")
    rows = sized(docs, *carry) if carry else small
    classes = materialise(small.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-classes")
    totals = small.groupBy("key").agg(
        F.first("source", ignorenulls=True).alias("source"),
        F.sum("size").cast("double").alias("total"),
        F.count("*").alias("n"),
    )
    goal = materialise(targets(totals, most, weights).coalesce(FILES), "mix-targets")
    dealt = class_copies(classes, balance(classes, goal, most), most)
    parts = buckets(small.count(), 100_000, 1024)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part")
    in_parts = small.groupBy("key", "size", part).agg(F.count("*").alias("in_part"))
    ahead = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = in_parts.select("key", "size", "part", F.coalesce(F.sum("in_part").over(ahead), F.lit(0)).alias("before"))
    places = materialise(places.join(dealt, ["key", "size"]), "mix-places")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("doc_id"))
    whole = F.expr("copies div n")
    ranked = rows.withColumn("part", part).join(places, ["key", "size", "part"])
    return ranked.withColumn("copies", whole + (rank <= F.col("copies") % F.col("n")).cast("long")).select(
        "doc_id",
        "source",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )
