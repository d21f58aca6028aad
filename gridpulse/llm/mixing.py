"""Mixing sources to target weights by entropy balancing.

Each document starts with rate 1.  Among all rates between 0 and `MOST_COPIES` that give every
source its target number of words, the ones nearest to 1 (least relative entropy) have the form
`min(MOST_COPIES, exp(λ · size / mean size))` with one multiplier per source: the exponential tilt.  The
multipliers solve a convex dual problem; Newton's method does, kept inside a bracket so that the bend where
rates reach their limit cannot throw it off.  An iteration is one aggregation of the
(source, size) histogram, joined with the table of multipliers; documents themselves are read once.

Rates become copies by systematic rounding: along the documents of a source, ordered by size,
an extra copy is dealt whenever the sum of the fractions passes a whole number.  Neighbours have nearly the same size, so a
source misses its target by about one document, which may be a long one.  What it misses is then settled with shorter ones: the largest size that
still fits into the rest flips between its two neighbouring whole numbers of copies, then shorter ones, until nothing fits or `SETTLING` rounds are
over.  A source in which too few short documents can flip keeps the rest of its miss.  Sums are of integers (millionths of a copy, words), so reruns agree.

Scale: equal documents of one source share one histogram row, hence one rate.  The sums run over blocks
of sizes and over hash slots within one size, never over all documents of a source in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.workspace import store

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
TOLERANCE = 1e-7
ITERATIONS = 60
#: Rounds in which sources settle what rounding left; each leaves less than the size it chose.
SETTLING = 6
#: Fractions of a copy are counted in these units.
UNIT = 1_000_000
#: Sizes whose fractions are summed in one window, and hash slots of documents of one size.
SIZE_BLOCK, SLOTS = 1024, 4096


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def targets(sources: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size) plus `target`: the share of all words by weight, none above `most` times its size.

    Sources in code point order, null last, take the weights in turn.  Resharing the excess of capped sources
    by weight until none is above ends at `min(most · size, level · weight)` with one level for all; sorted by
    `most · size / weight`, the level follows from running sums.  One row per source is all this window holds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = reduce(lambda c, k: F.when(turn == k, weights[k]).otherwise(c), range(len(weights)), F.lit(weights[0]))
    named = sources.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(most))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(every) * share - capped) / F.sum("weight").over(after)
    levels = named.withColumn("level", level)
    fits = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(every)
    return levels.select("source", "source_size", F.least("cap", F.coalesce(fits * F.col("weight"), F.col("cap"))).alias("target"))


def multipliers(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, lambda, mean, full) by Newton's method; `full` marks sources whose every document gets all copies.

    histogram: (source, size, n).  goals: (source, source_size, target).  Sources without words have no multiplier.
    """
    sized = histogram.where("size > 0")
    means = sized.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = goals.where("source_size > 0").join(means, goals["source"].eqNullSafe(means["source"])).select(
        goals["source"], "target", "mean", F.col("target") >= MOST_COPIES * F.col("source_size") * (1 - TOLERANCE),
        F.lit(0.0), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(False),
    ).toDF("source", "target", "mean", "full", "lambda", "low", "high", "done").withColumn("done", F.col("full"))
    state = store(state, "mixing_multipliers")
    for _ in range(ITERATIONS):
        if state.where("not done").isEmpty():  # one row per source
            return state
        at = state.where("not done").withColumnRenamed("source", "s")
        rate = F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0)))
        words = F.col("n") * F.col("size")
        sums = (
            sized.join(at, sized["source"].eqNullSafe(at["s"]))
            .groupBy("source")
            .agg(
                F.sum(words * F.least(rate, F.lit(float(MOST_COPIES)))).alias("value"),
                F.sum(F.when(rate < MOST_COPIES, words * rate * F.col("size") / F.col("mean"))).alias("slope"),
            )
            .withColumnRenamed("source", "s")
        )
        miss = F.col("value") - F.col("target")
        done = F.col("done") | F.coalesce(F.abs(miss) <= TOLERANCE * F.col("target"), F.lit(False))
        low = F.when(miss < 0, F.col("lambda")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("lambda")).otherwise(F.col("high"))
        newton = F.col("lambda") - F.try_divide(miss, F.col("slope"))
        inside = (newton > F.coalesce(low, newton - 1)) & (newton < F.coalesce(high, newton + 1)) & (F.abs(newton - F.col("lambda")) <= 4 + F.abs(F.col("lambda")))
        middle = F.coalesce((low + high) / 2, low + 1 + F.abs(low), high - 1 - F.abs(high))
        step = F.when(F.col("miss_known") & ~done, F.when(F.coalesce(inside, F.lit(False)), newton).otherwise(middle)).otherwise(F.col("lambda"))
        joined = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left").withColumn("miss_known", F.col("value").isNotNull())
        state = store(
            joined.select("source", "target", "mean", "full", step.alias("lambda"), low.alias("low"), high.alias("high"), done.alias("done")),
            "mixing_multipliers",
        )
    return state


def _eqs(a: DataFrame, b: DataFrame, *names: str) -> Column:
    return reduce(lambda x, y: x & y, (a[n].eqNullSafe(b[n]) for n in names))


def mix(docs: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies.

    Needs doc_id, text and source.  A null text has no words, a null source is a source, documents without words get no copy.
    Repeated rows are documents of their own; which of several equal ones gets an extra copy is decided by a hash of the id.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = store(sized.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")), "mixing_sizes")
    slots = store(sized.groupBy("source", "size", "slot").agg(F.count("*").alias("n")), "mixing_slots")
    histogram = store(slots.groupBy("source", "size").agg(F.sum("n").alias("n")), "mixing_histogram")
    goals = store(targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), share, weights), "mixing_targets")
    found = multipliers(histogram, goals).select("source", "mean", "full", "lambda")

    rate = F.when(F.col("size") == 0, 0.0).when(F.col("full"), float(MOST_COPIES))
    rate = rate.otherwise(F.least(F.lit(float(MOST_COPIES)), F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    rated = histogram.join(found, _eqs(histogram, found, "source"), "left").select(histogram["source"], "size", "n", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    whole, part = F.floor("rate"), F.floor((F.col("rate") - F.floor("rate")) * UNIT)
    rated = rated.withColumns({"whole": whole, "part": part, "block": F.floor(F.col("size") / SIZE_BLOCK)})

    # units before each block of sizes, then before each size, then before each slot of that size
    blocks = rated.groupBy("source", "block").agg(F.sum(F.col("n") * F.col("part")).alias("units"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "block", F.coalesce(F.sum("units").over(earlier), F.lit(0)).alias("before_block"))
    smaller = Window.partitionBy("source", "block").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.withColumn("before_size", F.coalesce(F.sum(F.col("n") * F.col("part")).over(smaller), F.lit(0)))
    rated = rated.join(blocks, _eqs(rated, blocks, "source", "block")).select(
        rated["source"], "size", "rate", "whole", "part", (F.col("before_block") + F.col("before_size")).alias("before")
    )
    previous = Window.partitionBy("source", "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("docs_before", F.coalesce(F.sum("n").over(previous), F.lit(0)))
    dealt = slots.join(rated, _eqs(slots, rated, "source", "size")).select(
        slots["source"], slots["size"], "slot", "rate", "whole", "part", (F.col("before") + F.col("docs_before") * F.col("part")).alias("before")
    )
    dealt = dealt.join(goals, _eqs(dealt, goals, "source")).select(dealt["*"], "source_size", "target")

    turn = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy("doc_id"))
    ranked = sized.withColumn("turn", turn)
    units = F.col("before") + F.col("turn") * F.col("part") + UNIT // 2
    extra = F.floor(units / UNIT) - F.floor((units - F.col("part")) / UNIT)
    rounded = ranked.join(dealt, _eqs(ranked, dealt, "source", "size", "slot")).select(
        "doc_id", ranked["source"], ranked["size"], ranked["slot"], "source_size", "target", "rate", "whole", extra.alias("extra"), (F.col("part") > 0).alias("free")
    )
    return _settled(store(rounded, "mixing_rounded"))


def _flips(counts: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, size, extra, flips): how many documents of a size give up their extra copy, or get one where `extra` is 0.

    counts: (source, size, extra, n) of the documents that can flip.  goals: (source, miss), words taken above the target.
    """
    rest = goals.select("source", (F.col("miss") > 0).cast("long").alias("extra"), F.floor(F.abs("miss")).alias("rest"))
    rest = rest.withColumn("below", F.col("rest") + 1)  # sizes from here on are settled
    longer = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = None
    for _ in range(SETTLING):
        fits = counts.join(rest, _eqs(counts, rest, "source", "extra")).where((counts["size"] <= F.col("rest")) & (counts["size"] < F.col("below")))
        left = F.col("rest") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(longer), F.lit(0))
        fits = fits.select(counts["source"], counts["extra"], counts["size"], "n", "rest").withColumn("left", left).where("left > 0")
        step = fits.withColumn("flips", F.least(F.col("n"), F.floor(F.col("left") / F.col("size"))))
        step = store(step, "mixing_flips")  # at most a row per source and size
        chosen = step.where("flips > 0").select("source", "size", "extra", "flips")
        found = chosen if found is None else found.unionByName(chosen)
        # the longest size that did not fit with all its documents ends the round; shorter ones wait for the next
        rest = step.groupBy("source", "extra").agg(
            (F.max("rest") - F.sum(F.col("flips") * F.col("size"))).alias("rest"), F.min("size").alias("below")
        )
    return found


def _settled(rounded: DataFrame) -> DataFrame:
    """The rounded mix with the flips that bring each source close to its target.

    Of the documents of one size those in the first hash slots flip, in a slot those with the smallest ids.
    """
    words = F.col("size") * (F.col("whole") + F.col("extra"))
    per_slot = rounded.groupBy("source", "size", "slot", "extra", "free", "target").agg(F.count("*").alias("n"), F.sum(words).alias("words"))
    per_slot = store(per_slot, "mixing_slots")
    goals = per_slot.groupBy("source").agg((F.sum("words") - F.max("target")).alias("miss"))
    can = per_slot.where("free and size > 0")
    flips = _flips(can.groupBy("source", "size", "extra").agg(F.sum("n").alias("n")), goals)

    earlier = Window.partitionBy("source", "size", "extra").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    asked = can.join(flips, _eqs(can, flips, "source", "size", "extra")).select(can["source"], can["size"], can["extra"], "slot", "n", "flips")
    own = F.least(F.col("n"), F.col("flips") - F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    asked = asked.withColumn("own", own).where("own > 0").select("source", "size", "slot", "extra", "own", F.lit(True).alias("free"))

    turn = F.row_number().over(Window.partitionBy("source", "size", "slot", "extra", "free").orderBy("doc_id"))
    ranked = rounded.withColumn("turn", turn)
    both = ranked.join(asked, _eqs(ranked, asked, "source", "size", "slot", "extra", "free"), "left")
    final = F.when(F.col("turn") <= F.col("own"), 1 - ranked["extra"]).otherwise(ranked["extra"])
    return both.select(
        "doc_id", ranked["source"], ranked["size"], "source_size", "target", "rate", (F.col("whole") + final).cast("long").alias("copies")
    )


def mixed_documents(docs: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: every document as often as it is taken, with `size`, `target` and `copy` (1, 2, …) added.

    Input columns of these three names are replaced; all others stay as they are, whatever their names (`_mix_size` and `_mix_nth` are reserved).
    Documents are matched to their copies by (doc_id, source, size); rows equal in all three share their copies evenly by sum.
    """
    columns = [c for c in docs.columns if c not in ("copy", "size", "target")]
    taken = mix(docs, share, weights).withColumnRenamed("size", "_mix_size")
    same = Window.partitionBy("doc_id", "source", "_mix_size")
    taken = taken.withColumn("_mix_nth", F.row_number().over(same.orderBy(F.col("copies").desc()))).select(
        "doc_id", "source", "_mix_size", "_mix_nth", F.col("target").alias("_mix_target"), F.col("copies").alias("_mix_copies")
    )
    rows = docs.select(*columns).withColumn("_mix_size", word_count(F.col("text")))
    rows = rows.withColumn("_mix_nth", F.row_number().over(same.orderBy(F.xxhash64("text"))))
    both = rows.join(taken, _eqs(rows, taken, "doc_id", "source", "_mix_size", "_mix_nth")).where("_mix_copies > 0")
    repeats = F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))).alias("copy")
    return both.select(*[rows[c] for c in columns], rows["_mix_size"].alias("size"), F.col("_mix_target").alias("target"), repeats)
