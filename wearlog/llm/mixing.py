"""Mixing sources to target weights by entropy balancing.

Targets: the sources, in code-point order (null last), weigh 1, 2, 3, 1, 2, 3,
... and share all words; a target stops at three times its source's words and
the excess goes to the others by weight.

Rates: per source, the document rates w that differ least in relative entropy
from 1 (sum of w ln w - w + 1) subject to sum(w * size) = target and w <= 3 are
w = min(3, exp(lambda * size / mean size)). The multiplier solves a convex dual
in one variable: safeguarded Newton iterations for all sources at once, each one
aggregate over the (source, size) histogram, which is exact and far smaller than
the documents.

Copies: the whole part of the rate, and one more where the running sum of the
fractional parts, over the source's documents by size, passes a whole number.
So the words taken differ from the target by about one document; two rounds
then add or take back the one copy that fits the rest best.

Null text and text without words have size 0 and are taken with 0 words. Null
ids, repeated ids and repeated rows are documents of their own. No document
gives more than three times its words. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlog.session import materialize

MOST = 3
ROUNDS = 48
CLOSE = 1e-6
PARTS = 256


def n_words(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; null has none."""
    blank = r"[\x20\x09-\x0D]+"
    one = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    line = F.regexp_replace(one, blank, " ")
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) - 1).cast("long")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size) -> also g (the source's number from 0), weight and target."""
    ranked = sources.withColumn("g", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", (F.col("g") % 3 + 1).cast("double")).withColumn("top", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("top") / F.col("weight"), "g")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    share = ranked.withColumn("level", level)
    # the first source in this order that its share leaves under its top fixes the share of all that follow
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("top"), F.struct(F.col("top") / F.col("weight"), F.col("g"), F.col("level")))).over(every)
    return share.withColumn("level", fits["level"]).withColumn("target", F.least(F.col("top"), F.coalesce(F.col("level") * F.col("weight"), F.col("top")))).drop("top", "level")


def multipliers(hist: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """Newton iterations on the dual: (g, mean, lam) for every source with words."""
    sums = hist.groupBy("g").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    reach = F.col("mean") / F.col("least")
    state = goals.where("source_size > 0").join(sums, "g").select(
        "g", "target", "mean",
        F.lit(0.0).alias("lam"),
        (F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) * reach).alias("low"),
        (F.log(F.lit(float(most))) * reach).alias("high"),
        F.lit(1.0).alias("miss"),
    )
    state = materialize(state, "mix-state")
    for _ in range(ROUNDS):
        raw = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))
        words = F.col("n") * F.col("size") * F.least(raw, F.lit(float(most)))
        slope = F.when(raw < most, F.col("n") * F.col("size") * raw * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = hist.join(state.select("g", "lam", "mean"), "g").groupBy("g").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope"))
        inside = (step > low) & (step < high)
        done = F.abs(gap) <= CLOSE * F.col("target")
        state = materialize(
            state.join(sums, "g").select(
                "g", "target", "mean",
                F.when(done, F.col("lam")).when(inside, step).otherwise((low + high) / 2).alias("lam"),
                low.alias("low"), high.alias("high"),
                (F.abs(gap) / F.col("target")).alias("miss"),
            ),
            "mix-state",
        )
        if not (state.agg(F.max("miss")).first()[0] or 0) > CLOSE:
            break
    return state.select("g", "mean", "lam")


def mix(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    base = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-base")
    goals = materialize(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), most), "mix-goals")
    keyed = base.join(goals.select("g", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    keyed = materialize(keyed.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")), "mix-keyed")
    parts = keyed.groupBy("g", "size", "part").agg(F.count("*").alias("n"))
    hist = materialize(parts.groupBy("g", "size").agg(F.sum("n").alias("n")).where("size > 0"), "mix-hist")
    lam = multipliers(hist, goals, most)

    # rate of each (source, size), and the running sum of fractional parts before it
    full = F.col("target") >= most * F.col("source_size")
    rate = F.when(full, float(most)).otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    frac = F.col("rate") - F.floor("rate")
    earlier = Window.partitionBy("g").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    classes = (
        hist.join(goals, "g").join(lam, "g", "left").withColumn("rate", rate).withColumn("frac", frac)
        .withColumn("ahead", F.coalesce(F.sum(F.col("n") * F.col("frac")).over(earlier), F.lit(0.0)))
        .select("g", "size", "rate", "frac", "ahead")
    )
    # a document's place in its class: places before its part, and its place there
    upto = Window.partitionBy("g", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.where("size > 0").withColumn("shift", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
    inside = Window.partitionBy("g", "size", "part").orderBy(F.xxhash64("doc_id"), "doc_id")
    placed = (
        keyed.withColumn("place", F.row_number().over(inside) - 1)
        .join(shifts, ["g", "size", "part"], "left").join(classes, ["g", "size"], "left")
        .withColumn("place", F.col("place") + F.coalesce("shift", F.lit(0)))
    )
    at = F.col("ahead") + F.col("place") * F.col("frac") + 0.5
    extra = F.floor(at + F.col("frac")) - F.floor(at)
    copies = F.least(F.lit(most), F.coalesce(F.floor("rate") + extra, F.lit(0))).cast("int")
    out = materialize(placed.select("doc_id", "g", "size", "part", "place", "rate", copies.alias("copies")), "mix-copies")
    for _ in range(2):
        left = out.groupBy("g").agg(F.sum(F.col("copies") * F.col("size")).alias("got")).join(goals, "g").select("g", (F.col("target") - F.col("got")).alias("rest"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("rest")) & F.when(F.col("rest") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
        pick = F.max(F.when(fits, F.struct("size", "part", "place", F.signum("rest").cast("int").alias("turn")))).alias("pick")
        fixes = out.join(left, "g").groupBy("g").agg(pick).where("pick IS NOT NULL").select("g", "pick.*")
        out = materialize(
            out.join(fixes, ["g", "size", "part", "place"], "left").withColumn("copies", F.col("copies") + F.coalesce("turn", F.lit(0))).drop("turn"),
            "mix-copies",
        )
    return out.join(goals, "g").select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them: each row as often as its copies, all columns.

    Rows that share id, source and size share their copies evenly, earlier ones first.
    """
    keys = ["__mix_id", "__mix_source", "__mix_size"]
    got = mix(docs).groupBy(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size")).agg(
        F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_rows")
    )
    own = docs.withColumn("__mix_n", n_words(F.col("text")))
    match = own["doc_id"].eqNullSafe(got["__mix_id"]) & own["source"].eqNullSafe(got["__mix_source"]) & (own["__mix_n"] == got["__mix_size"])
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("text"))
    times = F.floor(F.col("__mix_copies") / F.col("__mix_rows")) + (nth <= F.col("__mix_copies") % F.col("__mix_rows")).cast("int")
    rows = own.join(got, match).withColumn("__mix_times", times.cast("int")).where("__mix_times > 0")
    return rows.withColumn("__mix_times", F.explode(F.sequence(F.lit(1), F.col("__mix_times")))).select(*docs.columns)
