"""Mixing sources to target weights by entropy balancing, in DataFrame operations alone.

Among all document rates r in [0, ``most``] whose words meet every source's target,
sum(r * size) = target, the least tilted from one copy each (minimal relative
entropy) are r = min(most, exp(lambda_s * size / mean size of s)). The multipliers
lambda_s maximise the convex dual; safeguarded Newton steps find them, every source
in the same job. A step needs sums over a source's documents only, and documents of
one source and size weigh alike, so all steps run on the counts per (source, size).

Rates become copies on those counts: walking a source's sizes from the largest down,
whole copies follow the running sum of rates, so words miss the target by less than
one document; then copies of the size that fits best make up the rest, a few times.
The documents of one (source, size) take its copies evenly, in the order of a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import SPACE_WORD, Scratch, packed, same_document

WEIGHTS = (5, 2, 1)
MOST = 3
STEPS = 60  # bound of the Newton steps; ten are usual, halving alone ends before it
NEAR = 1e-6
BUCKETS = 256  # into which the documents of one (source, size) are dealt for ranking


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_hash and size: the words of the text."""
    text = F.col("text").cast("string")
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to source, source_size: weighted shares of all words, none above ``most`` sizes.

    With t words per weight, a source gets min(most * size, t * weight). Sources reach
    their limit in the order of limit / weight; t follows from those that have not.
    ``sources`` has one row per source, few beside the documents.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * float(most))
    whole = W.partitionBy()
    place_by_limit = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = place_by_limit.rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(upto), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    per_weight = rest / open_weight
    # the first source that stays below its limit sets t; all before it are at their limits
    level = F.min(F.when(F.col("limit") > F.col("per") * F.col("weight"), F.struct("at", "per"))).over(whole)
    rows = rows.withColumn("per", per_weight)
    rows = rows.withColumn("at", F.row_number().over(place_by_limit)).withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(
        F.least("limit", F.col("level.per") * F.col("weight"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def _tilt(most: int) -> Column:
    # the exponent is held to what a double can carry; beyond log(most) the limit rules
    return F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), F.col("lam") * F.col("x"))))


def multipliers(cells: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """lam per source id ``s`` from cells (s, n, x, goal), x = size / mean size, goal = target / mean size.

    Every step narrows the interval that holds lam and takes the Newton point if it
    lies inside, else the middle. Only the number of open sources reaches the driver.
    """
    # beyond these ends every document is at the limit, or below what the goal needs
    least, share = F.min("x"), F.max("goal") / F.sum(F.col("n") * F.col("x"))
    state = cells.groupBy("s").agg(
        F.lit(0.0).alias("lam"),
        F.when(share < 1, F.log(share) / least).otherwise(F.lit(0.0)).alias("low"),
        F.when(share > 1, F.log(F.lit(float(most))) / least).otherwise(F.lit(0.0)).alias("high"),
        F.lit(False).alias("done"),
    )
    for _ in range(STEPS):
        rate = _tilt(most)
        slope = F.when(rate < most, rate * F.col("x") * F.col("x")).otherwise(0.0)
        sums = cells.join(state, "s").groupBy("s", "lam", "low", "high", "done").agg(
            F.sum(F.col("n") * F.col("x") * rate).alias("got"),
            F.sum(F.col("n") * slope).alias("slope"),
            F.max("goal").alias("goal"),
        )
        over = F.col("got") > F.col("goal")
        low, high = F.when(over, F.col("low")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - (F.col("got") - F.col("goal")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        done = F.col("done") | (F.abs(F.col("got") - F.col("goal")) <= NEAR * F.col("goal"))
        done = done | (F.col("high") - F.col("low") <= 1e-12 * (1 + F.abs("lam")))
        step = F.when(inside, newton).otherwise((low + high) / 2)
        state, seen = scratch.counted(
            sums.select(
                "s", F.when(done, F.col("lam")).otherwise(step).alias("lam"), low.alias("low"), high.alias("high"), done.alias("done")
            ),
            "newton",
            F.sum((~F.col("done")).cast("long")).alias("open"),
        )
        if not seen["open"]:
            return state.select("s", "lam")
    raise RuntimeError(f"{seen['open']} sources have no multiplier after {STEPS} steps")


def _copies(cells: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """Adds ``k``, the copies of all documents of a cell (s, size, n, rate, target)."""
    down = W.partitionBy("s").orderBy(F.desc("size")).rowsBetween(W.unboundedPreceding, 0)
    run = F.floor(F.sum(F.col("n") * F.col("rate")).over(down) + 0.5)
    rows = cells.withColumn("run", run)
    rows = rows.withColumn("k", F.col("run") - F.coalesce(F.lag("run").over(W.partitionBy("s").orderBy(F.desc("size"))), F.lit(0)))
    rows = scratch(rows.drop("run").withColumn("k", F.greatest(F.lit(0), F.least("k", most * F.col("n"))).cast("long")), "rounded")
    for _ in range(3):  # the one size whose copies make up best for what a source still misses
        miss = rows.groupBy("s").agg((F.max("target") - F.sum(F.col("k") * F.col("size"))).alias("miss"))
        change = F.round(F.col("miss") / F.col("size"))
        change = F.greatest(-F.col("k"), F.least(most * F.col("n") - F.col("k"), change)).cast("long")
        tried = rows.join(miss, "s").withColumn("change", F.when(F.col("size") > 0, change).otherwise(F.lit(0)))
        tried = tried.withColumn("left", F.abs(F.col("miss") - F.col("change") * F.col("size")))
        best = F.min(F.struct("left", "size")).over(W.partitionBy("s"))
        here = best["size"] == F.col("size")
        rows = tried.withColumn("k", F.col("k") + F.when(here, F.col("change")).otherwise(F.lit(0)))
        rows = scratch(rows.drop("miss", "change", "left"), "refined")
    return rows


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, scratch: Scratch | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, text_hash, size, source_size, target, copies, taken.

    Sources stand in code point order, null last, and weigh ``weights`` in turn; a
    source without words has target 0. A null or empty text has size 0 and no copies'
    words (it keeps one copy). Rows with the same doc_id and text are ranked apart by
    nothing: each of them takes what the hash order gives, and their sum is the same
    in every run. No rows give no rows; other columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    rows = scratch(sized(docs), "sizes")
    cells = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    cells = scratch(cells.withColumn("s", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())), "counts")
    per = cells.groupBy("s", "source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs")
    )
    per = scratch(per, "per_source")
    goals = targets(per.select("source", "source_size"), weights, most)
    goals = goals.withColumn("s", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())).drop("source")
    goals = scratch(goals.join(per.select("s", "docs"), "s"), "targets")
    known = cells.select("s", "size", "n").join(goals, "s")
    mean = F.col("source_size") / F.col("docs")
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    tilted = known.where((F.col("size") > 0) & ~full)
    tilted = scratch(tilted.select("s", "n", (F.col("size") / mean).alias("x"), (F.col("target") / mean).alias("goal")), "cells")
    lam = multipliers(tilted, scratch, most)
    rated = known.join(lam, "s", "left").withColumn("x", F.col("size") / mean)
    rate = F.when(F.col("size") == 0, 1.0).when(full, float(most)).otherwise(_tilt(most))
    rated = rated.select("s", "size", "n", rate.alias("rate"), "target", "source_size")
    taken = _copies(rated, scratch, most)

    keyed = rows.withColumn("s", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()))
    order = F.xxhash64("doc_id", "text_hash")
    keyed = keyed.withColumn("order", order).withColumn("bucket", F.pmod(order, F.lit(BUCKETS)).cast("int"))
    sizes = scratch(keyed.groupBy("s", "size", "bucket").agg(F.count(F.lit(1)).alias("m")), "buckets")
    upto = W.partitionBy("s", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select("s", "size", "bucket", F.coalesce(F.sum("m").over(upto), F.lit(0)).alias("base"))
    base = scratch(base.join(taken.drop("rate"), ["s", "size"]), "bases")
    inner = W.partitionBy("s", "size", "bucket").orderBy("order", F.col("doc_id").asc_nulls_last())
    ranked = keyed.withColumn("rank", F.row_number().over(inner) - 1).join(base, ["s", "size", "bucket"])
    more = F.pmod(F.col("k"), F.col("n"))
    copies = F.floor(F.col("k") / F.col("n")) + ((F.col("rank") + F.col("base")) < more).cast("long")
    return ranked.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, scratch: Scratch | None = None) -> DataFrame:
    """The mix itself: ``docs`` with every row as often as it is taken, columns as they are."""
    own = scratch is None
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    taken = mix(docs, weights, scratch=scratch)
    # rows alike in doc_id, text and source are one document: their copies are dealt as one sum
    times = taken.groupBy("doc_id", "text_hash", F.col("source").alias("of")).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")
    )
    times = scratch(times, "copies")
    if own:
        scratch.keep_only(times)
    rows = packed(docs, F.col("source").cast("string").alias("source"))
    rows = rows.join(times, same_document() & F.col("source").eqNullSafe(F.col("of")))
    once = rows.where("rows = 1").select("row", "copies")
    alike = W.partitionBy("id", "hash", "source").orderBy(F.lit(0))
    more = rows.where("rows > 1").withColumn("place", F.row_number().over(alike) - 1)
    share = F.floor(F.col("copies") / F.col("rows")) + (F.col("place") < F.pmod("copies", "rows")).cast("long")
    dealt = once.union(more.select("row", share.alias("copies"))).where("copies > 0")
    return dealt.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
