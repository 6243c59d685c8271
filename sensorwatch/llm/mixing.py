"""Mixing sources to target weights by entropy balancing.

Method: rates r of documents minimise the relative entropy to rate 1 under one
token constraint per source, sum(r * size) = target, and r <= CAP. The solution
is an exponential tilt in the document's size, r = min(CAP, exp(t * z)) with z
the size over its source's mean, where t solves the convex dual. Newton
iterations solve it for all sources at once; each one is a distributed
aggregation over the histogram of (source, size), which holds all that the dual
needs, is made once by partial sums, and is much smaller than the documents. A
bracket guards each step, so the iteration cannot run away.

Rates become copies: the whole part, plus one where a hash of the document's
id and size falls under the fractional part, shifted by one number per source
so that the source's taken words come nearest its target. That number is found
by two histogram passes and a last ordering of the few documents in one of 2^24
slots, so no source is gathered in a task.

Contract: null text has no words; null source is a source of its own; a source
without words has target 0; documents without words keep rate 1; repeated rows
are documents of their own (with equal hashes); an empty table gives an empty
result; reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import free_name, join_small, materialize, quoted, read_table, text_column

#: Repeating weights of the sources in code point order.
WEIGHTS = (1.0, 2.0, 3.0)
#: A source's target is at most this many times its size; so are a document's copies.
CAP = 3
#: Newton steps; the bracket at least halves each second step, and the loop ends when all targets are met.
MAX_STEPS = 60
TOLERANCE = 1e-7
#: A tilt beyond this in size caps (or drops) everything with a word.
_FAR = 60.0
_SLOT_BITS = 12
#: Rounds in which the rest of a source's target is filled with documents that fit in it.
FILL_ROUNDS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, share: float = 1.0) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    ``share`` of all words goes out by weight; a target stops at ``cap`` times
    its source's size and the rest is shared again by weight. In order of
    ``cap * size / weight`` the sources below the common level are the full ones.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * float(cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), "source")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    full_before, weight_before = (F.coalesce(F.sum(c).over(upto), F.lit(0.0)) for c in ("most", "weight"))
    rest = F.sum("source_size").over(everything) * float(share) - full_before
    level = rest / (F.sum("weight").over(everything) - weight_before)
    per = per.withColumn("level", F.when(F.col("most") > F.col("weight") * level, level))  # null: a full source
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    common = F.first("level", ignorenulls=True).over(whole)  # of the first source that is not full
    target = F.coalesce(F.least("most", F.col("weight") * common), F.col("most"))
    return per.select("source", "source_size", target.alias("target"))


def _rate(tilt: Column, z: Column, cap: float) -> Column:
    """min(cap, exp(tilt * z)); a document without words has rate 1."""
    return F.when(z <= 0, F.lit(1.0)).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(tilt * z, F.lit(700.0)))))


def balance(sizes: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """One row per source: ``source_size``, ``target``, the mean size of its documents with words, and the ``tilt``."""
    hist = materialize(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    means = hist.groupBy(F.col("source").alias("_s")).agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = goals.join(means, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    full = F.col("target") >= F.lit(float(cap) * (1 - 1e-12)) * F.col("source_size")
    # full sources take everything cap times; tilt 0 is the start of the others
    state = state.withColumns(
        {
            "open": (F.col("source_size") > 0) & ~full,
            "tilt": F.when(full, F.lit(1e300)).otherwise(F.lit(0.0)),
            "low": F.lit(-_FAR),
            "high": F.lit(_FAR),
        }
    )
    state = materialize(state, "mix-state")
    for _ in range(MAX_STEPS):
        if not state.where("open").limit(1).count():
            break
        step = state.where("open").select(F.col("source").alias("_s"), "tilt", "mean")
        joined = join_small(hist, step.withColumnRenamed("_s", "source"), ["source"], "inner")
        z = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.col("tilt") * z, F.lit(700.0)))
        below = raw < float(cap)
        words = F.col("n") * F.col("size")
        taken = F.sum(words * F.least(raw, F.lit(float(cap))))
        slope = F.sum(F.when(below, words * z * raw).otherwise(0.0))
        sums = joined.groupBy(F.col("source").alias("_s")).agg(taken.alias("taken"), slope.alias("slope"))
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        over = F.col("taken") > F.col("target")
        moved = moved.withColumns(
            {
                "high": F.when(F.col("open") & over, F.col("tilt")).otherwise(F.col("high")),
                "low": F.when(F.col("open") & ~over, F.col("tilt")).otherwise(F.col("low")),
                "met": F.abs(F.col("taken") - F.col("target")) <= F.lit(TOLERANCE) * F.col("target") + 1e-6,
            }
        )
        newton = F.col("tilt") + F.when(F.col("slope") > 0, (F.col("target") - F.col("taken")) / F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        following = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        open_next = F.col("open") & ~F.coalesce(F.col("met"), F.lit(True)) & (F.col("high") - F.col("low") > 1e-13)
        state = moved.select(
            "source", "source_size", "target", "mean", open_next.alias("open"),
            F.when(open_next, following).otherwise(F.col("tilt")).alias("tilt"), "low", "high",
        )
        state = materialize(state, "mix-state")
    # sums of doubles may differ in their last bits between runs; the rounded tilt does not
    tilt = F.when(F.abs("tilt") < 1e6, F.round("tilt", 9)).otherwise(F.col("tilt"))
    return state.select("source", "source_size", "target", "mean", tilt.alias("tilt"))


def _nearest(candidates: DataFrame, goals: DataFrame, over: bool) -> DataFrame:
    """Per source the lowest key that is taken: the words from there up reach the goal, or with ``over`` come nearest.

    ``candidates``: source, key (integer below 2^24 slots of 2^30 values), size.
    Two histograms narrow the place down, then the slot's documents are ordered.
    """
    wide, narrow = 1 << (2 * _SLOT_BITS + 6), 1 << (_SLOT_BITS + 6)
    found = goals.withColumnRenamed("source", "_s").withColumn("base", F.lit(0).cast("long"))
    bits = [(wide, 1 << (_SLOT_BITS + 6)), (narrow, 1 << 6)]
    rows = candidates
    for _, width in bits:
        slot = F.floor(F.col("key") / width)
        sums = rows.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("size"))
        before = Window.partitionBy("source").orderBy(F.col("slot").desc()).rowsBetween(Window.unboundedPreceding, -1)
        run = sums.withColumn("above", F.coalesce(F.sum("size").over(before), F.lit(0)))
        run = run.join(found, F.col("source").eqNullSafe(F.col("_s"))).where(
            (F.col("above") < F.col("goal")) & (F.col("above") + F.col("size") >= F.col("goal"))
        )
        at = run.select(
            F.col("source").alias("_s"), (F.col("goal") - F.col("above")).alias("goal"), F.col("slot").alias("_slot")
        )
        found = materialize(at, "mix-slot")
        small = found.select(F.col("_s").alias("source"), "_slot")
        rows = join_small(rows, small, ["source"], "inner").where(slot == F.col("_slot")).drop("_slot")
    # the last slot: 1 / 2^24 of a source's documents, in order of the key
    here = rows.groupBy("source", "key").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("source").orderBy(F.col("key").desc()).rowsBetween(Window.unboundedPreceding, -1)
    here = here.withColumn("above", F.coalesce(F.sum("size").over(before), F.lit(0)))
    here = here.join(found.select("_s", "goal"), F.col("source").eqNullSafe(F.col("_s")))
    reach = here.where(F.col("above") < F.col("goal"))
    # taking this key overshoots by (above + size - goal), leaving it out falls short by (goal - above)
    beyond = F.col("above") + F.col("size") - F.col("goal")
    take = beyond <= (F.col("goal") - F.col("above") if over else F.lit(0.0))
    cut = F.when(take, F.col("key")).otherwise(F.col("key") + 1)
    return reach.groupBy("source").agg(F.min(cut).alias("cut"))


def copies(sizes: DataFrame, solved: DataFrame, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, size, unit: a hash in [0, 1)) with ``source_size``, ``target``, ``rate`` and whole ``copies``."""
    rated = join_small(sizes, solved, ["source"])
    rate = _rate(F.col("tilt"), F.col("size") / F.col("mean"), cap)
    rated = rated.withColumn("rate", F.coalesce(rate, F.lit(1.0))).drop("tilt", "mean")
    rated = rated.withColumn("whole", F.floor("rate").cast("int"))
    # higher keys are taken first; 2^30 values over (-1, 1)
    lead = F.col("rate") - F.col("whole") - F.col("unit")
    rated = rated.withColumn("key", F.floor((lead + 1) * (1 << 29)).cast("long"))
    rated = materialize(rated, "mix-rates")
    per = rated.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"), F.first("target").alias("target"))
    goals = materialize(per.select("source", (F.col("target") - F.col("sure")).alias("goal")), "mix-goals")
    # without words a document adds nothing to the sums: rate 1, one copy
    spare = (F.col("whole") < cap) & (F.col("size") > 0)
    pool, final, more = rated.where(spare).select("source", "key", "size"), rated, F.lit(False)
    for k in range(FILL_ROUNDS):
        ends = _cuts(pool, goals, last=k == FILL_ROUNDS - 1)
        small = ends.select("source", F.col("cut").alias(f"cut{k}"), F.col("goal").alias(f"goal{k}"))
        final = join_small(final, small, ["source"])
        fits = F.lit(True) if k == 0 else F.col("size") <= F.col(f"goal{k}")
        more = more | (spare & fits & (F.col("key") >= F.col(f"cut{k}")))
        if k < FILL_ROUNDS - 1:  # what is left to fill, and the documents that fit in
            done = join_small(pool, ends.select("source", "cut"), ["source"])
            got = done.where(F.col("key") >= F.col("cut")).groupBy(F.col("source").alias("_g")).agg(F.sum("size").alias("got"))
            goals = goals.join(got, F.col("source").eqNullSafe(F.col("_g")), "left").drop("_g")
            goals = materialize(goals.select("source", (F.col("goal") - F.coalesce("got", F.lit(0))).alias("goal")), "mix-goals")
            left = done.where(F.col("key") < F.col("cut")).drop("cut")
            pool = join_small(left, goals, ["source"]).where(F.col("size") <= F.col("goal")).drop("goal")
    extra = [f"{c}{k}" for k in range(FILL_ROUNDS) for c in ("cut", "goal")]
    return final.withColumn("copies", F.col("whole") + more.cast("int")).drop("whole", "key", *extra)


def _cuts(pool: DataFrame, goals: DataFrame, last: bool) -> DataFrame:
    """Per source of ``goals``: the key from which on documents of the pool are taken, and the goal itself."""
    # a source whose sure copies reach the target takes no more; one whose goal is beyond all candidates takes all
    room = pool.groupBy(F.col("source").alias("_r")).agg(F.sum("size").alias("room"))
    goals = goals.join(room, F.col("source").eqNullSafe(F.col("_r")), "left").drop("_r")
    goals = materialize(goals.withColumn("room", F.coalesce("room", F.lit(0))), "mix-room")
    inner = goals.where((F.col("goal") > 0) & (F.col("goal") <= F.col("room"))).select("source", "goal")
    cuts = _nearest(pool, inner, last).withColumnRenamed("source", "_c")
    ends = goals.join(cuts, F.col("source").eqNullSafe(F.col("_c")), "left").drop("_c")
    none, everything = F.lit(1 << 31).cast("long"), F.lit(-1).cast("long")
    cut = F.when(F.col("goal") <= 0, none).when(F.col("goal") > F.col("room"), everything)
    return materialize(ends.select("source", "goal", cut.otherwise(F.coalesce("cut", none)).alias("cut")), "mix-cuts")


def unit_hash(*values: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *values), F.lit(1 << 52)).cast("double") / float(1 << 52)


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``.

    The text is read once; what follows works on these few columns.
    """
    size = word_count(text_column(text))
    sizes = docs.select(
        quoted(doc_id).alias("_id"), F.xxhash64(text_column(text)).alias("_hash"), quoted(source).alias("source"), size.alias("size")
    )
    sizes = materialize(sizes.withColumn("unit", unit_hash(F.col("_id"), F.col("size"))), "mix-sizes")
    goals = materialize(targets(sizes), "mix-targets")
    return copies(sizes, balance(sizes, goals)).drop("unit")


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed documents: each as often as it is taken, columns unchanged.

    Documents of one id and text have one number of copies, as their hash is the same.
    """
    mixed = mix(docs, doc_id, source, text)
    found = materialize(mixed.groupBy("_id", "_hash", "source").agg(F.max("copies").alias("copies")), "mix-copies")
    i, h, n = (free_name(docs.columns, x) for x in ("_mix_id", "_mix_hash", "_mix_copies"))
    small = found.select(
        F.col("_id").alias("_i"), F.col("_hash").alias("_h"), F.col("source").alias("_s"), F.col("copies").alias(n)
    )
    keyed = docs.withColumns({i: quoted(doc_id), h: F.xxhash64(text_column(text))})
    match = quoted(i).eqNullSafe(F.col("_i")) & (quoted(h) == F.col("_h")) & quoted(source).eqNullSafe(F.col("_s"))
    joined = keyed.join(small, match)
    times = F.explode(F.array_repeat(F.lit(1), F.col(n)))
    return joined.where(F.col(n) > 0).select(*map(quoted, docs.columns), times.alias("_time")).drop("_time")


def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``."""
    mixed = mix(read_table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return mixed.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", taken, "rate", "copies")
