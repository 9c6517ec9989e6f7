"""Operator 3: mixing sources to target weights by entropy balancing (built-in functions only).

Targets. Sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share ``share`` times all words. A target stops at ``max_rate`` times its
source's words; the excess is reshared by weight until none is above. That is
a water level: target = min(cap, weight * level), found with one running sum
over the sources sorted by cap / weight.

Rates. For every source the rates r_d (repeats of document d) closest to 1 in
relative entropy with 0 <= r_d <= max_rate and sum(size_d * r_d) = target are
r_d = min(max_rate, exp(lambda * z_d)), z_d = size_d over the source's mean
size. lambda minimises a convex dual whose gradient and curvature are sums over the documents.
Newton steps (kept inside a bracket by bisection) run on one
row per (source, size), which is exact because equal sizes have equal rates.

Copies. With v_d a hash of doc_id in [0, 1), the j-th copy of d (j up to
max_rate) stands at b = j - r_d - v_d. Copies that are not larger than the
target are taken by rising b, up to the one that crosses it. What remains is
filled from the copies left over, the largest first, each if it still fits.
Both orders are walked in the same way: words are summed per source in ``BINS``
bins, again inside the bin that crosses the need, and so on until one place is
left, which is set aside. The fill goes on behind that place with the words
still needed, less than half of them each time, until no copy fits. All sums
are integers, so reruns agree.

Defined cases: null and empty texts have size 0 and take nothing; a null
doc_id has a fixed hash; repeated rows share one decision; an empty table
gives an empty result; extra columns are kept by ``mix_rows`` and ignored by
``mix``. A source made of one document can only take it 0, 1 or 2 times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import bounded_broadcast, text_of, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_RATE = 2
BINS = 4096
STEPS_PER_JOB, MAX_JOBS, TOLERANCE, DIGITS = 4, 50, 1e-9, 10


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def source_targets(hist: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_rate: int = MAX_RATE) -> DataFrame:
    """One row per source: sid (rank), source, source_size, mean size, smallest positive size, target."""
    s = hist.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    s = s.withColumn("sid", F.row_number().over(rank) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (F.col("sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * float(max_rate))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    s = (s.withColumn("budget", F.sum("source_size").over(whole) * float(share))
         .withColumn("caps_before", F.sum("cap").over(by_ratio) - F.col("cap"))
         .withColumn("weights_left", F.sum("weight").over(whole) - F.sum("weight").over(by_ratio) + F.col("weight")))
    # the level if exactly the earlier sources (smaller cap / weight) were full: full sources stay below it
    s = s.withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weights_left"))
    s = s.withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    first_open = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(whole)
    s = s.withColumn("level", F.coalesce(first_open["level"], F.lit(0.0)))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("level"))
    return s.select("sid", "source", "source_size", (F.col("source_size") / F.col("docs")).alias("mean"),
                    F.col("full"), target.alias("target"))


def _rate(lam: Column, size: Column, mean: Column, max_rate: int) -> Column:
    x = lam * size / mean
    return F.when(x >= F.log(F.lit(float(max_rate))), F.lit(float(max_rate))).otherwise(F.exp(x))


def solve_rates(hist: DataFrame, targets: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """(sid, lambda) by safeguarded Newton steps; every step is one aggregation over (source, size) rows.

    Steps end when every source meets its target or its bracket is narrower than the digits kept; a
    source that does neither within MAX_JOBS rounds raises.
    """
    log_cap = F.log(F.lit(float(max_rate)))
    open_ = targets.filter(~F.col("full") & (F.col("source_size") > 0) & (F.col("target") > 0))
    # at lo nearly nothing is taken, at hi every document is at the cap (sizes are whole numbers)
    state = open_.select("sid", "source", "mean", "target", F.lit(0.0).alias("lam"), F.lit(-1e9).alias("lo"),
                         (log_cap * F.col("mean")).alias("hi"), F.lit(1.0).alias("gap"))
    h = hist.filter(F.col("size") > 0)
    for _ in range(MAX_JOBS):
        for _ in range(STEPS_PER_JOB):
            t = h.withColumnRenamed("source", "_s").join(state, F.col("_s").eqNullSafe(F.col("source")))
            r = _rate(F.col("lam"), F.col("size"), F.col("mean"), max_rate)
            words = F.col("size") * F.col("n")
            sums = t.groupBy("sid").agg(
                *[F.first(c).alias(c) for c in ("source", "mean", "target", "lam", "lo", "hi")],
                F.sum(words * r).alias("f"),
                F.sum(F.when(r < max_rate, words * r * F.col("size") / F.col("mean")).otherwise(0.0)).alias("df"))
            over = F.col("f") - F.col("target")
            sums = sums.withColumn("hi", F.when(over > 0, F.col("lam")).otherwise(F.col("hi")))
            sums = sums.withColumn("lo", F.when(over <= 0, F.col("lam")).otherwise(F.col("lo")))
            step = F.col("lam") - over / F.when(F.col("df") > 0, F.col("df"))
            inside = (step > F.col("lo")) & (step < F.col("hi"))
            # without a usable Newton step: halve the bracket, or double the distance while its low end is open
            fallback = F.when(F.col("lo") <= -1e9, F.least(F.col("hi") * 2, F.col("hi") - 1)).otherwise(
                (F.col("lo") + F.col("hi")) / 2)
            state = sums.select("sid", "source", "mean", "target", F.when(inside, step).otherwise(fallback).alias("lam"),
                                "lo", "hi", F.abs(over / F.col("target")).alias("gap"))
        state = written(state, "mix-dual")
        narrow = F.col("hi") - F.col("lo") <= 10.0 ** -DIGITS
        if state.filter(~((F.col("gap") < TOLERANCE) | narrow)).isEmpty():
            return state.select("sid", F.round("lam", DIGITS).alias("lam"))
    raise RuntimeError(f"rates of some sources miss their targets after {MAX_JOBS * STEPS_PER_JOB} steps")


def _hash01(doc_id: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("mix")), 11) / F.lit(float(1 << 53))


def _place(j: int) -> Column:
    return F.lit(j) - F.col("rate") - F.col("v")


def _fill_place(j: int, mass: Column, max_rate: int) -> Column:
    """The largest mass first, then by copy and hash."""
    return (F.col("v") + F.lit(j - 1)) / F.lit(max_rate) - mass


def _crossing(points: DataFrame, ahead: DataFrame) -> DataFrame:
    """Per source: first and last place of the first bin whose cumulative words exceed the need, and the need before it.

    ``points`` (sid, mass, at), ``ahead`` (sid, limit, after, low, high, need). Without such a bin all is
    taken and low and high are null; sources without points ahead have no row.
    """
    at, low, high = F.col("at"), F.col("low"), F.col("high")
    p = points.join(bounded_broadcast(ahead), "sid").filter(
        (F.col("mass") <= F.col("limit")) & (at > F.col("after")) & (at >= low) & (at <= high))
    width = F.when(high > low, high - low).otherwise(1.0)
    keys = ["sid", "limit", "after", "need"]
    binned = p.groupBy(*keys, F.floor((at - low) / width * BINS).alias("bin")).agg(
        F.sum("mass").alias("mass"), F.min("at").alias("low"), F.max("at").alias("high"))
    binned = binned.withColumn("cum", F.sum("mass").over(Window.partitionBy("sid").orderBy("bin")))
    out = binned.groupBy(*keys).agg(F.sum("mass").alias("all"), F.min(F.when(F.col("cum") > F.col("need"), F.struct(
        "bin", "low", "high", (F.col("cum") - F.col("mass")).alias("used")))).alias("cross"))
    return out.select("sid", "limit", "after", (F.col("need") - F.coalesce(F.col("cross.used"), F.col("all"))).alias("need"),
                      F.col("cross.low").alias("low"), F.col("cross.high").alias("high"))


def _walk(points: DataFrame, goal: DataFrame, low: Column, high: Column, once: bool) -> DataFrame:
    """Strides (sid, limit, after, before, need): points with after < at < before and mass <= limit are taken.

    ``goal`` (sid, need); ``low`` and ``high`` are outside of all places of a source (by its need). ``once``: one stride
    a source; else as many as it takes until no point fits.
    """
    ahead = written(goal.filter(F.col("need") > 0).select(
        "sid", F.col("need").alias("limit"), low.alias("after"), low.alias("low"), high.alias("high"), "need"), "mix-goal")
    strides = ahead.select("sid", "limit", "after", F.col("high").alias("before"), "need").limit(0)
    while not ahead.isEmpty():
        out = written(_crossing(points, ahead), "mix-cross")
        wide = F.coalesce(F.col("high") > F.col("low"), F.lit(False))
        strides = strides.unionByName(out.filter(~wide).select(
            "sid", "limit", "after", F.coalesce(F.col("low"), F.lit(float("inf"))).alias("before"), "need"))
        on = wide if once else wide | (F.col("low").isNotNull() & (F.col("need") > 0))
        ahead = out.filter(on).select(
            "sid", F.when(wide, F.col("limit")).otherwise(F.col("need")).alias("limit"),
            F.when(wide, F.col("after")).otherwise(F.col("low")).alias("after"), "low",
            F.when(wide, F.col("high")).otherwise(high).alias("high"), "need")
    return strides


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
         max_rate: int = MAX_RATE) -> tuple[DataFrame, DataFrame | None]:
    """The mix of a written table (doc_id, source, size): one row per source with lambda, crossing and strides; repeated rows, if any."""
    hist = written(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-hist")
    targets = written(source_targets(hist, weights, share, max_rate), "mix-targets")
    lam = solve_rates(hist, targets, max_rate)
    params = written(targets.join(lam, "sid", "left").select(
        "*", F.when(F.col("full"), F.lit(None)).otherwise(F.col("lam")).alias("_l")).drop("lam")
        .withColumnRenamed("_l", "lam"), "mix-rates")
    rated = _rated(sized, params, max_rate).filter(~F.col("full") & (F.col("size") > 0))
    units = written(rated.groupBy("sid", "source", "size", "rate", "v").agg(F.count("*").alias("n")), "mix-units")
    mass, js = F.col("size") * F.col("n"), range(1, max_rate + 1)
    points = units.select("sid", mass.alias("mass"), F.explode(F.array(*[_place(j) for j in js])).alias("at"))
    goal = params.filter(~F.col("full") & (F.col("source_size") > 0)).select(
        "sid", F.floor(F.col("target")).alias("need"))
    first = written(_walk(points, goal, F.lit(-1.0 - max_rate), F.lit(1.0 + max_rate), once=True), "mix-first")
    over = units.join(bounded_broadcast(first.select("sid", "before", "need")), "sid").filter(mass <= F.col("need"))
    over = over.select("sid", mass.alias("mass"), F.explode(F.filter(F.array(*[
        F.when(_place(j) >= F.col("before"), _fill_place(j, mass, max_rate)) for j in js]), F.isnotnull)).alias("at"))
    fills = _walk(written(over, "mix-over"), first.select("sid", "need"), -1.0 - F.col("need"), F.lit(1.0), once=False)
    fills = fills.groupBy("sid").agg(F.collect_list(F.struct("limit", "after", "before")).alias("fills"))
    params = params.join(first.select("sid", "limit", "before"), "sid", "left").join(fills, "sid", "left")
    params = written(params, "mix-plan")
    repeated = units.filter(F.col("n") > 1).select("source", "size", "v", "n")
    return params, None if repeated.isEmpty() else written(repeated, "mix-repeated")


def _rated(rows: DataFrame, params: DataFrame, max_rate: int) -> DataFrame:
    """Join source parameters (one row per source) and add ``rate`` and ``v``."""
    p = bounded_broadcast(params.withColumnRenamed("source", "_psource"))
    out = rows.join(p, F.col("source").eqNullSafe(F.col("_psource"))).drop("_psource")
    rate = F.when(F.col("full"), F.lit(float(max_rate))).otherwise(
        F.coalesce(_rate(F.col("lam"), F.col("size"), F.col("mean"), max_rate), F.lit(0.0)))
    return out.withColumn("rate", rate).withColumn("v", _hash01(F.col("doc_id")))


def decide(rows: DataFrame, params: DataFrame, repeated: DataFrame | None, max_rate: int = MAX_RATE) -> DataFrame:
    """Add ``copies`` (0..max_rate) to rows with doc_id, source, size."""
    out, mass = _rated(rows, params, max_rate), F.col("size")
    if repeated is not None:  # repeated rows are taken together, so what must fit is the sum of their sizes
        r = repeated.select(*[F.col(c).alias(f"_{c}") for c in repeated.columns])
        out = out.join(bounded_broadcast(r), F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
                       & (F.col("v") == F.col("_v")), "left")
        mass = mass * F.coalesce("_n", F.lit(1))
    taken = [F.when(_place(j) < F.col("before"), mass <= F.col("limit")).otherwise(F.exists("fills", lambda s: (
        (_fill_place(j, mass, max_rate) > s["after"]) & (_fill_place(j, mass, max_rate) < s["before"]) & (mass <= s["limit"]))))
        for j in range(1, max_rate + 1)]
    base = sum((F.coalesce(t.cast("int"), F.lit(0)) for t in taken), F.lit(0))
    return out.withColumn("copies", F.when(F.col("full"), F.lit(max_rate)).otherwise(base))


def sized_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(text_of()).alias("size"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    sized = written(sized_rows(docs), "mix-sized")
    out = decide(sized, *plan(sized, **options), options.get("max_rate", MAX_RATE))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "copies")


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves, repeated ``copies`` times, with the columns of the input."""
    planned = plan(written(sized_rows(docs), "mix-sized"), **options)
    rows = docs.select("doc_id", "source", n_words(text_of()).alias("size"), F.struct(*docs.columns).alias("_row"))
    out = decide(rows, *planned, options.get("max_rate", MAX_RATE)).filter(F.col("copies") > 0)
    return out.select(F.explode(F.array_repeat("_row", F.col("copies"))).alias("_row")).select("_row.*")
