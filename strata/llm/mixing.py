"""Mixing sources to target weights by entropy balancing: tilted document rates from Newton steps on the dual, rounded into copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import keep, row_key, with_decisions
from strata.llm.components import TOGETHER, gathered
from strata.session import BROADCAST_ROWS

#: ASCII white space ends a word; anything else is part of one.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: A document is taken at most so often.
COPIES = 3
#: Newton steps at most, each a job, and the relative error of a source's words that ends them.
STEPS, ERROR = 72, 1e-10
#: Bins a doubling of the distance, and doublings, in the search for how far the rounding reaches: BINS * DOUBLINGS sums a source at most.
BINS, DOUBLINGS = 100, 40
#: Passes of the rounding at most: later ones fill what long documents left open, until none that fits is left or a source's words are within
#: this part of its target.
PASSES, SLACK = 8, 2.0**-14
#: Rows that one task makes out of one repeated row.
REPEATS = 10_000


def _kept(df: DataFrame, label: str, **wanted: Column) -> tuple[DataFrame, dict]:
    """`keep`, and aggregates of the rows from the write itself: no job of their own."""
    seen = Observation()
    return keep(df.observe(seen, *[c.alias(name) for name, c in wanted.items()]), label), seen.get


def _tasks(rows: int) -> int | None:
    """Tasks for so many rows; None where they are too many to be gathered or broadcast."""
    return 1 + rows // TOGETHER if rows <= BROADCAST_ROWS else None


def _hinted(rows: DataFrame, few: int | None) -> DataFrame:
    return F.broadcast(rows) if few else rows


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """One row a source: source, k (its place by code point from 0, null last), weight, source_size, cap and target, in words.

    In: columns source and size. The sum of all sizes is shared by weight. No target exceeds `copies` times its source's size;
    what is above goes to the others by weight until none is above. With sources in order of cap for each unit of weight, let
    level be what is left for a unit of weight when all before are full: the highest level is the final one.
    Windows run over one row a source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sums.select("*", (F.row_number().over(order) - 1).alias("k"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = placed.select(
        "source", "source_size", "k", cycle[F.col("k") % len(weights)].alias("weight"), (copies * F.col("source_size")).cast("double").alias("cap")
    )
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "k")
    behind, ahead = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(behind), F.lit(0.0))) / F.sum("weight").over(ahead)
    leveled = placed.select("*", level.alias("level"))
    top = F.max("level").over(Window.partitionBy())
    return leveled.select("source", "k", "weight", "source_size", "cap", F.least("cap", F.col("weight") * top).alias("target"))


def _rate(size: Column, tilt: Column, mean: Column, full: Column, copies: int) -> Column:
    """exp(tilt * size / mean), `copies` at most; a source whose target is its cap takes all its documents so often."""
    return F.when(full, F.lit(float(copies))).otherwise(F.exp(F.least(tilt * size / mean, F.log(F.lit(float(copies))))))


def solve_tilts(histogram: DataFrame, targets: DataFrame, few: int | None, copies: int = COPIES) -> DataFrame:
    """k, tilt, mean and full for every source with words.

    histogram: k, size > 0 and n, the number of documents. The rates closest to one (in relative entropy, documents as the base
    measure, at most `copies`) under which the words of each source sum to its target are exp(tilt * size / mean). The dual is
    convex with a diagonal Hessian, one tilt a source; a Newton step is one aggregation over the histogram, its state a
    written row a source, and the write tells whether another step is needed. Steps that leave the bracket known so far are halved.
    few: tasks for a row a source, None where these are too many to broadcast.
    """
    moments = gathered(histogram.groupBy("k").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean")), few)
    state = keep(
        targets.join(_hinted(moments, few), "k").select(
            "k", "target", "mean", (F.col("target") >= F.col("cap") * (1 - 1e-12)).alias("full"),
            F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(1.0).alias("error"),
        ),
        "tilts",
    )
    for _ in range(STEPS):
        state, seen = _kept(_newton(histogram, state, few, copies), "tilts", open=F.max(~F.col("full") & (F.col("error") > ERROR)))
        if not seen.get("open"):
            break
    return state.select("k", F.round("tilt", 10).alias("tilt"), "mean", "full")


def _newton(histogram: DataFrame, state: DataFrame, few: int | None, copies: int) -> DataFrame:
    rate = _rate(F.col("size"), F.col("tilt"), F.col("mean"), F.col("full"), copies)
    words = F.col("n") * F.col("size") * rate
    now = state.select("k", "target", "mean", "full", "tilt", "low", "high")
    # the state goes through as part of the key, so the sums need no second join with it
    sums = histogram.join(_hinted(now, few), "k").groupBy(*now.columns).agg(
        F.sum(words).alias("words"),
        # asked of the exponent: exp(log(copies)) may come out below copies
        F.sum(F.when(F.col("tilt") * F.col("size") / F.col("mean") < F.log(F.lit(float(copies))), words * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
    )
    sums = gathered(sums, few)
    over = F.col("words") - F.col("target")
    bounded = sums.select(
        "*", (F.abs(over) / F.greatest("target", F.lit(1.0))).alias("error"),
        F.when(over > 0, F.col("tilt")).otherwise(F.col("high")).alias("h"), F.when(over < 0, F.col("tilt")).otherwise(F.col("low")).alias("l"),
    )
    step = F.col("tilt") - F.when(F.col("slope") > 0, over / F.col("slope"))
    inside = (step > F.col("l")) & (step < F.col("h")) & (F.abs(step - F.col("tilt")) < 1 + F.abs("tilt"))
    wide = F.when(over > 0, F.col("tilt") - 1 - F.abs("tilt")).otherwise(F.col("tilt") + 1 + F.abs("tilt"))  # no bracket yet
    middle = F.when((wide > F.col("l")) & (wide < F.col("h")) & ((F.col("l") <= -1e6) | (F.col("h") >= 1e6)), wide).otherwise((F.col("l") + F.col("h")) / 2)
    tilt = F.when(F.col("full") | (F.col("error") <= ERROR / 10), F.col("tilt")).when(inside, step).otherwise(middle)
    return bounded.select("k", "target", "mean", "full", tilt.alias("tilt"), F.col("l").alias("low"), F.col("h").alias("high"), "error")


def _bin(place: Column, low: Column) -> Column:
    """Bins of places from the lowest one on, each a little wider than the one before: the first units are told apart, however close."""
    return F.floor(F.log2((place - low) * float(1 << DOUBLINGS) + 1) * BINS).cast("int")


def _reach(fits: DataFrame, few: int | None, some: int | None) -> DataFrame:
    """k, low, cut and got: a source's units from the lowest place up to bin `cut` add up to `got`, the words needed or less.

    fits: k, size, place, need; each unit fits by itself, so the lowest one is always taken. some: tasks for a source's bins, as `few` for one row.
    """
    lowest = gathered(fits.groupBy("k").agg(F.min("place").alias("low")), few)
    bins = fits.join(_hinted(lowest, few), "k").groupBy("k", "low", _bin(F.col("place"), F.col("low")).alias("bin")).agg(F.sum("size").alias("words"), F.first("need").alias("need"))
    bins = gathered(bins, some).select("*", F.sum("words").over(Window.partitionBy("k").orderBy("bin")).alias("until"))
    within = F.col("until") <= F.col("need")
    ends = F.max(F.when(within, F.col("bin")).otherwise(-1)).alias("cut"), F.max(F.when(within, F.col("until")).otherwise(0)).alias("got")
    return gathered(bins.groupBy("k", "low").agg(*ends), few)


def _round_off(rated: DataFrame, few: int | None, some: int | None, copies: int) -> tuple[DataFrame, int]:
    """k, up (1 or -1) and, for each pass, need, low and cut: which units get a copy more or less, see `_moved`; and the number of passes.

    The first pass moves units in order of place until the next ones would exceed the words still needed. The passes after it
    do the same with what they left, among units that fit, so long documents next to the border do no harm. They end when no unit fits.
    """
    sums = rated.groupBy("k").agg((F.first("target") - F.sum(F.col("total") * F.col("size"))).alias("gap"), (F.first("target") * SLACK).alias("slack"))
    sums = gathered(sums, few).select("k", "slack", F.signum("gap").cast("int").alias("up"), F.abs("gap").alias("need0"))
    state, seen = _kept(sums, "gaps", open=F.max(F.col("need0") > F.col("slack")))
    if not seen.get("open"):
        return state, 0
    near = rated.join(_hinted(state.select("k", "up"), few), "k").filter(_room(copies) & (F.col("size") > 0)).select("k", "size", _place().alias("place"))
    near = keep(near, "near")
    for turn in range(PASSES):
        need, left = F.col(f"need{turn}"), F.col(f"need{turn + 1}")
        still = near.join(_hinted(state, few), "k").filter((F.col("size") <= need) & (need > F.col("slack")) & ~_moved(turn))
        reach = _reach(still.select("k", "size", "place", need.alias("need")), few, some).withColumnsRenamed({"low": f"low{turn}", "cut": f"cut{turn}"})
        found = state.join(_hinted(reach, few), "k", "left").na.fill({f"low{turn}": 0.0, f"cut{turn}": -1, "got": 0})
        found = found.select(*state.columns, f"low{turn}", f"cut{turn}", (need - F.col("got")).alias(f"need{turn + 1}"))
        state, seen = _kept(found, "gaps", open=F.max((left < need) & (left > F.col("slack"))))
        if not seen.get("open"):
            break
    return state, turn + 1


def _room(copies: int) -> Column:
    return F.when(F.col("up") > 0, F.col("total") < F.col("n") * copies).otherwise(F.col("total") > 0)


def _place() -> Column:
    """Where a unit lies between the border that it would cross (0) and the other one (1)."""
    return F.least(F.when(F.col("up") > 0, 1 - F.col("part")).otherwise(F.col("part")), F.lit(1 - 2.0**-53))


def _within(turn: int) -> Column:
    low = F.col(f"low{turn}")
    return (F.col("place") >= low) & (_bin(F.greatest(F.col("place"), low), low) <= F.col(f"cut{turn}"))


def _moved(passes: int) -> Column:
    hit = [(F.col("size") <= F.col(f"need{t}")) & _within(t) for t in range(passes)]
    return F.coalesce(reduce(lambda x, y: x | y, hit), F.lit(False)) if hit else F.lit(False)


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as column `times` says, and place, its number from 0. A row of very many repeats is made by several tasks."""
    few = rows.filter(F.col(times).between(1, REPEATS)).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1)).alias("place"))
    many = rows.filter(F.col(times) > REPEATS).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(REPEATS).cast("long"))).alias("start"))
    many = many.repartition("start")
    many = many.select("*", F.explode(F.sequence("start", F.least(F.col("start") + REPEATS, F.col(times)) - 1)).alias("place")).drop("start")
    return few.unionByName(many)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    copies: int = COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often each document is taken so that the words of every source come to its target.

    One row for each row of `docs`: doc_id, source, size (words), source_size, target (words of its source in the mix), rate
    (real-valued, from the balancing), copies (0 to `copies`) and taken (copies times size). Rates become copies by adding a
    number from 0 to 1 drawn from the row's id and text, and rounding down; then documents next to a rounding border are moved
    up or down, those nearest first, until no document that is left fits into what the source's words lack to the target. Nothing is
    random, so reruns agree. Rows equal in id, text and source are rounded together, their number times their rate, and dealt
    out: their copies differ by one at most. Null text: no words, never taken. A null source is one source, the last.
    Null ids and repeated rows stay. Empty in, empty out. Other columns are not read.
    """
    final = _mixed(docs.select(*dict.fromkeys((id_col, text_col, source_col))), weights, copies, id_col, text_col, source_col)
    each = _repeated(final, "n").withColumn("copies", (F.expr("total div n") + F.when(F.col("place") < F.col("total") % F.col("n"), 1).otherwise(0)).cast("int"))
    return each.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """The rows of `docs`, all columns kept, each as often as mix_sources takes it; repeated rows as often as all of them together.
    Documents without words are never taken."""
    units = _mixed(docs, weights, copies, "doc_id", "text", "source").filter("total > 0")
    decided = keep(units.select("key", F.struct("n", F.col("total").alias("times")).alias("unit")), "copies")
    taken = with_decisions(docs, row_key(docs), decided, "unit").select("key", "row", "decision.n", "decision.times")
    once = taken.filter("n = 1").select("row", "times")
    again = taken.filter("n > 1").dropDuplicates(["key"]).select("row", "times")
    return _repeated(once.union(again), "times").select("row.*")


def _mixed(docs: DataFrame, weights: Sequence[float], copies: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """A row for each distinct row of `docs` (a unit): key, doc_id, source, size, source_size, target, rate, n (its rows) and total (copies of all)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = docs.select(
        row_key(docs).alias("key"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ((F.xxhash64(F.col(id_col), text).bitwiseAND((1 << 52) - 1)) / F.lit(float(1 << 52))).alias("draw"),
    )
    sized = keep(sized.groupBy("key", "doc_id", "source", "size", "draw").agg(F.count("*").alias("n")), "sized")
    counts, seen = _kept(sized.groupBy("source", "size").agg(F.sum("n").alias("n")), "sizes", rows=F.count("*"))
    sizes = _tasks(seen.get("rows", 0))
    targets = source_targets(counts.select("source", (F.col("size") * F.col("n")).alias("size")), weights, copies)
    targets, seen = _kept(targets, "targets", rows=F.count("*"))
    # the number of sources never changes
    few, some = _tasks(seen.get("rows", 0)), _tasks(seen.get("rows", 0) * BINS * DOUBLINGS)
    histogram = counts.filter("size > 0").join(targets.select("source", "k"), counts["source"].eqNullSafe(targets["source"])).select("k", "size", "n")
    tilts = solve_tilts(keep(gathered(histogram, sizes), "histogram"), targets, few, copies)
    placed = keep(targets.join(tilts, "k", "left").withColumnRenamed("source", "own"), "placed")
    rate = F.when(F.col("size") > 0, _rate(F.col("size"), F.col("tilt"), F.col("mean"), F.col("full"), copies)).otherwise(0.0)
    rated = sized.join(placed, sized["source"].eqNullSafe(placed["own"])).select("key", "doc_id", "source", "size", "n", "source_size", "target", "k", rate.alias("rate"), "draw")
    drawn = F.col("rate") * F.col("n") + F.col("draw")
    rated = keep(rated.select("*", F.floor(F.least(drawn, (F.col("n") * copies).cast("double"))).cast("long").alias("total"), (drawn - F.floor(drawn)).alias("part")), "rated")
    state, passes = _round_off(rated, few, some, copies)
    final = rated.join(_hinted(state, few), "k").withColumn("place", _place())
    times = F.when(F.col("size") > 0, F.col("total") + F.when(_room(copies) & _moved(passes), F.col("up")).otherwise(0)).otherwise(0)
    return final.select("key", "doc_id", "source", "size", "n", "source_size", "target", "rate", times.cast("long").alias("total"))
