"""Which calls to keep: caps per speaker, gender balance, splits without leaks, exposure."""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import materialize
from . import graph


def enabled(cap: float | None) -> float | None:
    """A cap of None, 0 or less is off."""
    return cap if cap is not None and cap > 0 else None


def admit(rows: list[tuple], max_calls: int | None, max_ms: int | None) -> list[str]:
    """'kept' or the reason for each (speakers, times), in order.

    Strict: a call that would take a speaker past a cap is refused, and a
    refused call doesn't count for anyone. Checks run side by side: longer than
    the cap alone, calls used up, time used up.
    """
    calls: dict = {}
    used: dict = {}
    out = []
    for speakers, times in rows:
        reason = "kept"
        for s, t in zip(speakers, times, strict=True):
            if max_ms is not None and t > max_ms:
                reason = "longer_than_duration_cap"
            elif max_calls is not None and calls.get(s, 0) >= max_calls:
                reason = "speaker_cap"
            elif max_ms is not None and used.get(s, 0) + t > max_ms:
                reason = "speaker_duration_cap"
            if reason != "kept":
                break
        out.append(reason)
        if reason == "kept":
            for s, t in zip(speakers, times, strict=True):
                calls[s] = calls.get(s, 0) + 1
                used[s] = used.get(s, 0) + t
    return out


#: Sides of undecided calls that one task takes in order, and the rounds after which it takes whatever is left.
FEW, TURNS = 200_000, 12


def _sides(candidates: DataFrame) -> DataFrame:
    """(id, call, quality, speaker, own, n, total, top, kept): each different speaker of a call with the places and times of the sides it has."""
    kinds = dict(candidates.dtypes)
    quality = F.nullif(F.col("quality"), F.lit(float("nan"))).alias("quality") if kinds["quality"] in ("double", "float") else F.col("quality")
    each = F.transform(F.arrays_zip("speakers", "times"), lambda x, i: F.struct(x["speakers"].alias("speaker"), i.alias("pos"), x["times"].alias("ms")))
    mine = F.transform(F.array_distinct("speakers"), lambda s: F.struct(s.alias("speaker"), F.filter(each, lambda x: x["speaker"] == s).alias("own")))
    numbered = candidates.where(F.get("speakers", F.lit(0)).isNotNull()).select(F.monotonically_increasing_id().alias("id"), "call", quality, mine.alias("mine"))
    named = numbered.select("id", "call", "quality", F.explode("mine").alias("x"))
    ms = F.transform("own", lambda x: x["ms"])
    sides = named.select("id", "call", "quality", F.col("x.speaker").alias("speaker"), F.transform("x.own", lambda x: F.struct(x["pos"].alias("pos"), x["ms"].alias("ms"))).alias("own")).where("speaker is not null")
    total = F.aggregate(ms, F.lit(0).cast("long"), lambda t, x: t + x).alias("total")
    return sides.select("*", F.size("own").cast("long").alias("n"), total, F.array_max(ms).alias("top"), F.lit(None).cast("boolean").alias("kept"))


def _order() -> list[Column]:
    return [F.desc_nulls_last("quality"), F.col("call"), F.col("id")]


def _rest_in_order(sides: DataFrame, max_calls: int | None, max_ms: int | None) -> DataFrame:
    """(id) of the calls that are kept among undecided ones, whose sides say what calls kept already use (calls, used) before them; one task."""

    def run(batches):
        calls: dict = {}
        used: dict = {}
        own: list = []

        def admitted():
            fits = lambda s, c, u, top: (max_calls is None or c + calls.get(s, 0) < max_calls) and (max_ms is None or u + used.get(s, 0) + top <= max_ms)
            if not own or not all(fits(s, c, u, top) for _, s, c, u, _, _, top in own):
                return []
            for _, s, _, _, n, total, _ in own:
                calls[s] = calls.get(s, 0) + n
                used[s] = used.get(s, 0) + total
            return [own[0][0]]

        for b in batches:
            out = []
            for row in zip(*(b[x].tolist() for x in ("id", "speaker", "calls", "used", "n", "total", "top")), strict=True):
                if own and own[0][0] != row[0]:
                    out += admitted()
                    own = []
                own.append(row)
            yield pd.DataFrame({"id": out}, dtype="int64")
        yield pd.DataFrame({"id": admitted()}, dtype="int64")

    ordered = sides.repartition(1).sortWithinPartitions(*_order())
    return ordered.select("id", "speaker", "calls", "used", "n", "total", "top").mapInPandas(run, "id long")


def cap_admission(candidates: DataFrame, max_calls: int | None, max_ms: int | None, few: int = FEW, turns: int = TURNS) -> DataFrame:
    """(call, reason) for rows (call, speakers, times in ms, quality): best quality first, then by call; as ``admit`` has it.

    In rounds. Running sums of each speaker's calls, in order, say what it has used before a call at least (by calls
    kept already) and at most (if all undecided ones before are kept). A call that fits with the most is kept, one that
    doesn't with the least is refused; the first undecided one always is either. What is left after some
    rounds, or is small, is taken in order by one task that holds the speakers of these calls: the same
    calls either way. Reasons follow from the sums over all calls kept. A null speaker has no caps; calls whose first is null are left out.
    """
    max_calls, max_ms = enabled(max_calls), enabled(max_ms)
    before = Window.partitionBy("speaker").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, -1)
    one = Window.partitionBy("id")
    taken = lambda x, which: F.coalesce(F.sum(F.when(which, F.col(x))).over(before), F.lit(0))
    at_least = lambda t: t.withColumns({"calls": taken("n", F.col("kept")), "used": taken("total", F.col("kept"))})

    def over(calls, used, ms):
        """Which cap refuses a side, null if none does."""
        long = F.lit(False) if max_ms is None else ms > max_ms
        many = F.lit(False) if max_calls is None else calls >= max_calls
        much = F.lit(False) if max_ms is None else used + ms > max_ms
        return F.when(long, "longer_than_duration_cap").when(many, "speaker_cap").when(much, "speaker_duration_cap")

    live = materialize(_sides(candidates), "sides")
    columns, refused = live.columns, []
    for turn in count():
        n = live.where("kept is null").count()
        if not n:
            break
        if n <= few or turn >= turns:
            found = materialize(_rest_in_order(at_least(live).where("kept is null"), max_calls, max_ms), "rest").withColumn("found", F.lit(True))
            live = live.join(found, "id", "left").withColumn("kept", F.coalesce("kept", "found", F.lit(False))).select(columns)
            break
        most = {"most_calls": taken("n", F.lit(True)), "most_used": taken("total", F.lit(True))}
        known = at_least(live).withColumns(most)
        fits = over(F.col("most_calls"), F.col("most_used"), F.col("top")).isNull()
        fails = over(F.col("calls"), F.col("used"), F.col("top")).isNotNull()
        judged = known.withColumns({"fits": F.min(fits).over(one), "fails": F.max(fails).over(one)})
        kept = F.coalesce("kept", F.when(F.col("fits"), True).when(F.col("fails"), False))
        step = materialize(judged.withColumn("kept", kept).select(columns), "judged")
        refused.append(step.where("not kept"))
        live = step.where("kept is null or kept")
    every = at_least(reduce(DataFrame.unionByName, refused, live))
    why = lambda x: F.struct(x["pos"].alias("pos"), over(F.col("calls"), F.col("used"), x["ms"]).alias("reason"))
    first = F.array_min(F.filter(F.transform("own", why), lambda x: x["reason"].isNotNull()))
    per = every.withColumn("why", F.when(F.col("kept"), None).otherwise(first)).groupBy("id").agg(F.first("call").alias("call"), F.min("why").alias("why"))
    return per.select("call", F.coalesce("why.reason", F.lit("kept")).alias("reason"))


def balance_plan(male: int, female: int, only_male: int, only_female: int, tolerance: float) -> tuple[int, int]:
    """How many all-male and all-female calls (two sides each) to drop, weakest first.

    Follows the one-by-one rule exactly, overshoot and change of majority
    included, on four counts; while the majority can't change yet it jumps.
    """
    drop = [0, 0]
    have, movable = [male, female], [only_male, only_female]
    while True:
        total = have[0] + have[1]
        if total == 0 or abs(have[0] / total - 0.5) <= tolerance:
            return drop[0], drop[1]
        side = 0 if have[0] / total > 0.5 else 1
        if movable[side] == 0:
            return drop[0], drop[1]
        gap = have[side] - have[1 - side]
        jump = max(1, min(movable[side], int((gap - 2 * tolerance * total) // 2) - 2))
        have[side] -= 2 * jump
        movable[side] -= jump
        drop[side] += jump


def balance_gender(calls: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """``calls`` (call, genders, quality) without the weakest calls of the majority's own, until balanced."""
    both = lambda g: (F.size("genders") > 0) & F.forall("genders", lambda x: F.coalesce(x == g, F.lit(False)))
    count = lambda g: F.sum(F.size(F.filter("genders", lambda x: x == g)))
    c = calls.agg(
        *[F.coalesce(count(g), F.lit(0)).alias(g) for g in ("male", "female")],
        *[F.coalesce(F.sum(both(g).cast("int")), F.lit(0)).alias(f"only_{g}") for g in ("male", "female")],
    ).first()
    k_male, k_female = balance_plan(c.male, c.female, c.only_male, c.only_female, tolerance)
    if not k_male and not k_female:
        return calls
    own = F.when(both("male"), "male").when(both("female"), "female")
    ranked = calls.withColumn("__own", own)
    order = Window.partitionBy("__own").orderBy("quality", "call")
    weak = ranked.where(F.col("__own").isNotNull()).withColumn("__rank", F.row_number().over(order))
    weak = weak.where(F.col("__rank") <= F.when(F.col("__own") == "male", k_male).otherwise(k_female))
    return calls.join(weak.select("call"), "call", "left_anti")


def assign_splits(sizes: Sequence[tuple], targets: dict[str, float], seed: int = 1234, total: int | None = None) -> dict:
    """Component -> split: largest first, the second half shuffled, each to the split furthest below its target."""
    ordered = sorted(sizes, key=lambda p: (-p[1], p[0]))
    tail = ordered[len(ordered) // 2 :]
    random.Random(seed).shuffle(tail)
    total = sum(n for _, n in sizes) if total is None else total
    have = dict.fromkeys(targets, 0)
    out = {}
    for component, n in [*ordered[: len(ordered) // 2], *tail]:
        split = max(targets, key=lambda s: targets[s] * total - have[s])
        have[split] += n
        out[component] = split
    return out


def split_by_component(calls: DataFrame, targets: dict[str, float], seed: int = 1234, large: float = 1e-4) -> DataFrame:
    """(call, component, split) for rows (call, speakers): speakers connected by calls share a split.

    Components above the share ``large`` of all calls, 1 / ``large`` of them at most,
    are assigned on the driver; each of the others takes a split by a seeded hash, in proportion to
    what the large ones leave of the targets.
    """
    spark = calls.sparkSession
    parts = graph.connected_components(calls.select(F.col("speakers")[0].alias("a"), F.explode("speakers").alias("b")))
    placed = materialize(calls.select("call", F.col("speakers")[0].alias("node")).join(parts, "node").select("call", "component"), "placed")
    sizes = placed.groupBy("component").agg(F.count("*").alias("n"))
    total = placed.count()
    big = [(r.component, r.n) for r in sizes.where(F.col("n") > large * total).collect()]
    chosen = assign_splits(big, targets, seed, total)
    kind = dict(placed.dtypes)["component"]
    known = spark.createDataFrame(list(chosen.items()), f"component {kind}, chosen string")
    left = {s: max(0.0, share * total - sum(n for c, n in big if chosen[c] == s)) for s, share in targets.items()}
    u = F.pmod(F.xxhash64(F.lit(seed), "component"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    split, below = F.lit(list(targets)[-1]), 1.0
    for s in list(targets)[:0:-1]:  # from the last: those below its start go to the ones before
        below -= left[s] / max(1e-9, sum(left.values()))
        split = F.when(u >= below, split).otherwise(F.lit(list(targets)[list(targets).index(s) - 1]))
    return placed.join(F.broadcast(known), "component", "left").select("call", "component", F.coalesce("chosen", split).alias("split"))


def exposure(sides: DataFrame, time: Column, steps: int = 65_536) -> DataFrame:
    """How concentrated speech is on its loudest voices, from rows (speaker, time in ms).

    The voice at the upper hundredth is looked for among those in its one of
    ``steps`` equal ranges; no task ranks all voices.
    """
    per = materialize(sides.groupBy("speaker").agg(F.sum(time).alias("ms")), "voices")
    one = per.agg(F.count("*").alias("n"), F.coalesce(F.max("ms"), F.lit(0)).alias("top"), F.coalesce(F.sum("ms"), F.lit(0)).alias("total")).first()
    loudest = per.orderBy(F.desc("ms"), "speaker").limit(10).agg(F.sum("ms").alias("ms")).first().ms
    rank = round(0.01 * (one.n - 1)) + 1  # half to even, as SQL's rint
    step = F.least(F.floor(F.col("ms") * steps / F.lit(max(1, one.top))), F.lit(steps)).alias("step")
    counts = {r.step: r.n for r in per.where("ms is not null").groupBy(step).agg(F.count("*").alias("n")).collect()}
    seen, at = 0, None
    for k in sorted(counts, reverse=True):
        at = k
        if seen + counts[k] >= rank:
            break
        seen += counts[k]
    some = per.where(step == F.lit(at)).orderBy(F.desc("ms")).select("ms").limit(max(1, rank - seen)) if at is not None else per.limit(0).select("ms")
    found = some.agg(F.coalesce(F.min("ms"), F.lit(0)).cast("long").alias("p99_ms"))
    share = round((loudest or 0) / one.total, 4) if one.total else 0.0
    return found.select(
        F.lit(one.n).cast("long").alias("speakers"),
        F.lit(int(one.top)).cast("long").alias("max_ms"),
        "p99_ms",
        F.lit(float(share)).alias("top10_share"),
        F.lit(round(one.total / 3.6e6, 3)).cast("double").alias("hours"),
    )
