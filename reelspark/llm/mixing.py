"""Mixing sources to target weights by pivotal dependent rounding, without user functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.text import count_words, only
from reelspark.operators.ordering import with_offsets
from reelspark.session import broadcast_if_small, materialise

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_COPIES = 2
FAN_IN_BITS = 6
SEED = 42


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: int) -> DataFrame:
    """(source, source_size) -> weight and target.

    Weights repeat over the sources in code-point order, null last. Shares of ``budget`` times all
    sizes go out by weight; sources above ``most`` times their size stop there and the excess is
    shared again. Each round is one aggregate; only its two sums come back.
    """
    ranked = with_offsets(sizes.withColumn("_missing", F.col("source").isNull()), ["_missing", "source"])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = materialise(
        ranked.select("source", "source_size", F.get(cycle, (F.col("pos") % len(weights)).cast("int")).alias("weight"))
    )
    cap = F.lit(most) * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        below = F.col("weight") * F.lit(level) <= cap
        sums = table.agg(
            F.sum(F.when(below, F.col("weight")).otherwise(0.0)).alias("open"),
            F.sum(F.when(below, 0).otherwise(cap)).alias("full"),
        ).first()
        if not sums["open"]:
            break
        now = (budget * total - sums["full"]) / sums["open"]
        if now <= level:
            break
        level = now
    return table.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Give an expression a name, so that ``body`` does not evaluate it for each use."""
    return F.get(F.transform(F.array(value), body), 0)


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _item(x: Column, p: Column) -> Column:
    return F.struct(x["order"].alias("order"), x["pos"].alias("pos"), x["doc_id"].alias("doc_id"), p.alias("p"))


def _duel(a: Column, b: Column, seed: int) -> Column:
    """Move words between two open items until one is whole; the sum of size * p stays.

    Either a rises and b falls, or the other way round, with the odds that keep each p in mean.
    """
    ratio = -b["order"] / -a["order"]
    rise = F.struct((1 - a["p"]).alias("to_one"), (b["p"] * ratio).alias("to_zero"))
    fall = F.struct(a["p"].alias("to_zero"), ((1 - b["p"]) * ratio).alias("to_one"))

    def settle(x: Column) -> Column:
        up, down = x["up"], x["down"]
        most_up, most_down = F.least(up["to_one"], up["to_zero"]), F.least(down["to_zero"], down["to_one"])
        raised = F.struct(
            F.when(up["to_one"] <= up["to_zero"], 1.0).otherwise(a["p"] + most_up).alias("a"),
            F.when(up["to_zero"] <= up["to_one"], 0.0).otherwise(b["p"] - most_up / ratio).alias("b"),
        )
        lowered = F.struct(
            F.when(down["to_zero"] <= down["to_one"], 0.0).otherwise(a["p"] - most_down).alias("a"),
            F.when(down["to_one"] <= down["to_zero"], 1.0).otherwise(b["p"] + most_down / ratio).alias("b"),
        )
        chance = most_down / (most_up + most_down)
        return F.when(_uniform(a["pos"], b["pos"], F.lit(seed)) < chance, raised).otherwise(lowered)

    return _let(F.struct(rise.alias("up"), fall.alias("down")), settle)


def _fold(items: Column, seed: int, kind: str) -> Column:
    """Fold a block of open items: those that became whole, and at most one left open."""
    none = F.lit(None).cast(kind)
    start = F.struct(none.alias("left"), F.array().cast(f"array<{kind}>").alias("done"))

    def meet(acc: Column, x: Column) -> Column:
        def after(p: Column) -> Column:
            pair = F.array(_item(acc["left"], p["a"]), _item(x, p["b"]))
            whole = F.filter(pair, lambda i: (i["p"] == 0) | (i["p"] == 1))
            still = F.filter(pair, lambda i: (i["p"] > 0) & (i["p"] < 1))
            return F.struct(F.get(still, 0).alias("left"), F.concat(acc["done"], whole).alias("done"))

        fresh = F.struct(x.alias("left"), acc["done"].alias("done"))
        return F.when(acc["left"].isNull(), fresh).otherwise(_let(_duel(acc["left"], x, seed), after))

    return F.aggregate(items, start, meet)


def pivotal_round(open_items: DataFrame, id_type: str, seed: int = SEED) -> DataFrame:
    """Round (source, pos, doc_id, size, p) with 0 < p < 1 and size > 0 to ``rounded`` 0 or 1.

    ``pos`` numbers the rows, sources in one run each. Level by level, 64 neighbours of a source
    fold into at most one open item, so a block is bounded whatever the source holds and levels
    grow with the logarithm of the rows. The one item a source has left without a partner goes to
    the nearest whole number, so a source's sum misses its target by half an item at most.
    """
    kind = f"struct<order:bigint,pos:bigint,doc_id:{id_type},p:double>"
    items = open_items.select(
        "source", F.struct((-F.col("size")).alias("order"), "pos", "doc_id", F.col("p").cast("double").alias("p")).alias("x")
    )
    top = open_items.agg(F.max("pos")).first()[0]
    bits, parts = 0, []
    while top is not None:
        bits += FAN_IN_BITS
        block = F.shiftright(F.col("x.pos"), bits).alias("block")
        folded = items.groupBy("source", block).agg(F.sort_array(F.collect_list("x")).alias("xs"))
        state = materialise(folded.select("source", _fold(F.col("xs"), seed, kind).alias("state")))
        parts.append(state.select("source", F.explode("state.done").alias("x")))
        items = state.where("state.left IS NOT NULL").select("source", F.col("state.left").alias("x"))
        if top >> bits == 0:
            break
    nearest = F.when(F.col("x.p") >= 0.5, 1).otherwise(0)
    done = items.select("source", "x.doc_id", (-F.col("x.order")).alias("size"), nearest.alias("rounded"))
    for part in parts:
        whole = part.select("source", "x.doc_id", (-F.col("x.order")).alias("size"), F.col("x.p").cast("int").alias("rounded"))
        done = done.unionByName(whole)
    return done


def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """How many copies of each document the mix takes: doc_id, source, size, source_size, target,
    copies and taken (words, repeats counted).

    Size is the number of words; a null or blank text has size 0 and is taken 0 words (its copies
    follow the whole part of its source's rate). A null source is a source of its own, the last.
    Repeated rows are rounded one by one. An empty table gives no rows; extra columns are ignored.
    The same table and seed give the same rows, whatever the partitions.
    """
    named = only(df, doc_id=doc_id, source=source, text=text)
    sized = materialise(named.select("doc_id", "source", count_words(F.col("text")).alias("size")))
    return mix_sizes(sized, weights, budget, most, seed)


def mix_sizes(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``mix`` of a stored table (doc_id, source, size)."""
    id_type = sized.schema["doc_id"].dataType.simpleString()
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(per_source, weights, budget, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = targets.select("source", "source_size", "target", rate.alias("rate")).withColumn("_base", F.floor("rate"))
    rates = broadcast_if_small(rated.withColumnRenamed("source", "_source"), rated.count(), 256)

    def with_rate(rows: DataFrame) -> DataFrame:
        return rows.join(rates, rows["source"].eqNullSafe(rates["_source"])).drop("_source")

    rows = with_rate(sized).withColumn("p", F.col("rate") - F.col("_base"))
    is_open = (F.col("p") > 0) & (F.col("size") > 0)
    # Sources stand together and their rows in an order drawn from the seed.
    drawn = rows.where(is_open).select(
        "source", "doc_id", "size", "p", F.col("source").isNull().alias("_missing"), F.xxhash64("doc_id", F.lit(seed)).alias("_draw")
    )
    numbered = with_offsets(drawn, ["_missing", "source", "_draw", "doc_id", "size"])
    rounded = with_rate(pivotal_round(numbered, id_type, seed))
    whole = rows.where(~is_open).withColumn("rounded", F.lit(0))
    copies = (F.col("_base") + F.col("rounded")).cast("bigint")
    result = [F.col("doc_id"), F.col("source"), F.col("size"), F.col("source_size"), F.col("target"), copies.alias("copies")]
    both = whole.select(*result).unionByName(rounded.select(*result))
    return both.withColumn("taken", F.col("size") * F.col("copies"))
