"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.llm.common import (
    Scratch,
    count_white_words,
    fresh,
    leading,
    named,
    packed,
    running_offsets,
    seeded,
)

#: Hex digits of the seeded digest that make a bucket: 65,536 buckets for each source.
BUCKET_DIGITS = 4


def staged(df: DataFrame) -> DataFrame:
    """The table written to the shared folder, so that counted sizes are counted once."""
    return Scratch(df.sparkSession, "mix").write(df, "rows")


def source_sizes(df: DataFrame, source: str, size: Column) -> DataFrame:
    """(source, size) with the sum of the sizes; null is a source like others."""
    return df.groupBy(named(source).alias("source")).agg(
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("size")
    )


def cyclic_weights(sizes: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """Weights that repeat over the sources in code point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    options = F.array(*[F.lit(float(w)) for w in cycle])
    return sizes.withColumn("weight", F.get(options, (place % len(cycle)).cast("int")))


def water_fill(sizes: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """(source, size, weight) with `target`: shares by weight, none above max_epochs times its size.

    Sources in order of cap to weight fill up first. A source is clamped when its share of what
    the sources before it leave reaches its cap; all later ones share the rest by weight. One row
    per source, so one window over them all stays small. `total` counts in sums of all sizes; what
    all caps together cannot hold stays out. Weights must be positive.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    capped = sizes.withColumns(
        {
            "cap": F.col("size") * F.lit(float(max_epochs)),
            "goal": F.sum("size").over(everything) * F.lit(float(total)),
        }
    )
    shared = capped.withColumns(
        {
            "left_over": F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(rest),
        }
    )
    clamped = shared.withColumn(
        "clamped", F.col("cap") * F.col("open_weight") <= F.col("weight") * F.col("left_over")
    )
    held = F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0.0)).over(everything)
    free = F.sum(F.when(F.col("clamped"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("clamped"), F.col("cap")).otherwise(
        F.col("weight") * (F.col("goal") - held) / free
    )
    return clamped.select("source", "size", "weight", "clamped", target.alias("target"))


def mix(
    df: DataFrame,
    weights: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    size: Column | None = None,
    total: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 7,
    out: str = "mix",
) -> DataFrame:
    """The rows with a struct: size, source_size, target, copies, taken.

    `weights` has (source, size, weight). Each source gives all its rows a whole number of times
    and, for the fraction left, once more the rows that come first in an order by a seeded digest
    of the key, up to the row whose middle passes the fraction. So a source misses its target by
    half a row at most, and no row is taken more than max_epochs times, rounded up.

    Sums over 65,536 digest buckets per source tell in which bucket the fraction ends; only rows
    of that bucket are put in order. A hot source costs no more per task than any other.

    A null source is a source of its own, a null key sorts by its text; rows equal in key and size
    are put in order by all columns, and equal rows are interchangeable. Rows of size 0 fall on a
    side of the cut like others and count for nothing. A source without any size, or a row whose
    source has no weight, gets target 0 and no copy. A column called `out` is replaced. An empty
    table gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "mix")
    amount = count_white_words(named("text")) if size is None else size
    own = [c for c in df.columns if c.lower() != out.lower()]
    n, digest, bucket, tie, side, extra = fresh(
        df, "_size", "_digest", "_bucket", "_tie", "_side", "_extra"
    )
    shares = scratch.write(water_fill(weights, total, max_epochs), "shares")
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0))
    plan = shares.withColumn("whole", whole.cast("int")).withColumn(
        "fraction", F.col("target") - F.col("whole") * F.col("size")
    )

    rows = df.select(*map(named, own)).withColumns(
        {n: F.coalesce(amount, F.lit(0)).cast("long"), digest: seeded(seed, named(key))}
    )
    rows = rows.withColumn(bucket, leading(named(digest), BUCKET_DIGITS))

    sums = rows.groupBy(named(source).alias("source"), named(bucket).alias("bucket")).agg(
        F.sum(named(n)).alias("words")
    )
    running = running_offsets(sums, ["source"], "bucket", "words", "before", span=256)
    joined = running.alias("r").join(
        plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))
    )
    cut = joined.where(
        (F.col("before") <= F.col("fraction"))
        & (F.col("fraction") < F.col("before") + F.col("words"))
    ).select("p.source", F.col("bucket").alias("cut"), F.col("before").alias("cut_before"))
    cut = scratch.write(cut, "cuts")
    steps = scratch.write(
        plan.alias("p")
        .join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
        .select(
            F.col("p.source").alias("source"),
            F.col("p.size").alias("source_size"),
            F.col("p.target").alias("target"),
            F.col("p.whole").alias("whole"),
            F.col("p.fraction").alias("fraction"),
            # Without a cut the fraction is 0 or takes in all buckets.
            F.coalesce(
                F.col("c.cut"), F.when(F.col("p.fraction") > 0, F.lit(16**BUCKET_DIGITS)), F.lit(-1)
            ).alias("cut"),
            F.coalesce(F.col("c.cut_before"), F.lit(0)).alias("cut_before"),
        ),
        "steps",
    )

    step = named(side)
    placed = rows.join(packed(steps, side), named(source).eqNullSafe(step["source"]), "left")
    at_cut = F.coalesce(named(bucket) == step["cut"], F.lit(False))
    apart = placed.where(~at_cut).withColumn(
        extra,
        F.coalesce(((named(bucket) < step["cut"]) & (step["fraction"] > 0)).cast("int"), F.lit(0)),
    )
    everything = F.xxhash64(*map(named, own))
    in_order = Window.partitionBy(named(source)).orderBy(named(digest), named(n), named(tie))
    ending = placed.where(at_cut).withColumn(tie, everything)
    words_before = F.coalesce(
        F.sum(named(n)).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    middle = 2 * (step["cut_before"] + words_before) + named(n)
    ending = ending.withColumn(extra, ((middle <= 2 * step["fraction"]) & (step["fraction"] > 0)).cast("int")).drop(tie)

    both = apart.unionByName(ending)
    copies = F.coalesce(step["whole"] + named(extra), F.lit(0))
    return both.select(
        *map(named, own),
        F.struct(
            named(n).alias("size"),
            F.coalesce(step["source_size"], F.lit(0)).alias("source_size"),
            F.coalesce(step["target"], F.lit(0.0)).alias("target"),
            copies.alias("copies"),
            (named(n) * copies).alias("taken"),
        ).alias(out),
    )


def repeat_rows(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """Every row as often as its `copies` say, without the struct; 0 copies drop the row."""
    (turn,) = fresh(mixed, "_turn")
    some = mixed.where(named(out)["copies"] > 0)
    return some.withColumn(
        turn, F.explode(F.sequence(F.lit(1), named(out)["copies"]))
    ).drop(turn, out)
