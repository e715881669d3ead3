"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source asks for its weight's share of the mix. A source stops at
``max_epochs`` times its own words; what it can't take goes to the others in
proportion to their weights, until none is above its limit. Ordering sources by
limit over weight makes this one pass: the sources that stop are a prefix of that
order.

A source's target is then made of whole repetitions of all its documents and one
fractional repetition: documents in seeded hash order while they fit, and one
closing document, the one nearest to the words still missing. Only documents of
the one hash bucket in which the target is reached are ordered one by one, so a
source with any share of all rows needs no task of its own.

Defined results: a null text has no words and is taken 0 times; a null source is a
source of its own, last in order; a null id hashes like the text ``null``;
repeated rows count one by one; an empty table gives no rows; extra columns stay
inside ``doc``, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorspan.llm.common import materialized, running_sums, word_count

WEIGHTS = (5, 2, 1)


def cycle_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``weight`` for each row of ``source``: by code point, null last, repeating."""
    ranked = running_sums(
        sources, [F.col("source").asc_nulls_last()], {"position": F.lit(1)}, "mix-rank"
    )
    cycle = F.array(*map(F.lit, weights))
    return ranked.withColumn(
        "weight", F.element_at(cycle, (F.col("position") % len(weights) + 1).cast("int"))
    ).drop("position")


def water_fill(sources: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight).

    The targets sum to ``share`` times all sizes, unless every source is at its limit.
    """
    limit = F.col("source_size") * max_epochs
    order = [
        (limit / F.col("weight")).asc(),
        F.col("source").asc_nulls_last(),
    ]
    filled = running_sums(
        sources, order, {"limit_before": limit, "weight_before": F.col("weight")}, "mix-fill"
    )
    size, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(share * (size or 0)) - F.col("limit_before")) / (
        F.lit(weights or 0) - F.col("weight_before")
    )
    # The first source in this order that stays within its limit sets the level.
    (final,) = (
        filled.withColumn("level", level)
        .filter(F.col("level") <= limit / F.col("weight"))
        .agg(F.min_by("level", F.col("limit_before") + F.col("weight_before")))
        .first()
    )
    target = limit.cast("double")
    if final is not None:
        target = F.least(target, F.lit(final) * F.col("weight"))
    return sources.withColumn("target", target)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix-1",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """(doc, size, source_size, target, copies, taken) for every row of ``docs``.

    ``doc`` holds the row's own columns (those in ``keep``, or all), ``copies``
    says how often the mix repeats it, ``taken`` is ``copies * size``.
    """
    kept = docs.columns if keep is None else keep
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = materialized(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in kept)).alias("doc"),
            F.col("source"),
            F.col("doc_id"),
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}|"), identity)).alias("place"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-rows",
    ).withColumn("bucket", F.substring("place", 1, 3))
    facts = rows.drop("doc")
    plan = _plan(facts, weights, share, max_epochs)

    def with_plan(df: DataFrame) -> DataFrame:
        return df.join(
            plan.withColumnRenamed("source", "plan_source"),
            F.col("source").eqNullSafe(F.col("plan_source")),
        ).drop("plan_source")

    sized = with_plan(facts.filter("size > 0"))
    edge = _edge(sized)
    extra = sized.join(edge, "row", "left").withColumn("extra", _extra())
    decided = (
        edge.unionByName(_closing(extra)).groupBy("row").agg(F.max("taken_once").alias("taken_once"))
    )
    out = with_plan(rows).join(decided, "row", "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + _extra()).otherwise(0)
    return out.select(
        "doc", "size", "source_size", "target", copies.cast("int").alias("copies")
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    repeated = mix(docs, **options).filter("copies > 0")
    return repeated.select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")


def _extra() -> Column:
    """1 if the fractional repetition takes the row: as decided, else by its bucket."""
    below = F.coalesce(F.col("bucket") < F.col("edge_bucket"), F.lit(False))
    return F.coalesce("taken_once", below.cast("int"))


def _plan(facts: DataFrame, weights, share: float, max_epochs: int) -> DataFrame:
    """Per source its target, whole repetitions and the bucket that reaches the rest."""
    buckets = materialized(
        facts.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets"
    )
    sources = materialized(
        buckets.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sources"
    )
    targets = water_fill(cycle_weights(sources, weights), share, max_epochs)
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    targets = targets.withColumn("whole", whole).withColumn(
        "part", F.col("target") - F.col("whole") * F.col("source_size")
    )
    targets = materialized(targets, "mix-targets")
    # At most 4,096 buckets a source, whatever its rows.
    upto = Window.partitionBy("source").orderBy("bucket")
    reached = (
        buckets.withColumn("upto", F.sum("words").over(upto))
        .withColumnRenamed("source", "bucket_source")
        .join(targets, F.col("bucket_source").eqNullSafe(F.col("source")))
        .filter("upto > part and upto - words <= part")
        .groupBy("bucket_source")
        .agg(
            F.min("bucket").alias("edge_bucket"),
            F.min(F.col("upto") - F.col("words")).alias("edge_before"),
        )
    )
    return materialized(
        targets.join(reached, F.col("source").eqNullSafe(F.col("bucket_source")), "left").drop(
            "bucket_source", "weight"
        ),
        "mix-plan",
    )


def _edge(planned: DataFrame) -> DataFrame:
    """Rows of each source's edge bucket, and whether they still fit."""
    upto = Window.partitionBy("source").orderBy("place", "doc_id", "size", "row")
    fits = F.sum("size").over(upto) + F.col("edge_before") <= F.col("part")
    return planned.filter(F.col("bucket") == F.col("edge_bucket")).select(
        "row", fits.cast("int").alias("taken_once")
    )


def _closing(extra: DataFrame) -> DataFrame:
    """Per source the one further row whose size is nearest to the missing words."""
    missing = (
        extra.groupBy("source")
        .agg((F.max("part") - F.sum(F.col("extra") * F.col("size"))).alias("missing"))
        .withColumnRenamed("source", "missing_source")
    )
    missing = materialized(missing, "mix-missing")
    off = F.abs(F.col("size") - F.col("missing"))
    nearest = (
        extra.filter("extra = 0")
        .join(missing, F.col("source").eqNullSafe(F.col("missing_source")))
        .filter(off < F.col("missing"))
        .groupBy("source")
        .agg(F.min(F.struct(off.alias("off"), "place", "doc_id", "size", "row")).alias("best"))
    )
    return nearest.select(F.col("best.row").alias("row"), F.lit(1).alias("taken_once"))
