"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 9).

Every source has a word budget.  It is filled with complete epochs of the source
first, then with part of one more: documents get the key -ln(u) / w, where u is
a hash of the document between 0 and 1 and w its quality weight, and are taken
in the order of the key until their words reach what is left of the budget.
That order is a weighted sample without replacement of any length.

The order is not computed by sorting a source.  Sums of words per source and
slice of the key range tell in which slice the budget runs out; only the
documents of that slice are sorted.  Slices are equal parts of the logarithm of
the key: the weight only shifts it, so whatever the weights, no slice is expected
to hold more than a share of 1 / (e * ``SLICES``) of a source's distinct texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import column, fresh, saved
from tickerloom.llm.quality_rules import GAPS, SPACES, SYMBOLS

#: Slices per unit of the logarithm of the key.
SLICES = 1024
#: Below all slices.
NO_SLICE = -(2**31)
#: A plan of at most so many sources is broadcast; a larger one is joined by shuffling.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Words between blanks; 0 for null."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, GAPS))).otherwise(0).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: 1 for prose, less the more symbols there are to a word."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * F.coalesce(symbols, F.lit(0)) / F.greatest(size, F.lit(1)))


def handed_weight(weight: Column) -> Column:
    """A weight that the caller brings, a score for instance, between 1e-6 and 1; the least for null and NaN."""
    weight = weight.cast("double")
    return F.when(weight.isNull() | F.isnan(weight), 1e-6).otherwise(F.least(F.greatest(weight, F.lit(1e-6)), F.lit(1.0)))


def sampling_key(id: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, with u from the first 52 bits of an MD5 of seed, id and text."""
    named = F.concat_ws("|", F.lit(str(seed)), F.coalesce(id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(2.0**52)) / weight


def _slice(key: Column) -> Column:
    return F.floor(F.log(key) * SLICES).cast("int")


def source_targets(sizes: DataFrame, shares: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source its ``target``: shares of all words by weight, capped, what is cut off reshared by weight.

    ``sizes`` has ``source`` and ``source_size``.  Sources in the order of their
    names, null last, weigh ``shares`` in turn.  With the sources in the order
    of cap by weight, one is capped exactly if its cap is not above its share of
    what those before it leave.  One row per source meets in one task here.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(named) - 1) % len(shares)
    weight = F.lit(float(shares[-1]))
    for k, share in enumerate(shares[:-1]):
        weight = F.when(turn == k, float(share)).otherwise(weight)
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    pull = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    capped = weighed.withColumn("capped", F.col("cap") * pull <= F.col("weight") * left)
    free = F.when(~F.col("capped"), F.col("weight"))
    rest = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)
    )
    shared = rest.cast("double") * F.col("weight") / F.sum(free).over(everything)
    return capped.select(
        "source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared).alias("target")
    )


def mixture_plan(keyed: DataFrame, *, shares: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Per source: size, target, complete ``epochs``, and where one more is cut: ``cut_slice`` and ``cut_key``.

    ``keyed`` has ``source``, ``size`` and ``key`` and is read three times.
    Documents with equal keys are taken together; the group at the cut is taken
    if that comes nearer to the target.
    """
    keyed = keyed.withColumn("slice", _slice(F.col("key")))
    slices = keyed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    targets = source_targets(
        slices.groupBy("source").agg(F.sum("words").alias("source_size")), shares, max_epochs
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", F.least(epochs, F.lit(max_epochs)).cast("long")).withColumn(
        "rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))
    )
    # Keys lie between e^-37 and e^4 over the least weight: some ten thousand rows per source.
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    cuts = (
        slices.withColumn("upto", upto)
        .alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .filter(F.col("upto") > F.col("rest"))
        .groupBy(F.col("t.source").alias("source"))
        .agg(F.min_by(F.struct("slice", F.col("upto") - F.col("words"), "rest"), "slice").alias("cut"))
        .select("source", "cut.slice", F.col("cut.col2").alias("before"), "cut.rest")
    )
    here = (
        keyed.alias("k")
        .join(cuts.alias("c"), F.col("k.source").eqNullSafe(F.col("c.source")) & (F.col("k.slice") == F.col("c.slice")))
        .groupBy(F.col("c.source").alias("source"), "key", "before", "rest")
        .agg(F.sum("size").alias("words"))
    )
    reach = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key"))
    taken = (
        here.withColumn("reach", reach)
        .filter(
            (F.col("reach") <= F.col("rest"))
            | (F.col("rest") - (F.col("reach") - F.col("words")) >= F.col("words") / 2)
        )
        .groupBy("source")
        .agg(F.max("key").alias("cut_key"))
    )
    plan = targets.alias("t").join(cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
    plan = plan.join(taken.alias("x"), F.col("t.source").eqNullSafe(F.col("x.source")), "left")
    return plan.select(
        F.col("t.source").alias("source"),
        "source_size",
        "target",
        "epochs",
        F.coalesce(F.col("c.slice"), F.lit(NO_SLICE)).alias("cut_slice"),
        F.coalesce("cut_key", F.lit(-1.0)).alias("cut_key"),
    )


def _copies(max_epochs: int) -> Column:
    """How often a document is taken: a source at its limit has no epoch left for what stands before an empty cut."""
    at = _slice(F.col("key"))
    taken = (at < F.col("cut_slice")) | ((at == F.col("cut_slice")) & (F.col("key") <= F.col("cut_key")))
    return F.least(F.col("epochs") + taken.cast("long"), F.lit(max_epochs).cast("long"))


def _with_plan(keyed: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    side = plan.withColumnRenamed("source", "plan_source")
    if sources <= BROADCAST_SOURCES:
        side = F.broadcast(side)
    return keyed.join(side, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")


def keyed_documents(
    docs: DataFrame, *, text: str, id: str, source: str, seed: int, weight: str | None = None
) -> DataFrame:
    """Per row ``doc_id``, ``source``, ``size`` and ``key``."""
    body = column(docs, text)
    handed = F.lit(None).cast("double") if weight is None else handed_weight(column(docs, weight))
    sized = docs.select(
        column(docs, id).alias("doc_id"), column(docs, source).alias("source"), body.alias("text"),
        word_count(body).alias("size"), handed.alias("weight"),
    )
    weighed = quality_weight(F.col("text"), F.col("size")) if weight is None else F.col("weight")
    key = sampling_key(F.col("doc_id"), F.col("text"), weighed, seed)
    return sized.withColumn("key", key).drop("text", "weight")


def mix(
    docs: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    shares: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 42,
    weight: str | None = None,
) -> DataFrame:
    """Per row its id, ``size`` in words, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    Null and empty texts have size 0 and take nothing; a null source is a source
    of its own; a source without words has target 0.  Rows equal in id and text
    have one key and are taken together.  Reruns agree, since keys are hashes.
    ``weight`` names a column of quality weights, such as scores (see
    ``handed_weight``); without it a text's symbols tell.  No document, without
    words or not, comes more than ``max_epochs`` times.  Other columns are left out; an empty table gives an empty one.
    """
    keyed = saved(keyed_documents(docs, text=text, id=id, source=source, seed=seed, weight=weight), "mixture_keys")
    plan = saved(mixture_plan(keyed, shares=shares, max_epochs=max_epochs), "mixture_plan")
    joined = _with_plan(keyed, plan, plan.count()).withColumn("copies", _copies(max_epochs))
    return joined.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    shares: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 42,
    weight: str | None = None,
) -> DataFrame:
    """The rows of the mix, all columns as they are, each as often as it is taken, ``max_epochs`` times at most.

    Nulls, ties, repeated rows, weights and empty tables are as in ``mix``;
    documents without words come as often as their key says.
    """
    keyed = saved(keyed_documents(docs, text=text, id=id, source=source, seed=seed, weight=weight), "mixture_keys")
    plan = saved(mixture_plan(keyed, shares=shares, max_epochs=max_epochs), "mixture_plan")
    row = fresh(["source", "size", "key", *plan.columns], "row")
    body = column(docs, text)
    whole = docs.select(
        F.struct(*(column(docs, name) for name in docs.columns)).alias(row),
        column(docs, source).alias("source"),
        word_count(body).alias("size"),
    )
    inner = F.col(row)
    weighed = quality_weight(inner[text], F.col("size")) if weight is None else handed_weight(inner[weight])
    whole = whole.withColumn("key", sampling_key(inner[id], inner[text], weighed, seed))
    joined = _with_plan(whole, plan, plan.count())
    repeated = joined.select(row, F.explode(F.array_repeat(F.lit(0), _copies(max_epochs).cast("int"))))
    return repeated.select(*(inner[name].alias(name) for name in docs.columns))
