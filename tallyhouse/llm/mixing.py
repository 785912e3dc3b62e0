"""Mixing sources to target weights: temperature, budgets, block permutations. DataFrame code only.

Each source's share of the tokens is raised to an exponent between 0 (all sources alike) and 1 (as
they are) and normalised. The exponent is bisected until the weights reach a target entropy, or until no
source is repeated more often than allowed. A source's budget of tokens is its weight of the whole
budget; it is read epoch by epoch. Its documents lie in blocks of bounded size. Each epoch takes
the blocks in another order, and the documents of a block in another order, until the budget is
used up. ``position`` is the part of its source's budget that comes before a document, so reading
all sources by position mixes them by their weights from beginning to end.

A null source is a source of its own. Null, empty and blank texts have no tokens: they are placed once,
at the start. Very long texts are documents like others, larger than a block if need be. Equal hashes are
ordered by block and row number, repeated rows are rows of their own, an empty table gives an empty mixture,
and other columns than ``doc_id``, ``source`` and ``text`` may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, free_name, numbered
from tallyhouse.operators.skew import skew_join

BLOCK_TOKENS = 1 << 20
MAX_REPEATS = 2.0
EPOCH_RANGE = 1 << 16
RANGE_BITS = 12
_STEPS, _POINTS, _DIGITS = 6, 15, 6


def n_tokens(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null, also for rows without a source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def bisect_exponent(shares: DataFrame, target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent for shares (p > 0, summing to 1).

    With ``target_entropy``, in nats, the largest exponent whose weights have at least that
    entropy. With ``max_repeats``, the smallest at which no source is read more often than that
    while every source is read once. Each pass over the sources tries several exponents, which
    narrows the bracket as four halvings do.
    """
    low, high = 0.0, 1.0
    for _ in range(_STEPS):
        tries = [low + (high - low) * i / (_POINTS + 1) for i in range(1, _POINTS + 1)]
        grid = shares.select("p", F.explode(F.array(*[F.lit(a) for a in tries])).alias("a"))
        raised = F.pow("p", "a")
        sums = grid.groupBy("a").agg(
            F.sum(raised).alias("z"),
            F.sum(raised * F.log("p")).alias("zl"),
            (F.max(raised / F.col("p")) / F.min(raised / F.col("p"))).alias("repeats"),
        )
        measured = sums.select("a", (F.log("z") - F.col("a") * F.col("zl") / F.col("z")).alias("entropy"), "repeats").collect()
        for row in sorted(measured):
            if target_entropy is not None:
                up = row["entropy"] >= target_entropy
            else:
                up = row["repeats"] > max_repeats
            if up:
                low = row["a"]
            else:
                high = row["a"]
                break
    return round(low if target_entropy is not None else high, _DIGITS)


def source_weights(
    tokens: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: int | None = None
) -> DataFrame:
    """Per source of ``tokens`` (s, tokens): its tokens, share, weight, budget and epochs.

    Without ``budget`` it is the least with which every source is read at least once.
    """
    totals = cut_lineage(tokens.groupBy("s").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("docs")), "totals")
    whole = totals.agg(F.sum("total")).first()[0] or 0
    shares = totals.where("total > 0").withColumn("p", F.col("total") / F.lit(float(max(whole, 1))))
    exponent = bisect_exponent(shares.select("p"), target_entropy, None if target_entropy is not None else max_repeats)
    raised = shares.withColumn("raised", F.pow("p", F.lit(exponent)))
    z, most = raised.agg(F.sum("raised"), F.max(F.col("p") / F.col("raised"))).first()
    tokens_in_all = F.lit(float(budget)) if budget is not None else F.lit((z or 0.0) * (most or 0.0) * whole)
    weighted = raised.withColumn("weight", F.col("raised") / F.lit(z or 1.0)).withColumn("exponent", F.lit(exponent))
    sized = weighted.withColumn("budget", F.round(F.col("weight") * tokens_in_all).cast("long"))
    # Sums of doubles may differ in the last digits: an epoch that is all but whole is whole.
    sized = sized.withColumn("budget", F.when(F.abs(F.col("budget") - F.col("total")) <= 1, F.col("total")).otherwise(F.col("budget")))
    return cut_lineage(
        sized.select(
            "s", "total", "docs", "p", "exponent", "weight", "budget", F.floor(F.col("budget") / F.col("total")).cast("long").alias("epochs")
        ),
        "weights",
    )


def _each_epoch(df: DataFrame) -> DataFrame:
    """Each row once for each epoch from 0 to ``epochs``. A small source under a large budget is read billions
    of times, so ranges of epochs come first and no row holds a list of all."""
    ranges = df.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs"), F.lit(EPOCH_RANGE).cast("long"))))
    last = F.least(F.col("_from") + (EPOCH_RANGE - 1), F.col("epochs"))
    return ranges.withColumn("epoch", F.explode(F.sequence(F.col("_from"), last))).drop("_from", "epochs")


def _block_starts(by_block: DataFrame, seed: int) -> DataFrame:
    """Tokens of a source that come before each of its blocks (s, block, epoch), epochs before included.

    The blocks of an epoch are ordered by a hash. Its highest bits cut the order into even ranges, so
    only the ranges' sums meet in one task, and no task gets all the blocks of a large source.
    """
    order = F.xxhash64("s", "block", "epoch", F.lit(seed))
    placed = _each_epoch(by_block).withColumn("place", order).withColumn("range", F.shiftright("place", 64 - RANGE_BITS))

    def before(*keys: str) -> WindowSpec:
        return Window.partitionBy("s", "epoch", *keys).rowsBetween(Window.unboundedPreceding, -1)

    sums = placed.groupBy("s", "epoch", "range").agg(F.sum("tokens").alias("tokens"))
    ranges = sums.select("s", "epoch", "range", F.coalesce(F.sum("tokens").over(before().orderBy("range")), F.lit(0)).alias("earlier"))
    inside = F.coalesce(F.sum("tokens").over(before("range").orderBy("place", "block")), F.lit(0))
    within = placed.select("s", "epoch", "range", "block", (inside + F.col("epoch") * F.col("total")).alias("start"))
    start = F.col("start") + F.col("earlier")
    return within.join(ranges, ["s", "epoch", "range"]).select("s", "block", "epoch", start.alias("block_start"))


def mixture(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame, str]:
    """The rows as numbered, their places in the mixture, and the number's name.

    A place has row, doc_id, source, epoch (from 0), block, tokens, weight and position. A null
    source is a source of its own. Rows without tokens (null or blank text) cost nothing and are
    placed once, at the start. Repeated rows are rows of their own. A document is placed only if
    it fits what is left of the budget, so a source falls short of it by less than one document.
    """
    stored, row = numbered(docs, "documents")
    facts = stored.select(
        F.col(row).alias("row"), "doc_id", "source", source_key(F.col("source")).alias("s"), n_tokens(F.col("text")).alias("tokens")
    )
    facts = cut_lineage(facts, "tokens")
    weights = source_weights(facts.select("s", "tokens"), target_entropy, max_repeats, budget)

    blocked = skew_join(facts.where("tokens > 0"), weights.drop("docs", "p", "exponent"), "s")
    n_blocks = F.ceil(F.col("total") / block_tokens)
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(seed)), n_blocks))
    by_block = blocked.groupBy("s", "block").agg(
        F.sum("tokens").alias("tokens"), F.first("total").alias("total"), F.first("budget").alias("budget"), F.first("epochs").alias("epochs")
    )
    starts = _block_starts(cut_lineage(by_block, "blocks"), seed)
    copies = _each_epoch(blocked.select("row", "doc_id", "source", "s", "block", "tokens", "weight", "budget", "epochs"))
    in_block = Window.partitionBy("s", "block", "epoch").orderBy(F.xxhash64("row", "epoch", F.lit(seed)), "row")
    earlier = F.coalesce(F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        copies.join(starts, ["s", "block", "epoch"])
        .withColumn("start", F.col("block_start") + earlier)
        .where(F.col("start") + F.col("tokens") <= F.col("budget"))
        .select("row", "doc_id", "source", "epoch", "block", "tokens", "weight", (F.col("start") / F.col("budget")).alias("position"))
    )
    free = facts.where("tokens = 0").select(
        "row", "doc_id", "source", F.lit(0).cast("long").alias("epoch"), F.lit(0).cast("long").alias("block"), "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("position")
    )
    return stored, placed.unionByName(free), row


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mixture in their own columns, one row for each epoch that reads them."""
    stored, places, row = mixture(docs, **options)
    epochs, one = free_name(docs, "_epochs"), free_name(docs, "_epoch")
    times = places.groupBy(F.col("row").alias(row)).agg(F.collect_list("epoch").alias(epochs))
    kept = stored.join(times.hint("shuffle_hash"), row)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(epochs).alias(one)).drop(one)
