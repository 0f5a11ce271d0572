"""Mixing sources to target weights by temperature, in DataFrame operations only.

Source shares of tokens are raised to an exponent between 0 (equal weights) and 1 (as they are) and normalised. The
exponent is bisected to meet a target entropy, and lowered no further than a limit on repetition allows. Each source
then gets budget x weight tokens: whole passes over its documents, and a last pass that stops where the budget is
reached. Documents of a source stand in a random order that a hash gives, cut into blocks; whole blocks count by
their sums, and only the block in which the budget ends is looked at document by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Halvings of the exponent's range; six are made by each pass over the table of sources.
HALVINGS, STEP = 24, 6
#: Tokens to a block of a source and to a block of the mixture.
BLOCK = 1_000_000
#: A source has no more blocks than this; they grow instead.
MOST_BLOCKS = 65_536


def _number(digest, at: int = 1) -> F.Column:
    """A number from 0 to 2^32 - 1: eight hexadecimal digits of a digest."""
    return F.conv(F.substring(digest, at, 8), 16, 10).cast("long")


def count_tokens(text) -> F.Column:
    """Runs of signs other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_exponent(sources: DataFrame, entropy: float, max_repeats: float, budget: int) -> float:
    """The exponent in [0, 1] whose weights have ``entropy`` (a share of that of equal weights) unless repeats forbid it.

    Entropy falls as the exponent rises, and so do the most repeats of any source (those of the smallest one). A
    source is repeated budget x weight / tokens times. Both are sums over sources, taken for 63 exponents in one pass,
    so the table of sources may be of any size.
    """
    low, high = 0.0, 1.0
    n, total, least = sources.filter("tokens > 0").agg(F.count("*"), F.sum("tokens"), F.min("tokens")).first()
    if not n:
        return 1.0
    aim = entropy * F.log(F.lit(float(n)))
    share = F.col("tokens") / F.lit(float(total))
    for _ in range(HALVINGS // STEP):
        width = (high - low) / 2**STEP
        points = F.explode(F.sequence(F.lit(0), F.lit(2**STEP))).alias("i")
        tried = sources.filter("tokens > 0").select(share.alias("s"), points).withColumn("x", F.lit(low) + F.col("i") * F.lit(width))
        sums = tried.groupBy("i").agg(F.sum(F.pow("s", "x")).alias("z"), F.sum(F.pow("s", "x") * F.col("x") * F.log("s")).alias("e"))
        repeats = F.pow(F.lit(least / total), F.lit(low) + F.col("i") * F.lit(width)) / F.col("z") * budget / least
        # The smallest exponent at which neither the entropy is over the aim nor a source is repeated too often.
        good = sums.filter((F.log("z") - F.col("e") / F.col("z") <= aim + 1e-9) & (repeats <= max_repeats + 1e-9))
        i = good.agg(F.min("i")).first()[0]
        i = 2**STEP if i is None else i
        low, high = low + max(0, i - 1) * width, low + i * width
    return round(high, 6)


def _decide(
    docs: DataFrame,
    entropy: float = 0.95,
    max_repeats: float = 4.0,
    budget: int | None = None,
    block: int = BLOCK,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, int]:
    text_key = F.coalesce(F.md5(F.col(text_col)), F.lit("-"))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), text_key))
    given = docs.drop(*[c for c in docs.columns if c.lower() in ("tokens", "mix_key")]).withColumns({"tokens": count_tokens(F.col(text_col)), "mix_key": key})
    narrow = stage(given.select(F.col(source_col).alias("source"), "mix_key", "tokens"), "tokens")
    sources = stage(narrow.groupBy("source").agg(F.sum("tokens").alias("size")), "sources")

    total = sources.agg(F.sum("size")).first()[0] or 0
    budget = total if budget is None else budget
    exponent = weight_exponent(sources.select(F.col("size").alias("tokens")), entropy, max_repeats, budget)
    live = sources.filter("size > 0")
    powers = F.pow(F.col("size") / F.lit(float(total or 1)), F.lit(exponent))
    norm = live.agg(F.sum(powers)).first()[0] or 1.0
    share = F.when(F.col("size") > 0, powers / F.lit(norm)).otherwise(F.lit(0.0))
    goal = F.floor(F.lit(float(budget)) * F.col("weight"))
    if exponent == 1 and total:
        # Shares as they are: in whole numbers, as a product of doubles may fall just short of the source's own size.
        goal = F.expr(f"cast({int(budget)} as decimal(18,0)) * cast(size as decimal(18,0)) div {total}")
    sources = sources.withColumn("weight", share).withColumn("goal", goal)
    sources = sources.withColumn("passes", F.when(F.col("size") > 0, F.expr("goal div size")).otherwise(F.lit(1)))
    sources = sources.withColumn("left", F.when(F.col("size") > 0, F.expr("goal % size")).otherwise(F.lit(0)))
    sources = stage(sources.withColumn("blocks", F.least(F.ceil(F.col("size") / block), F.lit(MOST_BLOCKS))), "weights")

    same_source = F.col("source").eqNullSafe(F.col("of"))
    of = sources.withColumnRenamed("source", "of")
    own_block = F.floor(_number("mix_key") * F.col("blocks") / F.lit(2.0**32))
    placed = narrow.filter("tokens > 0").join(of, same_source).select("of", "left", "mix_key", "tokens", own_block.alias("block"))
    sums = placed.groupBy("of", "left", "block").agg(F.sum("tokens").alias("tokens"))
    so_far = F.sum("tokens").over(Window.partitionBy("of").orderBy("block"))
    ends = sums.withColumn("before", so_far - F.col("tokens")).filter("before <= left and left < before + tokens")
    ends = stage(ends.select(F.col("of").alias("end_of"), F.col("block").alias("end_block"), (F.col("left") - F.col("before")).alias("rest")), "ends")
    within = placed.join(ends, F.col("of").eqNullSafe(F.col("end_of")) & (F.col("block") == F.col("end_block")))
    within = within.groupBy("end_of", "rest", "mix_key").agg(F.sum("tokens").alias("tokens"))
    fits = F.sum("tokens").over(Window.partitionBy("end_of").orderBy("mix_key")) <= F.col("rest")
    last = within.withColumn("fits", fits).filter("fits").groupBy("end_of").agg(F.max("mix_key").alias("end_key"))
    ends = ends.join(last.withColumnRenamed("end_of", "last_of"), F.col("end_of").eqNullSafe(F.col("last_of")), "left").select("end_of", "end_block", "end_key")
    decided = of.join(ends, F.col("of").eqNullSafe(F.col("end_of")), "left").select("of", "weight", "passes", "blocks", "end_block", "end_key")
    decided = stage(decided.select(*[F.col(c).alias(f"__{c}") for c in decided.columns]), "decisions")

    mine = F.floor(_number("mix_key") * F.col("__blocks") / F.lit(2.0**32))
    again = (mine < F.col("__end_block")) | ((mine == F.col("__end_block")) & (F.col("mix_key") <= F.coalesce("__end_key", F.lit(""))))
    repeats = F.when(F.col("tokens") == 0, F.lit(1)).otherwise(F.col("__passes") + F.coalesce(again, F.lit(False)).cast("int")).cast("long")
    rows = given.join(decided, F.col(source_col).eqNullSafe(F.col("__of")))
    return rows.withColumns({"weight": F.col("__weight"), "repeats": repeats}).drop(*decided.columns), budget


def plan_mixture(docs: DataFrame, **options) -> DataFrame:
    """The input's rows with tokens, weight, mix_key and repeats: how often the mixture takes the document.

    ``budget`` is the mixture's size in tokens, by default that of the input. ``entropy`` is the target as a share of
    log(number of sources), ``max_repeats`` the most passes over any source; where even the shares as they are don't
    meet them, these are taken. A source gets floor(budget x weight) tokens: each document as often as whole passes
    fit, and the documents that fit whole into what is left, in the order of their hash, once more.

    A null source is a source of its own. A null text or one without words has 0 tokens and is taken once, as it
    costs no budget. Rows with equal ids and texts share a place, and each counts. An empty table gives an empty
    result. Columns of the input with one of the new names are replaced.

    Documents are only joined with one row per source; whatever else moves has no text.
    """
    return _decide(docs, **options)[0]


def mix_sources(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mixture: every document as often as ``plan_mixture`` says, with pass, mix_block and mix_order.

    Blocks hold about ``block`` tokens of all sources in their weights, and mix_order puts a block's rows in a random
    order of its own (rows with equal ids and texts in one pass tie). Writing the rows by (mix_block, mix_order) gives the order of training.
    """
    planned, budget = _decide(docs, block=block, **options)
    blocks = max(1, -(-budget // block))
    rows = planned.filter("repeats > 0").withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    place = F.md5(F.concat_ws("|", "mix_key", F.col("pass").cast("string")))
    return rows.withColumns({"mix_block": F.floor(_number(place) * F.lit(blocks) / F.lit(2.0**32)), "mix_order": _number(place, 9)})
