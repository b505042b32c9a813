"""Mixing sources to target weights by temperature, with DataFrame functions only.

1. Words are counted per source; a source's weight is its share of all words to
   the power of an exponent, normalised.
2. The exponent is bisected on [0, 1]: the smallest one whose weights have at
   most the target entropy (a share of that of equal weights) and repeat no
   source more often than the limit. Lower exponents are more even and repeat
   small sources more. Where even 1 stays above the target entropy, 1 is taken.
   A step asks one aggregate over the sources for 32 points, five halvings at once.
3. A source's budget (weight times all words wanted) is spent in passes. A
   pass permutes the source's blocks, and the documents in a block, by hash. All
   blocks go into the whole passes; the last one takes blocks in order, then
   documents of the block that no longer fits, while the budget holds.
   ``slot`` orders the mixture: sorted by it, every stretch has the weights.
   ``__place`` also orders the documents of a block, ``position`` numbers the places.

Without a budget the smallest one is taken that gives every document a place:
nothing is dropped, small sources are repeated.

No window holds more than one block's documents or 1/256 of a source's blocks.

Defined cases
* a null source is a source of its own; null or blank text has no words;
* a source without words has weight 0, its documents come once;
* repeated rows are placed together; other columns are carried along, clashing
  names included, but names that begin with two underscores are this module's;
* an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import Workspace, whole_row

POINTS = 32
STEPS = 4


@dataclass(frozen=True)
class Mix:
    entropy: float = 0.95
    max_repeats: float = 4.0
    budget: int | None = None
    block_words: int = 1 << 16
    seed: int = 11


def word_count(text: Column) -> Column:
    parts = F.split(text, r"[\x20\x09-\x0D]+")
    return F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0)).cast("long")


def _keyed(documents: DataFrame, mix: Mix) -> DataFrame:
    return documents.withColumns({
        "__skey": F.xxhash64(F.col("source").isNull(), "source"),
        "__key": F.xxhash64(F.lit(mix.seed), "doc_id", "text", "source"),
    })


def exponent(sources: DataFrame, mix: Mix) -> float:
    """``sources`` has ``n_words``, one row per source."""
    known = sources.where("n_words > 0")
    n, total, low, high = known.agg(F.count("*"), F.sum("n_words"), F.min("n_words"), F.max("n_words")).first()
    if n < 2:
        return 1.0
    share, wanted = F.col("n_words") / F.lit(total), mix.entropy * math.log(n)

    def fits(a: float, z: float, log_sum: float) -> bool:
        repeats = (high / low) ** (1 - a) if mix.budget is None else mix.budget / total * (low / total) ** (a - 1) / z
        return math.log(z) - a * log_sum / z <= wanted and repeats <= mix.max_repeats

    left, right = 0.0, 1.0
    for step in range(STEPS):
        points = [left + (right - left) * i / POINTS for i in range(POINTS)]
        sums = [f(F.pow(share, F.lit(a))) for a in points for f in (F.sum, lambda p: F.sum(p * F.log(share)))]
        values = known.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        first = next((i for i, a in enumerate(points) if fits(a, values[2 * i], values[2 * i + 1])), None)
        if first == 0:
            return left
        left, right = (points[-1], right) if first is None else (points[first - 1], points[first])
    return right


def weights(sources: DataFrame, mix: Mix) -> DataFrame:
    """Adds exponent, weight, passes, whole (passes) and rest (words of the last pass) to each source."""
    a = exponent(sources, mix)
    total = sources.agg(F.sum("n_words")).first()[0] or 0
    known = F.col("n_words") > 0
    raw = F.when(known, F.pow(F.col("n_words") / F.lit(max(total, 1)), F.lit(a))).otherwise(0.0)
    out = sources.withColumn("__raw", raw)
    norm, highest = out.agg(F.sum("__raw"), F.max(F.when(known, F.col("n_words") / F.col("__raw")))).first()
    norm = norm or 1.0
    budget = float(mix.budget) if mix.budget is not None else (highest or 0.0) * norm
    out = out.withColumn("exponent", F.lit(a)).withColumn("weight", F.col("__raw") / norm).drop("__raw")
    out = out.withColumn("passes", F.when(known, F.round(budget * F.col("weight") / F.col("n_words"), 9)).otherwise(1.0))
    out = out.withColumn("whole", F.floor("passes"))
    return out.withColumn("rest", F.round((F.col("passes") - F.col("whole")) * F.col("n_words")).cast("long"))


def _order(mix: Mix, turn: Column) -> Column:
    """Place of a block in a pass, uniform in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(mix.seed), "__skey", "__block", turn.cast("long")), 11) / F.lit(float(1 << 53))


def _last_pass(ws: Workspace, blocks: DataFrame) -> DataFrame:
    """(__skey, __block, extra, cut): whether the last pass takes a block, and the words left for the first that does not fit."""
    blocks = blocks.withColumn("bucket", F.floor(F.col("place") * 256).cast("int"))
    sums = blocks.groupBy("__skey", "bucket").agg(F.sum("words").alias("bucket_words"))
    upto = Window.partitionBy("__skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 256 rows
    sums = sums.select("__skey", "bucket", F.coalesce(F.sum("bucket_words").over(upto), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("__skey", "bucket").orderBy("place", "__block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("ahead") + F.coalesce(F.sum("words").over(inside), F.lit(0))
    placed = blocks.join(sums, ["__skey", "bucket"]).withColumn("before", before)
    room = F.col("rest") - F.col("before")
    return ws.save(
        placed.select("__skey", "__block", F.when((F.col("rest") > 0) & (room >= F.col("words")), 1).otherwise(0).alias("extra"),
                      F.when((room > 0) & (room < F.col("words")), room).alias("cut")), "blocks")


def placed(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents with __words, __block, __copies (places in the mixture), __weight, __exponent, __passes."""
    ws = Workspace(documents.sparkSession, "mixing")
    keyed = _keyed(documents, mix)
    keys = ws.save(keyed.select("__skey", "__key", word_count(F.col("text")).alias("words")), "keys")
    sources = ws.save(keys.groupBy("__skey").agg(F.sum("words").alias("n_words")), "sources")
    sources = weights(sources, mix).withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("n_words") / mix.block_words)))
    sources = ws.save(sources, "weights")
    block = F.pmod(F.xxhash64("__key"), F.col("n_blocks")).alias("__block")
    wide = ws.save(
        keys.join(sources.select("__skey", "n_blocks", "whole", "rest"), "__skey").select("__skey", block, "__key", "words", "whole", "rest")
        .groupBy("__skey", "__block", "__key").agg(F.sum("words").alias("words"), F.first("whole").alias("whole"), F.first("rest").alias("rest")),
        "placed",
    )
    blocks = wide.groupBy("__skey", "__block").agg(F.sum("words").alias("words"), F.first("whole").alias("whole"), F.first("rest").alias("rest"))
    last = _last_pass(ws, blocks.withColumn("place", _order(mix, F.col("whole"))))
    edge = wide.join(last.where("cut is not null").select("__skey", "__block", "cut"), ["__skey", "__block"])
    in_block = Window.partitionBy("__skey", "__block").orderBy(F.xxhash64("__key", "whole"), "__key").rowsBetween(Window.unboundedPreceding, 0)
    edge = ws.save(edge.withColumn("upto", F.sum("words").over(in_block)).where("upto <= cut").select("__key", F.lit(1).alias("edge")).distinct(), "edge")
    known = sources.select("__skey", "n_blocks", "weight", "exponent", "passes", "whole")
    out = keyed.withColumn("__words", word_count(F.col("text"))).join(known, "__skey").withColumn("__block", block)
    out = out.join(last.select("__skey", "__block", "extra"), ["__skey", "__block"]).join(edge, "__key", "left")
    copies = F.col("whole") + F.col("extra") + F.coalesce("edge", F.lit(0))
    names = [F.col(c) for c in documents.columns]
    return out.select(*names, "__skey", "__key", "__words", "__block", copies.cast("long").alias("__copies"),
                      F.col("weight").alias("__weight"), F.col("exponent").alias("__exponent"), F.col("passes").alias("__passes"))


def places(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per place in the mixture: those of ``placed``, __turn, __slot and __place, by which the mixture is ordered.
    Rows with the same __place are repeated rows."""
    rows = placed(documents, mix).where("__copies > 0").withColumn("__turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
    slot = (F.col("__turn") + _order(mix, F.col("__turn"))) / F.greatest(F.col("__passes"), F.lit(1.0))
    order = F.struct("__slot", "__skey", "__block", F.xxhash64("__key", "__turn").alias("inner"), "__key")
    return rows.withColumn("__slot", slot).withColumn("__place", order)


def mixture(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per place in the mixture: the columns of ``documents`` and ``slot``, which replaces one of that name."""
    rows = documents.select("doc_id", "text", "source", whole_row(documents, "slot"))
    return places(rows, mix).select("__all.*", F.col("__slot").alias("slot"))


def ordered(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per place in the mixture: the columns of ``documents`` and ``__place``, by which a later stage sorts (it replaces one of that name)."""
    rows = documents.select("doc_id", "text", "source", whole_row(documents, "__place"))
    return places(rows, mix).select("__all.*", "__place")


def numbered(rows: DataFrame, ws: Workspace) -> DataFrame:
    """Rows with ``position``: 0, 1, 2, ... in the order of ``__place``, sorted in ranges."""
    rows = ws.save(rows, "places")
    in_order = rows.repartitionByRange("__place").sortWithinPartitions("__place").withColumn("__at", F.monotonically_increasing_id())
    in_order = ws.save(in_order, "order").withColumn("__range", F.shiftrightunsigned("__at", 33))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ahead = in_order.groupBy("__range").count().select("__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__ahead"))
    at = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return in_order.join(ws.save(ahead, "ahead"), "__range").withColumn("position", F.col("__ahead") + at).drop("__range", "__ahead", "__at")


def report(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per place, with its position in the mixture."""
    rows = places(documents, mix).select(
        "doc_id", "source", F.col("__words").alias("n_words"), F.col("__block").alias("block"), F.col("__copies").alias("copies"),
        F.round("__weight", 6).alias("weight"), F.round("__exponent", 6).alias("exponent"),
        F.col("__turn").alias("turn"), F.col("__slot").alias("slot"), "__place",
    )
    return numbered(rows, Workspace(documents.sparkSession, "mixing-order")).drop("__place")
