"""Temperature mixing of sources to target weights. [DataFrame operations only]

Source weights are token shares raised to an exponent between 0 (all sources alike) and 1 (as they come) and
normalised. Bisection finds the exponent that meets a target entropy, or the flattest mixture that keeps every source
within a repetition limit. The weights are then realised under a token budget: each source is cut into blocks by hash,
every epoch is a fresh permutation of the source's blocks, whole epochs take all blocks and the last one takes blocks
in order until the source's budget is spent, with the block on the edge taken document by document.

Tokens are words between ASCII white space, plus one for the end of each document, so no source is without weight.
Block sums are small rows: at most ``BLOCKS`` blocks plus one for each source, whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipekit.session import durable

BLOCKS = 65_536
LEAST_BLOCK = 50_000
MAX_EPOCHS = 2.0
STEPS = 40


def count_tokens(text: F.Column) -> F.Column:
    words = F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return (F.size(words) + 1).cast("long")


def _measures(sources: DataFrame, exponent: float) -> tuple[float, float]:
    """Entropy in nats, and the most epochs of a source where each has at least one."""
    raw = sources.select("tokens", F.pow(F.col("share"), F.lit(exponent)).alias("raw"))
    total, logs, most, least = raw.agg(
        F.sum("raw"), F.sum(F.col("raw") * F.log("raw")),
        F.max(F.col("raw") / F.col("tokens")), F.min(F.col("raw") / F.col("tokens"))).first()
    return math.log(total) - logs / total, most / least


def find_exponent(sources: DataFrame, target_entropy: float | None = None, max_epochs: float | None = None) -> float:
    """The exponent for ``sources`` (tokens, share). A target out of reach gives the nearest end, 0 or 1."""
    def too_flat(exponent: float) -> bool:
        entropy, epochs = _measures(sources, exponent)
        return entropy > target_entropy if target_entropy is not None else epochs > (max_epochs or math.inf)

    if not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def source_weights(docs: DataFrame, target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS,
                   budget: float | None = None) -> DataFrame:
    """source, tokens, weight, quota (tokens to draw), epochs and n_blocks for each source of ``docs`` (source, _n).

    Without a ``budget``, it is the smallest that gives every source a whole epoch."""
    sums = docs.groupBy("source").agg(F.sum("_n").alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    sources = durable(sums.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1)))), "mix-sources")
    if not total:
        exponent, norm, budget = 1.0, 1.0, 0.0
    else:
        exponent = find_exponent(sources, target_entropy, max_epochs)
        norm, need = sources.select(F.pow("share", F.lit(exponent)).alias("raw"), "tokens").agg(
            F.sum("raw"), F.max(F.col("tokens") / F.col("raw"))).first()
        budget = need * norm if budget is None else budget
    block = max(LEAST_BLOCK, -(-total // BLOCKS))
    return sources.select(
        "source", "tokens", (F.pow("share", F.lit(exponent)) / F.lit(norm)).alias("weight")).withColumn(
        # A millionth of slack, so that a source meant to run once is not cut by rounding.
        "quota", F.floor(F.col("weight") * F.lit(float(budget)) * (1 + 1e-6) + 0.5).cast("long")).withColumn(
        "epochs", F.floor(F.col("quota") / F.col("tokens")).cast("long")).withColumn(
        "n_blocks", F.ceil(F.col("tokens") / F.lit(float(block))).cast("long"))


def mixture(docs: DataFrame, target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS,
            budget: float | None = None, seed: int = 1) -> DataFrame:
    """Every drawn copy: the row itself (struct ``row``), its n_tokens and weight, epoch, slot (place of its block in
    the order of the mixture) and within (order inside the block).

    A null source is a source like any other; null and empty texts count one token. Rows repeated in ``docs`` are
    drawn as often as they stand there. An empty table gives an empty result.
    """
    # The input's own columns travel in one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].alias("source"),
                       count_tokens(docs["text"]).alias("_n"), F.xxhash64(docs["doc_id"], docs["text"]).alias("_h"))
    weights = durable(source_weights(rows.select("source", "_n"), target_entropy, max_epochs, budget), "mix-weights")
    cut = weights.select(F.col("source").alias("_s"), "weight", "quota", "tokens", "epochs", "n_blocks")
    placed = rows.join(cut, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "block", F.pmod(F.xxhash64("_h", F.lit(seed)), F.col("n_blocks")))
    blocks = placed.groupBy("_s", "block").agg(F.sum("_n").alias("size"), F.first("quota").alias("quota"),
                                               F.first("tokens").alias("tokens"), F.first("epochs").alias("epochs"))
    spent = Window.partitionBy("_s").orderBy(F.xxhash64("_s", "epochs", "block", F.lit(seed)), "block").rowsBetween(
        Window.unboundedPreceding, -1)
    dealt = blocks.withColumn("left", F.col("quota") - F.col("epochs") * F.col("tokens")
                              - F.coalesce(F.sum("size").over(spent), F.lit(0)))
    dealt = dealt.withColumn("edge", F.when((F.col("left") > 0) & (F.col("left") < F.col("size")), F.col("left")))
    whole = F.when(F.col("left") >= F.col("size"), F.col("epochs") + 1).otherwise(F.col("epochs"))
    runs = dealt.select("_s", "block", "edge", F.explode(F.when((whole > 0) | F.col("edge").isNotNull(), F.sequence(
        F.lit(0).cast("long"), whole - F.when(F.col("edge").isNull(), 1).otherwise(0)))).alias("epoch"), "epochs")
    turn = Window.orderBy(F.xxhash64("_s", "epoch", "block", F.lit(seed)), "_s", "epoch", "block")
    runs = durable(runs.select("_s", "block", "epoch", F.when(F.col("epoch") == F.col("epochs"), F.col("edge")).alias(
        "edge"), (F.row_number().over(turn) - 1).cast("long").alias("slot")), "mix-runs")

    def drawn(of: DataFrame) -> DataFrame:
        r = of.select(F.col("_s").alias("_rs"), F.col("block").alias("_rb"), "epoch", "edge", "slot")
        return placed.join(r, F.col("_s").eqNullSafe(F.col("_rs")) & (F.col("block") == F.col("_rb"))).withColumn(
            "within", F.xxhash64("_h", "epoch", F.lit(seed)))

    out = ["row", "source", F.col("_n").alias("n_tokens"), "weight", "epoch", "slot", "within"]
    upto = Window.partitionBy("slot").orderBy("within", "_h").rowsBetween(Window.unboundedPreceding, 0)
    part = drawn(runs.where("edge is not null")).withColumn("_sum", F.sum("_n").over(upto)).where("_sum <= edge")
    return drawn(runs.where("edge is null")).select(*out).union(part.select(*out))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mixture draws them, with their own columns; repeated draws are repeated rows."""
    return mixture(docs, **options).select("row.*")
