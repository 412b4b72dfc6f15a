"""Mix sources to target weights by temperature, in DataFrame operations only.

The token share p of each source is raised to an exponent a and normalised:
w = p^a / sum(p^a).  a = 1 keeps the shares, a = 0 makes all sources equal; the
entropy of w and the largest number of repetitions both grow as a falls.  The
exponent is found by bisection: the largest a that reaches the target entropy,
or, if that would repeat a source more than ``max_epochs`` times, the smallest a
that does not.  If the shares reach the target as they are, a is 1.

Weights are realised as permutations under a budget of tokens (all tokens of
the input unless given).  The quota of a source is floor(w * budget).  Each pass
over a source is a permutation of its documents by hash.  Whole passes are taken
while the quota lasts (a source with a quota of 0 is left out); of the last, partial pass the longest beginning that fits
the rest of the quota is taken.

Cases: null and empty texts have no tokens and take nothing from a quota; a
source without any token has weight 0 and none of its documents is taken; a null
source is a source; repeated rows are rows of their own, and rows whose
permutation key is equal are taken together or not at all; an empty table gives
an empty one; extra columns of any name stay (the mixture's own columns start
with ``mix_``; a column of such a name in the input is replaced).

No source is gathered in one task.  The end of a partial pass is found in two
steps: tokens are summed per source and key prefix (a block), blocks are run
through in order, and only the one block in which the quota ends is sorted.
What decides about a row then is one row per source.  The driver receives sums,
never sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postwright.llm.common import small_side, stage

#: Entropy to reach, as a share of the greatest possible (all sources equal).
TARGET_ENTROPY = 0.95
#: Most passes over a source, on average over its tokens.
MAX_EPOCHS = 4.0
#: Rows that a block of a permutation holds on average, at most.
BLOCK_ROWS = 4096
#: Exponents tried at once, and how often the bracket is narrowed.
GRID, ROUNDS = 16, 6
#: Decimals of the exponent.
DECIMALS = 6

TOKEN = r"[^\x20\x09-\x0D]+"


def tokens(text: str = "text") -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")


def _key(seed: int, epoch: Column, key: str) -> Column:
    """Place of a row in the permutation of a pass, as 32 hexadecimal digits."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name))


def exponent(
    sources: DataFrame,
    budget: float,
    target_entropy: float = TARGET_ENTROPY,
    max_epochs: float = MAX_EPOCHS,
) -> float:
    """The exponent for a table of (share, tokens); the driver sees sums of powers only.

    Each round evaluates a grid of exponents in one aggregation and keeps the
    cell in which the condition changes.
    """
    facts = sources.agg(
        F.count(F.lit(1)).alias("n"), F.min("share").alias("least"), F.sum("n_tokens").alias("all")
    ).first()
    if not facts["n"] or facts["n"] == 1:
        return 1.0
    target = target_entropy * math.log(facts["n"])

    def solve(holds) -> tuple[float, float]:
        """The bracket around the a up to which ``holds`` is true (it is for small a only)."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
            power = [F.pow(F.col("share"), F.lit(a)) for a in grid]
            sums = sources.agg(
                *[F.sum(p).alias(f"z{k}") for k, p in enumerate(power)],
                *[F.sum(p * F.log("share")).alias(f"l{k}") for k, p in enumerate(power)],
            ).first()
            good = [holds(a, sums[f"z{k}"], sums[f"l{k}"]) for k, a in enumerate(grid)]
            if good[-1] or not good[0]:
                return (high, high) if good[-1] else (low, low)
            last = good.index(False) - 1
            low, high = grid[last], grid[last + 1]
        return low, high

    by_entropy, _ = solve(lambda a, z, l: math.log(z) - a * l / z >= target)
    # the source of least share repeats most; how often falls as a rises
    repeats = lambda a, z: budget / facts["all"] * facts["least"] ** (a - 1) / z
    _, by_epochs = solve(lambda a, z, _: repeats(a, z) > max_epochs)
    return round(max(by_entropy, by_epochs), DECIMALS)


def plan(
    rows: DataFrame,
    key: str = "doc_id",
    budget: int | None = None,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
    **target: float,
) -> DataFrame:
    """One row per source: share, weight, quota, whole passes and the key where the last ends.

    ``rows`` is a staged table of (key, source, n_tokens).
    """
    totals = rows.groupBy("source").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_rows")
    )
    facts = totals.agg(F.sum("n_tokens").alias("t"), F.sum("n_rows").alias("n")).first()
    all_tokens, n_rows = facts["t"] or 0, facts["n"] or 0
    budget = all_tokens if budget is None else budget
    shares = stage(
        totals.filter("n_tokens > 0")
        .withColumn("share", F.col("n_tokens") / F.lit(float(all_tokens or 1))),
        "shares",
    )
    a = exponent(shares, float(budget), **target)
    z = shares.agg(F.sum(F.pow("share", F.lit(a))).alias("z")).first()["z"] or 1.0
    weight = F.pow("share", F.lit(a)) / F.lit(z)
    quotas = shares.select(
        F.col("source").alias("q_source"), "share", "n_tokens",
        weight.alias("weight"),
        # a little more than nothing, so that sums in another order give the same whole number
        F.floor(weight * F.lit(float(budget)) * F.lit(1 + 1e-12)).alias("quota"),
    ).filter("quota > 0").select(
        "*", F.expr("quota div n_tokens").alias("passes"), F.expr("quota % n_tokens").alias("rest")
    )
    quotas = stage(quotas, "quotas")
    small = small_side(quotas, 128)
    digits = 0 if n_rows <= block_rows else math.ceil(math.log(n_rows / block_rows, 16))
    same = F.col("source").eqNullSafe(F.col("q_source"))

    # tokens per block of each source's partial pass, summed before the exchange
    placed = rows.join(small.select("q_source", "passes", "rest"), same).select(
        "q_source", "rest", "n_tokens", _key(seed, F.col("passes"), key).alias("place")
    )
    block = F.substring("place", 1, digits) if digits else F.lit("")
    blocks = placed.groupBy("q_source", "rest", block.alias("block")).agg(
        F.sum("n_tokens").alias("tokens")
    )
    upto = F.sum("tokens").over(Window.partitionBy("q_source").orderBy("block"))
    # the block in which the rest ends, and what the blocks before it have used
    ends = stage(
        blocks.withColumn("upto", upto)
        .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("tokens") <= F.col("rest")))
        .select(
            F.col("q_source").alias("e_source"), F.col("block").alias("e_block"),
            (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"),
        ),
        "ends",
    )
    inside = (
        placed.withColumn("block", block)
        .join(
            small_side(ends, 128),
            F.col("q_source").eqNullSafe(F.col("e_source")) & (F.col("block") == F.col("e_block")),
        )
        .groupBy("e_source", "left", "place").agg(F.sum("n_tokens").alias("tokens"))
    )
    reached = F.sum("tokens").over(Window.partitionBy("e_source").orderBy("place"))
    last = (
        inside.withColumn("reached", reached).filter("reached <= left")
        .groupBy("e_source").agg(F.max("place").alias("last"))
    )
    # without a row that fits, the pass ends before the block
    cut = ends.join(
        last.withColumnRenamed("e_source", "l_source"),
        F.col("e_source").eqNullSafe(F.col("l_source")), "left",
    ).select("e_source", F.coalesce("last", "e_block").alias("cut"))
    return stage(
        quotas.join(cut, F.col("q_source").eqNullSafe(F.col("e_source")), "left")
        .select("q_source", "share", "n_tokens", "weight", "quota", "passes", "cut"),
        "mixture",
    )


def mix(
    documents: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    budget: int | None = None,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
    **target: float,
) -> DataFrame:
    """The documents as often as the mixture takes them.

    Columns as they came, then ``mix_tokens``, ``mix_weight`` (of the source),
    ``mix_epoch`` (which pass) and ``mix_order``: the millionths of its source's
    quota that stand before the row on average.  Reading the rows by
    ``mix_order`` gives each source its weight in every stretch.
    """
    rows = stage(
        documents.select(
            F.col(key), F.col(source).alias("source"), tokens(text).alias("n_tokens")
        ),
        "tokens",
    )
    mixture = plan(rows, key, budget, seed, block_rows, **target)
    epochs = F.expr("explode(sequence(0L, _passes))")
    joined = (
        documents.select(F.struct(*documents.columns).alias("_doc"), key, source, text)
        .join(
            small_side(mixture, 128).select(
                "q_source", F.col("n_tokens").alias("_total"), F.col("weight").alias("_weight"),
                F.col("quota").alias("_quota"), F.col("passes").alias("_passes"),
                F.col("cut").alias("_cut"),
            ),
            F.col(source).eqNullSafe(F.col("q_source")),
        )
    )
    counted = joined.withColumn("_tokens", tokens(text)).withColumn("_epoch", epochs)
    placed = counted.withColumn("_place", _key(seed, F.col("_epoch"), key))
    # every source has a cut, as the rest is less than its tokens
    taken = placed.filter(
        (F.col("_epoch") < F.col("_passes")) | (F.col("_place") <= F.col("_cut"))
    )
    # the first 13 digits of the place as a fraction of their greatest value
    fraction = F.conv(F.substring("_place", 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    order = (F.col("_epoch") + fraction) * F.col("_total") / F.col("_quota") * F.lit(1e6)
    names = [c for c in documents.columns if c not in
             ("mix_tokens", "mix_weight", "mix_epoch", "mix_order")]
    return taken.select(
        *[F.col("_doc").getField(c).alias(c) for c in names],
        F.col("_tokens").alias("mix_tokens"),
        F.round("_weight", 9).alias("mix_weight"),
        F.col("_epoch").alias("mix_epoch"),
        F.floor(order).alias("mix_order"),
    )
