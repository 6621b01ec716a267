"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of (source, language, topic). The cells' token weights are raked:
scaled in turn to the target shares of sources, of languages and of topics until all three hold.
Raked weights over actual tokens give each cell a rate, and one scale turns the rates into sampling
probabilities whose expected tokens meet the budget. Built-in functions only.
"""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import spill, words_of

KEYS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mixture:
    """Targets of a mixture.

    ``powers``: a marginal's target share is its actual share to this power, rescaled (1 keeps it,
    0 makes all equal). ``shares``: fixed shares by key, which go before the powers; values that are
    not named share what is left by their powers. ``budget``: expected share of all tokens to keep.
    """

    powers: Mapping[str, float] = field(
        default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 1.0}
    )
    shares: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    budget: float = 0.5
    rounds: int = 24
    seed: str = "mix"
    small_cells: int = 200_000


def topic_of(text: Column) -> Column:
    """A topic by form: numbers, markup, lists or prose, from built-in counts."""
    size = F.greatest(F.length(text), F.lit(1))
    digits = F.length(text) - F.length(F.regexp_replace(text, "[0-9]+", ""))
    lines = F.size(F.split(text, "\n"))
    return (
        F.when(digits * 50 > size, "numbers")
        .when(text.rlike("[#$%&*]{2}"), "markup")
        .when(lines * 120 > size, "lists")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def with_mixing_keys(docs: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` of ``docs``, with source, lang and topic of each row and n_tokens; a
    null source or language is the value ''."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        *names,
        F.coalesce("source", F.lit("")).alias("_m_source"),
        F.coalesce("lang", F.lit("")).alias("_m_lang"),
        topic_of(text).alias("_m_topic"),
        token_count(F.col("text")).alias("_m_tokens"),
    )


def _targets(cells: DataFrame, key: str, mixture: Mixture) -> DataFrame:
    """``cells`` with the target share of their ``key``."""
    by, everything = Window.partitionBy(key), Window.partitionBy(F.lit(1))
    tokens = F.sum("tokens").over(by)
    named = mixture.shares.get(key, {})
    fixed = F.lit(None).cast("double")
    for value, share in named.items():
        fixed = F.when(F.col(key) == value, F.lit(float(share))).otherwise(fixed)
    # Each cell carries its part of the marginal's power, so that a plain sum adds a marginal once.
    cells = cells.withColumn("_all", tokens).withColumn("_fixed", fixed)
    part = F.pow(F.col("_all").cast("double"), F.lit(float(mixture.powers[key])))
    within = F.coalesce(F.try_divide(F.col("tokens"), F.col("_all")), F.lit(0.0))
    part = part * within
    free = F.when(F.col("_fixed").isNull(), part).otherwise(0.0)
    held = F.when(F.col("_fixed").isNotNull(), F.col("_fixed") * within).otherwise(0.0)
    cells = cells.withColumn("_free", F.sum(free).over(everything))
    cells = cells.withColumn("_held", F.sum(held).over(everything))
    left = F.greatest(1 - F.col("_held"), F.lit(0.0))
    share = F.when(
        F.col("_fixed").isNull(),
        F.try_divide(
            left * F.pow(F.col("_all").cast("double"), F.lit(float(mixture.powers[key]))),
            F.col("_free"),
        ),
    ).otherwise(F.col("_fixed"))
    return cells.withColumn(f"target_{key}", F.coalesce(share, F.lit(0.0))).drop("_all", "_fixed", "_free", "_held")


def rake(cells: DataFrame, mixture: Mixture) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with target shares and the raked ``weight``.

    The cells are as many as the keys' values combine, not as the documents; few cells are one
    partition, whose windows need no shuffle. Cells without tokens keep weight 0.
    """
    few = cells.count() <= mixture.small_cells
    together = lambda df: df.coalesce(1) if few else df
    cells = together(cells)
    for key in KEYS:
        cells = _targets(cells, key, mixture)
    cells = spill(cells.withColumn("weight", F.col("tokens").cast("double")), "targets")
    done = 0
    while done < mixture.rounds:
        step = min(4, mixture.rounds - done)
        cells = together(cells)
        for _ in range(step):
            for key in KEYS:
                total = F.sum("weight").over(Window.partitionBy(key))
                scaled = F.col("weight") * F.col(f"target_{key}") / total
                cells = cells.withColumn("weight", F.when(total > 0, scaled).otherwise(0.0))
        cells, done = spill(cells, "raked"), done + step
    return cells


def calibrate(cells: DataFrame, mixture: Mixture) -> DataFrame:
    """Adds ``rate``: the sampling probability of a token of the cell, at most 1.

    ``min(1, scale * weight / tokens)`` with the scale at which the expected tokens are the budget.
    Expected tokens only bend where a cell reaches probability 1, so that the scale follows from
    sums over the cells in the order in which they get there.
    """
    few = cells.count() <= mixture.small_cells
    cells = (cells.coalesce(1) if few else cells).withColumn(
        "pull", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    )
    everything = Window.partitionBy(F.lit(1))
    full = everything.orderBy(F.desc("pull"), *KEYS).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("tokens").over(full), F.lit(0))
    behind = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0))
    budget = F.lit(float(mixture.budget)) * F.sum("tokens").over(everything)
    cells = cells.withColumn("_scale", F.try_divide(budget - ahead, behind))
    # With the cells ahead full, this one is not: the first such cell holds the scale.
    open_cell = (F.col("pull") > 0) & (F.col("_scale") >= 0) & (F.col("_scale") * F.col("pull") <= 1)
    fits = F.when(open_cell, F.col("_scale"))
    scale = F.coalesce(F.max(fits).over(everything), F.lit(float("inf")))
    rate = F.when(F.col("pull") > 0, F.least(F.lit(1.0), scale * F.col("pull"))).otherwise(0.0)
    return cells.withColumn("rate", rate).drop("pull", "_scale")


def uniform(key: Column, seed: str) -> Column:
    """A number from 0 to 1 (exclusive) that depends on ``key`` and ``seed`` alone."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 12)
    return F.conv(digest, 16, 10).cast("double") / float(1 << 48)


def mix(docs: DataFrame, mixture: Mixture = Mixture(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row, with source, lang, topic, n_tokens, weight, probability, kept.

    ``weight`` is the cell's raked share of the mixture. Rows are drawn by a hash of doc_id (of the
    text where doc_id is null), so that repeated rows are drawn alike and a rerun draws the same.
    Null texts have no tokens and the probability of their cell; a cell without tokens has 0. An
    empty table gives no rows. Columns starting with ``_m_`` or ``_r_`` are reserved.
    """
    keyed = with_mixing_keys(docs, *keep, F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")).alias("_m_key"))
    counted = keyed.groupBy(*[F.col(f"_m_{k}").alias(k) for k in KEYS]).agg(
        F.sum("_m_tokens").alias("tokens")
    )
    cells = spill(calibrate(rake(spill(counted, "cells"), mixture), mixture), "rates")
    rates = cells.select(*[F.col(k).alias(f"_r_{k}") for k in (*KEYS, "weight", "rate")])
    on = [F.col(f"_m_{k}") == F.col(f"_r_{k}") for k in KEYS]
    few = cells.count() <= mixture.small_cells
    joined = keyed.join(F.broadcast(rates) if few else rates, on)
    return joined.select(
        *[F.col(c) for c in keep],
        *[F.col(f"_m_{k}").alias(f"_m_{k}") for k in KEYS],
        "_m_tokens",
        F.col("_r_weight").alias("_m_weight"),
        F.col("_r_rate").alias("_m_rate"),
        (uniform(F.col("_m_key"), mixture.seed) < F.col("_r_rate")).alias("_m_kept"),
    )


def mixed_documents(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The drawn rows of ``docs``, with their own columns."""
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("_m_row"), "doc_id", "text", "source", "lang")
    return mix(packed, mixture, keep=("_m_row",)).filter("_m_kept").select("_m_row.*")
