"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are dealt into blocks of about ``block_docs`` documents of one source by a hash, so a block
is a random sample of its source and block numbers are a random order. A source's target in words
becomes whole passes over its blocks plus one partial pass, that is a number of block draws. The
draws of all sources are split among the output shards by a binary tree: each inner node deals its
block quotas to its two halves by one multivariate-hypergeometric draw, so every quota is kept
exactly. A leaf draws the next blocks of each source, and its rows are shuffled by a hash.

Rows with equal content are told apart by nothing and share their fate, except that the boundary of
the partial pass may fall between them. A null text has no words and a null source is a source of
its own. A text without words is never drawn. A
very long text is drawn like others. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, BLOCK, ORDER = "_mix_source", "_mix_block", "_mix_order"


@dataclass(frozen=True)
class Source:
    """One source of the mixture: its key, documents, words and target in words."""

    key: str
    docs: int
    words: int
    blocks: int
    target: float

    @property
    def passes(self) -> int:
        """Whole passes over all blocks."""
        return round(self.target) // self.words if self.words else 0

    @property
    def rest(self) -> int:
        """Words of the partial pass."""
        return round(self.target) - self.passes * self.words


@F.pandas_udf(T.LongType())
def count_words(texts: pd.Series) -> pd.Series:
    """Number of runs of anything but the six ASCII blanks, which is what splitting bytes gives."""
    return texts.map(lambda text: 0 if text is None else len(text.encode().split())).astype("int64")


@F.pandas_udf(T.StringType())
def first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """The texts up to the end of their n-th word; whole where they have no more words."""

    def first(text: str, n: int) -> str:
        ends = [found.end() for found in islice(re.finditer("[^\x20\x09-\x0D]+", text), n + 1)]
        return text[: ends[n - 1]] if len(ends) > n else text

    return pd.Series([first(*pair) for pair in zip(texts, counts)], dtype=object)


def source_key(source: Column) -> Column:
    """A text that is never null and sorts by code point with null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def fill_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Targets in proportion to the weights, none above ``most`` times its size.

    What a capped source leaves goes to the others by weight, until none is above its cap. Sources
    that cannot take more than they have bound the total.
    """
    targets, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while free:
        level = left / sum(weights[i] for i in free)
        capped = {i for i in free if weights[i] * level > most * sizes[i]}
        for i in capped or free:
            targets[i] = float(most * sizes[i]) if capped else weights[i] * level
        if not capped:
            break
        left -= sum(targets[i] for i in capped)
        free -= capped
    return targets


def split_quotas(leaf: int, leaves: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The block quotas of one leaf and how many blocks of each source earlier leaves have.

    Walks down from the root; a node's draw depends on the seed and the node only, so all leaves agree.
    """
    low, high = 0, leaves
    quotas, before = quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        n_left = quotas.sum() * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(quotas, n_left, method="marginals")
        if leaf < middle:
            quotas, high = left, middle
        else:
            quotas, before, low = quotas - left, before + left, middle
    return quotas, before


def deal_draws(spark: SparkSession, keys: Sequence[str], quotas: Sequence[int], shards: int, seed: int) -> DataFrame:
    """One row per (source, draw) with its shard."""
    all_quotas = np.array(quotas, np.int64)

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leaf in batch["id"]:
                own, before = split_quotas(int(leaf), shards, all_quotas, seed)
                yield pd.DataFrame({KEY: list(keys), "shard": leaf, "first": before, "n": own})

    parts = spark.range(shards).mapInPandas(leaves, f"{KEY} string, shard bigint, first bigint, n bigint")
    draws = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))
    return parts.where("n > 0").select(KEY, "shard", draws.alias("draw"))


def allocate(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_docs: int = 1024,
    shard_blocks: int = 16,
    seed: int = 7,
    cut: bool = True,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every document with what the mixture takes of it.

    Sources in code-point order, null last, get the weights in turn; together they share ``share``
    times all words. ``keep`` are the columns to carry (default all). Adds ``size``, ``source_size``,
    ``target`` and ``draws``, an array of (shard, pass, words); columns of these names are replaced.
    With ``cut`` the document at the end of a partial pass gives only its first words, so a source's
    sum is its rounded target; otherwise documents are whole and the sum is within one document.
    """
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("size", "source_size", "target", "draws")]
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = docs.select(
        *keep, source_key(F.col("source")).alias(KEY), order.alias(ORDER), count_words("text").alias("size")
    )
    counts = docs.groupBy(source_key(F.col("source")).alias(KEY)).agg(F.count("*").alias("docs"))
    blocks_of = {r[KEY]: (r.docs, -(-r.docs // block_docs)) for r in counts.collect()}  # a row per source
    plan = spark.createDataFrame(
        [(k, int(n)) for k, (_, n) in sorted(blocks_of.items())], f"{KEY} string, _mix_blocks bigint"
    )
    dealt = sized.join(F.broadcast(plan), KEY).withColumn(BLOCK, F.expr(f"pmod({ORDER}, _mix_blocks)"))
    dealt = dealt.drop("_mix_blocks")
    blocks = dealt.groupBy(KEY, BLOCK).agg(F.sum("size").alias("_mix_words"))

    keys = sorted(blocks_of)
    words = {r[KEY]: r.words for r in blocks.groupBy(KEY).agg(F.sum("_mix_words").alias("words")).collect()}
    sizes = [words[k] for k in keys]
    targets = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(keys))], share * sum(sizes), most)
    sources = [Source(k, *blocks_of[k][:1], n, blocks_of[k][1], t) for k, n, t in zip(keys, sizes, targets)]

    table = spark.createDataFrame(
        [(s.key, s.words, s.target, s.passes, s.rest, s.blocks) for s in sources],
        f"{KEY} string, source_size bigint, target double, _mix_passes bigint, _mix_rest bigint, _mix_blocks bigint",
    )
    earlier = Window.partitionBy(KEY).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_mix_start", F.coalesce(F.sum("_mix_words").over(earlier), F.lit(0)))

    # A source's draws are its blocks in order, pass after pass; the last pass may be partial.
    quotas = [s.blocks * (s.passes + (s.rest > 0)) for s in sources]
    shards = max(1, -(-sum(quotas) // shard_blocks))
    draws = deal_draws(spark, keys, quotas, shards, seed).join(F.broadcast(table.select(KEY, "_mix_blocks")), KEY)
    by_block = draws.groupBy(KEY, (F.col("draw") % F.col("_mix_blocks")).alias(BLOCK)).agg(
        F.sort_array(
            F.collect_list(F.struct(F.expr("draw div _mix_blocks").alias("pass"), F.col("shard")))
        ).alias("_mix_draws")
    )  # at most three draws of a block

    in_block = Window.partitionBy(KEY, BLOCK).orderBy(ORDER, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_mix_before", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
    joined = placed.join(starts.drop("_mix_words"), [KEY, BLOCK]).join(F.broadcast(table), KEY)
    joined = joined.join(by_block, [KEY, BLOCK], "left")
    room = F.col("_mix_rest") - F.col("_mix_start") - F.col("_mix_before")
    if cut:
        partial = F.greatest(F.lit(0), F.least(F.col("size"), room))
    else:
        partial = F.when(room * 2 > F.col("size"), F.col("size")).otherwise(0)
    takes = F.transform(
        F.coalesce("_mix_draws", F.array().cast("array<struct<pass:bigint,shard:bigint>>")),
        lambda d: F.struct(
            d["shard"].alias("shard"),
            d["pass"].alias("pass"),
            F.when(d["pass"] < F.col("_mix_passes"), F.col("size")).otherwise(partial).alias("words"),
        ),
    )
    return joined.select(
        *keep, "size", "source_size", "target", F.filter(takes, lambda d: d["words"] > 0).alias("draws"),
        F.col(ORDER).alias("_mix_order"),
    )


def taken_words(draws: Column) -> Column:
    return F.aggregate(draws, F.lit(0).cast("bigint"), lambda total, d: total + d["words"])


def mix(docs: DataFrame, cut: bool = False, seed: int = 7, **options) -> DataFrame:
    """The mixture: a row per draw of a document with its ``shard``, ``position`` and ``words``.

    With ``cut``, the text of a document at the end of a partial pass ends after ``words`` words.
    Columns of these names are replaced.
    """
    rows = allocate(docs, seed=seed, cut=cut, **options)
    kept = [c for c in rows.columns if c not in ("size", "source_size", "target", "draws", "_mix_order")]
    drawn = rows.select(*rows.columns, F.explode("draws").alias("_mix_draw"))
    columns = [F.col(c) for c in kept if c not in ("shard", "position", "words", "text")]
    if "text" in kept:
        columns.append((first_words("text", "_mix_draw.words") if cut else F.col("text")).alias("text"))
    shuffled = F.xxhash64(F.lit(seed + 1), F.col("_mix_order"), F.col("_mix_draw.pass"))
    local = Window.partitionBy("shard").orderBy("_mix_shuffle", "_mix_order")
    out = drawn.select(
        *columns,
        F.col("_mix_draw.shard").alias("shard"),
        F.col("_mix_draw.words").alias("words"),
        shuffled.alias("_mix_shuffle"),
        "_mix_order",
    )
    return out.withColumn("position", F.row_number().over(local) - 1).drop("_mix_shuffle", "_mix_order")
