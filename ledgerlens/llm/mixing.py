"""Mixing sources to target weights through exact block quotas.

Every source is cut into blocks of about :data:`BLOCK_ROWS` documents, by a
hash. A source's target, in words, is some whole passes over its blocks and
a rest; a pass visits the blocks in a permuted order of its own, and the
rest ends inside one block, inside one document of it. All draws of blocks
are dealt out to the output shards by a splitting tree: each node divides
the quotas of all sources among its two halves by one multivariate
hypergeometric draw, so that every shard gets its exact share and the
sources are mixed alike. A shard takes, from each source, the blocks at
consecutive places of the permuted order, so shards are disjoint, and its
rows are shuffled locally.

What reaches the driver is one row per source (targets and quotas); sources
are the entries of a mixture's configuration. All else is decided row by
row from hashes, so a source with a third of all rows is no hot group.

Defined cases: a null text has size 0; null is a source of its own; a source
without words has target 0 and nothing is taken; repeated rows share a
place, and if the rest ends there, its words are shared among them; an empty
table gives an empty result; further columns are kept by :func:`mix`, but for
those named ``shard``, ``epoch`` or ``words``, which give way. A text of any length is one row of a
block; if the rest ends in it, its first words are taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, gcd

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored, unpacked, whole_row, word_count, words

SEED = 20240
BLOCK_ROWS = 32
#: Block draws of a plan at most (the sampler takes fewer than 10^9); blocks of more rows keep below it.
MOST_DRAWS = 500_000_000
SHARDS = 16
CAP = 3.0
#: Places of the permuted order whose words are summed together first.
GROUP = 1024


def cycled_weights(n: int) -> list[float]:
    """1, 2, 3, repeating."""
    return [float(1 + i % 3) for i in range(n)]


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float = CAP) -> list[float]:
    """Shares of ``total`` by weight, each at most ``cap`` times its size; what
    is cut off goes to the others by weight until none is above."""
    out = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in free)
        above = [i for i in free if left * weights[i] / weight > cap * sizes[i]]
        if not above:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in above:
            out[i] = cap * sizes[i]
        free -= set(above)
        left -= sum(out[i] for i in above)
    return out


def split_quotas(quotas: Sequence[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Quotas of every shard (rows) and source (columns): the splitting tree.

    Each node is seeded by its place, so reruns agree.
    """
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(have: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = have
            return
        mid = (low + high) // 2
        total = int(have.sum())
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(have, total * (mid - low) // (high - low), method="marginals")
        split(left, low, mid)
        split(have - left, mid, high)

    split(np.asarray(quotas, np.int64), 0, shards)
    return out


def _permutation(n: int, seed: Sequence[int]) -> tuple[int, int]:
    """(a, c) of the permutation x -> (a x + c) mod n of 0..n-1."""
    rng = np.random.default_rng(seed)
    a = int(rng.integers(1, max(2, min(n, 1 << 31))))
    while gcd(a, n) != 1:
        a += 1
    return a, int(rng.integers(0, max(1, n)))


_PLAN = ("source string, source_size long, target double, n_blocks long, passes int, rest long, perm array<struct<a:long,c:long>>, "
         "cut long, cut_hash long, cut_words long, cut_ties long, offsets array<long>")


def _hashed(df: DataFrame, size: Column) -> DataFrame:
    return df.withColumn("_size", size).withColumn("_h", F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text")))


def _with_plan(df: DataFrame, plan: list[tuple]) -> DataFrame:
    """``df`` with its source's plan as ``_p`` (one row per source)."""
    p = df.sparkSession.createDataFrame(plan, _PLAN)
    p = p.select(F.col("source").alias("_ps"), F.struct(*p.columns).alias("_p"))
    return df.join(p, df["source"].eqNullSafe(p["_ps"]), "left").drop("_ps")


def _place(epoch: Column) -> Column:
    """The place of a row's block in the permuted order of a pass."""
    perm = F.get(F.col("_p.perm"), epoch)
    block = F.pmod(F.shiftrightunsigned("_h", 1), F.col("_p.n_blocks"))
    return F.pmod(perm["a"] * block + perm["c"], F.col("_p.n_blocks"))


def make_plan(sized: DataFrame, weights: Callable[[int], Sequence[float]] = cycled_weights, share: float = 1.0,
              cap: float = CAP, shards: int = SHARDS, seed: int = SEED) -> list[tuple]:
    """The mixture's plan, one tuple (columns of ``_PLAN``) per source, from
    the narrow table ``sized`` (source, _size, _h)."""
    stats = sized.groupBy("source").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    stats.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-8")))
    if not stats:
        return []
    sizes = [r["size"] for r in stats]
    goal = targets(sizes, weights(len(stats)), share * sum(sizes), cap)
    plan = []
    per_block = max(BLOCK_ROWS, ceil((cap + 1) * sum(r["rows"] for r in stats) / MOST_DRAWS))
    for i, r in enumerate(stats):
        n = ceil(r["rows"] / per_block)
        want = round(goal[i])
        passes = int(want // sizes[i]) if sizes[i] else 0
        rest = int(want - passes * sizes[i])
        perm = [_permutation(n, [seed, i, e]) for e in range(passes + 1)]
        plan.append([r.source, sizes[i], goal[i], n, passes, rest, perm, None, None, None, None, None])
    cuts = _cuts(sized, plan)
    for p in plan:
        cut, cut_hash, cut_words, ties = cuts.get(p[0], (-1, 0, 0, 1))
        p[7:11] = cut, cut_hash, cut_words, ties
    draws = [p[4] * p[3] + p[7] + 1 for p in plan]
    quotas = split_quotas(draws, shards, seed)
    for i, p in enumerate(plan):
        p[11] = np.concatenate(([0], np.cumsum(quotas[:, i]))).tolist()
    return [tuple(p) for p in plan]


def _cuts(sized: DataFrame, plan: list[list]) -> dict:
    """Where each source's rest ends: its last place, and in that block the
    last row hash, the words still taken there, and the rows that share it.

    Sums over blocks, then over groups of :data:`GROUP` places, locate it, so
    running sums never go over a source's rows in one task.
    """
    rows = _with_plan(sized, [tuple(p) for p in plan]).where("_p.rest > 0").withColumn("_pos", _place(F.col("_p.passes")))
    blocks = stored(rows.groupBy("source", "_pos").agg(F.sum("_size").alias("w"), F.first("_p.rest").alias("rest")), "mix-blocks")

    def reached(df: DataFrame, by: str, value: str, rest: str) -> DataFrame:
        """The first row per source whose running sum reaches ``rest``, and
        what is left to take in it."""
        w = Window.partitionBy("source").orderBy(by)
        run = df.withColumn("_before", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
        return run.where((F.col("_before") < F.col(rest)) & (F.col("_before") + F.col(value) >= F.col(rest))).withColumn(
            "left", F.col(rest) - F.col("_before"))

    groups = blocks.groupBy("source", F.floor(F.col("_pos") / GROUP).alias("g")).agg(
        F.sum("w").alias("w"), F.first("rest").alias("rest"))
    group = {r.source: (r.g, r.left) for r in reached(groups, "g", "w", "rest").collect()}
    if not group:
        return {}
    spark = sized.sparkSession
    at = spark.createDataFrame([(s, g, left) for s, (g, left) in group.items()], "s string, g long, left long")
    inner = blocks.join(at, blocks["source"].eqNullSafe(at["s"]) & (F.floor(F.col("_pos") / GROUP) == F.col("g"))).select(
        "source", "_pos", "w", F.col("left").alias("rest"))
    place = {r.source: (r["_pos"], r.left) for r in reached(inner, "_pos", "w", "rest").collect()}
    at = spark.createDataFrame([(s, p, left) for s, (p, left) in place.items()], "s string, p long, left long")
    last = rows.join(at, rows["source"].eqNullSafe(at["s"]) & (F.col("_pos") == F.col("p")))
    last = last.groupBy("source", "_h").agg(F.sum("_size").alias("w"), F.count(F.lit(1)).alias("ties"), F.first("left").alias("rest"))
    return {r.source: (place[r.source][0], r["_h"], r.left, r.ties) for r in reached(last, "_h", "w", "rest").collect()}


def with_draws(df: DataFrame, plan: list[tuple]) -> DataFrame:
    """``df`` (source, _size, _h and more) with ``draws``, an array of
    (shard, pass, words), one entry for each time the row is taken."""
    out = _with_plan(df, plan)
    whole = F.when(F.col("_p.passes") > 0, F.sequence(F.lit(0), F.col("_p.passes") - 1)).otherwise(F.array().cast("array<int>"))
    pos = _place(F.col("_p.passes"))
    rest = (F.when(F.col("_p.rest") <= 0, F.lit(0)).when(pos < F.col("_p.cut"), F.col("_size"))
            .when(pos > F.col("_p.cut"), F.lit(0)).when(F.col("_h") < F.col("_p.cut_hash"), F.col("_size"))
            .when(F.col("_h") > F.col("_p.cut_hash"), F.lit(0))
            .otherwise(F.least(F.col("_size"), F.floor(F.col("_p.cut_words") / F.col("_p.cut_ties")))).cast("long"))

    def draw(epoch: Column, taken: Column) -> Column:
        index = epoch * F.col("_p.n_blocks") + _place(epoch)
        shard = F.size(F.filter(F.col("_p.offsets"), lambda o: o <= index)) - 1
        return F.struct(shard.alias("shard"), epoch.cast("int").alias("epoch"), taken.cast("long").alias("words"))

    every = F.concat(F.transform(whole, lambda e: draw(e, F.col("_size"))), F.array(draw(F.col("_p.passes"), rest)))
    return out.withColumn("draws", F.filter(every, lambda x: x["words"] > 0))


def _narrow(docs: DataFrame) -> DataFrame:
    return stored(_hashed(docs, word_count(F.col("text"))).select("doc_id", "source", "_size", "_h"), "mix-sizes")


def mix(docs: DataFrame, shards: int | None = None, **plan_args) -> DataFrame:
    """The mixed corpus: a row per time a document is taken, with ``shard``,
    ``epoch`` and ``words`` added, in shuffled order inside each shard. A
    document taken in part keeps its first ``words`` words. A shard is written
    by one task, so by default there are as many as shuffle partitions."""
    shards = shards or max(SHARDS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    plan = make_plan(_narrow(docs), shards=shards, **plan_args)
    made = ("shard", "epoch", "words")  # own columns of these names give way
    rows = docs.select(whole_row(docs, made), "doc_id", "text", "source")
    out = with_draws(_hashed(rows, word_count(F.col("text"))), plan).withColumn("_d", F.explode("draws"))
    text = F.when(F.col("_d.words") < F.col("_size"), F.array_join(
        F.slice(words(F.col("text")), F.lit(1), F.col("_d.words").cast("int")), " ")).otherwise(F.col("text"))
    own = [text.alias("text") if c == "text" else col for c, col in zip(
        [c for c in docs.columns if c not in made], unpacked(docs, made), strict=True)]
    order = F.xxhash64(F.lit(SEED), "_h", "_d.epoch")
    out = out.withColumn("_o", order).repartition("_d.shard").sortWithinPartitions("_d.shard", "_o")
    return out.select(*own, "_d.shard", "_d.epoch", "_d.words")


def op1_mixing_sources(docs: DataFrame) -> DataFrame:
    """Every document with the words the mix takes of it."""
    sized = _narrow(docs)
    out = with_draws(sized, make_plan(sized))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_p.source_size").alias("source_size"),
                      F.col("_p.target").alias("target"),
                      F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]).alias("taken"),
                      F.transform("draws", lambda d: d["shard"]).alias("shards"))
