"""How far the sources of a language are apart in their use of terms.

Tasks count the terms of the texts they read by (lang, source), and Spark adds
these up. The terms of a language are dealt into blocks by hash, so that a
block holds about :data:`BLOCK_ROWS` counts however large the vocabulary or
the language is; in its block a term gets a small id. A group's counts in a
block are a sorted (term id, count) array. For each unordered pair of groups
of a language and each block the two arrays meet in one row, where a
galloping intersection finds the terms of both; these, the terms of one side
only, and, with all blocks added up, the terms of neither are priced. The price of a pair is
the same both ways.

All arithmetic is in integers: products that could leave a long are divided
digit by digit (:func:`share`) or are decimals.

Defined cases: null text, lang and source count as empty strings; a group
without terms is priced as one with no occurrence; where a language keeps no
term every pair is 0 apart and there are no term rows; equal values are
ranked by their item (UTF-8, ascending); repeated rows count each; further columns are ignored. A text of any length is counted
whole, in pieces of :data:`PIECE` bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

#: A-Z to a-z; every other ASCII character but a-z ends a term.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE = 4 << 20
#: Distinct terms that a task holds before it sends what it counted.
HELD_TERMS = 400_000
BLOCK_ROWS = 1 << 16
#: Groups broadcast at most (some 100 bytes each); beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 1 << 16
UNIT = 1_000_000_000


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    data = text.encode("utf-8").translate(_LOWER)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= PIECE else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in count.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), terms, pa.array(list(n.values()), pa.int64()),
                 pa.array([docs[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
        count.clear()

    held = 0
    for b in batches:
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            if (lang, source) not in count:
                count[lang, source] = Counter(), Counter()
            n, docs = count[lang, source]
            before, here = len(n), set()
            for words in _terms(text):
                n.update(words)
                here.update(words)
            docs.update(here)
            held += len(n) - before
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(lang, source, block, id, term, n, lang_n) of the terms in at least
    ``least_docs`` documents of their language. ``counts`` is stored; one shuffle by (lang, block)
    serves the sums of a term and its id."""
    blocks = max(1, -(-counts.count() // block_rows))
    dealt = counts.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")).repartition("lang", "block")
    of_term = Window.partitionBy("lang", "block", "term")
    known = dealt.withColumns({"lang_n": F.sum("n").over(of_term), "_docs": F.sum("docs").over(of_term)})
    in_order = Window.partitionBy("lang", "block").orderBy("term")
    return (known.where(F.col("_docs") >= least_docs)
            .select("lang", "source", "block", (F.dense_rank().over(in_order) - 1).alias("id"), "term", "n", "lang_n"))


def group_facts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total) of every group that occurs:
    the sums of its and of its language's counts, and the number of kept terms."""
    groups = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang", "block").agg((F.max("id") + 1).cast("long").alias("terms"), F.sum("n").alias("n"))
    langs = sizes.groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    return (groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")]))


# --- prices ------------------------------------------------------------------------
def share(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(10^9 * (n + 2) / (total + 2 * terms)), exact while the divisor is below 9 * 10^15:
    a long division by three digits at a time."""
    rest, by, out = n + 2, total + 2 * terms, 0
    for _ in range(3):
        rest = rest * 1000
        digit = rest // by
        rest = rest - digit * by
        out = out * 1000 + digit
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _share(n: Column, total: str, terms: str) -> Column:
    """:func:`share` as a column of longs."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", top, (F.col(total) + 2 * F.col(terms)).cast("decimal(20,0)")) + 1


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def gallop(small: np.ndarray, large: np.ndarray, run: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values in two ascending arrays. For each run of
    values of the smaller one, steps in the larger one double until they pass
    the run, which is then looked up between the last two steps."""
    mine, theirs, at = [], [], 0
    for i in range(0, len(small), run):
        want = small[i:i + run]
        step = len(want)
        while at + step < len(large) and large[at + step] < want[-1]:
            step *= 2
        window = large[at:at + step + 1]
        place = np.searchsorted(window, want)
        hit = np.flatnonzero(place < len(window))
        hit = hit[window[place[hit]] == want[hit]]
        mine.append(hit + i)
        theirs.append(place[hit] + at)
        at += int(np.searchsorted(window, want[-1]))
    none = [np.empty(0, np.int64)]
    return np.concatenate(mine or none), np.concatenate(theirs or none)


def merged_price(ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray,
                 total_a: int, total_b: int, terms: int) -> tuple[int, int]:
    """(sum of prices, number of terms) over the terms of either array."""
    at_a, at_b = gallop(ids_a, ids_b) if len(ids_a) <= len(ids_b) else gallop(ids_b, ids_a)[::-1]
    p, q = share(n_a, total_a, terms), share(n_b, total_b, terms)
    none = np.zeros(1, np.int64)
    p0, q0 = share(none, total_a, terms), share(none, total_b, terms)
    both = apart(p[at_a], q[at_b]).sum()
    only_a, only_b = np.ones(len(p), bool), np.ones(len(q), bool)
    only_a[at_a], only_b[at_b] = False, False
    one_sided = apart(p[only_a], q0).sum() + apart(p0, q[only_b]).sum()
    return int(both + one_sided), len(p) + len(q) - len(at_a)


def _pair_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = np.empty(0, np.int64)
    for b in batches:
        sides = []
        for s in "ab":
            ids, n = b.column(f"ids_{s}"), b.column(f"n_{s}")
            off = np.asarray(ids.offsets)
            sides.append([(i[x:y], m[x:y]) if v else (nothing, nothing) for i, m in [(np.asarray(ids.values).astype(np.int64), np.asarray(n.values))]
                          for x, y, v in zip(off[:-1], off[1:], ids.is_valid().to_pylist(), strict=True)])
        facts = zip(*(b.column(c).to_pylist() for c in ("total_a", "total_b", "terms")), strict=True)
        made = [merged_price(*x, *y, *f) for x, y, f in zip(*sides, facts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column("lang"), b.column("a"), b.column("b"), pa.array([m[0] for m in made], pa.int64()),
             pa.array([m[1] for m in made], pa.int64())], ["lang", "a", "b", "price", "seen"])


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every unordered pair of groups of a language."""
    few = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda x: x
    arrays = (kept.groupBy("lang", "block", "source").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("e"))
              .select("lang", "block", "source", F.col("e.id").alias("ids"), F.col("e.n").alias("n")))
    own = few(groups.select("lang", "source", "total", "terms"))
    other = few(groups.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total")))
    sent = arrays.join(own, ["lang", "source"]).join(other, "lang").where(F.col("source") != F.col("other"))
    first = F.col("source") < F.col("other")

    def side(column: str, at: Column, name: str) -> Column:
        return F.first(F.when(at, F.col(column)), ignorenulls=True).alias(name)

    met = (sent.groupBy("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), "block")
           .agg(side("ids", first, "ids_a"), side("n", first, "n_a"), side("ids", ~first, "ids_b"), side("n", ~first, "n_b"),
                F.max(F.when(first, F.col("total")).otherwise(F.col("other_total"))).alias("total_a"),
                F.max(F.when(first, F.col("other_total")).otherwise(F.col("total"))).alias("total_b"), F.max("terms").alias("terms")))
    priced = (met.mapInArrow(_pair_tasks, "lang string, a string, b string, price long, seen long")
              .groupBy("lang", "a", "b").agg(F.sum("price").alias("price"), F.sum("seen").alias("seen")))
    left = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "terms")
    right = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = left.join(few(right), (F.col("lang") == F.col("_lang")) & (F.col("a") < F.col("b"))).drop("_lang")
    zero = F.lit(0).cast("long")
    absent = pairs.where("terms > 0").withColumns({"p": _share(zero, "total_a", "terms"), "q": _share(zero, "total_b", "terms")})
    with_terms = absent.join(priced, ["lang", "a", "b"], "left").select("lang", "a", "b", (
        F.coalesce("price", zero) + (F.col("terms") - F.coalesce("seen", zero)) * _apart("p", "q")).alias("value"))
    return with_terms.unionAll(pairs.where("terms = 0").select("lang", "a", "b", zero.alias("value")))


def term_divergence(kept: DataFrame, groups: DataFrame, top: int = 10) -> DataFrame:
    """(lang, source, item, value, rank): the ``top`` terms that a group uses
    more than its language does."""
    few = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda x: x
    priced = (kept.join(few(groups), ["lang", "source"])
              .withColumns({"p": _share(F.col("n"), "total", "terms"), "q": _share(F.col("lang_n"), "lang_total", "terms")})
              .where("p > q").select("lang", "source", F.col("term").alias("item"), _apart("p", "q").alias("value")))
    return ranked(priced).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def op13_source_divergence(docs: DataFrame) -> DataFrame:
    counts = stored(term_counts(docs), "term-counts")
    kept = stored(kept_terms(counts), "kept-terms")
    groups = stored(group_facts(docs, kept), "groups")
    pairs = pair_divergence(kept, groups)
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both = ranked(pairs.select("lang", ways.alias("w"), "value").select("lang", "w.*", "value"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (both.withColumn("part", F.lit("pair")).select(columns)
            .unionAll(term_divergence(kept, groups).withColumn("part", F.lit("term")).select(columns)))
