"""Document fingerprints from prefix polynomial hashes.

:class:`PrefixHashes` keeps, for one text, the polynomial hashes of all its
prefixes modulo two primes. Any two spans are compared in constant time and
the longest common extension of two positions is found by binary search. A
fingerprint holds the length, the hash of the whole text, and the smallest
scrambled hashes of all spans of :data:`SPAN` code points; the likeness of
two fingerprints estimates the share of spans their texts have in common.

:func:`fingerprint_edits` compares each document with the next one
(descending doc_id, null last, then text; the last is followed by the
first) and with an edit of itself: its last floor(n/2) code points replaced
by as many first ones (or all) of the next document.

Defined cases: a null text counts as empty; two empty texts are alike (1),
an empty and another one are not (0); rows that share a doc_id follow each
other in text order; a single document is its own next one; an empty table
gives an empty result; further columns are ignored. A text of any length is
hashed whole, in arrays of its own size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import U, mix

SPAN = 16
KEPT = 32
#: Blocks of the document order for each shuffle partition: several, so that the
#: hash that deals blocks to tasks leaves none with much more than its share.
BLOCKS = 8
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525)


class Powers:
    """Powers of a base and of its inverse modulo a prime, grown as needed."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime, self.n = base, prime, 0
        self.up = self.down = np.ones(1, U)

    def _grown(self, table: np.ndarray, step: int, n: int) -> np.ndarray:
        while len(table) < n:
            table = np.concatenate((table, table * U(pow(step, len(table), self.prime)) % U(self.prime)))
        return table

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = self._grown(self.up, self.base, n)
            self.down = self._grown(self.down, pow(self.base, -1, self.prime), n)
        return self.up, self.down


class PrefixHashes:
    """Hashes of all prefixes of a text's code points, per modulus."""

    def __init__(self, points: np.ndarray, powers: list[Powers]):
        self.n, self.powers, self.prefix = len(points), powers, []
        for pw in powers:
            up, _ = pw.upto(self.n + 1)
            h = np.zeros(self.n + 1, U)
            np.cumsum((points.astype(U) + U(1)) * up[:self.n] % U(pw.prime), out=h[1:])
            self.prefix.append(h % U(pw.prime))

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """The hash of one span, independent of where it stands."""
        return tuple((int(h[end]) - int(h[start])) * int(pw.upto(self.n + 1)[1][start]) % pw.prime
                     for h, pw in zip(self.prefix, self.powers, strict=True))

    def spans(self, size: int, upto: int | None = None) -> np.ndarray:
        """Scrambled hashes of every span of ``size`` that ends by ``upto``."""
        end = self.n if upto is None else upto
        k = end - size + 1
        if k <= 0:
            return np.empty(0, U)
        out = np.zeros(k, U)
        for h, pw in zip(self.prefix, self.powers, strict=True):
            p, down = U(pw.prime), pw.upto(self.n + 1)[1]
            out = (out << U(32)) | ((h[size:end + 1] + p - h[:k]) % p * down[:k] % p)
        return mix(out)

    def equal(self, i: int, other: PrefixHashes, j: int, size: int) -> bool:
        return self.span(i, i + size) == other.span(j, j + size)

    def lce(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest common extension of ``i`` and ``other``'s ``j``."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(i, other, j, mid):
                low = mid
            else:
                high = mid - 1
        return low


def smallest(hashes: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """The ``kept`` smallest distinct values, cut to 32 bits."""
    if len(hashes) > 4 * kept:
        least = np.unique(np.partition(hashes, 4 * kept)[:4 * kept])
        if len(least) < kept:
            least = np.unique(hashes)
    else:
        least = np.unique(hashes)
    return (least[:kept] >> U(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Estimated share of spans in common, from two kept sets (ascending)."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    union = np.union1d(a, b)[:kept]
    return float((np.isin(union, a) & np.isin(union, b)).mean())


class _Fingerprinter:
    def __init__(self):
        self.powers = [Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)]

    def text(self, value: str) -> tuple[np.ndarray, PrefixHashes, np.ndarray, str]:
        points = np.frombuffer(value.encode("utf-32-le"), "<u4")
        hashes = PrefixHashes(points, self.powers)
        return points, hashes, *self._made(hashes.n, hashes.spans(SPAN), hashes.span(0, hashes.n))

    def edited(self, cur: PrefixHashes, head: int, nxt: PrefixHashes, tail: int,
               points: np.ndarray, next_points: np.ndarray) -> tuple[np.ndarray, str]:
        """Fingerprint of ``cur``'s first ``head`` and ``nxt``'s first ``tail``
        code points joined, from their prefix hashes: only spans across the
        seam are hashed anew."""
        n = head + tail
        a, b = cur.span(0, head), nxt.span(0, tail)
        whole = tuple((x + y * int(pw.upto(head + 1)[0][head])) % pw.prime
                      for x, y, pw in zip(a, b, self.powers, strict=True))
        seam = np.concatenate((points[max(0, head - SPAN + 1):head], next_points[:min(tail, SPAN - 1)]))
        spans = np.concatenate((cur.spans(SPAN, head), PrefixHashes(seam, self.powers).spans(SPAN), nxt.spans(SPAN, tail)))
        return self._made(n, spans, whole)

    def _made(self, n: int, spans: np.ndarray, whole: tuple[int, ...]) -> tuple[np.ndarray, str]:
        if not len(spans) and n:
            spans = mix(np.array([whole[0] << 32 | whole[1]], U) + U(n))
        least = smallest(spans)
        return least, f"{n:x}.{whole[0]:08x}{whole[1]:08x}." + least.astype(">u4").tobytes().hex()


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                  ("near_next", pa.float64()), ("common_prefix_next", pa.int64())])
_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, common_prefix_next long")


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and place; a block's last row is a copy of
    the row that follows it."""
    made, rows, held = _Fingerprinter(), [], None
    for b in batches:
        for block, follows, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("block", "follows", "doc_id", "text")), strict=True):
            points, hashes, least, print_ = made.text(text)
            if held is not None:
                d, t, p, h, lst, fp = held
                tail = min(h.n // 2, hashes.n)
                head = h.n - h.n // 2
                e_least, e_print = made.edited(h, head, hashes, tail, p, points)
                sha = hashlib.sha256((t[:head] + text[:tail]).encode("utf-8")).hexdigest()
                rows.append((d, h.n, sha, fp, e_print, likeness(lst, e_least), likeness(lst, least), h.lce(0, hashes, 0)))
            held = None if follows else (doc_id, text, points, hashes, least, print_)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)
            rows = []


def _block_of(place: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (descending) that are above ``place``, found in
    two short scans: among every ``step``-th bound, then in the one step."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    tops = F.array(*[F.lit(g[-1]) for g in groups])
    passed = F.size(F.filter(tops, lambda x: x > place))
    inner = F.get(F.array(*[F.array(*[F.lit(x) for x in g + [g[-1]] * (step - len(g))]) for g in groups]), passed)
    return (passed * step + F.coalesce(F.size(F.filter(inner, lambda x: x > place)), F.lit(0))).cast("int")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, its edit and its next one; see above.

    The order is split into blocks of doc_ids, a few for each shuffle
    partition, by quantiles of the ids. Each block also gets a copy of the
    row after it (one per block), so the one shuffle of the texts is enough
    and no task sees more than its block.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = BLOCKS * parts
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).where("d is not null").approxQuantile(
        "d", [i / blocks for i in range(1, blocks)], 0.2 / blocks)
    rows = rows.withColumn("block", _block_of(F.col("place"), sorted({int(c) for c in cuts}, reverse=True)))
    heads = {r.block: r.place for r in rows.groupBy("block").agg(F.max("place").alias("place")).collect()}
    order = sorted(heads)
    if not order:
        return spark.createDataFrame([], _DDL)
    before = {heads[b]: order[i - 1] for i, b in enumerate(order)}  # the first row follows the last block
    first = rows.where(F.col("place").isin(list(before))).groupBy("place").agg(
        F.min_by("doc_id", "text").alias("doc_id"), F.min("text").alias("text"))
    target = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    copies = first.select("doc_id", "text", "place", target[F.col("place")].cast("int").alias("block"), F.lit(True).alias("follows"))
    both = rows.withColumn("follows", F.lit(False)).unionByName(copies)
    placed = both.repartition(parts, "block").sortWithinPartitions("block", "follows", F.desc("place"), "text")
    return placed.select("block", "follows", "doc_id", "text").mapInArrow(_in_order, _DDL)


def op9_document_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprint_edits(docs)
