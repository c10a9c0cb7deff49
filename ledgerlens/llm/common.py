"""Helpers shared by the operators: documents scan, stored intermediate
results, word pattern, and numpy text arithmetic used inside tasks."""

from __future__ import annotations

import re
import sys
import types
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import new_scratch

#: The white space that separates words (space, \t \n \v \f \r).
SPACE = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and scan it back.

    Cuts the lineage at files every executor can read, so a lost executor
    re-reads instead of recomputing, and a result used twice is made once.
    """
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids broadcast at most (8 bytes each); beyond, they are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def among(df: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose long ``column`` is in ``ids`` (one column, each
    value once, stored), or is not (``left_anti``). Up to :data:`BROADCAST_IDS`
    counted ids are broadcast, so that ``df``'s texts or sets stay where they
    are; more are joined by a shuffle."""
    few = ids.count() <= BROADCAST_IDS
    ids = ids.toDF("_id")
    return df.join(F.broadcast(ids) if few else ids, F.col(column) == F.col("_id"), how)


def whole_row(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``df`` in one struct ``_row``, so that an operator's own
    columns cannot clash with them; :func:`unpacked` names them again."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without]).alias("_row")


def unpacked(df: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``df`` out of ``_row``."""
    return [F.col("_row").getField(c).alias(c) for c in df.columns if c not in without]


def release(*tables: DataFrame) -> None:
    """Free stored tables whose readers have all been stored themselves: each is
    overwritten by an empty one, so its files do not outlive their use."""
    for t in tables:
        files = t.inputFiles()
        folder = files[0].rsplit("/", 1)[0] if files else ""
        if "/ledgerlens/" in folder:  # only what stored() wrote
            t.sparkSession.createDataFrame([], t.schema).coalesce(1).write.mode("overwrite").parquet(folder)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_BREAK)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text as a long (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


# --- task side -------------------------------------------------------------------
def per_worker(key: str, make: Callable[[], object]):
    """An object that a Python worker makes once and keeps for later tasks."""
    state = sys.modules.setdefault("ledgerlens_worker_state", types.ModuleType("ledgerlens_worker_state")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def forget_other_operators() -> None:
    """Free what operators before have left in this Python worker, which Spark
    reuses: a task that needs much memory itself begins with this."""
    sys.modules.get("ledgerlens_worker_state", types.ModuleType("none")).__dict__.clear()


class Splitter:
    """The matches of ``public_tokenizers.PATTERN`` in a text.

    A text of Latin-1 characters only (without the few control characters
    that two regular expression libraries class differently) is split by an
    equal pattern whose letter and number classes are written out, which
    takes half the time.
    """

    def __init__(self):
        import regex

        self.general = regex.compile(public_tokenizers.PATTERN).findall
        latin = [chr(i) for i in range(256)]
        letter, number = ("".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == kind) for kind in "LN")
        self.latin = re.compile(rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+").findall

    def __call__(self, text: str) -> list[str]:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return self.general(text)
        odd = len(raw.translate(None, b"\x1c\x1d\x1e\x1f\x85")) < len(raw)
        return self.general(text) if odd else self.latin(text)


U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
GOLD = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (splitmix finalizer)."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def byte_table(seed: int) -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U) * GOLD + U(seed))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, ``n`` of them."""
    out = np.ones(n, U)
    if n > 1:
        out[1:] = U(base)
        np.multiply.accumulate(out, out=out)
    return out


def word_hashes(buf: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of a byte buffer.

    A word's hash is a polynomial of table values of its bytes, read off
    prefix sums (modulo 2^64) and then scrambled together with its length.
    """
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    base = (int(mix(np.array([seed + 77], U))[0]) | 5) & ~2
    inverse = pow(base, -1, 1 << 64)
    n = len(buf)
    prefix = np.zeros(n + 1, U)
    np.cumsum(byte_table(seed)[buf] * powers(base, n), out=prefix[1:])
    h = (prefix[end] - prefix[start]) * powers(inverse, n + 1)[start]
    return mix(h + (end - start).astype(U) * GOLD), start, end


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values of ``h``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U)
    g = mix(h[:n] + U(k))
    for i in range(1, k):
        g = mix(g * GOLD + h[i:n + i])
    return g


def window_min(h: np.ndarray, w: int, fn=np.minimum) -> np.ndarray:
    """Minimum of every window of ``w`` consecutive values (by doubling)."""
    if len(h) < w:
        return h[:0]
    m, span = h, 1
    while span * 2 <= w:
        m = fn(m[:-span], m[span:])
        span *= 2
    if span < w:
        m = fn(m[:len(h) - w + 1], m[w - span:w - span + len(h) - w + 1])
    return m


def slices(batches: Iterator[pa.RecordBatch], text_col: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into pieces of about ``max_bytes`` of text (a single
    longer text is a piece of its own), which bounds a task's arrays."""
    for b in batches:
        size = np.fromiter((len(v.as_buffer()) if v.is_valid else 0 for v in
                            b.column(text_col).cast(pa.large_binary())), np.int64, b.num_rows)
        piece = np.cumsum(size) // max_bytes
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [b.num_rows])), strict=True):
            if e > s:
                yield b.slice(int(s), int(e - s))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, offsets); null counts as empty."""
    c = column.cast(pa.large_binary())
    if c.null_count:
        c = c.fill_null(b"")
    off = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
    data = np.frombuffer(c.buffers()[2], np.uint8)[off[0]:off[-1]] if c.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, off - off[0]
