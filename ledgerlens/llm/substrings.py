"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

All windows of :data:`WINDOW` consecutive words are hashed by two rolling
polynomials of 64 bits; Spark groups the hashes and finds the smallest
doc_id each sequence starts in. A document loses the words covered by
windows that also start in a smaller one; overlapping and adjacent repeated
windows merge into maximal spans. Windows whose anchor (see
:mod:`ledgerlens.llm.anchors`) is in no other text are known to be unique
and are not sent.

Copies are settled by their class: every copy of a text, but those with its
smallest doc_id, repeats all windows of that one, so only one row of each
text has its windows hashed.

Defined cases: a null or empty text has no words and loses none; a text of
fewer words than a window loses none; a null doc_id counts as larger than
every other, and rows with the same doc_id (or null) do not remove from each
other; an empty table gives an empty result; further columns are ignored. A
text longer than a task's piece is a piece of its own, read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.anchors import PIECE, classes, representatives, runs, shared_anchors, with_class
from ledgerlens.llm.common import U, gram_hashes, mix, powers, slices, stored, utf8, window_min, word_hashes, words

WINDOW = 50
#: Words of the grams whose hashes serve as anchors.
GRAM = 16
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_LAST = (1 << 63) - 1


def _anchor_of_windows(h: np.ndarray, window: int) -> np.ndarray:
    """The anchor of every window of word hashes."""
    return window_min(gram_hashes(h, GRAM), window - GRAM + 1)


def word_anchors(window: int):
    def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, off = spaced(data, off)
        found, text = [np.empty(0, U)], [np.empty(0, np.int64)]
        h, start, _ = word_hashes(data, 1)
        first = np.searchsorted(start, off)
        for i in range(len(off) - 1):
            a = np.unique(_anchor_of_windows(h[first[i]:first[i + 1]], window))
            found.append(a)
            text.append(np.full(len(a), i))
        text = np.concatenate(text)
        return np.concatenate(found), text, np.ones(len(text), np.int64)
    return anchors


def spaced(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with a line end after each, so words end with their text."""
    return np.insert(data, off[1:], np.uint8(10)), off + np.arange(len(off))


def rabin_karp(h: np.ndarray, window: int, base: int) -> np.ndarray:
    """Rolling polynomial hash of every window of ``h``, modulo 2^64."""
    n = len(h)
    prefix = np.zeros(n + 1, U)
    np.cumsum(h * powers(base, n), out=prefix[1:])
    return (prefix[window:] - prefix[:n - window + 1]) * powers(pow(base, -1, 1 << 64), n - window + 1)


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            data, off = spaced(*utf8(b.column("text")))
            h, start, _ = word_hashes(data, 1)
            first = np.searchsorted(start, off)
            cls, place, shared = b.column("cls").to_numpy(), b.column("place").to_numpy(), b.column("shared")
            out, places, sizes = [[np.empty(0, np.int64)] for _ in range(4)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
            for i in range(b.num_rows):
                own = h[first[i]:first[i + 1]]
                at = np.flatnonzero(np.isin(_anchor_of_windows(own, window), shared[i].values.to_numpy().view(U)))
                if len(at):
                    h1 = rabin_karp(own, window, _BASES[0])[at].view(np.int64)
                    h2 = rabin_karp(mix(own + U(9)), window, _BASES[1])[at].view(np.int64)
                    order = np.lexsort((at, h2, h1))   # a window that repeats in its text is one row
                    h1, h2, at = h1[order], h2[order], at[order]
                    cut = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
                    for k, v in enumerate((h1[cut], h2[cut], np.full(len(cut), place[i]), np.full(len(cut), cls[i]))):
                        out[k].append(v)
                    places.append(at)
                    sizes.append(np.diff(np.append(cut, len(at))))
            offsets = pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32))
            at = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(v)) for v in out), at], ["h1", "h2", "place", "cls", "at"])
    return run


def _spans(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            texts, at = b.column("text").to_pylist(), b.column("at")
            spans, kept = [], []
            for i, t in enumerate(texts):
                own = t.translate(_SPACES).split(" ")
                own = [w for w in own if w]
                hit = np.zeros(len(own) + 1, np.int64)
                pos = np.unique(at[i].values.to_numpy())
                hit[pos] += 1
                np.subtract.at(hit, pos + window, 1)
                gone = np.cumsum(hit[:-1]) > 0
                s, e = runs(gone)
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)])
                kept.append(" ".join([w for w, g in zip(own, gone.tolist(), strict=True) if not g]))
            yield pa.RecordBatch.from_arrays(
                [b.column("cls"), b.column("cls2"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.string())], ["cls", "cls2", "spans", "kept_text"])
    return run


_SPACES = {i: " " for i in (9, 10, 11, 12, 13)}


def _place(c: str) -> Column:
    return F.coalesce(c, F.lit(_LAST))


def repeated_spans(rows: DataFrame, per_class: DataFrame, window: int = WINDOW) -> DataFrame:
    """(cls, cls2, spans, kept_text) of every text that, in its smallest
    document, repeats windows of smaller documents: word spans removed and
    the words left, joined by one space."""
    shared = shared_anchors(rows, word_anchors(window), within=False)
    reps = stored(representatives(rows, per_class, shared, []).withColumn("place", _place("first_id")), "substring-texts")
    wins = reps.select("text", "cls", "place", "shared").mapInArrow(
        _windows(window), "h1 long, h2 long, place long, cls long, at array<int>")
    first = wins.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    hits = wins.join(first.select("h1", "h2", "first"), ["h1", "h2"]).where("place > first")
    at = hits.groupBy("cls").agg(F.flatten(F.collect_list("at")).alias("at"))  # at most one entry for each word of a text
    return (reps.select("cls", "cls2", "text").dropDuplicates(["cls", "cls2"]).join(at, "cls")
            .mapInArrow(_spans(window), "cls long, cls2 long, spans array<struct<start:long,end:long>>, kept_text string"))


def op10_substring_dedup(docs: DataFrame) -> DataFrame:
    """Words, removed words and the hash of the kept ones, per document."""
    rows = with_class(docs)
    per_class = classes(rows)
    spans = repeated_spans(rows, per_class)
    done = spans.select("cls", "cls2", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("gone"),
                        F.sha2("kept_text", 256).alias("left"))
    own = rows.select("doc_id", "cls", "cls2", words(F.col("text")).alias("w")).select(
        "doc_id", "cls", "cls2", F.size("w").cast("long").alias("n_words"), F.sha2(F.array_join("w", " "), 256).alias("whole"))
    out = own.join(per_class.select("cls", "cls2", "first_id"), ["cls", "cls2"]).join(done, ["cls", "cls2"], "left")
    copy = (_place("doc_id") > _place("first_id")) & (F.col("n_words") >= WINDOW)
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("left", "whole")).alias("kept_sha256"))
