"""Anchors: a filter that finds the documents in which a long match can lie.

Every window of a fixed length owns an anchor, the smallest scrambled hash of
the short grams in it. Equal windows have equal anchors, so a window whose
anchor occurs nowhere else has no equal. Consecutive windows mostly share
their anchor: a corpus has few distinct ones (about two for each window
length of text), and only they are shuffled and counted, not every window.

A text's class is its 64-bit hash; copies of a text count as one class, and
one row per class (a *representative*) is looked at further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import among, release, slices, stored, utf8

#: Bytes of text whose arrays a task holds at a time.
PIECE = 1 << 19
#: (bytes, offsets of the texts) -> (anchor, number of its text, times it
#: occurs there), each pair once; a module function of the operator.
Anchors = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def with_class(docs: DataFrame) -> DataFrame:
    """(doc_id, text, cls): null texts count as empty; ``cls`` and the check
    hash ``cls2`` together identify a text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("cls"), F.xxhash64(F.lit(1), text).alias("cls2"))


def classes(rows: DataFrame) -> DataFrame:
    """One row per text: ``first_id`` (smallest doc_id, null if it has none)
    and ``copies``. A count per task precedes the shuffle."""
    return rows.groupBy("cls", "cls2").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))


def shared_anchors(rows: DataFrame, anchors: Anchors, within: bool) -> DataFrame:
    """(cls, shared array<long>), stored: each text's anchors that occur in
    another text too or, if ``within``, more than once in one text.

    Of a hot anchor, each task sends one partial row; the join back is an
    inner join whose hot keys Spark splits. A text's list is bounded by the
    text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # texts of this task that were sent already
        for b in slices(batches, "text", PIECE):
            cls = b.column("cls").to_numpy()
            fresh = np.fromiter((not (c in seen or seen.add(c)) for c in cls.tolist()), bool, len(cls))
            b = b.filter(pa.array(fresh))
            data, off = utf8(b.column("text"))
            anchor, text, times = anchors(data, off)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(cls[fresh][text]), pa.array(times > 1)],
                                             ["anchor", "cls", "twice"])

    found = rows.select("cls", "text").mapInArrow(run, "anchor long, cls long, twice boolean")
    found = stored(found, "anchors")
    hit = F.min("cls") < F.max("cls")
    if within:
        hit = hit | F.max("twice")
    counted = found.groupBy("anchor").agg(hit.alias("hit")).where("hit").select("anchor")
    lists = found.select("anchor", "cls").join(counted, "anchor").groupBy("cls").agg(F.collect_set("anchor").alias("shared"))
    out = stored(lists, "shared-anchors")
    release(found)
    return out


def representatives(rows: DataFrame, per_class: DataFrame, shared: DataFrame, columns: list[str]) -> DataFrame:
    """One row of each text that has shared anchors (several if its smallest
    doc_id is repeated or null): cls, cls2, text, shared, first_id, ``columns``.

    The texts are shuffled once. The doc_id is part of the join key, so the
    copies of a text do not meet in one task.
    """
    wanted = shared.join(per_class, "cls").select(
        F.col("cls").alias("_c"), F.col("cls2").alias("_c2"), "shared", "first_id", *columns)
    on = (F.col("cls") == F.col("_c")) & (F.col("cls2") == F.col("_c2")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    some = among(rows, "cls", shared.select("cls"))  # the other texts stay out of the shuffle
    return some.join(wanted, on).select("cls", "cls2", "text", "shared", "first_id", *columns)


def runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flag.astype(np.int8), [0]))))
    return edge[0::2], edge[1::2]
