"""Suffix-array dedup with a logarithmic index family.

A byte is removed when a string of :data:`LENGTH` bytes that covers it also
starts anywhere else, in the same document or another. Sorted suffixes find
such strings: :class:`SuffixFamily` takes batches of suffixes, sorts each (a
suffix array, suffixes cut at the match length), merge-scans it against the
sorted levels it has for equal strings, and keeps it as a new level; levels
of equal size merge, so there are about log(batches) of them.

What is indexed: windows whose anchor (see :mod:`ledgerlens.llm.anchors`) occurs
a second time. Consecutive windows of one anchor form a segment; segments
are dealt out to tasks by anchor, where equal strings meet, and a task
builds its family over the batches it reads. Equal segments are indexed
once. Where a passage that very many texts share begins and ends, each text's segment is another;
so the windows of an anchor that more than :data:`HOT_TEXTS` texts have are dealt
out one by one, by 128 bits of their hash, and counted, those of a task's piece first:
no task holds a hot anchor. A text with copies is removed whole (if it has a full string) without
being indexed for itself; it is only something for others to match.

Defined cases: a null text counts as empty; a text shorter than a match
loses nothing; copies and repeated rows remove each other; null doc_ids are
documents like others; an empty table gives an empty result; further columns
are ignored. Kept bytes may cut a code point: as text, its rest is dropped. A
text longer than a task's piece is a piece of its own, read whole. Ties cannot
arise: all places of an equal string are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.anchors import PIECE, classes, representatives, runs, shared_anchors, with_class
from ledgerlens.llm.common import GOLD, U, byte_table, mix, powers, slices, stored, unpacked, utf8, whole_row, window_min

LENGTH = 200
#: Bytes of the grams whose hashes serve as anchors (a multiple of 8).
GRAM = 64
#: Suffixes sorted at a time, and bytes of text for each task of the index.
BATCH = 20_000
TASK_BYTES = 1 << 20
#: Texts with an anchor beyond which it is hot, and hot anchors broadcast (8 MB at most; the most frequent ones).
HOT_TEXTS, HOT_ANCHORS = 2048, 1 << 20


def byte_grams(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Scrambled hash of every run of ``size`` bytes."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, U)
    eight = np.empty(len(data) - 7, U)
    for k in range(8):
        part = data[k:k + (len(data) - k) // 8 * 8].view("<u8")
        eight[k::8] = part[:len(eight[k::8])]
    h = mix(eight[:n] + U(size))
    for i in range(8, size, 8):
        h = (h * GOLD) ^ (h >> U(29))
        h += eight[i:n + i]
    return mix(h)


def byte_anchors(length: int):
    def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, text, times = [np.empty(0, U)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        grams = byte_grams(np.ascontiguousarray(data))
        for i in range(len(off) - 1):
            if off[i + 1] - off[i] < length:
                continue
            h = grams[off[i]:off[i + 1] - GRAM + 1]
            w = length - GRAM + 1
            least = window_min(h, w)
            # a gram is an anchor where it is the least of some window over it
            over = np.concatenate((np.zeros(w - 1, U), least, np.zeros(w - 1, U)))
            a, n = np.unique(h[window_min(over, w, np.maximum) == h], return_counts=True)
            found.append(a)
            times.append(n)
            text.append(np.full(len(a), i))
        return np.concatenate(found), np.concatenate(text), np.concatenate(times)
    return anchors


class SuffixFamily:
    """Sorted levels of distinct strings of one length, with the number of
    the suffix that each was first seen at."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Index a batch; the ids, of it and of earlier batches, whose string
        is now known to occur twice."""
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        same = keys[1:] == keys[:-1]
        twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        found = [ids[twice]]
        first = np.concatenate(([True], ~same))
        keys, ids = keys[first], ids[first]
        new = np.ones(len(keys), bool)
        for level, level_ids in self.levels:
            at = np.searchsorted(level, keys)
            at[at == len(level)] = 0
            hit = level[at] == keys
            found += [level_ids[at[hit]], ids[hit]]
            new &= ~hit
        self._push(keys[new], ids[new])
        return np.concatenate(found)

    def _push(self, keys: np.ndarray, ids: np.ndarray) -> None:
        if not len(keys):
            return
        while self.levels and len(self.levels[-1][0]) < 2 * len(keys):
            k, i = self.levels.pop()
            keys, ids = np.concatenate((k, keys)), np.concatenate((i, ids))
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
        self.levels.append((keys, ids))


def window_hashes(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A 64-bit hash of every window of ``length`` bytes: a polynomial of the
    bytes' table values, read off prefix sums and then scrambled."""
    n = len(data)
    base = (int(mix(np.array([seed + 91], U))[0]) | 5) & ~2
    prefix = np.zeros(n + 1, U)
    np.cumsum(byte_table(seed)[data] * powers(base, n), out=prefix[1:])
    at = powers(pow(base, -1, 1 << 64), n - length + 1)
    return mix((prefix[length:] - prefix[:n - length + 1]) * at + U(seed))


HOT = "h1 long, h2 long, n long, cls long, low long, high long"


def _hot_windows(length: int, hot):
    """The windows of hot anchors, by hash. Of a piece of texts, a window met
    once is a row with its place; one met again is a row with its number, and
    its places (without a hash) are known to be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = hot.value
        for b in slices(batches, "text", PIECE):
            data, off = utf8(b.column("text"))
            grams = byte_grams(np.ascontiguousarray(data))
            shared, copies, own = b.column("shared"), b.column("copies").to_pylist(), b.column("cls").to_pylist()
            found = [[], [], [], []]  # hashes, row, place
            for i in range(b.num_rows):
                if off[i + 1] - off[i] < length:
                    continue
                mine = shared[i].values.to_numpy().view(U)
                mine = mine[np.isin(mine, anchors)]
                if len(mine):
                    at = np.flatnonzero(np.isin(window_min(grams[off[i]:off[i + 1] - GRAM + 1], length - GRAM + 1), mine))
                    text = data[off[i]:off[i + 1]]
                    for col, v in zip(found, (*(window_hashes(text, length, k)[at] for k in (1, 2)), np.full(len(at), i), at), strict=True):
                        col.append(v)
            if not found[0]:
                continue
            h1, h2, row, at = map(np.concatenate, found)
            order = np.lexsort((h2, h1))
            new = np.concatenate(([True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])))
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(new) - 1
            n = np.bincount(group)
            first = order[new]
            need, cls = np.array([c < 2 for c in copies]), np.array(own)
            once = n == 1
            known = (n[group] > 1) & need[row]                       # places of windows met again: as runs
            low = np.flatnonzero(known & np.concatenate(([True], ~known[:-1] | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))))
            high = np.flatnonzero(known & np.concatenate((~known[1:] | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1), [True])))
            owner = once & need[row[first]]
            k = len(low)
            place = pa.array(np.concatenate((at[first], at[low])), mask=np.concatenate((~owner, np.zeros(k, bool))))
            yield pa.RecordBatch.from_arrays([
                *(pa.concat_arrays([pa.array(h[first].view(np.int64)), pa.nulls(k, pa.int64())]) for h in (h1, h2)),
                pa.concat_arrays([pa.array(n), pa.nulls(k, pa.int64())]), pa.array(cls[np.concatenate((row[first], row[low]))]),
                place, pa.array(np.concatenate((at[first] + 1, at[high] + 1)))], ["h1", "h2", "n", "cls", "low", "high"])
    return run


def _hot_matches(reps: DataFrame, hot, length: int) -> DataFrame:
    """(cls, low, high) of the repeated windows of hot anchors. A window's
    number is a partial and a final sum; of a hot one there is a row a piece."""
    rows = stored(reps.select("text", "cls", "shared", "copies").mapInArrow(_hot_windows(length, hot), HOT), "hot-windows")
    twice = rows.where("h1 is not null").groupBy("h1", "h2").agg(F.sum("n").alias("times")).where("times > 1").select("h1", "h2")
    single = rows.where("h1 is not null and low is not null").join(twice, ["h1", "h2"], "left_semi")
    return single.select("cls", "low", "high").unionAll(rows.where("h1 is null").select("cls", "low", "high"))


def _segments(length: int, hot):
    """Candidate windows of each text, cut where the anchor changes, without
    those of hot anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            data, off = utf8(b.column("text"))
            grams = byte_grams(np.ascontiguousarray(data))
            raw = data.tobytes()
            key, cls, at, string, need = [], [], [], [], []
            shared, copies, own = b.column("shared"), b.column("copies").to_pylist(), b.column("cls").to_pylist()
            for i in range(b.num_rows):
                if off[i + 1] - off[i] < length:
                    continue
                least = window_min(grams[off[i]:off[i + 1] - GRAM + 1], length - GRAM + 1)
                mine = shared[i].values.to_numpy().view(U)
                hit = np.isin(least, mine[~np.isin(mine, hot.value)])
                edge = np.flatnonzero(least[1:] != least[:-1]) + 1
                starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(least)]))
                wanted = hit[starts]
                for s, e in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True):
                    string.append(raw[off[i] + s:off[i] + e + length - 1])
                    at.append(s)
                key.append(least[starts[wanted]].view(np.int64))
                cls += [own[i]] * int(wanted.sum())
                need += [copies[i] < 2] * int(wanted.sum())
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(key)), pa.array(cls, pa.int64()), pa.array(at, pa.int64()),
                     pa.array(need, pa.bool_()), pa.array(string, pa.binary())], ["anchor", "cls", "at", "need", "string"])
    return run


def _matches(length: int):
    """Ranges of window starts, per text, whose string occurs elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = SuffixFamily()
        number: dict[bytes, int] = {}   # of each distinct segment
        first, count = [0], []          # first suffix number, times seen
        owners: list[tuple[int, int, int]] = []
        twice: list[np.ndarray] = []
        waiting: list[bytes] = []
        held = 0

        def flush() -> None:
            nonlocal waiting, held
            if waiting:
                buf = np.frombuffer(b"".join(waiting), np.uint8)
                size = np.array([len(x) for x in waiting])
                begin = np.concatenate(([0], np.cumsum(size)[:-1]))
                n = size - length + 1
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                starts = np.repeat(begin, n) + within
                strings = np.lib.stride_tricks.sliding_window_view(buf, length)[starts].view(f"S{length}").ravel()
                twice.append(family.add(strings, np.arange(first[-1] - len(starts), first[-1])))
                waiting, held = [], 0

        for b in batches:
            for cls, at, need, string in zip(*(b.column(c).to_pylist() for c in ("cls", "at", "need", "string")), strict=True):
                k = number.setdefault(string, len(number))
                if k == len(count):
                    count.append(0)
                    first.append(first[-1] + len(string) - length + 1)
                    waiting.append(string)
                    held += len(string) - length + 1
                    if held >= BATCH:
                        flush()
                count[k] += 1
                if need:
                    owners.append((k, cls, at))
        flush()
        number.clear()
        hit = np.zeros(first[-1], bool)
        for t in twice:
            hit[t] = True
        out = ([], [], [])
        for k, cls, at in owners:
            if count[k] > 1:
                pairs = ((0, first[k + 1] - first[k]),)
            else:
                pairs = zip(*(x.tolist() for x in runs(hit[first[k]:first[k + 1]])), strict=True)
            for s, e in pairs:
                for col, v in zip(out, (cls, at + s, at + e), strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["cls", "low", "high"])
    return run


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            found, spans, kept = b.column("found"), [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                raw = np.frombuffer(t.encode("utf-8"), np.uint8)
                low, high = (found[i].values.field(c).to_numpy() for c in ("low", "high"))
                mark = np.zeros(len(raw) + 1, np.int64)
                np.add.at(mark, low, 1)
                np.subtract.at(mark, high + length - 1, 1)
                gone = np.cumsum(mark[:-1]) > 0
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(*runs(gone), strict=True)])
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("cls"), b.column("cls2"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())],
                ["cls", "cls2", "spans", "kept", "kept_text"])
    return run


def repeated_spans(rows: DataFrame, per_class: DataFrame, length: int = LENGTH) -> DataFrame:
    """(cls, cls2, spans, kept, kept_text) of every text without copies that has
    bytes covered by repeated strings: byte spans removed and the bytes left."""
    shared = shared_anchors(rows, byte_anchors(length), within=True)
    reps = stored(representatives(rows, per_class, shared, ["copies"]), "suffix-texts")
    total = reps.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)
    often = reps.select(F.explode("shared").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") > HOT_TEXTS).orderBy(F.desc("n"), "anchor").limit(HOT_ANCHORS).toArrow()
    hot = rows.sparkSession.sparkContext.broadcast(np.sort(often.column("anchor").to_numpy().view(U)))
    segments = reps.select("text", "cls", "shared", "copies").mapInArrow(
        _segments(length, hot), "anchor long, cls long, at long, need boolean, string binary")
    found = segments.repartition(parts, "anchor").select("cls", "at", "need", "string").mapInArrow(
        _matches(length), "cls long, low long, high long")
    if len(often):
        found = found.unionAll(_hot_matches(reps, hot, length))
    found = found.groupBy("cls").agg(F.collect_list(F.struct("low", "high")).alias("found"))  # bounded by the text
    return (reps.where("copies < 2").select("cls", "cls2", "text").join(found, "cls")
            .mapInArrow(_removed(length), "cls long, cls2 long, spans array<struct<start:long,end:long>>, kept binary, kept_text string"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (columns of documents) with repeated bytes cut out of the
    texts; a text left empty stays, as an empty one, and n_chars follows."""
    rows = with_class(docs)
    per_class = classes(rows)
    done = repeated_spans(rows, per_class, length).select("cls", "cls2", F.col("kept_text").alias("left"))
    text = F.coalesce("text", F.lit(""))
    out = docs.select(whole_row(docs), text.alias("text"), F.xxhash64(text).alias("cls"), F.xxhash64(F.lit(1), text).alias("cls2"))
    out = out.join(per_class.where("copies > 1").select("cls", "cls2", "copies"), ["cls", "cls2"], "left").join(
        done, ["cls", "cls2"], "left")
    whole = F.col("copies").isNotNull() & (F.octet_length("text") >= length)
    kept = F.when(whole, F.lit("")).otherwise(F.coalesce(F.col("left"), F.col("_row.text")))
    changed = {"text": kept.alias("text"), "n_chars": F.length(kept).cast("long").alias("n_chars")}
    return out.select(*[changed.get(c, col) for c, col in zip(docs.columns, unpacked(docs), strict=True)])


def op5_suffix_array_dedup(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes and spans, and the hash of the kept bytes."""
    rows = with_class(docs)
    per_class = classes(rows)
    done = repeated_spans(rows, per_class).select(
        "cls", "cls2", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("gone"),
        F.size("spans").cast("long").alias("cuts"), F.sha2("kept", 256).alias("left"))
    own = rows.select("doc_id", "cls", "cls2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    out = own.join(per_class.select("cls", "cls2", "copies"), ["cls", "cls2"]).join(done, ["cls", "cls2"], "left")
    copy = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("gone", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("cuts", zero)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("left", "whole")).alias("kept_sha256"))
