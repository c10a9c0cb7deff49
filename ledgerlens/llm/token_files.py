"""Token files: Parquet list columns in document order, written with
dictionary encoding, small row groups and page indexes.

:func:`encode` turns texts into token ids with a public tokenizer file.
:func:`write_token_files` orders documents by id across files and writes
one row per document: ``doc_id``, ``ids`` (list of int32), ``n_tokens``,
``at`` (ids before it in its file) and ``seq``, its place (file number, row).
:func:`read_token_files` reads them back with each document's start offset
in the whole stream: ``at`` and the ids of the files before, one number a
file. Reading only ``doc_id``/``n_tokens`` touches no token
page, and a filter on ``doc_id`` skips row groups and pages by statistics.

Defined cases: a null or empty text is the end id alone; a null doc_id
sorts first; rows that share a doc_id are ordered by their ids; further
columns of the input (named like a stored one or not) are not stored. A text of any length is one row, encoded
whole in memory that grows with that text. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Splitter, per_worker, slices, stored
from ledgerlens.session import new_scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Distinct words whose ids a Python worker keeps (two generations of this size).
MEMO = 250_000
ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 128 << 10


class _Recent(dict):
    """Words' ids, made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.make(word)
        return ids


class _Words:
    """ids of a word as little-endian bytes, remembered for recent words.

    The tokenizer's model is applied to each match of its byte-level
    pattern, which is what encoding a whole text does if no added token of
    the file is in it; a text with one is encoded by the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find = Splitter()
        # The byte-level alphabet: printable Latin-1 bytes stand for
        # themselves, the others for the code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.new, self.old = _Recent(self._ids), {}

    def _ids(self, word: str) -> bytes:
        known = self.old.pop(word, None)
        if known is not None:
            return known
        shown = word.encode("utf-8").decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        out = b"".join(map(self.new.__getitem__, self.find(text)))
        if len(self.new) > MEMO:
            self.old, self.new = self.new, _Recent(self._ids)
        return out


def encode(df: DataFrame, tokenizer: str = TOKENIZER, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids array<int>, n_tokens long, at long) of every whole ``text``;
    ``at`` counts the ids that the task has made before."""
    end = b"" if end_id is None else np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_worker(f"token words {tokenizer}", lambda: _Words(tokenizer))
        made = 0
        for b in slices(batches, "text"):
            blobs = [(enc.encode(t) if t else b"") + end for t in b.column("text").to_pylist()]
            n = np.fromiter((len(x) // 4 for x in blobs), np.int64, len(blobs))
            off = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            at = made + np.cumsum(n) - n
            made += int(n.sum())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.array(n), pa.array(at)], ["doc_id", "ids", "n_tokens", "at"])

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, at long")


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Write the token files of ``docs`` in ascending doc_id order.

    Texts, smaller than their ids, are range-partitioned by doc_id, so each
    file holds one range of ids; files are numbered in that order. Rows of a
    task are encoded in order as the file is written.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    out = encode(ordered, tokenizer).withColumn("seq", F.monotonically_increasing_id())
    (out.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES).option("parquet.enable.dictionary", "true")
        .parquet(path))


FILE_SCHEMA = "doc_id long, ids array<int>, n_tokens long, at long, seq long"
#: Files whose start offsets are broadcast (16 bytes each); of more, they are joined by a shuffle.
BROADCAST_FILES = 1 << 20


def with_starts(files: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with ``start``: ``at`` and the ids of all files before. Each
    file's total is read from ``n_tokens`` alone; there are as many totals as files."""
    part = F.shiftright("seq", 33)
    totals = stored(files.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("t")), "token-totals")
    before = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    few = F.broadcast if totals.count() <= BROADCAST_FILES else lambda x: x
    return rows.join(few(before), part == F.col("part")).withColumn("start", F.col("before") + F.col("at"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids, n_tokens, start): ``start`` counts the ids of all
    documents before it."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    return with_starts(files, files).select("doc_id", "ids", "n_tokens", "start")


def _ids_crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column("ids")
        off = np.asarray(col.offsets)
        flat = np.asarray(col.values).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[s:e]) for s, e in zip(off[:-1], off[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_tokens", "at", "seq")), pa.array(crc, pa.int64())],
                                         ["doc_id", "n_tokens", "at", "seq", "ids_crc32"])


def op8_token_files(docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs``, read them back and digest them."""
    spark = docs.sparkSession
    path = new_scratch(spark, "token-files")
    write_token_files(docs, path)
    return digest(spark, path)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each document's ids, read
    from the files. Ids are digested where they are read; only figures are
    summed and joined."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    rows = files.mapInArrow(_ids_crc32, "doc_id long, n_tokens long, at long, seq long, ids_crc32 long")
    return with_starts(files, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
