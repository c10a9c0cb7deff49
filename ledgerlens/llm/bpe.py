"""Byte-level BPE by prefix dynamic programming.

For every prefix of a word there is exactly one token that can end its
encoding. :class:`PrefixBpe` stores that last token per byte prefix: the
encoding of a prefix is read by following last tokens backwards, appending
bytes only extends the table, and an edit recomputes it from the edited
byte on, which is why both are exact. A candidate ending (a token that is a
suffix of the prefix) is the right one when it and the last token of what
precedes it stay two tokens, which :meth:`PrefixBpe._stays` decides by
undoing merges along their border.

Each match of the split pattern is encoded separately. Defined cases: a null
text counts as empty (no ids, hash of the empty string); strings of special
tokens are ordinary text; repeated rows and further columns are kept (columns
named like a result give way); an empty table gives an empty result. A text
of any length is encoded whole; words longer than :data:`MEMO_CHARS` are not remembered.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import Splitter, per_worker, slices, whole_row

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Distinct words and token pairs a Python worker remembers (words: two generations).
MEMO = 200_000
#: Longer words are encoded each time, so the memory of words stays small.
MEMO_CHARS = 64


class PrefixBpe:
    """Encoder over the ranks of a public vocabulary file."""

    def __init__(self, path: str = RANKS):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(t): int(r) for t, r in pairs}
        self.token = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for token, r in sorted(self.rank.items(), key=lambda kv: kv[1]):
            if len(token) > 1:
                parts = self._merge_below(token, r)
                if len(parts) == 2:
                    self.merged[parts[0], parts[1]] = r
                    self.halves[r] = (parts[0], parts[1])
        self.known: dict[tuple[int, int], bool] = {}

    def _merge_below(self, token: bytes, limit: int) -> list[int]:
        """``token``'s encoding by the merges that come before its own."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 1:
            best, at = limit, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1], limit)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def _stays(self, left: int, right: int) -> bool:
        """Whether ``left`` then ``right`` is the encoding of their bytes."""
        key = (left, right)
        known = self.known.get(key)
        if known is None:
            if len(self.known) > MEMO:
                self.known.clear()
            known = self.known[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        limit = 1 << 62
        while True:
            r = self.merged.get((left, right))
            if r is not None and r < limit:
                return False  # the border would have been merged first
            if left > right:
                limit = left
                if left not in self.halves:
                    return True
                left = self.halves[left][1]
                if left == limit:
                    return True
            else:
                limit = right + 1
                if right not in self.halves:
                    return True
                right = self.halves[right][0]

    def extend(self, data: bytes, last: list[int], start: int) -> list[int]:
        """The table of last tokens of ``data``, of which the entries of the
        first ``start`` bytes in ``last`` are kept."""
        rank, token, longest, stays = self.rank, self.token, self.longest, self._stays
        del last[start:]
        for end in range(start + 1, len(data) + 1):
            for size in range(min(longest, end), 0, -1):
                r = rank.get(data[end - size:end])
                if r is not None and (size == end or stays(last[end - size - 1], r)):
                    # the ending must also be a token by its own merges
                    if size == 1 or r in self.halves:
                        last.append(r)
                        break
        return last

    def read(self, last: list[int], end: int | None = None) -> list[int]:
        """The ids of the prefix of ``end`` bytes (default: all)."""
        out, at = [], len(last) if end is None else end
        while at:
            out.append(last[at - 1])
            at -= len(self.token[last[at - 1]])
        return out[::-1]

    def encode_word(self, data: bytes) -> list[int]:
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]  # a whole word in the vocabulary is one token
        return self.read(self.extend(data, [], 0))

    def decode(self, ids) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])


class PrefixTable:
    """A word under change: exact ids after each append or edit."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data = bpe, bytes(data)
        self.last = bpe.extend(self.data, [], 0)

    def append(self, more: bytes) -> None:
        kept = len(self.data)
        self.data += more
        self.bpe.extend(self.data, self.last, kept)

    def edit(self, at: int, removed: int, inserted: bytes) -> None:
        """Replace ``removed`` bytes at ``at``; entries before ``at`` stay."""
        self.data = self.data[:at] + inserted + self.data[at + removed:]
        self.bpe.extend(self.data, self.last, at)

    def ids(self, end: int | None = None) -> list[int]:
        return self.bpe.read(self.last, end)


class _Texts:
    """Ids of whole texts as little-endian bytes; recent words remembered."""

    def __init__(self, path: str):
        self.bpe = PrefixBpe(path)
        self.find = Splitter()
        self.new, self.old = {}, {}

    def encode(self, text: str) -> bytes:
        found = self.find(text)
        new, bpe = self.new, self.bpe
        long = {}
        for w in set(found).difference(new):
            known = self.old.pop(w, None)
            if known is None:
                known = np.array(bpe.encode_word(w.encode("utf-8")), "<u4").tobytes()
            if len(w) > MEMO_CHARS:
                long[w] = known
            else:
                new[w] = known
        out = b"".join([new[w] for w in found]) if not long else b"".join([new[w] if w in new else long[w] for w in found])
        if len(new) > MEMO:
            self.old, self.new = new, {}
        return out


def encode_decode(df: DataFrame, ranks: str = RANKS, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 (and, if asked,
    ``ids`` and ``decoded``); ``df``'s own columns of these names give way."""
    made = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if with_ids:
        made |= {"ids": pa.list_(pa.int32()), "decoded": pa.string()}
    kept = T.StructType([f for f in df.schema.fields if f.name not in made])
    spark_type = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType())}
    schema = T.StructType([T.StructField("_row", kept), *(T.StructField(c, spark_type.get(c, T.StringType())) for c in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_worker(f"prefix words {ranks}", lambda: _Texts(ranks))
        vocabulary = [enc.bpe.token.get(i, b"") for i in range(max(enc.bpe.token) + 1)]
        for b in slices(batches, "_text"):
            out = {c: [] for c in made}
            for t in b.column("_text").to_pylist():
                blob = enc.encode(t) if t else b""
                ids = np.frombuffer(blob, "<u4")
                decoded = b"".join([vocabulary[i] for i in ids.tolist()])
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(blob).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    out["ids"].append(ids.astype(np.int32))
                    out["decoded"].append(decoded.decode("utf-8"))
            yield pa.RecordBatch.from_arrays([b.column("_row"), *(pa.array(out[c], k) for c, k in made.items())], ["_row", *made])

    rows = df.select(whole_row(df, tuple(made)), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, schema).select("_row.*", *made)


def op2_byte_level_bpe(docs: DataFrame) -> DataFrame:
    return encode_decode(docs.select("doc_id", "text")).drop("text")
