"""SentencePiece BPE by backtracking, exact to the library's result.

A piece is the right one at a place if it does not merge across its border
with the piece before it. :meth:`PieceBpe.pieces` finds with an
Aho-Corasick automaton the longest piece that starts at each place, tries it
and then its shorter prefixes that are pieces, and asks
:meth:`PieceBpe.compatible` whether the pair stays two pieces, which merges
the two anew along their border. Where no piece fits, the place is marked in
a bitfield as failed, never to be ended at again, and the last piece is taken back.
The encoding of a prefix is unique, so no place fails twice.

A text is cut where no piece reaches across: before a word's run of spaces,
and around characters that occur in no piece of several characters. So the
encoding of a chunk does not depend on its neighbours and can be remembered.

For models of kind BPE with the identity normalizer, a dummy prefix, no removal of white space and
byte fallback (checked on probe texts when a model is loaded), whose pieces
are merged from pieces of no lower score; others raise ``ValueError``.

Defined cases: a null or empty text has no ids and decodes to the empty
text; a character that is no piece becomes its UTF-8 bytes; U+2581 in a text is a
space, as the library has it; names of control pieces are ordinary text. A text of any length
is encoded whole, in memory that grows with that one text alone. Equal
scores merge from the left. Repeated rows and further columns are kept (columns
named like a result give way); an empty table gives an empty table.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import groupby

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import per_worker, slices, whole_row

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Chunks and piece pairs that a Python worker remembers (chunks: two generations).
MEMO = 400_000
#: Longer chunks are encoded each time, so the memory of chunks stays small.
MEMO_CHARS = 64
#: The library is asked for these when a model is loaded, to see that it is of the kind that this module knows.
PROBES = ("", " ", "a", " two  words ", "line\n\ttab\r", "é ﬁ 　 ▁x", "été \U0001f600 �\x00", "<s> <0x0A>", "     in dent")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """An invalid byte becomes U+FFFD, and decoding goes on at the next one."""
    return "�", error.start + 1


class PieceBpe:
    """Encoder and decoder over the pieces of a model file."""

    def __init__(self, path: str = MODEL):
        import ahocorasick
        import sentencepiece

        codecs.register_error("each_byte", _each_byte)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id: dict[int, int] = {}
        self.shown: list[bytes] = []  # what an id decodes to
        self.strips: list[bool] = []  # whether a text that starts with this id loses a space
        self.controls = frozenset(filter(model.is_control, range(model.get_piece_size())))
        for i in range(model.get_piece_size()):
            piece, byte = model.id_to_piece(i), model.is_byte(i)
            if byte:
                self.byte_id[int(piece[3:5], 16)] = i
                self.shown.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.shown.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
                self.shown.append(piece.replace(SPACE, " ").encode("utf-8"))
            self.strips.append(not byte and piece.startswith(SPACE))
        if len(self.byte_id) < 256 or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError(f"{path}: needs byte fallback and spaces only at the start of pieces")

        joined = set("".join(p for p in self.ids if len(p) > 1)) - {SPACE}
        kept = "".join(map(re.escape, sorted(joined)))
        # a word with the spaces before it | spaces | characters that never join
        self.chunks = re.compile(f" *[{kept}]+| +|[^{kept} ]+").findall
        self.never_joins = re.compile(f"[^{kept} ]").match
        self._halves: dict[str, tuple[str, str] | None] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self.automaton = ahocorasick.Automaton()
        made = [p for p in sorted(self.ids, key=len) if len(p) > 1 and self.halves(p)]
        #: The longest proper prefix of a piece that can be a piece of an encoding (a single character always can).
        self.shorter: dict[str, str] = {}
        for piece in made:
            self.automaton.add_word(piece, (len(piece) - 1, piece))
            n = len(piece) - 1
            while n > 1 and piece[:n] not in self.shorter:
                n -= 1
            self.shorter[piece] = piece[:n]
        self.automaton.make_automaton()
        for probe in PROBES:
            if self.encode(probe) != model.encode(probe) or self.decode(self.encode(probe)) != model.decode(model.encode(probe)):
                raise ValueError(f"{path}: not a model of the kind that this module encodes")

    # --- how a piece comes about ---------------------------------------------------
    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``, or None if merging its
        characters, best score first, does not end in it."""
        if piece not in self._halves:
            self._halves[piece] = self._merge_alone(piece)
        return self._halves[piece]

    def _merge_alone(self, piece: str) -> tuple[str, str] | None:
        parts = list(piece)
        while len(parts) > 2:
            gains = [self.score.get(a + b, -float("inf")) for a, b in zip(parts, parts[1:])]
            best = max(gains)
            if best == -float("inf"):
                return None
            at = gains.index(best)  # the leftmost of equal scores
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        a, b = parts
        if any(len(p) > 1 and self.score[p] < self.score[piece] for p in parts):
            raise ValueError(f"piece {piece!r} is merged from a piece of lower score")
        return a, b

    def compatible(self, left: str, right: str) -> bool:
        """Whether ``left`` then ``right`` stay two pieces when their
        characters are merged."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > MEMO:
                self._pairs.clear()
            known = self._pairs[left, right] = self._remerge(left, right)
        return known

    def _remerge(self, left: str, right: str) -> bool:
        """Merge both pieces anew: the pieces at the border grow from single
        characters in the order of their scores (the left first, if equal);
        if a merge across the border is due before either grows, it happens."""
        grown_left, grown_right = [left], [right]  # the last grown first
        while len(grown_left[-1]) > 1:
            grown_left.append(self.halves(grown_left[-1])[1])
        while len(grown_right[-1]) > 1:
            grown_right.append(self.halves(grown_right[-1])[0])
        i, j = len(grown_left) - 1, len(grown_right) - 1
        never = -float("inf")
        while True:
            across = self.score.get(grown_left[i] + grown_right[j], never)
            next_left = self.score[grown_left[i - 1]] if i else never
            next_right = self.score[grown_right[j - 1]] if j else never
            if across > next_left and across >= next_right and across != never:
                return False
            if not i and not j:
                return True
            if next_left >= next_right and i:
                i -= 1
            else:
                j -= 1

    # --- encoding --------------------------------------------------------------------
    def pieces(self, chunk: str) -> list[str]:
        """The pieces of a chunk, characters that are no piece included."""
        if chunk in self.shorter or len(chunk) < 2:
            return [chunk] if chunk else []
        n, shorter, pairs, compatible = len(chunk), self.shorter.get, self._pairs.get, self.compatible
        longest = list(chunk)
        for end, (back, piece) in self.automaton.iter(chunk):
            longest[end - back] = piece  # later ends are longer
        failed, any_failed = bytearray(n + 8 >> 3), False
        at, piece, left, out = 0, longest[0], None, []
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    stays = left is None or pairs((left, piece))
                    if stays is None:
                        stays = compatible(left, piece)
                    if stays:
                        break
                piece = shorter(piece)
            if piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                piece = out.pop()
                at -= len(piece)
                piece, left = shorter(piece), out[-1] if out else None
            else:
                out.append(piece)
                left, at = piece, end
                piece = longest[at] if at < n else None
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        """The ids of a chunk, whose spaces are still spaces."""
        found = chunk if self.never_joins(chunk) else self.pieces(chunk.replace(" ", SPACE))
        try:
            return [self.ids[p] for p in found]
        except KeyError:
            pass
        out = []
        for p in found:
            out += [self.ids[p]] if p in self.ids else [self.byte_id[b] for b in p.encode("utf-8")]
        return out

    def normalized(self, text: str) -> str:
        """What is encoded: a space before the text; U+2581 is a space."""
        return " " + text.replace(SPACE, " ") if text else ""

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(self.normalized(text)) for i in self.encode_chunk(c)]

    # --- decoding --------------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        """The text of any ids, without the space of the dummy prefix. Control
        pieces show nothing, but no character is put together across one."""
        shown = self.shown
        if self.controls.isdisjoint(ids):
            out, first = b"".join([shown[i] for i in ids]).decode("utf-8", "each_byte"), ids[:1]
        else:
            runs = [list(run) for control, run in groupby(ids, self.controls.__contains__) if not control]
            out = "".join([b"".join([shown[i] for i in run]).decode("utf-8", "each_byte") for run in runs])
            first = runs[0][:1] if runs else []
        return out[1:] if first and self.strips[first[0]] else out


class _Texts:
    """Ids of whole texts: recent chunks are remembered as (decimal ids, ids)."""

    def __init__(self, path: str):
        self.bpe = PieceBpe(path)
        self.new: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def encode(self, text: str) -> tuple[bytes, list[int]]:
        """(ids in decimal, joined by commas; the ids)."""
        bpe = self.bpe
        found = bpe.chunks(bpe.normalized(text))
        new, long = self.new, {}
        for c in set(found).difference(new):
            known = self.old.pop(c, None)
            if known is None:
                ids = bpe.encode_chunk(c)
                known = (str(ids)[1:-1].replace(" ", "").encode(), array("i", ids).tobytes())
            (long if len(c) > MEMO_CHARS else new)[c] = known
        if long:
            parts = [new[c] if c in new else long[c] for c in found]
        else:
            parts = [new[c] for c in found]
        if len(new) > MEMO:
            self.old, self.new = new, {}
        decimal, ids = zip(*parts)
        return b",".join(decimal), array("i", b"".join(ids)).tolist()


def encode_decode(df: DataFrame, model: str = MODEL, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 (and, if asked,
    ``ids`` and ``decoded``); ``df``'s own columns of these names give way."""
    made = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if with_ids:
        made |= {"ids": pa.list_(pa.int32()), "decoded": pa.string()}
    kept = T.StructType([f for f in df.schema.fields if f.name not in made])
    spark_type = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType())}
    schema = T.StructType([T.StructField("_row", kept), *(T.StructField(c, spark_type.get(c, T.StringType())) for c in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_worker(f"pieces {model}", lambda: _Texts(model))
        for b in slices(batches, "_text"):
            out = {c: [] for c in made}
            for t in b.column("_text").to_pylist():
                decimal, ids = enc.encode(t) if t else (b"", [])
                decoded = enc.bpe.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(decimal).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if with_ids:
                    out["ids"].append(ids)
                    out["decoded"].append(decoded)
            yield pa.RecordBatch.from_arrays([b.column("_row"), *(pa.array(out[c], k) for c, k in made.items())], ["_row", *made])

    rows = df.select(whole_row(df, tuple(made)), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, schema).select("_row.*", *made)


def op11_sentencepiece(docs: DataFrame) -> DataFrame:
    return encode_decode(docs.select("doc_id", "text")).drop("text")
