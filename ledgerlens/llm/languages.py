"""Language identification of documents and of spans inside them.

A model holds, per language, log-probabilities of hashed letter trigrams and
the scripts its letters come from. For each word (a run of letters) the script
of its first letter narrows the candidates; the trigrams score it under
each; and a Viterbi pass over the words of a text, in which changing the
language costs :data:`SWITCH`, labels them, so a text of several languages
falls into spans. A document's language is that of most of its letters, its
score their share.

The classifier is fitted on a bounded sample of the labelled rows, about
``train_rows`` of them, drawn by a hash of doc_id; it holds languages x
:data:`BUCKETS` numbers.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
letters of scripts that no learned language uses give no evidence, and a
text of only such ones gets the commonest language; without labelled rows
all is ``und``; a null doc_id counts as held out; repeated rows are predicted
alike; equal scores go to the language that sorts first; an empty table gives an
empty result; further columns are ignored. A text of any length is read whole; one longer
than a piece is a piece of its own, so memory grows with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import U, mix, slices

BUCKETS = 1 << 16
TRAIN_ROWS = 20_000
#: Values of the hash that draws the sample: far more than a table has rows.
HASHES = 1 << 48
#: Word positions whose back-pointers the Viterbi pass holds at a time.
HELD_STEPS = 1 << 14
#: Cost of a change of language between two words, in nats.
SWITCH = 8.0
#: Least share of a language's letters for a script to count as its own.
SCRIPT_SHARE = 0.01
#: First code point of consecutive Unicode ranges, with their script.
RANGES = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"),
    (0x0B80, "Tamil"), (0x0C00, "other"), (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"),
    (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"),
    (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB07, "other"), (0x20000, "Han"), (0x323B0, "other"),
]
SCRIPTS = sorted({name for _, name in RANGES})
UNKNOWN = -1e4


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the doc_id's text is divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class _Letters:
    """Words of texts as arrays: trigram buckets of letters, word bounds."""

    def __init__(self):
        top = RANGES[-1][0]  # no code point from here on is a letter; one entry stands for all of them
        self.alpha = np.fromiter((i < top and chr(i).isalpha() for i in range(top + 1)), bool, top + 1)
        self.lower = np.fromiter((ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(top + 1)), np.uint32, top + 1)
        self.edges = np.array([x for x, _ in RANGES])
        self.scripts = np.array([SCRIPTS.index(n) for _, n in RANGES])
        self.top = top

    def read(self, texts: list[str | None]):
        """(buckets of all letters, first letter of each word, script of each
        word, text of each word, code point offset of each word's first letter
        in its text, letters of each word)."""
        points = np.frombuffer("\n".join([t or "" for t in texts] + [""]).encode("utf-32-le"), "<u4")
        size = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
        begin = np.concatenate(([0], np.cumsum(size)))
        points = np.minimum(points, self.top)
        alpha = self.alpha[points]
        low = np.where(alpha, self.lower[points], 0).astype(U)
        at = np.flatnonzero(alpha)
        pad = np.concatenate((np.zeros(1, U), low, np.zeros(1, U)))
        tri = mix(pad[at] << U(42) | pad[at + 1] << U(21) | pad[at + 2])
        first = np.flatnonzero(pad[at] == 0)
        script = self.scripts[np.searchsorted(self.edges, points[at[first]], side="right") - 1]
        text = np.searchsorted(begin, at[first], side="right") - 1
        letters = np.diff(np.append(first, len(at)))
        return (tri >> U(48)).astype(np.int64), first, script, text, at[first] - begin[text], letters


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray      # languages x BUCKETS
    prior: np.ndarray     # log share of each language
    scripts: np.ndarray   # languages x scripts: may be written in


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts of a task's rows, per language."""
    reader, sums = _Letters(), {}
    for b in slices(batches, "text"):
        langs = b.column("lang").to_pylist()
        tri, first, script, text, _, letters = reader.read(b.column("text").to_pylist())
        owner = np.repeat(text, letters)
        for lang in set(langs):
            mine = np.array([x == lang for x in langs])
            total = sums.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
            total[:BUCKETS] += np.bincount(tri[mine[owner]], minlength=BUCKETS)
            chosen = mine[text]
            total[BUCKETS:-1] += np.bincount(script[chosen], letters[chosen], len(SCRIPTS)).astype(np.int64)
            total[-1] += mine.sum()
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                                         ["lang", "at", "n"])


def sample_bound(n: int, train_rows: int) -> int:
    """Of the hash values below HASHES, how many put one of ``n`` rows into a
    sample of about ``train_rows``; never none."""
    return max(1, HASHES * min(train_rows, n) // max(n, 1))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from about ``train_rows`` rows of ``docs`` (doc_id, text, lang)
    that are labelled and not held out."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < sample_bound(rows.count(), train_rows)
    counts = rows.where(share).select("text", "lang").mapInArrow(_counts, "lang string, at long, n long")
    table = counts.groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    total = np.zeros((len(langs), BUCKETS + len(SCRIPTS) + 1))
    which = np.searchsorted(np.array(langs, object), np.array(table.column("lang").to_pylist(), object)) if langs else []
    total[which, table.column("at").to_numpy()] = table.column("n").to_numpy()
    tri, script, docs_of = total[:, :BUCKETS] + 0.1, total[:, BUCKETS:-1], total[:, -1]
    logp = np.log(tri / tri.sum(1, keepdims=True)).astype(np.float32)
    own = script >= SCRIPT_SHARE * np.maximum(script.sum(1, keepdims=True), 1)
    return Model(langs, logp, np.log(docs_of / max(docs_of.sum(), 1) + 1e-9), own & (script > 0))


def viterbi(scores: np.ndarray, begin: np.ndarray, size: np.ndarray, prior: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word. ``scores`` is languages x words; text
    i has the ``size[i]`` words from ``begin[i]`` on. All texts advance
    together, longest first, word by word. Back-pointers are held for
    :data:`HELD_STEPS` positions; of earlier ones, the values at the start of
    each such run, from which its back-pointers are made again."""
    label = np.zeros(scores.shape[1], np.int16)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right").tolist()

    def advance(value: np.ndarray, low: int, high: int, finish: bool) -> tuple[np.ndarray, list]:
        steps = []
        for t in range(low, high):
            k = active[t]
            v = value[:, :k]
            best = v.argmax(0)
            change = v[best, np.arange(k)] - switch
            stay = (v >= change) | (t == 0)  # the first word changes from nothing
            value = np.where(stay, v, change) + scores[:, begin[:k] + t]
            steps.append((stay, best.astype(np.int16)))
            after = active[t + 1] if t + 1 < len(active) else 0
            if finish and after < k:
                done = np.arange(after, k)
                label[begin[done] + t] = value[:, done].argmax(0)
        return value, steps

    value, steps, starts = np.repeat(prior[:, None], len(size), 1), [], []
    for low in range(0, len(active), HELD_STEPS):
        starts.append(value)
        value, steps = advance(value, low, min(low + HELD_STEPS, len(active)), True)
    for run in range(len(starts) - 1, -1, -1):
        low = run * HELD_STEPS
        if run + 1 < len(starts):
            _, steps = advance(starts[run], low, low + HELD_STEPS, False)
        for t in range(low + len(steps) - 1, max(low, 1) - 1, -1):
            stay, best = steps[t - low]
            k = active[t]
            now = label[begin[:k] + t]
            label[begin[:k] + t - 1] = np.where(stay[now, np.arange(k)], now, best)
    return label


def _predict(model, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, reader = Model(*model.value), _Letters()
        for b in slices(batches, "text"):
            tri, first, script, text, at, letters = reader.read(b.column("text").to_pylist())
            n = b.num_rows
            total = np.bincount(text, letters, n)
            lang, score, found = [None] * n, np.zeros(n), [[] for _ in range(n)]
            if m.languages and len(first):
                scores = np.stack([np.add.reduceat(lp[tri], first) for lp in m.logp])
                own = m.scripts[:, script]
                scores = np.where(own, scores, np.where(own.any(0), UNKNOWN, 0.0))
                begin = np.searchsorted(text, np.arange(n + 1))
                label = viterbi(scores, begin[:-1], np.diff(begin), m.prior)
                share = np.zeros((len(m.languages), n))
                np.add.at(share, (label, text), letters)
                best = share.argmax(0)
                score = share[best, np.arange(n)] / np.maximum(total, 1)
                lang = [m.languages[x] for x in best.tolist()]
                cut = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (text[1:] != text[:-1]))))
                cuts = np.bincount(text[cut], minlength=n)
                if spans:
                    end = (at + letters)[np.append(cut[1:], len(label)) - 1]
                    for t, s, e, x in zip(text[cut].tolist(), at[cut].tolist(), end.tolist(), label[cut].tolist(), strict=True):
                        found[t].append({"start": s, "end": e, "lang": m.languages[x]})
            else:
                cuts = np.zeros(n, np.int64)
            lang = [x if x is not None and k else "und" for x, k in zip(lang, total.tolist(), strict=True)]
            cols = [b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(cuts.astype(np.int64))]
            if spans:
                cols.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "lang_pred", "score", "n_spans", *["spans"] * spans])
    return run


def predict(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_spans of every whole text and,
    if asked, its spans (code point offsets and language). Only doc_id and
    text are read, and doc_id only for held_out."""
    out = "doc_id long, held_out boolean, lang_pred string, score double, n_spans long"
    if spans:
        out += ", spans array<struct<start:long,end:long,lang:string>>"
    # languages x BUCKETS numbers; as a plain tuple, which a task can read without this package
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.logp, model.prior, model.scripts))
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(_predict(shared, spans), out)


def op4_language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))
