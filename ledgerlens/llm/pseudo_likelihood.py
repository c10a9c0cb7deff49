"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the two before and the two after it by a small
network (embeddings, one hidden layer, softmax) trained here in numpy; a
document's score is the sum of the log-probabilities of its tokens, each
given both its sides. Tokens are words ``[^\\x20\\x09-\\x0D]+``: the commonest
of the corpus, counted over all documents, have an id each, all others one
of :data:`CLASSES` ids by a hash. The network predicts the id; a word of a
class then has its share of the class, ``(count + A) / (count of the class +
A (words of the class + 1))``, from the counts of all words of the corpus; one
``A`` is left for unseen words. The counts are a stored table that grows with
the corpus. Texts are cut into blocks: of each block, a row for each distinct
word is joined with the counts and meets the block's texts in a task, so no
task and no broadcast holds the table.

Training is distributed: in each of :data:`ROUNDS` rounds every task goes on
from the last parameters with minibatch steps over its own documents (every
:data:`ROUNDS`-th position, from the next start each round, so each position
is a target in exactly one round), and the
tasks' parameters are averaged, weighted by positions, in two levels. The
parameters are of fixed size (a few 100 KB).

Defined cases: a null text or one without words has 0 tokens, sum 0 and a
null mean; an empty table gives an empty result; repeated rows are scored
alike; a null doc_id is kept; further columns are ignored; words of equal count are ordered by their hash. A
text longer than a block is a block of its own, read in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.anchors import PIECE
from ledgerlens.llm.common import U, mix, slices, stored, utf8, word_hashes
from ledgerlens.llm.substrings import spaced

WORDS, CLASSES = 224, 31
SIDE = 2
WIDTH, HIDDEN = 16, 32
ROUNDS = 2
BATCH, RATE = 512, 0.25
MERGERS = 32
#: Bytes of text whose distinct words a task counts at a time and whose counts
#: another holds, and what is added to each count.
BLOCK = 32 << 20
A = 0.5
#: Ids: the words, the classes, and one for the places outside a text.
VOCABULARY = WORDS + CLASSES + 1
#: Values whose exponentials are summed as they are.
LARGE = 60
#: Places of an id's embedding among all embeddings.
CELLS = np.arange(VOCABULARY * WIDTH).reshape(VOCABULARY, WIDTH)
SHAPES = [(VOCABULARY, WIDTH), (2 * SIDE * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, VOCABULARY), (VOCABULARY,)]


def start_parameters() -> list[np.ndarray]:
    rng = np.random.default_rng(1)
    return [(rng.standard_normal(s) * (0.3 / np.sqrt(s[0]) if len(s) > 1 else 0)).astype(np.float32) for s in SHAPES]


def flat(parameters: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parameters])


def shaped(values: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for s in SHAPES:
        n = int(np.prod(s))
        out.append(values[at:at + n].reshape(s).astype(np.float32))
        at += n
    return out


def _hidden(p: list[np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = p[0][context].reshape(len(context), -1)
    return x, np.tanh(x @ p[1] + p[2])


def _weights(p: list[np.ndarray], h: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials of all ids' values, their sum, the logarithm of the own
    id's) for each token, which only count in proportion. Values are
    made smaller by their maximum where the parameters allow large ones: a
    hidden unit is at most 1, which bounds them."""
    z = h @ p[3]
    z += p[4]
    if np.abs(p[3]).sum(0).max() + np.abs(p[4]).max() > LARGE:
        z -= z.max(1, keepdims=True)
    own = z[np.arange(len(token)), token]
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], z.dtype), own


def log_probability(p: list[np.ndarray], context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Log-probability of each token given the ids on both its sides."""
    _, total, own = _weights(p, _hidden(p, context)[1], token)
    return own - np.log(total)


def step(p: list[np.ndarray], context: np.ndarray, token: np.ndarray, rate: float) -> None:
    """One gradient step on the mean loss of a batch, in place. The weights are
    not divided by their sums; what is multiplied with them is."""
    x, h = _hidden(p, context)
    z, total, _ = _weights(p, h, token)
    z[np.arange(len(token)), token] -= total
    by, share = np.float32(rate / len(token)), (1 / total)[:, None]
    dh = z @ p[3].T
    dh *= (1 - h * h) * share
    dx = dh @ p[1].T
    for value, grad in ((p[3], (h * share).T @ z), (p[4], share[:, 0] @ z), (p[1], x.T @ dh), (p[2], dh.sum(0))):
        value -= by * grad
    np.subtract.at(p[0].reshape(-1), CELLS[context.ravel()].ravel(), (by * dx).ravel())


def hash_class(h: np.ndarray) -> np.ndarray:
    return (mix(h) % U(CLASSES)).astype(np.int64)


class Ids:
    """Token ids of texts from the hashes of the common words (ascending)."""

    def __init__(self, common: np.ndarray):
        self.common = common

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(padded ids of all texts, place of each token in them, text and hash
        of each token)."""
        data, off = spaced(*utf8(texts))
        h, start, _ = word_hashes(data, 5)
        n = len(off) - 1
        text = np.searchsorted(off, start, side="right") - 1
        ids = WORDS + hash_class(h)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
            ids = np.where(self.common[at] == h, at, ids)
        place = np.arange(len(ids)) + SIDE * (text + 1)
        padded = np.full(len(ids) + SIDE * (n + 1), VOCABULARY - 1)
        padded[place] = ids
        return padded, place, text, h


def contexts(padded: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.stack([padded[place + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1)


BLOCKS = "block long, doc_id long, text string, word long, cls int, n long"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts, with the number of their block, and (without a text) every
    distinct word of each block with its class and count."""
    names, block = [c.split()[0] for c in BLOCKS.split(", ")], TaskContext.get().partitionId() << 32
    for b in slices(batches, "text", BLOCK):
        found = [word_hashes(spaced(*utf8(p.column("text")))[0], 5)[0] for p in slices(iter([b]), "text", PIECE)]
        word, n = np.unique(np.concatenate(found), return_counts=True)
        none = [pa.nulls(b.num_rows, t) for t in (pa.int64(), pa.int32(), pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, block)), b.column("doc_id"), b.column("text"), *none], names)
        none = [pa.nulls(len(word), b.schema.field(c).type) for c in ("doc_id", "text")]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), block)), *none, pa.array(word.view(np.int64)),
                                          pa.array(hash_class(word).astype(np.int32)), pa.array(n)], names)
        block += 1


def blocked(docs: DataFrame) -> DataFrame:
    """Texts and words of ``docs`` by block, stored."""
    return stored(docs.select("doc_id", "text").mapInArrow(_blocks, BLOCKS), "lm-blocks")


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, cls, n) of every distinct word of all blocks, stored."""
    return stored(blocks.where("word is not null").groupBy("word", "cls").agg(F.sum("n").alias("n")), "lm-words")


def common_words(counts: DataFrame) -> np.ndarray:
    """Hashes of the WORDS commonest words."""
    top = counts.select("word", "n").orderBy(F.desc("n"), "word").limit(WORDS).toArrow()
    return np.sort(top.column("word").to_numpy().view(U))


def class_sizes(counts: DataFrame, common: np.ndarray) -> np.ndarray:
    """Tokens and distinct words of every class, without the common words."""
    sizes = np.zeros((2, CLASSES))
    rare = counts.where(~F.col("word").isin(common.view(np.int64).tolist()))
    for r in rare.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():  # at most CLASSES rows
        sizes[:, r["cls"]] = r["n"], r["words"]
    return sizes


def _train(common, parameters, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, p, seen = Ids(common.value), shaped(parameters.value), 0
        for b in slices(batches, "text", PIECE):
            padded, place, _, _ = ids.read(b.column("text"))
            chosen = np.random.default_rng([turn, seen]).permutation(place[turn::ROUNDS])
            context, token = contexts(padded, chosen), padded[chosen]
            for s in range(0, len(token), BATCH):
                step(p, context[s:s + BATCH], token[s:s + BATCH], RATE)
            seen += len(token)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([flat(p).tobytes()], pa.binary()), pa.array([seen], pa.int64())], ["p", "seen"])
    return run


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("task")
    total = rows["seen"].sum()
    mean = sum(np.frombuffer(p, np.float32).astype(np.float64) * (s / total) for p, s in zip(rows["p"], rows["seen"], strict=True))
    return pd.DataFrame({"p": [mean.astype(np.float32).tobytes()], "seen": [total]})


def train(docs: DataFrame, counts: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(common words, flat parameters) from all documents; ``counts`` are their
    :func:`word_counts`, made here if not given."""
    context = docs.sparkSession.sparkContext
    common = common_words(word_counts(blocked(docs)) if counts is None else counts)
    shared, values = context.broadcast(common), flat(start_parameters())
    for turn in range(ROUNDS):
        local = docs.select("text").mapInArrow(_train(shared, context.broadcast(values), turn), "p binary, seen long")
        local = local.withColumn("task", F.spark_partition_id())
        merged = local.groupBy(F.pmod("task", F.lit(MERGERS))).applyInPandas(_average, "p binary, seen long").toPandas()
        if len(merged):  # at most MERGERS rows
            values = np.frombuffer(_average(merged.assign(task=merged["p"]))["p"][0], np.float32)
    return common, values


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(block, whether of texts, rows): batches cut where either changes."""
    for b in batches:
        block, texts = b.column("block").to_numpy(), np.asarray(b.column("word").is_null())
        edge = np.flatnonzero((block[1:] != block[:-1]) | (texts[1:] != texts[:-1])) + 1
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows], strict=True):
            if e > s:
                yield block[s], texts[s], b.slice(s, e - s)


def _score(common, parameters, sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, p = Ids(common.value), shaped(parameters.value)
        tokens, distinct = sizes.value
        rest = np.log(tokens + A * (distinct + 1))
        at, held, word, count = None, [], np.empty(0, U), np.empty(0)
        for block, texts, rows in _parts(batches):
            if block != at:
                at, held, word, count = block, [], np.empty(0, U), np.empty(0)
            if not texts:
                held.append((rows.column("word").to_numpy().view(U), rows.column("count").to_numpy()))
                continue
            if held:
                word, count = (np.concatenate(x) for x in zip(*held, strict=True))
                order, held = np.argsort(word), []
                word, count = word[order], count[order]
            for b in slices(iter([rows]), "text", PIECE):
                padded, place, text, h = ids.read(b.column("text"))
                # the share of each word of a class
                rare = np.flatnonzero(padded[place] >= WORDS)
                cls, met = padded[place[rare]] - WORDS, np.zeros(len(rare))
                if len(word):
                    k = np.minimum(np.searchsorted(word, h[rare]), len(word) - 1)
                    met = np.where(word[k] == h[rare], count[k], 0)
                total = np.bincount(text[rare], np.log(met + A) - rest[cls], b.num_rows)
                for s in range(0, len(place), 2048):
                    i = place[s:s + 2048]
                    total += np.bincount(text[s:s + 2048], log_probability(p, contexts(padded, i), padded[i]), b.num_rows)
                n = np.bincount(text, minlength=b.num_rows)
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(total), mean],
                                                 ["doc_id", "n_tokens", "pseudo_log_likelihood", "mean_log_prob"])
    return run


def _scored(blocks: DataFrame, common: np.ndarray, values: np.ndarray, counts: DataFrame) -> DataFrame:
    """Of a block, the words come first: each once with its count in the
    corpus (0 if it has none there), so a word has at most a row per block."""
    context = blocks.sparkSession.sparkContext
    known = counts.select(F.col("word").alias("known"), F.col("n").alias("count"))
    words = blocks.where("word is not null").select("block", "word").join(known, F.col("word") == F.col("known"), "left").select(
        "block", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "word",
        F.coalesce("count", F.lit(0).cast("long")).alias("count"))
    texts = blocks.where("word is null").select("block", "doc_id", "text", "word", F.lit(0).cast("long").alias("count"))
    rows = texts.unionByName(words).repartition("block").sortWithinPartitions("block", F.col("word").isNull())
    return rows.mapInArrow(
        _score(context.broadcast(common), context.broadcast(values), context.broadcast(class_sizes(counts, common))),
        "doc_id long, n_tokens long, pseudo_log_likelihood double, mean_log_prob double")


def score(docs: DataFrame, common: np.ndarray, values: np.ndarray, counts: DataFrame | None = None) -> DataFrame:
    """n_tokens, summed and mean log-probability of every whole text; ``counts``
    are the :func:`word_counts` of the training corpus, by default of ``docs``."""
    blocks = blocked(docs)
    return _scored(blocks, common, values, word_counts(blocks) if counts is None else counts)


def op7_lm_scoring(docs: DataFrame) -> DataFrame:
    blocks = blocked(docs)
    counts = word_counts(blocks)
    return _scored(blocks, *train(docs, counts), counts)
