"""N-gram Jaccard join with filters under several global token orders.

A document's tokens are its distinct word shingles. Two sets whose Jaccard
similarity reaches the threshold share a token among the first
``n - ceil(t n) + 1`` of each, under *any* one order of all tokens. Pairs are
generated by the prefixes of a first order, which puts frequent tokens last;
enough tokens must follow their first common one in both sets. They must also
share prefix tokens under two further, hashed orders (small signatures decide
that), and what is left is verified on the whole sets.

Only links between different sets matter, and only components are asked
for, so pairs inside a component already found are not looked at: documents
with equal sets are one node; in rounds, each token pairs its documents with one
of them (a star, each round around another), and the links found are joined up.
A family of copies of which not every two are similar is one component after
a few rounds, each of at most a pair a document. When :data:`IDLE_ROUNDS`
rounds running have found few links (one in :data:`USEFUL` pairs), or after
:data:`STAR_ROUNDS` rounds, the pairs of a token's documents that are still in different components are tried:
all of them, but of a family (:data:`FAMILY` documents or more that share tokens) only those whose differences
from the family's middle have enough in common. No bucket is capped, and every link between
components is found. A task passes on only a spanning forest of its links.

Frequent tokens are those that some task meets repeatedly; their counts are
summed over all documents and the :data:`FREQUENT` highest are broadcast (16
MB at most). They only shape the first order: any order gives the same links.

Defined cases: a text without words (null or empty) has an empty set and is
linked with nothing; with fewer words than a shingle, the whole sequence is
its one token; a null doc_id is in no component (null); rows that share a
doc_id are one node; an empty table gives an empty result; further columns
are ignored. A text longer than a task's piece is a piece of its own, read
whole. Ties: a component is named by its smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.anchors import PIECE
from ledgerlens.llm.common import U, among, forget_other_operators, gram_hashes, mix, release, slices, stored, unpacked, utf8, whole_row, word_hashes
from ledgerlens.llm.components import joined_up
from ledgerlens.llm.substrings import spaced

SHINGLE = 5
#: Similarity, as a fraction.
NUM, DEN = 4, 5
#: Size of the broadcast table of frequent tokens.
FREQUENT = 1 << 20
#: Times one task must meet a token, and all tasks, to call it frequent.
LOCAL, GLOBAL = 2, 2
#: Rounds of stars at most; a round is useful if one of so many pairs is a link; rounds running without use that end them.
STAR_ROUNDS, USEFUL, IDLE_ROUNDS = 10, 16, 2
#: Tokens whose documents a task groups at a time.
HELD = 5 << 17
#: Documents of a family at least: fewer are paired by their common tokens.
FAMILY = 64
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of every text."""
    data, off = spaced(*utf8(texts))
    h, start, _ = word_hashes(lower_ascii(data), 3)
    first = np.searchsorted(start, off)
    out = []
    for i in range(len(off) - 1):
        w = h[first[i]:first[i + 1]]
        out.append(np.unique(gram_hashes(w, min(k, len(w)) or 1)))
    return out


def prefix_size(n):
    return n - (NUM * n + DEN - 1) // DEN + 1


def set_hash(s: np.ndarray) -> tuple[int, int]:
    a = mix(s + U(11)).sum(dtype=U), mix(s ^ U(0x2545F4914F6CDD1D)).sum(dtype=U)
    return int(a[0].view(np.int64)), int(a[1].view(np.int64))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Small record batches with the sets of their texts."""
    forget_other_operators()
    for b in slices(batches, "text", PIECE):
        yield b, shingle_sets(b.column("text"))


def _often(tokens: list[np.ndarray]) -> pa.RecordBatch:
    """Tokens of at least LOCAL of the sets, in the columns of the profile."""
    every = np.concatenate([np.empty(0, U), *tokens])
    tokens.clear()
    every.sort()
    token, met = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)  # of tokens met again
    met = met + 1
    token, met = token[met >= LOCAL], met[met >= LOCAL]
    none = pa.nulls(len(token), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, pa.array(token.view(np.int64)), none, pa.array(met.astype(np.int64))],
                                      ["doc_id", "n", "s1", "s2", "met"])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and hash of every set; also, with a null size, the tokens that
    LOCAL of a task's sets (about 2 HELD tokens at a time) have in common."""
    seen, held, size = set(), [], 0
    for b, sets in _pieces(batches):
        hashes = [set_hash(s) for s in sets]
        n = pa.array([len(s) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), n, *(pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1)),
                                          pa.nulls(len(sets), pa.int64())], ["doc_id", "n", "s1", "s2", "met"])
        for h, s in zip(hashes, sets, strict=True):
            if h not in seen:
                seen.add(h)
                held.append(s)
                size += len(s)
        if size > 2 * HELD:
            yield _often(held)
            size = 0
    yield _often(held)


def _grouped(tokens: list[np.ndarray], docs: list[int], sizes: list[int]) -> pa.RecordBatch:
    """Rows (token, doc, n, pos, w) of the prefixes held; ``pos`` is the place in
    the prefix. Of each token, the first row stands for all of them (``w``
    counts them); the others, known to be shared, have w = 0."""
    many = np.array([len(t) for t in tokens])
    token = np.concatenate(tokens)
    order = np.argsort(token, kind="stable")
    pos = (np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many))[order].astype(np.int32)
    token, doc, size = token[order], np.repeat(docs, many)[order], np.repeat(sizes, many)[order].astype(np.int32)
    first = np.concatenate(([True], token[1:] != token[:-1]))
    w = np.zeros(len(token), np.int32)
    w[first] = np.diff(np.append(np.flatnonzero(first), len(token)))
    return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(doc), pa.array(size), pa.array(pos), pa.array(w)],
                                      ["token", "doc", "n", "pos", "w"])


def _prefixes(frequent):
    """Prefix tokens under the first order, of each set of a task once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = frequent.value
        seen, tokens, docs, sizes, held = set(), [], [], [], 0
        for b, sets in _pieces(batches):
            for doc, s in zip(b.column("doc_id").to_pylist(), sets, strict=True):
                key = set_hash(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                n = len(s)
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    known = common[at] == s
                    late = s[known]
                    s = np.concatenate((s[~known], late[np.lexsort((late, counts[at[known]]))]))
                tokens.append(s[:prefix_size(n)])
                docs.append(doc)
                sizes.append(n)
                held += len(tokens[-1])
            if held > HELD:
                yield _grouped(tokens, docs, sizes)
                tokens, docs, sizes, held = [], [], [], 0
        if tokens:
            yield _grouped(tokens, docs, sizes)
    return run


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole set, and its prefixes (32 bits a token) under ORDERS."""
    for b, sets in _pieces(batches):
        cols = [[s.tobytes() for s in sets]]
        for seed in ORDERS:
            cols.append([np.sort(np.sort(mix(s ^ U(seed)))[:prefix_size(len(s))] >> U(16)).astype(np.uint32).tobytes() for s in sets])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.binary()) for c in cols)],
                                         ["doc", "tokens", "p1", "p2"])


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that share a prefix token under every further order."""
    for b in batches:
        ok = np.ones(b.num_rows, bool)
        for x, y in (("p1", "q1"), ("p2", "q2")):
            for i, (p, q) in enumerate(zip(b.column(x).to_pylist(), b.column(y).to_pylist(), strict=True)):
                ok[i] = ok[i] and np.isin(np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32)).any()
        yield b.select(["a", "b"]).filter(pa.array(ok))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The similar pairs, without those whose ends the task has already joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        ok = np.zeros(b.num_rows, bool)
        ends = zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)
        for i, ((left, right), p, q) in enumerate(zip(ends, b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)):
            if root(left) == root(right):
                continue
            x, y = np.frombuffer(p, U), np.frombuffer(q, U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if DEN * both >= NUM * (len(x) + len(y) - both):
                ok[i] = True
                parent[root(left)] = root(right)
        yield b.select(["a", "b"]).filter(pa.array(ok))


def _verified(pairs: DataFrame, text: DataFrame) -> tuple[DataFrame, int]:
    """Of the pairs (a, b) that pass the further orders and are similar enough
    to join up all their components, stored; and the number of pairs looked at.

    Only the texts of documents in a pair are turned into sets, only the sets
    of documents in a pair that passed the further orders are joined to it.
    """
    def joined(pairs: DataFrame, sets: DataFrame, a: dict[str, str], b: dict[str, str], test) -> DataFrame:
        left, right = (sets.select(F.col("doc").alias(d), *[F.col(c).alias(x) for c, x in names.items()])
                       for d, names in (("a", a), ("b", b)))
        both = pairs.select("a", "b").join(left, "a").join(right, "b")
        return both.select("a", "b", *a.values(), *b.values()).mapInArrow(test, "a long, b long")

    def ends(pairs: DataFrame) -> DataFrame:
        return stored(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), "jaccard-ends")

    pairs = stored(pairs, "jaccard-pairs")
    looked_at = pairs.count()
    sets = stored(among(text, "doc_id", ends(pairs)).mapInArrow(
        _signatures, "doc long, tokens binary, p1 binary, p2 binary"), "jaccard-sets")
    near = stored(joined(pairs, sets, {"p1": "p1", "p2": "p2"}, {"p1": "q1", "p2": "q2"}, _share), "jaccard-pairs")
    whole = among(sets.select("doc", "tokens"), "doc", ends(near))
    links = stored(joined(near, whole, {"tokens": "x"}, {"tokens": "y"}, _similar).distinct(), "jaccard-links")
    release(pairs, sets, near)
    return links, looked_at


def _may_reach(n: str, pos: str, other_n: str, other_pos: str):
    """Whether two sets whose first common token stands at these places can
    still be similar: no more tokens can be common than follow in either."""
    common = F.least(F.col(n) - F.col(pos), F.col(other_n) - F.col(other_pos))
    return (NUM + DEN) * common >= NUM * (F.col(n) + F.col(other_n))


def _star(tokens: DataFrame, step: int) -> DataFrame:
    """For each document, of the hubs in other components the one it shares
    most tokens with. A token's hub is its smallest document, later one that a
    hash of the round picks."""
    order = F.col("doc") if not step else F.xxhash64("doc", F.lit(step))
    hub = tokens.groupBy("token").agg(F.min(F.struct(order.alias("o"), "doc", "n", "pos", "component")).alias("h"))
    met = tokens.join(hub, "token").where((F.col("component") != F.col("h.component")) & _may_reach("n", "pos", "h.n", "h.pos"))
    shared = met.groupBy("doc", F.col("h.doc").alias("hub")).agg(F.count(F.lit(1)).alias("k"))
    return shared.groupBy("doc").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub")).select(
        F.col("doc").alias("a"), F.col("hub").alias("b"))


def _sides(rows: DataFrame, key: list[str], **names: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` twice, the columns in ``names`` with their new name and a or b after it."""
    return tuple(rows.select(*key, F.col("doc").alias(s), *[F.col(c).alias(to + s) for c, to in names.items()]) for s in "ab")


def _across(tokens: DataFrame, text: DataFrame, frequent) -> DataFrame:
    """The pairs of documents in different components that may be similar:
    those of a token (a pair that passes the test of places does so at its first
    common token), and inside a family those of :func:`_within`."""
    family = _families(tokens)
    rows = tokens.join(family, "doc", "left")
    x, y = _sides(rows, ["token"], n="n", pos="p", component="c", family="f")
    apart = x.join(y, "token").where((F.col("ca") < F.col("cb")) & _may_reach("na", "pa", "nb", "pb")
                                     & ~F.coalesce(F.col("fa") == F.col("fb"), F.lit(False))).select("a", "b")
    if family.isEmpty():
        return apart.distinct()
    members = stored(rows.where("family is not null").select("doc", "family", "component").distinct(), "jaccard-family")
    return apart.union(_within(members, text, frequent)).distinct()


def _families(tokens: DataFrame) -> DataFrame:
    """(doc, family) of documents that share tokens with many others, stored:
    each takes the token most documents have, then what most documents with
    that token have taken. Any grouping gives the same links."""
    many = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= FAMILY)
    taken = stored(tokens.join(many, "token").groupBy("doc").agg(F.max_by("token", F.struct("k", "token")).alias("taken")), "jaccard-taken")
    heads = taken.select(F.col("taken").alias("token")).distinct()
    votes = tokens.select("token", "doc").join(heads, "token").join(taken, "doc").groupBy("token", "taken").agg(F.count(F.lit(1)).alias("k"))
    head = votes.groupBy("token").agg(F.max_by("taken", F.struct("k", "taken")).alias("family"))
    family = stored(taken.join(head, F.col("taken") == F.col("token")).select("doc", "family"), "jaccard-families")
    large = family.groupBy("family").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= FAMILY)
    return stored(family.join(large.select("family"), "family").select("doc", "family"), "jaccard-families")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole set of each document, ascending."""
    for b, sets in _pieces(batches):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc", "tokens"])


def _family_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(family, token, k): sets of the batch that hold a token."""
    for b in batches:
        of: dict[int, list[np.ndarray]] = {}
        for f, t in zip(b.column("family").to_pylist(), b.column("tokens").to_pylist(), strict=True):
            of.setdefault(f, []).append(np.frombuffer(t, U))
        for f, held in of.items():
            token, k = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), f)), pa.array(token.view(np.int64)), pa.array(k)],
                                             ["family", "token", "k"])


def _differences(frequent):
    """What a set and its family's middle do not share, rare elements first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = frequent.value
        for b in batches:
            n, out = [], []
            for t, middle, without in zip(*(b.column(c).to_pylist() for c in ("tokens", "middle", "without")), strict=True):
                s, middle, without = np.frombuffer(t, U), np.array(middle, np.int64).view(U), np.array(without, np.int64)
                here, gone = np.setdiff1d(s, middle, assume_unique=True), ~np.isin(middle, s)
                rare = np.zeros(len(here), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, here), len(common) - 1)
                    rare = np.where(common[at] == here, counts[at], 0)
                every, rare = np.concatenate((here, middle[gone])), np.concatenate((rare, without[gone]))
                n.append(len(s))
                out.append(every[np.lexsort((every, rare))].view(np.int64))
            off = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc", "family", "component")), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.empty(0, np.int64), *out])))],
                ["doc", "family", "component", "n", "diff"])
    return run


def _within(family: DataFrame, text: DataFrame, frequent) -> DataFrame:
    """Pairs (a, b) of one family, among them all similar ones that are not joined up.

    A family's middle is the tokens that more than half of its sets have. Let x
    be the size of the difference between a set of n tokens and the middle, and
    e = (NUM + DEN) x - (DEN - NUM) n. Two sets are similar if and only if
    2 (NUM + DEN) times what their differences share is at least the sum of
    their e. If that sum is not positive, they are, and both are also similar
    to the set of smallest e: a star finds those. Otherwise their differences
    share a token, early enough for as many to follow.
    """
    sets = stored(among(text, "doc_id", family.select("doc").distinct()).mapInArrow(_sets, "doc long, tokens binary")
                  .where(F.length("tokens") > 0).join(family, "doc"), "jaccard-family-sets")
    size = sets.groupBy("family").agg(F.count(F.lit(1)).alias("sets"))
    met = sets.select("family", "tokens").mapInArrow(_family_counts, "family long, token long, k long").groupBy("family", "token").agg(
        F.sum("k").alias("k")).join(size, "family").where("2 * k > sets")
    middle = met.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("token", (F.col("sets") - F.col("k")).alias("without")))).alias("m"))
    pairs = sets.join(middle, "family", "left").select(
        "doc", "family", "component", "tokens", F.coalesce("m.token", F.array().cast("array<long>")).alias("middle"),
        F.coalesce("m.without", F.array().cast("array<long>")).alias("without"))
    diff = stored(pairs.mapInArrow(_differences(frequent), "doc long, family long, component long, n long, diff array<long>").select(
        "*", F.size("diff").cast("long").alias("x")).withColumn("e", (NUM + DEN) * F.col("x") - (DEN - NUM) * F.col("n")), "jaccard-differences")
    hub = diff.groupBy("family").agg(F.min(F.struct("e", "doc", "component")).alias("h"))
    rows = diff.join(hub, "family")
    star = rows.where((F.col("e") + F.col("h.e") <= 0) & (F.col("component") != F.col("h.component"))).select(
        F.col("doc").alias("a"), F.col("h.doc").alias("b"))
    least = F.greatest(F.lit(1), F.ceil((F.col("e") + F.col("h.e")) / (2 * (NUM + DEN))))  # shared at least, with any other
    early = rows.withColumn("most", (F.col("x") - least + 1).cast("int")).where("most > 0").select(
        "doc", "family", "component", "x", "e", F.posexplode(F.slice("diff", F.lit(1), F.col("most"))).alias("pos", "token"))
    x, y = _sides(early, ["family", "token"], component="c", x="x", e="e", pos="p")
    both = F.col("ea") + F.col("eb")
    shared = F.least(F.col("xa") - F.col("pa"), F.col("xb") - F.col("pb"))
    return star.union(x.join(y, ["family", "token"]).where(
        (F.col("ca") < F.col("cb")) & (both > 0) & (2 * (NUM + DEN) * shared >= both)).select("a", "b"))


def _open(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """``tokens`` (token, doc, n, pos) with current components, without the
    tokens whose documents are all in one; stored."""
    out = tokens.join(found, tokens["doc"] == found["node"], "left").select(
        "token", "doc", "n", "pos", F.coalesce("component", "doc").alias("component"))
    several = out.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return stored(out.join(several.select("token"), "token"), "jaccard-open")


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    spark = docs.sparkSession
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    profile = stored(text.mapInArrow(_profile, "doc_id long, n long, s1 long, s2 long, met long"), "jaccard-sizes")
    every = profile.where("n is not null")
    top = (profile.where("n is null").groupBy("s1").agg(F.sum("met").alias("met")).where(F.col("met") >= GLOBAL)
           .orderBy(F.desc("met"), "s1").limit(FREQUENT).toArrow())
    common, met = top.column("s1").to_numpy().view(U), top.column("met").to_numpy()
    order = np.argsort(common)
    frequent = spark.sparkContext.broadcast((common[order], met[order]))

    sets = every.where("n > 0 and doc_id is not null")
    first = sets.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("first"))
    members = stored(sets.join(first, ["n", "s1", "s2"]).select("doc_id", "first").distinct(), "jaccard-members")
    others = stored(members.groupBy("doc_id").agg(F.max(F.col("first") == F.col("doc_id")).alias("own")).where("not own")
                    .select("doc_id"), "jaccard-copies")  # no set of theirs is its class's first
    text = among(text.where("doc_id is not null"), "doc_id", others, "left_anti")
    found = text.mapInArrow(_prefixes(frequent), "token long, doc long, n int, pos int, w int")
    salt = F.when(F.col("w") > 0, F.lit(0)).otherwise(F.col("doc"))
    total = F.sum("w").over(Window.partitionBy("token", salt))
    tokens = stored(found.withColumn("total", total).where("w = 0 or total > 1").select(
        "token", "doc", "n", "pos", F.col("doc").alias("component")), "jaccard-tokens")
    group, idle, step, last = None, 0, 0, False
    while not last:
        last = idle == IDLE_ROUNDS or step == STAR_ROUNDS
        new, looked_at = _verified(_across(tokens, text, frequent) if last else _star(tokens, step), text)
        group = joined_up(group, new)
        step, idle = step + 1, idle + 1 if USEFUL * new.count() < looked_at else 0
        if not last:
            still = _open(tokens.drop("component"), group)
            release(tokens)
            tokens, last = still, still.isEmpty()
    # the documents of a set, and the sets under one doc_id, are one component
    of = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sets"), F.min("first").alias("first"))
    several = members.join(of.where("sets > 1").select("doc_id"), "doc_id").where("doc_id <> first")
    group = joined_up(group, several.select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
    # a copy with one set has no link of its own: it goes where its first goes
    copies = of.where("sets = 1 and doc_id <> first").join(group, F.col("first") == F.col("node"), "left").select(
        F.col("doc_id").alias("node"), F.coalesce("component", "first").alias("component"))
    group = group.unionByName(copies)
    release(tokens)
    return every.select("doc_id", F.col("n").alias("n_shingles")).join(group, every["doc_id"] == group["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row of each component of similar rows: that of
    the smallest doc_id (null ids last). Every row is a node for itself, under a
    stored key, so repeated rows and copies with a null doc_id go too."""
    rows = stored(docs.select(F.monotonically_increasing_id().alias("key"), whole_row(docs)), "jaccard-rows")
    near = near_components(rows.select(F.col("key").alias("doc_id"), F.col("_row.text").alias("text")))
    ids = rows.select("key", F.col("_row.doc_id").alias("id"))
    group = stored(near.select(F.col("doc_id").alias("key"), F.col("component_id").alias("component")).join(ids, "key"), "jaccard-groups")
    first = group.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"),
                                           F.count(F.lit(1)).alias("rows")).where("rows > 1")
    gone = stored(group.join(first, "component").where(F.col("key") != F.col("first.key")).select("key"), "jaccard-gone")
    return among(rows, "key", gone, "left_anti").select(*unpacked(docs))


def op3_ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    return near_components(docs)
