"""The pipeline, each stage against brute force on what the stage before kept."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import mixing
from test_llm_operators import ROWS, WORD, brute_components, same, sha, shingles, tiktoken_encoding

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def accepted(t):
    w = WORD.findall(t)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    repeat = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    chars = sum(map(len, w))
    return not (len(w) < 20 or 100 * len(repeat) > 30 * len(w) or 20 * len(re.findall(r"[#*$%&|<>]", t)) > chars
                or 20 * t.count("!") > chars or not 2 * len(w) <= chars <= 20 * len(w)
                or 2 * (len(lines) - len(set(lines))) > len(lines))


def without_repeats(texts):
    raw = [t.encode() for t in texts]
    seen = Counter(b[i:i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\x01" * 200
        out.append(bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.createDataFrame([r[:5] for r in ROWS], SCHEMA).repartition(4)
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, made[-1], "").write.parquet(path)
        made.append(spark.read.parquet(path))
    return [[tuple(r) for r in d.select(*COLUMNS).collect()] for d in made], made[-1]


def test_columns_between_stages(spark):
    docs = spark.createDataFrame([r[:5] for r in ROWS], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == COLUMNS


def test_further_columns_go_through_every_stage(spark):
    """Columns named like those that operators use inside."""
    extra = ["token", "doc", "n", "key", "_row", "_text", "component", "cls", "block", "id", "kept", "n_words"]
    rows = [(*r[:5], *[f"{c}{i}" for c in extra]) for i, r in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", `{c}` string" for c in extra)).repartition(3)
    known = {tuple(r[5:]) for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert [c for c in out.columns if c in docs.columns] == docs.columns
        got = {tuple(r) for r in out.select(*[F.col(f"`{c}`") for c in extra]).collect()}
        assert got and got <= known, name


def test_quality_stage(steps):
    rows, _ = steps
    same(rows[1], [r for r in rows[0] if accepted(r[1] or "")])


def test_near_duplicate_stage(steps):
    """Of each group of similar rows one row stays, of its smallest doc_id
    (null ids last); rows, not ids, are grouped."""
    rows, _ = steps
    root = brute_components([(i, shingles(r[1])) for i, r in enumerate(rows[1])])
    groups = defaultdict(list)
    for i, r in enumerate(rows[1]):
        groups[root(i)].append(r)
    kept = Counter(rows[2])
    assert sum(kept.values()) == len(groups) < len(rows[1])
    for group in groups.values():
        least = min(group, key=lambda r: (r[0] is None, r[0] or 0))[0]
        one = next(r for r in group if r[0] == least and kept[r])
        kept[one] -= 1
    assert not +kept


def test_near_duplicates_leave_one_row_of_each_group(spark):
    rng = np.random.default_rng(8)
    a, b, c, d, e = (" ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(80)) for _ in range(5))
    rows = [(4, a), (4, a), (None, a), (9, a + " end"), (None, b), (None, b), (6, c), (6, d), (None, e), (2, e), (None, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    expected = [(4, a), (None, b), (6, c), (6, d), (2, e), (None, None), (7, "")]
    same([(r.doc_id, r.text) for r in kept.collect()], expected)
    left = corpus_pipeline.suffix_array_dedup(spark, kept, "")
    same([(r.doc_id, r.text) for r in left.collect()], expected)


def test_suffix_stage(steps):
    rows, _ = steps
    same([(r[0], r[1], r[4]) for r in rows[3]],
         [(r[0], t, len(t)) for r, t in zip(rows[2], without_repeats([r[1] for r in rows[2]]))])


def test_mixing_stage(steps):
    rows, _ = steps
    sizes, got = defaultdict(int), defaultdict(int)
    texts = defaultdict(list)
    for r in rows[3]:
        sizes[r[3]] += len(WORD.findall(r[1]))
        texts[r[0]].append(WORD.findall(r[1]))
    for r in rows[4]:
        w = WORD.findall(r[1])
        got[r[3]] += len(w)
        assert any(x[:len(w)] == w for x in texts[r[0]]) and r[4] == len(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([sizes[s] for s in order], mixing.cycled_weights(len(order)), sum(sizes.values()))
    for s, g in zip(order, goal):
        assert abs(got[s] - g) <= 2


def test_encoding_stage(steps):
    rows, last = steps
    enc = tiktoken_encoding()
    expected = []
    for r in rows[4]:
        ids = enc.encode_ordinary(r[1])
        expected.append((r[0], ids, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(r[1])))
    same([tuple(r) for r in last.select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256").collect()], expected)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run_reads_the_documents_table(spark, tmp_dir):
    import os
    d = os.path.join(tmp_dir, "sf")
    spark.createDataFrame([r[:5] for r in ROWS[9:30]], SCHEMA).write.parquet(f"{d}/documents.parquet")
    out = corpus_pipeline.run(spark, d)
    assert out.count() > 0 and out.where(F.size("ids") != F.col("n_tokens")).count() == 0
