"""Each operator against a brute-force version on a small fixture with nulls,
empty and long texts, ties, repeated rows, hot groups and clashing columns;
and over an empty table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe, fingerprints, jaccard, languages, mixing, pieces, pseudo_likelihood, quality, substrings, suffixes, token_files)
from ledgerlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cls long, _w string, token string, draws int"
SYLLABLES = "an be co du er fi go ha in ju ka lo mé ñu ör pi".split()


def sha(data):
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


def prose(rng, n):
    made = ["".join(rng.choice(SYLLABLES, rng.integers(1, 5))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.05 else "") for w in made)


def fixture_rows():
    rng = np.random.default_rng(5)
    base, passage = prose(rng, 260), prose(rng, 70)
    texts = [None, "", " \n\t ", "one", "one two three", "ONE Two three", "a" * 900, "ab" * 450, "x " * 300]
    texts += [prose(rng, int(rng.integers(5, 400))) for _ in range(30)]
    texts += [base] * 5 + [base.replace(base.split()[i], "zz", 1) for i in range(10, 200, 16)]
    texts += [base.upper(), base + " tail of it", " ".join(base.split()[:130])]
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 40)}" for _ in range(6)] + [passage]
    texts += [prose(rng, 25000), "日本語 のテキスト 123 !! ñandú", "### &&& *** " * 30, "line of words here\n" * 12, "\x85\x1c q r ½²"]
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    rows += [rows[12], rows[40], (None, base), (None, texts[12]), (None, None)]
    out = []
    for i, (d, t) in enumerate(rows):
        lang = ["en", "fr", None][i % 3]
        source = [None, "hot", "hot", "é", "b", ""][i % 6]
        out.append((d, t, lang, source, len(t or ""), 1, "w", "t", 3))
    return out


ROWS = fixture_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_by_id():
    return [(d, t or "") for d, t, *_ in ROWS]


def same(got, expected):
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


# --- op1 -----------------------------------------------------------------------------
def test_mixing(docs):
    got = mixing.op1_mixing_sources(docs).collect()
    again = mixing.op1_mixing_sources(docs.repartition(3)).collect()
    same(again, [tuple(r) for r in got])
    sizes = defaultdict(int)
    for _, t, _, s, *_ in ROWS:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([sizes[s] for s in order], [1.0, 2.0, 3.0] * 5, sum(sizes.values()))))
    assert len(got) == len(ROWS)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[round(r.target, 6)] += r.taken
    assert sum(r["size"] for r in got) == sum(sizes.values())
    wanted = defaultdict(float)  # sources with equal targets together
    for g in goal.values():
        wanted[round(g, 6)] += g
    for g, total in wanted.items():
        assert abs(taken[g] - total) <= 2 * len(goal)


def test_targets_cap_and_reshare():
    got = mixing.targets([10, 1000, 1000], [3, 1, 1], 2010)
    assert got == [30, 990, 990]
    assert mixing.targets([0, 0], [1, 2], 0) == [0, 0]
    assert mixing.targets([], [], 0) == []


def independent_targets(sizes, weights, total, cap=3):
    """Water filling by bisection: the level at which capped shares add up."""
    low, high = 0.0, 2.0 * total + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(cap * s, mid * w) for s, w in zip(sizes, weights)) < total else (low, mid)
    return [min(cap * s, high * w) for s, w in zip(sizes, weights)]


def test_targets_against_an_independent_version():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(1, 12))
        sizes = [int(x) for x in rng.integers(1, 10 ** int(rng.integers(1, 7)), n)]
        weights = mixing.cycled_weights(n)
        assert np.allclose(mixing.targets(sizes, weights, sum(sizes)), independent_targets(sizes, weights, sum(sizes)), rtol=1e-9)


def test_more_rows_than_draws_make_larger_blocks(docs, monkeypatch):
    before = mixing.op1_mixing_sources(docs).agg(F.sum("taken")).first()[0]
    monkeypatch.setattr(mixing, "MOST_DRAWS", 12)
    sized = mixing._narrow(docs)
    plan = mixing.make_plan(sized)
    assert sum(p[4] * p[3] + p[7] + 1 for p in plan) <= 12 + 2 * len(plan)
    assert mixing.op1_mixing_sources(docs).agg(F.sum("taken")).first()[0] == pytest.approx(before, abs=2 * len(plan))


def test_splitting_tree_is_exact_and_disjoint():
    quotas = [7, 0, 10_000, 333]
    dealt = mixing.split_quotas(quotas, 13)
    assert (dealt >= 0).all() and dealt.sum(0).tolist() == quotas
    assert dealt.sum(1).max() - dealt.sum(1).min() <= 4


def test_mix_rows(docs):
    got = mixing.mix(docs, shards=4)
    assert got.columns == docs.columns + ["shard", "epoch", "words"]
    rows = got.collect()
    for r in rows:
        assert len(WORD.findall(r.text)) == r.words and r._w == "w" and r.draws == 3
    per_doc = mixing.op1_mixing_sources(docs).agg(F.sum("taken")).first()[0]
    assert sum(r.words for r in rows) == per_doc


# --- op2 -----------------------------------------------------------------------------
def tiktoken_encoding():
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(bpe.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_level_bpe(docs):
    enc = tiktoken_encoding()
    expected = []
    for d, t in texts_by_id():
        ids = np.array(enc.encode_ordinary(t), "<u4")
        expected.append((d, len(ids), sha(ids.tobytes()), sha(t)))
    same(bpe.op2_byte_level_bpe(docs).collect(), expected)


def test_prefix_table_append_and_edit():
    table, coder, rng = bpe.PrefixTable(bpe.PrefixBpe()), bpe.PrefixBpe(), np.random.default_rng(2)
    enc = tiktoken_encoding()
    for _ in range(60):
        piece = "".join(rng.choice(list("abehinorstñ"), 6)).encode()
        if rng.random() < 0.5 or len(table.data) < 12:
            table.append(piece)
        else:
            at = int(rng.integers(0, len(table.data) - 3))
            table.edit(at, 2, piece[:3])
        assert table.ids() == coder.read(coder.extend(table.data, [], 0))
        word = table.data.decode("utf-8", "ignore")
        if word.encode() == table.data and word.isalpha():
            assert coder.encode_word(table.data) == enc.encode_ordinary(word)
        assert coder.decode(table.ids()) == table.data


# --- op3 -----------------------------------------------------------------------------
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = WORD.findall(t.translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(pairs_of):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(pairs_of, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return root


def test_ngram_jaccard(docs):
    sets = [(d, shingles(t)) for d, t in texts_by_id()]
    root = brute_components(sets)
    same(jaccard.op3_ngram_jaccard_join(docs).collect(), [(d, len(s), None if d is None else root(d)) for d, s in sets])
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == {None} | {root(d) for d, _ in sets if d is not None}


def test_prefix_filter_bound():
    rng = np.random.default_rng(9)
    for _ in range(300):
        x = set(rng.integers(0, 60, rng.integers(1, 50)).tolist())
        y = set(list(x)[: rng.integers(1, len(x) + 1)]) | set(rng.integers(0, 60, rng.integers(0, 5)).tolist())
        if 5 * len(x & y) >= 4 * len(x | y):
            for order in (lambda v: v, lambda v: v * 37 % 61):
                a, b = sorted(x, key=order), sorted(y, key=order)
                assert set(a[:jaccard.prefix_size(len(a))]) & set(b[:jaccard.prefix_size(len(b))])


# --- op4 -----------------------------------------------------------------------------
def test_language_id_edges(docs):
    got = languages.op4_language_id(docs).collect()
    assert len(got) == len(ROWS)
    by_id = defaultdict(list)
    for d, t, *_ in ROWS:
        by_id[d].append(any(c.isalpha() for c in t or ""))
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        if len(set(by_id[r.doc_id])) == 1:
            assert (r.lang_pred in ("en", "fr")) == by_id[r.doc_id][0]


def test_language_spans_of_a_mixed_text(spark):
    en, de, ru = "the house with whom they think", "der große garten schön über nichts", "мир труд май над нами всегда"
    rows = [(i, t * 3, lang) for i in range(1, 90) for t, lang in ((en, "en"), (de, "de"), (ru, "ru"))]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    mixed = spark.createDataFrame([(1, f"{en} {de} {ru}"), (2, "123 !?"), (3, None), (4, "日本")], "doc_id long, text string")
    out = {r.doc_id: r for r in languages.predict(mixed, languages.fit(train), spans=True).collect()}
    assert [s.lang for s in out[1].spans] == ["en", "de", "ru"]
    assert out[1].spans[1].start == len(en) + 1
    assert out[2].lang_pred == out[3].lang_pred == "und" and out[4].lang_pred in ("en", "de", "ru")


@pytest.mark.parametrize("held", [1, 2, 3, 7])
def test_viterbi_in_runs_equals_viterbi_at_once(monkeypatch, held):
    rng = np.random.default_rng(held)
    size = rng.integers(0, 20, 9)
    begin = np.cumsum(size) - size
    scores, prior = rng.normal(0, 2, (3, size.sum())), np.log([0.5, 0.3, 0.2])
    whole = languages.viterbi(scores, begin, size, prior, 1.0)
    monkeypatch.setattr(languages, "HELD_STEPS", held)
    assert languages.viterbi(scores, begin, size, prior, 1.0).tolist() == whole.tolist()


def test_a_sample_is_never_empty():
    assert languages.sample_bound(100, 20_000) == languages.HASHES and languages.sample_bound(0, 10) >= 1
    for n in (10 ** 6, 10 ** 10, 10 ** 13, 10 ** 15):
        bound = languages.sample_bound(n, 20_000)
        assert bound >= 1 and (n > 10 ** 12 or abs(bound * n / languages.HASHES - 20_000) < 2_000)


def test_code_points_above_the_letters(spark):
    """Tag characters and variation selectors are no letters, wherever they stand."""
    rows = [(i, "plain words of one language here", "en") for i in range(40)] + [(i, "слова другого языка здесь", "ru") for i in range(40, 80)]
    model = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = ["\U000E0067\U000E0062\U000E007F", "\U000E0100 \U000E01EF", "\U000323B0\U000F0000\U0010FFFF", "🏴\U000E0067\U000E007F"]
    probe = [(i, t) for i, t in enumerate(odd)] + [(10, "words"), (11, "words \U000E0067\U000E007F\U00033FFF")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in languages.predict(
        spark.createDataFrame(probe, "doc_id long, text string"), model).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4 and got[10] == got[11] == ("en", 1.0)


def test_one_long_text(spark, monkeypatch):
    monkeypatch.setattr(languages, "HELD_STEPS", 1000)
    rows = [(i, "plain words of one language here", "en") for i in range(40)] + [(i, "слова другого языка здесь", "ru") for i in range(40, 80)]
    model = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = "plain words here " * 9000 + "слова языка здесь " * 4000
    made = languages.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, spans=True).first()
    assert made.lang_pred == "en" and [x.lang for x in made.spans] == ["en", "ru"] and made.spans[1].start == text.index("слова")


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(4)
    for n in (1, 2, 6):
        s, prior = rng.normal(size=(3, n)), rng.normal(size=3)

        def value(path):
            return prior[path[0]] + sum(s[p, i] for i, p in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))

        paths = [()]
        for _ in range(n):
            paths = [p + (k,) for p in paths for k in range(3)]
        got = languages.viterbi(s, np.array([0]), np.array([n]), prior, 0.7)
        assert value(tuple(got.tolist())) == pytest.approx(max(map(value, paths)))


# --- op5 -----------------------------------------------------------------------------
@pytest.mark.parametrize("hot_texts", [2048, 3, 0], ids=["none_hot", "some_hot", "all_hot"])
def test_suffix_array_dedup(docs, monkeypatch, hot_texts):
    monkeypatch.setattr(suffixes, "HOT_TEXTS", hot_texts)
    raw = [(d, t.encode()) for d, t in texts_by_id()]
    seen = Counter(b[i:i + 200] for _, b in raw for i in range(len(b) - 199))
    expected, left = [], []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\x01" * 200
        kept = bytes(c for c, g in zip(b, gone) if not g)
        expected.append((d, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept)))
        left.append((d, kept.decode("utf-8", "ignore")))
    same(suffixes.op5_suffix_array_dedup(docs).collect(), expected)
    cleaned = suffixes.remove_repeats(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        assert r.text is None or r.n_chars == len(r.text)
    same([(r.doc_id, (r.text or "").replace("�", "")) for r in cleaned.select("doc_id", "text").collect()], left)


def test_suffix_family_finds_every_repeat():
    rng = np.random.default_rng(1)
    family, found, seen = suffixes.SuffixFamily(), set(), Counter()
    for b in range(40):
        keys = rng.integers(97, 100, (int(rng.integers(1, 60)), 5)).astype(np.uint8).view("S5").ravel()
        ids = np.arange(len(keys)) + 1000 * b
        seen.update(zip(keys.tolist(), ids.tolist()))
        found |= set(family.add(keys, ids).tolist())
    by_key = defaultdict(list)
    for k, i in seen:
        by_key[k].append(i)
    repeated = {k: v for k, v in by_key.items() if len(v) > 1}
    assert len(family.levels) <= 10
    assert found == {i for v in repeated.values() for i in v}


# --- op6 -----------------------------------------------------------------------------
def test_quality_features(docs):
    expected = []
    for d, t in texts_by_id():
        w = WORD.findall(t)
        at = defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        repeat = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        chars, marks = sum(map(len, w)), t.count("!")
        symbols, dup = len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines))
        failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
        bad = 20 * symbols > chars or 20 * marks > chars or chars > 20 * len(w) or chars < 2 * len(w) or 2 * dup > len(lines)
        expected.append((d, len(w), chars, symbols, dup, len(repeat), failed, not failed and not bad))
    same(quality.op6_quality_rules(docs).collect(), expected)
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    same([(r.doc_id,) for r in kept.select("doc_id").collect()], [(e[0],) for e in expected if e[-1]])


@pytest.mark.parametrize("costs, expected", [
    ((1.0, 1.0, 100.0), ["some", "all", "none"]), ((1.0, 1.0, 1.0), ["all", "some", "none"]), ((9.0, 1000.0, 1.0), ["all", "some", "none"])])
def test_cascade_orders_by_rejection_per_cost(docs, monkeypatch, costs, expected):
    rules = (quality.Rule("none", lambda: F.lit(False)), quality.Rule("some", lambda: F.col("_n") < 60),
             quality.Rule("all", lambda: F.lit(True)))
    ticks = iter([t for c in costs for t in (0.0, c)])
    monkeypatch.setattr(quality, "time", SimpleNamespace(perf_counter=lambda: next(ticks)))
    assert [r.name for r in quality.plan_cascade(docs, rules)] == expected
    assert [r.name for r in quality.plan_cascade(docs.limit(0), rules)] == ["none", "some", "all"]


# --- op7 -----------------------------------------------------------------------------
def test_pseudo_likelihood(docs):
    common, values = pseudo_likelihood.train(docs)
    got = pseudo_likelihood.score(docs, common, values).collect()
    assert len(got) == len(ROWS)
    same([(r.doc_id, r.n_tokens) for r in got], [(d, len(WORD.findall(t))) for d, t in texts_by_id()])
    for r in got:
        assert (r.mean_log_prob is None) == (r.n_tokens == 0) and r.pseudo_log_likelihood <= 0
    start = pseudo_likelihood.score(docs, common, pseudo_likelihood.flat(pseudo_likelihood.start_parameters())).collect()
    assert sum(r.pseudo_log_likelihood for r in got) > sum(r.pseudo_log_likelihood for r in start)


def test_gradient_step_lowers_the_loss_and_sums_to_one():
    rng = np.random.default_rng(0)
    p = pseudo_likelihood.start_parameters()
    context = rng.integers(0, 5, (64, 4))
    token = context[:, 1]
    before = pseudo_likelihood.log_probability(p, context, token).sum()
    for _ in range(50):
        pseudo_likelihood.step(p, context, token, 0.5)
    assert pseudo_likelihood.log_probability(p, context, token).sum() > before
    every = [pseudo_likelihood.log_probability(p, context[:1], np.array([k])) for k in range(pseudo_likelihood.VOCABULARY)]
    assert np.exp(np.concatenate(every)).sum() == pytest.approx(1, abs=1e-4)


def test_every_word_has_its_own_share_of_its_class(spark):
    from ledgerlens.llm.common import word_hashes

    def cls(w):
        return int(pseudo_likelihood.hash_class(word_hashes(np.frombuffer(w.encode(), np.uint8), 5)[0])[0])

    common = " ".join(f"c{i}" for i in range(pseudo_likelihood.WORDS))
    often, once, unseen = [w for w in (f"r{i}" for i in range(400)) if cls(w) == 3][:3]
    rows = [(1, " ".join([common] * 9)), (2, " ".join([often] * 5)), (3, once), (None, None)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    counts = pseudo_likelihood.word_counts(pseudo_likelihood.blocked(corpus))
    shared, values = pseudo_likelihood.train(corpus, counts)
    probe = spark.createDataFrame([(i, f"c1 c2 {w} c3 c4") for i, w in enumerate((often, once, unseen))], "doc_id long, text string")
    got = {r.doc_id: r.pseudo_log_likelihood for r in pseudo_likelihood.score(probe, shared, values, counts).collect()}
    a = pseudo_likelihood.A
    assert got[0] - got[1] == pytest.approx(np.log((5 + a) / (1 + a))) and got[1] - got[2] == pytest.approx(np.log((1 + a) / a))
    tokens, words = pseudo_likelihood.class_sizes(counts, shared)[:, 3]
    assert (tokens, words) == (6, 2)
    assert (5 + a + 1 + a + a) / (tokens + a * (words + 1)) == pytest.approx(1)


def test_every_position_is_a_training_target_once(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace as Shared

    targets = Counter()
    monkeypatch.setattr(pseudo_likelihood, "step", lambda p, context, token, rate: targets.update(token.tolist()))
    texts = pa.array(["one", None, "two three", "four five six " * 40, "", "seven"])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    common = np.empty(0, np.uint64)
    values = Shared(value=pseudo_likelihood.flat(pseudo_likelihood.start_parameters()))
    seen = 0
    for turn in range(pseudo_likelihood.ROUNDS):
        out = pseudo_likelihood._train(Shared(value=common), values, turn)(iter([batch]))
        seen += sum(b.column("seen").to_pylist()[0] for b in out)
    padded, place, *_ = pseudo_likelihood.Ids(common).read(texts)
    assert seen == len(place) == 124 and targets == Counter(padded[place].tolist())


# --- op8 -----------------------------------------------------------------------------
def test_token_files(docs, spark, tmp_dir):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(token_files.TOKENIZER)
    rows = sorted(texts_by_id(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected, start = [], 0
    for d, t in rows:
        ids = tk.encode(t, add_special_tokens=False).ids + [0]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same(token_files.op8_token_files(docs).collect(), expected)
    path = f"{tmp_dir}/tokens"
    token_files.write_token_files(docs, path)
    back = token_files.read_token_files(spark, path).collect()
    same([(r.doc_id, r.start, r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in back], expected)


def test_layout_of_token_files_allows_selective_reads(spark, tmp_dir, monkeypatch):
    import os

    import pyarrow.parquet as pq

    monkeypatch.setattr(token_files, "ROW_GROUP_BYTES", 64 << 10)
    monkeypatch.setattr(token_files, "PAGE_BYTES", 4 << 10)
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, prose(rng, 60)) for i in range(3000)], "doc_id long, text string")
    path = f"{tmp_dir}/tokens"
    token_files.write_token_files(docs, path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    last = -1
    groups = 0
    for f in files:
        meta = pq.ParquetFile(os.path.join(path, f)).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            cols = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
            ids = cols[next(c for c in cols if c.startswith("ids"))]
            assert ids.has_dictionary_page and ids.has_offset_index       # dictionary pages, pages that can be sought
            assert cols["doc_id"].has_column_index
            assert group.total_byte_size < 4 * (64 << 10)                 # controlled row groups
            low, high = cols["doc_id"].statistics.min, cols["doc_id"].statistics.max
            assert low > last and high >= low                             # ascending, disjoint: statistics skip row groups
            last = high
    assert groups > 4
    table = spark.read.schema(token_files.FILE_SCHEMA).parquet(path)
    narrow = table.select("doc_id", "n_tokens").where("doc_id = 77")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in narrow and "EqualTo(doc_id,77)" in narrow
    assert table.where("doc_id = 77").select("n_tokens").first()[0] == len(table.where("doc_id = 77").first().ids)


def test_starts_without_broadcast(docs, spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/tokens"
    token_files.write_token_files(docs, path)
    few = [tuple(r) for r in token_files.digest(spark, path).collect()]
    monkeypatch.setattr(token_files, "BROADCAST_FILES", 0)
    same([tuple(r) for r in token_files.digest(spark, path).collect()], few)


def test_added_tokens_of_the_file_keep_their_ids(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(token_files.TOKENIZER)
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext", "plain words", None, "ñ\n<|endoftext|>\t日本"]
    expected, start = [], 0
    for d, t in enumerate(texts):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [0]
        assert (50256 in ids) == ("<|endoftext|>" in (t or ""))
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    same(token_files.op8_token_files(docs).collect(), expected)


# --- op9 -----------------------------------------------------------------------------
def test_fingerprints(docs):
    got = fingerprints.op9_document_fingerprints(docs).collect()
    rows = sorted(texts_by_id(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    made = fingerprints._Fingerprinter()
    expected = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        expected.append((d, len(t), sha(edited), made.text(t)[3], made.text(edited)[3]))
    same([(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got], expected)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_prefix_hashes_spans_and_extensions():
    powers = [fingerprints.Powers(b, p) for b, p in zip(fingerprints.BASES, fingerprints.PRIMES)]
    a, b = "the quick brown fox jumps", "a quick brown fox naps"
    x, y = (fingerprints.PrefixHashes(np.frombuffer(s.encode("utf-32-le"), "<u4"), powers) for s in (a, b))
    assert x.lce(4, y, 2) == len("quick brown fox ") and x.lce(0, y, 0) == 0
    assert x.equal(4, y, 2, 5) and not x.equal(4, y, 3, 5) and x.span(3, 3) == y.span(0, 0)


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(3, "abcd")], "doc_id long, text string")
    r = fingerprints.op9_document_fingerprints(one).first()
    assert r.edited_sha256 == sha("abab") and r.near_next == 1.0


# --- op10 ----------------------------------------------------------------------------
def test_substring_dedup(docs):
    rows = texts_by_id()
    place = [float("inf") if d is None else d for d, _ in rows]
    first = {}
    for p, (_, t) in zip(place, rows):
        w = WORD.findall(t)
        for i in range(len(w) - 49):
            key = tuple(w[i:i + 50])
            first[key] = min(first.get(key, p), p)
    expected = []
    for p, (d, t) in zip(place, rows):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < p:
                gone[i:i + 50] = [True] * 50
        expected.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    same(substrings.op10_substring_dedup(docs).collect(), expected)


# --- all -----------------------------------------------------------------------------
OPERATORS = [mixing.op1_mixing_sources, bpe.op2_byte_level_bpe, jaccard.op3_ngram_jaccard_join, languages.op4_language_id,
             suffixes.op5_suffix_array_dedup, quality.op6_quality_rules, pseudo_likelihood.op7_lm_scoring,
             token_files.op8_token_files, fingerprints.op9_document_fingerprints, substrings.op10_substring_dedup,
             pieces.op11_sentencepiece]


@pytest.mark.parametrize("op", OPERATORS, ids=lambda f: f.__name__)
def test_empty_table(empty, op):
    out = op(empty)
    assert out.columns[0] == "doc_id" and out.count() == 0


def test_all_operators_are_registered():
    assert set(QUERIES) == {f.__name__ for f in OPERATORS} | {"op12_centroid_clustering", "op13_source_divergence"}


def borderline_copies(n, most, seed=2):
    """Copies of one text with some words changed, of which not every two are
    similar to each other."""
    rng = np.random.default_rng(seed)
    base = prose(rng, 260).split()
    out = []
    for i in range(n):
        w = list(base)
        for at in rng.choice(len(w), int(rng.integers(2, most + 1)), replace=False):
            w[at] = f"x{i}y{at}"
        out.append((i, " ".join(w)))
    return out


def test_pairs_of_borderline_copies_grow_with_the_group(spark, monkeypatch):
    """Nearly all are in one component, but about half of the pairs are not
    links: pairs looked at and links kept grow with the group, not its square."""
    formed, kept, real = [], [], jaccard._verified

    def counted(pairs, text):
        links, n = real(pairs, text)
        formed[-1] += n
        kept[-1] += links.count()
        return links, n

    monkeypatch.setattr(jaccard, "_verified", counted)
    for n in (100, 300):
        formed.append(0)
        kept.append(0)
        rows = borderline_copies(n, 3)
        sets = [(d, shingles(t)) for d, t in rows]
        root = brute_components(sets)
        links = sum(100 * len(x & y) >= 80 * len(x | y) for (_, x), (_, y) in combinations(sets, 2))
        got = jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        same(got.collect(), [(d, len(s), root(d)) for d, s in sets])
        assert 8 * n < links < n * (n - 1) / 2
    assert formed[1] <= 4 * formed[0] and kept[1] <= 4 * kept[0] and kept[1] < 4 * 300


def test_a_family_whose_first_hub_is_unlike_the_others(spark):
    """The smallest doc_id is similar to few: later rounds take other hubs."""
    rows = borderline_copies(60, 3) + [(-1, borderline_copies(1, 12, seed=2)[0][1] + " tail of others " * 12)]
    sets = [(d, shingles(t)) for d, t in rows]
    root = brute_components(sets)
    got = jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    same(got.collect(), [(d, len(s), root(d)) for d, s in sets])


def unlike_copies(n, seed=4):
    """Copies of one text with four words changed; only every tenth is similar
    to another, the one before it, which changes three of the same places."""
    rng = np.random.default_rng(seed)
    base = prose(rng, 260).split()
    out, at = [], None
    for i in range(n):
        new = rng.choice(len(base), 4, replace=False)
        at = np.append(at[:3], new[3]) if i % 10 == 9 else new
        out.append((i, " ".join(f"x{i}y{k}" if k in at else w for k, w in enumerate(base))))
    return out


def test_unlinked_copies_are_not_paired_with_their_whole_family(spark, monkeypatch):
    """Every two share prefix tokens and pass the test of places, few are links:
    the pairs of the last step come from what differs from the family's middle."""
    formed, real = [], jaccard._verified

    def counted(pairs, text):
        links, n = real(pairs, text)
        formed.append(n)
        return links, n

    monkeypatch.setattr(jaccard, "_verified", counted)
    rows = unlike_copies(200)
    sets = [(d, shingles(t)) for d, t in rows]
    root = brute_components(sets)
    got = jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    same(got.collect(), [(d, len(s), root(d)) for d, s in sets])
    assert 20 <= len(rows) - len({root(d) for d, _ in sets}) < 150
    assert formed[-1] < len(rows) * (len(rows) - 1) / 2 / 3


def test_families_with_several_sets_a_document(spark, monkeypatch):
    """Rows that share a doc_id, null texts and texts like the middle itself;
    without star rounds, so that the last step finds every link."""
    monkeypatch.setattr(jaccard, "FAMILY", 4)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    rows = borderline_copies(60, 6) + unlike_copies(60) + [(3, None), (5, None), (7, borderline_copies(90, 6)[80][1]), (200, "a b"), (201, None)]
    sets = [(d, shingles(t or "")) for d, t in rows]
    want = {}

    def root(d):
        while want.setdefault(d, d) != d:
            d = want[d]
        return d

    for (a, x), (b, y) in combinations(sets, 2):
        if a != b and x and y and 100 * len(x & y) >= 80 * len(x | y) and root(a) != root(b):
            low, high = sorted((root(a), root(b)))
            want[high] = low
    got = jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    same(got.collect(), [(d, len(s), root(d)) for d, s in sets])


def test_large_parameters_keep_the_log_probability_finite():
    """Values beyond the range of the exponential are made smaller first; sums
    of exponentials, not divided rows, give the same gradient as a plain softmax."""
    p = pseudo_likelihood.start_parameters()
    p[4][:] = 0
    p[4][7] = 500
    context, token = np.zeros((2, 4), np.int64), np.array([7, 8])
    got = pseudo_likelihood.log_probability(p, context, token)
    assert np.isfinite(got).all() and abs(got[0]) < 1e-3 and -501 < got[1] < -499
    p = pseudo_likelihood.start_parameters()
    z = (pseudo_likelihood._hidden(p, context)[1] @ p[3] + p[4]).astype(np.float64)
    soft = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    soft[[0, 1], token] -= 1
    want = p[4] - 0.5 / 2 * soft.sum(0)
    pseudo_likelihood.step(p, context, token, 0.5)
    np.testing.assert_allclose(p[4], want, atol=1e-6)


def test_words_forgotten_and_met_again_keep_their_ids(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO", 3)
    words, made, real = token_files._Words(token_files.TOKENIZER), [], token_files.array
    monkeypatch.setattr(token_files, "array", lambda kind, ids: made.append(1) or real(kind, ids))
    texts = ["one two three four", "four five one", "six  seven\n eight", "one two three four", ""] * 2
    for t in texts:
        ids = np.frombuffer(words.encode(t), "<u4").tolist()
        assert ids == words.tokenizer.encode(t, add_special_tokens=False).ids
    assert type(words.new) is token_files._Recent and len(made) > 8
