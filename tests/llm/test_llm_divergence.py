"""Source divergence against plain loops over Python integers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import divergence
from test_llm_operators import ROWS, SCHEMA, same

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def price(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: price(counts[lang, s]) for s in sources}
        q = price(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(items[:most])]
    return out


def more_rows():
    """The fixture, so often that terms reach ten documents, and plain words."""
    rows = [(t, lang, source) for _, t, lang, source, *_ in ROWS] * 3
    rows += [(f"Common word{i % 4} Étude Ünter été日本 x{i}", "en", f"s{i % 5}") for i in range(60)]
    rows += [("never kept", "xx", "one"), (None, "xx", None), ("", "xx", "two"), ("alone " * 5, "yy", "only")]
    rows += [("tie tie2 tie3", "zz", s) for s in "ab" for _ in range(10)] + [("", "zz", "none")]
    return rows


def frame(spark, rows):
    full = [(i, t, lang, source, 0, 1, "w", "t", 3) for i, (t, lang, source) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).withColumn("n", F.lit("clash")).withColumn("block", F.lit("clash"))


def test_query(spark):
    rows = more_rows()
    got = divergence.op13_source_divergence(frame(spark, rows).repartition(5))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "string", "string", "bigint", "int"]
    expected = brute(rows)
    assert {e[2] for e in expected} == {"pair", "term"} and any(e[4] == 0 for e in expected)
    same([tuple(r) for r in got.collect()], expected)


def test_blocks_flushes_and_shuffled_groups_change_nothing(spark, monkeypatch):
    rows = more_rows()
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    monkeypatch.setattr(divergence, "PIECE", 64)
    docs = frame(spark, rows).repartition(3)
    counts = divergence.term_counts(docs).cache()
    kept = divergence.kept_terms(counts, block_rows=40).cache()
    assert kept.agg(F.countDistinct("block")).first()[0] > 10
    groups = divergence.group_facts(docs, kept)
    got = [(r.lang, r.a, r.b, r.value) for r in divergence.pair_divergence(kept, groups).collect()]
    same(got, [(g, s, i, v) for g, s, part, i, v, _ in brute(rows) if part == "pair" and s < i])
    terms = [tuple(r) for r in divergence.term_divergence(kept, groups).select("lang", "source", "item", "value", "rank").collect()]
    same(terms, [(g, s, i, v, n) for g, s, part, i, v, n in brute(rows) if part == "term"])


def test_empty_table(spark):
    assert divergence.op13_source_divergence(frame(spark, more_rows()).limit(0)).count() == 0


def test_top_terms_are_cut_before_the_shuffle(spark):
    docs = frame(spark, more_rows())
    kept = divergence.kept_terms(divergence.term_counts(docs))
    plan = divergence.term_divergence(kept, divergence.group_facts(docs, kept))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("sizes", [(0, 5), (5, 0), (1, 4000), (300, 5000), (64, 64), (700, 900), (3, 3)])
def test_gallop(sizes):
    rng = np.random.default_rng(sum(sizes))
    for _ in range(20):
        small, large = (np.sort(rng.choice(max(8, s * 3), s, replace=False)) for s in sizes)
        mine, theirs = divergence.gallop(small, large)
        assert small[mine].tolist() == large[theirs].tolist() == np.intersect1d(small, large).tolist()


def test_share_of_large_counts():
    for n, total, terms in ((0, 0, 1), (7, 90, 3), (10 ** 13, 10 ** 13 + 5, 10 ** 9), (8 * 10 ** 15, 8 * 10 ** 15, 10 ** 6), (3, 8 * 10 ** 15, 4)):
        assert divergence.share(np.array([n]), total, terms)[0] == 1 + 10 ** 9 * (n + 2) // (total + 2 * terms)
