"""The two trained operators against plain loops: the same counts, parameters
and decisions, worked out token by token in Python."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlens.llm import languages, pseudo_likelihood
from ledgerlens.llm.common import word_hashes
from test_llm_operators import ROWS, SCHEMA, WORD

MASK = (1 << 64) - 1


def scrambled(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


# --- op4 -----------------------------------------------------------------------------
def words_of(text):
    out, word = [], []
    for c in (text or "") + " ":
        if c.isalpha() and ord(c) < languages.RANGES[-1][0]:
            word.append(c)
        elif word:
            out.append(word)
            word = []
    return out


def trigrams(word):
    low = [0, *(ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in word), 0]
    return [scrambled(a << 42 | b << 21 | c) >> 48 for a, b, c in zip(low, low[1:], low[2:])]


def script_of(word):
    return [name for start, name in languages.RANGES if start <= ord(word[0])][-1]


def held_out(doc_id):
    import zlib
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def brute_languages(rows):
    tri, script, docs = defaultdict(Counter), defaultdict(Counter), Counter()
    for doc, text, lang in rows:
        if lang is not None and text is not None and not held_out(doc):
            docs[lang] += 1
            for w in words_of(text):
                tri[lang].update(trigrams(w))
                script[lang][script_of(w)] += len(w)
    langs = sorted(docs)
    total = {k: sum(tri[k].values()) + 0.1 * languages.BUCKETS for k in langs}
    own = {k: {s for s, n in script[k].items() if n >= languages.SCRIPT_SHARE * sum(script[k].values())} for k in langs}

    def score(word, lang):
        if script_of(word) not in own[lang]:
            return languages.UNKNOWN if any(script_of(word) in own[k] for k in langs) else 0.0
        return sum(math.log((tri[lang][t] + 0.1) / total[lang]) for t in trigrams(word))

    out = []
    for doc, text, _ in rows:
        found = words_of(text)
        if not found or not langs:
            out.append((doc, held_out(doc), "und", 0.0))
            continue
        value = {k: math.log(docs[k] / sum(docs.values()) + 1e-9) + score(found[0], k) for k in langs}
        back = []
        for w in found[1:]:
            best = max(langs, key=lambda k: (value[k], -langs.index(k)))
            step = {k: k if value[k] >= value[best] - languages.SWITCH else best for k in langs}
            value = {k: max(value[k], value[best] - languages.SWITCH) + score(w, k) for k in langs}
            back.append(step)
        label = [max(langs, key=lambda k: (value[k], -langs.index(k)))]
        for step in reversed(back):
            label.append(step[label[-1]])
        letters = Counter()
        for k, w in zip(reversed(label), found):
            letters[k] += len(w)
        best = max(langs, key=lambda k: (letters[k], -langs.index(k)))
        out.append((doc, held_out(doc), best, letters[best] / sum(letters.values())))
    return out


def test_language_id_against_plain_loops(spark):
    rng = np.random.default_rng(12)
    sounds = {"aa": "ba be bi bo", "bb": "ska sko ñir üt", "cc": "жа ло пи ну", "dd": "zu za ba ska"}

    def prose(lang, n):
        part = sounds[lang].split()
        return " ".join("".join(rng.choice(part, rng.integers(1, 5))).title() for _ in range(n))

    rows = [(i, prose(k, int(rng.integers(3, 60))), k) for i, k in enumerate(list(sounds) * 30)]
    rows += [(500 + i, f"{prose(a, 20)}. {prose(b, 30)}, {prose(a, 9)}", None) for i, (a, b) in enumerate(
        [("aa", "bb"), ("bb", "cc"), ("cc", "dd"), ("dd", "aa"), ("aa", "dd")] * 4)]
    rows += [(None, prose("bb", 8), "bb"), (700, None, "aa"), (701, "", "aa"), (702, "12 34 !?", "aa"), (703, "日本 語", None),
             (704, "ba 日本 be", "aa"), (5, "ba be", "zz"), (705, "İstanbul ba be", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {(r.doc_id, r.lang_pred, round(r.score, 9), r.held_out) for r in languages.op4_language_id(df).collect()}
    want = {(d, k, round(s, 9), h) for d, h, k, s in brute_languages(rows)}
    assert got == want
    assert {k for _, k, _, _ in got} >= {*sounds, "und"} and any(0 < s < 1 for _, _, s, _ in got)


# --- op7 -----------------------------------------------------------------------------
def test_scores_against_plain_loops(spark):
    """Every document's score, from the trained parameters and the counts,
    one token after another in double precision."""
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    blocks = pseudo_likelihood.blocked(docs)
    counts = pseudo_likelihood.word_counts(blocks)
    common, values = pseudo_likelihood.train(docs, counts)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens), r.pseudo_log_likelihood)
                 for r in pseudo_likelihood.score(docs, common, values, counts).collect())

    tally = Counter(w for r in ROWS for w in WORD.findall(r[1] or ""))
    top = {w: k for k, w in enumerate(sorted((w for w in tally), key=lambda w: (-tally[w], hash_of(w)))[:pseudo_likelihood.WORDS])}
    place = {w: int(np.searchsorted(common, np.uint64(hash_of(w) & MASK))) for w in top}
    cls = {w: scrambled(hash_of(w) & MASK) % pseudo_likelihood.CLASSES for w in tally}
    size, kinds = Counter(), Counter()
    for w, n in tally.items():
        if w not in top:
            size[cls[w]] += n
            kinds[cls[w]] += 1
    table, w1, b1, w2, b2 = (p.astype(np.float64) for p in pseudo_likelihood.shaped(values))
    known = {}

    def log_share(context, own):
        key = (context, own)
        if key not in known:
            h = np.tanh(np.concatenate([table[i] for i in context]) @ w1 + b1)
            z = h @ w2 + b2
            known[key] = z[own] - np.log(np.exp(z - z.max()).sum()) - z.max()
        return known[key]

    a, edge = pseudo_likelihood.A, pseudo_likelihood.VOCABULARY - 1
    want = []
    for r in ROWS:
        words = WORD.findall(r[1] or "")
        if len(words) > 3000:
            continue  # the longest one is left to the sums of the others
        ids = [place[w] if w in top else pseudo_likelihood.WORDS + cls[w] for w in words]
        padded = [edge, edge, *ids, edge, edge]
        total = 0.0
        for i, (w, own) in enumerate(zip(words, ids)):
            total += log_share((padded[i], padded[i + 1], padded[i + 3], padded[i + 4]), own)
            if w not in top:
                total += math.log((tally[w] + a) / (size[cls[w]] + a * (kinds[cls[w]] + 1)))
        want.append(((r[0] is None, r[0] or 0, len(words)), total))
    got = [g for g in got if g[0][2] <= 3000]
    assert [k for k, _ in got] == [k for k, _ in sorted(want)]
    for (_, x), (_, y) in zip(got, sorted(want)):
        assert x == pytest.approx(y, rel=2e-4, abs=2e-3)


def hash_of(word):
    """The word's hash as a signed long."""
    return int(word_hashes(np.frombuffer(word.encode(), np.uint8), 5)[0].view(np.int64)[0])
