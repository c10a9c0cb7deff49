"""SentencePiece encoding against the library."""

import random

import pytest
import sentencepiece

from ledgerlens.llm import pieces
from test_llm_operators import ROWS, SCHEMA, same, sha


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def bpe():
    return pieces.PieceBpe()


def test_query_is_the_library(spark, library):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    expected = []
    for r in ROWS:
        ids = library.encode(r[1] or "")
        expected.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    same([tuple(r) for r in pieces.op11_sentencepiece(docs).collect()], expected)
    assert pieces.op11_sentencepiece(docs).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_random_texts(bpe, library):
    rng = random.Random(11)
    pools = [" ab", " \n\tabe", "the inga ", "éñü ßœ", "日本語の 中", "АБвгд е", "\U0001f600\U0001f44d‍", "▁ x", "0123.,;!?()",
             "<s></s>0x", " ", "\x00\x85�"]
    known = [p.replace("▁", " ") for p in bpe.ids]
    for n in range(4000):
        if n % 2:
            text = "".join(rng.choice(known) for _ in range(rng.randint(1, 10)))
        else:
            text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(1, 50)))
        ids = library.encode(text)
        assert bpe.encode(text) == ids
        assert bpe.decode(ids) == library.decode(ids)


def test_chunks_change_nothing(bpe, library):
    """A whole text as one chunk has the same pieces: cutting is only cheaper."""
    text = "when the text is   not cut, backtracking runs over all of it " * 5
    whole = bpe.pieces(bpe.normalized(text).replace(" ", pieces.SPACE))
    assert [bpe.ids[p] for p in whole] == library.encode(text)


def test_long_words_and_runs(bpe, library):
    for text in ("a" * 5000, "ab" * 3000, " " * 300, "e" * 17 + " " * 40 + "ing" * 90, "zq" * 2000 + "\n" * 50):
        assert bpe.encode(text) == library.encode(text)


def test_decoding_any_ids(bpe, library):
    rng = random.Random(4)
    for _ in range(4000):
        ids = [rng.choice([rng.randint(0, 31999), rng.randint(0, 260), rng.randint(0, 3), 259, 28705]) for _ in range(rng.randint(0, 6))]
        assert bpe.decode(ids) == library.decode(ids)


def test_compatible_pairs_are_those_that_stay_two(bpe, library):
    rng = random.Random(9)
    known = [p for p in rng.sample(sorted(bpe.ids), 3000) if "▁" not in p and (len(p) == 1 or bpe.halves(p))]
    for _ in range(3000):
        a, b = rng.choice(known), rng.choice(known)
        # after a line break, which joins nothing, the pair is encoded as if alone
        ids = library.encode("\n" + a + b)[2:]
        assert bpe.compatible(a, b) == (ids == [bpe.ids[a], bpe.ids[b]])


def test_ids_and_text_on_request_and_clashing_columns(spark, library):
    rows = [(1, "two  words", 5, "x"), (None, None, 6, "y"), (1, "two  words", 5, "x"), (3, "", 7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, _text string")
    out = pieces.encode_decode(df, with_ids=True)
    assert out.columns == ["doc_id", "text", "_text", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    got = [(r.doc_id, r.text, r._text, list(r.ids), r.decoded) for r in out.collect()]
    same(got, [(d, t, x, library.encode(t or ""), t or "") for d, t, _, x in rows])
    assert pieces.op11_sentencepiece(df.limit(0)).count() == 0


def test_models_of_another_kind_are_refused(monkeypatch):
    monkeypatch.setattr(pieces.PieceBpe, "normalized", lambda self, text: text)  # as if the model had no dummy prefix
    with pytest.raises(ValueError):
        pieces.PieceBpe()
