import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from visitlens.llm import pieces, queries

TEXTS = [
    "", None, " ", "  a  b\tc\nd ", "\n\n x", "ﬁ Å é 😀 \U0001F9FF", "   ", "a" * 300, "x y" * 5,
    "<s> </s> <unk> <0x41>", "日本語テキスト 한국어 текст", "word\r\nword  \n  word", "1234567890 3.14",
    "Unbelievable internationalization of words", "a\x00b \x7f",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def split(ids, sizes):
    ends = np.cumsum(sizes)
    return [ids[b:e].tolist() for b, e in zip(ends - sizes, ends, strict=True)]


def test_same_ids_as_the_library(sf_docs, library):
    texts = TEXTS + [r.text for r in sf_docs.limit(60).collect()]
    model = pieces.PieceModel(queries.PIECE_MODEL)
    for _ in range(2):
        ids, sizes = model.encode(texts)
        assert split(ids, sizes) == library.encode([t or "" for t in texts])
    assert model.decode(ids, sizes) == [t or "" for t in texts]


def test_words_beyond_the_memory(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    model = pieces.PieceModel(queries.PIECE_MODEL)
    for text in ("one two three four", "five six one seven", "two nine"):
        ids, sizes = model.encode([text])
        assert split(ids, sizes) == [library.encode(text)]


def test_unigram_path_has_the_best_score():
    """The sum of scores, against all ways to cut a word."""
    model = pieces.PieceModel(queries.PIECE_MODEL, bpe=False)

    def best(word):
        found = {0: 0.0}
        for end in range(1, len(word) + 1):
            options = [
                found[b] + model.scores[model.ids[word[b:end]]]
                for b in range(end) if b in found and word[b:end] in model.ids
            ]
            if options:
                found[end] = max(options)
        return found[len(word)]

    for word in ("▁hello", "▁internat", "▁there", "▁abcdef"):
        (ids,) = model.viterbi([word])
        assert model.scores[ids].sum() == pytest.approx(best(word))
        assert "".join(model.pieces[i] for i in ids) == word


def test_query_round_trip(spark, sf_docs):
    texts = {r.doc_id: r.text for r in sf_docs.select("doc_id", "text", F.sha2("text", 256).alias("h")).collect()}
    want = {r.doc_id: r.h for r in sf_docs.select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    rows = queries.op7_pieces(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.text_sha256 for r in rows} == want
    assert all(r.n_chars == len(texts[r.doc_id]) for r in rows)


def test_frames(documents, library):
    docs = documents(*enumerate(TEXTS), (None, "x"), (3, "x")).withColumn("piece_ids", F.lit(1))
    encoded = pieces.encode(docs, queries.PIECE_MODEL, ("doc_id", "source"))
    assert encoded.columns == ["doc_id", "source", "piece_ids"]
    got = [(r.doc_id, r.piece_ids) for r in encoded.collect()]
    assert len(got) == len(TEXTS) + 2
    for i, text in enumerate(TEXTS):
        assert (i, library.encode(text or "")) in got
    again = pieces.decode(encoded, queries.PIECE_MODEL)
    assert sorted(r.text for r in again.collect()) == sorted([*(t or "" for t in TEXTS), "x", "x"])
    assert pieces.encode(documents(), queries.PIECE_MODEL).count() == 0


def test_pairs_are_forgotten_and_told_again(monkeypatch):
    from visitlens.llm import pieces
    from visitlens.llm.queries import PIECE_MODEL

    texts = [f"some {w} words of {w[::-1]} and {i}" for i, w in enumerate(("alpha", "beta", "gamma")) for _ in (0, 1)]
    whole = pieces.PieceModel(PIECE_MODEL)
    monkeypatch.setattr(pieces, "PAIR_BITS", 2)
    few = pieces.PieceModel(PIECE_MODEL)
    for text in texts:
        assert few.encode([text])[0].tolist() == whole.encode([text])[0].tolist()
        assert len(few._pairs) == 4
    assert pieces.PieceTexts(PIECE_MODEL).decode(*whole.encode(texts)) == texts


def test_decoding_in_blocks(spark, documents, monkeypatch):
    from visitlens.llm import pieces
    from visitlens.llm.queries import PIECE_MODEL

    docs = documents((1, "word " * 700_000), (2, None), (3, ""), (4, "short"), (5, "other " * 300_000))
    back = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL).collect()
    assert {r.doc_id: r.text for r in back} == {r.doc_id: r.text or "" for r in docs.collect()}
