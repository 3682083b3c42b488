import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitlens.llm import huffman, queries, token_files


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(queries.BYTE_VOCABULARY)
    found.encode_special_tokens = True
    return found


def by_force(rows, tokenizer):
    out, at = {}, 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def told(rows):
    return {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows}


@pytest.mark.parametrize("n", [1, 2, 3, 100, 5000])
def test_huffman_round_trip(n):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(0.4, n) * 100).astype(np.int64) + 1
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.LIMIT
    if n > 1:
        assert sum(2.0 ** -lengths.astype(float)) == pytest.approx(1)
    ids = rng.integers(0, n, 3000).astype(np.int32)
    data, starts = huffman.pack(ids, huffman.canonical_codes(lengths), lengths)
    again = huffman.unpack(data, len(ids), starts[::128], 128, huffman.decoding_table(lengths))
    assert (again == ids).all()


def test_lengths_are_optimal_where_the_limit_allows():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 0])
    assert huffman.code_lengths(counts).tolist() == [6, 6, 5, 4, 3, 2, 1, 0]
    limited = huffman.code_lengths(counts, limit=4)
    assert limited.max() == 4 and sum(2.0 ** -limited[:7].astype(float)) == 1


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    texts = ["", None, " ", "  a  b\tc\nd ", "\n\n x", "x y\xa0 z", "a  b", "<|endoftext|> hi",
             "日本 語 😀", "a\x1c b\x85 c", "x a\x00b a", "word " * 500]
    encoder = token_files.Encoder(queries.BYTE_VOCABULARY)
    for _ in range(2):
        ids, sizes = encoder.encode(texts)
        ends = np.cumsum(sizes)
        for text, b, e in zip(texts, ends - sizes, ends, strict=True):
            want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
            assert ids[b:e].tolist() == want


def test_query_matches_the_library(spark, sf_docs, tokenizer):
    rows = sorted((r.doc_id, r.text) for r in sf_docs.collect())
    got = told(queries.op3_token_files(spark, "/root/testdata/sf0.001").collect())
    assert got == by_force(rows, tokenizer)


def test_cases_and_long_documents(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 256)
    rows = [(1, None), (2, ""), (5, "a b c " * 400), (9, "x"), (10, "y z " * 64)]
    docs = documents(*reversed(rows)).withColumn("n_tokens", F.lit("clash"))
    got = token_files.round_trip(docs, queries.BYTE_VOCABULARY).collect()
    assert told(got) == by_force(rows, tokenizer)


def test_names_of_added_tokens_as_the_library_has_them(documents):
    plain = Tokenizer.from_file(queries.BYTE_VOCABULARY)
    rows = [(1, "a <|endoftext|> b"), (2, "a b"), (3, "<|endoftext|>"), (4, "x<|endoftext|>y  z")]
    got = token_files.round_trip(documents(*rows), queries.BYTE_VOCABULARY).collect()
    assert told(got) == by_force(rows, plain)
    assert {r.doc_id: r.n_tokens for r in got}[1] == 5


def test_ties_nulls_and_empty(documents):
    docs = documents((None, "a"), (4, "b b"), (4, "c"), (4, "c"))
    rows = token_files.round_trip(docs, queries.BYTE_VOCABULARY).collect()
    assert sorted(r.start + r.n_tokens for r in rows)[-1] == sum(r.n_tokens for r in rows)
    assert min(rows, key=lambda r: r.start).doc_id is None
    assert token_files.round_trip(documents(), queries.BYTE_VOCABULARY).count() == 0


def test_damaged_block_is_noticed():
    lengths = huffman.code_lengths(np.array([5, 3, 2]))
    codes = huffman.canonical_codes(lengths)
    ids = np.array([0, 1, 2, 0], dtype=np.int32)
    block = token_files.file_block(0, 0, [(7, 4, True)], ids, codes, lengths)
    content = token_files.file_header(lengths) + token_files.SYNC + block + token_files.SYNC
    ((_, _, segments, values),) = token_files.read_blocks(content)
    assert segments == [(7, 4, True)] and values.tolist() == ids.tolist()
    broken = bytearray(content)
    broken[-12] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_blocks(bytes(broken)))


@pytest.mark.parametrize("added", [True, False])
def test_odd_white_space_and_names_against_the_library(added):
    """Texts at whose spaces the words may not be cut, among plain ones."""
    from tokenizers import Tokenizer

    texts = [
        None, "", " ", "  ", " a", "a ", "a  b", "a \n b", "a\u00a0 b c", "a \u3000b", "x\x1c y", "a\tb c d",
        "plain words only here", "<|endoftext|>", "a <|endoftext|> b", "plain <|endoftext|>", "\u0120 \u0120x y",
        "don't can't we'll", "a\x85 b", "one\n\ntwo three", "tail\n", " lead and tail ", "plain words only here",
    ]
    library = Tokenizer.from_file(queries.BYTE_VOCABULARY)
    library.encode_special_tokens = not added
    want = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    encoder = token_files.Encoder(queries.BYTE_VOCABULARY, added=added)
    for _ in range(2):  # the second time from what it remembers
        ids, sizes = encoder.encode(texts)
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert [len(x) for x in encoder.encode([])] == [0, 0]


def test_words_that_open_otherwise_go_one_by_one():
    encoder = token_files.Encoder(queries.BYTE_VOCABULARY)
    plain = token_files.Encoder(queries.BYTE_VOCABULARY).encode(["some plain words"])[0].tolist()
    encoder._opens[:] = False
    assert encoder.encode(["some plain words"])[0].tolist() == plain
