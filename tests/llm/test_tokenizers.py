import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import pyarrow as pa
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventflow.llm import boundaries, bpe, tokens
from eventflow.llm.common import buffers

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken"))
PATTERN = regex.compile(public_tokenizers.PATTERN)
LIBRARY = Tokenizer.from_file(JSON)
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS),
                             special_tokens={})
CHARS = " \t\n\r'''srtvelmdAS19.,!?-é漢字ü　\u0085\xa0​́ſKñ🙂٣½\x1c\x1f"


def texts(n, most, seed=1, chars=CHARS):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def split(many):
    raw, offsets = buffers(pa.array(many, pa.string()))
    text, starts, ends, row, _ = boundaries.pieces(raw, offsets)
    out = [[] for _ in many]
    for i, j, r in zip(starts, ends, row):
        out[r].append(text[i:j])
    return out


def test_boundaries_equal_the_pattern():
    many = texts(3000, 40) + ["", "'re", "a'r", "x  ", "\n's", " 's", "''s", "a" * 1000]
    assert split(many) == [PATTERN.findall(t) for t in many]


@given(st.lists(st.text(alphabet=CHARS, max_size=200), max_size=5))
@settings(max_examples=100, deadline=None)
def test_boundaries_any_text(many):
    assert split(many) == [PATTERN.findall(t) for t in many]


def test_chunk_maps_compose():
    kinds = np.random.RandomState(0).randint(0, 12, 5000).astype(np.uint8)
    step, emits = boundaries.tables()
    state, marks = boundaries.START, []
    for k in kinds:
        marks.append(emits[state * 12 + k])
        state = step[state * 12 + k]
    marks = np.array(marks)
    want = (marks & boundaries.BEFORE) > 0
    want[:-1] |= (marks[1:] & boundaries.EARLIER) > 0
    assert (boundaries.cut(kinds) == want).all()


def count(many):
    return tokens.count_batch(pa.array(many, pa.string()), JSON)[1].to_pylist()


def test_counts_equal_the_library():
    many = texts(2000, 60) + texts(500, 300, 2, "aAbehtinors ") + [
        "x<|endoftext|>y", "<|endoftext|>", " <|endoftext|> <|endoftext|>'s", "<|endof", "text|>",
        "a" * 5000, "!" * 3000, " " * 2000 + "x", "", None]
    want = [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in many], add_special_tokens=False)]
    assert count(many) == want


def test_counts_do_not_depend_on_the_cache(monkeypatch):
    many = texts(300, 80, 3, "aAbehtinors ")
    want = count(many)
    monkeypatch.setattr(tokens, "MAX_STATES", 20)
    monkeypatch.setattr(tokens, "MAX_PIECES", 5)
    tokens.tokenizer.cache_clear()
    assert count(many) == want
    tokens.tokenizer.cache_clear()


def test_fold_and_heap_equal_the_library(spark):
    rnd = random.Random(4)
    words = [w.encode() for w in (" hello", "Zürich", " 漢字漢字", "aaaaaaa", "x", " !!!!!!!!")]
    words += [bytes(rnd.choice(b"aehtinors ") for _ in range(rnd.randint(1, 30))) for _ in range(150)]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    got = {bytes(r.word): r.ids for r in df.select(
        "word", bpe.fold(F.col("word"), bpe.rank_literal(RANKS)).alias("ids")).collect()}
    for w in words:
        want = ENCODING._core_bpe.encode_single_piece(w)
        assert got[w] == want
        assert bpe.merge_bytes(w, bpe.ranks(RANKS)) == want
    flat, sizes = bpe.merge_many([*words, b"", b"a" * 500], bpe.pairs_of(RANKS))
    assert flat.tolist() == [i for w in [*words, b"a" * 500] for i in ENCODING._core_bpe.encode_single_piece(w)]
    assert sizes.tolist()[:len(words)] == [len(got[w]) for w in words] and sizes[len(words)] == 0
    long = bytes(rnd.choice(b"0123456789abcdef") for _ in range(5000))
    assert bpe.merge_bytes(long, bpe.ranks(RANKS)) == ENCODING._core_bpe.encode_single_piece(long)


@pytest.mark.parametrize("most", [0, 50, 1 << 16])
def test_encode_decode_round_trip(spark, most):
    """Nothing in the dictionary, some of it, all; pieces beyond the fold's length."""
    many = texts(200, 200, 5) + ["", None, "a" * 3000, " ", "ab" * 200 + " x", "", "Zürich 漢字"]
    d = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(d, RANKS, max_words=most), RANKS).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted(enumerate(many))
    for r in rows:
        ids = ENCODING.encode_ordinary(r.text or "")
        assert hashlib.sha256(bytes(r.ids)).digest() == hashlib.sha256(np.array(ids, "<u4").tobytes()).digest()
        assert bytes(r.decoded) == (r.text or "").encode()


def test_texts_without_pieces(spark):
    for rows in ([], [(1, "")], [(1, None), (2, "")]):
        d = spark.createDataFrame(rows, "doc_id long, text string")
        got = bpe.decode(bpe.encode(d, RANKS), RANKS).collect()
        assert sorted((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == [(i, b"", b"") for i, _ in rows]


def test_equal_hashes_do_not_mix_pieces(monkeypatch):
    """A hash that takes all pieces of one length for equal changes nothing."""
    monkeypatch.setattr(bpe, "range_hash", lambda raw, starts, ends: (ends - starts).astype(np.uint64))
    text = "one two six ten one".encode()
    words, back, count = bpe.distinct(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert b"".join(words[i] for i in back) == text and len(words) == 5 and count.tolist() == [5]


def test_dictionary_is_bounded(spark):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts(100, 50, 6))], "doc_id long, text string")
    assert bpe.dictionary(d, RANKS, max_words=40).count() <= 40


def test_ids_outside_the_vocabulary_and_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert {(r.doc_id, r.decoded if r.decoded is None else bytes(r.decoded)) for r in bpe.decode(df, RANKS).collect()} == {
        (1, None), (2, b"")}
    bad = spark.createDataFrame([(1, np.array([1 << 20], "<u4").tobytes())], "doc_id long, ids binary")
    with pytest.raises(Exception):
        bpe.decode(bad, RANKS).collect()


def test_names_that_clash(spark):
    d = spark.createDataFrame([(1, "some text", 5, 6)], "doc_id long, text string, ids long, decoded long")
    coded = bpe.encode(d, RANKS)
    assert coded.columns == [*d.columns, "ids_"]
    back = bpe.decode(coded, RANKS, ids="ids_")
    (r,) = back.collect()
    assert back.columns == [*coded.columns, "decoded_"] and (r.ids, r.decoded, bytes(r.decoded_)) == (5, 6, b"some text")
