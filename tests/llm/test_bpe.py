"""BPE encoding, decoding and token counts against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from skyledger.llm import bpe_automaton, byte_level, queries, token_counts
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "aaaaab ABC'stred  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 éßñ 12½²³ 　中文字каиו🎉́!?.-_ʼˈʰ"


def odd_texts():
    draw = random.Random(7)
    texts = ["", " ", "a" * 3000, "ab" * 500, " " * 300, "\n" * 90 + "x", "-" * 700,
             "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|",
             "don't WE'LL I'm 'tis", "\x1c\x1d \x85x  "]
    texts += ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 60)))
              for _ in range(800)]
    any_char = [*range(1, 0x300), *range(0x300, 0xD800, 97), *range(0xE000, 0x110000, 997)]
    texts += ["".join(chr(draw.choice(any_char)) for _ in range(30)) for _ in range(500)]
    return texts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def source():
    return byte_level.read_vocabulary_file(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_encodes_and_decodes_as_the_library(library, source):
    automaton = bpe_automaton.compiled(source)
    for text in odd_texts():
        expected = library.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text) == expected, text
        assert automaton.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_ids_that_break_characters_decode_as_the_library(library, source):
    automaton, draw = bpe_automaton.compiled(source), random.Random(3)
    for _ in range(300):
        ids = [draw.randrange(50257) for _ in range(12)]
        assert automaton.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_counts_as_the_library(library, source):
    counter = token_counts.prepared(source)
    for text in odd_texts():
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_proven_string_is_one_token(library, source):
    whole = sorted(token_counts.prepared(source).whole)
    encoded = library.encode_batch(whole, add_special_tokens=False)
    assert all(len(found.ids) == 1 for found in encoded)
    assert len(whole) > 49_000


def test_merge_order_of_a_small_vocabulary():
    labels = dict(enumerate([b"a", b"b", b"aa", b"ab", b"aab", b"aaaa"]))
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (2, 2, 5)]
    automaton = bpe_automaton.Automaton(byte_level.Vocabulary(labels, merges))
    counter = token_counts.Counter(byte_level.Vocabulary(labels, merges))
    draw = random.Random(1)
    for _ in range(2000):
        word = bytes(draw.choice(b"aaab") for _ in range(draw.randint(1, 14)))
        parts = [0 if byte == 97 else 1 for byte in word]
        for left, right, made in merges:  # one merge after the other, each from the left
            at = 0
            while at < len(parts) - 1:
                if parts[at:at + 2] == [left, right]:
                    parts[at:at + 2] = [made]
                at += 1
        assert list(automaton.path(word)) == parts == counter.merge(word)


def test_long_words_merge_as_short_ones(source):
    counter, draw = token_counts.prepared(source), random.Random(2)
    for _ in range(200):
        word = bytes(draw.choice(b"abet hing") for _ in range(60))
        parts = [counter._bytes[byte] for byte in word]
        assert counter._merge_long(parts) == counter.merge(word)


def test_rows_of_any_kind(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (None, "the end", "x"), (1, "the end", None),
            (1, "the end", None), (3, "lorem " * 40_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    found = bpe_automaton.encode(docs, PATH)
    counts = token_counts.count_tokens(docs, PATH, limit=100)
    for doc, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = sha(",".join(map(str, ids)))
        same = [r for r in found.collect() if r.doc_id == doc and r.ids == ids]
        assert same and same[0].n_tokens == len(ids) and same[0].ids_sha256 == digest
        assert same[0].decoded_sha256 == sha(text or "")
        assert (doc, len((text or "").encode()), len(ids), len(ids) > 100) in set(
            map(tuple, counts.collect()))
    assert found.count() == counts.count() == len(rows)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    texts = {(r.doc_id, r.text) for r in bpe_automaton.decode(found, PATH).collect()}
    assert texts == {(doc, text or "") for doc, text, _ in rows}
    assert bpe_automaton.encode(docs.limit(0), PATH).count() == 0
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_queries_cover_every_document(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    encoded = {r.doc_id: r for r in queries.op6_bpe_codec(spark, sf_dir).collect()}
    counted = {r.doc_id: r for r in queries.op10_token_counts(spark, sf_dir).collect()}
    assert len(encoded) == len(counted) == len(docs)
    for doc, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoded[doc].ids_sha256 == sha(",".join(map(str, ids)))
        assert encoded[doc].decoded_sha256 == sha(text)
        assert counted[doc].n_tokens == encoded[doc].n_tokens == len(ids)
        assert counted[doc].n_bytes == len(text.encode())
        assert counted[doc].over_limit == (len(ids) > 1024)
