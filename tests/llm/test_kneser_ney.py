"""The bigram model against counts and formulas in plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import LONG, ODD_ROWS, odd_documents
from skyledger.llm import hashing, kneser_ney, queries


def tokens(text):
    return [*(w.encode().lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")), "end"]


class Brute:
    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for text in texts:
            found = tokens(text)
            self.words.update(found)
            self.pairs.update(zip(["start", *found], found, strict=False))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.before = Counter(word for _, word in self.pairs)
        self.total, self.follow = Counter(), defaultdict(lambda: [0, 0, 0])
        for (context, _), n in self.pairs.items():
            self.total[context] += n
            self.follow[context][min(n, 3) - 1] += 1
        kinds = lambda counts: [list(counts.values()).count(k) for k in (1, 2, 3, 4)]
        self.cut = kneser_ney.discounts(kinds(self.pairs))
        self.low_cut = kneser_ney.discounts(kinds(self.before))
        self.left = sum(self.low_cut[min(n, 3)] for n in self.before.values())

    def lower(self, word):
        if not self.v:
            return 1.0
        n = self.before[word]
        spared = max(n - self.low_cut[min(n, 3)], 0) + self.left / (self.v + 1)
        return spared / sum(self.before.values())

    def probability(self, context, word):
        if not self.total[context]:
            return self.lower(word)
        n, share = self.pairs[context, word], np.dot(self.cut[1:], self.follow[context])
        own = max(n - self.cut[min(n, 3)], 0)
        return (own + share * self.lower(word)) / self.total[context]

    def row(self, text):
        found = tokens(text)
        score = sum(math.log10(self.probability(a, b))
                    for a, b in zip(["start", *found], found, strict=False))
        base = sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.v + 1)))
                   for w in found)
        known = sum(self.words[w] > 0 for w in found)
        return len(found), known, self.n, base, score


def check(rows, brute, text_of):
    for row in rows:
        want = brute.row(text_of(row))
        assert (row.n_tokens, row.n_known, row.train_tokens) == want[:3]
        assert row.base_score == pytest.approx(want[3], rel=1e-9, abs=1e-9)
        assert row.score == pytest.approx(want[4], rel=1e-9, abs=1e-9)


def test_probabilities_add_up_to_one():
    brute = Brute(["a b a c a b", "b a", "c", ""])
    for context in ["start", b"a", b"b", b"c", b"new"]:
        total = sum(brute.probability(context, word) for word in [*brute.words, "unseen"])
        assert total == pytest.approx(1.0)


def test_query_equals_the_formulas(spark, sf_dir):
    docs = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text").collect()))
    held = {doc for doc in docs if zlib.crc32(str(doc).encode()) % 5 == 1}
    rows = queries.op5_kneser_ney(spark, sf_dir).collect()
    assert {r.doc_id for r in rows if r.held_out} == held and len(rows) == len(docs)
    check(rows, Brute([text for doc, text in docs.items() if doc not in held]),
          lambda row: docs[row.doc_id])
    tested = [r for r in rows if r.held_out]
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested)


def test_rows_of_any_kind_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "TASK_TOKENS", 1000)
    monkeypatch.setattr(kneser_ney, "BATCH_TOKENS", 1000)
    monkeypatch.setattr(hashing, "PIECE", 64)
    rows = [*ODD_ROWS, (8, "a " * 400 + "Bé bé"), (9, "y" * 500 + " z")]
    docs = odd_documents(spark, rows)
    model = kneser_ney.fit(docs)
    found = kneser_ney.score(docs, model).collect()
    brute = Brute([text for _, text in rows])
    want = sorted((str(doc), *brute.row(text)) for doc, text in rows)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in found)
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-9)


def test_empty_tables(spark):
    docs = odd_documents(spark, [(1, "a b"), (2, None)])
    nothing = kneser_ney.fit(docs.limit(0))
    assert [(r.score, r.base_score, r.n_known) for r in kneser_ney.score(
        docs, nothing).collect()] == [(0.0, 0.0, 0)] * 2
    assert kneser_ney.score(docs.limit(0), kneser_ney.fit(docs)).count() == 0


def test_blocks_survive_packing():
    context = np.array([3, 3, 7, 9, 9], np.uint64)
    word = np.array([1, 5, 2, 1, 8], np.uint64)
    n = np.array([1, 300, 254, 255, 1 << 40])
    for got, want in zip(kneser_ney._unpack_pairs(kneser_ney._pack_pairs(context, word, n)),
                         (context, word, n), strict=True):
        assert (got == want).all()


def test_word_hashes_do_not_depend_on_their_place():
    data = np.frombuffer(LONG.encode(), np.uint8)
    starts, hashes = hashing.word_hashes(data)
    names = {}
    for word, found in zip(LONG.split(), hashes.tolist(), strict=True):
        assert names.setdefault(word, found) == found
    assert len(set(names.values())) == len(names) == 977 * 13 and starts[0] == 0


def test_discounts_by_hand():
    """Y = n1 / (n1 + 2 n2); D1 = 1 - 2Y n2/n1, D2 = 2 - 3Y n3/n2, D3 = 3 - 4Y n4/n3."""
    # Y = 4 / 8
    assert kneser_ney.discounts([4, 2, 1, 1]).tolist() == pytest.approx([0, 0.5, 1.25, 1.0])
    # Y = 60 / 100
    assert kneser_ney.discounts([60, 20, 10, 6]).tolist() == pytest.approx([0, 0.6, 1.1, 1.56])
    # too few n-grams for the estimate, or one that leaves its range
    assert kneser_ney.discounts([3, 0, 0, 0]).tolist() == pytest.approx([0, 0.5, 0.75, 0.9])
    assert kneser_ney.discounts([1, 1, 9, 9]).tolist() == pytest.approx([0, 1 / 3, 0.05, 5 / 3])


def test_word_shards_do_not_grow_with_the_input(spark, monkeypatch):
    """More shards of bigrams than of words, and no block for a shard that gets no word."""
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 20)
    monkeypatch.setattr(kneser_ney, "WORD_SHARDS", 3)
    texts = ["a b a c a b", "b a", "c", "", "d e f g h i j k l"] * 20
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    model = kneser_ney.fit(docs)
    assert (model.shards, model.word_shards) == (8, 3) or model.shards > 8
    check(kneser_ney.score(docs, model).collect(), Brute(texts), lambda row: texts[row.doc_id])
