"""Winnowing against a search for every window."""

import hashlib
import random
import re

import pytest
from cases import ODD_ROWS, odd_documents
from skyledger.llm import decontamination


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        windows += [(item, tuple(w[i:i + size])) for i in range(len(w) - size + 1) if w]
    found = {}
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, window in windows:
            for start in range(len(w) - len(window) + 1):
                if tuple(w[start:start + len(window)]) == window:
                    hit |= set(range(start, start + len(window)))
                    ids |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        found[doc, text or ""] = (len(w), len(hit), len(ids), digest, bool(hit))
    return found


def run(spark, docs, items):
    table = spark.createDataFrame(
        [(*i, "x", 1) for i in items], "item_id bigint, text string, words string, size int")
    rows = decontamination.decontaminate(odd_documents(spark, docs), table).collect()
    assert len(rows) == len(docs)
    return rows


@pytest.fixture(scope="module")
def fixture():
    draw = random.Random(11)
    vocabulary = ["a", "b", "The", "ñu", "x1", "of", "9"]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(draw.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(100, "one"), (101, items[0][1]), (None, "one two three"), (7, ""), (8, None),
              (9, "...!"), (20, " ".join(["same"] * 30))]
    docs = list(ODD_ROWS)
    for i in range(60):
        text = some(draw.randint(0, 40))
        if i % 2:
            copy = words(draw.choice(items)[1])
            at = draw.randint(0, len(text))
            text[at:at] = copy
        docs.append((1000 + i, draw.choice([" ", "\n", ", ", "-"]).join(text)))
    docs.append((2000, "SAME, same " * 9))
    return docs, items


def test_equals_a_search_for_every_window(spark, fixture):
    docs, items = fixture
    rows = run(spark, docs, items)
    short = [(doc, text or "") for doc, text in docs if len(text or "") < 9_000]
    expected = brute(short, items)
    long = [r for r in rows if r.n_words > 9_000]
    got = sorted(map(str, ((r.doc_id, *tuple(r)[2:]) for r in rows if r.n_words <= 9_000)))
    assert got == sorted(map(str, ((doc, *expected[doc, text]) for doc, text in short)))
    assert len(long) == 3


def test_large_benchmarks_are_joined_by_shuffling(spark, fixture, monkeypatch):
    docs, items = fixture
    want = sorted(map(str, map(tuple, run(spark, docs, items))))
    monkeypatch.setattr(decontamination, "SENT_WINDOWS", 0)
    assert sorted(map(str, map(tuple, run(spark, docs, items)))) == want


def test_empty_tables(spark):
    rows = run(spark, [(1, "a b c"), (2, None)], [])
    assert [(r.n_hit, r.n_items, r.contaminated) for r in rows] == [(0, 0, False)] * 2
    assert run(spark, [], [(1, "a b c")]) == []


def test_drops_contaminated_rows_whole(spark):
    docs = odd_documents(spark, [(1, "x one two y"), (2, "one"), (None, "one two"), (2, "one")])
    items = spark.createDataFrame([(5, "One two")], "item_id bigint, text string")
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "one"), (2, "one")]


def test_a_document_that_stands_there_often(spark, monkeypatch):
    docs = [(1, "x one two three y")] * 9000 + [(None, None)] * 5000 + [(2, "other")]
    rows = run(spark, docs, [(5, "one two three")])
    assert sorted(str((r.doc_id, r.n_hit)) for r in rows) == sorted(
        str((doc, 3 if doc == 1 else 0)) for doc, _ in docs)
