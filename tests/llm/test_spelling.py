"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from cases import ODD_ROWS, odd_documents
from skyledger.llm import queries, spelling

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    counts = brute_counts(docs)
    # words one edit apart have an equal first or an equal second half, give or take a letter
    meet = defaultdict(set)
    for word in counts:
        half = len(word) // 2
        for cut in (half - 1, half, half + 1):
            meet["a", word[:cut]].add(word)
            meet["z", word[cut:]].add(word)
    friends = defaultdict(set)
    for group in meet.values():
        group = sorted(group)
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if abs(len(a) - len(b)) < 2 and b not in friends[a] and near(a, b):
                    friends[a].add(b)
                    friends[b].add(a)
    form = {}
    for word, n in counts.items():
        best = min(((-counts[f], f) for f in friends[word]), default=None)
        form[word] = best[1] if best and -best[0] >= 5 * n else None
    found = set()
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        found.add((word, form[word], root, n, len(friends[word]), counts.get(form[word])))
    return found


def rows(df):
    found = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def fixture_rows():
    draw = random.Random(12)
    words = ["Letters", "letterß", "lettters", "léttèrs", "aaaaaaa", "aaaaaaaa", "abababab",
             "ÀÿÀÿÀÿÀ", "strassen", "strasse", "zzzzzz"]
    for _ in range(60):
        word = "".join(draw.choices("abcdö", k=draw.randint(6, 9)))
        words += [word, word[1:] + "x", word[:3] + "q" + word[4:], word[:2] + word[1:]]
    chain = ["chainword", "chainworp", "chainwarp", "chainwaxp"]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 200))) for _ in range(40)]
    for i, word in enumerate(chain):  # several documents, since each may damage the word
        texts += [" ".join([word] * 6 ** i)] * 7
    texts += ["tie-alphabe, tie-betalph. " * 5, "under_score12letters " * 9, "x" * 3000 + " y",
              *["l" * 300 + "m" * 300] * 6, *["l" * 300 + "m" * 299] * 5, "日本語letters𝒜letters"]
    return [(i * 37, text) for i, text in enumerate(texts)] + [(None, "nulltext nulltext " * 4)]


def test_equals_all_pairs(spark):
    docs = [*fixture_rows(), *ODD_ROWS, *[(n, "Repeated rows") for n in [9] * 7]]
    found = rows(spelling.variants(odd_documents(spark, docs).repartition(6)))
    assert found == brute(docs)
    assert any(form and root != form for _, form, root, *_ in found)


def test_parts_of_the_vocabulary(spark, monkeypatch):
    docs = fixture_rows()
    monkeypatch.setattr(spelling, "FILTER_BYTES", 256)
    monkeypatch.setattr(spelling, "COUNTED", 50)
    assert rows(spelling.variants(odd_documents(spark, docs))) == brute(docs)


def test_pieces_of_long_words(monkeypatch):
    monkeypatch.setattr(spelling, "TESTED", 200)
    filters = spelling.Filters({6: 2, 7: 1, 48: 1}, 0, 1)
    words = {6: ["abcdef", "abbdef"], 7: ["abbcdef"]}
    for shard, blocks in filters.blocks.items():
        table = filters.slots[shard] = np.zeros(blocks * spelling.BLOCK, np.uint64)
        for word in words.get(shard, []):
            hashes = spelling._mixed(spelling._sums(spelling._letters([word])), len(word))
            for bit in range(spelling.BITS_SET):
                slot, shift = spelling._bit(*spelling._places(hashes, blocks), bit)
                table[slot[0]] |= np.uint64(1) << shift[0]
    import pyarrow as pa

    class Held:
        value = filters

    batch = pa.RecordBatch.from_pydict({
        "word": ["abbcdef", "abbdef", "abcdef", "ab" * 40], "n": [1, 2, 3, 4]})
    found = {(r["word"], r["edit"]) for out in spelling._search(Held)([batch])
             for r in out.to_pylist()}
    assert {("abbcdef", "abcdef"), ("abbcdef", "abbdef"), ("abbdef", "abcdef")} <= found
    assert ("abcdef", "abbdef") not in found


def test_empty_table(spark):
    assert spelling.variants(odd_documents(spark).limit(0)).count() == 0


def test_query_covers_every_document(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]
    assert rows(queries.op12_spelling(spark, sf_dir)) == brute(docs)
