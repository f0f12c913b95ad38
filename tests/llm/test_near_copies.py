"""Near copies against a comparison of all pairs of shingle sets."""

import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from cases import LONG, ODD_ROWS, odd_documents
from pyspark.sql import Window
from pyspark.sql import functions as F
from skyledger.llm import near_copies


def brute_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def brute_kept(rows):
    """The smallest doc_id of each class; every row has one."""
    sets, root = [brute_set(text) for _, text in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(least.values())


def edited():
    """Texts with edits that leave similarities around 0.8, chains of them, and a common line."""
    draw, rows = random.Random(7), []
    common = " ".join(f"line{i}" for i in range(30))
    for family in range(12):
        words = [f"f{family}w{draw.randrange(400)}" for _ in range(draw.choice([6, 40, 150, 300]))]
        for _ in range(9):
            rows.append((len(rows), " ".join(words) + (f" {common}" if family % 2 else "")))
            if draw.random() < 0.3:
                words = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 45))):
                words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return rows


@pytest.mark.parametrize(("frequent", "large"), [(8, 4096), (2, 2), (10**6, 3), (10**6, 4096)])
def test_stage_equals_a_comparison_of_all_pairs(spark, sf_dir, monkeypatch, frequent, large):
    monkeypatch.setattr(near_copies, "FREQUENT", frequent)
    monkeypatch.setattr(near_copies, "LARGE", large)  # workers take it from the closure's module
    rows = edited()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash"]
    want = brute_kept(rows)
    assert sorted(r.doc_id for r in stage(spark, docs, sf_dir).collect()) == want
    assert 12 < len(want) < len(rows)


def test_fingerprints_that_link_are_near_copies_by_themselves(spark, sf_dir, monkeypatch):
    """Without any pair found by its shingles; equal fingerprints of unlike texts are no copies."""
    def no_pairs(stars):
        return lambda batches: (
            pa.RecordBatch.from_pydict({c: pa.array([], pa.int64()) for c in ("a", "b")})
            for _ in batches)

    words = [f"w{i}" for i in range(600)]
    texts = [" ".join(words), " ".join([*words[:300], "new", *words[301:]]), "some other text",
             " ".join(words[::-1])]
    a, b, *others = (near_copies.fingerprint(near_copies.shingles(text)) for text in texts)
    assert 0 < ((a ^ b) % 2 ** 64).bit_count() <= 2
    assert all(((a ^ c) % 2 ** 64).bit_count() > 2 for c in others)
    monkeypatch.setattr(near_copies, "_pairs", no_pairs)
    docs = spark.createDataFrame(enumerate(texts), "doc_id bigint, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash"]
    assert sorted(r.doc_id for r in stage(spark, docs, sf_dir).collect()) == [0, 2, 3]


def test_links_decide_nothing_that_the_sets_do_not(spark, sf_dir, monkeypatch):
    rows = edited()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def any_two(fps):
        return fps.select(F.col("fp").alias("a"), F.lag("fp").over(Window.orderBy("fp")).alias("b")).where(
            "b is not null")

    monkeypatch.setattr(near_copies, "links", any_two)
    assert sorted(r.doc_id for r in near_copies.keep_one(docs).collect()) == brute_kept(rows)


def test_documents_of_the_test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = near_copies.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_rows_of_any_kind(spark):
    docs = odd_documents(spark, [*ODD_ROWS, (9, LONG + " end")])
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, [
        (1, None), (4, "another four"), (4, "one"), (5, "One  TWO\nthree"), (6, LONG)]))
    assert near_copies.keep_one(docs.limit(0)).count() == 0


def judged(a, b):
    size_a, size_b = near_copies.fine_size(len(a)), near_copies.fine_size(len(b))
    return near_copies.judged(len(a), near_copies.parity(a, size_a).tobytes(),
                              len(b), near_copies.parity(b, size_b).tobytes())


@pytest.mark.parametrize("size", [0, 1, 5, 60, 300, 2000, 20_000])
def test_bitmaps_decide_only_what_is_sure(size):
    draw, told = np.random.default_rng(size), []
    for part in (0, 0.02, 0.05, 0.08, 0.1, 0.11, 0.112, 0.12, 0.2, 0.5):
        for _ in range(5):
            a = np.unique(draw.integers(0, 2 ** 63, size, dtype=np.uint64))
            cut = int(part * len(a))
            new = np.unique(draw.integers(0, 2 ** 63, cut, dtype=np.uint64))
            b = np.sort(np.concatenate([a[cut:], new]))
            if size and draw.random() < 0.3:
                b = b[:max(1, int(len(b) * draw.uniform(0.7, 1)))]
            verdict = judged(a, b)
            told.append(verdict)
            assert verdict in (None, near_copies.similar(a, b))
    if size >= 300:
        assert True in told and False in told


def test_runs_by_hand(monkeypatch):
    rows = [(1, 5), (2, 5), (2, 6), (2, 6), (3, 5), (3, 6), (4, 7), (5, 5), (5, 6), (5, 7), (6, 1)]
    hashes, names = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
    batch = pa.RecordBatch.from_arrays([hashes, names], names=["hash", "name"])
    for waiting, pieces in ((4096, 1), (4096, 4), (2, 3)):
        monkeypatch.setattr(near_copies, "LARGE", waiting)
        found = {}
        for out in near_copies._runs(batch.slice(i, pieces) for i in range(0, len(rows), pieces)):
            for row in out.to_pylist():
                found.setdefault(row["g"], set()).add(row["name"])
        # 2 and 3 have the same texts; the first and the last run may go on elsewhere
        assert sorted(map(sorted, found.values())) == [[1], [5], [5, 6], [5, 6, 7]]


def test_many_texts_with_one_shingle(spark):
    """A shingle of 50,000 texts is in no group of theirs, as it comes last in each."""
    common = "one two three four five"
    rows = [(i, f"{common} " + " ".join(f"w{i}x{j}" for j in range(12))) for i in range(50_000)]
    rows += [(60_000, rows[7][1]), (60_001, rows[9][1] + " x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert near_copies.keep_one(docs).count() == 50_000
