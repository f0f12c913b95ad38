"""Repeated passages against a table of all windows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from cases import LONG, ODD_ROWS, odd_documents
from skyledger.llm import queries, substring_dedup
from skyledger.llm.common import identified
from skyledger.llm.substring_dedup import NO_ID, WINDOW


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(docs):
    """(doc, text) to n_words, n_removed and digest; docs are (doc, key of the text, text)."""
    docs = sorted({(NO_ID if doc is None else doc, key, text or "") for doc, key, text in docs})
    seen, found = set(), {}
    for doc, _, text in docs:
        w = words(text)
        gone = set()
        for at in range(len(w) - WINDOW + 1):
            window = tuple(w[at:at + WINDOW])
            if window in seen:
                gone |= set(range(at, at + WINDOW))
            seen.add(window)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        found[doc, text] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def expected(df):
    """The result of every row of a table, as a sorted list."""
    rows = [(r.doc_id, r.text_key, r.text) for r in identified(df).collect()]
    known = brute(rows)
    return sorted((NO_ID if doc is None else doc, *known[NO_ID if doc is None else doc, text])
                  for doc, _, text in rows)


def result(df):
    return sorted((NO_ID if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                  for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def fixture_rows():
    draw = random.Random(11)
    some = lambda n: " ".join(draw.choices([f"v{i}" for i in range(200)], k=n))
    passages = [some(n) for n in (19, 20, 21, 22, 25, 34, 35, 40, 60, 150)]
    rows = [(1, None), (2, ""), (3, "x " * 19), (4, "Der " * 80), (5, "der " * 55), (6, "x " * 21)]
    for i in range(120):
        parts = []
        for _ in range(draw.randint(1, 4)):
            passage = draw.choice(passages).split()
            a = draw.randint(0, max(0, len(passage) - 18))
            parts += [some(draw.randint(0, 12)), " ".join(passage[a:a + draw.randint(17, 45)])]
        rows.append((draw.randint(0, 300), draw.choice([" ", "\n", " \t "]).join(parts)))
    whole = some(90)
    rows += [(200, whole), (201, whole), (202, whole.upper()), (203, whole + " end"),
             (203, whole + " end"), (None, whole), (None, some(5) + " " + whole), (None, whole),
             (7, some(30) + " " + whole), (7, whole + " " + some(30))]
    rows += [(400 + i, some(draw.randint(1, 200))) for i in range(20)]
    return rows


def test_equals_a_table_of_all_windows(spark):
    docs = odd_documents(spark, [*fixture_rows(), *ODD_ROWS]).repartition(5)
    assert result(substring_dedup.repeated_passages(docs)) == expected(docs)


def test_index_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "INDEX_ROWS", 7)
    monkeypatch.setattr(substring_dedup, "TASK_WINDOWS", 50)
    docs = odd_documents(spark, fixture_rows()).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        assert result(substring_dedup.repeated_passages(docs)) == expected(docs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_factors_stand_earlier(spark):
    rows = [row for row in fixture_rows() if row[0] is not None]
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(words(text))
    rows = [(doc, text) for doc, text in rows if len(texts[doc]) == 1]
    docs = odd_documents(spark, rows)
    found = substring_dedup.repeated_passages(docs).collect()
    by_id = {doc: words(text) for doc, text in rows}
    for row in found:
        gone = set()
        for f in row.factors:
            assert f.length >= WINDOW
            assert (f.source_doc_id, f.source_start) < (row.doc_id, f.start)
            own = by_id[row.doc_id][f.start:f.start + f.length]
            assert own == by_id[f.source_doc_id][f.source_start:f.source_start + f.length]
            gone |= set(range(f.start, f.start + f.length))
        assert len(gone) == row.n_removed
    assert sum(len(row.factors) for row in found) > 50


def test_a_key_with_other_phrases_is_told(monkeypatch):
    """Twins by hand: keys 1 (one phrase), 2 (two phrases), 3 (one row)."""
    rows = [(0, 5, 1, 0, 0), (1, 7, 1, 0, 3), (1, 7, 2, 0, 3), (1, 7, 2, 0, 3), (2, 1, 1, 0, 9),
            (2, 1, 4, 0, 9), (2, 3, 2, 0, 5), (3, 3, 9, 9, 9), (4, 4, 4, 4, 4), (5, 5, 5, 5, 5)]
    names = ["key", "phrase", "doc", "text_key", "at"]
    columns = [np.array(c) for c in zip(*rows, strict=True)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
    for size in (1, 2, 3, 100):
        monkeypatch.setattr(substring_dedup, "INDEX_ROWS", size)
        pieces = (batch.slice(i, size) for i in range(0, len(rows), size))  # noqa: B023
        told = [tuple(r.values()) for out in substring_dedup._twins(pieces)
                for r in out.to_pylist()]
        # the first and the last row may go on in another block
        assert {(d, a, s if f >= 0 else None) for d, _, a, s, f in told} == {
            (1, 0, None), (2, 3, 1), (1, 9, None), (4, 9, 1), (2, 5, None), (5, 5, None)}


def test_long_texts_and_empty_tables(spark):
    docs = odd_documents(spark, [(6, LONG), (7, LONG), (7, LONG), (8, "a b " * 30_000)])
    assert result(substring_dedup.repeated_passages(docs)) == expected(docs)
    assert substring_dedup.repeated_passages(docs.limit(0)).count() == 0


def test_query_covers_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(queries.op11_substring_dedup(spark, sf_dir)) == expected(docs)
