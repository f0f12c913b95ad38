"""Repeated passages against a table of all windows."""

import random
import re

import numpy as np
import pyarrow.fs as fs
import xxhash
from cases import LONG, odd_documents
from pyspark.sql import functions as F
from skyledger.llm import hashing, queries, suffix_dedup

SIZE = suffix_dedup.LENGTH


def words(text):
    return [w.encode().lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def text_key(text):
    key = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return key - (key >> 63 << 64)


def brute(docs):
    """(doc, start, first doc, is first) of every repeated window; null ids come first."""
    low = suffix_dedup.NO_ID
    places = {}
    for doc, text in docs:
        w, key = words(text), text_key(text)
        for at in range(len(w) - SIZE + 1):
            places.setdefault(tuple(w[at:at + SIZE]), set()).add(
                (low if doc is None else doc, key, at))
    found = set()
    for group in places.values():
        first = min(group)
        found |= {(doc, key, at, first[0], (doc, key, at) == first) for doc, key, at in group
                  if len(group) > 1}
    return found


def windows(rows):
    low = suffix_dedup.NO_ID
    ids = lambda doc: low if doc is None else doc
    return {(ids(r.doc_id), r.text_key, r.start + i, ids(r.first_doc_id), r.is_first)
            for r in rows for i in range(r.length - SIZE + 1)}


def spans_of(docs):
    """Every span with the hash of its text."""
    return suffix_dedup.repeated_spans(docs).select(
        "doc_id", "text_key", F.inline("spans")).collect()


def fixture_rows():
    draw = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    some = lambda n: " ".join(draw.choices(vocabulary, k=n))
    passages = [some(n) for n in (49, 50, 51, 60, 74, 120)]
    rows = [(1, None), (2, ""), (3, "x " * 49), (4, "Der " * 80), (5, "der " * 55)]
    for i in range(60):
        parts = [some(draw.randint(0, 30)), draw.choice(passages), some(draw.randint(0, 30))]
        rows.append((10 + i, " ".join(parts)))
    whole = some(90)
    rows += [(200, whole), (201, whole), (202, whole.upper()), (203, whole + " end"),
             (203, whole + " end"), (None, whole), (204, some(10) + "\n" + whole)]
    rows += [(300 + i, some(draw.randint(1, 200))) for i in range(20)]
    return rows


def test_equals_a_table_of_all_windows(spark):
    rows = fixture_rows()
    found = spans_of(odd_documents(spark, rows))
    assert windows(found) == brute(rows)
    assert all(r.length >= SIZE for r in found)


def test_suffixes_split_over_tasks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TASK_WINDOWS", 50)
    monkeypatch.setattr(suffix_dedup, "SHARD_WINDOWS", 400)
    rows = fixture_rows()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        found = spans_of(odd_documents(spark, rows).repartition(9))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert windows(found) == brute(rows)


def test_only_the_earliest_place_keeps_a_passage(spark):
    rows = fixture_rows()
    docs = odd_documents(spark, rows)
    kept = suffix_dedup.cut_repeats(docs)
    assert kept.columns == docs.columns
    out = [(r.doc_id, r.text) for r in kept.collect()]
    cut = {}
    for doc, key, at, _, first in brute(rows):
        if not first:
            cut.setdefault((None if doc == suffix_dedup.NO_ID else doc, key), set()).update(
                range(at, at + SIZE))
    expected = []
    for doc, text in rows:
        w = words(text)
        left = [x for i, x in enumerate(w) if i not in cut.get((doc, text_key(text)), ())]
        if left or not w:
            expected.append((doc, left))
    assert sorted(map(str, ((doc, words(text)) for doc, text in out))) == sorted(
        map(str, expected))
    same = {(doc, text) for doc, text in rows if (doc, text_key(text)) not in cut}
    assert same <= set(out)


def test_cut_keeps_the_rest_of_the_text():
    text = "  a b\tc\n\nd  e f\n"
    assert suffix_dedup.cut_text(text, [(1, 2)]) == "  a d  e f\n"
    assert suffix_dedup.cut_text(text, [(0, 2), (1, 1), (5, 1)]) == "  c\n\nd  e "
    assert suffix_dedup.cut_text(text, [(0, 6)]) == "  "
    assert suffix_dedup.cut_text(text, []) == text


def test_very_long_and_empty_tables(spark):
    docs = odd_documents(spark, [(6, LONG), (7, LONG), (7, LONG)])
    assert windows(spans_of(docs)) == brute([(6, LONG), (7, LONG)])
    assert suffix_dedup.passages(docs.limit(0)).count() == 0
    assert suffix_dedup.cut_repeats(docs.limit(0)).count() == 0


def test_query_covers_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op1_suffix_dedup(spark, sf_dir)
    named = {doc: text_key(text) for doc, text in docs}
    assert {(r.doc_id, named[r.doc_id], r.start + i, r.first_doc_id, r.is_first)
            for r in found.collect() for i in range(r.length - SIZE + 1)} == brute(docs)


def test_texts_that_share_an_id_repeat_each_other(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    for doc in (7, None):
        rows = [(doc, shared + " a b"), (doc, shared + " c d e")]
        found = spans_of(odd_documents(spark, rows))
        assert sorted((r.start, r.length, r.is_first) for r in found) == [
            (0, 60, False), (0, 60, True)]
        assert windows(found) == brute(rows)


def test_shards_off_a_mount_stay_within_a_bound(tmp_path, monkeypatch):
    """Look-ups through a file system that cannot be mapped, with room for two shards of eight."""
    draw = np.random.default_rng(3)
    keys = np.unique(draw.integers(3, 2 ** 63, 4000, dtype=np.uint64))
    places = np.zeros(len(keys), suffix_dedup.PLACE)
    places["doc"], places["at"] = np.arange(len(keys)), np.arange(len(keys)) % 7
    home = suffix_dedup._home(keys, 8)
    for shard in range(8):
        hashing.write_table(str(tmp_path), f"windows-{shard}", keys[home == shard],
                            places[home == shard])
    table = suffix_dedup.Table(str(tmp_path), 8)
    wanted = np.concatenate([keys[::3], keys[:50] + np.uint64(1)])
    mounted = suffix_dedup._Lookup(table).first_places(wanted)
    away = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(hashing, "filesystem", lambda folder: (away, ""))
    shard_bytes = max(28 * int((home == shard).sum()) for shard in range(8))
    monkeypatch.setattr(hashing, "CACHED_BYTES", 2 * shard_bytes)
    lookup = suffix_dedup._Lookup(table)
    for _ in range(2):
        found = lookup.first_places(wanted)
        assert (found[0] == mounted[0]).all() and (found[1] == mounted[1]).all()
        assert len(lookup._shards._known) <= 3 and lookup._shards._held <= 2 * shard_bytes
    assert found[0].sum() == len(keys[::3])


def test_a_text_is_cut_once(spark):
    """One Python step in the plan: none more for the filter behind it."""
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage), (2, "new " + passage), (3, passage)],
                                 "doc_id bigint, text string")
    kept = suffix_dedup.cut_repeats(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(map(tuple, kept.collect())) == [(1, passage), (2, "new ")]
