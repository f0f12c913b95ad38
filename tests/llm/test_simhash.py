"""SimHash against a plain count of bits and a comparison of all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from cases import LONG, ODD_ROWS, odd_documents
from skyledger.llm import components, queries, simhash


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_classes(fps):
    """Root of each fingerprint: its smallest reachable one."""
    fps = sorted(fps)
    array, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ array[i]) <= 2):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    return {fp: fps[find(i)] for i, fp in enumerate(fps)}


def signed(fp):
    return int(np.array([fp], np.uint64).view(np.int64)[0])


def crowd():
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    fps = set(base)
    for fp in base[:20]:
        for _ in range(20):
            for _ in range(draw.randint(1, 4)):
                fp ^= 1 << draw.randrange(64)
            fps.add(fp)
    return sorted(fps | {base[0] ^ draw.getrandbits(11) for _ in range(700)})


@pytest.mark.parametrize("largest", [4096, 40])
def test_classes_equal_a_comparison_of_all_pairs(spark, largest):
    fps = crowd()
    table = spark.createDataFrame([(signed(fp),) for fp in fps], "fp bigint")
    groups = {}
    for node, root in components.components(simhash.links(table, largest)).collect():
        groups.setdefault(root, set()).add(node)
    expected = {}
    for fp, root in brute_classes(fps).items():
        expected.setdefault(root, set()).add(signed(fp))
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(g) for g in expected.values() if len(g) > 1}


def test_bit_sliced_comparison_abandons_nothing_near():
    draw = np.random.default_rng(5)
    fps = draw.integers(0, 1 << 63, 130, np.uint64)
    fps[1::3] = fps[::3][:len(fps[1::3])] ^ (np.uint64(1) << np.uint64(63))
    fps[2::3] = fps[1::3][:len(fps[2::3])] ^ np.uint64(3)
    rows = simhash._adjacent(fps)
    lanes = np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")[:, :len(fps)]
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    linked = near.sum(axis=1) > 1  # a row without any other may be given up
    assert (lanes[linked].astype(bool) == near[linked]).all()


def test_rows_of_any_kind(spark):
    rows = [*ODD_ROWS, (9, LONG + " end"), (8, "one TWO three")]
    found = simhash.near_duplicates(odd_documents(spark, rows)).collect()
    fps = {text: brute_fingerprint(text) for _, text in rows}
    roots, least = brute_classes(set(fps.values())), {}
    for doc, text in rows:
        if doc is not None:
            root = roots[fps[text]]
            least[root] = min(least.get(root, doc), doc)
    expected = sorted(str((doc, f"{fps[text]:016x}", least.get(roots[fps[text]])))
                      for doc, text in rows)
    assert sorted(str(tuple(r)) for r in found) == expected


def test_one_row_of_each_class_stays(spark):
    docs = odd_documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(str((r.doc_id, r.text)) for r in kept.collect())
    assert got == sorted(map(str, [(1, None), (4, "another four"), (4, "one"),
                                   (5, "One  TWO\nthree"), (6, LONG)]))
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query_covers_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = {doc: brute_fingerprint(text) for doc, text in docs}
    roots, least = brute_classes(set(fps.values())), {}
    for doc, fp in fps.items():
        least[roots[fp]] = min(least.get(roots[fp], doc), doc)
    got = {tuple(r) for r in queries.op3_simhash(spark, sf_dir).collect()}
    assert got == {(doc, f"{fp:016x}", least[roots[fp]]) for doc, fp in fps.items()}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)]
    edges += [(200, 200), (301, 300), (300, 301), (-5, 7), (5000, -9), (-9, 4000)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    found = dict(map(tuple, components.components(table).collect()))
    assert all(found[i] == -5 for i in range(61)) and found[-5] == -5
    assert all(found[i] == 100 for i in range(100, 180)) and 200 not in found
    assert found[301] == found[300] == 300 and found[5000] == found[4000] == found[-9] == -9
