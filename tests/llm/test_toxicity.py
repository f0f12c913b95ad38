"""Lexicon matching and learning."""

import zlib

import pytest
from cases import LONG, ODD_ROWS, odd_documents
from skyledger.llm import queries, toxicity
from skyledger.llm.common import bucket_of

LEXICON = toxicity.Lexicon({toxicity.fold("idiot")[1]: 2.0, toxicity.fold("loser")[1]: 1.0,
                            "grum*": 3.0},
                           [toxicity.fold("useful idiot")[1]], of_weight=3.0)


@pytest.mark.parametrize(("text", "weight", "hits"), [
    ("You idiot!", 2, 1), ("1D10T", 2, 1), ("іdiоt", 2, 1), ("id​iot", 2, 1),
    ("ＩＤＩＯＴ", 2, 1), ("ïdîöt", 2, 1),
    ("ïdiot", 2, 1), ("idiots", 0, 0), ("grumbly grum", 6, 2), ("agrum", 0, 0),
    ("a useful idiot, idiot", 2, 1), ("useful\tidiot", 0, 0), ("l0ser!! lo$er", 2, 2),
    ("", 0, 0), ("idiot_idiot", 4, 2), ("(idiot)idiot", 4, 2)])
def test_matches(text, weight, hits):
    assert toxicity.Matcher(LEXICON).measure(text)[:2] == (weight, hits)


def test_same_weight_counts_less_in_a_longer_text():
    scores = [LEXICON.score(2.0, words) for words in (10, 100, 1000)]
    assert scores[0] > scores[1] > scores[2] > LEXICON.score(0.0, 10)


def sample(spark, noise=0):
    filler = [f"word{i}" for i in range(50)]
    rows = []
    for i in range(120):
        own = " ".join(filler[(i * k) % 50] for k in range(3, 20))
        bad = ["blurgh", f"snarl{'abcdefghijklmnop'[i % 16]}"][i % 2]
        good = f"brave {bad}" if i % 4 == 0 else filler[i % 7]
        rows.append((f"{own} {filler[i % 11]} {bad} {filler[i % 13]} {bad}", 1))
        rows += [(f"{own} {good} {filler[i % 17]}", 0)] * 3
    rows += [("only copies say zzyzx here", 1)] * 60
    return spark.createDataFrame(rows, "text string, y int")


def test_learns_words_stems_and_exceptions(spark):
    lexicon = toxicity.learn_lexicon(sample(spark))
    assert "snari*" in lexicon.weights or "snar*" in lexicon.weights
    assert not any(entry.startswith("zz") for entry in lexicon.weights)
    matcher = toxicity.Matcher(lexicon)
    assert lexicon.score(*matcher.measure("a SNARLQ b snаrlz")[::2]) > 0.5
    assert lexicon.score(*matcher.measure("nothing of note")[::2]) < 0.5


@pytest.mark.parametrize(("rows", "low", "high"), [
    ([], 0, 0.1), ([("a b", 0)], 0, 0.1), ([("a b", 1)], 0.9, 1)])
def test_without_labels_of_both_kinds(spark, rows, low, high):
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    assert lexicon.weights == {} and low <= lexicon.score(0.0, 3) <= high


def test_rows_of_any_kind(spark):
    rows = [*ODD_ROWS, (30, "idiot " + LONG), (31, "idiot"), (31, "idiot")]
    docs = odd_documents(spark, rows)
    found = toxicity.score(docs, LEXICON).collect()
    matcher = toxicity.Matcher(LEXICON)
    want = sorted(str((doc, LEXICON.score(*matcher.measure(text or "")[::2]))) for doc, text in rows)
    assert sorted(str((r.doc_id, r.score)) for r in found) == want
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found)
    kept = toxicity.drop_toxic(docs, LEXICON)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in found) < len(rows)
    assert toxicity.score(docs.limit(0), LEXICON).count() == 0
    assert toxicity.drop_toxic(docs.limit(0), LEXICON).count() == 0


def test_sample_takes_the_largest_label_and_no_null(spark):
    docs = odd_documents(spark, [(1, "a"), (2, "b"), (None, "c"), (3, None), (3, None)])
    labels = spark.createDataFrame(
        [(1, 0, "x"), (1, 1, "x"), (2, None, "x"), (None, 1, "x"), (3, 0, "x")],
        "doc_id bigint, toxic int, text string")
    found = toxicity.training_sample(docs, labels, "toxic", bucket_of("doc_id", 5) != 9)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(str, [("a", 1), (None, 0), (None, 0)]))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = queries.op9_toxicity(spark, sf).collect()
    assert len(found) == 1000
    assert {r.doc_id for r in found if r.held_out} == {
        r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    held = [r for r in found if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.9 * len(held)
    assert not [r for r in found if r.predicted and toxic.get(r.doc_id) == 0]


def naive_measure(lexicon, text):
    """Weight, matches and words by a search for every entry at every place."""
    clean, folded = toxicity.fold(text)
    entries = {e.removesuffix("*"): (w, e.endswith("*")) for e, w in lexicon.weights.items()}
    entries |= {phrase: (None, False) for phrase in lexicon.exceptions}
    hits, excused = [], []
    for plain, (weight, stem) in entries.items():
        at = folded.find(plain)
        while at >= 0:
            end = at + len(plain)
            if (at == 0 or not clean[at - 1].isalnum()) and (
                    stem or end == len(clean) or not clean[end].isalnum()):
                (excused if weight is None else hits).append((at, end, weight))
            at = folded.find(plain, at + 1)
    counted = [w for a, b, w in hits if not any(c <= a and b <= d for c, d, _ in excused)]
    return sum(counted), len(counted), len(clean.split())


def test_matches_equal_a_search_for_every_entry(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learnt = toxicity.learn_lexicon(toxicity.training_sample(
        docs, labels, "toxic", bucket_of("doc_id", 5) != 0))
    common = {"the": 0.5, "th*": 0.25, "ion": 1.0, "er*": 2.0, "of the": 1.5}
    made = toxicity.Lexicon({**learnt.weights, **common}, ["the of", "erthe er"])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    scored = {r.doc_id: r.score for r in toxicity.score(docs, learnt).collect()}
    matches = 0
    for doc, text in texts.items():
        for lexicon in (learnt, made):
            weight, count, words = naive_measure(lexicon, text)
            found = toxicity.Matcher(lexicon).measure(text)
            assert found == (pytest.approx(weight), count, words)
            matches += count
        weight, _, words = naive_measure(learnt, text)
        assert scored[doc] == pytest.approx(learnt.score(weight, words))
    assert matches > 500
