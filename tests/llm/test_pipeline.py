"""Each stage of the pipeline against a brute-force version on its own input."""

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from cases import odd_documents
from skyledger.llm import suffix_dedup, toxicity
from skyledger.llm.common import bucket_of, materialize, read_table
from test_decontamination import brute as brute_leaks
from test_near_copies import brute_kept
from test_suffix_dedup import brute as brute_windows
from test_suffix_dedup import words
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Input and output rows of each stage."""
    docs, found = read_table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        found[name] = (docs, out)
        docs = out
    return found


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_all_stages_but_the_last_keep_the_columns(steps):
    assert list(steps) == ["toxicity", "simhash", "passages", "benchmark", "tokens"]
    for name in list(steps)[:-1]:
        docs, out = steps[name]
        assert out.dtypes == docs.dtypes


def test_toxicity(spark, sf_dir, steps):
    docs, out = steps["toxicity"]
    lexicon = toxicity.learn_lexicon(toxicity.training_sample(
        docs, read_table(spark, sf_dir, "labels"), "toxic", bucket_of("doc_id", 5) != 0))
    matcher = toxicity.Matcher(lexicon)
    clean = [p for p in pairs(docs) if lexicon.score(*matcher.measure(p[1])[::2]) < 0.5]
    assert sorted(pairs(out)) == sorted(clean)


def test_simhash(steps):
    """The stage keeps one text of those that share 0.8 of their five-word shingles."""
    docs, out = steps["simhash"]
    assert sorted(doc for doc, _ in pairs(out)) == brute_kept(pairs(docs))
    assert out.count() < docs.count()


def test_passages(steps):
    docs, out = steps["passages"]
    cut = {}
    for doc, _, at, _, first in brute_windows(pairs(docs)):
        if not first:
            cut.setdefault(doc, set()).update(range(at, at + suffix_dedup.LENGTH))
    want = [(doc, [w for i, w in enumerate(words(text)) if i not in cut.get(doc, ())])
            for doc, text in pairs(docs)]
    assert cut and sorted((doc, words(text)) for doc, text in pairs(out)) == sorted(
        (doc, left) for doc, left in want if left)
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_benchmark(spark, sf_dir, steps):
    docs, out = steps["benchmark"]
    items = [(r.item_id, r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]
    hit = brute_leaks(pairs(docs), items)
    assert sorted(pairs(out)) == sorted(p for p in pairs(docs) if not hit[p][-1])
    assert len(pairs(out)) < len(pairs(docs))


def test_tokens(spark, sf_dir, steps):
    docs, out = steps["tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc, text in pairs(docs):
        ids = library.encode(text, add_special_tokens=False).ids
        joined = ",".join(map(str, ids))
        want.append((doc, len(ids), *(hashlib.sha256(x.encode()).hexdigest()
                                      for x in (joined, text))))
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_run_is_all_stages(spark, sf_dir, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(
        map(tuple, steps["tokens"][1].collect()))


def test_rows_of_any_kind_and_an_empty_table(spark, sf_dir):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, docs, sf_dir), f"odd-{name}")
            assert out.count() <= rows
            if name != "tokens":
                assert out.columns == docs.columns
            docs = out
