"""The rule ledger against plain counts; policies and ablations against the texts."""

import re
from collections import Counter

import pytest
from cases import LONG, ODD_ROWS, odd_documents
from skyledger.llm import quality_ledger as ledger

ROWS = [*ODD_ROWS, (20, "a b c a b c\n a b c \n\na b c\n#| x"), (21, "x x x x"), (22, "x x x"),
        (23, "Der " * 400), (24, "A!! B!! C!!"), (25, "\n\n \n"), (26, "é ÉÉ ñ 12 <%>"),
        (27, LONG + "\n" + LONG), (28, "a b\u0085c d\x1ce")]


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3)
               if windows[tuple(words[i:i + 3])] > 1}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in ledger.SYMBOLS for c in text), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_letters": sum(c.isalpha() for c in text),
        "n_capitals": sum(c.isupper() for c in text), "n_exclamations": text.count("!")}


def fails(m):
    conditions = {
        "few_words": m["n_words"] < 50, "repeated_words": m["n_repeat_words"] * 2 > m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "repeated_lines": 100 * m["n_dup_lines"] > 35 * m["n_lines"],
        "capitals": 100 * m["n_capitals"] > 40 * m["n_letters"],
        "exclamations": 10 * m["n_exclamations"] > m["n_words"],
        "word_length": not 3 * m["n_words"] <= m["word_chars"] <= 10 * m["n_words"],
        "few_letters": 100 * m["n_letters"] < 60 * m["word_chars"]}
    return {name for name, failed in conditions.items() if failed}


@pytest.fixture(scope="module")
def judged(spark):
    return ledger.judge(ledger.ledger(odd_documents(spark, ROWS))).collect()


def test_measures_and_bits(judged):
    got = sorted(str((r.doc_id, *(r[n] for n in ledger.MEASUREMENTS), r.fail_bits, r.base_failed,
                      r.kept)) for r in judged)
    want = []
    for doc, text in ROWS:
        m, failed = brute(text), fails(brute(text))
        base = bool(failed & {"few_words", "repeated_words"})
        want.append(str((doc, *(m[n] for n in ledger.MEASUREMENTS), ledger.mask_of(list(failed)),
                         base, not failed)))
    assert got == sorted(want)


@pytest.mark.parametrize("policy", sorted(ledger.POLICIES))
def test_policies_apply_to_the_bits(spark, policy):
    found = ledger.judge(ledger.ledger(odd_documents(spark, ROWS)), policy).collect()
    kept = sorted(str(doc) for doc, text in ROWS
                  if not fails(brute(text)) & set(ledger.POLICIES[policy]))
    assert sorted(str(r.doc_id) for r in found if r.kept) == kept


def test_ablations(spark):
    rows = ledger.ablations(ledger.ledger(odd_documents(spark, ROWS))).collect()
    failed = [fails(brute(text)) for _, text in ROWS]
    assert len(rows) == sum(map(len, ledger.POLICIES.values()))
    for r in rows:
        policy = set(ledger.POLICIES[r.policy])
        assert r.kept == sum(not f & policy for f in failed)
        assert r.failed == sum(r.rule in f for f in failed)
        assert r.only == sum(f & policy == {r.rule} for f in failed)


def test_empty_table(spark):
    found = ledger.ledger(odd_documents(spark).limit(0))
    assert ledger.judge(found).count() == 0
    assert {(r.kept, r.failed, r.only) for r in ledger.ablations(found).collect()} == {(0, 0, 0)}


def test_no_python_in_the_plan(spark, capsys):
    ledger.judge(ledger.ledger(odd_documents(spark))).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_verdicts_of_all_policies(spark):
    found = ledger.verdicts(ledger.ledger(odd_documents(spark, ROWS))).collect()
    names = {1 << rule.bit: rule.name for rule in ledger.RULES}
    for row in found:
        for policy, rules in ledger.POLICIES.items():
            assert row[f"kept_{policy}"] == (row.fail_bits & ledger.mask_of(rules) == 0)
        assert row.only_rule == names.get(row.fail_bits & ledger.mask_of(
            ledger.POLICIES[ledger.CURRENT]))
