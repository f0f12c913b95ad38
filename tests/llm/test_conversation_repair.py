"""Repaired conversations against a search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from skyledger.llm import conversation_repair, queries
from skyledger.llm.conversation_repair import Survivors

EMPTY = hashlib.sha256().hexdigest()


def damaged(rows):
    """The rows after damage, by the words of the contract."""
    out = []
    for conv, turn, role, text in rows:
        said = [" " if x is None else x for x in (conv, turn, role, text)]
        hit = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
        role, text = said[2:]
        if hit == 4:
            role = "user"
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def order(row):
    _, turn, role, text = row
    key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, key)


def best_edits(rows):
    """(cost, audit, repaired) of the cheapest, then least, edits; rows are (role, text, fault)."""
    following = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def rest(at, state, inserted):
        found = []
        if at == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 2:
            for initial in following[state]:
                if initial in name:
                    cost, audit, kept = rest(at, initial, inserted + 1)
                    found.append((cost + 3, "I" + audit, ((name[initial], ""), *kept)))
        if at < len(rows):
            role, text, fault = rows[at]
            cost, audit, kept = rest(at + 1, state, 0)
            found.append((cost + 4, "D" + audit, kept))
            extra = 3 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                for initial in following[state]:
                    cost, audit, kept = rest(at + 1, initial, 0)
                    if role[:1] == initial:
                        found.append((cost + extra, "K" + audit, ((role, text), *kept)))
                    if initial in name:
                        found.append((cost + extra + 3, "R" + audit, ((name[initial], text), *kept)))
        return min(found, default=(10 ** 9, "", ()))

    return rest(0, "", 0)


def brute(rows):
    """The report of each conversation."""
    found = {}
    after = damaged(rows)
    for conv in {row[0] for row in rows}:
        talk = sorted((r for r in after if r[0] == conv), key=order)
        seen, faults = set(), []
        for _, _, role, text in talk:
            bare = text.rstrip(" \t\n\x0b\f\r")
            if not bare:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {r[1] for r in talk} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(talk, talk[1:], strict=False)]
        cost, audit, kept = best_edits([(r[2], r[3], f) for r, f in zip(talk, faults, strict=True)])
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]


def collected(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def table(spark, rows):
    rows = [(*row, "x", 1, True) for row in rows]
    return spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string, key string, copies int, "
              "again boolean")


def fixture_rows():
    draw = random.Random(13)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Yes. ", "Ünïc ödé.", "So "]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "umpire"]
    rows = []
    for conv in [*range(200), None]:
        size = draw.randint(1, 9)
        for turn in range(size):
            role = ["user", "assistant"][turn % 2] if draw.random() < 0.7 else draw.choice(roles)
            at = draw.choice([turn, turn, turn, turn + 3, None, 0])
            rows.append((conv, at, role, draw.choice(texts)))
    rows += [(500, 0, "user", "a."), (500, 0, "user", "a."), (500, 0, "user", "a."),
             (501, None, "user", "b."), (501, None, "user", "b."), (501, 4, "user", "b.")]
    return rows


def test_equals_a_search_over_all_edits(spark):
    rows = fixture_rows()
    done = conversation_repair.reports(
        conversation_repair.damage(table(spark, rows).repartition(7)))
    assert collected(done) == brute(rows)


def test_dropped_and_empty(spark):
    turn = next(t for t in range(500) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    gone = table(spark, [(7, turn, "user", "x.")])
    assert collected(conversation_repair.reports(conversation_repair.damage(gone))) == {
        7: (0, 0, 0, 0, 0, 0, "", EMPTY)}
    none = conversation_repair.damage(gone.limit(0))
    assert conversation_repair.reports(none).count() == 0
    assert conversation_repair.repair(none).count() == 0


def test_edits_spell_the_report(spark):
    rows = fixture_rows()
    done = conversation_repair.repair(conversation_repair.damage(table(spark, rows))).collect()
    reports = {r.conv_id: r.report for r in done if r.report is not None}
    for conv, report in reports.items():
        edits = sorted((r for r in done if r.conv_id == conv and r.report is None),
                       key=lambda r: r.seq)
        assert "".join(r.edit for r in edits) == report.audit
        text = "\n".join(f"{r.role}:{r.text}" for r in edits if r.role is not None)
        assert hashlib.sha256(text.encode()).hexdigest() == report.repaired_sha256
        initials = "".join(r.role[0] for r in edits if r.role is not None)
        assert re.fullmatch("(s?(ua)+)?", initials)


@pytest.mark.parametrize("roles", ["ua", "uuaa", "su", "aaaaaaa", "uat"])
def test_few_edits_stay_undecided(roles):
    audit = []
    search = Survivors(lambda edit, turn: audit.append(edit))
    most = 0
    for i in range(20_000):
        role = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}[roles[i % len(roles)]]
        search.add(role, f"{i}.", i % 11 == 5, i % 7 == 3)
        most = max(most, search.undecided)
    search.end()
    assert most < 40 and sum(e != "I" for e in audit) == 20_000


def test_edits_that_the_end_decides():
    for size in (20_000, 20_001):
        audit = []
        search = Survivors(lambda edit, turn: audit.append(edit))  # noqa: B023
        for i in range(size):
            search.add("tool", f"{i}.", False, False)
        assert search.end() == 60_000 + 4 * (size % 2)
        assert "".join(audit) == "D" * (size % 2) + "R" * 20_000


def test_one_conversation_of_a_third_of_all_rows(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], ["Same.", f"t {i}."][i % 3 > 0])
            for i in range(3000)]
    rows += [(2 + i // 4, i % 4, ["user", "assistant"][i % 2], "Hello.") for i in range(6000)]
    done = collected(conversation_repair.reports(
        conversation_repair.damage(table(spark, rows).repartition(11))))
    expected = brute([r for r in rows if r[0] > 1])
    assert {k: v for k, v in done.items() if k > 1} == expected
    repeats = [r for r in damaged(rows) if r[0] == 1]
    blank = sum(not r[3].strip() for r in repeats)
    assert done[1][1:3] == (blank, len(repeats) - blank - len({r[2:] for r in repeats if r[3].strip()}))


def test_query_covers_every_conversation(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert collected(queries.op13_conversation_repair(spark, sf_dir)) == brute(rows)
