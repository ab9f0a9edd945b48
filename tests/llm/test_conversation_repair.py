"""Conversation repair against a plain search over all edits, with long, odd and empty conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from hourloom.llm import conversation_repair as repair
from hourloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, kind long, copies long, edit string, audit string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def cheapest_by_search(symbols):
    """Dijkstra-free plain search: extend every partial edit row by row, keep all that could still win."""
    best = None
    n = len(symbols)

    def grow(i, roles, cost, audit, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if not re.match(r"(s?(ua)*u?)\Z", roles):
            return
        if i == n and LEGAL.match(roles):
            best = min(best or (cost, audit), (cost, audit))
        if inserted < 2:
            for r in "ua":
                grow(i, roles + r, cost + 2, audit + "I", inserted + 1)
        if i < n:
            s = symbols[i]
            extra = int(s.isupper())
            if s != "d":
                grow(i + 1, roles + s.lower(), cost + extra, audit + "K", 0)
                for r in "ua":
                    grow(i + 1, roles + r, cost + 2 + extra, audit + "R", 0)
            grow(i + 1, roles, cost + 3, audit + "D", 0)

    best = (3 * n, "D" * n)
    grow(0, "", 0, "", 0)
    return best


@pytest.mark.parametrize("length", range(5))
def test_charts_find_the_cheapest_edits(length):
    rng = random.Random(length)
    every = ["".join(s) for s in itertools.product("dsuaoUA", repeat=length)]
    for symbols in every if len(every) < 400 else rng.sample(every, 250):
        assert repair.cheapest(repair.parse(symbols)) == cheapest_by_search(symbols), symbols


def test_doubling_spans_give_the_full_chart():
    rng = random.Random(5)
    for n in (0, 1, 8, 9, 17, 31, 40):
        symbols = "".join(rng.choice("dsuauauaoSUAO") for _ in range(n))
        spans = repair.Spans()
        for i in range(0, n, repair.LEAF):
            spans.push(repair.parse(symbols[i:i + repair.LEAF]))
        assert spans.cell() == repair.parse(symbols)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def by_plain_python(rows):
    want = {}
    left = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in left if r[0] == conv), key=lambda r: (
            r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, _, _ in mine if t is not None}
        faults, seen = [], set()
        for _, role, text in mine:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen
                          else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in mine]
        symbols = "".join("d" if f in ("blank", "duplicate") else (i if i in ("s", "u", "a") else "o").upper() if f
                          else i if i in ("s", "u", "a") else "o" for i, f in zip(initials, faults))
        cost, audit = cheapest_by_search(symbols) if len(symbols) < 9 else repair.cheapest(repair.parse(symbols))
        lines, source = [], iter(mine)
        length = len(audit) - audit.count("D")
        for edit in audit:
            _, role, text = next(source) if edit != "I" else (None, None, "")
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if (len(lines) - length % 2) % 2 else "user"
            lines.append(f"{role}:{text}")
        want[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
                      faults.count("duplicate"), faults.count("truncated"),
                      sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                      hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return want


def got_of(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in rows}


def test_odd_conversations_match_plain_python(spark):
    rng = random.Random(11)
    rows = [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b."), (1, None, "user", None),
            (1, None, "user", "x."), (2, 5, "", ""), (3, 0, "tool", " "), (3, 1, "User", "ok!\n"),
            (4, 0, "system", "s."), (4, 0, "system", "s."), (4, 9, "assistant", "long " * 50_000 + "."),
            (4, 7, "user", "é?\x85")]
    rows += [(c, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]),
              rng.choice(["Yes.", "No!", "maybe", "", " ", "Why?", f"{t}."]))
             for c in range(10, 90) for t in range(rng.randint(0, 6))]
    rows += [(500, t, "user" if t % 2 else "assistant", f"turn {t}" + "." * (t % 3)) for t in range(60)]
    # a conversation that holds most rows, over many ranges
    rows += [(600, t // 2, rng.choice(["user", "assistant"]), f"{t}.") for t in range(120)]
    table = spark.createDataFrame([(*r, 0, 9, "K", "x") for r in rows], SCHEMA).repartition(8)
    assert got_of(repair.repair_digests(repair.damage(table))) == by_plain_python(rows)


def test_long_conversation_over_many_ranges(spark):
    n = 40_000
    rows = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
                                     "concat(id, '.') AS text").repartition(8)
    got = repair.repair_digests(rows).collect()
    text = "\n".join(f"{'assistant' if i % 2 else 'user'}:{i}." for i in range(n))
    assert [(r.conv_id, r.cost, r.audit) for r in got] == [(7, 0, "K" * n)]
    assert got[0].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_repaired_rows_are_legal_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = repair.repaired_rows(repair.damage(table)).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.position)):
        found.setdefault(r.conv_id, []).append(r.role[:1])
        assert r.edit in "KRI" and (r.text == "" or r.edit != "I")
    assert found and all(LEGAL.match("".join(v)) for v in found.values())


def test_empty_table_and_whole_table(spark):
    assert repair.repair_digests(repair.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    found = QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.01")
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    assert got_of(found) == by_plain_python([(r.conv_id, r.turn, r.role, r.text) for r in rows])
