"""Conversation repair against SQL, a plain search over all edits, and hot or odd conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from harness import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
GOOD = re.compile(r"(s?(ua)+)?\Z")


def judged(rows):
    """Initial and fault of each (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(letters):
    """Least (cost, audit) by a search over all edits, cheapest and least first."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, made = heapq.heappop(heap)
        # What was made matters by its last role only, and whether there is any.
        if (k, made[-1:]) in done:
            continue
        done.add((k, made[-1:]))
        if k == len(letters) and (not made or made[-1] == "a"):
            return cost, audit
        turn = "a" if made[-1:] == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", k, made + turn))
        if k == len(letters):
            continue
        initial, fault = letters[k]
        heapq.heappush(heap, (cost + 2, audit + "D", k + 1, made))
        if fault in ("blank", "duplicate"):
            continue
        more = 5 * (fault == "truncated")
        heapq.heappush(heap, (cost + 1 + more, audit + "R", k + 1, made + turn))
        if initial == turn or initial == "s" and not made:
            heapq.heappush(heap, (cost + more, audit + "K", k + 1, made + initial))


def repaired(rows, audit):
    out, rows = [], iter(rows)
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        role, text = next(rows) if edit != "I" else (None, "")
        if edit != "K":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    assert next(rows, None) is None
    return out


def expected(table):
    """The report of rows conv_id, turn, role, text, damaged as the task says."""
    kept = {}
    for conv, turn, role, text in table:
        rows = kept.setdefault(conv, [])
        blank = lambda v: " " if v is None else v
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    report = set()
    for conv, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = {t for t, _, _ in rows if t is not None}
        rows = [r[1:] for r in rows]
        letters = judged(rows)
        cost, audit = cheapest(letters)
        made = repaired(rows, audit)
        assert GOOD.match("".join(r[0] for r, _ in made))
        faults = [sum(f == name for _, f in letters) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(letters, letters[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        report.add((conv, gaps, *faults, illegal, cost, audit, digest))
    return report


def made_up(seed, n=60, longest=9):
    rng, table = random.Random(seed), []
    for conv in [None, *range(n)]:
        for turn in range(rng.randrange(1, longest)):
            turn = rng.choice([turn] * 8 + [None, turn + 3, 0])
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", "", None, "u"])
            text = rng.choice(["Yes.", "No", f"Text {rng.randrange(9)}.", " \t", "", None, "Oh! ", "same?", "same?\n", "é\U0001f600."])
            table.append((conv, turn, role, text))
    return table


letters = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=9)


@settings(max_examples=150, deadline=None)
@given(letters, st.lists(letters, max_size=4))
def test_grammar_gives_the_cheapest_least_audit(one, others):
    grammar = cr.Grammar()
    texts = ["".join(cr.letter_of(*x) for x in row) for row in [one, *others]]
    for _ in range(3):
        pairs = {p for t in texts for s in [grammar.symbols(t)] for p in zip(s, s[1:])}
        grammar.add(sorted(pairs)[:5])
    names = ["", "truncated", "blank", "duplicate"]
    ways = [{"before": i, "after": j, "cost": c, "audit": cr.text_of(a)} for (i, j), (c, a) in grammar.matrix(texts[0]).items()]
    conversation = cr._Conversation(0)
    conversation.add_piece(texts[0], None, None, 0, 0, 0, 0, 0, ways)
    conversation.settle()
    assert (conversation.cost, conversation.audit) == cheapest([("suat"[i], names[f]) for i, f in one])


@given(st.text("ab"), st.text("ab"), st.text("ab"), st.text("ab"))
def test_ropes_compare_as_strings(a, b, c, d):
    one, other = cr.joined(cr.joined(a, b), cr.joined(c, d)), cr.joined(a, cr.joined(cr.joined(b, d), c))
    assert cr.less(one, other) == (a + b + c + d < a + b + d + c) and cr.text_of(one) == a + b + c + d


@pytest.mark.parametrize("scale", ["0.01"])
def test_same_rows_as_sql(spark, scale):
    from presslens.llm.queries import ORACLES, QUERIES

    directory = f"/root/testdata/sf{scale}"
    assert compare(QUERIES["op11_conversation_repair"](spark, directory), connect(directory), ORACLES["op11_conversation_repair"]) is None


def test_same_rows_as_all_edits(spark):
    table = made_up(1)
    frame = spark.createDataFrame([(*r, "x", 7) for r in table], SCHEMA + ", audit string, copies int")
    got = cr.repair_report(cr.damaged(frame))
    assert {tuple(r) for r in got.collect()} == expected(table) and got.count() == 61
    assert cr.repair_report(cr.damaged(frame.where("false"))).collect() == []


def test_sql_on_odd_rows(spark, tmp_path):
    from presslens.llm.queries import ORACLES, QUERIES

    import duckdb

    frame = spark.createDataFrame(made_up(2), SCHEMA)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert compare(got, con, ORACLES["op11_conversation_repair"]) is None


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE", 7)
    rng = random.Random(4)
    table = [(1, t // 2, rng.choice(["user", "assistant", "tool"]), rng.choice([f"{t}.", f"{t}", "again."])) for t in range(400)]
    table += made_up(5, 20)
    got = cr.repair_report(cr.damaged(spark.createDataFrame(table, SCHEMA).repartition(5))).collect()
    assert {tuple(r) for r in got} == expected(table)


def test_repaired_rows(spark):
    rows = [(1, 1, "assistant", "Hi."), (1, 0, "system", "Be kind."), (1, 2, "user", "cut"), (1, 3, "user", "Bye."), (2, 0, "user", " ")]
    got = cr.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in sorted(got)] == [(1, 0, "K", "system", "Be kind."), (1, 1, "R", "user", "Hi."), (1, 2, "R", "assistant", "Bye.")]


def test_conversations_without_rows(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:5".encode()) % 20 == 0)
    (row,) = cr.repair_report(cr.damaged(spark.createDataFrame([(gone, 5, "user", "A.")], SCHEMA))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", EMPTY)
