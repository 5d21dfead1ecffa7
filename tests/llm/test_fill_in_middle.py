"""Fill-in-middle against a plain version, with exact round trips."""

import hashlib
import re

import pyarrow as pa
import pytest
from harness import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = ["a", "bc", " ", "\t\n", "\x0b", "é", "\U0001f600", " ", "<P>", "<S", ">", "<M>", "\x00", "\x01", "\x01m", "\x01e", "<", "word "]


def plain_version(text, hashes):
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted(h % (n + 1) for h in hashes[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or hashes[2] % 100 >= 50:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if hashes[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), *[st.integers(0, 2**32 - 1)] * 4), min_size=1, max_size=6))
def test_batches_as_the_plain_version(rows):
    columns = list(zip(*rows))
    made = fim.arranged(pa.array(columns[0], pa.string()), [pa.array(c, pa.int64()) for c in columns[1:]])
    got = list(zip(*(c.to_pylist() for c in made.values())))
    assert got == [plain_version(r[0], r[1:]) for r in rows]
    assert fim.rebuilt(made["output"], made["form"]).to_pylist() == list(columns[0])


def hashes_of(doc_id):
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def test_rows_of_all_kinds(spark):
    texts = [None, "", " ", "\n\t x", "a <S> b", "one two  three four ", "\x00 \x01 \x00\x01m", "w " * 200_000, "<" * 9 + " P>", "é\U0001f600 " * 50]
    rows = [(i, t) for t in texts for i in (None, *range(30), 8, -3, 10**15)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, output string, n int")
    got = [tuple(r) for r in fim.restore(fim.transform(docs)).collect()]
    expected = [(i, *plain_version(t or "", hashes_of(i)), t or "") for i, t in rows]
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.digest_report(docs.where("false")).collect() == []
    assert fim.digest_report(docs).columns == "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256".split()


@pytest.mark.parametrize("scale", ["0.01"])
def test_same_rows_as_sql(spark, scale):
    from presslens.llm.queries import ORACLES, QUERIES

    directory = f"/root/testdata/sf{scale}"
    assert compare(QUERIES["op13_fill_in_middle"](spark, directory), connect(directory), ORACLES["op13_fill_in_middle"]) is None


def test_texts_as_ids(spark):
    docs = spark.createDataFrame([("x1", "a b c"), ("", None)], "doc_id string, text string")
    assert sorted(r["n"] for r in fim.transform(docs).collect()) == [0, 3]
