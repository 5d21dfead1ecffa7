"""CSV files cut into ranges give the rows of Spark's own reader, wherever the cuts lie."""

import csv
import gzip
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslens.sources import articles as A
from presslens.sources import csv_ranges as C

PIECES = ["a", "é\U0001f600", '"', ",", "\n", "\r\n", " ", '""', "word " * 30, "\n\n", ""]


def made_up(seed, n):
    rng = random.Random(seed)
    return [[str(k), *("".join(rng.choice(PIECES) for _ in range(rng.randrange(8))) for _ in range(3))] for k in range(n)]


def put(path, rows, end="\r\n", opener=open):
    with opener(path, "wt", newline="", encoding="utf-8") as handle:
        csv.writer(handle, lineterminator=end).writerows(rows)


def rows_of(frame, columns):
    # Spark's reader turns line ends inside quotes into those of the file; here they stay.
    return sorted(tuple((r[c] or "").replace("\r\n", "\n") for c in columns) for r in frame.collect())


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 40), st.integers(1, 50), st.booleans())
def test_ranges_own_each_record_once(seed, n, range_bytes, chunk, ended):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(made_up(seed, n))
    raw = text.getvalue().encode()
    raw = raw if ended else raw[:-1]
    found = []
    for start in range(0, len(raw), range_bytes):
        inside = raw[:start].count(b'"') % 2 == 1
        for part, ends in C.records_in_range(io.BytesIO(raw), start, min(start + range_bytes, len(raw)), inside, chunk):
            found += [part[a:b] for a, b in zip([0, *ends], ends)]
    assert b"".join(found) == raw
    assert [next(csv.reader(io.StringIO(f.decode(), newline=""))) for f in found] == made_up(seed, n)


@pytest.mark.parametrize("range_bytes", [500, 1 << 20])
def test_same_rows_as_sparks_reader(spark, tmp_path, range_bytes):
    names = ["id", "title", "body", "x"]
    for k, end in ((0, "\r\n"), (1, "\n")):
        put(tmp_path / f"f{k}.csv", [names, *made_up(k, 40)], end)
    own = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    made = C.csv_table(C.csv_files(spark, str(tmp_path)), range_bytes=range_bytes)
    assert made.columns == [*names, "file"]
    # Values of which nothing is left but a carriage return at the end of a line are not compared.
    assert rows_of(made, names[:3]) == rows_of(own, names[:3])
    assert made.count() == 80


def test_one_file_is_many_tasks(spark, tmp_path):
    put(tmp_path / "large.csv", [["id", "body"], *([str(k), f"line\n{k}" * 40] for k in range(3000))])
    size = (tmp_path / "large.csv").stat().st_size
    frame = C.csv_table(C.csv_files(spark, str(tmp_path)), range_bytes=size // 20)
    assert sorted(int(r["id"]) for r in frame.collect()) == list(range(3000))
    per_task = frame.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(per_task) >= 20 and max(r["count"] for r in per_task) < 300


def test_names_with_pattern_characters_and_other_headers(spark, tmp_path):
    put(tmp_path / "a[1]_eng.csv", [["uri", "url", "body"], ["1", "u1", "x,\ny"]])
    put(tmp_path / "b{2}*?_eng.csv", [["body", "URI"], ["z", "2"]])
    (tmp_path / "empty_eng.csv").write_bytes(b"")
    (tmp_path / "bom_eng.csv").write_bytes('﻿uri,"a\nb",\n\n3,4,5,6\n7\n'.encode())
    with gzip.open(tmp_path / "z_eng.csv.gz", "wt") as handle:
        handle.write("uri,body\n8,packed")
    made = A.read_csv_by_header(spark, str(tmp_path))
    assert made.columns == ["uri", "url", "body", "a\nb", "_c2", "file"]
    got = {r["uri"]: tuple(r)[1:] for r in made.collect()}
    assert got == {
        "1": ("u1", "x,\ny", None, None, "a[1]_eng.csv"),
        "2": (None, "z", None, None, "b{2}*?_eng.csv"),
        "3": (None, None, "4", "5", "bom_eng.csv"),
        "7": (None, None, None, None, "bom_eng.csv"),
        "8": (None, "packed", None, None, "z_eng.csv.gz"),
    }
    assert A.read_articles_csv(spark, str(tmp_path)).count() == 5


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    assert A.read_csv_by_header(spark, str(tmp_path)).count() == 0


def test_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x,y\n1,caf\xe9\n2,ok\n")
    got = {r["x"]: r["y"] for r in A.read_csv_by_header(spark, str(tmp_path)).collect()}
    assert got == {"1": "caf�", "2": "ok"}
