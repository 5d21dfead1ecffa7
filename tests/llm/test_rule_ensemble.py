"""The rule ensemble: statistics and rules against plain Python, optimal lasso weights, held-out accuracy."""

import re
import zlib

import numpy as np
import pytest

from presslens.llm import rule_ensemble as rules

TEXTS = [
    None,
    "",
    " \t\n",
    "One two two  two\nthree. One two two  two\nthree.\n\nEnd!",
    "A | b | c $$$ 12 É été É été",
    "x" * 5000,
    "LOUD!! WORDS!! HERE!!",
    "word " * 3000,
    "a b \U0001f600\U0001f600 c",
]


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = text.split("\n")
    count = lambda pattern: len(re.findall(pattern, text))
    n = len(words)
    share = lambda a, b: a / b if b else 0.0
    # White space of ASCII only, as the pattern of the column has it.
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return {
        "characters": len(text),
        "words": n,
        "lines": len(lines),
        "word_length": share(sum(map(len, words)), n),
        "longest_word": max(map(len, words), default=0),
        "short_words": share(sum(len(w) <= 3 for w in words), n),
        "distinct_words": share(len(set(words)), n),
        "repeated_words": share(repeats, n),
        "distinct_lines": share(len(set(lines)), len(lines)),
        "letters": share(sum(c.isalpha() for c in text), len(text)),
        "capitals": share(sum(c.isupper() for c in text), len(text)),
        "digits": share(count("[0-9]"), len(text)),
        "symbols": share(count(r"[#*$%&|<>{}\[\]\\^~=_+@/]"), len(text)),
        "exclamations": share(count("!"), n),
        "sentence_ends": share(count("[.?]"), n),
        "commas": share(count("[,;:]"), n),
    }


def test_statistics(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r.asDict() for r in rules.with_statistics(rows, "doc_id").collect()}
    for k, text in enumerate(TEXTS):
        assert {n: got[k][n] for n in rules.STATISTICS} == pytest.approx(plain_statistics(text)), text


def test_columns_score_as_the_rules_say(spark):
    rng = np.random.default_rng(3)
    n, names = 400, list(rules.STATISTICS)
    values = rng.integers(0, 9, (n, len(names))).astype(float)
    label = ((values[:, 4] > 3) & (values[:, 9] <= 5) | (rng.random(n) < 0.05)).astype(float)
    made = rules.fit(values, label, np.ones(n))
    assert 0 < len(made.rules)
    columns = dict(zip(names, values.T))
    odds = made.base + sum(w * rule.holds(columns) for rule, w in made.rules)
    frame = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(values)], ["k", *names])
    got = {r["k"]: r["s"] for r in frame.select("k", made.column().alias("s")).collect()}
    assert [got[k] for k in range(n)] == pytest.approx(list(1 / (1 + np.exp(-odds))))
    assert ((odds > 0) == label).mean() > 0.9
    assert all(str(rule) for rule, _ in made.rules)


def test_lasso_weights_are_optimal(monkeypatch):
    monkeypatch.setattr(rules, "STEPS", 5000)
    rng = np.random.default_rng(5)
    design = np.c_[(rng.random((300, 12)) < 0.4), np.ones(300)].astype(float)
    label = (rng.random(300) < 1 / (1 + np.exp(-(2 * design[:, 0] - 3 * design[:, 1])))).astype(float)
    weight = rng.random(300) + 0.5
    w = rules.lasso(design, label, weight, 0.01, np.zeros(13))
    slope = design.T @ (weight / weight.sum() * (label - 1 / (1 + np.exp(-design @ w))))
    assert abs(slope[-1]) < 1e-5
    for s, x in zip(slope[:-1], w[:-1]):
        assert abs(s - 0.01 * np.sign(x)) < 1e-5 if x else abs(s) <= 0.01 + 1e-5
    assert np.count_nonzero(w[:-1]) < 12


@pytest.mark.parametrize("scale", ["0.01"])
def test_held_out_documents(spark, scale):
    directory = f"/root/testdata/sf{scale}"
    docs, labels = (spark.read.parquet(f"{directory}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in rules.quality_report(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    known = [(r["doc_id"], r["quality"]) for r in labels.collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert len(known) > 50 and np.mean([got[i]["predicted"] == q for i, q in known]) >= 0.95
    assert all(got[i]["predicted"] == 1 for i, q in known if q == 1)
    again = {r["doc_id"]: r["score"] for r in rules.quality_report(docs, labels).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_labels_of_held_out_documents_are_not_used(spark):
    docs = spark.createDataFrame([(k, "word " * (k + 1)) for k in range(60)], "doc_id long, text string")
    rows = [(k, int(k > 20)) for k in range(60)]
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q) for k, q in rows]
    made = [rules.fit_ensemble(docs, spark.createDataFrame(r, "doc_id long, quality int")) for r in (rows, turned)]
    assert made[0] == made[1] and made[0].rules


def test_labels_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    schema = "doc_id long, quality int"
    for labels, score in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (1, 1)], 0.0), ([(None, 1), (1, None), (1, 7)], 0.5)):
        got = rules.quality_report(docs, spark.createDataFrame(labels, schema)).collect()
        assert [r["score"] for r in got] == pytest.approx([score] * 2, abs=1e-5)


def test_sample_is_bounded_in_rows(spark):
    docs = spark.createDataFrame([(1, f"a {k}") for k in range(500)] + [(2, "b " * 9)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    seen = []
    original, rules.fit = rules.fit, lambda v, label, w: seen.append(label) or original(v, label, w)
    try:
        rules.fit_ensemble(docs, labels, sample=50)
    finally:
        rules.fit = original
    assert [int((seen[0] == c).sum()) for c in (0, 1)] == [50, 1]
