"""Best headline matches against comparing all pairs."""

import random

from presslens.functions import similarity
from presslens.operators import matching as H


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def brute(query, choices, labels):
    scores = [2.0 * lcs(query, c) / max(len(query) + len(c), 1) for c in choices]
    best = max(scores)
    return min(label for label, s in zip(labels, scores) if s == best), best


def texts(n, longest, seed):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abcdé ع1") for _ in range(rng.randint(1, longest))) for _ in range(n)})


def test_best_in_is_exact():
    for longest in (4, 70, 200):
        queries, choices = texts(25, longest, 1), texts(40, longest, 2)
        for query, (at, score) in zip(queries, similarity.best_in(queries, choices, choices)):
            assert (choices[at], score) == brute(query, choices, choices)


def headlines(spark, rows, column):
    return spark.createDataFrame(rows, f"id long, lang string, {column} string")


def test_grid_of_small_cells_is_exact(spark):
    words = "war peace talks river flood price bread north south town".split()
    rng = random.Random(5)

    def made(n):
        return [" ".join(rng.choice(words) for _ in range(rng.randint(2, 6))).title() + "!" for _ in range(n)]

    left, right = made(40), made(30)
    right[3] = left[0].upper()
    a = headlines(spark, [(i, "x", t) for i, t in enumerate(left)], "title")
    b = headlines(spark, [(i, "x", t) for i, t in enumerate(right)], "headline")
    matched = H.best_matches(a, b, "title", "headline", cell=4)

    def norm(t):
        return "".join(c if c.isalnum() or c == "_" else " " for c in t.lower()).strip()

    reps = {}
    for t in right:
        reps[norm(t)] = min(t, reps.get(norm(t), t))
    labels = [reps[k] for k in sorted(reps)]
    for row in matched.collect():
        label, score = brute(norm(row["title"]), sorted(reps), labels)
        assert (row["matched_title"], row["matched_score"]) == (label, round(score * 100))
    assert matched.count() == 40


def test_hot_headline_and_blocks(spark):
    a = headlines(spark, [(i, "x", "Same News") for i in range(50)] + [(50, "y", "same news"), (51, "y", None)], "title")
    b = headlines(spark, [(1, "x", "same news!"), (2, "y", "some news")], "headline")
    rows = H.best_matches(a, b, "title", "headline", block="lang").collect()
    got = {r["id"]: (r["matched_title"], r["matched_score"]) for r in rows}
    assert len(rows) == 52
    assert got[0] == ("same news!", 100)
    assert got[50] == ("some news", 89)
    assert got[51] == (None, None)


def test_exact_matches_count_both_ways(spark):
    a = headlines(spark, [(1, "x", "A b"), (2, "x", "a B"), (3, "x", "c")], "title")
    b = headlines(spark, [(1, "x", "a b"), (2, "x", "d")], "headline")
    assert tuple(H.exact_matches(a, b, "title", "headline").first()) == (3, 2, 2, 1)


def test_score_bands_are_closed_on_the_right(spark):
    rows = spark.createDataFrame([(i, i) for i in range(0, 31)], "id long, score int")
    bands = H.score_bands(rows, "score", "id", 100).collect()
    assert {(r["score"], r["band"]) for r in bands if r["score"] in (1, 10, 11, 30)} == {
        (1, 1), (10, 1), (11, 2), (30, 3),
    }
    assert all(r["score"] > 0 for r in bands)


def test_both_ways_at_once_like_each_alone(spark):
    rng = random.Random(8)
    words = "war peace talks river flood price bread north south town".split()

    def made(n):
        return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) + rng.choice(["", "!"]) for _ in range(n)] + [None]

    left, right = made(40), made(30)
    right[:4] = left[:4]
    a = headlines(spark, [(i, "xy"[i % 2], t) for i, t in enumerate(left)], "title")
    b = headlines(spark, [(i, "xy"[i % 2], t) for i, t in enumerate(right)], "headline")
    for block in (None, "lang"):
        forth, back = H.best_matches_both_ways(a, b, "title", "headline", block=block, cell=8)
        assert sorted(forth.collect(), key=str) == sorted(H.best_matches(a, b, "title", "headline", block=block).collect(), key=str)
        assert sorted(back.collect(), key=str) == sorted(H.best_matches(b, a, "headline", "title", block=block).collect(), key=str)


def test_pairs_are_compared_once_for_both_ways(monkeypatch):
    compared = []
    plain = similarity.Block.common_subsequences
    monkeypatch.setattr(
        similarity.Block, "common_subsequences", lambda self, queries: compared.append(len(queries) * len(self.at)) or plain(self, queries)
    )
    a, b = texts(60, 70, 3), texts(50, 70, 4)
    forth, back = similarity.best_both_ways(a, b, a, b, [False] * len(a), [False] * len(b))
    assert sum(compared) <= len(a) * len(b)
    for mine, other, found in ((a, b, forth), (b, a, back)):
        for text, (at, score) in zip(mine, found):
            assert (other[at], score) == brute(text, other, other)
