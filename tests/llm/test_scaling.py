"""What grows faster than the input is not made: checked on rows built here."""

import numpy as np

from presslens.llm import jaccard_join, substring_dedup


def test_phrases_that_meet_by_chance_leave_few_windows():
    # Common phrases in random order: a few words in a row repeat everywhere, fifty words in a row nowhere.
    random = np.random.default_rng(5)
    phrases = random.integers(1, 2**63, (40, 14), dtype=np.uint64)
    texts = [phrases[random.integers(0, 40, 30)].ravel() for _ in range(60)]
    rows = np.cumsum([0, *map(len, texts)])
    names, low, high, row = substring_dedup.anchors(np.concatenate(texts), rows)
    documents = {}
    for name, number in zip(names, row):
        documents.setdefault(name, set()).add(number)
    shared = np.array([len(documents[name]) > 1 for name in names])
    left = 0
    for i, text in enumerate(texts):
        own = row == i
        left += len(substring_dedup.possible(low[own] - rows[i], high[own] - rows[i], shared[own], len(text)))
    assert left < 0.1 * sum(map(len, texts))


def test_a_repeat_of_fifty_words_keeps_its_window_anywhere():
    random = np.random.default_rng(6)
    for _ in range(200):
        repeat = random.integers(1, 2**63, substring_dedup.WINDOW, dtype=np.uint64)
        one, two = (random.integers(1, 2**63, random.integers(0, 90), dtype=np.uint64) for _ in range(2))
        before, after = random.integers(0, len(one) + 1), random.integers(0, len(two) + 1)
        texts = [np.concatenate([one[:before], repeat, one[before:]]), np.concatenate([two[:after], repeat, two[after:]])]
        rows = np.cumsum([0, *map(len, texts)])
        names, low, high, row = substring_dedup.anchors(np.concatenate(texts), rows)
        shared = np.isin(names, np.intersect1d(names[row == 0], names[row == 1]))
        for i, at in enumerate((before, after)):
            own = row == i
            kept = substring_dedup.possible(low[own] - rows[i], high[own] - rows[i], shared[own], len(texts[i]))
            assert at in kept


def test_classes_that_nearly_link_are_paired_once(spark, monkeypatch):
    # Texts that share most of their shingles in many groups, too few to link: each pair is made at its last group only.
    random = np.random.default_rng(7)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(16):
        words = list(base)
        for place in random.choice(58, 4, replace=False):
            words[5 * place + 4] = f"own{i}x{place}"
        texts.append(" ".join(words))
    texts += [t + " end" for t in texts[:2]]
    made, plain = [], jaccard_join._outside_pairs

    def counted(*parts):
        pairs = plain(*parts)
        made.append((pairs.count(), jaccard_join._distinct(pairs).count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "_outside_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_report(docs).collect()}
    assert found == {i: i if i < 16 else i - 16 for i in range(18)}
    assert made[0][0] == made[0][1] > 50


def test_pairs_met_in_many_groups_are_not_lost(spark, monkeypatch):
    # With no round of stars all pairs come from the last step; components against brute force.
    monkeypatch.setattr(jaccard_join, "STARS", 0)
    random = np.random.default_rng(8)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(40):
        words = list(base)
        for place in random.choice(150, random.integers(1, 5), replace=False):
            words[place] = f"own{random.integers(6)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    least = list(range(40))
    for _ in range(40):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_report(docs).collect()}
    assert found == dict(enumerate(least))
    assert len(set(least)) > 1
