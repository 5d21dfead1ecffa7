"""The word within its class is drawn by context, and its softmaxes are proper."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from presslens.llm import language_model as L


def trained(spark, texts):
    return L.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))[0]


def test_the_word_in_its_class_follows_the_words_before(spark):
    # Words of one class (equal last bytes, all as frequent): which one follows is told by the word before alone.
    names, lead = (["".join(p) + end for p in itertools.product("abcdefgh", repeat=2)] for end in ("xx", "yy"))
    text = " ".join(f"{a} {b}" for a, b in zip(lead, names))
    model = trained(spark, [text] * 20)
    stream, group, rows = L._stream(pa.array([text] * 20 + [f"{lead[i]} {names[i - 1]}" for i in range(64)]))
    token, features, softmax, drawn, classes, _ = model.choices(stream, group, rows)
    past, seen = np.ones(model.weights.shape, np.float32), np.zeros(len(model.weights), np.int64)
    right = token < rows[20]
    for _ in range(60):
        model.train(features[right], softmax[right], drawn[right], past, seen)
    # The logarithms of the shares within the classes alone.
    inside = softmax > 0
    shares = np.zeros(len(token))
    shares[inside] = model.log_shares(features[inside], softmax[inside])[np.arange(inside.sum()), drawn[inside]]
    shares = np.bincount(token, shares, len(stream))
    numbered = classes > L.FREQUENT
    told = shares[1:128:2][numbered[1:128:2]].mean()
    false = shares[rows[20] + 1 :: 3][numbered[rows[20] + 1 :: 3]].mean()
    assert told > false + 1


@pytest.mark.parametrize("size", [40, 1500])
def test_all_words_of_a_context_sum_to_one(spark, size):
    words = [f"w{i}q{i % 7}" for i in range(size)]
    model = trained(spark, [" ".join(words[: 1 + i * size // 50]) for i in range(50)])
    random = np.random.default_rng(4)
    model.weights = random.normal(0, 0.3, model.weights.shape).astype(np.float32)
    # After the same word, every known word and the rest of every group.
    before, shares = np.uint64(12345), []
    groups = [(w, g, 1) for w, g in zip(model.words, model.groups)] + [(np.uint64(10**9 + g), g, 0) for g in range(L.GROUPS)]
    for word, group, _ in groups:
        token, features, softmax, drawn, *_ = model.choices(np.array([before, word]), np.array([0, group]), np.array([0, 2]))
        own = token == 1
        shares.append(model.log_shares(features[own], softmax[own])[np.arange(own.sum()), drawn[own]].sum())
    assert np.exp(shares).sum() == pytest.approx(1, abs=1e-3)


def test_gradient_steps_add_up_like_one_by_one(spark):
    model = trained(spark, ["a b c d e f g h i j k l m n o p"] * 3)
    random = np.random.default_rng(5)
    features = random.integers(0, 30, (200, 4)).astype(np.int32)
    drawn, softmax = random.integers(0, L.CLASSES, 200), np.zeros(200, np.int64)
    start, slope = model.weights.copy(), -np.exp(model.log_shares(features, softmax))
    slope[np.arange(200), drawn] += 1
    step = np.zeros(model.weights.shape)
    np.add.at(step, features.ravel(), np.repeat(slope, 4, 0))
    past, seen = np.ones(model.weights.shape, np.float32), np.zeros(len(model.weights), np.int64)
    model.train(features, softmax, drawn, past, seen)
    assert model.weights == pytest.approx(start + L.RATE * step / np.sqrt(1 + step * step), abs=1e-4)
    assert seen.sum() == 800


def test_sums_too_large_for_a_float_have_proper_shares(spark):
    model = trained(spark, ["a b c d e f g h i j k l m n o p"] * 3)
    random = np.random.default_rng(6)
    model.weights = random.normal(0, 40, model.weights.shape).astype(np.float32)
    features, softmax = random.integers(0, len(model.weights), (300, 4)).astype(np.int32), np.zeros(300, np.int64)
    drawn = random.integers(0, L.CLASSES, 300)
    shares = model.log_shares(features, softmax)[np.arange(300), drawn]
    assert model.drawn_shares(features, softmax, drawn) == pytest.approx(shares, rel=1e-4, abs=1e-3)


def test_runs_of_any_length_are_summed():
    random = np.random.default_rng(7)
    met = -np.sort(-np.append(random.integers(1, 40, 50), [1, 8, 9, 72, 73, 700, 5000]))
    values, at = random.normal(size=(300, L.CLASSES)).astype(np.float32), random.integers(0, 300, met.sum())
    first = np.cumsum(met) - met
    expected = np.array([values[at[a : a + n]].sum(0) for a, n in zip(first, met)])
    assert L._sums(values, at, first, met) == pytest.approx(expected, abs=1e-2)


def test_many_small_splits_send_few_changes_of_the_model(spark, tmp_path):
    # Each task sends a row for every row of weights that it has met, so tasks follow the bytes, not the splits.
    spark.createDataFrame([(f"a{i} b c",) for i in range(200)], "text string").repartition(100).write.parquet(f"{tmp_path}/docs")
    rows = spark.read.parquet(f"{tmp_path}/docs").repartition(100)
    assert L._dealt(rows).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert L._dealt(rows).count() == 200
