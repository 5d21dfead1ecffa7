"""Toxicity: a linear-chain conditional random field over tokens.

Labels say which documents are toxic, not which words. So the words of a bounded sample of labelled training
documents are labelled first: a token of a toxic document is toxic if one of its features (the folded
word or a prefix of it) occurs in toxic documents far more often than elsewhere. On these labelled tokens the
chain is trained by gradient steps on its exact log likelihood: two states, weights per hashed feature, and
weights of the transitions. Forward-backward gives every token's marginal; a document's score is a logistic
function of its marginals' log odds of no toxic token, fitted on the sample's document labels. Tokens
whose marginal reaches `SPAN` give the offending spans.

The sample is bounded by `SAMPLE` documents (smallest hashes of the ids) and `SAMPLE_BYTES` of text per document
class, and it is trained in one task, so nothing but the model reaches the driver. All documents are
scored whole, without a shuffle; the chain runs over all documents of a batch side by side.

Defined results: a null or empty text has no tokens and gets the score of that; null ids are scored, held
out if the crc32 of a null counts as 0, that is always; repeated rows are scored alike; without labelled rows, or
with one class only, every score is the share of toxic rows, or 0; an empty table gives an empty
result. Label, language, source and id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm import tokens

FOLDS = 5
SAMPLE = 2000
# Longer sample texts are passed over when fitting, so that the sample's size is bounded in bytes, too.
SAMPLE_BYTES = 12_000
BUCKETS = 1 << 18
# Prefix lengths in bytes that are features beside the whole word.
PREFIXES = (4, 5, 6, 7)
# A feature marks tokens if this share of the documents that have it is toxic, by more than chance.
MARKS = 0.75
STEPS = 12
RATE = 0.3
DECAY = 1e-2
SPAN = 0.5
_SALT = np.arange(1, len(PREFIXES) + 2, dtype=np.uint64)


def held_out(id_column: Column, folds: int = FOLDS) -> Column:
    """Whether the crc32 of the id as text leaves no remainder."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == 0


def token_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets (tokens x features, -1 for none) of a text column, row borders, and byte ranges.

    A token is a word without the bytes at its edges that are ASCII and no letter or digit, A-Z folded.
    """
    raw, rows = tokens.column_bytes(column)
    first, last = tokens.word_places(raw, rows)
    row = np.searchsorted(first, rows)
    begin, end = first.copy(), last.copy()
    for _ in range(4):
        long = begin < end
        begin[long] += _MARK[raw[begin[long]]]
        long = begin < end
        end[long] -= _MARK[raw[end[long] - 1]]
    size = end - begin
    found = np.full((len(first), len(PREFIXES) + 1), -1, np.int64)
    total = np.zeros(len(first), np.uint64)
    for place in range(int(min(size.max(initial=0), _LONGEST))):
        inside = size > place
        total[inside] += _VALUES[raw[begin[inside] + place]] * _FACTORS[place]
        if place + 1 in PREFIXES:
            k = PREFIXES.index(place + 1)
            at = size >= place + 1
            found[at, k] = _bucket(total[at], _SALT[k])
    some = size > 0
    found[some, -1] = _bucket(total[some], _SALT[-1])
    return found, row, begin, end


def _bucket(total: np.ndarray, salt: np.uint64) -> np.ndarray:
    return (tokens.mixed(total ^ (salt * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(46)).astype(np.int64)


_LONGEST = 24
_rng = np.random.default_rng(7)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]
_FACTORS = _rng.integers(1, 2**63, _LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)]).astype(np.int64)


class Chain:
    """Two states, weights of features for the toxic one, and weights of the transitions."""

    def __init__(self):
        # The last bucket stands for no feature and keeps the weight 0.
        self.weights = np.zeros(BUCKETS + 1)
        self.bias = 0.0
        # Between (no, no), (no, yes), (yes, no), (yes, yes).
        self.moves = np.zeros((2, 2))
        self.link = (0.0, 0.0)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        """Log odds of the toxic state of every token by itself."""
        return self.bias + self.weights[features].sum(1)

    def marginals(self, emission: np.ndarray, row: np.ndarray, pairs: bool = False):
        """Probability of the toxic state of every token; with `pairs`, also of the moves into each token.

        Forward and backward run over all rows side by side, longest first, a step for each place.
        """
        size = np.diff(row)
        order = np.argsort(-size, kind="stable")
        size, start = size[order], row[:-1][order]
        n = len(emission)
        forward, backward = np.zeros(n), np.zeros(n)
        (a, b), (c, d) = self.moves
        longest = int(size[0]) if len(size) else 0
        # How many rows have more than t tokens.
        open_ = np.searchsorted(-size, -np.arange(longest + 1), "left")
        for t in range(longest):
            at = start[: open_[t]] + t
            if t == 0:
                forward[at] = emission[at]
            else:
                odds = forward[at - 1]
                forward[at] = emission[at] + np.logaddexp(b, odds + d) - np.logaddexp(a, odds + c)
        for t in range(1, longest):
            # Rows with at least t + 1 tokens, t places from their ends.
            at = start[: open_[t]] + size[: open_[t]] - 1 - t
            odds = backward[at + 1] + emission[at + 1]
            backward[at] = np.logaddexp(c, odds + d) - np.logaddexp(a, odds + b)
        log_odds = forward + backward
        if not pairs:
            return log_odds
        at = np.setdiff1d(np.arange(n), row[:-1][np.diff(row) > 0])
        left, right = forward[at - 1], backward[at] + emission[at]
        scores = np.stack([np.full(len(at), a), b + right, c + left, d + left + right])
        scores -= scores.max(0)
        share = np.exp(scores)
        return log_odds, (share / share.sum(0)).sum(1).reshape(2, 2)

    def train(self, features: np.ndarray, row: np.ndarray, marks: np.ndarray) -> None:
        """Gradient steps on the log likelihood of the marks, scaled per weight by past gradients.

        The first weights are the log odds of the marks by feature, shared among a token's features.
        """
        used = np.unique(features[marks])
        known = np.zeros(BUCKETS + 1, bool)
        known[used[used < BUCKETS]] = True
        # Only a feature that some marked token has can speak for the toxic state.
        features = np.where(known[features], features, BUCKETS)
        active = np.maximum((features < BUCKETS).sum(1), 1)
        self.bias = float(np.log(0.5 / max(len(marks), 1)))
        # Tokens count the more for a feature, the fewer others they have.
        every = np.bincount(features.ravel(), minlength=BUCKETS + 1)
        bad = np.bincount(features[marks].ravel(), minlength=BUCKETS + 1)
        among = np.bincount(features.ravel(), np.repeat(active, features.shape[1]), BUCKETS + 1) / np.maximum(every, 1)
        odds = np.log((bad + 0.5) / (every - bad + 0.5))
        self.weights = np.where(known, (odds - self.bias) / np.maximum(among, 1), 0.0)
        at = np.setdiff1d(np.arange(len(marks)), row[:-1][np.diff(row) > 0])
        seen = np.zeros((2, 2))
        np.add.at(seen, (marks[at - 1].astype(int), marks[at].astype(int)), 1)
        past, past_bias, past_moves = np.full(BUCKETS + 1, 1.0), 1.0, np.full((2, 2), 1.0)
        for _ in range(STEPS):
            odds, expected = self.marginals(self.emissions(features), row, pairs=True)
            error = marks - 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            slope = np.bincount(features.ravel(), np.repeat(error, features.shape[1]), BUCKETS + 1)
            slope = np.where(known, slope - DECAY * self.weights, 0.0)
            past += slope**2
            self.weights += RATE * slope / np.sqrt(past)
            past_bias += error.sum() ** 2
            self.bias += RATE * error.sum() / np.sqrt(past_bias)
            step = seen - expected - DECAY * self.moves
            past_moves += step**2
            self.moves += RATE * step / np.sqrt(past_moves)

    def evidence(self, odds: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Per row the log odds that some token is toxic, from the marginals; bounded."""
        none = -np.logaddexp(0, odds)
        total = np.concatenate([[0], np.cumsum(none)])
        log_none = np.minimum(total[row[1:]] - total[row[:-1]], -1e-12)
        some = -np.expm1(log_none)
        return np.clip(np.log(some) - log_none, -12, 12)

    def scores(self, odds: np.ndarray, row: np.ndarray) -> np.ndarray:
        slope, base = self.link
        return 1 / (1 + np.exp(-(slope * self.evidence(odds, row) + base)))


def marked_tokens(features: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Tokens of toxic documents that have a feature which marks toxic documents."""
    document = np.repeat(np.arange(len(toxic)), np.diff(row))
    pairs = np.unique(document[:, None] * (BUCKETS + 1) + np.where(features < 0, BUCKETS, features))
    bucket, label = pairs % (BUCKETS + 1), toxic[pairs // (BUCKETS + 1)]
    every = np.bincount(bucket, minlength=BUCKETS + 1)
    bad = np.bincount(bucket, label, BUCKETS + 1)
    # How unlikely the share is by chance, in nats, against the number of features that were tried.
    rate, share = toxic.mean(), bad / np.maximum(every, 1)
    rest = np.where(share < 1, (1 - share) * np.log(np.maximum(1 - share, 1e-9) / (1 - rate)), 0.0)
    gain = every * (np.where(share > 0, share * np.log(np.maximum(share, 1e-9) / rate), 0.0) + rest)
    marks = (share >= MARKS) & (gain >= np.log(max(np.count_nonzero(every), 1)) + 2)
    marks[BUCKETS] = False
    return marks[features].any(1) & (toxic[document] > 0)


def fit(texts: pa.Array, toxic: np.ndarray, odds: float | None = None) -> Chain:
    """The chain of a bounded set of labelled texts; `odds` are those of a toxic row where they differ."""
    chain = Chain()
    share = float(np.mean(toxic)) if len(toxic) else 0.0
    if not 0 < share < 1:
        chain.link = (0.0, 40.0 * (share - 0.5))
        return chain
    features, row, _, _ = token_features(texts)
    features = np.where(features < 0, BUCKETS, features)
    chain.train(features, row, marked_tokens(features, row, toxic))
    evidence = chain.evidence(chain.marginals(chain.emissions(features), row), row)
    # A logistic regression on one number per document, by damped Newton steps.
    design, w = np.stack([evidence, np.ones_like(evidence)]), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        gradient = design @ (toxic - p) - 0.1 * w
        step = np.linalg.solve((design * (p * (1 - p))) @ design.T + 0.1 * np.eye(2), gradient)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    slope, base = w
    if odds is not None:
        base += np.log(odds) - np.log(share / (1 - share))
    chain.link = (float(slope), float(base))
    return chain


def fit_chain(docs: DataFrame, labels: DataFrame) -> Chain:
    """Fit on a bounded sample of labelled documents (doc_id, text; doc_id, toxic) that are not held out.

    The bound is on rows, also where an id has several of them: at most SAMPLE rows of a class reach the one task.
    """
    # At most 2 * SAMPLE ids are broadcast: those of each class with the smallest hashes.
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    # The sample has other shares of the classes than the labels have.
    counts = dict(known.groupBy("toxic").count().collect())
    prior = counts[1] / counts[0] if counts.get(0) and counts.get(1) else None
    rows = docs.where(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(ids), "doc_id")
    # An id may have many rows: SAMPLE rows of a class are kept, most of the others before they are shuffled.
    first = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
    rows = rows.select("doc_id", "text", "toxic").withColumn("_n", F.row_number().over(first))
    # Brought together by a shuffle, so that the documents are read in many tasks.
    rows = rows.where(F.col("_n") <= SAMPLE).drop("_n").repartition(1)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        held = [b for b in batches if b.num_rows]
        chain = Chain()
        if held:
            table = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
            toxic = table.column(2).to_numpy().astype(float)
            chain = fit(table.column(1).combine_chunks(), toxic, prior)
        at = np.flatnonzero(chain.weights)
        sent = pickle.dumps((at, chain.weights[at], chain.bias, chain.moves, chain.link if held else (0.0, -20.0)))
        yield pa.RecordBatch.from_pydict({"model": [sent]})

    import pickle

    sent = rows.mapInArrow(train, "model binary").collect()
    chain = Chain()
    chain.link = (0.0, -20.0)
    if sent:
        at, weights, chain.bias, chain.moves, chain.link = pickle.loads(bytes(sent[0][0]))
        chain.weights[at] = weights
    return chain


def score(docs: DataFrame, chain: Chain, with_spans: bool = False) -> DataFrame:
    """Per row of `docs` (doc_id, text) the score; with `spans`, also byte ranges of offending tokens."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(chain)
    identity = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {identity}, held_out boolean, score double" + (", spans array<struct<start:long,end:long>>" if with_spans else "")
    names = ["doc_id", "held_out", "score"] + (["spans"] if with_spans else [])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        # Side by side, so more rows at a time cost less.
        for batch in tokens.parts(batches, 2, 8 << 20):
            features, row, begin, end = token_features(batch.column(2))
            odds = model.marginals(model.emissions(np.where(features < 0, BUCKETS, features)), row)
            columns = [batch.column(0), batch.column(1), pa.array(model.scores(odds, row))]
            if with_spans:
                base = tokens.column_bytes(batch.column(2))[1]
                cut = np.log(SPAN / (1 - SPAN)) if SPAN < 1 else np.inf
                columns.append(
                    pa.array(
                        [
                            [{"start": int(begin[k] - base[i]), "end": int(end[k] - base[i])} for k in range(row[i], row[i + 1]) if odds[k] >= cut]
                            for i in range(batch.num_rows)
                        ],
                        kind,
                    )
                )
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(apply, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) whether it was held out, its score and the prediction."""
    rows = docs.select("doc_id", "text")
    scored = score(rows, fit_chain(rows, labels))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
