"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

The probability of a word is that of its class after the words before it, times that of the word within its
class after the same words. Classes are the end of a text, the most frequent words (one each), and groups of all other
words by their last two bytes. Every class probability is a softmax over sums of weights, one row of weights per
hashed feature of the context: the word before, the two words before, and the words two and three places before
(skips).

Within a group the choice of the word is factored again, so that no softmax has more than `CLASSES` members: the words are
numbered by frequency, and each digit of the number, to the base `CLASSES`, is drawn by a softmax of its own, whose rows of
weights are hashed from the feature and from the group and digits before. There are as many digits as the largest group
asks for, and the `SHORT` smallest numbers have the first digit only. The number 0 of a group stands for its words below the head (see below) and an unknown one,
too rare to learn where they stand; only among these a word has its smoothed share of the group's training tokens.

Counting. Spark counts all words of the training documents; the counts stay a table. The words above the count
at which at most `HEAD` words are left are looked up in each task, all others in a join with the table.

Training. In `ROUNDS` rounds, each over its own share of all training documents, every task starts with the
same weights, takes gradient steps over its documents, and sends the change of each row of weights
with the tokens that it saw for it. Spark adds these up by row, and the rows move by the mean change. The model
has `FEATURES` rows for the classes and as many for the digits, however large the corpus is.

Words are known by 64-bit hashes. Scores are base-10 logarithms.

Defined results: a null or empty text has the end token only; a null id is held out (the crc32 of the empty
text is 0); repeated rows are counted, trained on and scored once each; without training documents all counts are
0 and no weights are trained; an empty table gives an empty result. Only `doc_id` and `text` are read. Texts are
read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm import tokens
from presslens.llm.common import written

FOLDS = 10
ADDED = 0.1
HEAD = 1 << 18
FEATURES = 1 << 15
CLASSES = 32
# Classes of the end, of frequent words, and of the rest by their last bytes.
FREQUENT = 11
GROUPS = CLASSES - FREQUENT - 1
ROUNDS = 2
BATCH = 16384
# Bytes of text whose softmaxes are listed at a time.
PART = 1 << 20
# Digits of a word's number within its group, at most, and how many numbers are told by the first alone.
DIGITS = 3
SHORT = 12
RATE = 0.15
# Softmaxes, or rows of weights, that are worked on at a time, so that they stay in a core's cache.
LINES = 2048
# How many slopes of a row of weights are added up one after the other; more are added up in pieces.
LAYERS = 8
# Bytes of documents for each task of a round, so that the changes sent stay a small part of the input.
TASK_BYTES = 64 << 20
END = np.uint64(1)
START = np.uint64(2)
# Distinct words that a task holds before it sends their counts on.
HELD = 1 << 20
_ROW = "key long, doc_id {id}, held_out boolean, n_tokens long, n_known long, head double, gain double, word long, n long"


def held_out(id_column: Column, folds: int = FOLDS) -> Column:
    """Whether the crc32 of the id as text leaves no remainder."""
    return _crc(id_column) % folds == 0


def _crc(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))


def _stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all rows, each row followed by its end; the group of each by its last bytes; row borders."""
    words, rows, tails = tokens.hashes_and_ends(column, fold=True)
    n = len(rows) - 1
    at = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(rows))
    stream = np.full(len(words) + n, END, np.uint64)
    stream[at] = words
    group = np.zeros(len(stream), np.int64)
    tails = np.where((tails >= 65) & (tails <= 90), tails + 32, tails)
    last = tails[:, 0].astype(np.uint64) * np.uint64(256) + tails[:, 1]
    group[at] = (tokens.mixed(last + np.uint64(77)) % np.uint64(GROUPS)).astype(np.int64)
    return stream, group, rows + np.arange(n + 1)


def count_words(rows: DataFrame) -> DataFrame:
    """(word, group, c) of all tokens of `rows` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))

        def sent() -> pa.RecordBatch:
            columns = [pa.array(held[0].view(np.int64)), pa.array(held[1].astype(np.int32)), pa.array(held[2])]
            return pa.RecordBatch.from_arrays(columns, ["word", "group", "n"])

        for batch in tokens.parts(batches, 0):
            stream, group, _ = _stream(batch.column(0))
            words, first, n = np.unique(stream, return_index=True, return_counts=True)
            both = np.concatenate([held[0], words])
            total = np.concatenate([held[2], n])
            groups = np.concatenate([held[1], group[first]])
            words, first, place = np.unique(both, return_index=True, return_inverse=True)
            held = (words, groups[first], np.bincount(place, total, len(words)).astype(np.int64))
            if len(words) > HELD:
                yield sent()
                held = tuple(x[:0] for x in held)
        yield sent()

    made = rows.select("text").mapInArrow(count, "word long, group int, n long")
    return made.groupBy("word").agg(F.first("group").alias("group"), F.sum("n").alias("c"))


class Model:
    """Weights, the classes of frequent words, the sizes of classes, and the counts and numbers of the head."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, groups: np.ndarray, tokens_: int, distinct: int):
        order = np.argsort(words)
        self.words, self.counts, groups = words[order], counts[order].astype(float), groups[order].astype(np.int64)
        self.tokens, self.distinct = tokens_, distinct
        self.total = tokens_ + ADDED * (distinct + 1)
        inner = self.words != END
        # The most frequent words, ties by hash.
        best = np.lexsort((self.words[inner], -self.counts[inner]))[:FREQUENT]
        self.own = np.sort(self.words[inner][best])
        self.size = np.full(CLASSES, ADDED)
        self.weights = np.zeros((2 * FEATURES, CLASSES), np.float32)
        self._number(groups, np.flatnonzero(inner & ~np.isin(self.words, self.own)))

    def _number(self, groups: np.ndarray, at: np.ndarray) -> None:
        """Number the words `at` within their groups by falling count, from 1; what is left has 0."""
        at = at[np.lexsort((self.words[at], -self.counts[at], groups[at]))]
        first = np.searchsorted(groups[at], np.arange(GROUPS))
        number = np.arange(len(at)) - first[groups[at]] + 1
        self.digits = 1
        while self.digits < DIGITS and SHORT + (CLASSES - SHORT) * self.unit <= number.max(initial=0):
            self.digits += 1
        number[number >= SHORT + (CLASSES - SHORT) * self.unit] = 0
        self.numbers = np.zeros(len(self.words), np.int64)
        self.numbers[at] = number
        self.groups = groups

    @property
    def unit(self) -> int:
        """How many numbers share a first digit."""
        return CLASSES ** (self.digits - 1)

    def coded(self, numbers: np.ndarray) -> np.ndarray:
        """Numbers as their digits, the first one in front of zeros if it stands alone."""
        return np.where(numbers < SHORT, numbers * self.unit, SHORT * self.unit + numbers - SHORT)

    def weigh(self) -> None:
        """Biases of all softmaxes, from the sizes of classes and the counts: without weights a word has its share."""
        mass = np.zeros((GROUPS, CLASSES**self.digits))
        at = np.flatnonzero(self.numbers)
        np.add.at(mass, (self.groups[at], self.coded(self.numbers[at])), self.counts[at] + ADDED)
        # Words without a number, and a place for an unknown one.
        mass[:, 0] = self.rest = np.maximum(self.size[FREQUENT + 1 :] - mass.sum(1), ADDED)
        bias = [self.size[None, :]]
        for digit in range(self.digits):
            bias.append(mass.reshape(GROUPS * CLASSES**digit, CLASSES, -1).sum(2))
        bias = np.concatenate(bias)
        self.bias = np.log(np.maximum(bias, 1e-12) / np.maximum(bias.sum(1, keepdims=True), 1e-12)).astype(np.float32)

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words are in the head, and whether they are."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return at, self.words[at] == words

    def choices(self, stream: np.ndarray, group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each softmax that the tokens are drawn by: token, rows of weights, softmax and the member drawn; the classes and
        numbers of all tokens. The classes of all tokens come first, then their digits, first to last."""
        classes, contexts = self.classes(stream, group), self.contexts(stream, rows)
        words, place = np.unique(stream, return_inverse=True)
        at, found = self.known(words)
        numbers = np.where(found, self.numbers[at], 0)[place] if len(self.words) else np.zeros(len(stream), np.int64)
        inside = np.flatnonzero(classes > FREQUENT)
        chosen, kind = self.coded(numbers[inside]), classes[inside] - FREQUENT - 1
        token, drawn, softmax = [np.arange(len(stream))], [classes], [np.zeros(len(stream), np.int64)]
        features, first = [self.hashed(contexts).astype(np.int32)], 1
        for digit in range(self.digits):
            left = CLASSES ** (self.digits - digit)
            node = first + kind * CLASSES**digit + chosen // left
            first += GROUPS * CLASSES**digit
            salted = (contexts[inside] + node.astype(np.uint64)[:, None] * tokens.GRAM[9]) * tokens.GRAM[10]
            features.append(FEATURES + self.hashed(salted).astype(np.int32))
            token.append(inside)
            softmax.append(node)
            drawn.append(chosen * CLASSES // left % CLASSES)
            if not digit:
                longer = numbers[inside] >= SHORT
                inside, chosen, kind = inside[longer], chosen[longer], kind[longer]
        made = (np.concatenate(x) for x in (token, features, softmax, drawn))
        return *made, classes, numbers

    def classes(self, stream: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The class of each token: 0 for the end, then the frequent words, then the groups."""
        found = group + 1 + FREQUENT
        if len(self.own):
            place = np.minimum(np.searchsorted(self.own, stream), len(self.own) - 1)
            same = self.own[place] == stream
            found[same] = place[same] + 1
        found[stream == END] = 0
        return found

    @staticmethod
    def hashed(contexts: np.ndarray) -> np.ndarray:
        """Rows of weights of contexts."""
        return (contexts >> np.uint64(64 - 15)).astype(np.uint16)

    @staticmethod
    def contexts(stream: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The features of the context of each token (tokens x 4), as hashes."""
        before = []
        for back in (1, 2, 3):
            word = np.full(len(stream), START, np.uint64)
            word[back:] = stream[:-back] if back < len(stream) + 1 else word[back:]
            for place in range(back):
                # The first tokens of a row have no word so far back.
                at = rows[:-1] + place
                word[at[at < rows[1:]]] = START
            before.append(word)
        one, two, three = before
        found = [
            tokens.mixed(one + np.uint64(11)),
            tokens.mixed(one * tokens.GRAM[1] + two * tokens.GRAM[2]),
            tokens.mixed(two + np.uint64(13)),
            tokens.mixed(three + np.uint64(17)),
        ]
        return np.stack(found, 1)

    def log_shares(self, features: np.ndarray, softmax: np.ndarray | int = 0) -> np.ndarray:
        """Natural logarithms of the probabilities of a softmax's members (tokens x classes); the first is that of classes."""
        total = self.sums(features, softmax)
        total -= total.max(1, keepdims=True)
        total -= np.log(np.exp(total).sum(1, keepdims=True))
        return total

    def sums(self, features: np.ndarray, softmax: np.ndarray | int) -> np.ndarray:
        """The biases and weights of a softmax's members, added up."""
        total = self.weights.take(features[:, 0], 0)
        total += self.bias.take(softmax, 0)
        for k in range(1, features.shape[1]):
            total += self.weights.take(features[:, k], 0)
        return total

    def odds(self, features: np.ndarray, softmax: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the members' probabilities are in proportion to, its sum, and the logarithms of the shares of those drawn.

        Members are not measured against the largest one, but where the sum would leave the range of a float.
        """
        odds = self.sums(features, softmax)
        own = odds[np.arange(len(drawn)), drawn].astype(float)
        with np.errstate(over="ignore"):
            np.exp(odds, out=odds)
            whole = odds @ np.ones(CLASSES, np.float32)
        far = np.flatnonzero(~((whole > 1e-20) & (whole < 1e20)))
        if len(far):
            total = self.sums(features[far], softmax[far])
            most = total.max(1)
            odds[far] = np.exp(total - most[:, None])
            whole[far] = odds[far].sum(1)
            own[far] -= most
        return odds, whole, own - np.log(whole.astype(float))

    def drawn_shares(self, features: np.ndarray, softmax: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of the members drawn."""
        shares = np.empty(len(drawn))
        for a in range(0, len(drawn), LINES):
            part = slice(a, a + LINES)
            shares[part] = self.odds(features[part], softmax[part], drawn[part])[2]
        return shares

    def train(self, features: np.ndarray, softmax: np.ndarray, drawn: np.ndarray, past: np.ndarray, seen: np.ndarray) -> None:
        """Gradient steps over batches, scaled per weight by past gradients."""
        for a in range(0, len(drawn), BATCH):
            f, c = features[a : a + BATCH], drawn[a : a + BATCH]
            slope = np.empty((len(c), CLASSES), np.float32)
            for b in range(0, len(c), LINES):
                odds, whole, _ = self.odds(f[b : b + LINES], softmax[a + b : a + min(b + LINES, len(c))], c[b : b + LINES])
                np.divide(odds, -whole[:, None], out=slope[b : b + LINES])
            slope[np.arange(len(c)), c] += 1
            flat = f.astype(np.uint16).ravel()
            order = np.argsort(flat, kind="stable")
            rows = flat[order]
            first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            met = np.diff(np.append(first, len(rows)))
            most = _falling(met)
            used, met, token = rows[first[most]].astype(np.int64), met[most], order // f.shape[1]
            step = _sums(slope, token, first[most], met)
            for b in range(0, len(used), LINES):
                at, moved = used[b : b + LINES], step[b : b + LINES]
                gathered = past.take(at, 0)
                gathered += moved * moved
                past[at] = gathered
                moved /= np.sqrt(gathered, out=gathered)
                moved *= RATE
                moved += self.weights.take(at, 0)
                self.weights[at] = moved
            seen[used] += met


def _falling(met: np.ndarray) -> np.ndarray:
    """The order of falling numbers."""
    return np.argsort(-met.astype(np.int32), kind="stable")


def _sums(values: np.ndarray, at: np.ndarray, first: np.ndarray, met: np.ndarray) -> np.ndarray:
    """The sum of `values` at each run of `at`, which begins at `first` and has `met` entries; longer runs come first."""
    total = values.take(at[first], 0)
    for again in range(1, LAYERS):
        more = int(np.searchsorted(-met, -again))
        total[:more] += values.take(at[first[:more] + again], 0)
    long = int(np.searchsorted(-met, -LAYERS))
    if long:
        left = met[:long] - LAYERS
        pieces = -(-left // LAYERS)
        starts = np.cumsum(pieces) - pieces
        within = (np.arange(pieces.sum()) - np.repeat(starts, pieces)) * LAYERS
        size = np.minimum(np.repeat(left, pieces) - within, LAYERS)
        order = _falling(size)
        parts = _sums(values, at, (np.repeat(first[:long] + LAYERS, pieces) + within)[order], size[order])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        total[:long] += _sums(parts, place, starts, pieces)
    return total


def _dealt(rows: DataFrame) -> DataFrame:
    """`rows` in as many tasks as their bytes ask for, or as there are cores: each task sends a change of the whole model.

    Where the bytes are not known, the splits stay.
    """
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    asked = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    return rows.coalesce(asked) if asked < 1 << 20 else rows


def _train_round(rows: DataFrame, model: Model) -> None:
    """One round over `rows` (text): the tasks' changes, added up by row of weights, move the model."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"w{k}" for k in range(CLASSES)]

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = sent.value
        own = object.__new__(Model)
        own.__dict__.update(start.__dict__, weights=start.weights.copy())
        past, seen = np.ones((2 * FEATURES, CLASSES), np.float32), np.zeros(2 * FEATURES, np.int64)
        for batch in tokens.parts(batches, 0, PART):
            stream, group, borders = _stream(batch.column(0))
            _, features, softmax, drawn, *_ = own.choices(stream, group, borders)
            own.train(features, softmax, drawn, past, seen)
        used = np.flatnonzero(seen)
        moved = (own.weights[used] - start.weights[used]) * seen[used, None].astype(np.float32)
        columns = [pa.array(used.astype(np.int32)), pa.array(seen[used])]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(moved[:, k]) for k in range(CLASSES))], ["row", "seen", *names])

    made = _dealt(rows.select("text")).mapInArrow(change, "row int, seen long, " + ", ".join(f"{n} float" for n in names))
    # At most twice FEATURES rows reach the driver.
    added = made.groupBy("row").agg(F.sum("seen").alias("seen"), *[F.sum(n).cast("float").alias(n) for n in names])
    summed = added.toArrow().to_pandas()
    if len(summed):
        at = summed["row"].to_numpy()
        model.weights[at] += (summed[names].to_numpy() / summed[["seen"]].to_numpy()).astype(np.float32)


def fit(rows: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the training documents `rows` (doc_id, text), and the table of words below its head."""
    vocabulary = written(count_words(rows), "words")
    total = vocabulary.agg(F.sum("c"), F.count("*")).first()
    # The least count of the head: how many words have each count, from the top.
    by_count = vocabulary.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(HEAD).collect()
    least, left = None, HEAD
    for r in by_count:
        left -= r["n"]
        if left < 0:
            break
        least = r["c"]
    head = vocabulary.where(F.col("c") >= (least if least is not None else F.lit(None))).select("word", "group", "c").toArrow().to_pandas()
    words, counts, groups = (head[x].to_numpy().astype(np.int64) for x in ("word", "c", "group"))
    model = Model(words.view(np.uint64), counts, groups, total[0] or 0, total[1])
    own = F.array(*[F.lit(int(w)) for w in model.own.view(np.int64)]) if len(model.own) else F.array().cast("array<long>")
    place = F.array_position(own, F.col("word")).cast("int")
    kind = F.when(F.col("word") == int(END), 0).when(place > 0, place).otherwise(F.col("group") + 1 + FREQUENT)
    for r in vocabulary.groupBy(kind.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        # A group of words keeps a place for an unknown one.
        model.size[r["k"]] = r["c"] + ADDED * (r["v"] + (r["k"] > FREQUENT))
    model.weigh()
    part = (_crc(F.col("doc_id")) / FOLDS).cast("long") % ROUNDS
    for number in range(ROUNDS):
        _train_round(rows.where(part == number), model)
    tail = vocabulary.where(F.col("c") < least) if least is not None else vocabulary
    return model, tail.select("word", "c")


def score(docs: DataFrame, model: Model, tail: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) its counts and its base and model scores."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = _ROW.format(id=rows.schema["doc_id"].dataType.simpleString())
    names = [f.split()[0] for f in schema.split(", ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = sent.value, TaskContext.get().partitionId() << 33
        scale = np.log10(own.total) - np.log10(own.size)
        rest = np.log10(own.total) - np.log10(own.rest)
        for batch in tokens.parts(batches, 2, PART):
            stream, group, borders = _stream(batch.column(2))
            n, sizes = batch.num_rows, np.diff(borders)
            row = np.repeat(np.arange(n), sizes)
            token, features, softmax, drawn, classes, numbers = own.choices(stream, group, borders)
            shares = own.drawn_shares(features, softmax, drawn)
            gain = np.bincount(token, shares, len(stream)) / np.log(10)
            words, place = np.unique(stream, return_inverse=True)
            at, known = own.known(words)
            logs = np.where(known, np.log10(own.counts[at] + ADDED), 0.0) if len(own.words) else np.zeros(len(words))
            # The token's share among all that the last softmax leaves: a numbered word is alone.
            alone = (numbers > 0) & (classes > FREQUENT)
            left = np.where(classes > FREQUENT, rest[np.maximum(classes - FREQUENT - 1, 0)], scale[classes])
            gain += np.where(alone, np.log10(own.total) - logs[place], left)
            key = number + np.arange(n)
            number += n
            empty = lambda kind, size=n: pa.nulls(size, kind)
            sums = lambda x: np.bincount(row, x, n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes),
                    pa.array(sums(known[place]).astype(np.int64)),
                    pa.array(sums(logs[place])),
                    pa.array(sums(gain)),
                    empty(pa.int64()),
                    empty(pa.int64()),
                ],
                names,
            )
            # Words that are not in the head, once per row.
            below = np.flatnonzero(~known[place])
            pairs, count = np.unique(row[below] * len(words) + place[below], return_counts=True)
            m, word = len(pairs), words[pairs % len(words)].view(np.int64)
            nothing = [pa.nulls(m, c.type) for c in (batch.column(0), batch.column(1))]
            more = [pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[pairs // len(words)]), *nothing, *more, pa.array(word), pa.array(count)], names
            )

    made = written(rows.mapInArrow(apply, schema), "scores")
    asked = made.where(F.col("word").isNotNull()).select("key", "word", "n")
    c = F.coalesce("c", F.lit(0))
    looked = asked.join(tail, "word", "left").select(
        "key", (F.col("n") * F.log10(c + ADDED)).alias("rest"), F.when(c > 0, F.col("n")).otherwise(0).alias("more")
    )
    added = looked.groupBy("key").agg(F.sum("rest").alias("rest"), F.sum("more").alias("more"))
    base = F.col("head") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(model.total))
    return (
        made.where(F.col("n_tokens").isNotNull())
        .join(added, "key", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
            F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            (base + F.col("gain")).alias("score"),
        )
    )


def score_report(docs: DataFrame) -> DataFrame:
    """Scores of all rows of `docs`, learnt from those that are not held out."""
    rows = docs.select("doc_id", "text")
    model, tail = fit(rows.where(~held_out(F.col("doc_id"))))
    return score(rows, model, tail)
