"""Similarity join of documents on the Jaccard similarity of their five-word shingles.

Documents with equal sets become one class first, named by a 64-bit digest of the set. All that follows
works on classes, so copies cost nothing.

Prefixes. Shingles are ordered rare first, by the number of documents in their frequency bucket (of
`BUCKETS`, counted over all documents) and then by hash. Two sets that link share a shingle among the first
n - ceil(0.8 n) + 1 of each. Prefix shingles that only one class has are dropped, and of those that the
same classes have one stands for all, with their number as its weight.

Candidates. Two sets that link share at least t prefix shingles, t from their lengths. So, with the groups of a class in
the order of their size, larger ones first, a pair need only be looked at in groups with which the weights of either class add
up to t; the last one that they share is such a group. There the pair must pass the length and the positional filter, and
an upper bound of the overlap from bitmaps of the whole sets (suffix filter). Pairs are made distinct and are verified
once on the whole sets. Links are merged into components.

In each of `STARS` rounds a class of the largest component of every group stands for it, and each class outside is
paired with two of those that it meets, so a round has at most two pairs a class. A group whose classes are all in one
component needs no more pairs, for those could not change a component. Afterwards all classes outside a
group's largest component are paired with the classes of other components. So the pairs within a large component are never
expanded, and no link between components is lost. A pair that shares many groups is made at the last of them: each row knows
the `BEHIND` groups that follow for its class, and where two rows have one of these in common their pair is left to it. The
rounds are the same at every size; the tables of a round go when the next one has been written.

Defined results: A-Z are lower-cased; a set of fewer than five words is the whole sequence; a null or
blank text has no shingles and links with nothing; a null id belongs to no component and links nothing; rows that
repeat an id stand for the same document; an empty table gives an empty result. Only `doc_id` and `text` are
read. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm import tokens
from presslens.llm.common import Scratch, small, written

SHINGLE = 5
# Similarity as a fraction of whole numbers, so that the bound is exact.
OVER, UNDER = 80, 100
BUCKETS = 1 << 18
# Words of 64 bits in the bitmap of a set.
SIGNS = 16
BROADCAST_BYTES = 32 << 20
# Rounds in which classes meet two others each, before all that is left is paired.
STARS = 2
# Groups behind one by which a pair is known to be met again.
BEHIND = 16


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingles of each row."""
    words, rows = tokens.word_hashes(column, fold=True)
    shingles = tokens.grams(words, list(range(SHINGLE)))
    result = []
    for a, b in zip(rows[:-1], rows[1:]):
        if b - a >= SHINGLE:
            result.append(np.unique(shingles[a : b - SHINGLE + 1]))
        elif b > a:
            # Shorter sequences are their own shingle, apart from those of other lengths.
            whole = tokens.grams(words[a:b], list(range(b - a))) ^ np.uint64(b - a)
            result.append(tokens.mixed(whole))
        else:
            result.append(np.empty(0, np.uint64))
    return result


def _key(shingles: np.ndarray) -> int:
    """A digest of a set."""
    if not len(shingles):
        return 0
    total = tokens.mixed(shingles ^ np.uint64(0x1234567)).sum(keepdims=True) + np.array([len(shingles)], np.uint64) * tokens.GRAM[7]
    return int(tokens.mixed(total)[0].view(np.int64))


def _least_overlap(n: int, m: int) -> int:
    """The smallest intersection with which sets of n and m members link."""
    return -(-OVER * (n + m) // (UNDER + OVER))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _classes(rows: DataFrame) -> DataFrame:
    """(doc_id, key, n, signs) of every row: its class, the size of its set, and a bitmap of it of fixed size."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.parts(batches, 1):
            sets = _sets(batch.column(1))
            signs = np.zeros((len(sets), SIGNS), np.uint64)
            for row, s in zip(signs, sets):
                np.bitwise_or.at(row, (s >> np.uint64(32)) % np.uint64(SIGNS), np.uint64(1) << (s >> np.uint64(58)))
            ends = np.arange(len(sets) + 1, dtype=np.int32) * SIGNS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(signs.ravel().view(np.int64))),
                ],
                ["doc_id", "key", "n", "signs"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, key long, n long, signs array<long>")


def _frequencies(rows: DataFrame) -> np.ndarray:
    """How many documents have a shingle of each bucket: a table of fixed size, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in tokens.parts(batches, 1):
            sets = [np.empty(0, np.uint64), *_sets(batch.column(1))]
            held += np.bincount((np.concatenate(sets) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["bucket", "n"])

    summed = rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(BUCKETS, np.int64)
    table[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return table


def _prefixes(rows: DataFrame, frequencies) -> DataFrame:
    """(shingle, key, n, at) of the prefix shingles of every set."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = frequencies.value
        for batch in tokens.parts(batches, 1):
            parts, keys, sizes, places = [np.empty(0, np.uint64)], [], [], []
            for s in _sets(batch.column(1)):
                n = len(s)
                if n:
                    # Stable, and the set is sorted: ties of the frequency go by hash.
                    order = np.argsort(table[(s % np.uint64(BUCKETS)).astype(np.int64)], kind="stable")
                    length = n + OVER * n // -UNDER + 1
                    parts.append(s[order[:length]])
                    keys.append(_key(s))
                    sizes.append(n)
                    places.append(length)
            at = np.concatenate([np.empty(0, np.int32), *(np.arange(p, dtype=np.int32) for p in places)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(parts).view(np.int64)),
                    pa.array(np.repeat(np.array(keys, np.int64), places)),
                    pa.array(np.repeat(np.array(sizes, np.int32), places)),
                    pa.array(at),
                ],
                ["shingle", "key", "n", "at"],
            )

    return rows.mapInArrow(cut, "shingle long, key long, n int, at int")


def _members(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, members) of the wanted classes: the shingles of one document of each."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.parts(batches, 1):
            sets = [s for s in _sets(batch.column(1)) if len(s)]
            keys = pa.array([_key(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "members"])

    stands = classes.join(small(wanted, BROADCAST_BYTES), "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    read = rows.join(small(stands.select("doc_id").distinct(), BROADCAST_BYTES), "doc_id", "left_semi")
    # An id may have several rows, of the same set or of others.
    made = read.mapInArrow(collect, "key long, members binary").join(small(wanted, BROADCAST_BYTES), "key", "left_semi")
    return made.groupBy("key").agg(F.first("members").alias("members"))


def _bounded(n: Column, m: Column, x: str, y: str) -> Column:
    """The suffix filter: a bit that one bitmap has and the other lacks is a shingle that is not common."""
    lacks = lambda p, q: sum(F.bit_count(F.get(p, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(q, F.lit(i))))) for i in range(SIGNS))
    least = F.ceil(OVER * (n + m) / F.lit(UNDER + OVER))
    return (n - lacks(x, y) >= least) & (m - lacks(y, x) >= least)


def _fitting(pairs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pairs (a, b) that the suffix filter leaves; bitmaps come to the distinct pairs only."""
    known = classes.join(small(wanted, BROADCAST_BYTES), "key", "left_semi")
    known = known.groupBy("key").agg(F.first("n").alias("n"), F.first("signs").alias("signs"))
    one = known.select(F.col("key").alias("a"), "n", "signs")
    two = known.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("signs").alias("marks"))
    both = pairs.join(one, "a").join(two, "b")
    return both.where(_bounded(F.col("n"), F.col("m"), "signs", "marks")).select("a", "b")


def _linked(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(common >= _least_overlap(len(x), len(y)))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    one = members.select(F.col("key").alias("a"), F.col("members").alias("x"))
    two = members.select(F.col("key").alias("b"), F.col("members").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(verified, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, component) of all keys of links (a, b): each gets the smallest key that it is connected with.

    Every round points each key at the smallest one near it and then at what that one points at, as a join and
    an aggregation; both need only few rounds for long chains, and no key gathers its links.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.written(both.distinct(), "edges")
    label = scratch.written(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c"), F.lit(True).alias("moved")), "labels")
    while True:
        old = label.select("a", "c")
        near = edges.join(old.select(F.col("a").alias("b"), F.col("c").alias("d")), "b").groupBy("a").agg(F.min("d").alias("d"))
        # A smaller label near a key is also told to the label it had, so that whole trees hang over at once.
        told = old.join(near, "a").select("a", "c", F.least("c", "d").alias("d"))
        hung = told.select("a", "d").unionByName(told.select(F.col("c").alias("a"), "d")).groupBy("a").agg(F.min("d").alias("d"))
        jumped = hung.join(hung.select(F.col("a").alias("d"), F.col("d").alias("e")), "d", "left")
        fresh = jumped.select("a", F.least("d", F.coalesce("e", "d")).alias("c"))
        joined = old.withColumnRenamed("c", "old").join(fresh, "a")
        new = scratch.written(joined.select("a", F.least("c", "old").alias("c"), (F.col("c") < F.col("old")).alias("moved")), "labels")
        scratch.drop(label)
        label = new
        if new.where("moved").isEmpty():
            named = scratch.written(new.select(F.col("a").alias("key"), F.col("c").alias("component")), "components")
            scratch.drop(edges, new)
            return named


def _passing(pairs: DataFrame) -> DataFrame:
    """The rows that pass the length and positional filters, of groups in which the pair must be met."""
    n, m = F.col("n"), F.col("m")
    least = F.ceil(OVER * (n + m) / F.lit(UNDER + OVER))
    # What is left behind the common shingle bounds the overlap, this shingle and those before it included.
    bound = 1 + F.least("at", "bt") + F.least(n - F.col("at") - 1, m - F.col("bt") - 1)
    close = (UNDER * F.least(n, m) >= OVER * F.greatest(n, m)) & (bound >= least)
    return pairs.where(close & (F.least("place", "spot") >= _least_common(n, m)))


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _least_common(n: Column, m: Column) -> Column:
    """How many prefix shingles two sets of n and m members share at least if they link.

    Of the set whose prefix ends first, common shingles lie in both prefixes or behind its own.
    """
    behind = F.ceil(OVER * F.greatest(n, m) / F.lit(UNDER)) - 1
    return F.ceil(OVER * (n + m) / F.lit(UNDER + OVER)) - behind


def _distinct_groups(groups: DataFrame) -> DataFrame:
    """The groups (shingle, key, n, at) with different classes, with their size and the number of shingles that each
    stands for as its weight.

    Groups are told apart by 128 bits of the hashes of their keys. Any shingle may stand for the others, since the
    filters hold at every common one.
    """
    marks = [F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"x{i}") for i in range(2)]
    alike = groups.groupBy("shingle").agg(F.count("*").alias("size"), *marks)
    stands = alike.groupBy("size", "x0", "x1").agg(F.min("shingle").alias("shingle"), F.count("*").alias("weight"))
    return groups.join(stands.select("shingle", "size", "weight"), "shingle")


def _groups(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(shingle, key, n, at, place) of the groups of classes; `place` is the weight of a class's groups up to this one."""
    sent = rows.sparkSession.sparkContext.broadcast(_frequencies(rows))
    prefixes = _prefixes(rows, sent).groupBy("shingle", "key").agg(F.first("n").alias("n"), F.first("at").alias("at"))
    # A first look at the groups by their smallest and largest key, which is combined in each task.
    ends = _prefixes(rows, sent).groupBy("shingle").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    common = scratch.written(ends.where("low < high").select("shingle"), "shingles")
    groups = scratch.written(prefixes.join(small(common, BROADCAST_BYTES), "shingle", "left_semi"), "groups")
    larger_first = Window.partitionBy("key").orderBy(F.desc("size"), "shingle")
    placed = _distinct_groups(groups).withColumn("place", F.sum("weight").over(larger_first)).drop("size", "weight")
    placed = scratch.written(placed, "groups")
    scratch.drop(common, groups)
    return placed


def class_components(rows: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, component) of the classes that link with another class."""
    groups = _groups(rows, scratch)
    label = scratch.written(rows.sparkSession.createDataFrame([], "key long, component long"), "components")
    for number in range(STARS + 1):
        named = groups.join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
        named = scratch.written(named, "named")
        # The component that has most rows of each group, and one of its classes; groups of one component are done.
        star = F.min_by(F.struct("key", "n", "at", "place"), F.xxhash64("key", F.lit(number))).alias("star")
        shares = named.groupBy("shingle", "component").agg(F.count("*").alias("c"), star)
        kept = shares.groupBy("shingle").agg(F.max(F.struct("c", "component", "star")).alias("most"), F.count("*").alias("parts"))
        live = kept.where("parts > 1").select("shingle", F.col("most.component").alias("most"), "most.c", "most.star")
        outside = named.join(live, "shingle").where("component <> most").withColumnRenamed("key", "a")
        if number < STARS:
            of_star = (("key", "b"), ("n", "m"), ("at", "bt"), ("place", "spot"))
            met = _passing(outside.select("a", "n", "at", "place", "c", *(F.col(f"star.{x}").alias(y) for x, y in of_star)))
            # One partner from the largest component that a class meets, and one at random.
            large = F.max_by("b", F.struct("c", "b")).alias("large")
            other = F.min_by("b", F.xxhash64("b", F.lit(number))).alias("other")
            chosen = met.groupBy("a").agg(large, other).select("a", F.explode(F.array("large", "other")).alias("b"))
            pairs = _distinct(chosen)
        else:
            pairs = _distinct(_outside_pairs(named, live, classes, scratch))
        found = _links(scratch.written(pairs, "pairs"), rows, classes, scratch)
        # What is connected already is told by one link for each class.
        links = label.select(F.col("key").alias("a"), F.col("component").alias("b")).unionByName(found)
        old, label = label, components(links, scratch)
        scratch.drop(old, found, named)
    scratch.drop(groups)
    return label


def _outside_pairs(named: DataFrame, live: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows outside the largest component against all of other components; two that are both outside, once.

    Only rows that may have a partner at all, by the sizes and places of their group, get the bitmap of their class, with which the
    pairs are filtered before they are made. The last group that two classes share is the same for both, as all classes have their groups
    in one order, and a pair that links passes there; so one that is met again within the next groups is not made yet.
    """
    of_group = named.groupBy("shingle").agg(
        F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("place").alias("top")
    )
    n, two = F.col("n"), F.col("rows") == 2
    partner = F.col("low") + F.col("high") - n
    most = F.when(two, partner).otherwise(F.least("high", F.floor(n * UNDER / F.lit(OVER))))
    least = F.when(two, partner).otherwise(F.greatest("low", F.ceil(n * OVER / F.lit(UNDER))))
    close = (UNDER * F.least(n, least) >= OVER * F.greatest(n, least)) & (UNDER * F.least(n, most) >= OVER * F.greatest(n, most))
    shared = F.least(_least_common(n, least), _least_common(n, most))
    may = named.join(of_group, "shingle").where(close & (F.least("place", "top") >= shared)).select(*named.columns)
    may = scratch.written(may.join(live.select("shingle", "most"), "shingle"), "may")
    keys = scratch.written(may.select("key").distinct(), "keys")
    signs = classes.join(small(keys, BROADCAST_BYTES), "key", "left_semi").groupBy("key").agg(F.first("signs").alias("signs"))
    following = Window.partitionBy("key").orderBy("place").rowsBetween(1, BEHIND)
    signed = may.withColumn("next", F.collect_list("shingle").over(following)).join(signs, "key")
    renamed = (("key", "b"), ("n", "m"), ("at", "bt"), ("component", "other"), ("place", "spot"), ("signs", "marks"), ("next", "then"))
    right = signed.select("shingle", *(F.col(c).alias(d) for c, d in renamed))
    left = signed.where("component <> most").withColumnRenamed("key", "a")
    pairs = _passing(left.join(right, "shingle").where("component <> other and (other = most or a < b)"))
    return pairs.where(_bounded(F.col("n"), F.col("m"), "signs", "marks") & ~F.arrays_overlap("next", "then"))


def _links(pairs: DataFrame, rows: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """The links (a, b) among distinct pairs of classes."""

    def keys(of: DataFrame) -> DataFrame:
        return scratch.written(of.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")

    wanted = keys(pairs)
    fitting = scratch.written(_fitting(pairs, classes, wanted), "fitting")
    left = keys(fitting)
    found = scratch.written(_linked(fitting, _members(rows, classes, left)), "links")
    scratch.drop(pairs, wanted, fitting, left)
    return found


def _report(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The report of `docs`, with nothing left in the scratch folder but what it reads."""
    texts = _texts(docs)
    classes = scratch.written(_classes(texts), "classes")
    known = classes.where("doc_id IS NOT NULL")
    label = class_components(texts.where("doc_id IS NOT NULL"), known, scratch)
    # Classes without a link to another are components of their own.
    named = classes.select("doc_id", "key", "n").join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = scratch.written(named.select("doc_id", "n", "component"), "named")
    least = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = named.where("n > 0").join(least, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )
    alone = named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    scratch.drop_all(named)
    return joined.unionByName(alone)


def join_report(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) the size of its set and the smallest id that links lead to."""
    return _report(docs, Scratch(docs.sparkSession, "jaccard"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, with all their columns.

    Rows without an id stay. An id that several rows have goes as soon as one of its texts is a
    copy of an earlier document.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    gone = _report(docs, scratch).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = written(gone, "gone")
    scratch.drop_all()
    gone = small(gone, BROADCAST_BYTES)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
