"""Conversation structure repair: the cheapest edits that make a conversation an optional system turn and then
user and assistant turns by turns, found on compressed sequences of roles and faults.

A row is a letter: its role's initial (s, u, a, other) and its fault (none, truncated, blank, duplicate). The letters
of a conversation, in order, are cut into pieces of bounded length. Re-Pair makes a grammar for all pieces together: each
round, Spark counts the adjacent pairs of symbols of all distinct pieces, and the most frequent ones become rules. A
rule has one min-plus transfer matrix over the four states of the wanted role pattern, made from those of its two parts
bottom-up and shared by all conversations that use it; an entry is the cost and the audit, a rope of edit initials whose
parts are those of the entries it was made from. Distinct pieces are evaluated once; their matrices are joined to the
conversations, which fold them from the first state to an accepting one.

Among equal costs the ASCII-least audit wins. This can be decided part by part: from one state the edits fix the path,
so one of two audits of equal cost between the same states is never the other one's beginning.

A long conversation is dealt over tasks by ranges of turns for the letters, and its pieces are evaluated apart. Its repaired
rows, and their digest, which is made of all of them in order, come from one sorted stream that holds a row at a time.
The driver gets at most `WIDTH` pairs a round. Pairs beyond that, and those after the last round, are only not shared.

Defined results: a null id is a conversation of its own; null turns come first and count for no gap; a null role or
text is one space; rows of equal turn are in the order of role, then of the text's MD5; repeated rows are
rows, all but the first of them duplicates; a conversation without rows (or with dropped ones only) has zeros, an empty audit and
the digest of nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import SPACES, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
# Letters of a piece; rules of a round; rounds.
PIECE = 1024
WIDTH = 256
ROUNDS = 6
# Initials and faults that letters are made of: letter 4 * initial + fault, from A.
NO_FAULT, CUT, BLANK, DUPLICATE = range(4)
# States of the role pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ACCEPTING = (START, ASSISTANT)


def letter_of(initial: int, fault: int) -> str:
    return chr(ord("A") + 4 * initial + fault)


# A string, or a pair of ropes that stands for the one and then the other, and shares them.
Rope = str | tuple


def joined(left: Rope, right: Rope) -> Rope:
    return left if right == "" else right if left == "" else (left, right)


def text_of(rope: Rope) -> str:
    parts, open_ = [], [rope]
    while open_:
        part = open_.pop()
        if isinstance(part, str):
            parts.append(part)
        else:
            open_ += (part[1], part[0])
    return "".join(parts)


def less(one: Rope, other: Rope) -> bool:
    """Whether the first string comes before the second one; parts that both share at one place are not read."""
    a, b = [one], [other]
    while a and b:
        x, y = a.pop(), b.pop()
        if x is y:
            continue
        if not isinstance(x, str):
            a += (x[1], x[0])
            b.append(y)
        elif not isinstance(y, str):
            b += (y[1], y[0])
            a.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x < y
            a += [x[n:]] if x[n:] else []
            b += [y[n:]] if y[n:] else []
    return bool(b)


# A matrix is a dictionary: (state before, state after) -> (cost, audit).
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def better(found: tuple | None, cost: int, audit: Rope) -> tuple:
    if found is None or cost < found[0] or cost == found[0] and less(audit, found[1]):
        return cost, audit
    return found


def product(left: Matrix, right: Matrix) -> Matrix:
    """The cheapest way through both, and the least audit of such ways."""
    after: dict[int, list] = {}
    for (middle, end), (cost, audit) in right.items():
        after.setdefault(middle, []).append((end, cost, audit))
    made: Matrix = {}
    for (begin, middle), (cost, audit) in left.items():
        for end, more, rest in after.get(middle, ()):
            found = made.get((begin, end))
            total = cost + more
            if found is None or total < found[0]:
                made[begin, end] = total, joined(audit, rest)
            elif total == found[0]:
                both = joined(audit, rest)
                if less(both, found[1]):
                    made[begin, end] = total, both
    return made


def _next(state: int) -> int:
    """The state after a user or assistant turn, whichever the pattern asks for."""
    return ASSISTANT if state == USER else USER


def insertions() -> Matrix:
    """No, one or two inserted turns; a third would only lead back."""
    made: Matrix = {(s, s): (0, "") for s in range(STATES)}
    for state in range(STATES):
        one = _next(state)
        for times, end in ((1, one), (2, _next(one))):
            made[state, end] = better(made.get((state, end)), times * COSTS[INSERT], INSERT * times)
    return made


def letter_matrix(letter: str) -> Matrix:
    """Insertions before a row of this letter, and what is done with the row."""
    initial, fault = divmod(ord(letter) - ord("A"), 4)
    more = TRUNCATED if fault == CUT else 0
    made: Matrix = {}
    for state in range(STATES):
        made[state, state] = COSTS[DELETE], DELETE
        if fault in (BLANK, DUPLICATE):
            continue
        end = _next(state)
        made[state, end] = better(made.get((state, end)), COSTS[REROLE] + more, REROLE)
        if initial == 0 and state == START:
            made[state, SYSTEM] = COSTS[KEEP] + more, KEEP
        elif initial == 1 and end == USER or initial == 2 and end == ASSISTANT:
            made[state, end] = better(made.get((state, end)), COSTS[KEEP] + more, KEEP)
    return product(insertions(), made)


LETTERS = "".join(letter_of(i, f) for i in range(4) for f in range(4))


class Grammar:
    """Rules of two symbols each, in rounds; the letters are the first symbols."""

    def __init__(self, rounds: list[dict[tuple[int, int], int]] | None = None, matrices: list[Matrix] | None = None):
        self.rounds = rounds or []
        self.matrices = matrices or [letter_matrix(c) for c in LETTERS]

    def add(self, pairs: list[tuple[int, int]]) -> None:
        """A round of rules, each with the product of its parts' matrices."""
        rules = {}
        for left, right in pairs:
            rules[left, right] = len(self.matrices)
            self.matrices.append(product(self.matrices[left], self.matrices[right]))
        self.rounds.append(rules)

    def symbols(self, piece: str) -> list[int]:
        """A piece of letters, with the rules of all rounds applied from left to right."""
        row = [ord(c) - ord("A") for c in piece]
        for rules in self.rounds:
            if len(row) < 2:
                break
            out, k, last = [], 0, len(row) - 1
            while k <= last:
                rule = rules.get((row[k], row[k + 1])) if k < last else None
                out.append(row[k] if rule is None else rule)
                k += 1 if rule is None else 2
            row = out
        return row

    def matrix(self, piece: str) -> Matrix:
        made: Matrix | None = None
        for symbol in self.symbols(piece):
            made = self.matrices[symbol] if made is None else product(made, self.matrices[symbol])
        return {(s, s): (0, "") for s in range(STATES)} if made is None else made


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text and `copies` (0 for a dropped row), damaged by a hash of id and turn."""
    space = F.lit(" ")
    read = lambda name: F.coalesce(F.col(name).cast("string"), space)
    kind = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(read("text"), "[.!?]", "")).otherwise(read("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(read("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _lettered(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn and `run`, the letters of equal rows, in order within partitions that are in order."""
    code = lambda initial, fault: F.char(F.lit(ord("A")) + 4 * initial + fault)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), NO_FAULT).otherwise(CUT)
    rows = rows.select("conv_id", "turn", "role", _digest(), "copies", initial.alias("initial"), fault.alias("fault"))
    rows = rows.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.first("initial").alias("initial"), F.first("fault").alias("fault")
    )
    # Where a role and text occur more than once in a conversation, all but the row of the first turn are duplicates.
    again = rows.where((F.col("copies") > 0) & (F.col("fault") != BLANK))
    again = again.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
    again = again.where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = F.coalesce(F.struct("turn") != F.col("first"), F.lit(False)) & (F.col("fault") != BLANK)
    rows = rows.join(again, same, "left")
    copy = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    begin = code(F.col("initial"), F.when(later, DUPLICATE).otherwise(F.col("fault")))
    rest = F.repeat(code(F.col("initial"), copy), (F.col("copies") - 1).cast("int"))
    run = F.when(F.col("copies") > 0, F.concat(begin, rest)).otherwise(F.lit(""))
    order = ["conv_id", "turn", "role", "digest"]
    rows = rows.select(*order, run.alias("run")).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("conv_id", "turn", "run", F.monotonically_increasing_id().alias("at"))


def _digest() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")


def pieces(rows: DataFrame) -> DataFrame:
    """Per conversation its letters in pieces: conv_id, at, part, seq, and the turns: low, high, turns (distinct)."""
    identity = rows.schema["conv_id"].dataType.simpleString()
    kind = pa.schema([("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        open_: list | None = None  # conv_id, at, letters, number of letters, low, high, turns

        def close() -> None:
            text = "".join(open_[2])
            for part, start in enumerate(range(0, max(len(text), 1), PIECE)):
                # The turns are told once.
                turns = open_[4:] if start == 0 else [None, None, 0]
                held.append([open_[0], open_[1], part, text[start : start + PIECE], *turns])

        for batch in batches:
            identities = batch.column(0).type
            for conv, turn, run, at in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or open_[0] != conv or open_[3] >= PIECE:
                    if open_ is not None:
                        close()
                    open_ = [conv, at, [], 0, None, None, 0]
                if run:
                    open_[2].append(run)
                    open_[3] += len(run)
                    if turn is not None and turn != open_[5]:
                        open_[4] = turn if open_[4] is None else open_[4]
                        open_[5] = turn
                        open_[6] += 1
            if len(held) >= 1000:
                yield flushed(held, identities)
                held = []
        if open_ is not None:
            close()
            yield flushed(held, identities)

    def flushed(held: list[list], identities: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*held))
        types = [identities, pa.int64(), pa.int32(), pa.string(), *kind.types]
        names = ["conv_id", "at", "part", "seq", *kind.names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = f"conv_id {identity}, at long, part int, seq string, low long, high long, turns long"
    return _lettered(rows).mapInArrow(apply, schema)


def compressed(distinct: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> Grammar:
    """The grammar of the distinct pieces (seq, n: how often it occurs).

    A round takes the pairs that occur most, but none that begins with the end of another one of the round or ends with
    its beginning, so that all counted occurrences can be replaced, but for those that overlap themselves.
    """
    grammar = Grammar()
    for _ in range(rounds):
        rules = list(grammar.rounds)

        def count(batches: Iterator[pa.RecordBatch], rules: list = rules) -> Iterator[pa.RecordBatch]:
            known = Grammar(rules)
            for batch in batches:
                found: Counter[tuple[int, int]] = Counter()
                for piece, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    row = known.symbols(piece)
                    for pair in zip(row, row[1:]):
                        found[pair] += n
                left, right = zip(*found) if found else ((), ())
                columns = [pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n"])

        pairs = distinct.select("seq", "n").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = pairs.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(width).collect()
        chosen, begins, ends = [], set(), set()
        for a, b, _n in top:
            if a not in ends and b not in begins:
                chosen.append((a, b))
                begins.add(a)
                ends.add(b)
        if not chosen:
            break
        grammar.add(chosen)
    return grammar


def _illegal(before: str, after: str) -> bool:
    one, other = ((ord(c) - ord("A")) // 4 for c in (before, after))
    return (one, other) not in ((0, 1), (1, 2), (2, 1))


def evaluated(distinct: DataFrame, grammar: Grammar) -> DataFrame:
    """Per distinct piece: its faults, illegal neighbours, and its matrix as `ways` (before, after, cost, audit)."""
    # As plain values, which need no class of this package to be read; at most `WIDTH` * `ROUNDS` rules.
    sent = distinct.sparkSession.sparkContext.broadcast((grammar.rounds, grammar.matrices))
    way = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    counts = ["blank", "duplicate", "truncated", "illegal"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grammar(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.column(0).slice(start, 500)
                numbers, ways = [], []
                for piece in part.to_pylist():
                    fault = Counter((ord(c) - ord("A")) % 4 for c in piece)
                    bad = sum(_illegal(a, b) for a, b in zip(piece, piece[1:]))
                    numbers.append((fault[BLANK], fault[DUPLICATE], fault[CUT], bad))
                    made = known.matrix(piece)
                    ways.append([{"before": i, "after": j, "cost": c, "audit": text_of(a)} for (i, j), (c, a) in made.items()])
                columns = [pa.array(c, pa.int64()) for c in zip(*numbers)]
                yield pa.RecordBatch.from_arrays([part, *columns, pa.array(ways, pa.list_(way))], ["seq", *counts, "ways"])

    ways = "array<struct<before:int,after:int,cost:long,audit:string>>"
    return distinct.select("seq").mapInArrow(apply, f"seq string, {', '.join(c + ' long' for c in counts)}, ways {ways}")


class _Conversation:
    """One conversation of a sorted stream: its pieces, then its rows."""

    def __init__(self, conv):
        self.conv = conv
        self.numbers = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = None
        self.turns, self.last = 0, ""
        self.reached: dict[int, tuple[int, str]] = {START: (0, "")}
        self.audit: str | None = None
        self.place, self.state = 0, START

    def add_piece(self, seq, low, high, turns, blank, duplicate, truncated, illegal, ways) -> None:
        for name, n in (("blank", blank), ("duplicate", duplicate), ("truncated", truncated), ("illegal", illegal)):
            self.numbers[name] += n
        if seq:
            self.numbers["illegal"] += bool(self.last) and _illegal(self.last, seq[0])
            self.last = seq[-1]
        if low is not None:
            # A turn whose rows are cut in two pieces is one.
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        after: dict[int, tuple[int, str]] = {}
        for way in ways:
            if way["before"] in self.reached:
                cost, audit = self.reached[way["before"]]
                after[way["after"]] = better(after.get(way["after"]), cost + way["cost"], audit + way["audit"])
        self.reached = after

    def settle(self) -> None:
        """Choose the end: an accepting state, by insertions behind the last row if need be."""
        best = None
        for (before, after), (cost, audit) in insertions().items():
            if after in ACCEPTING and before in self.reached:
                so_far, edits = self.reached[before]
                best = better(best, so_far + cost, edits + audit)
        self.cost, self.audit = best

    def _turn(self, role: str | None) -> str:
        """The role of the next repaired row; `role` where it is kept."""
        if role is not None and self.state == START and role[:1] == "s":
            self.state = SYSTEM
            return role
        self.state = _next(self.state)
        return role if role is not None else "user" if self.state == USER else "assistant"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.place : self.place + 1] == INSERT:
            self.place += 1
            yield INSERT, self._turn(None), ""

    def rows(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """The repaired rows up to and with these: edit, role and text."""
        for _ in range(copies):
            yield from self.inserted()
            edit = self.audit[self.place]
            self.place += 1
            if edit != DELETE:
                yield edit, self._turn(role if edit == KEEP else None), text


def _streamed(rows: DataFrame) -> DataFrame:
    """Per conversation its evaluated pieces, then its rows, side by side in one partition."""
    found = written(pieces(rows), "conversation-pieces")
    distinct = written(found.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "conversation-sequences")
    judged = evaluated(distinct, compressed(distinct))
    judged = found.join(judged, "seq")
    order = ["kind", "at", "part", "turn", "role", "digest"]
    facts = ["seq", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "ways"]
    none = lambda name, of: F.lit(None).cast(of.schema[name].dataType).alias(name)
    texts = rows.where("copies > 0").select("conv_id", "turn", "role", _digest(), "text", "copies")
    first = judged.select("conv_id", F.lit(0).alias("kind"), "at", "part", *facts, *[none(c, texts) for c in texts.columns[1:]])
    second = texts.select(*[F.lit(1).alias(c) if c == "kind" else F.col(c) if c in texts.columns else none(c, first) for c in first.columns])
    stream = first.unionByName(second).repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return stream.select("conv_id", "kind", *facts, "role", "text", "copies")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, tuple | None]]:
    """Each conversation with its repaired rows one by one, then with None at its end."""
    open_: _Conversation | None = None

    def end() -> Iterator[tuple[_Conversation, tuple | None]]:
        if open_.audit is None:
            open_.settle()
        yield from ((open_, made) for made in open_.inserted())
        yield open_, None

    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            for conv, kind, *facts, role, text, copies in zip(*(c.to_pylist() for c in part.columns)):
                if open_ is None or open_.conv != conv:
                    if open_ is not None:
                        yield from end()
                    open_ = _Conversation(conv)
                if kind == 0:
                    open_.add_piece(*facts)
                else:
                    if open_.audit is None:
                        open_.settle()
                    yield from ((open_, made) for made in open_.rows(role, text, copies))
    if open_ is not None:
        yield from end()


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000, most_text: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or size >= most_text:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _with_copies(rows: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"), copies.cast("long").alias("copies"))


def _id_type(rows: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows of `rows` (conv_id, turn, role, text, and copies if any): conv_id, place, edit, role, text."""
    name, identity = _id_type(rows)
    schema = pa.schema([("conv_id", identity), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            place = 0
            for conversation, row in _conversations(batches):
                if row is not None:
                    yield conversation.conv, place, *row
                place = place + 1 if row is not None else 0

        yield from _in_batches(made(), schema)

    return _streamed(_with_copies(rows)).mapInArrow(apply, f"conv_id {name}, place long, edit string, role string, text string")


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation its gaps and faults, the cost and edits of its repair, and a digest of the repaired rows."""
    name, identity = _id_type(rows)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = [(c, pa.int64()) for c in counts]
    schema = pa.schema([("conv_id", identity), *kinds, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            digest, between = hashlib.sha256(), ""
            for conversation, row in _conversations(batches):
                if row is not None:
                    digest.update(f"{between}{row[1]}:{row[2]}".encode())
                    between = "\n"
                    continue
                c = conversation
                gaps = 0 if c.low is None else c.high - c.low + 1 - c.turns
                yield c.conv, gaps, *c.numbers.values(), c.cost, c.audit, digest.hexdigest()
                digest, between = hashlib.sha256(), ""

        yield from _in_batches(made(), schema)

    columns = ", ".join(f"{c} long" for c in counts)
    return _streamed(_with_copies(rows)).mapInArrow(apply, f"conv_id {name}, {columns}, audit string, repaired_sha256 string")


REPAIR_SQL = r"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT),
                lambda h, b: list_reduce(range(8), lambda r, i: xor(r >> 1, (r & 1) * 3988292384), xor(h, b)),
                4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind
  FROM keyed
), harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM harmed
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS seen FROM placed
), judged AS (
  SELECT *, bare = '' AS blank, bare <> '' AND seen > 1 AS duplicate,
         bare <> '' AND seen = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM seen
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank)::BIGINT AS blank, count(*) FILTER (duplicate)::BIGINT AS duplicate,
         count(*) FILTER (truncated)::BIGINT AS truncated,
         count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal,
         list({'i': initial, 'role': role, 'text': text, 'gone': blank OR duplicate, 'more': CASE WHEN truncated THEN 5 ELSE 0 END}
              ORDER BY place) AS rows
  FROM judged GROUP BY conv_id
), walked AS (
  SELECT *, list_reduce(rows, lambda v, r: list_transform([list_transform([v], lambda w: [
      w[1], w[2],
      list_min([w[3], {'c': w[1].c + 5, 'a': w[1].a || 'I'}, {'c': w[2].c + 5, 'a': w[2].a || 'I'}, {'c': w[4].c + 5, 'a': w[4].a || 'I'}]),
      list_min([w[4], {'c': w[3].c + 5, 'a': w[3].a || 'I'}, {'c': w[1].c + 10, 'a': w[1].a || 'II'}, {'c': w[2].c + 10, 'a': w[2].a || 'II'}])
    ])[1]], lambda w: [
      {'c': w[1].c + 2, 'a': w[1].a || 'D'},
      list_min([{'c': w[2].c + 2, 'a': w[2].a || 'D'},
                {'c': w[1].c + CASE WHEN r.gone OR r.i <> 's' THEN 1000000000 ELSE r.more END, 'a': w[1].a || 'K'}]),
      list_min([{'c': w[3].c + 2, 'a': w[3].a || 'D'},
                {'c': w[1].c + CASE WHEN r.gone OR r.i <> 'u' THEN 1000000000 ELSE r.more END, 'a': w[1].a || 'K'},
                {'c': w[2].c + CASE WHEN r.gone OR r.i <> 'u' THEN 1000000000 ELSE r.more END, 'a': w[2].a || 'K'},
                {'c': w[4].c + CASE WHEN r.gone OR r.i <> 'u' THEN 1000000000 ELSE r.more END, 'a': w[4].a || 'K'},
                {'c': w[1].c + CASE WHEN r.gone THEN 1000000000 ELSE r.more + 1 END, 'a': w[1].a || 'R'},
                {'c': w[2].c + CASE WHEN r.gone THEN 1000000000 ELSE r.more + 1 END, 'a': w[2].a || 'R'},
                {'c': w[4].c + CASE WHEN r.gone THEN 1000000000 ELSE r.more + 1 END, 'a': w[4].a || 'R'}]),
      list_min([{'c': w[4].c + 2, 'a': w[4].a || 'D'},
                {'c': w[3].c + CASE WHEN r.gone OR r.i <> 'a' THEN 1000000000 ELSE r.more END, 'a': w[3].a || 'K'},
                {'c': w[3].c + CASE WHEN r.gone THEN 1000000000 ELSE r.more + 1 END, 'a': w[3].a || 'R'}])
    ])[1], [{'c': 0::BIGINT, 'a': ''}, {'c': 1000000000::BIGINT, 'a': ''}, {'c': 1000000000::BIGINT, 'a': ''}, {'c': 1000000000::BIGINT, 'a': ''}]) AS v
  FROM counted
), chosen AS (
  SELECT *, list_min([v[1], v[4], {'c': v[3].c + 5, 'a': v[3].a || 'I'},
                      {'c': v[1].c + 10, 'a': v[1].a || 'II'}, {'c': v[2].c + 10, 'a': v[2].a || 'II'}]) AS best
  FROM walked
), steps AS (
  SELECT conv_id, best.a AS audit, rows, unnest(range(1, length(best.a) + 1)) AS p FROM chosen
), kept AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit, audit, rows[length(replace(substr(audit, 1, p), 'I', ''))] AS r,
         row_number() OVER (PARTITION BY conv_id ORDER BY p) AS o
  FROM steps WHERE substr(audit, p, 1) <> 'D'
), roled AS (
  SELECT *, max(CASE WHEN o = 1 AND edit = 'K' AND r.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS led FROM kept
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN r.role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY p) AS t
  FROM roled GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
       coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal,
       coalesce(c.best.c, 0)::BIGINT AS cost, coalesce(c.best.a, '') AS audit, sha256(coalesce(t.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN chosen c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
"""
