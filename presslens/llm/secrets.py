"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean trigram query, an OR of ANDs of three-letter
strings that every match must contain. The index holds postings (trigram, document key) of the trigrams
that some query names, over lower-cased texts. Postings are intersected by adding up, per document and
clause, one bit per trigram. Only candidates are checked with a rule's expression; a rule with a clause
without trigrams (a class of characters only) scans every document. All of it is column expressions; the
queries are derived once on the driver from the handful of rules.

The document key is a hash of id and text: two rows that share it only become candidates together, and
candidates are checked on their own text, so no key can give a wrong span.

Defined results: a null or empty text has no spans; null ids and repeated rows are scanned like any
other; an empty table gives an empty result. Offsets count code points, ends are exclusive. Texts of any
length are read whole. Only the named columns are read, others are handed through.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser  # the tree of an expression; there is no public way to it

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import unused


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern` whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The kinds every report counts, in the order in which spans that start together are listed. A run of 24
# or more of the hex class is the same as a whole run that is then checked for its length.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published token formats that the base kinds do not describe.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("bearer", r"(?i)bearer\x20+([A-Za-z0-9._~+/-]{20,})"),
)
RULES = BASE + MORE
# What may stand before a line of a key, as in quotations and program text.
_MARGIN = r"""[\s>#"',|\\-]*"""
# A private key with its body: up to the END line if no other key begins before it, else over lines of base64.
# Repeated groups are bounded, as Java's expressions recurse over them; the largest keys in use have 200 lines.
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,400}-{5,}END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_MARGIN}(?:Proc-Type: ?[0-9]+, ?[A-Z]+|DEK-Info: ?[A-Z0-9-]+(?:, ?[0-9A-Fa-f]+)?)){{0,4}}"
    rf"(?:{_MARGIN}[A-Za-z0-9+/=]{{16,}}){{0,400}}"
    rf"(?:(?=[^A-Za-z0-9+/=]){_MARGIN}[A-Za-z0-9+/]{{1,15}}={{1,2}}|\r?\n[>#|-]?\x20?[A-Za-z0-9+/]{{1,15}}(?=\s*(?:\n|$)))?)"
)
# The rules by which texts are redacted; the spans of the report end with the BEGIN line, as its SQL has them.
REDACTED = tuple(Rule("pem", PRIVATE_KEY) if r.kind == "pem" else r for r in RULES)
# An expression with more alternatives than this is scanned for in every document.
ALTERNATIVES = 64
# Bits that fit into a clause; any of its trigrams may be left out, for all of them are necessary.
CLAUSE = 60


def _sequences(tree) -> list[tuple]:
    """What a parsed expression can match, as sequences of characters with None for anything else."""
    found = [()]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            parts = [(chr(value),)]
        elif name == "IN" and len(value) <= 5 and all(str(o) == "LITERAL" for o, _ in value):
            parts = [(chr(v),) for _, v in value]
        elif name == "SUBPATTERN":
            parts = _sequences(value[3])
        elif name == "BRANCH":
            parts = [s for branch in value[1] for s in _sequences(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = value
            once = _sequences(inner)
            if (low, high) == (0, 1) and all(None not in s for s in once):
                parts = [(), *once]
            elif low >= 1:
                parts = [s if high == low == 1 else (*s, None, *s) for s in once]
                parts = parts if low > 1 or high == 1 else [(*s, None) for s in once]
            else:
                parts = [(None,)]
        elif name == "AT":
            parts = [()]
        else:
            parts = [(None,)]
        if len(found) * len(parts) > ALTERNATIVES:
            parts = [(None,)]
        found = [a + b for a, b in product(found, parts)]
    return list(dict.fromkeys(found))


def trigram_query(pattern: str) -> list[list[str]] | None:
    """OR of ANDs of lower-case trigrams that every match contains, or None if a match needs none."""
    clauses = []
    for sequence in _sequences(_parser.parse(pattern)):
        grams = {
            "".join(sequence[i : i + 3]).lower()
            for i in range(len(sequence) - 2)
            # Only ASCII is lowered alike everywhere.
            if None not in sequence[i : i + 3] and "".join(sequence[i : i + 3]).isascii()
        }
        if not grams:
            return None
        clauses.append(sorted(grams)[:CLAUSE])
    return [list(c) for c in dict.fromkeys(map(tuple, clauses))]


def postings(docs: DataFrame, grams: list[str], key: Column, text: Column) -> DataFrame:
    """The inverted index (trigram, key) of the given trigrams over lower-cased texts."""
    lowered = docs.select(key.alias("key"), F.lower(text).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return lowered.select(F.explode(held).alias("trigram"), "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Per key the rules of which some clause has all its trigrams: (key, rules)."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    rows = [
        (gram, kind, clause, 1 << bit, (1 << len(grams)) - 1)
        for kind, clauses in queries.items()
        for clause, grams in enumerate(clauses or [])
        for bit, gram in enumerate(grams)
    ]
    # As many rows as the given rules have trigrams.
    wanted = index.sparkSession.createDataFrame(rows, "trigram string, kind string, clause int, bit long, need long")
    met = (
        index.join(F.broadcast(wanted), "trigram")
        .groupBy("key", "kind", "clause", "need")
        .agg(F.bit_or("bit").alias("bits"))
        .where(F.col("bits") == F.col("need"))
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("rules"))


def _running(parts: Column) -> Column:
    """Spans (start, end, size) from (gap, length, size); in blocks, so that appending stays cheap."""
    block = 256
    kind = "array<struct<start:int,end:int,size:int>>"
    blocks = F.transform(F.sequence(F.lit(0), F.size(parts) - 1, F.lit(block)), lambda i: F.slice(parts, i + 1, block))
    long = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x["gap"] + x["length"]))
    starts = F.aggregate(
        long, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )

    def of_block(rows, start):
        def step(a, x):
            begin = a["at"] + x["gap"]
            end = begin + x["length"]
            span = F.struct(begin.alias("start"), end.alias("end"), x["size"].alias("size"))
            return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

        nothing = F.struct(start.alias("at"), F.array().cast(kind).alias("spans"))
        return F.aggregate(rows, nothing, step, lambda a: a["spans"])

    return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), of_block))


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """The rule's spans in a text: the lengths of matches and of the gaps between them, summed up."""
    kind = "array<struct<start:int,place:int,kind:string,end:int>>"
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    zipped = F.arrays_zip(
        F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole)).alias("g"), whole.alias("m"), sized.alias("s")
    )
    parts = F.transform(
        zipped,
        lambda z: F.struct(
            F.length(z["g"]).alias("gap"), F.length(z["m"]).alias("length"), F.length(z["s"]).alias("size")
        ),
    )
    good = F.filter(_running(parts), lambda s: s["size"] >= rule.least)
    listed = F.transform(
        good,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("place"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")
        ),
    )
    # A first look without positions, as most texts have no match.
    return F.when(F.regexp_like(text, pattern), listed).otherwise(F.array().cast(kind))


def with_spans(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Add `spans`, an array of (start, place, kind, end) sorted by start and rule, as the last column."""
    name, key, found = unused(docs, "spans"), unused(docs, "_key"), unused(docs, "_rules")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    keyed = F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))
    grams = sorted({g for r in rules for clause in trigram_query(r.pattern) or [] for g in clause})
    indexed = [r for r in rules if trigram_query(r.pattern)]
    rows = docs.withColumn(key, keyed)
    if indexed:
        hits = candidates(postings(docs, grams, keyed, text), tuple(indexed))
        rows = rows.join(hits.select(F.col("key").alias(key), F.col("rules").alias(found)), key, "left")
    else:
        rows = rows.withColumn(found, F.lit(None).cast("array<string>"))
    lists = [
        F.when(F.array_contains(F.col(f"`{found}`"), r.kind), _spans(r, i, text)) if r in indexed else _spans(r, i, text)
        for i, r in enumerate(rules)
    ]
    empty = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    spans = F.sort_array(F.concat(*[F.coalesce(x, empty) for x in lists]))
    return rows.withColumn(name, spans).drop(key, found).select(*[f"`{c}`" for c in docs.columns], f"`{name}`")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secrets_report(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) the counts of the base kinds, their digest, and all spans."""
    found = with_spans(docs.select("doc_id", "text"))
    spans = F.col("spans")
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["place"] < len(BASE))
    return found.select(
        "doc_id",
        *[of(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redact(docs: DataFrame, length_column: str | None = "n_chars") -> DataFrame:
    """All rows of `docs` with each span of a secret replaced by its kind in brackets.

    A private key goes with its body. Spans that overlap become one, named after the first. A null text stays null. `length_column`, where
    the table has it, is set to the new length of changed texts.
    """
    found = with_spans(docs, REDACTED)
    name = found.columns[-1]
    text, spans = F.col("text"), F.col(f"`{name}`")
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a, s):
        fresh = F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), s["kind"], F.lit("]")))
        parts = F.when(s["start"] >= a["at"], F.concat(a["parts"], fresh)).otherwise(a["parts"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), parts.alias("parts"))

    clean = F.aggregate(
        spans, nothing, step, lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1))
    )
    changed = F.size(spans) > 0
    out = found.withColumn("text", F.when(changed, clean).otherwise(text))
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        out = out.withColumn(
            length_column, F.when(changed, F.length("text").cast(kind)).otherwise(F.col(length_column))
        )
    return out.drop(name)


def _sql() -> str:
    """The same rows from DuckDB: positions are summed over the lengths of matches and gaps."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(RULES):
        p = quote(r.pattern)
        parts.append(
            f"SELECT id, {i} AS place, {quote(r.kind)} AS kind, {r.least} AS least, "
            f"regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {r.group}) AS s, "
            f"string_split_regex(t, {p}) AS g FROM d"
        )
    base = ", ".join(
        f"count(*) FILTER (WHERE kind = '{r.kind}')::BIGINT AS n_{r.kind}" for r in BASE
    )
    listed = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place)"
    return f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(parts)}),
e AS (SELECT id, place, kind, least, unnest(m) AS m, unnest(s) AS s, unnest(g[1:len(m)]) AS g, unnest(range(len(m))) AS i
  FROM f WHERE len(m) > 0),
p AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY id, place ORDER BY i)::BIGINT AS b FROM e),
q AS (SELECT id, place, kind, b - length(m) AS a, b FROM p WHERE length(s) >= least),
c AS (SELECT id, {base},
  coalesce({listed} FILTER (WHERE place < {len(BASE)}), '') AS base, coalesce({listed}, '') AS spans FROM q GROUP BY id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN c USING (id)"""


SECRETS_SQL = _sql()
