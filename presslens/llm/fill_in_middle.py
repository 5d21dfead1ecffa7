"""Fill-in-middle: documents cut into prefix, middle and suffix and put in another order for training.

A batch of documents is handled as columns with `pyarrow.compute`, no Python object is made per row or unit: texts
are split into lists of units, the lists are flattened with the number of the row each unit comes from, a unit's
ordinal in its row says whether it is prefix, middle or suffix, the units of each role are filtered and made lists
again, and the pieces are joined. A unit is a word with the white space before it, or white space at the end.

The cuts and the form depend on a hash of the id only, so reruns agree. Nothing is shuffled, and batches are handled in
parts of bounded size, so memory is bounded by the longest text.

Defined results: a null text is an empty one, which is always `plain`; a text that holds a sentinel is `plain`, as it
could not be told apart otherwise; a null id is hashed as an empty one; repeated rows have equal results; an empty
table has an empty result; all other columns are ignored. `restore` gives back the exact text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import tokens

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
# Of 100 documents, how many are transformed, and how many of those have the suffix first.
RATE = 50
SUFFIX_FIRST = 80
UNIT = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
# Stands before each unit while a text is split; in texts that hold it, it is written as two others before.
_MARK, _ESCAPE = "\x00", "\x01"


def _remainder(value: pa.Array, divisor: pa.Array) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, divisor), divisor))


def _units(text: pa.Array) -> tuple[pa.ListArray, bool]:
    """The units of each text behind one empty string, and whether the texts had to be escaped."""
    escaped = bool(pc.any(pc.match_substring_regex(text, f"[{_MARK}{_ESCAPE}]")).as_py())
    if escaped:
        text = pc.replace_substring(text, _ESCAPE, _ESCAPE + "e")
        text = pc.replace_substring(text, _MARK, _ESCAPE + "m")
    return pc.split_pattern(pc.replace_substring_regex(text, UNIT, _MARK + r"\1"), _MARK), escaped


def _unescaped(text: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(text, _ESCAPE + "m", _MARK), _ESCAPE + "e", _ESCAPE)


def _joined(values: pa.Array, parents: np.ndarray, rows: int) -> pa.Array:
    """The values of each row in order, as one string."""
    offsets = pa.array(np.searchsorted(parents, np.arange(rows + 1)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "")


def _any_of(text: pa.Array, patterns: tuple[str, ...]) -> pa.Array:
    found = pc.match_substring(text, patterns[0])
    for pattern in patterns[1:]:
        found = pc.or_(found, pc.match_substring(text, pattern))
    return found


def arranged(text: pa.Array, hashes: list[pa.Array], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> dict[str, pa.Array]:
    """Number of units, form, characters of prefix and middle, and output of each text; four numbers a row decide."""
    rows = len(text)
    units, escaped = _units(text)
    n = pc.cast(pc.subtract(pc.list_value_length(units), 1), pa.int64())
    cuts = [_remainder(h, pc.add(n, 1)) for h in hashes[:2]]
    low, high = (f(*cuts) for f in (pc.min_element_wise, pc.max_element_wise))
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units).to_numpy()
    ordinal = np.arange(len(parent)) - np.searchsorted(parent, np.arange(rows))[parent]
    role = (ordinal > low.to_numpy()[parent]).astype(np.int8) + (ordinal > high.to_numpy()[parent])
    pieces = []
    for k in range(3):
        inside = role == k
        piece = _joined(flat.filter(pa.array(inside)), parent[inside], rows)
        pieces.append(_unescaped(piece) if escaped else piece)
    prefix, middle, suffix = pieces
    plain = pc.or_(pc.equal(n, 0), _any_of(text, (PREFIX, SUFFIX, MIDDLE)))
    plain = pc.or_(plain, pc.greater_equal(_remainder(hashes[2], pa.scalar(100)), rate))
    first = pc.less(_remainder(hashes[3], pa.scalar(100)), suffix_first)
    form = pc.if_else(plain, "plain", pc.if_else(first, "spm", "psm"))
    joined = lambda *parts: pc.binary_join_element_wise(*parts, "")
    psm = joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    spm = joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    size = lambda piece: pc.if_else(plain, None, pc.cast(pc.utf8_length(piece), pa.int64()))
    output = pc.if_else(plain, text, pc.if_else(first, spm, psm))
    return {"n": n, "form": form, "prefix_chars": size(prefix), "middle_chars": size(middle), "output": output}


def rebuilt(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that the outputs were made of: behind each sentinel is one piece, no text holds a sentinel."""
    plain = pc.equal(form, "plain")
    # One string between any two pieces, so that a plain output counts as one piece and two empty ones.
    shaped = pc.if_else(plain, pc.binary_join_element_wise(PREFIX, "", SUFFIX, MIDDLE, ""), output)
    head, middle = (pc.list_element(pc.split_pattern(shaped, MIDDLE), k) for k in (0, 1))
    suffix_first = pc.equal(form, "spm")
    # psm: <P>prefix<S>suffix; spm: <S>suffix<P>prefix.
    ends = []
    for inner, chosen in ((SUFFIX, pc.invert(suffix_first)), (PREFIX, suffix_first)):
        parts = pc.split_pattern(pc.if_else(chosen, head, PREFIX + SUFFIX if inner == SUFFIX else SUFFIX + PREFIX), inner)
        ends.append([pc.utf8_slice_codeunits(pc.list_element(parts, 0), len(inner)), pc.list_element(parts, 1)])
    (psm_prefix, psm_suffix), (spm_suffix, spm_prefix) = ends
    prefix = pc.if_else(suffix_first, spm_prefix, psm_prefix)
    suffix = pc.if_else(suffix_first, spm_suffix, psm_suffix)
    return pc.if_else(plain, output, pc.binary_join_element_wise(prefix, middle, suffix, ""))


def transform(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n, form, prefix_chars, middle_chars and the output."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.parts(batches, 1):
            made = arranged(batch.column(1), [batch.column(2 + k) for k in range(4)], rate, suffix_first)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], ["doc_id", *made])

    identity = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {identity}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", text, *numbers).mapInArrow(apply, schema)


def restore(rows: DataFrame) -> DataFrame:
    """The rows of `transform`, with the column `restored`: the text rebuilt from output and form alone."""
    place, form = rows.columns.index("output"), rows.columns.index("form")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.parts(batches, place):
            text = rebuilt(batch.column(place), batch.column(form))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(apply, f"{schema}, restored string")


def digest_report(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) what was done, with digests of the output and of the text restored from it."""
    rows = restore(transform(docs.select("doc_id", "text")))
    digest = lambda name: F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


DIGEST_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), numbered AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM cut
), placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
), pieces AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces
"""
