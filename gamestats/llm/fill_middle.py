"""Fill-in-the-middle: a document's lines cut into prefix, middle and suffix and
put together again with the middle last.

The draws of a document (where it is cut, which form it takes) come from a
SHA-256 of its id, so they are the same wherever and however often it is read.
The texts are cut by a pipeline of ``pyarrow.compute`` kernels over whole
batches: the units of all texts are one flat array with parent indices, each
unit's ordinal in its text gives its role, the units of a role are gathered
back into one list per text, and the lists are joined into pieces.  No kernel
sees more than about ``SLICE_BYTES`` of text beyond a single document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gamestats.llm.common import ship_package

SEED = 7
RATE = 100          # percent of the documents that are rearranged
SUFFIX_FIRST = 50   # percent of those that begin with the suffix
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 8 << 20

MADE = [StructField("n", LongType()), StructField("form", StringType()),
        StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
        StructField("output", StringType())]


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four 32-bit numbers from the first 32 hex digits of the SHA-256 of
    ``seed:doc_id``; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lines of all texts, each with the line feed that ends it: one flat
    array, the text each line belongs to, and its ordinal in that text."""
    lists = pc.split_pattern(texts, "\n")
    flat, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    size = pc.list_value_length(lists).to_numpy()
    ordinal = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    last = pa.array(ordinal == size[parent] - 1)
    whole = pc.binary_join_element_wise(flat, pc.if_else(last, "", "\n"), "")
    # what follows the last line feed is a line only if there is something
    real = pc.not_equal(whole, "")
    keep = real.to_numpy(zero_copy_only=False)
    return whole.filter(real), parent[keep], ordinal[keep]


def gathered(flat: pa.Array, parent: np.ndarray, chosen: np.ndarray, texts: int) -> pa.Array:
    """The chosen units of each text joined into one piece."""
    offsets = np.zeros(texts + 1, np.int32)
    np.cumsum(np.bincount(parent[chosen], minlength=texts), out=offsets[1:])
    lists = pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(chosen)))
    return pc.binary_join(lists, "")


def rearranged(texts: pa.Array, h: list[np.ndarray], rate: int, suffix_first: int) -> list[pa.Array]:
    """The columns of ``MADE`` for texts without nulls and their draws."""
    flat, parent, ordinal = units(texts)
    n = np.bincount(parent, minlength=len(texts)).astype(np.int64)
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    begin, end = np.minimum(a, b)[parent], np.maximum(a, b)[parent]
    prefix = gathered(flat, parent, ordinal < begin, len(texts))
    middle = gathered(flat, parent, (ordinal >= begin) & (ordinal < end), len(texts))
    suffix = gathered(flat, parent, ordinal >= end, len(texts))

    plain = pa.array(h[2] % 100 >= rate)
    plain = pc.or_(plain, pc.equal(texts, ""))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    spm = pa.array(h[3] % 100 < suffix_first)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    one = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    two = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    output = pc.if_else(plain, texts, pc.if_else(spm, two, one))
    none = pa.scalar(None, pa.int64())
    return [pa.array(n), form,
            pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
            pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())), output]


def _slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Start and length of stretches of about ``size`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, stop - at
        at = stop


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE,
                   suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any other columns) with ``n`` (lines),
    ``form``, ``prefix_chars``, ``middle_chars`` (code points) and ``output``.

    A line ends with its line feed; text after the last one is a line too.  Two
    draws, each modulo ``n + 1``, say after how many lines prefix and middle end.
    ``form`` is ``psm`` (prefix, suffix, middle, each behind its mark), ``spm``
    (suffix, prefix, middle) or ``plain``, where ``output`` is the text itself
    and the two lengths are null.

    * A null text counts as empty; an empty text is plain, with ``n`` 0.
    * A text that contains one of the marks is plain, so that ``restored`` gives
      every text back from ``output`` and ``form`` alone.
    * Every row is treated on its own: rows that repeat a ``doc_id`` take the
      same draws, and a null ``doc_id`` draws as an empty one.
    * Input columns named like one of the made ones are replaced.
    * An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    made = [f.name for f in MADE]
    kept = [c for c in docs.columns if c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, size in _slices(batch.column("_text")):
                part = batch.slice(at, size)
                h = [part.column(f"_h{k}").to_numpy() for k in range(4)]
                out = rearranged(part.column("_text"), h, rate, suffix_first)
                rest = part.column("_row").flatten() if kept else []
                yield pa.RecordBatch.from_arrays(rest + out, names=kept + made)

    schema = StructType([f for f in docs.schema.fields if f.name in kept] + MADE)
    # the input's columns travel as one, so their names clash with nothing here
    row = [F.struct(*[F.col(c) for c in kept]).alias("_row")] if kept else []
    return docs.select(
        *row, F.coalesce(F.col("text"), F.lit("")).alias("_text"),
        *[d.alias(f"_h{k}") for k, d in enumerate(draws(F.col("doc_id"), seed))],
    ).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  A rearranged text has none of the
    marks, so the first of each kind is the one that was put there."""
    body = F.substr(output, F.lit(4))

    def between(text: Column, mark: str, part: int) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(part))

    rest = between(body, SUFFIX, 2)
    psm = F.concat(between(body, SUFFIX, 1), between(rest, MIDDLE, 2), between(rest, MIDDLE, 1))
    rest = between(body, PREFIX, 2)
    spm = F.concat(between(rest, MIDDLE, 1), between(rest, MIDDLE, 2), between(body, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts and the SHA-256 of output and restored text."""
    out = fill_in_middle(docs.select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
