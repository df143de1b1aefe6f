"""Fill-in-the-middle transformation: texts are cut in three and their pieces reordered.

Every text is cut into its code points at two places.  A text becomes ``plain``
(itself), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each
piece behind its sentinel.  Places and form are drawn from the first four 8-digit
groups of the hex SHA-256 of ``seed`` and the decimal id, so a rerun, or another
partitioning, gives the same rows.

The work is a ``pyarrow.compute`` pipeline over slices of Arrow batches: texts are
split into list arrays of units, these are flattened with their parent indices, each
unit gets its ordinal in its text, units are filtered by role (before, between or
behind the cuts), lists are rebuilt from them, and ``binary_join`` makes pieces and
output.  No shuffle; a row needs only itself.  A slice holds at most ``BLOCK`` bytes of
text; a longer text goes through in parts, so memory is bounded by ``BLOCK`` for the
units and by the longest text for input and output.

Defined results: null text counts as empty; empty texts, and texts that contain a
sentinel, stay plain, so ``restore`` is exact; a null id draws as the empty string;
repeated rows give repeated results; an empty table gives an empty one; other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINELS = ("<P>", "<S>", "<M>")
SEED = "1:"
FIM_PERCENT, SPM_PERCENT = 90, 20
BLOCK = 1 << 20
OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(id_col: Column, seed: str = SEED) -> list[Column]:
    """Four whole numbers below 2^32 per id."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def check_sentinels(sentinels: Sequence[str]) -> None:
    """A sentinel must not begin inside another one or itself, or pieces that end in
    part of one couldn't be told from it."""
    starts = [s[0] for s in sentinels if s]
    if len(set(sentinels)) != 3 or len(starts) != 3 or any(c in s[1:] for c in starts for s in sentinels):
        raise ValueError("fim: three different sentinels are needed, none of whose first characters occurs later in any")


def _mod(a: pa.Array, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _offsets(counts: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(pc.cast(counts, pa.int32()))])


def units(texts: pa.StringArray) -> pa.ListArray:
    """Texts as lists of their code points; the characters are views of the texts' bytes."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0]))
    raw = pa.Array.from_buffers(pa.uint8(), data.size, [None, data])
    begins = pc.indices_nonzero(pc.not_equal(pc.bit_wise_and(raw, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8())))
    places = pa.concat_arrays([pc.cast(begins, pa.int32()), pa.array([data.size], pa.int32())])
    chars = pa.StringArray.from_buffers(len(begins), places.buffers()[1], data)
    return pa.ListArray.from_arrays(_offsets(pc.utf8_length(texts)), chars)


def _joined(flat: pa.Array, keep: pa.Array, counts: pa.Array) -> pa.Array:
    """Units of one role, rebuilt into a list per text and joined."""
    return pc.binary_join(pa.ListArray.from_arrays(_offsets(counts), flat.filter(keep)), "")


def _parts(text: pa.StringArray) -> pa.StringArray:
    """One long text, cut at code points into parts of about ``BLOCK`` bytes."""
    raw = np.frombuffer(text[0].as_buffer(), np.uint8)
    cuts = [0]
    while cuts[-1] < len(raw):
        end = min(cuts[-1] + BLOCK, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        cuts.append(end)
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(np.array(cuts, np.int32)), text[0].as_buffer())


def pieces(texts: pa.StringArray, lo: pa.Array, hi: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Prefix, middle and suffix of each text: its units before ``lo``, before ``hi`` and the rest."""
    if len(texts) == 1 and texts[0].as_buffer().size > BLOCK:
        found, base = ([], [], []), 0
        parts = _parts(texts)
        for k in range(len(parts)):
            part = pa.concat_arrays([parts.slice(k, 1)])
            n = pc.utf8_length(part)[0].as_py()
            cut = [pa.array([min(max(x[0].as_py() - base, 0), n)], pa.int64()) for x in (lo, hi)]
            for role, piece in zip(found, pieces(part, *cut), strict=True):
                role.append(piece)
            base += n
        whole = [pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), pa.concat_arrays(role)) for role in found]
        return tuple(pc.binary_join(w, "") for w in whole)
    lists = units(texts)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.cast(lists.offsets.take(parent), pa.int64()))
    before = pc.less(ordinal, lo.take(parent))
    behind = pc.greater_equal(ordinal, hi.take(parent))
    between = pc.invert(pc.or_(before, behind))
    n = pc.cast(pc.list_value_length(lists), pa.int64())
    return _joined(flat, before, lo), _joined(flat, between, pc.subtract(hi, lo)), _joined(flat, behind, pc.subtract(n, hi))


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``BLOCK`` bytes, or one longer row."""
    first, held = 0, 0
    for k, size in enumerate(pc.binary_length(texts).to_pylist()):
        if k > first and held + size > BLOCK:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def rearranged(texts: pa.StringArray, h: Sequence[pa.Array], sentinels: Sequence[str], fim: int, spm: int) -> dict[str, pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of some texts and their draws."""
    n = pc.cast(pc.utf8_length(texts), pa.int64())
    cuts = [_mod(x, pc.add(n, 1)) for x in h[:2]]
    lo, hi = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_mod(h[2], 100), fim))
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(texts, s))
    suffix_first = pc.less(_mod(h[3], 100), spm)
    form = pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm"))
    prefix, middle, suffix = pieces(texts, lo, hi)
    p, s, m = sentinels
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm_out = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    none = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": form,
        "prefix_chars": pc.if_else(plain, none, lo),
        "middle_chars": pc.if_else(plain, none, pc.subtract(hi, lo)),
        "output": pc.if_else(plain, texts, pc.if_else(suffix_first, spm_out, psm)),
    }


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = SEED,
    sentinels: Sequence[str] = SENTINELS,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """One row per document: ``doc_id, n`` (code points), ``form, prefix_chars,
    middle_chars`` (null if plain), ``output`` (the text to train on)."""
    check_sentinels(sentinels)

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _slices(texts):
                h = [batch.column(k).slice(a, b - a) for k in range(2, 6)]
                out = rearranged(pa.concat_arrays([texts.slice(a, b - a)]), h, sentinels, fim_percent, spm_percent)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a), **out})

    key = F.col(id_col).cast("bigint")
    return docs.select(key.alias("doc_id"), F.col(text_col).cast("string").alias("text"), *draws(key, seed)).mapInArrow(run, OUT)


def restore(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The exact text from an output and its form."""
    p, s, m = sentinels

    def between(marker: str, ends: Sequence[str]) -> Column:
        """What stands behind a marker, up to the next one."""
        rest = F.split_part(output, F.lit(marker), F.lit(2))
        for e in ends:
            rest = F.split_part(rest, F.lit(e), F.lit(1))
        return rest

    prefix, suffix = between(p, (s, m)), between(s, (p, m))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, between(m, ()), suffix))


def report(transformed: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Digests of the outputs and of the texts restored from them."""
    restored = restore(F.col("output"), F.col("form"), sentinels)
    return transformed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )
