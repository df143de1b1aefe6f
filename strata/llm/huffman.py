"""Token-id output: canonical length-limited Huffman coding in independent blocks.

Texts are tokenised in ascending ``doc_id`` order (null ids first, ties by
a hash of the text and a place of the row), every document ends with ``end_id``.  Code lengths
come from the counts of all ids, at most ``MAX_BITS`` bits (more where so many different ids
need them), and the canonical code follows from the lengths alone.  A file row is a block
of whole documents: its bit string, a checkpoint (bit offset) every ``STRIDE`` ids, and the
documents' ids and lengths.  The code lengths are written beside the blocks, so another
session decodes the files by themselves: one table look-up per id, all stretches
between checkpoints side by side.

A block closes at ``BLOCK_IDS`` ids, so a longer document is a block by itself.
Inputs: null text counts as empty (one id, the end).  Repeated rows are written
once each, and may be written by several tasks, however often they occur.  An empty table
writes no blocks.  Very long texts are tokenised whole.  Other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_scratch_path
from .common import shuffle_width, stage

END_ID = 2
MAX_BITS = 16
WIDEST = 25  # bits of a code that, wherever it begins in a byte, is read from four bytes
STRIDE = 64
BLOCK_IDS = 1 << 18
CACHE_WORDS = 1_000_000  # word -> ids entries a worker keeps, some 150 bytes each
LOOK_UP = 512  # unknown words encoded as one text
SLICE_BYTES = 8 << 20  # of texts split at a time
LONG_WORD = 200  # longer words are tokenised without being kept

BLOCK_SCHEMA = (
    "part int, block int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, "
    "bits binary, checkpoints binary"
)


# ---- tokenising ---------------------------------------------------------------

PROBES = ("Mixed CASE, and 1234 numbers\n\tnew lines", "  x  y ", "d'accord l'été ...!?", "naïve Ünïcode 中文 ok")


def _steps(spec: dict | None) -> list[dict]:
    """A normaliser or pre-tokenizer, taken apart."""
    inner = (spec or {}).get("normalizers") or (spec or {}).get("pretokenizers")
    return [x for part in inner for x in _steps(part)] if inner else [spec] if spec else []


def splits_at_space(tokenizer) -> bool:
    """Whether a text's ids are those of its lower-cased words, one after another: white space
    is dropped before the model sees it, and case doesn't matter."""
    spec = json.loads(tokenizer.to_str())
    lowers = any(s["type"] == "Lowercase" for s in _steps(spec["normalizer"]))
    cuts = _steps(spec["pre_tokenizer"])
    drops = any(s["type"] in ("Whitespace", "WhitespaceSplit") or s["type"] == "Split" and s["behavior"] == "Removed" for s in cuts)
    if not (lowers and drops) or any(s.get("add_prefix_space") for s in cuts):
        return False

    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    return all(ids(t) == [i for w in t.lower().split() for i in ids(w)] for t in PROBES)


def packed(ids: np.ndarray, ends: np.ndarray, end_id: int, kind: str) -> pa.BinaryArray:
    """The ids of texts that end at ``ends``, each followed by ``end_id``, as byte strings."""
    raw = np.insert(ids.astype(kind, copy=False), ends, end_id)
    cuts = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * raw.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw)])


class TextEncoder:
    """Ids of whole texts, each given to the tokenizer as it is."""

    def __init__(self, tokenizer):
        self.tokenizer, self.kind = tokenizer, id_kind(tokenizer.get_vocab_size())

    def encode(self, texts: pa.StringArray, end_id: int) -> pa.BinaryArray:
        """The ids of each text and ``end_id``, as little-endian numbers of ``kind``."""
        found = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        ids = np.array(list(itertools.chain.from_iterable(found)), self.kind)
        return packed(ids, np.cumsum([len(x) for x in found]), end_id, self.kind)


class WordEncoder:
    """The same for vocabularies that lower-case, drop white space and never join across it
    (``splits_at_space``): texts are encoded word by word and words are kept.
    A slice's texts are split and their different words numbered by Arrow; only those
    are looked up, and a word's ids are taken by its number.  A full stop or comma after
    letters alone is a token of its own, so such words are put together from two."""

    def __init__(self, tokenizer):
        self.tokenizer, self.kind = tokenizer, id_kind(tokenizer.get_vocab_size())
        self.known: dict[bytes, bytes] = {}
        # Ids that end a piece of letters, if the vocabulary marks them.
        suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix") or "\0"
        self.ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, from one text of them all.  Words of letters are one piece each, so
        their last ids tell them apart; else offsets tell whose ids they are."""
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.asarray(found.ids, dtype=self.kind)
        if all(map(bytes.isalpha, words)):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(words):
                return [ids[a:b].tobytes() for a, b in itertools.pairwise([0, *ends.tolist()])]
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        at = np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), begins)
        return [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def _learn(self, new: list[bytes]) -> None:
        known = self.known
        ending = [w for w in new if w[-1:] in b".," and len(w) > 1 and w[:-1].decode("utf-8", "replace").isalpha()]
        plain = set(new).difference(ending)
        plain.update(w for e in ending for w in (e[:-1], e[-1:]) if w not in known)
        plain = sorted(plain, key=bytes.isalpha)
        for i in range(0, len(plain), LOOK_UP):
            part = plain[i : i + LOOK_UP]
            known.update(zip(part, self._look_up(part), strict=True))
        for e in ending:
            known[e] = known[e[:-1]] + known[e[-1:]]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        found = list(map(self.known.get, words))
        gaps = [i for i, x in enumerate(found) if x is None]
        self._learn([words[i] for i in gaps if len(words[i]) <= LONG_WORD])
        for i in gaps:
            found[i] = self.known[words[i]] if len(words[i]) <= LONG_WORD else self._look_up([words[i]])[0]
        return found

    def encode(self, texts: pa.StringArray, end_id: int) -> pa.BinaryArray:
        """The ids of each text and ``end_id``, as little-endian numbers of ``kind``."""
        # Texts split at ASCII white space alone; other kinds stay with the tokenizer.
        # Special tokens are told by case, so texts that may hold one keep theirs.
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lower)
        word = split.flatten().dictionary_encode()
        found = self._ids(word.dictionary.cast(pa.binary()).to_pylist())
        cuts = np.cumsum([0, *map(len, found)]) // np.dtype(self.kind).itemsize
        table = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.frombuffer(b"".join(found), self.kind)))
        ids = table.take(word.indices).flatten().to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(np.diff(cuts)[word.indices.to_numpy(zero_copy_only=False)])])
        return packed(ids, before[np.asarray(split.offsets)[1:]], end_id, self.kind)


def id_kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder | TextEncoder:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return (WordEncoder if splits_at_space(tokenizer) else TextEncoder)(tokenizer)


def slices(texts: pa.StringArray):
    """Runs of rows of at most ``SLICE_BYTES``, or one longer row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(ends):
        held = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, held + SLICE_BYTES, side="right")))
        yield first, last
        first = last


def tokenise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """``doc_id, tie, place, ids``: every text's ids and the end id, staged, so that each text is
    tokenised once.  ``tie`` orders rows of equal id, and ``place`` those that are equal."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for a, b in slices(batch.column(2)):
                part = batch.slice(a, b - a)
                texts = pa.concat_arrays([pc.fill_null(part.column(2), "")])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), enc.encode(texts, end_id)], names=["doc_id", "tie", "ids"])
            pa.default_memory_pool().release_unused()

    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("string"))
    found = read.mapInArrow(run, "doc_id bigint, tie bigint, ids binary")
    return stage(found.withColumn("place", F.monotonically_increasing_id()), "token-ids")


def joined(rows: pa.BinaryArray) -> memoryview:
    """The bytes of all rows, as they follow each other in the array."""
    ends = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1]
    return memoryview(rows.buffers()[2] or b"")[int(ends[0]) : int(ends[-1])] if len(rows) else memoryview(b"")


def count_ids(tokens: DataFrame, path: str) -> DataFrame:
    """``id, n`` over all documents."""

    def counts(batches):
        total, kind = np.zeros(0, np.int64), encoder(path).kind
        for batch in batches:
            more = np.bincount(np.frombuffer(joined(batch.column(0)), kind), minlength=len(total))
            more[: len(total)] += total
            total = more
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": found.astype(np.int32), "n": total[found]})

    return tokens.select("ids").mapInArrow(counts, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


# ---- the code -------------------------------------------------------------------

def code_lengths(counts: dict[int, int], limit: int = MAX_BITS) -> dict[int, int]:
    """Optimal prefix code lengths of at most ``limit`` bits (package-merge)."""
    if len(counts) > 1 << limit:
        raise ValueError(f"{len(counts)} ids don't fit {limit} bits")
    if limit > WIDEST:
        raise ValueError(f"codes have at most {WIDEST} bits")
    symbols = sorted(counts, key=lambda s: (counts[s], s))
    if len(symbols) == 1:
        return {symbols[0]: 1}
    weights = np.array([counts[s] for s in symbols], dtype=np.float64)
    # A row of the merge is the sorted list of coins and packages; `coin` says which.
    rows, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        rows.append(order < len(weights))
        both = both[order]
        even = len(both) // 2 * 2
        packages = both[0:even:2] + both[1:even:2]
    # Walk back: of each row the first `take` entries are taken.
    lengths, take = np.zeros(len(symbols), np.int64), 2 * (len(symbols) - 1)
    for coin in reversed(rows):
        coins = int(coin[:take].sum())
        lengths[:coins] += 1
        take = 2 * (take - coins)
    return {s: int(n) for s, n in zip(symbols, lengths, strict=True)}


class Code:
    """Canonical code of given lengths: codes ascend with (length, id)."""

    def __init__(self, lengths: dict[int, int]):
        symbols = np.array(sorted(lengths, key=lambda s: (lengths[s], s)), dtype=np.int64)
        size = np.array([lengths[int(s)] for s in symbols], dtype=np.int64)
        self.width = int(size.max()) if len(size) else 1
        spans = np.left_shift(1, self.width - size)
        starts = np.concatenate([[0], np.cumsum(spans)[:-1]]) if len(size) else np.zeros(0, np.int64)
        top = int(symbols.max()) + 1 if len(symbols) else 0
        self.code, self.size = np.zeros(top, np.uint32), np.zeros(top, np.uint8)
        self.code[symbols] = (starts >> (self.width - size)).astype(np.uint32)
        self.size[symbols] = size
        # Decoding table: the next `width` bits name the id and its length.
        self.symbol_of, self.size_of = np.zeros(1 << self.width, np.uint32), np.ones(1 << self.width, np.uint8)
        used = int(spans.sum())
        self.symbol_of[:used] = np.repeat(symbols, spans)
        self.size_of[:used] = np.repeat(size, spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit string, and the bit offset of every ``STRIDE``-th id."""
        size = self.size[ids].astype(np.int64)
        ends = np.cumsum(size)
        starts = ends - size
        out = np.zeros(int(ends[-1] if len(ends) else 0) // 8 + 5, np.uint8)
        # A code of at most 25 bits touches four bytes; codes never share a bit, so adding is or-ing.
        window = self.code[ids].astype(np.uint32) << (32 - size - (starts & 7)).astype(np.uint32)
        at = starts >> 3
        for k in range(3 if self.width <= 17 else 4):
            part = (window >> np.uint32(24 - 8 * k)) & np.uint32(255)
            first = np.flatnonzero(np.diff(at, prepend=-1))
            if len(first):
                out[at[first] + k] += np.add.reduceat(part, first).astype(np.uint8)
        return out.tobytes(), starts[::STRIDE].astype(np.uint64)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.uint32)
        words = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((STRIDE, len(at)), np.uint32)
        last = len(words) - 1
        for k in range(STRIDE):
            here = np.minimum(at >> 3, last)
            window = (words[here] >> (32 - self.width - (at & 7)).astype(np.uint32)) & np.uint32((1 << self.width) - 1)
            out[k] = self.symbol_of[window]
            at += self.size_of[window]
        return out.T.reshape(-1)[:n]


# ---- files ----------------------------------------------------------------------

def write_blocks(tokens: DataFrame, path: str, lengths: dict[int, int], to: str) -> None:
    """Encode what :func:`tokenise` made, in id order, and write the blocks, and the code lengths
    that they are read by, as tables at ``to``."""
    spark = tokens.sparkSession
    spark.createDataFrame(sorted(lengths.items()), "id int, length int").coalesce(1).write.parquet(f"{to}/lengths")
    code = spark.sparkContext.broadcast(lengths)  # an entry per id of the vocabulary

    def encode(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        table, kind = Code(code.value), encoder(path).kind
        names, sizes, held, n = [], [], [], 0

        def close():
            nonlocal block, names, sizes, held, n
            ids = np.concatenate(held)
            bits, marks = table.encode(ids)
            row = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "doc_ids": pa.array([names], pa.list_(pa.int64())),
                    "lengths": pa.array([sizes], pa.list_(pa.int64())),
                    "n_ids": pa.array([n], pa.int64()),
                    "bits": pa.array([bits], pa.binary()),
                    "checkpoints": pa.array([marks.tobytes()], pa.binary()),
                }
            )
            block, names, sizes, held, n = block + 1, [], [], [], 0
            return row

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(raw, kind)
                if n and n + len(ids) > BLOCK_IDS:
                    yield close()
                names.append(doc_id)
                sizes.append(len(ids))
                held.append(ids)
                n += len(ids)
        if n:
            yield close()

    order = ["doc_id", "tie", "place"]
    ordered = tokens.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInArrow(encode, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{to}/blocks")


def read_blocks(spark, at: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian uint32 binary) from the files alone."""
    lengths = {r.id: r.length for r in spark.read.parquet(f"{at}/lengths").collect()}  # a row per id of the vocabulary
    code = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{at}/blocks")
    # Where each written part begins: a row per part.
    sizes = sorted((r.part, r.n) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    begins = spark.createDataFrame(before, "part int, before bigint")
    inner = blocks.select("part", "block", "n_ids").join(begins, "part")
    running = Window.partitionBy("part").orderBy("block")
    offsets = inner.select("part", "block", (F.col("before") + F.sum("n_ids").over(running) - F.col("n_ids")).alias("at"))

    def decode(batches):
        table = Code(code.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = table.decode(row["bits"], np.frombuffer(row["checkpoints"], np.uint64), row["n_ids"])
                n = np.asarray(row["lengths"], np.int64)
                ends = np.cumsum(n)
                raw = ids.astype("<u4").tobytes()
                for i in range(0, len(n), 512):
                    lo, hi = ends[i : i + 512] - n[i : i + 512], ends[i : i + 512]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(row["doc_ids"][i : i + 512], pa.int64()),
                            "start": pa.array(lo + row["at"], pa.int64()),
                            "n_tokens": pa.array(hi - lo, pa.int64()),
                            "ids": pa.array([raw[4 * a : 4 * b] for a, b in zip(lo, hi, strict=True)], pa.binary()),
                        }
                    )

    return blocks.join(offsets, ["part", "block"]).mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def write_and_read(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` to files in the shared folder and read the ids back."""
    spark = docs.sparkSession
    tokens = tokenise(docs, path, id_col, text_col, end_id)
    # The tokenizer's vocabulary bounds this: a row per id.
    counts = {r.id: r.n for r in count_ids(tokens, path).collect()}
    to = new_scratch_path(spark, "token-blocks")
    # Some bits more than the ids need, so that frequent ones can be short.
    lengths = code_lengths(counts, max(MAX_BITS, len(counts).bit_length() + 2)) if counts else {}
    write_blocks(tokens, path, lengths, to)
    return read_blocks(spark, to)


def digest(read: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what :func:`read_blocks` returns."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
