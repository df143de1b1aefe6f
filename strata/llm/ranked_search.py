"""Ranked lexical search: Block-Max MaxScore over a sharded, compressed inverted index.

Terms are maximal runs of 0-9, A-Z, a-z and all non-ASCII characters, with A-Z
lower-cased.  With ``N`` documents that have a term, ``L`` terms in all, ``n`` terms in
a document, ``df`` documents holding a term and ``tf`` occurrences in one, a term weighs
``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a document has
``m = 10 + (90 n N) div L``, and scores the sum of
``w ((10^9 tf) div (1000 tf + 8 m))`` over the distinct terms of the item: whole numbers,
so results don't depend on the order of sums.

Index (``build_index``): documents are packed into staged chunks, each a shard.  A row is a
term of a shard: its list of (document, tf) in blocks of ``BLOCK`` postings, written as
gaps in variable bytes, with the last document and the largest impact of each block.  A
shard's header, its ids and lengths, is the row of the empty term.

Search: the items' terms are joined to the index (the planner broadcasts them if they are
few), so a task gets the lists that a block of items needs of one shard, and the shard's
header.  Per item, lists are sorted by their bound (weight times largest impact).  Those
whose bounds add up to less than the k-th best score so far are non-essential: no document
that only they hold can enter.  Documents come from the essential lists, window by window;
then non-essential lists are looked up from the largest bound down, and a candidate whose
score so far, with the maximum of its block and the bounds of the lists below, falls short of
the k-th best is rejected before that block is decompressed.  Each shard hands on its k
best of each item, and a ranked window (with its limit pushed before the shuffle) merges
these.  All documents are ranked; equal scores come by ascending id.

A term of all documents is one row per shard, and a task holds the lists of one shard
(``SHARD_BYTES`` of text, or one longer document), however large the corpus.

Defined results: null and empty texts have no terms and are never found; rows are
documents, so a repeated row is found as often as it occurs; rows without an id can be
found, come last among equal scores, and keep the null; rows of one item id are one item
with the terms of all; items without a term that some document holds have no rows; empty
tables give empty results; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .suffix_dedup import Chunk, chunks

K = 10
BLOCK = 128
SHARD_BYTES = 16 << 20
ITEMS_PER_BLOCK = 256
FIRST_WINDOW, WINDOW = 256, 4096
HEADER = b""  # no term is empty

# The bytes that terms are made of, A-Z as a-z; all others separate.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


# ---- lists of postings ----------------------------------------------------------------

def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable bytes, seven bits each and low ones first; the top bit says that more
    follow.  And where each value begins."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= 1 << bits
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(5):
        has = size > k
        out[begin[has] + k] = ((values[has] >> (7 * k)) & 127) | ((size[has] > k + 1) * 128)
    return out, begin


def decode(raw: np.ndarray) -> np.ndarray:
    last = raw < 128
    if last.all():
        return raw.astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    place = np.arange(len(raw)) - np.repeat(begin, np.diff(np.append(begin, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), begin)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _binary(raw: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Byte strings that follow each other in ``raw``, from each cut to the next."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


LISTS = "shard bigint, term binary, df bigint, most bigint, lasts binary, maxima binary, begins binary, data binary"


def _lists(shard: int, names: list[bytes], number: np.ndarray, doc: np.ndarray, tf: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    """Lists of all terms from postings sorted by (term number, document)."""
    df = np.bincount(number, minlength=len(names))
    first = np.cumsum(df) - df
    n_blocks = -(-df // BLOCK)
    block_list = np.repeat(np.arange(len(names)), n_blocks)
    block_first = np.cumsum(n_blocks) - n_blocks
    start = first[block_list] + BLOCK * (np.arange(len(block_list)) - block_first[block_list])
    end = np.append(start[1:], len(doc))
    gap = np.diff(doc, prepend=0)
    gap[start] = doc[start]  # blocks are read one by one
    data, begin = encode(np.stack([gap, tf], 1).reshape(-1))
    most = np.maximum.reduceat(impacts(tf, m[doc]), start)
    by_list = np.append(block_first, len(block_list))
    begin = np.append(begin[::2], len(data))
    local = begin[start] - begin[first][block_list]
    return pa.RecordBatch.from_pydict(
        {
            "shard": pa.array(np.full(len(names), shard), pa.int64()),
            "term": pa.array(names, pa.binary()),
            "df": df,
            "most": np.maximum.reduceat(most, block_first),
            "lasts": _binary(doc[end - 1].astype("<i4"), 4 * by_list),
            "maxima": _binary(most.astype("<i4"), 4 * by_list),
            "begins": _binary(local.astype("<i4"), 4 * by_list),
            "data": _binary(data, begin[np.append(first, len(doc))]),
        }
    )


def _header(shard: int, doc_ids: list, m: np.ndarray) -> pa.RecordBatch:
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8")
    none = np.packbits([i is None for i in doc_ids])
    one = lambda x: pa.array([x.tobytes()], pa.binary())
    return pa.RecordBatch.from_pydict(
        {
            "shard": pa.array([shard], pa.int64()),
            "term": pa.array([HEADER], pa.binary()),
            "df": pa.array([0], pa.int64()),
            "most": pa.array([0], pa.int64()),
            "lasts": one(ids),
            "maxima": one(m.astype("<i8")),
            "begins": one(none),
            "data": pa.array([b""], pa.binary()),
        }
    )


def length_class(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``m`` of documents of ``n`` terms."""
    if 90 * int(n.max(initial=0)) * n_docs < 1 << 63:
        return 10 + (90 * n * n_docs) // n_terms
    return np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)


def _postings(n_docs: int, n_terms: int):
    def run(batches):
        for row in _rows(batches):
            c, known = Chunk(row), {}
            raw = c.raw.tobytes()
            found = [
                np.array([known.setdefault(t, len(known)) for t in terms(raw[b:e])], np.int64)
                for b, e in zip(c.begins, c.ends, strict=True)
            ]
            n = np.array([len(f) for f in found], np.int64)
            if not known:
                continue
            m = length_class(n, n_docs, n_terms)
            code, tf = np.unique(np.concatenate(found) * len(n) + np.repeat(np.arange(len(n)), n), return_counts=True)
            yield _header(row["chunk"], c.doc_ids, m)
            yield _lists(row["chunk"], list(known), code // len(n), code % len(n), tf, m)

    return run


def _sizes(batches):
    for row in _rows(batches):
        c = Chunk(row)
        raw = c.raw.tobytes()
        n = [len(terms(raw[b:e])) for b, e in zip(c.begins, c.ends, strict=True)]
        yield pa.RecordBatch.from_pydict({"n_docs": pa.array([sum(x > 0 for x in n)], pa.int64()), "n_terms": pa.array([sum(n)], pa.int64())})


@dataclass(frozen=True)
class Index:
    lists: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index of all terms of all documents, written to the shared scratch folder."""
    packed = chunks(docs, id_col, text_col, SHARD_BYTES)
    total = packed.mapInArrow(_sizes, "n_docs bigint, n_terms bigint").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    return Index(stage(packed.mapInArrow(_postings(n_docs, n_terms), LISTS), "search-index"), n_docs, n_terms)


# ---- search -----------------------------------------------------------------------------

class Postings:
    """A list of one shard; blocks are decompressed when first needed."""

    def __init__(self, row: dict, m: np.ndarray):
        self.most, self.df, self.m, self.data = row["most"], row["df"], m, np.frombuffer(row["data"], np.uint8)
        self.lasts, self.maxima = np.frombuffer(row["lasts"], "<i4"), np.frombuffer(row["maxima"], "<i4").astype(np.int64)
        self.begins = np.append(np.frombuffer(row["begins"], "<i4"), len(self.data))
        self.docs, self.impact = np.zeros(self.df, np.int64), np.zeros(self.df, np.int64)
        self.read = np.zeros(len(self.lasts), bool)

    def need(self, blocks: np.ndarray) -> None:
        new = blocks[~self.read[blocks]]
        if not len(new):
            return
        self.read[new] = True
        values = decode(np.concatenate([self.data[self.begins[b] : self.begins[b + 1]] for b in new])).reshape(-1, 2)
        size = np.minimum(BLOCK, self.df - new * BLOCK)
        first = np.cumsum(size) - size
        total = np.cumsum(values[:, 0])
        before = np.where(first > 0, total[first - 1], 0)
        place = np.repeat(new * BLOCK - first, size) + np.arange(len(values))
        docs = total - np.repeat(before, size)
        self.docs[place] = docs
        self.impact[place] = impacts(values[:, 1], self.m[docs])

    def within(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``lo`` to before ``hi`` and their impacts."""
        a, b = np.searchsorted(self.lasts, [lo, hi - 1])
        b = min(b + 1, len(self.lasts))
        self.need(np.arange(a, b))
        docs = self.docs[a * BLOCK : b * BLOCK]
        i, j = np.searchsorted(docs, [lo, hi])
        return docs[i:j], self.impact[a * BLOCK + i : a * BLOCK + j]


def best(lists: list[tuple[int, Postings]], rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents (by score, then ``rank``) and their scores."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].most)
    bound = np.cumsum([0, *[w * p.most for w, p in lists]])  # of the lists before each, and of all
    top, scores, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    lo, width = 0, FIRST_WINDOW
    while lo < len(rank):
        essential = int(np.searchsorted(bound[1:], floor))  # lists before it can't reach the floor together
        if essential == len(lists):
            break
        hi = min(lo + width, len(rank))
        score = np.zeros(hi - lo, np.int64)
        for w, p in lists[essential:]:
            docs, impact = p.within(lo, hi)
            score[docs - lo] += w * impact
        found = np.flatnonzero(score)
        for j in range(essential - 1, -1, -1):
            w, p = lists[j]
            found = found[score[found] + bound[j + 1] >= floor]
            block = np.searchsorted(p.lasts, found + lo)
            inside = block < len(p.lasts)
            ahead = np.where(inside, w * p.maxima[np.minimum(block, len(p.lasts) - 1)], 0)
            alive = score[found] + ahead + bound[j] >= floor
            found, block, inside = found[alive], block[alive], inside[alive]
            if not len(found):
                break
            p.need(np.unique(block[inside]))
            held = found[inside] + lo
            at = block[inside] * BLOCK
            # Within its block, the place of each candidate.
            step = BLOCK
            while step > 1:
                step //= 2
                ahead = np.minimum(at + step, p.df - 1)
                at = np.where((at + step < p.df) & (ahead // BLOCK == block[inside]) & (p.docs[ahead] <= held), ahead, at)
            hit = p.docs[at] == held
            score[held[hit] - lo] += w * p.impact[at[hit]]
        found = found[score[found] >= floor]
        if len(found):
            top, scores = np.concatenate([top, found + lo]), np.concatenate([scores, score[found]])
            order = np.lexsort((rank[top], -scores))[:k]
            top, scores = top[order], scores[order]
            if len(top) == k:
                floor = max(1, int(scores[-1]))
        lo, width = hi, min(2 * width, WINDOW)
    return top, scores


def _search(k: int, item_type: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["term", "df", "most", "lasts", "maxima", "begins", "data", "w", "items"]).to_pylist()
        header = next(r for r in rows if r["term"] == HEADER)
        m = np.frombuffer(header["maxima"], "<i8")
        ids = np.frombuffer(header["lasts"], "<i8")
        none = np.unpackbits(np.frombuffer(header["begins"], np.uint8), count=len(ids)).astype(bool)
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((ids, none))] = np.arange(len(ids))
        wanted: dict = {}
        for r in rows:
            if r["term"] != HEADER:
                p = Postings(r, m)
                for item in r["items"]:
                    wanted.setdefault(item["item_id"], []).append((r["w"], p))
        items, found, scores = [], [], []
        for item, lists in wanted.items():
            top, score = best(lists, rank, k)
            items += [item] * len(top)
            found.append(top)
            scores.append(score)
        at = np.concatenate([np.zeros(0, np.int64), *found])
        return pa.table(
            {
                "item_id": pa.array(items, item_type),
                "doc_id": pa.array(ids[at], pa.int64(), mask=none[at]),
                "score": pa.array(np.concatenate([np.zeros(0, np.int64), *scores]), pa.int64()),
            }
        )

    return run


def _item_terms(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            found = sorted(set(terms(batch.column(1)[k].as_py() or b"")))
            item = pa.concat_arrays([batch.column(0).slice(k, 1)]).take(pa.array(np.zeros(len(found), np.int64)))
            yield pa.RecordBatch.from_arrays([item, pa.array(found, pa.binary())], names=["item_id", "term"])


def _asked(index: Index, items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``block`` of items, ``term``, its weight ``w`` and the ``items`` that have it;
    in each block also the header's term."""
    kind = items.schema[item_col].dataType.simpleString()
    rows = items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    pairs = rows.mapInArrow(_item_terms, f"item_id {kind}, term binary").distinct()
    n_blocks = -(-items.count() // ITEMS_PER_BLOCK) or 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int").alias("block")
    by_term = stage(pairs.groupBy(block, "term").agg(F.collect_list(F.struct("item_id")).alias("items")), "search-terms")
    counts = index.lists.select("term", "df").join(by_term.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("in_docs"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * index.n_docs + 2)) / (2 * F.col("in_docs") + 1))).cast("bigint")
    weighed = by_term.join(counts, "term").select("block", "term", weight.alias("w"), "items")
    headers = by_term.select("block").distinct().select(
        "block", F.lit(HEADER).alias("term"), F.lit(0).cast("bigint").alias("w"), F.array().cast(by_term.schema["items"].dataType).alias("items")
    )
    return stage(weighed.unionByName(headers), "search-weights")


def search(index: Index, items: DataFrame, k: int = K, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``."""
    item_type = items.schema[item_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    asked = _asked(index, items, item_col, text_col)
    heaps = index.lists.join(asked, "term").groupBy("block", "shard").applyInArrow(
        _search(k, to_arrow_type(item_type)), f"item_id {item_type.simpleString()}, doc_id bigint, score bigint"
    )
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
