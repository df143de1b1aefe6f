"""Cross-entropy difference scoring with matched n-gram models.

Target model: all documents with good labels.  Background model: all documents.
Both are bigram models over one vocabulary, smoothed alike: the bigram estimate
with a Dirichlet prior of ``PRIOR`` tokens on the unigram estimate, which is
smoothed by one per word.  A token's loss difference is its target loss less its
background loss; a document's score is the mean (smaller: closer to the target).

Words are lower-cased and split at white space.  The vocabulary holds the most
frequent words of all documents, at most ``VOCABULARY``, so it may be broadcast;
all others are one unknown word.  Bigram counts grow with the corpus and are
never gathered in one place: chunks of documents ask for the losses of their
distinct bigrams, hash ranges of bigrams add up the counts of all chunks and
answer.  A bigram counts once per chunk there, however frequent it is.  Losses
are rounded to thousandths of a nat, so sums don't depend on their order.

Inputs: null and empty texts have no tokens and null scores.  Repeated rows count
as often as they occur.  Null labels are ignored; a document counts as good if
all its labels say so.  Without good labels all target losses are those of the
uniform prior.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, stage
from .quality import labelled
from .suffix_dedup import Chunk, chunks

VOCABULARY = 65_536
MIN_COUNT = 2
PRIOR = 50.0
CHUNK_BYTES = 8 << 20
GRAIN = 1000  # losses are whole thousandths of a nat

_M = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """64-bit hashes of the words of documents; keeps those of known words."""

    def __init__(self, keep: int = 500_000):
        self.keep, self.known = keep, {}

    def __call__(self, raw: bytes) -> np.ndarray:
        import xxhash

        words = raw.decode("utf-8", "replace").lower().split()
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1
        return np.array([known[w] for w in words], np.int64)


def _tokens(c: Chunk, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk's documents, and the document index of each."""
    found = [words(c.raw[b:e].tobytes()) for b, e in zip(c.begins, c.ends, strict=True)]
    sizes = np.array([len(f) for f in found], np.int64)
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), np.repeat(np.arange(len(found)), sizes)


def with_target(packed: DataFrame, labels: DataFrame) -> DataFrame:
    """Chunks with ``target``: places of the documents that have good labels."""
    good = labelled(labels).where("good").select("doc_id")
    places = packed.select("chunk", F.posexplode("doc_ids").alias("place", "doc_id")).join(good, "doc_id")
    return packed.join(places.groupBy("chunk").agg(F.collect_list("place").alias("target")), "chunk", "left")


def _in_target(row: dict, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[np.asarray(row["target"] or [], np.int64)] = True
    return out


def word_counts(chunked: DataFrame) -> DataFrame:
    """``word`` (hash), ``n`` and ``n_target`` over all documents."""

    def run(batches):
        words = Words()
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                h, doc = _tokens(c, words)
                name, where = np.unique(h, return_inverse=True)
                n = np.bincount(where, minlength=len(name))
                t = np.bincount(where[_in_target(row, len(c.sizes))[doc]], minlength=len(name))
                for i in range(0, len(name), 1 << 16):
                    s = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_pydict({"word": name[s], "n": n[s].astype(np.int64), "n_target": t[s].astype(np.int64)})

    found = chunked.mapInArrow(run, "word bigint, n bigint, n_target bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


class Model:
    """Unigrams of both models over the vocabulary; ids are 1.. in hash order, 0 is
    unknown and ``size`` the beginning of a document."""

    def __init__(self, words: np.ndarray, n: np.ndarray, n_target: np.ndarray, total: int, total_target: int, docs: int, docs_target: int):
        order = np.argsort(words)
        self.words = words[order]
        self.size = len(words) + 1
        self.uni, self.context = [], []
        for part, all_, begins in ((n, total, docs), (n_target, total_target, docs_target)):
            counts = np.concatenate([[all_ - part.sum()], part[order]]).astype(np.float64)
            self.uni.append((counts + 1) / (all_ + self.size))
            self.context.append(np.append(counts, begins))

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at + 1, 0)

    def codes(self, ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Bigram of each token: previous id (or beginning) and its own."""
        before = np.concatenate([[self.size], ids[:-1]]) if len(ids) else ids
        before = np.where(np.concatenate([[True], doc[1:] != doc[:-1]]), self.size, before) if len(ids) else before
        return before * self.size + ids

    def losses(self, codes: np.ndarray, n: np.ndarray, n_target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Target and background loss of bigrams of given counts, in GRAINs."""
        before, own = codes // self.size, codes % self.size
        out = []
        for k, c in ((1, n_target), (0, n)):
            p = (c + PRIOR * self.uni[k][own]) / (self.context[k][before] + PRIOR)
            out.append(np.minimum(np.rint(-np.log(p) * GRAIN), 65_535).astype("<u2"))
        return out[0], out[1]


def vocabulary(counts: DataFrame, docs: int, docs_target: int, size: int = VOCABULARY) -> Model:
    """The most frequent words: those over the lowest count bin that leaves at most
    ``size`` of them.  Bins are eighths of a power of two."""
    level = F.floor(F.log2("n") * 8).cast("int")
    binned = counts.where(F.col("n") >= MIN_COUNT).withColumn("level", level)
    bins = sorted(binned.groupBy("level").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)  # at most 512
    least, held = 1 << 20, 0
    for b in bins:
        if held + b.words > size:
            break
        least, held = b.level, held + b.words
    total = counts.agg(F.sum("n"), F.sum("n_target")).first()
    found = binned.where(F.col("level") >= least).select("word", "n", "n_target").toPandas()
    return Model(found.word.to_numpy(np.int64), found.n.to_numpy(np.int64), found.n_target.to_numpy(np.int64), total[0] or 0, total[1] or 0, docs, docs_target)


def _range_of(codes: np.ndarray, n: int) -> np.ndarray:
    h = (codes.astype(np.uint64) + np.uint64(1)) * _M
    h ^= h >> np.uint64(29)
    return ((h * _M) >> np.uint64(32)).astype(np.int64) * n >> 32


def _distinct(codes: np.ndarray, n_ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes by (range, code), where each range begins, and the place of each token's code."""
    name, where = np.unique(codes, return_inverse=True)
    r = _range_of(name, n_ranges)
    order = np.argsort(r, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return name[order], np.searchsorted(r[order], np.arange(n_ranges + 1)), place[where]


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _unpack(b: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def _ask(model, n_ranges: int):
    def run(batches):
        words = Words()
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                h, doc = _tokens(c, words)
                codes = model.value.codes(model.value.ids(h), doc)
                name, cut, place = _distinct(codes, n_ranges)
                n = np.bincount(place, minlength=len(name)).astype("<u4")
                t = np.bincount(place[_in_target(row, len(c.sizes))[doc]], minlength=len(name)).astype("<u4")
                full = np.flatnonzero(np.diff(cut))
                parts = [(slice(cut[r], cut[r + 1])) for r in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(full), row["chunk"]), pa.int64()),
                        pa.array(full, pa.int32()),
                        pa.array([s.stop - s.start for s in parts], pa.int32()),
                        pa.array([_pack(np.diff(name[s], prepend=0).astype("<i8")) for s in parts], pa.binary()),
                        pa.array([_pack(n[s]) for s in parts], pa.binary()),
                        pa.array([_pack(t[s]) for s in parts], pa.binary()),
                    ],
                    names=["chunk", "range", "size", "codes", "n", "n_target"],
                )

    return run


def _answer(model):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        codes = [np.cumsum(_unpack(r["codes"], "<i8", r["size"])) for r in rows]
        name, where = np.unique(np.concatenate(codes), return_inverse=True)
        n = np.bincount(where, np.concatenate([_unpack(r["n"], "<u4", r["size"]) for r in rows]), len(name))
        t = np.bincount(where, np.concatenate([_unpack(r["n_target"], "<u4", r["size"]) for r in rows]), len(name))
        target, background = model.value.losses(name, n, t)
        cut = np.cumsum([0, *[r["size"] for r in rows]])
        places = [where[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "range": table.column("range"),
                "losses": pa.array([_pack(np.concatenate([target[p], background[p]])) for p in places], pa.binary()),
            }
        )

    return run


def _score(model, n_ranges: int):
    def run(batches):
        words = Words()
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                h, doc = _tokens(c, words)
                name, cut, place = _distinct(model.value.codes(model.value.ids(h), doc), n_ranges)
                loss = np.zeros((2, len(name)), np.int64)
                for r in row["answers"] or []:
                    lo, hi = cut[r["range"]], cut[r["range"] + 1]
                    loss[:, lo:hi] = _unpack(r["losses"], "<u2", 2 * (hi - lo)).reshape(2, -1)
                docs = len(c.sizes)
                sums = [np.bincount(doc, loss[k][place], docs).astype(np.int64) for k in (0, 1)]
                n = np.bincount(doc, minlength=docs)
                for i in range(0, docs, 8192):
                    s = slice(i, i + 8192)
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(c.doc_ids[s], pa.int64()), "n_tokens": n[s], "target": sums[0][s], "background": sums[1][s]}
                    )

    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = VOCABULARY) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, target_loss, background_loss,
    score`` (nats per token)."""
    spark = docs.sparkSession
    n_ranges = 4 * shuffle_width(spark)
    packed = chunks(docs, id_col, text_col, CHUNK_BYTES)
    chunked = stage(with_target(packed, labels), "lm-chunks")
    n_docs = chunked.agg(F.sum(F.size("doc_ids")), F.sum(F.size(F.coalesce("target", F.array())))).first()
    counts = stage(word_counts(chunked), "lm-words")
    model = spark.sparkContext.broadcast(vocabulary(counts, n_docs[0] or 0, n_docs[1] or 0, size))
    asked = chunked.mapInArrow(_ask(model, n_ranges), "chunk bigint, range int, size int, codes binary, n binary, n_target binary")
    answered = asked.groupBy("range").applyInArrow(_answer(model), "chunk bigint, range int, losses binary")
    per_chunk = answered.groupBy("chunk").agg(F.collect_list(F.struct("range", "losses")).alias("answers"))
    sums = chunked.join(per_chunk, "chunk", "left").mapInArrow(
        _score(model, n_ranges), "doc_id bigint, n_tokens bigint, target bigint, background bigint"
    )
    per_token = [F.when(F.col("n_tokens") > 0, F.col(c) / (F.col("n_tokens") * GRAIN)) for c in ("target", "background")]
    return sums.select(
        "doc_id",
        "n_tokens",
        per_token[0].alias("target_loss"),
        per_token[1].alias("background_loss"),
        F.when(F.col("n_tokens") > 0, (F.col("target") - F.col("background")) / (F.col("n_tokens") * GRAIN)).alias("score"),
    )
