"""Dropping lines that many documents share.

A line's key is the line without white space (space, tab, ``\\n \\v \\f \\r``) at its ends
and with A-Z lower-cased.  Keys of at least ``min_chars`` code points that at least
``min_docs`` documents hold lose their lines: all of them, or with ``keep="first"`` all
but the first occurrence (smallest id, then place of the row, then line).

Only suspected repeats are shuffled as lines:

1. Documents are packed into staged chunks.  A chunk sends the 32-bit remainders of the
   hashes of its distinct keys to hash segments, with a bit for keys that more than one
   of its documents holds: four bytes a key and chunk, however frequent or long it is.
2. A segment keeps two Bloom filters, of hashes seen once and of hashes seen twice.  A hash
   that the first one holds already, or that comes with the bit, enters the second.
   Then every chunk is told, a bit a key, which of its keys the second filter holds.
   A filter errs on one side only, so no repeat is lost.
3. For suspected keys each chunk sends the key itself, in how many of its documents it is
   and where first.  Keys are added up and compared as text: that is the exact count,
   one row per key and chunk, so a line of a third of all documents is no hot group.
4. Chunks are told the numbers of their keys that are to go.

The number of segments follows the input (``SEGMENT_BYTES`` of text each), and a segment
sizes its filters by the hashes it is sent, so their error rate (about 0.3 %) and a
task's memory do not depend on the size of the corpus.

Defined results: null text counts as empty, and an empty text is one empty line; rows
count as documents, so repeated rows count as often as they occur, with or without an id;
null ids come last in the order; a key counts once per document; a text longer than a
chunk is a chunk of its own; an empty table gives an empty one; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, stage
from .suffix_dedup import Chunk, chunks

MIN_DOCS, MIN_CHARS = 10, 1
CHUNK_BYTES = 2 << 20
SEGMENT_BYTES = 64 << 20
BITS, PROBES = 16, 4  # of a filter, per hash sent to its segment
SPACE = b" \t\n\x0b\x0c\r"

_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)


class Bloom:
    """A Bloom filter over 32-bit hashes, for about ``n`` of them."""

    def __init__(self, n: int):
        self.bits = max(6, int(BITS * n - 1).bit_length())
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)

    def places(self, h: np.ndarray) -> np.ndarray:
        """``PROBES`` bits of each hash."""
        x = (h[:, None].astype(np.uint64) + _U(1)) * _M * (2 * np.arange(PROBES, dtype=np.uint64) + _U(1))
        x ^= x >> _U(31)
        return (x * _M) >> _U(64 - self.bits)

    def holds(self, places: np.ndarray) -> np.ndarray:
        return ((self.words[(places >> _U(6)).astype(np.int64)] >> (places & _U(63))) & _U(1)).all(axis=1)

    def add(self, places: np.ndarray) -> None:
        p = np.unique(places)
        if len(p):
            word = (p >> _U(6)).astype(np.int64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            self.words[word[first]] |= np.bitwise_or.reduceat(_U(1) << (p & _U(63)), first)


class Lines:
    """The lines of a chunk's documents.  Keys are numbered in order of appearance, so
    every pass over the chunk gives them the same numbers; -1 marks keys that are too short."""

    def __init__(self, chunk: Chunk, min_chars: int):
        self.known: dict[bytes, int] = {}
        self.docs: list[np.ndarray] = []
        known, raw = self.known, chunk.raw.tobytes()
        for b, e in zip(chunk.begins, chunk.ends, strict=True):
            keys = [line.strip(SPACE) for line in raw[b:e].lower().split(b"\n")]
            found = [known.setdefault(k, len(known)) if k and (min_chars <= 1 or len(k.decode("utf-8", "replace")) >= min_chars) else -1 for k in keys]
            self.docs.append(np.array(found, np.int64))

    def documents(self) -> np.ndarray:
        """In how many documents each key is."""
        held = [np.unique(d[d >= 0]) for d in self.docs]
        return np.bincount(np.concatenate(held), minlength=len(self.known)) if self.known else np.zeros(0, np.int64)

    def hashes(self) -> np.ndarray:
        import xxhash

        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.known), np.uint64, len(self.known))

    def firsts(self, doc_ids: list) -> tuple[np.ndarray, np.ndarray]:
        """Document (its place) and line of the first occurrence of each key."""
        doc, line = np.zeros(len(self.known), np.int64), np.zeros(len(self.known), np.int64)
        order = sorted(range(len(self.docs)), key=lambda k: (doc_ids[k] is None, doc_ids[k] or 0, k))
        for k in reversed(order):
            number, at = np.unique(self.docs[k], return_index=True)
            at, number = at[number >= 0], number[number >= 0]
            doc[number], line[number] = k, at
        return doc, line


def _rows(batches) -> Iterator[dict]:
    """One row at a time: a chunk is large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _by_segment(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the hashes by segment, and where each segment begins in it."""
    segment = ((h >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    return order, np.searchsorted(segment[order], np.arange(n + 1))


ASKED = "chunk bigint, segment int, size int, hashes binary, more binary"


def _ask(n_segments: int, min_chars: int):
    def run(batches):
        for row in _rows(batches):
            lines = Lines(Chunk(row), min_chars)
            h, more = lines.hashes(), lines.documents() > 1
            order, cut = _by_segment(h, n_segments)
            short, more = (h[order] & _U(0xFFFFFFFF)).astype("<u4"), more[order]
            full = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(np.full(len(full), row["chunk"]), pa.int64()),
                    "segment": pa.array(full, pa.int32()),
                    "size": pa.array(np.diff(cut)[full], pa.int32()),
                    "hashes": pa.array([short[cut[s] : cut[s + 1]].tobytes() for s in full], pa.binary()),
                    "more": pa.array([np.packbits(more[cut[s] : cut[s + 1]]).tobytes() for s in full], pa.binary()),
                }
            )

    return run


ANSWERED = "chunk bigint, segment int, suspected binary"


def suspect(table: pa.Table) -> pa.Table:
    """Both filters of one segment, then for each chunk's hashes whether they were seen twice."""
    sizes = table.column("size").to_pylist()
    hashes, more = table.column("hashes"), table.column("more")
    once, twice = Bloom(sum(sizes)), Bloom(sum(sizes))
    for k, n in enumerate(sizes):
        places = once.places(np.frombuffer(hashes[k].as_py(), "<u4"))
        again = once.holds(places) | np.unpackbits(np.frombuffer(more[k].as_py(), np.uint8), count=n).astype(bool)
        twice.add(places[again])
        once.add(places[~again])
    bits = [np.packbits(twice.holds(twice.places(np.frombuffer(h.as_py(), "<u4")))).tobytes() for h in hashes]
    return pa.table({"chunk": table.column("chunk"), "segment": table.column("segment"), "suspected": pa.array(bits, pa.binary())})


SUSPECTS = "key binary, chunk bigint, number bigint, docs bigint, first_id bigint, first_doc bigint, first_line bigint"


def _name(n_segments: int, min_chars: int):
    def run(batches):
        for row in _rows(batches):
            lines = Lines(Chunk(row), min_chars)
            order, cut = _by_segment(lines.hashes(), n_segments)
            found = np.zeros(len(order), bool)
            for a in row["answers"] or []:
                lo, hi = cut[a["segment"]], cut[a["segment"] + 1]
                found[order[lo:hi]] = np.unpackbits(np.frombuffer(a["suspected"], np.uint8), count=hi - lo)
            keys, docs = list(lines.known), lines.documents()
            first_doc, first_line = lines.firsts(row["doc_ids"])
            number = np.flatnonzero(found)
            for i in range(0, len(number), 8192):
                part = number[i : i + 8192]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([keys[k] for k in part], pa.binary()),
                        "chunk": pa.array(np.full(len(part), row["chunk"]), pa.int64()),
                        "number": part,
                        "docs": docs[part],
                        "first_id": pa.array([row["doc_ids"][k] for k in first_doc[part]], pa.int64()),
                        "first_doc": first_doc[part],
                        "first_line": first_line[part],
                    }
                )

    return run


CLEANED = "doc_id bigint, n_lines bigint, n_dropped bigint, text binary"


def _drop(min_chars: int, keep_first: bool):
    def run(batches):
        for row in _rows(batches):
            chunk = Chunk(row)
            lines, raw = Lines(chunk, min_chars), chunk.raw.tobytes()
            gone = np.zeros(len(lines.known) + 1, bool)  # the last one stands for -1
            gone[[v["number"] for v in row["verdicts"] or []]] = True
            stays = {}
            if keep_first and gone.any():
                first_doc, first_line = lines.firsts(row["doc_ids"])
                for v in row["verdicts"]:
                    if v["mine"]:
                        stays.setdefault(first_doc[v["number"]], []).append(first_line[v["number"]])
            texts, dropped = [], []
            for k, (d, b, e) in enumerate(zip(lines.docs, chunk.begins, chunk.ends, strict=True)):
                out = gone[d]
                out[stays.get(k, [])] = False
                text = raw[b:e]
                if out.any():
                    text = b"\n".join(line for line, o in zip(text.split(b"\n"), out.tolist(), strict=True) if not o)
                texts.append(text)
                dropped.append(int(out.sum()))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(chunk.doc_ids, pa.int64()),
                    "n_lines": pa.array([len(d) for d in lines.docs], pa.int64()),
                    "n_dropped": pa.array(dropped, pa.int64()),
                    "text": pa.array(texts, pa.binary()),
                }
            )

    return run


def suspects(chunked: DataFrame, n_segments: int, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every key that may be in more than one document, once per chunk that holds it."""
    asked = chunked.mapInArrow(_ask(n_segments, min_chars), ASKED)
    answered = asked.groupBy("segment").applyInArrow(suspect, ANSWERED)
    answers = answered.groupBy("chunk").agg(F.collect_list(F.struct("segment", "suspected")).alias("answers"))
    return chunked.join(answers, "chunk", "left").mapInArrow(_name(n_segments, min_chars), SUSPECTS)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep: str = "none",
) -> DataFrame:
    """One row per document: ``doc_id, n_lines`` (before dropping), ``n_dropped``, and
    ``text`` with the lines that stay, joined by newlines."""
    if min_docs < 2 or keep not in ("none", "first"):
        raise ValueError("line dedup: min_docs is at least 2, keep is 'none' or 'first'")
    chunked = chunks(docs, id_col, text_col, CHUNK_BYTES)
    n_bytes = chunked.agg(F.sum("n_bytes")).first()[0] or 0
    n_segments = max(shuffle_width(docs.sparkSession), -(-n_bytes // SEGMENT_BYTES))
    found = stage(suspects(chunked, n_segments, min_chars), "line-suspects")
    place = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "chunk", "first_doc", "first_line")
    repeated = found.groupBy("key").agg(F.sum("docs").alias("in_docs"), F.min(place).alias("first")).where(F.col("in_docs") >= min_docs)
    mine = (F.col("first.chunk") == F.col("chunk")).alias("mine")
    verdicts = found.join(repeated, "key").groupBy("chunk").agg(F.collect_list(F.struct("number", mine)).alias("verdicts"))
    cleaned = chunked.join(verdicts, "chunk", "left").mapInArrow(_drop(min_chars, keep == "first"), CLEANED)
    return cleaned.withColumn("text", F.col("text").cast("string"))


def report(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))
