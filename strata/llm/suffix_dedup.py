"""Exact removal of repeated byte strings by a distributed suffix sort.

A byte goes when a ``LENGTH``-byte string that covers it also starts earlier
(smaller id, or earlier in the same document).  Matches never cross documents.

Sparse suffixes.  Each ``LENGTH``-byte window names one anchor: the leftmost of
its 32-byte grams with the least hash.  Equal windows have equal anchors, so
only suffixes at anchors are sorted (about one in 35), and an anchor stands for
the run of windows that name it.

1. ``chunks``: documents packed into compressed chunks of about 2 MB, staged; all
   later steps read these, and a chunk is the unit of every answer.
2. ``repeated``: gram hashes that occur in more than one chunk.  A chunk asks with
   sorted hashes and their counts, split over hash ranges, and gets bits back: which
   grams repeat, and which are hot, that is more than ``HOT`` times there.
3. ``runs``: suffixes at repeated anchors, sorted per chunk, equal ones reduced to
   the earliest (the others are settled on the spot, so a passage that a third of
   all documents share leaves a chunk once), front-coded and cut by hash range.
   A suffix is its gram's hash, up to 100 bytes to the right and 68 to the left, as
   far as its windows reach; the leading hash spreads the sort evenly over ranges
   without sampling.
4. ``merge_range``: loser trees combine the runs of a range.  Every contender
   carries the length of the prefix it shares with the last winner, characters
   are compared from there on only, and the merged order comes with its LCPs.
5. Windows are equal where right LCP and left context reach (bytes are compared, the
   rolling hash only sorts); all but the first are repeats.  Their intervals go back to
   the chunks, which drop the bytes.

A hot gram is a phrase shorter than a window in many surroundings (longer ones leave a
chunk as few suffixes).  Its suffixes can't all meet in one task, so each of its windows
goes by itself, as a 128-bit hash with its earliest place in the chunk, to the range of
that hash, where again all but the first are repeats.

Ranges are as many as the input asks for (``RANGE_BYTES`` of text each), and a chunk
builds its suffixes in slices, so a task's memory depends neither on the size of the
corpus nor on how often a gram or a byte repeats; a text of one repeated byte has an anchor
at every byte, but few different suffixes.  A text longer than a chunk is a chunk of its own.

Inputs: null text counts as empty.  Null ids are smaller than all others.  Among
rows with equal ids the chunk order, fixed once chunks are staged, says which is
earlier.  Texts shorter than ``LENGTH`` bytes lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, stage

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1  # grams of a window; an anchor has up to SPAN - 1 bytes of it to the left
CHUNK_BYTES = 2 << 20
BLOCK = 1 << 17
SLICE = 1 << 16  # suffixes built at a time
RANGE_BYTES = 4 << 20  # of text
HOT = 20_000  # occurrences
HEAD = 6  # bytes of the gram hash in front of a suffix
RIGHT = HEAD + LENGTH
WIDTH = HEAD + LENGTH + SPAN - 1 + 2  # and how far back its windows begin, least and most

_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_STEP = [_U(c) for c in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


# ---- anchors ----------------------------------------------------------------------

def _gram_hashes(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit hash of the gram at every position."""
    h, n = table[raw], 1
    for c in _STEP:
        h = h[:-n] * c + h[n:]
        n *= 2
    return _mix(h)


def _grams(raw: np.ndarray) -> np.ndarray:
    """48 bits of it."""
    return _gram_hashes(raw, _BYTE) >> _U(16)


def _block_anchors(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows 0..n-1: starts of runs with one anchor, and their anchors."""
    low, w = h, 1
    while 2 * w <= SPAN:
        low = np.minimum(low[:-w], low[w:])
        w *= 2
    low = np.minimum(low[: len(low) - (SPAN - w)], low[SPAN - w :])[:n]
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    end = np.append(start[1:], n) - 1
    # A smaller minimum has just come in on the right; else it is looked up.
    anchor = start + SPAN - 1
    seek = np.flatnonzero(np.concatenate([[True], low[start[1:]] > low[start[1:] - 1]]))
    views = np.lib.stride_tricks.sliding_window_view(h, SPAN)
    anchor[seek] = start[seek] + views[start[seek]].argmin(axis=1)
    # Ties: the minimum stays although the window has passed its first place.
    tied = np.flatnonzero(anchor < end)
    if len(tied):
        count = end[tied] - anchor[tied]
        more = np.repeat(anchor[tied] + 1 - np.cumsum(count) + count, count) + np.arange(count.sum())
        found = np.concatenate([more[i : i + 4096] + views[more[i : i + 4096]].argmin(axis=1) for i in range(0, len(more), 4096)])
        start, anchor = np.concatenate([start, more]), np.concatenate([anchor, found])
        order = np.argsort(start, kind="stable")
        start, anchor = start[order], anchor[order]
    return start, anchor


class Anchors:
    """``at`` (anchor), ``lo``, ``hi`` (first and last window), ``gram`` and ``doc`` (index)
    over the concatenated bytes ``raw`` of documents that begin at ``begins``."""

    def __init__(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        n = len(raw) - LENGTH + 1
        parts = []
        for s in range(0, max(n, 0), BLOCK):
            m = min(BLOCK, n - s)
            h = _grams(raw[s : s + m + LENGTH - 1])
            start, anchor = _block_anchors(h, m)
            # The least hash of a window is a small one: mixed again, so that ranges get equal shares.
            parts.append((start + s, anchor + s, _mix(h[anchor]) >> _U(16)))
        if not parts:
            self.at = self.lo = self.hi = self.doc = np.zeros(0, np.int64)
            self.gram = np.zeros(0, np.uint64)
            return
        start, at, gram = (np.concatenate(x) for x in zip(*parts, strict=True))
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        lo, at, gram = start[first], at[first], gram[first]
        hi = np.append(lo[1:], n) - 1
        doc = np.searchsorted(begins, at, side="right") - 1
        lo, hi = np.maximum(lo, begins[doc]), np.minimum(hi, ends[doc] - LENGTH)
        ok = lo <= hi
        self.at, self.lo, self.hi, self.doc, self.gram = at[ok], lo[ok], hi[ok], doc[ok], gram[ok]


# ---- chunks ---------------------------------------------------------------------------

CHUNKS = "chunk bigint, doc_ids array<bigint>, sizes array<bigint>, n_bytes bigint, payload binary"


def chunks(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int | None = None) -> DataFrame:
    limit = chunk_bytes or CHUNK_BYTES

    def pack(batches):
        from pyspark import TaskContext

        codec, chunk = pa.Codec("zstd", 3), TaskContext.get().partitionId() << 33
        ids, held, n = [], [], 0

        def row():
            raw = b"".join(held)
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([chunk], pa.int64()),
                    "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                    "sizes": pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                    "n_bytes": pa.array([len(raw)], pa.int64()),
                    "payload": pa.array([codec.compress(raw, asbytes=True)], pa.binary()),
                }
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or b""
                if held and n + len(text) > limit:
                    yield row()
                    chunk, ids, held, n = chunk + 1, [], [], 0
                ids.append(doc_id)
                held.append(text)
                n += len(text)
            pa.default_memory_pool().release_unused()
        if held:
            yield row()

    packed = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("binary")).mapInArrow(pack, CHUNKS)
    return stage(packed, "text-chunks")


def _each(batches):
    """Rows as dicts, one at a time: a chunk is large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


class Chunk:
    def __init__(self, row: dict):
        self.id, self.doc_ids = row["chunk"], row["doc_ids"]
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        raw = pa.Codec("zstd").decompress(row["payload"], row["n_bytes"], asbytes=True) if row["n_bytes"] else b""
        self.raw = np.frombuffer(raw, np.uint8)

    def anchors(self) -> Anchors:
        # Empty documents begin where the next one does; a search from the right finds the full one.
        return Anchors(self.raw, self.begins, self.ends)


def _ranges(gram: np.ndarray, n: int) -> np.ndarray:
    """Range of each 48-bit hash, ascending with it."""
    return ((gram >> _U(16)) * _U(n) >> _U(32)).astype(np.int64)


# ---- which grams repeat ------------------------------------------------------------------

ASKED = "chunk bigint, range int, grams binary, counts binary"
ANSWERED = "chunk bigint, range int, bits binary, hot binary"


def _ask(n_ranges: int):
    def run(batches):
        for row in _each(batches):
            grams, count = np.unique(Chunk(row).anchors().gram, return_counts=True)
            cut = np.searchsorted(_ranges(grams, n_ranges), np.arange(n_ranges + 1))
            full = np.flatnonzero(np.diff(cut))
            six = grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(np.full(len(full), row["chunk"]), pa.int64()),
                    "range": pa.array(full, pa.int32()),
                    "grams": pa.array([six[cut[r] : cut[r + 1]].tobytes() for r in full], pa.binary()),
                    "counts": pa.array([_pack(count[cut[r] : cut[r + 1]].astype("<u4").tobytes()) for r in full], pa.binary()),
                }
            )

    return run


def _answer(table: pa.Table) -> pa.Table:
    rows, counts = table.column("grams").to_pylist(), table.column("counts").to_pylist()
    sizes = [len(r) // 6 for r in rows]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 6)
    times = np.frombuffer(b"".join(_unpack(c, 4 * n) for c, n in zip(counts, sizes, strict=True)), "<u4")
    _, where, chunks_of = np.unique(wide.reshape(-1).view("<u8"), return_inverse=True, return_counts=True)
    more, hot = chunks_of[where] > 1, (np.bincount(where, times) > HOT)[where]
    cuts = np.cumsum([0, *sizes])
    out = {"chunk": table.column("chunk"), "range": table.column("range")}
    for name, flags in (("bits", more), ("hot", hot)):
        out[name] = pa.array([np.packbits(flags[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
    return pa.table(out)


# ---- sorted runs --------------------------------------------------------------------------

RUNS = "chunk bigint, range int, n int, size bigint, lcps binary, tails binary, meta binary, settled binary, windows binary"
WINDOWS = np.dtype([("h0", "<u8"), ("h1", "<u8"), ("doc_id", "<i8"), ("doc", "<i4"), ("at", "<i8")])
META = np.dtype([("doc_id", "<i8"), ("doc", "<i4"), ("at", "<i8"), ("lo", "u1"), ("hi", "u1")])
SPANS = np.dtype([("lo", "<i8"), ("hi", "<i8")])


def _suffixes(raw: np.ndarray, at: np.ndarray, least: np.ndarray, most: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """``len(at) x WIDTH`` bytes: hash, right context, reversed left context, and how far
    back the windows begin.  Bytes that no window covers are zero."""
    out = np.zeros((len(at), WIDTH), np.uint8)
    out[:, :HEAD] = gram.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HEAD :]
    right = LENGTH - least
    for k in range(LENGTH):
        out[:, HEAD + k] = np.where(k < right, raw[np.minimum(at + k, len(raw) - 1)], 0)
    for k in range(SPAN - 1):
        out[:, RIGHT + k] = np.where(k < most, raw[np.maximum(at - 1 - k, 0)], 0)
    out[:, WIDTH - 2], out[:, WIDTH - 1] = least, most
    return out


def _lcps(rows: np.ndarray) -> np.ndarray:
    """Of each row with the one before; 0 for the first, WIDTH for equal rows."""
    differ = rows[1:] != rows[:-1]
    return np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH)]).astype(np.uint8)


def _pack(x: bytes) -> bytes:
    return pa.compress(x, codec="zstd", asbytes=True)


def _unpack(x: bytes, size: int) -> bytes:
    return pa.decompress(x, size, codec="zstd", asbytes=True)


def _meta(x: bytes, n: int) -> np.ndarray:
    raw, out, at = _unpack(x, n * META.itemsize), np.empty(n, META), 0
    for f in META.names:
        kind = META[f]
        out[f] = np.frombuffer(raw, kind, n, at)
        at += n * kind.itemsize
    return out


def _window_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the ``LENGTH`` bytes at each place (ascending), from those of the grams that cover them."""
    out = np.empty((2, len(at)), np.uint64)
    for s in range(0, len(raw), BLOCK):
        lo, hi = np.searchsorted(at, [s, s + BLOCK])
        if lo < hi:
            piece, here = raw[s : s + BLOCK + LENGTH - 1], at[lo:hi] - s
            for k, table in enumerate((_BYTE, _mix(_BYTE))):
                g = _gram_hashes(piece, table)
                x = np.zeros(hi - lo, np.uint64)
                for offset in (*range(0, LENGTH - GRAM, GRAM), LENGTH - GRAM):
                    x = _mix((x ^ g[here + offset]) * _M + _U(offset + 1))
                out[k, lo:hi] = x
    return out[0], out[1]


def _distinct(rows: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different rows, their LCPs, the index of the earliest (by ``place``) of each, and
    those of all others."""
    text = np.ascontiguousarray(rows).view(f"S{WIDTH}").ravel()
    order = np.argsort(place, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    rows = rows[order]
    lcps = _lcps(rows) if len(rows) else np.zeros(0, np.uint8)
    first = lcps < WIDTH
    return rows[first], lcps[first], order[first], order[~first]


def _places(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rank of each place: by id, then by where it is in the chunk (documents follow each other there)."""
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((at, ids))] = np.arange(len(ids))
    return rank


def _hot_windows(c: Chunk, a: Anchors, hot: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different windows of hot anchors at their earliest places, and the starts of the others."""
    size = a.hi[hot] - a.lo[hot] + 1
    at = np.repeat(a.lo[hot] - np.cumsum(size) + size, size) + np.arange(size.sum())
    doc = np.repeat(a.doc[hot], size)
    order = np.argsort(at, kind="stable")
    at, doc = at[order], doc[order]
    found = np.empty(len(at), WINDOWS)
    found["h0"], found["h1"] = _window_hashes(c.raw, at)
    found["doc_id"], found["doc"], found["at"] = ids[doc], doc, at
    found = found[np.lexsort((found["at"], found["doc_id"], found["h1"], found["h0"]))]
    again = _same_windows(found)
    return found[~again], found["at"][again]


def _same_windows(w: np.ndarray) -> np.ndarray:
    """Whether each has the hashes of the one before."""
    same = (w["h0"][1:] == w["h0"][:-1]) & (w["h1"][1:] == w["h1"][:-1])
    return np.concatenate([[False], same])[: len(w)]


def _runs(n_ranges: int):
    def one(row: dict):
        c = Chunk(row)
        a = c.anchors()
        grams, where, count = np.unique(a.gram, return_inverse=True, return_counts=True)
        known, hot = count > 1, np.zeros(len(grams), bool)
        cut = np.searchsorted(_ranges(grams, n_ranges), np.arange(n_ranges + 1))
        for r in row["answers"] or []:
            lo, hi = cut[r["range"]], cut[r["range"] + 1]
            known[lo:hi] |= np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=hi - lo).astype(bool)
            hot[lo:hi] = np.unpackbits(np.frombuffer(r["hot"], np.uint8), count=hi - lo)
        ids = np.array([-(1 << 63) if x is None else x for x in c.doc_ids], np.int64)
        pick = np.flatnonzero((known & ~hot)[where])
        place = _places(ids[a.doc[pick]], a.at[pick])
        # Slice by slice, different suffixes only; then those of all slices together.
        kept, gone = [np.zeros((0, WIDTH), np.uint8)], []
        index = [np.zeros(0, np.int64)]
        for s in range(0, len(pick), SLICE):
            some = pick[s : s + SLICE]
            at = a.at[some]
            rows, _, first, rest = _distinct(_suffixes(c.raw, at, at - a.hi[some], at - a.lo[some], a.gram[some]), place[s : s + SLICE])
            kept.append(rows)
            index.append(s + first)
            gone.append(s + rest)
        index = np.concatenate(index)
        rows, lcps, first, rest = _distinct(np.concatenate(kept), place[index])
        # All but the first of equal suffixes repeat with every window they stand for.
        rest = pick[np.concatenate([index[rest], *gone])]
        own = pick[index[first]]
        windows, again = _hot_windows(c, a, np.flatnonzero(hot[where]), ids)
        settled = np.empty(len(rest) + len(again), SPANS)
        settled["lo"], settled["hi"] = np.append(a.lo[rest], again), np.append(a.hi[rest], again)
        meta = np.empty(len(own), META)
        meta["doc_id"], meta["doc"], meta["at"] = ids[a.doc[own]], a.doc[own], a.at[own]
        meta["lo"], meta["hi"] = a.at[own] - a.hi[own], a.at[own] - a.lo[own]
        cut = np.searchsorted(_ranges(a.gram[own], n_ranges), np.arange(n_ranges + 1))
        parts = []
        for r in np.flatnonzero(np.diff(cut)):
            lo, hi = cut[r], cut[r + 1]
            mine = lcps[lo:hi].copy()
            mine[0] = 0
            tails = rows[lo:hi][np.arange(WIDTH) >= mine[:, None]]
            # Columns of equal kind side by side compress better.
            flat = b"".join(np.ascontiguousarray(meta[f][lo:hi]).tobytes() for f in META.names)
            parts.append((int(r), hi - lo, len(tails), _pack(mine.tobytes()), _pack(tails.tobytes()), _pack(flat), None, None))
        cut = np.searchsorted(_ranges(windows["h0"] >> _U(16), n_ranges), np.arange(n_ranges + 1))
        for r in np.flatnonzero(np.diff(cut)):
            parts.append((int(r), 0, int(cut[r + 1] - cut[r]), None, None, None, None, _pack(windows[cut[r] : cut[r + 1]].tobytes())))
        if len(settled):
            # No range: these only pass by, under keys of their own.
            parts.append((-1 - c.id % n_ranges, 0, 0, None, None, None, settled.tobytes(), None))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(parts), c.id), pa.int64())]
            + [pa.array([p[k] for p in parts], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5))],
            names=["chunk", "range", "n", "size", "lcps", "tails", "meta", "settled", "windows"],
        )

    def run(batches):
        for row in _each(batches):
            yield one(row)

    return run


def _unfold(n: int, lcps: np.ndarray, tails: bytes) -> np.ndarray:
    """Rows of a front-coded run."""
    out = np.zeros((n, WIDTH), np.uint8)
    own = np.arange(WIDTH) >= lcps[:, None]
    out[own] = np.frombuffer(tails, np.uint8)
    source = np.maximum.accumulate(np.where(own, np.arange(n)[:, None], 0), axis=0)
    return np.take_along_axis(out, source, axis=0)


# ---- merging -----------------------------------------------------------------------------

def _common(a: bytes, b: bytes, k: int) -> int:
    """Length of the common prefix, of which ``k`` is known."""
    while k < WIDTH:
        x, y = a[k : k + 16], b[k : k + 16]
        if x != y:
            d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return k + len(x) - (d.bit_length() + 7) // 8
        k += len(x)
    return WIDTH


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs of ``(strings, lcps)``: places ``(run, index)`` in order, and
    the LCP of each with the one before.

    A loser tree whose nodes keep the loser and its LCP with the last winner.  Of
    two contenders the one that shares more with the last winner is smaller; only
    if they share equally much are characters read, from there on."""
    k = 1
    while k < len(runs):
        k *= 2
    done = (-1, -1)  # an LCP of -1: this run has ended
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    shared = [r[1] for r in runs] + [[]] * (k - len(runs))
    at = [0] * k
    tree: list[tuple[int, int]] = [done] * k  # (lcp, run) of the loser

    def play(x: tuple[int, int], y: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        if x[0] > y[0]:
            return x, y
        if x[0] < y[0]:
            return y, x
        if x[0] < 0:
            return x, y
        a, b = strings[x[1]][at[x[1]]], strings[y[1]][at[y[1]]]
        m = _common(a, b, x[0])
        if m == WIDTH or a[m] < b[m]:
            return x, (m, y[1])
        return y, (m, x[1])

    level = [(0, r) if strings[r] else done for r in range(k)]
    base = k // 2
    while len(level) > 1:
        winners = []
        for i in range(0, len(level), 2):
            w, tree[base + i // 2] = play(level[i], level[i + 1])
            winners.append(w)
        level, base = winners, base // 2
    winner = level[0]
    order, lcps = [], []
    while winner[0] >= 0:
        lcp, run = winner
        order.append((run, at[run]))
        lcps.append(lcp)
        at[run] += 1
        now = (shared[run][at[run]], run) if at[run] < len(strings[run]) else done
        node = (k + run) // 2
        while node:
            other = tree[node]
            if now[0] < other[0]:
                tree[node], now = now, other
            elif now[0] == other[0] and now[0] >= 0:
                now, tree[node] = play(now, other)
            node //= 2
        winner = now
    return order, lcps


def _repeats(rows: np.ndarray, lcps: np.ndarray, meta: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """``len(rows) x SPAN``: whether the window that begins so many bytes before the anchor
    occurs earlier.  ``rows`` are sorted, ``lcps`` theirs."""
    n = len(rows)
    out = np.zeros((n, SPAN), bool)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((meta["at"], meta["doc"], chunk, meta["doc_id"]))] = np.arange(n)
    left = np.zeros(n, np.uint64)
    for back in range(SPAN):
        if back:
            left = _mix((left ^ (rows[:, RIGHT + back - 1].astype(np.uint64) + _U(1))) * _M)
        here = np.flatnonzero((meta["lo"] <= back) & (back <= meta["hi"]))
        if len(here) < 2:
            continue
        group = np.cumsum(lcps < RIGHT - back)[here]
        order = np.lexsort((rank[here], left[here], group))
        g, x = group[order], left[here][order]
        again = np.flatnonzero((g[1:] == g[:-1]) & (x[1:] == x[:-1]))
        now, before = here[order[again + 1]], here[order[again]]
        if back:
            equal = (rows[now, RIGHT : RIGHT + back] == rows[before, RIGHT : RIGHT + back]).all(axis=1)
            now = now[equal]
        out[now, back] = True
    return out


def _merged_suffixes(found: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the windows that repeat, and their chunks, from the runs of one range."""
    runs, metas, owners = [], [], []
    for row in found:
        n = row["n"]
        lcps = np.frombuffer(_unpack(row["lcps"], n), np.uint8)
        whole = _unfold(n, lcps, _unpack(row["tails"], row["size"])).tobytes()
        runs.append(([whole[i : i + WIDTH] for i in range(0, len(whole), WIDTH)], lcps.tolist()))
        metas.append(_meta(row["meta"], n))
        owners.append(np.full(n, row["chunk"], np.int64))
    order, lcps = merge_runs(runs)
    begin = np.cumsum([0, *[len(m) for m in metas]])
    place = np.array([begin[r] + i for r, i in order])
    rows = np.frombuffer(b"".join([runs[r][0][i] for r, i in order]), np.uint8).reshape(-1, WIDTH)
    meta, owner = np.concatenate(metas)[place], np.concatenate(owners)[place]
    again = _repeats(rows, np.array(lcps, np.int64), meta, owner)
    # Runs of neighbouring windows, as intervals of window starts.
    edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    r, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    spans = np.empty(len(r), SPANS)
    spans["lo"], spans["hi"] = meta["at"][r] - last, meta["at"][r] - first
    return spans, owner[r]


def _merged_windows(found: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The same from windows of hot grams."""
    parts = [np.frombuffer(_unpack(row["windows"], row["size"] * WINDOWS.itemsize), WINDOWS) for row in found]
    w, owner = np.concatenate(parts), np.repeat([row["chunk"] for row in found], [len(p) for p in parts])
    order = np.lexsort((w["at"], w["doc"], owner, w["doc_id"], w["h1"], w["h0"]))
    w, owner = w[order], owner[order]
    again = _same_windows(w)
    spans = np.empty(int(again.sum()), SPANS)
    spans["lo"] = spans["hi"] = w["at"][again]
    return spans, owner[again]


def merge_range(table: pa.Table) -> pa.Table:
    """Merge the runs of one hash range and report the windows that repeat."""
    if table.column("range")[0].as_py() < 0:
        return pa.table({"chunk": table.column("chunk"), "spans": table.column("settled")})
    rows = table.to_pylist()
    suffixes, windows = [r for r in rows if r["n"]], [r for r in rows if not r["n"]]
    found = ([_merged_suffixes(suffixes)] if suffixes else []) + ([_merged_windows(windows)] if windows else [])
    spans, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.argsort(owner, kind="stable")
    names, cut = np.unique(owner[by], return_index=True)
    blobs = np.split(spans[by], cut[1:]) if len(names) else []
    return pa.table({"chunk": pa.array(names, pa.int64()), "spans": pa.array([b.tobytes() for b in blobs], pa.binary())})


# ---- the operator ----------------------------------------------------------------------

def repeated_spans(packed: DataFrame) -> DataFrame:
    """``chunk, spans``: intervals of window starts that occur earlier."""
    n_bytes = packed.agg(F.sum("n_bytes")).first()[0] or 0
    n_ranges = max(4 * shuffle_width(packed.sparkSession), -(-n_bytes // RANGE_BYTES))
    asked = packed.mapInArrow(_ask(n_ranges), ASKED)
    answered = asked.groupBy("range").applyInArrow(_answer, ANSWERED)
    per_chunk = answered.groupBy("chunk").agg(F.collect_list(F.struct("range", "bits", "hot")).alias("answers"))
    runs = packed.join(per_chunk, "chunk").mapInArrow(_runs(n_ranges), RUNS)
    return runs.groupBy("range").applyInArrow(merge_range, "chunk bigint, spans binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary)."""
    packed = chunks(docs, id_col, text_col)
    spans = repeated_spans(packed).groupBy("chunk").agg(F.collect_list("spans").alias("spans"))

    def cut(batches):
        for row in _each(batches):
            c = Chunk(row)
            found = np.frombuffer(b"".join(row["spans"] or []), SPANS)
            edge = np.zeros(len(c.raw) + 1, np.int64)
            np.add.at(edge, found["lo"], 1)
            np.add.at(edge, found["hi"] + LENGTH, -1)
            gone = np.cumsum(edge)[:-1] > 0
            for lo in range(0, len(c.sizes), 256):
                out = []
                for d in range(lo, min(lo + 256, len(c.sizes))):
                    mine = gone[c.begins[d] : c.ends[d]]
                    starts = int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(len(mine) > 0 and mine[0])
                    out.append((c.doc_ids[d], len(mine), int(mine.sum()), starts, c.raw[c.begins[d] : c.ends[d]][~mine].tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return packed.join(spans, "chunk", "left").mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def report(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
