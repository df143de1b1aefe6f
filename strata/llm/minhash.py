"""Near-duplicate documents by b-bit MinHash, confirmed on whole shingle sets.

1. Sketch: 128 minima per document over its distinct 5-word shingles; 25 band
   keys of 5 minima each; the low 4 bits of every minimum packed into 8 longs.
   Two sets of similarity 0.85 share no band with probability 4e-7.
2. Documents with equal sets form a class; from here on a class is one row.
3. Candidates: in every band bucket each class meets the bucket's leader: the class that
   shares most buckets with others, as the text does that near copies were made from.
   Each class confirms the leader it meets in most buckets.  The
   packed bits estimate the similarity, ``(matches - C) / (1 - C)`` with
   ``C = 1/16`` for chance; pairs far below the threshold go (0.14 is more than
   four standard deviations).
4. Confirmed links make components.  Buckets that still hold several draw other leaders,
   and the classes of other components confirm the likeliest three.
5. What is left then compares the classes outside a bucket's largest component with those
   of other components; a pair counts in the first bucket it shares.  So every pair of a
   bucket is either known to be connected or tested.  A round costs the size of its
   buckets; pairs are left only of classes that no leader has tied to the others.  Those
   classes get a longer sketch, of LONG_HASHES minima, which rules out pairs over 0.055 (four
   standard deviations) below the threshold within the join; only the others are confirmed.

Inputs: null text and text without words have an empty set and are linked with
nothing.  Fewer than five words are one shingle.  Rows with equal ids are rows
of their own.  A null id never is a component's id; a component of null ids
alone has a null ``component_id``.  The contract's ``kept`` marks every row that has
its component's id; ``first_of_each`` leaves exactly one row of each component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import connected_components

SHINGLE = 5
HASHES = 128
BANDS, ROWS = 25, 5
LOW_BITS = 4
THRESHOLD = 85  # percent
MARGIN = 0.14
LONG_HASHES, LONG_MARGIN = 1024, 0.055
LEADERS = (1, 3)  # that a class confirms, round by round
SALTS = 32  # parts of the rows that repeat one id and text
CHUNK = 1 << 16  # shingles hashed at a time

_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of texts (as UTF-8 bytes); keeps word hashes."""

    def __init__(self, size: int = SHINGLE, keep: int = 250_000):
        self.size, self.keep, self.known = size, keep, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        import xxhash

        words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        n = min(self.size, len(h))
        total = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            total = total * _M + h[k : k + len(total)]
            total ^= total >> np.uint64(29)
        return np.unique(_mix(total))


def _functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 63, size=(2, n), dtype=np.int64).astype(np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1] * np.uint64(2)


def minima(sets: list[np.ndarray], n: int = HASHES, seed: int = 20240229) -> np.ndarray:
    """``len(sets) x n`` minima of non-empty sets."""
    a, b = _functions(n, seed)
    x = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((n, len(sets)), np.uint64)
    for j in range(n):
        out[j] = np.minimum.reduceat(x * a[j] + b[j], starts)
    return out.T


def low_bits(m: np.ndarray) -> np.ndarray:
    """The low bits of minima, packed into longs."""
    low = _mix(m) & np.uint64((1 << LOW_BITS) - 1)
    per = 64 // LOW_BITS
    packed = np.zeros((len(m), m.shape[1] // per), np.uint64)
    for k in range(per):
        packed |= low[:, k::per] << np.uint64(LOW_BITS * k)
    return packed.view(np.int64)


def sketch(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed low bits of non-empty sets."""
    m = minima(sets)
    bands = np.empty((len(sets), BANDS), np.uint64)
    for i in range(BANDS):
        key = np.full(len(sets), i + 1, np.uint64)
        for k in range(ROWS):
            key = _mix(key * _M + m[:, i * ROWS + k])
        bands[:, i] = key
    return bands.view(np.int64), low_bits(m)


def _set_key(s: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, n_shingles, c0, c1, bands, sig``; no keys for empty sets."""

    def run(batches):
        shingler = Shingler()

        def rows(ids, hashes, sets):
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = [_set_key(s) if len(s) else (None, None) for s in sets]
            bands, sig = [None] * len(sets), [None] * len(sets)
            if full:
                b, p = sketch([sets[i] for i in full])
                for i, x, y in zip(full, b, p, strict=True):
                    bands[i], sig[i] = x, y
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "text_hash": pa.array(hashes, pa.int64()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "c0": pa.array([k[0] for k in keys], pa.int64()),
                    "c1": pa.array([k[1] for k in keys], pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "sig": pa.array(sig, pa.list_(pa.int64())),
                }
            )

        ids, hashes, sets, n = [], [], [], 0
        for batch in batches:
            for doc_id, text, h in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                s = shingler(text.as_py())
                ids.append(doc_id)
                hashes.append(h)
                sets.append(s)
                n += len(s)
                if n >= CHUNK or len(ids) >= 2048:
                    yield rows(ids, hashes, sets)
                    ids, hashes, sets, n = [], [], [], 0
        if ids:
            yield rows(ids, hashes, sets)

    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, c0 bigint, c1 bigint, bands array<bigint>, sig array<bigint>"
    return _id_and_bytes(docs, id_col, text_col).mapInArrow(run, schema)


def _id_and_bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("text_hash"))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``c0, c1, shingles`` of the documents' whole sets."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                sets = [shingler(t.as_py()) for t in batch.column(0)[lo : lo + 64]]
                sets = [s for s in sets if len(s)]
                keys = [_set_key(s) for s in sets]
                yield pa.RecordBatch.from_pydict(
                    {
                        "c0": pa.array([k[0] for k in keys], pa.int64()),
                        "c1": pa.array([k[1] for k in keys], pa.int64()),
                        "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    }
                )

    return _id_and_bytes(docs, id_col, text_col).select("text").mapInArrow(run, "c0 bigint, c1 bigint, shingles array<bigint>")


def long_sketches(sets: DataFrame) -> DataFrame:
    """``cls, long``: the packed low bits of LONG_HASHES minima of whole sets."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [np.asarray(x.as_py(), np.int64).view(np.uint64) for x in part.column(1)]
                packed = low_bits(minima(found, LONG_HASHES, 20240301))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(packed), pa.list_(pa.int64()))], names=["cls", "long"])

    return sets.select("cls", "shingles").mapInArrow(run, "cls bigint, long array<bigint>")


def _unlike(x: Column, y: Column) -> Column:
    """How many lanes of two longs differ."""
    d = x.bitwiseXOR(y)
    d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
    d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
    return F.bit_count(d.bitwiseAND(0x1111111111111111))


def _similarity(differ: Column, hashes: int) -> Column:
    """Share of equal lanes, less those that agree by chance."""
    chance = 1.0 / (1 << LOW_BITS)
    return (F.lit(1.0) - differ / F.lit(float(hashes)) - chance) / (1 - chance)


def estimate(x: str, y: str) -> Column:
    """Similarity from two packed signatures."""
    return _similarity(sum((_unlike(F.col(x)[k], F.col(y)[k]) for k in range(HASHES * LOW_BITS // 64)), F.lit(0)), HASHES)


def long_estimate(x: str, y: str) -> Column:
    """The same from two long ones, written as a loop: they have many longs."""
    return _similarity(F.aggregate(F.zip_with(x, y, _unlike), F.lit(0), lambda total, d: total + d), LONG_HASHES)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    sa = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.select("a", "b").join(sa, "a").join(sb, "b")
        .withColumn("both", both)
        .where(F.expr(f"100 * both >= {threshold} * (size(sa) + size(sb) - both)"))
        .select("a", "b")
    )


def _placed(docs: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, first_hash``: the component's
    smallest id (null ids last) and that id's smallest text hash."""
    sketched = stage(sketches(docs, id_col, text_col), "sketches")
    classes = stage(
        sketched.where("n_shingles > 0")
        .groupBy("c0", "c1")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash"))).alias("first"),
            F.min(F.struct("bands", "sig")).alias("s"),
        )
        .select(F.monotonically_increasing_id().alias("cls"), "c0", "c1", "first.first_id", "first.first_hash", "s.bands", "s.sig"),
        "shingle-classes",
    )
    least = threshold / 100 - MARGIN
    keys = classes.select("cls", F.posexplode("bands").alias("band", "bucket"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stage(keys.join(shared, "bucket"), "bucket-members")
    sigs = classes.select("cls", "sig")

    def with_estimate(pairs: DataFrame) -> DataFrame:
        sa = sigs.select(F.col("cls").alias("a"), F.col("sig").alias("ga"))
        sb = sigs.select(F.col("cls").alias("b"), F.col("sig").alias("gb"))
        return pairs.join(sa, "a").join(sb, "b").withColumn("est", estimate("ga", "gb")).where(F.col("est") >= least).drop("ga", "gb")

    # Whole sets of the classes that share any bucket, from their first documents.
    wanted = members.select("cls").distinct().join(classes.select("cls", "c0", "c1", "first_id"), "cls")
    read = docs.alias("d").join(
        wanted.select("first_id").distinct().alias("w"), F.col(f"d.`{id_col}`").cast("bigint").eqNullSafe(F.col("w.first_id")), "left_semi"
    )
    sets = stage(
        shingle_sets(read, id_col, text_col).join(wanted.select("c0", "c1", "cls"), ["c0", "c1"]).select("cls", "shingles").dropDuplicates(["cls"]),
        "shingle-sets",
    )

    def meet_leaders(placed: DataFrame, weight: Column, n: int) -> DataFrame:
        """Links ``a, b`` between components, from each class and the ``n`` likeliest leaders of its buckets."""
        lead = F.max_by(F.struct(F.col("cls").alias("lead"), F.col("comp").alias("of")), weight).alias("l")
        met = placed.join(placed.groupBy("bucket").agg(lead), "bucket").where("comp <> l.of")
        met = met.groupBy("cls", "comp", "l.lead", "l.of").agg(F.count(F.lit(1)).alias("n"))
        # A class meets at most BANDS leaders.
        best = F.slice(F.sort_array(F.collect_list(F.struct("n", "lead", "of")), asc=False), 1, n)
        likeliest = met.groupBy(F.col("cls").alias("b"), "comp").agg(F.explode(best).alias("m"))
        pairs = stage(with_estimate(likeliest.select("b", F.col("m.lead").alias("a"), F.col("comp").alias("cb"), F.col("m.of").alias("ca"))), "leader-pairs")
        return _confirmed(pairs, sets, threshold).join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))

    def moved(nodes: DataFrame, merged: DataFrame) -> DataFrame:
        """With ``comp`` replaced by the component it is part of now."""
        to = merged.select(F.col("node").alias("comp"), "root")
        return nodes.join(to, "comp", "left").withColumn("comp", F.coalesce("root", "comp")).drop("root")

    def still_mixed(placed: DataFrame) -> DataFrame:
        """Rows of the buckets that hold several components, with the largest one's ``major``."""
        sizes = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
        mixed = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
        return placed.drop("major").join(mixed.select("bucket", "major"), "bucket")

    central = members.groupBy("cls").agg(F.sum("size").alias("central"))
    placed = members.join(central, "cls").select("bucket", "band", "cls", F.col("cls").alias("comp"), "central")
    comps = classes.select("cls", F.col("cls").alias("comp"))
    for k, n in enumerate(LEADERS):
        weight = F.struct("central", F.xxhash64("cls")) if not k else F.struct(F.xxhash64("bucket", "cls", F.lit(k)), "cls")
        merged = connected_components(meet_leaders(placed, weight, n))
        comps = stage(moved(comps, merged), "components")
        placed = stage(still_mixed(moved(placed, merged)), "mixed-buckets")
        if placed.isEmpty():
            break

    # Pairs of what is left.
    left = placed.select("cls").distinct()
    longer = stage(long_sketches(sets.join(left, "cls", "left_semi")).join(classes.select("cls", "sig", "bands"), "cls"), "long-sketches")
    rest = placed.join(longer, "cls")
    own = {"cls": "{}", "comp": "c{}", "sig": "g{}", "bands": "b{}", "long": "l{}"}
    side = lambda x: [F.col(c).alias(name.format(x)) for c, name in own.items()]
    minor = rest.where("comp <> major").select("bucket", "band", *side("a"))
    other = rest.select("bucket", (F.col("comp") == F.col("major")).alias("is_major"), *side("b"))
    cross = (
        minor.alias("m").join(
            other.alias("o"),
            (F.col("m.bucket") == F.col("o.bucket"))
            & (F.col("is_major") | (F.col("ca") < F.col("cb")))
            & (F.col("ca") != F.col("cb"))
            & (estimate("ga", "gb") >= least)
            & ~F.arrays_overlap(F.slice("ba", 1, F.col("band")), F.slice("bb", 1, F.col("band")))
            & (long_estimate("la", "lb") >= threshold / 100 - LONG_MARGIN),
        )
        .select("a", "b", "ca", "cb")
        .distinct()
    )
    cross = stage(cross, "cross-pairs")
    linked = _confirmed(cross, sets, threshold).join(cross, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = connected_components(linked)

    final = moved(classes.select("cls", "c0", "c1", "first_id", "first_hash").join(comps, "cls"), merged)
    first = F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "first_hash")).alias("first")
    ids = final.groupBy("comp").agg(first).select("comp", F.col("first.first_id").alias("component_id"), "first.first_hash")
    named = final.select("c0", "c1", "comp").join(ids, "comp").select(F.col("c0").alias("k0"), F.col("c1").alias("k1"), "component_id", "first_hash")
    rows = sketched.select("doc_id", "text_hash", "n_shingles", "c0", "c1")
    placed_docs = rows.join(named, (F.col("c0") == F.col("k0")) & (F.col("c1") == F.col("k1")), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return placed_docs.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), "first_hash")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, component_id, kept``."""
    placed = _placed(docs, id_col, text_col, threshold).drop("first_hash")
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The documents without those that repeat an earlier one, columns as they came:
    one row of each component, null ids included.  Rows without words stay."""
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    found = _placed(docs, id_col, text_col, threshold).where("n_shingles > 0").withColumn("first", first)
    keyed = found.groupBy(F.col("doc_id").alias("rep_id"), F.col("text_hash").alias("rep_hash"))
    repeats = stage(keyed.agg(F.first("first").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 OR NOT first"), "repeats")
    the_id, the_hash = F.col(f"d.`{id_col}`").cast("bigint"), F.xxhash64(F.col(f"d.`{text_col}`"))
    same = the_id.eqNullSafe(F.col("r.rep_id")) & (the_hash == F.col("r.rep_hash"))
    single = docs.alias("d").join(repeats.alias("r"), same, "left_anti").select("d.*")
    again = repeats.where("first")
    if again.isEmpty():
        return single
    # One row of those equal in id and text: the least by its columns.  They are
    # spread over SALTS parts, each of which finds its own first.
    row = F.struct("*")
    packed = docs.select(row.alias("d"), F.xxhash64(F.to_json(row)).alias("place"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    parts = again.select("rep_id", "rep_hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("rep_salt")).alias("r")
    one = packed.join(parts, same & (F.col("salt") == F.col("rep_salt")))
    for keys in (["rep_id", "rep_hash", "rep_salt"], ["rep_id", "rep_hash"]):
        one = one.groupBy(*keys).agg(F.min_by("d", "place").alias("d"), F.min("place").alias("place"))
    return single.unionByName(one.select("d.*"))
