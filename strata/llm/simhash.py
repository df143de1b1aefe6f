"""SimHash fingerprints: weighted term hashes vote on signed bits.

A fingerprint has 128 bits, written as 32 hex digits.  Terms are ASCII-lower-
cased words; each occurrence votes with weight ``(min(length, 8) - 1) ** 2``, so
short function words, shared by unrelated texts, hardly count.  A text without words of
two or more characters, or whose words have over GLUED characters on average (scripts that
don't put blanks between words), votes by its GRAM-character runs instead.  Two 32-bit
vote counters share one long, so 128 bits need 64 sums; they hold a text of
more than 40 million words.

Inputs: null text counts as empty, and only empty texts have the fingerprint of 32
zeros.  Repeated rows are rows of their own.  The order of documents is ``doc_id``
descending, null ids last (spread by a hash of their text), ties by text.  An empty table
gives an empty one; other columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, shuffle_width
from .decontaminate import words

BITS = 128
LANES = 0x0000000100000001  # one counter in either half of a long
LOW = 0xFFFFFFFF
MAX_LEN = 8
GRAM, GLUED = 3, 24
# Copies with a 5-word Jaccard similarity of 0.8 or more lie 6 bits away on average; 16
# bits hold 99.5 % of them, while unrelated texts are about 63 away.
RADIUS = 16
FLIPS = 2  # bits in which a leading block may differ
LEAD_BITS = 60  # of a longer block, the first bits lead


def term_weight(term: Column) -> Column:
    short = F.least(F.length(term), F.lit(MAX_LEN)) - 1
    return F.when(term.isNotNull(), (short * short).cast("long")).otherwise(F.lit(0).cast("long"))


def character_runs(text: Column) -> Column:
    """All runs of GRAM characters, or the whole text if it is shorter."""
    runs = F.regexp_extract_all(ascii_lower(text), F.lit("(?s)(?=(.{%d}))" % GRAM), F.lit(1))
    return F.when(F.length(text) >= GRAM, runs).otherwise(F.array(ascii_lower(text)))


def _is_wordless(ws: Column, text: Column) -> Column:
    n = F.size(ws)
    letters = F.aggregate(ws, F.lit(0), lambda total, w: total + F.length(w))
    return (F.length(text) > 0) & (F.forall(ws, lambda w: F.length(w) < 2) | ((F.length(text) > n * GLUED) & (letters > n * GLUED)))


def _half_hex(half: int) -> Column:
    """16 hex digits from the 32 counter pairs of one 64-bit half."""
    bits = []
    for i in range(32):
        s = F.col(f"v{half}_{i}")
        bits.append(F.when(s.bitwiseAND(LOW) * 2 > F.col("votes"), F.lit(1 << i)).otherwise(F.lit(0)))
        bits.append(
            F.when(F.shiftrightunsigned(s, 32) * 2 > F.col("votes"), F.shiftleft(F.lit(1).cast("long"), i + 32)).otherwise(F.lit(0))
        )
    total = bits[0].cast("long")
    for b in bits[1:]:
        total = total.bitwiseOR(b.cast("long"))
    return F.lpad(F.hex(total), 16, "0")


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint``: one row per key tuple.  Where ``texts`` is already
    partitioned by some of the keys, nothing is shuffled."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text__")
    parts = texts.select(*keys, text, words(text).alias("words__"))
    parts = parts.withColumn("runs__", _is_wordless(F.col("words__"), F.col("text__")))
    found = F.when(F.col("runs__"), character_runs(F.col("text__"))).otherwise(F.col("words__"))
    terms = parts.select(*keys, "runs__", F.explode_outer(found).alias("term"))
    weight = F.when(F.col("runs__"), F.lit(1).cast("long")).otherwise(term_weight(F.col("term")))
    hashed = terms.select(*keys, weight.alias("w"), F.xxhash64("term").alias("h0"), F.xxhash64("term", F.lit(17)).alias("h1"))
    sums = [F.sum("w").alias("votes")]
    for half in (0, 1):
        h = F.col(f"h{half}")
        sums += [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(LANES) * F.col("w")).alias(f"v{half}_{i}") for i in range(32)]
    voted = hashed.groupBy(*keys).agg(*sums)
    return voted.select(*keys, F.concat(_half_hex(1), _half_hex(0)).alias("fingerprint"))


def _words64(fp: str, part: int) -> Column:
    """One 64-bit half of a hex fingerprint as a long."""
    digits = F.substring(F.col(fp), 1 + 16 * part, 16)
    high = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(F.conv(F.substring(digits, 9, 8), 16, 10).cast("long"))


def distance(a: str, b: str) -> Column:
    """Hamming distance of two fingerprint columns."""
    return sum((F.bit_count(_words64(a, p).bitwiseXOR(_words64(b, p))) for p in (0, 1)), F.lit(0))


def likeness(a: str, b: str) -> Column:
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def blocks(radius: int) -> list[tuple[int, int, int]]:
    """``begin, end, flips`` of the block each permuted table leads with.  The flips
    plus one add up to ``radius + 1``, so of two fingerprints within the radius at
    least one block differs in no more bits than its flips."""
    n = radius + 1 if radius <= 3 else max(4, -(-(radius + 1) // (FLIPS + 1)))
    cuts = [round(k * BITS / n) for k in range(n + 1)]
    more, spare = divmod(radius + 1, n)
    return [(cuts[k], min(cuts[k + 1], cuts[k] + LEAD_BITS), more - 1 + (k < spare)) for k in range(n)]


def _block(high: Column, low: Column, begin: int, end: int) -> Column:
    """Bits ``begin`` to ``end`` (from the highest) of two longs, at most 60 of them."""
    mask = F.lit((1 << (end - begin)) - 1).cast("long")
    if end <= 64:
        return F.shiftrightunsigned(high, 64 - end).bitwiseAND(mask)
    if begin >= 64:
        return F.shiftrightunsigned(low, BITS - end).bitwiseAND(mask)
    upper = F.shiftleft(high, end - 64).bitwiseOR(F.shiftrightunsigned(low, BITS - end))
    return upper.bitwiseAND(mask)


def _hex(high: str, low: str) -> Column:
    return F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0"))


def block_table(fps: DataFrame, radius: int) -> DataFrame:
    """``high, low, slot, block`` of distinct fingerprints: each permuted table leads
    with another block."""
    halves = fps.select("fingerprint").distinct().select(_words64("fingerprint", 0).alias("high"), _words64("fingerprint", 1).alias("low"))
    led = [F.struct(F.lit(k).alias("slot"), _block(F.col("high"), F.col("low"), b, e).alias("block")) for k, (b, e, _) in enumerate(blocks(radius))]
    return halves.select("high", "low", F.inline(F.array(*led)))


def _masks(spark, radius: int) -> DataFrame:
    """``slot, mask``: what a leading block is met with, at most ``flips`` bits set."""
    rows = [
        (k, sum(1 << i for i in bits))
        for k, (b, e, flips) in enumerate(blocks(radius))
        for size in range(flips + 1)
        for bits in combinations(range(e - b), size)
    ]
    return spark.createDataFrame(rows, "slot int, mask bigint")


def neighbours(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (``query``, ``fingerprint``) of a distinct fingerprint of ``queries``
    and one of ``fps`` at most ``radius`` bits apart, the equal one included.

    The queries meet each table with their block and all blocks a few flips away, so
    that blocks are long and buckets small.  A pair that meets in several tables
    comes from the first of them alone, and the distance is tested inside the join,
    so only true neighbours leave it.  ``radius`` is at most 31."""
    masks = F.broadcast(_masks(queries.sparkSession, radius))  # depends on the radius alone
    q = block_table(queries, radius).join(masks, "slot").select(
        F.col("high").alias("q_high"), F.col("low").alias("q_low"), "slot", F.col("block").bitwiseXOR(F.col("mask")).alias("block")
    )
    t = block_table(fps, radius)
    high, low = F.col("q_high").bitwiseXOR(F.col("high")), F.col("q_low").bitwiseXOR(F.col("low"))
    first = F.lit(True)
    for k, (b, e, flips) in enumerate(blocks(radius)):
        first = first & ((F.bit_count(_block(high, low, b, e)) > flips) | (F.lit(k) >= F.col("q.slot")))
    near = F.bit_count(high) + F.bit_count(low) <= radius
    on = (F.col("q.slot") == F.col("t.slot")) & (F.col("q.block") == F.col("t.block")) & near & first
    found = q.alias("q").join(t.alias("t"), on)
    return found.select(_hex("q_high", "q_low").alias("query"), _hex("high", "low").alias("fingerprint"))


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents in buckets of consecutive ids, highest first, about a shuffle
    partition each; the head of the next bucket is added to each bucket as a
    sentinel, after its own rows."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = shuffle_width(spark)
    cuts = base.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10 * n + 1000).alias("q")).first().q or []
    bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]).cast("array<bigint>")
    above = F.size(F.filter(bounds, lambda b: b >= F.col("doc_id")))
    # Rows without an id come last, spread by their text.
    bucket = F.when(F.col("doc_id").isNotNull(), above).otherwise(n + 1 + F.pmod(F.xxhash64("text"), F.lit(n)))
    rows = base.withColumn("bucket", bucket.cast("int"))
    heads = sorted(tuple(r) for r in rows.groupBy("bucket").agg(F.max("doc_id")).collect())  # a row per bucket
    into = [(b, i, heads[k - 1][0]) for k, (b, i) in enumerate(heads)]
    # A row per bucket, so the documents need no shuffle to find their heads.
    wanted = F.broadcast(spark.createDataFrame(into, "b int, head bigint, into int"))
    firsts = rows.join(wanted, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("head")))
    sentinels = firsts.groupBy("into").agg(F.min(F.struct("text", "doc_id")).alias("s")).select(
        "s.doc_id", "s.text", F.col("into").alias("bucket"), F.lit(True).alias("sentinel")
    )
    return rows.withColumn("sentinel", F.lit(False)).unionByName(sentinels)


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket, rn, doc_id, sentinel, text, n_chars, edited``: every text with its
    last third replaced by the beginning of the next document."""
    order = Window.partitionBy("bucket").orderBy("sentinel", F.col("doc_id").desc_nulls_last(), "text")
    third = F.floor(F.length("text") / 3).cast("int")
    return (
        _ordered(docs, id_col, text_col)
        .select("*", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars as int) - cast(floor(n_chars / 3) as int))"), F.coalesce(F.substring("next", F.lit(1), third), F.lit(""))))
        .drop("next")
    )


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    edits = with_edits(docs, id_col, text_col).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["bucket", "rn", "doc_id", "sentinel", "n_chars", "edited_sha256"]
    both = edits.select(
        *keys,
        F.inline(F.array(F.struct(F.lit(0).alias("which"), F.col("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))),
    )
    fps = fingerprints(both, [*keys, "which"])
    row = fps.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    following = Window.partitionBy("bucket").orderBy("rn")
    return (
        row.withColumn("next_fingerprint", F.lead("fingerprint").over(following))
        .where(~F.col("sentinel"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
            likeness("fingerprint", "next_fingerprint").alias("near_next"),
        )
    )


def near_counts(report: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``query`` fingerprint and ``near_docs``: how many documents lie within the radius."""
    found = neighbours(queries, report, radius)
    size = report.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("docs"))
    return found.join(size, "fingerprint").groupBy("query").agg(F.sum("docs").alias("near_docs"))
