"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every document's word windows are hashed in the scan tasks and probed against
the benchmark's windows; a hash match is verified on the words themselves.
Only hits, and one marker row per document, leave the map side.

Inputs: null text and text without words give no windows (``n_words`` 0, never
hit).  Repeated rows give one result row each.  A null ``item_id`` counts as
hit and is listed as the empty string.  Columns other than the named id and
text column are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Above this many benchmark windows (about 200 bytes each) the planner's own
# size rules pick the join instead of a broadcast hint.
BROADCAST_WINDOWS = 200_000
# Marker rows keep documents without hits; their keys are spread this wide so
# that they never meet under one key when the join shuffles.
MARKERS = 1024


def words(text: Column) -> Column:
    """ASCII-lower-cased words, in order; empty for null."""
    found = F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _windows(hashes: Column, size: int) -> Column:
    """``(pos, size, key)`` of every window of ``size`` words."""
    made = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size),
        lambda i: F.struct(
            i.alias("pos"),
            F.lit(size).alias("size"),
            F.xxhash64(F.lit(size), *[hashes[i + k] for k in range(size)]).alias("key"),
        ),
    )
    return F.when(F.size(hashes) >= size, made).otherwise(F.array().cast("array<struct<pos:int,size:int,key:bigint>>"))


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("ws", words(F.col("text"))).withColumn(
        "hs", F.transform("ws", lambda w: F.xxhash64(w))
    )


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """``(key, size, window, item)``: all ``n``-word windows of the items; an item
    with fewer words (but some) is one window."""
    base = _hashed(
        items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    )
    made = F.when(F.size("ws") >= n, _windows(F.col("hs"), n))
    for size in range(1, n):
        made = made.when(F.size("ws") == size, _windows(F.col("hs"), size))
    return (
        base.select("item", "ws", F.explode_outer(made).alias("w"))
        .where("w IS NOT NULL")
        .select("w.key", "w.size", F.expr("slice(ws, w.pos + 1, w.size)").alias("window"), "item")
        .distinct()
    )


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, n_hit, items`` (sorted
    ids of items with an occurring window) and ``spans`` (hit windows as
    ``(pos, size)`` in words, sorted)."""
    spark = docs.sparkSession
    windows = item_windows(items, item_col, item_text_col, n).cache()
    try:
        sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # at most n values
        n_windows = windows.count()
    finally:
        windows.unpersist()
    markers = spark.range(MARKERS).select(
        F.col("id").alias("key"),
        F.lit(0).alias("size"),
        F.array().cast("array<string>").alias("window"),
        F.lit(None).cast("string").alias("item"),
    )
    probe = windows.unionByName(markers)

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    base = base.withColumn("text_hash", F.xxhash64("text"))
    marker = F.array(
        F.struct(
            F.lit(-1).alias("pos"), F.lit(0).alias("size"), F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(MARKERS)).alias("key")
        )
    )
    tokens = _hashed(base).select(
        "doc_id",
        "text_hash",
        "ws",
        F.size("ws").alias("n_words"),
        F.concat(marker, *[_windows(F.col("hs"), size) for size in sizes]).alias("found"),
    )
    # The outer form: Spark would push a copy of ``found`` as a not-empty filter
    # below everything else, and compute it twice.  It is never empty.
    rows = tokens.select("doc_id", "text_hash", "n_words", "ws", F.inline_outer("found"))
    right = F.expr("slice(ws, pos + 1, size)") == F.col("window")
    if n_windows <= BROADCAST_WINDOWS:
        hits = rows.join(F.broadcast(probe), ["key", "size"]).where((F.col("size") == 0) | right).drop("ws", "window")
    else:
        # The join shuffles: rows go without the document's words, matches are verified after it.
        found = rows.drop("ws").join(probe, ["key", "size"])
        whole = tokens.select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"), "ws")
        same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_"))
        hits = found.where("size = 0").drop("window").unionByName(
            found.where("size > 0").join(whole, same).where(right).drop("ws", "window", "id_", "hash_")
        )
    # Rows equal in id and text share a group; the marker count restores them.
    per_doc = hits.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum(F.when(F.col("size") == 0, 1).otherwise(0)).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("size") > 0, F.struct("pos", "size")))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["pos"] + s["size"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["pos"] + s["size"] - F.greatest(acc["end"], s["pos"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return (
        per_doc.withColumn("n_hit", covered.cast("long"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), "n_hit", "items", "spans")
    )


def report(hits: DataFrame) -> DataFrame:
    """The per-document digest of :func:`find_hits`."""
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The documents without any hit, all columns as they came."""
    bad = find_hits(docs, items, id_col, text_col, **names).where("n_hit > 0").select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")
    )
    left = docs.alias("d")
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("b.bad_id")) & (F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("b.bad_hash"))
    return left.join(bad.alias("b"), same, "left_anti").select("d.*")
