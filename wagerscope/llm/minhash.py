"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets.

A document's set is its distinct shingles of ``shingle`` words (A-Z lower-cased,
words are runs of non-white-space); a text with fewer words is one shingle, a
text without words has the empty set and is linked with nothing.  A shingle is
its words' XXH64 hashes folded into one 64-bit hash; sets are sets of those.

Signature: one permutation.  Each hash falls into one of ``bands * rows`` bins by
its low 32 bits, and a bin keeps its smallest hash.  Empty bins are filled by
optimal densification: bin ``i`` tries bins ``probe(i, 1), probe(i, 2), ...`` (a
fixed hash of bin and attempt, the same for every document) and copies the first
bin that was filled.  Two sets then agree in a bin with probability close to
their Jaccard similarity.

Buckets: ``bands`` groups of ``rows`` bins each hash to a bucket key.  Inside a
bucket only star-shaped candidate edges are made: every member to the bucket's
smallest and largest set, so a bucket of ``m`` sets gives at most ``2 m`` edges
however large it is, and no pair list of the bucket exists anywhere.  Every edge
is confirmed on the full sets (``100 * |A & B| >= percent * |A | B|``), and the
components of the confirmed edges are found by alternating stars.

Words are hashed by Spark; shingle hashes, signatures and keys are made in
Arrow batches with numpy, and only the keys and a 128-bit digest of each set
are stored.  Exact copies are one set: rows are folded to distinct digests
before buckets are formed.  Full sets are rebuilt only for the rows at the ends
of candidate edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope.llm.common import SPACE, stored, table
from wagerscope.llm.graph import components
from wagerscope.session import work_folder

#: Bands and bins per band: a pair at similarity 0.85 meets in some band with
#: probability 1 - (1 - 0.85^6)^20 > 0.9999, at 0.5 in one band of 20 with 0.27.
BANDS, ROWS = 20, 6


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on unsigned 64-bit numbers (wraps around)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _probe(bins: np.ndarray, attempt: int, k: int) -> np.ndarray:
    """The bin that empty bin ``bins`` copies on try ``attempt``: the same for every set."""
    key = (bins.astype(np.uint64) << np.uint64(32)) | np.uint64(attempt)
    return (_mix(key ^ np.uint64(0x9E3779B97F4A7C15)) % np.uint64(k)).astype(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """``rows x k`` one-permutation signatures of the hash lists ``values[offsets[r]:offsets[r+1]]``.

    Every list must hold at least one hash.  Densified bins copy a filled bin of
    the same row, so the result depends on the set only.
    """
    rows = len(offsets) - 1
    unsigned = values.astype(np.int64).view(np.uint64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    bins = ((unsigned & np.uint64(0xFFFFFFFF)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    sig = np.full(rows * k, np.iinfo(np.int64).max, np.int64)
    np.minimum.at(sig, row * k + bins, values.astype(np.int64))
    filled = np.zeros(rows * k, bool)
    filled[row * k + bins] = True
    sig, filled = sig.reshape(rows, k), filled.reshape(rows, k)
    todo_r, todo_b = np.nonzero(~filled)
    attempt = 0
    while len(todo_r):
        attempt += 1
        source = _probe(todo_b, attempt, k)
        hit = filled[todo_r, source]
        sig[todo_r[hit], todo_b[hit]] = sig[todo_r[hit], source[hit]]
        todo_r, todo_b = todo_r[~hit], todo_b[~hit]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``rows x bands`` signed 64-bit bucket keys, each of ``rows`` bins in order."""
    key = np.zeros((sig.shape[0], bands), np.uint64)
    grouped = sig.view(np.uint64).reshape(sig.shape[0], bands, rows)
    for j in range(rows):
        key = _mix(key ^ grouped[:, :, j])
    return key.view(np.int64)


def word_hashes(docs: DataFrame) -> DataFrame:
    """``_rid, doc_id, wh``: XXH64 of every word (A-Z lower-cased) of each row, in order.

    ``_rid`` numbers the rows; ``docs`` must read the same rows in the same order
    each time it is evaluated (a table read does).
    """
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                        "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, f"{SPACE}+"), lambda w: w != "")
    return docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("wh"),
    )


def shingle_hashes(values: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes per row, from the word hashes of each row.

    A shingle is ``shingle`` consecutive words; a row with fewer words is one
    shingle of all of them; a row without words has none.  Returns the hashes
    and the offsets of each row's hashes.
    """
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    per_row = np.where(lengths >= shingle, lengths - shingle + 1, np.minimum(lengths, 1))
    row = np.repeat(np.arange(rows), per_row)
    first = np.repeat(offsets[:-1] - np.cumsum(np.r_[0, per_row[:-1]]), per_row) + np.arange(per_row.sum())
    span = np.minimum(lengths[row], shingle).astype(np.uint64)
    words = values.astype(np.int64).view(np.uint64)
    h = np.full(len(first), 0x51ED2701, np.uint64)
    if len(words):
        for t in range(shingle):
            at = np.minimum(first + t, len(words) - 1)
            h = np.where(np.uint64(t) < span, _mix(h ^ words[at]), h)
    h = _mix(h ^ span).view(np.int64)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
    h, row = h[fresh], row[fresh]
    return h, np.r_[0, np.cumsum(np.bincount(row, minlength=rows))].astype(np.int64)


def _digests(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each row's hash set (sums of mixed members)."""
    rows = len(offsets) - 1
    d1, d2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    if len(h):
        row = np.repeat(np.arange(rows), np.diff(offsets))
        u = h.view(np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(d1, row, _mix(u ^ np.uint64(0x243F6A8885A308D3)))
            np.add.at(d2, row, _mix(u ^ np.uint64(0x13198A2E03707344)))
    return d1.view(np.int64), d2.view(np.int64)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int64()))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    return values, offsets - offsets[0]


SIGNED = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("_rid", "doc_id", "n_shingles", "d1", "d2")],
    T.StructField("keys", T.ArrayType(T.LongType())),
])


def signed(words: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``_rid, doc_id, n_shingles, d1, d2, keys`` from ``word_hashes`` rows.

    ``keys`` holds the ``bands`` bucket keys (empty without shingles); the sets
    themselves are not kept.
    """

    def run(batches):
        for batch in batches:
            values, offsets = _flat(batch.column(2))
            h, hoff = shingle_hashes(values, offsets, shingle)
            d1, d2 = _digests(h, hoff)
            sizes = np.diff(hoff)
            some = np.flatnonzero(sizes > 0)
            keys = np.zeros((0, bands), np.int64)
            if len(some):
                sub = np.r_[0, np.cumsum(sizes[some])]
                keys = band_keys(signatures(h, sub, bands * rows), bands, rows)
            key_offsets = np.r_[0, np.cumsum(np.where(sizes > 0, bands, 0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(d1), pa.array(d2),
                 _lists(keys.reshape(-1), key_offsets)],
                names=SIGNED.names)

    return words.mapInArrow(run, SIGNED)


def full_sets(words: DataFrame, shingle: int) -> DataFrame:
    """``_rid, hs``: the sorted distinct shingle hashes of each ``word_hashes`` row."""
    schema = T.StructType([T.StructField("_rid", T.LongType()), T.StructField("hs", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            values, offsets = _flat(batch.column(1))
            h, hoff = shingle_hashes(values, offsets, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(h, hoff)], names=schema.names)

    return words.select("_rid", "wh").mapInArrow(run, schema)


def candidates(members: DataFrame) -> DataFrame:
    """``u, v`` star edges: each member of a shared bucket to its smallest and largest member.

    ``members`` holds distinct ``band, key, sid`` rows.  Bucket sizes and ends are
    partial aggregates, so a bucket of any size is combined before its shuffle.
    """
    on = ["band", "key"]
    ends = (
        members.groupBy(*on)
        .agg(F.count("*").alias("m"), F.min("sid").alias("lo"), F.max("sid").alias("hi"))
        .filter("m > 1")
        .drop("m")
    )
    both = members.join(ends, on).select(
        "sid", F.explode(F.array("lo", "hi")).alias("centre"))
    return both.filter("sid <> centre").select(
        F.least("sid", "centre").alias("u"), F.greatest("sid", "centre").alias("v")).distinct()




def confirmed(edges: DataFrame, words: DataFrame, shingle: int, percent: int, folder: str) -> DataFrame:
    """The ``u, v`` edges whose full sets meet ``100 * |A & B| >= percent * |A | B|``.

    Only the rows at the ends of an edge get their sets rebuilt; the list of
    ends is stored first, so Spark's size check can broadcast it when small.
    """
    ends = stored(edges.select(F.col("u").alias("_rid")).union(edges.select(F.col("v").alias("_rid"))).distinct(),
                  folder, "ends")
    needed = stored(full_sets(words.join(ends, "_rid", "left_semi"), shingle), folder, "needed")
    left = needed.select(F.col("_rid").alias("u"), F.col("hs").alias("hu"))
    right = needed.select(F.col("_rid").alias("v"), F.col("hs").alias("hv"))
    both = edges.join(left, "u").join(right, "v").withColumn("i", F.size(F.array_intersect("hu", "hv")))
    union = F.size("hu") + F.size("hv") - F.col("i")
    return both.filter(F.lit(100) * F.col("i") >= F.lit(percent) * union).select("u", "v")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 85, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest doc_id of the rows whose sets are linked to
    this row's, itself included; ``kept`` is ``doc_id <=> component_id``.  Rows
    without words have ``n_shingles = 0`` and are alone.  Repeated rows stay
    repeated and share one set.  A null doc_id takes part in linking but is the
    component's id only when no row of it has an id (then ``kept`` is true).
    Texts of any length are used whole.  Other columns, whatever their names and
    types, are ignored.  An empty table gives no rows.  ``docs`` must read the
    same rows in the same order each time (a table read does).
    """
    folder = work_folder(docs.sparkSession)
    words = word_hashes(docs.select("doc_id", "text"))
    meta = stored(signed(words, shingle, bands, rows), folder, "signed")
    with_words = meta.filter("n_shingles > 0")
    sets = stored(with_words.groupBy("d1", "d2").agg(F.min("_rid").alias("sid")), folder, "sets")
    # one row per set and band after the fold, so exact copies weigh once
    members = stored(
        with_words.select("d1", "d2", F.posexplode("keys").alias("band", "key")).distinct()
        .join(sets, ["d1", "d2"]).select("band", "key", "sid"),
        folder, "members",
    )
    edges = stored(candidates(members), folder, "candidates")
    roots = stored(components(confirmed(edges, words, shingle, percent, folder)), folder, "roots")
    placed = (
        meta.select("_rid", "doc_id", "n_shingles", "d1", "d2")
        .join(sets, ["d1", "d2"], "left")
        .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        .withColumn("root", F.coalesce("root", "sid", F.col("_rid")))
    )
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(smallest, "root").select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents``: 5-word shingle sets linked at Jaccard 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))
