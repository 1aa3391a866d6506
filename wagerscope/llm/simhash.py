"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of ``BITS`` bits that differ in at most ``max_bits`` bits are
linked.  The fingerprint is cut into ``max_bits // 2 + 1`` segments, so that two
linked ones differ by at most one bit in some segment.  Each segment is indexed
once for every bit left out of it (one wildcard); linked fingerprints then share
such a variant, so an equality join finds them and the bit distance is verified.

Texts are folded to distinct fingerprints first, so a group of exact copies is
one row from there on.  A variant that many fingerprints share is not joined
with itself: its members are indexed by the points at most one bit away from
them.  Two of them are linked exactly if they share a point, no point has more
than ``BITS + 1`` members, and tying each to the smallest keeps every component.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from wagerscope.llm.common import row_keys, stored, table, whole
from wagerscope.llm.graph import components
from wagerscope.session import work_folder

BITS = 64
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def _bit_counts(digests: list[bytes]) -> np.ndarray:
    """How many of the digests have each bit, from the highest bit down.

    Rows of 0/1 bytes are added eight at a time as 64-bit numbers, at most 255
    rows per sum, so no byte overflows.
    """
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8)).reshape(-1, BITS)
    pad = -len(bits) % 255
    if pad:
        bits = np.concatenate([bits, np.zeros((pad, BITS), np.uint8)])
    lanes = bits.view(np.uint64).reshape(-1, 255, BITS // 8).sum(axis=1)
    return lanes.view(np.uint8).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The signed 64-bit fingerprint of one UTF-8 text; 0 without words."""
    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= shingle:
        total, counts = 1, _bit_counts([digest(joined, seed)])
    else:
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        total, counts = len(words) - shingle + 1, np.zeros(BITS, np.int64)
        for i in range(0, total, CHUNK):
            j = min(i + CHUNK, total)
            ends = starts[i + shingle : j + shingle]
            counts += _bit_counts(
                [digest(joined[a : b - 1], seed) for a, b in zip(starts[i:j], ends, strict=True)]
            )
    packed = np.packbits(2 * counts > total).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def fingerprints(docs: DataFrame, text: Column, keep: list[Column], shingle: int, seed: int) -> DataFrame:
    """The ``keep`` columns and ``fp``, one row per row of ``docs``."""
    rows = docs.select(*keep, text.cast("binary").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, slot, value``: every segment with one of its bits left out."""
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    parts = max_bits // 2 + 1
    cuts = [BITS * i // parts for i in range(parts + 1)]
    segment = F.lit(None).cast("long")
    for low, high in reversed(list(zip(cuts, cuts[1:], strict=False))):
        mask = (1 << high) - (1 << low)
        mask -= (1 << BITS) if mask >> (BITS - 1) else 0
        segment = F.when(F.col("slot") < high, F.lit(mask).cast("long")).otherwise(segment)
    wildcard = F.expr("~shiftleft(1L, slot)")
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("slot")).withColumn(
        "value", F.col("fp").bitwiseAND(segment).bitwiseAND(wildcard)
    )


def links(fps: DataFrame, max_bits: int = 2, pair_limit: int = 8) -> DataFrame:
    """``u, v`` links between distinct fingerprints, enough to connect every linked pair.

    ``pair_limit`` is where a shared variant goes from pairwise joining to the
    points around its members; both find the same components.
    """
    if max_bits == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter("false")
    # Variants are shuffled once: only those that are shared go on.
    count = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, on = variants(fps.repartition(count, "fp"), max_bits), ["slot", "value"]
    if max_bits == 2:  # a slot and half a fingerprint fit one number
        half = F.when(F.col("slot") < BITS // 2, F.col("value")).otherwise(F.shiftrightunsigned("value", BITS // 2))
        packed = F.shiftleft(F.col("slot").cast("long"), BITS // 2).bitwiseOR(half)
        keys, on = keys.select("fp", packed.alias("key")), ["key"]
    members = stored(keys.withColumn("n", F.count("*").over(W.partitionBy(*on))).filter("n > 1"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    few = members.filter(F.col("n") <= pair_limit).drop("n")
    pairs = (
        few.withColumnRenamed("fp", "u").join(few.withColumnRenamed("fp", "v"), on).filter("u < v")
    ).select("u", "v")
    many = members.filter(F.col("n") > pair_limit).select("fp").distinct()
    flips = F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1))).alias("bit")
    points = many.select("fp", flips).withColumn(
        "point", F.expr("IF(bit < 0, fp, fp ^ shiftleft(1L, bit))")
    )
    stars = points.select(F.col("fp").alias("u"), F.min("fp").over(W.partitionBy("point")).alias("v"))
    return pairs.filter(near).unionAll(stars.filter("u <> v").filter(near)).distinct()


def classes(marked: DataFrame, max_bits: int = 2) -> DataFrame:
    """``fp, root, component_id`` per distinct fingerprint of ``marked`` (``doc_id, fp``).

    ``root`` is the smallest fingerprint of the component, ``component_id`` its
    smallest document id (null only if it has no other).
    """
    folder = work_folder(marked.sparkSession)
    own = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), folder, "classes")
    linked = stored(components(links(own.select("fp"), max_bits)), folder, "components")
    rooted = own.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, root``.

    A-Z are lower-cased, words are cut at ASCII white space, and shingles of
    ``shingle`` words are hashed with XXH64; a bit is set if over half of the
    hashes have it.  Null, empty and blank texts have fingerprint 0 and are
    linked like others.  Shorter texts than a shingle are one shingle.  Repeated
    rows stay repeated.  A null id is never a component's id while another is
    there.  Other columns are ignored; an empty table gives no rows.
    """
    keep = [F.col("doc_id").alias("doc_id")]
    marked = stored(fingerprints(docs, F.col("text"), keep, shingle, seed))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(classes(marked, max_bits), "fp").select("doc_id", hexed, "component_id", "root")


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the smallest id's.

    Rows that share that id are told apart by content; equal rows count once.
    """
    k1, k2 = row_keys(docs.columns)
    keep = [F.col("doc_id").alias("doc_id"), k1.alias("_k1"), k2.alias("_k2")]
    marked = stored(fingerprints(docs, F.col("text"), keep, shingle, seed))
    first = (
        marked.join(classes(marked, max_bits), "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("_k1", "_k2")).alias("k"))
        .select("k._k1", "k._k2")
    )
    keyed = docs.select(whole(docs.columns), k1.alias("_k1"), k2.alias("_k2"))
    return keyed.join(first, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("_row.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("root")
