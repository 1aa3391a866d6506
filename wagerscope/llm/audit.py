"""Filter interaction audit over a sparse document-term matrix.

Five document filters fail a text when:

* A: it has fewer than ``min_words`` words;
* B: ``100 * distinct words < 50 * words``;
* C: ``100 * [A-Z] characters > 3 * code points``;
* D: it holds any of ``#$%&*|``;
* E: its text equals the text of a smaller doc_id anywhere in the table.

A and B come from the document-term matrix: words are dictionary-encoded
globally (one id per distinct word of the whole table: its XXH64, checked
against a stored dictionary to be one-to-one), term counts per document are the
matrix entries, and the matrix is stored as CSR shards (each a CSR block over a
slice of the documents, built inside the task that read them).  Row sums give the
words of a document, nonzero counts its distinct words.  C, D and E are
attached per document, and everything is folded to counts per (part, failure
mask) before the 120 filter orders are laid over them, so the report costs the
same for any number of documents.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from wagerscope.llm.common import SPACE, stored, table
from wagerscope.session import work_folder

# Fixed values of the audit: the filter letters in order, the characters of D and of C.
LETTERS = "ABCDE"
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def hashed_words(docs: DataFrame) -> DataFrame:
    """``_rid, terms``: the global term id (XXH64 of the word) of every word, in order."""
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    return docs.select("_rid", F.transform(words, lambda w: F.xxhash64(w)).alias("terms"))


def dictionary(docs: DataFrame, folder: str) -> DataFrame:
    """``term, word``: the stored dictionary of all distinct words of ``docs`` (``text``).

    Ids are XXH64 of the word, so every task encodes a word alike without a
    join.  Words are folded per task by hashing before the shuffle, never sorted.
    Raises if two words ever share an id (then the ids are not a dictionary).
    """
    words = docs.select(F.explode(F.array_distinct(F.split("text", f"{SPACE}+"))).alias("word")).filter("word <> ''")
    table_ = stored(words.select(F.xxhash64("word").alias("term"), "word").distinct(), folder, "dictionary")
    clashes = table_.groupBy("term").count().where("count > 1").count()
    if clashes:
        raise ValueError(f"{clashes} term ids are shared by two words")
    return table_


_CSR = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("rows", T.ArrayType(T.LongType())),
    T.StructField("indptr", T.ArrayType(T.LongType())),
    T.StructField("indices", T.ArrayType(T.LongType())),
    T.StructField("data", T.ArrayType(T.LongType())),
])


def csr_shards(hashed: DataFrame) -> DataFrame:
    """One CSR block per Arrow batch of documents: ``shard, rows, indptr, indices, data``.

    ``rows`` are the documents of the block (all of them, also those without
    words), ``indptr`` their offsets into ``indices`` (term ids, ascending) and
    ``data`` (term counts).  Blocks slice the documents, so each row is whole
    in one block and the matrix is built without a shuffle.
    """
    schema = pa.schema([(f.name, pa.int32() if f.name == "shard" else pa.list_(pa.int64())) for f in _CSR.fields])

    def one(values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))

    def build(batches):
        import pyspark

        shard = pyspark.TaskContext.get().partitionId()
        for batch in batches:
            rids = batch.column(0).to_numpy()
            terms = batch.column(1)
            offsets = terms.offsets.to_numpy().astype(np.int64)
            values = terms.values.to_numpy()[offsets[0]:offsets[-1]]
            # One number per entry, (row, rank of its term among the batch's), so that a plain sort puts equal ones together.
            coded = pa.array(values).dictionary_encode()
            distinct = coded.dictionary.to_numpy()
            order = np.argsort(distinct)
            rank = np.empty(len(distinct), np.int64)
            rank[order] = np.arange(len(distinct))
            wide = max(len(distinct), 1)
            entries = np.repeat(np.arange(len(rids)) * wide, np.diff(offsets)) + rank[coded.indices.to_numpy()]
            entries.sort()
            starts = np.flatnonzero(np.diff(entries, prepend=-1))
            counts = np.diff(np.append(starts, len(entries)))
            entries = entries[starts]
            indptr = np.searchsorted(entries, np.arange(len(rids) + 1) * wide)
            terms = distinct[order][entries % wide]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), one(rids), one(indptr), one(terms), one(counts)], schema=schema)

    return hashed.mapInArrow(build, _CSR)


def row_statistics(shards: DataFrame) -> DataFrame:
    """``_rid, n_words, n_distinct``: row sums and nonzero counts of the stored matrix."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("_rid", "n_words", "n_distinct")])

    def flat(column) -> tuple[np.ndarray, np.ndarray]:
        return column.offsets.to_numpy().astype(np.int64), column.values.to_numpy().astype(np.int64)

    def reduce(batches):
        for batch in batches:
            (ro, rv), (po, pv), (do, dv) = (flat(batch.column(i)) for i in range(3))
            for b in range(batch.num_rows):
                rows, ptr, data = rv[ro[b]:ro[b + 1]], pv[po[b]:po[b + 1]], dv[do[b]:do[b + 1]]
                if not len(rows):
                    continue
                sums = np.add.reduceat(np.append(data, 0), ptr[:-1]) * (np.diff(ptr) > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array(sums.astype(np.int64)), pa.array(np.diff(ptr))], names=schema.names)

    return shards.select("rows", "indptr", "data").mapInArrow(reduce, schema)


def failure_masks(docs: DataFrame, labels: DataFrame | None, min_words: int = 200) -> DataFrame:
    """``part, mask, good, toxic`` per row of ``docs``; bit ``i`` of ``mask`` is filter ``LETTERS[i]``.

    ``part`` is ``lang`` (null: empty string).  Null texts are empty.  A null
    doc_id fails E never and makes no other row fail E.  ``good`` and ``toxic``
    are 1 if any ``labels`` row of the doc_id says so, else 0.  Repeated rows count
    as often as they occur; a row equal to one with a smaller doc_id fails E.
    """
    folder = work_folder(docs.sparkSession)
    base = docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    dictionary(base, folder)
    shards = stored(csr_shards(hashed_words(base)), folder, "csr")
    stats = row_statistics(shards)
    flags = base.select(
        "_rid", "doc_id", "part",
        (F.lit(100) * (F.length("text") - F.length(F.translate("text", CAPITALS, ""))) >
         F.lit(3) * F.length("text")).alias("c"),
        F.col("text").rlike(SYMBOLS).alias("d"),
        # equal texts: two independent 64-bit digests and the length (128 bits and more)
        F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"),
        F.length("text").alias("chars"),
    )
    digest = ["h1", "h2", "chars"]
    first = flags.groupBy(*digest).agg(F.min("doc_id").alias("first"))
    n = F.coalesce("n_words", F.lit(0))
    mask = (
        F.when(n < min_words, 1).otherwise(0)
        + F.when(F.lit(100) * F.coalesce("n_distinct", F.lit(0)) < F.lit(50) * n, 2).otherwise(0)
        + F.when(F.col("c"), 4).otherwise(0)
        + F.when(F.col("d"), 8).otherwise(0)
        + F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    )
    out = flags.join(first, digest).join(stats, "_rid", "left")
    if labels is not None:
        marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
        )
        out = out.join(marks, "doc_id", "left")
    else:
        out = out.withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    return out.select("part", mask.alias("mask"), F.coalesce("good", F.lit(0)).alias("good"),
                      F.coalesce("toxic", F.lit(0)).alias("toxic"))


def orders() -> list[tuple[str, int, str, int, int]]:
    """``filter_order, step, letter, bit, before``: every step of every order of the letters."""
    out = []
    for perm in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(perm, 1):
            bit = 1 << LETTERS.index(letter)
            out.append(("".join(perm), step, letter, bit, before))
            before |= bit
    return out


def interaction_report(masks: DataFrame) -> DataFrame:
    """One row per (part, filter_order, step) from ``part, mask, good, toxic`` rows.

    Counts: ``kept`` after the step, ``removed`` at it, ``redundant`` (fail its
    filter, removed earlier), ``unique_fails`` (fail its filter only),
    ``good_lost``/``toxic_lost`` (removed here and labelled so), ``shapley`` (its
    filter's removals summed over all orders).  Every part gets all 600 rows,
    zeros included; no rows without any part.
    """
    folded = masks.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("g"), F.sum("toxic").alias("t"))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(x).alias("letter"),
                               F.lit(b).alias("bit"), F.lit(p).alias("before")) for o, s, x, b, p in orders()])
    laid = folded.select("part", "mask", "n", "g", "t", F.inline(steps))
    fails = (F.col("mask").bitwiseAND(F.col("bit")) != 0)
    earlier = (F.col("mask").bitwiseAND(F.col("before")) != 0)
    gone = fails & ~earlier

    def total(cond, value="n"):
        return F.sum(F.when(cond, F.col(value)).otherwise(0)).cast("long")

    report = laid.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~earlier).alias("kept"),
        total(gone).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(gone, "g").alias("good_lost"),
        total(gone, "t").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(W.partitionBy("part", "letter")).cast("long")
    return report.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed",
                         "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters over all ``documents``, per language, with ``labels``."""
    masks = failure_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return interaction_report(masks)


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), f AS (
  SELECT part, doc_id,
    (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
  FROM w
), lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT f.part, f.mask, count(*) AS n, sum(coalesce(good, 0)) AS g, sum(coalesce(toxic, 0)) AS tx
  FROM f LEFT JOIN lab ON f.doc_id = lab.doc_id GROUP BY f.part, f.mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), perms AS (
  SELECT a.letter || b.letter || c.letter || e.letter || x.letter AS filter_order,
         [a.bit, b.bit, c.bit, e.bit, x.bit] AS bits
  FROM letters a, letters b, letters c, letters e, letters x
  WHERE a.bit + b.bit + c.bit + e.bit + x.bit = 31
), steps AS (
  SELECT filter_order, s AS step, substr(filter_order, s, 1) AS letter, bits[s] AS bit,
         CAST(list_sum(bits[1:s - 1]) AS INTEGER) AS before
  FROM perms, range(1, 6) r(s)
), rep AS (
  SELECT m.part, filter_order, CAST(step AS INTEGER) AS step, letter,
    CAST(sum(CASE WHEN (mask & bit) = 0 AND (mask & coalesce(before, 0)) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN (mask & bit) <> 0 AND (mask & coalesce(before, 0)) = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN (mask & bit) <> 0 AND (mask & coalesce(before, 0)) <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN (mask & bit) <> 0 AND (mask & coalesce(before, 0)) = 0 THEN g ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN (mask & bit) <> 0 AND (mask & coalesce(before, 0)) = 0 THEN tx ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM m, steps GROUP BY m.part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM rep
"""
