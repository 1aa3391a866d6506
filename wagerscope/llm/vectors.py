"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Vectors are centred, scaled to length one and turned by a random rotation; the
signs are the code, and the cosine between code and vector is the correction
scalar.  A query's inner products with the codes, divided by that scalar, estimate
those with the vectors, and the error is normal to a good approximation, so a
bound of ``eps`` deviations tells which vectors may be among the nearest.  Only
those are compared in double precision.

Queries meet all codes in a grid of blocks of fixed size.  Each cell returns its
best few per query, so what leaves it does not grow with the candidates.  Of equal
vectors only the ``k + 1`` smallest ids can ever be answers, and equal query
vectors are searched once, so a vector that a third of all rows share costs no more.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from wagerscope.llm.common import row_keys, stored, table

#: Rows of a cell of the grid, and how many of them are estimated or compared at a time.
CANDIDATES, QUERIES = 1 << 18, 1 << 16
STEP_QUERIES, STEP_CANDIDATES, PAIRS = 256, 4096, 1 << 16
KEYS = ("_k1", "_k2")


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding, _k1, _k2`` of vectors that take part: one row per id, one dimension.

    Left out are null ids and vectors that are null, empty, zero or hold null or
    non-finite components.  Of a repeated id the smallest vector counts.  Of
    several dimensions the most frequent one does (of equally frequent, the largest).
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    )
    unique = stored(clean.groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    sizes = unique.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    k1, k2 = row_keys(["embedding"])
    return unique.filter(F.size("embedding") == (sizes["d"] if sizes else 0)).select(
        "vec_id", "embedding", k1.alias("_k1"), k2.alias("_k2")
    )


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centre(rows: DataFrame) -> np.ndarray | None:
    """The mean vector of all rows, from one partial sum per batch; None without rows."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sums = _matrix(batch.column(0)).astype(np.float64).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows]), pa.array(np.arange(1)), pa.array([sums.tolist()])], names=["n", "z", "sums"]
                )

    parts = rows.select("embedding").mapInArrow(run, "n long, z long, sums array<double>")
    places = parts.select("n", F.posexplode("sums").alias("place", "value"))
    means = places.groupBy("place").agg((F.sum("value") / F.sum("n")).alias("mean")).orderBy("place").collect()
    return np.array([r["mean"] for r in means], np.float32).astype(np.float64) if means else None


def rotation(size: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, middle: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length and correction scalar (1 for the centre itself) of each row."""
    rest = vectors.astype(np.float64) - middle
    length = np.sqrt((rest * rest).sum(axis=1))
    turned = (rest @ turn) / np.where(length > 0, length, 1.0)[:, None]
    cosine = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, np.minimum(cosine, 1.0), 1.0)


def index(rows: DataFrame, middle: np.ndarray, turn: np.ndarray) -> DataFrame:
    """``vec_id, embedding, code, length, cosine`` for every row."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                packed, length, cosine = codes(_matrix(batch.column(1)), middle, turn)
                code = pa.array([x.tobytes() for x in packed], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, code, pa.array(length), pa.array(cosine)],
                    names=["vec_id", "embedding", "code", "length", "cosine"],
                )

    kind = rows.schema["embedding"].dataType.simpleString()
    id_kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_kind}, embedding {kind}, code binary, length double, cosine double"
    return rows.select("vec_id", "embedding").mapInArrow(run, schema)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of row pairs, squares added from the first component on."""
    total = np.zeros(len(a))
    for x, y in zip(a.T, b.T, strict=True):
        gap = x - y
        total += gap * gap
    return np.sqrt(total)


class Nearest:
    """The best ``k`` (distance, id) of each query so far."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.distance = np.full((len(queries), k), np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.compared = 0

    def offer(self, which: np.ndarray, rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        """Compare query ``which[i]`` with ``vectors[rows[i]]``, for all i."""
        for i in range(0, len(which), PAIRS):
            q, r = which[i : i + PAIRS], rows[i : i + PAIRS]
            self.compared += len(q)
            d = _distances(self.queries[q], vectors[r])
            near = d <= self.distance[q, -1]
            self._merge(q[near], d[near], ids[r[near]])

    def _merge(self, which: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        changed = np.unique(which)
        q = np.concatenate([np.repeat(changed, self.k), which])
        d = np.concatenate([self.distance[changed].ravel(), distance])
        v = np.concatenate([self.ids[changed].ravel(), ids])
        order = np.lexsort((v, d, q))
        q, d, v = q[order], d[order], v[order]
        first = np.searchsorted(q, changed)
        take = (first[:, None] + np.arange(self.k)).ravel()
        self.distance[changed] = d[take].reshape(-1, self.k)
        self.ids[changed] = v[take].reshape(-1, self.k)


def scan(
    queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray, packed: np.ndarray, length: np.ndarray,
    cosine: np.ndarray, middle: np.ndarray, turn: np.ndarray, k: int, eps: float,
) -> Nearest:
    """The ``k`` nearest candidates of each query, compared only where the bound allows it."""
    size = queries.shape[1]
    rest = (queries - middle) @ turn
    reach = np.sqrt((rest * rest).sum(axis=1))
    slack = eps * np.sqrt(1 - cosine * cosine) / cosine / math.sqrt(max(size - 1, 1))
    best = Nearest(queries, k)
    for i in range(0, len(candidates), STEP_CANDIDATES):
        part = slice(i, i + STEP_CANDIDATES)
        signs = np.unpackbits(packed[part], axis=1, count=size).astype(np.float32) * 2 - 1
        scale = length[part] / (cosine[part] * math.sqrt(size))
        inner = (rest.astype(np.float32) @ signs.T) * scale
        square = length[part] ** 2 + (reach * reach)[:, None] - 2 * inner
        least = square - 2 * (length[part] * slack[part]) * reach[:, None]
        seen = np.zeros(square.shape, bool)
        if i == 0:
            n = min(k, square.shape[1])
            top = np.argpartition(square, n - 1, axis=1)[:, :n]
            which = np.repeat(np.arange(len(queries)), n)
            best.offer(which, top.ravel(), candidates[part], ids[part])
            seen[which, top.ravel()] = True
        # a little room for rounding in the single-precision estimate
        room = 1e-4 * (length[part].max(initial=0.0) + reach) ** 2
        which, rows = np.nonzero(~seen & ~(least > (best.distance[:, -1] ** 2 + room)[:, None]))
        best.offer(which, rows, candidates[part], ids[part])
    return best


def nearest(rows: DataFrame, queries: DataFrame, k: int, eps: float = 3.0, seed: int = 42) -> DataFrame:
    """``_k1, _k2, vec_id, score``: the ``k`` nearest of ``rows`` to each distinct vector of ``queries``.

    Both are rows of ``usable``.  Ties go to the smaller id.  No candidate is
    left out by its block; one is missed only if its estimate is off by more than
    ``eps`` standard deviations.
    """
    spark = rows.sparkSession
    middle = centre(rows)
    place = F.row_number().over(W.partitionBy(*KEYS).orderBy("vec_id"))
    held = rows.withColumn("_place", place).filter(F.col("_place") <= k)
    size = 0 if middle is None else len(middle)
    turn = rotation(size, seed) if size else np.zeros((0, 0))
    coded = stored(index(held, middle, turn), name="codes")
    asked = stored(queries.groupBy(*KEYS).agg(F.first("embedding").alias("embedding")), name="asked")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = max(parts, -(-coded.count() // CANDIDATES))
    down = max(1, -(-asked.count() // QUERIES))

    def cell(a, b):
        return (a.cast("long") * down + b.cast("long")).alias("cell")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = coded.withColumn("_b", every(down)).select(
        cell(F.pmod(F.xxhash64("vec_id"), F.lit(across)), F.col("_b")), "vec_id", "embedding", "code", "length", "cosine"
    )
    right = asked.withColumn("_b", every(across)).select(
        cell(F.col("_b"), F.pmod(F.col("_k1"), F.lit(down))), *KEYS, "embedding"
    )

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        names = [*KEYS, "vec_id", "score"]
        if not c.num_rows or not q.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())], names=names)
        vectors, wanted = _matrix(c["embedding"]).astype(np.float64), _matrix(q["embedding"]).astype(np.float64)
        packed = np.frombuffer(b"".join(c["code"].to_pylist()), np.uint8).reshape(len(vectors), -1)
        ids, length, cosine = (c[n].to_numpy() for n in ("vec_id", "length", "cosine"))
        keys, out = [q[n].to_numpy() for n in KEYS], []
        for i in range(0, len(wanted), STEP_QUERIES):
            part = slice(i, i + STEP_QUERIES)
            best = scan(wanted[part], vectors, ids.astype(np.int64), packed, length, cosine, middle, turn, k, eps)
            full = np.isfinite(best.distance)
            owner = np.nonzero(full)[0] + i
            out.append(pa.table([*(pa.array(x[owner]) for x in keys), pa.array(best.ids[full]), pa.array(best.distance[full])], names=names))
        return pa.concat_tables(out)

    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(
        meet, "_k1 long, _k2 long, vec_id long, score double"
    )
    order = F.row_number().over(W.partitionBy(*KEYS).orderBy("score", "vec_id"))
    return found.withColumn("_place", order).filter(F.col("_place") <= k).drop("_place")


def search(vectors: DataFrame, is_query, k: int = 10, eps: float = 3.0, seed: int = 42) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows of each row that ``is_query`` selects.

    ``vectors`` has ``vec_id`` and ``embedding``; see ``usable`` for rows that take
    no part.  Distance is Euclidean, in double precision on the given components;
    ties go to the smaller id, and fewer candidates than ``k`` are all returned.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = usable(vectors)
    queries = rows.filter(is_query)
    found = nearest(rows, queries, k + 1, eps, seed)
    lists = found.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    asked = queries.select(*KEYS, F.col("vec_id").alias("query_id"))
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.join(lists, [*KEYS])
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.score")
    )


def op8_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
