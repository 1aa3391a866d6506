"""Periodic runs of words by recompression and grammar LCE queries.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal), at least ``max(min_length, 3 q)`` words long, that no
neighbouring word extends with period ``q``.

Every such run of period ``q`` holds a multiple ``j`` of ``q`` with ``[j, j + 2q)``
inside it (the harmonic grid: ``n / q`` points for each ``q``).  A grid point
whose words agree with those ``q`` further on is extended both ways by longest
common extension (LCE) queries, which gives the maximal ``q``-periodic stretch
around it.  A point inside a run already found with a period dividing ``q``
gives that run again and is skipped.

An extension first compares ``WINDOW`` words directly; longer ones (the long
periodic stretches) are answered on a recompression grammar of the word sequence,
without suffix arrays: levels alternate block compression (a maximal repeat
``a^k`` becomes one symbol) and pair compression (with the symbols split into a
left and a right half by a hash, each left-right pair becomes one symbol).  A
symbol names one expansion, so equal symbols at two positions let a query jump
over the whole expansion; runs of equal symbols are jumped at once.  Backward
extensions use the grammar of the reversed sequence.

Texts are split into words by Spark; the grammar and queries run per document
in Arrow batches, one document at a time, in memory linear in its words.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope.llm.common import SPACE, table

#: Grid points examined at once; bounds the memory of the candidate arrays.
GRID_CHUNK = 1 << 20
#: Words compared directly before an extension turns to the grammar.
WINDOW = 64


def _side(symbols: np.ndarray, level: int) -> np.ndarray:
    """0 (left) or 1 (right) per symbol, by a hash of the symbol and the level."""
    x = symbols.astype(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
    return (x & np.uint64(1)).astype(np.int8)


def _packed(values: np.ndarray) -> array:
    """Signed 64-bit numbers in a compact sequence that ``bisect`` can search."""
    out = array("q")
    out.frombytes(np.ascontiguousarray(values, np.int64).tobytes())
    return out


def _level(starts: np.ndarray, syms: np.ndarray) -> tuple[array, array, array]:
    return _packed(starts), _packed(syms), _packed(_rests(syms))


def _rests(symbols: np.ndarray) -> np.ndarray:
    """For each index, how many equal symbols follow from it on, itself included."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(symbols[1:] != symbols[:-1]) + 1, n)
    run_end = np.repeat(ends, np.diff(ends, prepend=0))
    return run_end - np.arange(n)


class Grammar:
    """The recompression levels of one sequence of integer symbols.

    Level ``l`` holds the start position of every symbol (with the sequence's
    length after the last), the symbols and their run lengths.  Starts of a
    higher level are starts of every lower one.
    """

    def __init__(self, seq: np.ndarray):
        self.n = n = len(seq)
        self.seq = seq.astype(np.int64)
        starts, syms = np.arange(n + 1, dtype=np.int64), self.seq
        self.levels = [_level(starts, syms)]
        fresh = int(syms.max()) + 1 if n else 0
        level, idle = 0, 0
        while len(syms) > 1 and idle < 8:
            level += 1
            before = len(syms)
            # block compression: a maximal repeat of one symbol becomes one symbol
            heads = np.flatnonzero(np.concatenate(([True], syms[1:] != syms[:-1])))
            lengths = np.diff(np.append(heads, len(syms)))
            if (lengths > 1).any():
                multi = lengths > 1
                keys = syms[heads][multi] * (n + 1) + lengths[multi]  # symbols < 2n + 1, lengths <= n
                uniq, inverse = np.unique(keys, return_inverse=True)
                syms = syms[heads].copy()
                syms[multi] = fresh + inverse.reshape(-1)
                fresh += len(uniq)
                starts = np.append(starts[heads], n)
                self.levels.append(_level(starts, syms))
            # pair compression: a left symbol followed by a right one becomes one symbol
            if len(syms) > 1:
                side = _side(syms, level)
                pair = np.flatnonzero((side[:-1] == 0) & (side[1:] == 1))
                if len(pair):
                    keys = syms[pair] * fresh + syms[pair + 1]
                    uniq, inverse = np.unique(keys, return_inverse=True)
                    merged = syms.copy()
                    merged[pair] = fresh + inverse.reshape(-1)
                    fresh += len(uniq)
                    keep = np.ones(len(syms), bool)
                    keep[pair + 1] = False
                    syms = merged[keep]
                    starts = np.append(starts[:-1][keep], n)
                    self.levels.append(_level(starts, syms))
            idle = idle + 1 if len(syms) == before else 0

    def lce(self, i: int, j: int) -> int:
        """How many words from ``i`` on equal those from ``j`` on."""
        total, n, levels = 0, self.n, self.levels
        while i < n and j < n:
            best = None
            for starts, syms, rests in levels:
                a = bisect_left(starts, i)
                if starts[a] != i or a >= len(syms):
                    break
                b = bisect_left(starts, j)
                if starts[b] != j or b >= len(syms) or syms[a] != syms[b]:
                    break
                best = (starts, a, rests[a], rests[b])
            if best is None:
                return total
            starts, a, ra, rb = best
            step = (starts[a + 1] - starts[a]) * min(ra, rb)
            i, j, total = i + step, j + step, total + step
        return total


def planted(ids: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The word sequence after the contract's periodic change (none for a null id)."""
    n = len(ids)
    if doc_id is None or not n:
        return ids
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return ids
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    source = np.arange(n)
    source[a:] = a + (source[a:] - a) % p
    return ids[source]


def runs(ids: np.ndarray, min_length: int = 24) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of ``ids``, by start, then period."""
    n = len(ids)
    if n < 2:
        return []
    grammars: list[Grammar] = []  # forward and backward, built at the first long extension

    def grammar() -> list[Grammar]:
        if not grammars:
            grammars.extend([Grammar(ids), Grammar(ids[::-1].copy())])
        return grammars

    def ahead_of(a: int, b: int) -> int:
        """LCE(a, b): a direct look at ``WINDOW`` words, the grammar beyond."""
        m = min(WINDOW, n - b)
        miss = np.flatnonzero(ids[a:a + m] != ids[b:b + m])
        if len(miss) or m < WINDOW:
            return int(miss[0]) if len(miss) else m
        return WINDOW + grammar()[0].lce(a + WINDOW, b + WINDOW)

    def back_of(a: int, b: int) -> int:
        """How many words before ``a`` equal those before ``b``."""
        m = min(WINDOW, a)
        if not m:
            return 0
        miss = np.flatnonzero(ids[a - m:a][::-1] != ids[b - m:b][::-1])
        if len(miss) or m < WINDOW:
            return int(miss[0]) if len(miss) else m
        return WINDOW + grammar()[1].lce(n - a + WINDOW, n - b + WINDOW)
    found: dict[tuple[int, int], int] = {}
    by_period: list[tuple[int, int, int]] = []  # (start, end, period) in order of period
    q = 1
    while 3 * q <= n and q <= n:
        # a chunk of periods whose grid points fit GRID_CHUNK
        qs = [q]
        size = (n - 2 * q) // q + 1
        while 3 * (qs[-1] + 1) <= n and size + (n - 2 * (qs[-1] + 1)) // (qs[-1] + 1) + 1 <= GRID_CHUNK:
            qs.append(qs[-1] + 1)
            size += (n - 2 * qs[-1]) // qs[-1] + 1
        periods = np.array(qs, np.int64)
        counts = (n - 2 * periods) // periods + 1
        big_q = np.repeat(periods, counts)
        k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        js = k * big_q
        ok = ((ids[js] == ids[js + big_q]) & (ids[js + big_q - 1] == ids[js + 2 * big_q - 1])
              & (ids[js + big_q // 2] == ids[js + big_q + big_q // 2]))
        cand_q, cand_j = big_q[ok], js[ok]
        for period in qs:
            sel = cand_j[cand_q == period]
            if not len(sel):
                continue
            inside = np.zeros(len(sel), bool)
            for s, e, p in by_period:
                if period % p == 0 and e - s >= 2 * period:
                    inside |= (sel >= s) & (sel + 2 * period <= e)
            last_end = -1
            for j in sel[~inside].tolist():
                if j < last_end - period:
                    continue
                ahead = ahead_of(j, j + period)
                if ahead < period:
                    continue
                back = back_of(j, j + period)
                start, end = j - back, j + period + ahead
                last_end = end
                if end - start >= max(min_length, 3 * period) and (start, end) not in found:
                    found[(start, end)] = period
                    by_period.append((start, end, period))
        q = qs[-1] + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def summary(words: list[str] | np.ndarray, ids: np.ndarray, doc_id: int | None, min_length: int = 24) -> dict:
    """The contract's row for one document from its words and their ids."""
    ids = planted(ids, doc_id)
    found = runs(ids, min_length)
    best = None
    for s, length, p in found:
        if best is None or length * best[2] > best[1] * p:
            best = (s, length, p)  # ties keep the earlier start, then the smaller period
    drop = np.zeros(len(ids), bool)
    for s, length, p in found:
        drop[s + p : s + length] = True
    source = planted(np.arange(len(ids)), doc_id)
    kept = " ".join(words[i] for i in source[~drop].tolist())
    listing = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    return {
        "n_runs": len(found),
        "start": best and best[0], "length": best and best[1], "period": best and best[2],
        "exponent_milli": best and (1000 * best[1]) // best[2],
        "runs_sha256": hashlib.sha256(listing.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(kept.encode()).hexdigest(),
    }


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_runs", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in ("start", "length", "period", "exponent_milli")],
    T.StructField("runs_sha256", T.StringType()),
    T.StructField("collapsed_sha256", T.StringType()),
])


def periodic_runs(docs: DataFrame, min_length: int = 24) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``); see ``SCHEMA``.

    Words are maximal runs of anything but space and ``\\t \\n \\v \\f \\r``,
    compared exactly.  A null or blank text has no words: no runs, four null
    best-run columns and the hashes of empty strings.  Documents whose doc_id
    hashes so get the contract's periodic change first; a null doc_id never
    does.  Texts of any length are used whole.  Repeated rows stay repeated.
    Other columns are ignored; an empty table gives no rows.
    """
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), f"{SPACE}+"), lambda w: w != "")

    def run(batches):
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.flatten() if len(lists) else pa.array([], pa.string())
            codes = pc.dictionary_encode(flat).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            values = flat.to_numpy(zero_copy_only=False)
            base = offsets[0]
            out = []
            for r, doc_id in enumerate(doc_ids):
                lo, hi = offsets[r] - base, offsets[r + 1] - base
                out.append({"doc_id": doc_id, **summary(values[lo:hi], codes[lo:hi], doc_id, min_length)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in SCHEMA.fields]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("words")).mapInArrow(run, SCHEMA)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``, with the contract's planted periods."""
    return periodic_runs(table(spark, sf_dir, "documents"))
