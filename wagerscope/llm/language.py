"""Language identification by n-gram filters that answer with a mask of languages.

A Bloom filter per language, cut into bits: position by position, one word holds
that position's bit of every language.  Looking an n-gram up is then a conjunction
of a few words, whose bits name all languages that contain it.  Per language the
share of a text's n-grams that answer yes, corrected for the filter's own rate of
false positives, decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope.llm.common import stored, table

#: Log of the positions of the filter, and how many each n-gram sets.
LOG_POSITIONS, HASHES = 18, 3
#: An n-gram belongs to a language if this share of its documents has it.
MIN_SHARE = 0.01
#: Characters of a text that are cut into n-grams at a time.
CHUNK = 1 << 20
UNKNOWN = "und"
# Odd multipliers of the multiplicative hashes.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> list[np.ndarray]:
    """One number per letter: it and its neighbours, lower-cased, other characters as spaces.

    Long texts give several arrays; every letter is in one of them.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    points = np.where(_letters()[points], points, 32).astype(np.uint64)
    points = np.concatenate([[np.uint64(32)], points, [np.uint64(32)]])
    out = []
    for i in range(1, len(points) - 1, CHUNK):
        end = min(i + CHUNK, len(points) - 1)
        before, middle, after = points[i - 1 : end - 1], points[i:end], points[i + 1 : end + 1]
        grams = before | (middle << np.uint64(21)) | (after << np.uint64(42))
        out.append(grams[middle != 32])
    return out


def positions(grams: np.ndarray) -> list[np.ndarray]:
    shift = np.uint64(64 - LOG_POSITIONS)
    folded = grams ^ (grams >> np.uint64(29))
    return [(folded * np.uint64(m)) >> shift for m in MULTIPLIERS[:HASHES]]


@dataclass(frozen=True)
class Filter:
    """``words[position, i]`` has the bits of languages ``64 i`` and on; ``wrong``, their false-positive rates."""

    languages: tuple[str, ...]
    words: np.ndarray
    wrong: np.ndarray

    def shares(self, text: str) -> np.ndarray | None:
        """Per language, the corrected share of the text's n-grams that it contains; None without letters."""
        total, hits = 0, np.zeros(len(self.languages))
        for grams in trigrams(text):
            total += len(grams)
            at = positions(grams)
            for i in range(self.words.shape[1]):
                column = self.words[:, i]
                mask = column[at[0]]
                for x in at[1:]:
                    mask = mask & column[x]
                for bit in range(min(64, len(self.languages) - 64 * i)):
                    hits[64 * i + bit] += np.count_nonzero(mask & np.uint64(1 << bit))
        if not total:
            return None
        wrong = np.minimum(self.wrong, 1 - 1e-9)
        return np.clip((hits / total - wrong) / (1 - wrong), 0.0, 1.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        shares = self.shares(text) if text else None
        if shares is None or not len(shares):
            return UNKNOWN, 0.0
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n``: in how many documents of a language an n-gram is; null gram: all its documents.

    Documents are folded inside each task first, so what is shuffled is bounded by
    the n-grams of a language, not by its documents.
    """

    def run(batches):
        for batch in batches:
            grams: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = [np.unique(x) for x in trigrams(text)]
                grams.setdefault(lang, []).append(own[0] if len(own) == 1 else np.unique(np.concatenate([np.empty(0, np.uint64), *own])))
            for lang, parts in grams.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                keys = pa.concat_arrays([pa.array(found.astype(np.int64)), pa.array([None], pa.int64())])
                counts = np.append(n, len(parts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts)), keys, pa.array(counts)], names=["lang", "gram", "n"]
                )

    rows = labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(labelled: DataFrame, min_share: float = MIN_SHARE) -> Filter:
    """The filter of the languages of ``labelled`` (``lang, text``), from all its rows.

    The driver gets one row per language and at most one per position.  Rows with
    null language or text teach nothing.
    """
    counts = stored(gram_counts(labelled), name="grams")
    totals = {r["lang"]: r["n"] for r in counts.filter("gram IS NULL").collect()}
    languages = tuple(sorted(totals))
    words = np.zeros((1 << LOG_POSITIONS, max(1, -(-len(languages) // 64))), np.uint64)
    if languages:
        number = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.lit(i))])
        needed = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(max(2.0, min_share * totals[k]) if totals[k] > 1 else 1.0))])
        kept = counts.filter("gram IS NOT NULL").filter(F.col("n") >= needed[F.col("lang")])

        def run(batches):
            for batch in batches:
                lang = batch.column(0).to_numpy()
                at = positions(batch.column(1).to_numpy().astype(np.uint64))
                bit = np.left_shift(np.uint64(1), (lang % 64).astype(np.uint64)).view(np.int64)
                for x in at:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.astype(np.int64)), pa.array((lang // 64).astype(np.int64)), pa.array(bit)],
                        names=["position", "word", "bits"],
                    )

        set_bits = kept.select(number[F.col("lang")].cast("long").alias("lang"), "gram").mapInArrow(
            run, "position long, word long, bits long"
        )
        for r in set_bits.groupBy("position", "word").agg(F.bit_or("bits").alias("bits")).collect():
            words[r["position"], r["word"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    fill = np.array([np.count_nonzero(words[:, i // 64] & np.uint64(1 << i % 64)) for i in range(len(languages))])
    return Filter(languages, words, (fill / (1 << LOG_POSITIONS)) ** HASHES)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 1 when divided by 3 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame, model: Filter) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per document.

    ``score`` is the estimated share of the text's n-grams that the language
    contains; ties go to the smaller language code.  Null texts, texts without
    letters, and all texts if nothing was learned are ``und`` with score 0.
    Repeated rows are answered each; other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, learn(docs.filter(~held_out(F.col("doc_id"))).select("lang", "text")))
