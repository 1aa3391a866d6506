"""Token ids as ORC: run-length coded integers, row indexes, Bloom filters on document ids.

Documents are dealt by ranges of their id and sorted, so the files, in the order
of their names, hold them in ascending order.  Each file is cut into stripes that
are read in parallel; minimum, maximum and a Bloom filter of the ids let a lookup
skip stripes and row groups.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from wagerscope.llm.common import table
from wagerscope.llm.lattice import spread
from wagerscope.llm.pieces import slices
from wagerscope.session import work_folder

FILE = "seq long, doc_id long, n_tokens long, ids array<int>"
#: Distinct pieces that go through the tokenizer as one text, and the texts, and their bytes, whose pieces are taken together.
TOGETHER, TEXTS, BYTES = 4096, 16_384, 8_000_000
#: Pieces after which a worker forgets those not met of late, and the longest ones it remembers.
REMEMBERED, LONGEST = 400_000, 48
#: A space that touches other white space, where a text must not be cut.
_ODD = r" [\s\x0b\x1c-\x1f\x{85}\pZ]|[\s\x0b\x1c-\x1f\x{85}\pZ] | $|^ "
#: Two white-space characters in a row, and a letter before a sign; letters and signs of any Unicode version.
_BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\pZ]{2}"
_WORD_END = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}])([!-/:-@\[-`{-~])"


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct piece of a slice encoded once.

    A byte-level tokenizer starts a new pre-token at a single space between two
    other characters.  Texts are cut there, and their distinct pieces once more
    where the rule of the tokenizer at hand starts one too: between a letter and a
    sign, and before a single newline.
    Distinct pieces, each with its space or newline, go through the tokenizer as
    one text, and the only tokens that begin with a space (newline) are the first
    ones of the pieces.  Remembered pieces lie in one Arrow array, their ids as
    32-bit numbers beside it; the distinct pieces of a slice are looked up in it
    together, and pieces not met since the last time are forgotten when it is full.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: By id, whether the token begins with a space or a newline; the byte-level alphabet writes them as U+0120, U+010A.
        self.begins = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in " \n"}
        for c, sign in zip(" \n", "\u0120\u010a", strict=True):
            self.begins[c][[i for t, i in vocabulary.items() if t.startswith(sign)]] = True
        #: Remembered pieces, their ids one after another and how many each has, and whether it was met of late.
        self.pieces = pa.array([], pa.string())
        self.ids, self.lengths, self.used = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)
        #: Whether the pre-token rule is known to end words at signs and newlines.
        form = json.loads(self.tokenizer.to_str())
        rule = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.finer = not form["normalizer"] and rule.items() <= (form["pre_tokenizer"] or {}).items()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and how many each has; every text on its own."""
        found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _tokenized(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that begin with the same character, a space or a newline, and hold it nowhere else."""
        ids, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, len(pieces), TOGETHER):
            some = pieces.slice(i, TOGETHER).to_pylist()
            found, _ = self._each(["".join(some)])
            starts = np.flatnonzero(self.begins[some[0][0]][found])
            if len(starts) == len(some) and starts[0] == 0:
                many = np.diff(np.append(starts, len(found)))
            else:
                found, many = self._each(some)
            ids.append(found)
            lengths.append(many)
        return np.concatenate(ids), np.concatenate(lengths)

    def _known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for distinct pieces, of which those met before are looked up among the remembered ones."""
        found = pc.index_in(pieces, self.pieces)
        place = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(place < 0)
        new = pieces.take(pa.array(fresh))
        spaced = pc.starts_with(new, " ").to_numpy(zero_copy_only=False)
        lined = pc.match_substring_regex(new, r"^\n[^\n]").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(x) for x in (spaced, lined, ~spaced & ~lined)])
        new = new.take(pa.array(order))
        lines, rest = int(spaced.sum()), int((spaced | lined).sum())
        parts = [
            (self.ids, self.lengths),
            self._tokenized(new.slice(0, lines)),
            self._tokenized(new.slice(lines, rest - lines)),
            self._each(new.slice(rest).to_pylist()),
        ]
        ids, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        begins = np.cumsum(lengths) - lengths
        self.used[place[place >= 0]] = True
        place[fresh[order]] = len(self.pieces) + np.arange(len(new))
        short = pc.less_equal(pc.utf8_length(new), LONGEST).to_numpy(zero_copy_only=False)
        keep = np.append(np.ones(len(self.pieces), bool), short)
        used = np.append(self.used, np.ones(len(new), bool))
        if keep.sum() > REMEMBERED:
            keep &= used
            used = np.zeros(len(used), bool)
        held = np.flatnonzero(keep)
        self.pieces = pa.concat_arrays([self.pieces, new]).take(pa.array(held))
        self.ids, self.lengths, self.used = ids[spread(begins[held], lengths[held])], lengths[held], used[held]
        return ids[spread(begins[place], lengths[place])], lengths[place]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for distinct pieces without spaces or NUL, a space before each."""
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        cut = pieces
        if self.finer:
            cut = pc.replace_substring_regex(pc.replace_substring(cut, "\n", "\0\n"), _WORD_END, r"\1" "\0" r"\2")
            cut = pc.if_else(pc.match_substring_regex(pieces, _BLANKS), pieces, cut)
        parts = pc.split_pattern(pc.binary_join_element_wise("", cut, " "), "\0")
        inner = parts.flatten().dictionary_encode()
        ids, lengths = self._known(inner.dictionary)
        codes = inner.indices.to_numpy()
        begins, each = (np.cumsum(lengths) - lengths)[codes], lengths[codes]
        after = np.append(0, np.cumsum(each))
        ends = np.cumsum(parts.value_lengths().to_numpy().astype(np.int64))
        return ids[spread(begins, each)], np.diff(after[np.append(0, ends)])

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, ``end_id`` after each, and where each text's begin."""
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain, strange = np.flatnonzero(~odd), np.flatnonzero(odd)
        cut = pc.split_pattern(texts.take(pa.array(plain)), " ")
        if len(strange):
            other = [self._cut(t) for t in texts.take(pa.array(strange)).to_pylist()]
            cut = pa.concat_arrays([cut, pa.array(other, cut.type)])
            cut = cut.take(pa.array(np.argsort(np.concatenate([plain, strange]))))
        words = cut.flatten().dictionary_encode()
        distinct, codes = words.dictionary, words.indices.to_numpy().astype(np.int64)
        ends = np.cumsum(cut.value_lengths().to_numpy().astype(np.int64))
        first = np.append(0, ends[:-1])
        # The table of pieces: simple ones, then others, the texts' first pieces without a space, and the end.
        other = pc.or_(pc.match_substring(distinct, " "), pc.equal(distinct, ""))
        other = pc.or_(other, pc.match_substring(distinct, "\0"))
        for token in self.special:
            other = pc.or_(other, pc.match_substring(distinct, token))
        other = other.to_numpy(zero_copy_only=False)
        place = np.empty(len(distinct), np.int64)
        place[~other], place[other] = np.arange((~other).sum()), (~other).sum() + np.arange(other.sum())
        codes = place[codes]
        heads = cut.flatten().take(pa.array(first)).to_pylist()
        codes[first] = len(distinct) + np.arange(len(heads))
        codes = np.insert(codes, ends, len(distinct) + len(heads))
        parts = [
            self._pieces(distinct.filter(pa.array(~other))),
            self._each([f" {p}" for p in distinct.filter(pa.array(other)).to_pylist()] + heads),
            (np.array([end_id], np.int32), np.ones(1, np.int64)),
        ]
        ids, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        begins, each = (np.cumsum(lengths) - lengths)[codes], lengths[codes]
        after = np.append(0, np.cumsum(each))
        return ids[spread(begins, each)], np.append(0, after[ends + np.arange(1, len(ends) + 1)])

    @staticmethod
    def _cut(text: str) -> list[str]:
        """The text's pieces, the spaces between them left out."""
        pieces = text.split(" ")
        joined = [pieces[0]]
        for p in pieces[1:]:
            last = joined[-1]
            if last and p and not last[-1].isspace() and not p[0].isspace():
                joined.append(p)
            else:
                joined[-1] = f"{last} {p}"
        return joined


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 0,
    stripe_bytes: int = 16 << 20,
    index_rows: int = 1000,
) -> None:
    """Encode every text of ``docs`` (``doc_id, text``) and write the ids, ``end_id`` after each.

    Null and empty texts hold the end id only.  Documents lie in ascending id
    order, null first; equal ids by their text, and equal rows in any order.
    ``seq`` counts the documents of a file.  Other columns are ignored, and an
    empty table gives no documents.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def run(batches):
        encoder, seq = _encoder(tokenizer), 0
        for batch in batches:
            for part in slices(batch, 1, limit=BYTES, texts=TEXTS):
                ids, offsets = encoder.encode(part.column("text"), end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(seq, seq + part.num_rows)),
                        part.column("doc_id"),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                    ],
                    names=["seq", "doc_id", "n_tokens", "ids"],
                )
                seq += part.num_rows

    (
        ranged.mapInArrow(run, FILE)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(index_rows))
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` and the place ``file, seq`` of every document."""
    name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    return spark.read.schema(FILE).orc(folder).select("*", name.alias("file"))


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The documents with the given ids; stripes and row groups without them are skipped."""
    return read_tokens(spark, folder).filter(F.col("doc_id").isin(doc_ids))


def checksums(tokens: DataFrame) -> DataFrame:
    """``file, seq, doc_id, n_tokens, ids_crc32``: CRC-32 over the ids as little-endian 32-bit numbers."""

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy().astype("<u4", copy=False)
            at = ids.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            counts = pa.array(np.diff(at).astype(np.int64))
            columns = [batch.column("file"), batch.column("seq"), batch.column("doc_id"), counts]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())], names=["file", "seq", "doc_id", "n_tokens", "ids_crc32"]
            )

    schema = "file string, seq long, doc_id long, n_tokens long, ids_crc32 long"
    return tokens.select("file", "seq", "doc_id", "ids").mapInArrow(run, schema)


def positions(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``file, seq, n_tokens``) and ``start``: the ids of all documents before each.

    Sums run inside each file; files take the totals of those before them, from
    one row per file.
    """
    per_file = read_tokens(spark, folder).groupBy("file").agg(F.sum("n_tokens").alias("total"))
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    before = per_file.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("file").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(before, "file")
        .withColumn("start", F.col("before") + F.col("inside"))
    )


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{work_folder(spark)}/tokens"
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    placed = positions(spark, folder, checksums(read_tokens(spark, folder)))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")
