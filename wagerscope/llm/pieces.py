"""SentencePiece encoding, decoding and counting, each distinct word of a slice segmented once.

A task collects the distinct marked words of a slice of texts, sorts them (a trie)
and computes forward values only for what a word does not share with the word
before it (``lattice``).  Unigram models take the best-scoring
segmentation; byte-pair models take the merges' own, found from forward values of
another kind, since the best total score would not be what such a model encodes.
Nothing is shuffled, and a worker remembers no words, only verdicts on pairs of
pieces in a table of fixed size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerscope.llm.common import stored, table
from wagerscope.llm.lattice import Lexicon, Segmenter

#: Texts that are segmented together, and the bytes at which fewer are taken.
TEXTS, BYTES = 1024, 500_000
MODEL = "piece_bpe_32k.model"


@lru_cache(maxsize=2)
def _lexicon(path: str) -> Lexicon:
    with open(path, "rb") as file:
        return Lexicon(file.read())


@lru_cache(maxsize=2)
def _segmenter(path: str) -> Segmenter:
    return Segmenter(_lexicon(path))


@lru_cache(maxsize=2)
def _spellings(path: str) -> pa.Array:
    return pa.array(_lexicon(path).spellings, pa.binary())


def slices(
    batch: pa.RecordBatch, column: int, each: int = 1, limit: int | None = None, texts: int = TEXTS
) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that long values of ``column`` come in small numbers; ``each`` is their unit in bytes."""
    lengths = pc.fill_null((pc.binary_length if each == 1 else pc.list_value_length)(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)) * each
    first = 0
    while first < batch.num_rows:
        most = (ends[first - 1] if first else 0) + (limit or BYTES)
        last = min(max(int(np.searchsorted(ends, most, "right")), first + 1), first + texts)
        yield batch.slice(first, last - first)
        first = last


def _fresh(docs: DataFrame, wanted: str) -> str:
    """``wanted``, or that name with underscores if the table has such a column."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def encoded(docs: DataFrame, model: str, out: str = "ids", keep_text: bool = True) -> DataFrame:
    """``docs`` and ``out``, the piece ids of each whole ``text``, without control pieces.

    Without ``keep_text`` the texts are left out.  Null and empty texts have no ids.  Rows are encoded one by one: ids, ties,
    repeated rows and other columns make no difference.  If a column is called
    ``out`` already, underscores are appended.  An empty table gives no rows.
    """
    out = _fresh(docs, out)
    at = docs.columns.index("text")
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    fields = [docs.schema.fields[i] for i in kept]
    schema = T.StructType([*fields, T.StructField(out, T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        segmenter = _segmenter(model)
        for batch in batches:
            for part in slices(batch, at):
                ids, offsets = segmenter.ids(part.column(at))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                columns = [*[part.column(i) for i in kept], lists]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                del ids, offsets, lists, columns
                pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def _spelled(lists: pa.ListArray, lexicon: Lexicon, spellings: pa.Array) -> pa.Array:
    """The texts of the ids in ``lists`` (null: null): their bytes end to end, cut where the lists are."""
    parts = spellings.take(lists.flatten())
    if parts.null_count:
        raise ValueError("an id is null")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    places = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.frombuffer(parts.buffers()[1], np.int32)[places + parts.offset] if len(parts) else np.zeros(len(places))
    offsets = pa.array(ends, pa.int32()).buffers()[1]
    null = lists.is_null()
    whole = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, offsets, parts.buffers()[2]])
    try:
        texts = whole.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8 become replacement characters
        texts = pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())
    if lexicon.dummy_prefix:
        texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
    return pc.if_else(null, pa.scalar(None, pa.string()), texts)


def decoded(tokens: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` and ``out``, the text that each row's ``ids`` spell (null: null).

    Control pieces spell nothing, byte pieces are joined before they are read as
    UTF-8, and the space that encoding put in front is taken off.
    """
    out = _fresh(tokens, out)
    at = tokens.columns.index(ids)
    schema = T.StructType([*tokens.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        lexicon, spellings = _lexicon(model), _spellings(model)
        for batch in batches:
            for part in slices(batch, at, 4):
                texts = _spelled(part.column(at), lexicon, spellings)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    return tokens.mapInArrow(run, schema)


def counted(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_words, n_tokens``: marked words and pieces of each whole text.

    Only counts are kept per word, never its pieces.  Null and empty texts count
    0.  Repeated rows are counted each; other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select("doc_id", "text")
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches):
        segmenter = _segmenter(model)
        for batch in batches:
            for part in slices(batch, 1):
                columns = [pa.array(x, pa.int64()) for x in segmenter.counts(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def _crc32(tokens: DataFrame) -> DataFrame:
    """``tokens`` (``doc_id, ids, text_sha256, decoded``) as the digests of the query."""

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            at, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            columns = [
                batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64()),
                batch.column("decoded_sha256"), batch.column("same"),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "same"]
    digests = tokens.select("doc_id", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "text_sha256")
    rows = digests.withColumn("same", F.unhex("decoded_sha256") == F.col("text_sha256")).drop("text_sha256")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, same boolean")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return counted(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the ids, decode them from there; digests and whether the text came back."""
    import public_tokenizers

    model = public_tokenizers.path(MODEL)
    whole = F.translate(F.coalesce("text", F.lit("")), "▁", " ")  # what decoding gives back
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.unhex(F.sha2(whole, 256)).alias("text_sha256"))
    return _crc32(decoded(stored(encoded(docs, model, keep_text=False)), model))
