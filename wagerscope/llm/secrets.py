"""Secret scanning with multipart credential linking, in DataFrame expressions only.

Strong kinds are reported as they are.  Weak kinds (identifiers, keys, endpoints)
are candidates: an identifier is reported if a secret lies within ``scope`` code
points of it, a key if an identifier does, an endpoint if both do.  Parts are
summarised by (document, cell of ``scope`` code points), and candidates meet the
cells around them in an equality join with a range condition, so no document's
parts are paired with each other or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerscope.llm.common import let, row_keys, stored, table, whole

# The strong kinds of the contract, in its order.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so the length can be asked for at once
# Weak kinds.
IDENTIFIER = r"[A-Z][A-Z0-9]{15,}"
KEY = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = (
    r"(?:https?|wss?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?)://[^\x20\x09-\x0D\"'<>]+"
)
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
SPAN = "array<struct<kind:int,start:int,end:int>>"
#: Steps of a prefix scan that are appended one by one; longer arrays are scanned in blocks.
BLOCK = 256


def _scan(values: Column, start: Column, combine: Callable) -> Column:
    """For each of a few values, what ``combine`` makes of ``start`` and the values before it."""
    first = F.struct(start.alias("now"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        return F.struct(combine(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out"))

    return F.aggregate(values, first, step, lambda a: a["out"])


def prefix(values: Column, combine: Callable) -> Column:
    """``_scan`` from 0 over any number of int values, by blocks."""
    zero = F.lit(0)

    def blocks(v: Column) -> Column:
        cuts = F.sequence(zero, F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.transform(cuts, lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))

    def offsets(bs: Column) -> Column:
        totals = F.transform(bs, lambda b: F.aggregate(b, zero, combine))
        return F.flatten(F.zip_with(bs, _scan(totals, zero, combine), lambda b, o: _scan(b, o, combine)))

    whole = let(values, lambda v: let(blocks(v), offsets))
    return F.when(F.size(values) > 0, whole).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, kind: int, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` that ``keep`` accepts, in code points.

    The pieces between matches and the matches themselves give the places.  Texts
    without a match are scanned once.
    """
    none = F.array().cast(SPAN)

    def place(gaps: Column) -> Column:
        def spans(found: Column) -> Column:
            steps = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))

            def span(m: Column, i: Column, before: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(gaps, i))
                fits = F.lit(True) if keep is None else keep(m)
                return F.struct(
                    F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), fits.alias("fits")
                )

            return let(prefix(steps, lambda a, x: a + x), lambda before: F.transform(found, lambda m, i: span(m, i, before)))

        every = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
        kept = F.transform(
            F.filter(every, lambda s: s["fits"]),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )
        return F.when(F.size(gaps) > 1, kept).otherwise(none)

    return let(F.split(text, pattern, -1), place)


def _scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, the content key of (doc_id, text), strong and weak spans; stored."""
    k1, k2 = row_keys(["doc_id", "text"])
    text = F.coalesce(F.col("text"), F.lit(""))
    digits = lambda m: m.rlike("[0-9].*[0-9]") & ~m.startswith("AKIA")
    mixed = lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    strong = F.concat(
        _spans(text, 0, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
        _spans(text, 1, ACCESS, lambda m: F.length(m) >= 20),
        _spans(text, 2, HEX),
    )
    weak = F.concat(
        _spans(text, 3, IDENTIFIER, digits), _spans(text, 4, KEY, mixed), _spans(text, 5, ENDPOINT)
    )
    return stored(
        docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), strong.alias("strong"), weak.alias("weak"))
    )


def _cells(start: Column, end: Column, scope: int, around: int) -> Column:
    at = lambda c: F.floor(c / scope).cast("int")
    return F.explode(F.sequence(at(start) - around, at(end) + around)).alias("cell")


def linked(scanned: DataFrame, scope: int) -> DataFrame:
    """``k1, k2, linked``: the weak spans of each document whose complements lie within ``scope``."""
    doc = ["k1", "k2"]
    parts = (
        scanned.filter(F.size("weak") > 0)
        .select(*doc, F.explode(F.concat("strong", "weak")).alias("s"))
        .select(*doc, "s.kind", "s.start", "s.end")
        .distinct()
    )
    is_id, is_secret = F.col("kind").isin(1, 3), F.col("kind").isin(0, 2, 4)
    cells = (
        parts.filter(is_id | is_secret)
        .select(*doc, "kind", "start", "end", _cells(F.col("start"), F.col("end"), scope, 0))
        .groupBy(*doc, "cell")
        .agg(
            F.min(F.when(is_id, F.col("start"))).alias("id_start"),
            F.max(F.when(is_id, F.col("end"))).alias("id_end"),
            F.min(F.when(is_secret, F.col("start"))).alias("secret_start"),
            F.max(F.when(is_secret, F.col("end"))).alias("secret_end"),
        )
    )
    weak = parts.filter(F.col("kind") >= 3).select(
        *doc, "kind", "start", "end", _cells(F.col("start"), F.col("end"), scope, 1)
    )
    def near(part: str) -> Column:
        close = (F.col(f"{part}_end") >= F.col("start") - scope) & (F.col(f"{part}_start") <= F.col("end") + scope)
        return F.coalesce(F.bool_or(close), F.lit(False)).alias(f"has_{part}")

    met = weak.join(cells, [*doc, "cell"]).groupBy(*doc, "kind", "start", "end").agg(near("id"), near("secret"))
    complete = F.when(F.col("kind") == 3, F.col("has_secret")).when(F.col("kind") == 4, F.col("has_id")).otherwise(
        F.col("has_id") & F.col("has_secret")
    )
    return (
        met.filter(complete)
        .groupBy(*doc)
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    )


def _sorted(spans: Column) -> Column:
    by_place = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.sort_array(by_place)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(_sorted(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    )


def _joined(docs: DataFrame, scope: int) -> DataFrame:
    scanned = _scanned(docs)
    weak = F.coalesce("linked", F.array().cast(SPAN))
    return scanned.join(linked(scanned, scope), ["k1", "k2"], "left").withColumn("spans", F.concat("strong", weak))


def secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then
    kind.  ``base_sha256`` covers the strong kinds only; ``spans`` adds linked weak
    ones.  Null and empty texts have none.  Repeated rows get the same answer each;
    other columns are ignored; an empty table gives no rows.
    """
    count = lambda k: F.size(F.filter("strong", lambda s: s["kind"] == k)).cast("long")
    return _joined(docs, scope).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.col("strong")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, scope: int = 200, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping or touching spans get one.

    ``n_chars``, where the table has it, follows the text.  Rows stay as many.
    """
    found = _joined(docs, scope).filter(F.size("spans") > 0).select("k1", "k2", "spans").dropDuplicates(["k1", "k2"])
    k1, k2 = row_keys(["doc_id", "text"])
    text, n_chars = F.col("_row")["text"], "n_chars"

    def rebuilt(s: Column) -> Column:
        def pieces(upto: Column) -> Column:
            before = F.transform(
                s,
                lambda x, i: F.when(
                    (x["start"] > F.get(upto, i)) | (i == 0),
                    F.concat(F.substring(text, F.get(upto, i) + 1, x["start"] - F.get(upto, i)), F.lit(mark)),
                ).otherwise(F.lit("")),
            )
            last = F.greatest(F.element_at(upto, -1), F.element_at(s, -1)["end"])
            return F.concat(F.concat_ws("", before), F.substring(text, last + 1, F.length(text)))

        return let(prefix(F.transform(s, lambda x: x["end"]), lambda a, x: F.greatest(a, x)), pieces)

    keyed = docs.select(whole(docs.columns), k1.alias("_k1"), k2.alias("_k2"))
    marked = found.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), _sorted(F.col("spans")).alias("_spans"))
    joined = keyed.join(marked, ["_k1", "_k2"], "left")
    new = F.when(F.col("_spans").isNull(), text).otherwise(let(F.col("_spans"), rebuilt))
    out = joined.select("_row", "_spans", new.alias("_text"))
    columns = {c: F.col("_row")[c] for c in docs.columns} | {"text": F.col("_text")}
    if n_chars in columns:
        kind = docs.schema[n_chars].dataType
        columns[n_chars] = F.when(F.col("_spans").isNull(), columns[n_chars]).otherwise(F.length("_text").cast(kind))
    return out.select(*[c.alias(name) for name, c in columns.items()])


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))
