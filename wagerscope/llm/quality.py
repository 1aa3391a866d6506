"""Quality rules as weak supervision, in DataFrame expressions only.

Each rule votes good (1), votes bad (-1) or abstains (0).  Documents are folded to
their vote patterns, at most 3 to the power of the number of rules, and
expectation-maximisation over the pattern counts estimates how often each rule is
right on good and on bad documents.  The posterior probability of being good then
decides, instead of requiring that every rule passes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerscope.llm.common import SPACE, let, stored, table, whole

STATS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_digits n_ends n_bars"
).split()


def _repeat_words(words: Column, n: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the same text.

    Windows are compared by 64-bit hashes.  Only texts that repeat one sort
    their windows, so the work stays within n log n of the text's words.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def twice(s: Column) -> Column:
            def same(x: Column, k: Column) -> Column:
                before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
                return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(
                at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window)))
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        repeated = let(F.sort_array(pairs), lambda s: let(twice(s), length))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), repeated).otherwise(F.lit(0).cast("long"))

    def hashed(w: Column) -> Column:
        last = F.size(w) - window
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])
        )

    counted = let(words, lambda w: let(hashed(w), covered))
    return F.when(n >= window, counted).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, window: int = 5) -> DataFrame:
    """``docs`` with a struct ``stats`` of whole-text counts (see ``STATS``); null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = " \t\n\x0b\f\r"
    trimmed = F.btrim(text, F.lit(blank))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(blank)) != "")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    def stats(w: Column, ls: Column) -> Column:
        n = F.size(w).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
            count("[#*$%&|<>]").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeat_words(w, n, window).alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines"),
            count("[A-ZÀ-ÖØ-Þ]").alias("n_upper"),
            count("[0-9]").alias("n_digits"),
            count("[.!?。](?=[\"')\\]]*\\s|\\Z)").alias("n_ends"),
            F.size(F.filter(w, lambda x: x.isin("|", "•", "-", "*", "–"))).cast("long").alias("n_bars"),
        )

    return docs.withColumn("stats", let(words, lambda w: let(lines, lambda ls: stats(w, ls))))


def base_failed(s: Column) -> Column:
    """Fewer than 10 words, or over a fifth of the words in repeated windows."""
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(s: Column) -> dict[str, Column]:
    """The rules.  A rule abstains between its two limits."""
    words, chars = s["n_words"], F.greatest(s["word_chars"], F.lit(1))
    per_word = lambda n: s[n] / F.greatest(words, F.lit(1))
    mean = s["word_chars"] / F.greatest(words, F.lit(1))
    dup = s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1))
    return {
        "length": _vote(words < 20, words >= 60),
        "word_length": _vote((mean < 2.5) | (mean > 11), (mean >= 3.5) & (mean <= 8)),
        "symbols": _vote(per_word("n_symbols") > 0.1, per_word("n_symbols") < 0.01),
        "repeated_lines": _vote(dup > 0.3, dup < 0.05),
        "repeated_words": _vote(per_word("n_repeat_words") > 0.15, per_word("n_repeat_words") < 0.03),
        "capitals": _vote(s["n_upper"] / chars > 0.3, s["n_upper"] / chars < 0.1),
        "digits": _vote(s["n_digits"] / chars > 0.2, s["n_digits"] / chars < 0.05),
        "sentences": _vote(per_word("n_ends") < 0.01, (per_word("n_ends") > 0.02) & (per_word("n_ends") < 0.3)),
        "separators": _vote(per_word("n_bars") > 0.1, per_word("n_bars") < 0.01),
    }


@dataclass(frozen=True)
class LabelModel:
    """``prior`` of being good; per rule, how often its votes are right on good and on bad documents."""

    rules: tuple[str, ...]
    prior: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def logit(self, vote: Mapping[str, object]):
        """Log-odds of good, for votes given as numbers or as columns."""
        total = math.log(self.prior / (1 - self.prior))
        for rule, a, b in zip(self.rules, self.right_on_good, self.right_on_bad, strict=True):
            up, down, v = math.log(a / (1 - b)), math.log((1 - a) / b), vote[rule]
            if isinstance(v, Column):
                total = total + F.when(v == 1, F.lit(up)).when(v == -1, F.lit(down)).otherwise(F.lit(0.0))
            else:
                total = total + (up if v == 1 else down if v == -1 else 0.0)
        return total


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: tuple[str, ...], rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over (votes, count) patterns; abstentions say nothing.

    Starts from rules that are right nine times out of ten on good documents and
    four times out of ten on bad ones, since a bad document usually fails few
    rules, and keeps those beliefs as pseudo-counts of 1 % of the documents.
    Without documents these starting values are returned.
    """
    size = sum(n for _, n in patterns)
    weight = max(1.0, 0.01 * size)
    start = LabelModel(rules, 0.8, (0.9,) * len(rules), (0.4,) * len(rules))
    model = start
    for _ in range(rounds if size else 0):
        good = 0.0
        counts = [[weight * a, weight * (1 - a), weight * b, weight * (1 - b)]
                  for a, b in zip(start.right_on_good, start.right_on_bad, strict=True)]
        for pattern, n in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.logit(dict(zip(rules, pattern, strict=True)))))))
            good += p * n
            for c, v in zip(counts, pattern, strict=True):
                if v == 1:
                    c[0] += p * n
                    c[3] += (1 - p) * n
                elif v == -1:
                    c[1] += p * n
                    c[2] += (1 - p) * n
        new = LabelModel(
            rules,
            (good + weight * start.prior) / (size + weight),
            tuple(c[0] / (c[0] + c[1]) for c in counts),
            tuple(c[2] / (c[2] + c[3]) for c in counts),
        )
        moved = max(abs(x - y) for x, y in zip((new.prior, *new.right_on_good, *new.right_on_bad),
                                               (model.prior, *model.right_on_good, *model.right_on_bad), strict=True))
        model = new
        if moved < 1e-9:
            break
    return model


def label_model(scored: DataFrame) -> LabelModel:
    """The model of all rows of ``scored`` (with ``stats``); only vote patterns reach the driver."""
    rules = tuple(votes(F.col("stats")))
    patterns = scored.select(*[v.alias(r) for r, v in votes(F.col("stats")).items()]).groupBy(*rules).count()
    rows = sorted((tuple(r[k] for k in rules), r["count"]) for r in patterns.collect())
    return fit(rows, rules)


def verdict(s: Column, model: LabelModel, threshold: float = 0.5) -> tuple[Column, Column]:
    """``posterior`` and ``kept``: no base failure, and a posterior of ``threshold`` or more."""
    posterior = 1 / (1 + F.exp(-model.logit(votes(s))))
    return posterior, ~base_failed(s) & (posterior >= threshold)


def rated(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed``, ``posterior``, ``kept``.

    Null and blank texts have no words and fail.  Rows are judged one by one, so
    null ids, repeated rows and other columns make no difference; an empty table
    gives no rows.
    """
    scored = stored(statistics(docs.select("doc_id", "text")).select("doc_id", "stats"))
    s = F.col("stats")
    posterior, kept = verdict(s, label_model(scored), threshold)
    return scored.select(
        "doc_id", *[s[n].alias(n) for n in STATS],
        base_failed(s).alias("base_failed"), posterior.alias("posterior"), kept.alias("kept"),
    )


def good_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    scored = stored(statistics(docs.select(whole(docs.columns), "text")).select("_row", "stats"))
    kept = verdict(F.col("stats"), label_model(scored), threshold)[1]
    return scored.filter(kept).select("_row.*")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )
