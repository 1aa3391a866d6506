"""Periodic runs against a plain search over every period and start."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wagerscope.llm import periodic

SF = "/root/testdata/sf0.01"


def brute_runs(w, min_length=24):
    """Every maximal stretch of agreeing words for every period, kept with its smallest period."""
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        k = 0
        while k < n - q:
            if w[k] != w[k + q]:
                k += 1
                continue
            s = k
            while k < n - q and w[k] == w[k + q]:
                k += 1
            if k + q - s >= max(min_length, 3 * q) and (s, k + q) not in found:
                found[(s, k + q)] = q
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(w)
    drop = set()
    for s, length, p in found:
        drop.update(range(s + p, s + length))
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{l},{p}\n" for s, l, p in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_grammar_lce_matches_plain():
    rng = random.Random(3)
    for trial in range(60):
        alphabet = rng.choice([1, 2, 3, 5, 50])
        seq = np.array([rng.randrange(alphabet) for _ in range(rng.randrange(1, 400))])
        if trial % 3 == 0:
            seq = np.tile(seq[:7], 60)[: len(seq) + 50]
        g = periodic.Grammar(seq)
        for _ in range(50):
            i, j = rng.randrange(len(seq)), rng.randrange(len(seq))
            plain = 0
            while i + plain < len(seq) and j + plain < len(seq) and seq[i + plain] == seq[j + plain]:
                plain += 1
            assert g.lce(i, j) == plain


def test_runs_match_plain_search():
    rng = random.Random(5)
    for trial in range(80):
        k = rng.choice([1, 2, 3, 8])
        words = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(0, 160))]
        if trial % 2:
            p = rng.randrange(1, 12)
            at = rng.randrange(0, max(1, len(words)))
            words[at:] = [words[at + (i % p)] if at + (i % p) < len(words) else "z" for i in range(len(words) - at)]
        ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.zeros(0, np.int64)
        assert periodic.runs(np.asarray(ids, np.int64)) == brute_runs(words)


def test_awkward_rows(spark):
    texts = [None, "", " \t ", "a", "a " * 100, "x y " * 40 + "end", "naïve 😀 " * 30, ("abc " * 5000),
             " ".join(f"t{i}" for i in range(500)), "A a " * 20]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "q r " * 30), (3, "a " * 100)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_runs int, words string")
    got = sorted((tuple(r) for r in periodic.periodic_runs(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted((brute(d, t) for d, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == want


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_documents_against_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [(r.doc_id, r.text) for r in docs if len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) <= 2000]
    got = {r.doc_id: tuple(r) for r in periodic.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, t in short:
        assert got[d] == brute(d, t)
    assert any(got[d][1] for d, _ in short)
