"""MinHash near-duplicates against all pairs of exact Jaccard similarities."""

import re

import numpy as np
import pytest

from wagerscope.llm import minhash

SF = "/root/testdata/sf0.01"


def shingle_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return set()
    if len(words) < k:
        return {" ".join(words)}
    return {" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows):
    """doc_id -> (n_shingles, component_id) by all pairs and union-find over row numbers."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = sets[i], sets[j]
            if a and b:
                inter = len(a & b)
                if 100 * inter >= 85 * (len(a) + len(b) - inter):
                    parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = d if low.get(r) is None else min(low[r], d)
    return [(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)]


def test_signature_depends_on_set_only():
    values = np.array([5, -3, 99, 5 << 40, 7, -3 << 33], np.int64)
    one = minhash.signatures(values, np.array([0, 6]), 120)
    two = minhash.signatures(values[::-1].copy(), np.array([0, 6]), 120)
    assert (one == two).all()
    single = minhash.signatures(values[:1], np.array([0, 1]), 120)
    assert (single == 5).all()  # every bin densified from the one filled bin
    h, off = minhash.shingle_hashes(np.array([1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5, 9, 9], np.int64), np.array([0, 6, 6, 11, 13]), 5)
    assert list(np.diff(off)) == [2, 0, 1, 1]


def test_awkward_rows_against_all_pairs(spark):
    base = " ".join(f"w{i}" for i in range(300))
    near = base.replace("w150", "X150")  # one word changed: 5 shingles differ of 296
    far = base.replace("w10 ", "Y ").replace("w100", "Z").replace("w200", "Q").replace("w250", "R")
    rows = [
        (1, base), (2, near), (3, far), (4, None), (5, ""), (6, " \t\n"), (7, "a b"), (8, "A B"),
        (9, "a b c d e f"), (10, base.upper()), (None, base), (11, "x" * 50000), (12, ("word " * 20000) + "end"),
        (1, base), (13, "only one"), (14, "word " * 3000), (15, base + " tail words here now"),
    ]
    df = spark.createDataFrame(
        [(d, t, "en", m) for d, t in rows for m in [{"k": 1}]],
        "doc_id long, text string, lang string, kept map<string,int>")
    got = sorted(minhash.near_duplicates(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_shingles))
    want = sorted(brute(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == want
    for r in got:
        assert r.kept == (r.doc_id == r.component_id)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_documents_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.doc_id, r.n_shingles, r.component_id) for r in minhash.op13_minhash(spark, sf).collect()}
    want = {d: (d, n, c) for d, n, c in brute(rows)}
    assert got == want
