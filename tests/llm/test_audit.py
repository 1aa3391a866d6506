"""The filter interaction audit against its DuckDB twin and a plain per-document count."""

import re
from itertools import permutations

import duckdb

from wagerscope.llm import audit

SF = "/root/testdata/sf0.01"
COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """All rows by walking every order over every document."""
    good = {d for d, q, t in labels if q == 1}
    toxic = {d for d, q, t in labels if t == 1}
    masks = []
    for d, lang, text in docs:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(ws) < 200,
            "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": re.search(r"[#$%&*|]", t) is not None,
            "E": d is not None and any(o is not None and o < d and (x or "") == t for o, _, x in docs),
        }
        masks.append((lang or "", fails, d in good, d in toxic))
    rows = {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        removed_by = {}
        for perm in permutations("ABCDE"):
            order = "".join(perm)
            for step, x in enumerate(perm, 1):
                earlier = perm[:step - 1]
                gone = [m for m in mine if m[1][x] and not any(m[1][e] for e in earlier)]
                rows[(part, order, step)] = [
                    sum(1 for m in mine if not any(m[1][e] for e in perm[:step])), len(gone),
                    sum(1 for m in mine if m[1][x] and any(m[1][e] for e in earlier)),
                    sum(1 for m in mine if m[1][x] and sum(m[1].values()) == 1),
                    sum(1 for m in gone if m[2]), sum(1 for m in gone if m[3]),
                ]
                removed_by[(x, order)] = len(gone)
        for (p, order, step), v in list(rows.items()):
            if p == part:
                v.append(sum(n for (x, _), n in removed_by.items() if x == order[step - 1]))
    return {k: tuple(v) for k, v in rows.items()}


def test_awkward_rows(spark):
    long_text = " ".join(f"w{i % 150}" for i in range(400))
    texts = [None, "", "A B C #", long_text, long_text, " ".join(f"u{i}" for i in range(300)), "UPPER CASE WORDS here",
             long_text + " |", "x " * 250, "naïve façade 😀 東京", long_text]
    docs = [(i if i != 9 else None, ["en", None, "de"][i % 3], t) for i, t in enumerate(texts)] + [(4, "en", long_text)]
    labels = [(3, 1, 0), (4, 1, 1), (4, 0, 0), (7, 0, 1), (99, 1, 1)]
    df = spark.createDataFrame([(d, lang, t, {"x": 1}, "clash") for d, lang, t in docs],
                               "doc_id long, lang string, text string, mask map<string,int>, part string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.interaction_report(audit.failure_masks(df, lab)).collect()}
    assert got == brute(docs, labels)
    assert len(got) == 3 * 600


def test_dictionary_and_shards(spark, tmp_path, monkeypatch):
    texts = ["b a b", "", " \t", "a c a a", "é 東 é", "b a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "_rid long, text string").coalesce(1)
    plans, stored = [], audit.stored
    monkeypatch.setattr(audit, "stored", lambda x, *a: plans.append(x._jdf.queryExecution().toString()) or stored(x, *a))
    words = {r.word: r.term for r in audit.dictionary(df, str(tmp_path)).collect()}
    assert set(words) == {w for t in texts for w in t.split()} and "SortAggregate" not in plans[0]
    got = {}
    for r in audit.csr_shards(audit.hashed_words(df)).collect():
        for i, rid in enumerate(r.rows):
            terms = r.indices[r.indptr[i]:r.indptr[i + 1]]
            assert terms == sorted(terms)
            got[rid] = dict(zip(terms, r.data[r.indptr[i]:r.indptr[i + 1]], strict=True))
    assert got == {i: {words[w]: t.split().count(w) for w in t.split()} for i, t in enumerate(texts)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert audit.interaction_report(audit.failure_masks(df, None)).count() == 0


def test_documents_against_sql(spark):
    got = sorted(tuple(r) for r in audit.op11_filter_audit(spark, SF).select(*COLS).collect())
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    want = sorted(tuple(r) for r in con.execute(f"SELECT {', '.join(COLS)} FROM ({audit.OP11_SQL})").fetchall())
    assert got == want
    assert len(got) % 600 == 0 and got
