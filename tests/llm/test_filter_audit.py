import random
from collections import Counter
from itertools import permutations

import duckdb

from vitrine.llm import filter_audit as M

DOCS = "doc_id long, text string, lang string, n_chars long, mask string, part string, n int, good string, step string"
LABELS = "doc_id long, quality int, toxic int, text string, good int"


def fails(text):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
    return "".join(x for x, bad in zip("ABCD", (
        len(words) < 100, 100 * len(set(words)) < 80 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), any(c in "#$%&*|" for c in text))) if bad)


def brute(docs, labels):
    """Rows (part, order, step, kept, removed, redundant, unique, good lost, toxic lost, shapley)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    lows = {}
    for i, t, _ in docs:
        if i is not None:
            lows[t or ""] = min(i, lows.get(t or "", i))
    failing = [(p or "", set(fails(t or "")) | ({"E"} if i is not None and i > lows[t or ""] else set()), i in good, i in toxic) for i, t, p in docs]
    rows, shares = [], Counter()
    for part in {p for p, *_ in failing}:
        own = [x[1:] for x in failing if x[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                redundant = sum(f in x[0] for x in own) - len(gone)
                left = [x for x in left if f not in x[0]]
                shares[part, f] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), redundant, sum(x[0] == {f} for x in own),
                             sum(x[1] for x in gone), sum(x[2] for x in gone)))
    return sorted((*r, shares[r[0], r[1][r[2] - 1]]) for r in rows)


def run(spark, docs, labels):
    d = spark.createDataFrame([(*x, 1, "x", "y", 3, "z", "w") for x in docs], DOCS)
    out = M.audit(M.document_masks(d, spark.createDataFrame([(*x, "t", 7) for x in labels], LABELS)))
    return sorted((r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in out.collect())


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(M.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    got = M.op11_filter_audit(spark, sf)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(cur.fetchall())


def test_brute_force_with_nulls_copies_and_clashing_columns(spark):
    rng = random.Random(5)
    long = " ".join(f"w{k}" for k in range(130))
    texts = [None, "", " \t\v\f\r\n", "a b", "A B C", long, long.upper(), long + " #", ("x " * 120), "ÀÉ É x", "tie$", "x" * 50_000, "y z " * 40_000]
    docs = [(rng.choice([None, 1, 2, 3, 7, *range(20, 60)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(300)]
    docs += [(5, long, "fr")] * 3 + [(5, None, "fr"), (None, long, "fr")]
    labels = [(rng.choice([None, 1, 2, 3, 20, 21, 22, 99]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_one_part_one_document(spark):
    got = run(spark, [(4, "ONE", "en")], [])
    assert len(got) == 600 and got == brute([(4, "ONE", "en")], [])


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == []


def test_many_parts_need_no_more_recursion(spark):
    docs = [(k, "A b" if k % 3 else "tie$", f"lang{k}") for k in range(400)]
    got = run(spark, docs, [(k, 1, 0) for k in range(0, 400, 2)])
    assert len(got) == 400 * 600 and got == brute(docs, [(k, 1, 0) for k in range(0, 400, 2)])
