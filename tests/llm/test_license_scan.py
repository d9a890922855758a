import random
import re

import duckdb

from vitrine.llm import license_scan as M

SCHEMA = "doc_id long, text string, rid string, words string, n_words int, t int, first int, label string, score string"
SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in SEPARATORS.split(low) if w]


def base(text):
    ws, out = words(text), []
    for label, phrase in M.PHRASES:
        p = phrase.split()
        out += [(k, label) for k in range(len(ws)) if ws[k:k + len(p)] == p]
    return len(ws), len(out), min(out)[0] if out else None, max(out)[0] if out else None, ",".join(sorted({x for _, x in out}))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "r", "w", 1, 2, 3, "l", "s") for i, t in rows], SCHEMA)


def digest(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "table", lambda *a: table(spark, rows))
    return [tuple(r) for r in M.op13_license_scan(spark, "").collect()]


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(M.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    key = lambda r: tuple((x is not None, x) for x in r)
    got = M.op13_license_scan(spark, sf)
    assert sorted(got.columns) == sorted(names)
    got = sorted((tuple(r) for r in got.select(*names).collect()), key=key)
    assert got == sorted(cur.fetchall(), key=key) and sum(r[2] for r in got) > 5


def test_base_places_equal_a_plain_scan(spark, monkeypatch):
    rng = random.Random(11)
    bits = ["mit", "MIT", "license", "License", "apache", "general", "public", "GENERAL", "é", "a", "1", "licenseé", "mitlicense"]
    seps = [" ", "\n", "-", "@", "\x00", "{", "~\t", "[", "`", "Z "]
    texts = [None, "", " ", "@@", "mit license", "MIT-LICENSE", "mit mit license license", "general public general public license license"]
    texts += ["".join(rng.choice(bits) + rng.choice(seps) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    rows = [(rng.choice([None, 1, 2, 3]), t) for t in texts] + [(7, "mit license")] * 4
    got = digest(spark, rows, monkeypatch)
    assert len(got) == len(rows)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((r[:6] for r in got), key=key) == sorted(((i, *base(t)) for i, t in rows), key=key)


def test_long_texts_are_whole(spark, monkeypatch):
    rng = random.Random(2)
    ws = [rng.choice(["mit", "license", "apache", "general", "public", "x"]) for _ in range(120_000)]
    one_word = "q" * 200_000 + " mit license"
    rows = [(1, " ".join(ws)), (2, one_word), (3, " " * 150_000 + "apache license")]
    got = {r[0]: r[1:6] for r in digest(spark, rows, monkeypatch)}
    assert got == {i: base(t) for i, t in rows}


def test_notices_with_edits_are_found_and_others_left_alone(spark, monkeypatch):
    rng = random.Random(4)
    filler = lambda n: " ".join(f"wort{rng.randrange(500)}" for _ in range(n))
    rows, want = [], {}
    for k, (label, text) in enumerate(M.NOTICES):
        ws = words(text)
        for edit in range(3):
            edited = list(ws)
            if len(ws) >= 20:  # one word dropped, one put in, one changed
                del edited[len(edited) // 3]
                edited.insert(2 * len(edited) // 3, "really")
                edited[len(edited) // 2 + edit] = "other"
            i = 100 * k + edit
            rows.append((i, filler(40) + " " + " ".join(edited) + " " + filler(30)))
            want[i] = label
    rows += [(10_000 + k, filler(200) + " the software of the license and the above copyright") for k in range(20)]
    got = {r[0]: r for r in digest(spark, rows, monkeypatch)}
    assert all(want[i] in got[i][6].split(",") and 0.5 <= got[i][7] <= 1 for i in want)
    assert all(got[i][6] == "" and got[i][7] == 0.0 for i in got if i >= 10_000)


def test_spans_carry_their_place(spark):
    notice = M.NOTICES[7][1]
    docs, found = M.license_scan(table(spark, [(1, "a b c " + notice + " d e " + notice), (2, "nothing")]))
    rows = sorted((r.start, r.stop, r.cover) for r in found.where("label = 'gpl' and not is_phrase").collect())
    n = len(words(notice))
    assert rows == [(3, 3 + n, 1.0), (5 + n, 5 + 2 * n, 1.0)]
    assert docs.count() == 2


def test_empty_table(spark, monkeypatch):
    assert digest(spark, [], monkeypatch) == []


def test_equal_hashes_do_not_make_a_match(spark, monkeypatch):
    real = M.Words.grams
    monkeypatch.setattr(M.Words, "grams", lambda self, k: (real(self, k)[0] * 0, real(self, k)[1]))
    notice = M.NOTICES[0][1]
    templates = M.template_words(M.PHRASES, ())
    hashed = M.Words([notice.encode()]).grams(2)[0]
    assert not hashed.any()
    found = M.matches(table(spark, [(1, "x y mit license z")]), templates).collect()
    assert [r for r in found if r.t >= 0] == [r for r in found if r.t == 0 and r.place == 2]
