import re

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_packing import check
from tests.llm.test_secret_scan import brute_base
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_substring_dedup import brute


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after every stage over sf0.001 with planted rows."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    passage = " ".join(f"w{k}x" for k in range(70))
    extra = [(900001, None, None, None, 0), (900002, "12 %% 34", "en", "s", 8), (900003, "alone " + passage, None, None, 5),
             (900004, passage + " the tail of it", "en", None, 5), (900005, passage, "en", "s", 5), (900005, passage, "en", "s", 5),
             (None, "a text without any id at all", "en", "s", 3), (900006, 'the password = "hunter2hunter2" is here', "en", "s", 3), (900007, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs.collect()]
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, sf), "t")
        if name != C.STAGES[-1][0]:
            assert tuple(docs.columns) == C.COLUMNS
        out.append(docs.collect())
    return out


def test_language_stage_rejects_only_texts_without_letters(stages):
    want = [r for r in stages[0] if r.text and any(c.isalpha() for c in r.text)]
    assert sorted(map(str, stages[1])) == sorted(map(str, want))


def test_near_duplicates_keep_one_of_each_group(stages):
    fps = {k: brute_fp(r.text) for k, r in enumerate(stages[1])}
    comp = brute_components(fps)
    want = set()
    for root in set(comp.values()):
        ids = [stages[1][k].doc_id for k in comp if comp[k] == root]
        want.add(min((i for i in ids if i is not None), default=None))
    assert sorted(str(r.doc_id) for r in stages[2]) == sorted(map(str, want))
    assert set(map(str, stages[2])) <= set(map(str, stages[1]))


def test_repeated_passages_go(stages):
    rows = [(r.doc_id, r.text) for r in stages[2]]
    gone = {i: n for i, _, n, _ in brute(rows)}
    left = {r.doc_id: r for r in stages[3]}
    for r in stages[2]:
        n = len(r.text.split())
        if gone[r.doc_id] == n:
            assert r.doc_id not in left
        else:
            now = left[r.doc_id]
            assert len(now.text.encode().split()) == len(r.text.encode().split()) - gone[r.doc_id]
            assert gone[r.doc_id] or now == r
            assert not gone[r.doc_id] or now.n_chars == len(now.text)
    assert 900004 in left and left[900004].text == "the tail of it"


def test_secrets_are_replaced(stages):
    before = {r.doc_id: r.text for r in stages[3]}
    assert sorted(map(str, before)) == sorted(str(r.doc_id) for r in stages[4])
    for r in stages[4]:
        assert not brute_base(before[r.doc_id]) or "[secret]" in r.text
        assert not brute_base(re.sub(r"\[secret\]", "", r.text))
        assert r.text == before[r.doc_id] or r.n_chars == len(r.text)
    assert any(r.doc_id == 900006 and r.text == "the [secret]\" is here" for r in stages[4])


def test_everything_left_is_packed(stages):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    reference = lambda x: t.encode(x or "", add_special_tokens=False).ids + [0]
    check(stages[5], [(r.doc_id, r.text, r.source) for r in stages[4]], reference)
    assert all(len(p.ids) == 4 * p.length and np.frombuffer(p.ids, "<u4").max() < 50257 for p in stages[5])


def test_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_nulls_and_long_texts(spark, tmp_path):
    """Columns beside the five change nothing, whatever their names; a null in any column passes
    through; a text of two megabytes is packed whole."""
    rng = np.random.default_rng(6)
    words = [f"wort{k}" for k in range(5000)]
    text = lambda n: " ".join(words[k] for k in rng.integers(0, 5000, n))
    rows = [(k, text(60), [None, "en", "de"][k % 3], [None, "s", "t"][k % 3], None if k % 4 else 5) for k in range(40)]
    rows += [(100, text(250_000), "en", "s", 1), (101, None, None, None, None), (None, text(80), None, None, None), (102, "12 34", "en", "s", 5)]
    clash = ("rest", "rid", "fp", "spans", "starts", "kept", "base", "row", "words", "queue", "part", "component_id", "lang_pred")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    plain, wide = f"{tmp_path}/plain", f"{tmp_path}/wide"
    spark.createDataFrame(rows, schema).write.parquet(f"{plain}/documents.parquet")
    spark.createDataFrame([(*r, *clash) for r in rows], schema + "".join(f", {c} string" for c in clash)).write.parquet(f"{wide}/documents.parquet")
    got = {}
    for d in (plain, wide):
        out = C.run(spark, d).collect()
        got[d] = {}
        for r in sorted(out, key=lambda r: r.start):
            got[d].setdefault(r.doc_id, []).append(bytes(r.ids))
    assert {i: b"".join(x) for i, x in got[plain].items()} == {i: b"".join(x) for i, x in got[wide].items()}
    assert set(got[plain]) == {r[0] for r in rows} - {101, 102}
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    kept = {r[0]: r[1] for r in rows}
    assert np.frombuffer(b"".join(got[plain][100]), "<u4").tolist() == t.encode(kept[100], add_special_tokens=False).ids + [0]


def test_substring_stage_sends_the_text_to_python_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*C.COLUMNS)
    plan = C.without_repeats(spark, docs, "")._jdf.queryExecution().analyzed().toString()
    sent = re.findall(r"struct\([^)]*\) AS rest", plan)
    assert sent and not any(re.search(r"\btext\b", x) for x in sent)


def test_a_worker_that_changes_operators_hands_its_memory_back(monkeypatch):
    from vitrine.llm import common

    done = []
    monkeypatch.setattr(common, "trim", lambda: done.append("trim"))
    monkeypatch.setattr(common, "_HELD", {})
    monkeypatch.setattr(common, "_OWNER", [])
    common.claim("one", lambda: done.append("release"))
    common.claim("one", lambda: done.append("never"))
    common.claim("other")
    common.claim("other")
    assert done == ["trim", "never", "trim"]
