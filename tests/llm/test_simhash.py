import numpy as np
import pytest
import xxhash

from vitrine.llm.simhash import HammingAnchors, fingerprint_links, op7_simhash, simhash_groups


def brute_fp(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def brute_components(fps, max_bits=2):
    """fps: {doc_id: fp}; smallest reachable id per doc."""
    ids = sorted(fps)
    a = np.array([fps[i] for i in ids], np.uint64)
    root = {}
    for k, i in enumerate(ids):
        if i in root:
            continue
        stack = [k]
        root[i] = i
        while stack:
            x = stack.pop()
            for y in np.flatnonzero(np.bitwise_count(a ^ a[x]) <= max_bits):
                if ids[y] not in root:
                    root[ids[y]] = i
                    stack.append(y)
    return root


def test_code_is_perfect():
    code = HammingAnchors(5, 3)
    assert code.patterns.shape == (32, 156)  # every pattern of weight <= 3, by syndrome
    fps = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)
    anchors = code.replicas(fps)
    assert not code.syndrome(anchors.ravel()).any()
    low = fps & code.mask
    assert (np.bitwise_count(anchors ^ low[:, None]) <= 3).all()
    assert (np.bitwise_count(anchors[:, 0] ^ low) <= 1).all()


def test_links_connect_every_close_pair(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for x in base[:20].tolist():  # chains and dense clusters
        y = x
        for _ in range(25):
            for _ in range(rng.integers(1, 4)):
                y ^= 1 << int(rng.integers(0, 64))
            fps.add(y)
            fps.add(x ^ (1 << int(rng.integers(0, 64))))
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    links = fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert len(links) < 200 * len(fps)
    at = {s: k for k, s in enumerate(signed)}
    parent = list(range(len(fps)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for r in links:
        assert bin(fps[at[r.a]] ^ fps[at[r.b]]).count("1") <= 2
        parent[find(at[r.a])] = find(at[r.b])
    want = brute_components(dict(enumerate(fps)))
    for i in range(len(fps)):
        for j in range(i):
            assert (want[i] == want[j]) == (find(i) == find(j))


def test_query_matches_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    got = {r.doc_id: r for r in op7_simhash(spark, sf_small).collect()}
    fps = {r.doc_id: brute_fp(r.text) for r in docs}
    want = brute_components(fps)
    assert len(got) == len(docs)
    for i, fp in fps.items():
        assert got[i].fingerprint == f"{fp:016x}" and got[i].component_id == want[i]


def test_edge_rows(spark):
    rows = [(3, None, 1), (2, "", 1), (5, " \n", 1), (7, "A b", 1), (8, "a B", 1), (9, "a b c d", 1),
            (9, "a b c d", 1), (None, "a b c d", 1), (None, "other words here", 1), (11, "É b c", 1), (12, "é b c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash_groups(df).collect()
    assert len(got) == len(rows)
    zero = [r for r in got if r.doc_id in (2, 3, 5)]
    assert {r.fingerprint for r in zero} == {"0" * 16} and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in got if r.doc_id in (7, 8)} == {7}
    assert sum(r.component_id == 9 for r in got) == 3
    assert [r.component_id for r in got if r.fingerprint == f"{brute_fp('other words here'):016x}"] == [None]
    assert {r.component_id for r in got if r.doc_id in (11, 12)} == {11, 12}


def test_empty_table(spark):
    assert simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("order,bits", [(3, 1), (4, 2)])
def test_other_codes(spark, order, bits):
    rng = np.random.default_rng(order)
    fps = {int(x) for x in rng.integers(0, 2**20, 40)}
    fps |= {x ^ (1 << int(rng.integers(0, 20))) for x in list(fps)}
    links = fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp long"), bits, order).collect()
    want = brute_components({x: x for x in fps}, bits)
    parent = {x: x for x in fps}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for r in links:
        parent[find(r.a)] = find(r.b)
    assert all((want[x] == want[y]) == (find(x) == find(y)) for x in fps for y in fps)
