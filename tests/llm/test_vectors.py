import numpy as np
from ledgerwright.llm import neardup_vectors as nv

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors, threshold=0.9):
    ok = {i: np.array(v, float) for i, v in vectors.items() if v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v))}
    links = {i: [] for i in vectors}
    for a in ok:
        for b in ok:
            if a != b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= threshold:
                links[a].append(b)
    out = {}
    for i in vectors:
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in links[todo.pop()] if j not in seen and not seen.add(j)]
        out[i] = (len(links[i]), min(seen), min(seen) == i)
    return out


def planted(seed=0, dim=24):
    r = np.random.default_rng(seed)
    vectors = {}
    for _ in range(60):
        base = r.normal(size=dim)
        for _ in range(int(r.integers(1, 8))):
            vectors[len(vectors) * 7 % 5003] = (base + r.normal(size=dim) * 0.12).tolist()
    same = r.normal(size=dim).tolist()
    vectors |= {6000 + i: same for i in range(30)} | {7000: None, 7001: [0.0] * dim, 7002: [float("nan")] * dim, 7003: [1.0] * 3, 7004: [1.0, 1.0, 1.01]}
    return vectors


def check(spark, vectors):
    out = nv.near_vectors(spark.createDataFrame(list(vectors.items()), SCHEMA)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == brute(vectors)


def test_links_match_brute_force(spark):
    check(spark, planted())


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(nv, "BLOCK", 3)
    check(spark, planted(3))


def test_recall_at_the_threshold():
    """Pairs just above the threshold share a filter almost always."""
    r = np.random.default_rng(2)
    n, dim = 3000, 64
    a = r.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.normal(size=(n, dim))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    code = nv.ProductCode(dim, 20_000, 0.9)
    b = 0.901 * a + (1 - 0.901**2) ** 0.5 * b
    shared = [bool(set(x) & set(y)) for x, y in zip(code.decode(a), code.decode(b), strict=True)]
    assert np.mean(shared) > 0.97


def test_nulls_inside_repeats_and_empty_tables(spark):
    rows = [(1, [1.0, None], "x"), (None, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    out = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in nv.near_vectors(df).collect()), key=str)
    assert out == sorted([(1, 0, 1, True), (None, 0, None, True), (2, 1, 2, True), (2, 1, 2, True), (3, 0, 3, True)], key=str)
    assert nv.near_vectors(df.where("false")).count() == 0
