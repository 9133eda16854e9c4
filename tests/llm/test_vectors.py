"""Manifest, whitening and near copies of vectors on small tables, against plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import merkle, near_vectors, whitening

# 11 manifest

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(said, (*row[:4], text)))


def tree(nodes):
    """Top of ``nodes`` and, for each, the siblings before and after it, level by level."""
    paths, place, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(place):
            run = level[i - i % 3 : i - i % 3 + 3]
            paths[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        level, place = [h(*level[i : i + 3]) for i in range(0, len(level), 3)], [i // 3 for i in place]
    return level[0], paths


def plain_manifest(rows):
    of = defaultdict(list)
    for r in rows:
        altered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        of[r[1]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), leaf(r, r[4].replace("\n", "") if altered else r[4]), r[0]))
    names = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: (sorted(of[s]), tree([x[2] for x in sorted(of[s])])) for s in names}
    root, upper = tree([below[s][1][0] for s in names])
    out = []
    for s, above in zip(names, upper, strict=True):
        own, (top, paths) = below[s]
        for (_, _, own_leaf, seen, doc_id), path in zip(own, paths, strict=True):
            whole, node = path + above, seen
            for before, after in whole:
                node = h(before, node, after)
            out.append((doc_id, own_leaf, top, root, h(*(a + b for a, b in whole)), node, node == root))
    return out


def as_rows(found):
    keys = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[k] for k in keys) for r in found), key=str)


@pytest.mark.parametrize("deep", [1, 2, 5])
def test_manifest_is_a_plain_tree(spark, tmp_path, monkeypatch, deep):
    monkeypatch.setattr(merkle, "DEEP", deep)
    monkeypatch.setattr(merkle, "BLOCK", 3**deep)
    rows = [(i * 7 % 101, f"s{i % 4}" if i % 9 else None, "en", i, f"line {i}\nnext\n") for i in range(101)]
    rows += [(200, "", "de", 3, ""), (201, "\u00e9", None, None, None), (202, "s1", "en", 5, "x\n"), (202, "s1", "en", 5, "x\n"), (202, "s1", "en", 6, "y")]
    rows += [(None, "s2", "en", 1, "a\nb"), (None, "s2", "en", 1, "c"), (300, "alone", "fr", 9, "l\n" * 40000)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("mine")).withColumn("at", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    found = merkle.op11_merkle(spark, folder).collect()
    assert as_rows(found) == sorted(plain_manifest(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 2, "t\n")], [(1, "a", "en", 2, "t"), (2, None, None, None, None)]])
def test_manifest_of_few_rows(spark, tmp_path, rows):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = merkle.op11_merkle(spark, str(tmp_path)).collect()
    assert as_rows(found) == (sorted(plain_manifest(rows), key=str) if rows else [])


# 12 whitening


@pytest.mark.parametrize(
    "rows",
    [
        np.random.default_rng(1).standard_normal((90, 12)),
        np.random.default_rng(2).standard_normal((90, 12)) * 10.0 ** -np.arange(12),
        np.random.default_rng(3).standard_normal((90, 12)) * 10.0 ** np.arange(12),
        np.random.default_rng(4).standard_normal((5, 12)),
        np.vstack((np.eye(9), -np.eye(9))),  # one eigenvalue, nine times
        np.hstack((np.zeros((30, 2)), np.random.default_rng(5).standard_normal((30, 3)), np.zeros((30, 2)))),
        np.repeat(np.random.default_rng(6).standard_normal((20, 1)), 6, 1),
        np.random.default_rng(7).standard_normal((9, 1)),
        np.random.default_rng(8).standard_normal((50, 8)) @ np.diag([3, 3, 3, 1, 1, 1, 1, 1]) @ np.linalg.qr(np.random.default_rng(9).standard_normal((8, 8)))[0],
        np.zeros((4, 3)),
    ],
)
def test_singular_values_and_directions(rows):
    n, d = rows.shape
    r = np.linalg.qr(rows, mode="r")
    square = np.zeros((d, d))
    square[: len(r)] = r
    a, b, v = whitening.bidiagonal(square)
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-13
    true = np.zeros(d)
    true[: min(n, d)] = np.linalg.svd(rows, compute_uv=False)
    assert np.abs(np.sqrt(whitening.squared_values(a, b)) - true).max() <= 1e-13 * max(true[0], 1e-300)
    model = whitening.solved(r, n, None, 4)
    cov, k = rows.T @ rows / n, len(model.values)
    assert k == min(4, int((true > 1e-12 * max(true[0], 1e-300)).sum()))
    if k:
        assert np.abs(model.directions.T @ model.directions - np.eye(k)).max() < 1e-12
        assert np.abs(cov @ model.directions - model.directions * model.values).max() < 1e-12 * model.values[0]


def test_small_singular_values_are_accurate():
    a, b = 10.0 ** -np.arange(0.0, 40, 2), 10.0 ** -np.arange(1.0, 39, 2)
    found = whitening.squared_values(a, b)
    assert np.prod(found / a[::1] ** 2) == pytest.approx(1, rel=1e-12)  # the product of all is the determinant, whose factors span 76 powers of ten


VECTORS = "vec_id long, embedding array<double>"


def plain_whitening(vectors):
    d = max(len(v) for v in vectors.values())
    x = {i: [int(np.floor(256 * c)) for c in v] + [0] * (d - len(v)) for i, v in vectors.items()}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, s = len(fit), fit.sum(0)
    c = ((n * fit - s) / n).astype(float)
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1], directions[:, ::-1]
    return {i: (sum(int(y) ** 2 for y in n * np.array(v, object) - s), ((n * np.array(v, object) - s) / n).astype(float) @ directions[:, :4] / np.sqrt(values[:4])) for i, v in x.items()}, n, values


def test_whitening(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(3)
    vectors = {i: (rng.standard_normal(7) * [9, 5, 3, 2, 1, 1, 1] + 100).tolist() for i in range(80)}
    vectors |= {80: vectors[3], 81: vectors[3], 82: vectors[5][:4]}
    bad = [(90, None), (91, [1.0, None]), (92, [float("nan")] * 7), (93, [1.0, float("inf")])]
    frame = spark.createDataFrame([*vectors.items(), *bad, (5, vectors[5])], VECTORS)
    frame.repartition(9).withColumn("x", F.lit("mine")).withColumn("n", F.lit(0)).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op12_whitening(spark, str(tmp_path)).collect()
    expected, n, values = plain_whitening(vectors)
    assert len(found) == 4 * (len(vectors) + 1) and {r.n for r in found} == {n}
    assert all(r.identity_error < 1e-9 and r.deviation == expected[r.vec_id][0] for r in found)
    for k in range(4):
        own = [r for r in found if r.component == k + 1]
        assert all(r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9) for r in own)
        sign = np.sign(sum(r.whitened * expected[r.vec_id][1][k] for r in own))
        assert all(abs(sign * r.whitened - expected[r.vec_id][1][k]) < 1e-7 for r in own)


def test_whitening_of_huge_and_few_values(spark):
    def run(rows):
        fit = whitening.whole_numbers(spark.createDataFrame(rows, "vec_id long, vector array<double>"))
        return fit, whitening.fitted(fit.select("x").distinct())

    fit, model = run([(1, [1e308, -1e308]), (2, [0.0, -0.0]), (3, [-0.001, 2.0**54])])
    assert [np.frombuffer(r.x, np.int64).tolist() for r in fit.orderBy("vec_id").collect()] == [[2**63 - 1, -(2**63)], [], [-1, 2**62]]
    assert len(model.values) == 2 and whitening.identity_error(fit.select("x"), model) < 1e-9
    assert {r.deviation for r in whitening.whiten(fit, model).collect()} == {2**63 - 1}
    assert run([])[1] is None and run([(1, [])])[1] is None
    assert len(run([(1, [1.0, 2.0]), (2, [1.0, 2.0])])[1].values) == 0  # nothing varies


def test_whitening_without_rows(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, [1.0])], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op12_whitening(spark, str(tmp_path))
    assert found.count() == 0 and "identity_error" in found.columns


# 13 near copies


def plain_links(rows):
    """n_links and component of each row (vec_id, label, vector)."""
    width = max((len(v) for _, _, v in rows if v), default=0)
    fine = lambda i, lab, v: i is not None and lab is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    kept = list({(i, lab, tuple(v) + (0.0,) * (width - len(v))) for i, lab, v in rows if fine(i, lab, v)})
    x = np.array([v for _, _, v in kept]).reshape(len(kept), width)
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([str(lab) for _, lab, _ in kept])
    link = (x @ x.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(link, False)
    least = np.array([i for i, _, _ in kept])
    while True:
        new = np.array([min(least[i], least[link[i]].min(initial=1 << 60)) for i in range(len(kept))])
        if (new == least).all():
            break
        least = new
    known = {k: (int(n), int(c)) for k, n, c in zip(kept, link.sum(1), least, strict=True)}
    return sorted(((i, *known.get((i, lab, tuple(v) + (0.0,) * (width - len(v))) if v else None, (0, i))) for i, lab, v in rows), key=str)


def planted(seed=4):
    rng = np.random.default_rng(seed)
    near = lambda v, size: (v + size * rng.standard_normal(len(v))).tolist()
    hot, rows = rng.standard_normal(8), []
    for _ in range(150):
        rows.append((1, near(hot, 0.08)))  # the core of a cell
    for _ in range(60):
        rows.append((1, near(hot, 0.35)))  # about the threshold
    for _ in range(120):
        rows.append((int(rng.integers(1, 4)), rng.standard_normal(8).tolist()))
    for i in range(60):
        t = 0.3 * i
        rows.append((2, [float(np.cos(t)), float(np.sin(t)), 0.01 * i, 0.0]))  # a chain
    rows += [rows[0]] * 5 + [(2, rows[0][1]), (1, [2 * c for c in rows[0][1]])]
    return [(i * 37 % 1009, lab, v) for i, (lab, v) in enumerate(rows)]


@pytest.mark.parametrize("block", [16, 4096])
def test_near_vectors_are_brute_force(spark, monkeypatch, block):
    for name, value in {"LEAST_BLOCK": 1, "BLOCK": block, "STRIP": 8, "CELL": 32}.items():
        monkeypatch.setattr(near_vectors, name, value)
    rows = planted()
    rows += [(2000, 1, None), (2001, None, rows[0][2]), (None, 1, rows[0][2]), (2002, 1, [0.0] * 8), (2003, 1, [1.0, None]), (2004, 1, [float("nan")]), (2005, 1, [])]
    rows += [rows[0], (rows[0][0], 1, rows[250][2]), (2006, 3, [1e308, 1e308]), (2007, 3, [1e-308, 1e-308, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>").repartition(5)
    found = near_vectors.near_vectors(frame).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain_links(rows)


def test_core_needs_no_products(spark, monkeypatch):
    rows = [(i, 1, (np.eye(4)[0] + 0.01 * np.random.default_rng(i).standard_normal(4)).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    monkeypatch.setattr(near_vectors, "in_tasks", lambda members, block, f=near_vectors.in_tasks: f(members.where(F.assert_true(F.col("part") == 0).isNull()), block))
    assert {(r.n_links, r.component_id) for r in near_vectors.near_vectors(frame).collect()} == {(199, 0)}


def test_near_vectors_of_few_rows_and_filter(spark, tmp_path):
    schema = "vec_id long, label int, embedding array<float>"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert near_vectors.op13_near_vectors(spark, str(tmp_path)).count() == 0
    rows = [(3, 1, [1.0, 0.1]), (1, 1, [1.0, 0.0]), (2, 2, [1.0, 0.0]), (None, 1, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, schema).withColumn("gone", F.lit("mine")).withColumn("c", F.lit("x"))
    left = near_vectors.representatives(frame, "embedding", "label").collect()
    assert sorted((r.vec_id or 0, r.gone, r.c) for r in left) == [(0, "mine", "x"), (1, "mine", "x"), (2, "mine", "x")]
