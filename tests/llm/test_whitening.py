import math

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("kgloom.llm")

from kgloom.llm import whitening  # noqa: E402
from kgloom.llm.whitening import op12_embedding_whitening, whiten  # noqa: E402


def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{extra}")


def brute(rows, components=4):
    """{vec_id: [(n, deviation, whitened, explained)]} by numpy and whole numbers; whitened up to its sign."""
    good = [(i, [math.floor(float(np.float32(c)) * 256) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n = len(fit)
    total = [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array([t / n for t in total])
    covariance = centred.T @ centred / n
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1], v[:, ::-1]
    out = []
    for i, x in good:
        deviation = sum((n * a - t) ** 2 for a, t in zip(x, total))
        for k in range(min(components, len(e))):
            if e[k] > 1e-12 * e.sum():
                w = (np.array(x, float) - np.array(total) / n) @ v[:, k] / math.sqrt(e[k])
                out.append((i, k + 1, n, deviation, w, e[k] / e.sum()))
    return out


def check(result, rows):
    want = brute(rows)
    got = [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in result]
    order = lambda r: (r[1], r[0] is not None, r[0] or 0, r[3], abs(r[4]))
    want, got = sorted(want, key=order), sorted(got, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for component in {r[1] for r in want}:
        a, b = (np.array([r[4] for r in x if r[1] == component]) for x in (want, got))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert len({r["identity_error"] for r in result}) <= 1 and all(r["identity_error"] < 1e-4 for r in result)


def query(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return op12_embedding_whitening(spark, str(tmp_path)).collect()


def test_matches_numpy(spark, tmp_path, monkeypatch):
    """Several blocks along both sides, repeated vectors, rows without a usable vector."""
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 320)
    monkeypatch.setattr(whitening, "TASK_BYTES", 2_000)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    draw = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in draw.normal(size=7) * [5, 3, 2, 1, 0.5, 0.3, 0.1]]) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(90)] + [(None, rows[5][1]), (7, rows[7][1])]
    rows += [(2000, None), (2001, [None] + [1.0] * 6), (2002, [float("nan")] * 7), (2003, [float("-inf")] + [0.0] * 6)]
    check(query(spark, vectors(spark, rows), tmp_path), rows)


def test_few_dimensions_and_components_without_variance(spark, tmp_path):
    rows = [(i, [i / 4.0, 2.0, -i / 4.0]) for i in range(9)]
    result = query(spark, vectors(spark, rows), tmp_path)
    assert {r["component"] for r in result} == {1} and len(result) == 9
    assert math.isclose(result[0]["explained"], 1.0, rel_tol=1e-9)


def test_equal_vectors_empty_tables_and_no_entries(spark):
    same = whiten(vectors(spark, [(i, [0.5, 0.25]) for i in range(3)])).collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in same] == [(1, 0, [])] * 3
    assert whiten(vectors(spark, [])).count() == 0 and whiten(vectors(spark, [(1, None)])).count() == 0
    assert whiten(vectors(spark, [(1, [])])).first()["whitened"] == []
    with pytest.raises(ValueError):
        whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_other_columns_are_kept(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=3).tolist()) for i in range(20)]
    plain = vectors(spark, rows)
    names = ["at", "row", "values", "index", "vector", "n", "__part"]
    odd = whiten(plain.withColumns({c: F.lit("theirs") for c in names}))
    assert odd.select("at", "row", "values", "index", "vector", "__part").distinct().collect() == [("theirs",) * 6]
    take = lambda d: sorted((r["vec_id"], r["n"], r["deviation"], [round(abs(w), 9) for w in r["whitened"]]) for r in d.collect())
    assert take(odd) == take(whiten(plain))


def test_whole_steps(spark):
    rows = vectors(spark, [(1, [-0.001, 0.0039, 0.0040]), (2, [1.0, -1.0, 0.0])])
    assert sorted(r["x"] for r in whiten(rows).collect()) == [[-1, 0, 1], [256, -256, 0]]
