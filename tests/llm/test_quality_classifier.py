"""Quality scores: parts against plain computations, the whole on held-out labels."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trilode.llm import quality_classifier as Q
from trilode.llm.common import crc_mod


def test_waves_approximate_the_kernel():
    draw = np.random.default_rng(0)
    x = draw.standard_normal((30, 4))
    maker = Q.waves(np.zeros(4), np.ones(4), count=20_000, width=1.5)
    z = maker.of(x)[:, 1:]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    wanted = np.exp(-distance / (2 * (1.5 * 2) ** 2))
    np.testing.assert_allclose(z @ z.T, wanted, atol=0.05)


def test_ridge_solves_the_penalised_fit():
    draw = np.random.default_rng(1)
    z = np.column_stack([np.ones(50), draw.standard_normal((50, 6))])
    y = draw.standard_normal(50)
    got = Q.ridge(z.T @ z, z.T @ y, 2.0)
    rows = np.concatenate([z, np.sqrt(2.0) * np.eye(7)[1:]])
    wanted = np.linalg.lstsq(rows, np.concatenate([y, np.zeros(6)]), rcond=None)[0]
    np.testing.assert_allclose(got, wanted, atol=1e-6)


def test_pooling_is_the_isotonic_fit():
    draw = np.random.default_rng(2)
    for _ in range(20):
        n = draw.integers(1, 9)
        y, w = draw.random(n), draw.integers(1, 5, n).astype(float)

        def mean(a, b):
            return (y[a:b + 1] @ w[a:b + 1]) / w[a:b + 1].sum()

        wanted = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        np.testing.assert_allclose(Q.pooled(y, w), wanted)


def test_statistics_of_texts():
    for blank in (None, b"", b" \t\n\x0b\x0c\r "):
        assert Q.statistics(blank) == [0.0] * len(Q.NAMES)
    found = dict(zip(Q.NAMES, Q.statistics("AB! ab ab# ä\nx\nx".encode())))
    assert found["words"] == np.log1p(6)
    assert found["capitals"] == 2 / 8 and found["all_capitals"] == 1 / 6
    assert found["repeated_lines"] == pytest.approx(1 / 3)
    assert found["repeated_pairs"] == 0
    assert found["echoes"] == np.sqrt(1 / 6)
    assert found["calls"] == found["symbol_ends"] == np.sqrt(1 / 6)
    one = Q.statistics(b"#")
    assert np.isfinite(one).all() and np.isfinite(Q.statistics("ä".encode() * 10**6)).all()


def learned(rows, labels):
    return Q.fit(rows, labels, crc_mod("doc_id", 5) != 0)


def test_model_is_that_of_all_rows_at_once(spark, docs, sf_dir):
    rows = Q.with_statistics(docs.select("doc_id", "text")).drop("text").cache()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learned(rows, labels)
    y = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    by_x: dict = {}
    for r in rows.collect():
        if r.doc_id in y:
            by_x.setdefault(tuple(r.statistics), []).append(y[r.doc_id])
    x, target = np.array(list(by_x)), np.array([np.mean(v) for v in by_x.values()])
    np.testing.assert_allclose(model.waves.mean, x.mean(axis=0), atol=1e-9)
    z = model.waves.of(x)
    weights = Q.ridge(z.T @ z, z.T @ target)
    np.testing.assert_allclose(model.raw(x), z @ weights, atol=1e-4)
    assert (np.diff(model.knots) > 0).all() and (np.diff(model.values) >= 0).all()


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = Q.with_statistics(docs).drop("text")
    found = Q.score(rows, learned(rows, labels)).join(labels.select(
        "doc_id", F.col("quality").alias("y")), "doc_id").where(crc_mod("doc_id", 5) == 0).collect()
    good = [r.quality for r in found if r.y]
    bad = [r.quality for r in found if not r.y]
    assert min(good) >= 0.3 and sum(b < 0.3 for b in bad) >= 0.8 * len(bad)
    assert all(0 < r.quality < 1 for r in found)


def test_odd_rows(spark, odd, none):
    # the other names used inside, such as id, x, y and half, are columns of the fixture
    marked = odd.selectExpr("*", "'clash' AS statistics", "'clash' AS quality", "5 AS cell")
    rows = Q.with_statistics(marked)
    ids = [None, 1, 2, 4, 8, 8, 9, 77]
    labels = spark.createDataFrame(
        [(i, k % 2 if k < 7 else None, "l") for k, i in enumerate(ids)],
        "doc_id bigint, quality int, text string")
    found = Q.score(rows, Q.fit(rows, labels, F.lit(True)))
    assert found.count() == odd.count() and found.where("quality BETWEEN 0 AND 1").count() == odd.count()
    assert set(found.columns) == set(marked.columns)
    assert Q.fit(Q.with_statistics(none), labels, F.lit(True)) is None
    assert Q.fit(rows, labels.limit(0), F.lit(True)) is None
    assert {r.quality for r in Q.score(rows, None).collect()} == {0.5}
    assert Q.score(Q.with_statistics(none), None).count() == 0
    one_class = labels.withColumn("quality", F.lit(1))
    assert Q.score(rows, Q.fit(rows, one_class, F.lit(True))).where("quality < 0.5").count() == 0


def test_binary_and_text_columns_count_alike():
    batch = pa.array(["ä b"], pa.string())
    assert Q.statistics(batch.cast(pa.binary()).to_pylist()[0]) == Q.statistics("ä b".encode())
