"""op2 against brute force, the pipeline against the operators, and the guard of the entry file."""

import os
import subprocess
import sys

import numpy as np
import pytest

import corpus_pipeline
from llm_fixtures import none, odd  # noqa: F401
from ledgerhawk.llm import langid, multi_index, outliers, packing, queries, simhash
from ledgerhawk.llm.common import read

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def brute(ids, x, q, k=5):
    score = multi_index.cosines(x, x[q])
    score[ids == ids[q]] = -np.inf
    order = np.lexsort((ids, -score))[:k]
    return [(int(ids[i]), float(score[i])) for i in order if score[i] > -np.inf]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    got = queries.op2_multi_index(spark, f"/root/testdata/{sf}").toPandas()
    e = read(spark, f"/root/testdata/{sf}", "embeddings").toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    hits = n = 0
    for q in np.flatnonzero(ids % 50 == 0):
        best, mine = brute(ids, x, q), got[got.query_id == ids[q]].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
        score = multi_index.cosines(x, x[q])
        assert [score[np.flatnonzero(ids == v)[0]] for v in mine.vec_id] == mine.score.tolist()
        hits += len({v for v, _ in best} & set(mine.vec_id))
        n += len(best)
    assert hits >= 0.9 * n


def test_visit_bound_equals_sorted_pairs():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b, counts = rng.random(7), rng.random(5), rng.integers(0, 4, (7, 5))
        order = np.argsort((a[:, None] + b).ravel())
        upto = np.cumsum(counts.ravel()[order])
        want = int(rng.integers(1, upto[-1] + 1))
        exp = (a[:, None] + b).ravel()[order][np.searchsorted(upto, want)]
        assert multi_index.visit_bound(a, b, counts, want) == pytest.approx(exp)


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=6).tolist()
    rows = [(i, same) for i in range(0, 200)] + [(200 + i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(1000, None), (1001, [0.0] * 6), (1002, [float("nan")] + [1.0] * 5), (1003, [None] + [1.0] * 5),
             (1004, [1.0, 2.0]), (1005, [float("inf")] + [1.0] * 5), (1006, []), (None, same), (1050, [1e300] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS c1", "'q' AS score")
    got = multi_index.nearest_neighbours(df, 50).toPandas()
    assert set(got.query_id) == {0, 50, 100, 150, 200, 250, 1050}
    assert got[got.query_id == 0].sort_values("rank").vec_id.tolist() == [1, 2, 3, 4, 5]
    assert got[got.query_id == 50].sort_values("rank").vec_id.tolist() == [0, 1, 2, 3, 4]
    assert np.isfinite(got.score).all()
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert multi_index.nearest_neighbours(few, 50).count() == 2
    assert multi_index.nearest_neighbours(few.limit(0), 50).count() == 0


def test_vectors_without_id_are_no_neighbours(spark):
    """The nearest vector has no id, and ids above 2^53 share its block."""
    rng = np.random.default_rng(3)
    big = 2**53 + 1
    rows = [(big + 2 * i, rng.normal(size=6).tolist()) for i in range(30)]
    query, near = 50, rng.normal(size=6).tolist()
    rows = [r for r in rows if r[0] % 50] + [(query, near)]
    df = spark.createDataFrame([*rows, *[(None, near)] * 3], "vec_id long, embedding array<double>")
    got = multi_index.nearest_neighbours(df, 50).toPandas().sort_values("rank")
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    best = brute(ids, x, len(rows) - 1)
    assert set(got.query_id) == {query} and got.vec_id.tolist() == [i for i, _ in best]
    assert got.score.tolist() == pytest.approx([c for _, c in best])


def test_pipeline_equals_its_operators(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf).toPandas()
    docs = read(spark, sf, "documents")
    langs = {r.doc_id for r in langid.identify(docs, langid.train_on(docs)).collect()
             if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_LANGUAGE_SHARE}
    docs = docs.where(docs.doc_id.isin(langs))
    kept = {r.doc_id for r in outliers.verdicts(docs).collect() if r.kept}
    docs = docs.where(docs.doc_id.isin(kept))
    one = {r.doc_id for r in simhash.near_duplicates(docs).collect() if r.doc_id == r.component_id}
    assert set(got.doc_id) == one
    exp = packing.pack(docs.where(docs.doc_id.isin(one))).toPandas()
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(got[key].itertuples(index=False)) == sorted(exp[key].itertuples(index=False))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality rules", "near duplicates", "packing"]


def test_pipeline_odd_and_empty(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, "").columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_entry_without_the_package(tmp_path):
    """Without the package and the pipeline the entry file still imports and registers the rest."""
    for name in os.listdir(ROOT):
        if name not in (".git", "corpus_pipeline.py", "ledgerhawk"):
            os.symlink(os.path.join(ROOT, name), tmp_path / name)
    os.mkdir(tmp_path / "ledgerhawk")
    for name in os.listdir(os.path.join(ROOT, "ledgerhawk")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "ledgerhawk", name), tmp_path / "ledgerhawk" / name)
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(os.path.join(ROOT, "__spark_entry__.py")).read())
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"],
                         cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode == 0 and out.stdout.split()[1] == "False", out.stderr
