"""Model steps against brute force."""
from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import functions as F

from samples import DATA
from fraudloom import queries
from fraudloom.operators import boosting, layers, model
from fraudloom.plans.ranges import running_totals
from fraudloom.sources import adapter


@pytest.fixture(scope="module")
def built(spark):
    return layers.build_layers(adapter.messages(spark, DATA))


def labelled_frame(spark, n=4000, seed=3):
    rng = random.Random(seed)
    rows = [(f"t{i}", int(rng.random() < 0.1), rng.choice([0.5, round(rng.random(), 3)])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "transaction_id string, label int, fraud_score double")


def test_split_takes_exact_shares(spark):
    rows, df = labelled_frame(spark)
    got = {r["transaction_id"]: r["is_train"] for r in model.stratified_split(df).collect()}
    assert len(got) == len(rows)
    for label in (0, 1):
        ids = sorted((t for t, y, _ in rows if y == label), key=lambda t: hashlib.md5(f"42:{t}".encode()).hexdigest())
        cut = len(ids) * 3 // 4
        assert all(got[t] for t in ids[:cut]) and not any(got[t] for t in ids[cut:])


@pytest.mark.parametrize("per_range", [50_000, 40])
def test_average_precision_equals_brute_force(spark, per_range):
    rows, df = labelled_frame(spark)
    total, want = sum(y for _, y, _ in rows), 0.0
    for s in {r[2] for r in rows}:
        above = [y for _, y, x in rows if x >= s]
        want += sum(y for _, y, x in rows if x == s) / total * (sum(above) / len(above))
    got = model.average_precision(df, rows_per_range=per_range).first()[0]
    assert abs(got - want) < 1e-9


def test_running_totals_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).cast("double").alias("v"), F.lit(1).alias("n"))
    got = running_totals(df, "v", ("n",), 5000, 100)
    order = sorted((r["v"] for r in df.collect()), reverse=True)
    want = {v: i + 1 for i, v in enumerate(order)}
    assert all(want[r["v"]] == r["n_upto"] for r in got.collect())


def test_metrics_of_nothing_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1)], "label int, fraud_score double")
    row = model.evaluate(df, F.col("fraud_score") > 0.5, "x").first()
    assert (row["precision"], row["recall"], row["f1"], row["tn"]) == (0.0, 0.0, 0.0, 1)


def test_too_little_data_is_refused(spark):
    with pytest.raises(ValueError):
        model.require_enough(labelled_frame(spark, 100)[1])


def test_label_is_true_if_any_copy_was_injected(spark):
    df = spark.createDataFrame([("a", '{"_injected_fraud": null}'), ("a", '{"_injected_fraud": "X"}'), ("b", "{}")],
                               "transaction_id string, payload string")
    assert {r[0]: r[1] for r in model.labels(df).collect()} == {"a": True, "b": False}


def test_train_save_load_score(spark, tmp_path, built):
    processed = built["processed"]
    lab = processed.withColumn("label", (F.col("amount") > 150).cast("int"))
    trained = model.train_model(lab, model.TreeParams(trees=3, depth=3))
    assert model.load_model(spark, str(tmp_path)) == (None, None)
    model.save_model(spark, trained, {"rows": 1}, str(tmp_path))
    loaded, metadata = model.load_model(spark, str(tmp_path))
    assert metadata == {"rows": 1}
    a = {r[0]: r[1] for r in model.score(processed, trained).select("transaction_id", "fraud_score").collect()}
    b = {r[0]: r[1] for r in model.score(processed, loaded).select("transaction_id", "fraud_score").collect()}
    assert a == b and all(0 <= v <= 1 for v in a.values())
    back = model.backfill(processed, loaded)
    assert back.columns == processed.columns and back.filter("fraud_score IS NULL").count() == 0
    unchanged = [c for c in processed.columns if c not in ("fraud_score", "ml_flagged")]
    assert back.select(unchanged).exceptAll(processed.select(unchanged)).count() == 0
    top = model.importances(spark, trained).collect()
    assert top[0]["feature"] == "amount" and abs(sum(r["importance"] for r in top) - 1) < 1e-6


def test_without_model_scores_are_null(spark, built):
    assert model.score(built["processed"]).filter("fraud_score IS NOT NULL").count() == 0


def test_training_tasks_hold_equal_parts(spark, monkeypatch):
    """Rows that lie in one task are dealt out before the passes of the trainer, and none is lost."""
    monkeypatch.setattr(model, "ROWS_PER_TASK", 100)
    rows = spark.createDataFrame([(f"t{i}", i % 2) for i in range(2_050)], "transaction_id string, label int").coalesce(1)
    seen = {}
    real = model.vectorize

    def watched(df):
        seen["sizes"] = df.rdd.glom().map(len).collect()
        return real(df)

    monkeypatch.setattr(model, "vectorize", watched)
    missing = [F.col("label").cast("double").alias(c) for c in model.schemas.MODEL_FEATURES]
    model.train_model(rows.select("transaction_id", "label", *missing), model.TreeParams(trees=1, depth=1))
    assert len(seen["sizes"]) == 21 and sum(seen["sizes"]) == 2_050 and max(seen["sizes"]) <= 110


def test_scoring_computes_the_learned_rows_once(spark, monkeypatch, tmp_path):
    built, folder, real_layers, real_train = [], str(tmp_path / "data"), queries.all_layers, model.train_model
    monkeypatch.setattr(queries, "all_layers", lambda s, d: built.append(d) or real_layers(s, DATA))
    monkeypatch.setattr(model, "MIN_POSITIVES", 1)
    monkeypatch.setattr(model, "train_model", lambda rows, params: real_train(rows, model.TreeParams(trees=2, depth=2)))
    scored = queries.ml_score(spark, folder)
    assert built == [folder]
    want = model.labels(real_layers(spark, DATA)["raw"])
    assert scored.filter("is_probability").join(want, "transaction_id").count() == scored.count() > 500


def training_rows(spark, n=3000, seed=5):
    """Inputs with few and with many values, some missing, and a label that depends on some of them."""
    rng, names = random.Random(seed), model.schemas.MODEL_FEATURES
    rows = []
    for i in range(n):
        row = {c: float(rng.randrange(9)) if k % 2 else round(rng.random() * 100, 3) for k, c in enumerate(names)}
        # What fills a missing value lies among the others, or two splits would part the rows alike.
        row |= {c: None if rng.random() < 0.1 else row[c] - 4 for c in model.MAY_BE_MISSING}
        row |= {c: rng.choice([0.0, 1.0]) for c in model.schemas.FLAG_FEATURES}
        label = int((row["amount"] > 70 and row["amount_zscore"] > 4) or rng.random() < 0.05)
        rows.append((f"t{i}", label, *[row[c] for c in names]))
    return spark.createDataFrame(rows, "transaction_id string, label int, " + ", ".join(f"{c} double" for c in names))


def saved_nodes(spark, trained, path):
    trained.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect()


@pytest.mark.parametrize("block_rows", [65_536, 500])
def test_trees_are_those_of_sparks_own_trainer(spark, tmp_path, monkeypatch, block_rows):
    """Few rows train in the driver, more of them in tasks."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block_rows)
    rows = training_rows(spark).cache()
    weight = model.positive_weight(rows)
    ready = model.vectorize(rows).select(model.VECTOR, "label", F.when(F.col("label") == 1, weight).otherwise(1.0).alias("weight"))
    want = GBTClassifier(featuresCol=model.VECTOR, weightCol="weight", maxIter=5, maxDepth=4).fit(ready)
    got = model.train_model(rows, model.TreeParams(trees=5, depth=4, row_share=1.0, column_share=1.0))
    pairs = list(zip(saved_nodes(spark, got, str(tmp_path / "a")), saved_nodes(spark, want, str(tmp_path / "b")), strict=True))
    for a, b in ((x.nodeData, y.nodeData) for x, y in pairs):
        assert (a.id, a.rawCount, a.leftChild, a.rightChild, a.split) == (b.id, b.rawCount, b.leftChild, b.rightChild, b.split)
        numbers = [[n.prediction, n.impurity, n.gain, *n.impurityStats] for n in (a, b)]
        assert np.allclose(*numbers, rtol=1e-9, atol=1e-9)
    assert got.treeWeights == want.treeWeights and got.numFeatures == want.numFeatures
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())


def test_every_tree_draws_its_rows_and_every_node_its_inputs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 500)
    monkeypatch.setattr(boosting, "TREES_PER_CHECKPOINT", 2)
    monkeypatch.setattr(boosting, "MOST_RESULTS", 1)
    rows = training_rows(spark).cache()
    passes, real = [], boosting.gathered
    monkeypatch.setattr(boosting, "gathered", lambda *a: passes.append(1) or real(*a))
    trained = model.train_model(rows, model.TreeParams(trees=5, depth=3, column_share=0.5))
    assert len(passes) == 5 * 3 + 1
    roots = [r.nodeData.rawCount for r in saved_nodes(spark, trained, str(tmp_path)) if r.nodeData.id == 0]
    assert len(roots) == 5 and len(set(roots)) > 1 and all(2600 <= n <= 2800 for n in roots)
    again = model.train_model(rows, model.TreeParams(trees=5, depth=3, column_share=0.5))
    assert again.toDebugString.split("\n")[1:] == trained.toDebugString.split("\n")[1:]


def test_cut_points_of_many_values_hold_equal_shares(spark, monkeypatch):
    """Values of all rows are summed up, block by block, and a heavy value stays whole."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 4_000)
    values = np.append(np.random.default_rng(1).lognormal(size=300_000), np.full(60_000, 2.5))
    batch = boosting.pa.RecordBatch.from_arrays(
        [boosting.pa.array(list(values[:, None])), boosting.pa.array(np.zeros(len(values)))], ["inputs", "label"])
    batches = [batch.slice(i, 4_000) for i in range(0, len(values), 4_000)]
    (found,) = (dict(zip(b.schema.names, (c[0].as_py() for c in b.columns))) for b in boosting.summaries(batches, 3.0))
    got, weights = np.frombuffer(found["found"]), np.frombuffer(found["weights"])
    assert len(got) <= boosting.SUMMARY_VALUES + 1 and abs(weights.sum() - len(values)) < 1e-6
    cuts = boosting.cut_points(got, weights, boosting.BINS)
    shares = np.diff(np.searchsorted(np.sort(values), cuts), prepend=0) / len(values)
    assert len(cuts) > 20 and all(s < 0.04 or 0.16 < s < 0.23 for s in shares) and (shares > 0.04).sum() == 1


def test_labels_other_than_two_and_no_rows_are_refused(spark):
    with pytest.raises(Exception, match="neither 0 nor 1"):
        model.train_model(training_rows(spark, 50).withColumn("label", F.lit(2)), model.TreeParams(trees=1, depth=1))
    with pytest.raises(ValueError, match="no rows"):
        model.train_model(training_rows(spark, 50).limit(0), model.TreeParams(trees=1, depth=1))
    alike = model.train_model(training_rows(spark, 50).withColumn("label", F.lit(0)), model.TreeParams(trees=2, depth=2))
    assert alike.totalNumNodes == 2


def test_scores_equal_those_of_the_models_own_transform(spark, monkeypatch):
    rows = training_rows(spark).cache()
    params = model.TreeParams(trees=6, depth=4)
    for trained in (model.train_model(rows, params), model.train_model(rows.withColumn("label", F.lit(0)), params)):
        real = GBTClassificationModel.transform
        monkeypatch.setattr(GBTClassificationModel, "transform", lambda *a: pytest.fail("scored row by row"))
        got = {r[0]: r[1] for r in model.score(rows, trained).select("transaction_id", "fraud_score").collect()}
        monkeypatch.setattr(GBTClassificationModel, "transform", real)
        monkeypatch.setattr(boosting, "DEEPEST", -1)
        want = {r[0]: r[1] for r in model.score(rows, trained).select("transaction_id", "fraud_score").collect()}
        monkeypatch.setattr(boosting, "DEEPEST", 12)
        assert len(got) == 3000 and got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-12 for k in got)
        assert model.score(rows, trained).columns == [*rows.columns, "fraud_score"]
        assert model.score(rows.limit(0), trained).count() == 0
