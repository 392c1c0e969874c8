"""Trees and thresholds of the personal-data operator come from all candidates, whatever their number."""

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from delayloom.llm import pii


def test_trees_are_fitted_on_all_candidates(spark, monkeypatch):
    # base: 24,000 addresses and 30 numbers; failed: 24,000 short numbers, as phone and as card, 23,990 ids and the 30 numbers as card
    base, failed = 24_000 + 30, 2 * 24_000 + 23_990 + 30
    docs = spark.range(24_000).selectExpr("id as doc_id", """concat('mail u', id, '@host.org or +12 3',
        if(id % 800 = 0, concat(' tel +1 377 555 ', lpad(id, 5, '0')), '')) as text""")
    seen = []

    class Watched(GBTClassifier):
        def fit(self, frame, params=None):
            frame = frame if "weight" in frame.columns else frame.selectExpr("*", "1.0 as weight")
            seen.append({r["label"]: round(float(r["w"]), 6) for r in frame.groupBy("label").agg(F.sum("weight").alias("w")).collect()})
            return super().fit(frame, params)

    monkeypatch.setattr(pii, "GBTClassifier", Watched)
    got = pii.found(docs)
    assert seen == [{1.0: (base + failed) / 2, 0.0: (base + failed) / 2}]
    sums = got.groupBy().sum("n_email", "n_phone").first()
    assert tuple(sums) == (24_000, 30)


def test_thresholds_count_every_base_span(spark):
    rows = [(3.0, 0.91, 1), (3.0, 0.95, 98), (3.0, 0.99, 1), (0.0, 0.92, 2), (0.0, 0.97, 98), (1.0, 0.93, 5), (1.0, 0.99, 5), (2.0, 0.4, 7)]
    base = spark.createDataFrame(rows, "kind_number double, chance double, n long")
    assert pii._limits(base) == {3: 0.95, 0: 0.92, 1: 0.93, 2: pii.LEAST_THRESHOLD}


def test_splits_need_no_sample(spark):
    """Every feature is known to be yes or no, so the learner draws no rows to find where to split."""
    row = spark.range(1).selectExpr("id as doc_id", *[f"double(3) as {name}" for name in pii.FEATURES])
    attributes = pii._encoded(row).schema["features"].metadata["ml_attr"]["attrs"]
    assert list(attributes) == ["binary"]
    assert len(attributes["binary"]) == len(pii.COUNTED) * len(pii.STEPS) + 6 + len(pii.KINDS)
