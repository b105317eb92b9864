import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termscope.operators import hinge, stages, tuning


@pytest.fixture(scope="module")
def three(spark):
    """Sparse vectors of three overlapping labels: frequent, rare, constant and empty columns."""
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        label = rnd.choice((0, 0, 0, 1, 1, 2))
        entries = {40: 0.5}
        for slot in rnd.sample(range(label * 10, label * 10 + 18), 5) + rnd.sample(range(41, 90), 2):
            entries[slot] = rnd.random() + 0.1
        if i % 50 == 0:
            entries = {}
        rows.append((float(label), Vectors.sparse(95, entries)))
    rows.append((2.0, Vectors.dense([0.0] * 40 + [0.5] * 55)))
    return spark.createDataFrame(rows, ["label", "norm_features"]).persist()


POINTS = [
    tuning.GridPoint(95, reg, scaled, 15) for reg in (0.0, 0.01, 1.0) for scaled in (True, False)
]


def _passes(monkeypatch):
    made, inner = [], hinge._Passes._pass
    monkeypatch.setattr(hinge._Passes, "_pass", lambda *a: made.append(len(a[1])) or inner(*a))
    return made


def _linear_svc(train, point, label):
    own = F.when(F.col("label") == float(label), 1.0).otherwise(0.0)
    svm = stages.linear_svm(point.regParam, point.maxIter, point.standardization)
    return svm.setLabelCol("own").fit(train.select("norm_features", own.alias("own")))


def test_fits_in_step_are_those_of_linear_svc(three, monkeypatch):
    """Model by model, and in as many jobs as the longest fit takes, not in their sum."""
    made = _passes(monkeypatch)
    rows = hinge.HingeRows(three)
    fits = [(tuning.fit_label(rows, point, label), rows) for point in POINTS for label in (0, 2)]
    models = hinge.in_step(fits)
    assert sum(made) > 4 * len(made)
    for model, (point, label) in zip(models, [(p, x) for p in POINTS for x in (0, 2)]):
        expected = _linear_svc(three, point, label)
        assert model.coefficients.toArray() == pytest.approx(expected.coefficients.toArray(), abs=1e-7)
        assert model.intercept == pytest.approx(expected.intercept, abs=1e-7)


def test_one_fit_at_a_time_gives_the_same(three, monkeypatch):
    made = _passes(monkeypatch)
    found, points = [], [p for p in POINTS if p.regParam == 0.01]
    for most in (1, None):
        rows = hinge.HingeRows(three)
        fits = [(tuning.fit_label(rows, point, 1), rows) for point in points]
        found.append([m.coefficients.toArray() for m in hinge.in_step(fits, most)])
        made.append(None)
    assert found[0][0] == pytest.approx(found[1][0]) and found[0][1] == pytest.approx(found[1][1])
    assert made.index(None) > len(made) - made.index(None) - 2


def test_a_higher_limit_goes_on_where_the_lower_one_ended(three, monkeypatch):
    rows = hinge.HingeRows(three)
    made = _passes(monkeypatch)
    low, high = (tuning.GridPoint(95, 0.01, True, n) for n in (10, 14))
    hinge.in_step([(tuning.fit_label(rows, low, 0), rows)])
    first = len(made)
    model = hinge.in_step([(tuning.fit_label(rows, high, 0), rows)])[0]
    assert 0 < len(made) - first < first
    expected = _linear_svc(three, high, 0)
    assert model.coefficients.toArray() == pytest.approx(expected.coefficients.toArray(), abs=1e-9)


def test_sets_of_several_parts_share_a_pass(three, monkeypatch):
    """Two training sets, dealt over many parts and added by a tree."""
    point = tuning.GridPoint(95, 0.1, False, 5)
    monkeypatch.setattr(hinge, "MOST_ENTRIES", 100)
    monkeypatch.setattr(hinge, "COLLECTED", 2)
    monkeypatch.setattr(hinge, "BLOCK_ROWS", 7)
    made = _passes(monkeypatch)
    parts = three.where("label < 2"), three.where("label > 0")
    sets = [hinge.HingeRows(part) for part in parts]
    models = hinge.in_step([(tuning.fit_label(rows, point, 1), rows) for rows in sets])
    assert max(made) > 1
    for model, part in zip(models, parts):
        expected = _linear_svc(part, point, 1)
        assert model.coefficients.toArray() == pytest.approx(expected.coefficients.toArray(), abs=1e-9)
