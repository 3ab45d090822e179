import numpy as np
import pandas as pd
import pytest

from conftest import DATA
from panelwright.operators import correlation, factors
from panelwright.plans import segments
from panelwright.presets import mortgage
from panelwright.workload import features as workload
from panelwright.workload import fixture as fx

BLOCKS = {"first": ["a", "b", "c"], "second": ["d", "e", "f"], "third": ["g", "h", "i"]}
COLUMNS = [n for block in BLOCKS.values() for n in block]


def _structure():
    load = np.zeros((9, 3))
    for j in range(3):
        load[3 * j : 3 * j + 3, j] = (0.8, 0.7, -0.6)
    phi = np.array([[1, 0.3, 0.2], [0.3, 1, 0.1], [0.2, 0.1, 1]])
    common = load @ phi @ load.T
    return load, phi, common + np.diag(1 - np.diag(common))


def test_repair_raises_the_least_eigenvalue_and_keeps_the_diagonal():
    broken = np.array([[1, 0.9, -0.9], [0.9, 1, 0.9], [-0.9, 0.9, 1]])
    fixed = correlation.positive_definite(broken)
    assert fixed.least_before == pytest.approx(-0.8)
    assert fixed.least_after > 0
    assert np.allclose(np.diag(fixed.matrix), 1) and np.allclose(fixed.matrix, fixed.matrix.T)
    overall, _ = correlation.kmo(fixed.matrix)
    assert 0 <= overall <= 1


def test_repair_leaves_a_sound_matrix_alone():
    _, _, matrix = _structure()
    fixed = correlation.positive_definite(matrix)
    assert np.array_equal(fixed.matrix, matrix)
    assert fixed.least_before == fixed.least_after


def test_factors_keep_the_place_of_their_block():
    load, phi, matrix = _structure()
    model = factors.fit_blocks(matrix, COLUMNS, BLOCKS)
    assert model.names == tuple(BLOCKS)
    assert np.allclose(model.loadings, load, atol=0.02)
    assert np.allclose(model.factor_correlations, phi, atol=0.03)
    # another order of blocks and columns gives the same factors under the same names
    order = [8, 3, 0, 5, 1, 7, 4, 2, 6]
    turned = factors.fit_blocks(matrix[np.ix_(order, order)], [COLUMNS[i] for i in order], dict(reversed(BLOCKS.items())))
    assert np.allclose(turned.loadings[:, ::-1], model.loadings[order], atol=0.02)


def test_blocks_have_to_cover_the_columns():
    _, _, matrix = _structure()
    with pytest.raises(ValueError, match="differ"):
        factors.fit_blocks(matrix, COLUMNS, {"first": ["a", "b"]})
    with pytest.raises(ValueError, match="too few"):
        factors.fit_blocks(np.eye(3), list("abc"), {"x": ["a"], "y": ["b"], "z": ["c"]})


def test_constant_outcomes_have_no_correlation(spark):
    rows = pd.DataFrame({"f": [1.0, 2.0, 4.0, None], "y": [1.0, 1.0, 1.0, 2.0], "z": [1.0, 3.0, None, 5.0]})
    df = spark.createDataFrame(rows.astype(object).where(rows.notna(), None), "f double, y double, z double")
    found = {r["col"]: r["value"] for r in correlation.outcome_correlation(df, ["f"], ["y", "z"]).collect()}
    assert found["y"] is None
    assert found["z"] == pytest.approx(1.0)


def test_origination_factors_load_on_their_blocks(spark):
    model = segments.origination_model(segments.origination_block(fx.loan_table(spark, DATA)))
    assert len(model.columns) == 16
    assert np.linalg.eigvalsh(model.correlations)[0] > 0
    for j, (name, block) in enumerate(mortgage.ORIGINATION_FACTORS.items()):
        assert model.names[j] == name
        assert model.columns[np.abs(model.loadings[:, j]).argmax()] in block


def test_latent_outcome_correlation_equals_numpy(spark):
    # the scores are computed anew from the model's weights
    loans = segments.origination_block(fx.loan_table(spark, DATA))
    model = segments.origination_model(loans)
    outcomes = fx.loan_table(spark, DATA).select("loan_id", "ever_d90").toPandas()
    block = loans.select("loan_id", *model.columns).toPandas().dropna().set_index("loan_id").astype(float)
    z = (block - block.mean()) / block.std(ddof=0)
    scores = pd.DataFrame(z.to_numpy() @ model.weights, index=block.index, columns=list(model.names))
    latent = segments.latent_space(fx.loan_table(spark, DATA)).select("loan_id", *segments.LATENT).toPandas().set_index("loan_id")
    merged = latent.join(outcomes.set_index("loan_id"))
    assert merged.index.is_unique and set(merged.index) <= set(scores.index)
    cells = workload.book.runs["m20_latent_outcome_correlation"](spark, DATA).where("col = 'ever_d90'").collect()
    found = {r["row"]: r["value"] for r in cells}
    for name in model.names:
        want = np.corrcoef(scores.loc[merged.index, name], merged["ever_d90"].astype(float))[0, 1]
        assert found[name] == pytest.approx(want, abs=1e-6)
