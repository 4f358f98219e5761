import numpy as np
import pytest

from wellframe.operators import components


def path(spark, order):
    return spark.createDataFrame([(int(a), int(b)) for a, b in zip(order[:-1], order[1:])] + [(900, 901), (None, 1), (5000, None)], "a long, b long")


def test_estimated_size_stays_small(spark):
    """Each round joins its own state: the size the planner expects of it must not be multiplied round after round."""
    labels = components.smallest_labels(path(spark, np.arange(12)))
    assert len(str(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100
    assert {r.node: r.root for r in labels.collect()} == {**dict.fromkeys(range(12), 0), 900: 900, 901: 900}


@pytest.mark.parametrize("size", [40, 300])
def test_chains_in_any_order_take_few_rounds(spark, monkeypatch, size):
    """A chain of shuffled numbers is done in rounds like its size's logarithm, not like its length (132 for 300)."""
    rounds = []
    cut = components.cut_estimates
    monkeypatch.setattr(components, "cut_estimates", lambda df: (rounds.append("old" in df.columns and "root" in df.columns), cut(df))[1])
    labels = components.smallest_labels(path(spark, np.random.default_rng(1).permutation(size)))
    assert {r.node: r.root for r in labels.collect()} == {**dict.fromkeys(range(size), 0), 900: 900, 901: 900}
    assert sum(rounds) <= np.ceil(np.log2(size)) + 1
