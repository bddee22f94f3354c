"""Links inside groups of near-copies that are many windows large, counted in full."""

import numpy as np
import pytest

from starling.llm import near_vectors


def _links(x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    return (u @ u.T >= threshold) & ~np.eye(len(x), dtype=bool)


@pytest.mark.parametrize("spread", [0.2, 0.4])        # nearly all pairs of the group are links; few of them are
def test_groups_of_many_windows_are_exact(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((2, 32))
    x = np.concatenate([centres[0] + spread * rng.standard_normal((1500, 32)), centres[1] + 0.1 * rng.standard_normal((300, 32)),
                        rng.standard_normal((500, 32))]).astype(np.float32).astype(np.float64)
    x = x[np.concatenate([np.arange(len(x)), [0, 0, 1600]])]                    # copies count each
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(d, window=32, block=128).collect()}
    links = _links(x)
    assert {i: r["n_links"] for i, r in got.items()} == {i: int(n) for i, n in enumerate(links.sum(1))}
    least = np.arange(len(x))
    while (new := np.minimum(least, np.where(links, least[None, :], len(x)).min(1))).tolist() != least.tolist():
        least = new
    assert [got[i]["component_id"] for i in range(len(x))] == least.tolist()


def test_labels_follow_the_links():
    rng = np.random.default_rng(4)
    near = rng.random((40, 60)) < 0.02
    label = near_vectors._joined(near, np.arange(40), np.arange(40, 100), np.arange(100, dtype=np.int32))
    i, j = np.nonzero(near)
    assert (label == near_vectors.least_reachable(100, i, j + 40)).all()
