"""Crowds of near copies that are linked only across: no list of nearest neighbours tells, yet no link may be lost."""

import numpy as np
from touchline.llm import embeddings


def crowd(rng, centre, n, spread):
    x = centre + spread * rng.standard_normal((n, len(centre)))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(6)


def expected(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    label = np.arange(len(x))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return near.sum(axis=1) - 1, label
        label = new


def test_two_crowds_linked_only_across(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal(64)
    a /= np.linalg.norm(a)
    away = rng.standard_normal(64)
    away -= (away @ a) * a
    away /= np.linalg.norm(away)
    b = 0.958 * a + np.sqrt(1 - 0.958 ** 2) * away
    far = -0.5 * a + np.sqrt(0.75) * away
    x = np.concatenate([crowd(rng, a, 2000, 0.0008), crowd(rng, b, 2000, 0.0008), crowd(rng, far, 300, 0.0008)])
    x = x[rng.permutation(len(x))]
    links, label = expected(x)
    assert links.sum() == 2 * (15_996_000 // 2) + 300 * 299  # every pair of the two crowds
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame(spark, x)).collect()}
    assert got == {i: (int(links[i]), int(label[i])) for i in range(len(x))}


def test_many_crowds_in_a_chain(spark, monkeypatch):
    """Six crowds around an arc, each near enough to the next for some links only; balls smaller than a crowd."""
    monkeypatch.setattr(embeddings, "BALL", 32)
    monkeypatch.setattr(embeddings, "CENTRES", 7)
    rng = np.random.default_rng(6)
    e = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
    step = np.arccos(0.948)
    x = np.concatenate([crowd(rng, np.cos(k * step) * e[0] + np.sin(k * step) * e[1], 150, 0.004) for k in range(6)])
    links, label = expected(x)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame(spark, x)).collect()}
    assert got == {i: (int(links[i]), int(label[i])) for i in range(len(x))}
    assert len(set(label)) == 1
