"""Small shape fixtures and a plain numpy Procrustes for comparison."""

from __future__ import annotations

import numpy as np

# the eight-point outline used by most shape tests
BASE = np.array([(0, 0), (1, 0.2), (2, -0.3), (1.5, 1), (0.5, 1.3), (-0.5, 0.8), (-0.2, -0.5), (1, -1)], dtype=float)


def turned(shape, degrees=0.0, scale=1.0, shift=(0.0, 0.0)):
    t = np.deg2rad(degrees)
    r = np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]])
    return scale * shape @ r.T + np.asarray(shift)


def population(n, seed=0, noise=0.01, base=BASE):
    rng = np.random.default_rng(seed)
    return [base + rng.normal(0, noise, base.shape) for _ in range(n)]


def frame(spark, shapes, **columns):
    names = list(columns)
    rows = [
        (i, s[:, 0].tolist(), s[:, 1].tolist(), len(s), *[columns[c][i] for c in names]) for i, s in enumerate(shapes)
    ]
    df = spark.createDataFrame(rows, ["ord", "x", "y", "n_points", *names])
    return df.repartition(3)


def unit(shape):
    c = shape - shape.mean(axis=0)
    return c / np.sqrt((c**2).sum())


def rotated(source, target):
    """Best rotation by singular vectors, reflection excluded."""
    u, _, vt = np.linalg.svd(source.T @ target)
    d = np.sign(np.linalg.det(vt.T @ u.T))
    return source @ (vt.T @ np.diag([1.0, d]) @ u.T).T


def plain_consensus(shapes, max_iter=100, tol=1e-8):
    std = [unit(s) for s in shapes]
    ref = std[0]
    for step in range(1, max_iter + 1):
        al = np.stack([rotated(s, ref) for s in std])
        mean = al.mean(axis=0)
        mean /= np.sqrt((mean**2).sum())
        shift, ref = np.sqrt(((mean - ref) ** 2).sum()), mean
        if shift < tol:
            break
    return al, ref, step
