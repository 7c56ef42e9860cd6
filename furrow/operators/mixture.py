"""Gaussian mixtures by expectation maximisation over rows packed in blocks, all rows in every pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import stage

#: Rows of a packed block.
PACKED = 1 << 16
#: Added to each variance of the scaled features, so that no component shrinks to a point.
RIDGE = 1e-6


def packed_blocks(df: DataFrame, features: Sequence[str], shift: np.ndarray, scale: np.ndarray) -> DataFrame:
    """(block): the features, shifted and scaled, of up to PACKED rows as bytes of doubles; staged, as every pass reads it."""

    def pack(it):
        held, n = [], 0
        for pdf in it:
            held.append((pdf.to_numpy(dtype=float) - shift) * scale)
            n += len(pdf)
            while n >= PACKED:
                x = np.concatenate(held)
                yield pd.DataFrame({"block": [x[:PACKED].tobytes()]})
                held, n = [x[PACKED:]], n - PACKED
        if n:
            yield pd.DataFrame({"block": [np.concatenate(held).tobytes()]})

    return stage(df.select(*features).mapInPandas(pack, "block binary"), "packed")


def moments(x: np.ndarray) -> np.ndarray:
    """1, each feature, and each product of two, a row a row."""
    i, j = np.triu_indices(x.shape[1])
    return np.hstack([np.ones((len(x), 1)), x, x[:, i] * x[:, j]])


@dataclass(frozen=True)
class Mixture:
    """Weights, means and covariances; ``log_likelihood`` is that of the pass before the last step."""

    weight: np.ndarray
    mean: np.ndarray
    cov: np.ndarray
    log_likelihood: float = -np.inf

    def coefficients(self) -> np.ndarray:
        """A column a component: its weighted log density is the moments times this."""
        d = self.mean.shape[1]
        i, j = np.triu_indices(d)
        inverse = np.linalg.inv(self.cov)
        with np.errstate(divide="ignore"):
            log_weight = np.log(self.weight)
        lead = log_weight - 0.5 * (d * np.log(2 * np.pi) + np.linalg.slogdet(self.cov)[1] + np.einsum("ki,kij,kj->k", self.mean, inverse, self.mean))
        twice = np.where(i == j, 0.5, 1.0)
        return np.vstack([lead, np.einsum("kij,kj->ik", inverse, self.mean), -(inverse[:, i, j] * twice).T])

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return _shares(moments(x) @ self.coefficients())[0]


def _shares(log_p: np.ndarray) -> tuple[np.ndarray, float]:
    """Each component's share of each row, and the log likelihood of all rows."""
    top = log_p.max(1, keepdims=True)
    p = np.exp(log_p - top)
    total = p.sum(1, keepdims=True)
    return p / total, float((top + np.log(total)).sum())


class GaussianMixture:
    """A mixture of Gaussians with full covariances, fitted from ``first`` in at most ``max_iter`` passes or until the log likelihood gains at most ``tol``."""

    def __init__(self, first: Mixture, max_iter: int, tol: float = 0.01):
        self.first, self.max_iter, self.tol = first, max_iter, tol

    def fit(self, blocks: DataFrame) -> Fit:
        """A fit that has begun; ``together`` carries it to its end."""
        return Fit(blocks, self.first, self.max_iter, self.tol)


@dataclass
class Fit:
    """A fit under way: the mixture so far and how many passes are left."""

    blocks: DataFrame
    mixture: Mixture
    left: int
    tol: float

    def step(self, s: np.ndarray, log_like: float) -> None:
        """The next mixture, from each component's sums of moments."""
        m, before = self.mixture, self.mixture.log_likelihood
        d, k = m.mean.shape[1], len(m.weight)
        n, alive = np.maximum(s[:, 0], 1e-300), s[:, 0] > 1e-9
        mean = np.where(alive[:, None], s[:, 1 : d + 1] / n[:, None], m.mean)
        cov, (i, j), at = np.empty((k, d, d)), np.triu_indices(d), np.arange(d)
        cov[:, i, j] = cov[:, j, i] = s[:, d + 1 :] / n[:, None] - mean[:, i] * mean[:, j]
        cov[:, at, at] = np.maximum(cov[:, at, at], 0.0) + RIDGE
        self.mixture = Mixture(s[:, 0] / s[:, 0].sum(), mean, np.where(alive[:, None, None], cov, m.cov), log_like)
        self.left = 0 if abs(log_like - before) <= self.tol else self.left - 1


def first_mixture(rows: np.ndarray, k: int) -> Mixture:
    """Each component's mean and variances from its share of a few rows."""
    parts = np.array_split(rows, k)
    return Mixture(np.full(k, 1 / k), np.array([p.mean(0) for p in parts]), np.array([np.diag(p.var(0) + RIDGE) for p in parts]))


def together(fits: Sequence[Fit]) -> list[Mixture]:
    """All fits over the same blocks to their ends, one pass over the blocks for all of them at a time."""
    while under_way := [f for f in fits if f.left > 0]:
        betas, d = [f.mixture.coefficients() for f in under_way], under_way[0].mixture.mean.shape[1]

        def sums(it):
            totals = [np.zeros(b.T.shape) for b in betas]
            log_like = np.zeros(len(betas))
            for pdf in it:
                for block in pdf["block"]:
                    z = moments(np.frombuffer(block).reshape(-1, d))
                    for i, beta in enumerate(betas):
                        share, ll = _shares(z @ beta)
                        totals[i] += share.T @ z
                        log_like[i] += ll
            yield pd.DataFrame({"sums": [np.concatenate([*(t.ravel() for t in totals), log_like]).tobytes()]})

        got = np.array([np.frombuffer(r["sums"]) for r in under_way[0].blocks.mapInPandas(sums, "sums binary").collect()])
        got = np.sort(got, axis=0).sum(0)  # whatever the order of the tasks
        log_likes = got[-len(betas) :]
        at = 0
        for f, beta, ll in zip(under_way, betas, log_likes):
            f.step(got[at : at + beta.size].reshape(beta.T.shape), float(ll))
            at += beta.size
    return [f.mixture for f in fits]


def predicted_sums(blocks: DataFrame, m: Mixture) -> np.ndarray:
    """For each component the number of rows that it is likeliest for, and their sums of each feature."""
    d, k = m.mean.shape[1], len(m.weight)

    def sums(it):
        total = np.zeros((k, d + 1))
        for pdf in it:
            for block in pdf["block"]:
                x = np.frombuffer(block).reshape(-1, d)
                c = m.posteriors(x).argmax(1)
                total += np.stack([np.bincount(c, w, k) for w in (None, *x.T)], 1)
        yield pd.DataFrame({"sums": [total.tobytes()]})

    got = np.array([np.frombuffer(r["sums"]) for r in blocks.mapInPandas(sums, "sums binary").collect()])
    return np.sort(got, axis=0).sum(0).reshape(k, -1)


def scales(df: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and 1 / deviation of each feature; 0 for one that is constant."""
    r = df.agg(*[f(c) for f in (F.avg, F.stddev_samp) for c in features]).first()
    sd = np.array([v or 0.0 for v in r[len(features) :]])
    return np.array(r[: len(features)], dtype=float), np.divide(1.0, sd, out=np.zeros(len(sd)), where=sd > 0)
