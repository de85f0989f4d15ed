"""Brute-force numpy versions of the clustering operators, for small fixtures only."""

from __future__ import annotations

import hashlib
import itertools
import math
from decimal import Decimal

import numpy as np


def draw(seed: int, init: int, step: int, cid: str) -> float:
    h = int(hashlib.md5(f"{seed}|{init}|{step}|{cid}".encode()).hexdigest()[:13], 16)
    return (h + 0.5) / 4503599627370496.0


def d2(p, c) -> float:
    return round(sum((a - b) * (a - b) for a, b in zip(p, c)), 10)


def kpp(ids, X, k, seed, init=0):
    centres = []
    for step in range(k):
        best = None
        for cid, p in zip(ids, X):
            u = draw(seed, init, step, cid)
            if step == 0:
                s = -math.log(u)
            else:
                dd = min(d2(p, c) for c in centres)
                s = -math.log(u) / dd if dd > 0 else math.inf
            key = (s, cid)
            if best is None or key < best[0]:
                best = (key, tuple(p))
        centres.append(best[1])
    return centres


def assign(X, centres):
    return [min(range(len(centres)), key=lambda j: (d2(p, centres[j]), j)) for p in X]


def lloyd(X, centres, max_iter=300, tol=1e-4):
    it = 0
    bound = tol * float(np.var(np.asarray(X), axis=0).mean())
    for it in range(1, max_iter + 1):
        labels = assign(X, centres)
        new = []
        for j, c in enumerate(centres):
            members = [p for p, lab in zip(X, labels) if lab == j]
            if not members:
                new.append(c)
                continue
            sums = [sum(Decimal(repr(round(p[a], 10))) for p in members) for a in range(3)]
            new.append(tuple(float(str(s)) / len(members) for s in sums))
        moved = sum((a - b) * (a - b) for u, c in zip(new, centres) for a, b in zip(u, c))
        stop = new == list(centres) or moved <= bound
        centres = new
        if stop:
            break
    return centres, assign(X, centres), it


def inertia(X, centres, labels):
    return sum(Decimal(repr(d2(p, centres[lab]))) for p, lab in zip(X, labels))


def silhouette(X, labels):
    X = np.asarray(X)
    labels = np.asarray(labels)
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    ks = sorted(set(labels.tolist()))
    s = np.zeros(len(X))
    for i in range(len(X)):
        own = labels[i]
        n_own = (labels == own).sum()
        if n_own <= 1:
            continue
        a = D[i, labels == own].sum() / (n_own - 1)
        b = min(D[i, labels == c].mean() for c in ks if c != own)
        s[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return float(s.mean())


def ari(a, b):
    from collections import Counter

    n = len(a)
    c2 = lambda m: m * (m - 1) / 2.0
    s_ij = sum(c2(v) for v in Counter(zip(a, b)).values())
    s_a = sum(c2(v) for v in Counter(a).values())
    s_b = sum(c2(v) for v in Counter(b).values())
    expected = s_a * s_b / c2(n)
    den = (s_a + s_b) / 2.0 - expected
    return 1.0 if den == 0 else (s_ij - expected) / den


def pairwise(labelings):
    return [ari(x, y) for x, y in itertools.combinations(labelings, 2)]
