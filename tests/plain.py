"""Plain versions that hold a group whole, for comparison."""

import numpy as np

EARTH_RADIUS = 6371000.0


def dbscan(x: np.ndarray, eps: float, least: int) -> np.ndarray:
    """Labels in order of discovery, -1 for noise; rows are visited in their order."""
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= eps * eps
    core, labels, n = near.sum(axis=1) >= least, np.full(len(x), -1), 0
    for i in range(len(x)):
        if labels[i] >= 0 or not core[i]:
            continue
        todo, labels[i] = [i], n
        while todo:
            for j in np.flatnonzero(near[todo.pop()] & (labels < 0)):
                labels[j] = n
                if core[j]:
                    todo.append(j)
        n += 1
    return labels


def ward(x: np.ndarray, k: int) -> np.ndarray:
    """Labels of ``k`` clusters by Ward's criterion, numbered by their first row.

    Chains of nearest neighbours end in pairs that are nearest to one another, which merge; merges are then
    taken in the order of their costs. Time grows with the square of the rows, memory with the rows.
    """
    n = len(x)
    mean, size, alive = x.astype(float).copy(), np.ones(n), np.ones(n, bool)
    chain, merges = [], []
    while len(merges) < n - 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        a = chain[-1]
        cost = np.where(alive, ((mean - mean[a]) ** 2).sum(axis=1) * size * size[a] / (size + size[a]), np.inf)
        cost[a] = np.inf
        b = int(cost.argmin())
        if len(chain) > 1 and cost[chain[-2]] <= cost[b]:  # the one before is as near: both are nearest to one another
            b = chain[-2]
            del chain[-2:]
            merges.append((cost[b], a, b))
            mean[a] = (mean[a] * size[a] + mean[b] * size[b]) / (size[a] + size[b])
            size[a] += size[b]
            alive[b] = False
        else:
            chain.append(b)
    root = np.arange(n)

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for _, a, b in sorted(merges, key=lambda m: m[0])[: n - max(1, k)]:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return np.unique([top(i) for i in range(n)], return_inverse=True)[1]


def silhouette(x: np.ndarray, labels: np.ndarray, block: int = 1024) -> float:
    """Mean silhouette; rows are compared with all others in blocks, of which only sums by cluster stay."""
    names, at = np.unique(labels, return_inverse=True)
    if len(names) < 2:
        return 0.0
    member, out = np.eye(len(names))[at], []
    size = member.sum(axis=0)
    for i in range(0, len(x), block):
        part, own = x[i : i + block], at[i : i + block]
        d = np.sqrt(np.maximum(((part[:, None] - x[None]) ** 2).sum(axis=2), 0)) @ member
        rows = np.arange(len(part))
        inner = d[rows, own] / np.maximum(size[own] - 1, 1)
        other = d / size
        other[rows, own] = np.inf
        outer = other.min(axis=1)
        most = np.maximum(inner, outer)
        out.append(np.where((size[own] == 1) | (most == 0), 0.0, (outer - inner) / np.where(most == 0, 1.0, most)))
    return float(np.concatenate(out).mean())


def davies_bouldin(x: np.ndarray, labels: np.ndarray) -> float:
    names = np.unique(labels)
    if len(names) < 2:
        return 0.0
    mean = np.stack([x[labels == c].mean(axis=0) for c in names])
    spread = np.array([np.sqrt(((x[labels == c] - m) ** 2).sum(axis=1)).mean() for c, m in zip(names, mean, strict=True)])
    apart = np.sqrt(((mean[:, None] - mean[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    return float(((spread[:, None] + spread[None]) / apart).max(axis=1).mean())


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Haversine distances in metres between the points (lon, lat) of two lines."""
    p, q = np.radians(a)[:, None], np.radians(b)[None]
    h = np.sin((q[..., 1] - p[..., 1]) / 2) ** 2 + np.cos(p[..., 1]) * np.cos(q[..., 1]) * np.sin((q[..., 0] - p[..., 0]) / 2) ** 2
    return 2 * EARTH_RADIUS * np.arcsin(np.sqrt(np.minimum(h, 1)))


def frechet(a: np.ndarray, b: np.ndarray) -> float:
    """Discrete Frechet distance, row by row."""
    d = distances(a, b)
    row = np.maximum.accumulate(d[0])
    for i in range(1, len(d)):
        new = np.empty_like(row)
        new[0] = max(row[0], d[i, 0])
        for j in range(1, len(row)):
            new[j] = max(min(row[j], row[j - 1], new[j - 1]), d[i, j])
        row = new
    return float(row[-1])


def hausdorff(a: np.ndarray, b: np.ndarray) -> float:
    d = distances(a, b)
    return float(max(d.min(axis=1).max(), d.min(axis=0).max()))
