"""Plain Python answers for small inputs."""

from __future__ import annotations


def percentile(values, p):
    """Linear interpolation between the two neighbours of position p * (n - 1)."""
    ordered = sorted(values)
    position = p * (len(ordered) - 1)
    low = int(position)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (position - low) * (ordered[high] - ordered[low])


def wcss(values, labels):
    total = 0.0
    for label in set(labels):
        members = [v for v, l in zip(values, labels) if l == label]
        mean = sum(members) / len(members)
        total += sum((v - mean) ** 2 for v in members)
    return total


def silhouette(values, labels):
    """From all pairwise squared distances."""
    scores = []
    for i, (x, own) in enumerate(zip(values, labels)):
        to = {}
        for j, (y, label) in enumerate(zip(values, labels)):
            if i != j:
                to.setdefault(label, []).append((x - y) ** 2)
        if own not in to:
            scores.append(0.0)
            continue
        means = {label: sum(d) / len(d) for label, d in to.items()}
        a = means.pop(own)
        b = min(means.values())
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return sum(scores) / len(scores)


def least_wcss(values, k):
    """The least possible cost of k clusters of one-dimensional values, by dynamic programming."""
    ordered = sorted(values)
    n = len(ordered)

    def cost(i, j):
        part = ordered[i:j]
        mean = sum(part) / len(part)
        return sum((v - mean) ** 2 for v in part)

    best = [0.0] + [float("inf")] * n
    for _ in range(k):
        best = [0.0] + [
            min(best[i] + cost(i, j) for i in range(j)) for j in range(1, n + 1)
        ]
    return best[n]


def elbow(curve):
    points = sorted((k, s) for k, s in curve if s is not None)
    if not points:
        return 2
    if len(points) <= 2:
        return points[-1][0]
    (x1, y1), (xn, yn) = points[0], points[-1]
    length = ((yn - y1) ** 2 + (xn - x1) ** 2) ** 0.5

    def distance(x, y):
        return abs((yn - y1) * x - (xn - x1) * y + xn * y1 - yn * x1) / length if length else 0.0

    return max(points, key=lambda p: (distance(*p), -p[0]))[0]
