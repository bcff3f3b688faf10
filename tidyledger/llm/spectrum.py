"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

An LDL' factorisation of A - s has as many positive pivots as A has eigenvalues
above s (Sylvester's law of inertia). Such counts isolate each leading
eigenvalue in an interval of its own; Rayleigh quotient iteration, which solves
with the same factorisation, converges within it; two more counts certify which
eigenvalue it is.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17**0.5) / 8  # of Bunch and Kaufman's pivoting
EPSILON = float(np.finfo(float).eps)


class Factors:
    """P (A - shift) P' = L D L' with pivots of one or two rows."""

    def __init__(self, matrix: np.ndarray, shift: float):
        n = len(matrix)
        a = matrix - shift * np.eye(n)
        self.tiny = EPSILON * max(np.abs(a).max(initial=0.0), np.finfo(float).tiny / EPSILON)
        self.order, self.pivots, k = np.arange(n), [], 0
        while k < n:
            size = self._choose(a, k)
            block, below = a[k : k + size, k : k + size], a[k + size :, k : k + size].copy()
            if size == 1 and abs(block[0, 0]) < self.tiny:
                # The shift is an eigenvalue of a leading part; below it all is as small.
                block[0, 0] = -self.tiny
            factor = np.linalg.solve(block, below.T).T
            a[k + size :, k + size :] -= factor @ below.T
            a[k + size :, k : k + size] = factor
            self.pivots.append((k, size))
            k += size
        self.a = a

    def _swap(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]

    def _choose(self, a: np.ndarray, k: int) -> int:
        """Rows of the next pivot, which is moved to place k."""
        if k + 1 == len(a):
            return 1
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax())
        largest, own = column[r - k - 1], abs(a[k, k])
        if own >= _ALPHA * largest:
            return 1
        row = np.abs(a[r, k:])
        row[r - k] = 0
        if own * row.max() >= _ALPHA * largest**2:
            return 1
        if abs(a[r, r]) >= _ALPHA * row.max():
            self._swap(a, k, r)
            return 1
        self._swap(a, k + 1, r)
        return 2

    def positive(self) -> int:
        """Positive eigenvalues of A - shift."""
        found = 0
        for k, size in self.pivots:
            if size == 1:
                found += self.a[k, k] > 0
            else:
                found += int((np.linalg.eigvalsh(self.a[k : k + 2, k : k + 2]) > 0).sum())
        return int(found)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].astype(float)
        for k, size in self.pivots:
            x[k + size :] -= self.a[k + size :, k : k + size] @ x[k : k + size]
        for k, size in self.pivots:
            x[k : k + size] = np.linalg.solve(self.a[k : k + size, k : k + size], x[k : k + size])
        for k, size in reversed(self.pivots):
            x[k : k + size] -= self.a[k + size :, k : k + size].T @ x[k + size :]
        found = np.empty_like(x)
        found[self.order] = x
        return found


class Slicer:
    """Counts of the eigenvalues above a shift; each is made once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        # Eigenvalues are not told apart below this.
        self.width = 8 * EPSILON * max(len(matrix), 1) * self.norm
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = Factors(self.matrix, shift).positive()
        return self.counts[shift]

    def isolate(self, j: int, low: float, high: float) -> tuple[float, float]:
        """An interval with the eigenvalue of number j, and with no other if it can be told apart."""
        known = [s for s in self.counts if low <= s <= high]
        low = max([low, *(s for s in known if self.counts[s] >= j)])
        high = min([high, *(s for s in known if self.counts[s] < j)])
        while high - low > self.width and (self.above(low) > j or self.above(high) < j - 1):
            low, high = self.halve(j, low, high)
        return low, high

    def halve(self, j: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) >= j else (low, middle)

    def certified(self, j: int, value: float) -> bool:
        """Whether `value` is the eigenvalue of number j but for rounding."""
        return self.above(value - self.width) >= j > self.above(value + self.width)

    def refine(self, low: float, high: float, earlier: list[np.ndarray], j: int) -> tuple[float, np.ndarray]:
        """Rayleigh quotient iteration from the middle of the interval, across earlier vectors."""
        draw = np.random.default_rng(j)
        vector = draw.standard_normal(len(self.matrix))
        shift, best = (low + high) / 2, (np.inf, 0.0, vector)
        for turn in range(30):
            vector = Factors(self.matrix, shift).solve(vector)
            for _ in range(2):
                for other in earlier:
                    vector -= (other @ vector) * other
                vector /= np.linalg.norm(vector)
            product = self.matrix @ vector
            value = float(vector @ product)
            left = float(np.linalg.norm(product - value * vector))
            if left < best[0]:
                best = (left, value, vector.copy())
            elif turn > 3:  # it has come as near as rounding lets it
                break
            if turn:
                shift = value
        return best[1], best[2]


def leading(matrix: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The `number` largest eigenvalues that are above rounding, falling, and unit vectors (columns).

    Fewer if fewer are above rounding. The largest entry of a vector is positive.
    Equal eigenvalues get any orthogonal vectors of their space.
    """
    slicer = Slicer(matrix)
    if not len(matrix) or not slicer.norm:
        return np.zeros(0), np.zeros((len(matrix), 0))
    least, most = slicer.width, slicer.norm * (1 + 4 * EPSILON) + slicer.width
    values, vectors = [], []
    for j in range(1, min(number, slicer.above(least)) + 1):
        low, high = slicer.isolate(j, least, most)
        while True:
            value, vector = slicer.refine(low, high, vectors, j)
            if low - slicer.width <= value <= high + slicer.width and slicer.certified(j, value):
                break
            if high - low <= slicer.width:
                raise ArithmeticError(f"eigenvalue {j} could not be certified")
            low, high = slicer.halve(j, low, high)
        values.append(value)
        vectors.append(vector * np.sign(vector[np.abs(vector).argmax()]))
    return np.array(values), np.array(vectors).reshape(len(values), len(matrix)).T
