"""An averaged perceptron over sparse string features, for small models that are trained here."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable


class AveragedPerceptron:
    """Binary or structured: weights of features, averaged over all updates.

    `score` sums weights; `update` adds to the features of the right answer and takes from those of the wrong one.
    """

    def __init__(self) -> None:
        self.weights: dict = {}
        self._totals: dict = defaultdict(float)
        self._stamps: dict = defaultdict(int)
        self._now = 0

    def score(self, features: Iterable) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def tick(self) -> None:
        self._now += 1

    def _add(self, feature, value: float) -> None:
        current = self.weights.get(feature, 0.0)
        self._totals[feature] += (self._now - self._stamps[feature]) * current
        self._stamps[feature] = self._now
        self.weights[feature] = current + value

    def update(self, right: Iterable, wrong: Iterable, by: float = 1.0) -> None:
        for f in right:
            self._add(f, by)
        for f in wrong:
            self._add(f, -by)

    def averaged(self) -> dict:
        """The mean of every weight over the training run."""
        now = max(1, self._now)
        out = {}
        for feature, weight in self.weights.items():
            total = self._totals[feature] + (self._now - self._stamps[feature]) * weight
            if total:
                out[feature] = total / now
        return out
