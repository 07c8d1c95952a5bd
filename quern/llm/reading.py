"""Problem 8: how demanding each English document is to read.

A Rasch-style latent model links the level of a document with the difficulty of its words: the chance that a word
occurrence in document d is word w is proportional to exp(f_w + b_w t_d), with t_d the level of the document, b_w the
difficulty of the word and f_w its frequency. (In the plain Rasch model for presence or absence of words, the number
of different words alone decides the level, that is, the length of the document; so its form for counts is used.)

The parameters are estimated by alternating over all documents: given the words, every task finds the levels of its
documents; given the levels, sums by word are added up, and the driver improves the words by Newton steps. Words are
hashed into 2^18 places, so what is broadcast and collected has a fixed bound whatever the vocabulary. Readers'
judgements of a bounded sample of documents start the alternation and place the limits between the bands.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows
from quern.session import stored

WORD = re.compile(r"[^\W_]+")
MIN_WORDS = 60
#: Places for words; a fixed bound.
PLACES = 1 << 18
#: Most labelled documents used to start the estimation and to place the limits.
MAX_LABELLED = 4_000
ROUNDS = 4
BANDS = (1, 2, 3, 4)
GRID = np.linspace(-4.0, 4.0, 161)
#: Function words by language (fixed values).
FUNCTION_WORDS = {
    "en": "the and of to in is that for with must be are not when on it this at by every each before unless if which their after was were has have from or an as you your can will they we he she his her its but do does did so than then there these those what who",
    "fr": "le la les des et dans pour qui une est du sur ne pas que par au aux avec ce cette ces il elle se sont chaque avant si sans un ou mais nous vous leur plus",
    "de": "der die das und nicht ist für von mit dem den des ein eine einer vor nach wenn es auf im zu sich wird werden bei als auch aus oder aber wir sie ihre jede jeder",
    "es": "el los las de que y en por con una del se si no es para su sus un al lo como más antes después cada durante nadie sin o pero este esta estos",
    "it": "il lo gli di che e è per con una del della non si nel sono un al dei delle anche ma questo prima dopo",
    "pt": "o os as de que e em por com uma do da não se para um ao dos das mas mais como são antes depois cada",
    "nl": "de het een en van is dat voor met niet op te zijn aan bij door als ook maar naar wordt worden er om",
}
_LANGUAGES = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}


def is_english(words: list[str]) -> bool:
    """Whether more of the function words are English than of any other language, and not just a few."""
    counts = Counter(words)
    share = {k: sum(n for w, n in counts.items() if w in v) for k, v in _LANGUAGES.items()}
    english = share.pop("en")
    return english > max(share.values()) and english >= 0.04 * len(words)


def encoded(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, words, and the places and counts of the words, of every English document of at least `min_words` words."""

    def start():
        cache: dict[str, int] = {}

        def encode(doc_id: int, text: str) -> list[tuple]:
            words = WORD.findall(text.lower())
            if len(words) < min_words or not is_english(words):
                return []
            counts: dict[int, int] = {}
            for word, n in Counter(words).items():
                place = cache.get(word)
                if place is None:
                    if len(cache) > 500_000:
                        cache.clear()
                    place = cache[word] = zlib.crc32(word.encode()) % PLACES
                counts[place] = counts.get(place, 0) + n
            return [(doc_id, len(words), list(counts), list(counts.values()))]

        return encode

    rows = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text")
    return map_rows(rows, "doc_id bigint, words int, places array<int>, counts array<int>", start)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column and the lengths of its lists."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


class Model:
    """Frequencies f, difficulties b of the places in `used`, and the mean difficulty expected at each level of GRID."""

    def __init__(self, totals: np.ndarray) -> None:
        self.used = np.flatnonzero(totals > 0)
        self.f = np.log(totals[self.used] / max(1.0, totals.sum()))
        self.b = np.zeros(len(self.used))

    def _chunks(self):
        step = 16_384
        return [slice(i, i + step) for i in range(0, len(self.used), step)]

    def _normaliser(self, grid: np.ndarray) -> np.ndarray:
        top = 30.0
        total = np.zeros(len(grid))
        for c in self._chunks():
            total += np.exp(self.f[c, None] + self.b[c, None] * grid[None] - top).sum(0)
        return np.log(total) + top

    def improve(self, s0: np.ndarray, s1: np.ndarray, weights: np.ndarray, grid: np.ndarray, steps: int = 5, ridge: float = 1.0) -> None:
        """Newton steps for f and b, given the sums by word of counts and of counts times level, and the words at each level."""
        s0, s1 = s0[self.used], s1[self.used]
        for _ in range(steps):
            z = self._normaliser(grid)
            for c in self._chunks():
                p = np.exp(self.f[c, None] + self.b[c, None] * grid[None] - z)
                e0, e1, e2 = p @ weights, p @ (weights * grid), p @ (weights * grid**2)
                g0, g1 = s0[c] - e0, s1[c] - e1 - ridge * self.b[c]
                h00, h11 = e0 + 1e-3, e2 + ridge
                det = h00 * h11 - e1 * e1
                self.f[c] += np.clip((h11 * g0 - e1 * g1) / det, -1, 1)
                self.b[c] += np.clip((h00 * g1 - e1 * g0) / det, -1, 1)

    def curve(self) -> np.ndarray:
        """The mean difficulty of a word at each level; it rises."""
        z = self._normaliser(GRID)
        mean = np.zeros(len(GRID))
        for c in self._chunks():
            mean += self.b[c] @ np.exp(self.f[c, None] + self.b[c, None] * GRID[None] - z)
        return mean

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """What the tasks need: the difficulty of every place, and the curve."""
        b = np.zeros(PLACES, dtype=np.float32)
        b[self.used] = self.b
        return b, self.curve()


def levels(places: np.ndarray, counts: np.ndarray, lengths: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The most likely level of each document: the one at which its mean word difficulty is expected."""
    b, curve = table
    rows = np.repeat(np.arange(len(lengths)), lengths)
    n = np.bincount(rows, counts, len(lengths))
    mean = np.bincount(rows, counts * b[places], len(lengths)) / np.maximum(n, 1)
    return np.interp(mean, curve, GRID)


def _gather(docs: DataFrame, table, totals_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all documents: counts by place, counts times level by place, and words by level. At most 2^18 + 161 rows come back."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        s0, s1, weights = np.zeros(PLACES), np.zeros(PLACES), np.zeros(len(GRID))
        for batch in batches:
            places, lengths = _flat(batch.column(0))
            counts, _ = _flat(batch.column(1))
            s0 += np.bincount(places, counts, PLACES)
            if not totals_only:
                t = levels(places, counts, lengths, shared.value)
                rows = np.repeat(np.arange(len(lengths)), lengths)
                s1 += np.bincount(places, counts * t[rows], PLACES)
                at = np.clip(np.round((t - GRID[0]) / (GRID[1] - GRID[0])).astype(int), 0, len(GRID) - 1)
                weights += np.bincount(at, np.bincount(rows, counts, len(lengths)), len(GRID))
        used = np.flatnonzero(s0)
        level = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([used, PLACES + level]).astype(np.int32)), pa.array(np.concatenate([s0[used], weights[level]])), pa.array(np.concatenate([s1[used], np.zeros(len(level))]))],
            names=["place", "s0", "s1"],
        )

    sums = docs.select("places", "counts").mapInArrow(run, "place int, s0 double, s1 double").groupBy("place").agg(F.sum("s0").alias("s0"), F.sum("s1").alias("s1")).toPandas()
    s0, s1 = np.zeros(PLACES + len(GRID)), np.zeros(PLACES + len(GRID))
    s0[sums.place], s1[sums.place] = sums.s0, sums.s1
    return s0[:PLACES], s1[:PLACES], s0[PLACES:]


def judged(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """doc_id and the middle of its readers' bands, of at most `most` documents, chosen by a hash of their id.

    Judgements without a band or with one out of range are ignored; the same judgement stored twice counts once.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("band").isin(*BANDS)).select("doc_id", "rater", "band", "rated_at").distinct()
    return rows.groupBy("doc_id").agg(F.percentile("band", 0.5).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


#: How much the share of documents around a limit counts against it, beside the share of judgements it misses.
VALLEY = 0.3


def limits(t: np.ndarray, label: np.ndarray, weights: np.ndarray, grid: np.ndarray) -> list[float]:
    """Three limits between the bands: where few judgements are missed and few documents lie."""
    found: list[float] = []
    density = np.convolve(weights, [1, 1, 1], "same") / (weights.sum() or 1.0)
    for k in BANDS[:-1]:
        wrong = np.array([np.sum((t > g) & (label <= k)) + np.sum((t <= g) & (label > k)) for g in grid])
        cost = wrong / max(1, len(t)) + VALLEY * density
        low = np.flatnonzero(cost <= cost.min() + 1e-12)
        at = float(grid[low[len(low) // 2]]) if len(t) else k - 2.0
        found.append(max(at, found[-1]) if found else at)
    return found


def estimate(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> tuple[tuple[np.ndarray, np.ndarray], list[float]]:
    """The model's table and the limits between bands, from encoded documents and judgements."""
    sample = docs.join(F.broadcast(judged(labels)), "doc_id").dropDuplicates(["doc_id"]).select("places", "counts", "label").toPandas()
    sample = sample.sort_values("label", kind="stable")
    lengths = np.array([len(p) for p in sample["places"]], dtype=np.int64)
    places = np.concatenate([*sample["places"], []]).astype(np.int64)
    counts = np.concatenate([*sample["counts"], []]).astype(np.float64)
    label = sample["label"].to_numpy(dtype=np.float64)
    zero = (np.zeros(PLACES, dtype=np.float32), GRID)
    model = Model(_gather(docs, zero, totals_only=True)[0])
    if not len(model.used):
        return zero, [-1.0, 0.0, 1.0]
    rows = np.repeat(np.arange(len(lengths)), lengths)
    if len(label):
        t = label - 2.5
        at = np.clip(np.round((t - GRID[0]) / (GRID[1] - GRID[0])).astype(int), 0, len(GRID) - 1)
        weights = np.bincount(at, np.bincount(rows, counts, len(lengths)), len(GRID))
        model.improve(np.bincount(places, counts, PLACES), np.bincount(places, counts * t[rows], PLACES), weights, GRID, steps=15)
    else:
        # Without any judgement the length of words gives the direction, by the share of rare ones.
        model.b = -(model.f - model.f.mean()) / (model.f.std() or 1.0) * 0.1
    for _ in range(rounds):
        s0, s1, weights = _gather(docs, model.table())
        total = weights.sum() or 1.0
        mean = (weights * GRID).sum() / total
        spread = np.sqrt((weights * (GRID - mean) ** 2).sum() / total) or 1.0
        model.improve(s0, (s1 - mean * s0) / spread, weights, (GRID - mean) / spread)
    table = model.table()
    _, _, weights = _gather(docs, table)
    return table, limits(levels(places, counts, lengths, table), label, weights, GRID)


LEVELS = "doc_id bigint, words int, level double, band int"


def reading_levels(documents: DataFrame, labels: DataFrame, min_words: int = MIN_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """level (the latent one, higher is harder) and band (1-4) of every English document of at least `min_words` words.

    What lang says is ignored. Null, blank and short texts, and rows without doc_id, have no level; a document that
    comes twice has a row each time, with the same level. Without judgements the bands are cut at -1, 0 and 1.
    Without documents the result is empty. Other columns are ignored.
    """
    docs = stored(encoded(documents, min_words), "reading")
    table, cuts = estimate(docs, labels, rounds)
    shared = documents.sparkSession.sparkContext.broadcast((table, cuts))

    def run(batches):
        table, cuts = shared.value
        for batch in batches:
            places, lengths = _flat(batch.column(2))
            counts, _ = _flat(batch.column(3))
            t = levels(places, counts, lengths, table)
            band = 1 + sum((t > c).astype(np.int32) for c in cuts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(t), pa.array(band.astype(np.int32))], names=["doc_id", "words", "level", "band"])

    return docs.select("doc_id", "words", "places", "counts").mapInArrow(run, LEVELS)
