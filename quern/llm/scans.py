"""Problem 1: noise in text from scanned pages.

Three small models, all averaged perceptrons, repair a text: one tells page furniture from text lines by the form of a
line and its place on the page, by the distance between page breaks too; one decides at line ends whether a division
mark goes (and the halves are joined) or stays; one edits characters: for each it predicts, over the whole alphabet of
the corpus, to keep, replace or delete it, with or without an insertion after it, and ranks sequences of such operations.

They are trained here, without hand-made labels: on the words and lines of the corpus itself, which are taken as
right, and on copies of them spoilt as scanning does it. What counts as a word of the corpus comes from counts over
all texts; the lines for training from a sample of documented size. An edit counts only if the outcome is a trusted
word of the corpus that is far more frequent than what stood there, an exact check after the model.
"""

from __future__ import annotations

import random
import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows
from quern.llm.perceptron import AveragedPerceptron
from quern.session import stored

# --- fixed values --------------------------------------------------------------------------------------------------

#: Marks by which a word is divided at a line end: hyphen, not sign, soft hyphen, typographic hyphen.
MARKS = "-¬­‐"
#: What scanning makes of letters: (right, misread).
CONFUSIONS = [
    ("o", "0"), ("o", "©"), ("o", "c"), ("l", "1"), ("l", "|"), ("l", "i"), ("l", "I"), ("i", "l"), ("i", "1"), ("i", "!"), ("i", "ï"), ("i", "|"), ("i", "j"), ("s", "5"), ("s", "8"), ("s", "$"),
    ("g", "9"), ("g", "q"), ("q", "9"), ("b", "6"), ("b", "h"), ("h", "b"), ("h", "li"), ("b", "8"), ("z", "2"), ("a", "@"), ("a", "o"), ("a", "á"), ("c", "("), ("c", "e"), ("c", "<"), ("c", "¢"), ("e", "c"), ("e", "é"), ("e", "3"), ("e", "€"),
    ("t", "f"), ("f", "t"), ("f", "ƒ"), ("t", "+"), ("t", "7"), ("t", "l"), ("u", "v"), ("v", "y"), ("y", "v"), ("n", "u"), ("u", "n"), ("n", "ri"), ("n", "h"), ("m", "rn"), ("m", "in"), ("m", "nn"), ("rn", "m"), ("in", "m"),
    ("w", "vv"), ("vv", "w"), ("u", "ii"), ("u", "ü"), ("ii", "u"), ("d", "cl"), ("cl", "d"), ("k", "lc"), ("h", "ln"), ("r", "i"), ("r", "n"), ("p", "n"), ("x", "×"), ("y", "¥"), ("o", "ö"), ("d", "ol"), ("n", "ii"), ("w", "w/"),
]
_CONFUSED = {c for _, misread in CONFUSIONS for c in misread if not (c.isascii() and c.isalpha())}

# --- parameters ----------------------------------------------------------------------------------------------------

#: Words of a smaller share of all words are not broadcast, so at most 1,000,000 are; the rarer ones are joined to the
#: texts that ask for them.
LEAST_SHARE = 1e-6
#: Rows from which training lines are taken, and words from which training words are.
SAMPLE_ROWS = 1_200
SAMPLE_WORDS = 1_500
#: A corrected word must be so many times as frequent as what it replaces.
RATIO = 20.0

WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
#: Signs of a scanned row: a misread sign within a word, a divided word at a line end, or a line that is a page number.
PAGE_NUMBER = re.compile(
    r"^\s*(?:[-–—|\[(]\s?)?(?:(?:page|p\.|seite|pag\.?)\s*)?(?:\d{1,4}|[ivxlcdm]{1,8}|[A-Z]-\d{1,4})(?:\s*(?:of|/|von|de)\s*\d{1,4})?(?:\s?[-–—|\])])?\s*$", re.I
)
#: What such a line may end with.
_NUMBER_ENDS = frozenset("0123456789ivxlcdmIVXLCDM-–—|])")
_SPOILT = re.compile(r"[a-z][0-9@©|!ƒ(ï][a-z]{2}|^[0-9@©|ƒ][a-z]{4}", re.I)
_SOFT = tuple(f"{mark}{space}\n" for mark in MARKS for space in ("", " "))[1:]
_NUMBER_LINE = re.compile(r"\n[ ]*(?:[-–—|\[(]\s?)?(?:page\s|p\.\s)?(?:[0-9]{1,4}|[ivxl]{1,6}|[A-Z]-[0-9]{1,3})(?:\s?(?:of|/)\s?[0-9]+)?(?:\s?[-–—|\])])?[ ]*(?=\n)", re.I)


def scan_signs(text: str, fine: set[str], tokens: list[str] | None = None) -> bool:
    """Whether a text shows signs of scanning: divided words, lone page numbers, signs within words.

    `fine` gathers tokens that are none, as most tokens recur; `tokens` are those of the text, if they are at hand.
    """
    if "\n" in text and (any(m in text for m in _SOFT) or _NUMBER_LINE.search(text)):
        return True
    unsure = set(text.split() if tokens is None else tokens) - fine
    spoilt = {t for t in unsure if _SPOILT.search(t)}
    if len(fine) > 500_000:
        fine.clear()
    fine |= unsure - spoilt
    return bool(spoilt)


# --- the lexicon ---------------------------------------------------------------------------------------------------

def _is_trusted(word: str, n: int, scanned: int) -> bool:
    return scanned <= 0.5 * n and len(word) > 1 or word in ("a", "i")


class Lexicon:
    """Words of the corpus with their counts; `trusted` are those that do not stand mostly in scanned rows."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.count = {w: n for w, n, _ in rows}
        self.trusted = {w for w, n, scanned in rows if _is_trusted(w, n, scanned)}
        self.sorted = sorted(w for w in self.trusted if "-" not in w)
        #: Length of the longest word of the corpus, rare ones included.
        self.longest = max(map(len, self.trusted), default=0)
        self.added: list[str] = []
        self.starts: set[str] = set()

    def begins(self, prefix: str) -> bool:
        """Whether a trusted word begins so."""
        i = bisect_left(self.sorted, prefix)
        return i < len(self.sorted) and self.sorted[i].startswith(prefix) or prefix in self.starts

    def those_trusted(self, words: set[str]) -> set[str]:
        return words & self.trusted

    def add(self, rows: list[tuple[str, int, int]]) -> None:
        """Rare words that a text asks for. They are right for any text, and go when there are many of them."""
        if len(self.added) > 100_000:
            for w in self.added:
                self.count.pop(w, None)
                self.trusted.discard(w)
            self.added, self.starts = [], set()
        for w, n, scanned in rows:
            if w in self.count:
                continue
            self.added.append(w)
            self.count[w] = n
            if _is_trusted(w, n, scanned):
                self.trusted.add(w)
                if "-" not in w:
                    self.starts.update(w[:k] for k in range(len(w) + 1))

    def unsure_count(self, word: str, better: int | None) -> None:
        """Called where it matters whether `word` is RATIO times rarer than a word with the count `better`, if any is better."""

    def bucket(self, word: str) -> int:
        return min(6, len(str(self.count.get(word, 0)))) if word in self.trusted else 0


#: Places in each bitmap of rare words; when it fills up, more texts are looked up, with the same result.
BITS = 1 << 24
_TRUSTED, _OTHER, _STARTS = range(3)


class Bitmaps:
    """Hashed places of the rare trusted words, of the other rare words, and of the beginnings of the trusted ones."""

    def __init__(self, rare: DataFrame, bits: int = BITS) -> None:
        self.size = bits

        def run(batches):
            masks: Counter = Counter()

            def out():
                kinds, slots = [k for k, _ in masks], [s for _, s in masks]
                return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(slots, pa.int32()), pa.array(list(masks.values()), pa.int64())], names=["kind", "slot", "mask"])

            for batch in batches:
                for word, n, scanned in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    trusted = _is_trusted(word, n, scanned)
                    entries = [(_TRUSTED if trusted else _OTHER, word)]
                    if trusted and "-" not in word:
                        entries += [(_STARTS, word[:k]) for k in range(min(len(word), 60) + 1)]
                    for kind, entry in entries:
                        slot, bit = divmod(crc32(entry.encode()) % bits, 32)
                        masks[kind, slot] |= 1 << bit
                    if len(masks) > 300_000:
                        yield out()
                        masks = Counter()
            yield out()

        found = rare.select("word", "n", "scanned").mapInArrow(run, "kind int, slot int, mask bigint").groupBy("kind", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        self.bits = [array("I", bytes(bits // 8)) for _ in range(3)]
        for batch in found.to_batches(max_chunksize=50_000):
            for kind, slot, mask in zip(*(batch.column(i).to_pylist() for i in range(3))):
                self.bits[kind][slot] = mask

    def may_hold(self, kind: int, word: str) -> bool:
        slot, bit = divmod(crc32(word.encode()) % self.size, 32)
        return bool(self.bits[kind][slot] >> bit & 1)


class _Asking(set):
    """Trusted words that notes which others may be rare trusted ones."""

    def __init__(self, words: set[str], bitmaps: Bitmaps, asked: set[str]) -> None:
        super().__init__(words)
        self.bitmaps, self.asked = bitmaps, asked

    def __contains__(self, word) -> bool:
        if set.__contains__(self, word):
            return True
        if self.bitmaps.may_hold(_TRUSTED, word):
            self.asked.add(word)
        return False


class AskingLexicon(Lexicon):
    """The frequent words; `asked` gathers the words whose rare counts would be needed to be sure.

    An answer given while nothing is asked is what all words together would give.
    """

    def __init__(self, words: Lexicon, bitmaps: Bitmaps, bound: float) -> None:
        self.count, self.sorted, self.longest, self.added, self.starts = words.count, words.sorted, words.longest, [], set()
        self.asked: set[str] = set()
        self.bitmaps, self.bound = bitmaps, bound
        self.trusted = _Asking(words.trusted, bitmaps, self.asked)
        self.surely = words.trusted

    def those_trusted(self, words: set[str]) -> set[str]:
        found = words & self.surely
        bits, size = self.bitmaps.bits[_TRUSTED], self.bitmaps.size
        for word in words - found:
            place = crc32(word.encode()) % size
            if bits[place >> 5] >> (place & 31) & 1:
                self.asked.add(word)
        return found

    def begins(self, prefix: str) -> bool:
        return super().begins(prefix) or self.bitmaps.may_hold(_STARTS, prefix)

    def unsure_count(self, word: str, better: int | None) -> None:
        # A rare word has fewer than `bound` occurrences; a rare outcome that is asked for may be the better one.
        if word not in self.count and (self.asked or better is not None and better < RATIO * self.bound) and self.bitmaps.may_hold(_OTHER, word):
            self.asked.add(word)


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n, scanned: how often every word occurs in all texts, and in those that show signs of scanning."""

    def run(batches):
        everywhere: Counter = Counter()
        scanned: Counter = Counter()
        fine: set[str] = set()

        def out():
            # Tokens recur, so words are looked for in the different tokens only.
            words: dict[str, list[int]] = {}
            for token, n in everywhere.items():
                for word in WORD.findall(token.lower()):
                    counts = words.setdefault(word, [0, 0])
                    counts[0] += n
                    counts[1] += scanned.get(token, 0)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array([n for n, _ in words.values()], pa.int64()), pa.array([n for _, n in words.values()], pa.int64())],
                names=["word", "n", "scanned"],
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = text.split()
                everywhere.update(tokens)
                if scan_signs(text, fine, tokens):
                    scanned.update(tokens)
            if len(everywhere) > 300_000:
                yield out()
                everywhere, scanned = Counter(), Counter()
        yield out()

    counted = texts.select("text").where("text IS NOT NULL").mapInArrow(run, "word string, n bigint, scanned bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("scanned").alias("scanned"))


def lexicon(texts: DataFrame, least_share: float = LEAST_SHARE) -> Lexicon:
    """The words whose share of all words is at least `least_share`: at most 1 / least_share of them, whatever the corpus."""
    return all_words(texts, least_share)[0]


def all_words(texts: DataFrame, least_share: float) -> tuple[Lexicon, DataFrame | None, float]:
    """The frequent words, the table of the others (None if there are none), and the count from which a word is frequent."""
    counts = stored(word_counts(texts), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = (F.col("n") >= F.lit(least_share * total)) & (F.length("word") <= 60)
    rare = counts.where(~frequent)
    words = Lexicon([tuple(r) for r in counts.where(frequent).collect()])
    words.longest = counts.agg(F.max(F.length("word"))).first()[0] or 0
    return words, None if rare.isEmpty() else rare, least_share * total


# --- the character editor ------------------------------------------------------------------------------------------

#: Of the operations that training texts need, the share that must be within reach; the margin follows from it.
REACH = 0.995
#: Share of spoilt places in training that come from anywhere in the alphabet instead of CONFUSIONS.
ANYWHERE = 0.02


class Operations:
    """The operation at each character, by a multi-class averaged perceptron over the characters around it.

    An operation is the text that takes the character's place: itself (keep), another letter of the alphabet (replace),
    nothing (delete), or two letters (insert). weights: by feature, then by operation; `margin`: how far below keeping an
    operation may score and still be looked at.
    """

    def __init__(self, weights: dict | None = None, margin: float = 0.0) -> None:
        self.weights, self.margin = weights or {}, margin
        self.cache: dict[tuple, list[str]] = {}

    @staticmethod
    def features(x: str, i: int) -> tuple:
        before, after = x[i - 1] if i else "^", x[i + 1] if i + 1 < len(x) else "$"
        return (x[i], before + x[i], x[i] + after + "+", before + x[i] + after)

    def scores(self, x: str, i: int) -> dict[str, float]:
        found: dict[str, float] = {x[i]: 0.0}
        for feature in self.features(x, i):
            for to, weight in self.weights.get(feature, {}).items():
                found[to] = found.get(to, 0.0) + weight
        return found

    def likely(self, x: str, i: int) -> list[str]:
        """The operations other than keeping that are within the margin; they depend on three characters alone."""
        key = (x[i - 1] if i else "^", x[i], x[i + 1] if i + 1 < len(x) else "$")
        known = self.cache.get(key)
        if known is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            scores = self.scores(x, i)
            least = scores[x[i]] - self.margin
            known = self.cache[key] = sorted(to for to, score in scores.items() if to != x[i] and score >= least)
        return known

    def train(self, words: list[list[tuple[str, str]]], seed: int, rounds: int = 4) -> None:
        """On words given as (character, right operation)."""
        rng = random.Random(seed)
        model = AveragedPerceptron()
        known: dict[str, set[str]] = defaultdict(set)
        for word in words:
            for c, to in word:
                known[c] |= {c, to}

        def score(fs: tuple, to: str) -> float:
            return model.score([(f, to) for f in fs])

        for _ in range(rounds):
            rng.shuffle(words)
            for word in words:
                x = "".join(c for c, _ in word)
                model.tick()
                for i, (c, right) in enumerate(word):
                    fs = self.features(x, i)
                    others = sorted(known[c] - {right})
                    if not others:
                        continue
                    best = max(others, key=lambda to: score(fs, to))
                    # The right one must lead by one.
                    if score(fs, right) < score(fs, best) + 1.0:
                        model.update([(f, right) for f in fs], [(f, best) for f in fs])
        self.weights = {}
        for (feature, to), weight in model.averaged().items():
            self.weights.setdefault(feature, {})[to] = weight
        gaps = []
        for word in words:
            x = "".join(c for c, _ in word)
            for i, (c, right) in enumerate(word):
                if right != c:
                    scores = self.scores(x, i)
                    gaps.append(scores[c] - scores.get(right, float("-inf")))
        gaps.sort()
        # The least lead that was asked for in training is the unit of what words outside of it may differ by.
        self.margin = max(0.0, gaps[min(len(gaps) - 1, int(REACH * len(gaps)))] + 1.0) if gaps else 0.0
        self.cache = {}


def spoil(word: str, edits: int, alphabet: list[str], rng: random.Random) -> list[tuple[str, str]]:
    """A word as scanning may give it: its characters, each with the operation that puts it right."""
    pairs = [(c, c) for c in word]
    for _ in range(edits):
        fine = [i for i, (c, to) in enumerate(pairs) if c == to]
        if not fine:
            break
        if rng.random() < ANYWHERE:
            at = rng.choice(fine)
            c = pairs[at][0]
            kind = rng.randrange(3)
            if kind == 0:
                pairs[at] = (rng.choice(alphabet), c)
            elif kind == 1 and at + 1 < len(pairs) and pairs[at + 1][0] == pairs[at + 1][1]:
                pairs[at : at + 2] = [(c, c + pairs[at + 1][0])]
            else:
                pairs.insert(at + 1, (rng.choice(alphabet), ""))
            continue
        x = "".join(c for c, _ in pairs)
        places = [(a, b.lower(), m.start()) for a, b in CONFUSIONS for m in re.finditer(re.escape(a), x) if all(c == to for c, to in pairs[m.start() : m.end()])]
        if places:
            # Confusions are drawn first, so that a frequent letter does not crowd the others out.
            right, misread = rng.choice(sorted({(a, b) for a, b, _ in places}))
            at = rng.choice([k for a, b, k in places if (a, b) == (right, misread)])
            operations = (right,) if len(misread) == 1 else (right, *[""] * (len(misread) - 1)) if len(right) == 1 else tuple(right[: len(misread)])
            pairs[at : at + len(right)] = list(zip(misread, operations))
    return pairs


class Editor:
    """Edits a word character by character: operations that the model expects, and a perceptron that ranks sequences.

    Sequences with up to two edited places (an operation, or one with the next character deleted) are searched, all of
    those within the margin, and those count that lead to a trusted word.
    """

    def __init__(self, words: Lexicon, weights: tuple[dict, dict, float] | None = None) -> None:
        self.words = words
        self.weights, expected, margin = weights or ({}, {}, 0.0)
        self.operations = Operations(expected, margin)

    def trained(self) -> tuple[dict, dict, float]:
        return self.weights, self.operations.weights, self.operations.margin

    @staticmethod
    def features(x: str, i: int, to: str) -> tuple:
        before, after = x[i - 1] if i else "^", x[i + 1] if i + 1 < len(x) else "$"
        if to == x[i]:
            return (("k", x[i]), ("kb", before, x[i]), ("ka", x[i], after))
        return (("e", x[i], to), ("eb", before, x[i], to), ("ea", x[i], after, to), ("edit",))

    def _all(self, x: str, operations: list[str], out: str, edits: int) -> tuple:
        parts = [f for i, to in enumerate(operations) for f in self.features(x, i, to)]
        return (*parts, ("f", self.words.bucket(out)), ("n", edits, min(len(x), 12)), ("odd", edits, sum(c in _CONFUSED for c in x)))

    def _places(self, x: str) -> list[tuple[int, int, tuple[str, ...]]]:
        """(first, end, operations) of every single edit: one operation, or a replacement with the next character deleted."""
        likely = [self.operations.likely(x, i) for i in range(len(x))]
        found = [(i, i + 1, (to,)) for i, several in enumerate(likely) for to in several]
        return found + [(i, i + 2, (to, "")) for i in range(len(x) - 1) if "" in likely[i + 1] for to in likely[i] if to]

    def search(self, x: str, score, hidden: str = "") -> list[tuple[float, str, tuple]]:
        """Outcomes with their features, best first: x itself, and the trusted words (but `hidden`) within reach."""
        places = sorted(self._places(x))
        outcomes: list[tuple[str, list[str], int]] = [(x, list(x), 0)]
        single = {k: x[:i] + "".join(ops) + x[end:] for k, (i, end, ops) in enumerate(places)}
        good = self.words.those_trusted(set(single.values()) - {hidden})
        if good:
            outcomes += [(single[k], [*x[:i], *ops, *x[end:]], 1) for k, (i, end, ops) in enumerate(places) if single[k] in good]
        elif len(x) >= 5:
            for n, (i, end, ops) in enumerate(places):
                head = x[:i] + "".join(ops)
                if not self.words.begins(head):
                    continue
                pairs = [(head + x[end:j] + "".join(ops2) + x[end2:], j, end2, ops2) for j, end2, ops2 in places[n + 1 :] if j >= end]
                good = self.words.those_trusted({p[0] for p in pairs} - {hidden})
                outcomes += [(out, [*x[:i], *ops, *x[end:j], *ops2, *x[end2:]], 2) for out, j, end2, ops2 in pairs if out in good]
        if len(outcomes) == 1:
            # Nothing to choose from, so nothing is weighed.
            return [(0.0, x, ())]
        found = []
        for out, operations, edits in outcomes:
            f = self._all(x, operations, out, edits)
            found.append((score(f), out, f))
        return sorted(found, key=lambda f: (-f[0], f[1]))

    def train(self, seed: int = 1, rounds: int = 3) -> None:
        """On words spoilt at one or two places, and on unspoilt ones taken as unknown."""
        rng = random.Random(seed)
        ranked = sorted((w for w in self.words.sorted if len(w) >= 3 and w.isalpha()), key=lambda w: (-self.words.count[w], w))[:SAMPLE_WORDS]
        alphabet = sorted({c for w in ranked for c in w})
        spoilt = [(spoil(word, 1 if rng.random() < 0.8 else 2, alphabet, rng), word) for word in ranked for _ in range(4)]
        spoilt = [(pairs, word) for pairs, word in spoilt if (x := "".join(c for c, _ in pairs)) != word and x not in self.words.trusted]
        self.operations.train([pairs for pairs, _ in spoilt] + [[(c, c) for c in word] for word in ranked], seed)
        cases = [("".join(c for c, _ in pairs), word) for pairs, word in spoilt] + [(word, word) for word in ranked if rng.random() < 0.5]
        model = AveragedPerceptron()
        for _ in range(rounds):
            rng.shuffle(cases)
            for x, word in cases:
                model.tick()
                found = self.search(x, model.score, hidden=word if x == word else "")
                right = next((f for f in found if f[1] == word), None)
                if right and found[0][1] != word:
                    model.update(right[2], found[0][2])
        self.weights = model.averaged()

    def correct(self, x: str) -> str | None:
        """The trusted word that x should be; None to leave it."""
        # Two edits take two characters away at most, so what is longer than that is in reach of no word.
        if not 2 <= len(x) <= self.words.longest + 2:
            return None
        get = self.weights.get
        found = self.search(x, lambda fs: sum(get(f, 0.0) for f in fs))
        best = found[0][1]
        self.words.unsure_count(x, self.words.count[best] if len(found) > 1 and best != x else None)
        if len(found) == 1 or best == x or self.words.count[best] < RATIO * self.words.count.get(x, 0) or self.words.count[best] < 2:
            return None
        return best


# --- line ends -----------------------------------------------------------------------------------------------------

class Joiner:
    """Whether a division mark at a line end goes, from what its halves are alone, joined, and joined by a hyphen."""

    def __init__(self, words: Lexicon, editor: Editor, weights: dict | None = None) -> None:
        self.words, self.editor, self.weights = words, editor, weights or {}
        self.cache: dict[str, bool] = {}

    def _known(self, word: str) -> int:
        if word in self.words.trusted:
            return 2
        if word not in self.cache:
            if len(self.cache) > 200_000:
                self.cache.clear()
            known = bool(self.editor.operations.weights) and self.editor.correct(word) is not None
            if isinstance(self.words, AskingLexicon) and self.words.asked:
                return int(known)
            self.cache[word] = known
        return int(self.cache[word])

    def features(self, first: str, second: str, mark: str, spaced: bool) -> tuple:
        a, b = first.lower(), second.lower()
        joined, hyphened = self._known(a + b), a + "-" + b in self.words.trusted
        parts = (a in self.words.trusted, b in self.words.trusted)
        return (("mark", mark), ("joined", joined, hyphened), ("parts", parts, joined, hyphened), ("spaced", spaced, mark), ("capital", second[:1].isupper(), joined), ("short", len(a) < 3, len(b) < 3, joined), ("bias",))

    def train(self, seed: int = 2) -> None:
        rng = random.Random(seed)
        single = sorted((w for w in self.words.sorted if len(w) >= 6 and w.isalpha()), key=lambda w: (-self.words.count[w], w))[:SAMPLE_WORDS]
        compounds = sorted((w for w in self.words.trusted if re.fullmatch(r"[^\W\d_]+-[^\W\d_]+", w)), key=lambda w: (-self.words.count[w], w))[:SAMPLE_WORDS]
        cases = []
        for w in single:
            at = rng.randint(2, len(w) - 2)
            cases.append((w[:at], w[at:], rng.choice(MARKS), rng.random() < 0.2, True))
        for w in compounds or ["well-known"]:
            for _ in range(1 + len(single) // (2 * max(1, len(compounds)))):
                a, b = w.split("-")
                cases.append((a, b, "-", rng.random() < 0.1, False))
        model = AveragedPerceptron()
        for _ in range(3):
            rng.shuffle(cases)
            for a, b, mark, spaced, goes in cases:
                model.tick()
                f = self.features(a, b, mark, spaced)
                if (model.score(f) > 0) != goes:
                    model.update(f if goes else (), () if goes else f)
        self.weights = model.averaged()

    def goes(self, first: str, second: str, mark: str, spaced: bool) -> bool:
        get = self.weights.get
        return sum(get(f, 0.0) for f in self.features(first, second, mark, spaced)) > 0


# --- page furniture ------------------------------------------------------------------------------------------------

_DIGIT = re.compile(r"\d")
_DIGITS = re.compile(r"\d+|\b[ivxlcdm]+\b", re.I)


def _shape(line: str) -> str:
    """A line without what changes from page to page."""
    return re.sub(r"\s+", " ", _DIGITS.sub("#", line.strip().lower()))


def _squeeze(text: str | None) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip() if text else ""


class Furniture:
    """Lines that are nothing but a running header, a running footer or a page number."""

    def __init__(self, weights: dict | None = None) -> None:
        self.weights = weights or {}

    def features(self, lines: list[str], about: tuple[str, ...]) -> list[tuple]:
        """Of each line; `about` holds what the row says of its document (title, number, section), squeezed."""
        shapes = [_shape(x) for x in lines]
        times = Counter(s for s in shapes if s)
        number = [bool(x.strip()) and bool(PAGE_NUMBER.match(x)) for x in lines]
        filled = [i for i, x in enumerate(lines) if x.strip()]
        longest = max((len(lines[i].rstrip()) for i in filled), default=0)
        # The text lines before and after, with those that may be furniture passed over.
        names = [self._named(x, about) for x in lines]
        weak = [number[i] or times[shapes[i]] > 1 or names[i] for i in range(len(lines))]
        earlier, later = [""] * len(filled), [""] * len(filled)
        for place in range(1, len(filled)):
            i = filled[place - 1]
            earlier[place] = earlier[place - 1] if weak[i] else lines[i].rstrip()
        for place in range(len(filled) - 2, -1, -1):
            i = filled[place + 1]
            later[place] = later[place + 1] if weak[i] else lines[i].strip()
        # A list of short items has no text lines between which furniture could stand.
        listed = sum(len(lines[i].strip()) < 28 for i in filled) > 0.6 * len(filled)
        paged = (any(number), any(names))
        period = self._periods([weak[i] for i in filled])
        out: list[tuple] = [()] * len(lines)
        for place, i in enumerate(filled):
            line = lines[i].strip()
            before, after = earlier[place], later[place]
            open_before = bool(before) and before[-1] not in ".!?:;"
            runs_on = open_before and (after[:1].islower() or before[-1] in MARKS)
            near = any(number[j] for j in filled[max(0, place - 1) : place + 2] if j != i)
            repeated = min(3, times[shapes[i]])
            named = names[i]
            ends = line[-1] in ".!?,;:"
            split = line.split()
            capitals, low = line.isupper(), line[0].islower()
            titled = not low and not ends and len(split) < 16 and all(w[0].isupper() or not w[0].isalpha() or len(w) < 4 for w in split)
            words = min(6, len(split))
            digits = bool(re.match(r"[\d\[|–—-]|page\b", line, re.I)) or bool(re.search(r"\d[\]|]?$", line))
            bars = bool(re.search(r" [|*•·–—] |\s{2,}", line))
            out[i] = (
                ("number", number[i]), ("number", number[i], runs_on), ("number", number[i], repeated > 1), ("repeated", repeated), ("repeated", repeated, ends), ("repeated", repeated, runs_on), ("named", named), ("named", named, near), ("named", named, ends), ("named", named, titled or capitals, digits or bars),
                ("near", near, titled or capitals, ends), ("form", capitals, titled, digits, bars), ("ends", ends), ("words", words), ("runs on", runs_on, open_before), ("runs on", runs_on, ends, titled or capitals), ("full", len(lines[i].rstrip()) > 0.8 * longest, ends), ("first", place == 0, named), ("last", place == len(filled) - 1, number[i]),
                ("near", near, named, repeated > 1), ("runs on", runs_on, named, number[i]), ("listed", listed), ("listed", listed, number[i], repeated > 1), ("listed", listed, named), ("turn", runs_on or not open_before, repeated > 1, number[i], titled or capitals), ("low", low, number[i], repeated > 1), ("paged", paged, number[i], named, repeated > 1), ("paged", paged, near, runs_on), ("edge", place in (0, len(filled) - 1), repeated > 1, number[i]), ("period", period[place]), ("period", period[place], number[i], repeated > 1), ("period", period[place], runs_on, named), ("bias",),
            )
        return out

    @staticmethod
    def _periods(weak: list[bool]) -> list[int]:
        """Of each text line that may be furniture, how its place fits the pages: 3 if it is as far from the break before
        or after as those are from each other on the whole, 2 if not, 1 if there are too few breaks to tell; else 0."""
        starts = [k for k, w in enumerate(weak) if w and not (k and weak[k - 1])]
        gaps = [b - a for a, b in zip(starts, starts[1:])]
        usual = sorted(gaps)[len(gaps) // 2] if len(gaps) > 1 else None
        out, group = [0] * len(weak), -1
        for k, w in enumerate(weak):
            if w:
                group += not (k and weak[k - 1])
                mine = gaps[max(0, group - 1) : group + 1]
                out[k] = 1 if usual is None else 3 if any(abs(g - usual) <= 2 for g in mine) else 2
        return out

    @staticmethod
    def _named(line: str, about: tuple[str, ...]) -> bool:
        """Whether the line is mostly made of what the row says of its document."""
        squeezed = _squeeze(line)
        return any(len(a) > 3 and a in squeezed and len(a) >= 0.4 * len(squeezed) for a in about)

    @staticmethod
    def about(doc_id: str | None, title: str | None, path: str | None) -> tuple[str, ...]:
        sections = [re.sub(r"^[\d.]+\s+", "", p) for p in path.split(" > ")] if path else []
        return tuple(_squeeze(x) for x in (doc_id, title, *sections) if x and len(x) > 3)

    def train(self, rows: list[tuple], seed: int = 3) -> None:
        """On lines of sampled texts (text, doc_id, title, path), wrapped and broken into pages with furniture put between."""
        rng = random.Random(seed)
        model = AveragedPerceptron()
        cases = []
        for text, doc_id, title, path in rows:
            about = self.about(doc_id, title, path)
            lines = text.split("\n")
            cases.append((lines, [False] * len(lines), about))
            if rng.random() < 0.2:
                items = [rng.choice([doc_id or "X-1", f"{rng.choice('ABCDEF')}-{rng.randint(1, 60)}", str(rng.randint(1, 99)), *text.split()[:6], " ".join(text.split()[6:9])]) for _ in range(rng.randint(8, 60))]
                cases.append((items, [False] * len(items), about))
            elif rng.random() < 0.3:
                # What a web page repeats above and below its text is no furniture of printed pages.
                above, below = (rng.choice(["", "Back to start", "Share | Print | Store", "Start  Find  Log in", "Start | News | Contact", section_of(path)]) for _ in range(2))
                framed = [above, *lines, rng.choice([above, below])]
                cases.append((framed, [False] * len(framed), about))
            for _ in range(2):
                cases.append((*_paged(text, doc_id or "X-1", title or "A Title of Some Length", path, rng), about if rng.random() < 0.8 else ()))
        prepared = [(self.features(lines, about), gold) for lines, gold, about in cases]
        for _ in range(5):
            rng.shuffle(prepared)
            for features, gold in prepared:
                for f, is_furniture in zip(features, gold):
                    if not f:
                        continue
                    model.tick()
                    if (model.score(f) > 0) != is_furniture:
                        model.update(f if is_furniture else (), () if is_furniture else f)
        self.weights = model.averaged()

    def find(self, lines: list[str], about: tuple[str, ...]) -> list[bool]:
        get = self.weights.get
        return [bool(f) and sum(get(x, 0.0) for x in f) > 0 for f in self.features(lines, about)]


def section_of(path: str | None) -> str:
    return path.split(" > ")[-1].lstrip("0123456789. ") or "A Section" if path else "Some Section Name"


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


def _paged(text: str, doc_id: str, title: str, path: str | None, rng: random.Random) -> tuple[list[str], list[bool]]:
    """A text as if scanned: wrapped, with headers, footers and page numbers between its lines."""
    width = rng.randint(40, 75)
    body: list[str] = []
    for paragraph in text.split("\n\n"):
        line = ""
        for word in paragraph.split():
            if line and len(line) + len(word) >= width:
                if len(word) > 6 and rng.random() < 0.3:
                    cut = rng.randint(2, len(word) - 2)
                    body.append(f"{line} {word[:cut]}" + rng.choice(MARKS))
                    line = word[cut:]
                else:
                    body.append(line)
                    line = word
            else:
                line = f"{line} {word}".strip()
        body += [line, ""]
    section = section_of(path)
    n, total, letter = rng.randint(1, 60), rng.randint(60, 99), rng.choice("ABCDEF")
    number = rng.choice([lambda n: str(n), lambda n: f"Page {n}", lambda n: f"PAGE {n} OF {total}", lambda n: f"Page {n}/{total}", lambda n: f"- {n} -", lambda n: f"— {n} —", lambda n: f"[{n}]", lambda n: f"{n} |", lambda n: f"{letter}-{n}", lambda n: f"{n} of {total}", _roman])
    header = rng.choice([
        lambda n: f"{section} | {doc_id}", lambda n: f"{doc_id} — {' '.join(text.split()[:3])}", lambda n: title.upper(), lambda n: title, lambda n: f"Draft of 2020-{rng.randint(10, 12)}  *  {title}", lambda n: f"{doc_id}    {title}", lambda n: f"{title}    {n}",
        lambda n: f"APPENDIX {letter}    PAGE {letter}-{n}", lambda n: f"CHAPTER {rng.randint(1, 9)}    {section.upper()}", lambda n: f"{n}    {section}", lambda n: f"{doc_id}, {title}", lambda n: f"For official use only — {doc_id}",
    ])
    with_number, with_header = rng.choice([(True, True), (True, True), (True, False), (False, True)])
    lines: list[str] = []
    gold: list[bool] = []
    step, indent = rng.randint(5, 18), rng.choice([0, 0, 0, 6, 15])
    blank = rng.random() < 0.4
    if rng.random() < 0.3:
        # The text goes on to the end of its page.
        body = body[: max(step, len(body) // step * step)] + [""]
    for k, line in enumerate(body):
        if k and k % step == 0:
            furniture = [header(n)] * with_header + [number(n)] * with_number
            if rng.random() < 0.6:
                furniture.reverse()
            for f in furniture:
                if blank and rng.random() < 0.5:
                    lines.append("")
                    gold.append(False)
                lines.append(" " * indent + f)
                gold.append(True)
            n += 1
        lines.append(line)
        gold.append(False)
        if line and k > 3 and rng.random() < 0.03:
            # Text may come again too.
            lines.append(body[rng.randrange(k)])
            gold.append(False)
    return lines, gold


# --- all together --------------------------------------------------------------------------------------------------

#: Punctuation around a word. What may also be a misread letter is tried with and without.
_OPEN, _CLOSE = "(\"'“‘[{*•–—-", ".,;:?!)\"'”’]}*–—-"
_PLAIN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


class Repairer:
    """The three models and the lexicon, as every task uses them."""

    def __init__(self, words: Lexicon, editor: tuple[dict, dict, float], joiner: dict, furniture: dict) -> None:
        self.words = words
        self.editor = Editor(words, editor)
        self.joiner = Joiner(words, self.editor, joiner)
        self.furniture = Furniture(furniture)
        self.right: set[str] = set()
        self.wrong: dict[str, str] = {}
        self.asks: dict[str, frozenset[str]] = {}

    def word(self, token: str) -> str | None:
        """The token with its word put right, or None if nothing is wrong with it. Cached, as most tokens recur."""
        if token in self.right:
            return None
        if token in self.wrong:
            return self.wrong[token]
        if isinstance(self.words, AskingLexicon):
            if token in self.asks:
                self.words.asked |= self.asks[token]
                return None
            before = set(self.words.asked)
            self.words.asked.clear()
            found = self._word(token)
            mine = frozenset(self.words.asked)
            self.words.asked |= before
            if mine:
                if len(self.asks) > 100_000:
                    self.asks.clear()
                self.asks[token] = mine
                return None
        else:
            found = self._word(token)
        if found is None:
            if len(self.right) > 500_000:
                self.right.clear()
            self.right.add(token)
        else:
            if len(self.wrong) > 200_000:
                self.wrong.clear()
            self.wrong[token] = found
        return found

    def _word(self, token: str) -> str | None:
        core = token.lstrip(_OPEN).rstrip(_CLOSE)
        low = core.lower()
        if low in self.words.trusted or not any(c.isalpha() for c in token):
            return None
        if "-" in core or "/" in core:
            parts = re.split(r"([-/])", token)
            if len(parts) > 1 and all(len(p) != 1 or not p.isalnum() for p in parts[::2]):
                fixed = [self._word(p) if k % 2 == 0 and len(p) > 2 else None for k, p in enumerate(parts)]
                if isinstance(self.words, AskingLexicon) and self.words.asked:
                    # What a part would be is open, so all of them are asked for.
                    _ = [p.strip(_OPEN + _CLOSE).lower() in self.words.trusted for p in parts[::2]]
                if any(fixed) and sum(f is not None or not p or p.strip(_OPEN + _CLOSE).lower() in self.words.trusted for f, p in zip(fixed[::2], parts[::2])) == len(parts[::2]):
                    return "".join(f or p for f, p in zip(fixed, parts))
            return None
        ways = [core]
        start, end = len(token) - len(token.lstrip(_OPEN)), len(token.rstrip(_CLOSE))
        if start and token[start - 1] in "(":
            ways.append(token[start - 1 : end])
        if end < len(token) and token[end] in "!)":
            ways.append(token[start : end + 1])
        for way in ways:
            digits = sum(c.isdigit() for c in way)
            if len(way) < 2 or digits > max(1, len(way) // 3) or way.isupper() and digits:
                continue
            if len(way) < 4 and not any(c in _CONFUSED for c in way):
                continue
            better = self.editor.correct(way.lower())
            if better:
                at = token.index(way)
                better = better.capitalize() if way[0].isupper() else better
                return token[:at] + better + token[at + len(way) :]
        return None

    def analyse(self, text: str, doc_id: str | None, title: str | None, path: str | None, repair: bool) -> tuple[list[tuple[int, str]], str | None]:
        """The faults as (line number from 1, kind), and the repaired text if wanted; the same text if it has no faults."""
        unsure = set(text.split()) - self.right
        spoilt = {t for t in unsure if self.word(t) is not None}
        divided = "\n" in text and any(m in text for m in _DIVIDED)
        paged = self._may_have_furniture(text, doc_id, title, path)
        asking = isinstance(self.words, AskingLexicon)
        if not spoilt and not divided and not paged and not (asking and self.words.asked):
            return [], text
        lines = text.split("\n")
        furniture = self.furniture.find(lines, Furniture.about(doc_id, title, path)) if paged else [False] * len(lines)
        faults = [(i + 1, "furniture") for i, f in enumerate(furniture) if f]
        body = [i for i, x in enumerate(lines) if x.strip() and not furniture[i]]
        tokens = {i: lines[i].split() for i in body}
        glue: dict[int, str] = {}
        for i, j in zip(body, body[1:]):
            end = lines[i].rstrip()
            if end[-1] not in MARKS or len(end) < 2 or not end[-2].isalpha():
                continue
            m, n = _LAST.search(end[:-1]), _FIRST.match(tokens[j][0])
            if not m or not n:
                continue
            if asking:
                for between in ("", "-"):
                    self.word(tokens[i][-1][:-1] + between + tokens[j][0])
            if self.joiner.goes(m.group(0), n.group(0), end[-1], lines[i] != end):
                glue[i] = ""
                faults.append((i + 1, "broken_word"))
            else:
                glue[i] = "-"
        wrong = self._wrong(body, tokens, glue, repair)
        faults += [(i + 1, "wrong_char") for i in sorted(wrong)]
        if not faults:
            return [], text
        return faults, self._paragraphs(lines, body, tokens, glue, furniture) if repair else None

    def _wrong(self, body: list[int], tokens: dict[int, list[str]], glue: dict[int, str], repair: bool) -> set[int]:
        """The lines with a misread word. A divided word is judged whole; it counts for the line of its misread half."""
        wrong: set[int] = set()
        skip: dict[int, int] = {}
        for k, i in enumerate(body):
            words = tokens[i]
            for w in range(skip.get(i, 0), len(words)):
                token = words[w]
                if w == len(words) - 1 and i in glue and k + 1 < len(body):
                    j = body[k + 1]
                    head = token[:-1]
                    whole = head + glue[i] + tokens[j][0]
                    fixed = self.word(whole)
                    if fixed is not None:
                        first = next((n for n, (a, b) in enumerate(zip(whole, fixed)) if a != b), len(whole))
                        wrong.add(i if first < len(head) else j)
                        if repair:
                            # The whole word stands on the first line from now on.
                            tokens[i][w], tokens[j][0] = fixed + "\0", ""
                    skip[j] = 1
                    continue
                fixed = self.word(token)
                if fixed is not None:
                    wrong.add(i)
                    if repair:
                        words[w] = fixed
        return wrong

    def _may_have_furniture(self, text: str, doc_id: str | None, title: str | None, path: str | None) -> bool:
        """Whether a line may be furniture at all: it is a page number, names what the row tells of its document, speaks of
        a page, or comes again, with or without a number that changes."""
        if "\n" not in text:
            return False
        lines = [x for x in map(str.strip, text.split("\n")) if x]
        if any(len(x) < 40 and x[-1] in _NUMBER_ENDS and PAGE_NUMBER.match(x) for x in lines):
            return True
        low = text.lower()
        if (doc_id and doc_id.lower() in low) or (title and title.lower() in low) or "page " in low:
            return True
        short = [x for x in lines if len(x) < 90 and x[-1] not in ".!?,;:"]
        if len(short) != len(set(short)):
            return True
        for part in path.lower().split(" > ") if path else ():
            # A section's name above its text is its heading.
            name = part.lstrip("0123456789. ")
            if len(name) > 3 and name in low and any(name in x.lower() for x in short if x is not lines[0]):
                return True
        shapes = [_shape(x) for x in short if _DIGIT.search(x)]
        return len(shapes) != len(set(shapes))

    @staticmethod
    def _paragraphs(lines: list[str], body: list[int], tokens: dict[int, list[str]], glue: dict[int, str], furniture: list[bool]) -> str:
        """The text lines as paragraphs: a blank line ends one unless it belongs to a page break within a sentence."""
        paragraphs: list[str] = []
        # The pieces of the paragraph so far, with the spaces between them.
        now: list[str] = []
        for k, i in enumerate(body):
            line = " ".join(t for t in tokens[i] if t)
            if k:
                last = body[k - 1]
                between = range(last + 1, i)
                page = any(furniture[x] for x in between)
                blank = any(not lines[x].strip() for x in between)
                ended = bool(now) and now[-1].rstrip("\"'”’)").endswith((".", "!", "?", ":"))
                indented = lines[i][:1] in " \t" and lines[last][:1] not in " \t"
                listed = bool(re.match(r"\s*(?:[a-z]\.|\d+\.|[•*–-])\s", lines[i]))
                if last not in glue and (blank and (not page or ended) or ended and indented or listed and not page):
                    paragraphs.append("".join(now))
                    now = []
            if not now:
                now = [line]
            elif k and body[k - 1] in glue:
                whole = now[-1].endswith("\0")
                now[-1] = now[-1][:-1]
                now.append((f" {line}" if line else "") if whole else glue[body[k - 1]] + line)
            else:
                now.append(f" {line}")
        return "\n\n".join(p.replace("\0", "") for p in [*paragraphs, "".join(now)] if p)


_DIVIDED = tuple(f"{mark}{space}\n" for mark in MARKS for space in ("", " ", "  "))
_LAST = re.compile(r"[^\W\d_]*[^\s\W][^\s-]*$")
_FIRST = re.compile(r"[^\s-]*[^\s\W]")


def prepare(chunks: DataFrame, least_share: float = LEAST_SHARE) -> tuple[tuple[Lexicon, dict, dict, dict], DataFrame | None, float]:
    """Counts the words of all texts and trains the models: (what every task uses, table of rare words, their bound)."""
    words, rare, bound = all_words(chunks, least_share)
    editor = Editor(words)
    editor.train()
    joiner = Joiner(words, editor)
    joiner.train()
    rows = chunks.where("text IS NOT NULL AND length(text) BETWEEN 300 AND 20000").select("text", "doc_id", "doc_title", "section_path", F.xxhash64("row_no").alias("h")).orderBy("h", "text").limit(SAMPLE_ROWS).collect()
    furniture = Furniture()
    furniture.train([tuple(r)[:4] for r in rows if not scan_signs(r.text, set())])
    return (words, editor.trained(), joiner.weights, furniture.weights), rare, bound


def _with_models(chunks: DataFrame, schema: str, rows_of, least_share: float) -> DataFrame:
    """Most texts are settled by the frequent words alone. The others are kept with the words they ask for, which are
    joined to the counts of the rare words, and settled with those."""
    names = ["row_no", "text", "doc_id", "doc_title", "section_path"]
    needed = chunks.select(*names)
    context = chunks.sparkSession.sparkContext
    models, rare, bound = prepare(needed, least_share)
    shared = context.broadcast(models)
    texts = needed.where("text IS NOT NULL")

    def start():
        repairer = Repairer(*shared.value)
        return lambda *values: rows_of(repairer, *values)

    if rare is None:
        return map_rows(texts, schema, start)
    maps = context.broadcast(Bitmaps(rare))
    kinds = needed.schema
    columns = [x.split()[0] for x in schema.split(", ")]

    def start_asking():
        words, *weights = shared.value
        asking = AskingLexicon(words, maps.value, bound)
        repairer = Repairer(asking, *weights)

        def run(*values):
            asking.asked.clear()
            rows = rows_of(repairer, *values)
            if asking.asked:
                return [(*[None] * len(columns), sorted(asking.asked), *values)]
            return [(*row, None, *[None] * len(names)) for row in rows]

        return run

    asked_schema = ", ".join([schema, "asked array<string>", *(f"in_{n} {kinds[n].dataType.simpleString()}" for n in names)])
    first = stored(map_rows(texts, asked_schema, start_asking), "settled")
    open_ones = first.where("asked IS NOT NULL").select("asked", *(F.col(f"in_{n}").alias(n) for n in names)).withColumn("key", F.sha2("text", 256))
    wanted = open_ones.select("key", F.explode("asked").alias("word")).distinct().join(rare, "word")
    extra = wanted.groupBy("key").agg(F.collect_list(F.struct("word", "n", "scanned")).alias("extra"))

    def start_again():
        words, *weights = shared.value
        # Of its own, as other tasks of this process may use the shared one.
        mine = Lexicon([])
        mine.count, mine.trusted, mine.sorted, mine.longest = dict(words.count), set(words.trusted), words.sorted, words.longest
        repairer = Repairer(mine, *weights)

        def run(rare_words, *values):
            mine.add([(r["word"], r["n"], r["scanned"]) for r in rare_words or ()])
            return rows_of(repairer, *values)

        return run

    again = map_rows(open_ones.join(extra, "key", "left").select("extra", *names), schema, start_again)
    return first.where("asked IS NULL").select(*columns).unionByName(again)


def faults(chunks: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """row_no, line_no (from 1), fault: furniture, broken_word or wrong_char; each fault of a line once.

    Null, blank and empty texts have none. Rows that occur twice have their faults twice. doc_id, doc_title and
    section_path only help to know headers and may be null; other columns are ignored. Texts are read whole.
    """

    def rows_of(repairer: Repairer, row_no: int, text: str, doc_id, title, path):
        return [(row_no, line, fault) for line, fault in repairer.analyse(text, doc_id, title, path, repair=False)[0]]

    return _with_models(chunks, "row_no bigint, line_no int, fault string", rows_of, least_share)


def repaired(chunks: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """row_no, text, faults (their number): every text, those with faults as continuous paragraphs, the others as they are."""

    def rows_of(repairer: Repairer, row_no: int, text: str, doc_id, title, path):
        found, better = repairer.analyse(text, doc_id, title, path, repair=True)
        return [(row_no, better, len(found))]

    return _with_models(chunks, "row_no bigint, text string, faults int", rows_of, least_share)
