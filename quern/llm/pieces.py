"""Problem 3: cutting oversized texts at natural boundaries, with an overlap between consecutive pieces.

A dynamic programme over boundary positions minimises the penalties of the cuts plus the imbalance of the piece
sizes, with every piece within the limit and every two neighbours sharing exactly the overlap. The same programme,
confined to paragraph ends, then to paragraph and sentence ends, tells at what a text can be cut at all. Only oversized
rows leave the JVM; the limits are a small table whose size is checked before it is broadcast.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows

#: Separators of paragraphs: line ends with nothing but space between them.
BLANK_LINES = re.compile(r"\n(?:[^\S\n]*\n)+")
#: A sentence ends at one of these marks if white space follows.
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
LINE_END = re.compile(r"\n")
CLAUSE_END = re.compile(r"(?<=[,;:|)\]])\s+")
SPACE = re.compile(r"\s+")

#: Penalty of a cut by kind; one unit is a piece whose size is off the mean by the whole limit.
PENALTY = {"paragraph": 0.0, "line": 0.6, "sentence": 1.0, "clause": 3.0, "word": 6.0, "character": 50.0}
IMBALANCE = 4.0
MAX_LIMITS = 10_000


#: Kinds of boundaries from the coarsest to the finest, each with its pattern.
KINDS = (("paragraph", BLANK_LINES), ("line", LINE_END), ("sentence", SENTENCE_END), ("clause", CLAUSE_END), ("word", SPACE))


def positions(text: str, kinds: tuple[str, ...], grid: int = 0) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Every place where the text may be cut (after the white space of a boundary), from 0 to its end; the penalty of
    each, and its kind, the coarsest that ends there.

    With `grid` a stretch longer than twice that without any boundary may be cut at every so many characters.
    """
    best: dict[int, str] = {}
    for kind, pattern in reversed(KINDS):
        if kind in kinds:
            for m in pattern.finditer(text):
                best[m.end()] = kind
    best.pop(len(text), None)
    best.pop(0, None)
    if grid:
        places = [0, *sorted(best), len(text)]
        for a, b in zip(places, places[1:]):
            for at in range(a + grid, b - grid if b - a > 2 * grid else a, grid):
                best[at] = "character"
    found = sorted(best)
    at = np.array([0, *found, len(text)], dtype=np.int64)
    return at, np.array([0.0, *(PENALTY[best[p]] for p in found), 0.0]), ["start", *(best[p] for p in found), "end"]


def least_cost(at: np.ndarray, penalty: np.ndarray, begins: np.ndarray, ends: np.ndarray, limit: int, mean: float) -> tuple[list[int], float] | None:
    """The cheapest way from the first position to the last whose pieces are within the limit, as places in `at`, and what
    it costs; None if there is no way.

    A piece between positions i and j has the size ends[j] - begins[i]; both rise. Its cost is the penalty at j and the
    square of its distance from the mean size, in limits.
    """
    n = len(at)
    cost, back = np.full(n, np.inf), np.full(n, -1, dtype=np.int64)
    cost[0] = 0.0
    firsts = np.searchsorted(begins, ends - limit).tolist()
    off, upto = (begins + mean) / limit, (ends / limit).tolist()
    for j in range(1, n):
        i = firsts[j]
        if i >= j:
            continue
        value = cost[i:j] + IMBALANCE * (upto[j] - off[i:j]) ** 2
        best = int(value.argmin())
        # After a cut within the first overlap the next piece would not start later than the first.
        if value[best] < np.inf and (begins[j] > 0 or j == n - 1):
            back[j], cost[j] = i + best, value[best] + penalty[j]
    if back[-1] < 0:
        return None
    way, j = [], n - 1
    while j > 0:
        way.append(j)
        j = int(back[j])
    return way[::-1], float(cost[-1])


def boundary(text: str, limit: int) -> str:
    """`paragraph` if the programme finds a way over paragraph ends alone, else `sentence` if it does over paragraph and
    sentence ends, else `none`. White space at the ends of a piece does not count here, and nothing overlaps.
    """
    for level in ("paragraph", "sentence"):
        at, penalty, _ = positions(text, ("paragraph", level))
        # A piece goes from the first sign after a cut to the last before the next one.
        begins = np.array([p + len(t) - len(t.lstrip()) for p, t in zip(at[:-1].tolist(), (text[a:b] for a, b in zip(at, at[1:])))] + [len(text)], dtype=np.int64)
        ends = np.array([0] + [p - len(t) + len(t.rstrip()) for p, t in zip(at[1:].tolist(), (text[a:b] for a, b in zip(at, at[1:])))], dtype=np.int64)
        # Stretches of nothing but white space take no room.
        ends = np.maximum.accumulate(ends)
        begins = np.minimum.accumulate(begins[::-1])[::-1]
        mean = len(text) / max(1, -(-len(text) // limit))
        if _way_within(at, penalty, begins, ends, limit, mean):
            return level
    return "none"


def _way_within(at, penalty, begins, ends, limit, mean) -> bool:
    # Only the start of the first piece may be at 0, so positions are moved by one for the programme.
    return least_cost(at, penalty, begins + 1, ends + 1, limit, mean) is not None


def cut(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """The pieces as (start, end, kind of the cut at the end); neighbours share exactly `overlap` characters.

    The overlap is at most limit - 1 (it is cut to that), so that every piece goes on. A text within the limit is
    one piece; an empty one too. Of all ways over all boundaries the cheapest is taken; only within stretches longer
    than a piece's room that hold no boundary at all, where every place is as good, a grid of places is looked at.
    """
    limit = max(1, limit)
    overlap = min(max(0, overlap), limit - 1)
    size = len(text)
    if size <= limit:
        return [(0, size, "end")]
    room = limit - overlap
    count = -(-(size - overlap) // room)
    mean = (size + (count - 1) * overlap) / count
    # A way over the coarser kinds that costs no more than one cut of the next finer kind is the cheapest of all.
    for kinds, next_finer, grid in ((("paragraph", "line", "sentence"), "clause", 0), (("paragraph", "line", "sentence", "clause"), "word", 0), (tuple(PENALTY)[:-1], None, max(1, room // 2))):
        at, penalty, names = positions(text, kinds, grid)
        # Where a piece that follows a cut starts; none may start before the text.
        begins = at - overlap
        begins[0] = 0
        found = least_cost(at, penalty, np.maximum.accumulate(np.maximum(begins, 0)), at, limit, mean)
        if found and (next_finer is None or found[1] <= PENALTY[next_finer]):
            way = found[0]
            froms = [0, *way[:-1]]
            return [(int(begins[i]), int(at[j]), names[j]) for i, j in zip(froms, way)]
    # Only if a boundary lies within the first overlap alone; even steps always work.
    starts = list(range(0, size - overlap, room))
    return [(s, min(size, s + limit), "character" if s + limit < size else "end") for s in starts]


PIECES = "row_no bigint, boundary string, piece int, pieces int, first_char int, cut string, text string, section_path string"


def oversized(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """The rows above the limit of their chunk_type, with it. Types without a limit have none.

    Of several limits of one type the smallest counts, with its smallest overlap; null limits are none, a null or
    negative overlap is 0.
    """
    smallest = limits.where("chunk_type IS NOT NULL AND max_chars > 0").groupBy("chunk_type").agg(F.min(F.struct("max_chars", F.greatest(F.coalesce("overlap_chars", F.lit(0)), F.lit(0)).alias("overlap"))).alias("limit"))
    if smallest.count() > MAX_LIMITS:
        raise ValueError(f"more than {MAX_LIMITS} chunk types have limits; they are meant to be a small table")
    joined = chunks.select("row_no", "text", "section_path", "chunk_type").join(F.broadcast(smallest), "chunk_type")
    return joined.where(F.length("text") > F.col("limit.max_chars")).select("row_no", "text", "section_path", F.col("limit.max_chars").alias("max_chars"), F.col("limit.overlap").alias("overlap"))


def pieces(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """The pieces of every oversized chunk, in order.

    boundary says at what the whole text could be cut, cut at what this piece ends; first_char is its place in the
    text (in code points, from 0). section_path gets " (part n of m)", which alone stands where it was null or
    blank. Null and empty texts are never oversized; repeated rows are cut alike; other columns are ignored.
    """

    def start():
        def split(row_no: int, text: str, path: str | None, limit: int, overlap: int) -> list[tuple]:
            way = cut(text, limit, overlap)
            kind = boundary(text, limit)
            base = f"{path} " if path and path.strip() else ""
            return [(row_no, kind, k + 1, len(way), a, how, text[a:b], f"{base}(part {k + 1} of {len(way)})") for k, (a, b, how) in enumerate(way)]

        return split

    return map_rows(oversized(chunks, limits), PIECES, start)
