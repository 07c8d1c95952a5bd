"""Problem 6: passages of held-out test items inside training documents.

1. The items are cut into segments, and these put into blocks of bounded size, for each of which a generalised suffix
   automaton can be built in one task. Any number of items makes so many blocks.
2. Every document is streamed once, whatever the number of blocks: runs of its words are looked for whose windows of
   twelve words are marked in a bitmap of the items' windows. What is not marked is in no item. Documents are not
   shuffled; only the few marked runs leave their task.
3. Marked runs meet the automata of the blocks that hold one of their windows, and are streamed through them: that
   gives the exact matching lengths and items. A block with many runs is split over tasks.
4. To cut the passages out, documents without any pass by a bitmap; only the others meet their spans in a join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows
from quern.llm.marks import Marks, met
from quern.session import stored

#: A word is an unbroken run of letters and digits.
WORD = re.compile(r"[^\W_]+")
MIN_WORDS = 12
#: Words of items in one automaton, of about 700 bytes each.
BLOCK_WORDS = 200_000
#: Words of marked runs that one task streams through an automaton.
PART_WORDS = 2_000_000


def words(text: str | None) -> list[str]:
    """The words of a text in lower case; each for itself where lower-casing the whole would move places."""
    if not text:
        return []
    low = text.lower()
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


class SuffixAutomaton:
    """A suffix automaton of several word sequences.

    step[s] maps a word to the next state, link[s] is the suffix link, length[s] the longest string of the state.
    home[s] is the ancestor whose strings include the last `least` words of a match in s, and items[home] are the
    sequences that hold them.
    """

    def __init__(self, sequences: list[tuple[int, list[str]]], least: int = MIN_WORDS) -> None:
        self.least = least
        self.step: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        for item, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word, ends)
                ends[last].add(item)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[state]] >= least:
                ends[self.link[state]] |= ends[state]
        self.home = [-1] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            if self.length[state] >= least:
                up = self.link[state]
                self.home[state] = state if self.length[up] < least else self.home[up]
        self.items = {s: tuple(sorted(ends[s])) for s in set(self.home) if s >= 0}
        self.known = frozenset(self.step[0])

    def _new(self, length: int, ends: list[set[int]]) -> int:
        self.step.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.step) - 1

    def _extend(self, last: int, word: str, ends: list[set[int]]) -> int:
        there = self.step[last].get(word)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._clone(last, there, word, ends)
        state = self._new(self.length[last] + 1, ends)
        at = last
        while at != -1 and word not in self.step[at]:
            self.step[at][word] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            there = self.step[at][word]
            self.link[state] = there if self.length[there] == self.length[at] + 1 else self._clone(at, there, word, ends)
        return state

    def _clone(self, at: int, there: int, word: str, ends: list[set[int]]) -> int:
        """Splits from `there` the strings that end in `word` after those of `at`; end marks reach it over the links."""
        copy = self._new(self.length[at] + 1, ends)
        self.step[copy] = dict(self.step[there])
        self.link[copy], self.link[there] = self.link[there], copy
        while at != -1 and self.step[at].get(word) == there:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def matches(self, tokens: list[str]) -> Iterator[tuple[int, int, int]]:
        """(end position, matching length, state) for every position at which at least `least` words match."""
        least, known, step, link, length = self.least, self.known, self.step, self.link, self.length
        n, done = len(tokens), 0
        # Every run of `least` words covers a position of this stride; if its word is in no item, the run is none.
        for anchor in range(least - 1, n, least):
            if anchor < done or tokens[anchor] not in known:
                continue
            start, floor = anchor, max(done, anchor - least + 1)
            while start > floor and tokens[start - 1] in known:
                start -= 1
            end = anchor + 1
            while end < n and end - start < least and tokens[end] in known:
                end += 1
            if end - start < least:
                continue
            # Streams from here until an unknown word ends the run.
            state = matched = 0
            at = start
            while at < n:
                word = tokens[at]
                if word not in known:
                    break
                while state and word not in step[state]:
                    state = link[state]
                    matched = length[state]
                state = step[state].get(word, 0)
                matched = matched + 1 if state else 0
                if matched >= least:
                    yield at, matched, state
                at += 1
            done = at


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def segments(items: DataFrame, least: int, block_words: int) -> DataFrame:
    """item_id, text, words, block: the items as runs of words of bounded length, in blocks.

    A longer item is cut into several segments that share `least` - 1 words, so that none of its windows is lost.
    """

    def start():
        def cut(item_id: int, text: str) -> list[tuple]:
            tokens = words(text)
            step = max(block_words - least + 1, least)
            return [(item_id, " ".join(part), len(part)) for at in range(0, max(len(tokens) - least + 1, 0), step) if len(part := tokens[at : at + step + least - 1]) >= least]

        return cut

    rows = items.where("item_text IS NOT NULL AND item_id IS NOT NULL").select("item_id", F.col("item_text").alias("text")).distinct()
    cut = stored(map_rows(rows, "item_id bigint, text string, words bigint", start), "segments")
    total = cut.agg(F.sum("words")).first()[0] or 0
    return cut.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-total // block_words)))).cast("int"))


def windows(cut: DataFrame, least: int) -> DataFrame:
    """window, block: the hash of every window of `least` words of the items."""

    def start():
        def hashes(block: int, text: str) -> list[tuple]:
            tokens = text.split(" ")
            return [(_hash(" ".join(tokens[i : i + least])), block) for i in range(len(tokens) - least + 1)]

        return hashes

    return map_rows(cut.select("block", "text"), "window bigint, block int", start).distinct()


RUNS = "row bigint, doc_id bigint, first int, text string, words int, windows array<bigint>"


def marked_runs(texts: DataFrame, cut: DataFrame, of_items: DataFrame, least: int) -> DataFrame:
    """The runs of words of every document (row, doc_id, text) all of whose windows are marked."""

    def start_words():
        return lambda text: [(_hash(word),) for word in set(text.split(" "))]

    known_marks = Marks(stored(map_rows(cut.select("text"), "h bigint", start_words).distinct(), "item-words"), "h")
    window_marks = Marks(of_items.select("window").distinct(), "window")
    shared = texts.sparkSession.sparkContext.broadcast(((known_marks.bits, known_marks.array()), (window_marks.bits, window_marks.array())))

    def start():
        (word_bits, word_table), (bits, table) = shared.value
        # Plain integers are faster to look up one by one.
        word_table, table = word_table.tolist() if word_bits < 16 else word_table, table.tolist() if bits < 16 else table
        digest = xxhash.xxh64_intdigest
        cache: dict[str, bool] = {}

        def known(word: str) -> bool:
            found = cache.get(word)
            if found is None:
                if len(cache) > 500_000:
                    cache.clear()
                h = digest(word)
                found = cache[word] = bool(int(word_table[h >> (64 - word_bits)]) >> (h & 63) & 1)
            return found

        def find(row: int, doc_id: int | None, text: str) -> list[tuple]:
            tokens = words(text)
            n, done, out = len(tokens), 0, []
            # Every run of `least` words covers a position of this stride; if its word is in no item, the run is none.
            for anchor in range(least - 1, n, least):
                if anchor < done or not known(tokens[anchor]):
                    continue
                start, floor = anchor, max(done, anchor - least + 1)
                while start > floor and known(tokens[start - 1]):
                    start -= 1
                end = anchor + 1
                while end < n and known(tokens[end]):
                    end += 1
                done = end
                run: list[int] = []
                for at in range(start, end - least + 1):
                    h = digest(" ".join(tokens[at : at + least]))
                    if int(table[h >> (64 - bits)]) >> (h & 63) & 1:
                        run.append(h - (1 << 64) if h >> 63 else h)
                    elif run:
                        out.append((row, doc_id, at - len(run), " ".join(tokens[at - len(run) : at + least - 1]), len(run) + least - 1, run))
                        run = []
                if run:
                    first = end - least + 1 - len(run)
                    out.append((row, doc_id, first, " ".join(tokens[first:end]), end - first, run))
            return out

        return find

    return map_rows(texts, RUNS, start)


SPANS = "row bigint, doc_id bigint, item_id bigint, first int, last int"


def spans(texts: DataFrame, items: DataFrame, least: int = MIN_WORDS, block_words: int = BLOCK_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """row, doc_id, item_id, first, last: the longest runs of words that a document (row, doc_id, text) shares with an item."""
    cut = segments(items, least, block_words)
    of_items = stored(windows(cut, least), "windows")
    runs = stored(marked_runs(texts, cut, of_items, least), "runs")
    routes = runs.select("row", "first", F.explode("windows").alias("window")).join(of_items, "window").select("row", "first", "block").distinct()
    routed = stored(runs.select("row", "doc_id", "first", "text", "words").join(routes, ["row", "first"]), "routed")
    parts = routed.groupBy("block").agg((F.lit(1) + F.floor(F.sum("words") / part_words)).cast("int").alias("parts"))
    streams = routed.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("row", "first"), F.col("parts")).cast("int"))
    copies = cut.join(parts, "block").select("block", "item_id", "text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def search(documents, held):
        import pandas as pd

        automaton = SuffixAutomaton(list(zip(held["item_id"].tolist(), (t.split(" ") for t in held["text"]))), least)
        out: list[tuple] = []
        for row, doc_id, first, text in zip(documents["row"], documents["doc_id"], documents["first"], documents["text"]):
            hits: dict[int, list[list[int]]] = {}
            for end, _, state in automaton.matches(text.split(" ")):
                for item in automaton.items[automaton.home[state]]:
                    mine = hits.setdefault(item, [])
                    # Positions come one after the other; those of one match grow its span.
                    if mine and mine[-1][1] == end - 1:
                        mine[-1][1] = end
                    else:
                        mine.append([end - least + 1, end])
            out += [(row, doc_id, item, first + a, first + b) for item, found in hits.items() for a, b in found]
        frame = pd.DataFrame(out, columns=["row", "doc_id", "item_id", "first", "last"], dtype=object)
        return frame.astype({"row": "int64", "doc_id": "Int64", "item_id": "int64", "first": "int32", "last": "int32"})

    left = streams.select("block", "part", "row", "doc_id", "first", "text").groupBy("block", "part")
    return left.cogroup(copies.groupBy("block", "part")).applyInPandas(search, SPANS)


def merged(found: DataFrame, key: list[str]) -> DataFrame:
    """Spans of each key that overlap as one: key, words (how many they cover), spans in order.

    What is gathered is bounded by the words of one document.
    """
    gathered = found.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("l"))
    start = F.array().cast("array<struct<first:int,last:int>>")

    def join(done, x):
        n, top = F.size(done), F.get(done, F.size(done) - 1)
        grown = F.array_append(F.slice(done, 1, F.greatest(n - 1, F.lit(0))), F.struct(top["first"].alias("first"), F.greatest(top["last"], x["last"]).alias("last")))
        return F.when((n > 0) & (x["first"] <= top["last"] + 1), grown).otherwise(F.array_append(done, x))

    one = gathered.withColumn("spans", F.aggregate("l", start, join)).drop("l")
    return one.withColumn("words", F.aggregate("spans", F.lit(0), lambda n, x: n + x["last"] - x["first"] + 1))


def leaks(documents: DataFrame, items: DataFrame, least: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document and item that share at least `least` consecutive words.

    words: how many of the document's words lie in such passages; spans: their first and last word, from 0.
    Null, empty or short texts match nothing; items of fewer than `least` words cannot leak; a document that comes
    twice gives its rows twice, an item that comes twice under one id counts once. Other columns are ignored.
    """
    texts = documents.where(F.col("text").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = merged(spans(texts, items, least, block_words), ["row", "doc_id", "item_id"])
    return found.select("doc_id", "item_id", "words", "spans")


CLEAN = "doc_id bigint, text string, removed_words int, total_words int, coverage double, verdict string"


def without_leaks(documents: DataFrame, items: DataFrame, least: int = MIN_WORDS, max_span: int = MIN_WORDS, max_coverage: float = 0.3, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every document with the passages cut out that match more than `max_span` - 1 words of an item.

    verdict: `clean` if nothing matched, `cut` if passages were removed, `dropped` (and text null) if they cover more
    than `max_coverage` of the words. Null texts stay null and are `clean`. Removal never touches other words.
    Rows that share a doc_id are each judged by their own text.
    """
    # Rows of one doc_id and one text have the same spans, so both name the row.
    none = F.lit(-(2**63)).cast("bigint")
    named = documents.select("doc_id", "text", F.coalesce("doc_id", none).alias("_id"), F.xxhash64("text").alias("_print"))
    keyed = named.where("text IS NOT NULL").select(F.col("_print").alias("row"), F.col("_id").alias("doc_id"), "text")
    whole = merged(spans(keyed, items, least, block_words), ["doc_id", "row"]).select(F.col("doc_id").alias("_id"), F.col("row").alias("_print"), "spans")
    whole = stored(whole.withColumn("spans", F.filter("spans", lambda s: s["last"] - s["first"] + 1 >= max_span)).where(F.size("spans") > 0), "spans")
    untouched, touched = met(named, ["_id", "_print"], whole)

    def start():
        def cut(doc_id: int, text: str, gaps: list) -> list[tuple]:
            places = [m.span() for m in WORD.finditer(text)]
            gone = sum(s["last"] - s["first"] + 1 for s in gaps)
            coverage = gone / len(places)
            if coverage > max_coverage:
                return [(doc_id, None, gone, len(places), coverage, "dropped")]
            kept, at = [], 0
            for s in gaps:
                kept.append(text[at : places[s["first"]][0]])
                at = places[s["last"]][1]
            kept.append(text[at:])
            return [(doc_id, "".join(kept), gone, len(places), coverage, "cut")]

        return cut

    words_of = F.coalesce(F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")), F.lit(0)).cast("int")
    clean = untouched.select("doc_id", "text").unionByName(touched.where("spans IS NULL").select("doc_id", "text"))
    clean = clean.select("doc_id", "text", F.lit(0).alias("removed_words"), words_of.alias("total_words"), F.lit(0.0).alias("coverage"), F.lit("clean").alias("verdict"))
    return clean.unionByName(map_rows(touched.where("spans IS NOT NULL").select("doc_id", "text", "spans"), CLEAN, start))
