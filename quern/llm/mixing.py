"""Problem 7: mixing sources to target weights.

1. Every document is encoded once, and its tokens stored. The documents of a source, in a pseudorandom order, form one
   long row of tokens, which is cut into blocks of a fixed length (the last one of a source may be shorter). Places in
   that row come from running sums within many buckets of a source, so that a source with a third of all documents is
   spread over as many tasks.
2. How many tokens each source gives is fixed by its share; it is at most max_repeats times its tokens. So many blocks
   are taken, the last one cut, that the share is met to the token.
3. The mixture is a sequence of slots in output shards. Every shard draws how many of its slots each source fills from
   the multinomial law, given the totals: the shards are halved again and again, and at each halving the counts of the
   left half are drawn without replacement. So every shard finds its own counts, and what came before it, alone.
4. The k-th slot of a source holds block p(k mod n) of repeat k div n, with p a pseudorandom permutation of its full
   blocks for each repeat; its shorter block ends each repeat. Slots and blocks are joined by source and index, a key
   that occurs at most max_repeats times. The permutation can be turned round, so tokens of blocks that fill no slot
   never leave their task.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows
from quern.llm.marks import Marks
from quern.session import stored

#: A public vocabulary and the pattern by which its texts are split (fixed value).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_TOKENS = 256
SHARD_SLOTS = 1024
#: Parts of a source in which places are counted; one part is one task's share at most.
BUCKETS = 1024
#: Bound of the table of targets, which is collected and broadcast.
MAX_SOURCES = 10_000
#: Above so many slots a halving is proportional; chance would move it by less than 1 in 30,000.
_EXACT = 900_000_000


_encodings: dict[bytes, tiktoken.Encoding] = {}


def _encoding(ranks: bytes) -> tiktoken.Encoding:
    """The tokenizer of a vocabulary file's content; one is kept in each process."""
    if ranks not in _encodings:
        _encodings.clear()
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        _encodings[ranks] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encodings[ranks]


def tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        return _encoding(file.read())


def _shipped(spark: SparkSession, path: str) -> Callable[[], tiktoken.Encoding]:
    """The vocabulary, read on the driver and sent to the executors; its size is that of a vocabulary, a few MB."""
    with open(path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    return lambda: _encoding(shared.value)


def plain_source(source: Column) -> Column:
    """A source's plain spelling: lower case, words joined by one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(source), r"(?U)^[\s_-]+|[\s_-]+$", ""), r"(?U)[\s_-]+", "_")


def clean_targets(targets: DataFrame) -> DataFrame:
    """One row for each plain source with a positive share: source, target_share (they sum to 1), max_repeats (1 at least).

    Several rows of one source add up their shares, and the smallest max_repeats counts; a null one counts as 1.
    """
    rows = targets.where("source IS NOT NULL AND target_share > 0").groupBy(plain_source(F.col("source")).alias("source"))
    summed = rows.agg(F.sum("target_share").alias("target_share"), F.greatest(F.min(F.coalesce("max_repeats", F.lit(1))), F.lit(1)).alias("max_repeats"))
    if summed.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources have targets; they are meant to be a small table")
    return summed


def encoded(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """row, doc_id, source, tokens (their number) and ids of every document of a wanted source that has any. Stored, so
    that row stays its name."""
    get = _shipped(documents.sparkSession, vocabulary)

    def start():
        encode = get().encode_ordinary

        def tokens(row: int, doc_id: int, source: str, text: str) -> list[tuple]:
            ids = encode(text)
            return [(row, doc_id, source, len(ids), ids)] if ids else []

        return tokens

    rows = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), "doc_id", plain_source(F.col("source")).alias("source"), "text")
    wanted = rows.join(F.broadcast(targets.select("source")), "source", "left_semi").select("row", "doc_id", "source", "text")
    return stored(map_rows(wanted, "row bigint, doc_id bigint, source string, tokens bigint, ids array<int>", start), "tokens")


def placed(sizes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Each document (row, doc_id, source, tokens) with its first place in the row of tokens of its source."""
    rows = sizes.select("row", "doc_id", "source", "tokens").withColumn("order", F.xxhash64("doc_id", F.lit(7))).withColumn("bucket", F.pmod("order", F.lit(buckets)))
    sums = rows.groupBy("source", "bucket").agg(F.sum("tokens").alias("in_bucket"))
    before = sums.withColumn("before", F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket")) - F.col("in_bucket"))
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "tokens", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.withColumn("within", F.sum("tokens").over(within) - F.col("tokens"))
    # At most `buckets` rows of each of at most MAX_SOURCES sources.
    joined = running.join(before.select("source", "bucket", "before"), ["source", "bucket"])
    return joined.select("row", "doc_id", "source", "tokens", (F.col("before") + F.col("within")).alias("place"))


def plan(targets: list[dict], available: dict[str, int], block_tokens: int = BLOCK_TOKENS, total_tokens: int | None = None) -> list[dict]:
    """What each source has and gives: the largest mixture in which every source that has documents keeps its share.

    available, blocks: what it has; wanted: the tokens it gives; slots: the blocks they fill; last: the tokens taken of
    the last one. Sources without documents give nothing; the shares of the others are scaled up to sum to 1. With
    `total_tokens` the mixture is that large, or as large as can be.
    """
    present = [dict(t, available=(n := available.get(t["source"], 0)), blocks=-(-n // block_tokens)) for t in sorted(targets, key=lambda t: t["source"])]
    whole = sum(t["target_share"] for t in present if t["blocks"])
    tokens = min((t["available"] * t["max_repeats"] * whole / t["target_share"] for t in present if t["blocks"]), default=0)
    if total_tokens is not None:
        tokens = min(tokens, total_tokens)
    for t in present:
        t["wanted"] = min(round(tokens * t["target_share"] / whole), t["available"] * t["max_repeats"]) if t["blocks"] else 0
        repeats, rest = divmod(t["wanted"], t["available"]) if t["blocks"] else (0, 0)
        # Within a repeat the full blocks come first, so the first k blocks hold k full blocks' tokens.
        more = -(-rest // block_tokens)
        t["slots"] = repeats * t["blocks"] + more
        t["last"] = rest - (more - 1) * block_tokens if more else (t["available"] - 1) % block_tokens + 1
    return present


def shard_counts(totals: np.ndarray, shard: int, shards: int, shard_slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source in this shard, slots of each in all shards before it)."""
    size = int(totals.sum())
    low, high, counts, before = 0, shards, totals.astype(np.int64), np.zeros(len(totals), dtype=np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left = min(middle * shard_slots, size) - low * shard_slots
        all_here = int(counts.sum())
        if all_here < _EXACT:
            part = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(counts, left, method="marginals")
        else:
            share = counts.astype(object) * left
            part = np.array([x // all_here for x in share], dtype=np.int64)
            rest = np.array([x % all_here for x in share], dtype=object)
            for i in sorted(range(len(rest)), key=lambda i: (-rest[i], i))[: left - int(part.sum())]:
                part[i] += 1
        if shard < middle:
            high, counts = middle, part
        else:
            low, counts, before = middle, counts - part, before + part
    return counts, before


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The places of indices under a pseudorandom permutation of range(n): a Feistel network, walked until inside.

    With `back` the indices of places: the permutation turned round.
    """
    if n <= 1:
        return index.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def mixed(x: np.ndarray, r: int) -> np.ndarray:
        h = x + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return h & mask

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for r in reversed(range(6)) if back else range(6):
            left, right = (right ^ mixed(left, r), left) if back else (right, left ^ mixed(right, r))
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = once(index.astype(np.uint64))
        while (outside := out >= np.uint64(n)).any():
            out[outside] = once(out[outside])
    return out.astype(np.int64)


def _key(seed: int, source: int, repeat: int) -> int:
    return (seed * 1_000_003 + source) * 1_000_003 + repeat


def used(blocks: np.ndarray, planned: dict, source: int, block_tokens: int, seed: int) -> np.ndarray:
    """Which blocks of a source fill a slot at all."""
    if planned["slots"] >= planned["blocks"]:
        return np.ones(len(blocks), dtype=bool)
    # Less than one repeat: the shorter block has no turn, and a full one only if its place comes early enough.
    full = planned["available"] // block_tokens
    inside = blocks < full
    out = np.zeros(len(blocks), dtype=bool)
    out[inside] = permuted(blocks[inside], full, _key(seed, source, 0), back=True) < planned["slots"]
    return out


SLOTS = "shard bigint, slot int, source string, repeat int, block bigint, take int"


def slots(spark, planned: list[dict], block_tokens: int = BLOCK_TOKENS, shard_slots: int = SHARD_SLOTS, seed: int = 42) -> DataFrame:
    """Every slot of the mixture: which block of which source fills it, for the how many-th time (from 1), and the tokens taken."""
    totals = np.array([t["slots"] for t in planned], dtype=np.int64)
    shards = -(-int(totals.sum()) // shard_slots)

    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts, before = shard_counts(totals, shard, shards, shard_slots, seed)
                which = np.repeat(np.arange(len(planned)), counts)
                rank = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts)]) if len(which) else np.zeros(0, dtype=np.int64)
                repeat, block, take = (np.zeros(len(which), dtype=np.int64) for _ in range(3))
                for s in np.unique(which):
                    mine, about = which == s, planned[s]
                    full = about["available"] // block_tokens
                    repeat[mine] = rank[mine] // about["blocks"]
                    take[mine] = np.where(rank[mine] == about["slots"] - 1, about["last"], block_tokens)
                    for r in np.unique(repeat[mine]):
                        these = mine & (repeat == r)
                        place = rank[these] % about["blocks"]
                        # The shorter block comes last in each repeat.
                        block[these] = place
                        inner = place < full
                        block[np.flatnonzero(these)[inner]] = permuted(place[inner], full, _key(seed, int(s), int(r)))
                order = np.random.default_rng([seed, 1, shard]).permutation(len(which))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(which), shard)), pa.array(np.arange(len(which), dtype=np.int32)), pa.array([planned[i]["source"] for i in which[order]], pa.string()),
                        pa.array((repeat[order] + 1).astype(np.int32)), pa.array(block[order]), pa.array(take[order].astype(np.int32)),
                    ],
                    names=["shard", "slot", "source", "repeat", "block", "take"],
                )

    return spark.range(shards).mapInArrow(run, SLOTS)


def _prepared(documents: DataFrame, targets: DataFrame, vocabulary: str, block_tokens: int, total_tokens: int | None) -> tuple[DataFrame, list[dict]]:
    wanted = clean_targets(targets)
    tokens = encoded(documents, wanted, vocabulary)
    available = {r["source"]: r["tokens"] for r in tokens.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    return tokens, plan([r.asDict() for r in wanted.collect()], available, block_tokens, total_tokens)


def blocks(tokens: DataFrame, planned: list[dict], block_tokens: int = BLOCK_TOKENS, seed: int = 42) -> DataFrame:
    """source, block (from 0), parts, ids: the tokens of each block that fills a slot, and the documents they are from."""
    by_source = {t["source"]: (number, t) for number, t in enumerate(planned)}

    def wanted(batches):
        for batch in batches:
            n, place = (batch.column(i).to_numpy() for i in (2, 3))
            first = place // block_tokens
            many = (place + n - 1) // block_tokens - first + 1
            of = np.repeat(np.arange(len(n)), many)
            mine = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            sources = np.array([by_source[x][0] for x in batch.column(1).to_pylist()], dtype=np.int64)
            kept = np.zeros(len(of), dtype=bool)
            for number in np.unique(sources):
                these = sources[of] == number
                kept[these] = used(mine[these], planned[number], int(number), block_tokens, seed)
            counts = np.bincount(of[kept], minlength=len(n))
            rows = np.flatnonzero(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts[rows])]).astype(np.int32)), pa.array(mine[kept]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(place[rows]), lists], names=["row", "place", "blocks"])

    # Slim rows tell which documents have tokens in a block that is used; only those are shuffled with their tokens.
    places = stored(placed(tokens).select("row", "source", "tokens", "place").mapInArrow(wanted, "row bigint, place bigint, blocks array<bigint>"), "places")
    told = Marks(places, "row").tell(tokens.select("row", "doc_id", "source", "ids"), "row").where("_in").drop("_in")
    joined = told.join(places.hint("merge"), "row")

    # Each row's tokens are sliced as they are exploded, so no row is copied for its blocks.
    one = joined.select("doc_id", "source", "ids", "place", F.explode("blocks").alias("block"))
    first, last = F.greatest(F.lit(0), F.col("block") * block_tokens - F.col("place")).cast("int"), F.least(F.size("ids"), (F.col("block") + 1) * block_tokens - F.col("place")).cast("int")
    part = F.struct((F.col("place") + first).alias("at"), "doc_id", first.alias("from_token"), last.alias("to_token"), F.slice("ids", first + 1, last - first).alias("ids"))
    cut = one.select("source", "block", part.alias("part"))
    # A block has at most block_tokens parts, as each holds a token at least.
    grouped = cut.groupBy("source", "block").agg(F.array_sort(F.collect_list("part")).alias("l"))
    named = F.transform("l", lambda p: F.struct(p["at"].alias("at"), p["doc_id"].alias("doc_id"), p["from_token"].alias("from_token"), p["to_token"].alias("to_token")))
    return grouped.select("source", "block", named.alias("parts"), F.flatten(F.transform("l", lambda p: p["ids"])).alias("ids"))


MIXTURE = "shard, slot, source, repeat, block, tokens, parts, ids"


def mixture(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS, total_tokens: int | None = None, seed: int = 42) -> DataFrame:
    """The mixture, one row for each slot: shard, slot, source, repeat, block, tokens (their number), parts, ids (the tokens).

    parts names the tokens of the documents in the block, in order: at (place in the source's row), doc_id,
    from_token and to_token (exclusive). Documents without text, tokens, doc_id or a wanted source take no part; two
    rows of one doc_id count as two documents. A source without documents gives nothing and the others keep the ratio
    of their shares. Without any documents or targets the mixture is empty. Other columns are ignored.
    """
    tokens, planned = _prepared(documents, targets, vocabulary, block_tokens, total_tokens)
    # Both sides grow with the data, so neither is broadcast.
    filled = slots(documents.sparkSession, planned, block_tokens, seed=seed).hint("merge").join(blocks(tokens, planned, block_tokens, seed), ["source", "block"])
    # The last slot of a source takes so many tokens only as its share still wants.
    end = f"block * {block_tokens} + take"
    parts = f"transform(filter(parts, p -> p.at < {end}), p -> named_struct('at', p.at, 'doc_id', p.doc_id, 'from_token', p.from_token, 'to_token', int(least(p.to_token, p.from_token + {end} - p.at))))"
    cut = filled.withColumn("parts", F.expr(parts)).withColumn("ids", F.expr("slice(ids, 1, take)"))
    return cut.withColumn("tokens", F.size("ids").cast("bigint")).select(*MIXTURE.split(", "))


def shares(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS, total_tokens: int | None = None, seed: int = 42) -> DataFrame:
    """What the mixture holds of each source of `targets`, against what was wanted, in tokens counted in its slots."""
    wanted = clean_targets(targets)
    tokens, planned = _prepared(documents, targets, vocabulary, block_tokens, total_tokens)
    sizes = documents.sparkSession.createDataFrame([(t["source"], int(t["available"])) for t in planned], "source string, available bigint")
    # A slot's tokens follow from its block alone: full, or what is left at the end of the source's row.
    held = slots(documents.sparkSession, planned, block_tokens, seed=seed).join(F.broadcast(sizes), "source")
    held = held.withColumn("tokens", F.least(F.col("take"), F.col("available") - F.col("block") * block_tokens))
    by_source = held.groupBy("source").agg(F.sum("tokens").alias("mixture_tokens"), F.max("repeat").alias("repeats"), F.count("*").alias("blocks_used"))
    there = tokens.groupBy("source").agg(F.sum("tokens").alias("available_tokens"), F.count("*").alias("documents"))
    joined = wanted.join(there, "source", "left").join(by_source, "source", "left").fillna(0, ["available_tokens", "documents", "mixture_tokens", "repeats", "blocks_used"])
    # One row for each source, at most MAX_SOURCES.
    everything = Window.partitionBy(F.lit(1))
    scaled = F.when(F.col("documents") > 0, F.col("target_share")).otherwise(0.0)
    return joined.select(
        "source", "target_share", (scaled / F.sum(scaled).over(everything)).alias("reachable_share"), (F.col("mixture_tokens") / F.sum("mixture_tokens").over(everything)).alias("actual_share"),
        "mixture_tokens", "available_tokens", "documents", "blocks_used", "repeats", "max_repeats",
    )


def texts(mixed: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The slots as text: shard, slot, source, text. Tokens that split a character at the end of a block give U+FFFD there."""
    get = _shipped(mixed.sparkSession, vocabulary)

    def start():
        decode = get().decode
        return lambda shard, slot, source, ids: [(shard, slot, source, decode(ids))]

    return map_rows(mixed.select("shard", "slot", "source", "ids"), "shard bigint, slot int, source string, text string", start)
