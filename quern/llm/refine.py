"""Problem 2: records that are alike but for white space, letter case, punctuation or the order of their fields.

Progressive refinement of the partition into classes of copies:

1. Cheap invariants of every record, computed in the JVM without leaving it: how often all values hold each of eight
   letters, and so how long they are when stripped of all others. They do not depend on the order of fields nor on
   anything that is ignored, nor on how a value is escaped or nested. Only (invariants -> count) is shuffled, combined
   before.
2. Invariants shared by several records are marked in a bitmap whose size follows their number up to a bound (see
   `marks`). It only lets too much through when it fills up, never too little.
3. Only records whose mark is set are parsed fully and get the costly key, a 128-bit digest of each field's sequence
   of letters and digits. Classes are then made on it; of a record only ids and keys are shuffled, never its text.

A class may hold a third of all records: classes are counted by partial aggregation, and the join back to the members
is by class key with one small row on the class side, so that a hot class can be split over tasks.
"""

from __future__ import annotations

import json
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.arrow import map_rows
from quern.llm.marks import Marks, lacking, met
from quern.session import stored

#: Letters of the histogram: frequent ones that no escape of JSON brings in (b, f, n, r, t, u, the digits of codes).
HISTOGRAM = "iosmlhpg"
#: What lower-casing does not unify: sharp s and the Latin ligatures (fixed values).
EXPAND = {"ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
_TO_LETTERS = str.maketrans(EXPAND | {"ẞ": "ss"})
_DROP = bytes(i for i in range(256) if not chr(i).isalnum() or i > 127)
ROW_FIELDS = ("id", "text", "doc_id", "doc_title", "revision", "pub_date", "tier", "chunk_type", "control_id", "section_path", "source_url", "sha256_source")


def _written(value: object) -> str:
    """A nested value without its outward form: names and values in the order of names or of places; a null is `null`."""
    if isinstance(value, dict):
        return " ".join(f"{name} {_written(value[name])}" for name in sorted(value))
    if isinstance(value, list):
        return " ".join(map(_written, value))
    return value if isinstance(value, str) else json.dumps(value)


def sequence(value: object) -> bytes:
    """The letters and digits of a value, in lower case; nothing for null."""
    if value is None:
        return b""
    text = value if isinstance(value, str) else _written(value)
    if text.isascii():
        return text.lower().encode().translate(None, _DROP)
    return "".join(filter(str.isalnum, text.lower().translate(_TO_LETTERS))).encode()


def _refuse(name: str) -> object:
    raise ValueError(name)


def costly_key(payload: str) -> tuple[int, int] | None:
    """Two halves of the digest over all fields, in the order of their names; None unless it is a complete JSON object.

    Numbers count as they are written. A field that is absent, null or holds neither letter nor digit is the same.
    """
    try:
        record = json.loads(payload, parse_float=str, parse_int=str, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return None
    if not isinstance(record, dict):
        return None
    digest = blake2b(digest_size=16)
    for name in sorted(record):
        if value := sequence(record[name]):
            digest.update(name.encode("utf-8", "surrogatepass") + b"\0%d\0" % len(value))
            digest.update(value)
    both = digest.digest()
    return int.from_bytes(both[:8], "big", signed=True), int.from_bytes(both[8:], "big", signed=True)


def letters(payload: Column) -> Column:
    """All values of a record in lower case, ligatures and the like expanded; empty for what cannot be read.

    Records with equal sequences of letters and digits have as many of each letter of HISTOGRAM here. A nested value is
    read as its JSON text, whose names are part of it; its escapes and literals bring in none of these letters but the s
    of false and the l of false and null, which copies share.
    """
    record = F.from_json(payload, ", ".join(f"{name} string" for name in ROW_FIELDS), {"mode": "PERMISSIVE"})
    values = expanded = F.lower(F.concat_ws("", *[record[name] for name in ROW_FIELDS]))
    for letter, several in EXPAND.items():
        expanded = F.replace(expanded, F.lit(letter), F.lit(several))
    return F.when(F.octet_length(values) == F.length(values), values).otherwise(expanded)


def keyed(records: DataFrame) -> DataFrame:
    """rec_id, payload and the cheap key of every record with a payload: a hash of the letter histogram, whose sum is the
    stripped length."""
    rows = records.where("payload IS NOT NULL AND rec_id IS NOT NULL").select("rec_id", "payload", letters(F.col("payload")).alias("letters"))
    histogram = [F.octet_length("letters") - F.octet_length(F.replace("letters", F.lit(letter))) for letter in HISTOGRAM]
    return rows.select("rec_id", "payload", F.xxhash64(*histogram).alias("cheap"))


KEYS = "rec_id bigint, print bigint, cheap bigint, k1 bigint, k2 bigint"


def members(records: DataFrame) -> DataFrame:
    """The records that share their cheap key with another, each with its costly key.

    print is a hash of the payload as it is: with rec_id it tells rows apart that repeat a rec_id.
    """
    rows = keyed(records)
    shared = stored(rows.groupBy("cheap").count().where("count > 1").select("cheap"), "shared")
    marked = Marks(shared, "cheap").tell(rows, "cheap").where("_in")

    def start():
        def key(rec_id: int, print_: int, payload: str, cheap: int) -> list[tuple]:
            found = costly_key(payload)
            return [(rec_id, print_, cheap, *found)] if found else []

        return key

    return map_rows(marked.select("rec_id", F.xxhash64("payload").alias("print"), "payload", "cheap"), KEYS, start)


CLASS = ["cheap", "k1", "k2"]


def _classes(keys: DataFrame) -> DataFrame:
    """Classes of several rows with the one that is kept, the first by rec_id and print; counted by partial aggregation."""
    least = F.min(F.struct("rec_id", "print"))
    return keys.groupBy(*CLASS).agg(least.alias("kept"), F.count("*").alias("copies")).where("copies > 1")


def copies(records: DataFrame) -> DataFrame:
    """One row for each record that has copies: kept_rec_id (the smallest of its class), rec_id, copies (in all).

    The kept record has a row too, with itself. Payloads that are null, cut off, or not a JSON object are no copies of
    anything, and an empty table has none. A rec_id that occurs twice has a row each time. Rows without a rec_id take
    no part. Other columns are ignored.
    """
    keys = stored(members(records), "members")
    found = keys.join(_classes(keys).hint("shuffle_hash"), CLASS)
    return found.select(F.col("kept.rec_id").alias("kept_rec_id"), "rec_id", "copies")


def collapsed(records: DataFrame) -> DataFrame:
    """One record for each class: rec_id and payload of the kept one, and the number of its copies (1 if single).

    The first by rec_id is kept, among rows of one rec_id that with the smaller hash of its payload. Different records
    that share a rec_id, or have none, all stay; so do payloads that are null or cannot be read, each as it is. Only
    payloads of kept records with copies are shuffled: the others pass by the bitmaps of what is kept and what goes.
    """
    keys = stored(members(records), "members")
    found = keys.join(_classes(keys).hint("shuffle_hash"), CLASS).select("rec_id", "print", "kept", "copies")
    is_kept = (F.col("rec_id") == F.col("kept.rec_id")) & (F.col("print") == F.col("kept.print"))
    gone = stored(found.where(~is_kept).select("rec_id", "print").distinct(), "gone")
    # A kept row may itself come several times.
    kept = stored(found.where(is_kept).groupBy("rec_id", "print").agg(F.max("copies").alias("copies"), F.count("*").alias("times")), "kept")
    rows = records.select("rec_id", "payload", F.xxhash64("payload").alias("print"))
    named = F.col("rec_id").isNotNull() & F.col("payload").isNotNull()
    single, several = met(lacking(rows.where(named), ["rec_id", "print"], gone, "mistaken"), ["rec_id", "print"], kept)
    once = several.where("times IS NULL OR times = 1").select("rec_id", "payload", F.coalesce("copies", F.lit(1)).alias("copies"))
    repeated = several.where("times > 1").groupBy("rec_id", "print").agg(F.first("payload").alias("payload"), F.first("copies").alias("copies"))
    alone = rows.where(~named).unionByName(single).select("rec_id", "payload", F.lit(1).cast("bigint").alias("copies"))
    return alone.unionByName(once).unionByName(repeated.select("rec_id", "payload", "copies"))
