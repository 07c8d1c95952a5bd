"""Counts and checks over a build: by kind, by rule, lengths, expected ranges, and the published order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import text as T
from quern.operators import ordered

#: Expected ranges of a full build (fixed values); None is no bound.
EXPECTED = {"control_rows": (900, 1200), "families": (20, 20), "ai_rmf_subcategories": (60, 80), "ssdf_practices": (40, None)}


def rejections_by(rejections: DataFrame, *columns: str) -> DataFrame:
    return rejections.groupBy(*columns).agg(F.count("*").alias("n"))


def rows_by_document_and_type(rows: DataFrame) -> DataFrame:
    """Rows by document, by chunk type and in all, from one pass: level tells which."""
    grouped = rows.groupingSets([["doc_id"], ["chunk_type"], []], "doc_id", "chunk_type").agg(F.count("*").alias("n"), F.grouping_id().alias("_level"))
    level = F.when(F.col("_level") == 1, "document").when(F.col("_level") == 2, "type").otherwise("total")
    return grouped.select(level.alias("level"), F.coalesce(F.when(level == "document", F.col("doc_id")), F.when(level == "type", F.col("chunk_type"))).alias("name"), "n")


def family_counts(rows: DataFrame) -> DataFrame:
    """Rows of each control family by kind, with a TOTAL row."""
    kinds = ("control", "control_enhancement", "control_discussion", "assessment_objective", "assessment_method")
    family = F.upper(F.split_part(F.col("control_id"), F.lit("-"), F.lit(1)))
    counted = rows.where("control_id IS NOT NULL").withColumn("family", family).rollup("family")
    counts = counted.agg(*[F.count_if(F.col("chunk_type") == k).alias(k) for k in kinds], F.grouping("family").alias("_g"))
    return counts.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("family")).alias("family"), *kinds)


def length_stats(rows: DataFrame, by: str = "chunk_type") -> DataFrame:
    """Shortest, upper middle and longest text by type, and how many are under the floor or over the limit.

    Lengths are counted by value before any are gathered, so a type with a third of all rows costs one small histogram.
    """
    lengths = rows.where("text IS NOT NULL").groupBy(by, F.length("text").alias("chars")).agg(F.count("*").alias("n"))
    total = lengths.groupBy(by).agg(F.sum("n").alias("total"), F.min("chars").alias("shortest"), F.max("chars").alias("longest"))
    before = F.sum("n").over(Window.partitionBy(by).orderBy("chars"))
    middle = lengths.withColumn("upto", before).join(total.select(F.col(by).alias("_by"), "total"), F.col(by).eqNullSafe(F.col("_by")))
    middle = middle.where((F.col("upto") > F.expr("total div 2")) & (F.col("upto") - F.col("n") <= F.expr("total div 2"))).select(F.col(by).alias("_m"), F.col("chars").alias("upper_median"))
    floor = T.min_text_len(F.col(by)) if by == "chunk_type" else F.lit(schemas.MIN_TEXT)
    under = lengths.groupBy(by).agg(F.sum(F.when(F.col("chars") < floor, F.col("n")).otherwise(0)).alias("under"), F.sum(F.when(F.col("chars") > schemas.MAX_TEXT, F.col("n")).otherwise(0)).alias("over")).withColumnRenamed(by, "_u")
    joined = total.join(middle, F.col(by).eqNullSafe(F.col("_m"))).join(under, F.col(by).eqNullSafe(F.col("_u")))
    return joined.select(by, "total", "shortest", "upper_median", "longest", "under", "over")


def text_bytes(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("text").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))


def expected_counts(rows: DataFrame) -> DataFrame:
    """check, subject, value, low, high, warning: every expectation, and whether a build misses it. Warnings reject nothing."""
    kind = F.col("chunk_type")
    family = F.when((kind == "control") & (F.coalesce("control_id", F.lit("")) != ""), F.split_part(F.col("control_id"), F.lit("-"), F.lit(1)))
    whole = rows.agg(F.count_if(kind.isin("control", "control_enhancement")).alias("control_rows"), F.countDistinct(family).alias("families"), F.count_if(kind == "ssdf_practice").alias("ssdf_practices"))
    single = whole.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.lit("").alias("subject"), F.col(c).alias("value")) for c in whole.columns])).alias("x")).select("x.*")
    base = F.split_part(F.col("id"), F.lit(" (part "), F.lit(1))
    per_document = rows.where(kind == "ai_rmf_subcategory").groupBy(F.col("doc_id").alias("subject")).agg(F.countDistinct(base).alias("value")).select(F.lit("ai_rmf_subcategories").alias("check"), "subject", "value")
    every = single.unionByName(per_document)
    low, high = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, (least, most) in EXPECTED.items():
        low = F.when(F.col("check") == name, least).otherwise(low)
        high = F.when(F.col("check") == name, most).otherwise(high)
    return every.select("*", low.alias("low"), high.alias("high")).withColumn("warning", (F.col("value") < F.col("low")) | F.coalesce(F.col("value") > F.col("high"), F.lit(False)))


def export_order(rows: DataFrame) -> DataFrame:
    """Rows in the order in which they are published: document, control as readers count, id."""
    key = T.control_sort_key(F.coalesce(F.col("control_id"), F.lit("")))
    return rows.orderBy("doc_id", key, "id")


def export_positions(rows: DataFrame, tie: str) -> DataFrame:
    """Rows with `place`, from 1, in the published order; rows alike in it follow `tie`."""
    key = T.control_sort_key(F.coalesce(F.col("control_id"), F.lit("")))
    return ordered.positions(rows, [F.col("doc_id"), key, F.col("id"), F.col(tie)], "place")


def sorted_controls(ids: DataFrame, column: str) -> DataFrame:
    """One row: the distinct control ids in readers' order, how many are base controls, how many enhancements.

    Bounded by the number of different ids, which a catalog fixes.
    """
    entry = F.struct(T.control_sort_key(F.col(column)).alias("key"), F.col(column).alias("id"))
    gathered = ids.where(F.col(column).isNotNull()).select(column).distinct().agg(F.sort_array(F.collect_list(entry)).alias("l"), F.count_if(~F.col(column).contains(".")).alias("base"), F.count_if(F.col(column).contains(".")).alias("enhancements"))
    return gathered.select(F.array_join(F.transform("l", lambda x: T.display_id(x["id"])), ", ").alias("controls"), "base", "enhancements")


def samples(rows: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The first `n` rows of each kind; ranges of the order send at most `n` each to the window of their kind."""
    return ordered.first_n(rows, [by], order, n)


def by_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """id, found and the first row of each wanted id (of several with one id the first by `seq`), for a reader to look at.

    `ids` has a column id; an id that occurs twice is asked for once, and one that no row has is reported as not found.
    """
    wanted = ids.where("id IS NOT NULL").select("id").distinct()
    first = ordered.first_rows(rows.join(wanted, "id", "left_semi"), ["id"], [F.col("seq")], [c for c in rows.columns if c != "id"])
    return wanted.join(first, "id", "left").withColumn("found", F.col("seq").isNotNull())


def summary_markdown(valid: DataFrame, rejections: DataFrame, warnings: DataFrame) -> str:
    """The build's summary as text. Only counts by document, type and rule reach the driver."""
    counts = rows_by_document_and_type(valid).collect()
    size = text_bytes(valid).first()
    by_rule = rejections_by(rejections, "stage", "rule").orderBy("stage", "rule").collect()
    missed = warnings.where("warning").orderBy("check", "subject").collect()

    def table(level: str, title: str, head: str) -> list[str]:
        body = [f"| `{r['name']}` | {r['n']:,} |" for r in sorted((r for r in counts if r["level"] == level), key=lambda r: r["name"] or "")]
        return [f"## {title}", "", f"| {head} | rows |", "|---|---:|", *body, ""]

    lines = ["# Dataset summary", "", f"- Rows published: **{size['rows']:,}**", f"- Rows rejected across all stages: **{sum(r['n'] for r in by_rule):,}**", f"- Total text: **{(size['bytes'] or 0) / 1e6:.1f} MB**", ""]
    lines += table("document", "Rows by document", "doc_id") + table("type", "Rows by chunk type", "chunk_type")
    lines += ["## Rejections by rule", "", "| stage | rule | count |", "|---|---|---:|", *[f"| {r['stage']} | `{r['rule']}` | {r['n']:,} |" for r in by_rule], ""]
    lines += ["## Expected-count warnings", "", *([f"- {r['check']} {r['subject']}: {r['value']} outside [{r['low']}, {'∞' if r['high'] is None else r['high']}]" for r in missed] or ["- none"])]
    return "\n".join(lines) + "\n"
