"""Control catalogs as rows: parameters rendered into prose, part trees flattened to labelled lines, one row each for a
control's statement, discussion, assessment objective and assessment methods.

A catalog is one row until it is exploded: its nodes are an array (see `nested`), to which what stands above them comes
down, and parameters are resolved within the row. Then parts meet their control in one shuffle by control, and all
rows of a control are made within its row. Order is that of the tree, by a padded path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import nested
from quern.session import stored

#: `{{ insert: param, ID }}`; the id is group 1.
MARKER = r"\{\{\s*insert:\s*param,\s*([^}\s]+)\s*\}\}"
UNRESOLVED = "[Assignment: organization-defined parameter]"
MAX_PASSES = 5
#: Sections of a control by the name of their parts: statement first, children last (fixed values).
PART_KINDS = {"statement": "statement", "guidance": "guidance", "assessment-objective": "objective", "assessment-method": "method"}
_PROPS = "array<struct<name:string,value:string,class:string>>"
_COLUMNS = {name: (name,) for name in ("title", "name", "prose", "props", "label", "select")}
#: Parameters sort before parts, and parts before child controls (fixed values).
_CODES = {"groups": "0", "params": "1", "parts": "2", "controls": "3"}
_CODE = "CASE {field} " + " ".join(f"WHEN '{f}' THEN '{c}'" for f, c in _CODES.items()) + " END"
#: What comes down to a node: its order, the node right above it, and the group it is in.
_PASSED = {
    "ord": ("''", f"concat_ws('.', nullif(n.ord, ''), {_CODE}, lpad(cast(i AS string), 10, '0'))"),
    "above": ("CAST(NULL AS struct<kind:string,id:string,title:string>)", "named_struct('kind', n.kind, 'id', coalesce(n.values.node_id, ''), 'title', coalesce(n.values.title, ''))"),
    "home": ("CAST(NULL AS struct<id:string,title:string>)", "CASE WHEN n.kind = 'groups' THEN named_struct('id', coalesce(n.values.node_id, ''), 'title', n.values.title) ELSE n.home END"),
}


def trees(files: DataFrame) -> DataFrame:
    """file_id, doc_id, nodes (all nodes of a catalog with what comes down to them) and params (latest first, as printed)."""
    fields = list(nested.OSCAL_KINDS)
    depth = nested.depth_of(nested.infer_schema(files, "mini_catalog", "catalog"), fields)
    rows, found = nested.tree_arrays(files, ["file_id", "doc_id"], "mini_catalog", "catalog", fields, depth, {"node_id": ("id",)} | _COLUMNS, _PASSED)
    arrays = rows.select("file_id", "doc_id", found.alias("nodes"))
    own = F.filter("nodes", lambda n: (n["kind"] == "params") & (F.coalesce(n["values"]["node_id"], F.lit("")) != ""))
    printed = F.transform(own, lambda n: F.struct(n["ord"].alias("ord"), n["values"]["node_id"].alias("id"), render_param(n["values"]["node_id"], n["values"]["label"], n["values"]["select"]).alias("rendered")))
    return arrays.withColumn("params", F.reverse(F.array_sort(printed)))


def render_param(node_id: Column, label: Column, select: Column) -> Column:
    """As the catalog prints it: `[Selection; one or more: a; b]` or `[Assignment: organization-defined label]`."""
    chosen = F.from_json(select, "struct<`how-many`:string,choice:array<string>>")
    how_many = F.nullif(F.replace(chosen["how-many"], F.lit("-"), F.lit(" ")), F.lit(""))
    selection = F.concat(F.lit("[Selection"), F.coalesce(F.concat(F.lit("; "), how_many), F.lit("")), F.lit(": "), F.coalesce(F.array_join(chosen["choice"], "; "), F.lit("")), F.lit("]"))
    return F.when(select.isNotNull(), selection).otherwise(F.concat(F.lit("[Assignment: organization-defined "), F.coalesce(F.nullif(label, F.lit("")), node_id, F.lit("")), F.lit("]")))


def _ids(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(MARKER), 1), lambda i: F.regexp_replace(i, ",+\\z", ""))


def _known(params: Column, wanted: Column) -> Column:
    """The rendered form of the latest parameter of an id, null if there is none."""
    return F.get(F.filter(params, lambda p: p["id"] == wanted), 0)["rendered"]


def resolved(text: Column, params: Column, passes: int = MAX_PASSES) -> Column:
    """A text with its markers replaced, again and again as parameters hold markers too; a catalog's own loops end after
    `passes` rounds. Ids that no parameter has give a blank one."""

    def once(t: Column, _: Column) -> Column:
        bits = F.zip_with(F.split(t, MARKER.replace("(", "(?:")), _ids(t), lambda bit, i: F.concat(bit, F.when(i.isNull(), "").otherwise(F.coalesce(_known(params, i), F.lit(UNRESOLVED)))))
        return F.when(t.rlike(MARKER), F.array_join(bits, "")).otherwise(t)

    return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), text, once)


def param_index(files: DataFrame) -> DataFrame:
    """file_id, param_id, rendered: every parameter of a catalog, the last one of an id, with markers inside it resolved.

    Prose takes one more pass than its parameters, which makes five.
    """
    listed = trees(files).select("file_id", "params", F.explode("params").alias("p"))
    shown = listed.select("file_id", F.col("p.id").alias("param_id"), "p.ord", resolved(F.col("p.rendered"), F.col("params"), MAX_PASSES - 1).alias("rendered"))
    return shown.groupBy("file_id", "param_id").agg(F.max_by("rendered", "ord").alias("rendered"))


def part_label(props: Column) -> Column:
    """The first label without a class, else the first of class sp800-53a, else nothing."""
    labels = F.filter(props, lambda p: p["name"] == "label")
    plain = F.filter(labels, lambda p: F.coalesce(p["class"], F.lit("")) == "")
    assessor = F.filter(labels, lambda p: p["class"] == "sp800-53a")
    return F.coalesce(F.get(plain, 0)["value"], F.get(assessor, 0)["value"], F.lit(""))


def _props(text: Column) -> Column:
    # One property alone may stand without its array.
    several = F.coalesce(F.from_json(text, _PROPS), F.array(F.from_json(text, _PROPS[6:-1])))
    return F.coalesce(F.filter(several, lambda p: p.isNotNull()), F.array().cast(_PROPS))


def controls(files: DataFrame) -> DataFrame:
    """One row for each control of each catalog: file_id, control (its path), doc_id, what it is called and where it stands,
    and sections: its own parts in order, each with its name, method and printed lines.

    A control and its parts are gathered in one row, so its size is that of a printed control.
    """
    catalogs = trees(files)
    wanted = F.filter("nodes", lambda n: n["kind"].isin("controls", "parts"))
    flat = catalogs.select("file_id", "doc_id", "params", F.explode(wanted).alias("n")).select("file_id", "doc_id", "params", "n.*")
    is_part = F.col("kind") == "parts"
    control = F.when(is_part, F.regexp_extract("path", r"^((?:.*\.)?controls\.\d+)\.parts\.", 1)).otherwise(F.col("path"))
    prose = F.when(is_part, F.regexp_replace(resolved(F.coalesce("values.prose", F.lit("")), F.col("params")), MARKER, UNRESOLVED))
    flat = flat.select("file_id", "doc_id", control.alias("control"), is_part.alias("is_part"), "ord", "path", "parent", "values", "above", "home", prose.alias("prose")).where("control <> ''")
    part = F.struct("ord", "path", "parent", F.col("values.name").alias("name"), F.col("values.props").alias("props"), "prose")
    about = F.struct("doc_id", "ord", F.coalesce("values.node_id", F.lit("")).alias("id"), F.coalesce("values.title", F.lit("")).alias("title"), F.col("values.props").alias("props"), "above", "home")
    gathered = flat.groupBy("file_id", "control").agg(F.first(F.when(~F.col("is_part"), about), ignorenulls=True).alias("c"), F.array_sort(F.collect_list(F.when(F.col("is_part"), part))).alias("_parts"))
    parts = F.transform("_parts", lambda p: F.struct(p["ord"].alias("ord"), p["path"].alias("path"), p["parent"].alias("parent"), p["name"].alias("name"), _props(p["props"]).alias("props"), p["prose"].alias("prose")))
    gathered = gathered.select("file_id", "control", "c", parts.alias("_parts"))

    def section(top: Column) -> Column:
        # The section's own part names the section and gives the method; its label is not printed.
        method = F.coalesce(F.get(F.filter(top["props"], lambda p: p["name"] == "method"), 0)["value"], F.lit("METHOD"))
        is_method = F.coalesce(top["name"] == "assessment-method", F.lit(False))
        mine = F.filter("_parts", lambda p: F.startswith(p["path"], F.concat(top["path"], F.lit("."))) | (~is_method & (p["path"] == top["path"])))
        lines = F.transform(mine, lambda p: _line(p, (p["path"] == top["path"]) | (is_method & (p["parent"] == top["path"]))))
        return F.struct(top["ord"].alias("ord"), top["name"].alias("name"), method.alias("method"), F.array_join(F.filter(lines, lambda x: F.trim(x) != ""), "\n").alias("body"))

    def _line(p: Column, unlabelled: Column) -> Column:
        """A label without prose is only a line where no part is below it."""
        label = F.when(unlabelled, "").otherwise(part_label(p["props"]))
        text = F.rtrim(F.concat(F.when(label != "", F.concat(label, F.lit(" "))).otherwise(""), p["prose"]))
        return F.when((p["prose"] != "") | ((label != "") & ~F.exists("_parts", lambda c: c["parent"] == p["path"])), text)

    tops = F.filter("_parts", lambda p: F.regexp_extract(F.substr(p["path"], F.length("control") + 1), r"^(\.parts\.\d+)\z", 1) != "")
    withdrawn = F.exists(_props(F.col("c.props")), lambda p: (p["name"] == "status") & (p["value"] == "withdrawn"))
    enhancement = F.coalesce(F.col("c.above.kind") == "controls", F.lit(False))
    family = F.upper(F.coalesce("c.home.id", F.lit("")))
    printed, parent = T.display_id(F.col("c.id")), T.display_id(F.col("c.above.id"))
    context = F.concat(F.lit("Family: "), F.coalesce("c.home.title", F.upper("c.home.id"), F.lit("")), F.lit(" ("), family, F.lit(")"))
    return gathered.select(
        "file_id", "control", "c.doc_id", F.col("c.ord").alias("order"), F.col("c.id").alias("control_id"), F.col("c.title").alias("title"), F.coalesce(withdrawn, F.lit(False)).alias("withdrawn"), F.coalesce("c.home.id", F.lit("")).alias("family"), enhancement.alias("enhancement"), printed.alias("printed"),
        F.when(enhancement, F.concat(printed, F.lit(" "), F.col("c.above.title"), F.lit(" | "), F.col("c.title"))).otherwise(F.concat(printed, F.lit(" "), F.col("c.title"))).alias("heading"),
        F.concat_ws(" > ", family, F.when(enhancement, parent), printed).alias("base_path"),
        F.when(enhancement, F.concat(context, F.lit(" > "), parent, F.lit(" "), F.col("c.above.title"))).otherwise(context).alias("context"),
        F.transform(tops, section).alias("sections"),
    )


def _is_dull(body: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(body), r"\.+\z", "")).isin("none", "")


def parse_catalogs(files: DataFrame, assessment_doc: str | None = "assessment") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, rejections, counts) of catalogs given as file_id, doc_id, mini_catalog.

    rows: file_id, order, kind_order, chunk_type, control_id, doc_id, id, section_path, text. Withdrawn controls, controls
    without a statement or an id, and empty discussions are rejected; children of a withdrawn control are read. Without
    an `assessment_doc` there are no assessment rows. counts: file_id, family, kind, n.
    """
    known = stored(controls(files), "catalog-controls")
    live = known.where("NOT withdrawn AND control_id <> ''")
    named = lambda name: F.filter("sections", lambda s: s["name"] == name)
    joined = lambda found, gap: F.array_join(F.filter(F.transform(found, lambda s: s["body"]), lambda b: b != ""), gap)
    title_case = lambda method: F.array_join(F.transform(F.split(F.lower(method), "(?<=[^a-z])(?=[a-z])"), F.initcap), "")
    blocks = F.transform(F.filter(named("assessment-method"), lambda s: F.trim(s["body"]) != ""), lambda s: F.concat(title_case(s["method"]), F.lit(": "), F.trim(s["body"])))
    head = F.concat("printed", F.lit(" "), "title")

    def made(kind_order: int, chunk_type: Column, doc_id: Column, heading: Column, ending: str, body: Column) -> Column:
        return F.struct(F.lit(kind_order).alias("kind_order"), chunk_type.alias("chunk_type"), doc_id.alias("doc_id"), F.concat("base_path", F.lit(ending)).alias("section_path"), F.concat(heading, F.lit("\n\n"), body).alias("text"), (F.trim(body) != "").alias("full"))

    own = F.col("doc_id")
    several = F.transform(F.filter(named("guidance"), lambda s: ~_is_dull(s["body"])), lambda s: made(2, F.lit("control_discussion"), own, F.concat(head, F.lit(" - Discussion\n"), "context"), " > Discussion", s["body"]))
    all_made = [F.array(made(1, F.when(F.col("enhancement"), "control_enhancement").otherwise("control"), own, F.concat("heading", F.lit("\n"), "context"), "", joined(named("statement"), "\n"))), several]
    if assessment_doc:
        doc = F.lit(assessment_doc)
        all_made.append(F.array(made(3, F.lit("assessment_objective"), doc, F.concat(head, F.lit(" - Assessment Objective\nDetermine if the following are satisfied:")), " > Assessment Objective", joined(named("assessment-objective"), "\n"))))
        all_made.append(F.array(made(4, F.lit("assessment_method"), doc, F.concat(head, F.lit(" - Assessment Methods and Objects")), " > Assessment Methods", F.array_join(blocks, "\n\n"))))
    rows = live.select("file_id", "order", "family", "control_id", F.explode(F.concat(*all_made)).alias("r")).where("r.full")
    rows = rows.select("file_id", "order", "r.kind_order", "r.chunk_type", "control_id", "r.doc_id", "r.section_path", T.normalize_text(F.col("r.text")).alias("text"), T.make_id(F.col("r.doc_id"), F.col("r.chunk_type"), F.col("control_id")).alias("id"), "family")

    reasons = F.array_compact(
        F.when(F.col("withdrawn"), F.array(F.struct(F.lit("withdrawn_control").alias("rule"), F.concat("printed", F.lit(" '"), "title", F.lit("' marked withdrawn")).alias("detail"))))
        .when(F.col("control_id") == "", F.array(F.struct(F.lit("no_id").alias("rule"), F.concat(F.lit("control at "), "control").alias("detail"))))
        .otherwise(
            F.concat(
                F.array(F.when(F.size(named("statement")) == 0, F.struct(F.lit("no_statement").alias("rule"), F.concat("printed", F.lit(" has no statement part")).alias("detail")))),
                F.transform(F.filter(named("guidance"), lambda s: _is_dull(s["body"])), lambda s: F.struct(F.lit("empty_discussion").alias("rule"), F.concat("printed", F.lit(" discussion is empty or 'None.'")).alias("detail"))),
            )
        )
    )
    rejections = known.select("doc_id", F.col("control_id").alias("ref"), F.explode(reasons).alias("x")).select("doc_id", "ref", "x.rule", "x.detail", F.lit("parse_oscal").alias("stage"))
    withdrawn = known.where("withdrawn").select("file_id", "family", F.lit("withdrawn").alias("kind"))
    counts = rows.select("file_id", "family", F.col("chunk_type").alias("kind")).unionByName(withdrawn).groupBy("file_id", "family", "kind").agg(F.count("*").alias("n"))
    return rows.drop("family"), rejections, counts


def part_names(files: DataFrame) -> DataFrame:
    """How often each part name occurs in the trees of all controls, withdrawn ones too."""
    parts = nested.nodes(files, "file_id", "mini_catalog", "catalog", list(nested.OSCAL_KINDS), {"name": ("name",)}).where("kind = 'parts'")
    return parts.where(F.col("path").rlike(r"(?:^|\.)controls\.\d+\.parts\.")).groupBy("name").agg(F.count("*").alias("n"))


def unresolved_params(files: DataFrame) -> DataFrame:
    """Markers in prose that no parameter of the catalog resolves, by id."""
    prose = F.transform(F.filter("nodes", lambda n: n["kind"] == "parts"), lambda n: F.coalesce(n["values"]["prose"], F.lit("")))
    found = trees(files).select("params", F.explode(F.flatten(F.transform(prose, _ids))).alias("param_id"))
    return found.where(_known(F.col("params"), F.col("param_id")).isNull()).groupBy("param_id").agg(F.count("*").alias("n"))


def parse_profiles(profiles: DataFrame) -> DataFrame:
    """One row for each profile (doc_id, doc_title, profile as JSON text): which controls a baseline selects, in readers' order."""
    shape = "struct<profile:struct<metadata:struct<title:string>,imports:array<struct<`include-controls`:array<struct<`with-ids`:array<string>>>>>>>"
    read = profiles.withColumn("p", F.from_json("profile", shape)["profile"])
    ids = F.flatten(F.flatten(F.transform(F.coalesce("p.imports", F.array().cast("array<struct<`include-controls`:array<struct<`with-ids`:array<string>>>>>")), lambda i: F.transform(F.coalesce(i["include-controls"], F.array().cast("array<struct<`with-ids`:array<string>>>")), lambda c: F.coalesce(c["with-ids"], F.array().cast("array<string>"))))))
    keyed = F.array_sort(F.transform(F.array_distinct(ids), lambda i: F.struct(T.control_sort_key(i).alias("key"), i.alias("id"))))
    name = F.regexp_extract("doc_id", r"([^-]*)\z", 1)
    listed = read.withColumn("_ids", F.transform(keyed, lambda k: k["id"])).withColumn("_name", name)
    enhancements = F.size(F.filter("_ids", lambda i: i.contains(".")))
    text = F.concat(
        F.lit("SP 800-53B "), "_name", F.lit(" baseline. "), F.coalesce("p.metadata.title", "doc_title"), F.lit(". The "), "_name", F.lit(" baseline selects "), F.size("_ids").cast("string"), F.lit(" controls and control enhancements ("),
        (F.size("_ids") - enhancements).cast("string"), F.lit(" base controls, "), enhancements.cast("string"), F.lit(" enhancements) from the SP 800-53 Rev 5 catalog. Selected control identifiers:\n\n"), F.array_join(F.transform("_ids", T.display_id), ", "),
    )
    return listed.select(T.make_id(F.col("doc_id"), F.lit("baseline"), F.col("_name")).alias("id"), T.normalize_text(text).alias("text"), "doc_id", F.lit("baseline").alias("chunk_type"), F.concat(F.lit("SP 800-53B Baselines > "), "_name").alias("section_path"))
