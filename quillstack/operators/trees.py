"""Rewriting of regulation trees: what a node becomes depends on what its parent became.

A tree is rows (reg, node, parent, tag, kind, num, title, text), node numbers in document order and
parent null at the root. Rules are rows too: in a context, a tag of a kind becomes something, by an
action, at a place. The context of a node is what its parent became, not what the parent's tag means
elsewhere, so nested contexts come out right however deep they are.

Actions. ``make`` opens an element for the children; ``wrap`` opens two, one in the other; ``inline`` opens
one that leaves the places below it as they are; ``pass`` gives the children and the text to the place
without an element; ``split`` closes what went before and opens a paragraph in a content of its own for the
siblings that follow; ``drop`` leaves the whole subtree out. What no rule names is left out too, as ``ignored``.

Places. ``into`` is the parent's element; ``up`` the element around that; ``outer`` the one that the parent
itself was put in, where hoisted nodes go; ``para`` and ``content`` the paragraph and the content that a sibling
opened last.

The pass is top down, a level at a time: the nodes whose parents were placed last meet them in one join,
and only the others go on. Siblings that have no children, which are most nodes, wait and meet all their parents
in one join at the end; only nodes that have children, or siblings with children, are shuffled once for each
level above them. Of a node its numbers go down the levels, with that of its tag and kind among those of the rules; its
texts wait and meet its state when all is placed. Steps are compressed files, each written over the last but one.
Only the children of one parent ever meet in one window. Nodes without a way to a root, and those below a node that was
left out, are no part of the result. Repeated (reg, node) are the caller's to remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint, dealt, emptied, run_folder, stored

#: What code elements become, by the context and their types, and at which place.
CODES = {
    "regulation": (
        ("section", "into", ("Section", "Rule", "Rule2")),
        ("division", "into", ("Division", "Agency", "Subagency", "Series", "RegulationNo", "Subtitle", "Title", "Sec2")),
        ("chapter", "into", ("Chapter", "Subchapter")),
        ("part", "into", ("Part", "Subpart", "Regulation")),
        ("group", "into", ("Undesignated", "Unprefixed", "Form")),
        ("article", "into", ("Article", "Subarticle")),
        ("appendix", "into", ("Appendix",)),
    ),
    "division": (
        ("chapter", "into", ("Chapter", "Rule2")),
        ("section", "into", ("Section", "Rule")),
        ("article", "into", ("Article",)),
        ("part", "into", ("Undesignated", "Part", "Regulation", "Subpart")),
        ("appendix", "into", ("Appendix",)),
        ("subdivision", "into", ("Subdivision", "Division", "Series")),
        ("subchapter", "into", ("Subchapter",)),
        ("group", "into", ("Form", "Attachment", "Exhibit")),
    ),
    "subdivision": (
        ("chapter", "into", ("Chapter",)),
        ("section", "into", ("Section",)),
        ("part", "into", ("Part", "Sec2", "Series")),
        ("subdivision", "outer", ("Division",)),
        ("appendix", "into", ("Appendix",)),
        ("group", "into", ("Table", "Undesignated", "Exhibit", "Attachment", "Form")),
    ),
    "chapter": (
        ("section", "into", ("Section", "Rule")),
        ("article", "into", ("Article",)),
        ("chapter", "outer", ("Chapter",)),
        ("part", "into", ("Part", "Sec2", "Regulation", "Rule2", "Subject")),
        ("group", "into", ("Table", "Group", "Figure", "Form", "Subsection", "Opinion", "Attachment", "Addendum", "Schedule", "Chart", "Amendment", "RuleOfSections")),
        ("subchapter", "into", ("Subchapter", "Undesignated", "Unprefixed")),
        ("appendix", "into", ("Appendix",)),
        ("content", "into", ("Exhibit",)),
        ("subpart", "into", ("Subpart",)),
        ("division", "into", ("Division",)),
    ),
    "subchapter": (
        ("section", "into", ("Section", "Rule", "Canon")),
        ("article", "into", ("Article",)),
        ("appendix", "into", ("Appendix",)),
        ("group", "into", ("Group", "Form", "Attachment", "Table", "Subchapter", "Title")),
        ("division", "into", ("Division",)),
        ("subchapter", "outer", ("Undesignated",)),
        ("subarticle", "into", ("Subarticle",)),
        ("content", "into", ("Exhibit",)),
        ("part", "into", ("Unprefixed", "Part", "Sec2", "Subpart")),
    ),
    "group": (
        ("section", "into", ("Section", "Sec2")),
        ("article", "into", ("Article",)),
        ("appendix", "into", ("Appendix",)),
        ("group", "into", ("Subgroup", "Exhibit", "Schedule", "Undesignated", "Unprefixed", "Form", "Attachment", "Rule", "Table", "Opinion")),
        ("part", "into", ("Part", "Subpart")),
        ("chapter", "into", ("Chapter", "Subchapter")),
        ("division", "into", ("Subtitle", "Division")),
    ),
    "part": (
        ("section", "into", ("Section", "Regulation", "Rule")),
        ("content", "into", ("Exhibit",)),
        ("part", "outer", ("Undesignated",)),
        ("chapter", "into", ("Chapter",)),
        ("subpart", "into", ("Subpart", "Rule2", "Unprefixed", "Part", "Title", "Sec2", "Subtitle", "Subsection")),
        ("appendix", "into", ("Appendix",)),
        ("article", "into", ("Article",)),
        ("group", "into", ("Form", "Figure", "Attachment", "Table", "Schedule")),
        ("subdivision", "into", ("Subdivision", "Division")),
    ),
    "subpart": (
        ("section", "into", ("Section", "Rule")),
        ("part", "into", ("Undesignated",)),
        ("chapter", "into", ("Chapter", "Subchapter")),
        ("article", "into", ("Article",)),
        ("group", "into", ("Unprefixed", "Table", "Exhibit", "Schedule", "Sec2")),
        ("appendix", "into", ("Appendix",)),
        ("subpart", "into", ("Subpart",)),
    ),
    "appendix": (
        ("appendix", "into", ("Appendix",)),
        ("group", "into", ("Form", "Chart", "Unprefixed", "Exhibit", "Title", "Attachment", "Addendum", "Schedule", "Series", "Article", "Table")),
        ("section", "into", ("Rule", "Section")),
        ("part", "into", ("Undesignated", "Part")),
        ("chapter", "into", ("Chapter",)),
    ),
    "article": (
        ("article", "outer", ("Article",)),
        ("section", "into", ("Section", "Sec2", "Rule")),
        ("group", "into", ("Undesignated", "Table", "Exhibit", "Form", "Attachment", "Schedule")),
        ("appendix", "into", ("Appendix", "Addendum")),
        ("subarticle", "into", ("Subarticle", "Unprefixed")),
        ("part", "into", ("Part",)),
        ("subchapter", "into", ("Subchapter",)),
        ("chapter", "into", ("Chapter",)),
    ),
    "subarticle": (
        ("section", "into", ("Section",)),
        ("group", "into", ("Undesignated", "Table")),
        ("appendix", "into", ("Appendix",)),
        ("subarticle", "into", ("Subarticle",)),
        ("part", "into", ("Part",)),
    ),
    "section": (
        ("subsection", "into", ("Subsection", "Rule", "Section", "Unprefixed", "Part", "Article")),
        ("part", "outer", ("Undesignated",)),
        ("content", "into", ("Exhibit",)),
        ("appendix", "into", ("Appendix",)),
        ("group", "into", ("Form", "Attachment", "Schedule", "Table", "Sec2", "Rule2", "Subpart", "Subagency")),
    ),
    "subsection": (
        ("subsection", "into", ("Rule", "Section")),
        ("appendix", "into", ("Appendix",)),
        ("group", "into", ("Exhibit",)),
    ),
    "content": (
        ("section", "up", ("Section",)),
        ("group", "up", ("Exhibit", "Appendix")),
    ),
}
#: What other elements become, by the contexts that share them, and at which place. Some contexts are read like others below them.
MARKUP = {
    ("division", "subdivision", "chapter", "subchapter", "group", "part", "subpart", "article", "subarticle", "section", "subsection"): (
        ("content", "into", ("content",)),
    ),
    "regulation": (
        ("preface", "into", ("content",)),
    ),
    "preface": (
        ("text", "into", ("codetext",)),
        ("remark", "into", ("currency",)),
        ("notes", "into", ("notes",)),
    ),
    "section": (
        ("subsection", "into", ("subsect",)),
        ("notes", "into", ("notes",)),
        ("version", "into", ("version",)),
    ),
    ("article", "subarticle"): (
        ("table", "into", ("table",)),
        ("notes", "into", ("notes",)),
    ),
    "appendix": (
        ("remark", "into", ("currency",)),
        ("p", "into", ("para",)),
        ("matter", "into", ("content",)),
    ),
    "matter": (
        ("remark", "into", ("currency",)),
        ("matter_text", "into", ("codetext",)),
        ("notes", "into", ("notes",)),
    ),
    "content": (
        ("remark", "into", ("currency",)),
        ("text", "into", ("codetext",)),
        ("notes", "into", ("notes",)),
        ("subsection", "outer", ("subsect",)),
        ("content", "outer", ("content",)),
    ),
    ("text", "matter_text", "subsection"): (
        ("list", "into", ("itemizedlist",)),
        ("pre", "into", ("literallayout",)),
    ),
    "text": (
        ("p", "into", ("para",)),
        ("subsection", "outer", ("subsect",)),
        ("table", "into", ("table",)),
        ("nbsp", "into", ("nbsp",)),
        ("a", "into", ("filelink",)),
        ("b", "into", ("bold",)),
        ("i", "into", ("italic",)),
        ("ref", "into", ("codecitation",)),
        ("del", "into", ("strike",)),
    ),
    "matter_text": (
        ("p", "into", ("para",)),
        ("subsection", "into", ("subsect",)),
        ("table", "into", ("table",)),
        ("b", "into", ("bold",)),
    ),
    "subsection": (
        ("designator", "into", ("designator", "number")),
        ("subsection", "into", ("subsect",)),
        ("p", "content", ("para",)),
        ("table", "para", ("table",)),
        ("remark", "into", ("add",)),
        ("a", "para", ("ulink", "filelink")),
        ("span", "para", ("actcitation", "actseccitation")),
        ("ref", "para", ("codecitation",)),
        ("sup", "para", ("superscript",)),
        ("sub", "para", ("subscript",)),
        ("b", "para", ("bold",)),
        ("u", "para", ("underscore",)),
        ("i", "para", ("italic",)),
        ("del", "para", ("strike", "del")),
        ("ref", "into", ("footnoteref",)),
        ("date", "para", ("effectivedate",)),
        ("nbsp", "para", ("nbsp",)),
        ("words", "para", ("div",)),
    ),
    "p": (
        ("subsection", "outer", ("subsect",)),
        ("table", "into", ("table",)),
        ("remark", "into", ("add",)),
        ("a", "into", ("filelink", "ulink", "regcitation")),
        ("ref", "into", ("codecitation", "footnoteref")),
        ("span", "into", ("actcitation", "actseccitation", "monospace")),
        ("br", "into", ("linebreak",)),
        ("nbsp", "into", ("nbsp",)),
        ("words", "into", ("li", "div")),
        ("del", "into", ("del",)),
        ("dropped", "into", ("strike",)),
        ("date", "into", ("effectivedate", "expirationdate")),
    ),
    ("p", "td", "th", "note"): (
        ("b", "into", ("bold",)),
        ("i", "into", ("italic",)),
        ("sup", "into", ("superscript",)),
        ("sub", "into", ("subscript",)),
        ("u", "into", ("underscore",)),
    ),
    "note": (
        ("p", "into", ("para", "notetext")),
        ("ref", "into", ("codecitation",)),
        ("span", "into", ("actcitation", "actseccitation", "filedate")),
        ("table", "into", ("table",)),
        ("a", "into", ("regcitation", "filelink", "ordercitation", "ulink")),
        ("br", "into", ("linebreak",)),
        ("date", "into", ("effectivedate", "operationaldate", "expirationdate", "reviewdate")),
        ("p", "into", ("reviewdates",)),
        ("words", "into", ("drop", "codesec", "primaryidcodenumber")),
    ),
    "notes": (
        ("note_kind", "outer", ("notes-citeas",)),
        ("note_kind", "into", ("notes-history", "notes-priorhistory", "notes-cont", "notes-std", "notes-alert", "notes-editor", "notes-src", "notes-cr", "notes-cn", "notes-auth")),
        ("maintained", "into", ("notes-maint",)),
        ("note", "into", ("notes-footnotes",)),
    ),
    "note_kind": (
        ("note", "into", ("note",)),
    ),
    "maintained": (
        ("p", "into", ("note",)),
    ),
    "list": (
        ("item", "into", ("listitem",)),
    ),
    "table": (
        ("tr", "into", ("tr",)),
        ("td", "into", ("td",)),
        ("tbody", "into", ("tbody",)),
        ("thead", "into", ("thead",)),
        ("table", "into", ("table",)),
        ("row_of_content", "into", ("content",)),
    ),
    "row_of_content": (
        ("remark", "into", ("currency",)),
        ("notes", "into", ("notes",)),
        ("matter_text", "into", ("codetext",)),
    ),
    "tbody": (
        ("tr", "into", ("tr",)),
        ("td", "into", ("td",)),
        ("table", "into", ("table",)),
    ),
    "thead": (
        ("tr", "into", ("tr",)),
    ),
    "tr": (
        ("td", "into", ("td",)),
        ("th", "into", ("th",)),
        ("table", "into", ("table",)),
    ),
    "td": (
        ("td", "into", ("td",)),
        ("table", "into", ("table",)),
        ("a", "into", ("ulink",)),
        ("p", "into", ("para",)),
        ("ref", "into", ("codecitation",)),
        ("span", "into", ("actcitation",)),
    ),
    "remark": (
        ("subsection", "into", ("subsect",)),
        ("ref", "into", ("codecitation",)),
        ("del", "into", ("strike",)),
        ("remark", "into", ("add",)),
        ("span", "into", ("actcitation",)),
        ("b", "into", ("bold",)),
        ("i", "into", ("italic",)),
        ("sup", "into", ("superscript",)),
        ("sub", "into", ("subscript",)),
    ),
    "item": (
        ("b", "into", ("bold",)),
        ("i", "into", ("italic",)),
        ("sup", "into", ("superscript",)),
        ("sub", "into", ("subscript",)),
        ("u", "into", ("underscore",)),
        ("a", "into", ("ulink", "filelink")),
        ("ref", "into", ("codecitation",)),
        ("span", "into", ("actcitation",)),
        ("br", "into", ("linebreak",)),
        ("words", "into", ("li",)),
    ),
}
#: The actions that are not make.
ACTIONS = {
    "wrap": ("content", "matter", "subarticle", "item", "row_of_content"),
    "inline": ("p", "b", "i", "u", "sup", "sub", "a", "ref", "span", "date", "del", "br", "nbsp", "table", "list", "pre"),
    "pass": ("text", "matter_text", "words", "note", "note_kind", "maintained"),
    "split": ("designator",),
    "drop": ("dropped",),
}
#: The elements that are not named like what a node becomes; the second is inside the first.
ELEMENTS = {
    "regulation": ("body",),
    "group": ("hcontainer",),
    "appendix": ("hcontainer",),
    "content": ("hcontainer", "content"),
    "matter": ("hcontainer", "content"),
    "subarticle": ("hcontainer", "content"),
    "item": ("item", "p"),
    "row_of_content": ("tr", "content"),
    "notes": ("remark",),
    "list": ("blockList",),
    "designator": ("num", "content", "p"),
    "nbsp": ("br",),
}
#: Ids that count through a regulation, and ids that continue that of the parent.
GLOBAL_IDS = {"section": "sec", "chapter": "chap", "part": "part", "division": "division", "article": "article", "appendix": "hcontainer", "matter": "hcontainer"}
LOCAL_IDS = {"subchapter": "_subchap_", "subdivision": "_subdivision_", "subpart": "__subpart_", "subarticle": "_subarticle_", "content": "__hcontainer_", "subsection": "__subsec_"}
#: Ids that differ by the context: as above, the first of nested contents being 2.
IDS_WITHIN = {("subdivision", "subdivision"): "_division_", ("content", "content"): "_content_", ("group", "content"): "hcontainer"}

#: Numbers of elements for each node: those that it opens, from its own number times this on.
SLOTS = 4
_ROOT = "regulation"
_LEFT_OUT = ("drop", "ignored")


def rules() -> list[tuple]:
    """(context, tag, kind, becomes, action, place, first, second, prefix, counts): a row for each case.

    first and second: the elements that are opened. prefix: that of the id; counts: whether it goes through the
    regulation (all) or through the siblings (own), null without an id.
    """
    action = {name: kind for kind, names in ACTIONS.items() for name in names}
    out, contexts_seen = [], set()

    def add(context: str, tag: str, kind: str, becomes: str, place: str) -> None:
        elements = ELEMENTS.get(becomes, (becomes,))
        within = IDS_WITHIN.get((context, becomes))
        everywhere = within if within == "hcontainer" else GLOBAL_IDS.get(becomes)
        own = None if everywhere else within or LOCAL_IDS.get(becomes)
        counts = "all" if everywhere else "own" if own else None
        out.append((context, tag.lower(), kind.lower(), becomes, action.get(becomes, "make"), place, elements[0], elements[-1], everywhere or own, counts))

    for table in (CODES, MARKUP):
        for contexts, cases in table.items():
            for context in (contexts,) if isinstance(contexts, str) else contexts:
                contexts_seen.add(context)
                for becomes, place, names in cases:
                    for name in names:
                        add(context, "code" if table is CODES else name, name if table is CODES else "", becomes, place)
    for context in contexts_seen - {"section"}:
        add(context, "version", "", "dropped", "into")
    return sorted(out)


RULE_COLUMNS = "context string, tag string, kind string, becomes string, action string, place string, first string, second string, prefix string, counts string"


def rule_table(spark, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or rules(), RULE_COLUMNS)


def _named_rules(rule_rows: DataFrame) -> DataFrame:
    """Rules with name, a number for each tag and kind that they have."""
    named = rule_rows.withColumnsRenamed({"tag": "r_tag", "kind": "r_kind", "context": "r_context"})
    return checkpoint(named.withColumn("name", F.dense_rank().over(Window.orderBy("r_tag", "r_kind"))))  # some hundred rows


def _prepared(nodes: DataFrame, named: DataFrame) -> DataFrame:
    """nodes with name, rescinded, inner and open.

    name: the number of the tag and kind that rules go by, null where none has them. The kind is ruleofsections for rules that
    hold articles or sections, and empty but for code. inner: whether the node has children; open: whether a sibling or the node itself has.
    """
    coded = F.lower("tag") == "code"
    holds = F.coalesce(coded & F.lower("kind").isin("article", "section"), F.lit(False))
    mark = F.col("mark")
    # Each node stands beside the marks that its children leave, so nodes are made once and windows over parts of a table dealt by reg need no shuffle.
    twice = nodes.withColumn("mark", F.explode(F.array(F.lit(False), F.lit(True)))).where("NOT mark OR parent IS NOT NULL")
    beside = twice.select(
        "reg", *[F.when(~mark, F.col(c)).alias(c) for c in nodes.columns if c != "reg"], "mark",
        F.when(mark, F.col("parent")).otherwise(F.col("node")).alias("key"), F.when(mark, holds).alias("holds"),
    )
    known = beside.withColumn("holds", F.max("holds").over(Window.partitionBy("reg", "key"))).where("NOT mark")
    kind = F.when(F.col("holds") & (F.lower("kind") == "rule"), "ruleofsections").otherwise(F.lower(F.coalesce("kind", F.lit(""))))
    ruled = known.select(*nodes.columns, F.when(coded, kind).otherwise("").alias("rule_kind"), F.col("holds").isNotNull().alias("inner"))
    opened = ruled.withColumn("open", F.max("inner").over(Window.partitionBy("reg", "parent")))
    names = F.broadcast(named.select("r_tag", "r_kind", "name").distinct())
    rescinded = F.coalesce(F.lower(F.trim("title")).rlike("^\\[?rescind"), F.lit(False))
    return opened.join(names, (F.lower("tag") == F.col("r_tag")) & (F.col("rule_kind") == F.col("r_kind")), "left").select(*nodes.columns, "name", rescinded.alias("rescinded"), "inner", "open")


def _state(placed: DataFrame, carried: list[str]) -> DataFrame:
    """What the children of placed nodes, and the result, need of them.

    placed: nodes with their rule, the parent's state under p_ and the place ``at`` they go to.
    """
    el = F.col("node") * SLOTS
    opens = F.col("action").isin("make", "wrap", "inline")
    wraps, inner = F.col("action") == "wrap", F.when(F.col("action") == "wrap", el + 1).otherwise(el)
    holds = F.col("action").isin("make", "wrap")
    local, whole = F.col("counts") == "own", F.col("counts") == "all"
    hoisted = (F.col("place") == "outer") & (F.col("becomes") == "subsection")
    from_anchor = F.when(hoisted, F.col("p_outer_anchor")).otherwise(F.col("p_anchor"))
    from_suffix = F.when(hoisted, F.col("p_outer_suffix")).otherwise(F.col("p_suffix"))
    siblings = Window.partitionBy("reg", "parent", "prefix").orderBy("node")
    nth = F.row_number().over(siblings) + F.when(F.col("prefix") == "_content_", 1).otherwise(0)
    anchor = F.when(whole, F.col("node")).otherwise(from_anchor)
    suffix = F.when(whole, "").when(local, F.concat(from_suffix, F.col("prefix"), nth.cast("string"))).otherwise(from_suffix)
    return placed.select(
        *carried, "becomes", "action", "first", "second", "prefix", "counts", "at",
        F.when(opens | (F.col("action") == "split"), el).alias("el"),
        F.when(opens, inner).otherwise(F.col("at")).alias("into"),
        F.when(wraps, el).when(opens, F.when(holds, F.col("at")).otherwise(F.col("p_up"))).otherwise(F.col("p_up")).alias("up"),
        F.when(holds, F.col("at")).otherwise(F.col("p_outer")).alias("outer"),
        anchor.alias("anchor"), suffix.alias("suffix"),
        F.when(holds, F.col("p_anchor")).otherwise(F.col("p_outer_anchor")).alias("outer_anchor"),
        F.when(holds, F.col("p_suffix")).otherwise(F.col("p_outer_suffix")).alias("outer_suffix"),
    )


def rewritten(nodes: DataFrame, rule_rows: DataFrame) -> DataFrame:
    """nodes with what each became: (..., becomes, action, first, second, prefix, counts, at, el, into, anchor, suffix).

    el: the first element that it opens; at: the element that this is put in. anchor: the node whose id counts
    through the regulation and begins this one's; suffix: what follows there. Sections whose title begins
    with rescind are dropped.
    """
    spark = nodes.sparkSession
    work = run_folder(spark, "levels")
    named = _named_rules(rule_rows)
    prepared = stored(_prepared(nodes, named), f"{work}/nodes")
    narrow, out = ["reg", "node", "parent", "name", "rescinded", "inner"], ["becomes", "action", "first", "second", "prefix", "counts", "at", "el", "into", "anchor", "suffix"]
    el, none = F.col("node") * SLOTS, F.lit(None).cast("string")
    made = prepared.where("parent IS NULL").select(
        *narrow, F.lit(False).alias("gone"), F.lit(_ROOT).alias("becomes"), F.lit("make").alias("action"), F.lit(ELEMENTS[_ROOT][0]).alias("first"), F.lit(ELEMENTS[_ROOT][0]).alias("second"),
        none.alias("prefix"), none.alias("counts"), F.lit(None).cast("long").alias("at"), el.alias("el"),
        el.alias("into"), el.alias("up"), el.alias("outer"), F.col("node").alias("anchor"), F.lit("").alias("suffix"), F.col("node").alias("outer_anchor"), F.lit("").alias("outer_suffix"),
    )
    made, turn = stored(made, f"{work}/states/level=0"), 0
    below, levels = prepared.where("parent IS NOT NULL"), f"{work}/states"
    rest, last = below.where("open").select(*narrow), below.where("NOT open")
    while not made.isEmpty():
        met, turn = stored(_met(rest, made, "left"), f"{work}/met{turn % 2}"), turn + 1
        rest = met.where("p_node IS NULL").select(*narrow)
        made = stored(_placed(met.where("p_node IS NOT NULL"), named, [*narrow, "gone"]), f"{levels}/level={turn}")
    states = spark.read.schema(made.schema).parquet(levels).where("NOT gone")
    first = prepared.where("open OR parent IS NULL").select(*nodes.columns).join(states.select("reg", "node", *out).hint("merge"), ["reg", "node"])
    then = _placed(_met(dealt(last, "reg", "parent"), states.where(F.col("inner") & ~F.col("action").isin(*_LEFT_OUT)), "inner"), named, nodes.columns)
    columns = [*nodes.columns, *out]
    folder = run_folder(spark, "tree")
    stored(first.select(*columns), folder)  # one after the other, so their shuffles are not on disk at once
    whole = stored(then.select(*columns), folder, "append")
    emptied(spark, work)
    return whole


def _met(rest: DataFrame, made: DataFrame, how: str) -> DataFrame:
    """rest with the states of those of their parents that are made, under p_."""
    state = ("becomes", "action", "into", "up", "outer", "anchor", "suffix", "outer_anchor", "outer_suffix")
    above = made.where("inner").select(F.col("reg").alias("p_reg"), F.col("node").alias("p_node"), *[F.col(c).alias(f"p_{c}") for c in state])
    return rest.join(above.hint("merge"), (F.col("reg") == F.col("p_reg")) & (F.col("parent") == F.col("p_node")), how)


def _placed(met: DataFrame, named: DataFrame, carried: list) -> DataFrame:
    """The states of nodes that have met their parents, all siblings together."""
    ruled = met.join(F.broadcast(named.withColumnRenamed("name", "r_name")), (F.col("p_becomes") == F.col("r_context")) & (F.col("name") == F.col("r_name")), "left")
    gone = F.col("p_action").isin(*_LEFT_OUT)  # what is above was left out
    rescinded = (F.col("becomes") == "section") & F.col("rescinded")
    action = F.when(gone | rescinded, "drop").otherwise(F.coalesce("action", F.lit("ignored")))
    ruled = ruled.withColumns({"action": action, "gone": gone}).withColumns({c: F.when(~F.col("action").isin(*_LEFT_OUT), F.col(c)) for c in ("becomes", "place", "first", "second", "prefix", "counts")})
    before = Window.partitionBy("reg", "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("node") * SLOTS
    split = F.col("action") == "split"
    last_para = F.last(F.when(split, own + 2).when(F.col("becomes") == "p", own), True).over(before)
    last_content = F.last(F.when(split, own + 1), True).over(before)
    at = (
        F.when(F.col("place") == "up", F.col("p_up")).when(F.col("place") == "outer", F.col("p_outer"))
        .when(F.col("place") == "para", F.coalesce(last_para, F.col("p_into"))).when(F.col("place") == "content", F.coalesce(last_content, F.col("p_into"))).when(F.col("place") == "into", F.col("p_into"))
    )
    return _state(ruled.withColumn("at", at), carried)


def ignored(tree: DataFrame) -> DataFrame:
    """(tag, kind, n): what no rule names, without what is below it."""
    return tree.where("action = 'ignored'").groupBy("tag", "kind").agg(F.count(F.lit(1)).alias("n"))


def with_ids(tree: DataFrame) -> DataFrame:
    """tree without what was left out, with eid; ids that count through a regulation do so in document order."""
    kept = tree.where("action NOT IN ('drop', 'ignored')")
    turn = Window.partitionBy("reg", "prefix").orderBy("node")
    counted = kept.where("counts = 'all'").select("reg", F.col("node").alias("anchor"), F.concat("prefix", F.lit("_"), F.row_number().over(turn).cast("string")).alias("begins"))
    joined = kept.join(counted.hint("merge"), ["reg", "anchor"], "left")
    eid = F.when(F.col("counts").isNotNull(), F.concat(F.coalesce("begins", F.lit("")), "suffix"))
    return joined.withColumn("eid", eid).select(*kept.columns, "eid")


def elements(tree: DataFrame) -> DataFrame:
    """(reg, el, parent, element, eid, num, heading, text) of a tree with ids, texts without an element as #text.

    Siblings are in the order of el. Headings of groups begin with their kind.
    """
    named = F.lower(F.col("becomes")).eqNullSafe("group") & ~F.coalesce(F.lower("kind").isin("undesignated", "unprefixed"), F.lit(True))
    heading = F.when(named, F.concat("kind", F.lit(" - "), "title")).otherwise(F.col("title"))
    none, own = F.lit(None).cast("string"), F.col("node") * SLOTS

    def element(el: Column, parent: Column, name: Column, eid=none, num=none, head=none, text=none) -> Column:
        return F.struct(el.alias("el"), parent.alias("parent"), name.alias("element"), eid.alias("eid"), num.alias("num"), head.alias("heading"), text.alias("text"))

    at, text = F.col("at"), F.col("text")
    one = F.array(element(own, at, F.col("first"), F.col("eid"), F.col("num"), heading, text))
    two = F.array(element(own, at, F.col("first"), F.col("eid"), F.col("num"), heading), element(own + 1, own, F.col("second"), text=text))
    three = F.array(element(own, at, F.lit("num"), text=text), element(own + 1, at, F.lit("content")), element(own + 2, own + 1, F.lit("p")))
    bare = F.when(text != "", F.array(element(own, at, F.lit("#text"), text=text)))
    action = F.col("action")
    opened = F.when(action.isin("make", "inline"), one).when(action == "wrap", two).when(action == "split", three).when(action == "pass", bare)
    return tree.select("reg", F.explode(opened).alias("e")).select("reg", "e.*")


def assembled(tree: DataFrame, parts: DataFrame) -> DataFrame:
    """Rewritten trees of parts as trees of whole regulations, reg being their key.

    parts: (reg, key, subnum), the regulation that each tree belongs to and its place there, those without a
    place last. Node numbers go on from part to part, what stood at the root of a later part stands at that
    of the first. Sections with a number that an earlier part has are left out with all that was put in them.
    """
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.asc_nulls_last("subnum"), "reg"))
    kept = tree.where("action NOT IN ('drop', 'ignored')").join(parts.select("reg", "key", rank.alias("part")), "reg")
    ends = kept.groupBy("key", "part").agg(F.max("node").alias("most"), F.min(F.when(F.col("parent").isNull(), F.col("el"))).alias("root"))
    earlier = Window.partitionBy("key").orderBy("part")
    shift = F.coalesce(F.sum("most").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = kept.join(ends.select("key", "part", F.col("root").alias("own_root"), shift.alias("shift"), F.first("root").over(earlier).alias("top")), ["key", "part"])
    moved = {c: F.col(c) + F.col("shift") for c in ("node", "parent", "anchor")} | {c: F.col(c) + F.col("shift") * SLOTS for c in ("el", "into")}
    at = F.when((F.col("at") == F.col("own_root")) & (F.col("part") > 1), F.col("top")).otherwise(F.col("at") + F.col("shift") * SLOTS)
    rows = placed.where("part = 1 OR parent IS NOT NULL").withColumns(moved | {"at": at}).withColumn("reg", F.col("key")).select(*tree.columns, "part")
    rows = checkpoint(rows.withColumn("owner", F.floor(F.col("at") / SLOTS).cast("long")))
    number = F.trim(F.regexp_replace("num", "\\s+", " "))
    numbered = rows.where("becomes = 'section'").select("reg", "node", "part", number.alias("number")).where("number IS NOT NULL")
    gone = checkpoint(numbered.withColumn("first", F.min("part").over(Window.partitionBy("reg", "number"))).where("part > first").select("reg", "node"))
    out = gone
    while not gone.isEmpty():  # a level of what was put in them at a time
        gone = checkpoint(rows.join(gone.withColumnRenamed("node", "owner"), ["reg", "owner"], "left_semi").select("reg", "node"))
        out = out.unionByName(gone)
    return rows.join(out.distinct(), ["reg", "node"], "left_anti").select(*tree.columns)


def with_paths(rows: DataFrame) -> DataFrame:
    """rows (reg, el, parent, ...) with path, the numbers from the root to each; those without a way to a root are left out.

    Paths are made for the numbers of elements that have children; whole rows meet that of their parent once.
    rows are read several times, so store what is dear to make.
    """
    spark, carried = rows.sparkSession, rows.columns
    work = run_folder(spark, "steps")
    parents = rows.where("parent IS NOT NULL").select("reg", F.col("parent").alias("el")).distinct()
    inner = stored(rows.select("reg", "el", "parent").join(parents.hint("merge"), ["reg", "el"], "left_semi"), f"{work}/inner")
    made, rest = inner.where("parent IS NULL").select("reg", "el", F.array("el").alias("path")), inner.where("parent IS NOT NULL")
    paths = run_folder(spark, "paths")
    whole, turn = stored(made, paths), 0

    def met(lower: DataFrame, upper: DataFrame, how: str) -> DataFrame:
        above = upper.select(F.col("reg").alias("p_reg"), F.col("el").alias("p_el"), F.col("path").alias("p_path"))
        return lower.join(above.hint("merge"), (F.col("reg") == F.col("p_reg")) & (F.col("parent") == F.col("p_el")), how)

    while not made.isEmpty():
        step = stored(met(rest, made, "left").select("reg", "el", "parent", F.concat("p_path", F.array("el")).alias("path")), f"{work}/step{turn % 2}")
        rest, made, turn = step.where("path IS NULL").drop("path"), step.where("path IS NOT NULL").drop("parent"), turn + 1
        whole = stored(made, paths, "append")
    emptied(spark, work)
    tops = rows.where("parent IS NULL").withColumn("path", F.array("el"))
    return tops.unionByName(met(rows.where("parent IS NOT NULL"), whole, "inner").select(*carried, F.concat("p_path", F.array("el")).alias("path")))


def _xml(text: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def documents(found: DataFrame) -> DataFrame:
    """(reg, xml): elements as one text a regulation.

    Each element gives an opening and a closing mark; sorted by their paths these are the document.
    """
    found = stored(found, run_folder(found.sparkSession, "elements"))
    part = lambda tag, x: F.coalesce(F.concat(F.lit(f"<{tag}>"), _xml(x), F.lit(f"</{tag}>")), F.lit(""))
    text = F.coalesce(_xml(F.col("text")), F.lit(""))
    eid = F.coalesce(F.concat(F.lit(' eId="'), F.replace(_xml(F.col("eid")), F.lit('"'), F.lit("&quot;")), F.lit('"')), F.lit(""))
    bare = F.col("element") == "#text"
    begins = F.when(bare, text).otherwise(F.concat(F.lit("<"), "element", eid, F.lit(">"), part("num", F.col("num")), part("heading", F.col("heading")), text))
    rows = dealt(with_paths(found).select("reg", "path", begins.alias("mark"), F.when(~bare, F.col("element")).alias("element")), "reg", counted=found)
    packed = rows.groupBy("reg").agg(F.collect_list(F.struct("path", "mark", "element")).alias("m"))
    ends = F.transform(F.filter("m", lambda x: x["element"].isNotNull()), lambda x: F.struct(F.concat(x["path"], F.array(F.lit(2**63 - 1))).alias("path"), F.concat(F.lit("</"), x["element"], F.lit(">")).alias("mark")))
    marks = F.array_sort(F.concat(F.transform("m", lambda x: F.struct(x["path"].alias("path"), x["mark"].alias("mark"))), ends))
    return packed.select("reg", F.concat_ws("", marks["mark"]).alias("xml"))
