"""Rewriting of regulation trees against a recursion in Python, and by hand."""

import random
from pathlib import Path
from xml.etree import ElementTree

import pytest

from quillstack.operators import trees
from quillstack.session import shared_folder
from quillstack.sources import containers

NODES = "reg string, node long, parent long, tag string, kind string, num string, title string, text string"


def numbered(reg, tree):
    """Rows of a nested (tag, kind, num, title, text, children)."""
    rows = []

    def walk(item, parent):
        tag, kind, num, title, text, children = item
        node = len(rows) + 1
        rows.append((reg, node, parent, tag, kind, num, title, text))
        for child in children:
            walk(child, node)

    walk(tree, None)
    return rows


def code(kind, *children, num=None, title=None, text=None):
    return ("code", kind, num, title, text, children)


def tag(name, *children, text=None, title=None, num=None):
    return (name, None, num, title, text, children)


def document(spark, *regs):
    rows = [r for k, tree in enumerate(regs) for r in numbered(f"r{k}", tree)]
    tree = trees.rewritten(spark.createDataFrame(rows, NODES), trees.rule_table(spark))
    return {r["reg"]: r["xml"] for r in trees.documents(trees.elements(trees.with_ids(tree))).collect()}


def test_contexts_actions_and_places(spark):
    nested = code("Title", code("Chapter", code("Section", num="1"), code("Chapter", code("Rule", code("Section", num="2"), title="Of rules"), code("Rule", num="3")), code("Section", num="4")))
    section = code(
        "Title",
        code(
            "Section",
            tag("version", text="v1"),
            tag("content", tag("currency", text="now"), tag("codetext", tag("para", tag("bold", text="B"), tag("strike", text="no"), tag("li", text="item"), text="P "), tag("subsect", tag("para", text="lost p")), tag("unknown", tag("para")))),
            tag("content", tag("content", tag("codetext")), title="Inner"),
        ),
        code("Section", title=" [RESCINDED eff. 1]"),
    )
    split = code("Title", code("Section", tag("subsect", tag("bold", text="x"), tag("designator", text="(a)"), tag("italic", text="y"), tag("para", text="p"), tag("bold", text="z"), tag("designator", text="(b)"), tag("para", text="q"))))
    parts = code("Title", code("Part", code("Undesignated", code("Section"), num="2"), code("Subpart", code("Subpart"), tag("content", text="c")), num="1"), code("Appendix", code("Exhibit", title="E & F"), code("Unprefixed", title="U")))
    got = document(spark, nested, section, split, parts)
    assert got["r0"] == (
        '<body><chapter eId="chap_1"><section eId="sec_1"><num>1</num></section><section eId="sec_4"><num>4</num></section></chapter>'
        '<chapter eId="chap_2"><hcontainer><heading>Rule - Of rules</heading><section eId="sec_2"><num>2</num></section></hcontainer><section eId="sec_3"><num>3</num></section></chapter></body>'
    )
    assert got["r1"] == (
        '<body><section eId="sec_1"><version>v1</version><hcontainer eId="sec_1__hcontainer_1"><content><remark>now</remark><p>P <b>B</b>item</p></content></hcontainer>'
        '<subsection eId="sec_1__subsec_1"><p>lost p</p></subsection><hcontainer eId="sec_1__hcontainer_2"><heading>Inner</heading><content></content></hcontainer>'
        '<hcontainer eId="sec_1__hcontainer_2_content_2"><content></content></hcontainer></section></body>'
    )
    assert got["r2"] == (
        '<body><section eId="sec_1"><subsection eId="sec_1__subsec_1"><b>x</b><num>(a)</num><content><p><i>y</i></p><p>p<b>z</b></p></content><num>(b)</num><content><p></p><p>q</p></content></subsection></section></body>'
    )
    assert got["r3"] == (
        '<body><part eId="part_1"><num>1</num><subpart eId="part_1__subpart_1"><subpart eId="part_1__subpart_1__subpart_1"></subpart><hcontainer eId="part_1__subpart_1__hcontainer_1"><content>c</content></hcontainer></subpart></part>'
        '<part eId="part_2"><num>2</num><section eId="sec_1"></section></part>'
        '<hcontainer eId="hcontainer_1"><hcontainer><heading>Exhibit - E &amp; F</heading></hcontainer><hcontainer><heading>U</heading></hcontainer></hcontainer></body>'
    )
    for xml in got.values():
        ElementTree.fromstring(xml)


def test_what_no_rule_names_is_counted_once(spark):
    rows = numbered("r", code("Title", code("Mystery", tag("odd", tag("odd"))), tag("odd"), code("Section", tag("odd"))))
    tree = trees.rewritten(spark.createDataFrame(rows, NODES), trees.rule_table(spark))
    assert sorted((r["tag"], r["kind"], r["n"]) for r in trees.ignored(tree).collect()) == [("code", "Mystery", 1), ("odd", None, 2)]
    assert trees.rewritten(spark.createDataFrame([], NODES), trees.rule_table(spark)).count() == 0


def by_hand(rows):
    """The document of one regulation's rows, by recursion."""
    rules = {r[:3]: r[3:] for r in trees.rules()}
    below = {}
    for r in rows:
        below.setdefault(r[2], []).append(r)
    counts, ids = {}, {}

    def new(parent, name):
        return ElementTree.SubElement(parent, name)

    def walk(row, context, own, up, outer, own_id, outer_id):
        opened = {"para": own, "content": own}
        turns = {}
        for _, node, _, tag_, kind, num, title, text in below.get(row[1], []):
            ruled = kind
            if (tag_, kind) == ("code", "Rule") and any(c[3] == "code" and c[4] in ("Article", "Section") for c in below.get(node, [])):
                ruled = "RuleOfSections"
            rule = rules.get((context, tag_.lower(), ruled.lower() if tag_ == "code" else ""))
            if rule is None or rule[1] == "drop" or rule[0] == "section" and (title or "").lower().startswith("[rescind"):
                continue
            becomes, action, place, first, second, prefix, numbering = rule
            at = {"into": own, "up": up, "outer": outer, **opened}[place]
            base = outer_id if place == "outer" and becomes == "subsection" else own_id
            eid = None
            if numbering == "all":
                counts[prefix] = counts.get(prefix, 0) + 1
                eid = f"{prefix}_{counts[prefix]}"
            elif numbering == "own":
                turns[prefix] = turns.get(prefix, int(prefix == "_content_")) + 1
                eid = base + prefix + str(turns[prefix])
            now = base if eid is None else eid
            if action == "pass":
                if text:
                    new(at, "bare").text = text
                walk((None, node), becomes, at, up, outer, now, outer_id)
                continue
            element = new(at, first)
            if action == "split":
                element.text = text
                opened["content"] = new(at, "content")
                opened["para"] = new(opened["content"], "p")
                walk((None, node), becomes, at, up, outer, now, outer_id)
                continue
            if eid:
                element.set("eId", eid)
            if becomes == "group" and kind not in ("Undesignated", "Unprefixed") and title is not None:
                title = f"{kind} - {title}"
            for name, value in (("num", num), ("heading", title)):
                if value is not None:
                    new(element, name).text = value
            inner = new(element, second) if action == "wrap" else element
            if text is not None:
                new(inner, "bare").text = text
            if becomes == "p":
                opened["para"] = element
            if action == "inline":
                walk((None, node), becomes, inner, up, outer, now, outer_id)
            else:
                walk((None, node), becomes, inner, element if action == "wrap" else at, at, now, own_id)

    root = rows[0]
    body = ElementTree.Element("body")
    for name, value in (("num", root[5]), ("heading", root[6])):
        if value is not None:
            new(body, name).text = value
    if root[7] is not None:
        new(body, "bare").text = root[7]
    walk(root, "regulation", body, body, body, "", "")
    return ElementTree.tostring(body, encoding="unicode", short_empty_elements=False).replace("<bare>", "").replace("</bare>", "")


LEVELS = (
    ["Chapter", "Part", "Division", "Article", "Section", "Rule"],
    ["Chapter", "Section", "Rule", "Undesignated", "Subchapter", "Division", "Appendix", "Subpart", "content:"],
    ["Section", "Undesignated", "Subarticle", "content:", "subsect:", "Exhibit", "Rule"],
    ["content:", "subsect:", "codetext:", "notes:", "Section", "Table", "itemizedlist:"],
    ["codetext:", "para:", "subsect:", "designator:", "bold:", "notes-history:", "listitem:", "content:"],
    ["para:", "bold:", "subsect:", "designator:", "note:", "table:", "strike:"],
)


@pytest.mark.parametrize("seed", range(2))
def test_random_trees_match_a_recursion(spark, seed):
    rnd = random.Random(seed)

    def made(level):
        pick = rnd.choice(LEVELS[min(level, len(LEVELS) - 1)])
        children = [made(level + 1) for _ in range(rnd.randrange(4) if level < 8 else 0)]
        title = rnd.choice([None, "T", "[Rescinded]"]) if rnd.random() < 0.3 else None
        return (pick[:-1] if ":" in pick else "code", None if ":" in pick else pick, rnd.choice([None, "1"]), title, rnd.choice([None, "x & y"]), children)

    regs = [code("Title", *[made(0) for _ in range(5)], num="9", title="All", text="t") for _ in range(4)]
    got = document(spark, *regs)
    for k, tree in enumerate(regs):
        assert got[f"r{k}"] == by_hand(numbered(f"r{k}", tree))


def test_parts_make_whole_regulations(spark):
    one = code("Title", code("Chapter", code("Section", num="1"), code("Section", num=" 2 "), num="I"))
    two = code("Title", code("Chapter", code("Section", code("Section"), tag("content", tag("subsect")), num="2"), code("Section", num="3"), code("Section", num="3"), num="II"))
    last = code("Title", code("Section", num="4"), code("Section", num="1", title="again"), code("Section"))
    rows = [*numbered("b", two), *numbered("a", one), *numbered("c", last), *numbered("alone", one)]
    tree = trees.rewritten(spark.createDataFrame(rows, NODES), trees.rule_table(spark))
    parts = spark.createDataFrame([("b", "k", 2), ("a", "k", 1), ("c", "k", None), ("alone", "l", None)], "reg string, key string, subnum int")
    got = {r["reg"]: r["xml"] for r in trees.documents(trees.elements(trees.with_ids(trees.assembled(tree, parts)))).collect()}
    assert got["k"] == (
        '<body><chapter eId="chap_1"><num>I</num><section eId="sec_1"><num>1</num></section><section eId="sec_2"><num> 2 </num></section></chapter>'
        '<chapter eId="chap_2"><num>II</num><section eId="sec_3"><num>3</num></section><section eId="sec_4"><num>3</num></section></chapter>'
        '<section eId="sec_5"><num>4</num></section><section eId="sec_6"></section></body>'
    )
    assert got["l"].count("<section") == 2


def test_documents_escape_and_missing_parents_stand_in_the_body(spark):
    rows = [("r", 1, 9, "sec", 'a"b', "1", "<T>", "x & y"), ("r", 2, 1, None, None, None, None, None)]
    made = spark.createDataFrame(rows, "reg string, node int, parent int, becomes string, eid string, num string, title string, text string")
    assert containers.akn_document(made).first()["xml"] == '<body><sec eId="a&quot;b"><num>1</num><heading>&lt;T&gt;</heading>x &amp; y<block></block></sec></body>'


def test_childless_siblings_wait(spark, monkeypatch):
    """Only nodes with children, or siblings with children, go down the levels; the others meet their parents once."""
    rows = [(1, 1, None, "regulation", None, None, None, None)]
    rows += [(1, 2, 1, "code", "Chapter", "1", "c", None), (1, 3, 2, "code", "Section", "2", "s", None), (1, 4, 3, "content", None, None, None, None), (1, 5, 4, "codetext", None, None, None, "t")]
    rows += [(1, 10 + k, 5, "para", None, None, None, str(k)) for k in range(20)]
    seen, met = [], trees._met
    monkeypatch.setattr(trees, "_met", lambda rest, made, how: seen.append((how, rest.count())) or met(rest, made, how))
    tree = trees.rewritten(spark.createDataFrame(rows, NODES), trees.rule_table(spark))
    assert tree.where("becomes = 'p'").count() == 20
    assert seen[-1] == ("inner", 20) and max(n for how, n in seen if how == "left") == 4


def test_texts_are_moved_once(spark):
    """Texts do not go down the levels, and steps leave nothing on disk; nodes below one that was left out are no part of the tree."""
    rnd = random.Random(3)
    chain = tag("content", tag("codetext", *[tag("para", text=rnd.randbytes(20_000).hex()) for _ in range(20)], text=rnd.randbytes(20_000).hex()))
    for _ in range(6):
        chain = code("Chapter", chain, tag("odd", tag("para", text=rnd.randbytes(20_000).hex())), num="1", text=rnd.randbytes(20_000).hex())
    rows = numbered("r", code("Title", code("Chapter", code("Section", chain)), code("Section", tag("content", tag("codetext", tag("para", text="t"))))))
    nodes = spark.createDataFrame(rows, NODES)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    before = size()
    tree = trees.rewritten(nodes, trees.rule_table(spark))
    assert size() - before < 1.1 * sum(len(r[-1] or "") for r in rows)
    found = {r["node"]: r["action"] for r in tree.select("node", "action").collect()}
    out = {"drop", "ignored"}
    assert found[1] == "make" and len(found) < len(rows)
    assert set(found) == {1} | {r[1] for r in rows if found.get(r[2], "drop") not in out}
    assert trees.elements(trees.with_ids(tree)).where("text = 't'").count() == 1
