"""HTML extraction, SimHash, toxicity, language ID and the quality classifier."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillstack.llm import graph, html_extract, language_id, near_copies, quality_model, simhash, text_features, toxicity
from quillstack.llm.common import join_named

PARAS = [" ".join(f"word{chr(97 + (k * 7 + j) % 26)}{j % 9}" for j in range(30)) + "." for k in range(6)]


def page(body, nav=True):
    menu = "<div class='nav-bar'><ul><li><a href=/a>Alpha</a><li><a href=/b>Beta</a></ul></div>" if nav else ""
    return f"<html><head><title>t</title><script>if (a < b) x('<p>')</script></head><body>{menu}{body}<div id=footer>&copy; us</div></body></html>"


def article(k, cls="post"):
    paras = "".join(f"<p>{p}</p>" for p in PARAS[:k])
    return f"<div class='{cls} item-{k}'><h1>Head &amp; tail</h1>{paras}<div class='share'>Tweet</div><form><p>Sign up</p></form><section class=comments><p>First!</p></section></div><div class=sidebar><p>Other news and more of it here</p></div>"


def test_html_extraction(spark):
    rows = [(k, f"http://a.example/{k}", page(article(k))) for k in range(2, 7)]
    rows += [(10, "http://b.example/", None), (11, None, ""), (12, "http://b.example/x", "<p>no closing <b>tags &lt;here&gt;\n\n at   all<br>ok"), (13, "http://b.example/n", page("<p>  </p>"))]
    rows += [(2, "http://a.example/2", page(article(2)))]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, n_chars int")
    got = html_extract.extract_pages(pages.repartition(3)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    for k in range(2, 7):
        assert by[k]["text"] == "\n".join(["Head & tail", *PARAS[:k]]) and by[k]["n_chars"] == len(by[k]["text"])
    assert by[10]["text"] == by[11]["text"] == "" and by[12]["text"] == "no closing tags <here> at all ok" and by[13]["text"] == ""
    paths = {r["host"]: r["path"] for r in html_extract.host_paths(pages.where("page_id < 10")).collect()}
    assert paths == {"a.example": "/body/div.item-#.post"}
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_html_uses_the_host_path():
    # this page's own choice would be the long list; its host's path holds enough of it
    html = page("<div class=main><p>" + PARAS[0] + "</p></div>", nav=False)
    assert html_extract.extract(html, "/body/div.main") == PARAS[0]
    assert html_extract.extract(html, "/body/div.gone") == PARAS[0]
    assert html_extract.extract("<article><header><h1>T</h1></header><p>a<aside>b</aside>c</article>", None) == "T\na\nc"
    side = "<div class='page with-sidebar'><div class='banner'><h1>T</h1><p>a b</p></div><div class=sidebar><p>x</p></div></div>"
    assert html_extract.extract(side, None) == "T\na b"
    firm = "<div class=main><p>a b c d e f g</p></div><div class='comments'><h1>Comments</h1><p>first</p></div>"
    assert html_extract.extract(firm, None) == "a b c d e f g"
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    assert html_extract.extract(deep, None) == "text"


@pytest.mark.parametrize(
    "html, text",
    [
        ("<body><h1>Title here</h1><p>Lead paragraph outside.</p><div class=text><p>Body one.</p><p>two</p></div></body>", "Title here\nLead paragraph outside.\nBody one.\ntwo"),
        ("<div class=hd><h2>Headline</h2></div><div class=text><p>Body one.</p></div>", "Headline\nBody one."),
        ("<h1>T</h1><p>lead</p><article><p>body body body body body</p></article>", "T\nlead\nbody body body body body"),
        ("<h1>Site</h1><article><h1>T</h1><p>body body body body body body body</p></article>", "T\nbody body body body body body body"),
        ("<article><p>six words here</p></article><article><p>and as many there</p></article>", "six words here\nand as many there"),
        ("<article><p>one two three</p></article><div><p>four five six</p></div>", "one two three\nfour five six"),
        ("<article>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</article>", "so x=2 holds"),
        ("<div class='social-history'><p>Old news of it</p></div><div class='social-links'><a href=x>share</a></div><p>end</p>", "Old news of it\nend"),
        ("<p>keep</p><div class='comment-guide'><a href=1>one</a> <a href=2>two</a></div>", "keep"),
        ("<p>keep</p><ul class='related-posts'><li>no</li></ul><div id=cookie-notice>no</div><div class=cookieNotice>no</div>", "keep"),
        ("<title>abc <p>text after</p>", "text after"),
        ("<p>keep</p><div class='article-comments'>no</div><div id=sidebar2>no</div><div class=topnav>no</div><div class='entry-share3'>no</div>", "keep"),
        ("<body><form id=page><input name=q><div class=box><h1>T</h1><p>in a form</p></div></form></body>", "T\nin a form"),
        ("<p>keep</p><form><p>Search</p><label>no</label></form>", "keep"),
        ("<p>a<![CDATA[x]]>b</p><p>c</p>", "ab\nc"),
        ("<p>a<object>o</object><video>v</video><noscript>no</noscript><svg><text>no</text></svg>z</p>", "a o v z"),
        ("<p>a<textarea>never closed</p><p>b</p>", "a never closed\nb"),
        ("<TEMPLATE><p>no</p></Template><p>yes &lt;&amp;&#x41;&nbsp;z</p>", "yes <&A z"),
        ("<select><option>no</select><p>yes</p><script>if (a<b) '</p>'", "yes"),
        ("<p>" + "<svg>" * 20_000 + "end", "end"),
    ],
)
def test_html_keeps_the_whole_article(html, text):
    assert html_extract.extract(html, None) == text
    assert html_extract.extract(html, "/body/div.other") == text


def neutral(rnd, host, k):
    """A page whose furniture has names that say nothing, and its article."""
    say = lambda n: " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rnd.randrange(99)) for _ in range(n)) + "."
    article = [f"Title {say(3)}", "Summary", say(40), say(30), *([say(5)] * (k % 3))]
    body = f"<h1>{article[0]}</h1><h2>{article[1]}</h2>" + "".join(f"<p>{x}</p>" for x in article[2:])
    box = f"<div class=k7><p>Get our letter every week on {host}.</p><p>{k} readers are here now, join them!</p></div>"
    top = "<div class=t1><div>Quality since 1901</div></div>"
    aside = f"<div class=x9>{say(6)}</div>" if k % 2 else ""  # says something else on each page, so it may be text
    return f"<html><body><div class=wrap>{top}<div class=txt>{body}</div>{box}{aside}</div></body></html>", "\n".join([*article, *([aside[14:-6]] if aside else [])])


def test_html_consensus_decides_what_is_furniture(spark):
    rnd = random.Random(31)
    rows, want = [], {}
    for h in range(6):
        for k in range(12):
            page_, text = neutral(rnd, f"h{h}.example", k)
            rows.append((100 * h + k, f"https://h{h}.example/{k}", page_))
            want[100 * h + k] = text
    copies = neutral(rnd, "copies.example", 0)[0]  # many copies of one page are one page: nothing repeats beside other text
    rows += [(1000 + k, f"https://copies.example/{k}", copies + f"<!-- {k} -->") for k in range(40)]
    few = [neutral(rnd, "few.example", k)[0] for k in range(3)]
    rows += [(2000 + k, f"https://few.example/{k}", p) for k, p in enumerate(few)]
    inside = "<article><h1>T{0}</h1><p>Words of article number {0} and more of them.</p><p>The same line in each of them.</p></article>"
    rows += [(3000 + k, f"https://art.example/{k}", inside.format(k)) for k in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    changed = {i // 100 for i, t in want.items() if html_extract.extract(dict((r[0], r[2]) for r in rows)[i], None) != got[i]}
    assert changed == set(range(6))  # the consensus changes the text on each of these hosts
    assert {i: got[i] for i in want} == want
    for k in range(40):
        assert "Get our letter" in got[1000 + k] and "Title" in got[1000 + k]
    assert all("Quality since 1901" in got[2000 + k] for k in range(3)) and all("The same line in each of them." in got[3000 + k] for k in range(12))
    paths = {r["host"]: r["path"] for r in html_extract.host_paths(pages).collect()}
    assert paths["h0.example"] == "/body/div.wrap" or paths["h0.example"] == "/body/div.wrap/div.txt"


def test_html_host_path_leaves_no_text_out():
    main, more = "<p>" + "main words " * 30 + "</p>", "<p>" + "more words " * 20 + "</p>"
    page_ = f"<div class=page><div class=text>{main}<ul><li><a href=x>a link in it</a></ul></div><div class=more>{more}<ul><li><a href=y>a link beside</a></ul></div></div>"
    text = html_extract.extract(page_, "/div.page/div.text")
    assert text.split("\n") == [("main words " * 30).strip(), "a link in it", ("more words " * 20).strip()]


def test_html_paths_of_deep_nodes_differ():
    deep = "".join(f"<div class='c{chr(97 + k % 26)}x{'y' * 20}'>" for k in range(80))
    nodes, _ = html_extract.read(deep + "<div class=one><p>a</p></div><div class=two><p>b</p></div>")
    paths = [n.path for n in nodes if n.tag == "div"]
    assert len(set(paths)) == len(paths) and max(map(len, paths)) <= html_extract.LONGEST_PATH


def kept(node):
    """A second reading of a page made of nested (tag, attributes, children): its blocks outside parts that are marked with no."""
    tag, attributes, children = node
    if "no" in attributes:
        return []
    out, text = [], ""
    for c in children:
        if isinstance(c, str):
            text += c
        elif c[0] in ("b", "i", "span"):
            text += "".join(c[2])
        else:
            out += [text, *kept(c)]
            text = ""
    return [" ".join(x.split()) for x in [*out, text] if x.strip()]


def drawn(rnd, depth=0):
    words = lambda n: " ".join(f"w{rnd.randrange(10**4)}" for _ in range(n))
    no = [("nav", {"no": ""}), ("aside", {"no": ""}), ("footer", {"no": ""}), ("form", {"no": ""}), ("div", {"no": "", "class": "cookie-bar"}), ("div", {"no": "", "id": "comments"}),
          ("div", {"no": "", "role": "search"}), ("section", {"no": "", "class": "related posts"}), ("ul", {"no": "", "class": "menu"}), ("div", {"no": "", "hidden": ""})]
    children = []
    for _ in range(rnd.randrange(2, 6)):
        kind = rnd.random()
        if kind < 0.4 or depth > 3:
            children.append(("p", {}, [words(9), ("b", {}, [words(2)]), " ", words(3)]))
        elif kind < 0.6:
            tag, attributes = rnd.choice(no)
            children.append((tag, attributes, [("p", {}, [words(6)])]))
        else:
            tag, attributes, inner = drawn(rnd, depth + 1)
            children.append((tag, attributes, inner))
    return rnd.choice(["div", "section", "blockquote"]), {"class": rnd.choice(["text", "body-text", "x1", "social-history", "entry"])}, children


def written(node):
    tag, attributes, children = node
    shown = "".join(f' {k}="{v}"' for k, v in attributes.items() if k != "no")
    return f"<{tag}{shown}>" + "".join(c if isinstance(c, str) else written(c) for c in children) + f"</{tag}>"


def test_html_query_matches_a_second_reading_of_drawn_pages(spark, tmp_path):
    rnd = random.Random(41)
    drawings = [drawn(rnd) for _ in range(60)]
    rows = [(k, f"https://h{k % 5}.example/{k}", "<html><body>" + written(d) + "</body></html>") for k, d in enumerate(drawings)]
    spark.createDataFrame([*rows, (None, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    from quillstack.llm.queries import op1_html_extraction

    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in op1_html_extraction(spark, str(tmp_path)).collect()}
    assert got == {None: ("", 0), **{k: ((t := "\n".join(kept(d))), len(t)) for k, d in enumerate(drawings)}}


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints):
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def test_fingerprints():
    for text in (None, "", " \n", "A", "a B", "Eins zwei DREI", "É ß é", "x y z\x1f w", "a b c " * 50, " ".join(map(str, range(400)))):
        assert simhash.fingerprint(text) == brute(text), text


def test_simhash_components_match_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 40, 400]))]
        for _ in range(6):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append(" ".join(text))
    rows += [None, "", "  \n"]
    ids = list(range(500, 500 + len(rows)))
    docs = spark.createDataFrame([(i, t, 9) for i, t in zip(ids, rows)], "doc_id long, text string, fp int")
    roots = brute_components([brute(t) for t in rows])
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(least.get(r, i), i)
    got = {r["doc_id"]: r["component"] for r in simhash.near_duplicates(docs.repartition(4)).collect()}
    assert got == {i: least[r] for i, r in zip(ids, roots)}
    kept = sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())
    assert kept == sorted(set(least.values())) and simhash.keep_one(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_of_components_with_null_and_shared_ids(spark):
    rnd = random.Random(12)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(80)) for _ in range(9)]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:7]] + [(8, texts[7]), (None, texts[8])]
    copies = [(None, texts[0]), (7, texts[4]), (None, texts[7]), (3, texts[8])]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([*rows[:8], (3, texts[8])], key=str)


def edited(rnd, words, changes):
    out = list(words)
    for at in rnd.sample(range(len(out)), changes):
        out[at] = f"x{rnd.randrange(10**6)}"
    return out


def five(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_copies_match_brute_force(spark):
    rnd = random.Random(13)
    bases = [[f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((60, 150, 400)))] for _ in range(40)]
    texts = [edited(rnd, b, k) for b in bases for k in (0, *[rnd.randrange(1, 2 + len(b) // 30) for _ in range(6)])]
    sets = [five(t) for t in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    up = list(range(len(texts)))
    for _ in texts:
        for a, b in near:
            up[a] = up[b] = min(up[a], up[b])
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for piece in (near_copies.PIECE, 2):
        found = near_copies.near_components(docs, piece=piece).collect()
        groups = {}
        for r in found:
            groups.setdefault(r["root"], []).append(r["id"])
        assert sorted(map(sorted, groups.values())) == sorted(sorted(k for k in range(len(texts)) if up[k] == u) for u in set(up))
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == sorted(set(up))


def linked(values, links):
    """The components of values by brute force, and by the links."""
    got = {r["node"]: r["root"] for r in graph.components(links).collect()}
    want, mine = {}, {}
    for v, r in zip(values, brute_components(values)):
        want.setdefault(r, set()).add(v)
        mine.setdefault(got.get(simhash._signed(v), simhash._signed(v)), set()).add(v)
    return sorted(map(sorted, want.values())), sorted(map(sorted, mine.values()))


def dense(rnd, n, cores):
    core = [rnd.getrandbits(64) for _ in range(cores)]
    values = set(core)
    while len(values) < n:
        c = rnd.choice(core)
        for _ in range(rnd.randrange(1, 5)):
            c ^= 1 << rnd.randrange(64)
        values.add(c)
    return sorted(values)


def test_near_copies_of_a_large_group_and_strangers(spark, monkeypatch):
    rnd = random.Random(23)
    base = [f"w{rnd.randrange(3000)}" for _ in range(200)]
    texts = [edited(rnd, base, rnd.choice((1, 2, 3))) for _ in range(120)]
    chain = [f"w{rnd.randrange(3000)}" for _ in range(200)]
    for _ in range(40):  # each is near to the one before, few to one further away
        chain = edited(rnd, chain, 3)
        texts.append(chain)
    sets = [five(t) for t in texts]
    up = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = up[a], up[b]
                up = [min(x, y) if u in (x, y) else u for u in up]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for piece, anchors in ((16, 2), (300, 16), (7, 16)):
        monkeypatch.setattr(near_copies, "ANCHORS", anchors)
        groups = {}
        for r in near_copies.near_components(docs, piece=piece).collect():
            groups.setdefault(r["root"], []).append(r["id"])
        assert sorted(map(sorted, groups.values())) == sorted(sorted(k for k in range(len(texts)) if up[k] == u) for u in set(up))


@pytest.mark.parametrize("limit", [simhash.BROADCAST_BYTES, 0])
def test_links_of_dense_shards(spark, limit):
    values = dense(random.Random(6), 900, 3)
    rows = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    for shard, piece in ((100, 64), (512, 2048)):
        links = simhash.near_links(rows, shard=shard, piece=piece, limit=limit)
        want, mine = linked(values, links)
        assert want == mine and links.count() < 20 * len(values)


def test_shard_masks_meet_all_links():
    rnd = random.Random(3)
    for n in (1, 512, 10**5, 10**8, 10**11):
        masks = simhash.shard_masks(n)
        assert {m.bit_count() for m in masks} == {masks[0].bit_count()} and n / 2 ** masks[0].bit_count() <= simhash.SHARD
        for _ in range(200):
            a = rnd.getrandbits(64)
            b = a
            for k in rnd.sample(range(64), 3):
                b ^= 1 << k
            assert any(a & m == b & m for m in masks)
    assert len(simhash.shard_masks(10**6)) == 4 and len(simhash.shard_masks(10**8)) == 10


def test_bk_tree_finds_all_by_following_few_edges():
    rnd = np.random.default_rng(7)
    for values, radius in ((np.unique(rnd.integers(0, 1 << 16, 3000).astype(np.uint64)), 2), (rnd.integers(0, 1 << 63, 2000).astype(np.uint64), 3)):
        rnd.shuffle(values)
        grown = simhash.BKTree.grown(values)
        tree = simhash.BKTree.unpacked(grown.packed())
        assert (tree.child == grown.child).all() and (tree.value == values).all()
        # children are keyed by their distance to the node, and each value is in the tree once
        up, key = np.nonzero(tree.child >= 0)
        assert (np.bitwise_count(values[up] ^ values[tree.child[up, key]]) == key).all() and len(up) == len(values) - 1
        q, t = tree.search(values[:200], radius)
        assert {(int(a), int(b)) for a, b in zip(q, t)} == {(i, j) for i in range(200) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= radius}
        assert 0 < tree.followed < 200 * (len(values) - 1) / 2 and tree.pruned > 0
    assert [len(x) for x in simhash.BKTree.grown(values[:1]).search(values[:1], 3)] == [1, 1]


def test_the_query_goes_through_trees_that_branch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = {i: brute(t) for i, t in ((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())}
    values = spark.createDataFrame([(simhash._signed(v),) for v in set(prints.values())], "fp long")
    trees = [simhash.BKTree.unpacked(bytes(r["tree"])) for r in simhash.shard_trees(values).collect()]
    assert all((t.child >= 0).sum() == len(t.value) - 1 for t in trees) and max(len(t.value) for t in trees) > 200
    for t in trees:
        t.search(t.value, simhash.RADIUS)
    assert sum(t.followed for t in trees) > 10**5 and sum(t.pruned for t in trees) > 10**5
    from quillstack.llm.queries import op5_simhash

    ids = sorted(prints)
    roots = brute_components([prints[i] for i in ids])
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(least.get(r, i), i)
    got = op5_simhash(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{prints[i]:016x}", least[r]) for i, r in zip(ids, roots)}
    assert len(got) == len(prints)


def test_long_texts_have_the_fingerprint_of_brute_force():
    rnd = random.Random(21)
    text = " ".join(str(rnd.randrange(50_000)) for _ in range(simhash._CHUNK + 5000))
    assert simhash.fingerprint(text) == brute(text)


def test_join_named_of_hot_keys(spark):
    rows = [(k % 50 if k % 3 else 7, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "key long, n long")
    counts = {k: sum(a == k for a, _ in rows) for k in range(50)}
    named = spark.createDataFrame([(k, k * 10, c) for k, c in counts.items() if k != 9], "key long, label long, times long")
    want = sorted((n, k * 10) for k, n in rows if k != 9)
    for least in (1, 500, 10**6):
        got = join_named(df, named, ["key"], len(rows), least)
        assert got.columns == ["key", "n", "label"] and sorted((r["n"], r["label"]) for r in got.collect()) == want


def brute_graph(edges):
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(139, 300), (5, 5)] + [(1, 2)] * 3
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 140)}, 300: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    stars = [(c, k) for c in (5, 500) for k in range(100, 400)] + [(k, k + 1) for k in range(1000, 1030)] + [(700 + k % 7, 5000 + k) for k in range(60)]
    want = brute_graph(stars)
    for hot in (10, 1000):
        got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(stars, "a long, b long").repartition(3), hot=hot).collect()}
        assert got == want


def corpus(spark, n=400):
    rnd = random.Random(8)
    plain = [f"{a}{b}" for a in ("ta", "ro", "mi", "ne", "lu") for b in ("ber", "gan", "sil", "tor", "vex", "dum")]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rnd.choice(plain) for _ in range(rnd.randrange(30, 90))]
        if toxic:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(["you", "your"]) + " " + rnd.choice(["nitwit", "blockhead", "dunce"]))
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def test_toxicity(spark):
    rows = corpus(spark)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(1000, None, 0.0), (1001, "", 0.0), (1002, "you n1twit! n1twit, blockh3ad", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(5000, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.7) == bool(y) for i, _, y in rows if not i % 3]
    assert sum(held) >= 0.95 * len(held) and got[1000] == got[1001] < 0.5
    none = toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_toxicity_features():
    lexicon = {"nitwit": 3.0}
    hit = dict(zip(text_features.TOXICITY_FEATURES, text_features.toxicity("YOU are a n1twit, really!", lexicon, {})))
    assert hit["unmasked_hits"] == 1 and hit["near_address"] > 0 and hit["capital_words"] > 0 and hit["exclamations"] > 0
    assert text_features.toxicity(None, lexicon, {}) == [0.0] * len(text_features.TOXICITY_FEATURES)


LANGS = {"en": "the of and to in that is was for with as on be at by this", "de": "der die das und ist nicht ein eine mit auf für von dem den im zu", "fr": "le la les des est une dans pour que qui sur avec pas plus par au", "es": "el los las una es en que con por para del como más pero sus al"}


def test_language_id(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(240):
        lang = "en de fr es".split()[i % 4]
        rows.append((i, " ".join(rnd.choice(LANGS[lang].split()) for _ in range(40)), lang))
    extra = [(900, None, None), (901, "12 34 !!", None), (902, "", "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + extra], "doc_id long, text string, lang string, score double")
    machines = language_id.train(docs.where("doc_id % 3 <> 0 OR doc_id >= 900"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, machines).collect()}
    assert all(got[i][0] == lang for i, _, lang in rows) and all(0 <= s <= 1 for _, s in got.values())
    assert [got[i] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    one = language_id.train(docs.where("lang = 'en'"))
    assert {r["lang_pred"] for r in language_id.predict(docs.where("doc_id < 10"), one).collect()} == {"en"}
    none = language_id.train(docs.where("lang IS NULL"))
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), machines).count() == 0
    assert language_id.family("pt-BR") == "romance" and language_id.family("xx") == "of xx"


def test_quality_model(spark):
    rnd = random.Random(10)
    rows = []
    for i in range(300):
        words = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.randrange(20, 120))]
        rows.append((i, " ".join(w.upper() + "###" for w in words) if i % 5 == 0 else ". ".join(w.capitalize() for w in words) + ".", int(i % 5 > 0)))
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(900, None, 1), (901, "", 1), (902, "x", 1)], "doc_id long, text string, x int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality_model.score_quality(docs, labels).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows) and got[900] == got[901] and 0 <= got[902] <= 1
    assert {r["score"] for r in quality_model.score_quality(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r["score"] for r in quality_model.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.score_quality(docs.limit(0), labels).count() == 0


def test_shrinkage_needs_few_rows(spark):
    rows = spark.createDataFrame([([float(i), 1.0], i % 2) for i in range(4)], "x array<double>, label int")
    classes = quality_model.fit(rows, 2)
    for _, _, factor, logdet in classes:
        assert np.allclose(2 * np.log(np.diag(factor)).sum(), logdet)
    assert quality_model.fit(rows.where("label = 0"), 2) == 0.0


@pytest.mark.parametrize("text", [None, "", " ", "a", "1 2 3", "\x00퟿", "x" * 100_000, "\n" * 1000])
def test_features_are_finite(text):
    assert np.isfinite(text_features.quality(text)).all() and len(text_features.quality(text)) == len(text_features.QUALITY_FEATURES)
    assert np.isfinite(text_features.toxicity(text, {}, {})).all()
    vector = text_features.ngrams(text)
    assert vector is None or np.isfinite(vector).all()


def test_held_out_rule(spark):
    import zlib

    from quillstack.llm.queries import _held_out

    rows = spark.range(50).select(F.col("id").alias("doc_id")).select("doc_id", _held_out(4, 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_near_copies_come_through_fingerprints(spark, monkeypatch):
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(1200)) for _ in range(6)]
    near = [t.rsplit(" ", 1)[0] + " other" for t in texts[:3]]
    docs = spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")
    fps = [near_copies.set_fingerprint(near_copies.shingles(t)) for t in texts + near]
    assert all((fps[k] ^ fps[k + 6]).bit_count() <= simhash.RADIUS for k in range(3))
    sims = spark.createDataFrame([(k, fp - (1 << 64) if fp >> 63 else fp) for k, fp in enumerate(fps)], "fp long, sim long")
    roots = {r["node"]: r["root"] for r in graph.components(near_copies.linked_sets(sims)).collect()}
    assert roots == {0: 0, 6: 0, 1: 1, 7: 1, 2: 2, 8: 2}
    # the stage asks them
    links = []
    wired = near_copies.linked_sets
    monkeypatch.setattr(near_copies, "linked_sets", lambda s: links.append(wired(s)) or links[-1])
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == list(range(6)) and links[0].count() >= 3


def test_star_steps_shuffle_edges_twice(spark):
    """A step of a graph without hubs deals its edges by node twice and once to find equal ones, without joins."""
    from quillstack.llm import graph

    plans, kept = [], graph.checkpoint

    def seen(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df)

    graph.checkpoint = seen
    try:
        edges = [(i, i + 1) for i in range(12)] + [(30, 40), (40, 30)]
        got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    finally:
        graph.checkpoint = kept
    assert got == {**dict.fromkeys(range(13), 0), 30: 30, 40: 30}
    assert len(plans) > 2 and not any("Join" in p for p in plans)
