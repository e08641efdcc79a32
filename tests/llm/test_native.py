"""Quality rules, mixing, line dedup, decontamination and URL filter against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillstack.llm import decontamination, line_dedup, mixing, quality_rules, queries, url_filter

PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from a tall oak tree nearby."
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def counts(text):
    ws = WORD.findall(text or "")
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_match_brute_force(spark):
    rnd = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a a", "x\u00a0y z", "\n\nline\nline\n line\n", "tab\tand\x0bvt # $"]
    texts += ["".join(rnd.choice(["a ", "b ", "c", "\n", "é", "| "]) for _ in range(n)) for n in (5, 60, 400, 400)]
    texts += [" ".join(rnd.choice("abcdefghij") for _ in range(3000)), " ".join(map(str, range(5000)))]
    rows = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["quality"] for r in quality_rules.judge(rows).collect()}
    for i, t in enumerate(texts):
        q = got[i]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == counts(t), repr(t)[:60]
        n, *_, repeated = counts(t)
        assert q["base_failed"] == (n < 50 or 100 * repeated > 50 * n)


def test_quality_lines(spark):
    good = "\n".join(" ".join(f"Word{chr(97 + k)}{chr(97 + j)}" for j in range(14)) + "." for k in range(5))
    junk = good + "\n" + "\n".join("Home | News | About | Contact | Sitemap | Press and more of it here" for _ in range(20))
    rows = documents(spark, [(1, good, "a"), (2, junk, "a"), (3, good + "\nAll rights reserved.", "a"), (4, good.upper(), "a"), (4, good, "a")])
    got = sorted((r["doc_id"], r["quality"]["kept"], r["quality"]["n_bad_lines"]) for r in quality_rules.judge(rows).collect())
    assert got == [(1, True, 0), (2, False, 20), (3, True, 1), (4, False, 5), (4, True, 0)]
    clean = {r["doc_id"]: r["quality"]["clean_text"] for r in quality_rules.judge(rows.where("doc_id < 4")).collect()}
    assert clean[1] == good and clean[2] == good and clean[3] == good


def test_quality_keeps_clashing_columns(spark):
    rows = spark.createDataFrame([(1, PROSE, 5, "x")], "doc_id long, text string, n_words int, `a.b` string")
    out = quality_rules.judge(rows)
    assert out.columns == ["doc_id", "text", "n_words", "a.b", "quality"] and out.first()["n_words"] == 5
    assert quality_rules.judge(rows.limit(0)).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / w > 2 * sizes[s]} if w else set()
        if not over:
            return {s: 2 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        full |= over


def test_mixing_targets_rates_and_reruns(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(1500):
        s = rnd.choice(["a"] * 6 + ["b", "c", "d", None])
        rows.append((i, " ".join(["w"] * int(rnd.lognormvariate(3, 1))), s))
    rows += [(9000 + i, "one two three", "hot") for i in range(600)] + [(9999, None, "none"), (None, "x y", "a"), (None, "x y", "a")]
    docs = documents(spark, rows).repartition(5)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target, cells = defaultdict(int), defaultdict(int), {}, defaultdict(dict)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        if r["size"]:
            cells[r["source"]][r["size"]] = r["rate"]
    want = targets(sizes)
    for s in want:
        assert target[s] == pytest.approx(want[s], rel=1e-9), s
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 100), s
    # rates are exponentially tilted: log(rate) / size is one number in a source, but at the bound
    for s, rates in cells.items():
        tilts = [math.log(r) / n for n, r in rates.items() if r < 1.999 and n > 3]
        assert not tilts or max(tilts) - min(tilts) < 1e-6
    again = {(r["doc_id"], r["source"], r["taken"]) for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["source"], r["taken"]) for r in got}


def test_mixing_meets_targets_of_few_documents(spark):
    rnd = random.Random(12)
    rows = [(s * 100 + k, " ".join(["w"] * rnd.choice([rnd.randrange(5, 300), rnd.randrange(300, 6000)])), f"s{s}") for s in range(9) for k in range(50)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, taken int")
    got = mixing.mix(docs).collect()
    for s in range(9):
        own = [r for r in got if r["source"] == f"s{s}"]
        gap = own[0]["target"] - sum(r["taken"] for r in own)
        # no copy added, taken away or exchanged for another one would come nearer, and all are near
        adds = [0, *[r["size"] for r in own if r["copies"] < 2]]
        drops = [0, *[r["size"] for r in own if r["copies"] > 0]]
        assert abs(gap) <= 5 and abs(gap) <= min(abs(gap - a + b) for a in adds for b in drops) + 1e-6, s
        assert all(0 <= r["copies"] <= 2 for r in own)


def test_mixing_of_many_sources_and_hot_cells(spark, monkeypatch):
    rnd = random.Random(14)
    rows = [(k, "a b c", "hot") for k in range(1500)] + [(2000 + k, " ".join(["w"] * rnd.randrange(1, 40)), f"t{rnd.randrange(200):03}") for k in range(2500)]
    rows += [(None, "x y z", "hot")] * 40 + [(5000, " ".join(["w"] * 200_000), "long")]
    docs = documents(spark, rows).repartition(7)
    want, sizes = None, defaultdict(int)
    monkeypatch.setattr(mixing, "PIECE", 16)
    real = mixing.join_named
    for least in (10**6, 50):
        monkeypatch.setattr(mixing, "join_named", lambda *a, n=least: real(*a, n))
        got = sorted((str(r["doc_id"]), r["source"], r["size"], r["target"], r["taken"]) for r in mixing.mix(docs).collect())
        assert want in (None, got)
        want = got
    for _, s, size, _, _ in want:
        sizes[s] += size
    goals = targets(sizes)
    assert all(t == pytest.approx(goals[s], rel=1e-9) for _, s, _, t, _ in want)
    assert abs(sum(x[4] for x in want if x[1] == "hot") - goals["hot"]) <= 3


def test_mixing_says_when_it_does_not_settle(spark):
    docs = documents(spark, [(k, "w " * (k + 1), f"s{k % 3}") for k in range(30)])
    cells = docs.selectExpr("source IS NOT NULL AS known", "source AS name", "size(split(trim(text), ' ')) AS size").groupBy("known", "name", "size").agg(F.count("*").alias("n"))
    with pytest.raises(RuntimeError):
        mixing.multipliers(cells, mixing.targets(cells), steps=1)


def test_mixing_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def deletable(rows, least=50):
    """Line numbers that brute force deletes, by (id, text)."""
    runs = []
    for key in sorted({(i, t) for i, t, *_ in rows if t is not None}, key=lambda k: (k[0] is not None, k[0] or 0, k[1])):
        at = [(n, x) for n, x in enumerate(key[1].split("\n")) if WORD.search(x)]
        runs.append((key, at))
    first, found = {}, defaultdict(set)
    for d, (key, at) in enumerate(runs):
        n = [len(WORD.findall(x)) for _, x in at]
        for i in range(len(at)):
            for j in range(i, min(len(at), i + 30)):
                if sum(n[i : j + 1]) >= least:
                    run = tuple(x for _, x in at[i : j + 1])
                    if first.setdefault(run, (d, i)) != (d, i):
                        found[key] |= {at[k][0] for k in range(i, j + 1)}
    return found


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(3)
    lines = [" ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.choice([1, 3, 9, 20, 30, 60]))) for _ in range(40)]
    passage = lines[:6]
    rows = []
    for i in range(60):
        body = [rnd.choice(lines[:12]) if rnd.random() < 0.5 else f"own {i} {k} " + rnd.choice(lines) for k in range(rnd.randrange(1, 14))]
        if i % 3 == 0:
            body[1:1] = passage
        rows.append((i, "\n".join(body).replace("own 5", "\n\nown 5"), "s"))
    rows += [(100, None, "s"), (101, "", "s"), (102, "short\nshort\nshort", "s"), (103, "\n".join(passage * 3), "s"), (7, rows[3][1], "s")]
    docs = documents(spark, rows)
    got = {(r["doc_id"], r["text"]): r["line_dedup"] for r in line_dedup.dedup_lines(docs).collect()}
    want = deletable(rows)
    assert len(got) == len(rows) and sum(map(len, want.values())) > 60
    for key, r in got.items():
        assert set(r["deleted"]) == want.get(key, set()), key[0]
        if key[1] is not None:
            assert r["text"] == "\n".join(x for n, x in enumerate(key[1].split("\n")) if n not in want.get(key, set()))
    assert got[(100, None)]["text"] is None and got[(102, "short\nshort\nshort")]["n_deleted"] == 0


def test_line_dedup_repeated_rows_and_nothing(spark):
    long = " ".join(f"w{k}" for k in range(60))
    same = documents(spark, [(1, long, "s"), (1, long, "s"), (None, long, "s")])
    got = sorted((r["doc_id"] or 0, r["line_dedup"]["text"]) for r in line_dedup.dedup_lines(same).collect())
    assert got == [(0, long), (1, ""), (1, "")]
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


ITEMS = [
    (1, "A train travels 120 km in 3 hours, then stops. How far does Alice ride when she takes the train for 5 hours more?"),
    (2, "Photosynthesis turns light into chemical energy within the green leaves of most plants on earth."),
    (3, "Too short."),
    (4, None),
    (5, "1 2 3 4 5 6 7 8 9 10 11 12"),
]


def test_line_dedup_long_repeated_rows_match_brute_force(spark):
    rnd = random.Random(15)
    long = "\n".join(f"a{k} b{k}" for k in range(45))
    short = "\n".join(f"c{k}" for k in range(60))  # a run of 50 words has 50 lines
    other = f"new start here\n{long}\n{short}\nand an end"
    rows = [(None, short, "s"), (1, long, "s"), (5, other, "s"), (6, "\n".join(f"d{rnd.randrange(99)} e" for _ in range(40)), "s")]
    first, want = {}, defaultdict(set)
    for i, text, _ in rows:  # every run of 50 words or more, however many lines it has
        at = text.split("\n")
        for a in range(len(at)):
            for b in range(a + 1, len(at) + 1):
                if len(WORD.findall(" ".join(at[a:b]))) >= 50 and first.setdefault(tuple(at[a:b]), (i, a)) != (i, a):
                    want[i] |= set(range(a, b))
    assert len(want[5]) == 105
    found = line_dedup.dedup_lines(documents(spark, rows * 3)).collect()
    assert len(found) == 3 * len(rows)
    assert all(set(r["line_dedup"]["deleted"]) == want[r["doc_id"]] for r in found)


def test_ranks_are_a_suffix_array_and_deletions_its_intervals(spark):
    rnd = random.Random(31)
    lines = [" ".join(f"v{rnd.randrange(99)}" for _ in range(rnd.choice([2, 5, 11, 17]))) for _ in range(14)]
    passages = [[rnd.choice(lines) for _ in range(n)] for n in (5, 12, 30, 70)]
    rows = []
    for i in range(30):
        body = [f"own {i} {k}" for k in range(rnd.randrange(4))]
        for _ in range(3):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p) // 2)
            body += p[a : a + rnd.randrange(3, len(p))] + [f"mid {i} {len(body)}"]
        rows.append((i, "\n".join(body), "s"))
    docs = documents(spark, rows)
    table = line_dedup.line_table(docs)
    at = sorted(((r["doc"], r["at"]), (r["h1"], r["h2"]), r["n"]) for r in table.collect())
    of_doc = defaultdict(list)
    for (d, _), h, n in at:
        of_doc[d].append((h, n))
    ranks = line_dedup.levels(table, 50)
    assert len(ranks) == 6
    for k, level in enumerate(ranks):
        got = {(r["doc"], r["at"]): r["rank"] for r in level.collect()}
        prefix = {(d, i): tuple(h for h, _ in x[i : i + 2**k]) for d, x in of_doc.items() for i in range(len(x) - 2**k + 1)}
        times = Counter(prefix.values())
        assert got.keys() == {p for p, x in prefix.items() if times[x] > 1}
        # the order of the ranks is that of the suffixes, and equal ranks are equal prefixes
        order = sorted(got, key=got.get)
        assert all((prefix[a] < prefix[b]) == (got[a] < got[b]) and (prefix[a] == prefix[b]) == (got[a] == got[b]) for a, b in zip(order, order[1:]))
    # the suffix array and common prefixes of neighbours; an earlier suffix with a prefix of 50 words deletes it
    suffixes = sorted(((tuple(h for h, _ in x[i:]), d, i) for d, x in of_doc.items() for i in range(len(x))))
    common = [0]
    for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
        common.append(next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))
    want = defaultdict(set)
    for k, (_, d, i) in enumerate(suffixes):
        longest = 0
        for step in (-1, 1):
            near, least = k, 10**9
            while 0 <= near + step < len(suffixes):
                least = min(least, common[near if step < 0 else near + 1])
                near += step
                if suffixes[near][1:] < (d, i):
                    longest = max(longest, least)
                    break
        if sum(n for _, n in of_doc[d][i : i + longest]) >= 50:
            want[d] |= set(range(i, i + longest))
    assert sum(map(len, want.values())) > 200
    got = line_dedup.dedup_lines(docs).select("doc_id", "line_dedup.deleted").collect()
    assert {r["doc_id"]: set(r["deleted"]) for r in got} == {i: want[i] for i, *_ in rows}


def test_line_dedup_of_hot_and_long_lines(spark, monkeypatch):
    rnd = random.Random(33)
    hot = " ".join(f"h{k}" for k in range(55))
    long = " ".join(f"x{rnd.randrange(10**6)}" for _ in range(60_000))
    rows = [(i, f"start {i}\n{hot}\nend {i}", "s") for i in range(1200)] + [(5000, long, "s"), (5001, long + "\n" + hot, "s")]
    real = line_dedup.join_named
    for least in (1000, 5):
        monkeypatch.setattr(line_dedup, "join_named", lambda *a, n=least: real(*a, n))
        got = {r["doc_id"]: r["deleted"] for r in line_dedup.dedup_lines(documents(spark, rows)).select("doc_id", "line_dedup.deleted").collect()}
        assert got == {0: [], **{i: [1] for i in range(1, 1200)}, 5000: [], 5001: [0, 1]}
    monkeypatch.setattr(line_dedup, "BROADCAST_DELETIONS", 0)
    got = line_dedup.dedup_lines(documents(spark, rows).withColumn("Line_Dedup", F.lit(1)))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "line_dedup"] and got.where("line_dedup.n_deleted > 0").count() == 1200


def test_decontamination(spark):
    filler = " ".join(f"word{chr(97 + k % 26)}x{chr(97 + k % 7)}" for k in range(200))
    verbatim, changed = ITEMS[0][1], ITEMS[0][1].replace("120", "90").replace("3 hours", "2 hours").replace("5 hours", "4 hours").replace("Alice", "Bob")
    rows = [
        (1, f"{filler}\n{verbatim}\n{filler}"), (2, f"{filler} {changed} {filler}"), (3, filler), (4, None), (5, ""),
        (6, ITEMS[1][1].upper().replace(" ", "   ")), (7, " ".join(ITEMS[1][1].split()[:8]) + " " + filler), (8, "Too short. " * 30),
        (9, " ".join(str(k) for k in range(50))), (None, ITEMS[1][1]), (10, f"{verbatim} {ITEMS[1][1]}"), (10, filler),
        (11, ITEMS[1][1].replace("light", "quick light").replace("earth", "our earth")),
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, cover int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = Counter((r["doc_id"], tuple(r["leaks"]["items"] or ())) for r in decontamination.decontaminate(docs, items).collect())
    assert got == Counter(
        {(1, (1,)): 1, (2, (1,)): 1, (3, ()): 1, (4, ()): 1, (5, ()): 1, (6, (2,)): 1, (7, ()): 1, (8, ()): 1, (9, ()): 1,
         (None, (2,)): 1, (10, (1, 2)): 1, (10, ()): 1, (11, (2,)): 1}
    )
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).where("leaks.contaminated").count() == 0


def test_decontamination_slots_must_agree(spark):
    item = "Give Tom 4 apples and then, when Tom sleeps, take 4 back so that, well, Tom has 4 less, as Tom said."
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    mixed = item
    for name, number in (("Ann", "1"), ("Bea", "2"), ("Cid", "3"), ("Dan", "5")):
        mixed = mixed.replace("Tom", name, 1).replace(" 4 ", f" {number} ", 1)
    rows = [(1, item.replace("Tom", "Eva").replace("4", "7")), (2, mixed)]
    got = {r["doc_id"]: r["leaks"]["contaminated"] for r in decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {1: True, 2: False}


def leaks_of(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {r["doc_id"]: r["leaks"]["items"] or [] for r in found}


def test_decontamination_in_capitals_and_side_by_side(spark):
    tom = "Tom buys 4 apples, then Tom eats 2 of them. How many apples does Tom have?"
    short = "Each of the 3 boxes weighs 12 kg when full, says Mia."
    items = [(1, tom), (2, short), (3, "Who wrote Faust?"), (4, "7 + 5 = 12")]
    changed = [short.replace("3", "5").replace("12", "40").replace("Mia", "Leo"), short.replace("3", "8").replace("12", "9").replace("Mia", "Ann")]
    texts = [tom.upper(), tom.lower(), tom.upper().replace("4", "9").replace("2", "3"), " ".join(changed), changed[0] + " " + short, "Intro\nwho wrote Faust\nend",
             "I asked who wrote Faust and why", "7 + 5 = 12", "x" * 300_000 + " " + tom + " y" * 50_000, "Buys apples then eats many of them, Tom and Tim do have four"]
    got = leaks_of(spark, items, texts)
    assert got == {0: [1], 1: [1], 2: [1], 3: [2], 4: [2], 5: [3], 6: [], 7: [], 8: [1], 9: []}


def test_decontamination_finds_short_items_in_long_lines(spark):
    items = [(1, "What is seven plus")]
    texts = ["what is seven plus?", "a b\nWhat is seven plus" + "!" * 400 + "\nc", "What is seven plus" + " " * 5000 + "eight", "?" * 2000 + " What is seven plus " + "-" * 2000]
    assert leaks_of(spark, items, texts) == {0: [1], 1: [1], 2: [], 3: [1]}


def test_decontamination_beyond_its_broadcast(spark, monkeypatch):
    common = "read the text below with great care and then answer"
    own = lambda k: " ".join(f"{w}{chr(97 + k)}" for w in ("ask", "why", "this", "goes", "that", "way", "each", "time", "when", "it", "rains", "hard"))
    items = [(k, f"{common} {own(k)}") for k in range(12)]
    texts = [f"{common} something else of number{k % 7} words" for k in range(150)] + [items[3][1], items[5][1].upper() + " " + items[7][1], "no leak at all in this one"]
    want = leaks_of(spark, items, texts)
    assert want[150] == [3] and want[151] == [5, 7] and not any(want[k] for k in (*range(150), 152))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert leaks_of(spark, items, texts) == want
    real = decontamination.join_named
    monkeypatch.setattr(decontamination, "join_named", lambda *a: real(*a, 20))
    assert leaks_of(spark, items, texts) == want


def test_decontamination_finds_the_benchmark_in_any_case(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    for change in (str.upper, str.lower, str):
        got = leaks_of(spark, items, [change(t) for _, t in items])
        assert all(items[k][0] in x for k, x in got.items())


URLS = [
    "http://A.Example.com/en/x?y=1#z", "https://www.example.com/en/", "http://x.net/es/1", "http://net/fr/", "http://com.org/a", "http://x.com",
    "http://x.com?q=/en/", "no scheme/en/", None, "", "ftp://h.org/a://b.com/c", "http://www.example.com/de/", "http://notexample.com/en/q",
    "http://EXAMPLE.com/EN/", "http://x.net/ES/",
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
    best = None
    for rule, label in queries.URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, label
    return host, path, best


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    rules = spark.createDataFrame(list(queries.URL_RULES), "rule string, label string")
    got = url_filter.judge_urls(pages, rules).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, best = judged(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[0] if best else None), r["url"]
        assert r["verdict"] == best[1] if best else r["verdict"] in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_url_model_learns_from_labels(spark):
    rnd = random.Random(4)
    good = [f"https://news{rnd.randrange(9)}.example.org/world/story-{k}" for k in range(150)]
    bad = [f"http://win-{rnd.randrange(10**6)}-cash.example.org/{rnd.randrange(10**9)}?a={k}&b={rnd.random()}" for k in range(150)]
    labelled = spark.createDataFrame([(u, "allow") for u in good[:100]] + [(u, "block") for u in bad[:100]], "url string, label string")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(good[100:] + bad[100:])], "page_id long, url string")
    rules = spark.createDataFrame([], "rule string, label string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, rules, labelled).collect()}
    assert sum(v == ("allow" if i < 50 else "block") for i, v in got.items()) >= 95


def test_url_suffix_statistics_are_of_all_labelled_rows(spark, monkeypatch):
    seen = []
    real = url_filter.featured
    monkeypatch.setattr(url_filter, "featured", lambda urls, statistics, *a: seen.append(statistics) or real(urls, statistics, *a))
    rows = [(f"http://h{k % 5}.org/p{k}", f"h{k % 5}.org", f"/p{k}", "block" if k % 2 else "allow") for k in range(200)]
    url_filter.train(spark.createDataFrame(rows, "url string, host string, path string, label string"), max_train=40)
    got = seen[0].collect()
    assert {r["suffix"]: r["s_seen"] for r in got if r["fold"] is None} == {f"h{k}.org": 40 for k in range(5)}
    # a host is in one fold, whose rows see nothing of it
    assert sorted((r["suffix"], r["s_seen"]) for r in got if r["fold"] is not None) == sorted((f"h{k}.org", 0 if f == own else 40) for k, own in enumerate(
        r["f"] for r in spark.createDataFrame([(f"h{k}.org",) for k in range(5)], "h string").select(url_filter.fold(F.col("h")).alias("f")).collect()) for f in range(url_filter.FOLDS))


def test_url_model_is_measured_on_hosts_it_did_not_learn_from(spark):
    rnd = random.Random(6)
    good = [f"https://news{k % 40}.site{k % 40}.org/world/story-{k}" for k in range(300)]
    bad = [f"http://win{k % 40}.cash{k % 40}.org/{rnd.randrange(10**9)}?a={k}&b={rnd.random()}" for k in range(300)]
    labelled = spark.createDataFrame([(u, "allow") for u in good] + [(u, "block") for u in bad * 3], "url string, label string")
    r = url_filter.held_out(labelled).first()
    assert r["blocks"] > 100 and r["found"] >= 0.95 * r["blocks"] and r["wrong"] <= 0.05 * (r["n"] - r["blocks"])
    # a URL that is labelled a thousand times is one row of the sample
    hot = labelled.unionByName(labelled.limit(1).select(F.explode(F.array_repeat("url", 5000)).alias("url"), "label"))
    apply = url_filter.train(hot.select("url", *[c.alias(n) for c, n in zip(url_filter.host_and_path(F.col("url")), ("host", "path"))], "label"), max_train=500)
    scored = apply(labelled.select("url", *[c.alias(n) for c, n in zip(url_filter.host_and_path(F.col("url")), ("host", "path"))], "label"))
    assert scored.where((F.col("blocked") > 0.5) != (F.col("label") == "block")).count() < 20


def test_url_rules_of_hot_and_malformed_urls(spark):
    long = "http://a.example.com/en/" + "x" * 200_000
    rows = [(k, "http://x.net/es/1") for k in range(1500)] + [(k, None) for k in range(1500)] + [(None, "no scheme")] * 3 + [(1, long), (2, "http://y.org/a")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, rule string, verdict string").repartition(5)
    rules = spark.createDataFrame(list(queries.URL_RULES), "rule string, label string")
    got = Counter((r["url"], r["rule"], r["verdict"] if r["rule"] else "") for r in url_filter.judge_urls(pages, rules).collect())
    assert got == {("http://x.net/es/1", "net/es/", "block"): 1500, (None, None, ""): 1500, ("no scheme", None, ""): 3, (long, "example.com/en/", "block"): 1, ("http://y.org/a", None, ""): 1}
