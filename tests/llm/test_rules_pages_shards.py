"""Quality rules, URL filter, HTML text, decontamination, sharding and the pipeline on small fixtures."""

import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import decontaminate, html_text, quality_rules, queries, sharding, simhash_dedup, url_filter

SMOKE = "/root/testdata/sf0.001"
GOOD = "The quick walker went along the river and saw many small boats near the old bridge of the town today."


def base_stats(t):
    t = t or ""
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in t).split(" ") if w]
    win = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    cover = {i + k for i in range(len(words) - 7) if win[tuple(words[i:i + 8])] > 1 for k in range(8)}
    full = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(cover))


def test_quality_statistics_like_brute_force(spark, docs):
    rnd = random.Random(5)
    texts = ["", None, "a", " \n ", GOOD, "\n".join([GOOD, GOOD, "x"]), "w " * 60, " a b c", "é😀 #&|"]
    texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 80))) for _ in range(30)]
    rows = list(enumerate(texts))
    q = quality_rules.judge(docs(rows), out="q").select("doc_id", "q.*").collect()
    for r in q:
        want = base_stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_lines_and_verdict(spark, docs):
    other = "Nothing is said twice here, because every sentence of this text tells something new about weather and sea."
    junk = ["Home | News | About | Contact | Login", "BUY NOW!! CHEAP!! GO!! GO!!", "a### b### c$$$ d%%%",
            "All rights reserved by us", "THIS LINE IS ONLY SHOUTING AT YOU"]
    rows = [(1, GOOD + "\n" + other), (2, "\n".join([GOOD, other, *junk])), (3, "\n".join([GOOD, *junk, *junk])), (4, None)]
    q = {r.doc_id: r.q for r in quality_rules.judge(docs(rows), out="q").collect()}
    assert q[1].kept and q[1].text == rows[0][1]
    assert q[2].text == GOOD + "\n" + other and q[2].n_removed_lines == 5
    assert not q[3].kept and not q[4].kept and q[4].text is None
    df = docs(rows).withColumnRenamed("lang", "quality")
    assert quality_rules.judge(df).columns == [*df.columns, "quality_"]


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="test tables not present")
def test_quality_query_matches_sql(spark):
    got = queries.op2_quality_rules(spark, SMOKE)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMOKE}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op2_quality_rules"])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


def test_urls(spark):
    urls = ["http://WWW.a.example.com/en/1?x", "https://a.example.com/en/", "https://a.example.com/de/", "http://x.net/es/1",
            "http://x.net/es", "ftp://evilnet/es/", "no scheme", None, "", "http://com", "http://free-casino.example.org/en/3",
            "http://gardening-school.example.org/en/3", "http://www.example.com/en/9", "http://h#f/x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumnRenamed("page_id", "host")
    rows = url_filter.judge(df, queries.URL_RULES, url_filter.train(spark)).collect()
    got = {r.host_in: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[0] == ("www.a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1][2:] == ("example.com/en/", "block") and got[2][2:] == ("com/", "allow")
    assert got[3][2:] == ("net/es/", "block") and got[4][2] is None and got[5][2] is None
    assert all(got[i][:3] == ("", "", None) for i in (6, 7, 8)) and got[9][:3] == ("com", "", None)
    assert got[10][3] == "block" and got[11][3] == "allow"
    assert got[12][2:] == ("www.example.com/en/", "allow") and got[13][:2] == ("h", "")


def test_url_model_on_held_out_words(spark):
    held = [(u, y) for k, (u, y) in enumerate(url_filter.labelled_urls()) if k % 7 == 3]
    model = url_filter.train(spark, [x for k, x in enumerate(url_filter.labelled_urls()) if k % 7 != 3])
    out = url_filter.judge(spark.createDataFrame(held, "url string, label int"), {}, model).collect()
    assert sum((r.verdict == "block") == (r.label == 1) for r in out) / len(out) >= 0.9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><!-- ad --><div class="ad">Buy this now, it is very cheap today.</div>
%s<footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("inner, want", [
    ("<article><h1>A &amp; B</h1><p><b>First  one<br><p>Second\n line &lt;x&gt;</p><p>No.</p></article>",
     "A & B\nFirst one\nSecond line <x>\nNo."),
    ("<div id=content><h1>Head</h1><p>Some long paragraph of text that is the article here.</p><ul><li>one<li>two</ul>"
     "<div class='comments'><p>Reader says hello to all</p></div></div>",
     "Head\nSome long paragraph of text that is the article here.\none\ntwo"),
    ("<main><p>Only this</p><aside>side</aside><form><p>mail</p></form><table><tr><td>a<td>b</table></main>", "Only this\na\nb"),
    ("", ""),
])
def test_main_text(inner, want):
    assert html_text.main_text(PAGE % inner) == want


LONG = [f"Paragraph {k} tells at some length what happened on that day in the town by the river." for k in range(6)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_density_selects_on_every_page():
    three = "".join(f"<article>{paragraphs(LONG[k:k + 2])}</article>" for k in (0, 2, 4))
    assert html_text.main_text(PAGE % f"<div>{three}</div>") == "\n".join(LONG)  # several articles side by side
    links = "<ul>" + "".join(f"<li><a href=/{k}>Another page {k}</a></li>" for k in range(8)) + "</ul>"
    for tag in ("main", "article", "div"):  # link lists go, whatever holds them
        assert html_text.main_text(PAGE % f"<{tag}>{paragraphs(LONG)}{links}</{tag}>") == "\n".join(LONG)
    low = f"<div>{links}{links}</div>"
    assert html_text.main_text(PAGE % f"{low}<div><div>{paragraphs(LONG)}</div></div>{low}") == "\n".join(LONG)  # no article


@pytest.mark.parametrize("wrap", ["<div class='content has-sidebar'>%s</div>", "<div class=no-sidebar>%s</div>",
                                  "<div class='post with-comments'>%s</div>", "<div id=search-results-article>%s</div>",
                                  "<div class=social-history>%s</div>", "<div class=sidebar>%s</div>", "<form>%s</form>"])
def test_hints_never_drop_the_text(wrap):
    for inner in (paragraphs(LONG), f"<article>{paragraphs(LONG)}</article>"):
        assert html_text.main_text(PAGE % (wrap % inner)) == "\n".join(LONG)


def test_pages_without_much(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "just text"), (4, "<div>" * 5000 + "deep"), (5, "<p>a < b"), (5, "<")],
                               "page_id int, html string").withColumnRenamed("page_id", "n_chars")
    got = [(r.n_chars, r.text) for r in html_text.extract(df).orderBy("n_chars", "text").collect()]
    assert got == [(1, ""), (2, ""), (3, "just text"), (4, "deep"), (5, "<"), (5, "a < b")]


ITEM = "Anna has 5 apples and gives 2 of them to her friend Carl before they walk 3 km home together with John."


def test_decontamination_finds_reparameterised_questions(spark, docs):
    swap = ITEM.replace("5", "17").replace("2", "9").replace("Carl", "Dora").replace("3 km", "8 miles").replace("John", "Kim")
    twice = ITEM.replace("gives 2", "gives 5")  # the item has two values, the document one: not one to one
    rows = [(1, GOOD + " " + ITEM), (2, "Text before. " + swap + " Text after."), (3, GOOD), (4, None), (5, ""), (6, twice),
            (7, ITEM.upper()), (8, " ".join(ITEM.split()[:9])), (2, "Text before. " + swap + " Text after."), (None, ITEM)]
    bench = spark.createDataFrame([(0, ITEM), (1, None), (2, "short one")], "item_id int, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert set(got) == {1, 2, 7, None}
    assert not got[1].reparameterised and got[2].reparameterised and got[2].n_slots == 6
    left = decontaminate.drop_contaminated(docs(rows), bench)
    assert left.columns == docs(rows).columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 8]
    assert decontaminate.drop_contaminated(docs(rows), bench.where("false")).count() == len(rows)


def test_decontamination_judges_slots_per_window(spark, docs):
    item = "Anna has 5 apples and gives 2 of them to her friend before they walk over 5 bridges home together with John."
    texts = [item.replace("5 apples", "7 apples").replace("5 bridges", "9 bridges"),  # 5 stands for two things
             item.replace("gives 2", "gives 5"),          # two values become one
             item.replace("5 bridges", "6 bridges"),      # a near copy, one of two equal numbers changed
             item, GOOD]
    bench = spark.createDataFrame([(0, item)], "item_id int, text string")
    rows = list(enumerate(texts))
    got = {r.doc_id: r.reparameterised for r in decontaminate.contaminated(docs(rows), bench, one_to_one=False).collect()}
    assert got == {0: True, 1: True, 2: True, 3: False}
    left = decontaminate.drop_contaminated(docs(rows), bench, one_to_one=False)
    assert [r.doc_id for r in left.collect()] == [4]


def test_consistent_windows_keep_the_largest_set():
    w = [[("40", "7")], [("40", "7"), ("x", "y")], [("40", "9")], [("40", "40")], [], [("x", "z")]]
    assert decontaminate.consistent_windows(w) == [w[0], w[1], w[3], w[4]]


def test_decontamination_of_short_items_names_and_scripts_without_spaces(spark, docs):
    items = ["What is the capital of Peru?", "Is 7 > 5?", "12 + 30 = 42 and 7 * 6 = 42 .",
             "Anna has many old books. Bob reads them all. Carl buys ten more. Dora sells some now. Ed keeps one.",
             "Early that day Mary Ann took her new bike and rode it all the way to town.",
             "小明有5个苹果，他把其中两个给了他的朋友，然后一起走路回家。",
             "สมชายมีแอปเปิ้ลหลายลูกและแบ่งให้เพื่อน"]
    swap = items[3]
    for a, b in (("Anna", "Gina"), ("Bob", "Hal"), ("Carl", "Ian"), ("Dora", "Jo"), ("Ed", "Kim")):
        swap = swap.replace(a, b)
    found = {0: "Quiz: what is the capital of Peru? Lima.", 1: "He asked: Is 7 > 5? Yes.", 2: "So 12 + 30 = 42 and 7 * 6 = 42 .",
             3: swap, 4: items[4].replace("Mary Ann", "Sue"), 5: "题目：" + items[5].replace("5", "8") + "答案是三。",
             6: "โจทย์ " + items[6] + "กี่ลูก"}
    rows = [*found.items(), (10, "Is 8 > 5?"), (11, "So 13 + 30 = 43 and 7 * 6 = 42 ."), (12, "小明走路去学校，然后一起吃苹果。"), (13, GOOD)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    got = decontaminate.contaminated(docs(rows), bench, one_to_one=False).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in found]
    assert {r.doc_id for r in got if r.reparameterised} == {3, 4, 5}


def test_decontamination_reads_texts_together_as_alone():
    rnd = random.Random(7)
    words = "the of Mary Ann runs 5 12 5km, km 3.5 miles end. Stop! -- ... ask? tell said 北京大学 ไทย Paris is".split()
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(200)] + ["", "12", "km", "Ann", "5km", ""]
    rnd.shuffle(texts)
    every = np.full(1 << 19, np.iinfo(np.uint64).max, np.uint64)  # a bitmap that holds all windows
    windows = decontaminate._text_windows(decontaminate.Canon(), texts, 2, [4, 8], [1, 3], every)
    assert windows == [decontaminate._text_windows(decontaminate.Canon(), [t], 2, [4, 8], [1, 3], every)[0] for t in texts]
    assert sum(map(len, windows)) > 1000
    together = [x for some in decontaminate._some(iter(texts * 100)) for x in some]
    assert together == texts * 100


def test_decontamination_adds_up_shifts(spark, docs):
    item = "Today near Mary Ann the tall old man saw one boat go by there again"  # 3 windows up to the name, 4 after it
    bench = spark.createDataFrame([(0, item)], "item_id int, text string")
    rows = [(0, item.replace("Mary Ann", "Sue")), (1, item.replace("Mary Ann the", "Sue a"))]
    got = decontaminate.contaminated(docs(rows), bench, one_to_one=False).collect()
    assert [(r.doc_id, r.n_windows, r.item_windows) for r in got] == [(0, 7, 7)]


def test_shards_are_even_and_stable(spark, docs):
    rows = [(k, f"t{k % 50}") for k in range(3000)] + [(None, "same")] * 500 + [(1, None)]
    df = docs(rows)
    for shards in (40, 41):
        out = sharding.assign(df, ["doc_id"], shards=shards).collect()
        by = Counter(r.shard for r in out)
        assert len(out) == len(rows) and len(by) == shards and max(by.values()) - min(by.values()) <= 1
        assert all(sorted(r.slot for r in out if r.shard == s) == list(range(n)) for s, n in by.items())
        if shards == 40:
            before = {r.doc_id: r.shard for r in out if r.doc_id is not None}
        else:  # most keys stay where they were
            assert sum(before[r.doc_id] == r.shard for r in out if r.doc_id is not None) > 0.6 * len(before)
    assert sharding.assign(df.where("false"), ["doc_id"]).count() == 0


def test_shards_do_not_depend_on_where_rows_lie(spark, docs):
    rows = [(k, f"t{k % 50}") for k in range(2000)] + [(None, "same")] * 900 + [(1, None)] * 3
    df = docs(rows).select("doc_id", "text")
    a, b, c = (Counter(map(tuple, sharding.assign(x, ["doc_id"], hot_rows=h).collect()))
               for x, h in ((df, 100), (df.repartition(7, "text"), 100), (docs(rows[::-1]).select("doc_id", "text").coalesce(1), 100)))
    assert a == b == c
    assert sum(a.values()) == len(rows) and len({(r[2], r[3]) for r in a}) == len(rows)


def test_keys_stay_with_the_owner_of_their_arc_until_it_is_full(spark, docs):
    """Row by row against a walk of the ring."""
    rows = [(k, "x") for k in range(1500)]
    got = {r.doc_id: r.shard for r in sharding.assign(docs(rows), ["doc_id"], shards=7, vnodes=20).collect()}
    at = {r.doc_id: r.h for r in docs(rows).select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    points, owner = sharding.ring(7, 20)
    room = [1500 // 7 + (s < 1500 % 7) for s in range(7)]
    homes = dict(zip(at, sharding.home_shards(list(at.values()), 7, 20)))
    for s in range(7):  # a shard whose arcs ask for no more than its room keeps all of its keys
        mine = [k for k, h in homes.items() if h == s]
        assert sum(got[k] == s for k in mine) >= min(len(mine), 1) and (len(mine) > room[s] or all(got[k] == s for k in mine))
    assert len(points) == len(owner) == 140


def test_overflow_goes_clockwise():
    owner = [0, 1, 2, 0, 1, 2]
    plan = sharding.place([10, 0, 0, 0, 2, 0], owner, 3)
    assert sum(hi - lo for _, lo, hi, _, _ in plan) == 12
    assert Counter({s: n for s, n in ((s, sum(hi - lo for _, lo, hi, t, _ in plan if t == s)) for s in range(3))}) == {0: 4, 1: 4, 2: 4}
    assert plan[0][:4] == (0, 0, 4, 0)  # the owner first, the rest further round
    assert sharding.place([0] * 6, owner, 3) == []


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="test tables not present")
def test_sharding_query_contract(spark):
    out = queries.op9_sharding(spark, SMOKE)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    for r in out.collect():
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="test tables not present")
def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    n = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        n.append(docs.count())
    rows = docs.collect()
    assert n[0] == n[1] >= n[2] >= n[3] > 0
    assert not any(b in r.text for r in rows for b in bench) and all(r.n_chars == len(r.text) for r in rows)
    left = simhash_dedup.near_duplicates(docs).collect()
    assert all(r.doc_id == r.component_id for r in left)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == n[3]
