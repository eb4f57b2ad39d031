import itertools
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gaugeflow.llm import ann, bm25, html_text, licenses, url_rules


def test_ann_recall_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(12, 8))[rng.integers(0, 12, 600)] + 0.2 * rng.normal(size=(600, 8)),
                        np.tile(rng.normal(size=8), (300, 1))])
    rows = [(i, [float(v) for v in r], "e") for i, r in enumerate(x)]
    odd = [(5000, None, "n"), (5100, [0.0] * 8, "z"), (5200, [math.nan] * 8, "q"), (None, [90.0] * 8, "k"),
           (5300, [1.0, None] * 4, "p"), (5400, [1.0] * 3, "s"), (5401, [1.0, 1.0, 2.0], "s")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, leaf string")
    got = {}
    for r in ann.neighbours(frame, F.col("vec_id") % 50 == 0, 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.pop(5400) == [(1, 5401, 1.0)]  # only vectors of the same length are neighbours
    assert set(got) == set(range(0, 900, 50))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(d)), d))[:10].tolist()
        found = sorted(found)
        assert [r for r, *_ in found] == list(range(1, 11))
        assert all(s == d[v] for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(want))
        if q >= 600:
            assert [v for _, v, _ in found] == want  # equal vectors: the smallest ids
    assert hits >= 0.9 * 10 * len(got)
    assert ann.neighbours(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    few = ann.neighbours(frame.where("vec_id < 4"), F.col("vec_id") == 0, 10).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]


def test_ann_counts_every_row_but_the_querys_own(spark):
    big = 9007199254740993
    rows = [(0, [1.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [3.0, 0.0]), (big, [1.0, 1.0]), (None, [1.0, 1.0]), (0, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.neighbours(frame, F.col("vec_id") == 0, 10).collect()]
    ones = [7, 7, big, None]
    first = [(0, i + 1, v, 1.0) for i, v in enumerate(ones)] + [(0, 5, 0, 2.0), (0, 6, 8, 2.0)]
    second = [(0, i + 1, v, 1.0) for i, v in enumerate(ones)] + [(0, 5, 0, 2.0), (0, 6, 8, 8 ** 0.5)]
    assert sorted(got, key=str) == sorted(first + second, key=str)


def test_bm25_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"t{i}" for i in range(300)], p=np.arange(300, 0, -1) / 45150, size=rng.integers(0, 60)))
             for _ in range(400)]
    texts[7], texts[8], texts[20] = texts[40], texts[40], None
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "t1 t2", 1), (3, texts[3], 1)],
                                 "doc_id long, text string, dl int")
    counts = [Counter(re.findall(r"[a-z0-9]+", t or "")) for t in texts]
    n, mean = len(counts), sum(map(Counter.total, counts)) / len(counts)
    df = Counter(w for c in counts for w in c)

    def score(q, d):
        c, dl = counts[d], counts[d].total()
        return math.fsum(math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2 / (c[w] + 1.2 * (.25 + .75 * dl / mean))
                         for w in counts[q] if w in c)

    for shard_rows in (64, 10_000):
        got = {}
        for r in bm25.search(docs, F.col("doc_id") % 20 == 0, 10, shard_rows=shard_rows).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
        for q in range(0, 400, 20):
            want = sorted((-score(q, d), d) for d in range(n) if d != q and score(q, d) > 0)[:10]
            found = sorted(got.get(q, []))
            assert [d for _, d, _ in found] == [d for _, d in want]
            assert np.allclose([s for *_, s in found], [-s for s, _ in want])
    assert bm25.search(docs.limit(0), F.col("doc_id") % 20 == 0).collect() == []


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_url_parts_and_rules(spark):
    cases = [(None, "", "", None), ("no scheme", "", "", None), ("http://Ex.ORG", "ex.org", "", None),
             ("https://a.example.org/es/9?x#y", "a.example.org", "/es/9", "example.org/es/"),
             ("https://example.org/en/17", "example.org", "/en/17", "example.org/en/1"),
             ("https://example.org/en/27", "example.org", "/en/27", "org/"),
             ("http://badexample.org/es/", "badexample.org", "/es/", "org/"),
             ("x://b.com/de/1#/fr/", "b.com", "/de/1", "com/de/"), ("x://b.com?q=/de/", "b.com", "", None), ("", "", "", None)]
    rows = spark.createDataFrame([(i, c[0], 1) for i, c in enumerate(cases)], "page_id long, url string, tokens int")
    got = {r.page_id: r for r in url_rules.judge_urls(rows, RULES).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(cases))] == [c[1:] for c in cases]
    assert got[3].verdict == "block" and got[5].verdict == "allow"
    assert url_rules.judge_urls(rows.limit(0), RULES).collect() == []


def test_mined_rules_equal_enumeration(spark):
    rng = np.random.default_rng(8)
    baskets = [(sorted(set(rng.choice(list("abcdef"), size=4))), str(rng.choice(["block", "allow"]))) for _ in range(60)]
    baskets = [(t, "block" if {"a", "b"} <= set(t) else "allow" if "c" in t else v) for t, v in baskets]
    frame = spark.createDataFrame(baskets, "tokens array<string>, label string")
    want = set()
    for size in range(1, 5):
        for combo in itertools.combinations("abcdef", size):
            held = [v for t, v in baskets if set(combo) <= set(t)]
            for label in ("block", "allow"):
                n = held.count(label)
                if n >= 0.1 * len(baskets) and n / len(held) >= 0.8:
                    want.add((combo, label, round(n / len(held), 9)))
    rules = url_rules.mine_rules(frame, 0.1, 0.8)
    assert {(tuple(r.antecedent), r.label, round(r.confidence, 9)) for r in rules.collect()} == want
    got = {tuple(r.tokens): r.label for r in url_rules.match_rules(frame.select("tokens").distinct(), rules).collect()}
    for tokens in {tuple(t) for t, _ in baskets}:
        fits = [w for w in want if set(w[0]) <= set(tokens)]
        assert (tokens in got) == bool(fits)
        if fits:
            assert got[tokens] in {w[1] for w in fits if w[2] == max(f[2] for f in fits)}


def test_main_text():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home"
            "</a></nav><div class='ad box'>Buy <p>now</p></div><article><h1>A &amp; B</h1><p>One\n two<br>three<p>Short."
            "<div class=sidebar>side</div><p>" + "Long text here. " * 20 + "<script>var a='<p>x</p>'</script></p></article>"
            "<section id=comments><article><p>" + "I think so. " * 20 + "</p></article></section><form>mail <input></form>"
            "<footer>&copy; me</footer></body></html>")
    assert html_text.main_text(page) == "\n\n".join(
        ["A & B", "One two three", "Short.", ("Long text here. " * 20).strip()])
    assert html_text.main_text(None) == "" == html_text.main_text("") == html_text.main_text("<p> </p>")
    assert html_text.main_text("plain  text") == "plain text"
    bare = "<div><a href=x>a</a> <a href=y>b</a></div><nav>n</nav><div><p>" + "Words of the story. " * 30 + "</p><p>End.</p></div>"
    assert html_text.main_text(bare) == ("Words of the story. " * 30).strip() + "\n\nEnd."
    assert html_text.main_text("<p" * 2000) is not None and html_text.main_text("<div>" * 5000 + "x") == "x"


def test_main_text_is_chosen_by_ratio_in_every_region():
    story = "\n\n".join(["A story of some length that has words enough to be one. " * 5] * 3 + ["End."]).replace(". \n", ".\n")
    blocks = "".join(f"<p>{x}</p>" for x in story.split("\n\n"))
    card = "<article class=card><h3><a href=/x>Other story</a></h3><p>Read <b>this</b> too.</p></article>"
    text = html_text.main_text
    assert text(f"<body><div><p>menu</p></div><nav>n</nav><div>{blocks}</div><nav>n</nav><div>x</div></body>") == story
    # main text in plain containers beside a card, and beside a card within main
    assert text(f"<body><div>{blocks}</div>{card}</body>") == story
    assert text(f"<body><main>{card}<article>{blocks}</article>{card}</main></body>") == story
    # several long articles stay
    assert text(f"<body><article>{blocks}</article>{card}<article>{blocks}</article></body>") == f"{story}\n\n{story}"
    # names on what holds the text, or most of it, do not set it aside
    for wrapper in ("<div class=has-sidebar>", "<div id=widget>", "<form>", "<div role=search>", "<aside>"):
        end = wrapper[1:].split()[0].rstrip(">")
        side = "<div class=sidebar><p>" + "Side words. " * 9 + "</p></div>"
        assert text(f"<body>{wrapper}<article>{blocks}</article>{side}</{end}></body>") == story
        # a form, search box or sidebar that holds no article is none of the page's text, however long
        assert text(f"<body>{wrapper}{blocks}</{end}>{side}</body>") == (story if end == "div" and "role" not in wrapper else "")
    assert text(f"<article class='post tag-social'>{blocks}</article>") == story
    # text that is never shown is no text of the page
    assert text(f"<body><script>{'x ' * 9000}</script><div hidden><article>{blocks * 3}</article></div>{blocks}</body>") == story


NEWS, TALK = "The council met on Monday and agreed on the plan. " * 6, "I do not agree with this at all, not one bit. " * 20


def test_menus_consent_and_comments_are_never_text():
    text, news = html_text.main_text, NEWS.strip()
    assert text("<nav><a href=/>Home</a> and more words than one</nav><footer>About us, who we are</footer>") == ""
    assert text(f"<form><p>{NEWS}</p></form><div role=dialog><p>{TALK}</p></div>") == ""
    assert text(f"<div class=cookie-consent><p>{TALK}</p></div><div><p>{NEWS}</p></div>") == news
    comments = "".join(f"<p>{TALK}</p>" for _ in range(5))
    assert text(f"<article><p>{NEWS}</p></article><section id=comments>{comments}</section>") == news
    assert text(f"<div><p>{NEWS}</p></div><section id=comments>{comments}</section>") == news
    inner = f"<article><p>{TALK}</p></article>" * 4
    assert text(f"<article><p>{NEWS}</p></article><section class=comments>{inner}</section>") == news
    assert text(f"<div><p>{NEWS}</p></div><section class=comments>{inner}</section>") == news
    assert text(f"<article><p>{NEWS}</p></article>" + f"<article class='comment odd'><p>{TALK}</p></article>" * 4) == news


def test_wrappers_named_like_asides_keep_their_page():
    text, news = html_text.main_text, NEWS.strip()
    assert text(f"<form id=aspnet><nav>Home</nav><article><p>{NEWS}</p></article></form>") == news
    assert text(f"<div class=comments-open><main><p>{NEWS}</p></main><div id=comments><p>{TALK}</p></div></div>") == news
    assert text(f"<div class=has-sidebar><div><p>{NEWS}</p></div></div>") == news
    assert text(f"<article><p>{NEWS}</p></article><div class=sidebar><p>{TALK}</p><p>{TALK}</p></div>") == news


def test_extract_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>a b</p></article>", 7), (1, "u", None, 7), (None, None, "", 7)],
                                  "page_id long, url string, html string, n_chars int")
    got = html_text.extract_pages(pages).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "", 0), ("1", "a b", 3), ("None", "", 0)]
    assert html_text.extract_pages(pages.limit(0)).collect() == []
    clash = pages.selectExpr("*", "1 as TEXT", "2 as N_Chars", "3 as made")
    assert html_text.extract_pages(clash).columns[-3:] == ["made", "text", "n_chars"]


def test_license_scan(spark, docs, empty):
    scanner = licenses.Scanner()
    for name, text in licenses.TEMPLATES:
        best = scanner.scan(f"some words before {text} and some after it")
        assert best[0][:2] == (name, 1.0)
    assert scanner.scan(None) == [] == scanner.scan("") == scanner.scan("license the under of version")
    near = licenses.TEMPLATES[5][1].replace("free of charge", "at no charge")
    assert scanner.scan(near)[0][0] == "MIT" and 0.8 <= scanner.scan(near)[0][1] < 1
    words = licenses.normal_words("x y Released under the MIT License. z")
    assert scanner.scan("x y Released under the MIT License. z") == [("MIT", 1.0, 2, 7)] and words[2:7][0] == "released"
    a, b = Counter("aab"), Counter("abc")
    assert licenses.dice(a, b) == 2 * 2 / 6
    rows = docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" Licensed under CC BY-NC 4.0.")).alias("text"))
    assert {r.license for r in licenses.scan_licenses(rows).collect()} == {"CC-BY-NC-4.0"}
    assert licenses.scan_licenses(rows).count() == docs.count() and licenses.scan_licenses(empty).collect() == []


def test_license_scan_tells_whole_texts_and_neighbours_apart():
    scanner, rows = licenses.Scanner(), {}
    for name, text in licenses.TEMPLATES:
        rows[name] = max(rows.get(name, ""), text, key=len)
    for name in ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "AGPL-3.0-only", "MPL-2.0", "CC0-1.0", "MIT",
                 "MIT-0", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Unlicense"):
        words = rows[name].split()
        words[len(words) // 3] = "otherwise"  # a body with a change still comes before the notices within it
        found = scanner.scan("before it " + " ".join(words) + " after it")
        assert found[0][0] == name and 0.95 < found[0][1] < 1, (name, found)
        assert all(b - a < 60 for _, _, a, b in found[1:])
    notice = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as "
              "published by the Free Software Foundation; {}")
    for kind, number, name in (("General Public License", "2", "GPL-2.0"), ("General Public License", "3", "GPL-3.0"),
                               ("Lesser General Public License", "2.1", "LGPL-2.1"),
                               ("Affero General Public License", "3", "AGPL-3.0")):
        later = notice.format(kind, f"either version {number} of the License, or (at your option) any later version.")
        assert [x[0] for x in scanner.scan(later)] == [f"{name}-or-later"]
        assert [x[0] for x in scanner.scan(notice.format(kind, f"version {number} of the License."))] == [f"{name}-only"]
    assert [x[0] for x in scanner.scan("Licensed under CC BY-ND 4.0.")] == ["CC-BY-ND-4.0"]


def test_license_scan_equals_brute_force():
    rng = np.random.default_rng(2)
    templates = (("A", "a b c d e f"), ("B", "c d e g h"))
    scanner = licenses.Scanner(templates, 0.6)
    for _ in range(40):
        words = list(rng.choice(list("abcdefghxyz"), size=12, p=[.12, .12, .12, .12, .12, .1, .1, .05, .05, .05, .05]))
        best = 0.0
        for _, t in templates:
            grams = Counter(zip(t.split(), t.split()[1:]))
            for i in range(12):
                for j in range(i + 2, 13):
                    best = max(best, licenses.dice(Counter(zip(words[i:j], words[i + 1:j])), grams))
        found = scanner.scan(" ".join(words))
        assert (found[0][1] if found else 0) == (best if best >= 0.6 - 1e-12 else 0)


def test_tokens_come_from_the_whole_address(spark):
    url = "HTTPS://a.b.Example.org/One/two/3x44/deep/er/page.longending?q=1&lang=de#top"
    row = spark.createDataFrame([(url,), (None,), ("",)], "url string")
    c = F.coalesce("url", F.lit(""))
    got = [r.t for r in row.select(url_rules.url_tokens(c, url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))).alias("t")).collect()]
    assert set(got[0]) == {"scheme=https", "first=a", "host=org", "host=example.org", "host=b.example.org", "host=a.b.example.org",
                           "path0=one", "path1=two", "path2=0x0", "path3=deep", "path4=er", "path5=page.longending",
                           "ending=longending", "query=q", "query=lang", "fragment"}
    assert got[1] == got[2] == ["host=", "scheme="]


def test_a_deep_path_part_makes_a_rule(spark):
    rows = [(i, f"http://h{i}.org/a/b/c/{'bad' if i % 2 else 'good'}/{i}") for i in range(40)] + [(99, "http://x.net/a/b/c/bad/7")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [(f"h{i}.org", "/", "block" if i % 2 else "allow") for i in range(40)]
    got = [r.verdict for r in url_rules.judge_urls(pages, rules).where("page_id = 99").collect()]
    assert got == ["block", "block"]  # repeated rows give a row each


def test_block_max_wand_skips_blocks_and_loses_nothing():
    rng = np.random.default_rng(9)
    topics = [np.arange(40 * t + 100, 40 * t + 140) for t in range(30)]
    rows = [np.concatenate([rng.choice(100, 6), rng.choice(topics[i % 30], 14)]).astype(np.int64) for i in range(3000)]
    dl = np.array([len(r) for r in rows], float)
    shard = bm25.Shard(np.arange(3000), rows, dl, 20.0, np.arange(100))
    queries = [(i, np.unique(rows[i]), np.where(np.unique(rows[i]) < 100, 0.3, 3.0)) for i in range(0, 3000, 60)]
    got = {}
    for own, doc, value in shard.search(queries, 10):
        got.setdefault(own, []).append((-value, doc))
    for own, terms, weights in queries:
        every = shard.exact(np.arange(3000), terms, weights)
        want = sorted((-v, int(shard.ids[d])) for d, v in enumerate(every) if shard.ids[d] != own and v > 0)[:10]
        assert sorted(got[own]) == want
    assert shard.opened + shard.skipped == len(queries) * shard.blocks and shard.skipped > 0.6 * len(queries) * shard.blocks
    # every term has its list, and no posting exceeds the maximum of its block
    for t, (a, b) in enumerate(zip(shard.list_begins, shard.list_begins[1:])):
        for e in range(a, b):
            part = slice(shard.list_at[e], shard.list_at[e + 1])
            assert shard.impact[part].max() == shard.list_max[e] and set(shard.doc[part] // bm25.BLOCK) == {shard.list_block[e]}


def test_bm25_copies_no_document_for_blocks_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(i, " ".join(f"t{j}" for j in rng.integers(0, 80, 12))) for i in range(120)], "doc_id long, text string")
    rows = lambda: sorted(map(tuple, bm25.search(docs, F.col("doc_id") % 2 == 0, 5, shard_rows=16).collect()))
    want, seen, whole = rows(), [], bm25.search_packed
    monkeypatch.setattr(bm25, "QUERY_ROWS", 8)
    monkeypatch.setattr(bm25, "PACK_ROWS", 3)
    monkeypatch.setattr(bm25, "search_packed", lambda pairs, *a: seen.append(pairs) or whole(pairs, *a))
    assert rows() == want and len(want) == 60 * 5
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan and "Generate" not in plan
    shards = seen[0].select("shard", "ids").distinct().collect()
    assert len(shards) > 1 and sorted(i for r in shards for i in np.frombuffer(r.ids, np.int64).tolist()) == list(range(120))


def test_bm25_packs_queries_of_like_words_side_by_side(spark):
    df = spark.createDataFrame([(i, [1 + i % 2, 10 + i], [0.5, 1.0]) for i in range(12)], "query_id long, terms array<long>, weights array<double>")
    packs = bm25.packed_queries(df.coalesce(1), np.array([2, 1])).collect()
    ids = np.concatenate([np.frombuffer(r.q_ids, np.int64) for r in packs])
    terms = np.concatenate([np.frombuffer(r.q_terms, np.int64) for r in packs]).reshape(-1, 2)
    assert sorted(ids.tolist()) == list(range(12)) and terms.tolist() == [[1 + i % 2, 10 + i] for i in ids]
    assert np.count_nonzero(np.diff(terms[:, 0])) == 1
