"""Chats, urls, pages and archives against plain Python, with nulls, repeats and clashes."""

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from regspan.llm import chat, html, urls, warc

CHATS = "conv_id long, turn long, role string, text string"


def turns_of(conv, texts, first=0):
    roles = ["user", "assistant"]
    return [(conv, first + i, roles[i % 2], t) for i, t in enumerate(texts)]


CONVERSATIONS = [
    *turns_of(1, ["a", "b", "c", "d"]),
    *turns_of(2, ["a", "b"]),  # a snapshot of 1
    *turns_of(3, ["a", "b", "c", "d"]),  # equal to 1
    *turns_of(4, ["a", "x"]),
    *turns_of(5, ["b", "c"], 1),  # other turn numbers
    *turns_of(6, ["a"]),
    *turns_of(7, ["z <|im_end|>", "<|im_start|>user"]),
    (8, 0, None, None), (8, 1, "user", ""), (9, 0, None, ""), (9, None, "user", "before all"),
    (10, 0, "user", "q"), (10, 0, "user", "p"), (10, 1, "assistant", "r"), (11, 0, "user", "q"),  # two rows of one turn
    (11, 0, "user", "q"), (None, 0, "user", "nobody"), (None, 1, "assistant", "said"), (12, 0, "user", "nobody"),
    *turns_of(13, [f"t{i}" for i in range(40)]), *turns_of(14, [f"t{i}" for i in range(25)]),
    *turns_of(15, [f"t{i}" if i != 20 else "other" for i in range(40)]),
]


@pytest.mark.parametrize("per_row", [1024, 8])
def test_chats(spark, per_row):
    frame = spark.createDataFrame([(*r, "x") for r in CONVERSATIONS], CHATS + ", FIRST_TURN string").repartition(4)
    found = chat.format_chats(frame, per_row=per_row)
    assert found.columns == ["conv_id", "first_turn", "n_turns", "text"]
    rows = found.collect()
    assert {r.conv_id for r in rows} == brute.maximal(CONVERSATIONS)
    shown = {}
    for r in rows:
        shown[r.conv_id] = shown.get(r.conv_id, 0) + r.n_turns
        assert r.text.count(chat.START) == r.text.count(chat.END) == r.n_turns
    assert shown == {c: len({x[1:] for x in CONVERSATIONS if x[0] == c}) for c in shown}
    whole = {(r.conv_id, r.first_turn): r.text for r in rows}
    if per_row == 1024:
        assert whole[4, 0] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
        assert whole[7, 0].startswith("<|im_start|>user\nz < |im_end|><|im_end|>\n")
        assert whole[9, None].startswith("<|im_start|>user\nbefore all") and "unknown\n<" in whole[9, 0]
    else:
        parts = sorted((r for r in rows if r.conv_id == 13), key=lambda r: r.first_turn)
        assert [r.first_turn for r in parts] == [0, 8, 16, 24, 32] and sum(r.n_turns for r in parts) == 40


def test_rows_are_cut_by_the_number_of_turns(spark):
    stamps = [(2, 1_700_000_000 + 4000 * i, "user", f"s{i}") for i in range(1000)]
    many = [*turns_of(1, ["a", "b", "c"], 1023), *stamps, *turns_of(3, [f"t{i}" for i in range(1100)], 5), *turns_of(4, ["a", "b"], -1), (4, None, "user", "n")]
    rows = chat.format_chats(spark.createDataFrame(many, CHATS).repartition(3)).collect()
    found = sorted((r.conv_id, r.first_turn or 0, r.first_turn is None, r.n_turns) for r in rows)
    assert found == [(1, 1023, False, 3), (2, 1_700_000_000, False, 1000), (3, 5, False, 1024), (3, 1029, False, 76), (4, -1, False, 2), (4, 0, True, 1)]
    text = next(r.text for r in rows if r.conv_id == 2)
    assert [int(x) for x in re.findall(r"\ns(\d+)<", text)] == list(range(1000))


def test_many_rows_of_one_turn_are_cut(spark):
    many = [(1, 0, "user", f"{i}") for i in range(100)] * 2 + turns_of(2, ["a"])
    rows = chat.format_chats(spark.createDataFrame(many, CHATS), per_row=4).collect()
    mine = [r for r in rows if r.conv_id == 1]
    assert len(mine) > 3 and sum(r.n_turns for r in mine) == 100
    assert chat.format_chats(spark.createDataFrame([], CHATS)).count() == 0


def test_chats_equal_their_sql_on_odd_rows(spark, tmp_path):
    from compare import differences
    import duckdb

    from regspan.llm.queries import ORACLES, QUERIES

    rows = [r for r in CONVERSATIONS if r[0] is not None] + turns_of(20, [f"t{i}" for i in range(1500)]) + turns_of(21, [f"t{i}" for i in range(1400)])
    rows += [(22, 3, "user", f"same turn {i}") for i in range(5000)] + [(22, 4, None, "a"), (22, 4, "user", None), (23, 1, None, None), (23, 1, "", "")]
    rows += [(24, 5 * i, "user", f"{i}") for i in range(1030)] + [(24, None, "user", "z")]
    spark.createDataFrame(rows, CHATS).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    ours = QUERIES["op2_chat"](spark, str(tmp_path)).toArrow()
    assert differences(ours, con.execute(ORACLES["op2_chat"]).to_arrow_table()) == []
    cut = sorted(r["n_turns"] for r in ours.to_pylist() if r["conv_id"] == 22)
    assert cut == [906, 4096] and 21 not in {r["conv_id"] for r in ours.to_pylist()}


RULES = [urls.Rule.parse(r) for r in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")]
URLS = [
    "http://a.org/x", "https://WWW.Example.ORG/es/1", "http://example.org/es", "http://example.org/en/12?x=1", "http://x.com/fr/a#b",
    "http://x.com/de/a", "http://x.com/en/a", "http://borg/a", "http://.org/", "no scheme", None, "", "://", "http://a.org", "http://a.org?x/y",
    "//a.org/x", "http://a.net/p:q://r/s", "http://com/fr/", "x://y.example.org:80/es/", "http://notexample.org/es/", "http://A.B/\nx", "http://org/",
]


def plain_verdict(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(brute.LOWER), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


@pytest.mark.parametrize("literal", [200, 0])
def test_rules(spark, monkeypatch, literal):
    monkeypatch.setattr(urls, "LITERAL_RULES", literal)
    frame = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, html string, HOST string")
    found = urls.judge_urls(frame, RULES, columns=["page_id", "HOST"], iterations=2)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = found.collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, verdict = plain_verdict(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urls.judge_urls(frame.where("false"), RULES, iterations=1).count() == 0


def plain_rank(seed, edges, iterations, against=False):
    total = {}
    for (a, _), n in edges.items():
        total[a] = total.get(a, 0) + n
    score = dict(seed)
    for _ in range(iterations):
        new = dict(seed)
        for (a, b), n in edges.items():
            source, target = (b, a) if against else (a, b)
            if source in score:
                new[target] = new.get(target, 0) + 0.85 * score[source] * n / total[a]
        score = new
    return score


def test_trust_and_distrust_follow_links(spark):
    rng = random.Random(5)
    hosts = [f"h{i}.net" for i in range(12)] + ["good.org", "fine.org", "bad.com"]
    pages, edges, judged = [], {}, {}
    for i in range(150):
        host = rng.choice(hosts)
        to = [rng.choice(hosts) for _ in range(rng.randrange(4))]
        if host in hosts[:4]:
            to += ["bad.com"] * 3
        path = rng.choice(["/de/", "/de/", "/de/", "/en/"]) if host == "bad.com" else "/x"
        links = "".join(f"<a href={q}{s}//{t.upper()}/p{q}>" for t, s, q in zip(to, ["http:", "https:", ""] * 3, ['"', "'", '"'] * 3))
        pages.append((i, f"http://{host}{path}", f"<p>{links}<a href='/rel'>"))
        for t in to:
            if t != host:
                edges[host, t] = edges.get((host, t), 0) + 1
        judged.setdefault(host, []).append(plain_verdict(f"http://{host}{path}")[3])
    pages += [(200, "http://worse.com/de/", ""), (201, "http://evil.net/", "<a href=//worse.com>")]
    edges["evil.net", "worse.com"] = 1
    judged |= {"worse.com": ["block"], "evil.net": [None]}
    frame = spark.createDataFrame([*pages, (None, None, None)], "page_id long, url string, html string")
    places = frame.select(urls.host_of(F.col("url")).alias("_host"), urls.path_of(F.col("url")).alias("_path"))
    found = urls.host_verdicts(urls.judge_by_rules(places, RULES), urls.host_edges(frame, "url", "html"), iterations=7).collect()
    share = lambda v: {h: j.count(v) / len(j) for h, j in judged.items() if v in j}
    trust = plain_rank(share("allow"), edges, 7)
    distrust = plain_rank(share("block"), edges, 7, against=True)
    assert {r._host for r in found} == set(trust) | set(distrust)
    for r in found:
        assert r.trust == pytest.approx(trust.get(r._host, 0)) and r.distrust == pytest.approx(distrust.get(r._host, 0))
        assert r.blocked == (distrust.get(r._host, 0) > trust.get(r._host, 0) + 0.5)
    assert {"evil.net", "worse.com"} <= {r._host for r in found if r.blocked}


def page(i, host, to):
    return (i, f"http://{host}/p", " ".join(f"<a href='http://{x}/y'>l</a>" for x in to))


def blocked_hosts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    judged = urls.judge_urls(frame, RULES, columns=["page_id"]).collect()
    return {r.host for r in judged if r.verdict == "block" and r.rule is None}


@pytest.mark.parametrize("n", [1, 2, 50])
def test_linking_only_to_blocked_hosts_is_blocked_however_many_do(spark, n):
    rows = [(0, "http://bad.com/de/x", ""), (1, "http://worse.com/de/x", ""), (2, "http://good.org/", "")]
    rows += [page(10 + i, f"only{i}.net", ["bad.com", "worse.com"]) for i in range(n)]
    rows += [page(100 + i, f"mixed{i}.net", ["bad.com", "fine.net", "calm.net"]) for i in range(n)]
    rows += [page(200, "second.net", ["only0.net"]), page(201, "trusted.net", ["bad.com"]), page(202, "fine.net", ["calm.net"])]
    rows += [(203, "http://good.org/x", "<a href='http://trusted.net/'>l</a>")]
    assert blocked_hosts(spark, rows) == {f"only{i}.net" for i in range(n)} | {"second.net"}


def test_verdicts_on_a_graph_of_200_hosts(spark):
    rng = random.Random(6)
    hosts = [f"h{i}.net" for i in range(170)] + [f"g{i}.org" for i in range(15)] + [f"b{i}.com" for i in range(15)]
    rows, edges, pages_of = [], {}, {}
    for i in range(900):
        a = hosts[i] if i < 200 else rng.choice(hosts)
        kind = 1 if a.endswith(".org") else hosts.index(a) % 3
        pool = hosts[185:] if kind == 0 else hosts[170:185] if kind == 1 else hosts
        to = [x for x in rng.choices(pool, k=rng.randrange(1, 5)) if x != a]
        path = rng.choice(["de", "x"]) if a.endswith(".com") else "p"
        rows.append((i, f"http://{a}/{path}/y", " ".join(f'<a href="//{x}/">l</a>' for x in to)))
        pages_of.setdefault(a, []).append(plain_verdict(rows[-1][1])[3])
        for x in to:
            edges[a, x] = edges.get((a, x), 0) + 1
    seed = lambda v: {h: s for h, j in pages_of.items() if (s := j.count(v) / len(j))}
    trust, distrust = plain_rank(seed("allow"), edges, 20), plain_rank(seed("block"), edges, 20, against=True)
    want = {h for h, d in distrust.items() if d > trust.get(h, 0) + 0.5 and None in pages_of[h]}
    found = blocked_hosts(spark, rows)
    assert found == want and 20 < len(want) < 150


ARTICLE = "<h1>Head</h1><p>First  paragraph,\n with <b>bold</b> &amp; more text, indeed.<br>Next line.<p>Second one: short."
WANT = "Head First paragraph, with bold & more text, indeed. Next line. Second one: short."
PAGES = [
    (None, ""), ("", ""), ("plain  text\n only", "plain text only"), ("<p>a<p>b", "a b"), (f"<article>{ARTICLE}</article>", WANT),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li>Menu</ul></nav><article>{ARTICLE}</article><footer>&copy; foot</footer>", WANT),
    (f"<script>var t='</p><p>not text</p>';</script><div id=main>{ARTICLE}</div><div class='side-bar sidebar'><p>Other stories, many.</p></div>", WANT),
    (f"<body><header><h1>Site name</h1></header><main>{ARTICLE}<aside>Aside, here.</aside><form>Name <input> Send</form></main></body>", WANT),
    (f"<div class=cookie-notice>We use cookies, ok.</div><article>{ARTICLE}<section id='comments'><p>Reader says, hello.</p></section></article>", WANT),
    (f"<!-- <p>no</p> --><article>{ARTICLE}<div hidden>gone</div><div style='display: none'>gone</div></article>", WANT),
    (f"<div class='ad'>Buy now, cheap.</div><article>{ARTICLE}<ins class='adsbygoogle'>Ad</ins></article>", WANT),
    (f"<div class='page has-sidebar'><article title='a hidden thing'>{ARTICLE}</article><div class='sidebar'>x, y.</div></div>", WANT),
    (f"<div id=post><div class=body>{ARTICLE}</div></div><p class='notice'>Mind this, please.</p><span class=ad>Buy.</span>", WANT),
    ("<nav>Only <a href=x>menu</a></nav>", ""), ("x < y & z &gt; 1", "x < y & z > 1"), ("<p title='a > b'>c &#233; &eacute;&nbsp;d</p>", "c é é d"),
    ("<table><tr><td>one<td>two<tr><td>three</table>", "one two three"), ("<p>unclosed <b>bold <i>it", "unclosed bold it"),
    ("<p>" + "long words, " * 5000 + "</p>", ("long words, " * 5000).strip()), ("<a \"b<p>x, y", "x, y"), ("a<!-- open", "a"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_pages(spark):
    frame = spark.createDataFrame([(i, "u", p, 1) for i, (p, _) in enumerate(PAGES)] * 2, "page_id long, url string, html string, TEXT long")
    found = html.extract_text(frame)
    assert found.columns == ["page_id", "url", "html", "text", "n_chars"]
    for r in found.collect():
        assert r.text == html.main_text(r.html) and r.n_chars == len(r.text)
    assert html.extract_text(frame.where("false")).count() == 0


def test_hostile_pages_take_linear_time():
    import time

    begun = time.perf_counter()
    for page in ("<a \"" * 50_000, "<p>" * 50_000, "<div>" * 50_000 + "x", "</b>" * 50_000, "<!--" * 50_000, "&amp" * 50_000, "<a b='c" * 30_000 + ">"):
        html.main_text(page)
    assert time.perf_counter() - begun < 30


ICONS = [
    "<svg class='icon'/>", "<SVG viewBox='0 0 1 1' />", "<svg><path d='x'/><svg><g/></svg><text>Label.</text></svg>", "<math display='block'/>",
    "<svg><path d='x'>", "<svg><foreignObject><p>Label.</p></foreignObject><title>Icon</title></svg>", "<svg><svg/><use href='#a'/></svg>",
]


@pytest.mark.parametrize("icon", ICONS)
def test_text_behind_a_drawing_stays(icon):
    assert html.main_text(f"<article>{icon}{ARTICLE}</article>") == WANT
    assert html.main_text(f"<article><div>{icon}</div>{ARTICLE}</article><div class=ad>{icon}</div><svg><g/></svg>") == WANT
    assert html.main_text(f"<article>{ARTICLE}<p>Icon: {icon}</p><p>Last.</article>") == f"{WANT} Icon: Last."


PROSE = "<p>Normal prose of some length, with commas, and a full stop at the end of it.</p>"
SHORT = "Quoted words, said by somebody else, which are part of the article as well."
NESTED = [f"<section><p>{SHORT}</p></section>", f"<div class=quote><p>{SHORT}</p></div>", f"<section><h2>Aside</h2><div><p>{SHORT}</p></div></section>",
          f"<div class=note><p>One</p></div><div class=note><p>Two</p></div><div class=note><p>{SHORT}</p></div>"]


@pytest.mark.parametrize("n", [3, 100, 3000])
@pytest.mark.parametrize("nested", NESTED)
def test_a_short_nested_part_of_a_long_page_stays(nested, n):
    top = "<div class=top><a href=/>Home</a> <a href=/x>Other, page</a></div>"
    found = html.main_text(f"<body>{top}<div id=post>{PROSE * n}{nested}{PROSE * n}</div></body>")
    assert SHORT in found and found.count("Normal") == 2 * n and "Home" not in found
    assert ("Aside" in found) == ("Aside" in nested)
    assert html.main_text(f"<body>{top}<h1>Title</h1><div id=post>{PROSE * n}</div></body>").startswith("Title Normal")


def test_one_very_dense_path_does_not_shut_out_the_rest():
    code = "a = f(x, y); b: c. " * 2000
    found = html.main_text(f"<body><div id=post>{PROSE * 50}<div class=code><pre>{code}</pre></div></div></body>")
    assert found.count("Normal") == 50 and code.strip() in found


@pytest.mark.parametrize("page", [
    f"<article class='post category-social tag-search'>{ARTICLE}</article>", f"<article id=share-prices class='post social'>{ARTICLE}</article>",
    f"<div class='post category-social' id=share-prices>{ARTICLE}</div>", f"<section id=related-work>{ARTICLE}</section>", f"<section id=image-search>{ARTICLE}</section>",
    f"<article>{ARTICLE.replace('<h1>', '<h1 id=search>').replace('<p>', '<p id=copyright-notice>')}</article>", f"<div class='поиск-search-results'>{ARTICLE}</div>",
    f"<div class=post>{ARTICLE}</div><div class='related-posts'><p>Other, more.</p></div><div class='share-buttons'><p>Tell, all.</p></div><ul id=nav><li>Home</ul>",
    f"<div class=post>{ARTICLE}</div><div id=ad-container-1><p>Buy, now.</p></div><div class=main-menu>Home</div><article class=teaser><p>Other, more.</p></article>",
])
def test_only_whole_names_of_parts_hide_an_element(page):
    assert html.main_text(page) == WANT


MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Story number {i}, told</a></li>" for i in range(5)) + "</ul>"
LONGER = f"{ARTICLE}" + "".join(f"<p>Paragraph {i} has some more words, as prose has, and ends with a full stop.</p>" for i in range(6))
LONGER_WANT = WANT + "".join(f" Paragraph {i} has some more words, as prose has, and ends with a full stop." for i in range(6))


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main><article>{}</article></main><div class=sidebar><p>Other stories, many.</p></div></div>",
    "<div id=page class='layout sidebar-right'><div class=post>{}</div><div class=sidebar><p>Other stories, many.</p></div></div>",
    "<form id=aspnet action=/><nav>Home</nav><div class=post>{}</div><input></form>",
    "<div class='modal popup'><article>{}</article></div>",
    "<article>{}<div class='most-read'><h3>Most read</h3>" + MENU + "</div></article>",
    "<article>{}<div id=discussion><p>Reader says, hello.</p><p>So, do I, he said, and more.</p></div></article>",
    "<article>{}<div class=x7>Buy two, get one free.</div></article><div class=b2>&copy; 2020 The Owner. All rights, as always, reserved.</div>",
    "<div class=top>" + MENU + "</div><div>{}</div><div class=z>" + MENU + "</div><div>Buy now, cheap.</div>",
])
def test_ratios_tell_parts_from_content(page):
    assert html.main_text(page.replace("{}", LONGER)) == LONGER_WANT


def test_constant_scores_lose_the_content(monkeypatch):
    page = f"<div>Buy two, get one free.</div><article>{LONGER}</article>"
    assert html.main_text(page) == LONGER_WANT
    monkeypatch.setattr(html, "scores", lambda found: {b.path: 1.0 for b in found if b.inside})
    assert html.main_text(page) != LONGER_WANT


@pytest.mark.parametrize("label", ["related-work", "share-prices", "search", "social", "menu", "login", "copyright", "hidden", "the-alert"])
def test_slugs_of_headings_and_prose_hide_nothing(label):
    for name in ("h1", "h2", "h6", "p", "blockquote", "pre", "li"):
        assert html.main_text(f"<article>{ARTICLE}<{name} id='{label}'>More.</{name}></article>") == f"{WANT} More."


def test_formulas_and_xmp_are_text():
    formula = "<math display=block><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><mspace/></mrow></math>"
    assert html.main_text(f"<article>{ARTICLE}<p>So {formula}, it says.</p></article>") == f"{WANT} So E = m c 2, it says."
    assert html.main_text(f"<article>{ARTICLE}<math/><xmp>a <b> &amp; c</p></xmp><p>End.</article>") == f"{WANT} a <b> &amp; c</p> End."
    assert html.main_text(f"<article>{ARTICLE}<xmp>a <b> c") == f"{WANT} a <b> c"


LONG = "x" * 2500 + " > LEAK <p> " + "y" * 2500


@pytest.mark.parametrize("attributes", [f'data-json="{LONG}"', f"data-json='{LONG}'", " ".join(f"a{i}=1" for i in range(300)) + " title='a > LEAK'", f'a="{LONG}" b = "\'" {"c " * 300} d=\'">\''])
def test_long_tags_end_outside_quotes(attributes):
    assert html.main_text(f"<div {attributes} class='sidebar'><p>Other stories, many.</p></div><div id=post>{ARTICLE}</div>") == WANT
    assert html.main_text(f"<article {attributes}>{ARTICLE}<img {attributes}><br {attributes}/></article {attributes}>") == WANT
    assert "Other" in html.main_text(f"<div {attributes} data-x=' class=sidebar'><p>Other stories, many.</p></div>")


@pytest.mark.parametrize("page,text", [("<p class=x title='>a, b.</p>", "a, b."), ("<p class=ad title='>a, b.</p>", ""), ('<p title=it\'s>a, "b.</p>', 'a, "b.'), ("<p>x</p><a b='", "x <a b='"), ("<p>x</p>y <a <!-- z", "x y <a")])
def test_quotes_that_are_never_closed(page, text):
    assert html.main_text(page) == text


def test_tags_with_unclosed_quotes_take_linear_time():
    import time

    begun = time.perf_counter()
    for page in ("<a " + "b='><a '" * 30_000 + "b='", "<a " * 50_000 + "<!-- >", "<a b='>" * 30_000 + "'", "<a b=\"'>" * 30_000, "<p " + "a='1' " * 30_000 + "b='>"):
        html.main_text(page)
    assert time.perf_counter() - begun < 30


PAYLOADS = [
    "<p>one</p>", "", None, "a\r\n\r\nb\r\n", "\r", "x\r\r\n\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "é字😀", "ends\r", "<p>one</p>", "\r\n", "\r\n\r\n", "x" * 300_000,
]


def pages(spark):
    rows = [(100 - i, f"http://h{i}.org/p?q={i}", p, "x") for i, p in enumerate([*PAYLOADS, *PAYLOADS[:8]])]
    rows += [(None, None, "no id", "y"), (None, "http://bad url/\r\nX: y", "<p>one</p>", "y"), (500, None, "\x00\x1f", "z"), (7, "http://a.b", "twice", "q"), (7, "http://a.b", "twice", "q")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_id string").repartition(3)


def test_archives_round_trip(spark, tmp_path):
    frame, path = pages(spark), str(tmp_path / "archives")
    warc.write_archives(frame, path)
    found = warc.captures(warc.read_records(spark, path)).collect()
    rows = frame.collect()
    least = {}
    for r in rows:
        d = brute.digest(r.html)
        least[d] = min([x for x in (least.get(d), r.page_id) if x is not None], default=None)
    want = []
    for r in rows:
        d = brute.digest(r.html)
        first = least[d] == r.page_id
        want.append((r.page_id, len((r.html or "").encode()), d, "response" if first else "revisit", None if first else least[d]))
    got = []
    for c in found:
        fields, answer = c.metadata[0].fields, c.response
        id = fields.get("captureid")
        refers = answer.refers_to and int(answer.refers_to.split(":")[2])
        got.append((id and int(id), int(fields["payloadlength"]), answer.digest, answer.type, refers))
        assert len(c.metadata) == 1 and c.request.http.startswith("GET ")
        if answer.type == "response":
            assert answer.payload_digest == answer.digest and answer.payload_bytes == len(answer.payload)
            assert brute.digest(bytes(answer.payload).decode()) == answer.digest
        else:
            assert answer.payload is None
    order = lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_small_payloads_are_all_responses(spark, tmp_path):
    warc.write_archives(pages(spark), str(tmp_path / "a"), least_bytes=12)
    kinds = [r.type for r in warc.read_records(spark, str(tmp_path / "a"), payloads=False).collect()]
    assert kinds.count("response") + kinds.count("revisit") == kinds.count("metadata") == kinds.count("request") == 26
    assert kinds.count("revisit") == 1  # the WARC header as payload; "twice" is a response twice


def test_an_empty_table_gives_empty_archives(spark, tmp_path):
    warc.write_archives(pages(spark).where("false"), str(tmp_path / "a"))
    assert warc.captures(warc.read_records(spark, str(tmp_path / "a"))).count() == 0


def test_metadata_of_a_request_belongs_to_its_capture(spark):
    rows = [("r", "response", None), ("q", "request", "r"), ("m", "metadata", "q"), ("n", "metadata", "r"), ("lost", "metadata", "nothing"), ("v", "revisit", None)]
    fields = "refers_to string, target_uri string, date string, digest string, http string, payload_bytes long, payload_digest string, payload binary"
    frame = spark.createDataFrame([(i, t, c, *[None] * 8, {"a": i}) for i, t, c in rows], f"record_id string, type string, concurrent_to string, {fields}, fields map<string,string>")
    found = {c.response.record_id: c for c in warc.captures(frame).collect()}
    assert set(found) == {"r", "v"} and found["r"].request.record_id == "q"
    assert [m.record_id for m in found["r"].metadata] == ["m", "n"] and found["v"].metadata is None


def test_base32(spark):
    for text in ("", "a", "字" * 50):
        hexadecimal = F.sha1(F.lit(text).cast("binary"))
        assert spark.range(1).select(warc.base32(hexadecimal)).first()[0] == brute.digest(text)
