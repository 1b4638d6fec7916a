"""WARC packages, HTML extraction, the registered queries and the pipeline."""

import hashlib
import io
import re
import zipfile
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF0001
from tools.oracle_check import TABLES, digest

PAGES = "page_id long, url string, html string"
LONG = "<p>" + "x" * 1200 + "</p>"
ODD = [(1, None, None), (2, "http://a/\r\nb c", ""), (3, "http://ü/", LONG), (4, "u", LONG), (4, "u", LONG), (9, "u", LONG),
       (None, "u", LONG), (None, None, "short"), (11, "u", "short"), (12, "u", "\x00é🙂\r\n\r\nWARC/1.1 "), (13, "u", "y" * 999)]


# ---- ZIP packages ---------------------------------------------------------------------------

@pytest.mark.parametrize("zip64", [False, True])
def test_package_round_trip(zip64):
    from ledgergraph.llm.warc import PackageWriter, members, read_range
    out = io.BytesIO()
    package = PackageWriter(out, zip64=zip64)
    package.member("a/é.bin", b"one" * 100)
    package.member("empty", b"")
    package.member("z", b"PK\x05\x06 not the end " * 3)
    package.close()
    data = out.getvalue()
    assert len(data) == package.at
    # what an independent reader sees
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.namelist() == ["a/é.bin", "empty", "z"]
        want = {n: z.read(n) for n in z.namelist()}
    f = io.BytesIO(data)
    assert {n: read_range(f, *at) for n, at in members(f, len(data)).items()} == want


@pytest.mark.parametrize("zip64", [False, True])
def test_reads_packages_of_another_writer(zip64):
    from ledgergraph.llm.warc import members, read_range
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open("archive/x", "w", force_zip64=zip64) as m:
            m.write(b"payload")
        z.writestr("b", b"second")
        z.comment = b"a comment PK after the directory"
    data = out.getvalue()
    f = io.BytesIO(data)
    assert {n: read_range(f, *at) for n, at in members(f, len(data)).items()} == {"archive/x": b"payload", "b": b"second"}


def test_refuses_what_it_cannot_range_read():
    from ledgergraph.llm.warc import members
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("deflated", b"x" * 1000)
    for data in (out.getvalue(), b"no zip at all", b"PK\x05\x06" + b"\x00" * 10):
        with pytest.raises(ValueError):
            members(io.BytesIO(data), len(data))


def test_record_round_trip():
    from ledgergraph.llm.warc import parse, record
    body = "é\r\n\r\nWARC/1.1\r\n".encode()
    sha = hashlib.sha1(body).hexdigest()
    fields, http, got = parse(record("response", "7", "http://a/ b\n", body, sha, None))
    assert got == body and fields["warc-target-uri"] == "http://a/%20b%0A" and http["content-length"] == str(len(body))
    fields, http, got = parse(record("revisit", "8", "u", body, sha, "7"))
    assert got == b"" and fields["warc-refers-to"] == "<urn:page:7>" and http["content-length"] == str(len(body))


def test_archive_odd_rows(spark):
    from ledgergraph.llm.warc import archive, read_packages
    df = spark.createDataFrame(ODD, PAGES).withColumn("digest", F.lit("x")).withColumn("kind", F.lit("x"))
    packages, folder = archive(df, package_bytes=400)
    assert packages.count() > 1
    got = read_packages(packages, folder, run_bytes=300).collect()
    assert len(got) == len(ODD)
    seen = sorted(((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=str)
    want = []
    for i, _, html in ODD:
        n = len((html or "").encode())
        revisit = html == LONG and i != 9
        want.append((i is None, i or 0, "revisit" if revisit else "response", 9 if revisit else None, n))
    assert seen == sorted(want, key=str)
    bodies = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert bodies[12] == ODD[9][2] and bodies[1] == "" and bodies[9] == LONG
    assert {r.payload_digest for r in got if r.payload_bytes == len(LONG)} == {hashlib.sha1(LONG.encode()).hexdigest()}
    packages, folder = archive(spark.createDataFrame([], PAGES))
    assert read_packages(packages, folder).count() == 0


def test_read_fails_on_a_cut_package(spark, tmp_path):
    from ledgergraph.llm.warc import members, read_range, PackageWriter, DATA
    out = io.BytesIO()
    package = PackageWriter(out)
    package.member(DATA, b"x" * 100)
    package.close()
    f = io.BytesIO(out.getvalue())
    at, size = members(f, package.at)[DATA]
    with pytest.raises(ValueError):
        read_range(f, at, package.at)


# ---- HTML -----------------------------------------------------------------------------------

EN = "The old harbour was built by the people of the town and it is still in use for the boats that come in. "
ARTICLE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header class="site-header"><h1>The Site</h1><p>{EN}</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav>
<div class="cookie-notice">We use cookies. {EN}</div>
<main><article><header><h2>Harbour &amp; town</h2></header><p>{EN * 3}<p>Short.
<div class="ad">Buy the <b>boats</b> now. {EN}</div>
<p>With&nbsp;&lt;b&gt; and   spaces <script>var t = "</p>";</script>inside <a href=x>a link</a>.</p>
<ul><li>first point<li>second point</ul><table><tr><td>cell one</td><td>cell two</td></tr></table>
<form><label>Mail</label><input name=m><button>Send</button></form>
<blockquote>{EN}</blockquote>
<section id="comments"><h3>Comments</h3><article class="comment"><p>{EN * 3}</p></article></section></article>
<aside><p>{EN * 2}</p></aside></main><footer>© 2020 The Site</footer></body></html>"""


def test_article_page():
    from ledgergraph.llm.html_text import main_text
    one = EN.strip()
    assert main_text(ARTICLE).split("\n\n") == [
        "Harbour & town", (EN * 3).strip(), "Short.", "With <b> and spaces inside a link.", "first point", "second point",
        "cell one", "cell two", one]


def test_page_without_marked_article():
    from ledgergraph.llm.html_text import main_text
    page = (f"<body><div><a href=a>One</a> <a href=b>Two</a></div><div><h1>Title of it</h1><div>{EN * 3}</div><div>Then.</div>"
            f"<div>{EN * 3}</div></div><div>Contact us</div><div><a href=c>{EN * 2}</a></div></body>")
    assert main_text(page).split("\n\n") == ["Title of it", (EN * 3).strip(), "Then.", (EN * 3).strip()]


def test_main_text_outside_of_an_article():
    from ledgergraph.llm.html_text import main_text
    main, one = (EN * 3).strip(), EN.strip()
    teaser = f"<article><h3>Read next</h3><p>{EN}</p></article>"
    for wrap in ("div", "main", "section"):
        for page in (f"<body><{wrap}><p>{main}</p><p>{main}</p></{wrap}>{teaser}</body>",
                     f"<body><{wrap}>{teaser}<p>{main}</p><p>{main}</p></{wrap}></body>"):
            assert main_text(page).split("\n\n").count(main) == 2
    # an article with most of the text still stands for the page
    assert main_text(f"<body><div><p>{one}</p></div><article><p>{main}</p></article></body>") == main


def test_stop_words_count_inside_of_an_article():
    from ledgergraph.llm.html_text import main_text
    main = (EN * 3).strip()
    links = "<p><a href=a>" + "Harbour boats tickets prices timetable " * 3 + "</a></p>"
    list_of_names = "Rotterdam Hamburg Antwerp Valencia Piraeus Algeciras Bremerhaven Felixstowe Barcelona Genoa"
    page = f"<article><p>{main}</p>{links}<p>{list_of_names}</p>{links}<p>{main}</p></article>"
    assert main_text(page) == f"{main}\n\n{main}"
    # next to a good block it stays, and so does an article in a language without known stop words
    assert main_text(f"<article><p>{main}</p><p>{list_of_names}</p></article>") == f"{main}\n\n{list_of_names}"
    assert main_text(f"<article>{links}<p>{list_of_names}</p>{links}</article>") == list_of_names


@pytest.mark.parametrize("wrap,end", [
    ("<article class='post category-legal'>", "</article>"), ("<article class='post comments-open'>", "</article>"),
    ("<article class='ad related'>", "</article>"), ("<div class='elementor-widget'><article>", "</article></div>"),
    ("<div class='widget'><article>", "</article></div>"), ("<div id=page class='sharing-enabled'><article>", "</article></div>"),
    ("<div class='social'><div class='search-wrapper'>", "</div></div>"), ("<div class='comments'><article>", "</article></div>")])
def test_names_on_wrappers_hide_nothing(wrap, end):
    from ledgergraph.llm.html_text import main_text
    main = (EN * 3).strip()
    part = f"<div class='social-share'>{EN}</div><div class=ad>{EN}</div>"
    assert main_text(f"<body>{wrap}<p>{main}</p>{part}<p>{main}</p>{end}<div class='newsletter'>{EN}</div></body>") == f"{main}\n\n{main}"


def test_names_still_mark_parts():
    from ledgergraph.llm.html_text import main_text
    main = (EN * 3).strip()
    for name in ("ad", "related", "cookie-notice", "comment-list", "share_buttons", "sidebar", "search-box"):
        assert main_text(f"<body><div><p>{main}</p><div class='{name}'>{EN * 2}</div><p>{main}</p></div></body>") == f"{main}\n\n{main}"
    # more comments than article
    page = f"<body><article><p>{main}</p></article><section id=comments><p>{EN * 6}</p><p>{EN * 6}</p></section></body>"
    assert main_text(page) == main


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><meta charset=utf-8><body><article><p>a</article></body></html>", "a"),
    ("<head><title>T</title><link rel=x href=y><style>p{}</style><article><p>a</article>", "a"),
    ("<head class=sidebar><title>T<b></title><script>'<p>x'</script></head><article>a</article>", "a"),
    ("<article>a<svg viewBox='0 0 1 1'/><p>b</p><math />c</article>", "a\n\nb\n\nc"),
    ("<article>a<svg aria-label='x/>y'/>b<svg href=u/v><text>t</text></svg>c</article>", "abc"),
    ("<article>a<svg><path d=x /><text>t</text></svg><p>b</p></article>", "a\n\nb"),
    ("<article>a<video-player>b</video-player><p>c</article>", "a\n\nb\n\nc")])
def test_unclosed_head_and_self_closed_drawings(page, text):
    from ledgergraph.llm.html_text import main_text
    assert main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", ""), ("<article>tiny</article>", "tiny"), ("<article><p>a<br>b\n c</article>", "a b c"),
    ("<article><p>a<!-- x <p>b --></p><p>c</article>", "a\n\nc"), ("<article>x <script>never closed <p>y", "x"),
    ("<nav>menu<article><p>in it</p></article>", "in it"),
    ("<body class='home sidebar'><div class='wrap has-sidebar'><article>a<div class=sidebar>s</div></article></div>", "a"),
    ('<article><p class="x>a</p><p>b</p></article>', "a\n\nb"),
    ("<article>a<div class=comments><article>said</article></div></article>", "a"), ("<article><p hidden>h</p><p>v</p></article>", "v"),
    ("<article>&#x41;&eacute;&notanentity; 1 < 2</article>", "Aé&notanentity; 1 < 2"),
    ("<article><p>a</p></div></p></section><p>b</p></article>", "a\n\nb")])
def test_small_pages(page, text):
    from ledgergraph.llm.html_text import main_text
    assert main_text(page) == text.replace("&notanentity;", __import__("html").unescape("&notanentity;"))


def test_html_gold_of_the_page_table(spark):
    """The pages of the test tables follow one template, whose article a regular expression finds."""
    import html

    from ledgergraph.llm.html_text import query

    def gold(page):
        body = re.split("</article>|<footer>", page.split("<article>", 1)[1])[0]
        parts = (re.sub("</?b>", "", x.replace("<br>", " ")) for x in re.split("</?(?:p|h1)>", body))
        return "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    got = query(spark, SF0001).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == gold(pages[r.page_id]) and r.n_chars == len(r.text)


def test_html_odd_rows(spark):
    from ledgergraph.llm.html_text import extract
    df = spark.createDataFrame(ODD + [(99, "u", "<article>" + "<p>word " * 50_000)], PAGES).withColumn("text", F.lit("x")) \
        .withColumn("row", F.lit("x")).withColumn("t", F.lit("x"))
    got = extract(df).collect()
    assert len(got) == len(ODD) + 1
    long = next(r for r in got if r.row.page_id == 99)
    assert long.text.count("word") == 50_000 and long.n_chars == len(long.text)
    assert extract(spark.createDataFrame([], PAGES)).count() == 0


# ---- queries and pipeline -------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op6_exact_dedup", "op8_warc", "op9_mixing"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    sp, dd = entry.queries()[name](spark, SF0001).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns) and len(sp) == len(dd)
    assert digest(sp) == digest(dd)


def test_eleven_queries_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()


def test_pipeline_stages(spark):
    """Every stage against its own input: rules by brute force, columns and rows."""
    from ledgergraph.session import staged
    from test_operators import _components_brute, _norm, _simhash_brute
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    extra = spark.createDataFrame([(-1, "12345 %%%", "en", "src0", 9), (-2, None, "en", "src0", None)], docs.schema)
    docs, seen = docs.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = staged(stage(spark, docs, SF0001), "test")
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = seen["language ID"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if any(c.isalpha() for c in r.text or ""))

    before, after = seen["exact dedup"]
    first = defaultdict(lambda: 1 << 60)
    for r in before:
        first[_norm(r.text)] = min(first[_norm(r.text)], r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())

    before, after = seen["SimHash near-dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    roots = _components_brute([_simhash_brute(r.text) for r in before], 4)
    assert sorted(r.doc_id for r in after) == sorted({before[i].doc_id for i in roots})
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = seen["mixing"]
    words = sum(len(r.text.split()) for r in after)
    assert abs(words / (1.5 * sum(len(r.text.split()) for r in before)) - 1) < 0.1

    before, after = seen["packing"]
    assert sum(r.piece == 0 for r in after) == len(before)
    assert len({(r.sequence_id, r.offset) for r in after}) == len(after)


def test_pipeline_runs_and_cleans_up(spark):
    from ledgergraph.session import release_scratch, scratch_tables
    before = scratch_tables(spark)
    out = corpus_pipeline.run(spark, SF0001)
    assert out.count() > 0
    assert len(set(scratch_tables(spark)) - set(before)) == 1          # the result alone
    release_scratch(spark, since=before)


# ---- op3: pages without a marked article -----------------------------------------------------

NAV, FOOT = "<nav><a href=/>Home</a> <a href=/b>Blog</a></nav>", "<footer><a href=/t>Terms</a></footer>"
STORY = "This is the story of a man who was in the house with his dog and it was not the first time that they were there. " * 4


def _unmarked(*blocks, holder="div"):
    return f"<body>{NAV}<{holder}>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</{holder}>{FOOT}</body>"


@pytest.mark.parametrize("line", [
    "这是一篇关于城市历史的文章，描述了许多年来人们在这里的生活和工作。",
    "これは長いあいだこの家で犬と暮らしていた男の話で、だれの邪魔もしませんでした。",
    "Это рассказ о человеке, который жил в доме со своей собакой много лет подряд и никому не мешал. ",
    "Był sobie człowiek, który przez wiele lat mieszkał ze swoim psem w starym domu nad rzeką, nikomu nie wadząc. "])
def test_languages_without_stop_words_are_judged_by_length_and_links(line):
    from ledgergraph.llm.html_text import main_text
    text = (line * 6).strip()
    assert main_text(_unmarked(text, text[:90].strip())) == text + "\n\n" + text[:90].strip()
    links = "".join(f"<a href=/{i}>{line}</a>" for i in range(6))
    assert main_text(_unmarked(text, links)) == text


def test_short_blocks_of_unmarked_pages():
    from ledgergraph.llm.html_text import main_text
    lines = ["First short line.", "Second short line here.", "Third."]
    assert main_text(_unmarked(*lines)) == "\n\n".join(lines)
    assert main_text(_unmarked("A short start.", STORY, "The end.")) == f"A short start.\n\n{STORY.strip()}\n\nThe end."
    sign = "The sign © on the wall is one that they put there to tell us that the work was not to be copied."
    rights = "<div>© 2020 The Company. All rights reserved by the company and its partners in the trade.</div>"
    assert main_text(_unmarked(STORY, sign, STORY) + rights) == f"{STORY.strip()}\n\n{sign}\n\n{STORY.strip()}"
    # a short block of another element goes with its neighbours as before
    assert main_text(f"<body>{NAV}<div>Menu of the day</div><div><p>{STORY}</p></div>{FOOT}</body>") == STORY.strip()
    assert main_text(f"<body>{NAV}{FOOT}</body>") == ""


def _two_passes_brute(blocks):
    """Labels of the blocks of a page without marks, by the rules as the module's text states them."""
    from ledgergraph.llm.html_text import FEW_STOP_WORDS, LONG, MANY_LINKS, MANY_STOP_WORDS, SHORT, STOP_WORDS
    share = [sum(w.strip(".,") in STOP_WORDS for w in t.lower().split()) / len(t.split()) for t, *_ in blocks]
    linked = [n / len(t) for t, n, *_ in blocks]
    able = [i for i, (t, n, bad, _) in enumerate(blocks) if not bad and len(t) >= SHORT and linked[i] <= MANY_LINKS]
    if able and max(share[i] for i in able) < FEW_STOP_WORDS:
        for i in able:
            share[i] = MANY_STOP_WORDS
    first = []
    for i, (t, n, bad, _) in enumerate(blocks):
        if bad or linked[i] > MANY_LINKS:
            first.append("bad")
        elif len(t) < SHORT:
            first.append("short")
        elif share[i] >= MANY_STOP_WORDS:
            first.append("good" if len(t) >= LONG else "near")
        else:
            first.append("near" if share[i] >= FEW_STOP_WORDS else "bad")
    out = []
    for i, label in enumerate(first):
        if label in ("good", "bad"):
            out.append(label)
            continue
        left = next((x for x in reversed(first[:i]) if x in ("good", "bad")), "")
        right = next((x for x in first[i + 1:] if x in ("good", "bad")), "")
        if label == "near":
            out.append("bad" if left == right == "bad" and "good" in first else "good")
        elif not blocks[i][1] and any(x == "good" and b[3] == blocks[i][3] for x, b in zip(first, blocks)):
            out.append("good")
        elif left == right or not left or not right:
            out.append(left or right or "bad")
        else:
            out.append("bad")
    if "good" not in out:
        out = ["good" if x == "short" and not b[1] else y for x, y, b in zip(first, out, blocks)]
    return out


def test_two_passes_against_plain_rules():
    import random

    from ledgergraph.llm.html_text import Block, classify, judge_language
    rng = random.Random(6)
    plain, stops = "lorem ipsum dolor amet tempor labore magna".split(), "the of and to in is was".split()
    for _ in range(1500):
        given = []
        for _ in range(rng.randrange(1, 9)):
            words = [rng.choice(stops if rng.random() < rng.choice((0, 0.15, 0.4)) else plain) for _ in range(rng.choice((3, 8, 14, 25, 60)))]
            text = " ".join(words)
            given.append((text, rng.choice((0, 0, 0, 3, len(text))), rng.random() < 0.15, rng.randrange(3)))
        blocks = [Block(t, n, False, int(bad), 0, parent=parent, size=len(t)) for t, n, bad, parent in given]
        judge_language(blocks)
        classify(blocks, 0)
        assert [b.label for b in blocks] == _two_passes_brute(given)
