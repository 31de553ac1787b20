from __future__ import annotations

import html
import random
import re
import time

from obsgrid.llm import html_text
from obsgrid.llm.html_text import main_text
from obsgrid.llm.queries import QUERIES

LONG = "The morning was quiet and the people of the town went to the market as they did on every day of the week. "


def test_articles_of_the_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op3_html_text"](spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"(?s)<article>(.*?)</article>", page["html"])[1]
        blocks = re.split(r"</?(?:h1|p)>", inner)
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        want = "\n\n".join(b for b in plain if b)
        row = got[page["page_id"]]
        assert row["text"] == want and row["n_chars"] == len(want) and row["url"] == page["url"]


def test_boilerplate_goes_and_short_blocks_follow_their_neighbours():
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body>
    <header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
    <div id="cookie-notice"><p>{LONG}</p></div>
    <main><h2>A headline</h2><p>{LONG}<br>caf&eacute; &amp; more</p><p>Short one.</p>
    <div class="ad"><p>{LONG}</p></div><ul class=related><li><a href=a>{LONG}</a></ul>
    <table><tr><td>{LONG}</td></tr></table>
    <form><label>Name</label><input></form>
    <section class="comments"><p>{LONG}</p></section></main>
    <aside>{LONG}</aside><script>document.write("<p>{LONG}</p>")</script>
    <p><a href=x>one</a> <a href=y>two</a></p><footer>&copy; Site</footer></body></html>"""
    line = LONG.strip()
    assert main_text(page) == f"A headline\n\n{line} café & more\n\nShort one.\n\n{line}"


def test_stop_words_decide_outside_articles():
    menu = "Widgets Gadgets Gizmos Contraptions Devices Machines Tools Engines Parts Spares Offers Deals"
    page = f"<div>{LONG}</div><div>Yes.</div><div>{menu}</div><div>More</div>"
    assert main_text(page) == f"{LONG.strip()}\n\nYes."


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<p>") == ""
    assert main_text("just text") == "just text"
    assert main_text("a < b and <b>bold") == "a < b and bold"
    assert main_text("<p title='>'>x</p>") == "x"
    assert main_text("<p>one<p>two<li>three") == "one\n\ntwo\n\nthree"
    assert main_text("x<script>never closed <p>y") == "x"
    assert main_text("x<!-- never closed <p>y") == "x"
    assert len(main_text("<p>" + LONG * 5000)) == len(LONG * 5000) - 1
    assert main_text("<article>" + "<" * 20_000) == "<" * 20_000
    assert main_text("<article><p>x</p>" + "<a '" * 5_000).startswith("x")


def test_awkward_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>a</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [(0, "a", 1), (1, "", 0), (1, "", 0)]
    assert html_text.extract(pages.where("false")).count() == 0


RUSSIAN = "Утром на площади собрались жители города, и торговля шла весь день до самого вечера без перерыва. "
CHINESE = "早上镇上的人们像往常一样去集市买东西，天气很好，孩子们在河边玩耍，老人们坐在树下聊天。" * 3
FINNISH = "Aamulla kaupungin asukkaat kokoontuivat torille, ja kauppa kävi vilkkaana aina iltaan saakka ilman taukoa."
CODE = "def total(values): result = 0 for value in values: result += value return result  # adds up values"


def test_other_languages_and_code_outside_articles():
    for text in (RUSSIAN.strip(), CHINESE, FINNISH, "ภาษาไทยไม่มีจุดจบประโยค" * 6):
        page = f"<div><h1>head</h1><p>{text}</p><p>{text}</p></div><div><a href=x>{text}</a></div><div>Short</div>"
        assert main_text(page) == f"head\n\n{text}\n\n{text}"
    assert main_text(f"<div><h1>head</h1><pre>{CODE}</pre></div>") == "head\n\n" + " ".join(CODE.split())
    mixed = f"<div>{LONG}</div><pre>{CODE}</pre><div>{LONG}</div><p>{RUSSIAN}</p>"
    line = LONG.strip()
    assert main_text(mixed) == "\n\n".join([line, " ".join(CODE.split()), line, RUSSIAN.strip()])


def test_long_blocks_rather_than_short_ones_where_none_is_decided():
    names = "Widgets Gadgets Gizmos Contraptions Devices Machines Tools Engines Parts Spares Offers Deals"
    assert names in main_text(f"<div>{names}</div><div>Short</div>")


def test_names_round_the_whole_page():
    line = LONG.strip()
    want = f"Head\n\n{line}"
    inner = f"<h1>Head</h1><p>{LONG}</p>"
    ad = f"<div class=ad>{LONG}</div>"
    for names in ("class='layout has-sidebar'", "id='page' class='no-ads'", "class=nav-open", "class='sidebar layout'"):
        assert main_text(f"<div {names}><article>{inner}{ad}</article><footer>x</footer></div>") == want
        assert main_text(f"<div {names}><div>{inner}</div>{ad}</div>") == want
    assert main_text(f"<main>{inner}</main><div class=related><article>{inner}</article></div>") == want
    assert main_text(f"<aside><article>{inner}</article></aside>") == ""
    assert main_text(f"<div hidden><article>{inner}</article></div>") == ""


def quadratic_labels(blocks):
    """Labels of the second pass by looking at every decided block for each open one."""
    decided = [i for i, b in enumerate(blocks) if b.label is not None]
    if not any(blocks[i].label for i in decided):
        decided = []
    out = []
    for i, block in enumerate(blocks):
        if block.label is not None:
            out.append(block.label)
            continue
        near = [j for j in decided if blocks[j].section == block.section]
        if not near and not block.main:
            near = [j for j in decided if not blocks[j].boilerplate]
        if block.heading:
            near = [j for j in near if j > i] or near
        best = min(near, key=lambda j: (abs(j - i), not blocks[j].label), default=None)
        out.append(True if best is None else blocks[best].label)
    return out


def test_open_blocks_take_the_nearest_label():
    rng = random.Random(9)
    for _ in range(400):
        blocks = [
            html_text.Block(
                "x", 0, rng.randint(0, 3), rng.random() < 0.2, rng.random() < 0.2, rng.random() < 0.2,
                label=rng.choice([True, False, None, None, None]),
            )
            for _ in range(rng.randint(1, 25))
        ]
        want = quadratic_labels(blocks)
        html_text._second_pass(blocks)
        assert [b.label for b in blocks] == want


def test_long_pages_take_time_in_proportion():
    began = time.time()
    words = "the quick brown fox and the lazy dog are in the field of a farm by the road"
    page = "".join(f"<p>{words} {i}.</p><h2>h{i}</h2>" if i % 3 else f"<div>short {i}</div>" for i in range(60_000))
    assert html_text.main_text(page).count("\n\n") > 30_000
    for tail in ("<a " * 100_000, "<a '" * 100_000, "<!-- " * 100_000, '<a "> ' * 20_000, "< <b" * 100_000):
        assert html_text.main_text(f"<p>{words}, {words}.</p>{tail}").startswith("the quick")
    assert time.time() - began < 60


def test_unclosed_tags_and_comments():
    assert html_text.main_text("<p>One two.</p> tail <a href=") .startswith("One two.")
    assert html_text.main_text("<p>One two.</p><!-- gone <p>x</p>") == "One two."
    assert html_text.main_text("<p>One two.</p><!-- gone") == "One two."
