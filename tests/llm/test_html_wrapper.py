"""The wrapper decides: constants go, slots and groups stay, whatever the depth, the tags or the names."""

from __future__ import annotations

import random

import pytest

from opscore.llm import html_extract as H


def words(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def site_page(rnd: random.Random, layout: int) -> tuple[str, list[str]]:
    """A page of one of four layouts, and its article blocks."""
    paragraphs = [words(rnd, rnd.randint(8, 30)) for _ in range(rnd.randint(2, 6))]
    title, extra = words(rnd, 4), words(rnd, 12)
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    menu = '<nav><a href="/">home</a></nav><div class="sidebar">top stories</div>'
    if layout == 0:  # neither article nor main
        return (f'<html><body>{menu}<div id="wrap"><div class="text"><h2>{title}</h2>{body}</div></div>'
                f'<div class="legal">terms apply</div></body></html>', [title, *paragraphs])
    if layout == 1:  # a constant notice in the container, a section with a telling name
        return (f'<html><body>{menu}<article><h1>{title}</h1><p>Read our terms before you copy this text.</p>{body}'
                f'<section class="related-work"><h2>Related work</h2><p>{extra}</p></section></article></body></html>',
                [title, *paragraphs, "Related work", extra])
    if layout == 2:  # the text is beside a short article element
        teaser = words(rnd, 2)
        return (f'<html><body><article><p>{teaser}</p></article><div class="story">{body}<p>{extra}</p></div></body></html>',
                [*paragraphs, extra])
    return (f'<html><body>{menu}<main><div>{"<div>" * 150}<p>{extra}</p>{"</div>" * 150}{body}'
            f'<div class="comments"><p>{words(rnd, 9)}</p></div></div></main></body></html>', [extra, *paragraphs])


def site(layout: int, n: int = 12) -> list[tuple[str, list[str]]]:
    rnd = random.Random(layout)
    return [site_page(rnd, layout) for _ in range(n)]


@pytest.mark.parametrize("layout", range(4))
def test_whole_hosts_on_spark(spark, layout):
    pages = site(layout)
    rows = [(i, f"https://host{layout}.example/{i}", page, "x") for i, (page, _) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    got = {r["page_id"]: r["text"] for r in H.op5_html_extract(df).collect()}
    assert got == {i: "\n".join(blocks) for i, (_, blocks) in enumerate(pages)}


def test_text_after_a_deep_nest_stays():
    nest = "<div>" * 150 + "<p>deep</p>" + "</div>" * 150
    page = f'<html><body><article><div class="in"><p>start</p>{nest}<p>after</p></div><p>end</p></article><p>no</p></body></html>'
    assert H.main_text(page, ["html", "body", "article"]) == "start\ndeep\nafter\nend"
    menu = "<div>" * 120 + "<nav><p>menu</p></nav><form><p>form</p></form><p>text</p>" + "</div>" * 120
    assert H.main_text(f"<html><body><article>{menu}</article></body></html>", ["html", "body", "article"]) == "text"


@pytest.mark.parametrize("name", ["related-work", "legal", "notice", "side effects", "search", "alert", "header"])
def test_sections_with_telling_names_stay(name):
    page = f'<html><body><article><p>a</p><section class="{name}"><p>b</p></section></article><div class="{name}">c</div></body></html>'
    assert H.main_text(page, ["html", "body", "article"]) == "a\nb"


@pytest.mark.parametrize("name", ["ad", "comments", "share-bar", "newsletter", "nav-links"])
def test_parts_of_the_site_go_everywhere(name):
    page = f'<html><body><article><p>a</p><div class="{name}"><p>b</p></div></article></body></html>'
    assert H.main_text(page, ["html", "body", "article"]) == "a"


def test_constants_need_several_different_pages():
    page = "<html><body><article><p>%s</p><p>same on every page</p></article></body></html>"
    several = H.infer([page % f"text number {i} of the host, long enough to be most of it" for i in range(3)])
    path = H.main_path(several)
    assert H.constants(several, path, 3) == ["same on every page"]
    assert H.constants(several, path, 2) == []
    copies = H.infer([page % "one text"] * 4)
    assert H.constants(copies, H.main_path(copies), 4) == []


def test_headings_stay():
    page = "<html><body><article><h2>Summary</h2><p>%s</p></article></body></html>"
    wrapper = H.infer([page % f"text number {i} of the host" for i in range(4)])
    assert H.constants(wrapper, H.main_path(wrapper), 4) == []


def test_a_broken_page_of_very_many_open_elements():
    page = "<html><body><article>" + "<div><span><p>x" * 20_000
    assert H.main_text(page, ["html", "body", "article"]).count("x") == 20_000


def host_pages(n: int, lacking: int | None = None) -> list[tuple]:
    """A host whose container has one block on all pages, and one on all but the page ``lacking``."""
    rnd = random.Random(17)
    return [(i, f"https://large.example/{i}", "<html><body><nav>menu</nav><article>"
             + "".join(f"<p>{words(rnd, 20)}</p>" for _ in range(rnd.randint(1, 4)))
             + "<div>on all pages</div>" + ("" if i == lacking else "<section>on nearly all pages</section>")
             + "</article></body></html>") for i in range(n)]


def test_a_constant_is_on_all_pages_of_the_host(spark):
    for lacking in (3, 44):
        pages = spark.createDataFrame(host_pages(60, lacking), "page_id long, url string, html string")
        texts = {r["page_id"]: r["text"].split("\n") for r in H.op5_html_extract(pages).collect()}
        assert all(("on nearly all pages" in t) == (i != lacking) and "on all pages" not in t for i, t in texts.items())


def test_the_wrapper_does_not_depend_on_the_partitions(spark):
    rows = host_pages(90, 8) + [(1_000 + i, f"https://other.example/{i}", site_page(random.Random(i), i % 4)[0]) for i in range(40)]
    rows += rows[:30] * 3
    found = []
    for parts, order in ((1, 1), (7, -1)):
        pages = spark.createDataFrame(rows[::order], "page_id long, url string, html string").repartition(parts)
        found.append(sorted(map(tuple, H.wrappers(pages, group=4).collect())))
    assert found[0] == found[1] and [r[0] for r in found[0]] == ["large.example", "other.example"]
    assert found[0][0][2] == ["on all pages"]


def test_a_wrapper_stays_as_narrow_as_the_template():
    rnd = random.Random(5)
    tags = ("p", "ul", "h2", "pre", "table", "blockquote")
    pages = ["<html><body><article>" + "".join(f"<{t}>{words(rnd, 3)}</{t}>" for t in rnd.choices(tags, k=30))
             + f'<div class="c{words(rnd, 1)}"><p>{words(rnd, 3)}</p></div></article><p>always</p></body></html>' for _ in range(300)]
    wrapper = H.infer(pages)

    def width(e: H.Element) -> int:
        return max([len(e.kids), *map(width, e.kids)])

    assert width(wrapper) < 2 * H.WIDEST + 32 and H.main_path(wrapper) == ["html", "body", "article"]
    assert wrapper.size == sum(H.tree(p).size for p in pages)
