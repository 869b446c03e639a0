import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import mainhtml


@pytest.fixture(scope="module")
def chain():
    return mainhtml.fit(mainhtml._labelled())


def test_blocks_and_references():
    found = mainhtml.blocks("<p>a&amp;b  <b>c\n<p>d &lt 2<br>e</p><script>if (a<b) x('</p>')</script><!-- <p>no --><li>one<li>two <a href='x>y'>three</a>")
    assert [b.text for b in found] == ["a&b c", "d < 2 e", "one", "two three"]
    assert found[3].linked == 5
    assert mainhtml.blocks("") == [] and mainhtml.blocks("<p> </p><!-- x") == []


def test_article_without_its_surroundings(chain):
    page = (
        "<body><nav><ul><li>Menu</li></ul></nav><div class=ad>Buy now, it is cheap.</div><article><h1>Title</h1><p>First &amp; best.</p>"
        "<aside>Side, with words.</aside><p><b>Second<br><p>Third</p><div class='comments'><p>I disagree, strongly.</p></div></article>"
        "<form><p>Your name, please.</p></form><footer>&copy; x<p>Text of a footer, long and dull, with commas.</p></footer>"
    )
    assert mainhtml.main_text(page, chain) == "Title\nFirst & best.\nSecond\nThird"
    assert mainhtml.main_text(None, chain) == ""


def test_viterbi_equals_all_paths(chain):
    import itertools

    x = mainhtml.features(mainhtml.blocks(mainhtml.LABELLED[1])[:8], False)
    score = x @ chain.emit.T

    def value(path):
        return chain.start[path[0]] + sum(score[i, a] for i, a in enumerate(path)) + sum(chain.step[a, b] for a, b in zip(path, path[1:]))

    best = max(itertools.product((0, 1), repeat=len(x)), key=value)
    assert list(best) == chain.decode(x)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in mainhtml.extract(pages).collect()}
    assert len(got) == pages.count()
    import html

    for p in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[p.page_id].text == "\n".join(x for x in parts if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_nulls_empty_and_clashing_columns(spark):
    rows = [(1, "u", None, "x"), (None, None, "", "y"), (3, "u", "<article><p>" + "long " * 50_000 + "</p></article>", "z"), (3, "u", "<article>a</article>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.n_chars) for r in mainhtml.extract(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", 0), (None, None, 0), (3, "u", 249_999), (3, "u", 1)], key=str)
    assert mainhtml.extract(pages.limit(0)).collect() == []


GIVEN = "/root/testdata/sf0.01/pages.parquet"


@pytest.fixture(scope="module")
def given_pages():
    pages = pq.read_table(GIVEN)["html"].to_pylist()
    rows = mainhtml._labelled()
    for page in pages[:60]:
        found = mainhtml.blocks(page)
        rows.append((mainhtml.features(found), np.array([b.kind == mainhtml.MAIN for b in found], np.int64), 1.0))
    return pages, mainhtml.fit(rows)


@pytest.mark.parametrize("names", ["post comments-open", "site-main has-sidebar", "entry share-enabled", "post tag-share category-newsletter"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_names_of_looks_and_states_do_not_lose_an_article(given_pages, names, tag):
    pages, chain = given_pages
    for page in pages:
        changed = re.sub(r"<article\b[^>]*>", f'<{tag} class="{names}">', page).replace("</article>", f"</{tag}>")
        assert changed != page
        assert mainhtml.main_text(changed, chain) == mainhtml.main_text(page, chain) != ""


@pytest.mark.parametrize("element", ["<video src=x>", "<button>", "<svg>", "<select>"])
def test_unclosed_elements_end_with_their_block(given_pages, element):
    pages, chain = given_pages
    for page in pages[:50]:
        changed = re.sub(r"(<article\b[^>]*>)", rf"\1<div>{element}lost</div>", page)
        assert mainhtml.main_text(changed, chain) == mainhtml.main_text(page, chain)


def test_comments_are_left_out_though_they_are_articles():
    chain = mainhtml.fit(mainhtml._labelled())
    body = "".join(f"<p>This is the long paragraph number {i} of the article, with a full sentence.</p>" for i in range(5))
    page = f"<main><article class='post comments-open'>{body}</article><section id='comments'><article class='comment'><p>Nice words, reader says.</p></article></section></main>"
    assert "reader says" not in mainhtml.main_text(page, chain) and "paragraph number 4" in mainhtml.main_text(page, chain)
    assert "lost" not in mainhtml.main_text(f"<article>{body}<script>lost", chain)
