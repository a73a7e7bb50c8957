import html
import random

import numpy as np
import pytest

from assay.llm import html_text as op
from helpers import prose

SCHEMA = "page_id long, url string, html string"


def page(article, mark="article", extra=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Home</a></li><li><a href=b>News</a></li></ul></nav>"
        "<div class='ad'>Buy now, it is very good.</div>"
        f"<{mark}>{article}</{mark.split()[0]}>{extra}<footer>&copy; 2020 Someone</footer></body></html>"
    )


def paragraphs(seed):
    return [prose(seed + k, n).capitalize() + "." for k, n in enumerate((4, 60, 1, 25))]


def marked_up(blocks):
    return "<h1>" + html.escape(blocks[0]) + "</h1>" + "".join(f"<p>{html.escape(b)}</p>" for b in blocks[1:])


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "u", page(marked_up(paragraphs(10 * i)))) for i in range(40)]
    return op.fit_model(spark.createDataFrame(rows, SCHEMA))


def text_of(model, page):
    return op.extract([page.encode()], model)[0]


def test_held_out_pages_with_and_without_marks(model):
    for seed in range(5000, 5100, 10):
        blocks = paragraphs(seed)
        wanted = "\n\n".join(" ".join(b.split()) for b in blocks)
        assert text_of(model, page(marked_up(blocks))) == wanted
        assert text_of(model, page(marked_up(blocks), mark="div")) == wanted


def test_furniture_inside_and_beside_the_article(model):
    blocks = paragraphs(7)
    inner = marked_up(blocks) + (
        "<div class='advert'>An offer that you will see only once in all your life.</div>"
        "<form><label>Your name, please.</label><textarea>none</textarea></form>"
        "<div id='newsletter-notice'><p>Subscribe to our newsletter to read more of such long stories.</p></div>"
    )
    after = (
        "<section id='comments'><div class='comment'><p>What a great story this was, I liked it very much.</p></div></section>"
        "<aside><p>About the people who write these stories for you, every day.</p></aside>"
    )
    wanted = "\n\n".join(" ".join(b.split()) for b in blocks)
    assert text_of(model, page(inner, extra=after)) == wanted
    assert text_of(model, page(inner, mark="div class='post'", extra=after)) == wanted


def test_markup_references_and_white_space(model):
    got = text_of(
        model,
        page("<p>One&nbsp;&amp; <b>two<br>three &#233;&lt;x\n\n&copy<p>Next <a href='x>y'>link</a> text</p><ul><li>a<li>b</ul><!-- no -->"),
    )
    assert got == "One & two three é<x ©\n\nNext link text\n\na\n\nb"
    cut = page("<p>Whole words of a story that goes on.</p><p>An end that is cut off &am")
    assert text_of(model, cut[: cut.index("&am") + 3]).endswith("cut off &am")
    assert text_of(model, "<article><p>" + "<a title='>" + "</article>").strip("'<> atile=") == ""


def test_marginals_are_exact():
    rng = random.Random(3)
    n = 9
    parent = [-1] + [rng.randrange(i) for i in range(1, n)]
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    kinds = np.array([rng.randrange(len(op.KINDS)) for _ in range(n)])
    trees = op.Forest(np.array(parent), np.array(depth), kinds, np.arange(n), np.arange(n))
    gen = np.random.default_rng(1)
    model = op.Model(gen.normal(size=op.N_FEATURES), gen.normal(size=(len(op.KINDS), 2, 2)))
    content, joint = op.marginals(trees, model)
    total, single, pair = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for code in range(1 << n):
        y = [(code >> i) & 1 for i in range(n)]
        score = sum(model.own[i] * y[i] for i in range(n))
        score += sum(model.pair[kinds[i], y[parent[i]], y[i]] for i in range(1, n))
        weight = np.exp(score)
        total += weight
        single += weight * np.array(y)
        for i in range(1, n):
            pair[i, y[parent[i]], y[i]] += weight
    assert np.allclose(content, single / total)
    assert np.allclose(joint[1:], pair[1:] / total)


def test_awkward_pages(spark, model):
    long = page("".join(f"<p>{prose(k, 400)}</p>" for k in range(2500)))
    deep = "<div>" * 3000 + "A sentence deep down in the page, as long as any." + "</div>" * 3000
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "<p>"), (5, "u", deep), (6, "u", long), (7, "u", "<" * 5000 + "'\"" * 5000)]
    assert len(long) > 4_000_000
    found = {r["page_id"]: r for r in op.extract_text(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert found[1]["text"] == found[2]["text"] == found[None]["text"] == "" and found[1]["n_chars"] == 0
    assert found[6]["text"].count("\n\n") == 2499 and found[6]["n_chars"] == len(found[6]["text"])
    clashing = spark.createDataFrame(rows[:3], SCHEMA).selectExpr("*", "'mine' as text", "'mine' as body", "1 as c0")
    assert op.extract_text(clashing, model, keep=("page_id", "c0")).columns == ["page_id", "c0", "text", "n_chars"]
    empty = spark.createDataFrame([], SCHEMA)
    assert op.extract_text(empty, op.fit_model(empty)).count() == 0
