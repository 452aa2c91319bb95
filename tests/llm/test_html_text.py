"""Main text of pages: the reader on odd markup, the labeller against plain loops and unseen pages, the query on its table."""

import html
import random
import re

import numpy as np
import pytest

from weftline.llm import html_labels, html_text
from weftline.llm.common import table
from weftline.llm.html_blocks import blocks
from weftline.llm.html_layouts import pages

SF_DIR = "/root/testdata/sf0.001"


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>one <b>two</b>\n three<br>four&nbsp;&amp;&lt;x&#233;<p>five") == ["one two three four &<xé", "five"]
    assert texts("<ul><li>a<li>b <a href='>'>c</a></ul><table><tr><td>d<td>e<tr><td>f</table>g") == ["a", "b c", "d", "e", "f", "g"]
    assert texts("<script>var t='</p>';</script>a<!-- <p>x</p> -->b<style>p{}</STYLE>c<textarea><p>d</textarea>e") == ["abc", "e"]
    assert texts("a < b <3 </3> c<p x='y") == ["a < b <3 c"]
    assert texts("<select><option>x</select><button>y</button><head><p>z</head>t") == ["t"]
    assert texts(None) == texts("") == texts(" ") == texts("<div> </div>") == texts("<!-- open <p>x") == texts("<a") == []
    assert texts("<") == ["<"]
    assert texts("x</p></div></nothing><script>never closed <p>y") == ["x"]
    (b,) = blocks('<div class="Side-bar mainNav" id=top role=\'navigation\'><p><a href="/">four</a> six66')
    assert b.path == ("div", ".side", ".bar", ".main", ".nav", ".top", ".navigation", "p", "a") and b.linked == 4


def test_deep_and_long_pages_take_time_in_proportion():
    assert len(blocks("<div>" * 50_000 + "x" + "</div>" * 50_000)[0].path) <= 256
    for page in ("<b>" * 30_000 + "<p>x" * 30_000, "<li>a" * 60_000, "</p>" * 100_000 + "x", "<a ='" * 30_000, "&" * 100_000):
        blocks(page)
    long = "<article><h1>Title here</h1>" + "<p>" + "word " * 200_000 + "</p>" + "<p>Some more words, in a sentence.</p>" * 5000
    (found,) = html_text.main_texts(html_labels.trained(), [blocks(long)])
    assert found.count("\n") == 5001 and len(found) > 1_000_000


def plain_probabilities(model, page):
    """The labeller in loops over blocks and steps, in double precision."""
    m = {k: v.astype(float) for k, v in model.items()}
    xs = []
    for i, b in enumerate(page):
        f = html_labels.Features([page])
        path = [m["path"][html_labels._bucket(t)] for t in b.path]
        ws, sizes = html_labels._word_buckets([b.text])
        word = sum(m["word"][w] for w in ws) / max(sizes[0], 1)
        xs.append(np.concatenate([sum(path) / np.sqrt(len(path)), word + np.zeros(html_labels.WORD), f.plain[i]]))
    n = html_labels.HIDDEN
    sig = lambda v: 1 / (1 + np.exp(-v))
    score = np.full(len(xs), m["out_b"][0])
    for way, order, out in (("f", range(len(xs)), m["out"][:n]), ("b", range(len(xs) - 1, -1, -1), m["out"][n:])):
        h, c = np.zeros(n), np.zeros(n)
        for t in order:
            z = xs[t] @ m[f"{way}_x"] + h @ m[f"{way}_h"] + m[f"{way}_b"]
            c = sig(z[n : 2 * n]) * c + sig(z[:n]) * np.tanh(z[3 * n :])
            h = sig(z[2 * n : 3 * n]) * np.tanh(c)
            score[t] += h @ out
    return sig(score)


def test_labeller_is_what_plain_loops_give():
    model = html_labels.trained()
    some = [html_labels.labelled(p)[0] for p in pages(7, 6)] + [[], blocks("<p>x")]
    got = html_labels.probabilities(model, some)
    want = np.concatenate([plain_probabilities(model, p) for p in some])
    assert np.allclose(got, want, atol=1e-3)
    assert len(html_labels.probabilities(model, [])) == len(html_labels.probabilities(model, [[], []])) == 0


def test_gradients_are_those_of_the_loss():
    made = [html_labels.labelled(p) for p in pages(3, 3)]
    f, y = html_labels.Features([b for b, _ in made]), np.concatenate([y for _, y in made])
    model = {k: v.astype(np.float64) for k, v in html_labels._start(np.random.default_rng(0)).items()}
    _, grad = html_labels.gradients(model, f, y)
    rng = np.random.default_rng(1)
    for name, g in grad.items():
        at = np.unravel_index(np.argsort(-np.abs(g), axis=None)[rng.integers(0, min(5, g.size))], g.shape)
        near = []
        for d in (1e-3, -1e-3):
            moved = {k: v.copy() for k, v in model.items()}
            moved[name][at] += d
            near.append(html_labels.gradients(moved, f, y)[0])
        assert abs((near[0] - near[1]) / 2e-3 - g[at]) < 2e-3 + 0.02 * abs(g[at]), name


def test_unseen_made_pages():
    model = html_labels.trained()
    made = [html_labels.labelled(p) for p in pages(1234, 300)]
    likely = html_labels.probabilities(model, [b for b, _ in made]) >= 0.5
    y = np.concatenate([y for _, y in made])
    assert np.mean(likely == y) > 0.985
    assert np.mean(likely[y]) > 0.98 and np.mean(~likely[~y]) > 0.98


_WORDS = "the of and river stone light walks under every morning old quiet tower where people sing below grey hills".split()


def written_pages():
    """Pages in shapes of their own, as (html, main text)."""
    rng = random.Random(5)
    say = lambda a, b: " ".join(rng.choices(_WORDS, k=rng.randint(a, b))).capitalize() + "."
    for shape in range(40):
        title, ps, other = say(3, 8), [say(12, 60) for _ in range(rng.randint(3, 8))], [say(4, 25) for _ in range(8)]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in ps)
        menu = "".join(f'<li><a href="/{i}">{w.title()}</a></li>' for i, w in enumerate(_WORDS[:6]))
        start = [
            f'<header class="site-header"><div class="logo">My site</div><nav><ul>{menu}</ul></nav></header><main><article>',
            f'<div id="menu"><ul>{menu}</ul></div><div id="cookie-consent"><p>{other[0]}</p></div><div id="content"><div class="post">',
            f'<nav class="navbar">{menu}</nav><div class="notice">{other[0]}</div><div class="container"><div class="entry-content">',
            f"<header><p>{other[0]}</p></header><aside><h3>{other[1]}</h3><ul>{menu}</ul></aside><section><article>",
        ][shape % 4]
        mid = ["", f'<div class="advertisement">{other[2]}</div>', f"<aside>{other[2]}</aside>"][shape % 3]
        end = ["</article></main>", "</div></div>", "</div></div>", "</article></section>"][shape % 4]
        tail = (
            f'<section class="comments"><h2>Comments</h2><div class="comment"><p>{other[3]}</p></div><div class="comment"><p>{other[4]}</p></div></section>'
            f'<div class="sidebar"><h3>{other[5]}</h3><p>{other[6]}</p></div><form action="/q"><label>Your email</label><input><p>{other[7]}</p></form>'
            f"<footer><p>&copy; 2024 {say(2, 5)}</p></footer>"
        )
        cut = body.rfind("<p>")
        yield f"<html><head><title>{title}</title></head><body>{start}{body[:cut]}{mid}{body[cut:]}{end}{tail}</body></html>", "\n".join([title, *ps])


def test_pages_of_other_shapes():
    model = html_labels.trained()
    cases = list(written_pages())
    got = html_text.main_texts(model, [blocks(h) for h, _ in cases])
    found = sum(len(set(g.split("\n")) & set(w.split("\n"))) for g, (_, w) in zip(got, cases))
    assert found / sum(len(set(g.split("\n"))) for g in got) > 0.98
    assert found / sum(len(set(w.split("\n"))) for _, w in cases) > 0.98


def test_query_gives_the_articles(spark):
    rows = table(spark, SF_DIR, "pages").collect()
    got = {r.page_id: r for r in html_text.op12_main_text(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub("<[^>]*>?", " ", t)).split()) for t in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id].text.split("\n") == [t for t in want if t]
        assert got[r.page_id].url == r.url and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_odd_rows(spark):
    one = "<nav><a href='/'>Home</a></nav><article><p>Some words of a sentence, and some more.</p><p>And more of them.</p></article>"
    rows = [(1, None, "k"), (2, "", "k"), (3, "<p>", "k"), (4, one, "k"), (4, one, "k"), (None, one, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract(df, keep=["page_id"]).collect()
    want = "Some words of a sentence, and some more.\nAnd more of them."
    assert sorted(((r.page_id or 0), r.text, r.n_chars) for r in got) == [
        (0, want, len(want)), (1, "", 0), (2, "", 0), (3, "", 0), (4, want, len(want)), (4, want, len(want)),
    ]
    assert html_text.extract(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="text"):
        html_text.extract(df, keep=["text"])
