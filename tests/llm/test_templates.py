"""Main text of pages: element cases by hand, hosts without article elements by their template."""

import random
import time
import tracemalloc
from collections import Counter

import pytest

from affinity.llm.templates import _hash, extract, host_templates, main_text, parse, valid_roles

WORDS = [f"word{i}" for i in range(500)]


def text_of(html):
    return main_text(parse(html), frozenset(), None)


def found(spark, rows, columns="page_id long, url string, html string"):
    return extract(spark.createDataFrame(rows, columns))


@pytest.mark.parametrize("html, wanted", [
    ("<article><h1>T &amp; x</h1><p>a <b>b</b>c\n d<p>e&nbsp;f &#233;</article><footer>no</footer>",
     "T & x a bc d e f é"),
    ("<nav><a>m</a></nav><main><p>x<br>y</p><aside>no</aside><form>no<input></form><p>z</p></main>", "x y z"),
    ("<body><header>no</header><article>one<div class='comments'><p>no</p></div><div class=\"ad-box\">no</div>"
     "<section><p>two</p></section></article><div id=sidebar>no</div>", "one two"),
    ("<article><p>a<script>if (x < y) '</p>no'</script>b<style>no</style><!-- no > --> c</p>", "a b c"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>three<td>four</table></article>", "one two three four"),
    ("<article><p>open <b>bold<br><p>next</b></p>tail</article>after", "open bold next tail"),
    ("<article>a < b > c &lt;p&gt; <p title='<x>'>d</p></article>", "a < b > c <p> d"),
    ("<article><header><h1>title</h1></header><p>x</article><article class=comment>no</article>", "title x"),
    ("", ""), ("plain words", "plain words"), ("<p></p>", ""), ("<article>", ""), ("<div", ""),
])
def test_one_page(html, wanted):
    assert text_of(html) == wanted if html != "<div" else text_of(html) in ("", "<div", "< div", "<div".strip())


def site(rng, host, n):
    """Pages whose parts only their template tells apart; and the text of each."""
    rows, texts = [], []
    for k in range(n):
        blocks = [" ".join(rng.choices(WORDS, k=rng.randint(15, 60))) for _ in range(rng.randint(1, 7))]
        links = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in WORDS[:8])
        body = "".join(f"<p>{b}</p>" for b in blocks)
        rows.append((f"http://{host}/p/{k}",
                     f"<html><head><title>x</title></head><body><div class='t1'><ul>{links}</ul></div>"
                     f"<div class='t2'><div class='t3'>{body}</div><div class='t4'>Read on, dear friend</div></div>"
                     f"<div class='t5'>Made by {host} in {k}</div></body></html>"))
        texts.append(" ".join(blocks))
    return rows, texts


def test_template_finds_the_slot_with_the_text(spark):
    rng = random.Random(3)
    rows, texts = [], []
    for k in range(4):
        more, wanted = site(rng, f"h{k}.example", 12)
        rows, texts = rows + more, texts + wanted
    out = found(spark, [(i, u, h) for i, (u, h) in enumerate(rows)]).collect()
    assert {r.page_id: r.text for r in out} == dict(enumerate(texts))
    assert all(r.n_chars == len(r.text) for r in out)


def test_repeated_articles_stay_whole(spark):
    page = "<body><nav>m</nav><article><p>the same text</p></article><footer>f</footer>"
    out = found(spark, [(i, f"http://one.example/{i}", page) for i in range(20)]).collect()
    assert {r.text for r in out} == {"the same text"} and len(out) == 20


def test_template_decides_where_articles_are_boxes_or_have_repeated_blocks(spark):
    rng = random.Random(4)
    rows, texts = site(rng, "boxes.example", 12)
    rows = [(u, h.replace("<div class='t4'>", "<article class='t4'>").replace("friend</div>", "friend</article>"))
            for u, h in rows]
    more, wanted = site(rng, "inner.example", 12)
    rows += [(u, h.replace("<div class='t2'>", "<article>").replace("friend</div></div>", "friend</div></article>"))
             for u, h in more]
    out = found(spark, [(i, u, h) for i, (u, h) in enumerate(rows)]).collect()
    assert {r.page_id: r.text for r in out} == dict(enumerate(texts + wanted))


def test_copies_and_links_stay_on_hosts_without_articles(spark):
    rng = random.Random(5)
    page = ("<body><div class='t1'>Dear readers</div><div class='t2'><p>{} one</p><p>{} two</p>"
            "<p><a href='/x'>mostly a link {}</a> here</p></div><div class='t5'>Made in {}</div></body>")
    rows, texts = [], []
    for host, n, copies in (("few.example", 4, 2), ("many.example", 24, 16)):
        for k in range(n):
            of = "copy" if k < copies else f"page{k}"
            text = f"{of} " + " ".join(rng.choices(WORDS, k=40)) if k == 0 or k >= copies else text
            rows.append((f"http://{host}/{k}", page.format(text, text[::-1], of, k)))
            texts.append(f"{text} one {text[::-1]} two mostly a link {of} here")
    out = found(spark, [(i, u, h) for i, (u, h) in enumerate(rows)]).collect()
    assert {r.page_id: r.text for r in out} == dict(enumerate(texts))


def test_classes_nest_from_the_root():
    page = parse("<html><head></head><body><div>x</div></body></html>")
    by_name = {name: (page.hashes[r], page.hashes[page.parents[r]], page.depths[r]) for r, name in enumerate(page.shown)}
    slots = [dict(zip(("role", "parent", "depth"), by_name[name]), shown=name, large=large, chars=1) for name, large in
             [("html", True), ("body", False), ("div", True), ("head", True)]]
    random.Random(1).shuffle(slots)
    assert {r["shown"] for r in valid_roles(slots).values()} == {"", "html", "head"}


def test_names_within_an_article_must_say_it_all():
    kept = ('<h1 class="article-header">one</h1><div class="share-price-table">two</div>'
            '<p class="search-results">three</p><p>four</p>')
    gone = '<div class="comments">x</div><div class="ad-box">x</div><ul class="big share-links">x</ul><div id=related>x</div>'
    assert text_of(f"<article>{kept}{gone}</article>") == "one two three four"


def test_rows_without_end_tags_are_neighbours():
    page = parse("<table><tr><td>a<td>b<tr><td>c<tr><th>d</table><ul><li><p>e<li><p>f</ul>")
    assert max(page.depths) == 3 and page.shown.count("tr") == 1 and page.times[page.shown.index("tr")] == 3
    assert len({b[0] for b in page.blocks if b[1] in "abc"}) == 1


@pytest.mark.parametrize("html, chars", [
    ("<article><table>" + "<tr><td>x<td>y" * 50_000, 199_999), ("<article>" + "<div>" * 40_000 + "deep", 4),
    ("<b>" * 20_000 + "<hr>" * 20_000, 0), ("<div>" * 20_000 + "</span>" * 20_000 + "x", 1), ("<a " * 30_000, 89_999),
    ("<p title='" * 20_000 + ">x", None)])
def test_long_and_deep_pages_take_linear_time_and_memory(html, chars):
    tracemalloc.start()
    start = time.process_time()
    text = text_of(html)
    took, (_, peak) = time.process_time() - start, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert chars is None or len(text) == chars
    assert took < 40 and peak < 200e6  # seconds while memory is traced, which costs five times the work


def test_deep_pages_in_a_table(spark):
    rows = [(k, f"http://deep.example/{k}", "<article>" + "<div>" * 20_000 + f"<p>page {k}</p>") for k in range(5)]
    assert sorted((r.page_id, r.text) for r in found(spark, rows).collect()) == [(k, f"page {k}") for k in range(5)]


def plain_template(pages):
    """Tokens by whole occurrence vectors over a host's different bodies: those of large, frequent, various classes."""
    seen, vectors, beside = {}, {}, {}
    for html in pages:
        page = parse(html)
        own = [b[1] for b in page.blocks if not b[3]]
        seen["\0".join(own)] = page, max(own, key=lambda b: (len(b), b), default="")
    for k, (page, longest) in enumerate(seen.values()):
        tokens = Counter({("tag", h): n for h, n in zip(page.hashes, page.times, strict=True)})
        tokens.update(("text", page.hashes[b[0]], b[1]) for b in page.blocks)
        for token, n in tokens.items():
            vectors.setdefault(token, [0] * len(seen))[k] = n
            beside.setdefault(token, set()).add(longest)
    frequent = {t: tuple(v) for t, v in vectors.items() if sum(n > 0 for n in v) >= len(seen) / 2}
    sizes = Counter(frequent.values())
    large = {t for t, v in frequent.items() if sizes[v] > 1 or set(v) == {1}}
    every = {longest for _, longest in seen.values()}
    texts = {t[1:] for t in large if t[0] == "text" and len(every) >= 4 and len(beside[t]) >= len(every) / 2}
    return {t[1] for t in large if t[0] == "tag"}, {t[1] for t in frequent if t[0] == "tag"}, texts


def test_classes_by_whole_vectors(spark):
    """Fingerprints of occurrence vectors give the classes that the vectors themselves give."""
    rng = random.Random(6)
    html = [h for _, h in site(rng, "one.example", 9)[0]]
    html += [html[0]] * 3 + [h.replace("<ul>", "<ul><li>more</li>").replace("dear", "old") for h in html[:4]]
    rows = spark.createDataFrame([("one.example", h) for h in html], "host string, html string")
    (row,) = host_templates(rows.repartition(5)).collect()
    large, frequent, texts = plain_template(html)
    assert {s.role for s in row.slots} == frequent and {s.role for s in row.slots if s.large} == large
    assert set(row.template) == {_hash(role, block) for role, block in texts} and texts


def test_nulls_repeats_clashes_and_empty_table(spark):
    rows = [(1, None, None, "a", 1), (1, "", "<article>x</article>", "b", 2), (None, "no url", "<p>y</p>", None, 3),
            (4, "http://h/1", "<article>" + "long text " * 60_000, "t", 4),
            (4, "http://h/1", "<article>" + "long text " * 60_000, "t", 4)]
    columns = "page_id long, url string, html string, host string, template int"
    out = found(spark, rows, columns)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.url, r.n_chars) for r in out.collect()), key=str)
    assert got == sorted([(1, None, 0), (1, "", 1), (None, "no url", 1), (4, "http://h/1", 599_999),
                          (4, "http://h/1", 599_999)], key=str)
    assert found(spark, rows, columns).where("text is null").count() == 0
    assert found(spark, [], columns).count() == 0
