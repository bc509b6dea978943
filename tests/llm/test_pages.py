import html
import os
import random
import re

from quillstone.llm import pages, queries

ARTICLE = re.compile(r"<article>(.*?)(?:</article>|\Z)", re.S)


def extract(source, other=""):
    lines = [(x.text, x.article, x.never) for x in pages.page_lines(source)]
    theirs = [x.text for x in pages.page_lines(other)]
    return pages.main_text(lines, pages.common_lines([x[0] for x in lines], theirs))


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(9)
    for _ in range(800):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        shared = [x for x, s in zip(a, pages.common_lines(a, b), strict=True) if s]
        assert len(shared) == brute_lcs(a, b)
        rest = iter(b)
        assert all(x in rest for x in shared)  # a subsequence of b


def test_article_without_its_surroundings():
    source = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="ad-free">
    <header>Site</header><nav><ul><li>menu</li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>gone</p> -->
    <article><h1>Head&amp;line</h1><p>One   <b>bold</b>\n two&nbsp;three <a title="x > y" href=#>link</a>.<p>Second &lt;p&gt; &#8212; &eacute;
    <div class="ad">buy</div><form><p>mail</p><input></form><aside><p>side</p></aside><ul><li>item</li></ul><br>tail
    <section id="comments"><p>reader</p></section></article><footer>&copy; us</footer></body></html>"""
    assert extract(source) == "Head&line\nOne bold two three link.\nSecond <p> — é\nitem\ntail"


def test_difference_without_an_article():
    one = "<div>Top menu</div><p>Story one.</p><p>More.</p><div>All rights</div>"
    two = "<div>Top menu</div><p>Another story.</p><div>All rights</div>"
    assert extract(one, two) == "Story one.\nMore."
    assert extract(one, one) == "Top menu\nStory one.\nMore.\nAll rights"  # a copy: sharing says nothing
    assert extract(one) == "Top menu\nStory one.\nMore.\nAll rights"


def test_difference_beside_an_article():
    one = "<div>Top menu</div><p>Story one.</p><article><p>Licence</p><p>Teaser</p></article><div>All rights</div>"
    two = "<div>Top menu</div><p>Another story.</p><article><p>Licence</p></article><div>All rights</div>"
    assert extract(one, two) == "Story one.\nLicence\nTeaser"
    assert extract(two, one) == "Another story.\nLicence"


def test_names_are_whole_and_do_not_silence_an_article():
    for name in ("layout has-sidebar", "no-sidebar", "with-nav", "ad-free", "shareholder-notice-text", "sidebar", "header"):
        assert extract(f'<div class="{name}"><article><p>Story.</p></article></div>') == "Story."
        assert extract(f'<div id="{name}"><main><p>Story.</p></main></div>') == "Story."
    assert extract('<article><div class="article-header"><h1>Title</h1></div><div class="header"><h2>Sub</h2></div><p>Story.</p></article>') == "Title\nSub\nStory."
    assert extract('<div class="header">Site</div><div class="post share">Share</div><div class="ad"><p>buy</p></div><p>Story.</p>') == "Story."
    assert extract('<article><p>Story.</p><div id="comments"><article class="comment">reader</article><article>reader</article></div></article>') == "Story."
    assert extract('<article>Story.</article><div class="comments"><article class="comment">reader</article></div>') == "Story."


def test_odd_pages():
    assert extract(None) == extract("") == extract("<script>x") == extract("<!-- open") == ""
    assert extract("a < b") == "a < b"
    assert extract("plain &am &amp text") == "plain &am & text"
    assert extract("<article><p>cut off in a <b>tag<p class='x") == "cut off in a tag"
    assert extract("<p>" + "x " * 100_000 + "</p>").count("x") == 100_000
    assert extract("<nav><p>a</nav><article>b</article><article>c</article>") == "b\nc"


def test_operator_pairs_and_rows(spark):
    rows = [(k, f"http://H.example/{k // 10}/{k}", f"<div>Menu</div><p>Body {k}</p><div>Foot</div>") for k in range(40)]
    rows += [(100, "http://alone.example/", "<p>Only</p>"), (101, None, "<p>No url</p>"), (102, "http://h.example/x", None), (None, "http://h.example/y", "<div>Menu</div><p>Null id</p>"), (7, "http://H.example/0/7", "<div>Menu</div><p>Body 7</p><div>Foot</div>")]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "page_id long, url string, html string, text string, path int")
    out = {}
    for r in pages.extract_text(df).collect():
        out.setdefault(r.page_id, []).append(r.text)
    assert len(out) == 44 and len(out[7]) == 2
    assert out[100] == ["Only"] and out[101] == ["No url"] and out[102] == [""]
    assert all(set(out[k]) == {f"Body {k}"} for k in range(40))
    assert pages.extract_text(df.limit(0)).count() == 0


def brute_texts(rows):
    """The neighbour rule and the alignment said plainly: rows of (id, url, html) in the order of host, path, url, id."""
    def key(r):
        m = re.fullmatch(r"(?:[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*))?([^?#]*).*", r[1] or "", re.S)
        return ((m[1] or "").lower(), m[2], r[1] or "", r[0])

    def begin(a, b):
        return len(os.path.commonprefix([a, b]))

    rows = sorted(rows, key=key)
    out = {}
    for k, r in enumerate(rows):
        host, path = key(r)[:2]
        near = [x for x in (rows[k - 1] if k else None, rows[k + 1] if k + 1 < len(rows) else None) if x and key(x)[0] == host]
        near.sort(key=lambda x: -begin(key(x)[1], path))
        lines = [x.text for x in pages.page_lines(r[2])]
        other = next((x[2] for x in near if brute_lcs(lines, [y.text for y in pages.page_lines(x[2])]) < len(lines)), r[2])
        out[r[0]] = extract(r[2], other if near else "")
    return out


def test_text_is_the_same_in_any_partitions(spark):
    rng = random.Random(6)
    rows = []
    for k in range(90):
        host = rng.choice(["a.example", "B.example", "c.example"])
        blocks = [f"<p>{rng.choice(['Menu', 'Foot', 'Log in', f'Body {k}', f'More {k}'])}</p>" for _ in range(rng.randint(0, 7))]
        art = f"<article><p>Licence</p><p>Art {k}</p></article>" if k % 3 == 0 else ""
        rows.append((k, f"https://{host}/{rng.choice('xy')}/{rng.choice(['1', '12', '123'])}?q={k}", "<div>Site</div>" + "".join(blocks) + art))
    want = brute_texts(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 16, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert {r.page_id: r.text for r in pages.extract_text(df.repartition(5)).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_quotes_only_open_values():
    assert extract('<article><p title=5">one</p><p>two</p></article>') == "one\ntwo"
    assert extract("<article><p it's>one</p><p a='x>y' b = \"z>\">two</p><math><mi>x</mi></math></article>") == "one\ntwo\nx"
    assert extract("<p a=>one</p><p data-class='ad'>two</p><p class=ad>an advert</p>") == "one\ntwo"
    assert extract("<p " + "a=" * 50_000 + ">one") == "one"


def article_blocks(source):
    """Blocks of the generated pages' article, read with plain patterns."""
    body = re.sub(r'<div class="ad">.*?</div>', "\x00", ARTICLE.search(source)[1], flags=re.S)
    blocks = re.split(r"\x00|</?(?:p|h[1-6]|ul|ol|li|div|blockquote|table|tr|td|pre|section)\b[^>]*>", body)
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br[^>]*>", " ", b)) if "<" not in re.sub(r"<br[^>]*>", "", b) else html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", b)))).strip() for b in blocks]
    return [b for b in blocks if b]


def test_query_gives_the_article(spark, sf):
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op6_page_text(spark, sf).collect()
    assert len(got) == len(source)
    for r in got:
        assert r.text.split("\n") == (article_blocks(source[r.page_id]) or [""])
        assert r.n_chars == len(r.text)
