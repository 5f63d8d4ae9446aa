from newsgraph.llm import wrappers

HEAD = "<!DOCTYPE html><html><head><title>T</title><script>var t='</p><p>no';</script></head><body>"


def page(title, paragraphs, menu=3, notice=False, comments=0):
    return (HEAD + "<div class='top'><ul>" + "".join(f"<li><a href=/{i}>m{i}</a></li>" for i in range(menu)) + "</ul></div>"
            + ("<div class='cookie-notice'>We use cookies</div>" if notice else "")
            + f"<div id=x><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"
            + "".join(f"<div class=comments><p>reader {i}</p></div>" for i in range(comments))
            + "<div>Imprint &copy; us</div></body></html>")


def test_wrapper_finds_the_variable_region_without_semantic_tags():
    pages = [page("A one", ["Alpha beta gamma.", "Delta epsilon."]), page("B two", ["Zeta eta theta iota."], notice=True),
             page("C three", ["Kappa.", "Lambda mu.", "Nu xi omicron pi."], comments=2, menu=5)]
    assert wrappers.extract_block(pages) == [
        "A one\nAlpha beta gamma.\nDelta epsilon.", "B two\nZeta eta theta iota.",
        "C three\nKappa.\nLambda mu.\nNu xi omicron pi."]


def test_wrapper_becomes_a_union_free_expression():
    streams = [wrappers.tokens(page("A", ["x", "y", "z"])), wrappers.tokens(page("B", ["q"], notice=True))]
    w = wrappers.Wrapper(streams[0])
    w.align(streams[1])
    texts = {n.text for n in w.nodes if not n.key}
    assert None in texts and "Imprint &copy; us" in texts  # slots and constants
    assert any(n.back >= 0 for n in w.nodes)  # a repeated group
    for s in streams:  # accepts both
        assert all(i >= 0 for i in w.align(s, learn=False))


def test_article_marked_as_such_with_loose_markup():
    html = (HEAD + "<nav><ul><li>Menu</ul></nav><!-- ad 1 --><div class='ad box'>Buy</div><article><h1>T &amp; U</h1>"
            "<p><b>Bold  start<br><p>a&nbsp;b &lt;c&gt; &#233;&amp\n d</p><aside>side</aside><form>f</form>"
            "<div class=\"reader-comments\"><p>hey</p></div><p>End</p></article><footer>&copy; x</footer>")
    assert wrappers.extract_block([html]) == ["T & U\nBold start\na b <c> é& d\nEnd"]


def test_copies_keep_their_text():
    html = page("Same", ["All pages are equal."])
    assert wrappers.extract_block(["<article><p>" + "word " * 9 + "</p></article>"] * 5) == [("word " * 9).strip()] * 5
    assert len(set(wrappers.extract_block([html] * 3))) == 1


def test_broken_pages_do_not_crash():
    for html in ("", " ", "<", "<p", "<p class='", "&#xZZ;", "<!--", "<script>", "<article>", "</p></p>", "<p>" * 3000,
                 "a < b > c", "<" * 500, "<![CDATA[x", "\0<p>\0"):
        assert len(wrappers.extract_block([html, html, "<p>x</p>"])) == 3


def test_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = wrappers.op2(pages).collect()
    want = {r["page_id"]: r["html"] for r in pages.collect()}
    assert {r["page_id"] for r in rows} == set(want) and len(rows) == len(want)
    for r in rows:
        title = want[r["page_id"]].split("<h1>")[1].split("</h1>")[0]
        assert r["text"].split("\n")[0] == " ".join(wrappers.references.unescape(title).split())
        assert r["n_chars"] == len(r["text"]) and "track(" not in r["text"]


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, "http://a/x", None, "x"), (2, None, "<p>Hi</p>", "y"), (2, None, "<p>Hi</p>", "y"), (None, "bad", "", None),
         (3, "http://a/y", "<p>" + "long text " * 50_000 + "</p>", "z")],
        "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["n_chars"]) for r in wrappers.op2(df).collect()), key=str)
    assert got == sorted([(1, 0), (2, 2), (2, 2), (None, 0), (3, 499_999)], key=str)
    assert wrappers.op2(df.limit(0)).collect() == []


def test_pages_after_a_long_first_page_are_learned():
    texts = [[f"Line number {k} {i}." for i in range(n)] for k, n in enumerate((1500, 3, 4, 5, 6))]
    pages = [page(f"T{k}", ["Said on every page.", *x], notice=k % 2 == 1) for k, x in enumerate(texts)]
    assert wrappers.extract_block(pages) == ["\n".join([f"T{k}", *x]) for k, x in enumerate(texts)]
    # varied pages: a new element on every page is learned, also beyond 4,000 nodes
    streams = [wrappers.tokens("<div>" + "".join(f"<p class='c{k} d{i}'>x{k}</p>" for i in range(90)) + "</div>")
               for k in range(64)]
    w = wrappers.Wrapper(streams[0])
    for s in streams[1:]:
        w.align(s)
    assert len(w.nodes) > 4000
    assert all(i >= 0 for s in streams for i in w.align(s, learn=False))


def test_marks_of_one_page_and_other_layouts_lose_no_text():
    assert wrappers.extract_block(["<article id=a><h1>A</h1><p>One two three four.</article>",
                                   "<article id=b><h1>B</h1><p>Five.<ul><li>Six</ul></article>"]) == [
        "A\nOne two three four.", "B\nFive.\nSix"]
    # the first page owned the region: a later list was inserted with the later page's path
    blog = [f"<body class='post-template postid-{k}'><div>Menu</div><div id=post-{k}><h1>T{k}</h1><p>Own text {k}."
            + f"<blockquote>Said {k}</blockquote>" * (k == 2) + f"<h2>Sub {k}</h2><ul><li>item {k}</ul>" * (k > 2)
            + "</div><div>Imprint</div></body>" for k in range(6)]
    assert wrappers.extract_block(blog) == [
        f"T{k}\nOwn text {k}." + f"\nSaid {k}" * (k == 2) + f"\nSub {k}\nitem {k}" * (k > 2) for k in range(6)]
    # two layouts on one host, one of them marked; two regions on one page
    mixed = [f"<main><p>Marked {k}.</main><div><article><p>Second {k}.</article></div>" for k in range(3)] + [
        f"<div class=x><p>{'Plain words ' * 9}{k}.</div><div>Imprint</div>" for k in range(3)] + [
        f"<section id=s><p>Third layout {k}.</section>" for k in range(2)]
    assert wrappers.extract_block(mixed) == [f"Marked {k}.\nSecond {k}." for k in range(3)] + [
        f"{'Plain words ' * 9}{k}." for k in range(3)] + [f"Third layout {k}." for k in range(2)]
    # a page of the marked layout without the mark: its article is where the others have theirs
    lost = [f"<div><article><h1>T{k}</h1><p>Own text of page {k}.</article><p>Read {k} more</div>" for k in range(4)]
    lost.append("<div><h1>T4</h1><p>Own text of page 4.<hr class=end></div>")
    assert wrappers.extract_block(lost) == [f"T{k}\nOwn text of page {k}." for k in range(5)]


def test_copies_among_other_pages_lose_no_text():
    one = "<div><h1>Twice</h1><p>A first part.</p><blockquote>Quoted.</blockquote><p>The last part.</p></div>"
    other = "<div><h1>Once</h1><p>Another text.</p><p>With an end.</p></div>"
    assert wrappers.extract_block([one, one, other]) == [
        "Twice\nA first part.\nQuoted.\nThe last part."] * 2 + ["Once\nAnother text.\nWith an end."]
    # most rows, not most pages
    pages = [page(f"T{k}", [f"Own {k}.", f"And {k}."]) for k in range(4)]
    links = page("T0", ["Own 0.", "And 0."]).replace("href=/", "href=/copy/")
    assert wrappers.extract_block([pages[0], links] * 8 + pages) == ["T0\nOwn 0.\nAnd 0."] * 16 + [
        f"T{k}\nOwn {k}.\nAnd {k}." for k in range(4)]


def test_words_on_the_article_and_around_it_do_not_empty_a_page():
    for open_, close in (("<article class='node node--promoted'>", "</article>"), ("<article class='post tag-social'>", "</article>"),
                         ("<div id=page class='has-sidebar'><article>", "</article></div>"), ("<main class='with-ads'>", "</main>"),
                         ("<article class='post sponsored'>", "</article>"), ("<div class='has-sidebar'><div>", "</div></div>"),
                         ("<div class=social><main>", "</main></div>")):
        pages = [f"{open_}<h1>T{k}</h1><p>Own text {k}.</p><div class=sidebar><p>Beside {k}</div>{close}<nav>Menu</nav>"
                 f"<div class=comments><article><p>A reader's {k} words</article></div>" for k in range(3)]
        want = [f"T{k}\nOwn text {k}." for k in range(3)]
        assert wrappers.extract_block(pages) == want, open_
        assert [wrappers.extract_block([p])[0] for p in pages] == want, open_


def table_page(k, rows, shared=False):
    cells = "".join(f"<tr><td>name {i}</td><td>{'yes' if shared else f'value {k} {i}'}</td></tr>" for i in range(rows))
    return (HEAD + f"<div id=c><h1>Table {k}</h1><table>{cells}</table><p>Closing words of page {k}.</p></div>"
            "<div>Imprint of us</div></body></html>")


def test_a_large_table_does_not_cost_its_heading_and_closing_words():
    for shared in (False, True):
        sizes = (5, 400, 8)
        want = ["\n".join([f"Table {k}", *(x for i in range(n) for x in (f"name {i}", "yes" if shared else f"value {k} {i}")),
                           f"Closing words of page {k}."]) for k, n in enumerate(sizes)]
        assert wrappers.extract_block([table_page(k, n, shared) for k, n in enumerate(sizes)]) == want


def test_menus_of_any_length_stay_out():
    def made(k, links, items):
        return (HEAD + "<div><ul>" + "".join(f"<li><a href=/{i}>Menu entry {i}</a></li>" for i in range(links)) + "</ul></div>"
                + f"<div><h1>T{k}</h1><p>Own text of {k}.</p><ul>" + "".join(f"<li>item {i}</li>" for i in range(items))
                + f"</ul><p>End of {k}.</p></div><div>Imprint of us</div></body></html>")

    sizes = [(10, 2), (3, 4), (50, 3)]
    for order in (sizes, sizes[::-1], sizes + [(7, 60)]):
        assert wrappers.extract_block([made(k, *n) for k, n in enumerate(order)]) == [
            "\n".join([f"T{k}", f"Own text of {k}.", *(f"item {i}" for i in range(n[1])), f"End of {k}."])
            for k, n in enumerate(order)]
