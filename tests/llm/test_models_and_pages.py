"""Toxicity, embeddings and pages: held-out accuracy, brute force and edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from medcohort.llm import components, embedding_dedup, html_extraction, toxicity


def labelled(spark, n=300):
    rng = random.Random(3)
    rows, marks = [(900, None, "t"), (901, "", "t"), (901, "", "t"), (None, "x", "t")], [(901, None, 0), (900, 1, 1), (None, 1, 1)]
    for k in range(n):
        words = ["".join(rng.choices("abcdefg", k=5)) for _ in range(rng.choice([5, 50, 800]))]
        toxic = k % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = "vexo" + "".join(rng.choices("mnop", k=3))
        rows.append((k, " ".join(words), "t"))
        marks.append((k, int(toxic), k % 2))
    return (spark.createDataFrame(rows, "doc_id long, text string, Score string"),
            spark.createDataFrame(marks, "doc_id long, toxic int, quality int"))


def test_toxicity(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 304 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert len(unseen) > 40 and sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in unseen) >= 0.95 * len(unseen)
    kept = toxicity.drop_toxic(docs, docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got)


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, 10)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        assert {r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, some)).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


@pytest.mark.parametrize("block", [512, 4])
def test_vectors(spark, monkeypatch, block):
    from medcohort.llm import blocks
    monkeypatch.setattr(blocks, "BLOCK", block)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 20))
    rows = []
    for k in range(120):
        v = base[rng.integers(12)] + rng.normal(size=20) * rng.choice([0, 0.05, 0.12])
        rows.append((k, [float(np.float32(x)) for x in v], int(rng.integers(2)), "x"))
    odd = [None, [], [0.0] * 20, [float("nan")] * 20, [None] * 20, [float("inf")] * 20, [1.0]]
    rows += [(200 + k, v, 1, "x") for k, v in enumerate(odd)] + [(300, rows[0][1], None, "x"), (301, [x * 2 for x in rows[0][1]], rows[0][2], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, Node string")
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(table).collect()}
    good = [(i, np.array(v, np.float64), l) for i, v, l, _ in rows if l is not None and (i < 200 or i == 301)]
    links = {i: [j for j, w, m in good if j != i and m == l and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93] for i, v, l in good}
    for i, *_ in rows:
        reach, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links.get(i, [])), min(reach), i == min(reach))
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_repeated_and_null_vector_ids(spark):
    v, w = [1.0, 2.0, 3.0, 4.0], [-4.0, 3.0, -2.0, 1.0]
    rows = [(1, v, 0), (1, v, 0), (2, v, 0), (3, w, 0), (3, v, 1)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(got) == 5 and sorted(r["vec_id"] for r in got) == [1, 1, 2, 3, 3]
    assert {r["component_id"] for r in got if r["vec_id"] in (1, 2)} == {1}
    assert [r["n_links"] for r in got if r["vec_id"] == 2] == [2] and [r["kept"] for r in got if r["vec_id"] == 2] == [False]


def test_toxicity_of_a_very_long_text(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    long = spark.createDataFrame([(1, "abcde " * 500_000), (2, "vexomnop " * 300_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(long, model).collect()}
    assert 0 <= got[1]["score"] <= got[2]["score"] <= 1 and got[2]["predicted"] == 1


def test_several_polytopes_keep_near_vectors_together():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 64))
    y = x + rng.normal(size=x.shape) * 0.38
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    near = (x * y).sum(1) >= 0.93
    a, b = embedding_dedup.buckets(x, 2), embedding_dedup.buckets(y, 2)
    met = np.array([bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist())])
    assert near.sum() > 50 and met[near].mean() >= 0.97


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 50 + k) for k in range(30)] + [(7, 7), (60, 61)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(50, 80)} == {50} and got[100] == 50
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_many_small_tasks(spark, monkeypatch):
    rng = random.Random(3)
    name = {k: rng.randbytes(4) for k in range(400)}
    links = [(k, k + 1) for k in range(99)] + [(100, k) for k in range(101, 200)] + [(299, k) for k in range(200, 299)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    plans, store = [], components.materialise
    monkeypatch.setattr(components, "materialise", lambda df, tag: plans.append(
        df._jdf.queryExecution().executedPlan().toString().count("Exchange")) or store(df, tag))
    edges = spark.createDataFrame([(name[a], name[b]) for a, b in links], "a binary, b binary").repartition(16)
    got = {bytes(r["node"]): bytes(r["component"]) for r in components.components(edges).collect()}
    least = {name[k]: name[k] for pair in links if pair[0] != pair[1] for k in pair}
    for _ in range(400):
        for a, b in links:
            if a != b:
                least[name[a]] = least[name[b]] = min(least[name[a]], least[name[b]])
    assert got == least
    assert sum(plans) <= 40  # the plans of stars of salted neighbours named 219


@pytest.mark.parametrize("held", [1 << 20, 3])
def test_a_task_keeps_one_edge_of_a_node(monkeypatch, held):
    monkeypatch.setattr(components, "HELD_EDGES", held)
    batches = [pa.RecordBatch.from_pydict({"a": [9] * 50, "b": list(range(k, k + 5)) * 10}) for k in range(4)]
    got = [row for b in components._star_rows(iter(batches)) for row in zip(*b.to_pydict().values())]
    assert sorted(got) == [(k, 0) for k in (1, 2, 3, 4, 5, 6, 7, 9)]


def subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(0)
    for _ in range(500):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        got = html_extraction.shared_lines(a, b)
        assert len(got) == subsequence(a, b) == subsequence([a[k] for k in got], b) and got == sorted(set(got))


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<p>open", "open"), ("a<!-- b", "a"), ("a<script>if(1<2){'</p>'}</script>b", "ab"),
    ("<article><h1>A &amp B</h1><p>x <b>y</b>z<br>w</article><footer>f", "A & B\nx yz\nw"),
    ("<article><p>a</p><div class='ad x'><div>no</div>no</div><p>b</p><section id=comments><p>no</section></article>", "a\nb"),
    ("<nav>n</nav><main>m<aside>s</aside></main>", "m"), ("<div hidden>h</div><p>p", "p"),
    ("<table><tr><td>1<td>2</tr></table>", "1 2"), ("x &lt;b&gt; &#233; &am", "x <b> é &am"), ("<header>h</header>t", "t"),
    ("<article><header><h1>T</h1></header>t</article>", "T\nt"), ("<p title='>'>q</p>", "q"), ("1 < 2", "1 < 2")])
def test_page(spark, html, text):
    main, loose = html_extraction.lines_of(html)
    assert "\n".join(main or loose) == text


def test_differencing(spark):
    page = "<html><head><title>x</title></head><body><div><p>Top of site</p></div>{}<p>All rights</p></body></html>"
    rows = [(1, "http://a.org/x/1", page.format("<p>one &amp; two</p><p>alpha</p>")), (2, "http://a.org/x/2", page.format("<p>three</p>")),
            (3, "http://b.org/x", page.format("<p>solo</p>")), (4, None, None), (4, None, None),
            (5, "http://c.org/", "<article><p>same</p></article>"), (6, "http://c.org/1", "<article><p>same</p></article>")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, Text string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extraction.extract(pages).collect())
    want = [(1, "one & two\nalpha"), (2, "three"), (3, "Top of site\nsolo\nAll rights"), (4, ""), (4, ""), (5, "same"), (6, "same")]
    assert got == [(i, t, len(t)) for i, t in want]
    assert html_extraction.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(("html", "main"), [
    ('<article><p class="ad">Buy<p>Real</p><p>More</p></article>', ["Real", "More"]),
    ("<article><p class=ad>a<p class=ad>b <b>c</b><h2>T</h2>w</article>", ["T", "w"]),
    ("<article><div><p class=ad>x <b>y</div>w</article>", ["w"]), ("<article><p class=ad>x</b></span>y<br>z</article>", []),
    ("<article><ul><li class=share>x<ul><li>in<li>in</ul>y<li>Real<li class=ad>q</ul><p>More</article>", ["Real", "More"]),
    ("<article><dl><dt class=ad>x<dd>y<dd class=ad>z</dl>w</article>", ["y", "w"]),
    ("<article><table><tr><td class=ad>a<table><tr><td>in</table>b<td>c<tr class=ad><td>d<td>e<tr><td>f</table>z</article>",
     ["c", "f", "z"]),
    ("<main><datalist><option class=ad>x<option>y</datalist>z</main>", ["yz"])])
def test_left_out_elements_without_end_tags(html, main):
    assert html_extraction.lines_of(html) == (main, [])


@pytest.mark.parametrize(("html", "text"), [
    ('<article><div class="widget-area main-content"><p>Real</p></div></article>', "Real"),
    ('<article><p class="related-work">Real</p><p id="notice-of-meeting">Also</p></article>', "Real\nAlso"),
    ('<article>short</article><div><p>The body of the page is here</p><p>x</p></div>', "short\nThe body of the page is here"),
    ('<div><p>The body comes before</p></div><main>m</main>', "The body comes before\nm"),
    ('<main>m<div class="ad-slot">no</div><div class="site-nav">no</div><ul class="share-buttons">no</ul></main>', "m"),
    ('<main>m<div class="post entry-content notice">yes</div><div class="sidebar content">no</div></main>', "m\nyes"),
    ("<p title=don't>a</p><p title=\"x>b</p>", "a\nb"), ("<p title = '>'>q</p>", "q"), ("<p>a<!-->b<!--->c<!-- x --!>d", "abcd"),
    ("a<script>x</scripty></script >b", "ab"), ("a<b title='", "a"), ("", "")])
def test_page_parts(html, text):
    assert "\n".join(x for x, _ in html_extraction.chosen(html_extraction.blocks_of(html))[0]) == text


@pytest.mark.parametrize("piece", ['<a href="x ', "<a href='x\" ", "<p x=  ", "<!--", "</script", "<script>", "<div class=ad>", "&#", "<a b=\"'"])
def test_malformed_page_takes_linear_time(piece):
    import time
    begin = time.perf_counter()
    html_extraction.blocks_of(piece * (1_000_000 // len(piece)) + '"')
    assert time.perf_counter() - begin < 5


def test_shared_lines_in_parts():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(40))] for _ in range(2))
        got = html_extraction.shared_lines(a, b, limit=8)
        assert len(got) == subsequence(a, b) == subsequence([a[k] for k in got], b) and got == sorted(set(got))


def extracted(rows):
    """The result of ``extract`` by loops over whole hosts."""
    hosts = {}
    for _, url, page in rows:
        host, path = (url or "").partition("://")[2].partition("/")[::2] if "://" in (url or "") else ("", "")
        hosts.setdefault(host, set()).add(("/" + path.partition("?")[0], url, page))
    texts = {}
    for host, found in hosts.items():
        found = sorted(found, key=lambda r: r[0])
        loose = [[x for x, marked in html_extraction.blocks_of(r[2]) if not marked] for r in found]

        def weight(lines):
            return sum(len(x.encode()) for x in lines)

        def gone(i, j):
            if loose[i] == loose[j]:
                return None
            at = html_extraction.shared_lines(loose[i], loose[j])
            if weight([loose[i][k] for k in at]) * 3 >= 2 * max(weight(loose[i]), weight(loose[j])):
                return None
            return at

        first = [0] * len(found)
        for i in range(1, len(found)):
            first[i] = first[i - 1] if gone(i, i - 1) is None else i
        for i, (path, url, page) in enumerate(found):
            last = max(k for k in range(len(found)) if first[k] == first[i])
            best = None
            for j, side in ((first[i] - 1, 1), (last + 1, 0)):
                if 0 <= j < len(found) and gone(i, j) is not None:
                    common = next((k for k, (x, y) in enumerate(zip(path, found[j][0])) if x != y), min(len(path), len(found[j][0])))
                    best = max(best or (-1,), (common, side, gone(i, j)))
            out = set(best[2]) if best else set()
            keep = html_extraction.chosen(html_extraction.blocks_of(page))[0]
            texts[url, page] = "\n".join(x for x, k in keep if k not in out)
    return sorted((i, texts[url, page]) for i, url, page in rows)


@pytest.mark.parametrize(("partitions", "block"), [("1", 1000), ("7", 3)])
def test_extract_against_loops(spark, monkeypatch, partitions, block):
    monkeypatch.setattr(html_extraction, "RUN_BLOCK", block)
    rng = random.Random(11)
    lines = [f"line {k} " + "w" * rng.randrange(30) for k in range(40)]
    rows = []
    for k in range(150):
        body = rng.sample(lines, rng.randrange(1, 12)) if k % 4 else lines[:10] + rng.sample(lines, 1)
        page = "<p>Top</p>" + "".join(f"<p>{x}</p>" for x in body) + "<p>All rights</p>"
        if k % 10 == 3:
            page = f"<main><p>{'m' * rng.choice([3, 60])}</p></main>" + page
        rows.append((k, f"http://h{rng.choice('aaab')}.org/{rng.choice('xyz')}/{k}", page))
    rows += rows[5:9]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        got = sorted((r["page_id"], r["text"]) for r in html_extraction.extract(pages).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == extracted(rows)


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_differencing_skips_copies(spark, partitions):
    page = "<body><div><p>Top of site</p></div>{}<p>All rights</p></body>"
    body = [f"{word} is a line of the copied text of some length" for word in "abcdefgh"]
    rows, want = [], []

    def add(url, lines, left):
        rows.append((len(rows), url, page.format("".join(f"<p>{x}</p>" for x in lines))))
        want.append((len(want), "\n".join(left)))

    add("http://a.org/a", ["something else"], ["something else"])
    for k in range(30):  # equal and near copies, in one stretch of paths
        lines = body if k % 3 else [*body[:-1], f"line {k}"]
        add(f"http://a.org/m?q={k}" if k % 2 else f"http://a.org/m/{k}", lines, lines)
    add("http://a.org/z", ["another"], ["another"])
    for k in range(3):
        add(f"http://b.org/{k}", body, ["Top of site", *body, "All rights"])
    rows += rows[1:4] + rows[-1:]
    want += want[1:4] + want[-1:]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        got = [(r["page_id"], r["text"]) for r in html_extraction.extract(pages).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == sorted(want)


def test_differencing_of_marked_articles(spark):
    page = "<article><h1>Title {0}</h1><p>{0} is the text of this page, long enough to be no copy</p>{1}<p>Get our daily letter</p></article>"
    quote = "<p>A passage that two articles quote</p>"
    rows = [(k, f"http://a.org/{k}", page.format(f"word{k}", quote if k in (2, 3) else "")) for k in range(6)]
    rows += [(6, "http://a.org/6", "<article><p>Get our daily letter</p></article>"), (7, "http://a.org/7", None)]
    rows += [(10 + k, f"http://b.org/{k}", page.format(f"word{k}", "")) for k in range(3)]  # too few pages to tell
    rows += rows[:2]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = []
    for k, _, html in rows:
        lines = [x for x, _ in html_extraction.blocks_of(html)]
        want.append((k, "\n".join(lines[:-1] if k < 6 else lines)))
    assert sorted((r["page_id"], r["text"]) for r in html_extraction.extract(pages).collect()) == sorted(want)


def test_toxicity_counts_all_labelled_rows(spark):
    words = ["qzjx", "vkwy"]
    rows = [(k, f"plain words number {k} " + (words[k % 2] if k % 4 < 2 else "")) for k in range(0, 400)]
    docs = spark.createDataFrame(rows + rows[:1] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 < 2)) for k, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_rows_per_class=1)  # the two words cannot both be in one toxic text
    for word in words:
        assert (model.weights[toxicity.buckets(f" {word} ")] > 0).any()
