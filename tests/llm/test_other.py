"""Vectors, archives, pages, conversations and the pipeline."""

import itertools
import random
from collections import Counter
import re

import numpy as np
import pytest

from waymark.llm import chat, lattice, pages, warc
from waymark.llm.components import components


# ------------------------------------------------------------------ components

@pytest.mark.parametrize("local", [0, 200_000])
def test_components(spark, local, monkeypatch):
    from waymark.llm import components as module
    monkeypatch.setattr(module, "LOCAL_LINKS", local)
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] \
        + [(5, 5), (None, 3), (4, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ lattice

def test_vectors_of_repeated_ids(spark, rows):
    """Vectors A and B under one id, B under another; ids beyond 2^53 beside nulls."""
    rng = np.random.default_rng(1)
    a, b, c = (rng.normal(size=16).tolist() for _ in range(3))
    big = 2 ** 53 + 1
    data = [(5, a), (5, b), (2, b), (7, a), (big, c), (big + 1, c), (None, c), (None, None)]
    got = lattice.near_duplicates(rows(data, "vec_id long, embedding array<double>")).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == Counter(
        [(5, 1, 5, True), (5, 1, 2, False), (2, 1, 2, True), (7, 1, 5, False), (big, 1, big, True), (big + 1, 1, big, False),
         (None, 0, None, True), (None, 0, None, True)])


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    p = lattice.decode(x)
    d = ((x - p) ** 2).sum(1)
    for v in lattice.NEIGHBOURS:                          # no neighbour is nearer
        assert (((x - p - v) ** 2).sum(1) >= d - 1e-9).all()
    assert len(lattice.NEIGHBOURS) == 240 and np.allclose((lattice.NEIGHBOURS ** 2).sum(1), 2)


@pytest.mark.parametrize("side", [2048, 16])
def test_links_brute_force(spark, rows, side, monkeypatch):
    monkeypatch.setattr(lattice, "SIDE", side)
    rng = np.random.default_rng(4)
    v = [rng.normal(size=16) for _ in range(60)]
    for _ in range(120):
        b = v[rng.integers(60)]
        v.append(b + rng.normal(size=16) * np.linalg.norm(b) * rng.choice([0.01, 0.06, 0.11]))
    v = [x.astype(np.float32).tolist() for x in v] + [(2 * v[3]).tolist()]
    v += [v[3], v[3], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    table = rows(list(enumerate(v)) + [(None, v[3])], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in lattice.near_duplicates(table).collect()}
    assert len(got) == len(v) + 1
    ok = [i for i, x in enumerate(v) if x and None not in x and np.isfinite(x).all() and any(x)]
    u = {i: np.array(v[i], np.float32).astype(float) for i in ok}
    u = {i: x / np.linalg.norm(x) for i, x in u.items()}
    near = {i: {j for j in ok if j != i and len(u[i]) == len(u[j]) and u[i] @ u[j] >= lattice.COSINE} for i in ok}
    total = sum(map(len, near.values()))
    found = sum(got[i].n_links for i in ok)
    assert all(got[i].n_links <= len(near[i]) for i in ok) and found >= 0.99 * total and total > 300
    for i in set(range(len(v))) - set(ok):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    comp = {i: i for i in ok}
    for _ in ok:
        comp = {i: min([comp[i], *(comp[j] for j in near[i])]) for i in ok}
    assert np.mean([got[i].component_id == comp[i] for i in ok]) > 0.98
    assert got[None].n_links == 0
    assert lattice.near_duplicates(table.limit(0)).count() == 0


# ------------------------------------------------------------------ archives

def test_archives_round_trip(spark, rows, tmp_path):
    rng = random.Random(6)
    html = ["<p>" + " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(0, 400))) + "</p>\r\n\r\n" for _ in range(60)]
    html += [html[0], html[0], html[1], None, "", "é ü \u2028 x", "x" * 300_000]
    table = rows([(i, None if i == 5 else f"http://h/{i}\nz", h) for i, h in enumerate(html)] + [(None, "u", "only"), (None, "u", html[0])],
                 "page_id long, url string, html string").repartition(3)
    folder = "file://" + str(tmp_path / "archives")
    manifest = warc.write(table, folder)
    got = {(r.page_id, r.payload_digest): r for r in warc.read_back(spark, manifest, folder).collect()}
    payload = [(h or "").encode() for h in html]
    assert len(got) == len(html) + 2
    for i, p in enumerate(payload):
        r = got[i, warc.payload_digest(p)]
        first = payload.index(p)
        assert r.payload_bytes == len(p)
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
    assert got[None, warc.payload_digest(b"only")].record_type == "response"
    # Any record can be read alone, with the dictionary of its archive.
    import zstandard as zstd
    places = manifest.collect()
    for m in rng.sample(places, 5):
        data = (tmp_path / "archives" / m.archive).read_bytes()
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstd.ZstdDecompressor().decompress(data[8:8 + size])
        one = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary)).decompress(data[m.offset:m.offset + m.length])
        assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n")
    small = {r.page_id: r.record_type for r in warc.read_back(spark, warc.write(table, folder + "2", min_payload=10), folder + "2").collect()}
    assert small[63] == small[64] == "response" and small[60] == "revisit"
    assert warc.archive(table.limit(0)).count() == 0


# ------------------------------------------------------------------ pages

PAGE = ("<!DOCTYPE html><html><head><title>x</title><script>var t='</p><article>';</script></head><body><header>Site</header>"
        "<nav><ul><li><a href=/>Home</a></li></ul></nav><div class='ad banner'>buy {i}</div>"
        "<article class=post><h1>Title {i}</h1><p>First &amp; best {i}<br>line  two<p>Unclosed <b>bold</b> {i}</p>"
        "<div>Share this story</div><form><input>mail</form>{extra}<!-- hidden --><aside>side</aside></article>"
        "<section id='reader-comments'><p>nice {i}</p></section><footer>&copy; host {i}</footer></body></html>")


def test_pages(spark, rows):
    extra = {3: "<p>Only here</p>", 4: "<div class=cookie-notice>we use cookies</div>"}
    data = [(i, f"https://h.example/{i}", PAGE.format(i=i, extra=extra.get(i, ""))) for i in range(12)]
    data += [(100, None, None), (101, "http://x/", ""), (102, "http://y/", "<p>plain</p><nav>menu</nav> tail &lt;b&gt;"),
             (103, "http://z/", "<div class=sidebar>never closed <article>body text"), (None, "http://h.example/", "<article>a<"),
             (104, "http://q/", "<article><p>" + "long word " * 20000 + "</p></article>")]
    got = {r.page_id: r for r in pages.extract(rows(data, "page_id long, url string, html string")).collect()}
    for i in range(12):
        want = [f"Title {i}", f"First & best {i} line two", f"Unclosed bold {i}"] + (["Only here"] if i == 3 else [])
        assert got[i].text == "\n".join(want)              # the share line stands on every page: template
    assert [got[i].text for i in (100, 101)] == ["", ""] and got[102].text == "plain\ntail <b>"
    assert got[103].text == "body text" and got[None].text == "a<" or got[None].text == "a"
    assert got[104].n_chars == len("long word " * 20000) - 1
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert pages.extract(rows([], "page_id long, url string, html string")).count() == 0


def test_copied_articles_are_content(spark, rows):
    body = "<article><p>same one</p><p>same two</p><p>same three</p></article>"
    data = [(i, "http://h/", f"<html><body><nav>n</nav>{body if i < 8 else f'<article><p>own {i}</p></article>'}<footer>f</footer></body></html>")
            for i in range(20)]
    got = {r.page_id: r.text for r in pages.extract(rows(data, "page_id long, url string, html string")).collect()}
    assert got[0] == "same one\nsame two\nsame three" and got[19] == "own 19"


def test_copies_make_no_template(spark, rows):
    body = "<article><h2>The head</h2><p>same one</p><ul class=own><li>same two</li></ul><p>the longest of the same passages, {}</p></article>"
    shell = "<html><body><nav>n</nav>{}<footer>f</footer></body></html>"
    # A mirror host, a host with copies that hold tags of their own, and one with copies that differ in a line.
    data = [(i, "http://mirror/", shell.format(body.format("all"))) for i in range(6)]
    data += [(100 + i, "http://some/", shell.format(body.format("some") if i < 8 else f"<article><p>own {i}</p><dl><dd>Share it</dd></dl></article>"))
             for i in range(20)]
    near = body.format("all " * 20)
    data += [(200 + i, "http://near/", shell.format(near.replace("</article>", f"<p>line {i}</p></article>"))) for i in range(8)]
    got = {r.page_id: r.text for r in pages.extract(rows(data, "page_id long, url string, html string")).collect()}
    want = "The head\nsame one\nsame two\nthe longest of the same passages, "
    assert {got[i] for i in range(6)} == {want + "all"} and {got[100 + i] for i in range(8)} == {want + "some"}
    assert [got[100 + i] for i in range(8, 20)] == [f"own {i}" for i in range(8, 20)]
    assert [got[200 + i] for i in range(8)] == [f"{want}{('all ' * 20).strip()}\nline {i}" for i in range(8)]


def test_rows_that_repeat_keep_the_template(spark, rows):
    def page(i):
        alpha, share = "<p>Alpha</p>" * (1 + i % 2), "<dl><dd>Share it</dd></dl>"
        return f"<html><body><article><h2>Text of page number {i}</h2>{alpha + share if i % 2 else share + alpha}</article></body></html>"
    data = [(i, "http://h/", page(i)) for i in range(12)]
    texts = lambda d: sorted((r.page_id, r.text) for r in pages.extract(rows(d, "page_id long, url string, html string")).collect())
    once = texts(data)
    assert once[0][1] == "Text of page number 0\nAlpha"
    assert texts(data * 2) == sorted(once * 2)


def test_attributes_by_the_rules():
    """A quote opens a value only after "="."""
    assert pages.main_text("<div title=Bob's>one two</div><p>it's three</p>") == "one two\nit's three"
    assert pages.main_text('<p class="a"b">text here</p>') == "text here"
    assert pages.main_text("<p title='a>b' class = \"x > y\">kept</p>") == "kept"
    assert pages.main_text('<p data-x="class=sidebar">kept</p><p title=5">6\' tall</p>') == "kept\n6' tall"
    assert pages.main_text('<p title="never closed>lost? <b>bold</b>') == "lost? bold"


def test_page_ids_beyond_doubles(spark, rows):
    big = 2 ** 53 + 1
    got = pages.extract(rows([(big, "http://h/1", "<p>a</p>"), (None, None, None)], "page_id long, url string, html string"))
    assert Counter((r.page_id, r.text) for r in got.collect()) == Counter([(big, "a"), (None, "")])


def test_class_words_keep_the_article():
    want = "Head\nthe text of the page"
    text = "<h1>Head</h1><p>the text of the page</p>"
    for page in ("<article class='post comments-open'>{}</article>", "<main class='has-sidebar'>{}</main>", "<main class=widget>{}</main>",
                 "<div class='layout no-sidebar'>{}</div>", "<div class='sidebar-left'>{}</div>", "<div id=app hidden>{}</div>",
                 "<article><div class='social-history'>{}</div></article>", "<div aria-hidden=false>{}</div><p>x</p>"):
        assert pages.main_text(page.format(text)).startswith(want), page
    assert pages.main_text(f"<article>{text}<p class='notice'>of note</p></article>") == want + "\nof note"
    comments = "<section id=reader-comments>" + "<p>nice</p>" * 50 + "</section>"
    for page in (text + comments, f"<main>{text}{comments}</main>", f"{text}<div class='site-footer'>imprint</div>",
                 f"<main>{text}<div class='share-buttons'>mail</div></main>", f"<div class=sidebar>s</div>{text}"):
        assert pages.main_text(page) == want, page


# ------------------------------------------------------------------ chat

def cheapest(roles):
    best = None
    for way in itertools.product(range(4), repeat=len(roles)):     # 0: merge
        cost, q, ok = 0, chat.START, True
        for role, b in zip(roles, way):
            if b == 0:
                ok = ok and q != chat.START
                cost += chat.COST["merge"] + chat.COST["relabel"] * (role != q)
            elif chat.BETWEEN[q, b] is None:
                ok = False
            else:
                cost += chat.COST["insert"] * len(chat.BETWEEN[q, b]) + chat.COST["relabel"] * (role != b)
                q = b
            if not ok:
                break
        if ok:
            cost += chat.COST["insert"] * len(chat.AFTER[q])
            best = cost if best is None else min(best, cost)
    return best


def test_chat_brute_force(spark, rows):
    rng, data, convs = random.Random(8), [], {}
    for c in range(40):
        convs[c] = [rng.randrange(4) for _ in range(rng.randint(1, 6))]
        data += [(c, i, chat.ROLES[r] if r else rng.choice([None, "tool"]), f"t{i}") for i, r in enumerate(convs[c])]
    data += [(None, None, None, None), (70, 1, "user", ""), (70, 1, "user", ""), (71, 0, "Human", "a <|im_end|>"), (71, 1, "gpt", "b")]
    data += [(80, i, rng.choice(["user", "assistant", "system"]), f"t{i}") for i in range(900)]      # split over tasks
    rng.shuffle(data)
    out = chat.format_chat(rows(data, "conv_id long, turn long, role string, text string").repartition(5)).toPandas()
    assert len(out) == len(data)
    for c, g in out.sort_values("place").groupby("conv_id", dropna=False):
        text = "".join(g["rendered"])
        found = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
        assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in found) == text
        q = chat.START
        for a, _ in found:
            assert chat.ROLES.index(a) in chat.NEXT[q]
            q = chat.ROLES.index(a)
        assert q in chat.END and g["conv_cost"].nunique() == 1
        if c in convs:
            assert g["conv_cost"].iloc[0] == cheapest(convs[c])
            assert [x for _, b in found if b for x in b.split("\n\n")] == [f"t{i}" for i in range(len(convs[c]))]
    assert out[out.conv_id == 71]["conv_cost"].max() == 0
    whole = chat.chain([chat.reduce_run([(chat.ROLES.index(r), 0) for r in ["user", "user", "assistant"]])])
    assert whole[1] == cheapest([2, 2, 3])
    assert chat.format_chat(rows([], "conv_id long, turn long, role string, text string")).count() == 0


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, stage in cp.STAGES:
        out = cp.stored(stage(spark, docs, sf), f"test-{name}")
        if name != "mixing":
            assert out.columns == docs.columns and 0 < out.count() <= before
            before = out.count()
        docs = out
    assert {"part", "copy", "shuffle_key"} <= set(docs.columns) and docs.count() > 0
    for name, stage in cp.STAGES:
        assert stage(spark, spark.read.parquet(f"{sf}/documents.parquet").limit(0), sf).count() == 0
