"""Fill-in-middle texts, spelling variants and main texts on small planted cases, against plain versions."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pressgauge.llm import extraction, fill_middle, variants
from pressgauge.llm.textops import pieces

# -- 11 --------------------------------------------------------------------------------------------------------


def plain_form(doc_id, text):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in fill_middle.MARKS) or h[2] % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


ODD = ["", "a", "<", "<P>", "x<S>y", "<M", "<<P<S<", "é" * 9, "日本語のテキスト", "a😀b😀c", "tab\tline\n", "M><P", "word " * 400]


def test_fill_middle_forms(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(ODD) + rng.choice(ODD)) for k in range(400)] + [(None, None), (None, "null id"), (7, "again"), (7, "again")]
    rows += [(2**62, "long " * 700_000 + "日本 " * 300_000)]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id bigint, text string, restored int")
    out = fill_middle.transform(df)
    got = [tuple(r) for r in out.select("doc_id", "text", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored("output", "form")).collect()]
    want = [(k, t, *plain_form(k, t), t or "") for k, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {"plain", "psm", "spm"} == {g[2] for g in got}
    with pytest.raises(ValueError):
        fill_middle.transform(df.withColumnRenamed("restored", "Output"))


def test_fill_middle_slices(monkeypatch):
    """Sums carried from slice to slice give what one slice gives."""
    monkeypatch.setattr(fill_middle, "SLICE", 7)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aé日😀 ") for _ in range(rng.randrange(0, 60))) for _ in range(80)]
    cuts = [sorted((rng.randrange(len(t) + 1), rng.randrange(len(t) + 1))) for t in texts]
    forms = ["psm" if k % 2 else "spm" for k in range(80)]
    out = fill_middle._transformed(
        pa.array(texts), pa.array(forms), pa.array([a for a, _ in cuts]), pa.array([b - a for a, b in cuts]),
    ).to_pylist()
    for t, (a, b), form, o in zip(texts, cuts, forms, out):
        assert o == (f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}" if form == "psm" else f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}")
    assert fill_middle._restored(pa.array(out), pa.array(forms)).to_pylist() == texts


def test_fill_middle_not_restorable():
    broken = ["<P>a<S>b", "<P>a<S>b<M>c<M>", "x<P>a<S>b<M>c", "<S>a<P>b<M>c", "", "<P><S><M>"]
    assert fill_middle._restored(pa.array(broken), pa.array(["psm"] * 6)).to_pylist() == [None] * 5 + [""]


def test_fill_middle_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert fill_middle.transform(df).collect() == []


# -- 12 --------------------------------------------------------------------------------------------------------


def plain_words(rows):
    import re

    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_groups(words):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, vs in near.items():
        if vs:
            best = min(vs, key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


def vocabulary_rows(seed):
    rng = random.Random(seed)
    letters = "abcdeéßÀ×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 11))) for _ in range(40)]
    words = collections.Counter()
    for b in base:
        words[b] = rng.choice([2, 20, 400])
        for _ in range(8):
            k = rng.randrange(len(b))
            v = rng.choice([b[:k] + b[k + 1:], b[:k] + rng.choice(letters) + b[k:], b[:k] + rng.choice(letters) + b[k + 1:]])
            words[v] += rng.choice([1, 2, 2, 25])
    # A chain of forms, a tie, a very long word and its neighbour.
    words.update({"chainaaa": 2, "chainaab": 20, "chainabb": 200, "chainbbb": 2000, "tiewords": 2, "tiewordt": 30, "tiewordr": 30})
    words.update({"l" * 3000 + "m": 2, "l" * 3000: 30})
    rows = [[] for _ in range(50)]
    for w, n in words.items():
        for k in range(n):
            rows[rng.randrange(50)].append(w.upper() if k % 7 == 0 and w.isascii() else w)
    return [(k if k else None, " ".join(r)) for k, r in enumerate(rows)] + [(100, None), (101, ""), (102, "the of 12 a-b")]


@pytest.mark.parametrize("tile", [1000, 3])
def test_variants_brute_force(spark, monkeypatch, tile):
    """tile: blocks of many small tiles give what blocks of one give."""
    monkeypatch.setattr(variants, "TILE_WORDS", tile)
    rows = vocabulary_rows(3)
    df = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id bigint, text string, word int")
    words = variants.written(variants.word_counts(df), "words")
    assert {r.word: r.n for r in words.collect()} == plain_words(rows)
    got = sorted(tuple(r) for r in variants.grouped(words).collect())
    want = plain_groups(plain_words(rows))
    assert got == want
    assert any(r[2] not in (r[0], r[1]) for r in got)


def test_variants_tiles_of_equal_letters_and_other_lengths():
    letters, rows = "agmsyagmsyagagmsyagmsyas", []
    for length in (8, 12):
        words = [letters[k:k + length] for k in range(0, len(letters), length)]
        assert len(set(words)) == len(words)
        rows.append({"length_a": length, "letters_a": letters, "ns_a": [2] * len(words), "length_b": length, "letters_b": letters, "ns_b": [2] * len(words), "self": True})
    found = [r for b in variants._compared([pa.RecordBatch.from_pylist(rows)]) for r in b.to_pylist()]
    assert {r["word"]: (r["n_near"], r["best"]) for r in found} == {letters[:12]: (1, letters[12:]), letters[12:]: (1, letters[:12])}


def test_variants_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert variants.grouped(variants.written(variants.word_counts(df), "words")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=4, max_size=5), min_size=2, max_size=20), st.sets(st.text("abé", min_size=5, max_size=5), min_size=1, max_size=20))
def test_near_pairs(short, long):
    for length in (4, 5):
        own = sorted(w for w in short if len(w) == length)
        other = sorted(w for w in long)
        if own:
            a, b = (variants._matrix("".join(ws), len(ws[0])) for ws in (own, other))
            got = {(own[i], other[j]) for i, j in zip(*variants.near_pairs(a, b, False))}
            assert got == {(x, y) for x, y in itertools.product(own, other) if one_edit(x, y)}


def test_squared_distances():
    words = ["aabbc", "abcde", "éééaa"]
    m = variants._matrix("".join(words), 5)
    plain = [[sum((x.count(c) - y.count(c)) ** 2 for c in set(x + y)) for y in words] for x in words]
    assert np.array_equal(variants.squared_distances(m, m), plain)


# -- 13 --------------------------------------------------------------------------------------------------------


def text_of(source):
    return extraction.main_text(extraction.Page(source, extraction._Kinds()), None)[0]


def test_blocks():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav>Menu <a href="/">Home</a></nav>
    <article class="post has-sidebar"><header class="entry-header"><h1>A &amp; B</h1></header>
    <p>One <b>bold</b>,<br>two&nbsp;<i>three<p>Four<script>x("</p>")</script> five</p>
    <ul><li>six<li>seven</ul><div class="ad">Buy</div><aside>Side</aside><p hidden>gone</p>
    <blockquote>eight</blockquote></div><p>nine &lt;tag&gt; &#233; &#x1F600;</p><!-- <p>no</p> -->
    <table><tr><td>t1<td>t2</table><form>Name <input> <button>Go</button></form>
    <div id="comments"><article class="comment"><p>First!</p></article></div></article>
    <article class="comment">Me too</article><footer>&copy; me</footer></body></html>"""
    assert text_of(page) == "\n\n".join(["A & B", "One bold, two three", "Four five", "six", "seven", "eight", "nine <tag> é 😀", "t1", "t2"])


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain words", "plain words"), ("<article><p>a<p>b <a href='x", "a\n\nb"), ("<article><p>1 < 2</p><p>a<b", "1 < 2\n\na"),
    ("<article><p class=\"x>a</p><p>b</p></article>", "a\n\nb"), ("<article><script>if (a < b) {", ""),
    ("<form><nav>m</nav><main><p>in a form</p></main></form>", "in a form"), ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><p>a<!-- open <p>b", "a"), ("<article><a><p>x</a></p>y</article>z", "x\n\ny"),
    ("<body><div role=navigation>m</div><div itemprop=articleBody>t</div></body>", "t"),
])
def test_odd_markup(source, text):
    assert text_of(source) == text


def test_long_page():
    """Time follows length: unclosed tags, quotes and deep nesting."""
    n = 20_000
    assert len(text_of("<article>" + "<p>word " * n)) == 4 * n + 2 * (n - 1)
    assert text_of("<article>" + "<div>" * 2000 + "deep") == "deep"
    text_of("<article>" + '<a href="x> ' * n)
    text_of("<article>" + "<" * n)


def site(rng, k, words):
    """Pages without any telling tag or name: menu, notice, article, foot line."""
    def line(n):
        return " ".join(rng.choice(words) for _ in range(n))

    menu = "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in ("Home", "News", "Contact"))
    body = [line(rng.randrange(12, 40)) for _ in range(rng.randrange(2, 6))]
    title = line(5)
    return (
        f"<html><body><div><div>Daily site</div>{menu}</div><div><p>We keep your data safe, read more about how.</p></div>"
        f"<div><div><h1>{title}</h1>{''.join(f'<p>{b}</p>' for b in body)}</div></div><div>All rights reserved</div></body></html>",
        "\n\n".join([title, *body]),
    )


def test_templates(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    made = [site(rng, k, words) for k in range(40)]
    rows = [(k, f"https://Site.example/{k}", s) for k, (s, _) in enumerate(made)]
    want = {k: t for k, (_, t) in enumerate(made)}
    # An article's notice on all pages of a host; a line that some share stays; copies are not a template.
    for k in range(40, 50):
        own = f"unique text {words[k]} number {k} {words[k + 50]} and so on for this page"
        some = "<p>A line that some share</p>" if k % 3 == 0 else ""
        rows.append((k, "http://b.example/x", f"<body><article><p>{own}</p>{some}<p>Subscribe now</p></article></body>"))
        want[k] = "\n\n".join([own, "A line that some share"] if some else [own])
    for k in range(50, 60):
        rows.append((k, "http://copies.example/x", "<body><article><h1>Same</h1><p>The very same text</p></article></body>"))
        want[k] = "Same\n\nThe very same text"
    rows += [(60, None, "<article>no url</article>"), (61, "http://c.example", None), (62, "mailto:x", ""), (None, "http://c.example", "<p>x"), (0, *rows[0][1:])]
    want |= {60: "no url", 61: "", 62: "", None: "x"}
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id bigint, url string, html string, tokens int")
    got = extraction.extract(df, extraction.templates(df)).collect()
    assert len(got) == len(rows) and got[0].tokens == 5
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_template >= 3 for r in got if r.page_id is not None and r.page_id < 60)
    with pytest.raises(ValueError):
        extraction.extract(df.withColumnRenamed("tokens", "text"), extraction.templates(df))


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extraction.extract(df, extraction.templates(df)).collect() == []


def plain_classes(pages):
    """Tokens by their vectors over all pages, held in lists."""
    vectors = collections.defaultdict(lambda: [0] * len(pages))
    for k, page in enumerate(pages):
        for key in page.keys:
            vectors[key][k] += 1
    classes = collections.defaultdict(set)
    for key, v in vectors.items():
        classes[tuple(v)].add(key)
    return {frozenset(c) for v, c in classes.items() if len(c) >= extraction.LEAST_SIZE and sum(map(bool, v)) >= max(extraction.LEAST_PAGES, extraction.SHARE * len(pages))}


def test_classes_brute_force(spark, sf_dir):
    """The classes of each host, from hashes added up by Spark, and from whole vectors."""
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = df.select("html", extraction.host("url").alias("h")).collect()
    by_host = collections.defaultdict(list)
    for r in rows:
        by_host[r.h].append(extraction.Page(r.html or "", extraction._Kinds()))
    want = {frozenset(c) for pages in by_host.values() for c in plain_classes(pages)}
    got = set()
    for r in extraction.templates(df).collect():
        groups = collections.defaultdict(set)
        for t in r.tokens:
            groups[t.pages, t.vector].add(t.token)
        got |= {frozenset(g) for g in groups.values() if len(g) >= extraction.LEAST_SIZE}
    assert got == want and want


def test_crossing_classes():
    keys, vectors, places = (np.array(x) for x in ([1, 2, 3, 4, 5], [7, 7, 7, 8, 8], [0, 2, 4, 1, 3]))
    t = extraction.Template(keys, vectors, places * 3, np.array([3] * 5), np.zeros(5), 3)
    assert t.valid([1, 2, 3]) == t.valid([1, 4, 5, 2, 3]) | {1} == {0, 1}
    assert t.valid([1, 4, 2, 5, 3]) == {0}  # crossing: the smaller class goes
    assert t.valid([2, 1, 3, 4, 5]) == {1}  # out of order


def test_pieces_of_bytes():
    piece = next(iter(pieces(pa.array(["aé", "", "日x"]), lower=False)))
    assert fill_middle._byte_places(piece, np.array([1, 0, 2])).tolist() == [1, 3, 7]
    assert fill_middle._byte_places(piece, np.array([2, 0, 0])).tolist() == [3, 3, 3]
