"""Main texts of web pages, by templates deduced from equivalence classes of tokens.

A page's tokens are its elements, told apart by their path, tag, class and id, and its blocks of text, told apart by
path and text. Over the pages of a host every token has an occurrence vector: how often it occurs on each page. Tokens
of equal vectors are an equivalence class. Vectors are compared by a hash that is summed up before the shuffle, so a
host of any number of pages is never gathered; a host's template keeps what occurs on SHARE of its pages or more, and
is bounded by the size of its pages, not by their number.

On each page a class of at least LEAST_SIZE tokens is valid if its tokens come in the class's order, over and over, and
each run of them lies whole between two tokens of any other class; the valid classes nest into the template. Blocks in
classes are fixed text (menus, notices, footers), all others fill slots. The main text is what the slots of the article
hold: those below `article` or `main` where a page has them, else those below the element that holds most of the text
on this page and on the host. Slots in elements that say by tag, role, class or id that they hold something else
are left out. Fixed text inside an article goes only if nearly all pages of the host have it and it is the smaller
part of the article: copies of one article are not a template.

Blocks end at block elements; inline markup and line breaks do not end them. Character references are decoded, white
space becomes one space, blocks are joined by two line feeds.

Defined cases: a null page is an empty one and gives an empty text; a page without a host (null or no ``://``) is
judged by itself, as is one of a host with fewer than LEAST_PAGES pages; repeated rows count as pages each; markup
that is cut off ends where the page ends; an empty table gives an empty result; other columns don't matter. A page may
be of any length.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.graph import written

SHARE, LEAST_PAGES, LEAST_SIZE = 0.5, 3, 2
#: Fixed text inside an article: so many pages at least, and this share of the host's.
FIXED_PAGES, FIXED_SHARE = 5, 0.8
#: An element is the main one as long as one child holds less than this share of its text.
HOLDS = 0.6

# What HTML elements and usual class names stand for.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table caption colgroup tbody td tfoot th thead tr ul".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_UNSHOWN = frozenset(
    "head script style textarea title iframe noembed noframes noscript template svg math object canvas audio video "
    "select datalist button option map".split()
)
_VOID = frozenset("area base basefont br col embed hr img input link meta param source track wbr".split())
_OTHER_TAGS = frozenset("nav aside footer form dialog menu search header".split())
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_CONTAINERS = frozenset("html body div section center table tbody tr td main article form details".split())
_CLOSES_P = _BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup", "legend"}
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox banner sponsor sponsored sponsors "
    "promo promos promoted promotion "
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager "
    "masthead topbar footer colophon copyright "
    "sidebar widget widgets related recommended recommendations trending "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login paywall "
    "share sharing social comment comments commentlist reply replies respond disqus search searchbox".split()
)
_ARTICLE_WORDS = frozenset("article post entry content story headline title".split())
_NOT_PREFIXES = ("no-", "has-", "with-", "without-", "not-")

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|/([A-Za-z][^\s/>]*)[^>]*>|[!?/][^>]*>)", re.S,
)
_PLAIN_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|([A-Za-z][^\s/>]*)([^>]*)>|/([A-Za-z][^\s/>]*)[^>]*>|[!?/][^>]*>)", re.S)
_ATTRIBUTE = re.compile(r"(?i)(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?![\w-])")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NUMBER = re.compile(r"\d+")
_UNCLOSED = re.compile(r"<[A-Za-z!?/][^>]*\Z")

#: What an element says about the text below it.
_PLAIN, _ARTICLE, _OTHER, _NONE = 0, 1, 2, 3


def _key(parent: int, sign: str) -> int:
    own = hashlib.blake2b(parent.to_bytes(8, "little", signed=True) + sign.encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(own.digest(), "little", signed=True)


def _other_words(names: str) -> set[str]:
    words: set[str] = set()
    for name in names.split():
        if not name.lower().startswith(_NOT_PREFIXES):
            words.update(w.lower() for w in _WORD.findall(name))
    found = words & _OTHER_WORDS
    return found | ({"header"} if "header" in words and not words & _ARTICLE_WORDS else set())


class _Kinds:
    """What start tags say, remembered by their text."""

    LIMIT = 10_000

    def __init__(self):
        self.known: dict[tuple[str, str], tuple[str, int]] = {}

    def __call__(self, tag: str, attributes: str) -> tuple[str, int]:
        """The sign of an element in its path, and what it says."""
        found = self.known.get((tag, attributes))
        if found is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            found = self.known[tag, attributes] = self._read(tag, attributes)
        return found

    @staticmethod
    def _read(tag: str, attributes: str) -> tuple[str, int]:
        own: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
            own.setdefault(name.lower(), entities.unescape("".join(values)))
        names = f"{own.get('class', '')} {own.get('id', '')}"
        sign = _NUMBER.sub("0", f"{tag}.{own.get('class', '')}#{own.get('id', '')}")
        role = own.get("role", "").strip().lower()
        style = re.sub(r"\s", "", own.get("style", "").lower())
        if tag in _UNSHOWN or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in style:
            return sign, _NONE
        if tag in ("html", "body") or tag in _HEADINGS:
            return sign, _PLAIN
        if tag == "main" or role == "main":
            return sign, _ARTICLE
        found = _other_words(names)
        if tag == "article" or "articlebody" in own.get("itemprop", "").lower():
            return sign, _OTHER if found and tag == "article" else _ARTICLE
        return sign, _OTHER if found or tag in _OTHER_TAGS or role in _OTHER_ROLES else _PLAIN


class Page:
    """The tokens of a page in order. Of each its key, the token of its element, and for blocks text and link share."""

    def __init__(self, source: str, kinds: _Kinds):
        # Key, element above, tag (empty for blocks), text (None for elements), characters in links, what holds there,
        # the outermost article around (or -1).
        self._tokens: list[tuple[int, int, str, str | None, int, int, int]] = []
        self._path: dict[tuple[int, str], int] = {}
        self._parts: list[str] = []
        self._links = self._linked = 0  # depth of links, characters in them
        # Open elements: tag, token (-1: inline), what holds below it; then article, token and says of its block.
        self._open: list[tuple[str, int, int, int, int, int]] = [("", -1, _PLAIN, -1, -1, _PLAIN)]
        self._read(source, kinds)
        self.keys, self.parents, self.tags, self.texts, self.linked, self.says, self.article = (
            map(list, zip(*self._tokens)) if self._tokens else ([] for _ in range(7))
        )

    def _read(self, source: str, kinds: _Kinds) -> None:
        at, size, pattern = 0, len(source), _TAG
        while at < size:
            m = pattern.search(source, at)
            if m is None or (pattern is _TAG and source.find("<", at, m.start()) >= 0 and _PLAIN_TAG.search(source, at).start() < m.start()):
                # A quote that is never closed: from here on a tag ends at the next bracket.
                if pattern is _TAG and (m is not None or _PLAIN_TAG.search(source, at) is not None):
                    pattern = _PLAIN_TAG
                    continue
                cut = _UNCLOSED.search(source, at)
                self._text(source[at:cut.start() if cut else size])
                break
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            if m[1] is not None:
                tag = m[1].lower()
                sign, says = kinds(tag, m[2])
                self._start(tag, sign, says)
                if tag in _RAW:
                    end = re.compile(rf"(?i)</{tag}(?=[\s/>])").search(source, at)
                    at = size if end is None else end.start()
            elif m[3] is not None:
                self._end(m[3].lower())
        self._flush()

    def _text(self, text: str) -> None:
        if self._open[-1][2] != _NONE:
            if "&" in text:
                text = entities.unescape(text)
            self._parts.append(text)
            if self._links:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                _, _, _, article, at, holds = self._open[-1]
                self._tokens.append((_key(self._tokens[at][0] if at >= 0 else 0, "=" + text), at, "", text, self._linked, holds, article))
            self._parts = []
            self._linked = 0

    def _start(self, tag: str, sign: str, says: int) -> None:
        if tag == "br":
            self._parts.append(" ")
            return
        above = self._open[-1]
        if tag not in _BLOCKS:
            if tag not in _VOID:
                self._links += tag == "a"
                self._open.append((tag, -1, _NONE if says >= _OTHER or above[2] == _NONE else above[2], *above[3:]))
            return
        self._flush()
        if tag in _CLOSES_P:
            self._implied({"p"}, {"td", "th", "table", "article", "main", "div", "section", "li", "blockquote"})
        if tag in _SIBLINGS:
            self._implied(*_SIBLINGS[tag])
        if tag == "hr":
            return
        above = self._open[-1]
        holds, article = above[2], above[3]
        if holds != _NONE:
            inside = article >= 0
            if says == _ARTICLE:
                # A form or a header may stand around a whole page.
                if holds == _PLAIN or all(o[0] in ("form", "header") for o in self._open if o[2] == _OTHER and o[1] >= 0):
                    holds = _PLAIN
                    article = article if inside else len(self._tokens)
            elif says == _NONE:
                holds = _NONE
            elif says == _OTHER and not (tag == "header" and inside):
                holds = _OTHER
        parent, at = above[4], len(self._tokens)
        known = self._path.get((parent, sign))
        if known is None:
            known = self._path[parent, sign] = _key(self._tokens[parent][0] if parent >= 0 else 0, sign)
        self._open.append((tag, at, holds, article, at, holds))
        self._tokens.append((known, parent, tag, None, 0, holds, article))

    def _pop(self, to: int) -> None:
        if self._links:
            self._links -= sum(o[0] == "a" for o in self._open[to:])
        del self._open[to:]

    def _implied(self, closed: set[str], within: set[str]) -> None:
        """Closes the outermost open element of a kind, up to one that it may stand within."""
        found = 0
        for k in range(len(self._open) - 1, 0, -1):
            tag = self._open[k][0]
            if tag in closed:
                found = k
            elif tag in within:
                break
        if found:
            self._pop(found)

    def _end(self, tag: str) -> None:
        block = tag in _BLOCKS
        if block:
            self._flush()
        for k in range(len(self._open) - 1, 0, -1):
            own = self._open[k][0]
            if own == tag:
                self._pop(k)
                break
            # A stray end tag does not end the article around it, nor an inline one its block.
            if (own in ("article", "main") and tag not in ("body", "html", "article", "main")) or (not block and own in _BLOCKS):
                break


class Template:
    """The classes of a host: of each token its class and place there, and what share of the pages has it."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, places: np.ndarray, pages: np.ndarray, chars: np.ndarray, total: int):
        self.total = total
        self.class_of: dict[int, tuple[int, int]] = {}
        self.pages = dict(zip(keys.tolist(), pages.tolist()))
        self.chars = dict(zip(keys.tolist(), (chars / np.maximum(total, 1)).tolist()))
        by_vector: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for key, vector, place, n in zip(keys.tolist(), vectors.tolist(), places.tolist(), pages.tolist()):
            by_vector.setdefault((n, vector), []).append((place / n, key))
        self.sizes: list[int] = []
        for members in by_vector.values():
            if len(members) >= LEAST_SIZE:
                for k, (_, key) in enumerate(sorted(members)):
                    self.class_of[key] = (len(self.sizes), k)
                self.sizes.append(len(members))

    def valid(self, keys: list[int]) -> set[int]:
        """The classes that are ordered and nested on a page."""
        dropped: set[int] = set()
        while True:
            bad = self._crossing(keys, dropped)
            if bad is None:
                return set(range(len(self.sizes))) - dropped
            dropped.add(bad)

    def _crossing(self, keys: list[int], dropped: set[int]) -> int | None:
        stack: list[list[int]] = []
        for key in keys:
            own = self.class_of.get(key)
            if own is None or own[0] in dropped:
                continue
            number, place = own
            if place == 0:
                if any(s[0] == number for s in stack):
                    return number
                stack.append([number, 1])
            elif not stack:
                return number
            elif stack[-1][0] != number:
                # The smaller of two that cross is not valid.
                return min(number, stack[-1][0], key=lambda c: (self.sizes[c], c))
            elif stack[-1][1] != place:
                return number
            else:
                stack[-1][1] += 1
            if stack[-1][1] == self.sizes[number]:
                stack.pop()
        return stack[-1][0] if stack else None


def main_text(page: Page, template: Template | None) -> tuple[str, int]:
    """The text in the article's slots, and the number of the page's tokens that belong to valid classes."""
    fixed: set[int] = set()
    if template is not None and template.sizes:
        valid = template.valid(page.keys)
        fixed = {k for k, key in enumerate(page.keys) if (own := template.class_of.get(key)) and own[0] in valid}
    shown = [k for k, text in enumerate(page.texts) if text is not None and page.says[k] == _PLAIN]
    inside = [k for k in shown if page.article[k] >= 0]
    if inside:
        articles = [k for k in inside if page.tags[page.article[k]] == "article" or _below(page, k, "article")]
        if 2 * _length(page, articles) >= _length(page, inside):
            inside = articles
        everywhere = [
            k for k in inside
            if k in fixed and template.pages[page.keys[k]] >= max(FIXED_PAGES, FIXED_SHARE * template.total)
        ]
        if 2 * _length(page, everywhere) < _length(page, inside):
            gone = set(everywhere)
            inside = [k for k in inside if k not in gone]
        chosen = inside
    else:
        slots = [k for k in shown if k not in fixed]
        chosen = _main_slots(page, slots or shown, fixed, template)
    return "\n\n".join(page.texts[k] for k in chosen), len(fixed)


def _length(page: Page, blocks: list[int]) -> int:
    return sum(len(page.texts[k]) for k in blocks)


def _below(page: Page, k: int, tag: str) -> bool:
    while k >= 0:
        if page.tags[k] == tag:
            return True
        k = page.parents[k]
    return False


def _main_slots(page: Page, slots: list[int], fixed: set[int], template: Template | None) -> list[int]:
    """The slots below the element that holds most of the text, those that are mostly links left out."""
    slots = [k for k in slots if 2 * page.linked[k] <= len(page.texts[k])]
    weight = [0.0] * len(page.keys)
    for k in slots:
        weight[k] = len(page.texts[k])
    if template is not None:
        # What the element holds on the host's pages on the average, without its fixed text.
        own = {k: template.chars.get(page.keys[k], 0.0) for k, tag in enumerate(page.tags) if tag and page.says[k] == _PLAIN}
        for k in fixed:
            if page.texts[k] is not None and page.parents[k] in own:
                own[page.parents[k]] -= len(page.texts[k])
        seen: set[int] = set()
        for k, mean in own.items():
            if page.keys[k] not in seen:
                seen.add(page.keys[k])
                weight[k] += max(mean, 0.0)
    children: dict[int, list[int]] = {}
    for k in range(len(page.keys) - 1, -1, -1):
        if page.parents[k] >= 0:
            weight[page.parents[k]] += weight[k]
        if page.tags[k] in _CONTAINERS:
            children.setdefault(page.parents[k], []).append(k)
    at = -1
    total = sum(w for w, p in zip(weight, page.parents) if p < 0)
    while True:
        best = max(children.get(at, []), key=lambda k: weight[k], default=None)
        if best is None or weight[best] <= HOLDS * total:
            break
        at, total = best, weight[best]
    inside = {at}
    for k, parent in enumerate(page.parents):
        if parent in inside:
            inside.add(k)
    return [k for k in slots if k in inside]


_TOKENS_DDL = "host bigint, token bigint, pages bigint, vector bigint, place bigint, chars bigint"
_TOKENS = pa.schema([(c.split()[0], pa.int64()) for c in _TOKENS_DDL.split(", ")])
_STEP = 512
_M = (1 << 64) - 1


def _vector(page: int, count: int) -> int:
    """A page's part of a vector's hash."""
    x = (page ^ (count * 0x9E3779B97F4A7C15)) & _M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M
    x ^= x >> 31
    return x - (1 << 64) if x >> 63 else x


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of the pages with their vectors, added up by host."""
    kinds = _Kinds()
    for whole in batches:
        for s in range(0, whole.num_rows, _STEP):
            batch = whole.slice(s, _STEP)
            found: dict[tuple[int, int], list[int]] = {}
            for host, number, source in zip(*(batch.column(c).to_pylist() for c in ("host", "number", "html"))):
                page = Page(source, kinds)
                count: dict[int, list[int]] = {}
                for k, key in enumerate(page.keys):
                    own = count.setdefault(key, [0, k, 0])
                    own[0] += 1
                    if page.texts[k] is not None and page.says[k] == _PLAIN and page.parents[k] >= 0 and 2 * page.linked[k] <= len(page.texts[k]):
                        count[page.keys[page.parents[k]]][2] += len(page.texts[k])
                number &= _M
                for key, (n, place, chars) in count.items():
                    own = found.get((host, key))
                    part = _vector(number, n)
                    if own is None:
                        found[host, key] = [host, key, 1, part, place, chars]
                    else:
                        own[2] += 1
                        own[3] ^= part
                        own[4] += place
                        own[5] += chars
            columns = np.array(list(found.values()), dtype=np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_TOKENS)


def host(url: Column | str) -> Column:
    """The host and port of a URL, in lower case; null without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.lower(found))


def templates(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` (its hash), ``total`` pages and the ``tokens`` that SHARE of them have."""
    own = pages.where(host(url_col).isNotNull() & F.col(html_col).isNotNull())
    rows = own.select(
        F.xxhash64(host(url_col)).alias("host"), F.xxhash64(id_col, url_col, html_col).alias("number"), F.col(html_col).alias("html"),
    )
    found = rows.mapInArrow(_occurrences, _TOKENS_DDL).groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("place").alias("place"), F.sum("chars").alias("chars"),
    ).where(F.col("pages") >= LEAST_PAGES)
    # Counted without parsing: the tokens are made once.
    totals = own.groupBy(F.xxhash64(host(url_col)).alias("host")).agg(F.count(F.lit(1)).alias("total"))
    kept = found.join(totals, "host").where(F.col("pages") >= SHARE * F.col("total"))
    # At most 1 / SHARE times as many tokens a host as its pages have on the average.
    return kept.groupBy("host", "total").agg(F.collect_list(F.struct("token", "vector", "place", "pages", "chars")).alias("tokens"))


TEXT_DDL = "struct<text string, n_template bigint>"
_TEXT = pa.struct([("text", pa.string()), ("n_template", pa.int64())])
_HOSTS_HELD = 256


def _extracted(sources: pa.Array, hosts: pa.Array, totals: pa.Array, tokens: pa.Array) -> pa.Array:
    kinds, held = _Kinds(), {}
    texts, counts = [], []
    for k in range(len(sources)):
        template, total = None, totals[k].as_py()
        if total is not None:
            own = hosts[k].as_py()
            template = held.get(own)
            if template is None:
                if len(held) >= _HOSTS_HELD:
                    held.clear()
                fields = [np.asarray(f.to_numpy(zero_copy_only=False)) for f in tokens[k].values.flatten()]
                template = held[own] = Template(*fields, total)
        text, n = main_text(Page(sources[k].as_py() or "", kinds), template)
        texts.append(text)
        counts.append(n)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(counts, pa.int64())], fields=list(_TEXT))


def extract(
    pages: DataFrame, found: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text",
) -> DataFrame:
    """The pages with their main text and ``n_template``, given their hosts' templates.

    Spark sends the templates to the pages where they are small, else pages and templates meet by host; the rows of a
    large host can be split, as it has one template row."""
    names = {"_host", "_total", "_tokens", "_x"}
    taken = {c.lower() for c in pages.columns} & (names | {text_col.lower(), "n_template"})
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    own = found.select(F.col("host").alias("_host"), F.col("total").alias("_total"), F.col("tokens").alias("_tokens"))
    hashed = pages.withColumn("_host", F.when(host(url_col).isNotNull(), F.xxhash64(host(url_col))))
    run = F.arrow_udf(_extracted, TEXT_DDL)
    rows = hashed.join(own, "_host", "left").withColumn("_x", run(html_col, "_host", "_total", "_tokens"))
    return rows.select(*pages.columns, F.col("_x.text").alias(text_col), F.col("_x.n_template").alias("n_template"))


def query(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", "html")
    rows = extract(pages, written(templates(pages), "templates"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template")
