"""HTML extraction by equivalence-class template deduction (operator 10).

Pages of a host come from a template.  A token is a tag with its container path
(so the same tag in two places is two tokens) or a piece of text outside the
article.  Tokens whose occurrence vector over the host's pages is the same form
an equivalence class; vectors are compared by the number of pages and an XOR of
hashes of (page, count), which tasks combine without ever holding a vector.

Classes that occur on at least half of the host's pages are valid and form the
template: ordered by mean position, a class nests in the gap of an outer class
that holds all its tokens.  Its containers are the slots.  A slot's weight is the
text in it that varies: all of its text less the pieces that come at least on half of
the pages at the same place.  The main slot is the article or main elements that
hold a fifth of the text that varies, else the innermost slot with most of it.  An
article element that holds the same teaser on every page is thus no main slot.
Every page then gives all blocks of its main slot.  In a page without that slot,
text pieces outside an article that occur on at least half of the host's pages are
boilerplate.

A host with fewer than ``least_pages`` pages has no vectors to compare; its
pages, and pages without their host's main slot, use their own article or main
element, else their body.

Parts that are never article text are left out by their tag, or by a name in class,
id or role.  A name does not leave out what a wrapper's name cannot mean: a container
that holds all articles of the page, or half of its text where it has no article.  For
names of reader comments only the first holds.  Inside an article headings have no
such names, and paragraphs only whole ones.

A page is read once, from left to right: a tag ends at the next ``<`` or ``>`` outside
quotes, and no part of it is read again.

The template of a host is bounded by the tokens of one page.  Statistics are
combined map-side; the join back is left to the planner, which broadcasts small
template tables and can split a hot host's pages otherwise.

Null or empty html gives empty text; a null url is a host of its own.  Repeated
rows count twice in the vectors and each get their row.  Empty tables give empty
results.  Only the id, url and html columns are read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_or_empty

# tags whose nesting makes up a path, and whose text is its own block
CONTAINERS = frozenset("html head body div section article main nav header footer aside form table ul ol dl menu dialog".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr blockquote pre figure figcaption hr address caption".split())
SPACES = frozenset("br td th wbr img".split())
DEEPEST = 64  # containers nested deeper share the path of the one around them
# names that containers of the whole content also have
WRAPPERS = frozenset("banner header notice share sharing sidebar social widget".split())
# parts that are never article text
PARTS = frozenset("head nav aside footer form menu dialog".split())
# an unclosed one of the first hides the rest of the page, as in a browser; of the second, only itself
_TO_END = frozenset("script style noscript template svg iframe textarea".split())
_ALONE = frozenset("select button object".split())
_TOKEN = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^">]*+"|'[^'>]*+'|["'])*+)>?|<[!?/][^<>]*+>?|([^<]++|<)""")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = (r"ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|disqus|footer|header|menu|nav(?:s|bar|igation|igator|list|menu)?|newsletter|"
          r"notice|popup|promo\w*|related|repl(?:y|ies)|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|widget")
_ASIDE = re.compile(rf"(?:^|[\s_-])({_WORDS})(?=$|[\s_-])", re.I)
_WHOLE = re.compile(rf"(?:^|\s)(?:{_WORDS})(?=$|\s)", re.I)
_READERS = frozenset("comment comments disqus reply replies respond".split())


def _tokens(page: str) -> Iterator[tuple[str, re.Match | None, str]]:
    """(kind, match, name) of tags ("tag"), text ("text") and raw elements ("raw"), in one pass."""
    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        if m.group() == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
        elif m.group(4) is not None:
            yield "text", m, ""
        elif m.group(2):
            tag = m.group(2).lower()
            if not m.group(1) and (tag in _TO_END or tag in _ALONE):
                yield "raw", m, tag
                if m.group(3).endswith("/"):
                    continue
                # the end tag, or for those that stand alone another start before it
                found = _RAW_ENDS[tag].search(page, at)
                if found and not found.group(1):
                    at = found.end()
                elif tag in _TO_END:
                    at = len(page)
            elif not (m.group(1) and (tag in _TO_END or tag in _ALONE)):
                yield "tag", m, tag


_RAW_ENDS = {t: re.compile(rf"</{t}\s*+>()" if t in _TO_END else rf"</{t}\s*+>|(<{t})\b", re.I) for t in _TO_END | _ALONE}


def read_page(page: str) -> tuple[Counter, dict[str, int], list[tuple[str, int, str]]]:
    """(tokens, first place of each, blocks); a block is (path, left out, text)."""
    tokens: Counter = Counter()
    first: dict[str, int] = {}
    found: list[tuple[str, int, int, str]] = []  # path, left out by a tag, innermost container with a name or -1, text
    stack: list[tuple[str, str, int, int]] = []  # tag, path, left out by a tag, innermost container with a name
    open_: Counter = Counter()  # tags on the stack
    named: list[tuple[int, bool, bool]] = []  # the next one outside, whether all names are wrappers', whether one is readers'
    articles: list[int] = []  # the innermost container with a name around each article
    piece: list[str] = []
    path, out, around, skip = "", 0, -1, False

    def flush() -> None:
        nonlocal skip
        if piece:
            text = " ".join("".join(piece).split())
            if text:
                found.append((path, max(out, 2 * skip), around, text))
            piece.clear()
        skip = False

    for place, (kind, m, tag) in enumerate(_tokens(page)):
        if kind == "text":
            text = m.group(4)
            piece.append(entities.unescape(text) if "&" in text else text)
            continue
        if kind == "raw":
            tokens[f"{path}/{tag}"] += 1
            continue
        close, attrs = m.group(1), m.group(3)
        if tag in BLOCKS:
            flush()
        elif tag in SPACES:
            piece.append(" ")
        if tag in CONTAINERS:
            if close:
                if open_[tag]:
                    while True:
                        last = stack.pop()
                        open_[last[0]] -= 1
                        if last[0] == tag:
                            break
                    role = "</" + last[1]
                    tokens[role] += 1
                    first.setdefault(role, place)
                    path, out, around = stack[-1][1:] if stack else ("", 0, -1)
                continue
            name = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)) if "=" in attrs else ""
            inside = open_["article"] + open_["main"] > 0
            words = [x.lower() for x in _ASIDE.findall(name)] if name and tag not in ("html", "body") else []
            if tag in ("article", "main"):
                words = [x for x in words if x in _READERS]
            elif inside:  # an article's own header, titled or not, is text
                words = [x for x in words if x != "header"]
            if tag in PARTS and tag != "form" or (tag == "header" and not inside):
                aside = 2
            else:
                aside = int(tag == "form")
            if len(stack) < DEEPEST:
                path = f"{path}/{tag}" + (f".{name}" if len(name) <= 100 else f".{_h64(name)}") * bool(name)
            if tag in ("article", "main"):
                if not inside and out == 1:
                    out = 0  # a form around the whole content
                if not words:
                    articles.append(around)
            out = max(out, aside)
            if words:
                named.append((around, all(x in WRAPPERS for x in words), any(x in _READERS for x in words)))
                around = len(named) - 1
            stack.append((tag, path, out, around))
            open_[tag] += 1
            role = "<" + path
        else:
            if not close and "=" in attrs and tag in BLOCKS:
                name = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs))
                inside = open_["article"] + open_["main"] > 0
                skip = not (inside and tag in _HEADINGS) and (_WHOLE if inside and tag == "p" else _ASIDE).search(name) is not None
            role = f"<{close}{path}>{tag}"
        tokens[role] += 1
        first.setdefault(role, place)
    flush()
    return tokens, first, _judged(found, named, articles)


def _judged(found: list[tuple[str, int, int, str]], named: list[tuple[int, bool, bool]], articles: list[int]) -> list[tuple[str, int, str]]:
    """The blocks with what their containers' names mean (1: left out if anything else is left; 2: for good)."""
    held, holds, every = [0] * (len(named) + 1), [0] * (len(named) + 1), 0  # the last is for -1
    for _, out, i, text in found:
        if out < 2:
            every += len(text)
            held[i] += len(text)
    for i in articles:
        holds[i] += 1
    for i in range(len(named) - 1, -1, -1):  # outer ones come first
        held[named[i][0]] += held[i]
        holds[named[i][0]] += holds[i]
    means = [0] * (len(named) + 1)
    for i, (outer, wrapper, readers) in enumerate(named):
        whole = holds[i] == len(articles) if articles else not readers and 2 * held[i] >= every
        means[i] = max(means[outer], 0 if whole else 1 if wrapper else 2)
    return [(path, max(out, means[i]), text) for path, out, i, text in found]


def _in_article(path: str) -> bool:
    return "/article" in path or "/main" in path


def _h64(*parts) -> int:
    x = xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


_STATS = "host string, token string, pages bigint, sig bigint, place double, size double"


def _count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        sums: dict[tuple[str, str], list] = {}
        for host, key, page in zip(b["host"], b["key"], b["html"]):
            tokens, first, blocks = read_page(page)
            size: Counter = Counter()
            for path, out, text in blocks:
                if not out:
                    size["<" + path] += len(text)
                    same = f"={path}\x00{_h64(text)}"
                    tokens[same] += 1
                    size[same] += len(text)
                if not _in_article(path):
                    tokens["#" + text if len(text) <= 200 else f"#{_h64(text)}"] += 1
            for token, n in tokens.items():
                s = sums.setdefault((host, token), [0, 0, 0.0, 0.0])
                s[0] += 1
                s[1] ^= _h64(key, n)
                s[2] += first.get(token, 0)
                s[3] += size.get(token, 0)
        yield pd.DataFrame([(h, t, *s) for (h, t), s in sums.items()],
                           columns=["host", "token", "pages", "sig", "place", "size"])


def _valid_classes(tokens: pd.DataFrame) -> list[list[tuple[float, str, float]]]:
    """Equivalence classes, each (mean place, token, text size) in order, that
    nest: widest first, a class is kept if it lies in one gap of every kept
    class that its span touches."""
    rows = tokens.assign(at=tokens["place"] / tokens["pages"])
    tags = rows[~rows["token"].str.startswith(("#", "="))]
    classes = [sorted(zip(g["at"], g["token"], g["size"])) for _, g in tags.groupby(["pages", "sig"])]
    classes.sort(key=lambda c: (c[0][0] - c[-1][0], c[0][0]))
    kept: list[list[tuple[float, str, float]]] = []
    for c in classes:
        lo, hi = c[0][0], c[-1][0]
        if all(hi < k[0][0] or lo > k[-1][0] or bisect([x[0] for x in k], lo) == bisect([x[0] for x in k], hi) for k in kept):
            kept.append(c)
    return kept


def _template(tokens: pd.DataFrame) -> pd.DataFrame:
    """The main paths and boilerplate text of one host, from its frequent tokens."""
    slots = {token[1:]: size for c in _valid_classes(tokens) for _, token, size in c
             if token.startswith("</") and not token.startswith("<//") and ">" not in token}  # paths begin with a slash
    for token, size in zip(tokens["token"], tokens["size"]):
        if token.startswith("=") and (path := token[1:].split("\x00")[0]) in slots:
            slots[path] -= size  # the same text at the same place on most pages
    if sum(slots.values()) <= 0:  # copies of one page: all text is the same
        slots = {token[1:]: size for token, size in zip(tokens["token"], tokens["size"]) if token[1:] in slots}
    held = {p: sum(s for q, s in slots.items() if q == p or q.startswith(p + "/")) for p in slots}
    total = sum(slots.values())
    main = [p for p in slots if p.rsplit("/", 1)[-1].split(".")[0] in ("article", "main") and held[p] and held[p] >= 0.2 * total]
    if not main:
        deep = [p for p in slots if held[p] and held[p] >= 0.6 * total]
        main = [max(deep, key=len)] if deep else []
    outer = sorted(p for p in main if not any(p != q and p.startswith(q + "/") for q in main))
    stale = sorted(t[1:] for t in tokens["token"] if t.startswith("#"))
    return pd.DataFrame({"host": [tokens["host"].iloc[0]], "main": [outer], "stale": [stale]})


def host_templates(pages: DataFrame, share: float = 0.5, least_pages: int = 3) -> DataFrame:
    """(host, main, stale) for every host with enough pages; ``pages`` has
    host, key (a hash that names the page) and html."""
    n = pages.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    stats = (pages.select("host", "key", "html").mapInPandas(_count_tokens, _STATS)
             .groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("sig").alias("sig"), F.sum("place").alias("place"),
                                           F.sum("size").alias("size")))
    frequent = stats.join(n, "host").filter(F.col("pages") >= share * F.col("n")).drop("n")
    return frequent.groupBy("host").applyInPandas(_template, "host string, main array<string>, stale array<string>")


def main_text(page: str, main: list[str], stale: set[str]) -> str:
    _, _, blocks = read_page(page)
    kept = [(p, t) for p, out, t in blocks if not out] or [(p, t) for p, out, t in blocks if out == 1]
    under = lambda tops: [(p, t) for p, t in kept if any(p == m or p.startswith(m + "/") for m in tops)]
    body = under(main) if main else []
    if body:  # the main slot's text stays, however often it comes again
        return "\n\n".join(t for _, t in body)
    body = [(p, t) for p, t in kept if _in_article(p)] or kept
    return "\n\n".join(t for p, t in body if _in_article(p) or not ((t if len(t) <= 200 else str(_h64(t))) in stale))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least_pages: int = 3) -> DataFrame:
    """(id, url, text, n_chars) for every row of ``pages``."""
    url = F.col(url_col)
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), host.alias("host"), text_or_empty(html_col).alias("html"))
    keyed = rows.select("host", "html", F.xxhash64("id", "url", "html").alias("key"))
    templates = cut_lineage(host_templates(keyed, least_pages=least_pages))

    @F.pandas_udf("string")
    def text(html: pd.Series, main: pd.Series, stale: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, list(m) if m is not None else [], set(s) if s is not None else set())
                          for h, m, s in zip(html, main, stale)], dtype=object)

    return (rows.join(templates, "host", "left").select(F.col("id").alias(id_col), "url", text("html", "main", "stale").alias("text"))
            .select(id_col, F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")))
