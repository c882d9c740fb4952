"""Main text of web pages through host wrappers inferred as union-free expressions.

A page is a tree of block elements with text slots (inline markup and text between two
block tags are one slot).  An expression is the same tree with items marked optional or
repeated.  Pages of a host are aligned one after the other:

- equal items in a row, or equal runs of up to three items, become one repeated item or group;
- items that only one side has become optional;
- text that differs between pages is a data slot, equal text of the shape of page furniture a
  fixed token of the template.

Text at a path is equal if it stands there on more than half of the host's different pages and
on two at least (so an advert left out of some pages is fixed, and copies of one page are not).
It is counted per host, path and text; a page of the same slots counts once.  Being equal alone is
no evidence, as articles share paragraphs, table cells and headings: a fixed token is mostly link
text, or short text without a sentence end in no paragraph, heading, list, table or quote
(``furniture``).  All other text is data, however often it stands on a host.

Expressions need no union: a child list too irregular to stay below ``MAX_ITEMS`` items
becomes one repeated group of optional items.  The result is one wrapper per host: its
expression, with the fixed tokens and the places (element paths) of the data slots.  A data
slot belongs to the main text if no element above it is boilerplate (menus, headers, footers,
sidebars, notices, adverts, forms, comments) and it lies in an article; pages with more text in
other main regions use those, and pages with neither whatever is not boilerplate.  An article or
main region of nothing but fixed tokens keeps them.

Distinct page structures are summed up per host before any grouping and merged in rounds of
bounded groups, so a host with a third of all pages is no single task's work.  Pages are only
joined with their host's wrapper; Spark broadcasts the wrappers if they are small.
"""
from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, text_blocks

MAX_ITEMS = 32  # items of a child list before it becomes a group of optional items
GROUP = 64  # expressions of a host merged in one group
FURNITURE_CHARS = 60  # the longest text outside links that can be a fixed token
STRUCTURES = 10_000  # distinct structures that a task sums up before it passes them on
SENTENCE_ENDS = tuple(".!?:;…。！？：；")
SLOT, FIXED, REPEAT = "#", "=", "()"  # a fixed token has the number of its text behind the sign

INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label
mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe".split())  # without an end tag, to the end of the page
EMBEDDED = frozenset("template svg math object select button canvas audio video".split())  # left out if closed
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
BOILERPLATE_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs
comment comments consent cookie cookies disclaimer footer gdpr login menu modal nav navbar navigation newsletter
notice notification pagination popup promo promotion related reply replies respond share sharing sidebar signup
social sponsor sponsored subscribe subscription toolbar topbar widget widgets colophon commentlist main-menu
main-nav main-navigation masthead page-footer site-footer site-header site-nav site-navigation skip-link""".split())
MAIN_NAMES = frozenset("""article article-body article-content content entry entry-content main main-content
page-content post post-body post-content story story-body""".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond".split())
CLOSES_PARAGRAPH = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2
h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table body article main section div".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""",
                    re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


# pages as trees -----------------------------------------------------------------------------

def _symbol(tag: str, attributes: str, in_article: bool) -> str:
    """The tag, with "!" for boilerplate ("?" or, for comments, "??" if only a name says so) and
    "*" for a main region."""
    names, roles = [], []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        words = "".join(values).lower().split()
        (roles if kind.lower() == "role" else names).extend(words)
    if tag in ("html", "body"):
        return tag
    listed = {n if n in BOILERPLATE_NAMES else re.split("[-_]", n)[0] for n in names} & BOILERPLATE_NAMES
    header = any(n == "header" or n.startswith(("header-", "header_")) for n in names)
    if tag in BOILERPLATE_TAGS or any(r in BOILERPLATE_ROLES for r in roles) or tag == "header" and not in_article:
        return tag + "!"
    if listed or header and not in_article:
        return tag + ("!" if tag in INLINE else "??" if listed & COMMENT_NAMES else "?")
    if tag not in INLINE and (tag == "main" or "main" in roles or any(n in MAIN_NAMES for n in names)):
        return tag + "*"
    return tag


def _embedded_end(html: str, tag: str, at: int) -> int:
    """Where an embedded element ends that starts before ``at``; ``at`` itself if it is not closed
    before the next one (of buttons and selects), an article or main region, or the page's end."""
    depth = 1
    for found in re.compile(rf"<(/?)({tag}|article|main|body)(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).finditer(html, at):
        closing, name = found[1], found[2].lower()
        if name == tag:
            depth += -1 if closing else 0 if found[0].endswith("/>") else 1
            if not depth:
                return found.end()
            if tag in ("button", "select"):
                return at
        elif tag != "template" and (not closing or name == "body"):
            return at
    return at


def _shown(out: list, named: list[str]) -> set[int]:
    """Which of the elements that only a name hides are shown after all: one with more text in
    articles than the page's main regions have besides, and if those have none, one with more than half
    of the text.  Comments only show on pages without other main text.

    ``out`` has (elements above, text) with an element as (symbol, place in ``named`` or None)."""
    total = main = 0
    inside, articles = [0] * len(named), [0] * len(named)
    for path, text in out:
        if not text:
            continue
        total += len(text)
        ids = [(depth, k) for depth, (_, k) in enumerate(path) if k is not None]
        main += len(text) * (not ids and region(tuple(s for s, _ in path)) > 0)
        last = max((d for d, (s, _) in enumerate(path) if s.rstrip("*?") == "article"), default=-1)
        for depth, k in ids:
            inside[k] += len(text)
            articles[k] += len(text) * (depth <= last)
    return {k for k, symbol in enumerate(named)
            if (not main or not symbol.endswith("??")) and (articles[k] > main or not main and 2 * inside[k] > total)}


def slots(html: str | None) -> list[tuple[tuple[str, ...], str]]:
    """The text slots of a page in order: (symbols of the elements above, text).

    Character references are decoded and white space runs become one space.  The last symbol
    of a slot with mostly link text is "a".  Slots under boilerplate are left out; their outermost element stays, as a slot without text.  A name
    does not hide the element with the article or most of the text (see ``_shown``)."""
    html = html or ""
    path: list[tuple[str, str, int | None]] = []  # (tag, symbol, place in named)
    out, text, links, at, hidden, named, link = [], [], [], 0, 0, [], False

    def flush():
        joined = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if joined and not hidden:
            mostly = links and 2 * len(" ".join(entities.unescape("".join(links)).split())) > len(joined)
            out.append((tuple((s, k) for _, s, k in path) + ((("a", None),) if mostly else ()), joined))
        links.clear()

    def pop(n: int):
        nonlocal hidden
        flush()
        while len(path) > n:
            hidden -= path.pop()[1].endswith("!")

    while token := _TOKEN.search(html, at):
        text.append(html[at:token.start()])
        if link:
            links.append(text[-1])
        at = token.end()
        closing, tag, attributes = token.groups()
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            link = not closing
        if tag == "br":
            text.append(" ")
        elif closing:
            if tag not in INLINE or any(x[0] == tag for x in path):
                flush()
                for n in range(len(path) - 1, -1, -1):
                    if path[n][0] == tag:
                        pop(n)
                        break
        elif tag in RAW:
            flush() if tag not in INLINE else None
            if not attributes.endswith("/"):
                stop = r"|(?=</head\b|<body\b)" if tag in ("title", "noscript") else ""
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z){stop}", re.IGNORECASE).search(html, at)
                end = end or re.compile(r"</head\b|<body\b", re.IGNORECASE).search(html, at)
                at = len(html) if not end else end.start() if end[0][1:2] == "b" or end[0][:3] == "</h" else end.end()
        elif tag in EMBEDDED:
            flush() if tag not in INLINE else None
            if not attributes.endswith("/"):
                at = _embedded_end(html, tag, at)
        elif tag == "head":  # its elements hold no text; whatever else begins, begins the body
            flush()
        else:
            symbol = _symbol(tag, attributes, any(x[0] == "article" for x in path))
            if tag in INLINE and not symbol.endswith("!"):
                continue
            flush()
            if tag in VOID or attributes.endswith("/"):
                continue
            if tag in CLOSES_PARAGRAPH:
                for n in range(len(path) - 1, -1, -1):
                    if path[n][0] == "p":
                        pop(n)
                        break
                    if path[n][0] in SCOPES:
                        break
            for n in range(len(path) - 1, -1, -1):
                if path[n][0] in SIBLINGS.get(tag, ()):
                    pop(n)
                elif path[n][0] in SCOPES:
                    break
            path.append((tag, symbol, len(named) if symbol.endswith("?") else None))
            if symbol.endswith("?"):
                named.append(symbol)
            if symbol.endswith(("!", "?")):
                if not hidden:
                    out.append((tuple((s, k) for _, s, k in path), ""))
                hidden += symbol.endswith("!")
    text.append(html[at:])
    if link:
        links.append(text[-1])
    flush()
    if not named:
        return [(tuple(s for s, _ in above), joined) for above, joined in out]
    shown, left, last = _shown(out, named), [], None
    for above, joined in out:
        cut = next((d for d, (s, k) in enumerate(above) if k is not None and k not in shown), None)
        if cut is not None:
            if above[cut][1] != last:
                left.append((tuple(s.rstrip("?") for s, _ in above[:cut]) + (above[cut][0].rstrip("?") + "!",), ""))
            last = above[cut][1]
        elif joined or above[-1][1] is None:
            left.append((tuple(s.rstrip("?") for s, _ in above), joined))
    return left


def furniture(path: tuple[str, ...], text: str) -> bool:
    """Whether a text has the shape of a template's: mostly link text, or short, without a
    sentence end and in no element of running text."""
    if path and path[-1] == "a":
        return True
    return (0 < len(text) <= FURNITURE_CHARS and not text.endswith(SENTENCE_ENDS)
            and CONTENT.isdisjoint(s.rstrip("*") for s in path))


def slot_key(path: tuple[str, ...], text: str) -> int:
    """A number for a text at a path."""
    whole = "\x1f".join((*path, text)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "big", signed=True)


# expressions -----------------------------------------------------------------------------------
# an item is (symbol, optional, repeated, items below)

def _children(found: list[tuple], depth: int = 0, fixed=frozenset()) -> list[tuple]:
    """The tree of slots (path, text or its number) as items: neighbours below the same symbol
    share an element; what is in ``fixed`` becomes a fixed token."""
    out, k = [], 0
    while k < len(found):
        path = found[k][0]
        if len(path) == depth:
            out.append((f"{FIXED}{found[k][1]}" if found[k][1] in fixed else SLOT, False, False, ()))
            k += 1
            continue
        end = k + 1
        if path[depth] not in LEAVES:
            while end < len(found) and len(found[end][0]) > depth and found[end][0][depth] == path[depth]:
                end += 1
        if path[depth].endswith("!"):
            out.append((path[depth], False, False, ()))
        else:
            out.append((path[depth], False, False, tuple(_children(found[k:end], depth + 1, fixed))))
        k = end
    return fold(out)


#: elements whose slots are elements of their own, side by side
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 td th dt dd".split())
#: elements of running text
CONTENT = LEAVES | frozenset("pre blockquote caption figcaption address details summary".split())


def fold(items: list[tuple]) -> list[tuple]:
    """Equal neighbours, and equal runs of two or three items, as repeated items."""
    for period in (1, 2, 3):
        out: list[tuple] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period and ([x[0] for x in out[-period:]]
                                              == [x[0] for x in out[-2 * period:-period]]):
                if period == 1:
                    merged = _merge(out[-2], out[-1])
                    out[-2:] = [(merged[0], merged[1], True, merged[3])]
                else:
                    pairs = zip(out[-2 * period:-period], out[-period:])
                    out[-2 * period:] = [(REPEAT, False, True, tuple(_merge(a, b) for a, b in pairs))]
            if period > 1 and len(out) > period and out[-period - 1][0] == REPEAT and (
                    [x[0] for x in out[-period - 1][3]] == [x[0] for x in out[-period:]]):
                group = out[-period - 1]
                below = tuple(_merge(a, b) for a, b in zip(group[3], out[-period:]))
                out[-period - 1:] = [(REPEAT, group[1], True, below)]
        items = out
    if len(items) > MAX_ITEMS:
        flat = [x for item in items for x in (item[3] if item[0] == REPEAT else [item])]
        kinds: dict[str, tuple] = {}
        for x in flat:
            kinds[x[0]] = _merge(kinds[x[0]], x) if x[0] in kinds else x
        items = [(REPEAT, False, True, tuple((s, True, r, below) for s, _, r, below in kinds.values()))]
    return items


def _merge(a: tuple, b: tuple) -> tuple:
    return (a[0], a[1] or b[1], a[2] or b[2], tuple(align(list(a[3]), list(b[3]))))


def align(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """Two item lists as one: the longest common subsequence of symbols is kept, the rest
    becomes optional."""
    if a == b:
        return a
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            size[i][j] = (size[i + 1][j + 1] + 1 if a[i][0] == b[j][0]
                          else max(size[i + 1][j], size[i][j + 1]))
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and size[i + 1][j] >= size[i][j + 1]:
            out.append((a[i][0], True, *a[i][2:]))
            i += 1
        else:
            out.append((b[j][0], True, *b[j][2:]))
            j += 1
    return fold(out)


def _tuples(items: list) -> list[tuple]:
    return [(s, o, r, tuple(_tuples(below))) for s, o, r, below in items]


def slot_paths(items, above: tuple = ()) -> set[tuple[str, ...]]:
    """Element paths of an expression's data slots, boilerplate left out."""
    out: set = set()
    for symbol, _, _, below in items:
        if symbol == SLOT:
            out.add(above)
        elif not symbol.endswith("!"):
            out |= slot_paths(below, above if symbol == REPEAT else (*above, symbol))
    return out


def fixed_keys(items) -> set[int]:
    """Numbers of an expression's fixed tokens."""
    out: set = set()
    for symbol, _, _, below in items:
        if symbol.startswith(FIXED):
            out.add(int(symbol[len(FIXED):]))
        out |= fixed_keys(below)
    return out


def main_slots(found: list[tuple[tuple[str, ...], str]], data: list[bool] | None = None) -> list[str]:
    """The texts of the articles, or of the main regions if those hold more text besides
    (a teaser may be an article too), or of all slots if there are neither; of these the ``data``
    slots (all, if not given), but a region without any is kept."""
    size = [0, 0, 0]
    for path, text in found:
        size[region(path)] += len(text)
    least = 2 if size[2] and size[2] >= size[1] else 1 if size[1] else 0
    inside = [least != 1 and region(path) >= least or least == 1 and any(s.endswith("*") for s in path) for path, _ in found]
    if data is not None:
        kept = [a and b for a, b in zip(inside, data)]
        inside = kept if any(kept) or not least else inside
    return [text for (_, text), here in zip(found, inside) if here]


def region(path: tuple[str, ...]) -> int:
    """2 in an article, 1 in another main region, 0 elsewhere."""
    if any(s.rstrip("*") == "article" for s in path):
        return 2
    return int(any(s.endswith("*") for s in path))


# Spark ---------------------------------------------------------------------------------------------

def host(url: Column) -> Column:
    """The host of a url in lower case, "" if it has none."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
    return F.coalesce(F.lower(F.regexp_extract(url, pattern, 1)), F.lit(""))


def _slot_task(batches):
    """(host, page, keys, candidates, paths): the slots of a page as numbers of path and text, those
    of them that may be fixed, and their paths (JSON); page is the number of them all."""
    for part, pages in text_blocks(batches, "html"):
        rows = []
        for name, page in zip(part.column(1).to_pylist(), pages):
            found = slots(page)
            keys = [slot_key(path, text) for path, text in found]
            candidates = list({key for key, (path, text) in zip(keys, found) if furniture(path, text)})
            kinds = {path: k for k, path in enumerate(dict.fromkeys(path for path, _ in found))}
            paths = json.dumps([list(kinds), [kinds[path] for path, _ in found]])
            rows.append((name, slot_key((), json.dumps(keys)), keys, candidates, paths))
        hosts, numbers, keys, candidates, paths = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(numbers, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
             pa.array(candidates, pa.list_(pa.int64())), pa.array(paths, pa.string())],
            names=["host", "page", "keys", "candidates", "paths"])


def _structure_task(batches):
    """(host, expression, pages): the distinct structures of a host, summed up as far as
    ``STRUCTURES`` of a task."""
    found: Counter = Counter()

    def summed():
        hosts, expressions = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(expressions), pa.array(list(found.values()))],
                                          names=["host", "expression", "pages"])
    for batch in batches:
        for name, keys, paths, fixed in zip(*(c.to_pylist() for c in batch.columns)):
            kinds, at = json.loads(paths)
            rows = [(tuple(kinds[k]), key) for k, key in zip(at, keys)]
            found[name, json.dumps(_children(rows, fixed=frozenset(fixed or ())))] += 1
        if len(found) >= STRUCTURES:
            yield summed()
            found.clear()
    if found:
        yield summed()


def _merge_group(key, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["pages", "expression"], ascending=[False, True])
    merged: list[tuple] | None = None
    for expression in rows["expression"]:
        items = _tuples(json.loads(expression))
        merged = items if merged is None else align(merged, items)
    return pd.DataFrame({"host": [key[0]], "expression": [json.dumps(merged)], "pages": [rows["pages"].sum()]})


def _fixed_texts(seen: DataFrame) -> DataFrame:
    """(host, fixed): numbers of the candidates that are equal on most pages ``seen`` of a host."""
    sizes = seen.groupBy("host").agg(F.count("*").alias("pages")).where("pages > 1")
    counts = (seen.select("host", F.explode("candidates").alias("key"))
              .groupBy("host", "key").agg(F.count("*").alias("n")).where("n > 1"))
    return (counts.join(sizes, "host").where(2 * F.col("n") > F.col("pages"))
            .groupBy("host").agg(F.collect_list("key").alias("fixed")))


def infer(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, expression, pages): one wrapper per host of ``pages(host, html)``, in rounds of bounded groups."""
    schema = "host string, expression string, pages long"
    seen = scratch.keep(
        pages.select(F.lit(0).alias("at"), "host", "html")
        .mapInArrow(_slot_task, "host string, page long, keys array<long>, candidates array<long>, paths string")
        .dropDuplicates(["host", "page"]), "slots")
    fixed = scratch.keep(_fixed_texts(seen), "fixed")
    found = scratch.keep(
        seen.join(fixed, "host", "left").select("host", "keys", "paths", "fixed")
        .mapInArrow(_structure_task, schema)
        .groupBy("host", "expression").agg(F.sum("pages").alias("pages")), "wrappers-0")
    turn = 0
    while True:
        sizes = found.groupBy("host").agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= 1:
            return found
        turn += 1
        bucket = F.pmod(F.xxhash64("expression"), F.ceil(F.col("n") / GROUP)).alias("bucket")
        found = scratch.keep(found.join(sizes, "host").select("host", "expression", "pages", bucket)
                             .groupBy("host", "bucket").applyInPandas(_merge_group, schema), f"wrappers-{turn}")


def _place_task(batches):
    """(host, places): as JSON, the paths of a wrapper's data slots and the numbers of its fixed texts."""
    for batch in batches:
        out = []
        for expression in batch.column(1).to_pylist():
            items = _tuples(json.loads(expression))
            out.append(json.dumps([sorted(slot_paths(items)), sorted(fixed_keys(items))]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["host", "places"])


def page_text(page: str | None, places: set, fixed: set) -> str:
    """The main text of a page by its host's wrapper."""
    found = [(path, text) for path, text in slots(page) if text]
    data = [path in places and not (furniture(path, text) and slot_key(path, text) in fixed) for path, text in found]
    return "\n\n".join(main_slots(found, data))


def _text_task(batches):
    known: dict[str, tuple] = {}
    for part, pages in text_blocks(batches, "html"):
        out = []
        for page, places in zip(pages, part.column(3).to_pylist()):
            if places not in known:
                if len(known) > 1000:
                    known.clear()
                paths, fixed = json.loads(places)
                known[places] = {tuple(p) for p in paths}, set(fixed)
            out.append(page_text(page, *known[places]))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string())],
                                         names=["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``.

    A null or empty page, or one without main text, has an empty text; so has one without an article
    or main region that holds nothing but its host's fixed texts.  A null or unreadable url counts as
    the host "".  Repeated rows come back repeated; other columns are ignored; an empty table gives
    no rows."""
    scratch = Scratch(pages.sparkSession, "wrappers")
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        F.col("html").cast("string").alias("html"), host(url).alias("host"))
    places = scratch.keep(infer(rows, scratch).select("host", "expression")
                          .mapInArrow(_place_task, "host string, places string"), "places")
    joined = rows.join(places, "host").select("page_id", "url", "html", "places")
    return (joined.mapInArrow(_text_task, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))


def op5_union_free_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
