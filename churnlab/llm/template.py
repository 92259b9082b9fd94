"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: start tags (with class, id and role), end tags
and text nodes.  Tokens whose occurrence vectors over the pages of one host are
equal form an equivalence class.  A class that occurs on many pages, in one
order, instance after instance, and whose instances lie within one slot of the
class around it, belongs to the host's template if its tags also frame the
page; a passage that many pages share does not.  What no template class holds
is in the slots.  The slots of which template element hold a host's text is
counted over its pages: the innermost element of the template that holds nearly
all text of the slots is the host's region, and its slots, without boilerplate
elements, are the main text.  Where such elements nest, an article or main
element is taken before one inside it.  Copies of a page count as one page.

Vectors are never built: a token's vector is known by its number of pages and
an order-free sum of hashes of (page, count), which Spark adds up map-side.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stage

# Fixed values of HTML: elements without content, and with raw text content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# Elements, and words of a class, id or role, that hold no main text.
BOILERPLATE = frozenset(
    "nav header footer aside form script style textarea title noscript template iframe head button "
    "select svg canvas object dialog menu".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notices "
    "gdpr menu nav navbar navigation breadcrumb breadcrumbs sidebar aside header masthead footer comment "
    "comments disqus reply replies share sharing social related recommended newsletter subscribe signup login "
    "search popup modal complementary contentinfo toolbar".split()
)
MAIN = frozenset(("article", "main"))
FRAME = frozenset(("html", "head", "body"))
# Elements of one block: none of them is the region of a host.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote figure figcaption caption option".split())
# What an outermost article may be besides the text: its class words count no more.
ITEM_WORDS = frozenset("ad ads advert adverts advertisement comment comments disqus reply replies related recommended".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def tokens_of(page: str | None) -> list[tuple[str, str, str]]:
    """(kind, name, detail) of a page in order: ("<", tag, attributes),
    (">", tag, "") or ("", "", text).  Comments and declarations are skipped;
    the content of script-like elements is one raw text."""
    page, out, at = page or "", [], 0
    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text.strip():
            out.append(("", "", text))
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            out.append((">", name, ""))
            continue
        detail = " ".join(
            f"{k.lower()}={(a or b or c).lower()}" for k, a, b, c in _ATTRIBUTE.findall(m[3])
        ) if m[3] else ""
        out.append(("<", name, detail))
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            end = close.start() if close else len(page)
            if page[at:end].strip():
                out.append(("raw", name, page[at:end]))
            at = close.end() if close else len(page)
            out.append((">", name, ""))
    return out


def code_of(token: tuple[str, str, str]) -> int:
    """Signed 64-bit code of a token; text counts with its white space joined."""
    kind, name, detail = token
    if kind in ("", "raw"):
        detail = " ".join(detail.split())
    return xxhash.xxh3_64_intdigest(f"{kind}\0{name}\0{detail}".encode("utf-8", "replace")) - 2**63


def _is_boilerplate(name: str, detail: str, words: frozenset[str] = BOILERPLATE_WORDS) -> bool:
    """Whether an element is boilerplate by its name, or by a whole word of its
    class, id or role; of a compound (cookie-notice) every part must be one."""
    if name in BOILERPLATE:
        return True
    for value in detail.split():
        if value.startswith(("class=", "id=", "role=")):
            value = value.partition("=")[2]
        found = _WORD.findall(value)
        if found and words.issuperset(found):
            return True
    return False


def template_codes(codes: list[int], classes: dict[int, list[int]]) -> set[int]:
    """Codes that the template holds on this page.

    ``classes`` maps a class to its codes in template order.  A class is valid
    here if its codes occur in that order, instance after instance, and each
    instance that is not the first of its slot stays in the slot of the larger
    class around it (no token of that class parts an instance).
    """
    owner = {c: k for k, members in classes.items() for c in members}
    rank = {c: i for members in classes.values() for i, c in enumerate(members)}
    seen: dict[int, list[tuple[int, int]]] = {}
    for at, c in enumerate(codes):
        if c in owner:
            seen.setdefault(owner[c], []).append((at, rank[c]))
    valid: set[int] = set()
    spots: list[list[int]] = []  # places of the valid classes found so far
    for k in sorted(seen, key=lambda k: (len(seen[k]) // max(len(classes[k]), 1), -len(classes[k]), k)):
        size, found = len(classes[k]), seen[k]
        if any(r != i % size for i, (_, r) in enumerate(found)) or len(found) % size:
            continue
        if size > 1 and any(
            sum(first < p < last for p in outer) not in (0, len(outer))
            for outer in spots
            for first, last in ((found[i][0], found[i + size - 1][0]) for i in range(0, len(found), size))
        ):
            continue
        valid.add(k)
        spots.append([at for at, _ in found])
    return {c for c, k in owner.items() if k in valid}


def framing_classes(tokens: list[tuple[str, str, str]], codes: list[int], owner: dict[int, int]) -> set[int]:
    """Classes that frame this page: one of their elements, not inside an
    article or main element, is html, head or body or holds text of others."""
    framing: set[int] = set()
    stack: list[tuple[str, int | None, bool]] = []  # name, class if it may frame, main inside
    opened: dict[int, int] = {}  # open elements of the classes not yet known to frame
    for (kind, name, _), code in zip(tokens, codes):
        if kind == "":
            if opened:
                found = opened.keys() - {owner.get(code)}
                framing |= found
                for k in found:
                    del opened[k]
        elif kind == "<" and name not in VOID:
            main = bool(stack) and stack[-1][2]
            k = None if main else owner.get(code)
            if k is not None and k not in framing:
                if name in FRAME:
                    framing.add(k)
                    opened.pop(k, None)
                else:
                    opened[k] = opened.get(k, 0) + 1
            stack.append((name, k, main or name in MAIN))
        elif kind == ">" and any(s[0] == name for s in stack):
            while True:
                last, k, _ = stack.pop()
                if k in opened:
                    opened[k] -= 1
                    if not opened[k]:
                        del opened[k]
                if last == name:
                    break
    return framing


class Open(NamedTuple):
    """An open element, and what holds inside it."""

    name: str
    code: int
    dull: bool  # boilerplate
    main: bool  # an article or main element outside boilerplate
    article: bool
    inside: bool  # the region, if there is one


def _walk(
    tokens: list[tuple[str, str, str]], codes: list[int], item_words: frozenset[str], region: int | None = None
) -> Iterator[tuple[tuple[str, str, str], int, list[Open]]]:
    """Tokens with their codes and the elements open after them, the page first.

    Class words don't make html, body or main boilerplate, and only
    ``item_words`` an outermost article.
    """
    stack = [Open("", 0, False, False, False, region is None)]
    for token, code in zip(tokens, codes):
        kind, name, detail = token
        if kind == "<" and name not in VOID:
            if name == "p" and stack[-1].name == "p":
                stack.pop()
            _, _, dull, main, article, inside = stack[-1]
            if name in FRAME or name == "main":
                out = name in BOILERPLATE
            elif name == "article" and not article:
                out = _is_boilerplate(name, detail, item_words)
            else:
                # the header of an article holds its title, a page's header does not
                out = _is_boilerplate(name, detail) and not (name == "header" and main and not dull)
            inner = name in MAIN and not (dull or out)
            stack.append(Open(name, code, dull or out, main or inner, article or name == "article", inside or code == region))
        elif kind == ">" and any(s.name == name for s in stack):
            # an end tag closes what was left open in its element
            while stack.pop().name != name:
                pass
        yield token, code, stack


def _template_of(tokens: list[tuple[str, str, str]], codes: list[int], classes: dict[int, list[int]]) -> set[int]:
    """Codes of the valid classes that frame the page."""
    if not classes:
        return set()
    owner = {c: k for k, members in classes.items() for c in members}
    framing = framing_classes(tokens, codes, owner)
    return {c for c in template_codes(codes, classes) if owner[c] in framing}


def slot_masses(
    page: str | None, classes: dict[int, list[int]], rare: frozenset[int] | set[int] = frozenset()
) -> dict[int, list[int]]:
    """Text of the slots by template element: code to [characters, place, named].

    Counted are the characters outside links, boilerplate elements and the
    template, but for its ``rare`` texts; an element has those of all slots
    within it, code 0 those of the page.  Elements are known by a start tag that the template holds once on
    the page; ``named`` is 1 for article and main.
    """
    tokens = tokens_of(page)
    codes = [code_of(t) for t in tokens]
    template = _template_of(tokens, codes, classes)
    if not template:
        return {}
    times: dict[int, int] = {}
    for c in codes:
        times[c] = times.get(c, 0) + 1
    found = {0: [0, 0, 0]}
    for place, ((kind, name, detail), code, stack) in enumerate(_walk(tokens, codes, ITEM_WORDS)):
        if kind == "<" and not any(name in names for names in (VOID, INLINE, BLOCKS, FRAME)):
            if code in template and times[code] == 1 and not stack[-1].dull:
                found[code] = [0, place, int(name in MAIN)]
        elif kind == "" and (code in rare or code not in template) and not stack[-1].dull and all(s.name != "a" for s in stack):
            size = len("".join(detail.split()))
            found[0][0] += size
            for s in stack[1:]:
                if s.code in found:
                    found[s.code][0] += size
    return found


def main_text(
    page: str | None,
    classes: dict[int, list[int]],
    region: int | None = None,
    rare: frozenset[int] | set[int] = frozenset(),
) -> str:
    """Main text of one page: the blocks of the slots of the region (the code of
    its start tag), one a line.  Of a page without the region, or with no text
    in it, all slots count.  Texts of the template that are ``rare`` stay where
    they are inside the region, an article or a main element."""
    tokens = tokens_of(page)
    codes = [code_of(t) for t in tokens]
    template = _template_of(tokens, codes, classes)
    found: list[str] = []
    if region in template and codes.count(region) == 1:
        found = _blocks(tokens, codes, template, ITEM_WORDS, region, rare)
    if not found:
        found = _blocks(tokens, codes, template, ITEM_WORDS, None, rare)
    if not found and any(k == "<" and n == "article" for k, n, _ in tokens):
        found = _blocks(tokens, codes, template, frozenset(), None, rare)  # the only text is in such articles
    return "\n".join(found)


def _blocks(
    tokens: list[tuple[str, str, str]],
    codes: list[int],
    template: set[int],
    item_words: frozenset[str],
    region: int | None,
    rare: frozenset[int] | set[int],
) -> list[str]:
    """Blocks of the main text: those of the region, or of the page without one;
    of its articles and main elements not inside boilerplate, if there are any.
    A title (h1) before a region that has none goes with it."""
    has_main = has_title = False
    # blocks of the whole scope, of its articles and main elements, and titles before the region
    blocks: list[list[str]] = [[]]
    mains: list[list[str]] = [[]]
    titles: list[list[str]] = [[]]
    begun = region is None
    for (kind, name, detail), code, stack in _walk(tokens, codes, item_words, region):
        _, _, dull, main, _, inside = stack[-1]
        if kind == "":
            kept = code not in template or (code in rare and (main or (inside and region is not None)))
            if dull or not kept:
                continue
            if inside:
                blocks[-1].append(detail)
                if main:
                    mains[-1].append(detail)
            elif not begun and any(s.name == "h1" for s in stack):
                titles[-1].append(detail)
            continue
        if kind == "raw":
            continue
        if name not in INLINE:
            for found in (blocks, mains, titles):
                found.append([])
        elif name == "br":
            for found in (blocks, mains, titles):
                found[-1].append(" ")
        if kind == "<" and name not in VOID and inside:
            begun = True
            has_main = has_main or main
            has_title = has_title or name == "h1"
    chosen = mains if has_main else blocks
    joined = (" ".join(html.unescape("".join(b)).split()) for b in (chosen if has_title else titles + chosen))
    return [b for b in joined if b]


def _occurrences(batches):
    for batch in batches:
        rows = []
        for host, page in zip(batch["host"], batch["html"]):
            mark = xxhash.xxh3_64_intdigest((page or "").encode("utf-8", "replace")) - 2**63
            counts: dict[int, list[int]] = {}
            for at, t in enumerate(tokens_of(page)):
                counts.setdefault(code_of(t), [0, at])[0] += 1
            rows.append((host, mark, list(counts), [n for n, _ in counts.values()], [at for _, at in counts.values()]))
        yield pd.DataFrame(rows, columns=["host", "mark", "code", "n", "at"])


def _classes(found, least_pages: int) -> tuple[dict[int, list[int]], set[int]]:
    """Classes of a host's row, and the codes on fewer than ``least_pages`` pages."""
    classes: dict[int, list[int]] = {}
    rare: set[int] = set()
    for r in found if found is not None else ():
        classes.setdefault(r["cls"], []).append(r["code"])
        if r["seen"] < least_pages:
            rare.add(r["code"])
    return classes, rare


def _masses(least_pages: int):
    def run(batches):
        for batch in batches:
            rows = []
            for host, page, row in zip(batch["host"], batch["html"], batch["classes"]):
                found = slot_masses(page, *_classes(row, least_pages))
                mark = xxhash.xxh3_64_intdigest((page or "").encode("utf-8", "replace")) - 2**63
                columns = zip(*found.values()) if found else ([], [], [])
                rows.append((host, mark, list(found), *map(list, columns)))
            yield pd.DataFrame(rows, columns=["host", "mark", "code", "mass", "at", "named"])

    return run


def _extract(least_pages: int):
    def run(batches):
        for batch in batches:
            texts = []
            for page, row, region in zip(batch["html"], batch["classes"], batch["region"]):
                classes, rare = _classes(row, least_pages)
                texts.append(main_text(page, classes, region or None, rare))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    return run


def host_of(url):
    """Host of a URL in lower case; '' without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def deduce_templates(pages: DataFrame, support: float = 0.5) -> DataFrame:
    """(host, classes): a host's equivalence classes with at least two tokens,
    in the order of their tokens, each with its number of pages (seen).

    A class must be on one page more than a share of ``support`` of the host's
    different pages: on both of two, on five of eight, on 51 of 100.  Copies of
    a page count as one; a host with a single page has no row.
    """
    counted = (
        pages.mapInPandas(_occurrences, "host string, mark long, code array<long>, n array<long>, at array<long>")
        .dropDuplicates(["host", "mark"])
        .select("host", "mark", F.inline(F.arrays_zip("code", "n", "at")))
    )
    hosts = (
        pages.groupBy(F.col("host").alias("h"))
        .agg(F.count_distinct(F.xxhash64(F.coalesce("html", F.lit("")))).alias("pages"))
        .where("pages > 1")
    )
    vectors = counted.groupBy("host", "code").agg(
        F.count(F.lit(1)).alias("seen"),
        F.sum(F.xxhash64("mark", "n").cast("decimal(20,0)")).alias("vector"),
        F.avg("at").alias("place"),
    )
    frequent = vectors.where("seen >= 2").join(hosts, F.col("host") == F.col("h")).where(
        F.col("seen") >= F.col("pages") * support + 1
    )
    ordered = F.sort_array(F.collect_list(F.struct("place", "code")))
    return (
        frequent.groupBy("host", "seen", "vector")
        .agg(ordered.alias("members"))
        .where(F.size("members") > 1)
        .select("host", "seen", F.xxhash64("seen", "vector").alias("cls"), F.explode("members").alias("m"))
        .groupBy(F.col("host").alias("h"))
        .agg(F.sort_array(F.collect_list(F.struct("cls", "m.place", "m.code", "seen"))).alias("classes"))
    )


def choose_regions(pages: DataFrame, templates: DataFrame, least_pages: int = 8, percent: int = 80) -> DataFrame:
    """(host, region): the start tag of a host's region.

    It is the innermost template element that holds ``percent`` % or more of
    the text of the host's slots (``slot_masses``); elements that do so nest,
    and an article or main element goes before the others.  Every different
    page counts once.  A host without text in its slots has no row.
    """
    masses = (
        pages.join(templates, F.col("host") == F.col("h"))
        .select("host", "html", "classes")
        .mapInPandas(
            _masses(least_pages), "host string, mark long, code array<long>, mass array<long>, at array<long>, named array<long>"
        )
        .dropDuplicates(["host", "mark"])
        .select("host", F.inline(F.arrays_zip("code", "mass", "at", "named")))
    )
    sums = stage(
        masses.groupBy("host", "code").agg(
            F.sum("mass").alias("mass"), F.avg("at").alias("place"), F.max("named").alias("named")
        ),
        "masses",
    )
    totals = sums.where("code = 0 and mass > 0").select(F.col("host").alias("th"), F.col("mass").alias("total"))
    return (
        sums.where("code <> 0")
        .join(totals, F.col("host") == F.col("th"))
        .where(F.col("mass") * 100 >= F.col("total") * percent)
        .groupBy(F.col("host").alias("rh"))
        .agg(F.max(F.struct("named", "place", "code"))["code"].alias("region"))
    )


def extract_main_text(pages: DataFrame, support: float = 0.5, least_pages: int = 8, percent: int = 80) -> DataFrame:
    """Main text of every page (page_id, url, html; other columns are ignored).

    Returns page_id, url, ``text`` and ``n_chars`` (code points).  Blocks are
    in page order, one a line, white space joined, character references
    decoded; nothing else is cut.  A null or empty html, or one without main
    text, has the empty text.  A page without its host's region has the text of
    its articles and main elements outside boilerplate, without those that of
    the whole body.  Two different pages of a host make a template; a text
    inside the region, an article or a main element belongs to it only if
    ``least_pages`` different pages have it, as two articles may share a
    passage.  A host with one page has no template, its boilerplate elements
    still go.  Pages with a null url are one host ''.  Repeated pages are
    extracted each; no rows give no rows.
    """
    prepare(pages.sparkSession)
    known = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    templates = stage(deduce_templates(known, support), "templates")
    regions = stage(choose_regions(known, templates, least_pages, percent), "regions")
    hosts = templates.join(regions, F.col("h") == F.col("rh"), "left").select("h", "classes", "region")
    joined = known.join(hosts, F.col("host") == F.col("h"), "left")
    return (
        joined.select("page_id", "url", "html", "classes", F.coalesce("region", F.lit(0)).alias("region"))
        .mapInPandas(_extract(least_pages), "page_id long, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
