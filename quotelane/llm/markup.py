"""Blocks of text of a web page, with the structure around them. A small helper without Spark."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML: elements whose content is no markup, elements that start a block, and what an
# opening tag closes.
_RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
_BLOCKS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav object ol optgroup
    option p pre search section select summary svg table tbody td template tfoot th thead tr ul video audio canvas math""".split()
)
_VOID = frozenset("hr br img input meta link area base col embed source track wbr param".split())
_CLOSES = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th", "table"),
    "tfoot": ("tbody thead tfoot tr td th", "table"),
    "option": ("option", "select"),
    "optgroup": ("option optgroup", "select"),
}
_CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _CLOSES.items()}

# What marks a part of a page as not its text, or as its text.
_ASIDE_TAGS = frozenset(
    "nav aside footer form button select dialog menu search head object svg template video audio canvas math fieldset".split()
)
_ASIDE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promos promotion nav
    navigation navbar menu menus breadcrumb breadcrumbs sidebar sidebars rail footer cookie cookies consent gdpr notice
    notices popup modal overlay comment comments commentlist disqus replies respond share sharing social related
    recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar pager
    pagination copyright masthead topbar skip""".split()
)
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_REMARKS = frozenset("comment comments commentlist disqus replies respond".split())
_TEXT_WORDS = frozenset("article content post entry story main body text".split())

ARTICLE, MAIN, TEXT, NONE = 3, 2, 1, 0


class Element(NamedTuple):
    tag: str
    path: str
    level: int  # ARTICLE, MAIN or TEXT: what the element or one around it says of its content
    aside: bool
    remarks: bool


class Block(NamedTuple):
    text: str
    element: Element
    linked: int  # characters of the text within links


def _element(tag: str, rest: str, above: Element) -> Element:
    given = {}
    if rest and not rest.isspace():
        for name, a, b, c in _ATTRIBUTE.findall(rest):
            given.setdefault(name.lower(), a or b or c)
    names = f"{given.get('class', '')} {given.get('id', '')}"
    words = {w.lower() for w in _WORDS.findall(names)}
    role = given.get("role", "").lower()
    label = tag + "".join(f".{w}" for w in sorted(words))
    texts = words & _TEXT_WORDS
    remarks = above.remarks or bool(words & _REMARKS)
    level = above.level
    if tag == "article" or given.get("itemprop") == "articleBody":
        level = ARTICLE
    elif tag == "main" or role == "main":
        level = max(level, MAIN)
    elif texts:
        level = max(level, TEXT)
    aside = tag in _ASIDE_TAGS or role in _ASIDE_ROLES or bool(words & _ASIDE_WORDS) or "hidden" in given
    if "header" in words and not texts or tag == "header":
        aside = aside or above.level < MAIN
    if "display:none" in given.get("style", "").replace(" ", "").lower():
        aside = True
    if above.aside and not (tag in ("article", "main") and not remarks and above.level < ARTICLE):
        aside = True  # an article begins anew, so an unclosed menu before it doesn't hide it
    return Element(tag, f"{above.path}>{label}", level, aside or remarks, remarks)


ROOT = Element("", "", NONE, False, False)


def blocks(page: str | None) -> tuple[list[Block], list[Element]]:
    """The page's blocks of text in order, and every block-level element as it begins."""
    page = page or ""
    stack, found, begun = [ROOT], [], []
    pieces: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
        if text:
            linked = sum(len(" ".join(html.unescape(p).split())) for p, inside in pieces if inside)
            found.append(Block(text, stack[-1], min(linked, len(text))))
        pieces.clear()

    at = 0
    while at < len(page):
        tag = _TAG.search(page, at)
        if not tag:
            pieces.append((page[at:], links > 0))
            break
        if tag.start() > at:
            pieces.append((page[at : tag.start()], links > 0))
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing, rest = tag[1] or tag[4], tag[3] or tag[6] or ""
        if closing:
            if name == "a":
                links = max(0, links - 1)
            elif name in _BLOCKS:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == name:
                        del stack[depth:]
                        break
            continue
        if name == "br":
            pieces.append((" ", False))
        elif name == "a":
            links = 1
        elif name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name in _BLOCKS:
            flush()
            links = 0
            closes, until = _CLOSES.get(name, (frozenset(("p",)), _BLOCKS - {"p"}))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in until:
                    break
                if stack[depth].tag in closes:
                    del stack[depth:]
                    if name not in _CLOSES:
                        break
            if name not in _VOID:
                if name == "body":  # whatever was left open in the head ends here
                    stack = [e for e in stack if e.tag in ("", "html")]
                element = _element(name, rest, stack[-1])
                begun.append(element)
                if not rest.endswith("/") or name not in ("svg", "object"):
                    stack.append(element)
    flush()
    return found, begun
