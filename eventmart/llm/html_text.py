"""Pages as elements, blocks of text and their order, by the usual recovery rules of HTML. No template is known here."""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass, field
from hashlib import blake2b

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
STRUCTURE = frozenset(
    """html head body article section main nav aside header footer div center p h1 h2 h3 h4 h5 h6 hgroup ul ol li menu dl dt dd table caption thead tbody tfoot tr td th
    blockquote pre address figure figcaption form fieldset legend details summary dialog noscript template svg math object canvas audio video select button option hr search""".split()
)
#: Elements that hold other blocks; an article lies in one of them.
CONTAINERS = frozenset("html body article section main div center td tr tbody table form fieldset".split())
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that never hold an article's text, whatever they are called.
ASIDE_TAGS = frozenset("head nav menu aside footer form select button dialog noscript template svg math object canvas audio video search script style".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words of a class or id that name such an element.
ASIDE_NAMES = frozenset(
    """ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices
    sidebar sidebars aside rail nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar toolbar comment comments commentlist disqus reply replies respond
    discussion related recommended recommendations share sharing social newsletter subscribe subscription signup login popup modal overlay widget widgets pagination pager copyright""".split()
)
NONE, BY_NAME, BY_TAG, HEADER = range(4)

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<[!?/]")
_REST = re.compile(r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMED = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Parents that an element of these kinds stands in; an open one of its kind within that ends where the next begins.
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th")}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}
_raw_ends = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
#: Roles that a worker remembers.
REMEMBERED = 50_000
_roles: dict[tuple, tuple[int, int]] = {}


def number(*parts) -> int:
    """A 64-bit number that stands for the parts."""
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


ROOT = number("root")


@dataclass
class Page:
    """elements: (role, element around it, tag, why it is no text of an article); blocks: (element, text, characters in
    links); events in page order: element opened (2 * i), closed (2 * i + 1), or block (-1 - i). A role is an element's
    path from the root: tags with their classes and ids."""

    elements: list[tuple[int, int, str, int]] = field(default_factory=lambda: [(ROOT, -1, "html", NONE)])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    events: list[int] = field(default_factory=lambda: [0])


def attributes(text: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(text)}


def role_of(parent: int, tag: str, rest: str) -> tuple[int, int]:
    """The role of an element and why it is no text of an article. rest: its attributes as they were written."""
    given = attributes(rest) if _NAMED.search(rest) else {}
    names = f"{given.get('class') or ''} {given.get('id') or ''}"
    key = (parent, tag, names, given.get("role"), "hidden" in given, given.get("style"))
    known = _roles.get(key)
    if known is None:
        if len(_roles) > REMEMBERED:
            _roles.clear()
        words = frozenset(p.lower() for p in _PARTS.findall(names))
        why = NONE
        if tag in ASIDE_TAGS or (given.get("role") or "").lower() in ASIDE_ROLES or "hidden" in given or re.search(r"display\s*:\s*none", given.get("style") or "", re.IGNORECASE):
            why = BY_TAG
        elif tag == "header" or "header" in words:
            why = HEADER
        elif words & ASIDE_NAMES and tag not in ("html", "body", "main", "article"):
            why = BY_NAME
        signature = " ".join(sorted(set(re.sub(r"\d+", "", names).split())))  # numbers differ from page to page
        known = _roles[key] = number(parent, tag, signature, given.get("role") or ""), HEADER if why == BY_NAME and "header" in words else why
    return known


def parse(text: str) -> Page:
    """Elements, blocks and events of a page. Time is linear in the text but for deep nests of unclosed list or table parts."""
    page = Page()
    elements, blocks, events = page.elements, page.blocks, page.events
    stack, opened, held = [0], {"html": 1}, []
    at, links, linked, loose, size = 0, 0, 0, False, len(text)

    def flush() -> None:
        nonlocal linked
        if held:
            words = " ".join("".join(held).split())
            held.clear()
            if words:
                blocks.append((stack[-1], words, min(linked, len(words))))
                events.append(-len(blocks))
        linked = 0

    def close() -> None:
        flush()
        i = stack.pop()
        opened[elements[i][2]] -= 1
        events.append(2 * i + 1)

    def say(chunk: str) -> None:
        nonlocal linked
        chunk = references.unescape(chunk) if "&" in chunk else chunk
        held.append(chunk)
        if links:
            linked += len(chunk.strip())

    def open_(tag: str, rest: str) -> None:
        nonlocal links
        flush()
        links = 0  # a link that is left open ends with the block
        if elements[stack[-1]][2] == "p":
            close()
        same = _SIBLINGS.get(tag)
        if same and any(opened.get(t) for t in same):
            scope = _SCOPES.get(tag, ("table",))
            k = len(stack) - 1
            while k > 0 and elements[stack[k]][2] not in scope:
                if elements[stack[k]][2] in same:
                    while len(stack) > k:
                        close()
                    k = len(stack) - 1
                else:
                    k -= 1
        role, why = role_of(elements[stack[-1]][0], tag, rest)
        elements.append((role, stack[-1], tag, why))
        events.append(2 * (len(elements) - 1))
        stack.append(len(elements) - 1)
        opened[tag] = opened.get(tag, 0) + 1

    while True:
        m = _TAG.search(text, at)
        if m is None:
            say(text[at:])
            break
        if m.start() > at:
            say(text[at : m.start()])
        tag = m[2]
        if tag is None:
            if m[0] == "<!--":
                end = text.find("-->", m.end())
                at = size if end < 0 else end + 3
            else:
                end = text.find(">", m.end())
                at = size if end < 0 else end + 1
            continue
        tag = tag.lower()
        end = None if loose else _REST.match(text, m.end())
        if end is None:  # a quote that is never closed: from here on tags end at the next bracket
            loose = True
            stop = text.find(">", m.end()) + 1 or size
        else:
            stop = end.end()
        rest, at = text[m.end() : stop - 1], stop
        if m[1]:
            if tag == "a":
                links = 0
            elif tag == "br":
                held.append(" ")
            elif tag in STRUCTURE and tag != "html":
                flush()
                if opened.get(tag) and tag not in ("body",):
                    while elements[stack[-1]][2] != tag:
                        close()
                    close()
            continue
        if tag in RAW:
            end = _raw_ends[tag].search(text, at)
            at = size if end is None else text.find(">", end.end()) + 1 or size
        elif tag == "br":
            held.append(" ")
        elif tag == "a":
            links = 1
        elif tag == "html" or tag == "body" and opened.get("body"):
            flush()
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif tag in STRUCTURE:
            if tag == "body" and opened.get("head"):
                while len(stack) > 1:
                    close()
            open_(tag, rest)
    while stack:
        close()
    return page
