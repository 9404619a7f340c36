"""A page as a tree of blocks: what the extraction of main text sees of HTML.

Reads any string; nothing raises. Comments, declarations and the content of elements that
are never shown (scripts, styles, titles, templates, embedded frames and drawings) go.
Inline elements don't end a block, ``br`` is white space. End tags that HTML lets a page
leave out are implied, stray ones are ignored. Time is linear in the length of the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of the HTML standard.
BLOCKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html iframe
    label legend li main menu nav noscript ol optgroup option p pre search section select summary
    table tbody td tfoot th thead tr ul
    """.split()
)
UNSHOWN = frozenset(
    "script style title template textarea iframe noembed noframes xmp svg math object head-data".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Which open elements a start tag closes, up to which others.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_NOT_IN_P = BLOCKS - {"button", "label", "select", "option", "optgroup", "noscript", "iframe"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")


@dataclass(slots=True)
class Page:
    """Nodes in page order: ``parent`` (-1: none), ``tag`` ("" for text), names, and texts of leaves."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attributes: list[dict[str, str]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, attributes: dict[str, str]) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attributes.append(attributes)
        self.text.append("")
        self.linked.append(0)
        return len(self.parent) - 1


def _tag_end(page: str, at: int) -> int:
    """The place of the ``>`` that ends a tag, outside quoted values; -1: none."""
    while found := _STOP.search(page, at):
        at = found.start()
        if page[at] == ">":
            return at
        if "=" in page[max(0, at - 2) : at]:
            close = page.find(page[at], at + 1)
            if close >= 0:
                at = close
        at += 1
    return -1


class _Builder:
    def __init__(self):
        self.page = Page()
        self.open: list[int] = [self.page.add(-1, "html", {})]
        self.where: dict[str, int] = {}  # how many of a name are open
        self.inline: list[str] = []
        self.chars = self.link_chars = self.in_link = 0

    def text(self, raw: str) -> None:
        self.inline.append(raw)
        if self.in_link:
            self.link_chars += len(raw)

    def end_block(self) -> None:
        if self.inline:
            # References are decoded a run at a time, white space of any kind is one space.
            text = " ".join(html.unescape("".join(self.inline)).split())
            if text:
                leaf = self.page.add(self.open[-1], "", {})
                self.page.text[leaf] = text
                self.page.linked[leaf] = self.link_chars
            self.inline = []
            self.link_chars = 0

    def close(self) -> None:
        self.end_block()
        tag = self.page.tag[self.open.pop()]
        self.where[tag] -= 1

    def close_until(self, names: set[str], stop: set[str] | frozenset[str]) -> None:
        """Close the nearest open element of ``names``, if no element of ``stop`` is nearer."""
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.page.tag[self.open[depth]]
            if tag in names:
                while len(self.open) > depth:
                    self.close()
                return
            if tag in stop:
                return

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "a":
            self.in_link = 1
        if tag == "br":
            self.inline.append(" ")
        if tag not in BLOCKS:
            return
        self.end_block()
        if tag == "html":
            self.page.attributes[0] = self.page.attributes[0] or attributes
            return
        if tag == "body" and self.where.get(tag):
            return
        if tag in _NOT_IN_P and self.where.get("p"):
            self.close_until({"p"}, {"td", "th", "button", "caption"})
        if tag in CLOSED_BY:
            names, stop = CLOSED_BY[tag]
            if any(self.where.get(name) for name in names):
                if tag == "tr":
                    self.close_until({"td", "th"}, {"tr", "table"})
                    names = {"tr"}
                self.close_until(names, stop)
        if tag not in VOID:
            self.open.append(self.page.add(self.open[-1], tag, attributes))
            self.where[tag] = self.where.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = 0
        if tag in BLOCKS and tag not in ("html", "body"):
            self.end_block()
            self.in_link = 0
            if self.where.get(tag):
                self.close_until({tag}, {"td", "th", "table"} - {tag} if tag not in ("tr", "table") else set())


def parsed(page: str) -> Page:
    """The blocks of a page."""
    build, at, size = _Builder(), 0, len(page)
    while at < size:
        low = page.find("<", at)
        if low < 0:
            build.text(page[at:])
            break
        if low > at:
            build.text(page[at:low])
        if page.startswith("<!--", low):
            end = page.find("-->", low + 2 if page.startswith("<!-->", low) else low + 4)
            at = size if end < 0 else end + 3
            continue
        follows = page[low + 1 : low + 2]
        if follows in ("!", "?"):
            end = page.find(">", low)
            at = size if end < 0 else end + 1
            continue
        closing = follows == "/"
        name = _NAME.match(page, low + 2 if closing else low + 1)
        if not name:
            if closing:
                end = page.find(">", low)
                at = size if end < 0 else end + 1
            else:
                build.text("<")
                at = low + 1
            continue
        tag, end = name.group().lower(), _tag_end(page, name.end())
        if end < 0:
            break  # a page cut inside a tag
        at = end + 1
        if closing:
            build.end(tag)
            continue
        if tag in UNSHOWN:
            if tag in BLOCKS:
                build.end_block()
            if page[end - 1] != "/":
                gone = _closing(tag).search(page, at)
                if gone is None:
                    break
                at = gone.end()
            continue
        wanted = tag in BLOCKS and end > name.end()
        found = _ATTRIBUTE.findall(page, name.end(), end) if wanted else ()
        build.start(tag, {n.lower(): a or b or c for n, a, b, c in found})
    build.end_block()
    return build.page


_CLOSING: dict[str, re.Pattern[str]] = {}


def _closing(tag: str) -> re.Pattern[str]:
    if tag not in _CLOSING:
        _CLOSING[tag] = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE)
    return _CLOSING[tag]
