"""A small reader of HTML into a tree of blocks and the text runs in them.

Inline elements do not part text. Scripts, styles and other elements without visible text
are left out, ends of tags that may be left out are supplied, stray ends are ignored, and a
page that breaks off is read as far as it goes.
"""

from __future__ import annotations

import re
from html import unescape

# Element names of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math object canvas audio video select datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: An element that is closed by the start of one of these.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]), "option": frozenset(["option", "optgroup"]), "head": frozenset(["body"]),
}
#: A start looks for what it closes up to the next of these.
SCOPE = frozenset("table td th ul ol dl html body article section div".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
BLANKS = re.compile(r"\s+")


class Node:
    """An element, or a run of text (tag None) with the share of it that is linked."""

    __slots__ = ("attributes", "children", "linked", "parent", "tag", "text")

    def __init__(self, tag: str | None, attributes: str = "", parent: Node | None = None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node] = []
        self.text, self.linked = "", 0.0

    def attribute(self, name: str) -> str | None:
        for key, *values in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape(next((v for v in values if v), ""))
        return None


def read(html: str, is_block) -> Node:
    """The root of a page. is_block(tag, attributes) tells whether an inline element is a block of its own."""
    root = here = Node("#root")
    pieces: list[str] = []
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = BLANKS.sub(" ", unescape("".join(pieces))).strip()
            if text:
                run = Node(None, parent=here)
                run.text = text
                run.linked = min(1.0, linked / len(text))
                here.children.append(run)
            pieces.clear()
        linked = 0

    at, size = 0, len(html)
    while at < size:
        found = TOKEN.search(html, at)
        stop = found.start() if found else size
        if stop > at:
            piece = html[at:stop]
            pieces.append(piece)
            if links:
                linked += len(piece.strip())
        if not found:
            break
        at = found.end()
        name = found[2] or found[5]
        if not name:
            if found[0].startswith("<![CDATA["):
                pieces.append(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name = name.lower()
        ending = bool(found[1] or found[4])
        attributes = found[3] or found[6] or ""
        if not ending:
            if name == "br":
                pieces.append(" ")
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = close.start() if close else size
                if name in ("select", "textarea", "iframe", "object", "video", "audio"):
                    pieces.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                continue
            if name in INLINE and not is_block(name, attributes):
                links += name == "a"
                continue
            flush()
            links = 0 if name not in INLINE else links
            level = here
            while level is not root:
                if name in CLOSED_BY.get(level.tag, ()):
                    here = level.parent
                    break
                if level.tag in SCOPE:
                    break
                level = level.parent
            if attributes.rstrip().endswith("/") and name in ("svg", "path"):
                continue
            node = Node(name, attributes, here)
            here.children.append(node)
            here = node
        else:
            if name in RAW or name in VOID:
                continue
            if name in INLINE and here.tag != name:
                links = max(0, links - 1) if name == "a" else links
                continue
            level = here
            while level is not root and level.tag != name:
                level = level.parent
            if level is not root:
                flush()
                here = level.parent
                links = 0
    flush()
    return root
