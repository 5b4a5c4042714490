"""Block trees of HTML pages: a tolerant reader that keeps what extraction needs.

Inline elements are folded into their block, so a page's tree holds its block
elements only. Text is read in page order as runs, each of one block.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# An attribute: a quote opens a value only after an equals sign, elsewhere it is a character like others.
_ATTRIBUTE = r"(?:=?[^\s/>=]++|=)(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+"
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>")
_NAME_AND_VALUE = re.compile(r"(=?[^\s/>=]++|=)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
_NAMING = ("class", "id", "role", "aria-label", "itemprop")
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Elements that HTML reads as raw text and whose content is never text of the page: read up to their end tag as they stand.
RAW = frozenset("script style noscript textarea title iframe noembed noframes xmp".split())
# Elements that are never shown either, but hold elements: left out up to their end tag, and just a tag without one.
UNSHOWN = frozenset("template canvas annotation annotation-xml".split())
UNSHOWN_IN_SVG = frozenset("desc metadata".split())
# Elements with a vocabulary of their own, whose elements are inline here.
FOREIGN = frozenset(("svg", "math"))
# Elements whose text is never article text, whatever is in them.
SHUT = frozenset("head select button option label input dialog menu audio video map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd mark q ruby rb rt rp s samp "
    "small span strike strong sub sup time tt u var wbr label button select option nobr svg math object".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
# A start tag that ends an open element of the same family, up to the family's container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
BLOCKS = CLOSES_P | SHUT | frozenset(ENDS) | frozenset("html body thead tbody tfoot caption summary".split())


@dataclass
class Tree:
    """Blocks in page order; the root is the page itself."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    depths: list[int] = field(default_factory=lambda: [0])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    shut: list[bool] = field(default_factory=lambda: [False])
    links: list[int] = field(default_factory=lambda: [0])
    runs: list[tuple[int, str]] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    """Values by name; the first attribute of a name counts."""
    found: dict[str, str] = {}
    for name, value in _NAME_AND_VALUE.findall(text):
        plain = value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value
        found.setdefault(name.lower(), html.unescape(plain))
    return found


def _names(found: dict[str, str]) -> tuple[str, ...]:
    return tuple(
        part.lower() for name, value in found.items() if name in _NAMING for part in _NAME_PART.findall(value)
    )


def _hidden(found: dict[str, str]) -> bool:
    """Whether an element is hidden by its hidden attribute, its own style or ``aria-hidden``."""
    shown = _DISPLAY.findall(found.get("style", ""))
    return (
        "hidden" in found
        or found.get("aria-hidden", "").strip().lower() == "true"
        or bool(shown and shown[-1].lower() == "none")
    )


def read(page: str) -> Tree:
    """The block tree of a page. Unclosed and stray tags are borne with; nothing fails.

    Time grows with the page's length: every character is passed once, and
    open elements are looked up by name, not along the stack. A tag that the
    page ends in gives nothing.
    """
    tree = Tree()
    # open elements: tag, its block, whether it is a block of its own
    stack: list[tuple[str, int]] = [("#page", 0)]
    block, anchors, foreign = 0, 0, 0
    # depths on the stack of the open elements of a name, and of those that are blocks
    depths: dict[str, list[int]] = {}
    block_depths: list[int] = []
    # elements without an end tag in the rest of the page
    endless: set[str] = set()
    parts: list[str] = []
    linked = 0
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            # a no-break space is white space too
            text = " ".join("".join(parts).split())
            if text:
                tree.runs.append((block, text))
                tree.links[block] += linked
            parts.clear()
        linked = 0

    def pop(depth: int) -> None:
        """Leave the elements above a depth of the stack."""
        nonlocal block, anchors, foreign
        while len(stack) > depth:
            tag, own = stack.pop()
            if tag != "#ended":
                depths[tag].pop()
            if tag == "a":
                anchors -= 1
            foreign -= tag in FOREIGN
            if own >= 0:
                flush()
                block_depths.pop()
                block = tree.parents[own]

    def push(tag: str, own: int) -> None:
        depths.setdefault(tag, []).append(len(stack))
        if own >= 0:
            block_depths.append(len(stack))
        stack.append((tag, own))

    def find(tags, stops=()) -> int | None:
        """The innermost open element of these names, if none of ``stops`` is open within it."""
        nearest = lambda names: max((d[-1] for n in names if (d := depths.get(n))), default=0)
        depth = nearest(tags)
        return depth if depth > nearest(stops) else None

    while at < size:
        # the next tag, comment or declaration; any other < is text
        start = page.find("<", at)
        match, skipped = None, 0
        while start >= 0:
            after = page[start + 1 : start + 3]
            if after[:1].isascii() and (after[:1].isalpha() or (after[:1] == "/" and after[1:].isascii() and after[1:].isalpha())):
                match = _TAG.match(page, start)
                skipped = match.end() if match else size
                break
            if after[:1] in ("!", "?", "/") and after[1:]:
                comment = _COMMENT.match(page, start)
                end = comment.end() - 1 if comment else page.find(">", start)
                skipped = end + 1 if end >= 0 else size
                break
            start = page.find("<", start + 1)
        text = page[at : start if start >= 0 else size]
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if anchors:
                linked += len(text.strip())
        if start < 0:
            break
        at = skipped
        if not match:
            continue
        closing, tag, attributes = match.group(1), match.group(2), match.group(3)
        tag = tag.lower()
        if closing:
            if tag == "br":
                parts.append(" ")
            depth = find((tag,), () if tag not in INLINE else ("td", "th", "table"))
            if depth is not None:
                # an inline end tag doesn't end the blocks it happens to hold, unless it is one itself
                if tag not in INLINE or stack[depth][1] >= 0 or not block_depths or block_depths[-1] < depth:
                    pop(depth)
                else:
                    depths[tag].pop()
                    stack[depth] = ("#ended", -1)
                    anchors -= tag == "a"
                    foreign -= tag in FOREIGN
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            # only in svg and math a slash ends such an element
            if not (foreign and attributes.endswith("/")):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.I).search(page, at)
                at = end.end() if end else size
            if tag not in INLINE and not foreign:
                flush()
            continue
        if tag in UNSHOWN or (foreign and tag in UNSHOWN_IN_SVG):
            if tag not in endless and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?![\w-])[^>]*>", re.I).search(page, at)
                if end:
                    at = end.end()
                else:
                    endless.add(tag)
            continue
        if tag in ("br", "wbr", "img"):
            parts.append(" " if tag == "br" else "")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in CLOSES_P:
            depth = find(("p",), ("td", "th", "table", "button"))
            if depth is not None:
                pop(depth)
        if tag in ENDS:
            family, stops = ENDS[tag]
            while (depth := find(family, stops)) is not None:
                pop(depth)
        if tag == "body":
            depth = find(("head",))
            if depth is not None:
                pop(depth)
        if attributes.endswith("/") and tag not in CLOSES_P:
            continue
        if tag in INLINE and tag not in SHUT or foreign and tag not in BLOCKS:
            if foreign and tag == "text":
                parts.append(" ")
            push(tag, -1)
            anchors += tag == "a"
            foreign += tag in FOREIGN
            continue
        flush()
        tree.tags.append(tag)
        tree.parents.append(block)
        tree.depths.append(tree.depths[block] + 1)
        own_attributes = _attributes(attributes) if attributes else {}
        tree.names.append(_names(own_attributes))
        tree.shut.append(
            tree.shut[block] or tag in SHUT or bool(_MAY_HIDE.search(attributes) and _hidden(own_attributes))
        )
        tree.links.append(0)
        block = len(tree.tags) - 1
        push(tag, block)
    flush()
    # text beside blocks becomes a block of its own, so that it can differ from what surrounds it
    mixed = set(tree.parents)
    for place, (own, text) in enumerate(tree.runs):
        if own in mixed:
            tree.tags.append("#text")
            tree.parents.append(own)
            tree.depths.append(tree.depths[own] + 1)
            tree.names.append(())
            tree.shut.append(tree.shut[own])
            tree.links.append(0)
            tree.runs[place] = (len(tree.tags) - 1, text)
    return tree
