"""Leaf blocks of web pages: the runs of text between block-level tags, each with its place among the open elements."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

# A comment, a tag with its attributes (values in quotes may hold ">"), or other markup; what is not closed runs to the end.
_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# fixed values: HTML's element kinds
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html ins legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_PAGE = frozenset(("html", "head", "body"))
_TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
_SCOPE = frozenset(("table", "td", "th", "caption", "button"))
# Elements whose tag alone says what they hold.
_TELLING = frozenset("article aside dialog footer form header main nav".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# An opening tag ends an open element of the second set unless one of the third lies between.
_BETWEEN = BLOCKS - {"address", "div", "p", "li", "dt", "dd"}
_ENDS = {
    "li": ({"li"}, _BETWEEN),
    "dt": ({"dt", "dd"}, _BETWEEN),
    "dd": ({"dt", "dd"}, _BETWEEN),
    "tr": ({"tr", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", *_SCOPE}),
}
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Block(NamedTuple):
    """A leaf block: its text (white space as single spaces), what is known of its ancestors, and its linked characters.

    The context names the tags of all ancestors, the words of their class, id and role, and once more those of the nearest
    ancestor that has any.
    """

    text: str
    context: frozenset[str]
    linked: int


def _names(tag: str, attributes: str) -> set[str]:
    """What an element adds to the context of the blocks in it."""
    found = {f"in:{tag}"}
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "itemprop"):
            for word in value.split():
                found |= {f"name:{part.lower()}" for part in _NAME.findall(word)}
        elif name == "role":
            found.add(f"role:{value.lower()}")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            found.add("hidden")
    return found


def leaf_blocks(html: str) -> list[Block]:
    """The blocks of a page that hold more than white space, in page order.

    Character references are decoded. Contents of scripts, styles, titles and the like are no text. A line break is white
    space. Elements that a following tag ends, wrongly nested and unclosed ones are taken as browsers take them; the work
    grows with the page's length only.
    """
    root = ("", frozenset())
    stack: list[tuple[str, frozenset[str]]] = [root]
    open_tags: Counter[str] = Counter()
    # Open elements since the last table cell or the like, which an end tag inside does not reach beyond.
    scopes: list[Counter[str]] = [Counter()]
    contexts: dict[tuple[frozenset[str], str, str], frozenset[str]] = {}
    blocks: list[Block] = []
    pieces: list[str] = []
    links: list[str] = []
    in_link = False

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                linked = len(" ".join(unescape("".join(links)).split())) if links else 0
                blocks.append(Block(text, stack[-1][1], linked))
            pieces.clear()
            links.clear()

    def pop() -> None:
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        if tag in _SCOPE:
            scopes.pop()
        scopes[-1][tag] -= 1

    def push(tag: str, attributes: str) -> None:
        parent = stack[-1][1]
        key = (parent, tag, attributes)
        if key not in contexts:
            own = _names(tag, attributes)
            telling = {f"nearest:{name}" for name in own if not name.startswith("in:")}
            # An article's own header holds its title; the page's header is another thing.
            if tag in _TELLING and not (tag == "header" and "in:article" in parent):
                telling.add(f"nearest:{tag}")
            contexts[key] = frozenset(f for f in parent if not f.startswith("nearest:")) | own | telling if telling else parent | own
        stack.append((tag, contexts[key]))
        open_tags[tag] += 1
        scopes[-1][tag] += 1
        if tag in _SCOPE:
            scopes.append(Counter())

    def end_until(tags: set[str], barrier: set[str] | frozenset[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in tags:
                while len(stack) > at:
                    pop()
                return
            if stack[at][0] in barrier:
                return

    at = 0
    while at < len(html):
        found = _MARKUP.search(html, at)
        begin = found.start() if found else len(html)
        if begin > at:
            pieces.append(html[at:begin])
            if in_link:
                links.append(html[at:begin])
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if not name:
            continue
        tag, closing = name.lower(), found.group(1) == "/"
        if tag in RAW:
            if not closing:
                if tag in ("svg", "object", "canvas", "audio", "video", "template") and found.group(0).endswith("/>"):
                    continue
                end = _RAW_END[tag].search(html, at)
                at = end.start() if end else len(html)
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if tag in _PAGE or tag in VOID:
            continue
        if closing:
            in_link = False
            if (open_tags if tag in _TABLE or tag == "button" else scopes[-1])[tag] > 0:
                while stack[-1][0] != tag:
                    pop()
                pop()
        else:
            if stack[-1][0] == "p" or (tag in _HEADINGS and stack[-1][0] in _HEADINGS):
                pop()
            rule = _ENDS.get(tag)
            if rule and any(open_tags[t] for t in rule[0]):
                end_until(*rule)
            push(tag, found.group(3).strip())
    flush()
    return blocks
