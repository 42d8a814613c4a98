"""A small forgiving HTML reader: tags and text into a flat tree."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Possessive repeats: markup that never closes is given up at once.
_NODE = re.compile(
    r"<!--(?:.*?)(?:-->|\Z)"
    r"|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: An element of the left kind ends an open one of the right kinds, up to the listed borders.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_SCOPE = frozenset("html body table td th article section div main aside header footer nav form".split())


@dataclass
class Tree:
    """Node 0 is the root. Children come after their parent; ``parts`` holds child numbers and texts in order."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    attributes: list[dict[str, str]] = field(default_factory=lambda: [{}])
    parts: list[list[int | str]] = field(default_factory=lambda: [[]])

    def add(self, parent: int, tag: str, attributes: dict[str, str]) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.attributes.append(attributes)
        self.parts.append([])
        self.parts[parent].append(len(self.tags) - 1)
        return len(self.tags) - 1


def _attributes(rest: str) -> dict[str, str]:
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)
    }


def parse(source: str) -> Tree:
    """Read any text as HTML. Unknown ends are ignored, open elements end with the page."""
    tree, stack, at = Tree(), [0], 0
    open_tags: dict[str, int] = {}

    def leave(depth: int) -> None:
        for node in stack[depth:]:
            open_tags[tree.tags[node]] -= 1
        del stack[depth:]

    def end(kinds: set[str] | frozenset[str], borders) -> None:
        if not any(open_tags.get(k) for k in kinds):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = tree.tags[stack[depth]]
            if tag in kinds:
                leave(depth)
                return
            if tag in borders:
                return

    while at < len(source):
        match = _NODE.match(source, at)
        at = match.end()
        if match["text"] is not None:
            tree.parts[stack[-1]].append(match["text"])
            continue
        name = match["tag"] or match["tag2"]
        if not name:
            continue
        tag = name.lower()
        if match["close"] or match["close2"]:
            if open_tags.get(tag):
                end({tag}, ())
            elif tag == "br":
                tree.add(stack[-1], "br", {})
            continue
        if tag in BLOCK:
            end({"p"}, _SCOPE)
        if tag in _ENDS:
            end(*_ENDS[tag])
        rest = match["rest"] if match["tag"] else match["rest2"]
        node = tree.add(stack[-1], tag, _attributes(rest) if rest.strip(" /") else {})
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            tree.parts[node].append(source[at : close.start() if close else len(source)])
            at = close.end() if close else len(source)
        elif tag not in VOID:
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    return tree
