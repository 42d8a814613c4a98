"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors; a
container's points are discounted by its share of link text. From the best
container it goes up to the article or main around it, or to the body; what is
marked as something else, and what is mostly links, is left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.html_tree import BLOCK, Tree, parse

# What is never part of an article, by element and by words of class, id and role.
_DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea "
    "input label iframe object embed svg canvas audio video dialog menu search".split()
)
_BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside rail footer header masthead "
    "cookie cookies consent notice notices notification alert popup modal overlay gdpr "
    "comment comments disqus reply replies respond discussion "
    "share sharing social related recommended newsletter subscribe signup login widget toolbar pagination pager".split()
)
_GOOD_WORDS = frozenset("article body main content entry story post text".split())
_KEPT_TAGS = frozenset("html body article main #root".split())
#: How much of a paragraph's points reaches the ancestor so many levels up.
_SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
#: Share of link text beyond which a box of three links is a menu, and what stands beside the article is none of it.
_DENSE, _LINKED = 0.66, 0.25

_WORDS = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _unwanted(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _DROPPED:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    if tag in _KEPT_TAGS:
        return False
    named = " ".join(attributes.get(a, "") for a in ("class", "id", "role"))
    words = {w.lower() for w in _WORDS.findall(_CAMEL.sub(" ", named))}
    return bool(words & _BAD_WORDS) and not words & _GOOD_WORDS


def _flat(parts: list[str]) -> str:
    """Texts put together, references decoded, white space as single spaces."""
    return " ".join(html.unescape("".join(parts)).split())


def _measured(tree: Tree):
    """Kept nodes, and per node: letters of text and of link text below it, points."""
    n = len(tree.tags)
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[tree.parents[i]] and not _unwanted(tree.tags[i], tree.attributes[i])
    size, linked, links, points = [0] * n, [0] * n, [0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if not kept[i]:
            continue
        own = _flat([p for p in tree.parts[i] if isinstance(p, str)])
        size[i] += len(own)
        if tree.tags[i] == "a":
            linked[i], links[i] = size[i], links[i] + 1
        up = tree.parents[i]
        if up >= 0:
            size[up] += size[i]
            linked[up] += linked[i]
            links[up] += links[i]
    return kept, size, linked, links, points


def _blocks_of(tree: Tree, kept: list[bool], top: int) -> Iterator[tuple[int, str]]:
    """(element, text) of every run of text between block borders below ``top``, in page order."""
    holder, run = top, []
    todo: list[tuple[int, int]] = [(top, 0)]
    while todo:
        node, place = todo.pop()
        parts = tree.parts[node]
        if place == 0 and tree.tags[node] in BLOCK or node == top and place == 0:
            if run and (text := _flat(run)):
                yield holder, text
            holder, run = node, []
        while place < len(parts):
            part = parts[place]
            place += 1
            if isinstance(part, str):
                run.append(part)
            elif tree.tags[part] == "br":
                run.append(" ")
            elif kept[part]:
                todo.append((node, place))
                todo.append((part, 0))
                break
            elif tree.tags[part] in BLOCK:
                if run and (text := _flat(run)):
                    yield holder, text
                run = []
        else:
            if tree.tags[node] in BLOCK:
                if run and (text := _flat(run)):
                    yield holder, text
                run = []
                up = tree.parents[node]
                while up > top and tree.tags[up] not in BLOCK:
                    up = tree.parents[up]
                holder = up if up >= top else top
    if run and (text := _flat(run)):
        yield holder, text


def _scored(tree: Tree, kept, size, linked, points) -> list[float]:
    for holder, text in _blocks_of(tree, kept, 0):
        if tree.tags[holder] in ("h1", "h2", "h3", "h4", "h5", "h6"):
            continue
        gained = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        gained *= min(1.0, len(text) / 25)
        # Text right inside a container counts for the container itself.
        node = holder if tree.tags[holder] in ("div", "section", "article", "main", "td", "body") else tree.parents[holder]
        for share in _SHARES:
            if node < 0:
                break
            points[node] += gained * share
            node = tree.parents[node]
    scores = []
    for i, tag in enumerate(tree.tags):
        density = linked[i] / size[i] if size[i] else 1.0
        likely = 1.5 if tag in ("article", "main") or tree.attributes[i].get("role") in ("article", "main") else 1.0
        scores.append(points[i] * (1 - density) * likely if kept[i] else 0.0)
    return scores


def _open_parts(tree: Tree, kept, size, linked, parent: int, inner: int) -> list[int | str]:
    """Parts of ``parent`` without the blocks, and runs between blocks, that are link text by more than ``_LINKED``."""
    found: list[int | str] = []
    run: list[int | str] = []

    def closed() -> None:
        length = sum(len(_flat([p])) if isinstance(p, str) else size[p] for p in run)
        if sum(linked[p] for p in run if not isinstance(p, str)) <= _LINKED * length:
            found.extend(run)
        run.clear()

    for part in tree.parts[parent]:
        if isinstance(part, str):
            run.append(part)
        elif part == inner or tree.tags[part] in BLOCK:
            closed()
            # What is dropped stays as a border between texts.
            if part == inner or not kept[part] or linked[part] <= _LINKED * size[part]:
                found.append(part)
        elif kept[part]:
            run.append(part)
    closed()
    return found


def _climbed(tree: Tree, kept, size, linked, best: int) -> int:
    """The element whose text is the article, from the best container upwards.

    The outermost enclosing article, else main, is taken whole, and of its
    parent what is no link text. Without either, so is every ancestor up to
    the body that holds more text than the one below it.
    """
    outer = {}
    node = best
    while node >= 0:
        for kind in {tree.tags[node], tree.attributes[node].get("role")} & {"article", "main"}:
            outer[kind] = node
        node = tree.parents[node]
    node = top = outer.get("article", outer.get("main", best))
    while tree.parents[node] >= 0 and tree.tags[node] not in ("body", "html"):
        inner, node = node, tree.parents[node]
        parts = _open_parts(tree, kept, size, linked, node, inner)
        tree.parts[node] = parts
        if any(_flat([p]) if isinstance(p, str) else kept[p] and p != inner and size[p] for p in parts):
            top = node
        if outer:
            break
    return top


def main_text(source: str) -> str:
    """The article's blocks in page order, joined by one space; empty if there are none."""
    tree = parse(source)
    kept, size, linked, links, points = _measured(tree)
    scores = _scored(tree, kept, size, linked, points)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    if scores[best] <= 0:
        # Nothing but links or headings: no container stands out, the body is all there is.
        if not size[0] or linked[0] >= size[0]:
            return ""
        best = 0
    above, node = set(), best
    while node >= 0:
        above.add(node)
        node = tree.parents[node]
    # Lists and boxes of links inside are menus.
    for i, tag in enumerate(tree.tags):
        if kept[i] and i not in above and tag in ("ul", "ol", "div", "section", "table", "dl"):
            if links[i] >= 3 and linked[i] > _DENSE * size[i]:
                kept[i] = False
    top = _climbed(tree, kept, size, linked, best)
    # A kept element below one that is not kept is never reached.
    return " ".join(text for _, text in _blocks_of(tree, kept, top))


def _texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py() or "") for p in pages], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages (page_id, url, html)``.

    Each page is read whole, on its own, in its own row: nothing is shuffled or
    shared. A null or empty page, or one without an article, has an empty text.
    Broken markup is read as far as it goes; equal rows give equal texts.
    """
    text = F.arrow_udf(_texts, "string")("html")
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
