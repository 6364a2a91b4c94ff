"""Main text of web pages, by the ratios of their tag paths."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Fixed values of HTML: elements without an end, elements whose content is not markup,
#: and elements that do not break a line of text.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: What an opening tag closes, up to the nearest of the containers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that hold no running text by their definition.
APART = frozenset("head button select input svg object".split()) | RAW
#: Elements, and words of class, id or role, that cast doubt on the text in them.
APART_TAGS = frozenset("nav header footer aside form dialog menu".split())
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disqus foot footer form gdpr head "
    "header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notification paging pagination popup promo promotion related reply replies respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN = frozenset(["article", "main"])

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)"
    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(>|\Z)",
    re.S,
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")

#: Weights of a block and its neighbours in page order when ratios are smoothed.
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
#: Paths below this part of the deviation of all blocks' values are left out.
CUT = 0.5
#: What an element leaves of the ratios of a path through it: if its tag or a whole name of it says
#: that it is no main text, and if a word in a longer name does. The first is raised to the
#: power of the part of the page's text that lies outside it.
DOUBT, SOME_DOUBT = 0.02, 0.5
#: What MAIN elements add to them.
MAIN_COUNTS = 4


@dataclass
class Block:
    """Text of one block of a page: the path from the root to it, and how much of it is
    in links."""

    path: tuple[str, ...]
    text: str
    linked: int


@lru_cache(maxsize=10_000)
def _doubt(names: str) -> int:
    """2 if a whole name in ``names`` is made of words that say "not main text", 1 if some
    word in it is one of them, otherwise 0."""
    found = 0
    for name in names.split():
        parts = [part.lower() for part in NAME_PARTS.findall(name)]
        known = [part in APART_WORDS for part in parts]
        if (known and all(known)) or "".join(parts) in APART_WORDS:
            return 2
        found = max(found, int(any(known)))
    return found


def _shares(totals: dict[tuple, np.ndarray]) -> dict[tuple, float]:
    """The part of a page's text outside links that lies below each path that casts doubt."""
    held: dict[tuple, float] = defaultdict(float)
    for path, sums in totals.items():
        for depth, label in enumerate(path, 1):
            if _is_apart(label):
                held[path[:depth]] += sums[1]
    every = max(sum(sums[1] for sums in totals.values()), 1)
    return {path: text / every for path, text in held.items()}


def _is_apart(label: str) -> bool:
    tag, _, names = label.partition(".")
    return tag in APART_TAGS or _doubt(names) == 2


def _weight(path: tuple[str, ...], shares: dict[tuple, float]) -> float:
    """What the tags and names on a path make of its ratios."""
    weight, main = 1.0, 1
    for depth, label in enumerate(path, 1):
        tag, _, names = label.partition(".")
        if _is_apart(label):
            weight *= DOUBT ** (1 - shares.get(path[:depth], 0.0))
        elif _doubt(names):
            weight *= SOME_DOUBT
        if tag in MAIN:
            main = MAIN_COUNTS
    return weight * main


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of a page with text, in page order.

    Markup may be unclosed, badly nested or cut off; an unfinished tag or comment at the
    end is dropped. Inline elements are part of their block, and a line break is white
    space in it.
    """
    page = page or ""
    stack: list[tuple[str, str]] = [("", "")]
    found: list[Block] = []
    pieces: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text and not any(tag in APART for tag, _ in stack):
            path = tuple(label for _, label in stack[1:] if label)
            found.append(Block(path, text, linked))
        pieces.clear()
        linked = 0

    def pop(size: int) -> None:
        if any(frame[1] for frame in stack[size:]):
            flush()
        del stack[size:]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if any(frame[0] == "a" for frame in stack):
                linked += len(text.strip())

    while at < len(page):
        match = TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        slash, tag, attributes = match[1], match[2], match[3]
        if tag is None:
            slash, tag, attributes, end = match[5], match[6], match[7], match[8]
        else:
            end = match[4]
        if tag is None:
            continue
        if not end:
            break
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if tag == "br" or tag == "hr":
            add(" ")
        if tag in VOID:
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if tag not in INLINE:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    pop(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
            closes, within = CLOSES.get(tag, ((), ()))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in closes:
                    pop(depth)
                    break
                if stack[depth][0] in within:
                    break
            flush()
        label = names = ""
        if "=" in attributes and tag not in ("html", "body"):
            names = " ".join(value.strip("\"'") for _, value in NAMED.findall(attributes))
        if tag not in INLINE:
            label = f"{tag}.{names}" if names else tag
        stack.append((tag, label))
    flush()
    return found


def main_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks that are main text.

    Every path from the root has a text ratio (text outside links per block) and a
    punctuation ratio (marks per block). Each block takes its path's ratios; these are
    smoothed over the blocks in page order and fused, and paths whose blocks' mean lies
    below the threshold, a part of the deviation, are left out, as are paths whose text
    is mostly links. The element that holds most of what is left gives back its other
    blocks: headings and short paragraphs.

    Tags and names only weigh: an element that says it is no main text leaves a fiftieth of the
    fused ratio of paths through it, and the more the more of the page's text it holds; such a
    word in a longer name leaves a half, and ``article`` and ``main`` count four times.
    """
    if not blocks:
        return []
    totals: dict[tuple, np.ndarray] = defaultdict(lambda: np.zeros(4))
    for b in blocks:
        marks = len(PUNCTUATION.findall(b.text))
        totals[b.path] += [1, _plain(b), marks, len(b.text)]
    ratios = np.array([totals[b.path][1:3] / totals[b.path][0] for b in blocks])
    smooth = np.column_stack([_smoothed(ratios[:, 0]), _smoothed(ratios[:, 1])])
    shares = _shares(totals)
    weights = {path: _weight(path, shares) for path in totals}
    fused = smooth[:, 0] * (1.0 + smooth[:, 1]) * np.array([weights[b.path] for b in blocks])
    by_path: dict[tuple, list[float]] = defaultdict(list)
    for b, value in zip(blocks, fused):
        by_path[b.path].append(value)
    threshold = CUT * fused.std()
    chosen = {
        path
        for path, values in by_path.items()
        if np.mean(values) >= threshold and 2 * totals[path][1] >= totals[path][3]
    }
    if not chosen:
        return []
    held: dict[tuple, float] = defaultdict(float)
    for path in chosen:
        held[path[:-1]] += totals[path][1] * weights[path]
    home = max(held, key=lambda path: (held[path], path))
    inside = len(home) > 0 and home[-1].split(".")[0] not in ("html", "body")
    return [
        b
        for b in blocks
        if b.path in chosen
        or (inside and b.path[: len(home)] == home and weights[b.path] >= _weight(home, shares))
    ]


def _plain(block: Block) -> int:
    """Characters outside links."""
    return max(len(block.text) - block.linked, 0)


def _smoothed(values: np.ndarray) -> np.ndarray:
    """Weighted means of each value and its neighbours."""
    side = len(KERNEL) // 2
    weights = np.convolve(np.pad(np.ones(len(values)), side), KERNEL, "valid")
    return np.convolve(np.pad(values, side), KERNEL, "valid") / weights


def main_text(page: str | None) -> str:
    """Main text of a page, its blocks joined by a space; empty if there is none."""
    return " ".join(b.text for b in main_blocks(blocks_of(page)))


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``, from its whole html.

    A null or empty page has an empty text. Pages are independent of each other, and
    repeated rows give repeated results.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch.pop("html")]
            yield batch.assign(text=texts, n_chars=[len(text) for text in texts])

    rows = pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "url", f"`{html_col}` AS html")
    return rows.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
