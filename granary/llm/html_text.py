"""Main text of web pages: containers are scored page by page and widened to whole articles, hosts agree on where these stand."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import others
from granary.llm.components import stored

DECAY = 0.75
MIN_SHARE = 0.1
# What the paths of a level that get MIN_SHARE must hold together for the level to count.
AGREED = 0.5
LEVELS = 3

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|iframe|object|math|canvas|audio|video|title|textarea|select"
SKIPPED = frozenset("head nav header footer aside form button menu dialog fieldset label".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1
    h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("html body main article section div td center blockquote".split())
# An element of the key ends open elements of the first set, looking up no further than the second.
IMPLIED = {
    "p": ({"p"}, CONTAINERS | {"li", "table"}), "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"}),
} | {tag: ({"p"}, CONTAINERS | {"li", "table"}) for tag in "address article blockquote div dl figure h1 h2 h3 h4 h5 h6 main ol pre section table ul".split()}
ASIDE_WORDS = frozenset("""ad ads adv advert advertisement advertising adverts alert banner bottombar breadcrumb breadcrumbs comment
    commentary comments consent cookie cookies disqus footer footnav gdpr header headerbar hidden login masthead menu menubar modal nav
    navbar navigation newsletter notice notices notification pagination pager paywall popup promo promoted promotion recommended related
    replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription
    toolbar topbar widget widgets""".split())
# Of these words an article is set aside itself; others may name what it is about or holds.
ASIDE_ARTICLE_WORDS = frozenset("ad ads advert advertisement comment comments promo promoted related recommended replies reply sponsored".split())
# What these words set aside may be long and is never the article; what others set aside is read if it is most of a page.
NEVER_ARTICLE_WORDS = ASIDE_ARTICLE_WORDS | frozenset("commentary consent cookie cookies disqus gdpr login newsletter popup reply respond signup".split())
# A name may begin with a word if only these follow, and may end in one unless one of the others stands before it.
PART_WORDS = frozenset("""area articles author block body box button buttons bar container content count form group holder icon icons image
    inner item items left link links list main media message meta outer panel post posts right row section stories text title top bottom
    wrap wrapper""".split())
STATE_WORDS = frozenset("""category closed disabled enabled fixed has hide no not open overflow show sticky tag under with without""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search toolbar".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_LETTERS = re.compile(r"[a-z]+")
_NAMES = re.compile(r"([.#])")
_FIRST_PART = re.compile(r"[^_-]*")
_DIGITS = re.compile(r"\d+")


def general(label: str, level: int) -> str:
    """A label as it is, with the first parts of its classes and ids only (post-my-title: post), or as its tag alone."""
    if level == 0:
        return label
    tag, *names = _NAMES.split(label)
    if level == 2:
        return tag
    firsts = {kind + _FIRST_PART.match(name).group() for kind, name in zip(names[::2], names[1::2])}
    return tag + "".join(sorted(first for first in firsts if len(first) > 1))


@dataclass
class Page:
    """The elements of a page in their order (tag, label, parent, end of subtree) and its blocks of text outside what is skipped."""

    tags: list[str] = field(default_factory=lambda: ["html"])
    labels: list[str] = field(default_factory=lambda: ["html"])
    parents: list[int] = field(default_factory=lambda: [-1])
    ends: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    # letters outside links that only words set aside, others than those that never name an article
    doubtful: int = 0

    def path(self, node: int, level: int = 0) -> str:
        """Where an element stands: the labels down to it, on level 1 and 2 in a more general form and marked with the level."""
        parts = []
        while node >= 0:
            parts.append(general(self.labels[node], level))
            node = self.parents[node]
        return (f"{level}:" if level else "") + ">".join(reversed(parts))

    def best(self) -> tuple[int, float]:
        """The container with the highest score. A block gives its length, less twice its links, to all containers above it, less with distance."""
        scores: dict[int, float] = {}
        for node, text, linked in self.blocks:
            value = max(len(text) - 2 * linked, 0)
            while node >= 0 and value:
                if self.tags[node] in CONTAINERS:
                    scores[node] = scores.get(node, 0.0) + value
                    value *= DECAY
                node = self.parents[node]
        # the innermost of equals, as it comes last
        return max(((score, node) for node, score in scores.items()), default=(0.0, -1))[::-1]

    def whole(self, node: int) -> int:
        """The container that holds the whole article of which ``node`` is the densest part.

        That is the article element around it; else, and from there on, the next container above while what stands beside is mostly
        unlinked. The page itself, and what is around an article, is taken only for text that stands directly in it (or, beside
        another container, in sections of it), as other containers there are other things.
        """
        if node < 0:
            return node
        above = [node]
        while self.parents[above[-1]] >= 0:
            above.append(self.parents[above[-1]])
        place = {element: i for i, element in enumerate(above)}
        beside: list[list[tuple[int, int, int]]] = [[] for _ in above]
        for at, text, linked in self.blocks:
            apart = 0
            while at not in place:
                if self.tags[at] in CONTAINERS:
                    apart = max(apart, 1 if self.tags[at] == "section" else 2)
                at = self.parents[at]
            beside[place[at]].append((len(text), linked, apart))
        chosen = next((i for i, element in enumerate(above) if self.tags[element] == "article"), 0)
        rest: list[tuple[int, int, int]] = []
        for i in range(chosen + 1, len(above)):
            rest += beside[i]
            if not rest or self.tags[above[i]] not in CONTAINERS:
                continue
            in_article = self.tags[above[chosen]] in ("article", "main")
            bound = 0 if in_article else 1 if self.tags[above[i]] in ("html", "body") else 2
            if 2 * sum(linked for _, linked, _ in rest) > sum(letters for letters, _, _ in rest) or max(apart for _, _, apart in rest) > bound:
                break
            chosen, rest = i, []
        return above[chosen]

    def within(self, nodes: list[int]) -> str:
        """The blocks in the subtrees of some elements, in page order."""
        found, last = [], -1
        for start in nodes:
            if start > last:
                last = self.ends[start]
                found += [text for node, text, _ in self.blocks if start <= node <= last]
        return " ".join(found)

    def at(self, path: str) -> list[int]:
        """The elements at a path; of those at the same tags, the one with most text that is no link."""
        level = int(path[0]) if path[1:2] == ":" else 0
        leaf = path[2 * (level > 0):].rpartition(">")[2]
        nodes = [node for node, label in enumerate(self.labels) if general(label, level) == leaf and self.path(node, level) == path]
        if level < LEVELS - 1 or len(nodes) < 2:
            return nodes
        place = {node: i for i, node in enumerate(nodes)}
        held = [0] * len(nodes)
        for node, text, linked in self.blocks:
            while node >= 0:
                if node in place:
                    held[place[node]] += len(text) - linked
                node = self.parents[node]
        return [nodes[held.index(max(held))]]

    def unlinked(self, start: int) -> bool:
        """Whether an element has text that is mostly no link."""
        held = [(len(text), linked) for node, text, linked in self.blocks if start <= node <= self.ends[start]]
        return bool(held) and 2 * sum(linked for _, linked in held) <= sum(letters for letters, _ in held)


def _named(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id says one of some words: as a whole, as its end (site-header) or before a part (comments-area, comment-5)."""
    if name in words:
        return True
    parts = _LETTERS.findall(name)
    if len(parts) == 0 or ":" in name:
        return False
    if parts[-1] in words and STATE_WORDS.isdisjoint(parts[:-1]):
        return True
    return parts[0] in words and all(part in PART_WORDS or part in ASIDE_WORDS for part in parts[1:])


def _look(tag: str, attributes: str, words: frozenset[str]) -> tuple[str, int]:
    """The label of an element, with class and id in general form, and whether it is set aside: 2 surely, 1 by words that may mislead, 0 not."""
    aside = 2 * (tag in SKIPPED)
    if tag in ("html", "body") or not attributes or attributes.isspace():
        return tag, aside
    names, seen = [], set()
    if tag in ("article", "main"):
        words = words & ASIDE_ARTICLE_WORDS
    for found in _ATTRIBUTE.finditer(attributes):
        name = found.group(1).lower()
        if name in seen:
            continue
        seen.add(name)
        value = (found.group(2) or found.group(3) or found.group(4) or "").lower()
        if name in ("class", "id"):
            parts = value.split()
            names += [("." if name == "class" else "#") + _DIGITS.sub("0", part) for part in parts]
            if name == "id" and (tag in HEADINGS or tag == "section"):
                # an anchor, named after what the part is about
                if tag == "section" and not (words & ASIDE_ARTICLE_WORDS).isdisjoint(parts):
                    aside = 2
                continue
            for part in parts:
                if _named(part, words):
                    aside = max(aside, 2 if _named(part, words & NEVER_ARTICLE_WORDS) else 1)
        elif name == "role":
            aside = 2 if value in ASIDE_ROLES else aside
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            aside = 2
        elif name == "style":
            aside = 2 if "display:none" in value.replace(" ", "") else aside
    return tag + "".join(sorted(names)), aside


def read_page(source: str, by_words: frozenset[str] = ASIDE_WORDS) -> Page:
    """Elements and text blocks of a page, without what some words in class and id set aside. Broken markup is read as far as it makes sense; nothing is an error."""
    page = Page()
    stack, aside, links = [0], [0], 0
    words: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(words)).split()) if words else ""
        if text:
            node = next(element for element in reversed(stack) if page.tags[element] in BLOCKS)
            page.blocks.append((node, text, min(linked, len(text))))
        words.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            node = stack.pop()
            aside.pop()
            page.ends[node] = len(page.tags) - 1
            links -= page.tags[node] == "a"

    def add(text: str) -> None:
        nonlocal linked
        if text and not aside[-1]:
            words.append(text)
            if links:
                linked += len(text)
        elif text and aside[-1] == 1 and not links:
            page.doubtful += len(text.strip())

    position = 0
    for token in _TOKEN.finditer(source):
        add(source[position:token.start()])
        position = token.end()
        tag = token.group(3) or token.group(6)
        if tag is None:
            continue
        tag = tag.lower()
        if token.group(2) or token.group(5):
            if tag in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if page.tags[stack[depth]] == tag:
                    close(depth)
                    break
                if tag not in BLOCKS and page.tags[stack[depth]] in BLOCKS:
                    break
            continue
        if tag in BLOCKS:
            flush()
        if tag == "html":
            continue
        if tag in VOID:
            if tag == "br":
                add(" ")
            continue
        if tag in IMPLIED:
            ended, limits = IMPLIED[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if page.tags[stack[depth]] in ended:
                    close(depth)
                    break
                if page.tags[stack[depth]] in limits:
                    break
        label, off = _look(tag, token.group(4) or token.group(7) or "", by_words)
        page.tags.append(tag)
        page.labels.append(label)
        page.parents.append(stack[-1])
        page.ends.append(0)
        stack.append(len(page.tags) - 1)
        aside.append(max(aside[-1], off))
        links += tag == "a"
    add(source[position:])
    flush()
    close(0)
    return page


def _read(source: str | None) -> Page:
    """A page; one whose text words set aside for the most part is read again without these words, one without text without any."""
    page = read_page(source or "")
    if page.doubtful > sum(len(text) - linked for _, text, linked in page.blocks):
        page = read_page(source or "", NEVER_ARTICLE_WORDS)
    return page if page.blocks else read_page(source or "", frozenset())


def extract(source: str | None, paths: list[str]) -> tuple[str, str]:
    """Text of a page at all of some paths, in page order, else in the container of its own article; and the first path with text.

    What stands at a later path is left out if it is mostly links.
    """
    page = _read(source)
    nodes: list[int] = []
    first = ""
    for path in paths:
        here = page.at(path)
        if first:
            nodes += [node for node in here if page.unlinked(node)]
        elif page.within(here):
            nodes, first = here, path
    if first:
        return page.within(sorted(nodes)), first
    node = page.whole(page.best()[0])
    return (page.within([node]), page.path(node)) if node >= 0 else ("", "")


def host_of(url: Column) -> Column:
    """The host of an address in lower case, null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def winning_paths(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """Host and paths: where the articles of at least ``min_share`` of a host's pages stand, most voted first.

    Each page has one vote, for the path of the container around its densest one that holds the whole article, in three forms: tags with
    classes and ids, digits made equal; with the first parts of these; tags alone. The finest form holds in which the paths with
    enough votes have at least half of the host's, so that names made for each page do not split them. Votes are added up within the
    map tasks first; totals of hosts are a table of their own, so no host is one task.
    """
    @F.pandas_udf("array<string>")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for source in batch:
                page = _read(source)
                node = page.whole(page.best()[0])
                found.append([page.path(node, level) for level in range(LEVELS)] if node >= 0 else None)
            yield pd.Series(found, dtype=object)

    cast = pages.where("_host IS NOT NULL").select("_host", F.posexplode(vote.asNondeterministic()("_html")).alias("_level", "_path"))
    votes = stored(cast.groupBy("_host", "_level", "_path").agg(F.count(F.lit(1)).alias("_votes")), "votes")
    totals = votes.where("_level = 0").groupBy(F.col("_host").alias("_voting")).agg(F.sum("_votes").alias("_all"))
    won = votes.join(totals, F.col("_host") == F.col("_voting")).where(F.col("_votes") >= min_share * F.col("_all"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("_votes")).alias("v"), F.col("_path").alias("p"))))
    levels = won.groupBy("_host", "_level").agg(F.transform(order, lambda s: s["p"]).alias("_paths"), (F.sum("_votes") >= AGREED * F.first("_all")).alias("_agreed"))
    # the finest level that agrees, else the finest with a winner
    finest = F.min_by("_paths", F.struct(~F.col("_agreed"), "_level"))
    return levels.groupBy(F.col("_host").alias("_voted")).agg(finest.alias("_paths"))


def main_text(pages: DataFrame, source: str = "html", url: str = "url", min_share: float = MIN_SHARE) -> DataFrame:
    """Add ``text``, the main text of each page, and ``path``, where it was found.

    The pages of a host vote on where their article stands; each page is then read at all winning paths of its host, or in the
    container of its own article where it has none of them. Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and
    styles are left out, by element, role and the words in class and id, unless the words would leave out most of a page. Character references are decoded, white space inside a
    block becomes one blank, blocks are joined in page order by one blank.

    A null or empty page gives an empty text. A page without a host votes nowhere and is read by itself. Repeated rows stay; each
    votes. ``source`` is left out, and a column named like an added one gives way. An empty table gives an empty result.
    """
    rows = pages.select(*others(pages, ("text", "path", source)), F.col(f"`{source}`").alias("_html"), host_of(F.col(f"`{url}`")).alias("_host"))
    # a table of its own, so that the pages of a large host can be cut in the join
    won = stored(winning_paths(rows.select("_host", "_html"), min_share), "paths")

    @F.pandas_udf("struct<text: string, path: string>")
    def read(sources: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [extract(one, [] if given is None else list(given)) for one, given in zip(sources, paths)]
        return pd.DataFrame(found, columns=["text", "path"], dtype=object)

    kept = others(pages, ("text", "path", source))
    joined = rows.join(won, F.col("_host") == F.col("_voted"), "left_outer")
    return joined.select(*kept, read.asNondeterministic()("_html", "_paths").alias("_read")).select(*kept, "_read.text", "_read.path")
