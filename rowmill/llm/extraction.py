"""Main text of web pages by container paths that pages of a host agree on.

1. Each page is cut into blocks, each with the path of containers around it (tags with generalised classes:
   digits become ``#``). A container's score is the text directly in its blocks, less what is link text, and half of that
   of the containers inside it. The best container of the page, lifted to the nearest article or main around it, is its
   vote. Without one it is lifted to the parent while that adds text without links: to the body only if that adds
   nothing but blocks directly in the body, as other containers there are not known to belong to the text.
2. Spark adds up the votes of a host by path; the path with most votes wins (then by score, then by text).
3. Pages are extracted with the winning path of their host: all blocks inside such containers. A page without one is
   extracted with its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out, known by
tag, role or words in class and id. Words that articles use as well (``AMBIGUOUS``) count for containers only, not in
the id of a section, and not if a header's name says it is the article's. Ids of headings, paragraphs and other text
are not judged. A container known by words alone stays if it holds more than half of the page's text without links;
reader comments, adverts and consents (``APART``) do so only around an article, a main or a first heading. A header
element inside the article keeps its headings and the paragraphs whose class names a lead (``LEADS``). A form is left out
unless it is wrapped around the page: directly in the body (or around an article, a main or a first heading) with more than half of
the text. White space inside a block (line
break elements included) becomes one space; blocks are joined by line breaks; character references are decoded.

Edge cases: a null or empty page has an empty text and no vote; a page cut off inside a tag or comment ends there;
tags that are not closed end with what encloses them; a null URL belongs to the host without name; repeated
rows are extracted each and all vote; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.storage import materialize

BROADCAST_HOSTS = 50_000
DEEPEST = 200  # containers inside so many elements share the path of the last one above

# Elements by their part in a page.
UNREAD = "script style noscript template svg iframe object canvas head title math audio video"
LEFT_OUT = {*"nav footer aside button select textarea input dialog menu fieldset".split()}
INLINE = {*"a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()}
VOID = {*"area base br col embed hr img input link meta param source track wbr".split()}
CONTAINERS = {*"article main section div body td".split()}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_IN = {*"ul ol dl table tbody thead tfoot div section article body main".split()}
ROLES = {*"navigation banner contentinfo complementary search alert dialog menu menubar".split()}
NOISE = {
    *"ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner banners".split(),
    *"nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar".split(),
    *"header masthead topbar footer bottombar sidebar aside rail widget widgets".split(),
    *"cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall".split(),
    *"comment comments commentlist disqus reply replies respond responses discussion".split(),
    *"share sharing social related recommended recommendations teaser tags form search hidden".split(),
}

AMBIGUOUS = {
    *"header masthead notice notices alert reply replies respond response responses discussion".split(),
    *"share sharing social related recommended recommendations teaser tags form search hidden".split(),
}
APART = {
    *"ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr".split(),
    *"popup modal overlay newsletter subscribe signup login comment comments commentlist disqus".split(),
}
OF_ARTICLE = {*"article post entry story content title section".split()}
TEXT_BLOCKS = {*"h1 h2 h3 h4 h5 h6 hgroup p li dt dd blockquote pre figure figcaption caption".split()}
LEADS = {*"lead lede intro introduction summary standfirst dek deck subtitle subheading abstract".split()}
STRAY, NAMED, SET_APART = 1, 2, 3  # left out for certain, by name unless it holds most text, by name of an APART kind

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{UNREAD.replace(' ', '|')})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\bhidden\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _named_noise(name: str, key: str, value: str) -> int:
    """How a class or id marks an element: not (0) or as one of the kinds of noise."""
    text = name in TEXT_BLOCKS or name in INLINE
    if name in ("body", "html", "main", "article") or (text and key == "id"):
        return 0
    tokens = [{w.lower() for w in _WORDS.findall(token)} for token in value.split()]
    noisy = set()
    for words in tokens:
        noisy |= (words & NOISE) - ({"header"} if words & OF_ARTICLE else set())
    if text or (name == "section" and key == "id"):
        noisy -= AMBIGUOUS
    if not noisy:
        return 0
    return STRAY if text else SET_APART if noisy & APART else NAMED


def _noise(name: str, attributes: str) -> tuple[int, str]:
    """Whether and how an element is left out, and its generalised class names."""
    noise = STRAY if name in LEFT_OUT else 0
    if not attributes.strip():
        return noise, ""
    classes, by_name = "", 0
    for found in _ATTRIBUTE.finditer(attributes):
        key, value = (found[1] or "hidden").lower(), found[2] or found[3] or found[4] or ""
        if key in ("class", "id"):
            by_name = max(by_name, _named_noise(name, key, value), key=lambda kind: (kind == STRAY, kind))
            if key == "class":
                classes = "".join(f".{_DIGITS.sub('#', c)}" for c in sorted(value.split()))
        elif key == "role":
            noise |= value.lower() in ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            noise = STRAY
    return noise or by_name, classes


def _named(path: str) -> str:
    """Name of the last element of a path."""
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


def _adds_text(unlinked: dict[tuple[str, ...], bool], up: str, path: str) -> bool:
    """Whether what the container ``up`` holds besides ``path`` is text of the same article."""
    added = [chain for chain in unlinked if up in chain and path not in chain]
    if _named(up) == "body" and any(chain[-1] != up for chain in added):
        return False
    return bool(added) and all(unlinked[chain] for chain in added)


class Page:
    """Blocks of a page in order: text, characters of link text, and the paths of the containers around."""

    def __init__(self, html: str | None):
        self.blocks: list[tuple[str, int, tuple[str, ...]]] = []
        self.stack: list[tuple[str, str, int]] = []  # name, path, left out
        self.muted = 0
        self.open: dict[str, list[int]] = defaultdict(list)  # places of each name on the stack, so it is never searched
        self.closed_in, self.not_inline = [-1], [-1]  # places of such elements on the stack
        self.chain: list[str] = []  # paths of the containers around
        self.chain_now: tuple[str, ...] | None = None
        self.doubtful = [-1]  # containers around that are left out unless they hold most text
        self.kinds: list[int] = []
        self.outside: list[int] = []  # the next doubtful container around each
        self.around_article: set[int] = set()
        self.within: list[int] = []  # innermost doubtful container of each block
        self.parts: list[str] = []
        self.links, self.in_link = 0, False
        html = html or ""
        at = 0
        for token in _TOKEN.finditer(html):
            if token.start() > at:
                self._text(html[at : token.start()])
            at = token.end()
            if name := token["name"]:
                self._tag(name.lower(), bool(token["end"]), token["rest"])
        self._text(html[at:])
        self._flush()
        if self.kinds:
            self._settle()

    def _settle(self) -> None:
        """Leave out the blocks of doubtful containers that do not hold most of the text."""
        for k in reversed(range(len(self.kinds))):
            if k in self.around_article:
                self.around_article.add(self.outside[k])

        def spread(dropped: list[bool]) -> list[bool]:
            for k, outer in enumerate(self.outside):
                dropped[k] = dropped[k] or (outer >= 0 and dropped[outer])
            return [*dropped, False]  # the last one stands for no container

        apart = spread([kind == SET_APART and k not in self.around_article for k, kind in enumerate(self.kinds)])
        held, total = [0] * len(apart), 0
        for (text, links, _), k in zip(self.blocks, self.within):
            if not apart[k]:
                held[k] += len(text) - links
                total += len(text) - links
        for k in reversed(range(len(self.kinds))):
            held[self.outside[k]] += held[k]
        dropped = spread([apart[k] or 2 * held[k] <= total for k in range(len(self.kinds))])
        self.blocks = [block for block, k in zip(self.blocks, self.within) if not dropped[k]]

    def _text(self, text: str) -> None:
        if not self.muted:
            self.parts.append(text)
            self.links += len(text) * self.in_link

    def _flush(self) -> None:
        text = " ".join(unescape("".join(self.parts)).split()) if self.parts else ""
        if text:
            if self.chain_now is None:
                self.chain_now = tuple(self.chain) or ("",)
            self.blocks.append((text, min(self.links, len(text)), self.chain_now))
            self.within.append(self.doubtful[-1])
        self.parts, self.links, self.in_link = [], 0, False

    def _tag(self, name: str, end: bool, attributes: str) -> None:
        if name in VOID:
            if name == "hr":
                self._flush()
            self._text(" ")
            return
        if name == "a":
            self.in_link = not end
        if end:
            self._close(name)
        elif name in INLINE:
            noise, _ = _noise(name, attributes)
            if noise or any(s[0] == name for s in self.stack[-1:]):
                self._push(name, "", noise)
        else:
            self._flush()
            if self.stack and self.stack[-1][0] == "p":
                self._pop()
            self._close_open(CLOSES.get(name, ()))
            noise, classes = _noise(name, attributes)
            if name == "header":
                noise = noise if self.open["article"] or self.open["main"] else STRAY
            if name == "form" and noise != STRAY:
                noise = NAMED if all(s[0] in ("html", "body") for s in self.stack[:3]) else SET_APART
            lead = name == "p" and not LEADS.isdisjoint(w.lower() for w in _WORDS.findall(classes))
            if self.open["header"] and not lead and name not in ("h1", "h2", "h3", "h4", "h5", "h6", "div", "hgroup"):
                noise = STRAY
            if self.kinds and name in ("article", "main", "h1") and not (noise or self.muted):
                if NOISE.isdisjoint(w.lower() for w in _WORDS.findall(classes)):  # comments are articles at times
                    self.around_article.add(self.doubtful[-1])
            self._push(name, classes, noise)

    def _push(self, name: str, classes: str, noise: bool) -> None:
        above, at = self.stack[-1][1] if self.stack else "", len(self.stack)
        path = f"{above}/{name}{classes}" if name in CONTAINERS and at < DEEPEST else above
        if path != above:
            self.chain.append(path)
            self.chain_now = None
        self.stack.append((name, path, noise))
        self.open[name].append(at)
        if name in CLOSED_IN:
            self.closed_in.append(at)
        if name not in INLINE:
            self.not_inline.append(at)
        self.muted += noise == STRAY
        if noise > STRAY:
            self.outside.append(self.doubtful[-1])
            self.doubtful.append(len(self.kinds))
            self.kinds.append(noise)

    def _pop(self) -> None:
        name, path, noise = self.stack.pop()
        if path != (self.stack[-1][1] if self.stack else ""):
            self.chain.pop()
            self.chain_now = None
        self.open[name].pop()
        if name in CLOSED_IN:
            self.closed_in.pop()
        if name not in INLINE:
            self.not_inline.pop()
        self.muted -= noise == STRAY
        if noise > STRAY:
            self.doubtful.pop()

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._pop()

    def _close_open(self, names) -> None:
        """End the open items of the same list or row."""
        last = self.closed_in[-1]
        places = [self.open[n][bisect(self.open[n], last)] for n in names if self.open[n] and self.open[n][-1] > last]
        if places:
            self._pop_to(min(places))

    def _close(self, name: str) -> None:
        inline = name in INLINE
        if not inline:
            self._flush()
        if self.open[name] and not (inline and self.open[name][-1] < self.not_inline[-1]):
            self._pop_to(self.open[name][-1])

    def best(self) -> tuple[str, float] | None:
        """Path and score of the container with most text."""
        scores: dict[str, float] = defaultdict(float)
        per_chain: dict[tuple[str, ...], float] = defaultdict(float)
        for text, links, chain in self.blocks:
            per_chain[chain] += len(text) - links
        for chain, worth in per_chain.items():
            for path in reversed(chain):
                scores[path] += worth
                worth /= 2
        return max(scores.items(), key=lambda s: (s[1], -len(s[0]), s[0]), default=None)

    def vote(self) -> tuple[str, float] | None:
        """Path and score of the best container, the path lifted to the whole article around it."""
        if not (found := self.best()):
            return None
        path, score = found
        unlinked: dict[tuple[str, ...], bool] = {}  # whether no block of a chain is mostly link text
        for text, links, chain in self.blocks:
            unlinked[chain] = 2 * links <= len(text) and unlinked.get(chain, True)
        parents = {p: above for chain in unlinked for above, p in zip(("", *chain), chain) if above != p}
        up = path
        while up:
            if _named(up) in ("article", "main"):
                return up, score
            up = parents[up]
        while (up := parents.get(path, "")) and _adds_text(unlinked, up, path):
            path = up
        return path, score

    def text(self, path: str | None) -> str:
        inside = {chain for chain in {chain for _, _, chain in self.blocks} if path in chain}
        if not inside and self.blocks:
            return self.text(self.vote()[0])
        return "\n".join(text for text, _, chain in self.blocks if chain in inside)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple[str, str], list] = defaultdict(lambda: [0, 0.0])
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if found := Page(html).vote():
                vote = votes[host_of(url), found[0]]
                vote[0] += 1
                vote[1] += found[1]
        keys = list(votes)
        columns = [[k[0] for k in keys], [k[1] for k in keys], [votes[k][0] for k in keys], [votes[k][1] for k in keys]]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["host", "path", "votes", "score"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(html).text(path) for html, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def host_paths(pages: DataFrame) -> DataFrame:
    """The winning path of each host: ``host, path``."""
    votes = pages.select("url", "html").mapInArrow(_votes, "host string, path string, votes long, score double")
    counted = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.round(F.sum("score")).alias("score"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("votes", "score", "path")).alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    The hosts' paths are broadcast up to ``BROADCAST_HOSTS`` hosts (a few hundred bytes each) and joined by sorting
    beyond, where adaptive execution splits large hosts.
    """
    paths = materialize(host_paths(pages), "host-paths")
    facts = paths.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)).alias("chars")).first()
    small = facts["n"] <= BROADCAST_HOSTS and facts["chars"] <= 200 * BROADCAST_HOSTS
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST.pattern, 1))
    rows = pages.select("page_id", "url", "html", host.alias("host")).join(paths.hint("broadcast" if small else "merge"), "host", "left")
    return rows.select("page_id", "url", "html", "path").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
