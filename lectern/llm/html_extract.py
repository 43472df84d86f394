"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from lectern.llm.common import map_column, unused

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: What ends a tag, or opens a quoted value within it.
_STOP = re.compile(r""">|=\s*+(["'])""")
_MARK = re.compile(r"""\b(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, up to their end tag; of the second kind, only if they have one.
_RAW = frozenset("script style noscript title textarea iframe xmp".split())
_SKIPPED = frozenset("template svg math select object canvas".split())
_IN_HEAD = frozenset("title meta link script style base noscript template".split())
_DROP = frozenset("head nav footer aside button dialog menu label video audio map".split())
#: Elements that are dropped unless they hold most of the page.
_WRAPS = frozenset("form fieldset".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADINGS | frozenset("p blockquote pre li dt dd td th tr table tbody figure figcaption".split())
#: Words of a class or id that mark a part of the page outside the article, whatever stands beside them ...
_OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus popup modal footer masthead topbar newsletter pagination pager".split()
)
#: ... or only where the words beside them are such words too, or say nothing.
_OUTSIDE_ALONE = frozenset("share sharing social related recommended notice notices alert consent cookie cookies subscribe signup login promo overlay widget toolbar respond".split())
_NEUTRAL = frozenset(
    "box bar area block section container wrapper wrap list links link buttons button item items panel content posts post articles article stories news top bottom left right inner outer main site page global primary secondary title icons icon tools tool text form group row col column module region zone slot unit entry blog single wp the".split()
)
_ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo".split())
_COMMENTS = frozenset("comment comments disqus".split())
_OUTSIDE_STARTS = ("commentlist", "commentform", "adsense", "adslot", "adbox", "adunit", "advert", "sponsor", "breadcrumb", "newsletter", "cookie")
_HEADER = frozenset("site page main top global header".split())
_ROLES = frozenset("navigation banner complementary contentinfo search alert dialog form menu menubar alertdialog".split())
#: A start tag of the key closes an open element of the value.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol table article section div main body html td th dl blockquote".split())
_ITEMS = _SCOPE | _CLOSES.keys()
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Why a node may be dropped: never, if it doesn't hold most of the page, or always.
_STAYS, _SOFT, _HARD = 0, 1, 2
#: Shares of the page's text from which a wrapping form, or a part with an outside name, is its container.
_MOST = {"form": 0.5, "fieldset": 0.5}
_NEARLY_ALL = 0.8


class _Tree:
    """The elements of a page, numbered in order of their start tags, with the text that stands in them.

    What an end tag, an implied end or an unclosed quote refers to is found without walking the open elements or the page again, so the time is in
    proportion to the page, however deep or broken it is."""

    def __init__(self) -> None:
        self.tags, self.parent, self.last, self.drop = ["#root"], [-1], [0], [_STAYS]
        self.block, self.item, self.depth = [0], [0], [0]  # of each node: the nearest node that is not inline, and that lists and tables look for
        self.linked, self.inside = [False], [False]
        self.runs: list[tuple[int, int, bool, str]] = []  # text in page order: node, its block, whether it is within a link, text
        self.stack = [0]
        self.open: dict[str, list[int]] = {}  # by name, the places in the stack

    def close(self, depth: int) -> None:
        while len(self.stack) > depth:
            node = self.stack.pop()
            self.last[node] = len(self.tags) - 1
            self.open[self.tags[node]].pop()

    def text(self, raw: str) -> None:
        if raw:
            if self.open.get("head") and not raw.isspace():
                self.close(self.open["head"][-1])
            node = self.stack[-1]
            self.runs.append((node, self.block[node], self.linked[node], html.unescape(raw) if "&" in raw else raw))

    def end(self, name: str) -> None:
        places = self.open.get(name)
        if places and name not in ("body", "html"):
            if name not in _INLINE or places[-1] > self.depth[self.block[self.stack[-1]]]:  # an inline end tag closes no block
                self.close(places[-1])

    def start(self, name: str, attributes: str) -> None:
        if name in ("body", "html") and self.open.get(name):
            return
        if self.open.get("head") and name not in _IN_HEAD:
            self.close(self.open["head"][-1])
        if name in _CLOSES_P:
            near = self.block[self.stack[-1]]
            if self.tags[near] == "p":
                self.close(self.depth[near])
        elif name in _CLOSES:
            near = self.item[self.stack[-1]]
            while near and self.tags[near] not in _CLOSES[name] and (self.tags[near] not in _SCOPE or name == "tr" and self.tags[near] in ("td", "th")):
                near = self.item[self.parent[near]]
            if self.tags[near] in _CLOSES[name]:
                self.close(self.depth[near])
        up, node = self.stack[-1], len(self.tags)
        if name in ("br", "hr"):
            self.runs.append((up, self.block[up], False, " "))
            return
        if name in _VOID:
            return
        self.tags.append(name)
        self.parent.append(up)
        self.last.append(node)
        self.block.append(self.block[up] if name in _INLINE else node)
        self.item.append(node if name in _ITEMS else self.item[up])
        self.depth.append(len(self.stack))
        self.linked.append(self.linked[up] or name == "a")
        self.inside.append(self.inside[up] or name in ("article", "main"))
        if name in _DROP or name == "header" and not self.inside[up]:
            self.drop.append(_HARD)
        else:
            self.drop.append(max(_SOFT if name in _WRAPS else _STAYS, _outside(name, attributes, self.inside[up])))
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append(node)


def _scan(page: str) -> _Tree:
    tree = _Tree()
    at, end = 0, len(page)
    missing: set[str] = set()  # what does not occur from here on
    next_close = -1  # the first > from here on

    def find(what: str, start: int) -> int:
        if what in missing:
            return -1
        found = page.find(what, start)
        if found < 0:
            missing.add(what)
        return found

    while at < end:
        begin = page.find("<", at)
        if begin >= 0 and next_close < begin:
            next_close = page.find(">", begin)
        if begin < 0 or next_close < 0:
            tree.text(page[at:])
            break
        tag = _NAME.match(page, begin)
        if tag is None:
            if page.startswith("<!--", begin):
                tree.text(page[at:begin])
                done = find("-->", begin + 4)
                at = end if done < 0 else done + 3
            elif page.startswith(("<!", "<?"), begin):
                tree.text(page[at:begin])
                at = next_close + 1
            else:
                tree.text(page[at : begin + 1])
                at = begin + 1
            continue
        tree.text(page[at:begin])
        name, stop, done = tag[2].lower(), tag.end(), next_close
        while stop >= 0 and "tag end" not in missing:
            found = _STOP.search(page, stop)
            if found is None:
                missing.add("tag end")
            elif found[1] is None:
                done, stop = found.start(), -1
            else:
                stop = find(found[1], found.end()) + 1
                if not stop:
                    done, stop = max(done, page.find(">", found.end())), -1
        attributes, at = page[tag.end() : done], done + 1
        if tag[1]:
            tree.end(name)
        elif (name in _RAW or name in _SKIPPED) and not attributes.endswith("/"):
            closing = None if name in missing else re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if closing is None:
                missing.add(name)
                at = end if name in _RAW else at
            else:
                done = page.find(">", closing.end())
                at = end if done < 0 else done + 1
        elif name not in _RAW and name not in _SKIPPED:
            tree.start(name, attributes)
    tree.close(1)
    tree.last[0] = len(tree.tags) - 1
    return tree


def _names_outside(name: str, token: str, inside: bool) -> bool:
    """Whether a class or id names a part outside the article. Within an article, all its words must say so, and of a paragraph or heading only adverts do."""
    words = _WORD.findall(token)
    if not words or words[0] in ("has", "with", "without", "no", "is"):
        return False
    if inside and name in _PROSE:
        return _ADVERTS.issuperset(words)
    if name in _HEADINGS:
        return False
    if "header" in words and _HEADER.issuperset(words):
        return True
    strong = [w in _OUTSIDE or w.startswith(_OUTSIDE_STARTS) for w in words]
    if any(strong) and not inside:
        return True
    known = [a or w in _OUTSIDE_ALONE for a, w in zip(strong, words, strict=True)]
    return any(known) and all(k or w in _NEUTRAL for k, w in zip(known, words, strict=True))


def _outside(name: str, attributes: str, inside: bool) -> int:
    if not attributes or name in ("html", "body"):
        return _STAYS
    found = _STAYS
    for key, value in _MARK.findall(attributes):
        key, tokens = key.lower(), value.lower().strip("\"'").split()
        if key in ("class", "id"):
            for token in tokens:
                if _names_outside(name, token, inside):
                    hard = not _COMMENTS.isdisjoint(_WORD.findall(token)) or token.startswith("comment")
                    if name not in ("article", "main") or hard:
                        found = max(found, _HARD if hard else _SOFT)
        elif name not in ("article", "main") and (key == "role" and not _ROLES.isdisjoint(tokens) or key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            found = _HARD
    return found


def _dropped(tree: _Tree) -> list[bool]:
    """Whether each node is outside the article by its own or an outer element's name. A form or a part with an outside name that holds most of the page's text
    is the page's container, if no article stands elsewhere; and if nothing else is left, such names count for nothing."""
    n = len(tree.tags)
    hard, size, articles = [False] * n, [0] * n, [0] * n
    for node in range(1, n):
        hard[node] = hard[tree.parent[node]] or tree.drop[node] == _HARD
        articles[node] = tree.tags[node] in ("article", "main") and not hard[node]
    for node, _, _, x in tree.runs:
        if not hard[node]:
            size[node] += len(x) - x.count(" ")
    for node in range(n - 1, 0, -1):  # a child has a higher number than its parent
        size[tree.parent[node]] += size[node]
        articles[tree.parent[node]] += articles[node]

    def verdict(soft: bool) -> list[bool]:
        out = hard[:]
        for node in range(1, n):
            least = _MOST.get(tree.tags[node], _NEARLY_ALL) * size[0]
            wraps = size[node] > least and articles[node] == articles[0]
            out[node] = out[node] or out[tree.parent[node]] or soft and tree.drop[node] == _SOFT and not wraps
        return out

    out = verdict(True)
    return out if any(not out[node] and not x.isspace() for node, _, _, x in tree.runs) else verdict(False)


def extract(page: str | None) -> str:
    """The article of one page; an empty text for a null or empty page or one without text."""
    if not page:
        return ""
    tree = _scan(page)
    out = _dropped(tree)
    return _kept(tree.tags, tree.parent, tree.last, [(block, link, x) for node, block, link, x in tree.runs if not out[node]])


def _kept(tags: list[str], parent: list[int], last: list[int], runs: list[tuple[int, bool, str]]) -> str:
    n = len(tags)
    size, links, commas = [0] * n, [0] * n, [0] * n
    for node, link, x in runs:
        k = len(x) - x.count(" ")
        size[node] += k
        links[node] += k * link
        commas[node] += x.count(",")
    own = size[:]
    score = [0.0] * n
    for node in range(n):
        if own[node]:
            points = (1 + commas[node] + min(own[node] / 100, 3)) * (1 - links[node] / own[node])
            up, share = (parent[node] if node else 0), 1.0
            for level in range(3):
                score[up] += points * share
                if up == 0:
                    break
                up, share = parent[up], 1 / (2 * (level + 1))
    for node in range(n - 1, 0, -1):  # a child has a higher number than its parent
        size[parent[node]] += size[node]
        links[parent[node]] += links[node]
    for node in range(n):
        score[node] *= 1 - links[node] / max(1, size[node])
        if tags[node] in ("article", "main"):
            score[node] *= 1.5
    best = max(range(n), key=lambda i: (score[i], -i))
    inside, up = [], best
    while up > 0:
        inside += [up] if tags[up] == "article" else []
        up = parent[up]
    if not inside:
        up = best
        while up > 0:
            inside += [up] if tags[up] == "main" else []
            up = parent[up]
    best = inside[-1] if inside else best
    chosen = [best]
    if best:
        least = max(3.0, 0.2 * score[best])
        for node in range(parent[best] + 1, last[parent[best]] + 1):
            if parent[node] == parent[best] and node != best:
                density = links[node] / max(1, size[node])
                if score[node] >= least and density < 0.5 or tags[node] == "p" and size[node] > 80 and density < 0.25 and tags[best] not in ("article", "main"):
                    chosen.append(node)
    keep = bytearray(n)
    for node in chosen:
        keep[node : last[node] + 1] = b"\1" * (last[node] + 1 - node)
    out: list[str] = []
    before = -1
    for node, _, x in runs:
        if keep[node]:
            out += [" ", x] if node != before else [x]
        before = node
    return " ".join("".join(out).split())


def extract_pages(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_column`` in ``out`` instead of it.

    Whole pages only; a null page gives an empty text, equal rows give equal rows, other columns stay (one named as ``out`` is replaced). A narrow map: no shuffle."""
    if out != html_column:
        pages = pages.drop(out)
    page = unused(pages, "__page")
    return map_column(pages.withColumnRenamed(html_column, page), page, f"`{out}` string", lambda batch: {out: [extract(None if x is None else x.decode()) for x in batch]})
