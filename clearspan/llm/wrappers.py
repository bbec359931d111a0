"""Wrappers of hosts as union-free regular expressions over the tags of their pages.

A page is a stream of tags and texts. A wrapper is a sequence of tags, text slots, optional groups and repeated
groups that holds for all pages it was made from. It starts as the first page, repeats folded, and is aligned
with one page after the other: what only one of them has becomes an optional group.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left
from collections import Counter
from difflib import SequenceMatcher
from typing import NamedTuple

TEXT = "#"
OPTIONAL, REPEATED = "?", "+"
#: Longest group, in nodes, that is looked for as a repetition.
LONGEST_GROUP = 16

# Element names by what they mean for the text of a page.
RAW = {"script", "style", "textarea"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br",
}
UNCLOSED = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot", "h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE = {"head", "title", "nav", "header", "footer", "aside", "form", "menu", "button", "select", "option", "dialog", "fieldset", "input"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "header", "masthead", "footer", "copyright", "cookie", "cookies", "consent",
    "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "form", "search", "comment",
    "comments", "commentlist", "disqus", "respond", "reply", "replies", "share", "sharing", "social", "related", "recommended", "widget", "toolbar",
    "pagination", "pager",
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _start_tag(name: str, attributes: str) -> str:
    """The name with class, id and role, numbers left out: what pages of one template share."""
    if "=" not in attributes:
        return name
    found = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), re.sub(r"\d+", "", next((v for v in values if v), "")))
    marks = [f"{k}={' '.join(sorted(found[k].split()))}" for k in ("class", "id", "role") if found.get(k)]
    return " ".join([name, *marks])


def tokens(page: str) -> tuple[list[str], list[str]]:
    """The stream of a page and, of equal length, the raw text where the token is a text. Blank text is left out."""
    stream: list[str] = []
    texts: list[str] = []
    at, pending = 0, []

    def close_text() -> None:
        text = "".join(pending)
        pending.clear()
        if text:
            stream.append(TEXT)
            texts.append(text)

    while True:
        found = _MARKUP.search(page, at)
        pending.append(page[at : found.start() if found else len(page)])
        if not found:
            close_text()
            return stream, texts
        at = found.end()
        end, start = found.group(1), found.group(2)
        if not end and not start:
            continue  # a comment or declaration does not part a text
        close_text()
        if end:
            stream.append("/" + end.lower())
        else:
            name = start.lower()
            stream.append(_start_tag(name, found.group(3) or ""))
            if name in RAW and not found.group(0).endswith("/>"):
                closing = re.compile(f"</{re.escape(name)}[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, at)
                at = closing.end() if closing else len(page)
                texts.append("")
                stream.append("/" + name)
        texts.append("")


_REPEATS = {width: re.compile(f"(.{{{width}}})\\1+", re.DOTALL) for width in range(1, LONGEST_GROUP + 1)}


def fold(nodes: list) -> list:
    """Adjacent equal groups become one repeated group, short ones first.

    Each different node is one character, so that repeats are found by back references.
    """
    numbers: dict = {}
    text = "".join(chr(numbers.setdefault(n, len(numbers))) for n in nodes)
    known = list(numbers)

    def folded(found: re.Match) -> str:
        group = found.group(1)
        if len(group) == 1 and isinstance(known[ord(group)], tuple):
            return found.group(0) if known[ord(group)][0] == OPTIONAL else group
        node = (REPEATED, tuple(known[ord(c)] for c in group))
        if node not in numbers:
            numbers[node] = len(known)
            known.append(node)
        return chr(numbers[node])

    before = None
    while before != text:
        before = text
        for width, repeats in _REPEATS.items():
            if 2 * width <= len(text):
                text = repeats.sub(folded, text)
    return [known[ord(c)] for c in text]


def _absorb(nodes: list, groups: list[tuple]) -> list:
    """Plain stretches that equal a group the other side knows become that group."""
    for group in sorted(groups, key=lambda g: (-len(g[1]), g[0])):
        body, out, i = list(group[1]), [], 0
        while i < len(nodes):
            j = i
            while nodes[j : j + len(body)] == body:
                j += len(body)
                if group[0] == OPTIONAL:
                    break
            if j > i:
                out.append(group)
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _groups(nodes: list) -> list[tuple]:
    return list(dict.fromkeys(n for n in nodes if isinstance(n, tuple)))


def _optional(nodes: list) -> list:
    """The nodes as one optional group; groups that are optional already stay."""
    out, run = [], []
    for node in [*nodes, None]:
        if node is not None and not (isinstance(node, tuple) and node[0] == OPTIONAL) and node != TEXT:
            run.append(node)
            continue
        if node == TEXT and run:
            run.append(node)  # a text slot inside a group; a slot of its own may be empty anyway
            continue
        if run:
            out.append((OPTIONAL, tuple(run)))
            run = []
        if node is not None:
            out.append(node)
    return out


def align(wrapper: list, page: list) -> list:
    """A wrapper for what ``wrapper`` holds for and for one more folded page."""
    known = [g for g in _groups(wrapper) if g[0] == REPEATED]
    page = _absorb(page, known + [g for g in _groups(wrapper) if g[0] == OPTIONAL])
    wrapper = _absorb(wrapper, [g for g in _groups(page) if g[0] == REPEATED])
    merged: list = []
    a = c = 0
    for b, d in [*_anchors(wrapper, page), (len(wrapper), len(page))]:
        for kind, i, j, k, m in SequenceMatcher(None, wrapper[a:b], page[c:d], autojunk=False).get_opcodes():
            if kind == "equal":
                merged += wrapper[a + i : a + j]
            else:
                merged += _optional(wrapper[a + i : a + j]) + _optional(page[c + k : c + m])
        merged += wrapper[b : b + 1]
        a, c = b + 1, d + 1
    return merged


def _anchors(x: list, y: list) -> list[tuple[int, int]]:
    """Places of nodes that each side has once, as many as come in the same order on both: the frame of the pages."""
    once = [{n: i for i, n in enumerate(nodes) if count[n] == 1} for nodes, count in ((x, Counter(x)), (y, Counter(y)))]
    pairs = [(i, once[1][n]) for n, i in once[0].items() if n in once[1]]
    ends: list[int] = []
    back: list[tuple[int, int, object]] = []
    for i, j in pairs:
        k = bisect_left(ends, j)
        chain = (i, j, back[k - 1] if k else None)
        if k == len(ends):
            ends.append(j)
            back.append(chain)
        else:
            ends[k], back[k] = j, chain
    found, chain = [], back[-1] if back else None
    while chain:
        found.append(chain[:2])
        chain = chain[2]
    return found[::-1]


class Place(NamedTuple):
    """Where a token of a page lies."""

    article: bool
    main: bool
    #: Aside of both, told by names, roles or a whole class or id; and also by single words outside of articles and main parts.
    aside: bool
    aside_by_word: bool
    #: The open elements that hold parts, and how many of them lead to the innermost article.
    path: tuple[str, ...]
    depth: int

    @property
    def article_path(self) -> tuple[str, ...]:
        return self.path[: self.depth]


_NOWHERE = Place(False, False, False, False, (), 0)


def contexts(stream: list[str]) -> list[Place]:
    """For each token of a page where it lies. An end tag closes the elements that were opened since its start tag."""
    found: list[Place] = []
    stack: list[tuple[str, str, bool, bool]] = []
    now = _NOWHERE
    for token in stream:
        if token != TEXT:
            depth = len(stack)
            if token[0] == "/":
                if any(entry[0] == token[1:] for entry in stack):
                    while stack.pop()[0] != token[1:]:
                        pass
            else:
                name, _, marks = token.partition(" ")
                # Elements that neither part a page nor hold parts would only make the stack deep where they are not closed.
                if name not in VOID and name not in INLINE and name not in UNCLOSED:
                    whole = _lies_aside(name, marks, False)
                    stack.append((name, token, whole, whole or _lies_aside(name, marks, not (now.article or now.main))))
            if len(stack) != depth:
                names = [entry[0] for entry in stack]
                inner = len(names) - names[::-1].index("article") if "article" in names else 0
                now = Place(inner > 0, "main" in names, any(e[2] for e in stack), any(e[3] for e in stack), tuple(e[1] for e in stack), inner)
        found.append(now)
    return found


def _lies_aside(name: str, marks: str, one_word: bool) -> bool:
    """Whether an element says that it lies aside; of class and id with a part of one name or only as a whole."""
    if name in ASIDE or name in RAW:
        return True
    for mark in re.split(r" (?=(?:class|id|role)=)", marks) if marks else ():
        key, _, value = mark.partition("=")
        if key == "role":
            if value.lower() in ASIDE_ROLES:
                return True
            continue
        for part in value.split():
            said = [w.lower() in ASIDE_WORDS for w in _WORD.findall(part)]
            if said and (any(said) if one_word else all(said)):
                return name not in ("html", "body", "article", "main")
    return False


def match(wrapper: list, stream: list[str]) -> list[int] | None:
    """For each token of the stream the place of the wrapper node it matches; None if the wrapper does not hold."""
    places = [-1] * len(stream)

    def size(nodes) -> int:
        return sum(size(n[1]) if isinstance(n, tuple) else 1 for n in nodes)

    def run(nodes, at: int, place: int) -> int:
        for node in nodes:
            if isinstance(node, tuple):
                after = run(node[1], at, place)
                if after < 0 and node[0] == REPEATED:
                    return -1
                while after > at:
                    at = after
                    if node[0] == OPTIONAL:
                        break
                    after = run(node[1], at, place)
                place += size(node[1])
                continue
            if at < len(stream) and stream[at] == node:
                places[at] = place
                at += 1
            elif node != TEXT:
                return -1
            place += 1
        return at

    return places if run(wrapper, 0, 0) == len(stream) else None


def expanded(nodes: list | tuple, twice: int = 2) -> list[str]:
    """A stream that a wrapper holds for, with all its groups; repeated ones come twice, deeply nested ones once."""
    out: list[str] = []
    for node in nodes:
        if isinstance(node, tuple):
            out += expanded(node[1], twice - 1) * (2 if node[0] == REPEATED and twice > 0 else 1)
        else:
            out.append(node)
    return out


def read(nodes: list) -> list:
    """Nodes from JSON."""
    return [(n[0], tuple(read(n[1]))) if isinstance(n, list) else n for n in nodes]


#: Different pages that must have a node before its texts are told to be of the template or not.
TOLD_BY = 3


class Line(NamedTuple):
    """A block with text: the places of its texts in the stream, its text in one line, and the block that it stands in."""

    slots: list[int]
    text: str
    block: str


def lines_of(stream: list[str], texts: list[str]) -> list[Line]:
    """The blocks of a page that have text, in order."""
    found, held, slots, block = [], [], [], ""

    def close() -> None:
        text = "".join(held)
        line = " ".join((html.unescape(text) if "&" in text else text).split())
        if line:
            found.append(Line(slots[:], line, block))
        held.clear()
        slots.clear()

    for i, token in enumerate(stream):
        if token == TEXT:
            held.append(texts[i])
            slots.append(i)
        elif token == "br":
            held.append(" ")
        else:
            name = token.lstrip("/").partition(" ")[0]
            if name not in INLINE:
                if held:
                    close()
                block = "" if token[0] == "/" else token
    if held:
        close()
    return found


def mark(text: str) -> str:
    """What stands for a text where texts are compared."""
    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()


class Fact(NamedTuple):
    """What pages tell of a text slot."""

    #: Where it lies, None if pages differ.
    context: tuple[bool, bool, bool] | None
    #: Marks of the least pages with it, ``TOLD_BY`` of them at most; pages alike in all lines count once.
    pages: tuple[str, ...]
    #: Marks of the lines that begin in it on each of its pages.
    lines: frozenset[str]


#: By place.
Facts = dict[int, Fact]


def page_of(page: str) -> Learned:
    """What one page tells: its folded stream, where its texts lie and what they are."""
    stream, texts = tokens(page)
    nodes = fold(stream)
    places = match(nodes, stream)
    if places is None:  # the groups taken in turn do not give the page back
        nodes, places = stream, list(range(len(stream)))
    lines, lies = lines_of(stream, texts), contexts(stream)
    pages = (mark("\n".join(line.text for line in lines)),)
    began: dict[int, set[str]] = {}
    articles: Counter = Counter()
    for line in lines:
        first = line.slots[0]
        began.setdefault(places[first], set()).add(mark(line.text))
        if lies[first].article and not lies[first].aside:
            articles[" > ".join(lies[first].article_path)] += len(line.text)
    facts: Facts = {}
    for place, lie, token in zip(places, lies, stream, strict=True):
        if token == TEXT:
            context = lie[:3]
            same = place not in facts or facts[place].context == context
            facts[place] = Fact(context if same else None, pages, frozenset(began.get(place, ())))
    return Learned(nodes, facts, 1, articles)


def both(x: Facts, y: Facts) -> Facts:
    """The facts of the pages of both."""
    out = dict(x)
    for place, fact in y.items():
        if place in out:
            context, pages, lines = out[place]
            pages = tuple(sorted({*pages, *fact.pages})[:TOLD_BY])
            fact = Fact(context if context == fact.context else None, pages, lines & fact.lines)
        out[place] = fact
    return out


def moved(facts: Facts, nodes: list, into: list) -> Facts | None:
    """The facts of a wrapper by the places of one made from it; None if that does not hold for what the first holds for."""
    if nodes == into:
        return facts
    stream = expanded(nodes)
    old, new = match(nodes, stream), match(into, stream)
    if old is None or new is None:
        return None
    out: Facts = {}
    for a, b in dict.fromkeys(zip(old, new, strict=True)):
        if a in facts:
            out = both(out, {b: facts[a]})  # slots that become one
    return out


class Learned:
    """A wrapper with the facts of all pages that it was made from, their number, and the characters by article path."""

    def __init__(self, nodes: list, facts: Facts, pages: int, articles: dict[str, int] | None = None):
        self.nodes, self.facts, self.pages, self.articles = nodes, facts, pages, Counter(articles or {})

    def joined(self, other: Learned) -> Learned | None:
        """A wrapper for the pages of both; None if aligning them gives none."""
        if self.nodes == other.nodes or match(self.nodes, expanded(other.nodes)) is not None:
            nodes = self.nodes
        else:
            nodes = align(self.nodes, other.nodes)
        mine, theirs = moved(self.facts, self.nodes, nodes), moved(other.facts, other.nodes, nodes)
        if mine is None or theirs is None:
            return None
        return Learned(nodes, both(mine, theirs), self.pages + other.pages, self.articles + other.articles)

    def dump(self) -> list:
        return [self.nodes, [[place, f.context, f.pages, sorted(f.lines)] for place, f in self.facts.items()], self.pages, self.articles]

    @classmethod
    def load(cls, held: list) -> Learned:
        nodes, facts, pages, articles = held
        told = {place: Fact(context and tuple(context), tuple(marks), frozenset(lines)) for place, context, marks, lines in facts}
        return cls(read(nodes), told, pages, articles)

    def wrapper(self) -> Wrapper:
        told = {place: f for place, f in self.facts.items() if len(f.pages) >= TOLD_BY}
        main = min(self.articles, key=lambda path: (-self.articles[path], path), default=None)
        return Wrapper(self.nodes, {place: (*(f.context or (None,) * 3), *sorted(f.lines)) for place, f in told.items()}, main)


def together(learned: list[Learned]) -> list[Learned]:
    """As few wrappers as aligning gives, each with all pages of those it was made from; that of most pages first."""
    out: list[Learned] = []
    for one in learned:
        for k, other in enumerate(out):
            if (joined := other.joined(one)) is not None:
                out[k] = joined
                break
        else:
            out.append(one)
    return sorted(out, key=lambda x: -x.pages)


class Wrapper:
    """A wrapper with what the pages it was made from say of its slots, by place, and of their articles.

    A label has where the slot lies (None if pages differ) and then the marks of the lines that every page has there.
    ``main`` is the path of the article elements that hold most of the text of all pages.
    """

    def __init__(self, nodes: list, labels: dict[int, tuple], main: str | None = None):
        self.nodes, self.labels, self.main = nodes, labels, main

    def dump(self) -> str:
        return json.dumps([self.nodes, list(self.labels.items()), self.main], ensure_ascii=False)

    @classmethod
    def load(cls, text: str) -> Wrapper:
        nodes, labels, main = json.loads(text)
        return cls(read(nodes), {place: tuple(context) for place, context in labels}, main)


def _main_article(lines: list[Line], lies: list[Place], told: list[bool], main: str | None) -> tuple[str, ...] | None:
    """The path of the article elements that hold the main text: the wrapper's, or those with most of the page's text."""
    sizes: Counter = Counter()
    for line in lines:
        first = line.slots[0]
        if lies[first].article and not told[first]:
            sizes[lies[first].article_path] += len(line.text)
    for path in sizes:
        if " > ".join(path) == main:
            return path
    return min(sizes, key=lambda path: (-sizes[path], path), default=None)


def extract(held: list[Wrapper], page: str) -> tuple[str, bool]:
    """The main text of a page, one line per block, and whether one of the wrappers holds for it.

    The first wrapper that holds tells which article elements are the main ones, of whatever name, and which lines are the
    template's: lines that all its pages have in a slot, unless the page has other lines in blocks of the same kind
    beside them. Other lines are content unless their elements say otherwise by name, role or a whole class or id. Where
    too few pages tell, or no wrapper holds, single words of class and id tell as well, and the article elements with
    most text are the main ones. If nothing is left, the template's lines stay.
    """
    stream, texts = tokens(page)
    lies, labels, main = contexts(stream), {}, None
    told = [lie.aside_by_word for lie in lies]
    places = None
    for wrapper in held:
        places = match(wrapper.nodes, stream)
        if places is not None:
            main = wrapper.main
            labels = {i: wrapper.labels[p] for i, p in enumerate(places) if stream[i] == TEXT and p in wrapper.labels}
            for i, label in labels.items():
                told[i] = lies[i].aside if label[2] is None else label[2]
            break
    every = lines_of(stream, texts)
    kinds = [(lies[line.slots[0]].path, line.block) for line in every]
    fixed = [bool(label := labels.get(line.slots[0])) and mark(line.text) in label[3:] for line in every]
    vary = {kind for kind, same in zip(kinds, fixed, strict=True) if not same}
    content = [line for line, kind, same in zip(every, kinds, fixed, strict=True) if not same or kind in vary]
    for lines in (content, every):
        article = _main_article(lines, lies, told, main)
        slots = [i for line in lines for i in line.slots if not told[i]]
        if article is not None:
            kept = {i for i in slots if lies[i].article_path == article}
        else:
            inside = [i for i in slots if lies[i].main]
            kept = set(inside or slots)
        if kept:
            break
    if all(i in kept for line in lines for i in line.slots):
        return "\n".join(line.text for line in lines), places is not None
    if not any(0 < sum(i in kept for i in line.slots) < len(line.slots) for line in lines):
        return "\n".join(line.text for line in lines if line.slots[0] in kept), places is not None
    shown = {i for line in lines for i in line.slots} & kept
    only = [texts[i] if i in shown else "" for i in range(len(stream))]
    return "\n".join(line.text for line in lines_of(stream, only)), places is not None
