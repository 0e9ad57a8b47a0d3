"""Union-free wrappers of page trees: inference by alignment, and their use.

A wrapper is a page's tree in which text may be fixed or a slot, an element may
be optional, and a run of sibling elements may repeat as a group. It starts as
one page and is aligned with page after page. Text against other text becomes a
slot. An element against another one (a mismatch) is first explained by
repetition: if what follows has the shape of the siblings just before it, these
become a repeated group; else whatever must be skipped to go on becomes optional.
There are no alternatives (unions)."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable

from strata.llm.html_tree import Node

LONGEST_GROUP = 6
TEXT = "#text"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Their classes tell of the page, not of the place.
PAGE_ELEMENTS = frozenset("html body main article".split())
ROOT = 0


class Part:
    """An element, a text or a repeated group of a wrapper."""

    __slots__ = ("sig", "tag", "aside", "fixed", "optional", "repeats", "parts", "size", "seen")

    def __init__(self, sig, tag="", aside=False, fixed=None, parts=None, size=0):
        self.sig, self.tag, self.aside, self.fixed = sig, tag, aside, fixed
        self.optional = self.repeats = False
        self.parts: list[Part] = parts or []
        self.size, self.seen = size, 1          # characters outside links; pages

    @classmethod
    def of(cls, node) -> "Part":
        if isinstance(node, str):
            return cls(TEXT, fixed=node, size=len(node))
        part = cls(node.sig, node.tag, node.aside, parts=[cls.of(p) for p in node.parts])
        part.size = sum(p.size for p in part.parts) - node.link
        return part


def sig_of(node) -> str:
    return TEXT if isinstance(node, str) else node.sig


def merge(part: Part, node) -> None:
    """Widen a wrapper's part so that it covers ``node`` (of the same signature)."""
    part.seen += 1
    if isinstance(node, str):
        part.size += len(node)
        if part.fixed != node:
            part.fixed = None
        return
    part.aside &= node.aside        # an element around a page's heaviest text isn't aside
    part.size += sum(len(p) for p in node.parts if isinstance(p, str)) - node.link
    part.parts = align(part.parts, node.parts)


def fits(group: Part, nodes: list, j: int) -> bool:
    """Whether a turn of the group starts at ``nodes[j]``."""
    own = group.parts
    return j + len(own) <= len(nodes) and all(p.sig == sig_of(n) for p, n in zip(own, nodes[j:]))


def turn(group: Part, nodes: list, j: int) -> int:
    for p, n in zip(group.parts, nodes[j:]):
        merge(p, n)
    return j + len(group.parts)


def first(part: Part) -> str:
    return part.parts[0].sig if part.sig == "#group" else part.sig


def found_group(done: list[Part], upcoming: list[str]) -> int:
    """Length of the run that both ends ``done`` and starts ``upcoming``; 0 if none."""
    for size in range(1, min(LONGEST_GROUP, len(done), len(upcoming)) + 1):
        last = done[-size:]
        if all(p.sig != "#group" and p.sig == s for p, s in zip(last, upcoming)) and any(p.sig != TEXT for p in last):
            return size
    return 0


def as_group(run: list[Part]) -> Part:
    group = Part("#group", parts=run)
    group.repeats = True
    return group


def join(into: Part, other: Part) -> None:
    """Merge a wrapper part into another of the same signature."""
    into.size += other.size
    if into.sig == TEXT:
        into.fixed = into.fixed if into.fixed == other.fixed else None
        return
    left, right = into.parts, other.parts
    if [p.sig for p in left] == [p.sig for p in right]:
        for a, b in zip(left, right):
            join(a, b)
    else:
        known = {p.sig for p in left}
        for p in right:
            if p.sig not in known:
                p.optional = True
                left.append(p)
    for p in left:
        if p.fixed is not None and p.sig == TEXT and len(right) != len(left):
            p.optional = True


class Positions:
    """Where each signature stands among siblings, listed when it is first asked for."""

    def __init__(self, sigs: Callable[[], list[str]]):
        self.sigs, self.at = sigs, None

    def next(self, sig: str, start: int) -> int | None:
        if self.at is None:
            self.at = {}
            for k, own in enumerate(self.sigs()):
                self.at.setdefault(own, []).append(k)
        places = self.at.get(sig, ())
        k = bisect_left(places, start)
        return places[k] if k < len(places) else None


def align(parts: list[Part], nodes: list) -> list[Part]:
    of_nodes, of_parts = Positions(lambda: [sig_of(n) for n in nodes]), Positions(lambda: [first(p) for p in parts])
    done: list[Part] = []
    i = j = 0
    while i < len(parts) or j < len(nodes):
        part = parts[i] if i < len(parts) else None
        if part is not None and part.sig == "#group":
            turns = 0
            while fits(part, nodes, j):
                j = turn(part, nodes, j)
                turns += 1
            part.optional |= turns == 0
            done.append(part)
            i += 1
            continue
        if done and done[-1].sig == "#group" and j < len(nodes) and fits(done[-1], nodes, j):
            j = turn(done[-1], nodes, j)
            continue
        if part is not None and j < len(nodes) and part.sig == sig_of(nodes[j]):
            merge(part, nodes[j])
            done.append(part)
            i, j = i + 1, j + 1
            continue
        # a mismatch: repetition on the page's side, then on the wrapper's
        upcoming = [sig_of(n) for n in nodes[j: j + LONGEST_GROUP]]
        size = found_group(done, upcoming)
        if size:
            group = as_group(done[-size:])
            del done[-size:]
            while fits(group, nodes, j):
                j = turn(group, nodes, j)
            done.append(group)
            continue
        upcoming = [p.sig for p in parts[i: i + LONGEST_GROUP]]
        size = found_group(done, upcoming)
        if size:
            group = as_group(done[-size:])
            del done[-size:]
            while i + size <= len(parts) and [p.sig for p in parts[i: i + size]] == [p.sig for p in group.parts]:
                for a, b in zip(group.parts, parts[i: i + size]):
                    join(a, b)
                i += size
            done.append(group)
            continue
        # else options: skip to the nearest place where both sides go on
        skip_nodes = of_nodes.next(first(part), j) if part is not None else None
        skip_parts = of_parts.next(sig_of(nodes[j]), i) if j < len(nodes) else None
        if part is None or (skip_nodes is not None and (skip_parts is None or skip_nodes - j <= skip_parts - i)):
            stop = len(nodes) if part is None else skip_nodes
            for n in nodes[j:stop]:
                new = Part.of(n)
                new.optional = True
                done.append(new)
            j = stop
        else:
            stop = len(parts) if j == len(nodes) else skip_parts if skip_parts is not None else i + 1
            for p in parts[i:stop]:
                p.optional = True
            done.extend(parts[i:stop])
            i = stop
    return collapsed(done)


def collapsed(parts: list[Part]) -> list[Part]:
    """Equal neighbours that options have left side by side become one group."""
    out: list[Part] = []
    for p in parts:
        if out and p.sig not in ("#group", TEXT) and p.optional:
            if out[-1].sig == "#group" and len(out[-1].parts) == 1 and out[-1].parts[0].sig == p.sig:
                join(out[-1].parts[0], p)
                continue
            if out[-1].sig == p.sig and out[-1].optional:
                join(out[-1], p)
                out[-1] = as_group([out[-1]])
                out[-1].optional = True
                continue
        out.append(p)
    return out


def infer(pages: list[Node]) -> Part:
    wrapper = Part.of(pages[0])
    for page in pages[1:]:
        merge(wrapper, page)
    return wrapper


# -- the article's place ----------------------------------------------------------


def content_path(wrapper: Part) -> list[str]:
    """Signatures from the root to the element that holds the article: an
    ``article`` or ``main`` element if there is one, else the deepest element
    with most of the text that is neither fixed, linked nor beside the article."""
    def weigh(part: Part) -> int:
        if part.aside:
            return 0
        if part.sig == TEXT:
            return part.size if part.fixed is None or part.seen < 2 else 0
        return sum(map(weigh, part.parts)) + min(0, part.size if not part.parts else 0)

    def flat(parts: list[Part]):
        for p in parts:
            if p.sig == "#group":
                yield from flat(p.parts)
            elif p.sig != TEXT and not p.aside:
                yield p

    def named(part: Part, tag: str, path: list[str]):
        for p in flat(part.parts):
            if p.tag == tag:
                yield weigh(p), [*path, p.sig]
            else:
                yield from named(p, tag, [*path, p.sig])

    for tag in ("article", "main"):
        best = max(named(wrapper, tag, []), default=None, key=lambda x: x[0])
        if best:
            return best[1]
    path, at = [], wrapper
    while True:
        children = list(flat(at.parts))
        heaviest = max(children, key=weigh, default=None)
        total = sum(map(weigh, children)) + sum(p.size for p in at.parts if p.sig == TEXT)
        if heaviest is None or heaviest.tag in ("p", "li", "td", "h1", "h2", "h3") or weigh(heaviest) <= 0.6 * total:
            return path
        path, at = [*path, heaviest.sig], heaviest


# -- texts and their places ---------------------------------------------------------


def digest(*parts: str) -> int:
    own = hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(own, "little", signed=True)


class Places:
    """Numbers of places (the elements from the root down), remembered as they recur."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}

    def below(self, place: int, node: Node) -> int:
        key = place, node.tag if node.tag in PAGE_ELEMENTS else node.sig
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = digest(str(place), key[1])
        return self.known[key]


def placed_texts(page: Node, places: Places) -> tuple[set[int], dict[int, tuple[int, bool]]]:
    """The places of a page, and digest -> (place, whether that holds several texts)
    of its texts at their places. Headings and asides are left out."""
    at: dict[int, list[int]] = {}

    def walk(node: Node, place: int) -> None:
        own = at.setdefault(place, [])
        for p in node.parts:
            if isinstance(p, str):
                own.append(digest(str(place), p))
            elif not p.aside and p.tag not in HEADINGS:
                walk(p, places.below(place, p))

    walk(page, ROOT)
    return set(at), {text: (place, len(own) > 1) for place, own in at.items() for text in own}


class Unread(str):
    """A text of which only the digest and the length are known."""

    def __new__(cls, own: str, size: int):
        text = super().__new__(cls, own)
        text.size = size
        return text

    def __len__(self) -> int:
        return self.size


def packed(node: Node) -> list:
    """What alignment sees of a page's tree, as nested lists; texts by digest and length."""
    return [node.sig, int(node.aside), node.link,
            [[digest(p), len(p)] if isinstance(p, str) else packed(p) for p in node.parts]]


def unpacked(own: list) -> Node:
    sig, aside, link, parts = own
    node = Node(sig.split(".")[0], sig, bool(aside))
    node.link = link
    node.parts = [Unread(str(p[0]), p[1]) if len(p) == 2 else unpacked(p) for p in parts]
    return node


def subject(page: Node) -> int:
    """What a page is about: its title, headings and first other text; all its
    text, if it has no heading. Copies and near copies of a page have the same."""
    title: list[str] = []
    headings: list[str] = []
    others: list[str] = []

    def walk(node: Node, into: list[str]) -> None:
        for p in node.parts:
            if isinstance(p, str):
                into.append(p)
            elif p.tag == "title":
                walk(p, title)
            elif p.tag == "head":
                walk(p, [])
            elif not p.aside:
                walk(p, headings if p.tag in HEADINGS else into)

    walk(page, others)
    return digest(*title, "", *headings, "", *(others[:1] if headings else others))


def article(page: Node, path: list[str], template: frozenset[int], known: Places | None = None) -> list[str] | None:
    """The blocks of text that the wrapper's place holds on a page, but those whose
    digest at their place is among ``template``; None if the page lacks the place."""
    known = known or Places()
    places = [(page, ROOT)]
    for depth, sig in enumerate(path):
        below = [(n, known.below(at, n)) for place, at in places for n in place.parts if not isinstance(n, str) and n.sig == sig]
        if not below and depth == len(path) - 1:        # the same element, other classes
            tag = sig.split(".")[0]
            below = [(n, known.below(at, n)) for place, at in places for n in place.parts
                     if not isinstance(n, str) and n.tag == tag and not n.aside]
        if not below:
            return None
        places = below
    out: list[str] = []

    def walk(node: Node, at: int, counts: bool) -> None:
        for p in node.parts:
            if isinstance(p, str):
                if not (counts and digest(str(at), p) in template):
                    out.append(p)
            elif not p.aside:
                walk(p, known.below(at, p) if counts else at, counts and p.tag not in HEADINGS)

    for place, at in places:
        walk(place, at, bool(template))
    return out
