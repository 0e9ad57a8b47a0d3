"""HTML text -> a well-formed tree of blocks; linear in the page's length."""

from __future__ import annotations

import re
from html import unescape

# Element classes of HTML.
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                   "source span strike strong sub sup time track tt u var wbr object param "
                   "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow "
                   "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Not shown as text; a formula's annotation is its source in another notation.
RAW = frozenset("script style noscript template svg iframe canvas annotation annotation-xml".split())
#: Only foreign elements may close themselves.
FOREIGN = frozenset(t for t in INLINE if t[0] == "m" and t != "mark") | {"svg", "semantics", "annotation", "annotation-xml"}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
#: An open element of the value is closed by the start of the key, up to the nearest of the stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# Elements, roles, and whole classes or ids that aren't an article's text.
ASIDE_TAGS = frozenset("nav header footer aside form button select textarea menu dialog head title".split()) | RAW
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
ASIDE_CLASSES = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar side-bar footer header masthead banner "
                          "ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo cookie cookies consent "
                          "cookie-banner cookie-consent cookie-notice notice notices alert popup modal newsletter subscribe "
                          "signup login share sharing share-buttons social social-links social-share related related-posts "
                          "related-articles recommended recommendations comment comments comment-list comments-area disqus "
                          "reply replies discussion widget widget-area toolbar pagination pager site-header site-footer "
                          "site-nav site-navigation main-nav main-navigation page-footer".split())
#: An id names a part of the page on these elements only, and these words name an article's own parts too.
ID_TAGS = frozenset("div section ul ol dl table tr td center details fieldset".split())
ASIDE_IDS = ASIDE_CLASSES - frozenset("discussion notice notices alert related recommendations reply share sharing "
                                      "advertisement header".split())
#: Never aside by role, class or id.
NEVER_ASIDE = frozenset("html body main article".split())
#: Aside unless the heaviest text stands in them.
WEAK_ASIDES = frozenset("form header".split())
OWN_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd".split())

#: Elements nested deeper than this are kept as blocks of the one above.
DEEPEST = 200

NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[A-Za-z]+")
OPEN_VALUE = re.compile(r"=\s*[^\s\"'>]+$")


class Node:
    """An element. ``parts`` holds texts (white space made one blank, references
    decoded) and elements, in order; ``sig`` is what elements are compared by."""

    __slots__ = ("tag", "sig", "aside", "parts", "link")

    def __init__(self, tag: str, sig: str, aside: bool):
        self.tag, self.sig, self.aside, self.parts, self.link = tag, sig, aside, [], 0


def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
    """Position of the > that ends the tag; quotes hide one, if they are closed."""
    while True:
        end = html.find(">", at)
        if end < 0:
            return len(html)
        quote = min((q for q in (html.find('"', at, end), html.find("'", at, end)) if q >= 0), default=-1)
        if quote < 0 or last[html[quote]] <= quote:
            return end
        at = html.find(html[quote], quote + 1) + 1


def _describe(tag: str, attributes: str) -> tuple[str, bool]:
    words: list[str] = []
    aside = tag in ASIDE_TAGS
    if attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name, whole = name.lower(), value.strip("\"'").lower().split()
            if name != "role":
                words += [w.lower() for w in WORD.findall(value)]
            if tag in NEVER_ASIDE or name == "id" and tag not in ID_TAGS:
                continue
            aside |= not {"role": ASIDE_ROLES, "id": ASIDE_IDS, "class": ASIDE_CLASSES}[name].isdisjoint(whole)
    return ".".join([tag, *sorted(set(words))]), aside


def _settle_asides(root: Node) -> None:
    """What lies in an aside is aside, but the elements around the page's heaviest
    text aren't: a wrapper named for its sidebar is no sidebar. Heaviest is the
    element with most text of its own, paragraphs and lists counted, links not; if
    an article or main element has text beside its asides, it is sought there."""
    best: dict[bool, tuple[int, list[Node]]] = {False: (0, []), True: (0, [])}
    trail: list[Node] = []

    def walk(node: Node, named: bool, beside: bool) -> int:
        own = -node.link
        beside |= node.aside
        named = not beside and (named or node.tag in ("article", "main"))
        trail.append(node)
        for p in node.parts:
            if isinstance(p, str):
                own += len(p)
            elif not p.aside or p.tag not in ASIDE_TAGS or p.tag in WEAK_ASIDES:
                below = walk(p, named, beside)
                if p.tag in OWN_TEXT and not p.aside:
                    own += below
        if own > best[named][0]:
            best[named] = own, trail.copy()
        trail.pop()
        return max(0, own)

    walk(root, False, False)
    for node in (best[True][1] or best[False][1]):
        node.aside = False

    def inherit(node: Node) -> None:
        for p in node.parts:
            if not isinstance(p, str):
                p.aside |= node.aside
                inherit(p)

    inherit(root)


def parse(html: str) -> Node:
    root = Node("#root", "#root", False)
    stack, text, n_link, in_link = [root], [], 0, 0
    too_deep: dict[str, int] = {}
    last = {q: html.rfind(q) for q in "\"'"}
    lower = None

    def flush() -> None:
        nonlocal n_link
        if text:
            own = " ".join(unescape("".join(text)).split())
            if own:
                stack[-1].parts.append(own)
                stack[-1].link += n_link
            text.clear()
            n_link = 0

    def close(depth: int) -> None:
        flush()
        del stack[depth:]

    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            start = size
        if start > at:
            text.append(html[at:start])
            n_link += (start - at) * (in_link > 0)
        if start == size:
            break
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        closing = html.startswith("/", start + 1)
        name = NAME.match(html, start + 1 + closing)
        if not name:
            if html[start + 1: start + 2] in ("!", "?", "/"):
                end = html.find(">", start)
                at = size if end < 0 else end + 1
            else:
                text.append("<")
                at = start + 1
            continue
        tag = name[0].lower()
        end = _tag_end(html, name.end(), last)
        at = end + 1
        if closing:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if too_deep.get(tag):
                too_deep[tag] -= 1
                flush()
                continue
            if tag not in INLINE:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            continue
        sig, aside = _describe(tag, html[name.end(): end])
        if tag in FOREIGN and html.endswith("/", name.end(), end) and not OPEN_VALUE.search(html, name.end(), end):
            continue
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            stop = lower.find(f"</{tag}", at) if len(lower) == size else html.find(f"</{tag}", at)
            stop = size if stop < 0 else stop
            at = size if stop == size else _tag_end(html, stop, last) + 1
            if tag not in INLINE:
                text.append(" ")
            continue
        if tag in INLINE and not aside:
            if tag in ("br", "mtr", "mtd"):
                text.append(" ")
            elif tag == "a":
                in_link += 1
            continue
        flush()
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in ("table", "td", "button"):
                    break
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    close(depth)
                if stack[min(depth, len(stack) - 1)].tag in stops:
                    break
        if tag in VOID:
            continue
        if len(stack) > DEEPEST:
            too_deep[tag] = too_deep.get(tag, 0) + 1
            continue
        node = Node(tag, sig, aside)
        stack[-1].parts.append(node)
        stack.append(node)
    flush()
    _settle_asides(root)
    return root
