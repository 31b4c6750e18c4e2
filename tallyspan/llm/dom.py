"""A page as block nodes: what a block extractor needs to know of HTML."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import cache

# Fixed values of HTML: element kinds.
MATH = set(
    "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
INLINE = MATH | set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
#: Never text of a page, whatever a model says.
HIDDEN = set("head noscript template svg annotation annotation-xml button select option datalist canvas audio video map".split())
#: What may stand in a head that does not end; anything else ends it.
IN_HEAD = set("base link meta noscript script style template title".split())
#: An open element of the second kind ends where one of the first begins.
P_ENDERS = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split()
)
SAME_ENDERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}}

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>?|[^<]++|<""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|itemtype|aria-label|data-testid|name)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(attributes: str) -> tuple[str, ...]:
    """The words of naming attributes, in lower case."""
    if "=" not in attributes:
        return ()
    found = _ATTRIBUTE.findall(attributes)
    return tuple({w.lower() for _, a, b, c in found for w in _WORD.findall(a or b or c)})


@dataclass
class Page:
    """Block nodes in page order; node 0 is the root. Text runs name their node."""

    tag: list[str] = field(default_factory=lambda: ["#root"])
    parent: list[int] = field(default_factory=lambda: [-1])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    inline: list[int] = field(default_factory=lambda: [0])  # inline elements directly within
    linked: list[int] = field(default_factory=lambda: [0])  # characters of own text within links
    runs: list[tuple[int, str]] = field(default_factory=list)

    def text(self, keep: list[bool] | None = None) -> str:
        """The text of the kept nodes: white space within a block one blank, blocks joined by a blank."""
        out: list[str] = []
        at, held = -1, []
        for node, run in self.runs:
            if keep is not None and not keep[node]:
                node = -2
            if node != at:
                if held:
                    out += "".join(held).split()
                at, held = node, []
            if node >= 0:
                held.append(run)
        out += "".join(held).split()
        return " ".join(out)


class _Open:
    """The open elements, with the places of each name, so that no question walks the whole stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, node: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, node))

    def last(self, names: set[str]) -> int:
        """The place of the innermost open element of these names, 0 for none."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=0)

    def cut(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.stack) > place:
            self.places[self.stack.pop()[0]].pop()

    def without(self, name: str) -> None:
        """Close elements of a name, but not those within them."""
        if self.places.get(name):
            kept = [s for s in self.stack[1:] if s[0] != name]
            self.cut(1)
            for s in kept:
                self.push(*s)


def parse(source: str) -> Page:
    """Blocks, their nesting and text, in time that grows with the source. Broken markup is read as browsers roughly do; nothing raises."""
    page = Page()
    tag, parent, names, inline, linked, runs = page.tag, page.parent, page.names, page.inline, page.linked, page.runs
    opened = _Open()
    stack = opened.stack
    node, links, at, end = 0, 0, 0, len(source)
    match = _TOKEN.match
    while at < end:
        m = match(source, at)
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            run = m[0]
            if run[0] != "<" or run == "<":
                if "&" in run:
                    run = html.unescape(run)
                if stack[-1][0] == "head" and run.strip():
                    opened.without("head")
                    node = stack[-1][1]
                    runs.append((node, "\n"))
                runs.append((node, run))
                if links:
                    linked[node] += len(run)
            continue
        name = name.lower()
        if m[1] or m[4]:
            if name in INLINE:
                if name == "a" and links:
                    links -= 1
                continue
            if name == "br" or name == "p":
                runs.append((node, " "))
            if k := opened.last({name}):
                opened.cut(k)
                node, links = stack[-1][1], 0
                # text behind a block is a block of its own
                runs.append((node, "\n"))
            continue
        if stack[-1][0] == "head" and name not in IN_HEAD and name not in ("head", "html"):
            opened.without("head")
            node = stack[-1][1]
        if name in INLINE:
            inline[node] += 1
            if name == "a":
                links = 1
            elif name in VOID:
                continue
            continue
        if name in VOID:
            if name == "br" or name == "hr":
                runs.append((node, " "))
            continue
        attributes = m[3] or m[6] or ""
        if name == "svg" and attributes.endswith("/"):
            continue
        if name in RAW:
            close = _closing(name).search(source, at)
            at = close.end() if close else end
            continue
        if name in P_ENDERS and any(s[0] == "p" for s in stack[-3:]):
            while stack[-1][0] != "p" and len(stack) > 1 and stack[-1][0] not in P_ENDERS:
                opened.cut(len(stack) - 1)
            if stack[-1][0] == "p":
                opened.cut(len(stack) - 1)
        if name in SAME_ENDERS:
            k = opened.last(SAME_ENDERS[name])
            if k > opened.last(SCOPES[name]):
                opened.cut(k)
        if name == "body":
            opened.without("head")
        above, links = stack[-1][1], 0
        node = len(tag)
        tag.append(name)
        parent.append(above)
        names.append(tokens(attributes))
        inline.append(0)
        linked.append(0)
        opened.push(name, node)
        runs.append((node, "\n"))
    return page


@cache
def _closing(name: str) -> re.Pattern:
    return re.compile(f"</{re.escape(name)}\\b[^>]*>?", re.IGNORECASE)
