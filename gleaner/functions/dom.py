"""A small element tree over the standard library's HTML tokenizer.

Used inside Arrow UDFs where a page is asked for nested elements: one parse per
page answers everything an operator needs.  Attribute quoting, letter case,
comments and character references are the tokenizer's business.  An end tag
closes the nearest open element of its name and everything inside it; an end tag
without one is ignored.  All walks are loops, so deep pages do not exhaust the
stack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is not page text.
INERT = frozenset(("script", "style", "template"))


class Element:
    """``parts``: child elements and text pieces, in order."""

    __slots__ = ("tag", "attrs", "parent", "parts")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Element | str]:
        """Everything below, in document order."""
        stack = list(reversed(self.parts))
        while stack:
            part = stack.pop()
            yield part
            if isinstance(part, Element):
                stack.extend(reversed(part.parts))

    def every(self, test: Callable[[Element], bool]) -> list[Element]:
        """The elements below that pass, in document order."""
        return [x for x in self.walk() if isinstance(x, Element) and test(x)]

    def first(self, test: Callable[[Element], bool]) -> Element | None:
        return next((x for x in self.walk() if isinstance(x, Element) and test(x)), None)

    def children(self, tag: str) -> list[Element]:
        return [x for x in self.parts if isinstance(x, Element) and x.tag == tag]

    def inside(self, test: Callable[[Element], bool]) -> bool:
        """Whether an ancestor passes."""
        up = self.parent
        while up is not None and not test(up):
            up = up.parent
        return up is not None

    def text(self, separator: str = " ") -> str:
        """The stripped, non-empty text pieces, joined."""
        return separator.join(p for x in self._texts() if (p := x.strip()))

    def shown(self) -> str:
        """All text with runs of white space as one space, ends cut."""
        return " ".join(" ".join(self._texts()).split())

    def _texts(self) -> Iterator[str]:
        stack = list(reversed(self.parts))
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                yield part
            elif part.tag not in INERT:
                stack.extend(reversed(part.parts))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = self.at = Element("", {}, None)
        self.open: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        own: dict[str, str] = {}
        for name, value in attrs:
            own.setdefault(name, value or "")
        new = Element(tag, own, self.at)
        self.at.parts.append(new)
        if tag not in VOID:
            self.at = new
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        while True:
            closed, self.at = self.at, self.at.parent
            self.open[closed.tag] -= 1
            if closed.tag == tag:
                return

    def handle_data(self, data):
        self.at.parts.append(data)


def parse(html: str | None) -> Element:
    """The page's tree under an unnamed top element; null and empty pages have no parts."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.top


def has_class(*names: str, tag: str | None = None) -> Callable[[Element], bool]:
    """A test: any of the classes, and the tag if one is given."""
    return lambda e: (tag is None or e.tag == tag) and any(n in e.classes for n in names)
