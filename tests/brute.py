"""Plain-Python brute-force versions of the operators, used as test oracles.

Small, obvious, row-at-a-time code; never used by the library itself.
"""

from __future__ import annotations

from html.parser import HTMLParser

_SKIP = {"script", "style", "template", "rt", "rp"}


class _TextCollector(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.stack: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack and self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        # Strings take the type of the innermost open string-container tag.
        if any(t in _SKIP for t in self.stack):
            return
        s = data.strip()
        if s:
            self.parts.append(s)


def html_text(html: str) -> str:
    p = _TextCollector()
    p.feed(html)
    p.close()
    return " ".join(" ".join(p.parts).split())


def lcs_len(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    return round(100 * 2 * lcs_len(a, b) / (len(a) + len(b)))
