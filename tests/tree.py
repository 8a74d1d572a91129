"""A tree of a page by the standard library's parser: what the element intervals are tested against."""

from __future__ import annotations

from html.parser import HTMLParser

# fixed values: elements without content, and elements a new sibling closes
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "source", "track", "wbr"}
SKIP = {"script", "style", "template"}
IMPLIED_END = {"li": {"li"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
               "p": {"p"}, "option": {"option"}}


class _Node:
    __slots__ = ("tag", "children", "parent", "classes")

    def __init__(self, tag, parent, classes=()):
        self.tag, self.children, self.parent, self.classes = tag, [], parent, classes


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        ends = IMPLIED_END.get(tag)
        if ends and self.cur.tag in ends:
            self.cur = self.cur.parent
        node = _Node(tag, self.cur, (dict(attrs).get("class") or "").split())
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        if self.cur.tag not in SKIP:
            self.cur.children.append(data)


def _strings(node):
    for ch in node.children:
        if isinstance(ch, str):
            yield ch
        else:
            yield from _strings(ch)


def _text(node) -> str:
    return "".join(s.strip() for s in _strings(node) if s.strip())


def _find_all(node, tags, recursive=True):
    for ch in node.children:
        if isinstance(ch, _Node):
            if ch.tag in tags:
                yield ch
            if recursive:
                yield from _find_all(ch, tags, True)


def parse_tree(html: str):
    """(tables, lists) with the semantics of the regex path, for nested markup."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    tables = []
    for t in _find_all(b.root, {"table"}):
        rows = []
        for tr in _find_all(t, {"tr"}):
            cells = [_text(td) for td in _find_all(tr, {"td", "th"})]
            if cells:
                rows.append(cells)
        if rows:
            tables.append(rows)
    lists = {}
    for kind in ("ul", "ol"):
        items = []
        for lst in _find_all(b.root, {kind}):
            for li in _find_all(lst, {"li"}, recursive=False):
                s = _text(li)
                if s:
                    items.append(s)
        lists[kind] = items
    return tables, lists


def select(html: str, tag: str | None = None, cls: str | None = None) -> str:
    """Texts of all elements of a tag and a class, joined by one space."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    found = [n for n in _every(b.root) if (tag is None or n.tag == tag) and (cls is None or cls in n.classes)]
    return " ".join(_text(n) for n in found)


def _every(node):
    for ch in node.children:
        if isinstance(ch, _Node):
            yield ch
            yield from _every(ch)
