"""HTML to text as it would be laid out: a tree with implied tags, visibility rules, blocks, lists and aligned cells."""

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# ---------------------------------------------------------------- fixed values
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"head", "title", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio", "video", "select", "datalist", "textarea", "dialog"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "details", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table", "ul"}
SPACED = {"blockquote", "dl", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "ol", "p", "pre", "table", "ul"}
#: An opening tag closes the nearest of these, if no barrier stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
HEAD_ONLY = {"title", "meta", "link", "base", "style", "script", "head", "html", "noscript", "template"}
# ------------------------------------------------------------ end fixed values
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str | None] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


class Builder(HTMLParser):
    """Elements in a stack; end tags close what is open inside them, stray ones are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def close_nearest(self, tags: set[str], barriers: set[str]) -> None:
        cut = None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in barriers:
                break
            if self.open[at].tag in tags:
                cut = at
        if cut is not None:
            del self.open[cut:]

    def handle_starttag(self, tag: str, attributes) -> None:
        if tag == "html":
            return
        if tag in CLOSES:
            self.close_nearest(*CLOSES[tag])
        elif tag not in HEAD_ONLY and len(self.open) > 1 and self.open[1].tag == "head" and len(self.open) == 2:
            del self.open[1:]
        if tag in BLOCK or tag == "table":
            self.close_nearest({"p"}, {"table", "td", "th", "li", "div", "article", "section", "blockquote", "button"})
        if tag == "td" or tag == "th":
            if self.open[-1].tag in {"table", "thead", "tbody", "tfoot"}:
                self.push(Node("tr"))
        node = Node(tag, dict(attributes))
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self.push(node)

    def push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag: str, attributes) -> None:
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return
            if self.open[at].tag == "table" and tag not in {"body", "html"}:
                return

    def handle_data(self, data: str) -> None:
        if len(self.open) == 2 and self.open[1].tag == "head" and data.strip():
            del self.open[1:]
        self.open[-1].children.append(data)


def visible(node: Node) -> bool:
    a = node.attributes
    return not (node.tag in HIDDEN or "hidden" in a or (a.get("aria-hidden") or "").lower() == "true" or _UNSEEN.search(a.get("style") or ""))


class Page:
    """Lines in the making: pending spaces and line ends are only written before further text."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks, self.space, self.indent, self.mark = 0, False, 0, ""

    def block(self, lines: int) -> None:
        self.breaks, self.space = max(self.breaks, lines), False

    def write(self, text: str) -> None:
        if self.out:
            if self.breaks:
                self.out.append("\n" * self.breaks)
        if not self.out or self.breaks:
            self.out.append("  " * max(0, self.indent - 1) + self.mark)
            self.mark = ""
        elif self.space:
            self.out.append(" ")
        self.breaks, self.space = 0, False
        self.out.append(text)

    def inline(self, data: str) -> None:
        flat = _SPACE.sub(" ", data)
        if flat.startswith(" "):
            self.space = True
        if body := flat.strip(" "):
            self.write(body)
            self.space = flat.endswith(" ")


def rows_of(table: Node) -> list[list[Node]]:
    found, stack = [], [table]
    while stack:
        node = stack.pop()
        if isinstance(node, str) or not visible(node):
            continue
        if node.tag == "tr":
            found.append([c for c in node.children if not isinstance(c, str) and c.tag in {"td", "th"} and visible(c)])
        elif node is table or node.tag in {"thead", "tbody", "tfoot"}:
            stack += reversed(node.children)
    return [r for r in found if r]


def cells(table: Node) -> list[str]:
    """Cells are rendered on one line each and padded to the width of their column."""
    grid = [[_SPACE.sub(" ", rendered(c)).strip() for c in row] for row in rows_of(table)]
    widths = [max(len(r[i]) for r in grid if i < len(r)) for i in range(max(map(len, grid), default=0))]
    return [" | ".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in grid]


def rendered(root: Node) -> str:
    page, lists, pre = Page(), [], 0
    stack: list[tuple[object, bool]] = [(c, False) for c in reversed(root.children)]
    while stack:
        node, leaving = stack.pop()
        if isinstance(node, str):
            if pre:
                for i, line in enumerate(node.split("\n")):
                    if i:
                        page.breaks += 1
                    if line:
                        page.write(line)
            else:
                page.inline(node)
            continue
        tag = node.tag
        lines = 2 if tag in SPACED and not (tag in {"ul", "ol"} and len(lists) > leaving) else 1 if tag in BLOCK else 0
        if leaving:
            if tag in {"ul", "ol"}:
                lists.pop()
                page.indent -= 1
            pre -= tag == "pre"
            if lines:
                page.block(lines)
            continue
        if not visible(node):
            continue
        if tag == "br":
            page.breaks, page.space = page.breaks + 1, False
            continue
        if lines:
            page.block(lines)
        if tag == "img" and node.attributes.get("alt"):
            page.inline(node.attributes["alt"])
            continue
        if tag == "table":
            for c in node.children:
                if not isinstance(c, str) and c.tag == "caption" and visible(c):
                    page.inline(rendered(c))
                    page.block(1)
            for line in cells(node):
                page.write(line)
                page.block(1)
            loose = [c for c in node.children if (c.strip() if isinstance(c, str) else c.tag not in {"caption", "thead", "tbody", "tfoot", "tr", "colgroup", "col"})]
            page.block(2)
            stack += [(c, False) for c in reversed(loose)]  # text that a table may not hold is shown after it
            continue
        if tag in {"ul", "ol"}:
            lists.append([tag, 0])
            page.indent += 1
        if tag == "li":
            if lists:
                lists[-1][1] += 1
            page.mark = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
        pre += tag == "pre"
        stack.append((node, True))
        stack += [(c, False) for c in reversed(node.children)]
    return "".join(page.out).strip("\n")


def text_of(markup: str | None) -> str:
    builder = Builder()
    try:
        builder.feed(markup or "")
        builder.close()
    except AssertionError:  # the tokenizer's answer to a broken declaration; what was read so far counts
        pass
    return rendered(builder.root)


def extracted(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``page_id`` and ``text`` of every row.

    Null and empty pages have an empty text. Null ids and repeated rows are kept as they are; an empty table gives an
    empty result; other columns are ignored.
    """
    narrow = pages.select(pages[id_column].alias("page_id"), pages[html_column].cast("string").alias("html"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([text_of(h.as_py()) for h in batch.column(1)], pa.string())], names=["page_id", "text"])

    return narrow.mapInArrow(made, f"page_id {narrow.schema['page_id'].dataType.simpleString()}, text string")
