import random
import time
from html.parser import HTMLParser

from civicloom.sources.html import HIDDEN_TAGS, VOID_TAGS, _page_rows, extract_html_rows

CELLS = frozenset(("td", "th"))


class Tree(HTMLParser):
    """Brute force: the whole tree of a page, each text and each void element a leaf."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ("", {}, [])
        self.open = [self.root]
        self.data = ""

    def text(self):
        if self.data.strip():
            self.open[-1][2].append(self.data.strip())
        self.data = ""

    def handle_starttag(self, tag, attrs):
        self.text()
        node = (tag, dict(attrs), [])
        self.open[-1][2].append(node)
        if tag not in VOID_TAGS:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.text()
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place][0] == tag:
                del self.open[place:]
                return

    def handle_data(self, data):
        self.data += data

    def handle_comment(self, data):
        self.text()


def below(node, tags):
    for child in node[2]:
        if not isinstance(child, str):
            if child[0] in tags:
                yield child
            yield from below(child, tags)


def text_of(node):
    if node[0] in HIDDEN_TAGS:
        return ""
    return "".join(child if isinstance(child, str) else text_of(child) for child in node[2])


def brute(html):
    tree = Tree()
    tree.feed(html)
    tree.close()
    tree.text()
    for table_idx, table in enumerate(below(tree.root, {"table"})):
        for row_idx, row in enumerate(below(table, {"tr"})):
            cells = [text_of(cell) for cell in below(row, CELLS)]
            if cells:
                yield table_idx, row_idx, False, cells


def read(html, implied_ends=False):
    return list(_page_rows(html, "table", "tr", CELLS, None, implied_ends))


def test_random_tags_as_the_whole_tree():
    draw = random.Random(4)
    tags = ["table", "tr", "tr", "tr", "td", "td", "td", "th", "p", "b", "br", "tbody", "div"]
    some = 0
    while some < 1000:
        parts = ["<table>"] if draw.random() < 0.7 else []
        for _ in range(draw.randrange(25)):
            kind = draw.random()
            tag = draw.choice(tags)
            parts.append(f"<{tag}>" if kind < 0.5 else f"</{tag}>" if kind < 0.65 else f" {draw.randrange(99)} "
                         if kind < 0.93 else "<script>x</script>" if kind < 0.97 else "<!-- c -->")
        html = "".join(parts)
        want = list(brute(html))
        assert read(html) == want, html
        some += bool(want)


def table(draw, closed, depth=0):
    """Random tables of one grid, with all end tags or with those left out that may be."""
    end = (lambda tag: f"</{tag}>") if closed else (lambda tag: "" if draw[0].random() < 0.7 else f"</{tag}>")
    shape = draw[1]
    parts = ["<table>"]
    for _ in range(shape.randrange(1, 4)):
        group = shape.random() < 0.4
        parts.append("<tbody>" if group else "")
        for _ in range(shape.randrange(1, 4)):
            parts.append("<tr>")
            for _ in range(shape.randrange(1, 4)):
                parts.append(f"<td>{shape.randrange(1000)}")
                if shape.random() < 0.3:
                    parts.append("<p>more")
                if depth < 2 and shape.random() < 0.15:
                    parts.append(table(draw, closed, depth + 1))
                parts.append(end("td"))
            parts.append(end("tr"))
        # Without its end, a group runs on to the next rows: of no account for rows and cells.
        parts.append(end("tbody") if group else "")
    return "".join(parts) + "</table>"


def test_left_out_end_tags_are_implied():
    differ = 0
    for seed in range(300):
        whole = table((random.Random(seed), random.Random(seed)), True)
        short = table((random.Random(seed), random.Random(seed)), False)
        assert read(short, True) == read(whole) == read(whole, True)
        differ += read(short) != read(whole)
    assert differ > 200


def test_stray_end_tags_end_nothing_outside_of_their_cell():
    html = "<div><table><tr><td>a</div><td>b</td></tr><tr><td>c</p></table></div>"
    assert read(html, True) == [(0, 0, False, ["a", "b"]), (0, 1, False, ["c"])]
    assert read(html) == [(0, 0, False, ["a"])]


def test_time_grows_with_the_page():
    begun = time.process_time()
    assert read("<table><tr><td>" + "<p>x" * 60000) == [(0, 0, False, ["x" * 60000])]
    assert read("<table><tr><td>" + "<p>x</b>" * 60000) == [(0, 0, False, ["x" * 60000])]
    rows = read("<table>" + "<tr><td>a<td>b" * 20000, True)
    assert rows == [(0, k, False, ["a", "b"]) for k in range(20000)]
    assert time.process_time() - begun < 20


def test_option_reaches_the_pages(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>a<td>b<tr><td>c</table>"), (2, None)], "page_id long, html string")
    rows = extract_html_rows(pages, implied_ends=True).orderBy("row_idx").collect()
    assert [(r.row_idx, r.cells) for r in rows] == [(0, ["a", "b"]), (1, ["c"])]
    nested = extract_html_rows(pages).orderBy("row_idx").collect()
    assert [(r.row_idx, r.cells) for r in nested] == [(0, ["abc", "bc", "c"]), (1, ["c"])]
