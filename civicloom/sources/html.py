"""HTML tables: rows out of pages, contact records out of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.functions.text import mentions_any
from civicloom.session import spread

# Elements that never have an end tag, and those whose content is not text.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = frozenset(("script", "style", "template"))
GROUP_TAGS = frozenset(("thead", "tbody", "tfoot"))


class _TableReader(HTMLParser):
    """Finds the tables, rows and cells of one page in time that grows with its length.

    Texts, cells and rows are kept once, in page order. An element that is open holds all that
    follows until it ends, so what it holds is a span of them: ``[start, end)``.
    """

    def __init__(self, table_tag: str, row_tag: str, cell_tags: frozenset[str], implied_ends: bool):
        super().__init__(convert_charrefs=True)
        self.roles = {table_tag: "table", row_tag: "row", **dict.fromkeys(cell_tags, "cell")}
        self.implied_ends = implied_ends
        self.texts: list[str] = []
        self.spans: dict[str, list[list]] = {"table": [], "row": [], "cell": []}
        self.inside = {"table": self.spans["row"], "row": self.spans["cell"], "cell": self.texts}
        self.open: list[tuple[str, str | None, list | None]] = []
        # Where the open elements of each tag and of each role stand in ``open``.
        self.places: dict[str, list[int]] = {}
        self.role_places: dict[str, list[int]] = {"table": [], "row": [], "cell": []}
        self.hidden = 0
        self.pieces: list[str] = []

    def flush(self) -> None:
        if not self.pieces:
            return
        text = "".join(self.pieces).strip()
        self.pieces.clear()
        if text and not self.hidden and self.role_places["cell"]:
            self.texts.append(text)

    def _last(self, role: str) -> int:
        places = self.role_places[role]
        return places[-1] if places else -1

    def _end_from(self, place: int) -> None:
        """End the element that stands there and those that were opened in it."""
        while len(self.open) > place:
            tag, role, span = self.open.pop()
            self.places[tag].pop()
            self.hidden -= tag in HIDDEN_TAGS
            if role:
                self.role_places[role].pop()
                span[1] = len(self.inside[role])

    def _end_implied(self, tag: str, role: str | None) -> None:
        """What the start of a row, a cell or a group of rows ends in the innermost table."""
        table, row, cell = self._last("table"), self._last("row"), self._last("cell")
        if (role == "row" or tag in GROUP_TAGS) and row > table:
            self._end_from(row)
        elif role == "cell" and cell > max(table, row):
            self._end_from(cell)

    def handle_starttag(self, tag, attrs):
        self.flush()
        role, span = self.roles.get(tag), None
        if self.implied_ends:
            self._end_implied(tag, role)
        if role:
            start = len(self.inside[role])
            span = [start, start, dict(attrs).get("class") or "" if role == "table" else None]
            self.spans[role].append(span)
        if tag not in VOID_TAGS:
            self.places.setdefault(tag, []).append(len(self.open))
            if role:
                self.role_places[role].append(len(self.open))
            self.hidden += tag in HIDDEN_TAGS
            self.open.append((tag, role, span))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        places = self.places.get(tag)
        if not places:
            return
        # With implied ends, a stray end tag ends nothing outside of the cell it stands in.
        if self.implied_ends and not self.roles.get(tag) and tag not in GROUP_TAGS and places[-1] < self._last("cell"):
            return
        self._end_from(places[-1])

    def handle_data(self, data):
        self.pieces.append(data)

    def handle_comment(self, data):
        self.flush()


def _page_rows(html, table_tag, row_tag, cell_tags, table_class, implied_ends=False):
    reader = _TableReader(table_tag, row_tag, cell_tags, implied_ends)
    reader.feed(html)
    reader.close()
    reader.flush()
    reader._end_from(0)
    tables, rows, cells = reader.spans["table"], reader.spans["row"], reader.spans["cell"]
    marked = [
        table for table in tables
        if table_class is not None and (table_class == table[2] or table_class in table[2].split())
    ]
    for table_idx, (first, end, _) in enumerate(marked or tables):
        for row_idx, (start, stop, _) in enumerate(rows[first:end]):
            if stop > start:
                texts = ["".join(reader.texts[begin:until]) for begin, until, _ in cells[start:stop]]
                yield table_idx, row_idx, bool(marked), texts


_ROWS = T.ArrayType(
    T.StructType(
        [
            T.StructField("row_idx", T.IntegerType()),
            T.StructField("cells", T.ArrayType(T.StringType())),
        ]
    )
)


def extract_html_tables(
    pages: DataFrame,
    row_tag: str = "tr",
    cell_tags: Sequence[str] = ("td", "th"),
    table_tag: str = "table",
    table_class: str | None = None,
    id_col: str = "page_id",
    html_col: str = "html",
    partitions: int | None = None,
    implied_ends: bool = False,
) -> DataFrame:
    """``(page_id, table_idx, by_class, rows)`` of every table, its rows that have cells in order.

    Where a page has tables of ``table_class`` only those count. Pages without the table tag
    are dropped on the JVM; the rest is read page by page in Arrow batches. ``partitions`` deals
    the pages out first, for inputs of few files.

    An element without an end tag holds all that follows, so of rows and cells left open the first
    holds the text of all others. With ``implied_ends`` a row, a group of rows or a cell ends where
    the next one of its table begins, and other end tags end nothing outside of their cell.
    """
    schema = T.StructType(
        [
            pages.schema[id_col],
            T.StructField("table_idx", T.IntegerType()),
            T.StructField("by_class", T.BooleanType()),
            T.StructField("rows", _ROWS),
        ]
    )
    names = schema.names
    cells = frozenset(cell_tags)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page_id, html in zip(batch[id_col], batch[html_col]):
                by_table = groupby(_page_rows(html, table_tag, row_tag, cells, table_class, implied_ends), lambda row: row[0])
                for table_idx, rows in by_table:
                    rows = list(rows)
                    listed = [{"row_idx": row_idx, "cells": texts} for _, row_idx, _, texts in rows]
                    found.append((page_id, table_idx, rows[0][2], listed))
            yield pd.DataFrame(found, columns=names)

    holds_table = F.lower(html_col).contains(f"<{table_tag}")
    return spread(pages.select(id_col, html_col).filter(holds_table), partitions).mapInPandas(read, schema)


def extract_html_rows(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """``(page_id, table_idx, row_idx, by_class, cells)`` of every row that has cells; options as
    for ``extract_html_tables``."""
    tables = extract_html_tables(pages, id_col=id_col, **options)
    rows = tables.select(id_col, "table_idx", "by_class", F.inline("rows"))
    return rows.select(id_col, "table_idx", "row_idx", "by_class", "cells")


def _positions(cells: Column, test) -> Column:
    """Indexes, from 0, of the cells that pass the test."""
    marked = F.transform(cells, lambda cell, idx: F.when(test(cell), idx))
    return F.filter(marked, lambda idx: idx.isNotNull())


def _cell(cells: Column, idx: Column) -> Column:
    return F.coalesce(F.try_element_at(cells, idx + 1), F.lit(""))


def _headings(is_heading, place) -> Column:
    """The heading rows of a table that place a column: where they stand, and the place."""
    placed = F.transform(
        "rows",
        lambda row, idx: F.struct(
            idx.alias("idx"), F.when(is_heading(row["cells"]), place(row["cells"])).alias("at")
        ),
    )
    return F.filter(placed, lambda heading: heading["at"].isNotNull())


def _placed(tables: DataFrame, is_heading, places: dict[str, tuple]) -> DataFrame:
    """One row per row of the tables, with the places of its columns: ``places`` names them as
    ``(place in a heading, which heading counts: -1 the last so far, 1 the first)``. A table's
    rows are in one row already, so nothing is shuffled."""
    rows = tables.withColumns(
        {f"_{name}": _headings(is_heading, place) for name, (place, _) in places.items()}
    ).select("*", F.posexplode("rows").alias("_idx", "_row"))

    def at(name: str, which: int) -> Column:
        so_far = F.filter(f"_{name}", lambda heading: heading["idx"] <= F.col("_idx"))
        return F.try_element_at(so_far, F.lit(which))["at"]

    found = rows.withColumns({name: at(name, which) for name, (_, which) in places.items()})
    return found.withColumns(
        {
            "row_idx": F.col("_row.row_idx"),
            "cells": F.col("_row.cells"),
            "is_heading": is_heading(F.col("_row.cells")),
        }
    )


# Heading words of the two kinds of contact table.
NAME_WORD, NUMBER_WORD, PHONE_WORD = "ชื่อ", "หมายเลข", "โทรศัพท์"
FAX_WORDS = ("โทรสาร", "แฟกซ์")
HOSPITAL_WORD, HOSPITAL_PHONE_WORD = "ชื่อสถานพยาบาล", "หมายเลขโทรศัพท์"
HOSPITAL_ENGLISH = "list of network hospital"


def extract_station_contacts(
    tables: DataFrame, table_cols: Sequence[str] = ("page_id", "table_idx")
) -> DataFrame:
    """Name, phone and fax. Headings move the columns for the rows below them; before any
    heading the columns are the first three. Tables found by class know one heading word and
    the Latin ``fax`` on top of what the others know."""
    cells, by_class = F.col("cells"), F.col("by_class")

    def heading(text: Column) -> Column:
        return mentions_any(text, (NAME_WORD, NUMBER_WORD)) | (by_class & text.contains(PHONE_WORD))

    def is_name(cell: Column) -> Column:
        return cell.contains(NAME_WORD)

    def is_phone(cell: Column) -> Column:
        return ~is_name(cell) & mentions_any(cell, (NUMBER_WORD, PHONE_WORD))

    def is_fax(cell: Column) -> Column:
        latin = by_class & F.lower(cell).contains("fax")
        return ~is_name(cell) & ~is_phone(cell) & (mentions_any(cell, FAX_WORDS) | latin)

    def is_heading(row: Column) -> Column:
        return heading(F.lower(F.array_join(row, "")))

    def last_of(test):
        return (lambda row: F.array_max(_positions(row, test))), -1

    placed = _placed(
        tables, is_heading, {"name_at": last_of(is_name), "phone_at": last_of(is_phone), "fax_at": last_of(is_fax)}
    ).withColumns(
        {
            "name_at": F.coalesce("name_at", F.lit(0)),
            "phone_at": F.coalesce("phone_at", F.lit(1)),
            "fax_at": F.coalesce("fax_at", F.lit(2)),
        }
    )
    records = placed.filter(~F.col("is_heading") & (F.size("cells") >= 2)).select(
        *table_cols,
        "row_idx",
        "by_class",
        _cell(cells, F.col("name_at")).alias("name"),
        _cell(cells, F.col("phone_at")).alias("phone"),
        _cell(cells, F.col("fax_at")).alias("fax"),
    )
    name = F.col("name")
    return records.filter((name != "") & ~heading(F.lower(name))).drop("by_class")


def extract_hospital_contacts(
    tables: DataFrame,
    table_cols: Sequence[str] = ("page_id", "table_idx"),
    any_hospital_row_is_heading: bool = False,
) -> DataFrame:
    """Row number, Thai name, English name and phone; rows above the first heading are skipped.

    With ``any_hospital_row_is_heading`` every row that holds the word ``hospital`` counts as
    a heading, which loses most rows with an English name.
    """
    cells = F.col("cells")
    english_heading = "hospital" if any_hospital_row_is_heading else HOSPITAL_ENGLISH

    def is_heading(row: Column) -> Column:
        return mentions_any(F.lower(F.array_join(row, " ")), (HOSPITAL_WORD, english_heading))

    def is_thai(cell: Column) -> Column:
        return cell.contains(HOSPITAL_WORD)

    def is_english(cell: Column) -> Column:
        return ~is_thai(cell) & F.lower(cell).contains(HOSPITAL_ENGLISH)

    def is_phone(cell: Column) -> Column:
        phone = cell.contains(HOSPITAL_PHONE_WORD) | F.lower(cell).contains("telephone")
        return ~is_thai(cell) & ~is_english(cell) & phone

    def by(test, pick, which: int):
        return (lambda row: pick(_positions(row, test))), which

    placed = _placed(
        tables,
        is_heading,
        {
            "thai_at": by(is_thai, F.array_max, -1),
            "english_at": by(is_english, F.array_min, 1),
            "phone_at": by(is_phone, F.array_max, -1),
        },
    )
    widest = F.greatest("thai_at", F.coalesce("english_at", F.lit(0)), F.coalesce("phone_at", F.lit(0)))
    records = placed.filter(
        ~F.col("is_heading") & F.col("thai_at").isNotNull() & (F.size("cells") > widest)
    ).select(
        *table_cols,
        "row_idx",
        _cell(cells, F.col("thai_at")).alias("name_th"),
        F.when(F.col("english_at").isNull(), "").otherwise(_cell(cells, F.col("english_at"))).alias("name_en"),
        F.when(F.col("phone_at").isNull(), "").otherwise(_cell(cells, F.col("phone_at"))).alias("phone"),
    )
    name = F.col("name_th")
    return records.filter(
        ~name.isin("", HOSPITAL_WORD, "---") & ~name.rlike(r"^\p{Nd}+$")
    )


def extract_contacts(tables: DataFrame, kind: str, **options) -> DataFrame:
    """Contact records of ``stations`` or ``hospitals`` from ``extract_html_tables``."""
    readers = {"stations": extract_station_contacts, "hospitals": extract_hospital_contacts}
    return readers[kind](tables, **options)
