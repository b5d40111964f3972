"""Facts, links, lists and tables out of HTML pages.

Each page is handled inside its own row by column expressions; only the in-link count
shuffles. Closing tags that a page may leave out are not needed; nested tables are not
followed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.binding import let

# The markup patterns.
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)"
    r"|<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)"
)
# What stands in a tag; a quoted value may hold the sign that ends a tag.
INSIDE = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+"""
TAG = rf"(?s)<{INSIDE}>"
LINE_BREAK = r"(?i)<br\s*/?>"
TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title>"
ROOT = r"(?is)<html(?:\s[^>]*)?>"
META = rf"(?is)<meta\s{INSIDE}>"
ANCHOR = rf"(?is)<a\s{INSIDE}>"
TIME = rf"(?is)<time\s{INSIDE}>"
ATTRIBUTE = r"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
SPAN = r"""(?is)^<t[dh]\s(?:[^>]*?\s)?{name}\s*=\s*["']?\s*0*(\d+)"""
# The limits of the HTML standard for spans; a larger number counts as the limit.
SPAN_LIMITS = {"colspan": 1000, "rowspan": 65534}
QUOTES = r"""^["']|["']$"""
ITEM = r"(?is)<li(?:\s[^>]*)?>(.*?)(?=</li\s*>|<li[\s>]|</[uo]l\s*>|\z)"
LIST = r"(?i)<[uo]l[\s>]"
LIST_MARK = r"(?i)^</?(?:li|[uo]l)(?=[\s>])"
BEFORE_LIST_MARK = r"(?i)(?=</?(?:li|[uo]l)[\s>])"
# Stands in no page: HTML leaves this sign out.
BETWEEN_ITEMS = "\0"
TERM = r"(?is)<dt(?:\s[^>]*)?>(.*?)(?=</dt\s*>|<d[td][\s>]|</dl\s*>|\z)(.*?)(?=<dt[\s>]|</dl\s*>|\z)"
TERM_TEXT = r"(?is)<dd(?:\s[^>]*)?>(.*?)(?=</dd\s*>|<dd[\s>]|\z)"
BEFORE_HEADING = r"(?i)(?=<h2[\s>])"
HEADING = r"(?is)^<h2(?:\s[^>]*)?>(.*?)</h2>"
SCHEDULE_LINE = (
    r"(?is)<p(?:\s[^>]*)?>\s*<b>\s*(\d{1,2}:\d{2})\s*</b>\s*-\s*(.*?)(?=</p\s*>|<p[\s>]|\z)"
)
TABLE = r"(?is)<table(?:\s[^>]*)?>(.*?)(?:</table\s*>|\z)"
TABLE_ROW = r"(?is)<tr(?:\s[^>]*)?>(.*?)(?=</tr\s*>|<tr[\s>]|\z)"
TABLE_CELL = r"(?is)<t[dh](?:\s[^>]*)?>.*?(?=</t[dh]\s*>|<t[dh][\s>]|\z)"
DAY = r"^(\d{4,}-\d{2}-\d{2})(?:$|[T ])"
YEAR_CAPTION = r"\((\d{4})년[^)]*\)"
SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|//)"
MAIL_SCHEME = "mailto:"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def plain(markup: Column) -> Column:
    """Text of a piece of markup: tags removed, line breaks kept, trimmed."""
    text = F.regexp_replace(F.regexp_replace(markup, LINE_BREAK, "\n"), TAG, "")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag; NULL where the tag lacks it."""
    return let(
        F.regexp_extract(tag, ATTRIBUTE.format(name=name), 1),
        lambda value: F.when(value != "", F.regexp_replace(value, QUOTES, "")),
    )


def _attributes(html: Column, tag: str, name: str) -> Column:
    """The values of an attribute of all such tags, in page order."""
    values = F.transform(_all(html, tag, 0), lambda found: attribute(found, name))
    return F.filter(values, lambda value: value.isNotNull())


def page_facts(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", *carry: str
) -> DataFrame:
    """Language, title and description of each page; NULL where a page has none."""
    shown = F.col("_shown")
    descriptions = F.filter(
        _all(shown, META, 0), lambda tag: F.lower(attribute(tag, "name")) == "description"
    )
    return pages.select(page_id, *carry, visible(F.col(html)).alias("_shown")).select(
        page_id,
        *carry,
        attribute(F.regexp_extract(shown, ROOT, 0), "lang").alias("lang"),
        F.nullif(plain(F.regexp_extract(shown, TITLE, 1)), F.lit("")).alias("title"),
        attribute(F.get(descriptions, 0), "content").alias("description"),
    )


def link_kind(href: Column) -> Column:
    """Whether a link stays on the site, leaves it, or writes a mail."""
    return (
        F.when(F.lower(href).startswith(MAIL_SCHEME), "mailto")
        .when(href.rlike(SCHEME), "external")
        .otherwise("internal")
    )


def page_links(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", *carry: str
) -> DataFrame:
    """One row per link of each page, with position and kind."""
    links = F.posexplode(_attributes(visible(F.col(html)), ANCHOR, "href")).alias("pos", "href")
    return pages.select(page_id, *carry, links).select(
        page_id,
        *carry,
        F.col("pos").cast("long").alias("pos"),
        "href",
        link_kind(F.col("href")).alias("kind"),
    )


def resolve_link(url: Column, href: Column) -> Column:
    """The address that a link leads to, without its fragment and without dot segments."""
    path = F.regexp_replace(href, r"(?s)#.*$", "")
    page = F.regexp_replace(url, r"(?s)[?#].*$", "")
    site = site_of(page)
    place = F.substr(page, F.length(site) + 1)
    folder = F.when(place == "", "/").otherwise(F.regexp_replace(place, r"[^/]*$", ""))
    scheme = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    return _without_dots(
        F.when((path == "") | path.startswith("?"), F.concat(page, path))
        .when(path.startswith("//"), F.concat(scheme, path))
        .when(path.startswith("/"), F.concat(site, path))
        .when(path.rlike(SCHEME), path)
        .otherwise(F.concat(site, folder, path))
    )


def site_of(address: Column) -> Column:
    """Scheme and host of an address; empty where it has none."""
    return F.regexp_extract(address, r"^([A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?)", 1)


def _without_dots(address: Column) -> Column:
    """The address with the segments ``.`` and ``..`` of its path resolved."""
    site = site_of(address)
    path = F.regexp_extract(F.substr(address, F.length(site) + 1), r"(?s)^([^?]*)", 1)
    query = F.substr(address, F.length(site) + F.length(path) + 1)
    last = F.regexp_extract(path, r"[^/]*$", 0)
    # A dot segment at the end stands for a folder: an empty segment follows it.
    segments = F.split(F.when(last.isin(".", ".."), F.concat(path, F.lit("/"))).otherwise(path), "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda above, part: F.when(part == ".", above)
        .when(part == "..", F.slice(above, 1, F.greatest(F.size(above) - 1, F.lit(1))))
        .otherwise(F.concat(above, F.array(part))),
    )
    resolved = F.concat(site, F.array_join(kept, "/"), query)
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), resolved).otherwise(address)


def inlinks(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """How many links within a site lead to each address.

    Absolute links count if they stay on the page's own site.
    """
    links = page_links(pages, page_id, html, url).filter(F.col("kind") != "mailto")
    targets = links.select("kind", url, resolve_link(F.col(url), F.col("href")).alias("target"))
    own = F.lower(site_of(F.col("target"))) == F.lower(site_of(F.col(url)))
    within = targets.filter((F.col("kind") == "internal") | own)
    return within.groupBy("target").agg(F.count("*").alias("links"))


def _owners(pieces: Column) -> Column:
    """For each piece of markup the number of the list item that it belongs to, or -1.

    ``open`` has for each open list the item that text in it belongs to: its own open item,
    else that of the list around it. Numbers are gathered in chunks, so that no step copies
    all that came before it.
    """

    def add(state: Column, piece: Column) -> Column:
        held = state["open"]
        outer = F.slice(held, 1, F.size(held) - 1)
        above = F.coalesce(F.try_element_at(held, F.lit(-2)), F.lit(-1))

        def moved(mark: Column) -> Column:
            return (
                F.when(mark.isin("<ul", "<ol"), F.concat(held, F.array(F.element_at(held, -1))))
                .when(mark.isin("</ul", "</ol") & (F.size(held) > 1), outer)
                .when(mark == "<li", F.concat(outer, F.array(state["items"])))
                .when(mark != "", F.concat(outer, F.array(above)))
                .otherwise(held)
            )

        def step(mark: Column) -> Column:
            return let(
                moved(mark),
                lambda now: F.struct(
                    (state["items"] + F.when(mark == "<li", 1).otherwise(0)).alias("items"),
                    now.alias("open"),
                    F.concat(state["owners"], F.array(F.element_at(now, -1))).alias("owners"),
                ),
            )

        return let(F.lower(F.regexp_extract(piece, LIST_MARK, 0)), step)

    none = F.array().cast("array<int>")
    width = F.ceil(F.sqrt(F.size(pieces).cast("double"))).cast("int")

    def add_chunk(state: Column, start: Column) -> Column:
        begun = F.struct(state["items"], state["open"], none.alias("owners"))
        return let(
            F.aggregate(F.slice(pieces, start, width), begun, add),
            lambda done: F.struct(
                done["items"],
                done["open"],
                F.concat(state["chunks"], F.array(done["owners"])).alias("chunks"),
            ),
        )

    begun = F.struct(
        F.lit(0).alias("items"),
        F.array(F.lit(-1)).alias("open"),
        F.array().cast("array<array<int>>").alias("chunks"),
    )
    starts = F.sequence(F.lit(1), F.size(pieces), width)
    return F.aggregate(starts, begun, add_chunk, lambda state: F.flatten(state["chunks"]))


def _nested_items(shown: Column) -> Column:
    """The markup of each list item where items hold lists.

    Text after an inner list belongs to the item around it, on a line of its own. The pieces
    are sorted by item once and joined with a sign between items that no page keeps.
    """

    def numbered(pieces: Column) -> Column:
        return F.transform(
            F.arrays_zip(_owners(pieces).alias("item"), pieces.alias("piece")),
            lambda x, place: F.struct(x["item"], place.alias("place"), x["piece"]),
        )

    def kept(x: Column) -> Column:
        is_item = F.lower(F.regexp_extract(x["piece"], LIST_MARK, 0)) == "<li"
        return (x["item"] >= 0) & (is_item | (plain(x["piece"]) != ""))

    def joined(rows: Column) -> Column:
        def with_sign(x: Column, place: Column) -> Column:
            earlier = F.get(rows, place - 1)["item"]
            sign = F.when(earlier.isNull(), "").when(earlier == x["item"], "\n").otherwise(BETWEEN_ITEMS)
            return F.concat(sign, x["piece"])

        return F.array_join(F.transform(rows, with_sign), "")

    pieces = F.split(F.translate(shown, BETWEEN_ITEMS, ""), BEFORE_LIST_MARK)
    rows = let(pieces, lambda x: F.sort_array(F.filter(numbered(x), kept)))
    return let(
        rows,
        lambda x: F.when(F.size(x) > 0, F.split(joined(x), BETWEEN_ITEMS)).otherwise(
            F.array().cast("array<string>")
        ),
    )


def page_items(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per list item, with its position in the page; a nested item has its own row."""
    shown = pages.select(page_id, visible(F.col(html)).alias("_shown"))
    found = shown.select(page_id, "_shown", _all(F.col("_shown"), ITEM).alias("_found"))
    nested = F.exists("_found", lambda item: item.rlike(LIST))
    items = F.when(nested, _nested_items(F.col("_shown"))).otherwise(F.col("_found"))
    return found.select(page_id, F.posexplode(items).alias("pos", "item")).select(
        page_id, F.col("pos").cast("long").alias("pos"), plain(F.col("item")).alias("text")
    )


def _described(html: Column) -> Column:
    """Terms of the description lists, each with its texts joined by line breaks."""
    shown = visible(html)
    pairs = F.arrays_zip(
        _all(shown, TERM, 1).alias("term"), _all(shown, TERM, 2).alias("body")
    )
    return F.transform(
        pairs,
        lambda pair: F.struct(
            plain(pair["term"]).alias("term"),
            F.array_join(
                F.transform(_all(pair["body"], TERM_TEXT), lambda text: plain(text)), "\n"
            ).alias("text"),
        ),
    )


def description_rows(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per described term, with its position in the page."""
    return pages.select(
        page_id, F.posexplode(_described(F.col(html))).alias("pos", "pair")
    ).select(page_id, F.col("pos").cast("long").alias("pos"), "pair.term", "pair.text")


def description_map(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """The described terms of each page as one map; texts of a repeated term are joined."""
    pairs = F.col("_pairs")
    entries = F.transform(
        F.array_distinct(F.transform(pairs, lambda pair: pair["term"])),
        lambda term: F.struct(
            term.alias("key"),
            F.array_join(
                F.transform(
                    F.filter(pairs, lambda pair: pair["term"] == term),
                    lambda pair: pair["text"],
                ),
                "\n",
            ).alias("value"),
        ),
    )
    return pages.select(page_id, _described(F.col(html)).alias("_pairs")).select(
        page_id, F.map_from_entries(entries).alias("descriptions")
    )


def schedule_lines(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per line ``hh:mm - text``, with the heading above it and its place."""
    sections = F.posexplode(F.split(visible(F.col(html)), BEFORE_HEADING)).alias(
        "_block", "_markup"
    )
    lines = F.arrays_zip(
        _all(F.col("_markup"), SCHEDULE_LINE, 1).alias("time"),
        _all(F.col("_markup"), SCHEDULE_LINE, 2).alias("body"),
    )
    minutes = F.split("time", ":")
    return (
        pages.select(page_id, sections)
        .select(
            page_id,
            "_block",
            F.nullif(plain(F.regexp_extract("_markup", HEADING, 1)), F.lit("")).alias("section"),
            F.posexplode(lines).alias("pos", "_line"),
        )
        .select(
            page_id,
            F.col("_block").cast("long").alias("section_pos"),
            "section",
            F.col("pos").cast("long").alias("pos"),
            F.col("_line.time").alias("time"),
            F.col("_line.body").alias("body"),
        )
        .select(
            page_id,
            "section_pos",
            "section",
            "pos",
            "time",
            (minutes[0].cast("int") * 60 + minutes[1].cast("int")).alias("minute"),
            plain(F.col("body")).alias("text"),
        )
    )


def dated_marks(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per ``time`` element (with its date) and per year caption of each page."""
    shown = visible(F.col(html))
    times = F.transform(
        _attributes(shown, TIME, "datetime"),
        lambda day, at: F.struct(
            F.lit("time").alias("kind"),
            at.cast("long").alias("pos"),
            F.try_to_date(F.regexp_extract(day, DAY, 1), "yyyy-MM-dd").alias("day"),
            _digits(day, r"^(\d{4,})(?:-|$)").alias("year"),
        ),
    )
    captions = F.transform(
        _all(shown, YEAR_CAPTION),
        lambda year, at: F.struct(
            F.lit("caption").alias("kind"),
            at.cast("long").alias("pos"),
            F.lit(None).cast("date").alias("day"),
            year.cast("int").alias("year"),
        ),
    )
    return pages.select(page_id, F.explode(F.concat(times, captions)).alias("mark")).select(
        page_id, "mark.*"
    )


def _digits(text: Column, pattern: str) -> Column:
    """A found group of digits as integer, at most the largest one; NULL without digits."""
    return let(
        F.regexp_extract(text, pattern, 1),
        lambda found: F.when(
            found != "", F.coalesce(found.try_cast("int"), F.lit(2**31 - 1))
        ),
    )


def _span(cell: Column, name: str, smallest: int) -> Column:
    return F.greatest(
        F.least(
            F.coalesce(_digits(cell, SPAN.format(name=name)), F.lit(1)), F.lit(SPAN_LIMITS[name])
        ),
        F.lit(smallest),
    )


def table_cells(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per table: the array of its rows, each an array of cells with their spans."""
    tables = F.posexplode(_all(visible(F.col(html)), TABLE)).alias("table_pos", "_table")
    rows = F.transform(
        _all(F.col("_table"), TABLE_ROW),
        lambda row: F.transform(
            _all(row, TABLE_CELL, 0),
            lambda cell: F.struct(
                _span(cell, "rowspan", 0).alias("rowspan"),
                _span(cell, "colspan", 1).alias("colspan"),
                plain(cell).alias("text"),
            ),
        ),
    )
    return pages.select(page_id, tables).select(
        page_id, F.col("table_pos").cast("long").alias("table_pos"), rows.alias("cells")
    )


def place_cells(cells: Column) -> Column:
    """For the rows of one table, the column in which each cell starts.

    ``free`` tells for each column the first row that no earlier cell covers. A cell takes
    the next column to the right that is free, and covers its spans.
    """
    no_columns = F.array().cast("array<int>")
    height = F.size(cells)

    def next_column(state: Column, row: Column) -> Column:
        free, start = state["free"], state["next"]
        offset = F.array_position(
            F.transform(F.slice(free, start + 1, F.size(free)), lambda until: until <= row), True
        ).cast("int")
        return let(
            offset,
            lambda at: F.when(at > 0, start + at - 1).otherwise(F.greatest(start, F.size(free))),
        )

    def cover(free: Column, first: Column, after: Column, until: Column) -> Column:
        missing = F.greatest(F.lit(0), after - F.size(free))
        return F.transform(
            F.concat(free, F.array_repeat(F.lit(0), missing)),
            lambda old, at: F.when(
                (at >= first) & (at < after), F.greatest(old, until)
            ).otherwise(old),
        )

    def place_cell(state: Column, cell: Column, row: Column) -> Column:
        until = F.when(cell["rowspan"] == 0, height).otherwise(row + cell["rowspan"])
        return let(
            F.struct(next_column(state, row).alias("first"), until.alias("until")),
            lambda at: F.struct(
                cover(
                    state["free"], at["first"], at["first"] + cell["colspan"], at["until"]
                ).alias("free"),
                (at["first"] + cell["colspan"]).alias("next"),
                F.concat(state["columns"], F.array(at["first"])).alias("columns"),
            ),
        )

    def place_row(state: Column, row_cells: Column) -> Column:
        return F.aggregate(
            row_cells,
            F.struct(
                state["free"].alias("free"), F.lit(0).alias("next"), no_columns.alias("columns")
            ),
            lambda inner, cell: place_cell(inner, cell, F.size(state["placed"])),
            lambda line: F.struct(
                line["free"].alias("free"),
                F.concat(state["placed"], F.array(line["columns"])).alias("placed"),
            ),
        )

    return F.aggregate(
        cells,
        F.struct(
            no_columns.alias("free"), F.array().cast("array<array<int>>").alias("placed")
        ),
        place_row,
        lambda state: state["placed"],
    )


def table_slots(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per slot of each table's grid, a spanning cell repeated in all its slots."""
    key = [page_id, "table_pos"]
    cells = table_cells(pages, page_id, html)
    lines = F.transform(
        F.arrays_zip("cells", place_cells(F.col("cells")).alias("starts")),
        lambda line: F.struct(
            line["cells"].alias("cells"),
            line["starts"].alias("starts"),
            F.size("cells").alias("height"),
        ),
    )
    per_cell = (
        cells.select(*key, F.posexplode(lines).alias("_row", "_line"))
        .select(
            *key,
            F.col("_line.height").alias("_height"),
            "_row",
            F.explode(F.arrays_zip("_line.cells", "_line.starts")).alias("_cell"),
        )
        .select(
            *key,
            "_height",
            "_row",
            F.col("_cell.starts").alias("_start"),
            F.col("_cell.cells.*"),
        )
    )
    last_row = F.when(F.col("rowspan") == 0, F.col("_height")).otherwise(
        F.least(F.col("_row") + F.col("rowspan"), F.col("_height"))
    )
    return (
        per_cell.select(
            *key,
            "_start",
            "colspan",
            "text",
            F.explode(F.sequence(F.col("_row"), last_row - 1)).alias("row"),
        )
        .select(
            *key,
            F.col("row").cast("long").alias("row"),
            F.explode(
                F.sequence(F.col("_start"), F.col("_start") + F.col("colspan") - 1)
            ).alias("_column"),
            "text",
        )
        .select(*key, "row", F.col("_column").cast("long").alias("column"), "text")
    )
