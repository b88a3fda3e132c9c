"""Text, titles and tables out of page markup."""

from __future__ import annotations

import html as entities
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Elements and classes that are not text, and elements that separate paragraphs.
SKIPPED = frozenset("style script table sup figure figcaption math h1 h2 h3 h4 h5 h6 noscript audio video img map".split())
SKIPPED_CLASSES = frozenset(
    "reference references reflist mw-editsection hatnote navbox noprint thumb gallery infobox sidebar shortdescription metadata ambox mw-cite-backlink toc mw-heading mw-empty-elt"
    " rellink dablink portalbox sistersitebox side-box mbox-small quotebox error mw-ext-cite-error cs1-visible-error cs1-hidden-error scribunto-error".split()
)
BLOCKS = frozenset("p li dd dt blockquote div ul ol dl br".split())
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
NOTES = re.compile(r"\[(?:\d{1,3}|[a-z]|note \d+|citation needed|clarification needed)\]")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_GIVEN = re.compile(r"\b(class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PAGE_MARK, _BREAK = "\x1d", "\n"


def _hides(name: str, rest: str) -> bool:
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _GIVEN.finditer(rest)}
    return name in SKIPPED or given.get("role") == "note" or not SKIPPED_CLASSES.isdisjoint(given.get("class", "").split())


def visible(html: str) -> str:
    """What a page shows: paragraph ends as \\x1d, line breaks as \\n, character references decoded. One walk over the tokens; of the open elements it keeps the names, and how many of them are open outside what is skipped."""
    out, names, shown, at = [], [], None, 0  # shown: len(names) where a skipped element began
    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue  # inside a script or style sheet
        if shown is None:
            out.append(entities.unescape(html[at : m.start()]))
        at, name = m.end(), (m["name"] or "").lower()
        mark = _BREAK if name == "br" else _PAGE_MARK if name in BLOCKS else ""
        if not name:
            continue
        if m["end"]:
            if name in names and name not in EMPTY:
                del names[len(names) - 1 - names[::-1].index(name) :]
                shown = None if shown is not None and len(names) <= shown else shown
                out.append(mark if shown is None else "")
        elif name in EMPTY or m["rest"].endswith("/"):
            out.append(mark if shown is None and name == "br" else "")
        else:
            if shown is None and _hides(name, m["rest"]):
                shown = len(names)
            out.append(mark if shown is None else "")
            names.append(name)
            if name in ("script", "style"):
                close = html.lower().find(f"</{name}", at)
                at = close if close >= 0 else len(html)
    if shown is None:
        out.append(entities.unescape(html[at:]))
    return "".join(out)


def plain(html: str) -> str:
    """Paragraphs joined by blank lines: NFC, without bracketed notes and blanks before punctuation."""
    text = NOTES.sub("", unicodedata.normalize("NFC", visible(html)))
    text = re.sub(r"\n\s*\n", _PAGE_MARK, text)  # an empty line ends a paragraph too
    text = re.sub("[ \t\n\u00a0\u2009\u200a\u200b\u202f]+", " ", text)
    paragraphs = (re.sub(r"\s+([,.;:!?])", r"\1", p.strip()) for p in text.split(_PAGE_MARK))
    return "\n\n".join(p for p in paragraphs if p)


@pandas_udf(StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(lambda h: plain(h) if h else "")


@pandas_udf(StringType())
def _folded_title(title: pd.Series) -> pd.Series:
    """Compatibility forms, folded case, no marks: what has no built-in function."""
    return title.map(lambda t: t and "".join(c for c in unicodedata.normalize("NFKD", t.casefold()) if not unicodedata.combining(c)))


def normalize_title(title: Column | str) -> Column:
    """A title for comparison: compatibility forms, folded case, no marks, ``&`` and ``×`` as words, punctuation as blanks. Null is empty. Only titles outside ASCII go to Python."""
    t = F.coalesce(F.col(title) if isinstance(title, str) else title, F.lit(""))
    t = F.replace(F.replace(t, F.lit("&"), F.lit(" and ")), F.lit("×"), F.lit("x"))
    t = F.when(t.rlike(r"[^\x00-\x7F]"), _folded_title(F.when(t.rlike(r"[^\x00-\x7F]"), t))).otherwise(F.lower(t))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}\s]", " "), r"(?U)\s+", " "))


class _Rows(HTMLParser):
    """Rows of tables or lists: cells of tr, or items of li."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, list[str]]] = []
        self.table, self.cells, self.depth = -1, None, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("table", "ul"):
            self.table += 1
        elif tag in ("tr", "li"):
            self.cells = []
            self.rows.append((self.table, self.cells))
        elif tag in ("td", "th", "a") and self.cells is not None:
            self.cells.append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("tr", "li"):
            self.cells = None

    def handle_data(self, data: str) -> None:
        if self.cells is not None:
            if not self.cells:
                self.cells.append("")
            self.cells[-1] += data


@F.udtf(returnType=StructType([StructField("tbl", IntegerType()), StructField("row", IntegerType()), StructField("cells", ArrayType(StringType()))]))
class TableRows:
    """Rows of all tables and lists of a page, for LATERAL joins."""

    def eval(self, html: str):
        reader = _Rows()
        reader.feed(html or "")
        reader.close()
        for k, (t, cells) in enumerate(reader.rows):
            yield t, k, [" ".join(c.split()) for c in cells]
