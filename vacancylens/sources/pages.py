"""Keywords from HTML pages."""

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens import fixed_values as fixed
from vacancylens.functions.text import keyword
from vacancylens.session import ship_package
from vacancylens.sources.snapshots import posting_url

# Elements that have no end tag (fixed list of the HTML standard).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def flat_keywords(pages: DataFrame, css_class: str, tag: str = "div", page_id: str = "page_id") -> DataFrame:
    """``(page_id, keyword)`` for elements that hold plain text only.

    One regular expression over the whole page, without leaving the JVM. An
    element of the class that holds markup or a character reference fails the
    query: such pages are for :func:`page_keywords`.
    """
    name, element = re.escape(css_class), re.escape(tag)
    quoted = "|".join(rf"{q}(?:[^{q}>]*\s)?{name}(?:\s[^{q}>]*)?{q}" for q in "\"'")
    opened = rf"(?i)<{element}(?:\s[^>]*)?\sclass\s*=\s*(?:{quoted}|{name}(?=[\s>]))[^>]*>"
    pattern = rf"{opened}([^<&]*)</{element}\s*>"
    flat = F.regexp_count("html", F.lit(opened)) == F.regexp_count("html", F.lit(pattern))
    message = F.lit(f"an element of class {css_class} is not plain text; use page_keywords")
    pages = pages.where(F.when(F.coalesce(flat, F.lit(True)), F.lit(True)).otherwise(F.raise_error(message)))
    texts = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    return pages.select(page_id, F.explode(texts).alias("_text")).select(
        page_id, keyword(F.col("_text")).alias("keyword")
    )


class _ElementTexts(HTMLParser):
    """Texts of the elements of a class, optionally below an element id."""

    def __init__(self, css_class: str, container_id: str | None):
        super().__init__(convert_charrefs=True)
        self.css_class, self.container_id = css_class, container_id
        self.open: list[tuple[str, bool, int | None]] = []  # tag, is container, text index
        self.inside = container_id is None
        self.container_seen = False
        self.texts: list[str] = []

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        wanted = self.inside and self.css_class in (attributes.get("class") or "").split()
        is_container = (
            not self.container_seen and self.container_id is not None and attributes.get("id") == self.container_id
        )
        if is_container:
            self.inside = self.container_seen = True
        index = None
        if wanted:
            index = len(self.texts)
            self.texts.append("")
        if tag not in _VOID:
            self.open.append((tag, is_container, index))

    def handle_endtag(self, tag):
        if not any(name == tag for name, _, _ in self.open):
            return
        while self.open:
            name, was_container, _ = self.open.pop()
            if was_container:
                self.inside = False
            if name == tag:
                return

    def handle_data(self, data):
        for _, _, index in self.open:
            if index is not None:
                self.texts[index] += data


def page_keywords(
    pages: DataFrame,
    css_class: str = fixed.KEYWORD_CSS_CLASS,
    container_id: str | None = fixed.REQUIREMENTS_ELEMENT_ID,
    page_id: str = "page_id",
) -> DataFrame:
    """``(page_id, keyword)`` with nested markup and character references resolved.

    Reads the element with ``container_id`` (the whole page if None) and, in
    it, every element of ``css_class`` with the text of all its descendants.
    Pages that cannot match are dropped in the JVM; the others go to Python in
    Arrow batches.
    """
    candidates = pages.where(F.contains("html", F.lit(css_class)))
    if container_id is not None:
        candidates = candidates.where(F.contains("html", F.lit(container_id)))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = [], []
            for identity, html in zip(batch[page_id], batch["html"]):
                parser = _ElementTexts(css_class, container_id)
                parser.feed(html)
                parser.close()
                ids.extend([identity] * len(parser.texts))
                texts.extend(parser.texts)
            identities = pd.Series(ids, dtype=batch[page_id].dtype)
            yield pd.DataFrame({page_id: identities, "_text": pd.Series(texts, dtype=object)})

    ship_package(pages.sparkSession)
    kind = dict(pages.dtypes)[page_id]
    found = candidates.select(page_id, "html").mapInPandas(parse, f"`{page_id}` {kind}, _text string")
    return found.select(page_id, keyword(F.col("_text")).alias("keyword"))


def posting_keywords(
    postings: DataFrame,
    pages: DataFrame,
    css_class: str = fixed.KEYWORD_CSS_CLASS,
    container_id: str | None = fixed.REQUIREMENTS_ELEMENT_ID,
) -> DataFrame:
    """``(id, keyword)``: keywords of the page (``url``, ``html``) behind each posting.

    An equi join by address; pages that no posting leads to are not parsed.
    """
    linked = posting_url(postings).select("id", "page_url")
    wanted = pages.join(linked, pages["url"] == linked["page_url"], "left_semi")
    found = page_keywords(wanted, css_class, container_id, page_id="url")
    return linked.join(found, linked["page_url"] == found["url"]).select("id", "keyword")
