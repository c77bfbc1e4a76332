"""Fetched web pages ``url, html``: content, assets, links and the crawl frontier."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.scalars import CONTENT_TYPES, host_of
from lodestone.session import cut_lineage

# Elements without content, elements whose text is not shown, and elements that
# start a new line.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head script style template noscript".split())
BLOCK = frozenset(
    "address article aside blockquote br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li "
    "main nav ol p pre section table td th tr ul".split()
)
ASSET_ATTRIBUTE = {"img": "src", "script": "src", "source": "src", "link": "href", "a": "href"}
LINK_PATTERN = r"""(?i)<a\s[^>]*?href=["']([^"'#]+)"""


def parse_selector(text: str) -> list[list[tuple[str, str, frozenset[str]]]]:
    """A comma list of descendant chains of ``tag``, ``.class`` and ``#id``."""
    chains = []
    for alternative in filter(None, (part.strip() for part in text.split(","))):
        chain = []
        for step in alternative.split():
            if not re.fullmatch(r"([\w-]+)?([.#][\w-]+)*", step):
                raise ValueError(f"unsupported selector {step!r}")
            tag = re.match(r"[\w-]*", step).group().lower()
            ids = re.findall(r"#([\w-]+)", step)
            chain.append((tag, ids[0] if ids else "", frozenset(re.findall(r"\.([\w-]+)", step))))
        chains.append(chain)
    return chains


def _matches(selector: list, path: list[tuple[str, str, frozenset[str]]]) -> bool:
    """Whether the last element of ``path``, or one around it, is selected."""

    def fits(step: tuple, element: tuple) -> bool:
        return (not step[0] or step[0] == element[0]) and (not step[1] or step[1] == element[1]) and step[2] <= element[2]

    for chain in selector:
        i = 0
        for element in path:
            if i < len(chain) and fits(chain[i], element):
                i += 1
        if i == len(chain):
            return True
    return False


class _Page(HTMLParser):
    """Collects title and content of one page, and the assets it names."""

    def __init__(self, content: list, title: list, exclude: list):
        super().__init__(convert_charrefs=True)
        self.content, self.title, self.exclude = content, title, exclude
        self.path: list[tuple[str, str, frozenset[str]]] = []
        self.text: list[str] = []
        self.heading: list[str] = []
        self.assets: list[tuple[str, str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        if given.get(ASSET_ATTRIBUTE.get(tag, "")):
            self.assets.append((tag, given[ASSET_ATTRIBUTE[tag]]))
        if tag in BLOCK:
            self.text.append("\n")
        if tag not in VOID:
            self.path.append((tag, given.get("id", ""), frozenset(given.get("class", "").split())))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.path.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.text.append("\n")
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                return

    def handle_data(self, data: str) -> None:
        if _matches(self.title, self.path):
            self.heading.append(data)
        if any(tag in HIDDEN for tag, _, _ in self.path) or _matches(self.exclude, self.path):
            return
        if _matches(self.content, self.path):
            self.text.append(data)


def _tidy(parts: list[str]) -> str:
    lines = (" ".join(line.split()) for line in "".join(parts).split("\n"))
    return "\n".join(line for line in lines if line)


def _parse(html: str | None, content: list, title: list, exclude: list) -> _Page:
    page = _Page(content, title, exclude)
    page.feed(html or "")
    page.close()
    return page


def web_extract_content(
    pages: DataFrame, content: str = "", title: str = "", exclude: list[str] | None = None
) -> DataFrame:
    """``url, title, content`` of each page by selectors.

    Without selectors: the title element, and the articles or, where there is none, the body.
    """
    wanted = parse_selector(content or "article")
    fallback = None if content else parse_selector("body")
    heading = parse_selector(title or "title")
    left_out = parse_selector(",".join(exclude or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            titles, texts = [], []
            for html in batch.column("html").to_pylist():
                page = _parse(html, wanted, heading, left_out)
                text = _tidy(page.text)
                if not text and fallback is not None:
                    text = _tidy(_parse(html, fallback, heading, left_out).text)
                titles.append(" ".join("".join(page.heading).split()))
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("url"), pa.array(titles, pa.string()), pa.array(texts, pa.string())],
                names=["url", "title", "content"],
            )

    return pages.select("url", "html").mapInArrow(run, "url string, title string, content string")


def web_page_assets(
    pages: DataFrame, include_assets: bool = True, max_assets_per_page: int = 0, all_links: bool = False
) -> DataFrame:
    """``url, position, tag, target, resolved``: assets each page names, in document order.

    Assets are images, scripts, sources, stylesheets and links to files of a known type
    (``all_links`` takes every link). Zero means no bound per page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                found = [(t, a) for t, a in _parse(html, [], [], []).assets if all_links or t != "a" or _is_file(a)]
                bound = max_assets_per_page or len(found)
                for i, (tag, target) in enumerate(found[:bound]):
                    rows.append((url, i, tag, target, _resolve(url, target)))
            names = ["url", "position", "tag", "target", "resolved"]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    assets = pages.select("url", "html").mapInArrow(
        run, "url string, position int, tag string, target string, resolved string"
    )
    return assets if include_assets else assets.limit(0)


def _is_file(href: str) -> bool:
    try:
        ext = urlsplit(href).path.rsplit("/", 1)[-1].rpartition(".")[2].lower()
    except ValueError:
        return False
    return ext in CONTENT_TYPES and ext not in ("htm", "html")


def _resolve(url: str | None, target: str) -> str:
    try:
        return urljoin(url or "", target)
    except ValueError:
        return target


def page_links(pages: DataFrame) -> DataFrame:
    """``url, href``: the link targets of each page as written."""
    return pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(1))).alias("href"))


def web_crawl_frontier(
    edges: DataFrame,
    start: DataFrame,
    max_depth: int = 0,
    allowed_domains: list[str] | None = None,
    max_pages: int = 0,
) -> DataFrame:
    """``url, depth``: pages reached from the start urls, each at its smallest depth.

    ``edges`` is ``src, dst`` and ``start`` is ``url``. Zero bounds are unset; an empty list of
    domains allows any. ``max_pages`` keeps the first by depth and url. Each round is
    checkpointed in the shared folder, so plans stay flat and a lost executor costs one round.
    """

    def allowed(df: DataFrame, col: str) -> DataFrame:
        return df.where(host_of(F.col(col)).isin(allowed_domains)) if allowed_domains else df

    edges = cut_lineage(allowed(edges.select("src", "dst"), "dst").distinct())
    frontier = cut_lineage(allowed(start.select("url"), "url").distinct().withColumn("depth", F.lit(0)))
    reached = frontier
    depth = 0
    while depth != max_depth or max_depth <= 0:
        depth += 1
        step = frontier.select(F.col("url").alias("src")).join(edges, "src")
        step = step.select(F.col("dst").alias("url")).distinct()
        frontier = cut_lineage(step.join(reached, "url", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached.orderBy("depth", "url").limit(max_pages) if max_pages > 0 else reached
