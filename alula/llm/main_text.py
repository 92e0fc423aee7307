"""Main text of web pages by consensus of a host's pages on container paths.

A page's elements are scored by the running text below them (neither boilerplate nor links), with a premium for elements that say
they hold an article and a discount for the whole page. Every page votes for the *generalised path* (tags and classes from the
root, without digits) of its best container; Spark counts the votes of each host over all its pages. Then each
page is read again: of its own paths, the one with the most votes of its host wins (then the highest score, then the first by
name), and the text of all elements on that path is the page's main text. The paths with at least ``FREQUENT`` of a host's votes, a
hundred at most, travel with its pages as a list. A page that voted for a rarer path has all its paths looked up in the table of votes instead, so
that every vote counts however large the host is.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden elements and reader comments are left out wherever
they stand, by tag, role, class or id. Character references are decoded, white space becomes one blank, and blocks are joined by one
blank. Null and empty pages, and pages without running text, give the empty text. Broken markup is read as browsers do it:
unclosed elements end with their parents, stray end tags are ignored, an unclosed script or comment goes to the end.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import extended, free_name, send_small_batches, slices, written

#: Share of a host's votes from which a path is in the host's list.
FREQUENT = 0.01

# Elements by kind, and words in classes, ids and roles that mark boilerplate or main content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
PLAIN = frozenset("abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small strike strong sub sup time tt u var".split())
DROPPED = frozenset("head nav header footer aside form button select option dialog menu object canvas audio video map".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption caption address center".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies copyright dialog discussion disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup popups promo promoted promotion recommended related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar widget".split()
)
EXEMPT = frozenset("with has no without".split())
CONTENT = frozenset("article content main post entry story text body".split())

_TOKEN = re.compile(
    r"""<!--(?P<comment>.*?)(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))|(?=[\s/>]|$))""", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}[\s/>]", re.IGNORECASE) for tag in RAW}


class Page:
    """A page's elements and the texts in them."""

    def __init__(self, html: str | None):
        #: Per element: parent, label, tag, left out, in a link, content words in its names.
        self.parents, self.labels, self.tags, self.out, self.linked, self.content = [-1], [""], [""], [False], [False], [False]
        self.texts: list[tuple[int, str]] = []
        self._read(html or "")
        self.paths: list[str | None] = []
        for i, tag in enumerate(self.tags):
            above = self.paths[self.parents[i]] if i else None
            self.paths.append(above if tag in INLINE else self.labels[i] if i == 0 else f"{above}>{self.labels[i]}")

    def _read(self, html: str) -> None:
        stack, at = [0], 0
        while True:
            token = _TOKEN.search(html, at)
            text = html[at : token.start()] if token else html[at:]
            if text:
                self.texts.append((stack[-1], entities.unescape(text)))
            if not token:
                return
            at = token.end()
            tag = token["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if tag not in INLINE:
                self.texts.append((stack[-1], " "))
            if token["end"]:
                if tag not in PLAIN:
                    for depth in range(len(stack) - 1, 0, -1):
                        if self.tags[stack[depth]] == tag:
                            del stack[depth:]
                            break
                continue
            if tag in RAW:
                if not token["rest"].rstrip(">").endswith("/") or tag not in ("svg", "math"):
                    end = _RAW_END[tag].search(html, at)
                    at = html.find(">", end.start()) + 1 if end and html.find(">", end.start()) >= 0 else len(html)
                continue
            if tag in VOID or tag in PLAIN:
                continue
            if tag in CLOSES_P:
                self._close(stack, "p", "button")
            elif tag == "li":
                self._close(stack, "li", "ul", "ol")
            elif tag in ("dt", "dd"):
                self._close(stack, "dt", "dl")
                self._close(stack, "dd", "dl")
            elif tag == "body":
                self._close(stack, "head", "html")
            self._open(stack, tag, token["rest"])

    def _close(self, stack: list[int], tag: str, *barriers: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            name = self.tags[stack[depth]]
            if name == tag:
                del stack[depth:]
                return
            if name in barriers or name in ("table", "td", "th", "body"):
                return

    def _open(self, stack: list[int], tag: str, rest: str) -> None:
        names: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(rest) if len(rest) > 1 else ():
            names.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
        words = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", " ".join(names.get(k, "") for k in ("class", "id", "role"))).lower()))
        out = tag in DROPPED or "hidden" in names or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", names.get("style", ""), re.IGNORECASE))
        if tag not in ("html", "body", "article", "main") and words & BOILERPLATE and not words & EXEMPT:
            out = True
        classes = sorted({re.sub(r"\d+", "", c) for c in names.get("class", "").lower().split()} - {""})
        parent = stack[-1]
        self.parents.append(parent)
        self.labels.append(".".join([tag, *classes]))
        self.tags.append(tag)
        self.out.append(out or self.out[parent])
        self.linked.append(tag == "a" or self.linked[parent])
        self.content.append(bool(words & CONTENT))
        stack.append(len(self.tags) - 1)

    def scores(self) -> dict[str, float]:
        """Score of every container path."""
        own = [0] * len(self.tags)
        for at, text in self.texts:
            if not self.out[at] and not self.linked[at]:
                own[at] += len(text.strip())
        for at in range(len(own) - 1, 0, -1):  # children come after their parents
            own[self.parents[at]] += own[at]
        found: dict[str, float] = {}
        for at, mass in enumerate(own):
            tag = self.tags[at]
            if not mass or tag in INLINE or tag in TEXTUAL or self.out[at]:
                continue
            premium = 1.5 if tag in ("article", "main") else 0.5 if tag in ("", "html", "body") else 1.25 if self.content[at] else 1.0
            found[self.paths[at]] = found.get(self.paths[at], 0.0) + mass * premium
        return found

    def best_path(self) -> tuple[str, float] | None:
        """The path with the highest score; of equal ones the deepest, then the first by name."""
        return best_of(self.scores())

    def text(self, path: str) -> str:
        inside = [False] * len(self.tags)
        for at in range(len(self.tags)):
            inside[at] = (self.paths[at] == path and self.tags[at] not in INLINE) or (at > 0 and inside[self.parents[at]])
        return " ".join("".join(t for at, t in self.texts if inside[at] and not self.out[at]).split())


def best_of(found: dict[str, float]) -> tuple[str, float] | None:
    return min(found.items(), key=lambda x: (-x[1], -x[0].count(">"), x[0])) if found else None


def extract(html: str | None, voted: list[str]) -> str:
    """Main text of one page, given its host's paths, the most voted first."""
    page = Page(html)
    present = page.scores()
    if not present:
        return ""
    return page.text(next((p for p in voted if p in present), best_of(present)[0]))


def _host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _order() -> list[Column]:
    """Of a host's paths the one that sorts first by these wins."""
    return [(-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), F.col("path")]


def page_votes(pages: DataFrame) -> DataFrame:
    """(host, page, path, score) of every row of ``pages`` (host, page, html) that has a container; the votes."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            best = [Page(x).best_path() or (None, 0.0) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("page"), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64())],
                ["host", "page", "path", "score"],
            )

    return pages.select("host", "page", "html").mapInArrow(votes, "host string, page string, path string, score double").where("path is not null")


def rare_winners(pages: DataFrame, counted: DataFrame) -> DataFrame:
    """(host, page, winner): of all paths of a page the one with the most votes of its host, found by a join."""

    def own_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [sorted(Page(x).scores()) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(found, pa.list_(pa.string()))], ["host", "page", "paths"])

    own = pages.select("host", "page", "html").mapInArrow(own_paths, "host string, page string, paths array<string>")
    met = own.select("host", "page", F.explode("paths").alias("path")).join(counted, ["host", "path"])
    return met.groupBy("host", "page").agg(F.min(F.struct(*_order())).alias("first")).select("host", "page", F.col("first.path").alias("winner"))


def main_texts(pages: DataFrame, keep: list[str], html: str = "html", url: str = "url") -> DataFrame:
    """``keep`` columns with __text and __n_chars (code points) of every page (underscores in front where ``keep`` has these names)."""
    send_small_batches(pages.sparkSession)
    cast = pages.select(_host(url).alias("host"), F.col(html).cast("string").alias("html")).withColumn("page", F.sha2("html", 256))
    marks = written(page_votes(cast), "page-votes")
    counted = written(marks.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score")), "path-votes")
    judged = counted.join(counted.groupBy("host").agg(F.sum("votes").alias("all")), "host")
    frequent = F.col("votes") >= FREQUENT * F.col("all")
    listed = judged.where(frequent).groupBy("host").agg(F.array_sort(F.collect_list(F.struct(*_order()))).alias("found"))
    listed = written(listed.select("host", F.transform("found", lambda x: x["path"]).alias("paths")), "host-paths")
    rare = written(marks.join(judged.where(~frequent), ["host", "path"], "left_semi").select("host", "page").distinct(), "rare-pages")

    names = list(keep)
    added = [free_name(names, "__text"), free_name(names, "__n_chars")]
    n_html, n_host, n_page, n_paths, n_winner = (free_name(names, f"__{x}") for x in ("html", "host", "page", "paths", "winner"))
    rows = pages.select(*names, F.col(html).cast("string").alias(n_html), _host(url).alias(n_host))
    rows = rows.join(listed.toDF(n_host, n_paths), n_host, "left")
    if rare.isEmpty():
        rows = rows.withColumn(n_winner, F.lit(None).cast("string"))
    else:
        found = cast.join(rare, ["host", "page"], "left_semi").dropDuplicates(["host", "page"])
        winners = written(rare_winners(found, counted), "rare-winners")
        rows = rows.withColumn(n_page, F.sha2(n_html, 256)).join(winners.toDF(n_host, n_page, n_winner), [n_host, n_page], "left").drop(n_page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            given = zip(*(batch.column(c).to_pylist() for c in (n_html, n_paths, n_winner)))
            texts = [extract(h, [w] if w is not None else p or []) for h, p, w in given]
            columns = [batch.column(c) for c in names] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    return rows.drop(n_host).mapInArrow(run, extended(pages.select(*names).schema, f"`{added[0]}` string, `{added[1]}` long"))
