"""Main text of web pages by differencing each page with the page of the nearest URL.

A page is read into text lines, one per block. Elements whose kind or name says that they are no
article text (menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts) give
none. Pages of a host with equal lines count as one. Pages are then ordered by host and URL path, and each
is paired with the nearest one before or after it that differs materially, by the longer prefix of the
paths. For that, neighbours that do not differ materially form runs, of which only the ends are met:
copies, nearly equal captures and excerpts take no text from each other. The lines of the two pages are
aligned by longest common subsequence, and the lines on it are deleted, by their place, as the site's
template. That holds inside an ``article`` or ``main`` element too: sites repeat share lines, by-lines
and notices there. Where a page has such an element, lines outside it are no part of the article.

Only hashes and sizes of lines travel to the neighbour. Places in URL order come from
ranges of all pages, so a host with a third of the pages is spread like any other.

Defined cases: null or empty html has no text; a page whose URL is null, or whose host has no page that
differs materially, is not paired and keeps all lines; equal URLs are ordered by page id; every row with an id gives a row, rows of one
``page_id`` that repeat give as many; rows without ``page_id`` give their text unpaired; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import stored
from wayfare.llm.numbering import numbered

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("aside button dialog footer form head iframe math nav noscript object script select style svg "
                    "template textarea title menu canvas audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure hr html legend li "
    "main ol p pre section summary table tbody td tfoot th thead tr ul header hgroup".split())
OWN = frozenset(("article", "main"))
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
CLOSES_P = BLOCKS - frozenset("body html caption td th tr tbody thead tfoot li dd dt".split())
# Words of class, id and role that mark an element as no article text: what others wrote or sell, and page furniture.
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus respond "
    "reply replies related recommended recommendations".split())
MARKS = FOREIGN | frozenset(
    "banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside complementary footer contentinfo "
    "masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login search share sharing social widget toolbar pagination pager skip hidden".split())
# Words that may stand beside a mark in one token, as in share-box. Any other word makes the token a name of its own.
BESIDE = frozenset(
    "area articles bar block bottom box button buttons container content footer form global group header holder icons inner "
    "item items left link links list main message outer page panel post posts primary right secondary section site slot "
    "reader readers stories thread top unit user users wrap wrapper".split())
CONTAINERS = frozenset("article center details div dl fieldset figure li ol section table td ul".split())
NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)")
WHITE = re.compile(r"\s+")
# Pages differ materially if each has at least this share of its characters in lines that the other lacks.
OWN_SHARE = 0.15


def marked(value: str | None, marks: frozenset[str] = MARKS) -> bool:
    """Whether a whole token of a class, id or role is a mark, alone or beside words of layout."""
    for token in (value or "").lower().split():
        words = set(re.split("[_-]+", token)) - {""}
        if words & marks and words <= MARKS | BESIDE:
            return True
    return False


def unseen(attrs: dict[str, str | None]) -> bool:
    """Whether an element is never shown."""
    return "hidden" in attrs or (attrs.get("aria-hidden") or "").strip().lower() == "true" or bool(
        NOT_SHOWN.search((attrs.get("style") or "").lower()))


# How an element is left out: not at all, as a form or named wrapper that an article may stand in, or with all it holds.
READ, FORM, NAMED, OUT = range(4)
# How far a line is declared as article text.
IN_FORM, PLAIN, WRAPPED, OWN_TEXT = range(4)


class Lines(HTMLParser):
    """Text lines of a page, each with how far it is declared as article text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []  # element, how it is left out, how far it is article text
        self.named: Counter[str] = Counter()  # open elements by name
        self.lines: list[tuple[str, int]] = []
        self.text: list[str] = []
        self.has_own = False

    def end_line(self) -> None:
        line = WHITE.sub(" ", "".join(self.text)).strip()
        if line:
            left_out, own = self.state()
            self.lines.append((line, IN_FORM if left_out == FORM else own))
        self.text = []

    def state(self) -> tuple[int, int]:
        return self.open[-1][1:] if self.open else (READ, PLAIN)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.end_head(tag)
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCKS or tag in SKIPPED:
            self.end_line()
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close("p", stop=OWN | {"div", "section", "td", "li"})
        if tag == "li":
            self.close("li", stop=frozenset(("ul", "ol")))
        left_out, own = self.entered(tag, dict(reversed(attrs)), *self.state())
        self.has_own |= own == OWN_TEXT and left_out == READ
        self.open.append((tag, left_out, own))
        self.named[tag] += 1

    def entered(self, tag: str, attrs: dict[str, str | None], left_out: int, own: int) -> tuple[int, int]:
        """The state inside an element, from the state around it."""
        if left_out == OUT:
            return left_out, own
        # In an article, ids of sections are made from their headings.
        in_article = self.named["article"] > 0
        names = [attrs.get("role")] if tag not in ("html", "body", *OWN) else []
        names += [attrs.get("class")] if tag in CONTAINERS - OWN else []
        names += [attrs.get("id")] if tag in CONTAINERS - OWN and not (in_article and tag == "section") else []
        foreign = any(marked(n, FOREIGN) for n in names)
        if tag not in CONTAINERS and tag not in ("html", "body", *OWN):
            # Elsewhere a mark must be a whole token, with nothing beside it.
            foreign = foreign or not FOREIGN.isdisjoint((attrs.get("class") or "").lower().split())
        # The page's own header is a template; a header inside the article holds its title.
        if tag in SKIPPED and tag != "form" or tag == "header" and own == PLAIN or unseen(attrs) or foreign:
            return OUT, own
        if tag == "form" or any(map(marked, names)):
            return (OUT if own != PLAIN else max(left_out, FORM if tag == "form" else NAMED)), own
        if tag == "main":
            return READ, OWN_TEXT
        if tag == "article" and marked(attrs.get("class"), FOREIGN):
            return (OUT, own) if own != PLAIN else (READ, WRAPPED)
        if tag == "article":
            return READ, max(own, WRAPPED if left_out == NAMED else OWN_TEXT)
        return left_out, own

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # Besides the void elements only those of SVG and MathML may close themselves: else the slash is ignored.
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.close(tag, stop=frozenset())

    def end_head(self, tag: str) -> None:
        """The end tag of head may be left out: body, and whatever cannot stand in a head, close it."""
        if tag == "body" or self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self.close("head", stop=OWN | {"body"})

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in SKIPPED:
            self.end_line()
        self.close(tag, stop=frozenset() if tag in OWN or tag in SKIPPED else OWN)

    def close(self, tag: str, stop: frozenset[str]) -> None:
        if not self.named[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.end_line() if tag in BLOCKS else None
                self.named.subtract(name for name, *_ in self.open[at:])
                del self.open[at:]
                return
            if self.open[at][0] in stop:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.end_head("")
        if self.state()[0] in (READ, FORM):
            self.text.append(data)


def lines(html: str | None) -> list[tuple[str, bool]]:
    """The page's article candidates as (line, whether it is declared article text)."""
    if not html:
        return []
    reader = Lines()
    reader.feed(html)
    HTMLParser.close(reader)
    reader.end_line()
    kinds = [[line for line, own in reader.lines if own == kind] for kind in (IN_FORM, PLAIN, WRAPPED, OWN_TEXT)]
    if not reader.has_own:
        # Articles in a named wrapper are the page's text if they are most of it, and teasers or comments if not. A form
        # that holds all text stands round the page.
        wrapped = sum(map(len, kinds[WRAPPED])) > sum(map(len, kinds[PLAIN]))
        kind = WRAPPED if wrapped else PLAIN if kinds[PLAIN] else IN_FORM
        return [(line, wrapped) for line in kinds[kind]]
    return [(line, True) for line in kinds[OWN_TEXT]]


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each line of ``a`` is on the longest common subsequence with ``b``.

    Common ends are matched at once. The rest is Hirschberg's division with one row of
    lengths at a time, so memory stays linear in the lines.
    """
    out = np.zeros(len(a), bool)

    def lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        row = np.zeros(len(y) + 1, np.int32)
        for value in x:
            row[1:] = np.maximum(np.maximum.accumulate(np.where(y == value, row[:-1] + 1, 0)), row[1:])
        return row

    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out[i] = True
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            out[j - 1] = True
            j, m = j - 1, m - 1
        if i == j or k == m:
            continue
        if j - i == 1:
            out[i] = bool((b[k:m] == a[i]).any())
            continue
        half = (i + j) // 2
        front, back = lengths(a[i:half], b[k:m]), lengths(a[half:j][::-1], b[k:m][::-1])[::-1]
        cut = k + int((front + back).argmax())
        todo += [(i, half, k, cut), (half, j, cut, m)]
    return out


def _hashes(page: list[tuple[str, bool]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(line) - (1 << 63) for line, _ in page]


def compared(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, bool]:
    """Which lines of ``a`` are on the longest common subsequence, and whether the pages differ materially."""
    in_a, in_b = np.isin(a, b), np.isin(b, a)
    both = np.zeros(len(a), bool)
    both[in_a] = shared(a[in_a], b[in_b])
    return both, bool(a_sizes[~in_a].sum() >= OWN_SHARE * a_sizes.sum() and b_sizes[~in_b].sum() >= OWN_SHARE * b_sizes.sum())


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _prefix(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def page_lines(pages: DataFrame) -> DataFrame:
    """Every row's lines, with their hashes and sizes; ``digest`` of host and lines where the row can be paired."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                page = lines(row.pop("html"))
                row["lines"] = [line for line, _ in page]
                if row["page_id"] is not None and row["url"] is not None and (hashes := _hashes(page)):
                    row |= {"hashes": hashes, "sizes": [len(line) for line in row["lines"]], "digest": xxhash.xxh3_128_digest(
                        row["host"].encode() + b"\0" + np.array(hashes, np.int64).tobytes())}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, kinds)

    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()),
                       ("digest", pa.binary()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                       ("lines", pa.list_(pa.string()))])
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         _host(F.col("url")).alias("host"), _path(F.col("url")).alias("path"), "html")
    return stored(keyed.mapInArrow(read, "page_id long, url string, host string, path string, digest binary, "
                                         "hashes array<long>, sizes array<int>, lines array<string>"), "page-lines")


def runs(placed: DataFrame) -> DataFrame:
    """``placed`` with the number of its run: a run ends where the next page of the host differs materially."""

    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [row["other"] is None or compared(*_arrays(row))[1] for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(int, ends), pa.int32())], ["place", "ends"])

    follower = placed.select((F.col("place") - 1).alias("place"), "host", F.col("hashes").alias("other"),
                             F.col("sizes").alias("other_sizes"))
    ends = stored(placed.join(follower, ["place", "host"], "left").select("place", "hashes", "sizes", "other", "other_sizes")
                  .mapInArrow(ending, "place long, ends int"), "run-ends").withColumn("block", F.shiftright("place", 12))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # A row per 4096 pages.
    bases = ends.groupBy("block").agg(F.sum("ends").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(before.orderBy("block")), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum("ends").over(before.partitionBy("block").orderBy("place")), F.lit(0))
    numbers = ends.withColumn("within", within).join(F.broadcast(bases), "block").select(
        "place", (F.col("base") + F.col("within")).alias("run"))
    return stored(placed.join(numbers, "place"), "page-runs")


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.array(row["hashes"], np.int64), np.array(row["sizes"], np.int64),
            np.array(row["other"], np.int64), np.array(row["other_sizes"], np.int64))


def template_lines(found: DataFrame) -> DataFrame:
    """``digest, deleted array<int>``: places of the lines that pages share with the nearest page of other content."""
    one = found.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("host", "path", "page_id", "hashes", "sizes")).alias("first")).select("digest", "first.*")
    placed = stored(numbered(one, [F.col(c) for c in ("host", "path", "page_id")], "place"), "placed-pages")
    pages = runs(placed)
    edge = F.struct("place", "host", "path", "hashes", "sizes")
    # Looking back, a run is met at its last page, looking ahead at its first.
    met = pages.groupBy("run").agg(F.max(edge).alias("back"), F.min(edge).alias("ahead")).select(
        "run", F.explode(F.create_map(F.lit(-1), F.col("back"), F.lit(1), F.col("ahead"))).alias("side", "at")).select(
            "run", "side", "at.host", F.col("at.path").alias("other_path"), F.col("at.hashes").alias("other"),
            F.col("at.sizes").alias("other_sizes"))
    met = stored(met, "run-edges")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                both, differs = compared(*_arrays(row))
                rows.append({"place": row["place"], "side": row["side"], "steps": row["steps"], "differs": differs,
                             "prefix": _prefix(row["path"], row["other_path"]), "other_path": row["other_path"],
                             "deleted": np.flatnonzero(both).tolist()})
            yield pa.RecordBatch.from_pylist(rows, kinds)

    kinds = pa.schema([("place", pa.int64()), ("side", pa.int32()), ("steps", pa.int64()), ("differs", pa.bool_()),
                       ("prefix", pa.int32()), ("other_path", pa.string()), ("deleted", pa.list_(pa.int32()))])
    todo = pages.select("*", F.explode(F.array(F.lit(-1), F.lit(1))).alias("side"))
    mates, steps = None, 1
    while True:
        # The next run nearly always differs. Where it does not, twice as many runs as before are looked at.
        asked = todo.select("*", F.explode(F.sequence(F.lit(steps).cast("long"), F.lit(2 * steps - 1).cast("long"))).alias("steps"))
        pairs = asked.withColumn("run", F.col("run") + F.col("side") * F.col("steps")).join(met, ["run", "side", "host"])
        seen = stored(pairs.select("place", "side", "steps", "path", "hashes", "sizes", "other_path", "other", "other_sizes").mapInArrow(
            align, "place long, side int, steps long, differs boolean, prefix int, other_path string, deleted array<int>")
            .groupBy("place", "side").agg(F.count("*").alias("n"), F.min(F.when(F.col("differs"), F.struct(
                "steps", "prefix", "other_path", "deleted"))).alias("mate")), "page-mates")
        new = seen.where(F.col("mate").isNotNull()).select("place", "mate.*")
        mates = new if mates is None else mates.unionByName(new)
        # Fewer rows than runs asked for: the host has no more.
        open_ = seen.where(F.col("mate").isNull() & (F.col("n") == steps)).select("place", "side")
        if open_.isEmpty():
            break
        todo, steps = pages.join(open_, "place"), 2 * steps
    # Of two equally near pages the later one.
    best = mates.groupBy("place").agg(F.max_by("deleted", F.struct("prefix", -F.col("steps"), "other_path")).alias("deleted"))
    return stored(placed.select("place", "digest").join(best.where(F.size("deleted") > 0), "place").select(
        "digest", "deleted"), "template-lines")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every page."""
    found = page_lines(pages)
    # One row of template lines per content; a large group of copies is on the other side, which adaptive execution splits.
    paired = found.where(F.col("digest").isNotNull()).join(template_lines(found), "digest", "left").withColumn(
        "lines", F.when(F.col("deleted").isNull(), F.col("lines")).otherwise(
            F.filter("lines", lambda _, at: ~F.array_contains("deleted", at))))
    return paired.select("page_id", "url", "lines").unionByName(
        found.where(F.col("digest").isNull()).select("page_id", "url", "lines")).select(
            "page_id", "url", F.array_join("lines", "\n\n").alias("text"))
