"""HTML extraction by nearest-URL page differencing.

Pages of a host are ordered by URL path; each page is aligned, line by line, with the nearest page on either side that
is no copy of it by longest common subsequence, and what it shares with them is the site's, not the article's.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.llm.common import materialize

MAIN, OPEN, CHROME = "main", "open", "chrome"
#: Elements that start and end a line of text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript xmp iframe".split())
#: Elements that never hold the article.
ASIDE = frozenset("head nav footer aside form menu dialog button select template svg canvas object script style textarea title noscript iframe".split())
#: Words in class, id or role that mark a part as not the article, and those that mark the article.
CHROME_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets complementary".split())
MAIN_WORDS = frozenset("article articlebody main content entry post story".split())
NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
#: What follows a tag's name, quoted values whole; never walks back.
REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
SPLIT = re.compile(r"[^a-z]+")
#: Share of the characters of two pages outside furniture that lie in common lines, from which they are copies.
COPY = 0.8
#: Ranges of the order of pages whose outermost leaders one task compares.
SPAN = 64
#: Bits of the vectors that one alignment keeps at once; longer pages are aligned by halves.
TRACE_BITS = 1 << 24


def _zone(tag: str, attributes: str, outer: str, in_main: bool) -> str:
    if outer == CHROME or tag in ASIDE or (tag == "header" and not in_main):
        return CHROME
    words: set[str] = set()
    if "=" in attributes:
        for m in MARK.finditer(attributes):
            words.update(SPLIT.split((m[1] or m[2] or m[3] or "").lower()))
    if words & CHROME_WORDS and tag not in ("html", "body", "article", "main"):
        return CHROME if not (tag == "header" and in_main) else outer
    if tag == "article" and words & {"comment", "comments", "reply"}:
        return CHROME
    return MAIN if tag in ("article", "main") or words & MAIN_WORDS and tag not in ("html", "body") else outer


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, slash, name and attributes of every tag in order, in one pass.

    Comments and declarations come without a name; an element whose content is no markup is one tag up to its end.
    A tag that never ends is markup to the end of the page, as in browsers. If a quoted value never ends, tags from
    there on end at the next angle bracket.
    """
    at, last, quoted = 0, page.rfind(">"), True
    while (start := page.find("<", at)) >= 0:
        slash = name = attributes = ""
        if page.startswith("<!--", start):
            found = page.find("-->", start + 2)
            at = found + 3 if found >= 0 else len(page)
        elif m := NAME.match(page, start + 1):
            slash, name = m[1], m[2].lower()
            rest = REST.match(page, m.end()) if quoted and start < last else None
            if rest:
                attributes, at = rest[1], rest.end()
            elif start < last:
                quoted, at = False, page.find(">", m.end()) + 1
                attributes = page[m.end() : at - 1]
            else:
                slash, name, at = "", "", len(page)
            if name in RAW and not slash and not attributes.endswith("/"):
                end = RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
        elif page.startswith(("<!", "<?", "</"), start):
            at = page.find(">", start) + 1 if start < last else len(page)
        else:  # an angle bracket in the text
            at = start + 1
            continue
        yield start, at, slash, name, attributes


def lines_of(page: str | None) -> list[tuple[str, str]]:
    """The lines of a whole page in order, each with its zone: in the article's element, outside it, or furniture.

    A line is the text between two block boundaries, its character references decoded, its white space single.
    Wrongly nested, unclosed and unknown tags are read as browsers do in outline: an end tag closes what is open
    below it, a block closes an open paragraph. Null and empty pages have no lines. The time grows with the length
    of the page, however deep or broken it is.
    """
    page = page or ""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()
    held: list[str] = []
    at, zone = 0, OPEN

    def close_line() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                out.append((zone, text))

    def add(text: str) -> None:
        if text:
            held.append(html.unescape(text) if "&" in text else text)

    def close(tag: str) -> None:
        while True:
            last, _ = stack.pop()
            opened[last] -= 1
            if last == tag:
                return

    for start, end, slash, tag, attributes in tags(page):
        add(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            close_line()
        if slash:
            if opened[tag]:
                close(tag)
        else:
            if tag in BLOCKS and any(t == "p" for t, _ in stack[-4:]):
                close("p")
            if tag in BLOCKS and stack and stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dd", "dt", "option"):
                close(tag)
            if tag in VOID or tag in RAW or attributes.endswith("/") and tag not in BLOCKS:
                continue
            outer = stack[-1][1] if stack else OPEN
            inner = _zone(tag, attributes, outer, bool(opened["article"] or opened["main"]))
            if inner != outer:
                close_line()
            stack.append((tag, inner))
            opened[tag] += 1
        new = stack[-1][1] if stack else OPEN
        if new != zone:
            close_line()
            zone = new
    add(page[at:])
    close_line()
    return out


def line_hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), 42)
    return value - (1 << 64) if value >> 63 else value


def _states(mine: list[int], theirs: list[int]) -> Iterator[int]:
    """After each line of `theirs`, the bits of `mine` at which no common subsequence grows."""
    masks: dict[int, int] = {}
    for i, x in enumerate(mine):
        masks[x] = masks.get(x, 0) | 1 << i
    full = state = (1 << len(mine)) - 1
    for x in theirs:
        both = state & masks.get(x, 0)
        state = ((state + both) | (state - both)) & full
        yield state


def _lengths(mine: list[int], theirs: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of `theirs` with the first 0, 1, ... lines of `mine`."""
    state = deque(_states(mine, theirs), 1)[0]
    bits = np.unpackbits(np.frombuffer(state.to_bytes(-(-len(mine) // 8), "little"), np.uint8), bitorder="little")[: len(mine)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared_lines(mine: list[int], theirs: list[int]) -> set[int]:
    """Positions of `mine` in a longest common subsequence with `theirs`, by bit vectors.

    Lines that the other page does not hold are left out first; pages of very many common lines are cut where the
    subsequence meets the middle of `theirs`, so that no more than TRACE_BITS bits are kept.
    """
    common = set(mine).intersection(theirs)
    places = [i for i, x in enumerate(mine) if x in common]
    theirs = [x for x in theirs if x in common]
    todo, found = [(0, len(places), 0, len(theirs))], set()
    while todo:
        a, b, c, d = todo.pop()
        here, there = [mine[i] for i in places[a:b]], theirs[c:d]
        if not here or not there:
            continue
        if len(here) * len(there) > TRACE_BITS and len(there) > 1:
            mid = (c + d) // 2
            best = a + int(np.argmax(_lengths(here, theirs[c:mid]) + _lengths(here[::-1], theirs[mid:d][::-1])[::-1]))
            todo += [(a, best, c, mid), (best, b, mid, d)]
            continue
        rows = list(_states(here, there))
        row, col = len(there), len(here)
        while row and col:
            bit = 1 << (col - 1)
            if rows[row - 1] & bit:
                col -= 1
            else:
                row -= 1
                if not row or rows[row - 1] & bit:
                    col -= 1
                    found.add(places[a + col])
    return found


def copies(a: dict[int, int], b: dict[int, int]) -> bool:
    """Whether two sets of lines outside furniture (hash: characters) are those of copies of one page."""
    common = sum(size for line, size in a.items() if line in b)
    return common >= COPY * (sum(a.values()) + sum(b.values()) - common)


def page_lines(lines: list[tuple[str, str]]) -> dict:
    """Hash of every line, and its characters: 0 in furniture, below 0 in the article's element."""
    sign = {CHROME: 0, MAIN: -1, OPEN: 1}
    return {"hashes": [line_hash(text) for _, text in lines], "sizes": [sign[zone] * len(text) for zone, text in lines]}


def weighed(page: dict) -> dict[int, int]:
    """The lines outside furniture of a page, with their characters."""
    return {line: abs(size) for line, size in zip(page["hashes"], page["sizes"], strict=True) if size}


def article(lines: list[tuple[str, str]], deleted: set[int]) -> str:
    """What remains of the lines: those of the article's element, and those outside it that neighbours do not share."""
    return "\n".join(text for i, (zone, text) in enumerate(lines) if zone == MAIN or zone == OPEN and i not in deleted)


COUNTS = ("n_lines", "n_deleted", "n_protected", "n_furniture")


def pack(lines: list[tuple[str, str]]) -> bytes:
    """The lines of a page compressed, without the texts of furniture."""
    return zstandard.ZstdCompressor(3).compress("\n".join(zone[0] + (text if zone != CHROME else "") for zone, text in lines).encode("utf-8", "replace"))


def unpack(packed: bytes) -> list[tuple[str, str]]:
    whole = zstandard.ZstdDecompressor().decompress(packed).decode()
    zones = {zone[0]: zone for zone in (MAIN, OPEN, CHROME)}
    return [(zones[line[0]], line[1:]) for line in whole.split("\n")] if whole else []


def finished(lines: list[tuple[str, str]], shared: Sequence[bool]) -> dict:
    """The text of a page and how its lines were treated; `shared` marks those that a neighbour has."""
    of = {i for i, mark in enumerate(shared) if mark}
    counts = Counter((zone, i in of) for i, (zone, _) in enumerate(lines))
    deleted = counts[OPEN, True] + counts[CHROME, True]
    return {"text": article(lines, of)} | dict(zip(COUNTS, (len(lines), deleted, counts[MAIN, True], counts[CHROME, False]), strict=True))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order with the number of their run and whether they lead it; a run's pages are copies of its leader."""
    host, leader, run = None, {}, -1
    for batch in batches:
        numbers, leads = [], []
        for row in batch.to_pylist():
            lines = weighed(row["page"])
            new = row["host"] != host or not copies(leader, lines)
            if new:
                host, leader, run = row["host"], lines, run + 1
            numbers.append(run)
            leads.append(new)
        names = [*batch.schema.names, "run", "leads"]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64()), pa.array(leads, pa.bool_())], names=names)


_PAGE = "struct<hashes:array<bigint>,sizes:array<int>>"
_ENDS = ", ".join(f"{name} struct<host:string,page:{_PAGE}>" for name in ("first", "second", "last_but_one", "last"))


class _End:
    """An outermost leader of a range, with its lines outside furniture."""

    def __init__(self, row: dict):
        self.host, self.page, self.lines = row["host"], row["page"], weighed(row["page"])

    def meets(self, others: Iterable[_End]) -> tuple[_End | None, bool]:
        """The first of the others that is no copy, and whether the search came to an end: one of another host ends it."""
        for other in others:
            if other.host != self.host or not copies(self.lines, other.lines):
                return other, True
        return None, False


def _ranges(ends: pa.Table) -> list[tuple[int, list[_End]]]:
    """The ranges of a block in order, each with its outermost leaders in order; its first and last are always there."""
    order = ("first", "second", "last_but_one", "last")
    return [(row["part"], [_End(row[name]) for name in order if row[name]]) for row in sorted(ends.to_pylist(), key=lambda row: row["part"])]


def _inside(ends: pa.Table) -> pa.Table:
    """For each range of a block the nearest leaders of the block's other ranges on either side that are no copies of
    its outermost ones, and whether one must be sought outside the block."""
    ranges, out = _ranges(ends), []
    for i, (part, mine) in enumerate(ranges):
        before = (end for _, others in reversed(ranges[:i]) for end in reversed(others))
        after = (end for _, others in ranges[i + 1 :] for end in others)
        row = {"part": part}
        for side, me, others in (("left", mine[0], before), ("right", mine[-1], after)):
            found, ended = me.meets(others)
            row |= {side: found.page if found and found.host == me.host else None, f"{side}_open": not ended}
        out.append(row)
    page = pa.struct([("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
    return pa.Table.from_pylist(out, pa.schema([("part", pa.int32()), ("left", page), ("right", page), ("left_open", pa.bool_()), ("right_open", pa.bool_())]))


def _outline(block: tuple[pa.Scalar, ...], ends: pa.Table) -> pa.Table:
    """A block as one range of the level above: its outermost leaders, and the nearest to each that is no copy."""
    ranges = _ranges(ends)
    inner = [end for _, of in ranges for end in of]
    first, last = inner[0], inner[-1]
    told = {"first": first, "second": first.meets(inner[1:])[0], "last_but_one": last.meets(reversed(inner[:-1]))[0], "last": last}
    row = {"part": block[0].as_py()} | {name: end and {"host": end.host, "page": end.page} for name, end in told.items()}
    end = pa.struct([("host", pa.string()), ("page", pa.struct([("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))]))])
    return pa.Table.from_pylist([row], pa.schema([("part", pa.int32()), *((name, end) for name in told)]))


def _across(ends: DataFrame, ranges: int) -> DataFrame:
    """(part, left, right) of every range: the nearest leaders beyond it that are no copies of its outermost ones.

    Blocks of SPAN ranges are settled by one task each; what a block cannot settle, for all that it holds on that side
    are copies, is asked of the level above, in which a block is a range. No task holds more than SPAN ranges' ends.
    """
    blocks = ends.withColumn("block", F.floor(F.col("part") / SPAN).cast("int"))
    inside = blocks.groupBy("block").applyInArrow(_inside, f"part int, left {_PAGE}, right {_PAGE}, left_open boolean, right_open boolean")
    if ranges <= SPAN:
        return inside.select("part", "left", "right")
    above = materialize(blocks.groupBy("block").applyInArrow(_outline, f"part int, {_ENDS}"))
    beyond = _across(above, -(-ranges // SPAN)).select(F.col("part").alias("block"), F.col("left").alias("l"), F.col("right").alias("r"))
    joined = inside.withColumn("block", F.floor(F.col("part") / SPAN).cast("int")).join(beyond, "block")
    return joined.select("part", F.when(F.col("left_open"), F.col("l")).otherwise(F.col("left")).alias("left"), F.when(F.col("right_open"), F.col("r")).otherwise(F.col("right")).alias("right"))


def neighbour_lines(pages: DataFrame) -> DataFrame:
    """(key, page, before, after) of every page: its lines and those of the nearest pages that are no copies of it.

    Input: key, host, path, page (hashes and sizes of its lines). Pages are ordered by host, path and key over ranges
    of that order, which no host can outgrow, and fall into runs of copies. A page's neighbours are the leaders of the
    runs beside its own; only the outermost runs of a range look beyond it, through a table of one row a range, which
    is searched in blocks, level by level.
    """
    n = max(2, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = pages.repartitionByRange(n, "host", "path", "key").withColumn("part", F.spark_partition_id()).sortWithinPartitions("host", "path", "key")
    ranged = ranged.select("key", "host", "part", "page")
    walked = materialize(ranged.mapInArrow(_runs, f"key bigint, host string, part int, page {_PAGE}, run bigint, leads boolean"))
    order = W.partitionBy("part").orderBy("run")
    row = F.struct("host", "page")
    leaders = walked.filter("leads").select("part", "run", row.alias("row"), F.lag(row).over(order).alias("p"), F.lead(row).over(order).alias("n"))
    ends = leaders.groupBy("part").agg(F.min_by("row", "run").alias("first"), F.max_by("row", "run").alias("last"), F.min_by("n", "run").alias("second"), F.max_by("p", "run").alias("last_but_one"))
    across = _across(materialize(ends) if n > SPAN else ends, n)
    same = lambda c: F.when(F.col(c)["host"] == F.col("row")["host"], F.col(c)["page"])
    beside = leaders.join(across, "part").select("part", "run", F.when(F.col("p").isNull(), F.col("left")).otherwise(same("p")).alias("before"), F.when(F.col("n").isNull(), F.col("right")).otherwise(same("n")).alias("after"))
    return walked.join(beside, ["part", "run"]).select("key", "page", "before", "after")


def extract(df: DataFrame, html_col: str = "html", url_col: str = "url", text_col: str = "text", counts: bool = False) -> DataFrame:
    """df with `text_col`, the main text of each page; every other column stays.

    Every page is aligned with its neighbours and every line that it shares with one is deleted, in furniture as
    elsewhere. Structure comes after: lines inside the article's element are protected, for articles of one host may
    quote each other or hold equal lines, and furniture that differs from page to page is left out. With `counts`
    there are also n_lines, n_deleted (by differencing), n_protected (shared, but in the article's element) and
    n_furniture (left out by structure alone).

    A null url has no host and no neighbours, so its page is judged alone; a null or empty page gives an empty
    text. Repeated rows are one page, which is aligned once and does not meet itself. Copies of a page are not its
    neighbours; a page that has only copies on its host is judged alone. What is shuffled is the lines' hashes and,
    once, the lines that may stay; a page that very many rows repeat is one key, whose rows Spark splits.
    """
    key = F.xxhash64(df[url_col], df[html_col])

    def hashes(pages: pa.Array) -> pa.Array:
        return pa.array([page_lines(lines_of(page)) for page in pages.to_pylist()], pa.struct([("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))]))

    made = F.arrow_udf(hashes, "struct<hashes:array<bigint>,sizes:array<int>>")(df[html_col])
    host = F.lower(F.regexp_extract(df[url_col], r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract(df[url_col], r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    seen = df.filter(df[url_col].isNotNull()).select(key.alias("key"), host.alias("host"), path.alias("path"), made.alias("page"))
    # a filter ahead of the table would have every page read twice
    table = materialize(seen.dropDuplicates(["key"])).filter(F.size("page.hashes") > 0)

    def align(mine: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
        rows = []
        for page, *beside in zip(mine.to_pylist(), before.to_pylist(), after.to_pylist(), strict=True):
            # a page that is a copy of its run's leader may also be one of the next leader
            others = [other for other in beside if other and not copies(weighed(page), weighed(other))]
            shared = set().union(*(shared_lines(page["hashes"], other["hashes"]) for other in others))
            rows.append([i in shared for i in range(len(page["hashes"]))])
        return pa.array(rows, pa.list_(pa.bool_()))

    shared = F.arrow_udf(align, "array<boolean>")("page", "before", "after")
    marks = neighbour_lines(table).select(F.col("key").alias("__k"), shared.alias("__d"))

    def packed(pages: pa.Array) -> pa.Array:
        return pa.array([pack(lines_of(page)) for page in pages.to_pylist()], pa.binary())

    def finish(pages: pa.Array, marks: pa.Array) -> pa.Array:
        rows = [finished(unpack(page), shared or ()) for page, shared in zip(pages.to_pylist(), marks.to_pylist(), strict=True)]
        return pa.array(rows, pa.struct([("text", pa.string()), *((name, pa.int64()) for name in COUNTS)]))

    columns = [F.col(c) for c in df.columns if c != text_col]
    # the lines are read and packed before the join, which then carries no page
    read = df.select(*columns, key.alias("__key"), F.arrow_udf(packed, "binary")(F.col(html_col)).alias("__l"))
    joined = read.join(marks, F.col("__key") == F.col("__k"), "left")
    made = F.arrow_udf(finish, "struct<text:string," + ",".join(f"{name}:bigint" for name in COUNTS) + ">")("__l", "__d")
    joined = joined.select(*columns, made.alias("__m"))
    return joined.select(*columns, F.col("__m.text").alias(text_col), *[F.col(f"__m.{name}") for name in COUNTS if counts])


def op9_html_url_diff(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars, and the counts of `extract`."""
    made = extract(pages.select("page_id", "url", "html"), counts=True)
    return made.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_lines", "n_deleted", "n_protected", "n_furniture")
