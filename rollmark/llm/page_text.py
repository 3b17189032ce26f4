"""Main text of web pages by templates deduced from the pages of a host.

1. A page is read as tokens: tags with the path of open elements above them, and runs of text with
   theirs. A token's occurrence vector is how often each page of the host has it.
2. Tokens with the same vector form an equivalence class. Instead of vectors, sums of hashes over
   (page, count) are compared, so a class is a plain aggregate however many pages a host has.
3. A class is valid if it is frequent (on a share of the host's pages) and large (two tokens or
   more), and on a page if its tokens come in the same order as on the others: those that do not
   are left out of the template there. Valid classes nest as the elements that their tokens open.
4. Template tokens cut a page into slots, which hold what differs between pages. Text in slots is
   kept, template text is not. Inside an article or main element, where passages may be shared by
   chance, it stays unless it is on nearly all pages in a place of its own: one whose path holds no
   text that differs. Slots of links alone are dropped. Slots that bear a name of furniture (menus, headers,
   footers, side columns, adverts, notices, forms, comments), by element, class or id, are dropped; but
   where no article tells the text, a class or id does not outweigh most of the text that differs.
5. Article and main elements are a hint: text outside them goes only if it is short beside theirs, and
   the name of something around them says nothing about them.

The pages of a host are never brought together; a host's template is a bounded list, as each of its
tokens is on a fixed share of the pages. Pages of large hosts meet copies of it in many tasks.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

#: Share of a host's pages that a template token is on, at least; and the fewest pages.
SUPPORT, FEWEST = 0.3, 3
#: Tokens of a class, at least.
SIZE = 2
#: Share of a host's pages from which a class is on nearly all.
EVERYWHERE = 0.9
#: Pages of a large host that are joined to its template in one task.
PART = 2000
#: Text outside article and main elements goes if it is no longer than this part of theirs.
BESIDE = 0.5

#: Elements and names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = set("head script style template noscript iframe object svg math canvas audio video noembed noframes".split())
FURNITURE = set("nav footer aside form button select option dialog menu fieldset textarea input label".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = {"article", "main"}
#: A class or id that as a whole says furniture, with words that say where or what kind.
NAMES = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|post|entry|article|global|primary|secondary|user|reader)[-_]?)?"
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|side-bar|aside|"
    r"footer|header|masthead|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"share|sharing|social|related|recommend\w*|comments?|disqus|replies|respond|pagination|pager|toolbar|"
    r"widget|skip|hidden|alert)"
    r"(?:[-_]?(?:\d+|list|bar|box|area|wrap|wrapper|container|section|block|links?|menu|nav|content|item|items))*", re.I,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu"}
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_WHITE = re.compile(r"\s+")


@dataclass
class Element:
    name: str
    path: str
    main: bool
    furniture: bool  #: by element or role
    named: bool  #: by class or id
    unseen: bool
    link: bool


@dataclass
class Run:
    """Text of one block."""

    path: str
    main: bool
    furniture: bool
    named: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return _WHITE.sub(" ", "".join(self.parts)).strip()


def _opened(name: str, attributes: str, top: Element) -> Element:
    named: dict[str, str] = {}
    for m in _ATTR.finditer(attributes):
        named.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    label = f"{named.get('class', '')} {named.get('id', '')}".strip()
    enters = not top.main and (name in MAIN or named.get("role") == "main")
    main = top.main or enters
    furniture = top.furniture or name in FURNITURE or (name == "header" and not top.main)
    furniture = furniture or named.get("role", "").lower() in ROLES or named.get("aria-hidden") == "true"
    furniture = furniture or "hidden" in named
    says = top.named and not enters
    if name not in ("html", "body", "article", "main") and label:
        parts = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", label).split()
        says = says or any(NAMES.fullmatch(part) for part in parts)
    here = f"{top.path}/{name}" + (f".{label}" if label else "")
    return Element(name, here, main, furniture, says, top.unseen or name in UNSEEN, top.link or name == "a")


def tokens(page: str) -> Iterator[tuple[str, Run | None]]:
    """(token, None) for each tag and (token, run) for each block's text, in page order."""
    stack = [Element("", "", False, False, False, False, False)]
    run: Run | None = None
    at, n = 0, len(page)
    raw = re.compile("")

    def ended() -> Iterator[tuple[str, Run | None]]:
        nonlocal run
        if run is not None and (said := run.text()):
            yield f"{run.path}#{said}", run
        run = None

    def said(text: str) -> None:
        nonlocal run
        top = stack[-1]
        if top.unseen or not text:
            return
        block = next((e for e in reversed(stack) if e.name in BLOCK or not e.name), stack[0])
        if run is None:
            run = Run(block.path, top.main, top.furniture, top.named)
        elif (run.furniture, run.named, run.main) != (top.furniture, top.named, top.main):
            if not text.strip():
                return
            ready.append(run)
            run = Run(block.path, top.main, top.furniture, top.named)
        text = entities.unescape(text)
        run.parts.append(text)
        run.linked += top.link * len(text.strip())

    ready: list[Run] = []
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        said(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name == "br":
            said(" ")
            continue
        if name in BLOCK:
            for r in ready:
                if text := r.text():
                    yield f"{r.path}#{text}", r
            ready.clear()
            yield from ended()
        if closing:
            if any(e.name == name for e in stack):
                while stack[-1].name != name:
                    stack.pop()
                yield f"/{stack.pop().path}", None
            continue
        for other in _CLOSES.get(name, ()):
            if stack[-1].name == other:
                stack.pop()
        if name in BLOCK and stack[-1].name == "p":
            stack.pop()
        new = _opened(name, attributes, stack[-1])
        yield new.path, None
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        stack.append(new)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if name == "textarea" and not new.unseen:
                said(page[at : end.start() if end else n])
            at = end.start() if end else n
    said(page[at:])
    for r in ready:
        if text := r.text():
            yield f"{r.path}#{text}", r
    yield from ended()


def _mark(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token) - (1 << 63)


def _occurrences(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page, html) -> (page, token, times, first place), one row per page and distinct token."""
    for batch in frames:
        rows: list[tuple[str, int, int, int]] = []
        for host, key, page in zip(*(batch.column(k).to_pylist() for k in range(3))):
            first: dict[int, int] = {}
            times: Counter[int] = Counter()
            for place, (token, _) in enumerate(tokens(page or "")):
                mark = _mark(token)
                first.setdefault(mark, place)
                times[mark] += 1
            rows += [(host, key, mark, times[mark]) for mark in first]
            if len(rows) > 50_000:
                yield _rows(rows)
                rows = []
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "page", "token", "times"])


def host_templates(pages: DataFrame, support: float = SUPPORT, fewest: int = FEWEST, size: int = SIZE) -> DataFrame:
    """(host, page key, html) -> one row per host with `template`: its tokens with their class, an odd
    number if the class is on nearly all pages."""
    seen = pages.mapInArrow(_occurrences, "host string, page bigint, token bigint, times bigint")
    one = F.xxhash64("page", "times").cast("decimal(20,0)")
    vectors = seen.groupBy("host", "token").agg(F.count("*").alias("pages"), F.sum(one).alias("vector"))
    total = pages.groupBy("host").agg(F.count("*").alias("total"))
    frequent = vectors.join(total, "host").filter(
        (F.col("pages") >= fewest) & (F.col("pages") >= support * F.col("total")))
    classes = frequent.groupBy("host", "pages", "vector", "total").agg(
        F.collect_list("token").alias("members")).filter(F.size("members") >= size)
    member = F.explode("members").alias("token")
    everywhere = (F.col("pages") >= EVERYWHERE * F.col("total")).cast("bigint")
    name = F.xxhash64("pages", "vector").bitwiseAND(F.lit(-2)).bitwiseOR(everywhere)
    marked = classes.select("host", name.alias("class"), member)
    return marked.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("template"))


def _template_places(marks: list[int], template: dict[int, int]) -> set[int]:
    """Places of the tokens whose classes are valid on this page.

    A class is valid if its tokens come in one order, again and again, and if it nests: each of its
    occurrences lies within one slot of another class or holds whole occurrences of it. Of two that
    cross, the one with more tokens stays."""
    places: dict[int, list[int]] = {}
    for place, mark in enumerate(marks):
        if mark in template:
            places.setdefault(template[mark], []).append(place)
    ordered = []
    for name, at in places.items():
        size = len({marks[p] for p in at})
        turns = [[marks[p] for p in at[k : k + size]] for k in range(0, len(at), size)]
        if all(turn == turns[0] for turn in turns):
            ordered.append((size, name, at))
    kept: list[tuple[int, list[int]]] = []
    for size, _, at in sorted(ordered, key=lambda c: (-c[0], c[2][0])):
        if all(_nests(at, size, other, n) and _nests(other, n, at, size) for n, other in kept):
            kept.append((size, at))
    return {p for _, at in kept for p in at}


def _nests(at: list[int], size: int, other: list[int], n: int) -> bool:
    """No occurrence of one class holds a part of an occurrence of the other without being in a
    single slot of it."""
    for k in range(0, len(at), size):
        lo, hi = bisect_left(other, at[k]), bisect_left(other, at[k + size - 1])
        if hi > lo and (lo % n or hi % n) and lo // n != (hi - 1) // n:
            return False
    return True


def _said(token: str, run: Run) -> str:
    """The text of a run, which its token ends with."""
    return token[len(run.path) + 1 :]


def page_text(page: str, template: dict[int, int]) -> str:
    """The kept blocks of a page, with an empty line between two."""
    read = list(tokens(page))
    marks = [_mark(token) for token, _ in read]
    fixed = _template_places(marks, template)
    differing = [(token, run) for place, (token, run) in enumerate(read)
                 if run is not None and not run.furniture and place not in fixed]
    # A name is a weak sign: without an article, it does not outweigh most of the text that differs.
    own = sum(len(_said(token, run)) - run.linked for token, run in differing if run.named)
    rest = own and sum(len(_said(token, run)) - run.linked for token, run in differing if not run.named)
    outweighed = own > rest and not any(run.main for _, run in differing)
    varying = {run.path for _, run in differing if run.main and not run.named}
    main: list[str] = []
    anywhere: list[str] = []
    slot: list[tuple[Run, str]] = []

    def stays(place: int, run: Run) -> bool:
        if run.furniture or (run.named and not outweighed):
            return False
        if place not in fixed:
            return True
        # if no text of the article differs, it cannot be told from the template
        return run.main and (not varying or run.path in varying or template[marks[place]] % 2 == 0)

    def close() -> None:
        words = sum(len(text) for _, text in slot)
        links = sum(run.linked for run, _ in slot)
        for run, text in slot:
            if run.main or links * 2 <= words:
                anywhere.append(text)
                if run.main:
                    main.append(text)
        slot.clear()

    for place, (token, run) in enumerate(read):
        if run is None:
            if place in fixed:
                close()
        elif stays(place, run):
            slot.append((run, _said(token, run)))
    close()
    within = sum(map(len, main))
    beside = sum(map(len, anywhere)) - within
    return "\n\n".join(main if beside <= BESIDE * within else anywhere)


def _extracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = []
        for page, template in zip(frame["html"], frame["template"]):
            marks = {} if template is None else {m["token"]: m["class"] for m in template}
            texts.append(page_text(page or "", marks))
        yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts,
                            "n_chars": [len(x) for x in texts]})


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points).

    Character references are decoded, white space inside a block is one space, blocks are joined in
    page order by an empty line. A null or empty page has an empty text. Pages without a host (a
    null url, or one without `://`) share one template of their own. Repeated pages get the same
    text. Other columns of pages are not read. No rows give no rows.
    """
    own = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    ).withColumn("host", F.lower(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit(""))))
    own = own.withColumn("page", F.xxhash64("page_id", "url", "html"))
    templates = host_templates(own.select("host", "page", "html"), **options)
    large = _large_hosts(own)
    known = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
    parts = F.coalesce(F.element_at(known, F.col("host")), F.lit(1)) if large else F.lit(1)
    own = own.withColumn("part", F.pmod("page", parts).cast("int"))
    templates = templates.withColumn("part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    joined = own.join(templates, ["host", "part"], "left").select("page_id", "url", "html", "template")
    return joined.mapInPandas(_extracted, "page_id bigint, url string, text string, n_chars bigint")


def _large_hosts(pages: DataFrame) -> dict[str, int]:
    """Hosts with more than a two-hundredth of all pages, and of a task's, and the parts that their pages
    are cut into: at most 200 hosts, whatever the table."""
    counts = pages.groupBy("host").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    large = counts.filter(F.col("n") > max(PART, total // 200)).collect()
    return {r["host"]: -(-r["n"] // PART) for r in large}
