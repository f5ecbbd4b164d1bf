"""Main text of web pages: the best-scoring run of words and tags."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.llm.common import pick, sampled, slices, texts_of

# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noframes noembed".split())
UNSHOWN = frozenset("head script style title noscript template iframe svg math canvas object audio video select option datalist button textarea dialog map".split())
BESIDE = frozenset("nav aside footer menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
# Words that whole names in class, id, role or itemprop consist of where they mark what stands beside an article.
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pagination pager "
    "popup promo promoted promotion related reply replies share sharing sidebar skyscraper social sponsor sponsored subscribe "
    "tags toolbar widget complementary contentinfo search alert".split()
)
MAIN = frozenset(["article", "main"])
# Words in class, id or role of an element whose header belongs to the text.
MAIN_WORDS = frozenset(["main", "article", "articlebody"])
# A mark of the main element counts if it holds this share of the page's words that are not dropped.
LEAST_SHARE = 0.25
# Words beside these in a name that only say how an element is laid out, and those that say that a page has something or not.
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box bottombar col column container content element feed frame group holder inner item left "
    "list main mid page panel post reader right row section slot thread top unit user visitor wrap wrapper zone".split()
)
# What readers write, however much it is.
READER_WORDS = frozenset("comment comments disqus reply replies".split())
# An element is not dropped for its names if it holds half of the page's words; one with the words of readers, if hardly one would be left.
LARGE_SHARE, READER_SHARE = 0.5, 0.95

# Quotes enclose a value only behind an equals sign.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]+|=)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAMES = frozenset(["class", "id", "role", "itemprop"])
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NAME = re.compile(r"[a-zA-Z]+")


@dataclass
class Item:
    """A tag (no text) or the words between two tags, with where they stand."""

    kind: str
    words: int = 0
    text: str = ""
    block: int = 0
    dropped: bool = False
    main: str = "none"


@dataclass
class _Open:
    name: str
    aside: bool
    main: bool
    hidden: bool = False
    span: Span | None = None
    # Kind of the words inside: the nearest block, and whether they belong to a link.
    block: str = "none"
    link: str = ""


@dataclass
class Span:
    """Items of an element: from ``start`` up to ``end``, or to the page's end."""

    start: int
    # Whether the element marks the main text, and whether its names say that it stands beside the text.
    main: bool
    beside: bool
    # It is not dropped with this share of the page's words.
    kept_from: float = LARGE_SHARE
    end: int | None = None


@dataclass
class Page:
    items: list[Item] = field(default_factory=list)
    has_main: bool = False
    # Share of the words that are not dropped inside the main element.
    share: float = 0.0


def _attributes(text: str) -> list[tuple[str, str]]:
    """Names in lower case and values without their quotes."""
    found = []
    for name, value in _ATTRIBUTE.findall(text):
        quoted = len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]
        found.append((name.lower(), value[1:-1] if quoted else value))
    return found


def _marks_main(name: str, attributes: list[tuple[str, str]]) -> bool:
    """Whether an element says that it is the page's main one: by its name, or by the whole role or property."""
    if name in MAIN:
        return True
    return any((key, value.strip().lower()) in (("role", "main"), ("itemprop", "articlebody")) for key, value in attributes)


def _named_beside(name: str, attributes: list[tuple[str, str]]) -> float:
    """If one whole name of an element says that it stands beside the text, the share of the page up to which that holds; else 0.

    All its words do, or are about the layout: ``comment-list`` and ``ad-slot``, but neither
    ``has-comments`` nor ``tag-cookies``.
    """
    if name in ("html", "body"):
        return 0.0
    share = 0.0
    for key, value in attributes:
        for each in value.split() if key in _NAMES else ():
            said = [word.lower() for word in _NAME.findall(each)]
            beside = [word in BESIDE_WORDS or word + "s" in BESIDE_WORDS for word in said]
            if any(beside) and all(b or word in LAYOUT_WORDS for b, word in zip(beside, said, strict=True)):
                # What follows a label of the page itself is its subject.
                if len(said) < 2 or said[0] not in ("tag", "tags", "post", "page"):
                    share = max(share, LARGE_SHARE if READER_WORDS.isdisjoint(said) else READER_SHARE)
    return share


def _hidden(name: str, attributes: list[tuple[str, str]]) -> bool:
    """Whether an element is not shown."""
    return name in UNSHOWN or any(
        key == "hidden"
        or (key == "aria-hidden" and value.strip().lower() == "true")
        or (key == "style" and _NOT_SHOWN.search(value) is not None)
        for key, value in attributes
    )


def _role(name: str, attributes: list[tuple[str, str]]) -> tuple[bool, bool, bool]:
    """Whether an element stands beside the text, may have a header that belongs to it, or is not shown."""
    said: set[str] = set()
    for key, value in attributes:
        if key in _NAMES:
            said.update(word.lower() for word in _NAME.findall(value))
    main = name in MAIN or (name not in ("html", "body") and bool(said & MAIN_WORDS))
    return name in BESIDE, main, _hidden(name, attributes)


def read_page(source: str) -> Page:
    """Tags and words of a page in order. Faulty nesting is taken as browsers do, roughly."""
    page, stack, block, place = Page(), [], 0, 0
    spans: list[Span] = []
    open_names: Counter[str] = Counter()
    aside = main = hidden = 0
    end = len(source)

    def push(name: str, attributes: list[tuple[str, str]]) -> None:
        nonlocal aside, main, hidden
        is_aside, is_main, is_hidden = _role(name, attributes)
        if name == "header":
            is_aside = not main
        span = None
        if not (is_aside or aside):
            marks, share = _marks_main(name, attributes), 0.0 if name == "header" else _named_beside(name, attributes)
            if name == "form":
                share = max(share, LARGE_SHARE)
            if marks or share:
                spans.append(span := Span(len(page.items), marks, share > 0, LARGE_SHARE if marks else share))
        around = stack[-1] if stack else None
        if name in BLOCKS:
            nearest, link = name, ""
        else:
            nearest, link = (around.block, around.link) if around else ("none", "")
            link = "link-" if name == "a" else link
        stack.append(_Open(name, is_aside, is_main, is_hidden, span, nearest, link))
        open_names[name] += 1
        aside, main, hidden = aside + is_aside, main + is_main, hidden + is_hidden

    def pop() -> _Open:
        nonlocal aside, main, hidden
        top = stack.pop()
        open_names[top.name] -= 1
        if top.span:
            top.span.end = len(page.items)
        aside, main, hidden = aside - top.aside, main - top.main, hidden - top.hidden
        return top

    def words(start: int, stop: int) -> None:
        if start < stop and (text := html.unescape(source[start:stop])):
            count = len(text.split())
            kind = "words:" + ("aside" if aside else "hidden" if hidden else stack[-1].link + stack[-1].block if stack else "none")
            page.items.append(Item(kind, count, text, block, bool(aside or hidden)))

    while place < end:
        opening = source.find("<", place)
        match = _TOKEN.match(source, opening) if opening >= 0 else None
        if opening >= 0 and match is None:
            # A lone "<" is text.
            following = source.find("<", opening + 1)
            stop = following if following >= 0 else end
            words(place, stop)
            place = stop
            continue
        words(place, opening if opening >= 0 else end)
        if opening < 0:
            break
        place = match.end()
        if match[2] is None:
            continue
        name = match[2].lower()
        block += name in BLOCKS
        if match[1]:
            if open_names[name]:
                while pop().name != name:
                    pass
        elif name in RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(source, place)
            place = closing.start() if closing else end
            after = source.find(">", place)
            place = after + 1 if closing and after >= 0 else end
        elif name not in VOID:
            if name in BLOCKS:
                while stack and stack[-1].name in ("p", "b", "i", "em", "strong", "span", "a", "font", "u", "small"):
                    if not open_names["p"]:
                        break
                    pop()
            if name == "li" and stack and stack[-1].name == "li":
                pop()
            push(name, _attributes(match[3]) if match[3] else [])
            if match[3] and match[3].endswith("/"):
                pop()
        if name in VOID:
            space = " " if name == "br" else ""
            page.items.append(Item("tag:" + name, 0, space, block, bool(aside or hidden)))
        elif name not in RAW:
            page.items.append(Item(("end:" if match[1] else "tag:") + name))
    for span in spans:
        if span.end is None:
            span.end = len(page.items)
    _drop_beside(page, spans)
    _place_main(page, [span for span in spans if span.main])
    return page


def _shown(page: Page) -> list[int]:
    """Words that are not dropped before each item, and in all."""
    return [0, *accumulate(0 if item.dropped else item.words for item in page.items)]


def _drop_beside(page: Page, spans: Sequence[Span]) -> None:
    """Drops forms and elements that are named as beside the text, unless they hold the main element or too much of the page."""
    up_to = _shown(page)
    # In order, as spans are.
    mains = [span.start for span in spans if span.main and not span.beside]
    last = 0
    for span in spans:
        if not span.beside or span.end <= last or up_to[span.end] - up_to[span.start] >= span.kept_from * max(up_to[-1], 1):
            continue
        place = bisect_left(mains, span.start)
        if place < len(mains) and mains[place] < span.end:
            continue
        last = span.end
        for item in page.items[span.start : span.end]:
            if item.kind.startswith("words:"):
                item.kind, item.dropped = "words:aside", True
            else:
                item.dropped = True


def _place_main(page: Page, marks: Sequence[Span]) -> None:
    """Tells items inside of the marks that hold enough of the page's words from those outside."""
    items, up_to = page.items, _shown(page)
    inside, total = 0, max(up_to[-1], 1)
    found, last = [], 0
    for mark in marks:
        # Marks inside another one are in its span already.
        if up_to[mark.end] - up_to[mark.start] >= LEAST_SHARE * total and mark.end > last:
            found.append((max(mark.start, last), mark.end))
            last = mark.end
    if not found:
        return
    page.has_main = True
    for item in items:
        item.main = "out"
    for start, end in found:
        inside += up_to[end] - up_to[start]
        for item in items[start:end]:
            item.main = "in"
    page.share = inside / total


# Scores

# Scores of kinds that no labelled page shows, and where there are no labelled pages.
WORD_SCORE = 1.0
LINK_SCORE = -0.5
ASIDE_SCORE = -1.0
TAG_SCORE = -0.3
STEADY = 5.0
MOST_KINDS = 2_000


def default_score(kind: str) -> float:
    if kind.startswith("words:"):
        own = kind.partition(":")[2]
        return ASIDE_SCORE if own in ("aside", "hidden") else LINK_SCORE if own.startswith("link-") else WORD_SCORE
    return TAG_SCORE


def counts_of(source: str) -> Counter:
    """(kind, inside the main element) -> words or tags, for a page that marks its main element; else nothing."""
    page, found = read_page(source), Counter()
    if page.has_main:
        for item in page.items:
            found[item.kind, item.main == "in" and not item.dropped] += max(item.words, 1)
    return found


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Scores per kind from labelled counts: the log odds of standing inside, within bounds.

    Words score at least as their default's sign says if they are ordinary ones;
    tags always score below zero, the more so the more often they stand outside.
    """
    scores = {}
    for kind in {kind for kind, _ in counts}:
        inside, outside = counts.get((kind, True), 0), counts.get((kind, False), 0)
        odds = math.log((inside + STEADY) / (outside + STEADY))
        if kind.startswith("words:"):
            scores[kind] = min(max(odds / 4, -1.0), 1.0)
        else:
            scores[kind] = -min(max(0.5 - odds / 8, 0.05), 1.0)
    return scores


def _with_bonus(score: float, where: str, share: float) -> float:
    """A word's score inside or outside of a page's main element, which holds a share of the page's words.

    The bonus is as large as the share, so it never exceeds the learned range; outside
    it only lessens a score, so a longer text there still wins.
    """
    if where == "in":
        return score + share
    return score - share * abs(score) if where == "out" else score


def item_scores(page: Page, weights: dict[str, float]) -> list[float]:
    scores = []
    for item in page.items:
        each = weights.get(item.kind)
        if each is None:
            each = default_score(item.kind)
        if item.words:
            if item.dropped:
                # Left out anyway, so it should hardly end a run, and not at all inside the main element.
                scores.append(0.0 if item.main == "in" else max(-1.0, 0.02 * item.words * min(each, -0.5)))
            else:
                scores.append(item.words * _with_bonus(each, item.main, page.share))
        else:
            left_out = item.dropped and item.main == "in"
            scores.append(0.0 if left_out or item.kind.startswith("words:") else each)
    return scores


def best_run(scores: Sequence[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the greatest sum above zero; the first and longest of equals; else (0, 0)."""
    best, best_at, running, start = 0.0, (0, 0), 0.0, 0
    for place, value in enumerate(scores):
        if running < 0:
            running, start = 0.0, place
        running += value
        if running > best or (running == best and best > 0 and start == best_at[0]):
            best, best_at = running, (start, place + 1)
    return best_at


def main_text(source: str, weights: dict[str, float]) -> str:
    """Blocks of the best run, without what is hidden or stands beside the text, with an empty line between."""
    page = read_page(source)
    start, end = best_run(item_scores(page, weights))
    blocks: list[str] = []
    current, parts = None, []
    for item in page.items[start:end]:
        if item.text and not item.dropped:
            if item.block != current:
                blocks.append("".join(parts))
                current, parts = item.block, []
            parts.append(item.text)
    blocks.append("".join(parts))
    joined = (" ".join(block.split()) for block in blocks)
    return "\n\n".join(block for block in joined if block)


# On Spark


def learn(pages: DataFrame, most_pages: int = 2_000) -> dict[str, float]:
    """Scores learned from pages that mark their main element (article or main) themselves.

    About ``most_pages`` pages are used at most, those with the smallest hashes
    of their ids and addresses. Only counts per kind of tag or word come to the
    driver, at most ``MOST_KINDS``, the most frequent first.
    """
    sample = sampled(pick(pages, "page_id", "html", "url"), most_pages, "page_id", "url").select("page_id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for source in texts_of(batch.column(1)):
                total.update(counts_of(source))
        kinds = [kind for kind, _ in total]
        inside = [is_inside for _, is_inside in total]
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array(kinds, pa.string()),
                "inside": pa.array(inside, pa.bool_()),
                "n": pa.array(total.values(), pa.int64()),
            }
        )

    counts = sample.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    frequent = counts.orderBy(F.desc("n"), "kind", "inside").limit(MOST_KINDS).collect()
    return weights_from({(row.kind, row.inside): row.n for row in frequent})


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Main text of the whole sources of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A page is a sequence of words and tags. Words score above zero where labelled
    pages have them inside their main element, and below where they have them
    beside it; tags score below zero. The contiguous run with the greatest sum is
    the content; what is hidden or marked as standing beside the text inside that
    run (menus, notices, adverts, comments and the like) is left out.

    White space inside a block becomes one space, blocks are joined by empty
    lines, in page order. A null source is empty; a page without text gives an
    empty text. Null ids and urls stay null, repeated rows repeat, no rows give no
    rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            found = [main_text(source, weights) for source in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column(0),
                    "url": batch.column(1),
                    "text": pa.array(found, pa.string()),
                    "n_chars": pa.array(map(len, found), pa.int64()),
                }
            )

    return pick(pages, "page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
