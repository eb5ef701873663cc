"""HTML extraction by the maximum-scoring subsequence.

1. One linear pass turns a page into a sequence of tags and runs of words. What the contract excludes by
   structure (menus, headers, footers, asides, forms, hidden parts, told by element names and roles) is not in
   the sequence; scripts, styles and comments of the markup are not even read.
2. Words score by the elements around them: a base weight and the weights of element names and of class and id
   words, naive Bayes log odds of standing inside the article. Tags score negative. The weights are counted on
   labelled pages (a bounded sample of those that mark their article with <article> or <main>; the marks
   themselves are no feature), with `PRIOR` counts for names that the sample may lack.
3. One linear scan finds the contiguous region with the highest sum. Its blocks are the result, without those
   whose own words score negative (adverts, notices or comments in the midst of the article).

Character references are decoded; white space inside a block becomes one space; blocks are joined in
page order by one line feed. Nothing else is dropped or capped. Parsing takes time in proportion to the page,
whatever its markup.

Defined cases: null or empty html, and pages without a word that scores positive, give the empty text;
repeated rows are extracted alike; broken markup is read as it stands (unclosed elements end with their parent, an
unclosed quote ends with its tag, a "<" that begins no tag is text); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import smallest

MAX_LABELLED = 400
#: Bytes of html of the labelled pages, at most; larger pages than `MAX_PAGE` are no labelled ones.
MAX_PAGE = 1 << 18
#: Words counted for the article and against it before any page is seen, for each listed name.
PRIOR = 40.0
#: Weight of a word about which nothing is known.
BASE = 0.5
#: Bounds of the weight of one feature, of a word and of a tag.
FEATURE, WORD, TAG = (-4.0, 4.0), (-1.5, 1.5), (-2.0, -0.2)
#: Tags whose quotes may be open to the end of the page; from then on a tag ends with the first ">".
OPEN_QUOTES = 50

_words = lambda s: frozenset(s.split())
#: Element names and words of classes, ids and roles.
RAW = _words("script style title textarea noscript template iframe noembed noframes xmp")
VOID = _words("area base br col embed hr img input link meta param source track wbr")
CONTAINERS = _words("html body main article section div nav header footer aside form ul ol dl table thead tbody tfoot tr td th blockquote figure details dialog menu fieldset button select svg object address center hgroup search")
BLOCKS = CONTAINERS | _words("p h1 h2 h3 h4 h5 h6 li dt dd pre hr figcaption summary caption legend option optgroup")
BOILERPLATE = _words("nav header footer aside form button select menu dialog fieldset svg object head search")
ARTICLE = _words("article main")
ROLES = _words("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar")
NAMES = _words(
    "ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright"
    " dialog disqus footer footnav gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager"
    " pagination popup privacy promo promotion recommended related replies reply responses share sharing sidebar signup skip social sponsor sponsored"
    " sponsors subscribe subscription tagcloud teaser teasers toolbar tooltip topbar trending widget widgets"
)
NOT_NAMES = _words("has with no without")
#: Elements that hold the text of articles.
TEXT = _words("p h1 h2 h3 h4 blockquote pre figcaption")
#: Elements that say nothing about what they hold.
GENERIC = _words("html body main article section div span center table tbody thead tfoot tr td font")
_NAME = re.compile(r"[a-zA-Z][^\s/><\"'=]*+")
_REST = re.compile(r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_PART = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*+:\s*+none")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


def _features(name: str, attributes: str) -> tuple[bool, list[str]]:
    """Whether an element is left out for its structure, and its features."""
    skip, found = name in BOILERPLATE, [] if name in GENERIC else [name]
    if "=" not in attributes and "hidden" not in attributes:
        return skip, found
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id") and name not in ("html", "body", "main"):
            for word in value.split():
                parts = _PART.findall(word)
                if not NOT_NAMES.intersection(parts):
                    found += [f".{part}" for part in parts]
        elif key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
            skip = True
    return skip, found


class Page:
    """events: (words, tag, block, element), words being 0 for a tag; blocks: text; elements by number: parent, name,
    features, and whether it is left out for its structure."""

    def __init__(self, source: str):
        self.events: list[tuple[int, str, int, int]] = []
        self.blocks: list[str] = []
        self.parents, self.names, self.features, self.skipped = [0], [""], [[]], [False]
        self._open, self._count, self._text, self._link, self._failed, self._next = [0], Counter(), [], False, 0, -1
        at, size = 0, len(source)
        while at < size:
            start = source.find("<", at)
            if start < 0:
                break
            self._data(source[at:start])
            at = self._markup(source, start)
        self._data(source[at:])
        self._flush()

    def _markup(self, source: str, at: int) -> int:
        """Read what begins with the "<" at `at`; where to go on."""

        def after(mark: str, begin: int) -> int:
            end = source.find(mark, begin)
            return len(source) if end < 0 else end + len(mark)

        if source.startswith("<!--", at):
            return after("-->", at + 4)
        if source.startswith("<![CDATA[", at):
            end = after("]]>", at + 9)
            self._data(entities.escape(source[at + 9 : end].removesuffix("]]>"), quote=False))
            return end
        if source.startswith(("<!", "<?"), at):
            return after(">", at + 2)
        closing = source.startswith("</", at)
        named = _NAME.match(source, at + 1 + closing)
        if not named:
            self._data("<")
            return at + 1
        name, rest = named[0].lower(), None
        if self._failed < OPEN_QUOTES:
            rest = _REST.match(source, named.end())
            self._failed += rest is None
        if rest:
            end = rest.end()
        else:
            if self._next < named.end():  # the next ">", looked for once
                self._next = after(">", named.end()) - 1
            end = self._next + 1
            if self._next >= len(source) - 1 and source[-1] != ">" or 0 <= source.find("<", named.end()) < end:  # no tag at all
                self._data("<")
                return at + 1
        if name in RAW and not closing:
            found = _ENDS[name].search(source, end)
            return after(">", found.end()) if found else len(source)
        self._tag(name, closing, source[named.end() : end - 1])
        return end

    def _data(self, raw: str) -> None:
        if raw:
            self._text.append(raw)
            n = len(raw.split())
            if n:
                self.events.append((n, "a" if self._link else "", len(self.blocks), self._open[-1]))

    def _flush(self) -> None:
        self.blocks.append(" ".join(entities.unescape("".join(self._text)).split()))
        self._text = []

    def _tag(self, name: str, closing: bool, attributes: str) -> None:
        if name in BLOCKS:
            self._flush()
            self._link = False
        elif name == "br":
            self._text.append(" ")
        elif name == "a":
            self._link = not closing
        self.events.append((0, f"{'/' if closing else ''}{name}", len(self.blocks), self._open[-1]))
        if name not in BLOCKS or name in VOID:
            return
        if closing:
            while self._count[name] and self._pop() != name:
                pass
            return
        skip, features = _features(name, attributes)
        if name == "svg" and attributes.rstrip().endswith("/"):
            return
        while len(self._open) > 1 and self.names[self._open[-1]] not in CONTAINERS:
            self._pop()  # a block that holds text ends where the next one begins
        parent = self._open[-1]
        self.parents.append(parent)
        self.names.append(name)
        self.features.append(features)
        self.skipped.append(self.skipped[parent] or skip)
        self._open.append(len(self.names) - 1)
        self._count[name] += 1

    def _pop(self) -> str:
        name = self.names[self._open.pop()]
        self._count[name] -= 1
        return name

    def marked(self) -> list[bool] | None:
        """Of each element, whether it is in the one that the page marks as its article (that with most words)."""
        words = [0] * len(self.names)
        for n, _, _, element in self.events:
            if n and not self.skipped[element]:
                words[element] += n
        for element in range(len(words) - 1, 0, -1):
            words[self.parents[element]] += words[element]
        best = max((e for e, name in enumerate(self.names) if name in ARTICLE and words[e]), key=lambda e: (words[e], e), default=None)
        if best is None:
            return None
        inside = [False] * len(words)
        for element in range(best, len(words)):
            inside[element] = element == best or inside[self.parents[element]]
        return inside


def learn(sources: list[str]) -> dict[str, float]:
    """Weights of features (names of elements, class and id words, "a" for words of links), of tags (as "<p",
    "</p") and the base weight of a word ("")."""
    counts: tuple[Counter, Counter] = Counter(), Counter()  # outside, inside
    for feature in [f".{x}" for x in NAMES] + ["a"]:
        counts[0][feature] += PRIOR
    for feature in TEXT:
        counts[1][feature] += PRIOR
    for source in sources:
        page = Page(source)
        inside = page.marked()
        if inside is None:
            continue
        words = [[0, 0] for _ in page.names]
        for n, tag, _, element in page.events:
            if page.skipped[element]:
                continue
            if n:
                words[element][inside[element]] += n
                counts[inside[element]]["a"] += n if tag else 0
            else:
                counts[inside[element]]["<" + tag] += 1
        for element in range(len(words) - 1, 0, -1):
            for k in (0, 1):
                for feature in page.features[element]:
                    counts[k][feature] += words[element][k]
                words[page.parents[element]][k] += words[element][k]
        for k in (0, 1):
            counts[k][""] += words[0][k]
    base = math.log((counts[1][""] + 1) / (counts[0][""] + 1))
    weights = {"": BASE}
    for feature in sorted({*counts[0], *counts[1]} - {""}):
        odds = math.log((counts[1][feature] + 1) / (counts[0][feature] + 1))
        low, high = TAG if feature.startswith("<") else FEATURE
        seen = counts[0][feature] + counts[1][feature] > PRIOR
        weights[feature] = min(max(odds - max(base, 0.0) * seen, low), high)
    return weights


def scores(page: Page, weights: dict[str, float]) -> list[float]:
    """The score of each event."""
    around = [weights.get("", BASE)] * len(page.names)
    for element in range(1, len(around)):
        around[element] = around[page.parents[element]] + sum(weights.get(f, 0.0) for f in page.features[element])
    out = []
    for n, tag, _, element in page.events:
        if page.skipped[element]:
            out.append(0.0)
        elif n:
            out.append(n * min(max(around[element] + (weights.get(tag, 0.0) if tag else 0.0), WORD[0]), WORD[1]))
        else:
            out.append(weights.get("<" + tag, TAG[1]))
    return out


def region(values: list[float]) -> tuple[int, int]:
    """First and last place of the maximum-scoring subsequence, in one scan; the first and shortest of equal ones."""
    best, span, total, start = 0.0, (0, -1), 0.0, 0
    for i, score in enumerate(values):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, span = total, (start, i)
    return span


def extract(source: str | None, weights: dict[str, float]) -> str:
    page = Page(source or "")
    values = scores(page, weights)
    first, last = region(values)
    if last < first:
        return ""
    own: Counter = Counter()  # of each block, the score of its words
    for (n, _, block, element), value in zip(page.events, values, strict=True):
        if n and not page.skipped[element]:
            own[block] += value
    return "\n".join(page.blocks[k] for k in range(page.events[first][2], page.events[last][2] + 1) if own[k] > 0 and page.blocks[k])


def labelled(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> list[str]:
    """Up to `max_labelled` pages of at most `MAX_PAGE` bytes that mark their article, those with the smallest hashes of
    their html."""
    marked = pages.where(F.octet_length("html") <= MAX_PAGE).where(F.lower("html").rlike("<(article|main)[\\s>]")).select("html")
    return sorted({r["html"] for r in smallest(marked, F.xxhash64("html"), max_labelled).collect()})


def extract_pages(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html)."""
    weights = learn(labelled(pages, max_labelled))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), weights) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(scan, "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
