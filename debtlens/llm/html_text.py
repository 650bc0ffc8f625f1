"""Main text of web pages by tag-path ratios.

A page becomes its text blocks in page order, each with its path of open elements from the root.
Per path, over the whole page: blocks, characters outside links and punctuation. Two ratios,
characters and punctuation per block, are smoothed over the paths in the order they first appear and fused into
one weight by a product with the share of text that is not a link's; running prose is high in all, link lists in none. Structure enters
as a bounded prior: paths below elements that name themselves as other than content (``nav``, a class
``ad``, ...) lose nearly all of their weight, and where a page marks its article, paths inside count
``INSIDE`` times as much and paths outside ``ASIDE`` times. Content are the paths whose weight then
reaches ``THRESHOLD`` of the heaviest without it: so the ratios decide on either side, a path inside may
be too light (a list of links, a row of buttons), and one outside stays if none is heavier.

A name doesn't count on an element that holds over half of the page's text outside links, unless an
article is marked elsewhere, nor on the page's ``main`` or outermost ``article``. Where all of these are below names, they are not below
them: what surrounds an article is a frame. Only what is never shown as text has no blocks.

Defined results. Null and empty pages, and pages without content, give the empty string. In a
block white space becomes one space, at its ends none; blocks are joined by line feeds; ``br``
is white space. Elements left open are closed by what can't stand inside them, an end tag closes
what is open inside its element, and one without an open element is ignored. Only page_id, url
and html are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm.ship import ship

THRESHOLD = 0.1
#: What is left of the weight of a path below a name.
NAMED = 0.005
#: Where a page marks its article: what the weights of paths inside and outside are multiplied by.
INSIDE, ASIDE = 4.0, 0.1
#: Weights of a path's neighbours in smoothing, a bell over two on either side.
BELL = np.array([0.06, 0.24, 0.4, 0.24, 0.06])

# Fixed values of the HTML standard: elements without end tags, elements whose content is not
# markup, and elements that start a block of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes plaintext script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: What an opening element closes: the first of these that is open, up to one of the limits.
CLOSES = (
    ({"li"}, {"li"}, {"ul", "ol", "menu"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
    ({"td", "th"}, {"td", "th"}, {"table"}),
    ({"tr"}, {"tr"}, {"table"}),
    ({"thead", "tbody", "tfoot"}, {"thead", "tbody", "tfoot"}, {"table"}),
    ({"option", "optgroup"}, {"option"}, {"select"}),
    ({"body"}, {"head"}, set()),
)
CLOSING = {tag: (closed, limit) for tags, closed, limit in CLOSES for tag in tags}
#: A paragraph ends where a block starts, unless the block is inside one of these.
P_LIMIT = {"button", "caption", "object", "table", "td", "th"}

#: Elements that are other than content, and those that are not even shown as text.
OTHER = frozenset("aside dialog fieldset footer form header menu nav search".split())
UNSEEN = frozenset("button datalist head noscript object select svg template".split()) | RAW
CONTENT = frozenset(["article", "main"])
#: Words in class, id or role that mark other than content.
NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary "
    "contentinfo cookie cookies consent disclaimer disqus footer form header login masthead menu modal "
    "nav navbar navigation newsletter notice notices pagination popup promo promoted promotion "
    "recommended related replies reply search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?|<[!?][^>]*+>?",
    re.S,
)
_NAMED = re.compile(r"(?:^|[\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _other(name: str, rest: str) -> bool:
    """Whether an element says that it holds other than content."""
    if name in OTHER:
        return True
    if "=" not in rest or name in ("html", "body"):
        return False
    for values in _NAMED.findall(rest):
        for word in _WORD.findall(_HUMP.sub(" ", "".join(values))):
            if word.lower() in NAMES:
                return True
    return False


#: Path, whether inside an article, and whether below a name that counts.
Path = tuple[tuple[str, ...], bool, bool]
#: Text, path, and the share of the text that is not a link's.
Block = tuple[str, Path, float]


def blocks(page: str) -> list[Block]:
    """Every non-empty block that is shown."""
    found: list[tuple[str, tuple[str, ...], int, float]] = []
    names: list[str] = []
    unseen: list[bool] = []  # per open element: it or one above it is not shown
    frames: list[int] = []  # per open element: the innermost frame it is in
    every = Frames()
    parts: list[str] = []
    links = 0  # open links
    plain: list[int] = []  # of every part: its length, 0 in a link

    def flush() -> None:
        if parts:
            share = sum(plain) / max(1, sum(map(len, parts)))
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            plain.clear()
            if text and not (unseen and unseen[-1]):
                path = tuple(n for n in names if n in BLOCK)
                found.append((text, path, frames[-1] if frames else 0, share))

    def close(depth: int) -> None:
        nonlocal links
        outer = frames[depth - 1] if depth else 0
        if any(n in BLOCK for n in names[depth:]) or (unseen and unseen[-1]) or frames[-1] != outer:
            flush()
        links -= names[depth:].count("a")
        del names[depth:], unseen[depth:], frames[depth:]

    at, n = 0, len(page)
    while at < n:
        hit = _TAG.search(page, at)
        text = page[at : hit.start()] if hit else page[at:]
        if text and not (unseen and unseen[-1]):
            parts.append(text)
            plain.append(0 if links else len(text))
        if not hit:
            break
        at = hit.end()
        name = hit["name"]
        if not name:
            continue
        name = name.lower()
        if hit["end"]:
            if name in names:
                close(len(names) - 1 - names[::-1].index(name))
            elif name in BLOCK:
                flush()
            continue
        if name == "br":
            parts.append(" ")
            plain.append(0)
            continue
        if name in BLOCK:
            for k in range(len(names) - 1, -1, -1):
                if names[k] == "p":
                    close(k)
                    break
                if names[k] in P_LIMIT:
                    break
            flush()
        if name in CLOSING:
            closed, limit = CLOSING[name]
            for k in range(len(names) - 1, -1, -1):
                if names[k] in closed:
                    close(k)
                    break
                if names[k] in limit:
                    break
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else n
        frame = frames[-1] if frames else 0
        hidden = name in UNSEEN
        named = not hidden and _other(name, hit["rest"])
        if hidden or named:
            flush()
        if named or name in CONTENT:
            frame = every.add(frame, name, named)
        names.append(name)
        links += name == "a"
        unseen.append(hidden or bool(unseen and unseen[-1]))
        frames.append(frame)
    flush()
    held = [0.0] * len(every.above)
    for text, _, frame, plain in found:
        held[frame] += plain * len(text)
    below = every.below_names(held)
    return [(text, (path, every.article[frame], below[frame]), plain) for text, path, frame, plain in found]


class Frames:
    """The elements of a page that are an article's or have a name; number 0 is the page."""

    def __init__(self):
        self.above, self.tags, self.named, self.article = [0], [""], [False], [False]

    def add(self, above: int, tag: str, named: bool) -> int:
        self.above.append(above)
        self.tags.append(tag)
        self.named.append(named)
        self.article.append(tag in CONTENT or self.article[above])
        return len(self.above) - 1

    def below_names(self, held: list[float]) -> list[bool]:
        """Per frame, whether it is below a name that counts; ``held`` is the plain text of its own."""
        held, n = held.copy(), len(held)
        for k in range(n - 1, 0, -1):
            held[self.above[k]] += held[k]
        outermost = [tag in CONTENT and (tag == "main" or not self.article[a]) for tag, a in zip(self.tags, self.above)]
        articles = [k for k in range(n) if outermost[k] and held[k]]
        articles = [k for k in articles if self.tags[k] == "main"] or articles
        # An element with most of the text may hold the article; not if that is marked elsewhere.
        around = set(range(n)) if not articles else set()
        for k in articles:
            while k not in around:
                around.add(k)
                k = self.above[k]
        large = [k in around and 2 * held[k] > held[0] for k in range(n)]
        counts = [self.named[k] and not outermost[k] and not large[k] for k in range(n)]

        def down(free: set[int]) -> list[bool]:
            out = [False] * n
            for k in range(1, n):
                out[k] = counts[k] or (out[self.above[k]] and k not in free)
            return out

        below = down(set())
        return down(set(articles)) if all(below[k] for k in articles) else below


def _weights(paths: dict[Path, list[float]]) -> np.ndarray:
    n, chars, marks, length = np.array(list(paths.values()), float).reshape(-1, 4).T
    # Log ratios: one very long block is not to hide the others.
    ratios = [np.log1p(chars / n), np.log1p(marks / n)]
    # Each path counts by its own value or its neighbourhood's, so prose split by tags is kept.
    smooth = [np.maximum(r, np.convolve(np.pad(r, 2), BELL, "valid")) for r in ratios]
    # What is nearly all links is no prose, whatever is next to it.
    return smooth[0] * (0.1 + smooth[1]) * (chars / length)


def content_paths(found: list[Block]) -> set[Path]:
    """The paths whose weight is high enough."""
    clear: dict[Path, list[float]] = {}
    below: dict[Path, list[float]] = {}  # names: no neighbours of the others
    for text, path, plain in found:
        held = (below if path[2] else clear).setdefault(path, [0, 0, 0, 0])
        held[0] += 1
        held[1] += plain * len(text)
        held[2] += plain * len(_PUNCTUATION.findall(text))
        held[3] += len(text)
    weights: dict[Path, float] = {}
    for paths, share in ((clear, 1.0), (below, NAMED)):
        if paths:
            weights.update(zip(paths, share * _weights(paths)))
    least = THRESHOLD * max(weights.values(), default=0)
    if any(article for _, article, _ in weights):
        weights = {p: w * (INSIDE if p[1] else ASIDE) for p, w in weights.items()}
    return {p for p, w in weights.items() if w >= least}


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    content = content_paths(found)
    return "\n".join(text for text, path, _ in found if path in content)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p.as_py()) for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
