"""Main text of web pages: flat text blocks classified by a small decision tree."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import map_batches

# A comment, a declaration, a tag with quoted or bare attributes, or a run of text.
_PART = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][-\w:]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.DOTALL)
_NAMES = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
# A title that is not closed ends at the next tag.
_TITLE_END = re.compile(r"[^<]*(?:</title\s*>)?", re.IGNORECASE)
#: Elements whose content is no markup up to their end tag, those whose content is not shown, and those that are void.
_RAW = {"script", "style", "textarea"}
_HIDDEN = {"noscript", "template", "iframe", "svg", "canvas", "object", "math", "head", "select"}
#: The hidden ones that are read up to their end tag if none of their kind opens before it, and those that keep an outer p or li open.
_SKIPPED = {tag: re.compile(rf"<(/?){tag}(?![-\w:])[^<>]*>", re.IGNORECASE) for tag in ("noscript", "iframe")}
_SCOPE = {"object", "template", "select"}
#: What a head may hold, and the parts of svg and math that may hold HTML.
_IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
_HTML_IN = {"foreignobject", "desc", "annotation-xml", "mi", "mo", "mn", "ms", "mtext"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that end a block.
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that an opening tag of the same kind ends.
_IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SIDE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "address"}
#: Words in class, id or role that name the parts around an article.
_SIDE_NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|breadcrumb\w*|comments?|cookies?|consent|copyright|disqus|footer|gdpr|header|login|masthead|menu|modal"
    r"|nav\w*|newsletter|notice|pagination|popup|promo\w*|recommend\w*|related|repl(?:y|ies)|search|share|sharing|sidebar|signup|social|sponsor\w*"
    r"|subscribe|tags?|teaser|toolbar|widget)(?:$|[^a-z])"
)
#: The same that are never part of an article, whatever they hold: what readers, shops and other pages say.
_HARD = {"nav", "footer", "aside", "menu", "dialog", "button", "address"}
_HARD_NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|breadcrumb\w*|comments?|cookies?|consent|disqus|footer|gdpr|newsletter|pagination|promo\w*"
    r"|recommend\w*|related|repl(?:y|ies)|sponsor\w*|teaser)(?:$|[^a-z])"
)
#: Names that say what a page has or lacks, not what an element is; and the head of an article.
_STATES = re.compile(r"(?<![-\w])(?:has|no|with|without|js|is)-[-\w]+|(?<![-\w])[-\w]+-(?:open|opened|closed|hidden|enabled|disabled|visible)(?![-\w])")
_OWN_HEADER = re.compile(r"(?<![a-z])(?:article|content|entry|page|post|story)[-_]*header(?![a-z])")
#: Elements in which a paragraph or list item ends before another begins.
_CONTAINERS = ("ul", "ol", "dl", "table", "div", "article", "section", "body")
#: A side part with so much of a page's words, and no main part beside it, is a wrapper.
WRAPS, WRAPS_WORDS = 0.6, 40
_MAIN_NAMES = re.compile(r"(?:^|[^a-z])(?:article|content|entry|main|post|story|text)(?:$|[^a-z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "side", "main", "heading")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    side: bool
    main: bool
    heading: bool
    #: Soft side parts that it lies in, by number; empty where ``side`` is settled.
    soft: tuple[int, ...] = ()


def _side(tag: str, attributes: str, in_main: bool) -> tuple[bool, bool, bool]:
    """Whether an element is a side part, one that nothing in it can undo, and a main part."""
    names = " ".join(n.strip("\"'") for n in _NAMES.findall(attributes)).lower() if attributes else ""
    names = _STATES.sub(" ", names)
    if in_main:
        names = _OWN_HEADER.sub(" ", names)
    named = tag not in ("html", "body") and bool(names and _SIDE_NAMES.search(names))
    side = (tag in _SIDE and not (tag == "header" and in_main)) or named
    hard = side and (tag in _HARD or bool(names and _HARD_NAMES.search(names)))
    main = tag in ("article", "main") or bool(names and _MAIN_NAMES.search(names))
    return side, hard, main and not side


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order, with the words in links and what they lie in.

    Tags that are not closed end with the element around them, those of hidden
    elements too; only script, style and textarea reach to the end of the page. A
    head ends at the first tag or text that cannot stand in it, svg and math also
    with '/>' or before a block of HTML. A header inside an article's own element is
    part of it; other headers, menus and the like are not.

    Names of html and body say nothing of a page's parts. An article or main element in a
    form, or in a part that only has the name of a side part, is not at the side. The same
    holds for the text of such a part if it wraps the page: it has most of its words, and
    no main part lies outside. Time is linear in the page, however many tags are not closed.
    """
    out: list[Block] = []
    parts: list[str] = []
    link_words = 0
    # (tag, inside a part that is never of an article, inside the main part, a link, other side parts)
    stack: list[tuple[str, bool, bool, bool, tuple[int, ...]]] = []
    # Where the open elements of a kind lie in the stack.
    places: dict[str, list[int]] = {}
    softs = 0
    heading = False
    # Where the outermost hidden element lies in the stack, if one is open.
    hidden: int | None = None

    def end() -> None:
        nonlocal link_words
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            hard, main, soft = (stack[-1][1], stack[-1][2], stack[-1][4]) if stack else (False, False, ())
            out.append(Block(text, len(text.split()), link_words, hard, main, heading, () if hard else soft))
        link_words = 0

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def implied(tag: str) -> int | None:
        ends = _IMPLIED.get(tag)
        i = last(ends) if ends else -1
        return i if i >= 0 and i > last(_CONTAINERS) else None

    def enter(*entry) -> None:
        places.setdefault(entry[0], []).append(len(stack))
        stack.append(entry)

    def leave(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            places[stack.pop()[0]].pop()
        if hidden is not None and depth <= hidden:
            hidden = None

    at = 0
    while match := _PART.match(html, at):
        at = match.end()
        closing, tag, attributes, text = match.groups()
        if text is not None:
            if hidden is not None and stack[-1][0] == "head" and hidden == len(stack) - 1 and text.strip():
                leave(hidden)
            if hidden is not None:
                continue
            text = entities.unescape(text)
            parts.append(text)
            if stack and stack[-1][3]:
                link_words += len(text.split())
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            depth = places[tag][-1] if places.get(tag) else None
            if tag in _BLOCK and (hidden is None or (depth is not None and depth < hidden)):
                end()
                heading = False
            if depth is not None:
                leave(depth)
            continue
        if hidden is not None:
            outer = stack[hidden][0]
            if outer == "head":
                if tag == "body" or (hidden == len(stack) - 1 and tag not in _IN_HEAD):
                    leave(hidden)
            elif outer in ("svg", "math"):
                if attributes.endswith("/"):
                    continue
                if tag in _BLOCK and last(_HTML_IN) <= hidden:
                    leave(hidden)
        if tag in _RAW:
            stop = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
            at = stop.end() if stop else len(html)
            if hidden is None:
                parts.append(" ")
            continue
        if tag == "title" and hidden is not None and stack[hidden][0] == "head":
            stop = _TITLE_END.match(html, at)
            at = stop.end()
            continue
        if tag in _HIDDEN:
            if tag == "head":
                end()
            if hidden is None:
                parts.append(" ")
            if tag in ("svg", "math") and attributes.endswith("/"):
                continue
            stop = _SKIPPED[tag].search(html, at) if tag in _SKIPPED else None
            if stop and stop[1]:
                at = stop.end()
                continue
            if hidden is None:
                hidden = len(stack)
            enter(tag, *(stack[-1][1:] if stack else (False, False, False, ())))
            continue
        if hidden is not None and tag not in _VOID:
            i = implied(tag)
            if i is not None and (i > hidden or stack[hidden][0] not in _SCOPE):
                if i < hidden:
                    end()
                leave(i)
            if hidden is not None:
                enter(tag, *stack[-1][1:])
                continue
        if hidden is not None:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _VOID:
            if tag in _BLOCK:
                end()
            continue
        if tag in _BLOCK:
            end()
            if (i := implied(tag)) is not None:
                leave(i)
            heading = tag[0] == "h" and tag[1:].isdigit()
        over = stack[-1] if stack else ("", False, False, False, ())
        side, hard, main = _side(tag, attributes, over[2])
        soft = () if tag in ("article", "main") and not side else over[4]
        if side and not hard:
            softs += 1
            # A part within as many others adds nothing: what settles one of them settles it.
            soft = (*soft, softs) if len(soft) < 8 else soft
        enter(tag, over[1] or hard, over[2] or main, over[3] or tag == "a", soft)
    end()
    return _settled(out)


def _settled(found: list[Block]) -> list[Block]:
    """Mark blocks in soft side parts as side, but for parts that wrap the page."""
    words, outside = Counter(), sum(b.words for b in found if b.main and not b.side and not b.soft)
    for b in found:
        for s in b.soft:
            words[s] += b.words
    total = sum(b.words for b in found)
    wraps = {s for s, n in words.items() if n >= WRAPS_WORDS and n >= WRAPS * total} if not outside else set()
    for b in found:
        b.side = b.side or any(s not in wraps for s in b.soft)
    return found


def table(found: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block; a page has empty blocks before and after it."""
    rows = np.array([(b.words, b.link_words / max(1, b.words), b.side, b.main, b.heading) for b in found], float).reshape(-1, 5)
    edge = np.zeros((1, 2))
    near = np.concatenate([edge, rows[:, :2], edge])
    return np.concatenate([rows[:, :2], near[:-2], near[2:], rows[:, 2:]], axis=1)


#: Made-up pages whose blocks are labelled: text ending in "+" is main text.
EXAMPLES = (
    "<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/s>Sports results</a></ul></nav><article><h1>A quiet morning in the harbour+</h1>"
    "<p>The boats lay still while the tide came in, and nobody on the quay said a word about the storm of the night before.+<p>Later the fog lifted.+"
    "<p>By noon the market had opened and the first buyers were walking from stall to stall, asking for prices.+</article><footer>Harbour Post, all rights reserved</footer>",
    "<body><header><h1>The Daily Example</h1><p>News since the first day, written for readers everywhere</p></header><div class=menu><a href=/a>World</a> <a href=/b>Local</a></div>"
    "<div class=content><h2>New bridge opens+</h2><p>The bridge that the town had waited for was opened on Monday by the mayor and a school choir.+</p><p>Traffic is light.+</p>"
    "<p>More than a thousand people crossed it on the first day, most of them on foot, and many stopped to look at the water.+</p></div>"
    "<div class=comments><p>I was there and it was a wonderful day for the whole family, thank you all for the effort</p><p>First!</p></div>",
    "<body><div class=ad>Buy two and get one free, only this week in every shop near you</div><div class=cookie-notice>We use cookies to make this site better for you and our partners."
    " <a href=/c>Read more</a> <button>Accept</button></div><main><p>Soup is best when the onions have been cooked slowly until they are brown and sweet.+</p><p>Salt it late.+</p>"
    "<ul><li>two onions+</li><li>one litre of water and a spoon of salt+</li></ul></main><aside><h3>Related</h3><p>Ten quick dinners that you can cook with what is left in the fridge</p></aside>",
    "<body><h1>Notes on walking+</h1><p>Walking slowly is harder than it looks, because the street keeps asking you to hurry along with it.+</p><p>Stop often.+</p>"
    "<p>When the road turns there is nearly always something to see that a faster walker would have missed completely.+</p>"
    "<form><p>Leave your address here and we will send you a letter every month</p><input><button>Send</button></form><p><a href=/1>One</a> <a href=/2>Two</a> <a href=/3>Three</a></p>",
    "<body><div id=sidebar><ul><li><a href=/x>Archive of all posts</a></li><li><a href=/y>About</a></li></ul><p>This blog has been written by two sisters since they left school</p></div>"
    "<div class=post><h2>Moving house+</h2><p>We packed for a week and still forgot the kettle, which my sister found three days later in a box of books.+</p><p>It still works.+</p>"
    "<p>See <a href=/k>our list of boxes</a> if you plan to move and would rather not repeat any of our mistakes.+</p></div><div class=footer>Written at home, printed nowhere</div>",
    "<body><p><a href=/>Start</a></p><p><a href=/p>Products</a></p><p><a href=/q>Questions and answers</a></p><p>The library keeps its oldest maps in a cellar where the air is dry and cold all year.+</p>"
    "<p>Visitors may see them on request.+</p><p>A new catalogue lists every map with its maker, its year and the paper on which it was drawn.+</p><p><a href=/i>Imprint</a> <a href=/t>Terms</a></p>",
    "<body><p>Bees find their way home by the light of the sky even when the sun is hidden behind a thick cloud.+</p><p>How do they do it?+</p>"
    "<p>They see a pattern in the light that people cannot see, and it tells them where the sun must be.+</p>"
    "<p><a href=/u>Send by letter</a></p><p>Pass it on</p><p><a href=/v>Print</a></p><p>Most read</p><p><a href=/w>Why cats land on their feet</a></p>",
)


def examples() -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: features and label of each block of ``EXAMPLES``."""
    xs, ys = [], []
    for page in EXAMPLES:
        found = blocks(page)
        xs.append(table(found))
        ys += [b.text.endswith("+") for b in found]
    return np.concatenate(xs), np.array(ys, float)


@dataclass(frozen=True)
class Tree:
    """A decision tree as arrays; a negative feature marks a leaf with its label in ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = self.feature[node] >= 0
            if not inner.any():
                return self.cut[node] > 0.5
            at = node[inner]
            goes_left = x[np.flatnonzero(inner), self.feature[at]] <= self.cut[at]
            node[inner] = np.where(goes_left, self.left[at], self.right[at])


def train(spark: SparkSession, depth: int = 5) -> Tree:
    """Fit a decision tree to the labelled table."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    xs, ys = examples()
    rows = [(Vectors.dense(x.tolist()), float(y)) for x, y in zip(xs, ys, strict=True)]
    data = spark.createDataFrame(rows, ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(data.coalesce(1))
    feature, cut, left, right = [], [], [], []

    def add(node) -> int:
        k = len(feature)
        for column in (feature, cut, left, right):
            column.append(-1)
        if node.subtreeDepth() == 0:
            cut[k] = node.prediction()
        else:
            feature[k], cut[k] = node.split().featureIndex(), node.split().threshold()
            left[k], right[k] = add(node.leftChild()), add(node.rightChild())
        return k

    add(model._java_obj.rootNode())
    return Tree(np.array(feature), np.array(cut, float), np.array(left), np.array(right))


def main_text(html: str | None, tree: Tree) -> str:
    found = blocks(html) if html else []
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, tree.predict(table(found)), strict=True) if keep)


def extract(pages: DataFrame, tree: Tree, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A page is cut into flat blocks of text. A block's words, the part of them in
    links, the same of the blocks before and after it, and whether it lies in a
    part named as main or as a side part decide if it is main text. Character
    references are decoded, white space in a block becomes one space, blocks are
    joined by an empty line. NULL and empty pages give an empty text; rows that
    repeat an id are read each; whole pages count, however long. Other columns are not
    read. An empty table gives an empty result. Pages are read one by one: no shuffle.
    """

    def read(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page, tree) for page in part.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_batches(rows, read, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
