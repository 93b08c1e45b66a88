"""Main-text extraction from web pages by flat text blocks and a decision tree.

A page is cut into flat text blocks at block-level tags. Each block is described by
its own word count and link density, those of its neighbours, and where it stands
(its tag, an enclosing article, navigation, aside or form, telling words in classes and
ids). A decision tree, grown here on a small table of labelled blocks
(``TRAINING``), decides which blocks are main text. Nothing is downloaded and no
page is rendered; scripts, styles and other unseen elements never become text.

Kept blocks are joined in page order by an empty line. Character references are
decoded; white space inside a block becomes one space.

Edge cases: null or empty html gives an empty text; broken markup (unclosed tags,
comments or quotes) is read to its end; text outside any element counts;
pages of any length are read whole, in time linear in their length; repeated rows
give one row each; an empty table gives an empty result. Only the named columns are
read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_STOP = re.compile("[>\"']")
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_COMMENT_END = re.compile("--!?>")
_NAMES = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden|aria-label)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

#: Elements whose content is never text of the page.
UNSEEN = frozenset("script style template noscript iframe svg math canvas object select option datalist button textarea title audio video head".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in classes, ids and roles that speak against and for main text.
AGAINST = re.compile(
    r"^(ads?|adv|advert\w*|adsense|adslot|banner\w*|sponsor\w*|promo\w*|commercial|outbrain|taboola|nav\w*|menu\w*|breadcrumb\w*|crumbs?|toolbar|topbar|footer|foot|copyright|colophon|legal|disclaimer|sidebar\w*|side|rail|aside|widget\w*|related\w*|recommend\w*|teaser\w*|trending|popular|share\w*|sharing|social\w*|follow|comments?|commentlist|replies|reply|respond|disqus|discussion|cookies?\w*|consent|gdpr|notices?|notification\w*|alert\w*|warning|popup|modal|overlay|dialog|paywall|login|signin|signup|register|newsletter\w*|subscri\w*|search\w*|form|pagination|pager|paging|skip|tags?|tagcloud|metadata|byline|author|rating\w*|masthead|navigation|contentinfo|complementary|tooltip|hidden)$"
)
HEADER = re.compile(r"^(header|head|masthead|banner|topbar)$")
FOR = re.compile(r"^(article\w*|post|entry|story|content|main|body|text|prose|hentry|blog)$")
FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "heading", "list_item", "table_cell", "in_article", "in_navigation", "in_aside", "in_form", "in_page_header", "in_page_footer", "against", "for_", "long_neighbour", "sentence", "page_has_article",
)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    flags: frozenset[str]
    tag: str


def _flags(tag: str, attributes: str) -> set[str]:
    """What an element says about the text inside it."""
    out = set()
    if tag in ("article", "main"):
        out.add("article")
    elif tag in ("nav", "menu"):
        out.add("navigation")
    elif tag in ("aside", "form", "dialog", "search"):
        out.add("aside" if tag == "aside" else "form")
    elif tag in ("header", "footer"):
        out.add(tag)
    elif tag == "fieldset" or tag == "legend":
        out.add("form")
    if attributes and tag not in ("html", "body"):
        for m in _NAMES.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                out.add("unseen")
            elif name in ("class", "id", "role", "itemprop"):
                words = [w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", value) if w]
                good = any(FOR.match(w) for w in words)
                bad = [w for w in words if AGAINST.match(w)]
                if "articlebody" in (w.lower() for w in value.split()) or (good and not bad):
                    out.add("for")
                    if "article" in words or name == "role" and "main" in words:
                        out.add("article")
                if bad and not (good and all(HEADER.match(w) for w in bad)):
                    out.add("against")
                if any(HEADER.match(w) for w in words) and not good:
                    out.add("header")
    return out


class Scanner:
    """Tags of a page in order, in time linear in its length whatever the markup.

    Attributes may hold ``>`` in quotes. Where a quote never closes, the tag ends at its first ``>``;
    a tag without any ``>`` is text. What a failed search for the end has passed is remembered, so that
    no stretch is searched twice from the same state.
    """

    def __init__(self, page: str) -> None:
        self.page, self.n = page, len(page)
        self.dead: set[int] = set()  # stops from which no tag end is reached
        self.stop_from, self.stop = 0, -1  # the first stop at or after each position of this range
        self.gt = -1

    def next_stop(self, at: int) -> int:
        if not self.stop_from <= at <= self.stop:
            m = _STOP.search(self.page, at)
            self.stop_from, self.stop = at, m.start() if m else self.n
        return self.stop

    def next_gt(self, at: int) -> int:
        if self.gt < at:
            found = self.page.find(">", at)
            self.gt = self.n if found < 0 else found
        return self.gt

    def tag_end(self, at: int) -> int:
        """Position of the ``>`` that ends a tag whose attributes begin at ``at``; the page's length if there is none."""
        passed = []
        i = self.next_stop(at)
        while i < self.n and i not in self.dead:
            if self.page[i] == ">":
                return i
            passed.append(i)
            close = self.page.find(self.page[i], i + 1)
            if close < 0:
                break
            m = _STOP.search(self.page, close + 1)
            i = m.start() if m else self.n
        self.dead.update(passed)
        return self.next_gt(at)

    def tags(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, closing, tag, attributes); comments and declarations have an empty tag. The caller may send the
        position to go on from."""
        at = 0
        while (start := self.page.find("<", at)) >= 0:
            if self.page.startswith("<!--", start):
                m = _COMMENT_END.search(self.page, start + 4)
                token = (start, m.end() if m else self.n, False, "", "")
            elif self.page.startswith(("<!", "<?"), start):
                token = (start, min(self.next_gt(start) + 1, self.n), False, "", "")
            elif m := _OPEN.match(self.page, start):
                end = self.tag_end(m.end())
                if end == self.n:  # no tag ends behind here, but a comment may begin
                    at = start + 1
                    continue
                token = (start, end + 1, bool(m[1]), m[2].lower(), self.page[m.end() : end])
            else:
                at = start + 1
                continue
            jump = yield token
            at = token[1] if jump is None else jump
            if jump is not None:
                yield  # the answer to send()


class Elements:
    """Open elements with what they say about text inside; the last open one of each name is found at once."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.flags: list[frozenset[str]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def here(self) -> frozenset[str]:
        return self.flags[-1] if self.flags else frozenset()

    def block(self) -> str:
        return self.names[self.blocks[-1]] if self.blocks else ""

    def push(self, name: str, own: set[str]) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name in BLOCK:
            self.blocks.append(len(self.names))
        self.flags.append(self.here() | own if own else self.here())
        self.names.append(name)

    def pop(self) -> None:
        name = self.names.pop()
        self.flags.pop()
        self.places[name].pop()
        if name in BLOCK:
            self.blocks.pop()

    def close(self, name: str) -> None:
        """End the last open element of a name and all inside it; a span does not end the blocks inside it."""
        places = self.places.get(name)
        if not places or (name == "span" and self.blocks and self.blocks[-1] > places[-1]):
            return
        for _ in range(len(self.names) - places[-1]):
            self.pop()


def closed_links(page: str) -> set[int]:
    """Starts of the link tags that are followed by their end before another link begins."""
    marks = [(m.start(), bool(m[1])) for m in _LINK.finditer(page)]
    return {at for (at, closing), (_, next_closing) in zip(marks, marks[1:]) if not closing and next_closing}


def blocks_of(page: str) -> list[Block]:
    """Flat text blocks of a page in order.

    A link that is closed before another begins covers the blocks inside it; one that is not ends at the next block."""
    out: list[Block] = []
    elements = Elements()
    closed = closed_links(page)
    parts: list[str] = []
    linked: list[str] = []
    in_link, covers = False, False

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text and "unseen" not in elements.here():
                out.append(Block(text, len(text.split()), len(html_lib.unescape(" ".join(linked)).split()), elements.here(), elements.block()))
        parts, linked = [], []

    def take(text: str) -> None:
        if text:
            parts.append(text)
            if in_link:
                linked.append(text)

    at, n = 0, len(page)
    lower = None
    never_closed: set[str] = set()
    scanner = Scanner(page)
    tokens = scanner.tags()
    for start, end, closing, tag, attributes in tokens:
        take(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            in_link = not closing
            covers = start in closed
            continue
        if not closing and tag in UNSEEN and tag != "head" and not attributes.endswith("/"):
            if lower is None:
                lower = page.lower()
                if len(lower) != n:  # some capitals lower to two characters
                    lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in page)
            stop = -1 if tag in never_closed else lower.find(f"</{tag}", at)
            if stop < 0:
                never_closed.add(tag)
                if tag in ("script", "style", "template", "title", "textarea"):
                    at = n
                    break
                continue
            close = page.find(">", stop)
            at = n if close < 0 else close + 1
            tokens.send(at)
            parts.append(" ")
            continue
        if tag not in BLOCK and tag not in ("span", "head") or tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
            in_link = in_link and covers
        if closing:
            elements.close(tag)
            continue
        if tag in ("p", "li", "dt", "dd", "td", "th", "tr") or tag in HEADINGS:
            # these close themselves when the next one of their kind, or any block after a paragraph, begins
            ends = {"p", *HEADINGS} if tag in HEADINGS or tag == "p" else {"p", "li"} if tag == "li" else {"p", "dt", "dd"} if tag in ("dt", "dd") else {"p", "td", "th"} if tag in ("td", "th") else {"p", "td", "th", "tr"}
            while elements.names and (elements.names[-1] in ends or elements.names[-1] == "span"):
                elements.pop()
        elif tag in BLOCK:
            while elements.names and elements.names[-1] in ("p", "span"):
                elements.pop()
        own = _flags(tag, attributes)
        if tag == "span":
            if not own & {"unseen", "against"}:
                own = set()
            elif "unseen" in own:
                flush()
        elements.push(tag, own)
    take(page[at:])
    flush()
    return out


def feature_rows(blocks: list[Block]) -> np.ndarray:
    """Features of each block (blocks x ``FEATURES``)."""
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    density = np.array([min(b.linked, b.words) / max(1, b.words) for b in blocks])
    has_article = any("article" in b.flags for b in blocks)
    out = np.zeros((n, len(FEATURES)))
    for i, b in enumerate(blocks):
        f = b.flags
        before = (words[i - 1], density[i - 1]) if i else (0, 0)
        after = (words[i + 1], density[i + 1]) if i + 1 < n else (0, 0)
        article = "article" in f
        out[i] = (
            b.words, density[i], *before, *after,
            b.tag in HEADINGS, b.tag in ("li", "dt", "dd"), b.tag in ("td", "th"),
            article, "navigation" in f, "aside" in f, "form" in f, "header" in f and not article, "footer" in f, "against" in f, "for" in f,
            max(before[0] * (1 - before[1]), after[0] * (1 - after[1])), b.text[-1] in ".!?…:;\"'”»)", has_article,
        )
    return out


@dataclass
class Tree:
    """A grown decision tree: a test ``x[feature] <= cut`` with two branches, or an answer."""

    answer: bool
    feature: int = -1
    cut: float = 0.0
    below: Tree | None = None
    above: Tree | None = None

    def decide(self, rows: np.ndarray) -> np.ndarray:
        if self.below is None:
            return np.full(len(rows), self.answer)
        low = rows[:, self.feature] <= self.cut
        out = np.empty(len(rows), bool)
        out[low], out[~low] = self.below.decide(rows[low]), self.above.decide(rows[~low])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 8) -> Tree:
    """Grow a tree by the Gini criterion; ties take the first feature and the lowest cut."""
    answer = bool(y.mean() >= 0.5) if len(y) else False
    if depth == 0 or len(y) < 2 * least or y.all() or not y.any():
        return Tree(answer)
    best, n = None, len(y)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(v[1:] > v[:-1]) + 1
        at = at[(at >= least) & (at <= n - least)]
        if not len(at):
            continue
        a, b = t[at - 1] / at, (t[-1] - t[at - 1]) / (n - at)
        impurity = (at * a * (1 - a) + (n - at) * b * (1 - b)) / n
        k = int(np.argmin(impurity))
        if best is None or impurity[k] < best[0] - 1e-12:
            best = (impurity[k], f, (v[at[k] - 1] + v[at[k]]) / 2)
    if best is None:
        return Tree(answer)
    low = x[:, best[1]] <= best[2]
    return Tree(answer, best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


#: Labelled blocks as small pages: a block that begins with + is main text, one with - is not.
TRAINING = (
    """<nav><ul><li><a href=/>-Home</a></li><li><a href=/n>-News today</a></li><li><a href=/s>-Sport</a></li></ul></nav><div class=ad>-Buy the new kettle now while it lasts.</div>
    <article><h1>+Rain over the hills</h1><p>+The rain began before noon and did not stop until the river had risen over the old bridge.</p><p>+It rained.</p><p>+Farmers moved their animals to the high meadows, as they had done in other years.</p></article><footer>-&copy; The Valley Paper. All rights are reserved to it.</footer>""",
    """<header><div class=logo>-The Valley Paper</div><p>-News that grows with the valley every day of the week.</p></header><main><h1>+A bridge</h1><p>+Short.</p><ul><li>+First the stone piers were set</li><li>+Then the deck</li></ul><p>+After nine years the work was finished and the mayor cut a ribbon.</p>
    <aside>-Read also what our readers liked most in the past week of news.</aside><form><p>-Enter your address and get our letter every morning.</p></form></main><div id=comments><p>-I walked over this bridge with my father when I was a small child.</p><p>-Nice!</p></div>""",
    """<div id=menu><a href=a>-Start</a> <a href=b>-Shop</a></div><div class=content><h2>+How to bake</h2><p>+Take flour and water and a little salt, and wait for a long evening.</p><p>+Bake it.</p><div class=share>-Tell your friends about this page on every network you use.</div><p>+Let the bread cool before you cut it into slices for the table.</p></div><div class=sidebar><p>-Our shop has new tins and bowls for every kitchen this month.</p></div>""",
    """<div><a href=1>-One</a> <a href=2>-Two</a> <a href=3>-Three</a></div><div><h1>+Plain page</h1><p>+This page has no article element and no class that would help, but its paragraphs are long and free of links.</p><p>+A second paragraph follows the first one and it also says a thing or two about the matter at hand.</p><p>+A third paragraph ends the page with a few more words than a menu would ever have in it.</p></div><div><a href=x>-Imprint</a> <a href=y>-Contact us</a></div>""",
    """<div class="cookie-notice">-We use cookies to make this site work better for you and for us.</div><div class=breadcrumb><a href=/>-Home</a> / <a href=/x>-Travel</a></div><article class=post><header><h1>+By train to the sea</h1></header><p>+We left at six in the morning when the town was still asleep.</p><p>+See <a href=/m>the map</a> of the line.</p><blockquote>+The sea is a good listener.</blockquote><h2>+The way back</h2><p>+We slept.</p><section class="comments"><p>-Lovely story, it made me want to pack my bag at once and go.</p></section></article><div class=related><a href=/a>-By bus to the hills</a><p>-More travel stories from our writers can be found here.</p></div>""",
    """<div role=navigation><a href=/>-Index</a></div><div role=main><h1>+Results</h1><table><tr><td>+Tea</td><td>+42</td></tr><tr><td>+Coffee</td><td>+58</td></tr></table><p>+The table shows which drink people prefer after lunch.</p></div><div class=footer><p>-This site is made by a small team in a small town by the river.</p></div>""",
    """<article><h1>+Notes</h1><p>+One.</p><p>+Two words.</p><p>+A paragraph of a usual length that says something about something in a plain way.</p><div class="ad-slot">-Get three for the price of two in all our shops until Sunday.</div><p>+And on it goes.</p><ol><li>+Wash</li><li>+Rinse well</li></ol><figure><figcaption>+The old mill in winter</figcaption></figure></article><aside><p>-Weather for the next days is cold with a little sun in the afternoon.</p></aside><footer><p>-Made with care in the valley since the year the bridge was built.</p></footer>""",
    """<div class=notice>-The site will be closed for repairs on Monday night from ten.</div><div class="newsletter-box"><p>-Sign up for our letter and never miss a story again in your life.</p></div><div><p>+There was once a miller who had three sons, a mill, a donkey and a cat, and when he died the sons shared what he left.</p><p>+The eldest took the mill, the second took the donkey, and the youngest got the cat and was not happy about it at all.</p></div><div><a href=1>-Older</a><a href=2>-Newer</a></div>""",
    """<form action=/s><label>-Search this site for words</label></form><main><article><p>+No heading here, only text that runs on for a while until it ends with a stop.</p><p>+Yes, really!</p></article></main><section id=respond><h3>-Leave a reply</h3><p>-Your address will not be shown to anyone who reads this page.</p></section>""",
    """<h1>+Release notes</h1><p>+The new version reads files faster than the old version did, and it needs less memory for it.</p><ul><li>+Faster start when many files are open at the same time</li><li>+Fewer warnings for old settings that nobody uses now</li></ul><ul><li><a href=1>-Docs</a></li><li><a href=2>-Forum</a></li></ul><div class=legal>-All marks belong to their owners and are used here to name them.</div>""",
    """<nav>-Menu <a href=a>-Local</a></nav><div class="ad">-Short ad here.</div><article><h1>+A.</h1><p>+B.</p><p>+C d e.</p></article><footer>-&copy; some.example &middot; A few words at the end of it.</footer>""",
    """<div class="article-body"><p>+Soup is simple.</p><p>+Cut the roots, add water, and let it boil until they are soft.</p></div><div class="author-bio">-The author lives in the hills and cooks for a living these days.</div><div class="tags"><a href=/t>-soup</a> <a href=/u>-winter</a></div>""",
    """<footer><p>-This line stands in a footer that comes before the rest of the page.</p></footer><nav><p>-Pick a chapter of the book from the list that you see below here.</p><p>-Chapters</p></nav><p>+The text begins here and goes on to the very end of the page without any more parts.</p><p>+So this is the last paragraph of all.</p>""",
    """<article><h1>+Only an article</h1><p>+There is nothing else on this page.</p><p>+End.</p></article>""",
    """<p>+A single paragraph that makes up the whole page and nothing more than that.</p>""",
    """<div>+Some text in a bare element, long enough to be read as a text by anyone.</div><div>+And a second one that closes the page with a full stop.</div>""",
    """<article><p>+First.</p><p>+The last paragraph of an article that ends its page.</p><ul><li>+a</li><li>+the last item</li></ul></article>""",
    """<main><h2>+Steps</h2><ol><li>+Open the box</li><li>+Close the box</li></ol></main><nav><ul><li>-Back</li><li>-Forward</li></ul></nav><footer>-Box company, since the year the first box was made.</footer>""",
    """<header><p>-A line above the page that says what this place is about, in some words.</p></header><div><p>+The body of the page follows its header and has a number of words in it.</p><p>+Fine.</p></div><footer><ul><li>-Terms</li><li>-Privacy</li></ul><p>-No part of this may be copied without the leave of its makers.</p></footer>""",
    """<aside><h3>-More</h3><p>-A box at the side with a few words on another thing that we sell.</p></aside><article><h1>+A day at the lake</h1><p>+We swam.</p><p>+In the evening we sat by the fire and told each other old stories.</p></article><aside><p>-Last box of the page, with words about boats that one can hire.</p></aside>""",
    """<form><p>-Write your question here and we will answer it within two days.</p><p>-Send</p></form><article><p>+An answer that many people wanted to read is printed here in full.</p></article><form><p>-Was this of use to you? Tell us in a few words, please.</p></form>""",
    """<ul><li><a href=1>-Latest</a></li><li><a href=2>-Most read this week by all</a></li></ul><p>+A page of text with <a href=3>one link</a> inside a sentence and no other element of note.</p><p><a href=4>-Next page of this long list of pages</a></p>""",
    """<article><nav><p>-In this article</p><ul><li><a href=1>-Start</a></li><li>-End of it</li></ul></nav><h1>+Long read</h1><p>+It starts here.</p><p>+And it ends here, after a while and some more words.</p><footer><p>-Filed under long reads on the third day of the month.</p></footer></article>""",
    """<div><h1>+No article here</h1><p>+The text stands in a bare element between a box and a form.</p></div><aside><p>-The box says that there is more to see in another place of the site.</p></aside><form><p>-The form wants a name and an address before it lets you go on.</p></form><div><p>+And the text goes on below them until the page ends.</p></div>""",
)


def training_table(variants: int = 40, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of ``TRAINING`` and of variants of its pages.

    Where an element says what a block is (or the page marks its article), length is no sign: the
    variants give such blocks other lengths, and cut blocks off either end of the page. Blocks
    without such context keep their lengths, as there these are the signs.
    """
    rng = np.random.default_rng(seed)
    x, y = [], []
    for page in TRAINING:
        blocks = blocks_of(page)
        labels = np.array([b.text.startswith("+") for b in blocks])
        for b in blocks:
            b.text = b.text[1:]
        marked = any("article" in b.flags for b in blocks)
        for v in range(variants):
            made = []
            for b in blocks:
                words, linked, text = b.words, b.linked, b.text
                if v and (marked or b.flags):
                    words = int(rng.integers(1, rng.choice([4, 15, 80]) + 1))
                    linked = round(words * min(b.linked, b.words) / b.words)
                    text = text.rstrip(".!?") + rng.choice([".", "."] if words > 8 else [".", "x"])
                made.append(Block(text, words, linked, b.flags, b.tag))
            first = int(rng.integers(0, max(1, len(made) // 3))) if v % 3 == 1 else 0
            last = len(made) - (int(rng.integers(0, max(1, len(made) // 2))) if v % 3 == 2 else 0)
            x.append(feature_rows(made[first:last]))
            y.append(labels[first:last])
    return np.concatenate(x), np.concatenate(y)


def main_text(page: str | None, tree: Tree) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    kept = tree.decide(feature_rows(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, kept.tolist(), strict=True) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    tree = grow(*training_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [main_text(x.as_py(), tree) for x in part.column("_html")]
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    picked = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), F.col(html_col).cast("string").alias("_html"))
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
