"""Main text of web pages: leaf blocks of the markup, labelled by a linear-chain conditional random field.

Block features are the ancestors' tags, words of their class, id and role, and measures of the block's text. The
field is trained on labelled pages (see `labelled_page`) by stochastic gradient ascent of the log-likelihood, and
pages are decoded by Viterbi. A page is one row throughout; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(script|style|noscript|template|svg|iframe|head|textarea|select|object|canvas|math|audio|video)(?=[\s/>])(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
# Phrasing elements: what stands inside a sentence ends no block.
INLINE = frozenset("a abbr acronym area b bdi bdo big blink button cite code data del dfn em embed font i img input ins kbd keygen label link map mark meta meter nobr output picture progress q rb rp rt rtc ruby s samp slot small source span strike strong sub sup time track tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
RAW = frozenset("script style textarea iframe".split())
IN_HEAD = frozenset("base basefont bgsound html link meta noscript script style template title".split())
BLOCKS = CLOSES_P | frozenset("aside body figure figcaption html li dd dt tr td th tbody thead".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "option": ("option", ("select",))}
#: what the words of class, id and role tell; of four letters or more, also as a beginning
HINTS = {
    "menu": ("nav", "menu", "breadcrumb", "topbar", "toc", "pagination", "pager", "tabs", "navigation"),
    "header": ("header", "masthead", "banner", "logo", "branding", "hero"),
    "footer": ("footer", "foot", "copyright", "colophon", "contentinfo", "legal", "bottom"),
    "side": ("side", "aside", "widget", "rail", "related", "recommend", "popular", "trending", "complementary", "teaser", "more", "tag", "author", "bio"),
    "advert": ("ad", "ads", "advert", "sponsor", "promo", "adsense", "dfp", "outbrain", "taboola"),
    "notice": ("cookie", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "privacy", "message", "warning", "paywall"),
    "comment": ("comment", "comments", "reply", "replies", "discussion", "disqus", "respond", "reader", "feedback", "review"),
    "form": ("form", "subscribe", "newsletter", "login", "signup", "search", "contact", "register"),
    "share": ("share", "social", "follow", "buttons", "toolbar"),
    "article": ("article", "content", "post", "entry", "main", "story", "body", "text", "page"),
}
HINT_OF = {word: name for name, words in HINTS.items() for word in words}
#: words that blocks around the article often start with or hold
PHRASES = re.compile(r"cookie|subscribe|newsletter|copyright|all rights|privacy|advert|sponsored|read more|related|log ?in|sign (?:in|up)|share|comment|reply|posted by|terms of|click here|©|\bwrote\b|\bsays\b", re.I)


def _hints(attributes: str) -> tuple:
    found = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        for word in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()):
            known = HINT_OF.get(word) or next((HINT_OF[word[:n]] for n in range(len(word) - 1, 3, -1) if word[:n] in HINT_OF), None)
            if known:
                found.add(known)
    return tuple(sorted(found))


def _unclosed(page: str, at: int, element: str) -> int:
    """Where an element without an end tag ends: at the first tag that a head, or else a phrase, cannot hold.

    As in HTML, nothing ends raw text but its own end tag.
    """
    if element in RAW:
        return len(page)
    while found := TOKEN.search(page, at):
        at = found.end()
        tag = (found[1] or found[3] or "").lower()
        if element == "head" and tag in IN_HEAD:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at) if tag in ("script", "style", "noscript", "template", "title") and not found[2] else None
            at = end.end() if end else at
        elif tag and (element == "head" or tag in BLOCKS):
            return found.start()
    return len(page)


def blocks(page: str) -> list:
    """(text, path, share of its characters inside links) of each leaf block with text, in page order.

    path holds tag and hints of each open element. Markup may be malformed: a paragraph ends where a block begins,
    an end tag closes what is open inside its element, and one without a start is passed over.
    """
    out, path, pieces, linked, total, in_link = [], [], [], 0, 0, 0

    def close_block():
        nonlocal pieces, linked, total
        text = " ".join("".join(pieces).split())
        if text:
            out.append((text, tuple(path), linked / max(1, total)))
        pieces, linked, total = [], 0, 0

    def add(raw):
        nonlocal linked, total
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            total += len(text.strip())
            linked += len(text.strip()) if in_link else 0

    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        if found[1]:  # its content is no text of the page
            close = found[1].lower()
            if close in ("svg", "math") and found[0].endswith("/>"):
                continue
            end = re.compile(rf"</{found[1]}\s*>", re.I).search(page, at)
            if not end and close == "head":
                end = re.compile(r"(?=<body\b)", re.I).search(page, at)
            at = end.end() if end else _unclosed(page, at, close)
            if close == "head":
                close_block()
            continue
        tag = (found[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if found[2] else 1
            continue
        close_block()
        in_link = 0
        if found[2]:
            for depth in range(len(path) - 1, -1, -1):
                if path[depth][0] == tag:
                    del path[depth:]
                    break
        elif tag not in VOID:
            if tag in CLOSES_P and path and path[-1][0] == "p":
                path.pop()
            sibling, inside = SIBLINGS.get(tag, ("", ()))
            for depth in range(len(path) - 1, -1, -1):
                if path[depth][0] in inside:
                    break
                if path[depth][0] == sibling:
                    del path[depth:]
                    break
            if not found[4].rstrip().endswith("/") or tag in ("p", "div"):
                path.append((tag, _hints(found[4])))
    close_block()
    return out


def path_features(path: tuple) -> frozenset:
    """Features of a block's ancestors: each tag and hint above it, and the innermost ones once more."""
    found = {f"under {tag}" for tag, _ in path} | {f"hint {hint}" for _, hints in path for hint in hints}
    if path:
        found.add(f"in {path[-1][0]}")
        found.update(f"in hint {hint}" for hint in path[-1][1])
    order = [t for t, _ in path if t in ("article", "main", "header", "footer", "aside", "nav", "section")]
    if order:
        found.update((f"last landmark {order[-1]}", f"landmarks {' '.join(order[-3:])}"))
    hints = [hint for _, hs in path for hint in hs]
    if hints:
        found.update((f"last hint {hints[-1]}", f"hints {' '.join(hints[-3:])}"))
    return frozenset(found)


def text_features(text: str, linked: float) -> list:
    words = text.count(" ") + 1
    found = ["always", f"words {sum(words >= least for least in (2, 4, 8, 16, 32, 64))}", f"linked {sum(linked > least for least in (0, 0.3, 0.7, 0.95))}"]
    found.append("sentence" if text[-1] in ".!?…。:;\"”" else "no stop")
    if PHRASES.search(text):
        found.append("phrase")
    if sum(map(str.isdigit, text)) * 5 > len(text):
        found.append("digits")
    return found


@dataclass
class Field:
    """Weights of each feature, of each pair of neighbouring labels and of the first label; label 1 is the article."""

    names: dict
    emission: np.ndarray
    transition: np.ndarray
    first: np.ndarray

    def scores(self, page_blocks: list, seen: dict) -> np.ndarray:
        """seen keeps the summed weights of paths met before."""
        out = np.empty((len(page_blocks), 2))
        for i, (text, path, linked) in enumerate(page_blocks):
            above = seen.get(path)
            if above is None:
                if len(seen) > 50_000:
                    seen.clear()
                above = seen[path] = self._sum(path_features(path))
            out[i] = above + self._sum(text_features(text, linked))
        return out

    def _sum(self, features) -> np.ndarray:
        rows = [self.names[f] for f in features if f in self.names]
        return self.emission[rows].sum(axis=0)

    def decode(self, scores: np.ndarray) -> list:
        """Best labels by Viterbi."""
        (a0, a1), t = (self.first + scores[0]).tolist(), self.transition.tolist()
        back = []
        for s0, s1 in scores[1:].tolist():
            from0, from1 = a0 + t[0][0] < a1 + t[1][0], a0 + t[0][1] < a1 + t[1][1]
            back.append((from0, from1))
            a0, a1 = max(a0 + t[0][0], a1 + t[1][0]) + s0, max(a0 + t[0][1], a1 + t[1][1]) + s1
        label = int(a1 > a0)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def _marginals(scores, field):
    """P(label) of each block and expected label pairs, by the forward-backward algorithm."""
    size = len(scores)
    forward, backward = np.empty((size, 2)), np.zeros((size, 2))
    forward[0] = field.first + scores[0]
    for i in range(1, size):
        forward[i] = np.logaddexp(forward[i - 1, 0] + field.transition[0], forward[i - 1, 1] + field.transition[1]) + scores[i]
    for i in range(size - 2, -1, -1):
        ahead = scores[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(field.transition[:, 0] + ahead[0], field.transition[:, 1] + ahead[1])
    total = np.logaddexp(*forward[-1])
    single = np.exp(forward + backward - total)
    pairs = np.exp(forward[:-1, :, None] + field.transition + (scores[1:] + backward[1:])[:, None, :] - total)
    return single, pairs.sum(axis=0)


def train(pages: list, epochs: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> Field:
    """pages: lists of (feature names, label) per page. Adagrad on each page's log-likelihood."""
    names: dict = {}
    coded = [([np.array([names.setdefault(f, len(names)) for f in sorted(features)]) for features, _ in page], np.array([label for _, label in page])) for page in pages if page]
    field = Field(names, np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2))
    spent = [np.full(w.shape, 1e-3) for w in (field.emission, field.transition, field.first)]
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for number in random.permutation(len(coded)):
            rows, labels = coded[number]
            flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            scores = np.zeros((len(rows), 2))
            np.add.at(scores, owner, field.emission[flat])
            single, pairs = _marginals(scores, field)
            gap = -single
            gap[np.arange(len(labels)), labels] += 1
            slope = np.zeros_like(field.emission)
            np.add.at(slope, flat, gap[owner])
            truth = np.zeros((2, 2))
            np.add.at(truth, (labels[:-1], labels[1:]), 1)
            for weights, own, used in zip((field.emission, field.transition, field.first), (slope - decay * field.emission, truth - pairs, gap[0]), spent):
                used += own**2
                weights += rate * own / np.sqrt(used)
    return field


def labelled_page(random: np.random.Generator) -> list:
    """One page of a made-up layout as (markup, label) pieces: what is a block's text has label 0 or 1, markup None."""
    pick = lambda *options: options[random.integers(len(options))]
    syllables = "an the re on st ing ou er ment que la de un ich ver os ar ña ci zu é".split()
    word = lambda: "".join(syllables[i] for i in random.integers(len(syllables), size=random.integers(1, 5)))
    words = lambda low, high: " ".join(word() for _ in range(random.integers(low, high)))
    sentence = lambda low=3, high=25: words(low, high).capitalize() + pick(".", ".", ".", "!", "?", "")
    chance = lambda p: random.random() < p
    plain = chance(0.4)  # no landmark elements, only classes
    out: list = []

    def element(tag, attributes, inner):
        out.append((f"<{tag}{' ' + attributes if attributes else ''}>", None))
        inner()
        if tag not in ("p", "li") or chance(0.8):
            out.append((f"</{tag}>", None))

    def said(text, label, tag="p", attributes=""):
        element(tag, attributes, lambda: out.append((text, label)))

    def links(low=2, high=9):
        def items():
            for _ in range(random.integers(low, high)):
                said(f'<a href="/{word()}">{words(1, 4)}</a>', 0, "li")

        element(pick("ul", "ul", "ol"), "", items)

    def named(semantic, *classes):
        """An element of a landmark tag, or a div that only its class or id tells."""
        css = f'{pick("class", "class", "id")}="{pick(*classes)}{pick("", "", "-" + word())}"'
        return ("div" if plain or not semantic else semantic, css if plain or not semantic or chance(0.5) else "")

    def menu():
        element(*named("nav", "nav", "menu", "main-menu", "navbar", "breadcrumbs"), links)

    def header():
        def inner():
            if chance(0.7):
                said(words(1, 4), 0, pick("h1", "div", "p", "span"), pick("", 'class="logo"', 'class="site-title"'))
            if chance(0.6):
                menu()
            if chance(0.4):
                said(sentence(), 0)

        element(*named("header", "header", "site-header", "masthead", "top-banner"), inner)

    def footer():
        def inner():
            said(pick("&copy; ", "Copyright ", "© 2024 ", "") + words(1, 5) + pick(" &middot; ", ". ", " | ") + sentence(), 0, pick("p", "div", "span"))
            if chance(0.5):
                links()
            if chance(0.3):
                said(sentence(8, 40), 0)

        if chance(0.4) and not plain:
            said("&copy; " + word() + ".example.com &middot; " + sentence(), 0, "footer")
        else:
            element(*named("footer", "footer", "site-footer", "copyright", "colophon"), inner)

    def advert():
        said(pick("", "Advertisement: ") + sentence(3, 30), 0, pick("div", "div", "p", "section", "aside"), f'{pick("class", "class", "id")}="{pick("ad", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot")}"')

    def notice():
        said(pick("We use cookies. ", "", "") + sentence(5, 30), 0, pick("div", "section", "p"), f'{pick("class", "id")}="{pick("cookie", "cookie-notice", "cookie-banner", "consent", "notice", "alert", "gdpr", "popup")}"')

    def form():
        def inner():
            said(pick("Subscribe to our newsletter ", "Search ", "") + words(1, 8), 0, pick("label", "p", "div", "h3"))
            out.append(('<input type="text">', None))
            said(words(1, 3), 0, "button")

        element("form", pick("", 'class="newsletter"', 'id="search"'), inner)

    def aside():
        def inner():
            said(words(1, 4), 0, pick("h2", "h3", "h4"))
            if chance(0.6):
                links()
            for _ in range(random.integers(0, 3)):
                said(sentence(5, 40), 0)

        element(*named("aside", "sidebar", "side-bar", "widget", "related", "recommended"), inner)

    def comments():
        def one():
            if chance(0.7):
                said(words(1, 3) + pick("", " says", " wrote:"), 0, pick("h4", "span", "cite", "div"), 'class="author"')
            for _ in range(random.integers(1, 3)):
                said(sentence(5, 60), 0, pick("p", "p", "div"))

        def inner():
            if chance(0.7):
                said(pick("Comments", "3 comments", words(1, 3)), 0, pick("h2", "h3"))
            for _ in range(random.integers(1, 6)):
                element(pick("div", "li", "article", "section"), f'class="{pick("comment", "reply", "comment-body", "review")}"', one)
            if chance(0.3):
                form()

        element(pick("section", "div", "ol", "aside"), f'{pick("class", "id")}="{pick("comments", "comments", "discussion", "disqus_thread", "reader-comments", "replies")}"', inner)

    def paragraph():
        kind = random.random()
        if kind < 0.62:
            text = " ".join(sentence() for _ in range(random.integers(1, 6)))
            lead = chance(0.15)
            said(("<b>" if lead else "") + text + ("<br>" if lead else ""), 1, "p")
        elif kind < 0.72:
            said(sentence(1, 5), 1, "p")
        elif kind < 0.8:
            said(words(1, 8), 1, pick("h2", "h3"))
        elif kind < 0.86:
            element(pick("ul", "ol"), "", lambda: [said(sentence(2, 15), 1, "li") for _ in range(random.integers(2, 6))])
        elif kind < 0.9:
            element("blockquote", "", lambda: said(sentence(5, 40), 1, "p"))
        elif kind < 0.93:
            said(" ".join(sentence() for _ in range(3)) + f' <a href="/x">{words(1, 3)}</a> ' + sentence(), 1, "p")
        elif kind < 0.95:
            element("table", "", lambda: element("tr", "", lambda: [said(words(1, 3), 1, "td") for _ in range(3)]))
        elif kind < 0.97:
            element("figure", "", lambda: said(sentence(3, 12), 1, "figcaption"))
        else:
            said(sentence(3, 30), 1, pick("pre", "div", "section"))

    def article():
        def inner():
            if chance(0.9):
                title = lambda: said(words(2, 12) + pick("", ".", "%%%"), 1, pick("h1", "h1", "h2"))
                element("header", "", title) if chance(0.15) and not plain else title()
            for _ in range(random.integers(1, 14)):
                paragraph()
                if chance(0.06):
                    advert()
                if chance(0.03):
                    form()
                if chance(0.03):
                    aside()
                if chance(0.03):
                    said(f'<a href="/s">{words(1, 2)}</a>', 0, "div", f'class="{pick("share", "social", "share-buttons")}"')
            if chance(0.25):
                comments()

        tag, css = named(pick("article", "article", "main"), "article", "content", "post", "entry-content", "main-content", "story-body", "post-body")
        if chance(0.3):
            element(pick("main", "div"), pick("", 'id="content"', 'class="container"'), lambda: element(tag, css, inner))
        else:
            element(tag, css, inner)

    out.append(("<body>", None))
    for part, p in ((notice, 0.25), (header, 0.6), (menu, 0.6), (advert, 0.5), (form, 0.15), (aside, 0.25)):
        if chance(p):
            part()
    article()
    for part, p in ((advert, 0.2), (aside, 0.3), (comments, 0.35), (form, 0.2), (notice, 0.15), (menu, 0.15), (footer, 0.85)):
        if chance(p):
            part()
    out.append(("</body>", None))
    return out


TRAINING_PAGES = 500  # bound of the training set, made anew where it is needed


def labelled_blocks(pieces: list) -> list:
    """Blocks of a labelled page with their labels; texts are marked by position so that the parser's blocks can be told."""
    texts = {" ".join(html.unescape(re.sub(r"<[^>]*>", " ", piece)).split()): label for piece, label in pieces if label is not None}
    found = blocks("".join(piece for piece, _ in pieces))
    return [(text, path, linked, texts.get(text, 0)) for text, path, linked in found]


def trained_field(pages: int = TRAINING_PAGES, seed: int = 3) -> Field:
    """The field of so many labelled pages; the same on every call."""
    random = np.random.default_rng(seed)
    examples = []
    for _ in range(pages):
        page = labelled_blocks(labelled_page(random))
        examples.append([(path_features(path) | set(text_features(text, linked)), label) for text, path, linked, label in page])
    return train(examples)


def main_text(page: str | None, field: Field, seen: dict) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    labels = field.decode(field.scores(found, seen))
    return " ".join(text for (text, *_), label in zip(found, labels) if label)


def extract(pages: DataFrame, field: Field | None = None, html_col: str = "html", into: str = "text") -> DataFrame:
    """All columns of pages and the main text (an own column of that name is replaced).

    A null or empty page, or one without any block of the article, gives an empty text. Every row comes back,
    repeated ones too, with the whole text however long the page is; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or trained_field())  # a few hundred weights

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        seen: dict = {}
        return pd.Series([main_text(page, shared.value, seen) for page in column], dtype=object)

    kept = [c for c in pages.columns if c != into]
    return pages.select(*kept, texts(F.col(html_col)).alias(into))
