"""Markup after which the rest of the page must not be lost."""

from html.parser import HTMLParser

import numpy as np
import pytest

from arborflow.llm import html_text


@pytest.mark.parametrize(
    "start",
    [
        "<p><svg-icon></svg-icon>icon</p>",
        "<video-player src=x></video-player>",
        "<select-box>",
        "<p>a <svg viewBox='0 0 1 1'/> b</p>",
        "<p>a <math/> b</p>",
        "<div><object data=x>fallback</div>",
        "<video src=x>",
        "<canvas id=c>",
        "<head><title>t</title><meta charset=utf-8><script>if (a < b) '<p>no</p>'</script>",
        "<p title=it's>one</p>",
        "<a title=\"a > b\" href=x>link</a>",
        "<!--><p>after an abrupt comment</p>",
        "<!---><p>after another</p>",
        "<!----><!-- a > b -- c --!><!-- <p>no</p> -->",
    ],
)
def test_rest_of_the_page_stays(start):
    texts = [text for text, *_ in html_text.blocks(start + "<p>First it's here.</p><p>Last.</p>")]
    assert texts[-2:] == ["First it's here.", "Last."] and "no" not in texts


def test_skipped_elements_stay_skipped():
    page = "<head><title>t</title></head><svg><text>no</text></svg><script>'<p>no</p>'</script><video><p>no</p></video><p>Yes.</p>"
    assert [text for text, *_ in html_text.blocks(page)] == ["Yes."]


@pytest.mark.parametrize("inside", ["<img src=x>", "<input type=checkbox>", "<button>", "</button>", "<wbr>", "<script>'<p>no</p>'</script>", "<!-- no -->", "<svg><text>no</text></svg>", "<noscript>no</noscript>", "<picture><source></picture>", "<video><p>no</p></video>", "<link><meta>"])
def test_phrasing_elements_stay_in_their_sentence(inside):
    assert [t for t, *_ in html_text.blocks(f"<p>one{inside}two</p><p>three</p>")] == ["onetwo", "three"]


def test_no_feature_sees_a_prefix_only():
    long = "word " * 100
    assert "phrase" in html_text.text_features(long + "please subscribe", 0) and "digits" in html_text.text_features("x" * 100 + "1" * 100, 0)


class Reader(HTMLParser):
    """Blocks as another parser sees them: any tag that is no phrasing element ends one."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.found, self.pieces, self.skipped = [], [], 0
        self.feed(page)
        self.close()
        self.end()

    def end(self):
        text = " ".join("".join(self.pieces).split())
        self.found += [text] if text else []
        self.pieces = []

    def handle_starttag(self, tag, attributes):
        if tag in SKIPPED:
            self.skipped += 1
        elif tag == "br":
            self.pieces.append(" ")
        elif tag not in html_text.INLINE and not self.skipped:
            self.end()

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skipped -= 1
        elif tag not in html_text.INLINE and tag != "br" and not self.skipped:
            self.end()

    def handle_data(self, data):
        self.pieces.append("" if self.skipped else data)


SKIPPED = frozenset("script style noscript template svg iframe head textarea select object canvas math audio video".split())


def test_blocks_equal_another_parsers(spark, sf):
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect() if r.html]
    random = np.random.default_rng(9)
    pages += ["".join(piece for piece, _ in html_text.labelled_page(random)) for _ in range(300)]
    parts = ["<p>", "</p>", "<div class='a > b'>", "</div>", "a &amp; b", " ", "é&nbsp;x", "<b>", "</b>", "<br>", "<img src=\"x\">", "<!-- <p> -->", "<script>if (a < b) '</p>'</script>", "<h2 id=x>", "</h2>", "<ul><li>", "</ul>", "&#x41;&lt;", "<svg><g></g></svg>", "<button type=button>", "</button>"]
    pages += ["".join(parts[i] for i in random.integers(len(parts), size=30)) for _ in range(500)]
    for page in pages:
        assert [t for t, *_ in html_text.blocks(page)] == Reader(page).found, page
