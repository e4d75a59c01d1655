"""Pages of unclosed or repeated tags take time in proportion to their length, with the patterns' results."""

import random
import re
import time

import pytest

from shelfcast.llm import warc


def by_patterns(html):
    """The same steps as plain regular expressions over the whole text."""
    text = re.sub("[\r\n]+", " ", html)
    for pattern in (warc.COMMENT, *map(warc.hidden, warc.HIDDEN)):
        text = re.sub(pattern, "", text, flags=re.ASCII)
    text = re.sub("<[^>]*>", "", re.sub(warc.LINE_TAG, "\n", text, flags=re.ASCII))
    return warc.tidy(warc.decoded(text))


PIECES = [
    "<", ">", "<!--", "-->", "<script", "<script>", "</script", "</SCRIPT >", "<style x>", "</style>", "<p", "<P class=x>",
    "</p>", "<a ", "<a href=", '"', "'", "href = ", "/x", " ", "\n", "word", "&amp;", "&#65;", "&lt", "<title>", "</title>", "<br/>",
]
LINK = r"""(?i)<a[ \t\r\n][^>]*?href[ \t\r\n]*=[ \t\r\n]*("[^">]*"|'[^'>]*'|[^ \t\r\n"'>]+)"""


@pytest.mark.parametrize("seed", range(5))
def test_equal_to_plain_patterns(seed):
    rng = random.Random(seed)
    for _ in range(2000):
        html = "".join(rng.choices(PIECES, k=rng.randint(1, 30)))
        assert warc.page_text(html) == by_patterns(html)
        links = [re.sub(r"(?s)^([\"'])(.*)\1$", r"\2", u) for u in re.findall(LINK, html, flags=re.ASCII)]
        assert warc.page_links(html) == [re.sub("[\r\n]+", " ", u) for u in links]
        title = re.search(warc.TITLE, html, flags=re.ASCII)
        assert warc.page_title(html) == (re.sub("[\r\n]+", " ", warc.tidy(warc.decoded(title[1]))) if title else "")


@pytest.mark.parametrize("piece", ["<", "<script>", "<script ", "<!--", "<a href ", "<a ", "<title", "<p ", "&", "</script", "<a href=\""])
def test_a_megabyte_of_one_piece(piece):
    html = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    warc.page_text(html), warc.page_links(html), warc.page_title(html)
    assert time.perf_counter() - start < 5
