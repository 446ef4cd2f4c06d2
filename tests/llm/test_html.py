"""Pages that are long, deep or broken, and names that don't condemn what they stand on."""

import time

import pytest

from faremill.llm import html_blocks, html_extract


def _timed(html):
    """Quadratic readers take minutes on these pages."""
    start = time.perf_counter()
    blocks = html_blocks.blocks_of(html)
    assert time.perf_counter() - start < 8
    return blocks


@pytest.mark.parametrize(
    "unit", ["<b ", "<b \"> \"", "<!", "<? ", "</", "<a href='x' ", "<script>a</script ", "&amp;<", "</b>", "<b x=\">"]
)
def test_a_megabyte_of_broken_tags_takes_linear_time(unit):
    assert "end" in " ".join(b.text for b in _timed("<p>start</p>" + unit * (1_000_000 // len(unit)) + "'>\n<p>end")) or unit == "<script>a</script "


@pytest.mark.parametrize("tag", ["div", "div class=ad", "b", "h3", "p", "ul><li"])
def test_fifty_thousand_nested_elements(tag):
    html = "<body>" + f"<{tag}>word " * 50_000 + "</i></div>" * 50_000 + "<p>end"
    assert _timed(html) and len(html_extract._ballots(html)) <= html_extract.VOTES


def test_paths_leave_out_optional_tags():
    with_, without = "<html><body><table><tbody><tr><td>x</table>", "<table><tr><td>x</table>"
    assert html_blocks.blocks_of(with_) == html_blocks.blocks_of(without)


def test_paragraphs_of_an_article_are_not_condemned_by_name():
    page = "<article><p class='teaser'>The lead.</p><p class='market-share'>Shares rose.</p><p class='share'><a href=x>Share this</a></p></article>"
    assert [b.text for b in html_blocks.blocks_of(page)] == ["The lead.", "Shares rose."]
    assert html_blocks.blocks_of("<div><p class='cookie-notice'>We use cookies</p></div><article>x</article>")[0].text == "x"
