"""Tags of many thousand characters, thousands of open elements, and both in linear time."""

from __future__ import annotations

import time

import pytest

from tidemark.llm import html_text


@pytest.mark.parametrize("size", [100, 5000, 200_000])
def test_long_tags_are_read_whole(size):
    page = f"<article><p data-x='{'k' * size} <b>bold</b> tail' class=\"comment\">Text</p><p>More</p></article>"
    assert [b[0] for b in html_text.blocks(page)] == ["Text", "More"]
    assert [b[3] for b in html_text.blocks(page)] == [1, 0]


def test_signs_in_values_and_open_quotes():
    def texts(page):
        return [b[0] for b in html_text.blocks(page)]

    assert texts('<p title="a > b" alt=it\'s>One</p><p>don\'t</p>') == ["One", "don't"]
    assert texts("<p title='a>One</p><p>Two</p>") == ["One", "Two"]
    assert texts('<p title = "x>y"class=z>One</p>') == ["One"]


def test_deep_elements_keep_their_role():
    page = "<article><p>Before</p>" + "<div>" * 6000 + "<aside><p>Aside</p></aside><p>Inner</p>" + "</div>" * 6000 + "<p>After</p></article>"
    found = {b[0]: b[3:] for b in html_text.blocks(page)}
    assert found == {"Before": (0, 1), "Aside": (1, 1), "Inner": (0, 1), "After": (0, 1)}


@pytest.mark.parametrize("page", ['<a x=">"' * 100_000 + "<i y='" + ">", "<b>" * 200_000 + "</i>" * 200_000, "<p a='" * 100_000 + ">", "<a x='\">'" * 100_000])
def test_linear_in_odd_pages(page):
    start = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - start < 10
