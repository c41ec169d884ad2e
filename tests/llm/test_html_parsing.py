"""The page parser: paths share their ancestors, and its work grows with the page alone."""

import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelworks.llm import html_extract

_TAG = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a<>\"' ", max_size=40))
def test_tag_ends(page):
    ends = html_extract._TagEnds(page)
    for at in range(len(page)):
        found = _TAG.match(page, at)
        assert ends.after(at) == (found.end() - 1 if found else -1)


def test_paths_and_vectors():
    page = '<div class="main x"><p>one</p><div class="x side"><ul><li>two<li>three</ul></div><table><tr><td>four</table>'
    found = html_extract.blocks(page)
    assert [(text, tuple(path)) for text, path, _ in found] == [
        ("one", ("div", ".main", ".x", "p")),
        ("two", ("div", ".main", ".x", "div", ".x", ".side", "ul", "li")),
        ("three", ("div", ".main", ".x", "div", ".x", ".side", "ul", "li")),
        ("four", ("div", ".main", ".x", "table", "tr", "td")),
    ]
    for _, path, _ in found:
        want = np.zeros(html_extract.PATH_DIM, np.float32)
        for name in set(path):
            at, sign = html_extract._slot(name, html_extract.PATH_DIM)
            want[at] += sign
        assert np.array_equal(path.vector, want) and len(path) == len(tuple(path))


@pytest.mark.parametrize("make", [
    lambda n: "<div>x" * n, lambda n: "a <b c " * n, lambda n: "<div>" * n + "<li>x" * n, lambda n: "<a 'x " * n + '"',
    lambda n: "<! " * n, lambda n: "<div>x</p>" * n, lambda n: "<p><b>" * n, lambda n: "<iframe>" * n, lambda n: "<svg><select><option>" * n,
])
def test_bad_pages_take_time_in_proportion(make):
    took = []
    for n in (3000, 24000):
        began = time.process_time()
        html_extract.vectors(html_extract.blocks(make(n)))
        took.append(time.process_time() - began)
    assert took[1] < 30 * max(took[0], 0.02)  # eight times the page; a square would be 64 times the work
