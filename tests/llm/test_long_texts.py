"""Time and memory grow in proportion to one text, whatever is in it."""

from __future__ import annotations

import time

import pytest

from quillwork.llm import html_crf, secrets


@pytest.mark.parametrize("unit", ["-----BEGIN PRIVATE KEY-----\n", "-----BEGIN PRIVATE KEY-----\nAAAA\n-----END RSA PRIVATE KEY-----\n", "-----END PRIVATE KEY-----", "----- BEGIN A", "A" * 64 + "\n", "ey.", "token "])
def test_secrets_in_a_long_text(unit):
    began = time.process_time()
    secrets.find_secrets(unit * (2_000_000 // len(unit)))
    assert time.process_time() - began < 20


@pytest.mark.parametrize("unit", ["<a ", "<a \"", "<a '\"", "<div>x", "<b>", "<b><hr>", "<! ", "</script ", "<script ", "<li><ul>x", "<p><b>", "</div>", "<td><tr>x", "<a href='x' <b \"y\" "])
def test_blocks_of_a_long_page(unit):
    model = html_crf.ChainField({}, __import__("numpy").zeros((2, 2)), __import__("numpy").zeros(2))
    began = time.process_time()
    model.extract("<ul><li>" + unit * (1_000_000 // len(unit)) + "x")
    assert time.process_time() - began < 20


def test_blocks_after_unclosed_and_odd_tags():
    text = lambda h: [b.text() for b in html_crf.leaf_blocks(h)]
    assert text("<p class=\"a<p>one</p><p>two") == ["one", "two"] or text("<p class=\"a<p>one</p><p>two")[-1] == "two"
    assert text("<div title='>'>in</div><table><tr><td>a<tr><td>b</table><ul><li>c<li>d") == ["in", "a", "b", "c", "d"]
    assert text("a <b>c</b> <a href=x>d</a><div>e") == ["a c d", "e"]
    assert text("x<!-- > --><script>no</script ><style>no</style>y<?php no ?>z") == ["xyz"]
