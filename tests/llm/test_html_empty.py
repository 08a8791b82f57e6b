"""Self-closed svg and math tags are empty elements."""

from __future__ import annotations

from rivernet.llm import html_text


def test_text_after_an_empty_svg_or_math_stays():
    def texts(page):
        return [b.text for b in html_text.blocks(page)]
    assert texts("<p>One</p><svg class='i>c' width=\"1\"/><p>two</p><MATH /><p>three</p><svg/>four") == ["One", "two", "three", "four"]
    assert texts("<p>One</p><svg/><p>two</p><svg><text>no</text></svg><p>three</p>") == ["One", "two", "three"]
    assert texts("<svg a='/'><path d='M0'/><p>no</p></svg><p>yes</p><svg><p>to the end") == ["yes"]
    assert texts("<script src='x'/>no</script><p>yes</p>") == ["yes"]  # only svg and math can be empty
