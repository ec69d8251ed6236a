"""Boxes that the page's own display and white-space rules make."""

import pytest

from cohortlens.llm.html_layout import render

CASES = {
    "blocks from spans": ('<span style="display:block">one</span><span style="display:block">two</span>', "one\ntwo"),
    "menu of block links": ("<style>.r{display:block}</style><a class=r>Home</a><a class=r>News</a>", "Home\nNews"),
    "flex items stand apart": ("<nav style='display:flex'><a>Home</a><a>News</a></nav>end", "Home News\nend"),
    "grid of blocks": ("<div style='display: grid'><div>a</div><div>b</div></div>", "a\nb"),
    "inline paragraphs": ("<p style='display:inline'>a</p><p style='display:inline'>b</p>c", "abc"),
    "inline items have no marker": ("<ul><li style='display:inline'>a </li><li style='display:inline'>b</li></ul>", "a b"),
    "block items have no marker": ("<ul><li style='display:block'>a</li><li>b</li></ul>", "a\n- b"),
    "numbers skip boxes that are no items": ("<ol><li>a</li><li style='display:block'>x</li><li>b</li></ol>", "1. a\nx\n2. b"),
    "cells of styled tables": ("<div style='display:table'><div style='display:table-row'><i style='display:table-cell'>a</i><i style='display:table-cell'>b</i></div></div>", "a b"),
    "columns are not shown": ("<div style='display:table-column'>x</div>a", "a"),
    "fields stand apart": ("<label>Name</label><input value=v><button>Go</button>on", "Name v Go on"),
    "contents has no box": ("<div style='display:contents'>a</div>b", "ab"),
    "blockquote shown inline": ("x <blockquote style='display:inline'>a</blockquote> y", "x a y"),
    "white space kept": ("<p style='white-space:pre'>a  b\n  c</p>", "a  b\n  c"),
    "white space kept inline": ("x <code style='white-space:pre-wrap'>a  b</code> y", "x a  b y"),
    "lines kept": ("<div style='white-space: pre-line'>a   b\n   c</div>", "a b\nc"),
    "pre that wraps like text": ("<pre style='white-space:normal'>a\n  b</pre>", "a b"),
    "cells keep white space": ("<table><tr><td style='white-space:pre'>a  b</td><td>c</td></tr></table>", "a  b  c"),
    "unknown values change nothing": ("<p style='display:banana;white-space:odd'>a</p><p>b</p>", "a\n\nb"),
    "variables change nothing": ("<p style='display:var(--x)'>a</p><p>b</p>", "a\n\nb"),
}


@pytest.mark.parametrize("case", CASES)
def test_boxes_follow_the_rules_of_the_page(case):
    page, text = CASES[case]
    assert render(page) == text
