from __future__ import annotations

import pytest

from gridmargin.llm.style_tree import main_text, parse

STORY = "<p>" + "Long story of many words. " * 5 + "</p>"
TEXT = " ".join(["Long story of many words."] * 5)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (f"<article style='overflow: hidden'>{STORY}</article>", TEXT),
        (f"<div title='hidden gems'>{STORY}</div>", TEXT),
        (f"<article class='content has-sidebar'>{STORY}</article>", TEXT),
        (f"<main id='share-prices-fall'>{STORY}</main>", TEXT),
        (f"<article class='post legal'>{STORY}</article>", TEXT),
        (f"<body class='no-sidebar search'>{STORY}</body>", TEXT),
        (f"<div class='page modal'>{STORY}<div class='share'>Like</div></div>", TEXT),
        (f"<form>{STORY}</form>", TEXT),
        (f"{STORY}<div style='color:red; display : none'>x</div><p HIDDEN>y</p>", TEXT),
        (f"<div>{STORY}</div><div class='comments'><article><p>I agree</p></article></div>", TEXT),
        (f"<div>{STORY}</div><ol class='comment-list'><article>{STORY}{STORY}</article></ol>", TEXT),
        (f"<div>{STORY}</div><aside><article>Teaser</article></aside>", TEXT),
    ],
)
def test_names_do_not_drop_the_main_text(source, text):
    assert main_text(parse(source), {}) == text
