"""Pages whose markup misleads, and pages without markup that tells."""

import random
import re
import time

import pytest

from gridmill.llm import extraction
from gridmill.llm.extraction import main_text

P = "This is a paragraph of the article, long enough to be told as text by anyone who reads."


def test_form_around_the_page():
    assert main_text(f'<body><form id="aspnetForm"><div class="nav">Home</div><article><h1>T</h1><p>{P}</p></article></form></body>') == f"T\n{P}"
    assert main_text(f'<body><form id="f"><nav>Home</nav><div><h1>Title here</h1><p>{P}</p><p>{P}</p></div></form></body>') == f"Title here\n{P}\n{P}"


def test_forms_within_an_article_go():
    form = "<form><label>Name</label><p>Leave a reply to us, please, and do it now.</p></form>"
    assert main_text(f"<article><p>{P}</p>{form}</article>") == P
    assert main_text(f"<main><form id='page'><article><p>{P}</p>{form}</article></form></main>") == P
    # More text than the article has, and still a form of it.
    assert main_text(f"<article><p>{P}</p><form><p>{P}</p><p>{P}</p><p>{P}</p></form></article>") == P


def test_sections_of_an_article_are_text():
    page = (f'<article><p>{P}</p><section class="related-work"><h2>Related work</h2><p>{P}</p></section>'
            f'<section id="discussion"><h2>Discussion of it</h2><p>{P}</p></section></article>')
    assert main_text(page) == f"{P}\nRelated work\n{P}\nDiscussion of it\n{P}"


def test_boilerplate_of_an_article_is_not():
    links = "".join(f'<li><a href="{i}">Another story {i}</a></li>' for i in range(4))
    for side in (f'<section class="related"><ul>{links}</ul></section>', f'<div class="related"><p>{P}</p></div>',
                 f'<section class="comments"><p>{P}</p></section>', f'<section class="newsletter"><p>{P}</p></section>'):
        assert main_text(f"<article><p>{P}</p>{side}</article>") == P


def test_short_page_without_an_article():
    page = ("<body><nav>Home About</nav><h2>A heading</h2><p>This is the first of two paragraphs that a page without any article element has in it.</p>"
            "<p>And this is the second one of these two, a bit shorter.</p><p>Short third one.</p><footer>c</footer></body>")
    assert main_text(page).split("\n")[0] == "A heading" and len(main_text(page).split("\n")) == 4


@pytest.mark.parametrize("piece", ["<a ", '<a href="x ', "<a '\"", "<", "<p", "<!", "</a ", "<script ", "<b class='"])
def test_unclosed_tags_take_no_longer_than_others(piece):
    began = time.process_time()
    main_text(piece * ((1 << 20) // len(piece)))
    assert time.process_time() - began < 4  # a second as a rule


@pytest.mark.parametrize("seed", range(40))
def test_tags_end_where_the_plain_pattern_says(seed):
    """Both ways of finding a tag's end agree with a pattern that tries everything."""
    rng = random.Random(seed)
    page = "".join(rng.choice(["<a ", ">", '"', "'", " x", "<b", "y>"]) for _ in range(60))
    plain = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
    ends = extraction.TagEnds(page, 0)
    for at in range(len(page)):
        m = plain.match(page, at)
        assert ends.after(at) == (m.end() - 1 if m else -1)
        n = extraction._REST.match(page, at)
        assert (n and n.end()) == (m and m.end())
