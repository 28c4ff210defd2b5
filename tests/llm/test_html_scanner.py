import random
import time

import pytest

from ratewise.llm.html import parse


def texts(html):
    return [t for _, t in parse(html)[1]]


@pytest.mark.parametrize("part", ["<a", "<", "<a ", "<a x=", "<a x='", "<!", "<script", "<p x=\"y\" ", "</", "<a =\"'"])
def test_hostile_pages_are_scanned_once(part):
    start = time.time()
    parse(part * (1_000_000 // len(part)))
    parse("<p>" + part * (300_000 // len(part)) + ">end")
    assert time.time() - start < 5


def test_quotes_count_after_an_equals_sign_only():
    assert texts("<p class=it's>One two three.</p><p>Three isn't here</p>") == ["One two three.", "Three isn't here"]
    assert texts('<p title="oops>alpha</p><p>beta</p>') == ["alpha", "beta"]
    assert texts('<p title="a > b" id = \'c > d\'>alpha</p>') == ["alpha"]
    assert texts('<p "quoted" >alpha <b>beta</b>') == ["alpha beta"]


def test_text_of_embedded_elements_stays():
    assert texts("<p>a <math>x</math> <object>b</object><svg>c</svg> <video>d</video></p>") == ["a x bc d"]
    assert texts("<p>a</p><script>x</p></script><style>y</style><template>z</template><svg-icon>b</svg-icon>") == ["a", "b"]


def test_a_page_cut_anywhere_is_read():
    rng = random.Random(3)
    page = '<div class="a"><!-- x --><p id=\'b\'>Some &amp; text</p><script>var a = "<p>";</script><a href=x>link</a></div>'
    for _ in range(200):
        i, j = sorted(rng.randrange(len(page)) for _ in range(2))
        parse(page[i:j])
    assert texts(page) == ["Some & text", "link"]
