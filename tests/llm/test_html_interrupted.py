import pytest

from vitrine.llm.html_extract import main_text

ADVERT = '<div class="advert"><p>Buy now</p><p>Only today</p><p>Click here</p><p>Hurry</p></div>'
LONG = "A sentence of the article that says something of use. " * 12


@pytest.mark.parametrize("short", [["The closing paragraph ends what was said above and names where one may read more on it."],
                                   ["Short middle.", "The closing paragraph ends what was said above and names where one may read more on it."]])
def test_interrupted_article_keeps_its_short_parts(short):
    page = "<html><body><div>" + f"<p>{LONG}</p>" + "".join(f"{ADVERT}<p>{x}</p>" for x in short) + "</div></body></html>"
    assert main_text(page).split("\n") == [LONG.strip(), *short]


def page(*blocks):
    return "<html><body><div>" + "".join(blocks) + "</div></body></html>"


@pytest.mark.parametrize("lead", [["Title"], ["Title", "A first paragraph of some thirty letters"], ["T", "By A", "One.", "Two.", "Three.", "Four."]])
def test_short_first_and_last_paragraphs_of_unmarked_pages_stay(lead):
    tail = ["So it ends.", "Yes.", "The author", "lives there.", "Fin."]
    text = main_text(page("<nav><a>Home</a></nav>", *[f"<p>{x}</p>" for x in lead], f"<p>{LONG}</p>", *[f"<p>{x}</p>" for x in tail], "<footer>f</footer>"))
    assert text.split("\n") == [*lead, LONG.strip(), *tail]


def test_the_window_decides_what_belongs_to_the_text():
    """Two link lines part a short line from the article: they are a dive for windows up to two
    lines, and a gap inside the text for wider ones; four link lines are a dive for three."""
    link = "<p><a href=x>elsewhere on this site</a></p>"
    near, far = page("<p>Short.</p>", link * 2, f"<p>{LONG}</p>"), page("<p>Short.</p>", link * 4, f"<p>{LONG}</p>")
    for window, want in ((1, [LONG.strip()]), (2, [LONG.strip()]), (3, ["Short.", LONG.strip()])):
        assert main_text(near, window).split("\n") == want
    assert main_text(far, 3) == LONG.strip() and main_text(far, 5).split("\n") == ["Short.", LONG.strip()]


def test_formulas_are_text():
    assert main_text("<article><p>So <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds.</p><math><mn>1</mn><mo>&lt;</mo><mn>3</mn></math></article>") == "So a=2 holds.\n1<3"
