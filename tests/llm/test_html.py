"""Main texts written by hand, of pages that name their parts, misname them or not at all."""

import random

import pytest

pytest.importorskip("tarnfold.llm")

from tarnfold.llm import templates

WORDS = "ba be bi bo bu da de di do du ka ke ki ko ku".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(n))


def site(body, n, rng=None):
    """Pages with menus and footers about a body, which has its page's text for ``{}``; and these texts."""
    rng = rng or random.Random(n)
    own = [f"{prose(rng, 30)} {i}" for i in range(n)]
    frame = '<!DOCTYPE html><html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>{}<aside>Side</aside><footer>&copy; x</footer></body></html>'
    return [frame.format(body.replace("{}", t)) for t in own], own


#: What stands in an article, and what is to come of it; ``{}`` is the page's own text.
KEPT = [
    ("<h2>References</h2><p>{}</p>", "References {}"),
    ("<p>{}</p><p>This text is licensed under CC BY.</p>", "{} This text is licensed under CC BY."),
    ("<p>one {}<br>two</p>", "one {} two"),
    ('<section id="related-work"><h2>Related work</h2><p>{}</p></section>', "Related work {}"),
    ('<table class="search-results"><tr><td>{}</td><td>cell</td></tr></table>', "{} cell"),
    ('<ul class="dinner-menu"><li>{}</li><li>soup</li></ul>', "{} soup"),
    ('<div id="form-of-the-poem">{}</div>', "{}"),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, {}</p>", "Let x=1, {}"),
    ('<p>{} <object data="x"><em>instead</em></object></p>', "{} instead"),
    ('<p class="first intro">{}</p><p title="a hidden thing">end</p>', "{} end"),
    ('<header><h1>{}</h1></header><p style="color:red">end</p>', "{} end"),
    ("<blockquote>{}<p>cited</blockquote><dl><dt>term<dd>said</dl>", "{} cited term said"),
]
DROPPED = [
    ('<p>{}</p><p class="advert">Buy {}</p>', "{}"),
    ('<p>{}</p><p class="advert">Buy {}<p>end', "{} end"),
    ('<p class="comment">Me {} too</p><p>{}</p>', "{}"),
    ('<p>one <span class="ad">buy <b>it</b> <span>now</span></span> two {}</p>', "one two {}"),
    ('<div class="promoBox"><p>{}</p></div><p>{}</p>', "{}"),
    ("<div hidden>{}</div><p hidden>{}</p><p>{}</p>", "{}"),
    ('<p>{}</p><div style="x:y; display: none">{}</div><span aria-hidden="true">icon</span>', "{}"),
    ('<ul><li>{}<li class="ad">buy<li>end</ul>', "{} end"),
    ('<ul class="comment-list"><li class="comment"><p>{}</p></li></ul><p>{}</p>', "{}"),
    ('<div><p>{}</p><p class="ads">x</div><p>end</p>', "{} end"),
    ('<table><tr><td>{}<td class="ad-300x250">x<td>end</table>', "{} end"),
    ('<p>{}</p><form>send {}</form><div class="newsletter-signup">{}</div><nav>{}</nav>', "{}"),
    ('<p>{} <math><mi>x</mi><annotation encoding="t">\\x</annotation></math></p><script>var x="{}"</script>', "{} x"),
]


@pytest.mark.parametrize("n", [1, 4, 5, 12])
@pytest.mark.parametrize(("body", "text"), KEPT + DROPPED)
def test_articles(body, text, n):
    pages, own = site(f"<article>{body}</article>", n)
    assert templates.extract(pages) == [text.replace("{}", t) for t in own]


def misnamed_site(rng, n):
    """Pages of which the box named as main has one line, and the text is in boxes whose names say nothing."""
    pages, texts = [], []
    for i in range(n):
        body = [prose(rng, rng.randint(20, 70)) for _ in range(rng.randint(2, 5))]
        head = f'<div class="main"><p>{prose(rng, 2)}</p></div>'
        inner = "".join(f"<p>{b}</p>" for b in body)
        text = f'<div class="x7"><div class="h">Part {i}</div>{inner}<div class="q2">Get our letter <ul><li>daily<li>weekly</ul></div></div>'
        menu = "".join(f"<li>{prose(rng, 1)}" for _ in range(rng.randint(1, 4)))
        pages.append(f'<html><body><ul class="x1">{menu}</ul>{head}{text}<div class="x9">{prose(rng, 2)}</div></body></html>')
        texts.append(" ".join([f"Part {i}", *body]))
    return pages, texts


def test_the_template_decides_on_misnamed_pages(monkeypatch):
    pages, texts = misnamed_site(random.Random(61), 40)
    assert templates.extract(pages) == texts
    # Some pages have so little text that only the others say where it stands.
    short = '<html><body><ul class="x1"><li>long menu of many words that is longer than all the rest</ul><div class="main"><p>x</p></div><div class="x7"><div class="h">Part</div><p>tiny</p></div><div class="x9">y</div></body></html>'
    assert templates.extract([*pages, short])[-1] == "Part tiny"
    monkeypatch.setattr(templates, "deduce", lambda pages: templates.Template())
    assert all(a != b for a, b in zip(templates.extract(pages), texts, strict=True))


def test_names():
    aside = ["ad", "promoBox", "promo-box", "ad-300x250", "comment_list", "comment-content", "site-footer", "cookieNotice", "share-buttons", "main-menu", "newsletterSignup2"]
    plain = ["related-work", "dinner-menu", "search-results", "form-of-the-poem", "has-sidebar", "adventure", "commentary", "header2x", "reform"]
    assert all(templates.marks(f' class="x9 {name}"') in (templates.AS_ASIDE, templates.AS_ANSWER) for name in aside)
    assert not any(templates.marks(f' id={name}') for name in plain)
    assert templates.marks(' class="entry-content"') == templates.AS_MAIN and templates.marks(" title='hidden ad' href=/id") == ""
