"""Main text of pages whose parts have names that no list has, in the languages of the pages."""

import pytest

from ledgerlens.llm import html

STORY = [f"The {k} harbour of the old town was, as ever, full of boats, and of people who sold fish to the cooks of the inns." for k in range(8)]
BODY = "".join(f"<p>{x}</p>" for x in STORY)
WANT = "\n".join(["Boats", *STORY])
COMMENTS = "<p>What a nice text, I say, thank you for it.</p><p>I do not agree with this at all, sorry.</p>"


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return html.fit(pages)


def text(model, page):
    nodes = html.parse(page)
    return html.main_text(nodes, html.decode(nodes, model.log_odds(html.features(nodes, model.tokens))))


@pytest.mark.parametrize("name", ["commentaires", "kommentare", "comentarios", "discussion", "responses", "feedback-thread"])
def test_reader_comments_are_left_out(model, name):
    nav = "<nav><a href=/>Home</a></nav>"
    after = f"<html><body>{nav}<main><article><h1>Boats</h1>{BODY}</article><div class='{name}'>{COMMENTS}</div></main></body></html>"
    within = f"<html><body>{nav}<article><h1>Boats</h1>{BODY}<div class='{name}'>{COMMENTS}</div></article></body></html>"
    assert text(model, after) == WANT and text(model, within) == WANT


@pytest.mark.parametrize("name", ["publicite", "werbung", "anzeige", "outbrain", "impressum", "xqzw"])
def test_adverts_and_menus_are_left_out(model, name):
    with_ad = BODY.replace("</p>", f"</p><div class={name}>Buy the best nets now.</div>", 1)
    menu = f"<ul id={name}><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>"
    assert text(model, f"<html><body><article><h1>Boats</h1>{with_ad}</article></body></html>") == WANT
    assert text(model, f"<html><body>{menu}<article><h1>Boats</h1>{BODY}</article></body></html>") == WANT


@pytest.mark.parametrize("name", ["share", "social", "kopf", "artikel", "post-body"])
def test_article_under_an_odd_name_stays(model, name):
    part = f"{''.join(f'<p>{x}</p>' for x in STORY[:3])}<div class={name}>{''.join(f'<p>{x}</p>' for x in STORY[3:])}</div>"
    assert text(model, f"<html><body><article><h1>Boats</h1><div class={name}>{BODY}</div></article></body></html>") == WANT
    assert text(model, f"<html><body><article><h1>Boats</h1>{part}</article></body></html>") == WANT


def test_token_evidence_is_learned_and_bounded():
    tokens = html.Tokens()
    assert tokens.score(("comment",)) < 0 < tokens.score(("article",))
    assert tokens.score(("commentaires",)) < 0 and abs(tokens.score(("zzzzzz",))) < 0.2
    page = html.parse("<article><p>text</p><div class=share><p>more</p></div></article>")
    for _ in range(60):  # pages whose markup says otherwise outweigh what the list starts from
        tokens.learn(page, [1] * len(page))
    tokens.known.clear()
    assert tokens.score(("share",)) > 0 and tokens.score(("share",)) <= html._MOST
