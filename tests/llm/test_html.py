"""Main text of pages that the given tables have no examples of."""

import time

from ledgerline.llm import html

PROSE = " ".join(["The man and the dog of the town is in the house by the river."] * 6)


def test_long_attribute_values():
    for quote in "\"'":
        long = f"data-x={quote}{'x > y ' * 2000}{quote}"
        side = f'<div {long} class="sidebar"><div {long}><p>{PROSE}</p></div><p>Not this. {PROSE}</p></div>'
        page = f"<body>{side}<script {long}>var a = 1;</script><article {long}><p>{PROSE}</p><div {long}>Short one.</div></article>{side}</body>"
        assert html.main_text(page) == f"{PROSE}\nShort one."


def test_values_are_not_read_as_attributes():
    page = f"""<div data-class="sidebar" srcdoc='<p class="sidebar">' title="a 'b' class=ad" data-b=x"y><p>{PROSE}</p></div><p "odd>{PROSE}</p>"""
    assert html.main_text(page) == f"{PROSE}\n{PROSE}"


def test_unclosed_quotes():
    page = f"<div class='sidebar'><div title=\"lost><p>{PROSE}</p></div><p>{PROSE}</p></div><main><p>Whole text.</p></main>"
    assert html.main_text(page) == "Whole text."
    start = time.process_time()
    html.main_text("<a b='>'" * 40_000 + "<a b=\">\" c='" * 40_000)
    assert time.process_time() - start < 30  # each tag reaches to the end of the page


def test_wrappers_of_the_text_are_not_chrome():
    for name in ("layout has-sidebar", "no-sidebar", "with-nav", "social-share-enabled", "comments-open", "sidebar", "content-sidebar-wrap", "Widget"):
        nav = '<div class="main-nav"><p>Home of all</p></div><div id="sidebar-left"><p>The side of it.</p></div>'
        assert html.main_text(f'<div class="{name}">{nav}<article><p>Text.</p><p>{PROSE}</p></article></div>') == f"Text.\n{PROSE}"
        assert html.main_text(f'<div class="{name}">{nav}<div><p>{PROSE}</p></div></div><div class="ad-box">Buy it.</div>') == PROSE
        assert html.main_text(f'<div class="{name}">{nav}<main><p>Text.</p></main></div>') == "Text."


def test_side_columns_and_replies_stay_chrome():
    cards = "".join(f"<article><p>{PROSE}</p></article>" for _ in range(5))
    for side in ("comments", "related-posts", "sidebar"):
        assert html.main_text(f'<article><p>{PROSE}</p></article><div class="{side}"><p>x</p>{"" if side == "sidebar" else cards}</div>') == PROSE
    thread = f'<div class="comment-list"><div class="comment"><p>{PROSE}</p></div></div>'
    assert html.main_text(f"<div><p>{PROSE}</p></div>" + thread * 5) == PROSE
    assert html.main_text(f'<div class="sidebar">{thread * 5}<div><p>{PROSE}</p></div></div>') == PROSE
    assert html.main_text(thread) == PROSE  # a page of replies alone
    assert len(html.main_text('<div class="ad">' * 20_000 + PROSE)) == len(PROSE)


def test_short_paragraphs_without_an_article():
    short = "The man and the dog of the town is in the house by the river, and so is she."
    page = f'<nav><a href="/">Home</a></nav><div><h1>A title</h1><p>{short}</p><p>Short.</p><p>{short}</p></div><p><a href="/b">{short}</a></p><footer>{short}</footer>'
    assert html.main_text(page) == f"A title\n{short}\nShort.\n{short}"
    assert html.main_text("<div><p>One line of it.</p><p>Another line.</p></div><footer>Not this line at all.</footer>") == "One line of it.\nAnother line."
    # A line of links has no say about an article without a long paragraph.
    assert html.main_text(f'<article><p>{short}</p><p><a href="/b">{short}</a></p><p>{short}</p></article><p>Aside</p>').startswith(f"{short}\n{short}")


def test_prose_of_languages_without_stop_words():
    polish = "Stary rybak mieszkał nad brzegiem rzeki i codziennie przed świtem wypływał łodzią, żeby sprawdzić sieci zastawione poprzedniego wieczoru. "
    russian = "Старый рыбак жил на берегу реки и каждый день перед рассветом выходил на лодке проверить сети, поставленные накануне вечером. "
    chinese = "老渔夫住在河边，每天黎明之前划船出去检查前一天晚上布下的渔网，然后把鱼带到镇上的市场去卖。"
    for text in (polish * 3, polish, russian * 3, russian, chinese * 6, chinese):
        text = text.strip()
        page = f'<nav><a href="/">{text}</a></nav><div class="has-menu"><p>{text}</p><p>{text}</p></div><div class="sidebar"><p>{text}</p></div>'
        assert html.main_text(page) == f"{text}\n{text}"
    # On a page in a language of the rules, a block without stop words is no prose still.
    junk = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omega sigma tau"
    assert html.main_text(f"<p>{PROSE}</p><p>{PROSE}</p><p>{junk}</p>") == f"{PROSE}\n{PROSE}"
