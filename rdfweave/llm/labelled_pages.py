"""Small pages whose parts are labelled by hand, ``data-main`` 1 or 0, to train on.

They show layouts without telling tags, and the parts around an article.
"""

_SENTENCES = (
    "The harbour was quiet that morning, and only two boats had come in before the tide turned.",
    "Nobody in the village could say when the mill had last been repaired, but everyone agreed that it still worked.",
    "After a long debate, the council voted to keep the library open on Sundays, despite the cost.",
    "She measured the beam twice, wrote the numbers down, and went out to look for better timber.",
)


def _page(before: str, opening: str, inside: str, closing: str, after: str) -> str:
    body = f"<h1>A morning at the harbour</h1><p>{_SENTENCES[0]} {_SENTENCES[1]}</p><p>{_SENTENCES[2]}</p>{inside}<p>{_SENTENCES[3]}</p><ul><li>{_SENTENCES[0]}</li><li>{_SENTENCES[1]}</li></ul>"
    return f"<html><body>{before}{opening}{body}{closing}{after}</body></html>"


_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'
_AROUND = [
    ('<div id="header" data-main="0"><div class="logo">Daily Post</div><div class="menu">' + _MENU + "</div></div>", '<div id="footer" data-main="0"><p>Copyright 2020 Daily Post. All rights reserved.</p></div>'),
    ('<nav data-main="0">' + _MENU + '</nav><div class="cookie-notice banner" data-main="0"><p>We use cookies to improve this site. Accept all or read our policy.</p></div>', '<aside class="sidebar" data-main="0"><h3>Most read</h3>' + _MENU + "</aside><footer data-main=\"0\">&copy; 2020</footer>"),
    ('<header data-main="0"><h2>The Gazette</h2></header><div class="ad advert" data-main="0">Buy two, get one free, only this week.</div>', '<div class="related widget" data-main="0"><h4>Related stories</h4>' + _MENU + '</div><div class="newsletter subscribe" data-main="0"><form><p>Sign up for our letter.</p></form></div>'),
    ('<div class="topbar nav" data-main="0">' + _MENU + '</div><div class="breadcrumb" data-main="0"><a href="/">Home</a> &gt; <a href="/news">News</a></div>', '<section class="comments" id="comments" data-main="0"><h3>3 comments</h3><div class="comment"><p>I was there as well, and it was not like that at all, believe me.</p></div><div class="comment reply"><p>Thank you for writing this, it made my day.</p></div></section>'),
    ('<div class="sponsored promo" data-main="0"><p>Our partner offers you a new card without any fees for one year.</p></div>', '<div class="share social" data-main="0"><a href="#">Share</a> <a href="#">Post</a></div><div class="pagination" data-main="0"><a href="?p=2">Next</a></div><div class="alert notice popup modal" data-main="0"><p>Your session is about to expire.</p></div>'),
]
_REMARKS = "".join(f"<li class=\"comment depth-1\"><div class=\"comment-body\"><p>{s}</p></div></li>" for s in _SENTENCES)
_AROUND += [
    ('<div class="header" data-main="0">' + "<p>Every day since 1920.</p></div>", f'<ol class="comment-list" data-main="0">{_REMARKS}</ol><div class="footer" data-main="0"><p>{_SENTENCES[2]}</p></div>'),
    ('<div class="masthead" data-main="0"><p>Every day since 1920.</p></div>', f'<div class="responses discussion" data-main="0"><div class="response"><p>{_SENTENCES[1]} {_SENTENCES[2]}</p></div></div><div class="sidebar widget" data-main="0"><p>{_SENTENCES[3]}</p></div>'),
]
_MAIN = [
    ("<article data-main=\"1\">", "</article>"),
    ("<main data-main=\"1\"><article>", "</article></main>"),
    ('<div class="content" data-main="1">', "</div>"),
    ('<div id="wrapper" data-main="0"><div class="post-body entry article" data-main="1">', "</div></div>"),
    ('<div class="container row" data-main="0"><section class="story text" data-main="1">', "</section></div>"),
]
_INSIDE = [
    "",
    '<div class="ad" data-main="0">Best prices in town.</div>',
    f"<blockquote><p>{_SENTENCES[1]}</p></blockquote>",
    '<aside class="related" data-main="0"><a href="/x">Read more about harbours</a></aside>',
    "<h2>What came after</h2><table><tr><td>Boats, in all</td><td>Two.</td></tr></table>",
]

LABELLED = [
    _page(before, opening, inside, closing, after)
    for i, (before, after) in enumerate(_AROUND)
    for j, (opening, closing) in enumerate(_MAIN)
    for inside in [_INSIDE[(i + j) % len(_INSIDE)]]
]
