"""Labelled pages for the block classifier: layouts written by hand.

A page is put together from one part of each kind below; ``{H}`` and ``{P}``
stand for a headline and a paragraph of the main text, ``{s}`` and ``{p}`` for
a short and a longer text that is not part of it, ``{w!}`` and ``{w}`` for a
word of either kind, ``{c}`` for a generated name without meaning.  Words are made of random
syllables, so that nothing but layout and the fixed words below can be learned.
A main text is marked by a leading MARK character, from which the label of its
block is taken.
"""

from __future__ import annotations

import random

MARK = "\x01"

HEADERS = (
    "",
    '<header><a href="/">{s}</a><p>{s}</p></header>',
    '<header class="site-header"><h1>{s}</h1><p class="tagline">{s}</p><form action="/search"><label>Search</label><input name="q"><button>Search</button></form></header>',
    '<div id="header"><h2><a href="/">{s}</a></h2><div class="tagline">{s}</div></div>',
    '<div class="{c}"><div class="{c}"><a href="/">{s}</a></div><div class="{c}"><a href="/login">Log in</a></div></div>',
    '<div class="topbar"><span>{s}</span> <a href="/login">Log in</a> <a href="/join">Sign up</a></div><div class="masthead">{s}</div>',
)
MENUS = (
    '<nav><ul><li><a href="/a">{s}</a></li><li><a href="/b">{s}</a></li><li><a href="/c">{w}</a></li></ul></nav>',
    '<nav class="main-nav"><a href="/a">{w}</a> <a href="/b">{w}</a> <a href="/c">{s}</a></nav>',
    '<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">{w}</a></li><li><a href="/c">{s}</a></li><li><a href="/d">Contact</a></li></ul>',
    '<div id="navigation"><ul><li><a href="/a">{w}</a><li><a href="/b">{w}</a><li><a href="/c">{w}</a></ul></div>',
    '<div class="{c}"><div class="{c}"><a href="/a">{w}</a></div><div class="{c}"><a href="/b">{s}</a></div><div class="{c}"><a href="/c">{w}</a></div></div>',
    '<div class="{c}"><a href="/a">{w}</a> <a href="/b">{s}</a> <a href="/c">{w}</a></div>',
    '<table width="100%"><tr><td><a href="/a">{w}</a></td><td><a href="/b">{w}</a></td><td><a href="/c">{s}</a></td></tr></table>',
    '<nav role="navigation"><ol class="breadcrumb"><li><a href="/">{w}</a></li><li>{w}</li></ol></nav>',
    "",
)
NOTICES = (
    "",
    "",
    '<div class="ad">{p}</div>',
    '<div class="ad">{s}</div>',
    '<div class="advert"><p>Advertisement</p><p>{p}</p></div>',
    '<div class="cookie-notice"><p>We use cookies. {p}</p><button>Accept</button></div>',
    '<div id="banner" class="sponsored"><a href="/x">{p}</a></div>',
    '<section class="newsletter"><h3>Subscribe</h3><p>{p}</p><form><input name="mail"><button>Subscribe</button></form></section>',
    '<div class="notice alert">{p}</div>',
    '<div class="popup modal"><p>{p}</p><p>{s}</p></div>',
    '<div class="{c}"><div class="{c}">Advertisement</div><div class="{c}"><a href="/x">{p}</a></div></div>',
)
BODIES = (
    "<article><h1>{H}</h1><p>{P}</p><p>{P}</p><p>{P}</p></article>",
    "<article><h1>{H}</h1><p><b>{P}<br><p>{P}</p><p>{H}</p><p>{P}</p></article>",
    "<article><h1>{H}</h1><p><b>{P}<br></article>",
    "<article><h1>{H}</h1><p>{H}</p><p>{P}</p><p>{H}</p><p>{H}</p></article>",
    "<main><article><h1>{H}</h1><p>{P}</p><h2>{H}</h2><p>{P}</p><ul><li>{H}</li><li>{P}</li></ul><p>{P}</p></article></main>",
    '<main><h1>{H}</h1><p>{P}</p><blockquote>{P}</blockquote><p>{P}</p><pre>{P}</pre></main>',
    '<div id="content"><h1>{H}</h1><div class="post-content"><p>{P}</p><p>{P}</p><h3>{H}</h3><p>{P}</p></div></div>',
    '<div class="entry"><h2>{H}</h2><div class="entry-content"><p>{P}</p><div>{P}</div><p>{H}</p></div></div>',
    '<div class="container"><div class="story-body"><h1>{H}</h1><p>{P}</p><p><a href="/z">{H}</a> {P}</p><table><tr><td>{H}</td><td>{H}</td></tr></table><p>{P}</p></div></div>',
    '<section class="article-body"><h1>{H}</h1>{P}<br><br>{P}<p>{P}</p></section>',
    '<article class="post"><header><h1>{H}</h1></header><div class="body"><p>{P}</p><div class="ad">{p}</div><p>{P}</p><p>{P}</p></div><div class="share"><a href="/f">Share</a> <a href="/t">{w}</a></div></article>',
    '<article><h1>{H}</h1><p>{P}</p><aside class="related"><h4>Related</h4><ul><li><a href="/r">{s}</a></li><li><a href="/q">{s}</a></li></ul></aside><p>{P}</p><ol><li>{P}</li><li>{P}</li></ol></article>',
    '<div role="main" class="page-content"><h1>{H}</h1><p>{P}</p><p>{P}</p><dl><dt>{H}</dt><dd>{P}</dd></dl></div>',
    '<article><h1>{H}</h1><p>{P}</p><form class="signup"><p>{p}</p><label>{s}</label><input><button>Send</button></form><p>{P}</p><section class="comments"><h3>Comments</h3><p>{p}</p><p>{p}</p></section></article>',
    '<div class="{c}"><div class="{c}"><h1 class="{c}">{H}</h1><div class="{c}"><p class="{c}">{P}</p><p class="{c}">{P}</p><p class="{c}">{P}</p></div></div></div>',
    '<div class="{c}"><div class="{c}">{H}</div><div class="{c}">{P}</div><div class="{c}">{P}</div><div class="{c}">{P}</div></div>',
    '<div class="{c}"><div class="{c}">{H}</div><div class="{c}"><div class="{c}">{P}</div><div class="{c}">{H}</div><div class="{c}">{P}</div></div></div>',
    '<div id="{c}"><h1>{H}</h1><div class="{c}"><p>{P}</p><h2>{H}</h2><p>{P}</p><ul><li>{P}</li><li>{H}</li></ul><h2>{H}</h2><p>{P}</p></div></div>',
    '<div id="{c}"><h1>{H}</h1><p>{P}</p><p>{P}</p><h3>{H}</h3><ol><li>{H}</li><li>{P}</li></ol></div>',
    "<main><h1>{H}</h1><ul><li>{w!}</li><li>{w!}</li><li>{H}</li></ul><h2>{H}</h2><ol><li>{P}</li><li>{P}</li></ol></main>",
    "<h1>{H}</h1><p>{P}</p><p>{P}</p><p>{P}</p>",
    "<article><p>{P}</p></article>",
    "<main><p>{P}</p><p>{P}</p></main>",
    "<main><section><h1>{H}</h1><p>{P}</p></section><section><h2>{H}</h2><p>{P}</p><pre>{P}</pre></section></main>",
    '<div class="{c}"><section><h1>{H}</h1><p>{P}</p><section><h3>{H}</h3><p>{P}</p><p>{P}</p></section></section></div>',
    '<table><tr><td><h1>{H}</h1><p>{P}</p><p>{P}</p></td></tr><tr><td>{P}</td></tr></table>',
    "<main><h1>{H}</h1><table><tr><th>{w!}</th><th>{w!}</th></tr><tr><td>{w!}</td><td>{w!}</td></tr></table><p>{P}</p></main>",
    '<article><h1>{H}</h1><p>{P}</p><p class="promo">{p}</p><p>{P}</p><p class="advert">{s}</p><p>{P}</p></article>',
    '<article><h1>{H}</h1><figure><img src="a.png"><figcaption>{H}</figcaption></figure><p>{P}</p><p>{P}</p><footer><p>{s}</p></footer></article>',
)
SIDES = (
    "",
    "",
    '<aside><h3>{s}</h3><ul><li><a href="/a">{s}</a></li><li><a href="/b">{s}</a></li></ul></aside>',
    '<aside><h3>{s}</h3><p>{p}</p></aside>',
    '<div class="sidebar"><h4>{s}</h4><p>{p}</p><ul><li><a href="/t">{w}</a></li></ul></div>',
    '<div id="sidebar-right" class="widget"><h4>Popular</h4><p><a href="/p">{s}</a></p><p>{p}</p></div>',
)
COMMENTS = (
    "",
    "",
    '<section class="comments"><h3>Comments</h3><div class="comment"><p>{p}</p></div><div class="comment"><b>{w}</b><p>{p}</p></div></section>',
    '<div id="comments"><h2>{w} comments</h2><ol class="commentlist"><li><p>{p}</p></li><li>{p}</li></ol><form><textarea></textarea><button>Reply</button></form></div>',
    '<div class="discussion"><article class="comment"><p>{p}</p><a href="/r">Reply</a></article><article class="comment"><p>{p}</p></article></div>',
    '<div id="reader-comments"><p>{w} says: {p}</p><p>{p}</p></div>',
)
FOOTERS = (
    "<footer>&copy; {s} &middot; {p}</footer>",
    "<footer>&copy; {s} &middot; {s}</footer>",
    "<footer><p>{p}</p><ul><li><a href='/p'>Privacy</a></li><li><a href='/t'>Terms</a></li></ul></footer>",
    '<div id="footer"><p>Copyright {s}. All rights reserved.</p><a href="/i">{w}</a></div>',
    '<div class="{c}"><div class="{c}">© {s}</div><div class="{c}"><a href="/p">Privacy</a> <a href="/t">Terms</a></div></div>',
    '<div class="{c}">&copy; {s} <a href="/p">{w}</a></div>',
    '<div class="site-footer"><div class="links"><a href="/a">{s}</a> | <a href="/b">{s}</a></div>{p}</div>',
    "",
)
SYLLABLES = "an ber ca de en fi gro hu il jo ka lem mi nu or pa qui re sta ti un ver wi xa yo zen".split()


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def _text(rng: random.Random, kind: str) -> str:
    if kind == "c":  # as style compilers write them
        return rng.choice(("css-", "sc-", "_", "x")) + "".join(rng.choices("0123456789abcdefghijklmnopqrstuvwxyz", k=6))
    if kind in ("w", "w!"):
        return _words(rng, 1)
    if kind in "sH":
        text = _words(rng, rng.randint(1, 9)).capitalize()
        return text + rng.choice(("", ".", "", "?")) if kind == "H" else text
    sentences = [_words(rng, rng.randint(3, 18)).capitalize() for _ in range(rng.choice((1, 1, 2, 3, 5, 8) if kind == "P" else (1, 1, 2, 3)))]
    return ". ".join(sentences) + "."


def filled(layout: str, rng: random.Random) -> str:
    """A layout with words in its places, those of the main text marked."""
    for kind in ("H", "P", "w!", "s", "p", "w", "c"):
        pieces = layout.split("{%s}" % kind)
        layout = "".join(x + (MARK if kind in ("H", "P", "w!") else "") + _text(rng, kind) for x in pieces[:-1]) + pieces[-1]
    return layout


def labelled_pages(n: int = 480, seed: int = 7) -> list[str]:
    """n pages whose main blocks begin with MARK; the parts are drawn at random."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        generated = rng.random() < 0.25  # such names are used throughout a page

        def part(kinds: tuple[str, ...], generated: bool = generated) -> str:
            return rng.choice([x for x in kinds if "{c}" in x] or [""] if generated else kinds)

        before = [part(HEADERS), part(MENUS), part(NOTICES) if rng.random() < 0.7 else ""]
        after = [part(SIDES), part(COMMENTS), part(NOTICES) if rng.random() < 0.7 else "", part(FOOTERS)]
        if rng.random() < 0.3:
            before.append(after.pop(0))
        layout = part(BODIES)
        if rng.random() < 0.85:  # else the article is the whole page
            layout = "".join([*before, layout, *after])
        if rng.random() < 0.3 + 0.3 * generated:
            layout = f'<div class="{"{c}" if generated else rng.choice(("wrapper", "container", "page", "row"))}">{layout}</div>'
        layout = filled(layout, rng)
        pages.append(f"<!DOCTYPE html><html><head><title>{_words(rng, 4)}</title><style>p{{}}</style></head><body>{layout}</body></html>")
    return pages
