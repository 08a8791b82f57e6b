"""The labelled table of the block classifier: page outlines written for it,
each with the blocks that are article text (fixed values), filled by rule with
texts of one to several hundred words, so that no length belongs to a place."""

from __future__ import annotations

_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Weather", "About"))
_TEASERS = "".join(f'<li><a href="/{i}">Ten more rivers that you should see this year</a></li>' for i in range(3))

#: A number in braces is a text; the second part lists the texts that are main.
OUTLINES = [
    ("<html><head><title>{0}</title></head><body><nav><ul>" + _LINKS + "</ul></nav><div class='ad'>{1}</div><article>"
     "<h1>{2}</h1><p><b>{3}<br><p>{4}</p><p>{5}</p><p>{6}</p></article><footer>&copy; {7}</footer></body></html>",
     [2, 3, 4, 5, 6]),
    ("<html><body><nav><ul>" + _LINKS + "</ul></nav><div class='ad'>{0}</div><article><h1>{1}</h1><p>{2}</p>"
     "</article><footer>{3}</footer></body></html>", [1, 2]),
    ("<html><body><header><p>{0}</p><p>{1}</p></header><div class='cookie-consent'><p>{2}</p><button>{3}</button>"
     "</div><main><article><header><h1>{4}</h1></header><p>{5}</p><ul><li>{6}</li><li>{7}</li></ul><p>{8}</p>"
     "</article></main><aside><h2>{9}</h2><ul>" + _TEASERS + "</ul><p>{10}</p></aside><footer><p>{11}</p><p>{12}</p>"
     "</footer></body></html>", [4, 5, 6, 7, 8]),
    ("<html><body><div id='menu'>" + _LINKS + "</div><div class='content'><h2>{0}</h2><p>{1}</p><blockquote>{2}"
     "</blockquote><p>{3}</p></div><div class='sidebar'><p>{4}</p><ul>" + _TEASERS + "</ul></div><div class='comments'>"
     "<h3>{5}</h3><p>{6}</p><p>{7}</p><form><label>{8}</label><p>{9}</p></form></div><div id='footer'><p>{10}</p>"
     "</div></body></html>", [0, 1, 2, 3]),
    ("<html><body><nav><p>{0}</p></nav><article><h1>{1}</h1><p>{2}</p><div class='promo'><p>{3}</p></div><p>{4}</p>"
     "<aside><p>{5}</p></aside><section class='comments'><p>{6}</p><p>{7}</p></section><nav><a href='/2'>2</a></nav>"
     "</article><form><p>{8}</p><label>{9}</label></form><div class='newsletter'><p>{10}</p></div></body></html>",
     [1, 2, 4]),
    ("<html><body><div class='banner'><p>{0}</p></div><article><h1>{1}</h1><p><a href='/w'>{2}</a></p><table><tr>"
     "<td>{3}</td><td>{4}</td></tr></table><p>{5}</p><footer><p>{6}</p></footer></article></body></html>",
     [1, 2, 3, 4, 5]),
    ("<html><body><article class='post'><p>{0}</p><p>{1}</p><p>{2}</p></article><div class='sidebar'><p>{3}</p></div>"
     "<div class='advert'><p>{4}</p></div><header>{5}</header></body></html>", [0, 1, 2]),
    ("<html><body><nav><ul>" + _LINKS + "</ul></nav><article><h1>{0}</h1><p>{1}</p><p>{2}</p></article></body></html>",
     [0, 1, 2]),
    ("<main><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}", [0, 1, 2, 3]),
    ("<html><body><p><a href='/'>Home</a> | <a href='/c'>Contact</a></p><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p>"
     "<p><a href='/next'>Next</a></p></body></html>", [0, 1, 2, 3]),
]
#: Numbers of words that the texts of a page take in turn.
LENGTHS = (8, 1, 60, 15, 3, 400, 30)


def _filled(outline: str, main: list[int], turn: int) -> tuple[str, list[str]]:
    texts = [" ".join([f"Text{k}", *["word"] * (LENGTHS[(k * 3 + turn) % len(LENGTHS)] - 1)])
             for k in range(outline.count("{"))]
    return outline.format(*texts), [texts[k] for k in main]


PAGES = [_filled(outline, main, turn) for outline, main in OUTLINES for turn in range(len(LENGTHS))]
