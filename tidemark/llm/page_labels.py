"""Labelled pages the main-text model is trained from.

``m=1`` on an element says that it and what it holds are main text, ``m=0`` that they are
not; the nearest one above a node counts, none above means no main text. The given tables
hold no labels for pages, so these layouts were written and labelled by hand. ``{w}`` is a
few words, ``{s}`` a sentence, ``{p}`` a paragraph, ``{ps}`` paragraphs of any length, ``{li}``
links of a list, ``{cs}`` short comments, ``{t}`` a heading.
"""

from __future__ import annotations

import random
import re

LAYOUTS = [
    "<body><nav><ul>{li}</ul></nav><div class=ad>{s}</div><article m=1><h1>{t}</h1>{ps}</article><footer>&copy; {w} {s}</footer>",
    "<body><nav><ul>{li}</ul></nav><div class=ad>{p}</div><article m=1><h1>{t}</h1><p>{w}</p>{ps}<p>{w}</p></article><footer>{p}</footer>",
    "<body><header><a href=/>{w}</a><nav>{li}</nav></header><main m=1><h1>{t}</h1>{ps}<h2>{t}</h2>{ps}</main><aside><h3>{w}</h3><ul>{li}</ul></aside><footer><p>{s}</p></footer>",
    "<body><div id=header><h1>{w}</h1><p>{s}</p></div><div id=menu><ul>{li}</ul></div><div id=content m=1><h2>{t}</h2>{ps}</div><div id=footer>{s}</div>",
    "<body><div class=cookie-banner><p>{s}</p><button>{w}</button></div><div class=page><div class=sidebar><h4>{w}</h4><p>{p}</p></div><div class=post m=1><h1>{t}</h1>{ps}</div></div>",
    "<body><div class=wrapper><div class=top-bar>{w}</div><div class=article-body m=1>{ps}<ul><li>{s}</li><li>{w}</li></ul>{ps}</div><div class=related><h3>{w}</h3><ul>{li}</ul></div><section id=comments><h3>{w}</h3>{cs}</section></div>",
    "<body><main><article m=1><header><h1>{t}</h1></header>{ps}<aside m=0 class=advert><p>{s}</p></aside>{ps}<blockquote><p>{s}</p></blockquote></article><section class=comments><h2>{w}</h2><article><p>{p}</p></article><article><p>{s}</p></article></section></main>",
    "<body><article m=1><h1>{t}</h1>{ps}<form m=0><label>{w}</label><p>{s}</p><button>{w}</button></form>{ps}<footer m=0>{s}</footer></article>",
    "<body><article m=1><nav m=0><ul>{li}</ul></nav><h1>{t}</h1>{ps}<div m=0 class=share><a href=#>{w}</a><a href=#>{w}</a></div><div m=0 class=ad>{p}</div>{ps}</article><div class=comments><p>{p}</p><p>{s}</p></div>",
    "<body><div><div><p>{s}</p><a href=#>{w}</a></div><div m=1><h1>{t}</h1><p>{p}</p><p>{p}</p><p>{p}</p></div><div><a href=#>{w}</a> <a href=#>{w}</a></div></div>",
    "<body m=1><h1>{t}</h1><p>{p}</p><p>{p}</p><p>{s}</p><p>{p}</p>",
    "<body><table><tr><td><a href=#>{w}</a><br><a href=#>{w}</a><br><a href=#>{w}</a></td><td m=1><h1>{t}</h1><p>{p}</p><p>{p}</p></td></tr><tr><td>{w}</td></tr></table>",
    "<body><form id=page><div class=menu>{li}</div><div class=main-content m=1><h1>{t}</h1>{ps}<table><tr><th>{w}</th><td>{w}</td></tr><tr><th>{w}</th><td>{s}</td></tr></table></div><div class=newsletter><p>{s}</p><label>{w}</label></div></form>",
    "<body><noscript>{s}</noscript><div role=banner>{w}</div><div role=navigation>{li}</div><div role=main m=1><h1>{t}</h1>{ps}<pre>{s}</pre>{ps}</div><div role=complementary><p>{p}</p></div><div role=contentinfo><p>{s}</p></div>",
    "<body><header class=site-header><p>{s}</p></header><div class=notice><p>{p}</p></div><section class=story m=1><h1>{t}</h1><figure><figcaption>{s}</figcaption></figure>{ps}</section><div class=recommended>{li}</div><footer class=site-footer><ul>{li}</ul><p>{p}</p></footer>",
    "<body><div class=entry-content m=1>{ps}<div m=0 class=sponsored><p>{p}</p></div>{ps}</div><div id=respond><h3>{w}</h3><form><p>{s}</p></form></div><ol class=comment-list><li><p>{p}</p></li><li><p>{s}</p></li></ol>",
    "<body><nav class=breadcrumb>{w}</nav><main><div class=promo><h2>{w}</h2><p>{s}</p></div><article class=post m=1><h1>{t}</h1>{ps}<dl><dt>{w}</dt><dd>{s}</dd></dl></article><aside class=sidebar><h2>{w}</h2><p>{p}</p><p>{s}</p></aside></main><dialog open><p>{s}</p></dialog>",
    "<body><div id=app><div class=banner>{s}</div><div class=text m=1>{ps}</div><div class=popup>{s}</div><div class=subscribe><p>{p}</p></div></div>",
    "<body><header><h1>{w}</h1><form><label>{w}</label></form></header><article m=1><h2>{t}</h2><section>{ps}</section><section><h3>{t}</h3>{ps}</section><section m=0 class=reader-comments><h3>{w}</h3>{cs}</section></article><footer>{w}</footer>",
    "<body><ul class=nav>{li}</ul><div class=content><div class=ads>{s}</div><div class=article m=1><h1>{t}</h1><p>{w}</p><p>{w}</p></div><div class=comment><p>{p}</p></div><div class=comment><p>{w}</p></div></div><div class=footer>{p}</div>",
    "<body><div class=alert role=alert><p>{s}</p></div><main m=1><h1>{t}</h1><ol><li>{s}</li><li><p>{p}</p></li></ol>{ps}<details><summary>{w}</summary><p>{p}</p></details></main><nav><a href=#>{w}</a></nav>",
    "<body><div class=gdpr>{p}</div><center><div class=body m=1><p>{p}</p><p>{s}</p><p>{w}</p></div></center><address>{s}</address>",
    "<body><aside><p>{p}</p><p>{p}</p></aside><article m=1><p>{w}</p></article><aside><p>{p}</p></aside><section class=comments>{cs}{cs}</section>",
    "<body><div class=container><div class=row><div class=col m=1><h1>{t}</h1><p>{p}</p><p>{s}</p><p>{p}</p></div><div class=col><ul>{li}</ul></div></div></div><div class=legal><p>{s}</p></div>",
    "<body><header>{w}</header><main m=1><h1>{t}</h1><div class=content><p>{w}</p>{ps}</div><div m=0 class=disqus><p>{p}</p></div><div m=0 class=social><a href=#>{w}</a></div></main><footer>{p}</footer>",
    "<body><div class=modal><p>{p}</p></div><article m=1><h1>{t}</h1>{ps}<p><a href=#>{w}</a></p><p>{s} <a href=#>{w}</a></p><div m=0 class=cookie-notice>{s}</div></article><div class=tags><a href=#>{w}</a></div>",
    "<body><article m=1><p>{w}</p></article></body>",
    "<body><nav>{li}</nav><main m=1><p>{w}</p></main><footer>{p}</footer></body>",
    "<body><div class=menu>{li}</div><div class=content m=1><p>{w}</p></div><div class=advert>{p}</div>",
    "<body><article m=1><table><tr><td>{w}</td><td>{w}</td></tr><tr><td>{w}</td><td>{s}</td></tr></table><pre>{w}</pre></article><footer>{w}</footer>",
    "<body><main m=1><article><p>{w}</p><section m=0 id=comments><article><p>{p}</p></article><article><p>{s}</p></article></section></article></main>",
    "<body><header>{p}</header><article m=1>{w}</article><aside>{p}</aside><footer>{p}</footer>",
    "<body><div class=header>{s}</div><div class=post m=1>{w}<br>{w}<h3>{w}</h3><ul><li>{w}<li>{w}</ul></div><div class=sidebar>{p}</div>",
    "<p m=1>{p}</p><p m=1>{p}</p><p m=1>{s}</p>",
    "<p m=1>{s}</p><p m=1>{s}</p>",
    "<html m=1>{p}",
    "<html m=1>{s}",
    "<ul>{li}</ul><p m=1>{s}</p><p m=1>{p}</p><p m=1>{w}</p>",
    "<h1 m=1>{t}</h1><p m=1>{p}</p><p m=1>{p}</p><div class=ad>{s}</div>",
    "<body><div m=1><p>{p}</p><p>{p}</p></div><div class=comments><div><p>{p}</p></div><div><p>{p}</p></div></div>",
    "<body><article m=1><h1>{t}</h1><p>{w}</p><h2>{w}</h2><p>{w}</p><blockquote>{w}</blockquote><dl><dt>{w}<dd>{w}</dl><figure><figcaption>{w}</figcaption></figure></article><div class=newsletter>{p}</div>",
]

#: Syllables of invented words; what the words are does not matter to the model.
_SYLLABLES = "an be co de er fo ga in ka lo ma ne or pa re so ti un ve".split()


def _word(dice: random.Random) -> str:
    return "".join(dice.choices(_SYLLABLES, k=dice.randint(1, 4)))


def _sentence(dice: random.Random, low: int, high: int) -> str:
    return " ".join(_word(dice) for _ in range(dice.randint(low, high))).capitalize() + "."


def _paragraph(dice: random.Random) -> str:
    return " ".join(_sentence(dice, 5, 18) for _ in range(dice.randint(3, 9)))


def filled(layout: str, dice: random.Random) -> str:
    """A page of a layout, its places filled with words."""

    def fill(kind: str) -> str:
        if kind == "w":
            return " ".join(_word(dice) for _ in range(dice.randint(1, 4)))
        if kind == "t":
            return _sentence(dice, 3, 9)[:-1]
        if kind == "s":
            return " ".join(_sentence(dice, 5, 14) for _ in range(dice.randint(1, 2)))
        if kind == "p":
            return _paragraph(dice)
        if kind == "li":
            return "".join(f"<li><a href=#>{fill('w')}</a></li>" for _ in range(dice.randint(2, 7)))
        if kind == "cs":
            return "".join(f"<div><p>{fill(dice.choice('wsp'))}</p></div>" for _ in range(dice.randint(1, 3)))
        return "".join(f"<p>{fill(dice.choice('wsspp'))}</p>" for _ in range(dice.randint(1, 6)))

    return re.sub(r"\{(\w+)\}", lambda m: fill(m.group(1)), layout)


def labelled_pages(layouts: list[str] | None = None, fills: int = 6, seed: int = 1) -> list[str]:
    """``fills`` pages of each layout; their ``m`` attributes are the labels."""
    dice = random.Random(seed)
    return [filled(layout, dice) for layout in (layouts or LAYOUTS) for _ in range(fills)]
