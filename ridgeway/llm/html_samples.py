"""Labelled training pages for the block model, made by rule from a seed.

Site furniture comes in many layouts: menus, headers, footers, sidebars, notices, adverts, forms, reader
comments, related links, share bars.  Their texts are drawn from the same invented words as the
articles', at any length, so the model has to rest on ancestors more than on words.
"""

from __future__ import annotations

import random

_SYLLABLES = "the an re in on er st ou ti ha en ed ing tion ly wh sh ble or nd ea es at le de la que ment ar ción ung keit ver ein ge".split()
#: Class or id names by kind of furniture, and containers of articles.
FURNITURE = {
    "menu": ("nav menu navbar navigation topnav main-nav menubar breadcrumb breadcrumbs pagination pager tabs toolbar skip".split(), "nav div ul menu"),
    "header": ("header site-header masthead banner topbar page-header branding logo".split(), "header div"),
    "footer": ("footer site-footer bottom colophon copyright legal page-footer credits".split(), "footer div"),
    "sidebar": ("sidebar side aside widget rail left-column right-column related recommended trending popular archive tags tagcloud more".split(), "aside div section"),
    "notice": ("notice cookie cookies consent gdpr alert popup modal overlay warning message disclaimer banner-notice paywall subscribe".split(), "div section aside dialog"),
    "advert": ("ad ads advert advertisement sponsor sponsored promo promotion adbox banner-ad ad-slot commercial partner".split(), "div aside section"),
    "form": ("form search login signup newsletter contact feedback register search-box poll".split(), "form div"),
    "comments": ("comments comment commentlist comment-list discussion replies responses disqus reader-comments reviews".split(), "section div ol ul"),
    "share": ("share social sharing follow social-links tools byline-links buttons".split(), "div ul section"),
}
MAIN = (("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "article"), ("div", "post"),
        ("div", "entry-content"), ("div", "story-body"), ("section", "article-body"), ("div", "main"), ("div", "text"), ("article", "entry"), ("td", "content"))


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, n: int) -> str:
        r = self.r
        return " ".join("".join(r.choices(_SYLLABLES, k=r.randint(1, 3))) for _ in range(n))

    def sentence(self, lo: int = 2, hi: int = 16) -> str:
        return self.words(self.r.randint(lo, hi)).capitalize() + self.r.choice(".....!?")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def links(self) -> str:
        r = self.r
        items = [f'<li><a href="/{k}">{self.words(r.randint(1, 3))}</a></li>' for k in range(r.randint(2, 7))]
        return f"<ul>{''.join(items)}</ul>" if r.random() < 0.7 else " | ".join(i[4:-5] for i in items)

    def attr(self, names) -> str:
        name = self.r.choice(names)
        return self.r.choice((f' class="{name}"', f' id="{name}"', f" class='{name} {self.r.choice('abc')}1'", f' class="{name}-{self.r.choice(("wrap", "box", "top", "inner"))}"'))

    def furniture(self, kind: str) -> str:
        r = self.r
        names, tags = FURNITURE[kind]
        tag = r.choice(tags.split())
        plain = tag in ("nav", "header", "footer", "aside", "form") and r.random() < 0.5
        attr = "" if plain else self.attr(names)
        if kind in ("menu", "share"):
            inner = self.links()
        elif kind == "comments":
            one = r.choice((("article", ' class="comment"'), ("div", ' class="comment"'), ("li", ""), ("div", "")))
            inner = "".join(f"<{one[0]}{one[1]}><p>{self.prose(3)}</p></{one[0]}>" for _ in range(r.randint(1, 5)))
            inner = r.choice(("", f"<h3>{self.words(1)}</h3>", f"<h2>{self.sentence(1, 3)}</h2>")) + inner
        elif kind == "form":
            inner = f"<label>{self.words(1)}</label><input name=q><p>{self.sentence()}</p><button>{self.words(1)}</button>"
        else:
            inner = r.choice((self.prose(3), f"<p>{self.prose(3)}</p>", f"<h3>{self.words(2)}</h3><p>{self.prose(4)}</p>", self.links(),
                              f"<div>{self.sentence()}</div><div>{self.sentence()}</div>", f"&copy; {self.words(2)} &middot; {self.sentence()}"))
        if tag in ("ul", "ol", "menu") and "<li" not in inner:
            inner = f"<li>{inner}</li>"
        return f'<{tag}{attr} data-label="other">{inner}</{tag}>'

    def article(self) -> str:
        r = self.r
        tag, name = r.choice(MAIN)
        attr = f' class="{name}"' if name and r.random() < 0.7 else f' id="{name}"' if name else ""
        out = [f"<h1>{self.words(r.randint(3, 12))}</h1>"] if r.random() < 0.9 else []
        for _ in range(r.randint(1, 10)):
            if r.random() < 0.2:
                out.append(self.furniture(r.choice(sorted(FURNITURE))))
            roll = r.random()
            if roll < 0.55:
                out.append(f"<p>{self.prose()}</p>")
            elif roll < 0.68:
                out.append(f"<p><b>{self.prose()}<br>")
            elif roll < 0.76:
                out.append(f"<p>{r.choice((self.sentence(1, 2), self.words(1), self.words(2)))}</p>")
            elif roll < 0.79:
                out.append(f"<h2>{self.words(3)}</h2>")
            elif roll < 0.82:
                out.append("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(3)) + "</ul>")
            elif roll < 0.85:
                out.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif roll < 0.87:
                out.append(f"<pre>{self.words(5)}</pre>")
            elif roll < 0.89:
                out.append(f"<table><tr><td>{self.words(2)}</td><td>{self.words(2)}</td></tr></table>")
            elif roll < 0.92:
                out.append(f'<p>{self.sentence()} <a href="/x">{self.words(3)}</a> {self.sentence()}</p>')
            else:
                out.append(f"<div>{self.prose()}</div>")
        return f'<{tag}{attr} data-label="main">{"".join(out)}</{tag}>'

    def page(self) -> str:
        r = self.r
        before = [self.furniture(k) for k in ("notice", "header", "menu", "advert", "form", "share", "menu", "sidebar") if r.random() < 0.5]
        after = [self.furniture(k) for k in ("comments", "sidebar", "share", "advert", "form", "comments", "notice", "menu", "footer") if r.random() < 0.5]
        r.shuffle(before)
        wrap = r.choice(("{}", '<div class="container">{}</div>', '<div id="wrapper"><div class="row">{}</div></div>', '<div class="page">{}</div>'))
        return f'<!DOCTYPE html><html><head><title>x</title></head><body>{wrap.format("".join([*before, self.article(), *after]))}</body></html>'


def labelled_pages(n: int = 600, seed: int = 7) -> list[str]:
    """``n`` labelled pages, the same for the same arguments."""
    maker = _Maker(seed)
    return [maker.page() for _ in range(n)]
