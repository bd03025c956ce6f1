"""Pages built to train the block labeller: articles of made-up words in random layouts."""

from __future__ import annotations

import html
import random

import numpy as np

from tidemark.llm.html_extract import Block, blocks

#: Marks in the texts of built pages: main text, and the rest.
_MAIN, _REST = "\ue001", "\ue002"

#: Containers of main text, and of what is not, as open tags.
MAIN = (
    "article", "main", 'div class="content"', 'div id="content"', 'div class="post"', 'div class="post-content"',
    'div class="entry-content"', 'div class="article-body"', 'section class="story"', 'div class="article"',
    'div id="main"', 'div role="main"', 'article class="post"', 'main id="main-content"', 'div class="text body"',
    'section class="article-content"', 'div class="page-content"', 'article class="entry"', 'div itemprop="articleBody"',
)
SIDE = {
    "menu": (
        "nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'nav class="navbar"', 'div class="topbar"',
        'div class="breadcrumb"', 'ul class="menu main-menu"', 'nav class="breadcrumbs"', 'div role="navigation"',
        'div class="pagination"', 'div class="tags"', 'div class="links"',
    ),
    "header": ("header", 'div class="header"', 'div id="header"', 'header class="site-header"', 'div class="masthead"', 'div class="logo"'),
    "footer": ("footer", 'div class="footer"', 'div id="footer"', 'footer class="site-footer"', 'div class="copyright"', 'div class="legal"'),
    "side": (
        "aside", 'div class="sidebar"', 'aside class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"',
        'section class="related-posts"', 'div class="recommended"', 'div class="share"', 'div class="social-share"',
        'aside class="related"', 'div class="popular"', 'div class="side"', 'div class="trending"',
    ),
    "notice": (
        'div class="cookie"', 'div class="cookie-notice"', 'div id="cookie-banner"', 'div class="notice"', 'div class="alert"',
        'div class="consent"', 'div class="gdpr"', 'div class="popup"', 'div class="modal"', 'div role="alert"', 'div class="banner"',
        'section class="notice"', 'p class="notice"', 'div class="message"', 'div class="paywall"', 'div role="dialog"', 'dialog',
    ),
    "advert": (
        'div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"', 'div id="ad-top"',
        'div class="promo"', 'div class="promotion"', 'section class="ad-slot"', 'aside class="ad"', 'div class="sponsor"', 'p class="ad"',
    ),
    "form": (
        "form", 'form class="search"', 'div class="newsletter"', 'form id="login"', 'div class="subscribe"', 'div class="signup"',
        'form class="newsletter"', 'form class="comment-form"', 'form action="/search"',
    ),
    "comments": (
        'div class="comments"', 'section class="comments"', 'div id="comments"', 'section id="comments"', 'div class="comment"',
        'ol class="comment-list"', 'div class="replies"', 'div class="reader-comments"', 'div id="disqus"', 'div class="responses"',
        'ul class="comments"', 'aside class="comments"', 'div class="discussion"',
    ),
}
PHRASES = (
    "Home", "About us", "Contact", "Subscribe to our newsletter", "We use cookies to improve this site", "Accept all",
    "Advertisement", "Sponsored", "All rights reserved", "Leave a comment", "Posted by", "Log in", "Search", "Related posts",
    "Share this", "Read more", "Privacy policy", "Terms of use", "Next page", "Sign up", "Reply", "Your e-mail address",
)


class _Maker:
    def __init__(self, rng: random.Random):
        self.rng = rng
        syllables = ["".join(rng.choice(s) for s in ("bcdfghlmnprstv", "aeiouéäñ", ["", "n", "r", "s", "t"])) for _ in range(60)]
        self.words = ["".join(rng.choices(syllables, k=rng.choice([1, 1, 2, 3]))) for _ in range(400)]

    def sentence(self, low: int, high: int) -> str:
        r = self.rng
        words = [r.choice(self.words) for _ in range(r.randint(low, high))]
        words = [w + "," if r.random() < 0.08 else w for w in words]
        if r.random() < 0.04:
            words = [w + r.choice(["###", "$$$", "&&&", "!!"]) for w in words]
        if r.random() < 0.04:
            words = [w.upper() for w in words]
        text = " ".join(words)
        return text[:1].upper() + text[1:] + ("." if r.random() < 0.85 else "")

    def text(self, most: int) -> str:
        return " ".join(self.sentence(1, 14) for _ in range(self.rng.randint(1, most)))

    def leaf(self, mark: str, tag: str, text: str) -> str:
        r, inner = self.rng, html.escape(text, quote=False)
        if r.random() < 0.15:
            words = inner.split(" ")
            k = r.randrange(len(words))
            words[k] = r.choice(['<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<span>{}</span>"]).format(words[k])
            inner = " ".join(words)
        open_only = tag == "p" and r.random() < 0.15
        extra = r.choice(["", "", "<br>"]) if r.random() < 0.3 else ""
        bold = "<b>" if r.random() < 0.1 else ""
        return f"<{tag}>{bold}{mark}{inner}{extra}" + ("" if open_only else f"</{tag.split(' ')[0]}>")

    def article(self) -> str:
        r, out = self.rng, []
        title = self.leaf(_MAIN, "h1", self.sentence(1, 10))
        out.append(f"<header>{title}</header>" if r.random() < 0.1 else title if r.random() < 0.9 else "")
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 12, 20, 40])):
            kind = r.random()
            if kind < 0.72:
                out.append(self.leaf(_MAIN, "p", self.text(r.choice([1, 2, 6]))))
            elif kind < 0.80:
                out.append(self.leaf(_MAIN, r.choice(["h2", "h3"]), self.sentence(1, 6)))
            elif kind < 0.87:
                items = "".join(self.leaf(_MAIN, "li", self.sentence(1, 9)) for _ in range(r.randint(1, 5)))
                out.append(r.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format(items))
            elif kind < 0.91:
                out.append(f"<blockquote>{self.leaf(_MAIN, 'p', self.text(2))}</blockquote>")
            elif kind < 0.94:
                cells = "".join(self.leaf(_MAIN, "td", self.sentence(1, 4)) for _ in range(r.randint(1, 4)))
                out.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.96:
                out.append(self.leaf(_MAIN, r.choice(["pre", "div", "figcaption"]), self.text(2)))
            else:
                out.append(self.side(r.choice(["advert", "advert", "side", "notice", "form"])))
        return "".join(out)

    def side(self, kind: str) -> str:
        r, container = self.rng, self.rng.choice(SIDE[kind])
        name = container.split(" ")[0]

        def words() -> str:
            return r.choice(PHRASES) if r.random() < 0.4 else self.text(1 if kind in ("menu", "header") else 3)

        if kind == "menu" or (kind in ("side", "footer", "header") and r.random() < 0.4):
            links = [f'<a href="/{k}">{_REST}{html.escape(r.choice([r.choice(PHRASES), r.choice(self.words), self.sentence(1, 1), self.sentence(1, 3)]))}</a>' for k in range(r.randint(1, 7))]
            inner = "<ul>" + "".join(f"<li>{a}</li>" for a in links) + "</ul>" if r.random() < 0.8 else " ".join(links)
        elif kind == "form":
            inner = self.leaf(_REST, "label", words()) + '<input name="q">' + self.leaf(_REST, "button", r.choice(PHRASES))
            inner += self.leaf(_REST, "p", words()) if r.random() < 0.5 else ""
        elif kind == "comments":
            tag = r.choice(["p", "p", "div", "li"])
            inner = "".join(
                (self.leaf(_REST, r.choice(["h3", "h4", "span", "strong"]), r.choice([*PHRASES, *self.words])) if r.random() < 0.4 else "")
                + self.leaf(_REST, tag, self.text(3))
                for _ in range(r.randint(1, 5))
            )
        elif r.random() < 0.45:
            inner = _REST + (r.choice(["&copy; ", "&middot; ", ""])) + html.escape(words())
        else:
            inner = "".join(self.leaf(_REST, r.choice(["p", "p", "div", "h3", "li"]), words()) for _ in range(r.randint(1, 3)))
        return f"<{container}>{inner}</{name}>"

    def page(self) -> str:
        r = self.rng
        main = r.choice(MAIN[:2]) if r.random() < 0.4 else r.choice(MAIN)
        body = self.article()
        if r.random() < 0.15:
            body += self.side("comments")
        body = f"<{main}>{body}</{main.split(' ')[0]}>"
        if r.random() < 0.15:
            body = f"<main>{body}</main>" if r.random() < 0.5 else f'<div class="container">{body}</div>'
        before = [k for k in ("notice", "header", "menu", "advert", "form", "side") if r.random() < 0.45]
        after = [k for k in ("side", "comments", "advert", "menu", "form", "notice") if r.random() < 0.4]
        if r.random() < 0.3:
            r.shuffle(before)
        out = "".join(map(self.side, before)) + body + "".join(map(self.side, after))
        out += self.side("footer") if r.random() < 0.8 else ""
        if r.random() < 0.2:
            out = f'<div class="{r.choice(["wrapper", "container", "page", "site"])}">{out}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.sentence(1, 6)}</title></head><body>{out}</body></html>"


def training_pages(count: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks and labels of built pages."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        page, labels = [], []
        for b in blocks(_Maker(rng).page()):
            labels.append(_MAIN in b.text)
            text = b.text.replace(_MAIN, "").replace(_REST, "")
            if text.strip():
                page.append(Block(" ".join(text.split()), b.path, b.links))
            else:
                labels.pop()
        if page:
            out.append((page, np.array(labels, np.float32)))
    return out
