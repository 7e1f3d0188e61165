"""Labelled pages to learn extraction from: pages laid out by rule, each block marked as article or not.

The layouts are made up here, since no given table has labels. A mark is a
private-use character at the start of a block's text.
"""

from __future__ import annotations

import random
import re

from roomledger.llm.dom import Block, blocks

OTHER, ARTICLE = "\ue000", "\ue001"
# Elements that pages put around their parts.
MENUS = ["<nav>", '<nav class="main-menu">', '<div class="menu">', '<div id="navigation">', '<ul class="navbar">',
         '<div class="breadcrumbs">', '<div class="topics-nav">', '<div role="navigation">']
HEADERS = ["<header>", '<div id="header">', '<div class="masthead">', '<div class="top-bar">', '<header class="site-header">',
           '<div class="page-header">', '<div role="banner">']
FOOTERS = ["<footer>", '<div id="footer">', '<div class="site-footer">', '<footer class="copyright">', '<div class="bottom-links">',
           '<div class="legal">', '<div role="contentinfo">']
SIDES = ["<aside>", '<div class="sidebar">', '<div id="sidebar-right">', '<div class="widget">', '<div class="related-posts">',
         '<section class="recommended">', '<aside class="related">', '<div class="trending">', '<div class="most-read">',
         '<div role="complementary">', '<div class="author-bio">', '<div class="tags">']
ADVERTS = ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div id="advertisement">', '<div class="sponsored">',
           '<div class="promo">', '<aside class="ad-slot">', '<div class="banner-ad">', '<section class="promotion">',
           '<p class="ad">', '<p class="sponsor">']
NOTICES = ['<div class="cookie-notice">', '<div class="notice">', '<div class="alert">', '<div id="cookie-banner">', '<p class="notice">',
           '<div class="gdpr consent">', '<div class="newsletter">', '<div class="subscribe">', '<div class="paywall">',
           '<div class="popup modal">', '<dialog>', '<div class="disclaimer">', '<div role="alert">', '<section class="cookies">']
SHARES = ['<div class="share">', '<ul class="social-links">', '<div class="share-buttons">', '<div class="toolbar">']
FORMS = ["<form>", '<form class="search">', '<form id="login">', '<form class="signup"><fieldset>', '<div class="search-box"><form>']
COMMENTS = ['<section id="comments">', '<div class="comments">', '<ol class="comment-list">', '<div class="reader-comments">',
            '<article class="comment">', '<div id="disqus_thread">', '<div class="replies">', '<section class="discussion">',
            '<div class="user-comment">', '<div class="responses">']
BODIES = ["<article>", "<article>", "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="main-content">',
          '<div class="post-body">', '<div class="entry-content">', '<div class="article-text">', '<section class="story">',
          '<div role="main">', '<div id="container"><div class="article">', '<div class="page"><div class="text">', "<div>",
          '<article class="post">', '<section>', ""]
SIGNS = ["cookies", "subscribe", "sign up", "log in", "share", "reply", "comments", "privacy policy", "read more", "all rights reserved",
         "terms of use", "advertisement", "newsletter", "accept"]
SYLLABLES = "th er on an re in ed es ti or ha nd st en at it is al ou ch un de la que ei ge ño mé ür 我 的 на ст".split()
PAGES = 400


class _Pages:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        pick = self.random
        n = int(low * (high / low) ** pick.random())
        words = ["".join(pick.choices(SYLLABLES, k=pick.randint(1, 5))) for _ in range(n)]
        style = pick.random()
        if style < 0.1:
            return " ".join(w.upper() + "!!" for w in words)
        if style < 0.2:
            return " ".join(w + pick.choice(["***", "$$$", "###", "%%%", "&amp;&amp;"]) for w in words)
        if style < 0.25:
            return " | ".join(words)
        ends = [pick.random() for _ in words]
        text = " ".join(w + ("." if e < 0.1 else "," if e < 0.2 else "") for w, e in zip(words, ends))
        return text[:1].upper() + text[1:] + pick.choice([".", ".", "", "!", "?"])

    def close(self, opened: str) -> str:
        tags = re.findall(r"<(\w+)", opened)
        return "".join(f"</{t}>" for t in reversed(tags))

    def around(self, kinds: list[str], inside: str) -> str:
        opened = self.random.choice(kinds)
        if opened.startswith("<p "):
            inside = OTHER + self.words(1, 40)
        return opened + inside + self.close(opened)

    def links(self, n: int) -> str:
        items = [f'<a href="/{k}">{OTHER}{self.words(1, 3)}</a>' for k in range(n)]
        kind = self.random.random()
        if kind < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return "".join(f"<div>{i}</div>" for i in items) if kind < 0.8 else f"<p>{OTHER}" + " ".join(items).replace(OTHER, "") + "</p>"

    def other(self, low: int = 1, high: int = 60) -> str:
        text = self.words(low, high)
        if self.random.random() < 0.3:
            text += " " + self.random.choice(SIGNS)
        tag = self.random.choice(["p", "p", "div", "h3", "", "li", "span"])
        return f"<{tag}>{OTHER}{text}</{tag}>" if tag else OTHER + text

    def article(self) -> str:
        pick, parts = self.random, []
        if pick.random() < 0.9:
            title = f"<h1>{ARTICLE}{self.words(1, 12)}</h1>"
            parts.append(f"<header>{title}</header>" if pick.random() < 0.1 else title)
        for _ in range(int(40 ** pick.random())):
            kind = pick.random()
            text = ARTICLE + self.words(1, 120)
            if kind < 0.7:
                parts.append(f"<p>{text}</p>")
            elif kind < 0.78:
                parts.append(f"<p><b>{text}<br>")
            elif kind < 0.84:
                parts.append(f"<h2>{ARTICLE}{self.words(1, 8)}</h2>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{ARTICLE}{self.words(1, 20)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.91:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.93:
                parts.append(f"<table><tr><td>{ARTICLE}{self.words(1, 5)}</td><td>{ARTICLE}{self.words(1, 5)}</td></tr></table>")
            elif kind < 0.95:
                parts.append(f"<figure><img src=x><figcaption>{ARTICLE}{self.words(2, 15)}</figcaption></figure>")
            elif kind < 0.97:
                parts.append(f"<pre>{text}</pre>")
            else:
                parts.append(f"<div>{text}</div>")
            if pick.random() < 0.07:
                parts.append(self.part(pick.choice([ADVERTS, SIDES, NOTICES, SHARES, FORMS])))
        if pick.random() < 0.1:
            parts.append(self.part(COMMENTS))
        return "".join(parts)

    def part(self, kinds: list[str]) -> str:
        pick = self.random
        if kinds in (MENUS, SHARES):
            return self.around(kinds, self.links(pick.randint(1, 8)))
        if kinds is FORMS:
            inside = f"<label>{OTHER}{self.words(1, 4)}</label><input><button>{OTHER}{self.words(1, 2)}</button>"
            if pick.random() < 0.3:
                inside = f"<p>{OTHER}{self.words(2, 20)}</p>" + inside
            return self.around(kinds, inside)
        if kinds is HEADERS and pick.random() < 0.4:
            title = f"<h1>{OTHER}{self.words(1, 6)}</h1>"
            return self.around(kinds, title + (f"<p>{OTHER}{self.words(1, 12)}</p>" if pick.random() < 0.5 else ""))
        inside = "".join(self.other(1, 80) for _ in range(pick.randint(1, 5 if kinds is COMMENTS else 3)))
        if kinds in (SIDES, HEADERS, FOOTERS) and pick.random() < 0.5:
            inside += self.links(pick.randint(1, 5))
        if kinds is FOOTERS and pick.random() < 0.6:
            inside = f"{OTHER}&copy; {self.words(1, 12)}" + ("" if pick.random() < 0.5 else inside)
        return self.around(kinds, inside)

    def page(self) -> str:
        pick = self.random
        parts = [self.part(kinds) for kinds, share in ((NOTICES, 0.2), (HEADERS, 0.4), (MENUS, 0.7), (ADVERTS, 0.4), (SIDES, 0.2)) if pick.random() < share]
        if pick.random() < 0.3:
            pick.shuffle(parts)
        if pick.random() < 0.97:
            parts.append(self.around(BODIES, self.article()))
        after = [self.part(kinds) for kinds, share in ((SHARES, 0.15), (COMMENTS, 0.3), (SIDES, 0.3), (ADVERTS, 0.2), (FORMS, 0.2), (NOTICES, 0.1)) if pick.random() < share]
        pick.shuffle(after)
        if pick.random() < 0.7:
            after.append(self.part(FOOTERS))
        return "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(parts + after) + "</body></html>"


def labelled_pages(n: int = PAGES, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """``n`` pages as their blocks, and for each block 1 if it belongs to the article, else 0."""
    made = _Pages(seed)
    pages = []
    for _ in range(n):
        found = blocks(made.page())
        labels = [int(ARTICLE in b.text) for b in found]
        bare = [b._replace(text=b.text.replace(ARTICLE, "").replace(OTHER, "").strip()) for b in found]
        kept = [k for k, b in enumerate(bare) if b.text]
        pages.append(([bare[k] for k in kept], [labels[k] for k in kept]))
    return pages
