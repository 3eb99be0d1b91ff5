"""Labelled pages to train the extraction model on: made from rules, so the main text of each is known."""

from __future__ import annotations

import random

_SOUNDS = "ba de fi go lu ma ne pi ro su ta ve wi xo za chi tra ple sko ung ein tion ment que os ra ión".split()
PAGES, SEED = 420, 11
#: Share of pages that are hardly more than a paragraph.
SHORT = 0.1


class _Page:
    def __init__(self, rng: random.Random):
        self.r, self.main, self.used = rng, [], set()

    def word(self) -> str:
        return "".join(self.r.choice(_SOUNDS) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int, stop: bool | None = None) -> str:
        """A text that is on the page once."""
        while True:
            t = " ".join(self.word() for _ in range(self.r.randint(lo, hi)))
            t = t[0].upper() + t[1:]
            if self.r.random() < 0.4:
                t = t.replace(" ", ", ", 1)
            t += "." if (self.r.random() < 0.7 if stop is None else stop) else ""
            if t not in self.used:
                self.used.add(t)
                return t

    def say(self, text: str) -> str:
        self.main.append(text)
        return text

    def one(self, *options: str) -> str:
        return self.r.choice(options)

    def close(self, tag: str) -> str:
        return f"</{tag}>" if self.r.random() < 0.9 else ""

    # what is not main text

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.one(self.words(1, 2, False), "Home", "About us", "Contact", self.words(2, 5))}</a></li>' for _ in range(n))

    def nav(self) -> str:
        body = f"<ul>{self.links(self.r.randint(3, 9))}</ul>" if self.r.random() < 0.8 else " | ".join(f'<a href="#">{self.words(1, 1, False)}</a>' for _ in range(4))
        return self.one("<nav>{}</nav>", '<div class="nav">{}</div>', '<div id="menu">{}</div>', '<div class="breadcrumbs">{}</div>', '<nav class="main-menu">{}</nav>', '<div role="navigation">{}</div>').format(body)

    def header(self) -> str:
        body = self.one(f"<h1>{self.words(1, 3, False)}</h1>", f'<div class="logo">{self.words(1, 3)}</div>', f"<p>{self.words(2, 8)}</p>", f"<h2>{self.words(1, 4, False)}</h2><p>{self.words(3, 9)}</p>")
        return self.one("<header>{}</header>", '<div class="header">{}</div>', '<div id="masthead">{}</div>', '<header class="site-header">{}</header>').format(body + (self.nav() if self.r.random() < 0.4 else ""))

    def footer(self) -> str:
        body = self.one(f"&copy; {self.word()}.example.com &middot; {self.words(3, 8)}", f"<p>&copy; 2023 {self.words(1, 4)}</p>", f"<ul>{self.links(4)}</ul><p>All rights reserved.</p>", f"<p>{self.words(4, 20)}</p>", f"<div>{self.words(6, 30)}</div><p>{self.words(3, 9)}</p>")
        return self.one("<footer>{}</footer>", '<div class="footer">{}</div>', '<div id="footer">{}</div>', '<footer class="page-footer"><div>{}</div></footer>').format(body)

    def ad(self) -> str:
        body = self.one(self.words(3, 20), f"<p>{self.words(5, 30)}</p>", f'<a href="/buy">{self.words(2, 9)}</a>', f"<h3>{self.words(2, 4)}</h3><p>{self.words(6, 16)}</p>", "Advertisement")
        return self.one('<div class="ad">{}</div>', '<div class="ads banner">{}</div>', '<div id="ad-1">{}</div>', '<aside class="advert">{}</aside>', '<div class="sponsored">{}</div>', '<section class="promo">{}</section>').format(body)

    def notice(self) -> str:
        body = self.one(f"We use cookies. {self.words(3, 12)}", f"<p>{self.words(5, 22)}</p><button>{self.words(1, 1, False)}</button>", f"<p>Subscribe to our newsletter {self.words(1, 5)}</p>", f"{self.words(5, 18)}")
        return self.one('<div class="cookie-notice">{}</div>', '<div id="cookie-banner">{}</div>', '<div class="notice">{}</div>', '<div class="popup">{}</div>', '<div class="newsletter">{}</div>', '<div role="alert">{}</div>').format(body)

    def sidebar(self) -> str:
        body = self.one(f"<h3>{self.words(1, 3)}</h3><ul>{self.links(self.r.randint(2, 6))}</ul>", f"<p>{self.words(8, 40)}</p>", f"<h2>Related</h2><p>{self.words(6, 20)}</p><p>{self.words(6, 20)}</p>", f"<div><h4>{self.words(1, 4)}</h4>{self.words(5, 25)}</div>")
        return self.one("<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div id="sidebar">{}</div>', '<aside class="widget">{}</aside>', '<div class="related-posts">{}</div>', '<section class="popular">{}</section>').format(body)

    def form(self) -> str:
        return self.one('<form action="/s"><label>{}</label><input name="q"><button>{}</button></form>', '<form class="login"><p>{}</p><input type="text"><button>{}</button></form>', '<div class="search-form"><form><label>{}</label><select><option>a</option></select><button type="submit">{}</button></form></div>').format(self.words(1, 6), self.words(1, 2, False))

    def share(self) -> str:
        return self.one('<div class="share">{}</div>', '<ul class="social">{}</ul>', '<div class="share-buttons">{}</div>').format(self.links(3))

    def comments(self) -> str:
        one = lambda: self.one('<div class="comment"><p>{}</p></div>', "<li><b>{}</b><p>{}</p></li>", '<div class="comment"><span class="author">{}</span> says: <p>{}</p></div>', "<p>{}</p>", "<div><p>{}</p><p>{}</p></div>").replace("{}", "\0")
        body = "".join(self._fill(one()) for _ in range(self.r.randint(1, 5)))
        head = self.one("", "<h3>Comments</h3>", f"<h2>{self.words(1, 2)}</h2>")
        return self.one('<section class="comments">{}</section>', '<div id="comments">{}</div>', '<ol class="commentlist">{}</ol>', '<section id="comments">{}</section>', '<div class="user-comments">{}</div>', '<div class="reader-comments">{}</div>').format(head + body)

    def _fill(self, s: str) -> str:
        while "\0" in s:
            s = s.replace("\0", self.words(3, 40), 1)
        return s

    # the article

    def paragraph(self) -> str:
        r = self.r.random()
        t = self.say(self.words(1, 3) if r < 0.08 else self.words(4, 14) if r < 0.3 else self.words(15, 90))
        if self.r.random() < 0.15:
            a, _, b = t.partition(" ")
            return f'<p>{a} <a href="/x">{b}</a>{self.close("p")}' if self.r.random() < 0.3 else f'<p><b>{a}</b> {b}{self.close("p")}'
        if self.r.random() < 0.1:
            return f"<p><b>{t}<br>"
        return f"<p>{t}{self.close('p')}"

    def article(self) -> str:
        out = [f"<h1>{self.say(self.words(2, 10))}</h1>"] if self.r.random() < 0.8 else []
        for _ in range(self.r.randint(1, 9)):
            kind = self.r.random()
            if kind < 0.68:
                out.append(self.paragraph())
            elif kind < 0.76:
                h = self.one("h2", "h3", "h4")
                out.append(f"<{h}>{self.say(self.words(1, 7))}</{h}>")
            elif kind < 0.82:
                tag = self.one("ul", "ol")
                out.append(f"<{tag}>" + "".join(f"<li>{self.say(self.words(2, 14))}{self.close('li')}" for _ in range(self.r.randint(2, 5))) + f"</{tag}>")
            elif kind < 0.86:
                out.append(f"<blockquote><p>{self.say(self.words(8, 30))}</p></blockquote>")
            elif kind < 0.89:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.say(self.words(1, 4, False))}</td>" for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>")
            elif kind < 0.92:
                out.append(f"<pre>{self.say(self.words(4, 12))}</pre>")
            elif kind < 0.94:
                out.append(f'<figure><img src="a.png"><figcaption>{self.say(self.words(3, 12))}</figcaption></figure>')
            else:
                out.append(self.one(self.ad(), self.share(), self.notice(), self.form()))
        if self.r.random() < 0.12:
            out.append(self.comments())
        if self.r.random() < 0.08:
            out.append(self.sidebar())
        body = "".join(out)
        if self.r.random() < 0.12:
            body = f'<div class="{self.one("row", "inner", "col", "c1")}">{body}</div>'
        return self.one(
            "<article>{}</article>", "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="content">{}</div>', '<div class="post">{}</div>',
            '<div class="entry-content">{}</div>', '<section class="article-body">{}</section>', "<section>{}</section>", "<div>{}</div>", '<article class="post">{}</article>', '<div id="main">{}</div>', '<div role="main">{}</div>',
        ).format(body)

    def short(self) -> str:
        """An article of one or two blocks."""
        title = f"<h1>{self.say(self.words(1, 5))}</h1>" if self.r.random() < 0.3 else ""
        return self.one("<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "{}").format(f"{title}<p>{self.say(self.words(2, 40))}</p>")

    def html(self) -> str:
        some = lambda p, f: f() if self.r.random() < p else ""
        head = f"<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>{self.word()}</title><style>p{{margin:0}}</style></head>"
        body = [some(0.25, self.notice), some(0.4, self.header), some(0.75, self.nav), some(0.15, self.form), some(0.35, self.ad), some(0.15, self.sidebar), self.article(), some(0.2, self.share), some(0.3, self.comments), some(0.3, self.sidebar), some(0.15, self.ad), some(0.1, self.form), some(0.15, self.notice), some(0.8, self.footer)]
        if self.r.random() < SHORT:
            self.main = []
            body = [self.short()] + [some(0.3, self.footer)]
            head = self.one(head, "")
        return head + "<body>" + "\n".join(body) + self.one("</body></html>", "</body></html>", "", " ")


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[str, list[str]]]:
    """(html, texts of the main blocks) of n pages."""
    out = []
    for i in range(n):
        page = _Page(random.Random(seed * 1_000_003 + i))
        out.append((page.html(), page.main))
    return out
