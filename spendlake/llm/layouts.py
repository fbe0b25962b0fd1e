"""Labelled pages to learn extraction from: seeded layouts whose main text is marked.

Nobody has labelled the given pages, so the trees learn from pages that are
composed here: an article among menus, headers, footers, sidebars, notices,
adverts, forms and reader comments, with the markup of each drawn from what is
common on the web, with and without telling names, and closed properly or not.
"""

from __future__ import annotations

import random

SYLLABLES = "an be co da el fi go ha in jo ka le mo na or pe ri su ta un ve wo za ér".split()


class Layout:
    """One page, drawn from a seed; ``data-main`` says what is main text."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        # Some pages name nothing, some use no elements with a meaning of their own.
        self.named = self.r.random() < 0.85
        self.semantic = self.r.random() < 0.6
        self.sloppy = self.r.random() < 0.3

    def pick(self, choices: str) -> str:
        return self.r.choice(choices.split())

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4))) for _ in range(self.r.randint(low, high)))

    def prose(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.r.randint(low, high)):
            one = self.words(3, 18).capitalize()
            if self.r.random() < 0.3:
                one = one.replace(" ", ", ", 1)
            if self.r.random() < 0.08:
                one = f'<a href="/x">{one}</a>' if self.r.random() < 0.5 else f"<b>{one}</b>"
            if self.r.random() < 0.05:
                one += " &amp; " + self.words(1, 3)
            out.append(one + self.r.choice([".", ".", ".", "!", "?"]))
        return " ".join(out)

    def box(self, inside: str, names: str, tags: str = "div", semantic: str = "", main: bool | None = False, certain: bool = False) -> str:
        """A box around something, named if the page names things or nothing else would tell."""
        tag = semantic if semantic and self.semantic and self.r.random() < 0.8 else self.pick(tags)
        if tag == "p" and "<" in inside:
            tag = "div"  # a paragraph cannot hold blocks
        attrs = ""
        if (self.named and self.r.random() < 0.9) or (certain and tag != semantic):
            name = self.pick(names)
            if self.r.random() < 0.3:
                name = self.r.choice(["site-", "page-", "js-", "x_", "my", "main-"]) + name
            if self.r.random() < 0.2:
                name += self.r.choice([" " + self.words(1, 1), "-wrap", "-box", "1", "Container"])
            attrs = f' {self.r.choice(["class", "class", "class", "id"])}="{name}"'
        mark = "" if main is None else f' data-main="{int(main)}"'
        return f"<{tag}{attrs}{mark}>{inside}</{tag}>"

    def links(self, low: int, high: int, words: int = 2) -> str:
        items = [f'<a href="/{n}">{self.words(1, words)}</a>' for n in range(self.r.randint(low, high))]
        style = self.r.random()
        if style < 0.6:
            return f'<{"ul"}>' + "".join(f"<li>{item}</li>" for item in items) + "</ul>"
        return self.r.choice([" | ", " ", " &middot; ", ""]).join(items)

    def menu(self) -> str:
        return self.box(self.links(3, 10), "menu nav navbar navigation breadcrumb main-nav topnav tabs pagination", "div div ul", "nav")

    def header(self) -> str:
        title = self.r.choice(["h1", "h2", "div", "p", "a"])
        inside = f"<{title}>{self.words(1, 4)}</{title}>"
        if self.r.random() < 0.4:
            inside += f"<p>{self.words(2, 8)}</p>"
        if self.r.random() < 0.5:
            inside += self.menu()
        if self.r.random() < 0.3:
            inside += self.form()
        return self.box(inside, "header masthead topbar top site-header branding banner", "div", "header", certain=True)

    def footer(self) -> str:
        inside = self.r.choice(["&copy; ", "© 2024 ", "Copyright ", ""]) + self.words(1, 3)
        if self.r.random() < 0.6:
            inside += self.r.choice([" &middot; ", " | ", "<br>", "</p><p>"]) + self.prose(1, 2)
        if self.r.random() < 0.5:
            inside = f"<p>{inside}</p>"
        if self.r.random() < 0.4:
            inside += self.links(2, 8)
        return self.box(inside, "footer foot site-footer bottom copyright colophon legal", "div", "footer", certain=True)

    def advert(self) -> str:
        text = self.prose(1, 4)
        inside = self.r.choice([text, f"<p>{text}</p>", f'<a href="/buy">{text}</a>', f"<h3>{self.words(1, 5)}</h3><p>{text}</p>"])
        return self.box(inside, "ad ads advert advertisement ad-slot sponsored promo adsbygoogle banner-ad sponsor", "div div div aside section p", "", certain=True)

    def notice(self) -> str:
        inside = self.r.choice([self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>"])
        if self.r.random() < 0.5:
            inside += self.r.choice(["<button>OK</button>", '<a href="#">OK</a>'])
        return self.box(inside, "cookie cookie-banner notice alert consent gdpr popup modal subscribe-notice paywall privacy-notice announcement", "div div section aside p", certain=True)

    def sidebar(self) -> str:
        parts = []
        for _ in range(self.r.randint(1, 3)):
            body = self.r.choice([self.links(3, 8, 7), f"<p>{self.prose(1, 3)}</p>", f"<ul>{''.join(f'<li>{self.words(3, 9)}</li>' for _ in range(4))}</ul>"])
            parts.append(self.box(f"<h3>{self.words(1, 3)}</h3>{body}", "widget box related popular recommended block", "div section", main=None))
        return self.box("".join(parts), "sidebar side rail widgets related secondary aside", "div", "aside", certain=True)

    def related(self) -> str:
        return self.box(f"<h3>{self.words(1, 3)}</h3>{self.links(3, 6, 8)}", "related related-posts recommended more trending share social tags", "div section", "aside")

    def form(self) -> str:
        kind = self.r.random()
        if kind < 0.4:
            inside = '<input type="search"><button>Go</button>' + self.r.choice(["", f"<label>{self.words(1, 3)}</label>"])
        else:
            inside = "".join(f"<{tag}>{self.words(1, 4)}</{tag}><input>" for tag in [self.r.choice(["label", "p", "div", "span"])] * self.r.randint(1, 4))
            inside = self.r.choice(["", f"<h3>{self.words(1, 4)}</h3>", f"<p>{self.prose(1, 3)}</p>"]) + inside + f"<button>{self.words(1, 2)}</button>"
        return f'<form action="/s" data-main="0">{inside}</form>' if self.r.random() < 0.85 else self.box(inside, "form search newsletter signup login contact-form subscribe", certain=True)

    def comments(self) -> str:
        out = [f"<h3>{self.words(1, 3)}</h3>"] if self.r.random() < 0.7 else []
        tag = self.r.choice(["div", "li", "article", "div", "p", "section"])
        for _ in range(self.r.randint(1, 8)):
            text = self.prose(1, 5)
            body = text if tag == "p" else f"<{self.r.choice(['b', 'span', 'div', 'cite'])}>{self.words(1, 2)}</b>" + self.r.choice([f"<p>{text}</p>", text])
            name = self.r.choice(["comment", "comment", "reply", "comment-body", "review", "c"])
            out.append(f'<{tag} class="{name}">{body}</{tag}>' if self.r.random() < 0.8 else f"<{tag}>{body}</{tag}>")
        if self.r.random() < 0.4:
            out.append(self.form())
        inside = "".join(out)
        if tag == "li":
            inside = f"<ol>{inside}</ol>"
        return self.box(inside, "comments comment-list commentlist responses discussion disqus_thread reader-comments reviews replies", "div section div aside", "section", certain=True).replace(
            "<section data-main", '<section id="comments" data-main', 1
        )

    def heading(self) -> str:
        level = self.r.randint(2, 4)
        return f"<h{level}>{self.words(1, 8)}</h{level}>"

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.76:
            text = self.prose(1, 8) if self.r.random() < 0.8 else self.words(1, 12)
            if self.sloppy and self.r.random() < 0.3:
                return self.r.choice([f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text}<br>"])
            return f"<p>{text}</p>"
        if kind < 0.84:
            return self.heading()
        if kind < 0.89:
            tag = self.r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.prose(1, 2)}</li>" for _ in range(self.r.randint(2, 6))) + f"</{tag}>"
        if kind < 0.93:
            return f"<blockquote>{self.r.choice([self.prose(1, 4), '<p>' + self.prose(1, 4) + '</p>'])}</blockquote>"
        if kind < 0.95:
            return f"<pre><code>{self.words(3, 30)}</code></pre>"
        if kind < 0.97:
            return f'<figure><img src="a.png"><figcaption>{self.words(3, 12)}</figcaption></figure>'
        if kind < 0.985:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(self.r.randint(2, 5))) + "</table>"
        return f"<div>{self.prose(1, 6)}</div>"

    def article(self) -> str:
        blocks = [self.block() for _ in range(self.r.choice([1, 1, 2, 3, 4, 6, 9, 14, 25]))]
        if self.r.random() < 0.12:
            # Plain text with line breaks, no paragraphs at all.
            blocks = [self.prose(1, 4) + "<br><br>" for _ in blocks]
        for _ in range(self.r.choice([0, 0, 0, 1, 2])):
            extra = self.r.choice([self.advert, self.related, self.notice, self.form])()
            blocks.insert(self.r.randint(0, len(blocks)), extra)
        title = f"<h1>{self.words(2, 12)}</h1>" if self.r.random() < 0.85 else ""
        if title and self.r.random() < 0.2:
            title = f"<header>{title}<p>{self.words(2, 6)}</p></header>" if self.semantic else f"<div>{title}</div>"
        inner = "".join(blocks)
        if self.r.random() < 0.25:
            inner = self.box(inner, "content entry-content article-body post-body text story body", "div section", main=None)
        if self.r.random() < 0.15:
            inner += self.comments()
        if self.r.random() < 0.1 and self.semantic:
            inner += f'<footer data-main="0">{self.r.choice([self.words(1, 6), self.links(2, 5)])}</footer>'
        return self.box(title + inner, "content article post entry main story main-content post-content blog-post page-content", "div div div section td", self.pick("article article main"), main=True)

    def page(self) -> str:
        before = [f for f in (self.header, self.menu, self.notice, self.advert, self.form, self.sidebar) if self.r.random() < 0.35]
        after = [f for f in (self.comments, self.related, self.sidebar, self.advert, self.notice, self.form, self.menu) if self.r.random() < 0.3]
        self.r.shuffle(after)
        if self.r.random() < 0.9:
            after.append(self.footer)
        top, middle, bottom = [], self.article(), []
        for f in before:
            top.append(f())
        for f in after:
            bottom.append(f())
        if self.r.random() < 0.4:
            # Sidebars, comments and the like share a box with the article.
            k, j = self.r.randint(0, len(top)), self.r.randint(0, max(len(bottom) - 1, 0))
            middle = self.box("".join(top[k:]) + middle + "".join(bottom[:j]), "wrapper container main page row layout content", "div", "main", main=None)
            top, bottom = top[:k], bottom[j:]
        body = "".join(top) + middle + "".join(bottom)
        for _ in range(self.r.choice([0, 0, 0, 1, 2])):
            body = self.box(body, "wrapper container page site outer layout", main=None)
        if self.r.random() < 0.04:
            body = f'<form id="aspnetForm">{body}</form>'
        end = "" if self.r.random() < 0.1 else "</body></html>"
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body data-main=\"0\">{body}{end}"
