"""Made web pages with known main text, for training the block labeller.

A page is a random layout: main text in one of many wrappings, and around or inside it menus, headers, footers, sidebars, notices,
adverts, forms, share links and reader comments. Words are made of random syllables, so that the labeller learns
layouts, lengths and the usual phrases rather than a language; some wrappings have names that say nothing. Every block begins with a mark, `MAIN` or
`OTHER`, from Unicode's private use area.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

MAIN, OTHER = "\ue001", "\ue002"

# Fixed: names in common use on web pages, per kind of part.
MAIN_NAMES = """content main post entry article story text body page article-body post-content entry-content main-content
story-body articleBody article__text single-post blog-post page-content prose markdown-body hentry news-text""".split()
NAMES = {
    "menu": """menu nav navbar navigation main-menu top-menu breadcrumb breadcrumbs site-nav topbar tabs pagination pager toc
sub-menu quick-links skip-links language-switcher""".split(),
    "header": "header site-header masthead banner top page-header branding logo header-inner global-header".split(),
    "footer": "footer site-footer bottom colophon copyright legal page-footer footer-links footer-inner imprint credits".split(),
    "sidebar": """sidebar side aside widget widgets secondary related related-posts recommended more-news trending popular
most-read right-column left-column tag-cloud categories archive teaser teasers read-more side-box""".split(),
    "notice": """notice cookie cookie-notice cookie-banner consent gdpr alert message popup modal overlay paywall banner-notice
disclaimer announcement warning subscribe-wall info-box toast""".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsbygoogle ad-slot banner-ad commercial partner".split(),
    "form": "form search search-form newsletter signup login subscribe contact-form login-form mailing-list register".split(),
    "share": "share social social-share sharing share-buttons follow-us tools print-links post-meta tags meta".split(),
    "comments": """comments comment comment-list discussion replies responses disqus comment-body commentlist user-comments
reader-comments thread feedback""".split(),
}
TAGS = {
    "menu": ["nav", "nav", "div", "ul", "menu"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"],
    "sidebar": ["aside", "aside", "div", "section"], "notice": ["div", "div", "section", "dialog", "aside"],
    "advert": ["div", "div", "aside", "ins", "section"], "form": ["form", "form", "div"], "share": ["div", "ul", "p"],
    "comments": ["section", "div", "div", "ol"],
}
PHRASES = {
    "menu": "Home|About|About us|Contact|News|Sport|Blog|Products|Services|Login|Sign up|Help|FAQ|Shop|Next|Previous|Skip to content|Menu",
    "header": "The daily|Welcome|Breaking news|Your source for news|Search|Log in|Subscribe|Menu",
    "footer": "© 2024|© 2021 All rights reserved.|Copyright 2020.|Privacy policy|Terms of use|Imprint|Powered by|Back to top|Contact us|Sitemap",
    "sidebar": "Related articles|Most read|Popular posts|Recent posts|Trending|Read more|More news|Categories|Archives|Tags|You may also like",
    "notice": "We use cookies to improve your experience.|Accept all|By using this site you agree to our privacy policy.|Subscribe to continue reading."
    "|Please enable JavaScript.|This site is under maintenance.|Your browser is out of date.|Close|OK",
    "advert": "Advertisement|Sponsored|Buy now|Save 50% today!|Limited offer|Ad|Shop now|Order today and get free shipping.|Click here",
    "form": "Search|Email address|Your name|Password|Subscribe to our newsletter|Sign up|Send|Submit|Remember me|Leave a reply|Your message",
    "share": "Share|Tweet|Share on|Print|Email|Follow us|Like|Posted in|Tags|Filed under|2 min read",
    "comments": "Comments|3 comments|Reply|Leave a comment|says:|Anonymous|2 hours ago|Report|Log in to comment|Great article!|Thanks for sharing.",
}
_SYLLABLES = "an be ci do er fa gu he in jo ka le mi no or pe qui ra so tu un va we xi yo za ch st ié ño ön ß ла ко ми те 日本 文字".split()


class _Maker:
    def __init__(self, rng: random.Random):
        self.rng = rng
        # each page has its own way of writing
        self.vocabulary = ["".join(rng.choices(_SYLLABLES, k=rng.choice([1, 1, 2, 2, 3]))) for _ in range(rng.choice([40, 200]))]
        self.noise = rng.choice(["", "", "", "***", "&amp;", "|"])

    def words(self, low: int, high: int) -> str:
        chosen = self.rng.choices(self.vocabulary, k=self.rng.randint(low, high))
        if self.noise:
            chosen = [w + self.noise if self.rng.random() < 0.3 else w for w in chosen]
        return " ".join(chosen).capitalize()

    def sentences(self, low: int, high: int, longest: int = 22) -> str:
        some = [self.words(1, longest) + self.rng.choice([".", ".", ".", "!", "?"]) for _ in range(self.rng.randint(low, high))]
        return " ".join(some)

    def named(self, tag: str, names: list[str], inside: str, plain: float = 0.25, bland: float = 0.12) -> str:
        """A wrapping with a telling name, or none, or one that says nothing."""
        rng = self.rng
        chance = rng.random()
        if chance < plain:
            return f"<{tag}>{inside}</{tag}>"
        name = "".join(rng.choices("abcdefghijklmnop", k=6)) if chance < plain + bland else rng.choice(names)
        if rng.random() < 0.25:
            name += " " + rng.choice(["wrap", "container", "inner", "box", "block", "row", "col-4", "clearfix", "active", "module"])
        where = "id" if rng.random() < 0.25 else "class"
        return f'<{tag} {where}="{name}">{inside}</{tag}>'

    # --- main text ---

    def inline(self, text: str) -> str:
        rng = self.rng
        parts = text.split(" ")
        if len(parts) > 4 and rng.random() < 0.35:
            at = rng.randrange(len(parts) - 2)
            tag = rng.choice(["a href='/x'", "b", "em", "i", "strong", "span", "code", "sup"])
            parts[at] = f"<{tag}>{parts[at]}"
            parts[at + 1] += f"</{tag.split()[0]}>"
        if rng.random() < 0.1:
            parts.insert(rng.randrange(len(parts)), rng.choice(["<br>", "<br/>", "\n", "&nbsp;"]))
        return " ".join(parts)

    def paragraph(self) -> str:
        rng = self.rng
        kind = rng.random()
        if kind < 0.15:
            text = self.words(1, 5) + rng.choice([".", ".", ""])
        elif kind < 0.18:  # main text may quote what usually is not
            text = self.phrase(rng.choice(list(PHRASES)))
        elif kind < 0.22:
            text = rng.choice([" | ", " # ", " - "]).join(self.words(1, 2) for _ in range(rng.randint(2, 9)))
        else:
            text = self.sentences(1, 6)
        text = self.inline(MAIN + text)
        if rng.random() < 0.04:
            return f"<p><b>{text}<br>"
        return f"<{'div' if kind > 0.95 else 'p'}>{text}</{'div' if kind > 0.95 else 'p'}>"

    def piece(self) -> str:
        rng = self.rng
        kind = rng.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.84:
            level = rng.choice(["h2", "h2", "h3", "h4"])
            return f"<{level}>{MAIN}{self.words(1, 9)}</{level}>" + self.paragraph()
        if kind < 0.91:
            tag = rng.choice(["ul", "ol"])
            low, high = rng.choice([(1, 4), (6, 20)])
            return f"<{tag}>" + "".join(f"<li>{self.inline(MAIN + self.words(low, high))}</li>" for _ in range(rng.randint(2, 6))) + f"</{tag}>"
        if kind < 0.94:
            return f"<blockquote>{self.paragraph()}</blockquote>"
        if kind < 0.96:
            rows = ["".join(f"<td>{MAIN}{self.words(1, 3)}</td>" for _ in range(3)) for _ in range(rng.randint(2, 4))]
            return "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"
        if kind < 0.98:
            return f"<figure><img src='a.jpg'><figcaption>{MAIN}{self.words(3, 12)}</figcaption></figure>"
        return f"<pre>{MAIN}{self.words(4, 15)}</pre>"

    def main(self) -> str:
        rng = self.rng
        title = f"<h1>{MAIN}{self.words(2, 11)}</h1>" if rng.random() < 0.85 else ""
        if title and rng.random() < 0.15:
            title = f"<header>{title}</header>"
        pieces = [self.piece() for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 10, 14, 20]))]
        for kind, chance in (("advert", 0.15), ("share", 0.15), ("sidebar", 0.12), ("form", 0.08), ("notice", 0.05)):
            if rng.random() < chance:
                pieces.insert(rng.randint(0, len(pieces)), self.part(kind, sure=True))
        body = "".join(pieces)
        if rng.random() < 0.4:
            body = self.named("div", MAIN_NAMES, body)
        if rng.random() < 0.12:
            body += self.named("section", NAMES["comments"], self.comments(), plain=0)
        body = title + body
        chance = rng.random()
        if chance < 0.4:
            return self.named("article", MAIN_NAMES, body, plain=0.6)
        if chance < 0.6:
            return self.named("main", MAIN_NAMES, body if rng.random() < 0.5 else f"<article>{body}</article>", plain=0.6)
        if chance < 0.92:
            return self.named(rng.choice(["div", "div", "section", "td"]), MAIN_NAMES, body, plain=0.1)
        return body

    # --- everything else ---

    def phrase(self, kind: str) -> str:
        return self.rng.choice(PHRASES[kind].split("|"))

    def links(self, kind: str, low: int, high: int) -> str:
        rng = self.rng
        texts = [self.phrase(kind) if rng.random() < 0.4 else self.words(1, rng.choice([1, 3, 9])) for _ in range(rng.randint(low, high))]
        if rng.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{i}">{OTHER}{t}</a></li>' for i, t in enumerate(texts)) + "</ul>"
        return OTHER + rng.choice([" ", " | ", " · "]).join(f'<a href="/{i}">{t}</a>' for i, t in enumerate(texts))

    def comments(self) -> str:
        rng = self.rng
        some = [f"<h3>{OTHER}{self.phrase('comments')}</h3>"] if rng.random() < 0.7 else []
        for _ in range(rng.randint(1, 6)):
            head = f"<div class='author'>{OTHER}{self.words(1, 2)} {self.phrase('comments')}</div>" if rng.random() < 0.7 else ""
            text = f"<p>{OTHER}{self.sentences(1, 3)}</p>" if rng.random() < 0.8 else OTHER + self.sentences(1, 3)
            tag = rng.choice(["div", "li", "article", "section"])
            some.append(self.named(tag, NAMES["comments"], head + text, plain=0.3))
        if rng.random() < 0.3:
            some.append(self.part("form", sure=True))
        return "".join(some)

    def part(self, kind: str, sure: bool = False) -> str:
        rng = self.rng
        if kind == "comments":
            inside = self.comments()
        elif kind == "menu":
            inside = self.links(kind, 2, 8)
        elif kind in ("advert", "notice"):
            text = f"{self.phrase(kind)} " if rng.random() < 0.5 else ""
            text = OTHER + text + (self.sentences(1, 2, 14) if rng.random() < 0.7 else "")
            text = text if len(text) > 1 else OTHER + self.sentences(1, 1)
            inside = f"<p>{text}</p>" if rng.random() < 0.4 else text
            if rng.random() < 0.2:
                inside += f"<p>{OTHER}<a href='/y'>{self.phrase(kind)}</a></p>"
        elif kind == "form":
            labels = [f"<label>{OTHER}{self.phrase(kind)}</label><input name='q'>" for _ in range(rng.randint(1, 3))]
            inside = f"<p>{OTHER}{self.sentences(1, 1)}</p>" * (rng.random() < 0.4) + "<div></div>".join(labels) + "<button>Go</button>"
        elif kind == "footer":
            text = f"<p>{OTHER}{self.phrase(kind)} {self.words(1, 8)}.</p>" if rng.random() < 0.5 else f"{OTHER}&copy; {self.words(1, 3)} &middot; {self.words(2, 9)}."
            inside = text + (self.links(kind, 2, 6) if rng.random() < 0.5 else "")
        elif kind == "share":
            inside = self.links(kind, 1, 4)
        elif kind == "header":
            tag = rng.choice(["h1", "div", "p", "span"])
            inside = f"<{tag}>{OTHER}{self.words(1, 4)}</{tag}>"
            if rng.random() < 0.5:
                inside += f"<p>{OTHER}{self.phrase(kind) if rng.random() < 0.5 else self.sentences(1, 1, 8)}</p>"
            if rng.random() < 0.4:
                inside += self.part("menu")
        else:
            title = f"<h3>{OTHER}{self.phrase(kind)}</h3>" if rng.random() < 0.6 else ""
            some = self.links(kind, 2, 6) if rng.random() < 0.5 else "".join(f"<p>{OTHER}{self.sentences(1, 3)}</p>" for _ in range(rng.randint(1, 3)))
            inside = title + some
        tag = rng.choice(TAGS[kind])
        telling = tag in ("nav", "header", "footer", "aside", "form", "ins", "dialog", "menu")
        return self.named(tag, NAMES[kind], inside, plain=0.5 if telling and not sure else 0.0, bland=0.0 if sure else 0.08)

    def page(self) -> str:
        rng = self.rng
        before = [k for k, chance in (("notice", 0.35), ("header", 0.55), ("menu", 0.75), ("form", 0.15), ("advert", 0.35), ("sidebar", 0.2)) if rng.random() < chance]
        after = [k for k, chance in (("share", 0.3), ("comments", 0.4), ("sidebar", 0.45), ("advert", 0.25), ("form", 0.25), ("menu", 0.15), ("footer", 0.8), ("notice", 0.1)) if rng.random() < chance]
        if rng.random() < 0.3:
            rng.shuffle(before)
        if rng.random() < 0.3:
            rng.shuffle(after)
        body = "".join(map(self.part, before)) + self.main() + "".join(map(self.part, after))
        if rng.random() < 0.3:
            body = self.named("div", ["page", "wrapper", "container", "site", "layout", "outer"], body)
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def pages(seed: int, n: int) -> Iterator[str]:
    """n made pages, the same for the same seed."""
    rng = random.Random(seed)
    for _ in range(n):
        yield _Maker(rng).page()
