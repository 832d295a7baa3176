"""Pages with known main text, laid out by rule, that teach the extractor.

A layout deals a few given paragraphs into an article and into what stands around
it: menus, headers, footers, sidebars, notices, adverts, forms, comments.  Tags,
attribute words, order, nesting and carelessness vary by chance.  MARK stands at the
start of every piece of main text.
"""

from __future__ import annotations

import html
import random

MARK = "\ue000"
#: Attribute words by what they are usually given to: fixed values.
TOKENS = {
    "nav": "nav navbar navigation menu topnav mainmenu breadcrumb breadcrumbs tabs pagination pager toc links skip",
    "head": "header masthead topbar siteheader branding logo banner hero top",
    "foot": "footer sitefooter bottom colophon copyright legal credits foot",
    "side": "sidebar aside widget widgets side rail related recommended popular trending tags categories archive social share sharing follow more",
    "note": "cookie cookies consent gdpr notice alert popup modal overlay message warning paywall announcement",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion dfp outbrain taboola",
    "form": "form search login signup newsletter subscribe contact register",
    "talk": "comments comment commentlist reply replies respond disqus discussion responses feedback thread reviews",
    "main": "article content post entry main story body text page maincontent primary articlebody postcontent hentry blog single prose",
    "plain": "container wrapper row col inner outer section block box clearfix wrap left right center grid layout site root app module",
}
WORDS = {k: v.split() for k, v in TOKENS.items()}
SEMANTIC = {"nav": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form", "main": "article", "talk": "section", "note": "div", "ad": "div", "plain": "div"}


class Layout:
    def __init__(self, rng: random.Random, paragraphs: list[str]):
        self.rng, self.paragraphs = rng, paragraphs
        self.semantic, self.named, self.careless = rng.random() < 0.5, rng.random() < 0.85, rng.random() < 0.3

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, low: int, high: int) -> range:
        return range(self.rng.randint(low, high))

    def words(self, low: int, high: int) -> str:
        got: list[str] = []
        most = self.rng.randint(low, high)
        while len(got) < most:
            got += self.rng.choice(self.paragraphs).split()[: most - len(got)] or ["x"]
        return html.escape(" ".join(got), quote=False)

    def long(self) -> str:
        text = html.escape(self.rng.choice(self.paragraphs), quote=False)
        if self.chance(0.3):
            parts = text.split(" ")
            k = self.rng.randrange(len(parts))
            tag = self.rng.choice(["b", "i", "em", "strong", 'a href="/x"', 'span class="hl"', "code"])
            # a piece of its own inside the paragraph is main text too
            mark = MARK if tag.startswith("span") and text.startswith(MARK) else ""
            parts[k] = f"<{tag}>{mark}{parts[k]}</{tag.split(' ')[0]}>" + (mark if k + 1 < len(parts) and tag.startswith("span") else "")
            text = " ".join(parts)
        return text

    def attributes(self, kind: str, sure: float = 0.8) -> str:
        if not self.named or not self.chance(sure):
            return self.rng.choice(["", "", ' class="c%d"' % self.rng.randrange(99), ' id="x%d"' % self.rng.randrange(99)])
        first = self.rng.choice(WORDS[kind])
        value = self.rng.choice([first, first, f"{first}-{self.rng.choice(WORDS['plain'])}", f"{self.rng.choice(WORDS['plain'])}-{first}", f"{first} {first}-{self.rng.randrange(9)}", f"{self.rng.choice(WORDS['plain'])} {first}"])
        return f' {self.rng.choice(["class", "class", "id"])}="{value}"'

    def region(self, kind: str, body: str, sure: float = 0.8) -> str:
        tag = SEMANTIC[kind] if self.semantic or kind == "form" and self.chance(0.5) else self.rng.choice(["div", "div", "section", "div"])
        if not self.semantic and tag == "section" and self.chance(0.5):
            tag = "div"
        # a semantic tag says enough by itself
        sure = sure / 2 if tag in ("nav", "header", "footer", "aside", "form", "article") else sure
        return f"<{tag}{self.attributes(kind, sure)}>{body}</{tag}>"

    def close(self, tag: str) -> str:
        return "" if self.careless and tag in ("p", "li", "td", "tr", "dd") and self.chance(0.5) else f"</{tag}>"

    def wrap(self, body: str, most: int = 2) -> str:
        for _ in self.some(0, most):
            body = f"<div{self.attributes('plain', 0.6)}>{body}</div>"
        return body

    def links(self, low: int = 2, high: int = 9) -> str:
        if self.chance(0.7):
            return "<ul>" + "".join(f'<li><a href="/{k}">{self.words(1, 3)}</a>{self.close("li")}' for k in self.some(low, high)) + "</ul>"
        return " | ".join(f'<a href="/{k}">{self.words(1, 3)}</a>' for k in self.some(low, high))

    def form(self) -> str:
        body = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
        if self.chance(0.4):
            body = f"<p>{self.words(4, 20)}{self.close('p')}" + body
        if self.chance(0.2):
            body += "<select><option>a<option>b</select>"
        return self.region("form", body)

    def advert(self) -> str:
        return self.region("ad", self.rng.choice([self.words(2, 12), f"<p>{self.words(5, 30)}</p>", f'<a href="/buy"><img src=x>{self.words(1, 5)}</a>', f"<span>{self.words(3, 10)}</span>"]), 0.95)

    def notice(self) -> str:
        return self.region("note", f"<p>{self.words(5, 40)}{self.close('p')}" + (f"<button>{self.words(1, 2)}</button>" if self.chance(0.6) else "") + (f'<a href="/p">{self.words(1, 3)}</a>' if self.chance(0.4) else ""), 0.95)

    def side(self) -> str:
        out = ""
        for _ in self.some(1, 3):
            out += self.rng.choice([f"<h{self.rng.randint(2, 4)}>{self.words(1, 4)}</h3>" + self.links(2, 6), f"<p>{self.words(6, 50)}{self.close('p')}", self.form(), self.advert()])
        return self.region("side", out, 0.95)

    def talk(self) -> str:
        tag = self.rng.choice(["li", "div", "article" if self.semantic else "div"])
        out = f"<h3>{self.words(1, 3)}</h3>" if self.chance(0.6) else ""
        items = ""
        for k in self.some(1, 6):
            who = self.rng.choice([f'<span class="author">{self.words(1, 2)}</span>', f"<b>{self.words(1, 2)}</b>", f"<cite>{self.words(1, 2)}</cite> <time>{k} h</time>", ""])
            text = "".join(f"<p>{self.rng.choice([self.words(3, 30), self.long()])}{self.close('p')}" for _ in self.some(1, 2))
            items += f"<{tag}{self.attributes('talk')}>{who}{text}" + (f'<a href="/r">{self.words(1, 1)}</a>' if self.chance(0.3) else "") + self.close(tag)
        out += f"<{self.rng.choice(['ol', 'ul'])}>{items}</ol>".replace("</ol>", "</ol></ul>") if tag == "li" else items
        if self.chance(0.3):
            out += self.form()
        return self.region("talk", out, 1.0)

    def article(self) -> str:
        """Main pieces, with MARK, and what may stand between them."""
        heading = f"<h1>{MARK}{self.words(2, 14)}</h1>"
        out = f"<header>{heading}</header>" if self.semantic and self.chance(0.2) else heading if self.chance(0.9) else ""
        if self.chance(0.3):
            out += f"<p><b>{MARK}{self.words(4, 30)}<br>"
        for _ in self.some(1, self.rng.choice([2, 5, 20])):
            kind = self.rng.random()
            if kind < 0.72:
                out += f"<p{self.attributes('main', 0.1)}>{MARK}{self.marked()}{self.close('p')}"
            elif kind < 0.78:
                out += f"<h{(k := self.rng.randint(2, 4))}>{MARK}{self.words(1, 8)}</h{k}>"
            elif kind < 0.83:
                out += "<ul>" + "".join(f"<li>{MARK}{self.words(1, 25)}{self.close('li')}" for _ in self.some(2, 6)) + "</ul>"
            elif kind < 0.87:
                out += f"<blockquote>{MARK}{self.words(5, 60)}</blockquote>"
            elif kind < 0.89:
                out += "<table>" + "".join(f"<tr><td>{MARK}{self.words(1, 4)}{self.close('td')}<td>{MARK}{self.words(1, 4)}{self.close('td')}{self.close('tr')}" for _ in self.some(1, 4)) + "</table>"
            elif kind < 0.91:
                out += f"<pre>{MARK}{self.words(3, 40)}</pre>"
            elif kind < 0.93:
                out += f"<figure><img src=x><figcaption>{MARK}{self.words(3, 15)}</figcaption></figure>"
            elif kind < 0.96:
                out += self.advert()
            elif kind < 0.98:
                out += self.side()
            else:
                out += self.form()
        return out

    def marked(self) -> str:
        text = self.rng.choice([self.long, lambda: self.words(1, 12), self.long])()
        return text.replace('<span class="hl">', f'<span class="hl">{MARK}').replace("</span>", f"</span>{MARK}")

    def page(self) -> str:
        if self.chance(0.06):  # hardly any structure
            body = self.rng.choice([f"{MARK}{self.words(3, 60)}", "".join(f"<p>{MARK}{self.marked()}" for _ in self.some(1, 5)), f"<h1>{MARK}{self.words(2, 8)}</h1>{MARK}{self.words(9, 60)}"])
            return self.rng.choice([body, f"<html><body>{body}</body></html>", f"<html><body><div>{body}</div></body></html>"])
        inside = self.article()
        after = ""
        for p, make in ((0.25, self.side), (0.15, self.form), (0.35, self.talk), (0.15, self.advert)):
            if self.chance(p):
                after += make()
        if self.chance(0.5):
            inside, after = inside + after, ""
        main = self.wrap(self.region("main", self.wrap(inside, 1), 0.85))
        if self.semantic and self.chance(0.3):
            main = f"<main>{main}</main>"
        before = [make() for p, make in (
            (0.25, self.notice), (0.5, lambda: self.region("head", self.wrap(self.words(1, 6), 1) + (self.region("nav", self.links()) if self.chance(0.5) else ""))), (0.7, lambda: self.region("nav", self.links())),
            (0.4, self.advert), (0.2, self.side), (0.15, self.form), (0.15, lambda: self.region("nav", self.links(1, 4))),
        ) if self.chance(p)]
        later = [make() for p, make in ((0.35, self.side), (0.3, self.talk if not after else self.advert), (0.2, self.advert), (0.2, self.notice)) if self.chance(p)]
        if self.chance(0.2):
            self.rng.shuffle(before)
        foot = ""
        if self.chance(0.85):
            foot = self.region("foot", self.rng.choice([f"&copy; {self.words(1, 8)}", f"&copy; {self.words(1, 3)} &middot; {self.words(2, 14)}", f"<p>{self.words(3, 40)}</p>" + self.links(1, 5), self.links(2, 8)]), 0.9)
        middle = after + "".join(later)
        body = "".join(before) + (self.wrap(main + middle) if self.chance(0.5) else main + middle) + foot
        head = f"<head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>" if self.chance(0.8) else ""
        return f"<!DOCTYPE html><html>{head}<body>{self.wrap(body, 2)}" + ("" if self.careless else "</body></html>")


def layouts(paragraphs: list[str], many: int, seed: int) -> list[str]:
    """So many pages with paragraphs of the given ones; where there are none, with words made by rule."""
    rng = random.Random(seed)
    paragraphs = [p for p in paragraphs if p.split()]
    if not paragraphs:
        syllable = [a + b for a in "bdklmnrst" for b in "aeiou"]
        paragraphs = [" ".join("".join(rng.choices(syllable, k=rng.randint(1, 4))) for _ in range(rng.randint(5, 90))) + "." for _ in range(40)]
    return [Layout(rng, paragraphs).page() for _ in range(many)]
