"""Review-page fields from HTML, with the standard library's parser."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

# FIXED VALUES: elements that never hold content, and elements whose content is no text
VOID = "area base br col embed hr img input link meta param source track wbr".split()
NO_TEXT = ("script", "style")
#: Elements whose content the parser reads by rules of their own.
RAW = {"script", "style", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math"}
#: A tag with double-quoted attributes without entities, or text up to the next tag.
PLAIN = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z-]*="[^"<>&]*")*)[ \t\n\r\f]*>|([^<]+)')
ATTR = re.compile(r'([a-zA-Z][a-zA-Z-]*)="([^"]*)"')
DOCTYPE = "<!DOCTYPE html>"


def _element(tag, attrs):
    """(tag, kinds, class tokens, is a rating, href) of a start tag."""
    a = {}
    for k, v in attrs:
        a.setdefault(k, v or "")
    tokens = a.get("class", "").split()
    kinds = [tag] if tag in ("h1", "h3", "p") else []
    kinds += [k for c, k in (("user-name", "users"), ("important", "chars"), ("comment-content", "reviews"),
                             ("track_BreadCrumbs_Brand", "brands")) if c in tokens]
    if tag == "div" and "date" in tokens:
        kinds.append("dates")
    if a.get("id") == "hold-ingredients":
        kinds.append("ingredients")
    return tag, kinds, tokens, tag == "span" and "l-" in a.get("class", "") and bool(tokens), a.get("href")


@lru_cache(4096)
def _plain_element(tag, attrs):
    return _element(tag.lower(), [(k.lower(), v) for k, v in ATTR.findall(attrs)])


class ReviewPage(HTMLParser):
    """Collects the elements that the review fields are read from.

    An element's text is all text below it, in order, entities decoded, without comments,
    scripts and styles. A class matches as one token of the attribute, whatever the tag. An
    end tag closes the nearest open element of its name and all inside it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = []  # [tag, kinds, text parts, number of children, text of an only child, first class, href]
        self.found = {k: [] for k in ("h1", "h3", "p", "users", "chars", "reviews", "dates", "lipies",
                                      "ingredients", "brands", "brand_href")}
        self.title = False

    def handle_starttag(self, tag, attrs):
        self._start(*_element(tag, attrs))

    def _start(self, tag, kinds, tokens, rating, href):
        if tag == "title":
            self.title = True
        if rating and any(e[0] == "div" and "lipies" in e[5] for e in self.open):
            self.found["lipies"].append(tokens[0])
        spots = [(k, len(self.found[k])) for k in kinds]
        for k in kinds:  # a place in document order, filled when the element ends
            self.found[k].append(None)
        if "brands" in kinds:
            self.found["brand_href"].append(href)
        self.open.append([tag, spots, [], 0, None, tokens])
        if tag in VOID:
            self._close()

    def feed_plain(self, html):
        """Feed a page that holds plain tags and text only, as ``feed`` does; False, with nothing
        fed, if it holds anything else."""
        at, steps = len(DOCTYPE) if html.startswith(DOCTYPE) else 0, []
        title = False
        for m in PLAIN.finditer(html, at):
            if m.start() != at:
                return False
            at = m.end()
            end, tag, attrs, text = m.groups()
            if text is not None:
                steps.append((self.handle_data, (unescape(text) if "&" in text else text,)))
            elif end:
                tag = tag.lower()
                if attrs or title and tag != "title":
                    return False
                title = False
                steps.append((self.handle_endtag, (tag,)))
            else:
                element = _plain_element(tag, attrs)
                if title or element[0] in RAW:
                    return False
                title = element[0] == "title"
                steps.append((self._start, element))
        if at != len(html) or title:
            return False
        for step, args in steps:
            step(*args)
        return True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self._close()
                return

    def handle_data(self, data):
        if self.open:
            top = self.open[-1]
            if top[0] not in NO_TEXT:
                top[2].append(data)
            top[3] += 1
            top[4] = data

    def handle_comment(self, data):
        if self.open:
            self.open[-1][3] += 1
            self.open[-1][4] = None

    def _close(self):
        tag, spots, parts, children, only, _ = self.open.pop()
        text = "".join(parts)
        only = only if children == 1 else None
        for kind, at in spots:
            # a paragraph counts by its text only if that is its only content
            self.found[kind][at] = (only, text) if kind == "p" else text
        if self.open:
            up = self.open[-1]
            if tag not in NO_TEXT:
                up[2].append(text)
            up[3] += 1
            up[4] = only

    def finish(self):
        self.close()
        while self.open:
            self._close()


def page_fields(html: str | None) -> dict:
    """Scalars (None where the page has no such element) and arrays of one page."""
    page = ReviewPage()
    if not page.feed_plain(html or ""):
        page.feed(html or "")
    page.finish()
    f = page.found
    paragraph = lambda s: next((text for only, text in f["p"] if only is not None and s in only), None)
    first = lambda k, i=0: f[k][i] if len(f[k]) > i else None
    return {"has_title": page.title, "names": first("h1", 1), "ratings": first("h3"),
            "repurchases": paragraph("would repurchase"), "pkg_quals": paragraph("Package Quality"),
            "prices": paragraph("Price"), "ingredients": first("ingredients"), "brands": first("brands"),
            "brand_href": first("brand_href"), "users_a": f["users"], "chars_a": f["chars"],
            "reviews_a": f["reviews"], "lipies_a": f["lipies"], "dates_a": f["dates"]}
