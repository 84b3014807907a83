"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read once, left to right, into leaf blocks: runs of text between block-level tags, each with the
tags, classes and ids of its open ancestors.  Scripts, styles, comments and other markup give no text.  A block's
features come from its ancestors (tag names and the words of class, id and role, by distance) and its text (length, link share,
punctuation, words of menus, notices and adverts, place on the page).  The model scores the label sequence of a
page (article or not) by feature weights and label transitions; it is trained by maximum likelihood (forward-backward gradients) on labelled
pages and applied by Viterbi decoding, page by page, in Arrow batches.

The labelled pages are written by ``labelled_pages`` from a seeded generator of page layouts (semantic tags, class-named
divisions, tables, forms, notices, comments, related links, broken markup), so that they carry no text of the corpus;
``train`` takes any other labelled pages as well.  Training works on ``TRAIN_PAGES`` pages, whatever the size of the input.

Text: character references are decoded, white space inside a block is one space, blocks are trimmed and joined in page order
by two line feeds.  The output is as long as the article; nothing is capped.

Nulls and ties: a null or empty page, or one without an article, has an empty text; a null page_id or url is returned as it
is; repeated rows are each extracted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

TRAIN_PAGES = 700
SEED = 7
# ---- fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style head title noscript template textarea select option svg annotation annotation-xml iframe object canvas".split())
RAW = ("script", "style", "textarea", "title")
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
button label caption""".split())
CLOSES_P = BLOCK - {"button", "label", "caption", "legend", "summary"}
#: Closing one of these also closes what stands open inside it; an open one of the same kind ends at the next.
SELF_ENDING = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
               "option": {"select"}}
#: Elements that an open paragraph outside of them does not end at.
KEEPS_P = ("div", "td", "th", "li", "article", "section", "body", "button")
#: Start tags that a head may hold; any other one, and text, ends an open head.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes script style template".split())
#: Elements that end each other.
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
# ---- end of fixed values

# A quote sign opens a value only behind an equals sign; elsewhere, and in an unquoted value, it is a sign like any other.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>][^\s=/>]*)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")
_RAW_END = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in RAW}
_UNSEEN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_NOSCRIPT_END = re.compile(r"</noscript\s*>", re.I)
_PIECE = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def parse(page: str) -> list[tuple[str, tuple, int, int]]:
    """Leaf blocks in page order: (text, ancestors from the inside out as (tag, names), link characters, place of a start).

    Of the ancestors beyond the two nearest, equal ones are given once.  The open elements are also listed by tag, so that a tag
    costs the same on a page with thousands of unclosed ones.
    """
    out: list[tuple[str, tuple, int, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    trails: list[tuple] = []  # of every open element, the distinct ones up to it
    where: defaultdict[str, list[int]] = defaultdict(list)  # tag -> places in the stack
    blocks: list[int] = []  # places of block elements
    shut: list[int] = []  # places of elements whose content is not shown, noscript apart
    parts: list[str] = []
    hidden = links = in_link = 0
    noscript_end = -1
    owner: tuple = ()

    def flush():
        nonlocal parts, links
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append((text, owner, links, len(out)))
            parts, links = [], 0

    def last(*tags: str) -> int:
        """Place of the innermost open element of these tags, -1 if none."""
        return max((where[t][-1] if where[t] else -1 for t in tags), default=-1)

    def open_(tag: str, names: tuple[str, ...]):
        nonlocal hidden, in_link
        i, above = len(stack), trails[-1] if trails else ()
        stack.append((tag, names))
        trails.append(above if stack[-1] in above else (stack[-1], *above))
        where[tag].append(i)
        if tag in BLOCK:
            blocks.append(i)
        if tag in HIDDEN and tag != "noscript":
            shut.append(i)
        hidden += tag in HIDDEN or "!hidden" in names
        in_link += tag == "a"

    def close(i: int):
        """Close the elements from ``i`` on."""
        nonlocal hidden, in_link
        if blocks and blocks[-1] >= i or any(t in ("head", "title") for t, _ in stack[i:]):
            flush()
        for t, n in stack[i:]:
            hidden -= t in HIDDEN or "!hidden" in n
            in_link -= t == "a"
            where[t].pop()
        for places in (blocks, shut):
            while places and places[-1] >= i:
                places.pop()
        del stack[i:], trails[i:]

    def leave_head(name: str | None):
        """A start tag (None: text) that an open head cannot hold closes it and all in it; the content of a template or of a raw
        element is its own, and so is that of a noscript that ends before the body."""
        nonlocal noscript_end
        head = last("head")
        if head < 0 or name in IN_HEAD or shut[-1] > head:
            return
        if name != "body" and last("noscript") > head:
            if noscript_end < at:
                end = _NOSCRIPT_END.search(page, at)
                noscript_end = end.end() if end else -1
            if noscript_end >= at:
                return
        close(head)

    def add(text: str):
        nonlocal owner, links
        if hidden and not text.isspace():
            leave_head(None)
        if hidden or not text:
            return
        if not parts or not owner:
            owner = (*stack[:-3:-1], *(trails[-3] if len(stack) > 2 else ()))
        parts.append(text)
        if in_link:
            links += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            i = last(name)
            if i < 0 and name == "p":
                flush()
            elif i >= 0 and (name in BLOCK or not blocks or blocks[-1] < i):  # an inline tag does not close a block
                close(i)
            continue
        if hidden:
            leave_head(name)
        if name in CLOSES_P:
            i = last("p")
            if i > last(*KEEPS_P):
                close(i)
            while stack and name != "a" and not _holds_blocks(*stack[-1]):
                close(len(stack) - 1)
            flush()
        if name in SELF_ENDING:
            i = last(*ALIKE.get(name, (name,)))
            if i > last(*SELF_ENDING[name]):
                close(i)
        if name in ("br", "wbr", "hr", "img"):
            add(" " if name != "wbr" else "")
        if name in VOID or m.group(3).endswith("/") and name not in BLOCK:
            continue
        if name in BLOCK or name in ("head", "title"):
            flush()
        open_(name, _names(m.group(3)) if m.group(3) else ())
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end()
            close(len(stack) - 1)
    flush()
    return out


def _holds_blocks(tag: str, names: tuple[str, ...]) -> bool:
    """Whether an open element stays open when a block starts in it: blocks, elements that are not shown, custom elements and
    inline ones with a class or id; a bare inline element was left open by mistake."""
    return tag in BLOCK or tag in HIDDEN or "-" in tag or "!hidden" in names or bool(names) and tag != "a"


@lru_cache(maxsize=20_000)
def _names(attributes: str) -> tuple[str, ...]:
    """Lower-case words of class, id and role; ``!hidden`` for an element that is not shown."""
    found: list[str] = []
    for key, value in _ATTR.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSEEN.search(value):
            found.append("!hidden")
        elif key in ("class", "id", "role", "itemprop"):
            found += _PIECE.findall(_CAMEL.sub(" ", value).lower())
    return tuple(dict.fromkeys(found))


# ---------------------------------------------------------------- features

# Words that name a part of a page in class, id and role attributes, by part.
PARTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumbs toc pagination pager tabs skip sitemap dropdown topbar toolbar",
    "head": "header masthead banner logo branding site top hero",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "sidebar side aside rail widget widgets related recommended recommendations popular trending more secondary complementary teaser teasers",
    "advert": "ad ads advert advertisement adverts adsense sponsor sponsored promo promotion promoted commercial dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup paywall privacy disclaimer",
    "form": "form search login register contact input submit captcha",
    "talk": "comment comments commentary discussion disqus reply replies respond reviews feedback thread",
    "share": "share sharing social tags tag meta byline author date time published categories print tools",
    "text": "article content main body post entry story text page prose articlebody maincontent",
}
PART_OF = {w: part for part, words in PARTS.items() for w in words.split()}
#: Words that often open or fill notices, menus and forms.
CUES = frozenset("cookie cookies subscribe newsletter login register share tweet advertisement sponsored copyright rights reserved comment comments reply menu search privacy terms consent accept".split())
# End of fixed values.


@lru_cache(maxsize=50_000)
def _ancestor_features(owner: tuple) -> tuple[str, ...]:
    got = set()
    for d, (tag, names) in enumerate(owner):
        got.add(f"tag={tag}")
        if d < 2:
            got.add(f"tag{d}={tag}")
        for w in names:
            part = PART_OF.get(w)
            if part:
                got.add(f"part={part}")
                if d < 2:
                    got.add(f"part{d}={part}")
        own = {PART_OF[w] for w in names if w in PART_OF}
        if tag in ("div", "section", "article", "main", "td") and "text" in own and not own - {"text"}:
            got.add("in-text-box")
    kinds = [t for t, _ in owner]
    if not any(t in kinds for t in ("article", "main")):
        got.add("no-article")
    return tuple(sorted(got))


def block_features(blocks: Sequence[tuple]) -> list[list[str]]:
    out = []
    total = len(blocks)
    has_article = any(t in ("article", "main") for b in blocks for t, _ in b[1])
    for i, (text, owner, links, _) in enumerate(blocks):
        n = len(text)
        words = text.count(" ") + 1
        f = list(_ancestor_features(owner))
        f.append("bias")
        f.append(f"words={min(7, words.bit_length())}")
        density = links / n
        f.append("links=all" if density > 0.9 else "links=half" if density > 0.4 else "links=some" if density > 0 else "links=none")
        if text[-1] in ".!?":
            f.append("ends")
        if text.count(",") + text.count(". ") > 1:
            f.append("sentences")
        if "©" in text or "·" in text or "|" in text:
            f.append("mark")
        if words < 40 and not CUES.isdisjoint(_PIECE.findall(text.lower())):
            f.append("cue")
        if has_article and "no-article" in f:
            f.append("outside-article")
        f.append("place=first" if i == 0 else "place=last" if i == total - 1 else "place=mid")
        out.append(f)
    return out


# ---------------------------------------------------------------- the model

def _emissions(features: list[list[str]], weights: dict[str, float]) -> list[float]:
    get = weights.get
    return [sum(get(x, 0.0) for x in f) for f in features]


def viterbi(scores: Sequence[float], trans: Sequence[Sequence[float]], start: Sequence[float]) -> list[int]:
    """The best label sequence; ``scores`` are the emission scores of label 1 against 0.  Ties go to label 0."""
    best, back = [start[0], start[1] + scores[0]], []
    for s in scores[1:]:
        came, nxt = [], []
        for y in (0, 1):
            a, b = best[0] + trans[0][y], best[1] + trans[1][y]
            came.append(0 if a >= b else 1)
            nxt.append(max(a, b) + (s if y else 0.0))
        back.append(came)
        best = nxt
    y = 0 if best[0] >= best[1] else 1
    path = [y]
    for came in reversed(back):
        y = came[y]
        path.append(y)
    return path[::-1]


def train(pages: Sequence[tuple[list[list[str]], list[int]]], rounds: int = 120, l2: float = 0.05) -> dict:
    """Maximum-likelihood weights from (block features, labels) of labelled pages.

    Forward-backward over all pages at once (padded to the longest), plain gradient steps with per-weight scaling."""
    names = sorted({x for f, _ in pages for b in f for x in b})
    at = {x: i for i, x in enumerate(names)}
    P, L = len(pages), max(len(y) for _, y in pages)
    rows = np.concatenate([np.full(len(b), p * L + i) for p, (f, _) in enumerate(pages) for i, b in enumerate(f)])
    cols = np.array([at[x] for f, _ in pages for b in f for x in b])
    real = np.zeros((P, L), bool)
    gold = np.zeros((P, L), int)
    for p, (_, y) in enumerate(pages):
        real[p, :len(y)], gold[p, :len(y)] = True, y
    w, trans, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    pair = real[:, 1:] & real[:, :-1]
    gold_pair = np.zeros((2, 2))
    np.add.at(gold_pair, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    gold_start = np.bincount(gold[:, 0], minlength=2).astype(float)
    gold_w = np.bincount(cols, weights=gold.ravel()[rows].astype(float), minlength=len(names))
    seen = [np.full_like(x, 1e-8) for x in (w, trans, start)]
    for _ in range(rounds):
        e = np.bincount(rows, weights=w[cols], minlength=P * L).reshape(P, L)
        em = np.stack([np.zeros_like(e), e], axis=2)
        fwd = np.empty((P, L, 2))
        fwd[:, 0] = start + em[:, 0]
        for i in range(1, L):
            step = np.logaddexp(fwd[:, i - 1, 0, None] + trans[0], fwd[:, i - 1, 1, None] + trans[1]) + em[:, i]
            fwd[:, i] = np.where(real[:, i, None], step, fwd[:, i - 1])
        bwd = np.zeros((P, L, 2))
        for i in range(L - 2, -1, -1):
            nxt = em[:, i + 1] + bwd[:, i + 1]
            step = np.logaddexp(trans[:, 0] + nxt[:, 0, None], trans[:, 1] + nxt[:, 1, None])
            bwd[:, i] = np.where(real[:, i + 1, None], step, 0.0)
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        mark = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None]) * real
        joint = np.exp(fwd[:, :-1, :, None] + trans + (em + bwd)[:, 1:, None, :] - z[:, None, None, None]) * pair[:, :, None, None]
        grads = (gold_w - np.bincount(cols, weights=mark.ravel()[rows], minlength=len(names)) - l2 * w,
                 gold_pair - joint.sum(axis=(0, 1)) - l2 * trans,
                 gold_start - np.array([P - mark[:, 0].sum(), mark[:, 0].sum()]) - l2 * start)
        for x, g, s in zip((w, trans, start), grads, seen):
            s += g * g
            x += 0.5 * g / np.sqrt(s)
    return {"weights": {x: float(v) for x, v in zip(names, w)}, "trans": trans.tolist(), "start": start.tolist()}


def extract(page: str | None, model: dict) -> str:
    blocks = parse(page) if page else []
    if not blocks:
        return ""
    labels = viterbi(_emissions(block_features(blocks), model["weights"]), model["trans"], model["start"])
    return "\n\n".join(b[0] for b, y in zip(blocks, labels) if y)


# ---------------------------------------------------------------- labelled pages

def labelled_pages(count: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, list[str]]]:
    """(html, the article's blocks) from a seeded generator of page layouts over invented words."""
    rng = random.Random(seed)
    syllables = "ba ko ri ten mu sal ver no lia dor quin esh ül çe ando pre sti ga wen zo".split()

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def phrase(a, b):
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence():
        s = phrase(1, 14).capitalize()
        return s + rng.choice([".", ".", ".", "!", "?", ","][:5])

    def noisy(s):
        kind = rng.random()
        if kind < 0.06:
            return s.upper()
        if kind < 0.12:
            return " ".join(x + rng.choice(["%%%", "***", "$$$", "###"]) for x in s.split())
        if kind < 0.16:
            return s.replace(" ", " | ")
        return s

    def para():
        return noisy(" ".join(sentence() for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9]))))

    def links(n):
        return [f'<a href="/{word()}">{phrase(1, 3)}</a>' for _ in range(n)]

    def listing(n):
        return "<ul>" + "".join(f"<li>{x}" + rng.choice(["</li>", "</li>", ""]) for x in links(n)) + "</ul>"

    def attr(*names):
        name = rng.choice(names)
        return rng.choice([f' class="{name}"', f' id="{name}"', f' class="{word()} {name}"', f" class='{name}-{word()}'"])

    def boiler(kind):
        if kind == "menu":
            return rng.choice([f"<nav>{listing(rng.randint(2, 8))}</nav>", f"<div{attr('menu', 'navbar', 'nav', 'breadcrumbs', 'topbar')}>{listing(rng.randint(2, 8))}</div>",
                               f"<div{attr('breadcrumb', 'nav')}>{' &gt; '.join(links(3))}</div>", f"<table{attr('nav', 'menu')}><tr><td>{'</td><td>'.join(links(4))}</td></tr></table>"])
        if kind == "head":
            return rng.choice([f"<header><h1>{phrase(1, 4)}</h1><p>{phrase(2, 6)}</p></header>", f"<div{attr('header', 'masthead', 'site-header', 'banner')}><span>{phrase(1, 3)}</span> {phrase(1, 5)}</div>",
                               f"<header{attr('top')}><a href='/'>{phrase(1, 2)}</a><p>{sentence()}</p></header>"])
        if kind == "foot":
            return rng.choice([f"<footer>&copy; {word()}.example.com &middot; {sentence()}</footer>", f"<footer><p>{sentence()}</p>{listing(3)}</footer>",
                               f"<div{attr('footer', 'copyright', 'bottom', 'legal')}>&copy; 20{rng.randint(10, 29)} {phrase(1, 4)}. {sentence()}</div>"])
        if kind == "side":
            return rng.choice([f"<aside><h3>{phrase(1, 3)}</h3><p>{para()}</p>{listing(3)}</aside>", f"<div{attr('sidebar', 'widget', 'related', 'rail')}><h4>{phrase(1, 3)}</h4><p>{para()}</p></div>",
                               f"<aside{attr('related')}>{para()}</aside>", f"<section{attr('related', 'recommended', 'trending')}><h2>{phrase(1, 3)}</h2>{listing(4)}</section>"])
        if kind == "advert":
            return rng.choice([f"<div{attr('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo')}>{para()}</div>", f"<section{attr('ad', 'promo')}><p>{sentence()}</p></section>",
                               f"<div{attr('ad', 'sponsor')}><a href='/x'>{phrase(3, 9)}</a></div>", f"<p{attr('ad', 'advert', 'sponsored')}>{para()}</p>"])
        if kind == "notice":
            return rng.choice([f"<div{attr('cookie', 'cookie-banner', 'consent', 'notice', 'newsletter', 'alert', 'popup')}><p>{para()}</p><button>{phrase(1, 2)}</button></div>",
                               f"<div role='dialog'{attr('modal', 'gdpr')}>{sentence()} {sentence()}</div>", f"<p{attr('notice', 'disclaimer', 'subscribe')}>{para()}</p>",
                               f"<dialog open>{sentence()}</dialog>", f"<div role='alert'>{para()}</div>"])
        if kind == "form":
            return rng.choice([f"<form action='/s'><label>{phrase(1, 3)}</label><input name=q><button>{word()}</button></form>",
                               f"<form{attr('login', 'contact')}><p>{sentence()}</p><select><option>{word()}<option>{word()}</select><textarea>{phrase(2, 4)}</textarea></form>",
                               f"<fieldset><legend>{phrase(1, 3)}</legend><label>{phrase(1, 2)}</label></fieldset>"])
        if kind == "talk":
            each = "".join(rng.choice([f"<div{attr('comment', 'reply')}><b>{word()}</b><p>{para()}</p></div>", f"<li><p>{para()}</p></li>", f"<article{attr('comment')}><p>{para()}</p></article>"])
                           for _ in range(rng.randint(1, 4)))
            return rng.choice([f"<section{attr('comments', 'discussion', 'responses')}><h3>{phrase(1, 3)}</h3>{each}</section>", f"<div{attr('comments', 'comment-list', 'disqus_thread')}>{each}</div>",
                               f"<ol{attr('commentlist', 'comments', 'comment-list')}>{each}</ol>"])
        if kind == "share":
            return rng.choice([f"<div{attr('share', 'social', 'tags', 'byline', 'meta')}>{rng.choice([' '.join(links(3)), phrase(2, 6)])}</div>", f"<ul{attr('tags', 'share')}><li>{'</li><li>'.join(links(2))}</li></ul>"])
        return rng.choice([f"<script>var t='</p>';{word()}(0);</script>", f"<style>.{word()}{{margin:0}}</style>", f"<!-- {phrase(1, 5)} <p>{word()}</p> -->", f"<noscript>{sentence()}</noscript>"])

    def article():
        good, parts = [], []

        def text(s, shown=None):
            good.append(" ".join((shown or s).split()))
            return s.replace("&", "&amp;")

        if rng.random() < 0.8:
            t = noisy(phrase(2, 10))
            parts.append(f"<h1>{text(t)}</h1>")
        for _ in range(rng.choice([1, 2, 3, 4, 6, 8, 12])):
            kind = rng.random()
            if kind < 0.62:
                s = text(para())
                parts.append(rng.choice([f"<p>{s}</p>", f"<p>{s}</p>", f"<p>{s}", f"<div>{s}</div>", f"<p><b>{s}<br>"]))
            elif kind < 0.70:
                h = rng.choice(["h2", "h2", "h3", "h4"])
                parts.append(f"<{h}>{text(phrase(1, 6))}</{h}>")
            elif kind < 0.77:
                h = rng.choice(["ul", "ol"])
                parts.append(f"<{h}>" + "".join(f"<li>{text(sentence())}</li>" for _ in range(rng.randint(1, 4))) + f"</{h}>")
            elif kind < 0.79:
                s = text(phrase(2, 8))
                parts.append(rng.choice([f"<figure><img src=x><figcaption>{s}</figcaption></figure>", f"<section><p>{s}</p></section>", f"<dl><dt>{s}</dl>",
                                         f"<p><em>{s}</em></p>", f"<p><span class='{word()}'>{s}</span></p>"]))
            elif kind < 0.82:
                parts.append(f"<blockquote><p>{text(para())}</p></blockquote>")
            elif kind < 0.86:
                a, b, c = phrase(2, 6), phrase(1, 3), phrase(2, 8) + "."
                good.append(f"{a} {b} {c}")
                parts.append(f"<p>{a} <a href='/y'>{b}</a> {c}</p>")
            elif kind < 0.90:
                parts.append("<table>" + "".join(f"<tr><td>{text(phrase(1, 4))}</td><td>{text(phrase(1, 3))}</td></tr>" for _ in range(2)) + "</table>")
            elif kind < 0.93:
                parts.append(f"<pre>{text(phrase(3, 9))}</pre>")
            else:
                parts.append(boiler(rng.choice(["advert", "advert", "share", "side", "notice", "form", "raw"])))
        if rng.random() < 0.12:
            parts.append(boiler("talk"))
        inner = "".join(parts)
        box = rng.choice([("<article>", "</article>")] * 8 + [("<main>", "</main>"), ("<main><article>", "</article></main>"), ("<div class='content'>", "</div>"), ("<div id='main-content'>", "</div>"),
                          ("<div class='post entry'>", "</div>"), ("<div class='story-body'>", "</div>"), ("<section itemprop='articleBody'>", "</section>"), ("<table><tr><td class='content'>", "</td></tr></table>"), ("<div>", "</div>"), ("", "")])
        if box[0].startswith("<table") and "<table>" in inner:
            box = ("<article>", "</article>")
        return good, box[0] + inner + box[1]

    out = []
    while len(out) < count:
        before = [boiler(k) for k in ("menu", "head", "advert", "notice", "form", "share", "side", "raw") if rng.random() < 0.4]
        after = [boiler(k) for k in ("side", "talk", "advert", "notice", "form", "menu", "share", "raw") if rng.random() < 0.3]
        rng.shuffle(before)
        rng.shuffle(after)
        if rng.random() < 0.85:
            after.append(boiler("foot"))
        good, inner = article() if rng.random() < 0.97 else ([], "")
        wrap = rng.choice([("", "")] * 3 + [("<div class='wrapper'>", "</div>"), ("<div id='page'>", "</div>")])
        head = f"<head><meta charset='utf-8'><title>{phrase(1, 6)}</title><style>p{{margin:0}}</style></head>"
        out.append((f"<!DOCTYPE html><html>{head}<body>{wrap[0]}{''.join(before)}{inner}{''.join(after)}{wrap[1]}</body></html>", good))
    return out


def training_set(pages: Sequence[tuple[str, list[str]]]) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels: the article's blocks are found among the page's blocks in order."""
    out = []
    for page, good in pages:
        blocks = parse(page)
        labels, k = [0] * len(blocks), 0
        for i, b in enumerate(blocks):
            if k < len(good) and b[0] == good[k]:
                labels[i] = 1
                k += 1
        if k == len(good) and blocks:
            out.append((block_features(blocks), labels))
    return out


@lru_cache(maxsize=1)
def default_model() -> dict:
    return train(training_set(labelled_pages()))


def extract_text(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x.as_py(), model) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


QUERIES = {"op1_extract": op1_extract}
ORACLES: dict[str, str] = {}
