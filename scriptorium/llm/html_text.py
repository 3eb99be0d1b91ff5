"""Operator 7: main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, in page order. A block's features are the tags and
the roles (from class, id and role attributes) of its ancestors, and its own text: length, links, punctuation, typical
phrases. The chain has two states, main text and other; weights are learnt in numpy by gradient ascent on the likelihood
of labelled pages (see ``page_generator``), and a page is decoded by Viterbi, all pages of an Arrow batch together.

Defined results: null or empty html gives an empty text; script, style, textarea, title and comments are no blocks, nor is
the content of IGNORED elements; such an element without an end tag is empty, any other ends where its parent ends; the
text of math is part of its sentence; only an unclosed raw text element hides the rest of a page; white space is what
str.split() splits at, no-break spaces included; repeated rows get equal results; an empty table gives no rows; a column
of the output's name is replaced by ``extract_main_text``, and others are not read; a page of any length is read whole.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Their content is text up to their end tag, or to the end of the page.
RAW = "script|style|textarea|title"
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW.split("|")}
#: Elements whose content is not shown as text; one without an end tag is taken as empty.
IGNORED = frozenset("noscript template svg iframe object canvas select audio video annotation annotation-xml".split())
#: '/>' closes these and what is in them; the slash of an unquoted value is none.
FOREIGN = frozenset("svg math".split())
_SLASH = re.compile(r"(?:\A|[\s\"'])[^\s\"'=]*/\Z")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mspace msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key closes an open element of the values.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A start tag of these closes an open p.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure details".split())
#: Closing a p or li looks no further up than these.
SCOPE = frozenset("html body article section main div td th table ul ol blockquote aside nav header footer form figure dl".split())
ROLES = {
    "comment": "comment comments commentlist reply replies respond disqus discussion feedback",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner dfp adsense adbox",
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination toc skip",
    "foot": "footer foot copyright legal colophon bottom imprint",
    "head": "header head masthead topbar top logo branding banner hero",
    "side": "sidebar side aside widget widgets rail related recommended recommendations popular trending more tags tagcloud",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe subscription paywall toast privacy message",
    "share": "share sharing social follow buttons button toolbar tools meta byline",
    "form": "form search searchbox login signin signup register contact",
    "main": "article content post entry story main body text page maincontent articlebody prose",
}
_ROLE_OF: dict[str, list[str]] = {}
for _role, _words in ROLES.items():
    for _word in _words.split():
        _ROLE_OF.setdefault(_word, []).append("r:" + _role)
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PHRASES = {
    "x:notice": re.compile(r"\b(?:cookies?|consent|gdpr|privacy|accept all|we use)\b", re.I),
    "x:subscribe": re.compile(r"\b(?:subscribe|newsletter|sign up|log ?in|register|password|e-?mail)\b", re.I),
    "x:share": re.compile(r"\b(?:share|tweet|follow us|facebook|twitter|whatsapp)\b", re.I),
    "x:comment": re.compile(r"\b(?:comments?|repl(?:y|ies)|says|posted by|permalink)\b", re.I),
    "x:ad": re.compile(r"\b(?:advertis\w*|sponsored|promoted|buy now|shop now|special offer)\b", re.I),
    "x:rights": re.compile(r"©|\(c\)|\bcopyright\b|\ball rights reserved\b|\bterms of (?:use|service)\b", re.I),
    "x:more": re.compile(r"\b(?:read more|related|recommended|popular|trending|next|previous|home|search|menu|contact|about us)\b", re.I),
}
_ANY_PHRASE = re.compile("|".join(f"(?:{p.pattern})" for p in _PHRASES.values()), re.I)
FEATURES: dict[str, int] = {}


def _f(name: str) -> int:
    return FEATURES.setdefault(name, len(FEATURES))


for _name in [
    *(f"t:{t}" for t in "nav header footer aside form article main section figure figcaption table ul ol dl blockquote pre button label a body div".split()),
    *(f"b:{t}" for t in "h1 h2 h3 h4 h5 h6 p li td th dt dd pre blockquote div figcaption other".split()),
    *(f"r:{r}" for r in ROLES), *_PHRASES,
    *(f"n:{i}" for i in range(6)), *(f"l:{i}" for i in range(4)), "e:stop", "e:colon", "e:none", "c:comma", "c:digits", "c:upper", "p:first", "p:last", "p:head", "p:after", "bias",
]:
    _f(_name)
_ROLES_OF_ATTRS: dict[str, tuple] = {}
MAIN, OTHER = 1, 0


def _roles(attrs: str) -> tuple:
    """Features of a tag's class, id and role attributes."""
    got = _ROLES_OF_ATTRS.get(attrs)
    if got is None:
        words = {w for m in _ATTR.finditer(attrs) for w in re.split(r"[^a-z0-9]+", _CAMEL.sub("-", m[1] or m[2] or m[3] or "").lower())}
        got = tuple(sorted({FEATURES[r] for w in words for r in _ROLE_OF.get(w, ())}))
        if len(_ROLES_OF_ATTRS) > 20_000:
            _ROLES_OF_ATTRS.clear()
        _ROLES_OF_ATTRS[attrs] = got
    return got


def _tokens(page: str) -> tuple[list[tuple], set[int]]:
    """Tags of a page, (start, end, "/" or "", name, attributes), raw text elements being one nameless tag with their
    content; and the places in that list of ignored elements that have an end tag of their own."""
    out: list[tuple] = []
    opened: dict[str, list[int]] = {}
    closed: set[int] = set()
    search = _TAG.search
    at, end = 0, len(page)
    while at < end and (m := search(page, at)):
        start, at = m.span()
        raw, name = m[1], m[4]
        if raw:
            foreign = opened.get("svg") or opened.get("math")
            if not (foreign and _SLASH.search(m[2])):
                close = _ENDS[raw.lower()].search(page, at)
                at = close.end() if close else at if foreign else end
            out.append((start, at, "", "", ""))
            continue
        name = name.lower() if name else ""
        if name in IGNORED or name in FOREIGN:
            if m[3]:
                if own := opened.get(name):
                    closed.add(own.pop())
            elif not (name in FOREIGN and _SLASH.search(m[5])):
                opened.setdefault(name, []).append(len(out))
        out.append((start, at, m[3] or "", name, m[5] or ""))
    return out, closed


def blocks(page: str | None) -> list[tuple[str, str, frozenset, int]]:
    """Leaf blocks of a page: (text, block tag, ancestor features, characters inside links)."""
    out: list = []
    if not page:
        return out
    stack: list[tuple[str, frozenset]] = []
    none: frozenset = frozenset()
    parts: list[str] = []
    linked = links = 0
    at = 0
    off = -1  # place in stack of the outermost ignored element

    def flush():
        nonlocal linked
        text = "".join(parts)
        parts.clear()
        n, linked = linked, 0
        if not text or text.isspace():
            return
        if "&" in text:
            text = html_lib.unescape(text)
        text = " ".join(text.split())
        if not text:
            return
        tag = next((t for t, _ in reversed(stack) if t not in INLINE), "other")
        out.append((text, tag, stack[-1][1] if stack else none, n))

    def pop_to(i: int):
        nonlocal links, off
        links -= sum(t == "a" for t, _ in stack[i:])
        del stack[i:]
        if off >= i:
            off = -1

    tokens, closed = _tokens(page)
    tokens.append((len(page), len(page), "", "", ""))
    for k, (stop, after, slash, name, attrs) in enumerate(tokens):
        if stop > at and off < 0:
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        at = after
        if not name:
            continue
        if slash:
            i = len(stack) - 1
            while i >= 0 and stack[i][0] != name:
                i -= 1
            if off >= 0:
                if i >= off:
                    pop_to(i)
                    continue
                if i < 0 or name in INLINE:
                    continue
                pop_to(off)  # its parent ends
            if name not in INLINE and name not in IGNORED:
                flush()
            if i >= 0 and (name not in INLINE or all(t in INLINE for t, _ in stack[i:])):
                pop_to(i)
            continue
        if name in VOID:
            if off >= 0:
                continue
            if name == "br":
                parts.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in IGNORED:
            if k in closed:
                stack.append((name, stack[-1][1] if stack else none))
                if off < 0:
                    off = len(stack) - 1
            continue
        if name == "head":  # what may be in a head holds no text, and the rest ends it
            flush()
            continue
        if attrs.endswith("/") and _SLASH.search(attrs) and (name in FOREIGN or any(t in FOREIGN for t, _ in stack)):
            continue
        if name not in INLINE:
            if off < 0:
                flush()
            own = CLOSES.get(name, none) | ({"p"} if name in ENDS_P else none)
            if own:
                for i in range(len(stack) - 1, off, -1):
                    t = stack[i][0]
                    if t in own:
                        pop_to(i)
                        break
                    if t in SCOPE:
                        break
        elif name == "mtd" and off < 0:
            parts.append(" ")
        if attrs.endswith("/") and name not in INLINE and len(attrs) < 2:
            continue
        feats = stack[-1][1] if stack else none
        t = FEATURES.get("t:" + name)
        extra = (_roles(attrs) if attrs and "=" in attrs else ()) + ((t,) if t is not None else ())
        if extra and not feats.issuperset(extra):
            feats = feats.union(extra)
        stack.append((name, feats))
        if name == "a":
            links += 1
    flush()
    return out


def features(found: list) -> list[list[int]]:
    """Feature numbers of each block."""
    out, seen = [], False
    g = FEATURES
    last = len(found) - 1
    for i, (text, tag, above, linked) in enumerate(found):
        own = list(above)
        own.append(g.get("b:" + tag, g["b:other"]))
        n = text.count(" ") + 1
        own.append(g[f"n:{0 if n < 2 else 1 if n < 5 else 2 if n < 10 else 3 if n < 20 else 4 if n < 50 else 5}"])
        share = linked / len(text)
        own.append(g[f"l:{0 if not linked else 1 if share < 0.3 else 2 if share < 0.8 else 3}"])
        end = text[-1]
        own.append(g["e:stop" if end in ".!?…\"”»)" else "e:colon" if end in ":;," else "e:none"])
        if "," in text:
            own.append(g["c:comma"])
        if n < 30:
            if sum(c.isdigit() for c in text) * 4 > len(text):
                own.append(g["c:digits"])
            if text.isupper():
                own.append(g["c:upper"])
        if n < 60 and _ANY_PHRASE.search(text):
            own += [g[k] for k, p in _PHRASES.items() if p.search(text)]
        if i == 0:
            own.append(g["p:first"])
        if i == last:
            own.append(g["p:last"])
        if tag == "h1":
            seen = True
        own.append(g["p:after" if seen else "p:head"])
        own.append(g["bias"])
        out.append(own)
    return out


class ChainModel:
    """Two-state linear-chain conditional random field."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, first: np.ndarray):
        self.emit, self.move, self.first = emit, move, first

    @staticmethod
    def _grid(pages: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(flat feature numbers, where each block's begin, place of each block in its page, page of each block)."""
        sizes = np.array([len(b) for p in pages for b in p], np.int64)
        flat = np.fromiter((i for p in pages for b in p for i in b), np.int64, int(sizes.sum()))
        n = np.array([len(p) for p in pages], np.int64)
        page = np.repeat(np.arange(len(pages)), n)
        step = np.arange(len(page)) - np.repeat(np.cumsum(n) - n, n)
        return flat, np.cumsum(sizes) - sizes, step, page

    def _scores(self, flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.emit[flat], begin, axis=0) if len(begin) else np.zeros((0, 2))

    def decode(self, pages: list[list[list[int]]]) -> list[np.ndarray]:
        """The best states of each page, by Viterbi over all pages at once; a tie keeps state 0."""
        n = np.array([len(p) for p in pages], np.int64)
        if not n.sum():
            return [np.zeros(0, np.int64) for _ in pages]
        flat, begin, step, page = self._grid(pages)
        score = self._scores(flat, begin)
        order = np.argsort(-n, kind="stable")
        start = np.cumsum(n) - n
        states = np.zeros(len(page), np.int64)
        live = np.searchsorted(-n[order], -np.arange(1, n.max() + 1), "right")
        best = self.first + score[start[order[: live[0]]]]
        back = []
        finals = np.zeros((len(pages), 2))
        finals[: live[0]] = best
        for t in range(1, int(n.max())):
            k = live[t]
            path = best[:k, :, None] + self.move
            from_ = path.argmax(axis=1)
            back.append(from_)
            best = np.take_along_axis(path, from_[:, None, :], 1)[:, 0] + score[start[order[:k]] + t]
            finals[:k] = best
        now = finals.argmax(axis=1)
        for t in range(int(n.max()) - 1, -1, -1):
            k = live[t]
            states[start[order[:k]] + t] = now[:k]
            if t:
                now[:k] = back[t - 1][np.arange(k), now[:k]]
        return np.split(states, np.cumsum(n)[:-1])

    def gradients(self, pages: list[list[list[int]]], labels: list[list[int]]) -> tuple[float, list[np.ndarray]]:
        """Log likelihood of the labels and its gradients for emit, move and first; every page has a block."""
        flat, begin, step, page = self._grid(pages)
        n = np.array([len(p) for p in pages])
        y = np.array([v for own in labels for v in own])
        longest = int(n.max())
        cell = page * longest + step
        block_of = np.repeat(np.arange(len(page)), np.diff(np.append(begin, len(flat))))
        gold = np.zeros((len(pages), longest), np.int64)
        gold.ravel()[cell] = y
        mask = np.arange(longest) < n[:, None]
        both = mask[:, 1:]
        own = self._scores(flat, begin)
        s = np.zeros((len(pages) * longest, 2))
        s[cell] = own
        s = s.reshape(len(pages), longest, 2)
        fwd, bwd = np.zeros_like(s), np.zeros_like(s)
        fwd[:, 0] = self.first + s[:, 0]
        for t in range(1, longest):
            fwd[:, t] = np.where(mask[:, t, None], np.logaddexp(fwd[:, t - 1, 0, None] + self.move[0], fwd[:, t - 1, 1, None] + self.move[1]) + s[:, t], fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = s[:, t + 1] + bwd[:, t + 1]
            got = np.logaddexp(self.move[:, 0] + nxt[:, 0, None], self.move[:, 1] + nxt[:, 1, None])
            bwd[:, t] = np.where(mask[:, t + 1, None], got, 0)
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        p = np.exp(fwd + bwd - z[:, None, None])
        pair = np.exp(fwd[:, :-1, :, None] + self.move + (s[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
        diff = -p.reshape(-1, 2)[cell]
        diff[np.arange(len(y)), y] += 1
        per = diff[block_of]
        moves = np.bincount((gold[:, :-1] * 2 + gold[:, 1:])[both], minlength=4).reshape(2, 2)
        starts = np.bincount(gold[:, 0], minlength=2)
        g_emit = np.stack([np.bincount(flat, per[:, k], len(FEATURES)) for k in (0, 1)], 1)
        value = own[np.arange(len(y)), y].sum() + (moves * self.move).sum() + (starts * self.first).sum() - z.sum()
        return float(value), [g_emit, moves - pair[both].sum(axis=0), starts - p[:, 0].sum(axis=0)]

    @classmethod
    def fit(cls, pages: list[list[list[int]]], labels: list[list[int]], steps: int = 120, rate: float = 0.15, ridge: float = 1e-3) -> "ChainModel":
        keep = [i for i, p in enumerate(pages) if p]
        pages, labels = [pages[i] for i in keep], [labels[i] for i in keep]
        model = cls(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.zeros(2))
        params = [model.emit, model.move, model.first]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for it in range(1, steps + 1):
            for q, g, mm, vv in zip(params, model.gradients(pages, labels)[1], m, v):
                g = g / len(pages) - ridge * q
                mm *= 0.9
                mm += 0.1 * g
                vv *= 0.99
                vv += 0.01 * g * g
                q += rate * (mm / (1 - 0.9**it)) / (np.sqrt(vv / (1 - 0.99**it)) + 1e-8)
        return model


def extract(pages: list[str | None], model: ChainModel) -> list[str]:
    """Main text of each page."""
    found = [blocks(p) for p in pages]
    states = model.decode([features(b) for b in found])
    return ["\n".join(x[0] for x, s in zip(b, own.tolist()) if s == MAIN) for b, own in zip(found, states)]


def train(pages: list[tuple[str, list[str]]]) -> ChainModel:
    """A model from labelled pages: (html, texts of its main blocks)."""
    found = [blocks(h) for h, _ in pages]
    labels = [[int(x[0] in own) for x in b] for b, own in zip(found, (set(t) for _, t in pages))]
    return ChainModel.fit([features(b) for b in found], labels)


def extract_main_text(pages: DataFrame, model: ChainModel, *, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with the main text of their html, never null."""

    @F.arrow_udf("string")
    def main_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            out: list[str] = []
            for at in range(0, len(col), 256):
                out += extract(col.slice(at, 256).to_pylist(), model)
            yield pa.array(out, pa.string())

    return pages.withColumn(text_col, main_text(F.col(html_col)))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .page_generator import labelled_pages

    model = train(labelled_pages())
    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), model)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
