"""HTML extraction with a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block
tags, each with the path of tags, classes and ids that leads to it.  A
bidirectional LSTM in numpy reads a vector per block, made of learned vectors
of the hashed path parts and hashed words and a few numbers, and labels every
block as main text or not from the whole page.  The main text is the text of
the blocks labelled so, in page order.

The labeller is trained on the driver with pages that :func:`make_page` builds
from a seed, so their labels are known.  They vary in layout, in names (a quarter
of which say nothing) and in language, from whole portals to a bare text
without any tag; nothing of the pages to be read is learned from.  The weights
are kept in the shared folder under a hash of this module, so one session
trains and later ones read (:func:`model`).  Reading pages is one narrow stage,
with memory bounded by a batch of pages, and takes time in proportion to a
page's length, however deep its tags are nested.
"""

from __future__ import annotations

import hashlib
import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from panelforge.llm.common import shared_dir, slices, without

PATH_BUCKETS, WORD_BUCKETS, WIDTH, HIDDEN, NUMBERS = 4096, 1 << 14, 24, 16, 9

#: In a tag only a quote after = opens a string.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>])*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_RAW = frozenset("script style".split())
#: An opening tag of the first kind ends an open element of the second kind.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class _Hashed(dict):
    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, part: str) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[part] = zlib.crc32(part.encode("utf-8", "replace")) % self.buckets
        return found


_path_bucket, _word_bucket = _Hashed(PATH_BUCKETS).__getitem__, _Hashed(WORD_BUCKETS).__getitem__


#: Elements that an implied end tag may be looked for through, as inline ones are.
_OPEN = frozenset("p td th dd dt".split())


class Blocks(list):
    """(place of its path, leaf tag, text, share of linked characters) of every block with text, in page order.

    ``paths`` has the place of each path's parent, which comes before it, and
    the buckets that it adds to this; so a path costs what it adds, however
    deep it is.  The first is the empty path.
    """

    def __init__(self, found=(), paths=None) -> None:
        super().__init__(found)
        self.paths: list[tuple[int, tuple[int, ...]]] = [(-1, ())] if paths is None else paths


class _Stack:
    """The open elements, with what a block needs of them kept per element, so that nothing is gone through again."""

    def __init__(self, paths: list[tuple[int, tuple[int, ...]]]) -> None:
        self.tags: list[str] = []
        self.paths = paths
        #: place of a path by its parent and what it adds, and the buckets of all open block elements
        self.place: dict[tuple[int, tuple[int, ...]], int] = {}
        self.open: set[int] = set()
        #: place of the path, whether a link is open, the place of the innermost element that shuts others off, leaf, and what the element adds to its path
        self.state: list[tuple[int, bool, int, str, tuple[int, ...]]] = [(0, False, -1, "", ())]
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, names: list[str]) -> None:
        path, linked, wall, leaf, _ = self.state[-1]
        at, new = len(self.tags), ()
        if tag not in _INLINE:
            new = tuple(b for b in dict.fromkeys(map(_path_bucket, [f"<{tag}", *names])) if b not in self.open)
            if new:
                if (path, new) not in self.place:
                    self.place[path, new] = len(self.paths)
                    self.paths.append((path, new))
                path = self.place[path, new]
                self.open.update(new)
            leaf = tag
            wall = wall if tag in _OPEN else at
        self.state.append((path, linked or tag == "a", wall, leaf, new))
        self.tags.append(tag)
        self.places.setdefault(tag, []).append(at)

    def cut(self, at: int) -> None:
        """End the element at a place and all that are open in it."""
        while len(self.tags) > at:
            self.places[self.tags.pop()].pop()
            self.open.difference_update(self.state.pop()[4])

    def close(self, tag: str) -> None:
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def imply(self, ends: set[str]) -> None:
        """End the innermost of the named elements, if nothing shuts it off."""
        at = max((self.places[e][-1] for e in ends if self.places.get(e)), default=-1)
        if at >= 0 and at >= self.state[-1][2]:
            self.cut(at)


def blocks(page: str | None) -> Blocks:
    page, out = page or "", Blocks()
    stack = _Stack(out.paths)
    path, leaf, parts, linked = 0, "", [], 0

    def add(raw: str) -> None:
        nonlocal path, leaf, linked
        top = stack.state[-1]
        if not parts:
            if not raw.strip():
                return
            path, leaf = top[0], top[3]
        parts.append(raw)
        if top[1]:
            linked += len(raw)

    def end() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                out.append((path, leaf, text, linked / max(len(raw), 1)))
            parts.clear()
            linked = 0

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _RAW:
            if not m[1]:
                close = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else size
            end()
            continue
        if tag not in _INLINE:
            end()
        if m[1]:
            stack.close(tag)
            continue
        if tag in _VOID:
            continue
        if tag not in _INLINE:
            stack.imply(_CLOSES.get(tag, {"p"}))
        names = [x for n in _NAMES.finditer(m[3]) for x in _PART.findall(_CAMEL.sub(" ", n[1] or n[2] or n[3] or "").lower())] if m[3] else []
        stack.push(tag, [f".{x}" for x in names if not x.isdigit()])
    end()
    return out


@dataclass
class Inputs:
    """The blocks of several pages, one after another: ids with the blocks they belong to, numbers, and blocks per page.

    ``path`` is the place of each block's path among those of all pages,
    ``leaf`` its leaf's bucket.  ``part`` are the buckets that the paths add to
    their ``parent``s, ``part_n`` how many each, and ``depth`` the paths above.
    """

    path: np.ndarray
    leaf: np.ndarray
    part: np.ndarray
    part_n: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    word: np.ndarray
    word_of: np.ndarray
    numbers: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, pages: list[Blocks]) -> Inputs:
        path, leaves, part, part_n, parent, depth, word, word_n, numbers = [], [], [], [], [], [], [], [], []
        for page in pages:
            before = len(parent)
            for above, new in page.paths:
                depth.append(depth[before + above] + 1 if above >= 0 else 0)
                parent.append(before + max(above, 0))
                part += new
                part_n.append(len(new))
            # the share of a page's text that stands in blocks of one path
            mass = Counter()
            for at, leaf, text, _ in page:
                mass[at, leaf] += len(text)
            total = mass.total()
            for k, (at, leaf, text, linked) in enumerate(page):
                path.append(before + at)
                leaves.append(_path_bucket(f"leaf {leaf}"))
                n = len(words := text.lower().split())
                words = dict.fromkeys(words)
                word += map(_word_bucket, words)
                word_n.append(len(words))
                numbers.append((np.log1p(n) / 3, linked, float(text[-1] in ".!?\"”"), float("©" in text or "copyright" in text.lower()), min(1, 10 / n), k / len(page), float(k == 0), min(3, sum(map(text.count, ",.;")) / n * 4), mass[at, leaf] / total))
        n = len(numbers)
        whole = [np.array(x, np.int64) for x in (path, leaves, part, part_n, parent, depth, word)]
        return cls(*whole, np.repeat(np.arange(n), word_n).astype(np.int64), np.array(numbers, np.float64).reshape(n, NUMBERS), np.array([len(p) for p in pages], np.int64))

    def levels(self) -> Iterator[np.ndarray]:
        """The paths below the empty ones, those nearest to them first."""
        order = np.argsort(self.depth, kind="stable")
        ends = np.searchsorted(self.depth[order], np.arange(1, self.depth.max(initial=0) + 2))
        return (order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))

    def path_size(self) -> np.ndarray:
        """For each block the number of buckets of its path and leaf."""
        size = self.part_n.copy()
        for at in self.levels():
            size[at] += size[self.parent[at]]
        return size[self.path] + 1

    def path_sums(self, table: np.ndarray) -> np.ndarray:
        """For each block the sum of the rows of ``table`` of its path and leaf; a path adds its own to its parent's sum."""
        sums = np.zeros((len(self.parent), table.shape[1]), table.dtype)
        np.add.at(sums, np.repeat(np.arange(len(self.parent)), self.part_n), table[self.part])
        for at in self.levels():
            sums[at] += sums[self.parent[at]]
        return sums[self.path] + table[self.leaf]

    def path_slopes(self, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all paths and leaves, and what each gets of the blocks' slopes: the other way round, from the paths to their parents."""
        sums = np.zeros((len(self.parent), slope.shape[1]), slope.dtype)
        np.add.at(sums, self.path, slope)
        for at in list(self.levels())[::-1]:
            np.add.at(sums, self.parent[at], sums[at])
        return np.concatenate([self.part, self.leaf]), np.concatenate([sums[np.repeat(np.arange(len(self.parent)), self.part_n)], slope])


def _sums(table: np.ndarray, ids: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """For each of n blocks the sum of its rows of ``table`` over the root of their number; every block has one or more."""
    count = np.bincount(of, minlength=n)
    return np.add.reduceat(table[ids], np.cumsum(count) - count, axis=0) / np.sqrt(count)[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Labeller:
    """The network: block vectors, an LSTM in each direction, and a logistic output per block."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        w = {"path": (PATH_BUCKETS, WIDTH), "word": (WORD_BUCKETS, WIDTH), "numbers": (NUMBERS, WIDTH), "bias": (WIDTH,)}
        for d in "fb":
            w |= {f"{d}x": (WIDTH, 4 * HIDDEN), f"{d}h": (HIDDEN, 4 * HIDDEN), f"{d}b": (4 * HIDDEN,)}
        w |= {"out": (2 * HIDDEN + WIDTH, 1), "out_b": (1,)}
        self.w = {k: np.zeros(s) if len(s) == 1 else rng.normal(0, 0.05 if k in ("path", "word") else 0.3, s) for k, s in w.items()}
        for d in "fb":
            self.w[f"{d}b"][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def _vectors(self, x: Inputs) -> np.ndarray:
        n, w = len(x.numbers), self.w
        return np.tanh(x.path_sums(w["path"]) / np.sqrt(x.path_size())[:, None] + _sums(w["word"], x.word, x.word_of, n) + x.numbers @ w["numbers"] + w["bias"])

    def probabilities(self, x: Inputs) -> np.ndarray:
        """The probability of main text for each block, all pages at once; pages of fewer blocks leave the batch as they end."""
        if not len(x.numbers):
            return np.empty(0)
        v = self._vectors(x)
        order = np.argsort(-x.lengths, kind="stable")
        first = (np.cumsum(x.lengths) - x.lengths)[order]
        most = int(x.lengths.max())
        active = np.searchsorted(-x.lengths[order], -np.arange(1, most + 1), side="right")
        hidden = []
        for d, steps in (("f", range(most)), ("b", range(most - 1, -1, -1))):
            gates_x, seen = v @ self.w[f"{d}x"] + self.w[f"{d}b"], np.empty((len(v), HIDDEN))
            h, c = np.zeros((len(order), HIDDEN)), np.zeros((len(order), HIDDEN))
            for t in steps:
                k = active[t]
                at = first[:k] + t
                c[:k], h[:k] = _cell(gates_x[at] + h[:k] @ self.w[f"{d}h"], c[:k])[:2]
                seen[at] = h[:k]
            hidden.append(seen)
        return _sigmoid((np.concatenate([*hidden, v], 1) @ self.w["out"] + self.w["out_b"])[:, 0])

    def gradients(self, x: Inputs, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the blocks and its gradient, by back-propagation through time."""
        w, n, pages, most = self.w, len(x.numbers), len(x.lengths), int(x.lengths.max())
        v = self._vectors(x)
        page = np.repeat(np.arange(pages), x.lengths)
        step = np.arange(n) - np.repeat(np.cumsum(x.lengths) - x.lengths, x.lengths)
        wide = np.zeros((most, pages, WIDTH))
        wide[step, page] = v
        real = np.zeros((most, pages, 1))
        real[step, page] = 1
        runs, hidden = {}, []
        for d, steps in (("f", range(most)), ("b", range(most - 1, -1, -1))):
            h, c, kept, all_h = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)), {}, np.zeros((most, pages, HIDDEN))
            for t in steps:
                new_c, new_h, gates = _cell(wide[t] @ w[f"{d}x"] + w[f"{d}b"] + h @ w[f"{d}h"], c)
                kept[t] = (h, c, new_c, gates)
                h, c = real[t] * new_h + (1 - real[t]) * h, real[t] * new_c + (1 - real[t]) * c
                all_h[t] = h
            runs[d] = kept
            hidden.append(all_h[step, page])
        top = np.concatenate([*hidden, v], 1)
        p = _sigmoid((top @ w["out"] + w["out_b"])[:, 0])
        loss = -np.mean(gold * np.log(p + 1e-9) + (1 - gold) * np.log(1 - p + 1e-9))
        slope = ((p - gold) / n)[:, None]
        g = {k: np.zeros_like(a) for k, a in w.items()}
        g["out"], g["out_b"] = top.T @ slope, slope.sum(0)
        d_top = slope @ w["out"].T
        d_v = d_top[:, 2 * HIDDEN :].copy()
        for i, (d, steps) in enumerate((("f", range(most - 1, -1, -1)), ("b", range(most)))):
            d_out = np.zeros((most, pages, HIDDEN))
            d_out[step, page] = d_top[:, i * HIDDEN : (i + 1) * HIDDEN]
            dh, dc, d_wide = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)), np.zeros_like(wide)
            for t in steps:
                h, c, new_c, (a, f, o, u) = runs[d][t]
                dh = dh + d_out[t]
                th = np.tanh(new_c)
                d_new_h, d_new_c = real[t] * dh, real[t] * dc
                d_new_c = d_new_c + d_new_h * o * (1 - th**2)
                raw = np.concatenate([d_new_c * u * a * (1 - a), d_new_c * c * f * (1 - f), d_new_h * th * o * (1 - o), d_new_c * a * (1 - u**2)], 1)
                g[f"{d}x"] += wide[t].T @ raw
                g[f"{d}h"] += h.T @ raw
                g[f"{d}b"] += raw.sum(0)
                d_wide[t] = raw @ w[f"{d}x"].T
                dh, dc = (1 - real[t]) * dh + raw @ w[f"{d}h"].T, (1 - real[t]) * dc + d_new_c * f
            d_v += d_wide[step, page]
        d_v *= 1 - v**2
        g["numbers"], g["bias"] = x.numbers.T @ d_v, d_v.sum(0)
        np.add.at(g["path"], *x.path_slopes(d_v / np.sqrt(x.path_size())[:, None]))
        np.add.at(g["word"], x.word, (d_v / np.sqrt(np.bincount(x.word_of, minlength=n))[:, None])[x.word_of])
        return float(loss), g


def _cell(gates: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    s = _sigmoid(gates[:, : 3 * HIDDEN])
    a, f, o, u = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(gates[:, 3 * HIDDEN :])
    new = a * u + f * c
    return new, o * np.tanh(new), (a, f, o, u)


# Pages to train on: names that are common on the web for each part of a page, and words that are common in it.
_MAIN = ["article", "main", "main.page", "div.content", "div.post", "div.entry-content", "section.article-body", "div#main", "div.story", "div.text", "article.post", "div.post-body", "section", "div", "td.content", "div#content", "article.single"]
_AROUND = {
    "menu": ["nav", "nav.menu", "div.menu", "ul.navbar", "div#nav", "div.navigation", "div.breadcrumb", "div.topnav", "nav#main-nav", "div[menubar]", "ol.breadcrumbs", "td.menu"],
    "header": ["header", "div.header", "div#header", "header.site-header", "div.masthead", "div.top-bar", "div#logo"],
    "footer": ["footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div.bottom", "div#colophon"],
    "side": ["aside", "div.sidebar", "aside.widget", "div#sidebar", "div.related", "section.related-posts", "div.recommended", "div.tags", "div.share", "div.social", "ul.archive", "div.toc", "aside.author-bio", "div.pagination", "td.sidebar"],
    "notice": ["div.cookie", "div.notice", "div#cookie-banner", "div.alert", "div.consent", "div.gdpr", "div.popup", "div.modal", "noscript", "div.disclaimer", "section.newsletter", "div.subscribe", "div.paywall", "div.banner"],
    "ad": ["div.ad", "div.ads", "div.advert", "div.advertisement", "ins.adsbygoogle", "div#ad", "aside.sponsored", "div.promo", "div.ad-slot", "section.sponsor", "div.sponsored-content"],
    "form": ["form", "form.search", "form#login", "div.form", "form.subscribe", "fieldset"],
    "comments": ["div.comments", "section#comments", "div#disqus", "ol.comment-list", "div.comment", "section.reader-comments", "div.replies", "div.discussion", "section.comments", "div.responses"],
}
_SAID = {
    "menu": "home about contact news products services blog shop help login register search archive categories gallery forum start startseite kontakt anmelden suche accueil connexion recherche boutique inicio contacto buscar tienda skip content menu",
    "header": "welcome official site online daily magazine logo slogan login search willkommen bienvenue bienvenido",
    "footer": "copyright rights reserved terms privacy policy imprint sitemap powered impressum datenschutz mentions légales droits réservés derechos reservados aviso legal ©",
    "side": "related popular latest recommended share tags trending more read also posts categories author follow tweet facebook teilen ähnliche articles similaires relacionados previous next page",
    "notice": "cookies cookie accept consent privacy settings agree browser javascript enable subscribe newsletter continue akzeptieren accepter aceptar utilisons verwenden usamos we use this site your",
    "ad": "advertisement sponsored anzeige publicité publicidad buy now sale offer discount free shipping order today deal save best price click here",
    "form": "email password name username subscribe submit send message required phone remember forgot your address passwort nom correo",
    "comments": "says reply comment comments wrote ago posted report thanks great agree lol kommentare antworten commentaires répondre comentarios responder user likes",
}
_SAID = {part: said.split() for part, said in _SAID.items()}
_PLAIN = [
    x.split()
    for x in (
        "the of and to in a is that it was for on as with by at from which this be not are or an had but were have there been their one all would they",
        "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei",
        "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son cette ou elle",
        "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque",
    )
]
_FIRST, _NEXT, _LAST = "b c d f g h k l m n p r s t v br ch gr st tr".split(), "a e i o u ai ou é ä ó".split(), ["", "", "n", "r", "s", "t", "l", "nd", "ng"]


class _Writer:
    """Texts in one invented language, with a real one's little words."""

    def __init__(self, rng: random.Random) -> None:
        self.rng, self.plain = rng, rng.choice(_PLAIN)
        self.noise, self.named = (0.7 if self.chance(0.06) else 0.03), self.chance(0.7)

    def one(self, options: list):
        return self.rng.choice(options)

    def chance(self, share: float) -> bool:
        return self.rng.random() < share

    def word(self) -> str:
        if self.chance(0.4):
            return self.one(self.plain)
        return "".join(self.one(_FIRST) + self.one(_NEXT) + self.one(_LAST) for _ in range(self.rng.randrange(1, 4)))

    def text(self, low: int, high: int, part: str | None = None, end: str = ".") -> str:
        """Words, of which those of a part of a page say what it is as often as not."""
        said, noise = (_SAID[part] if part and self.chance(0.65) else None), self.chance(self.noise)
        made = []
        for _ in range(self.rng.randrange(low, high)):
            w = self.one(said) if said and self.chance(0.6) else self.word()
            if noise and self.chance(0.7):
                w += self.one(["!!", "#", "~~", "$", "|", "%", "&amp;"])
            made.append(w + (self.one([",", ".", ";", ":", "?"]) if self.chance(0.1) else ""))
        return made[0].capitalize() + "".join(f" {w}" for w in made[1:]) + (end if self.chance(0.8) else "")

    def wrap(self, kind: str, inner: str) -> str:
        if not kind:
            return inner
        m = re.fullmatch(r"(\w+)(?:([.#\[])([^\]]+)\]?)?", kind)
        tag, name = m[1], {".": "class", "#": "id", "[": "role"}.get(m[2] or "")
        value = (m[3] or "") + (self.one(["", "", "", "-1", " box", " wide", " clearfix"]) if name == "class" else "")
        if not self.named and self.chance(0.8):  # a name that says nothing, or none
            tag, name, value = ("div" if tag in ("article", "main", "nav", "aside", "footer", "header") else tag), "class" if self.chance(0.7) else "", f"{self.word()}-{self.word()}"
        return f"<{tag}" + (f' {name}="{value}"' if name else "") + f">{inner}</{tag}>" + self.one(["", "\n", " "])

    def around(self, part: str) -> str:
        """The markup of one part of a page that is no main text."""
        link = lambda: f'<a href="/x">{self.text(1, 5, part, "")}</a>'
        if part in ("menu", "header", "side", "footer") and self.chance(0.7):
            n = self.rng.randrange(1, 9)
            inner = self.one(["<ul>{}</ul>", "{}", "<ul>{}</ul>"]).format("".join(f"<li>{link()}</li>" for _ in range(n)) if self.chance(0.7) else self.one([" | ", " ", " &middot; "]).join(link() for _ in range(n)))
            if part == "side" and self.chance(0.5):
                inner = f"<h3>{self.text(1, 4, part, '')}</h3>{inner}"
            if part == "footer":
                inner = self.one(["&copy; ", "Copyright ", "<p>© ", ""]) + self.text(2, 12, part) + (inner if self.chance(0.4) else "")
            if part == "header" and self.chance(0.5):
                inner = f"<h1>{self.text(1, 4, part, '')}</h1>" + inner
        elif part == "form":
            inner = f"<label>{self.text(1, 4, part, ':')}</label><input name='q'><select><option>{self.text(1, 3, None, '')}<option>{self.text(1, 3, None, '')}</select><button>{self.text(1, 3, part, '')}</button>" + (f"<p>{self.text(3, 20, part)}</p>" if self.chance(0.4) else "")
        elif part == "comments":
            return self.comments()
        else:
            inner = self.one(["{}", "<p>{}</p>", "<div>{}</div>", "<span>{}</span>"]).format(self.text(2, 30, part))
            if part == "notice" and self.chance(0.4):
                inner += f"<button>{self.text(1, 3, part, '')}</button>"
        return self.wrap(self.one(_AROUND[part]), inner)

    def comments(self) -> str:
        shape, mute = self.rng.randrange(5), self.wrap(self.one(_AROUND["comments"]), "\0").strip().split("\0")
        inner = f"<h{shape % 3 + 2}>{self.text(1, 4, 'comments', '')}</h{shape % 3 + 2}>" if self.chance(0.6) else ""
        for _ in range(self.rng.randrange(1, 7)):
            who = f"{self.word().capitalize()} {self.word().capitalize()}" + self.one(["", " says:", " wrote:", ", 3 days ago", " 12:45", ":"])
            what = self.text(3, 45, "comments" if self.chance(0.3) else None)
            inner += [
                f"<div class='comment'><b>{who}</b><p>{what}</p></div>", f"<div><span>{who}</span><div>{what}</div></div>", f"<li>{who} {what}</li>",
                f"<article class='comment'><h4>{who}</h4><p>{what}</p><a href='#'>{self.one(_SAID['comments'])}</a></article>", f"<p><i>{who}</i><p>{what}</p>",
            ][shape]
        return mute[0] + inner + mute[1]


#: Characters that mark main text while an invented page is built.
_ON = "\ue000"


def make_page(rng: random.Random) -> tuple[Blocks, list[int]]:
    """Blocks of an invented page and 1 for each that is main text."""
    w = _Writer(rng)

    def main(low: int, high: int, end: str = ".") -> str:
        return _ON + w.text(low, high, None, end)

    def paragraph() -> str:
        kind, text = rng.random(), main(1, 12) if w.chance(0.15) else main(5, 70)
        if kind < 0.6:
            return f"<p>{text}" + w.one(["</p>", "</p>", "\n"])
        if kind < 0.7:
            return f"<div>{text}</div>"
        if kind < 0.76:
            return f"<h{rng.randrange(2, 5)}>{main(1, 9, '')}</h2>"
        if kind < 0.8:
            return "<ul>" + "".join(f"<li>{main(1, 15)}" + w.one(["", "</li>"]) for _ in range(rng.randrange(1, 6))) + "</ul>"
        if kind < 0.84:
            return f"<blockquote>{text}</blockquote>"
        if kind < 0.88:
            return f'<p>{text} <a href="/y">{w.text(1, 4, None, "")}</a> {w.text(1, 9)}</p>'
        if kind < 0.92:
            return "<table>" + "".join(f"<tr><td>{main(1, 5, '')}<td>{main(1, 9, '')}</tr>" for _ in range(rng.randrange(1, 4))) + "</table>"
        if kind < 0.95:
            return w.one([f"<pre>{text}</pre>", f"<figure><figcaption>{text}</figcaption></figure>", f"<dl><dt>{main(1, 4, '')}<dd>{text}</dl>"])
        return f"{text}<br>{main(4, 40)}<br><br>"

    some, inner = rng.random(), []
    if some < 0.05:  # a bare text
        page = "\n".join(main(3, 60) for _ in range(rng.randrange(1, 6)))
    elif some < 0.13:  # paragraphs and nothing else
        page = "".join(paragraph() for _ in range(rng.randrange(1, 7)))
        page = w.wrap(w.one(_MAIN), page) if w.chance(0.5) else page
    else:
        body = [w.around(part) for part in ("notice", "header", "menu", "ad", "form", "side") if w.chance(0.75 if part == "menu" else 0.35)]
        rng.shuffle(body)
        if w.chance(0.8):
            title = f"<h1>{main(1, 14, '')}</h1>"
            inner.append(f"<header>{title}</header>" if w.chance(0.1) else title)
        inside = w.chance(0.35)
        for _ in range(rng.randrange(1, 14)):
            inner.append(paragraph())
            if inside and w.chance(0.15):
                inner.append(w.around(w.one(["ad", "side", "notice", "form"])))
        if w.chance(0.15) and w.named:
            inner.append(w.comments())
        before = w.chance(0.06)  # comments that come before the article
        if before:
            body.append(w.comments())
        body.append(w.wrap(w.one(_MAIN), "".join(inner)) if w.chance(0.9) else "".join(inner))
        for part, share in (("comments", 0 if before else 0.3), ("side", 0.35), ("ad", 0.25), ("form", 0.15), ("notice", 0.2), ("footer", 0.75)):
            if w.chance(share):
                body.append(w.around(part))
        if w.chance(0.3):
            body = [w.wrap(w.one(["div.wrapper", "div#page", "div", "div.container", "table", "center"]), "".join(body))]
        head = f"<head><title>{w.text(1, 9, None, '')}</title></head>" if w.chance(0.8) else ""
        page = f"<html>{head}<body>{''.join(body)}</body></html>"
    found = blocks(page)
    return Blocks(((a, b, t.replace(_ON, "").strip() or ".", d) for a, b, t, d in found), found.paths), [int(_ON in t) for _, _, t, _ in found]


#: Invented pages that the labeller is trained on, and how often it sees each.
TRAINING_PAGES, PASSES = 3000, 6


@lru_cache(maxsize=2)
def train(pages: int = TRAINING_PAGES, passes: int = PASSES, seed: int = 11) -> Labeller:
    """Fit a labeller to invented pages with Adam; the same seed gives the same weights."""
    source = random.Random(seed)
    made = [p for p in (make_page(source) for _ in range(pages)) if p[0]]
    size, t = 32, 0
    parts = [made[at : at + size] for at in range(0, len(made), size)]
    parts = [(Inputs.of([p for p, _ in part]), np.array([y for _, gold in part for y in gold], float)) for part in parts]
    net, rng = Labeller(), np.random.default_rng(seed)
    m, s = ({k: np.zeros_like(a) for k, a in net.w.items()} for _ in range(2))
    for one in range(passes):
        for i in rng.permutation(len(parts)):
            _, g = net.gradients(*parts[i])
            t += 1
            rate = 0.01 * (1 - 0.9 * one / passes)
            x = parts[i][0]
            for k, a in net.w.items():
                # of the hashed vectors only those that the batch has are moved
                at = np.unique(np.concatenate([x.part, x.leaf])) if k == "path" else np.unique(x.word) if k == "word" else slice(None)
                m[k][at] = 0.9 * m[k][at] + 0.1 * g[k][at]
                s[k][at] = 0.99 * s[k][at] + 0.01 * g[k][at] ** 2
                a[at] -= rate * (m[k][at] / (1 - 0.9**t)) / (np.sqrt(s[k][at] / (1 - 0.99**t)) + 1e-8)
    net.w = {k: a.astype(np.float32) for k, a in net.w.items()}
    return net


_WEIGHTS = "name string, shape array<int>, numbers binary"


def model(spark: SparkSession) -> Labeller:
    """The trained labeller from the shared folder; trained and stored there if it lacks one of this module's present text."""
    with open(__file__, "rb") as f:
        path = f"{shared_dir(spark)}/panelforge-models/html-{hashlib.sha256(f.read()).hexdigest()}"
    try:
        rows = spark.read.schema(_WEIGHTS).parquet(path).collect()  # a dozen rows of bounded size
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = []
    net = Labeller()
    if {r["name"] for r in rows} >= net.w.keys():
        net.w = {r["name"]: np.frombuffer(r["numbers"], np.float32).reshape(r["shape"]) for r in rows}
        return net
    net = train()
    spark.createDataFrame([(k, list(a.shape), bytearray(a.tobytes())) for k, a in net.w.items()], _WEIGHTS).coalesce(1).write.mode("overwrite").parquet(path)
    return net


def main_texts(net: Labeller, pages: list[str | None]) -> list[str]:
    """The main text of each page: its main blocks joined by one space."""
    found = [blocks(p) for p in pages]
    keep = net.probabilities(Inputs.of(found)) >= 0.5
    out, at = [], 0
    for page in found:
        out.append(" ".join(b[2] for b, y in zip(page, keep[at : at + len(page)], strict=True) if y))
        at += len(page)
    return out


def extract(pages: DataFrame, net: Labeller, keep: list[str] | None = None, html: str = "html") -> DataFrame:
    """``keep`` columns with ``text`` (empty if there is none) and ``n_chars`` (its code points, long) for every page.

    Null and empty pages have an empty text; one without any tag is a single
    block.  Pages of any length and depth are read whole.  Rows are read one
    by one, repeated ones too; other columns are ignored, and one of ``keep``
    that is named like a result gives way to it.
    """
    keep = without(["page_id", "url"] if keep is None else keep, "text", "n_chars")
    rows = pages.select(*keep, pages[html].alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(keep)):
                text = main_texts(net, part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], [*part.schema.names[: len(keep)], "text", "n_chars"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}text string, n_chars long")
