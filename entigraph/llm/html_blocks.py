"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks, each with the path of the elements around it. A bidirectional LSTM
(numpy) reads a vector for each block, made of hashed path steps, hashed words and a few sizes, and tells for each
block, with the whole page as context, whether it belongs to the article. It is trained here, on a bounded sample
of the pages: the teacher labels the blocks by what the elements mean, and three further copies of each sampled page get
furniture of many other kinds, two with an article element of some kind and one that has lost it, so that the labeller
does not hang on one template. Of pages without an article element the teacher knows nothing: they are no lesson
where others are.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches
from .linear import sampled, sigmoid
from .pieces import Recent

START = r"<(?:(!--)|(!\[CDATA\[)|(!|\?|/(?![a-zA-Z]))|(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
#: The rest of a tag. Only a quote behind = opens a value, and only one that is closed later; nothing is tried twice.
REST = r"""(?:((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)>)?"""
MARKUP, BARE_MARKUP = re.compile(f"{START}{REST})"), re.compile(f"{START})()")
#: Elements whose text is no markup; one without an end tag takes the rest of the page.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in ("script", "style", "textarea")}
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements without text of the page; one without an end tag is as if it were not there.
UNSEEN = {name: re.compile(rf"</{name}\s*>", re.I) for name in "noscript template iframe svg object select title".split()}
#: Elements that do not end a head without an end tag.
HEAD = frozenset("html head title base basefont bgsound link meta style script noscript noframes template".split())
#: Elements that stand inside a block of text; all others begin and end one.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main", "role=main", "role=article"))
FURNITURE = frozenset("nav aside footer form header menu button dialog".split())
#: Of these, the ones that make furniture of an article inside them; the others, and all names, only count below it.
AROUND = frozenset("nav aside footer".split())
#: Classes, ids and roles that name page furniture.
FURNITURE_WORDS = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header login menu modal nav navbar navigation newsletter notice popup promo promoted related reply share sharing sidebar signup social sponsor sponsored subscribe widget".split())
PATH_DIM, WORD_DIM, EXTRA, KINDS = 48, 16, 5, 9
INPUT, HIDDEN = PATH_DIM + WORD_DIM + EXTRA, 12
Block = tuple[tuple[str, ...], str, float]


def _steps(name: str, attributes: str) -> list[str]:
    """The element, and its whole class names, id and role; of html and body, whose names tell of the whole page, the role only."""
    out = [name]
    if attributes and "=" in attributes:
        for key, *value in ATTRIBUTE.findall(attributes):
            key, text = key.lower(), "".join(value).lower()
            if key == "role":
                out.append(f"role={text.strip()}")
            elif name not in ("html", "body"):
                out += [f"{key}={w}" for w in text.split()]
    return out


def tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, whether it is an end tag, name in lower case, attributes) of all markup, in time linear in the page.

    Comments, declarations and elements of RAW with their text are one token each, the former without a name. Where a
    tag's quotes leave it without an end, tags end at the next > from there on; one without any takes the rest.
    """
    at, markup = 0, MARKUP
    while m := markup.search(page, at):
        opening, data, other, closing, name, rest = m.groups()
        start, at = m.span()
        if name is None:
            if opening and page.startswith((">", "->"), at):
                at = page.index(">", at) + 1
            else:
                ends = ("-->", "--!>") if opening else ("]]>", ">") if data else (">",)
                found = [(k, e) for e in ends if (k := page.find(e, at)) >= 0]
                k, e = (found[0] if data else min(found)) if found else (len(page), "")
                at = k + len(e)
            yield start, at, False, "", ""
            continue
        name = name.lower()
        if not rest and page[at - 1] != ">":
            markup = BARE_MARKUP
            k = page.find(">", at)
            rest, at = (page[at:k], k + 1) if k >= 0 else ("", len(page))
        if name in RAW and not closing:
            end = RAW[name].search(page, at)
            at = end.end() if end else len(page)
        yield start, at, bool(closing), name, rest


#: Of a path of more elements the outer and the inner half of these count.
DEEPEST = 256


def blocks(page: str | None) -> list[Block]:
    """(path steps, text, share of the text in links) of all blocks with text, in page order.

    References are decoded and white space is one space. Elements that are not closed reach as far as their parent;
    scripts, styles, comments and the head have no text. The head ends at its end tag, or at the first text or element
    that cannot be in it; only script, style, textarea and comments reach to the end of the page if nothing ends them.
    """
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links = 0
    in_link = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                shown = stack if len(stack) <= DEEPEST else stack[: DEEPEST // 2] + stack[-DEEPEST // 2 :]
                out.append((tuple(s for _, steps in shown for s in steps), text, min(1.0, links / len(text))))
            parts.clear()
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        if piece:
            parts.append(piece)
            if in_link:
                links += len(piece)

    def leave() -> str:
        name = stack.pop()[0]
        opened[name] -= 1
        return name

    at = after = 0
    page = page or ""
    in_head = False
    endless: set[str] = set()  # elements of UNSEEN that nothing ends any more
    for start, end, closing, name, rest in tokens(page):
        if start < after:  # inside an element of UNSEEN
            continue
        piece = page[max(at, after) : start]
        in_head = in_head and not piece.strip()
        if not in_head:
            add(piece)
        at = end
        if not name:
            continue
        if name in RAW:
            if not in_head:
                add(" ")
            continue
        if name in UNSEEN:
            found = None
            if not closing and name not in endless and not (name == "svg" and rest.endswith("/")):
                found = UNSEEN[name].search(page, at)
                if found:
                    after = found.end()
                else:
                    endless.add(name)
            if name == "title" and in_head and not closing and not found:
                after = max(at, page.find("<", at))  # its text is no page text
            in_head = in_head and name in HEAD
            if not in_head:
                add(" ")
            continue
        if name == "head":
            flush()
            in_head = not closing
            continue
        if in_head and not closing and name not in HEAD:
            in_head = False
        if in_head:
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            if name in ("br", "img", "wbr"):
                add(" ")
            continue
        flush()
        in_link = 0
        if closing:
            while opened[name] and leave() != name:
                pass
        elif name not in EMPTY and not rest.endswith("/"):
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                leave()
            stack.append((name, _steps(name, rest)))
            opened[name] += 1
    add(page[max(at, after) :])
    flush()
    return out


def _furniture(path: tuple[str, ...]) -> tuple[bool, list[str], list[str]]:
    """Whether the path has an article element, and the furniture elements and names that count: those below the
    article's element, if there is one, and of the elements around it nav, aside and footer."""
    at = next((k for k, s in enumerate(path) if s in ARTICLE), -1)
    below = next((k for k in range(at + 1, len(path)) if "=" not in path[k]), len(path)) if at >= 0 else 0
    elements = [s for k, s in enumerate(path) if s in FURNITURE and (s in AROUND or k >= below and not (s == "header" and at >= 0))]
    return at >= 0, elements, [s for s in path[below:] if s.partition("=")[2] in FURNITURE_WORDS]


def taught(path: tuple[str, ...]) -> bool:
    """What the elements and their names say: in an article and in no furniture inside it, nor in nav, aside or footer."""
    inside, elements, names = _furniture(path)
    return inside and not elements and not names


def plausible(path: tuple[str, ...], links: float) -> bool:
    """What is left to say where no page has an article element: in no furniture, and mostly no links."""
    _, elements, names = _furniture(path)
    return not elements and not names and links < 0.5


def has_article(page: list[Block]) -> bool:
    return any(s in ARTICLE for path, _, _ in page for s in path)


def _step(text: str) -> tuple[int, float]:
    h = xxhash.xxh32_intdigest(text)
    return KINDS + h % (PATH_DIM - KINDS), 0.5 if h >> 31 else -0.5


STEPS = Recent(_step, 20_000)
WORDS = Recent(lambda w: xxhash.xxh32_intdigest(w) % (2 * WORD_DIM), 200_000)  # the upper half counts down
PATHS = Recent(None, 20_000)


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Signed sums of hashed steps; furniture and article names also by their kind."""
    v = PATHS.get(path)
    if v is None:
        v = np.zeros(PATH_DIM)
        for depth, s in enumerate(path):
            i, amount = STEPS[s]
            v[i] += amount
            v[0] += s in ARTICLE
            v[3] = depth / 8
            v[8] += not FURNITURE_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", s.partition("=")[2]))
        _, elements, names = _furniture(path)
        v[1], v[2] = len(elements), len(names)
        v[4] = v[0] > 0
        v[5] = v[1] > 0
        v[6] = v[2] > 0
        v[7] = path[-1] == "p" if path else 0
        if len(PATHS) >= PATHS.bound:
            PATHS.clear()
        PATHS[path] = v
    return v


def vectors(page: list[Block], article: bool | None = None, start: int = 0) -> np.ndarray:
    """The labeller's input: a row per block. Of a part of a page: whether the page has an article element, and the blocks before."""
    x = np.zeros((len(page), INPUT), np.float32)
    article = has_article(page) if article is None else article
    words = [text.lower().split() for _, text, _ in page]
    sizes = np.array([len(w) for w in words])
    flat = np.fromiter((WORDS[w] for ws in words for w in ws), np.int64, int(sizes.sum()))
    counts = np.bincount(flat + 2 * WORD_DIM * np.repeat(np.arange(len(page)), sizes), minlength=2 * WORD_DIM * len(page)).reshape(len(page), -1)
    x[:, PATH_DIM : PATH_DIM + WORD_DIM] = (counts[:, :WORD_DIM] - counts[:, WORD_DIM:]) / np.sqrt(sizes)[:, None]
    for t, (path, text, links) in enumerate(page):
        x[t, :PATH_DIM] = path_vector(path)
        x[t, -EXTRA:] = np.log1p(len(text)) / 5, links, text[-1] in '.!?…"”', np.log1p(start + t) / 5, article and not x[t, 0]
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output; weights in one dictionary."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.w: dict[str, np.ndarray] = {"out": rng.normal(0, 0.3, (2 * HIDDEN + INPUT, 1)), "out_b": np.zeros(1)}
        for d in "fb":
            self.w[d] = rng.normal(0, 0.15, (INPUT + HIDDEN, 4 * HIDDEN))
            self.w[d + "_b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States of one direction for x (time, page, input); padded places (mask 0) keep the state."""
        n, b, _ = x.shape
        w, bias, h, c = self.w[d], self.w[d + "_b"], np.zeros((b, HIDDEN)), np.zeros((b, HIDDEN))
        given = x @ w[:INPUT] + bias
        states, steps = np.zeros((n, b, HIDDEN)), []
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            z = given[t] + h @ w[INPUT:]
            i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            new_h = m * (o * np.tanh(new_c)) + (1 - m) * h
            if keep:
                steps.append((t, h, c, i, f, o, g, new_c))
            h, c = new_h, new_c
            states[t] = h
        return states, steps

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        (hf, sf), (hb, sb) = self._run(x, mask, "f", keep), self._run(x, mask, "b", keep)
        y = np.concatenate([hf, hb, x], 2)
        return sigmoid((y @ self.w["out"])[..., 0] + self.w["out_b"]), (y, sf, sb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        p, (y, sf, sb) = self.forward(x, mask, keep=True)
        total = mask.sum()
        err = (p - target) * mask / total
        g = {"out": np.tensordot(y, err, ([0, 1], [0, 1]))[:, None], "out_b": np.array([err.sum()])}
        back = err[..., None] * self.w["out"][:, 0]
        for d, steps, dh_all in (("f", sf, back[..., :HIDDEN]), ("b", sb, back[..., HIDDEN : 2 * HIDDEN])):
            w, gw, gb = self.w[d], np.zeros_like(self.w[d]), np.zeros_like(self.w[d + "_b"])
            dh, dc = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
            for t, h, c, i, f, o, gg, new_c in reversed(steps):
                m = mask[t][:, None]
                dh = dh + dh_all[t]
                th = np.tanh(new_c)
                dct = dc + m * dh * o * (1 - th * th)
                dz = np.concatenate([dct * gg * i * (1 - i), dct * c * f * (1 - f), dh * th * o * (1 - o), dct * i * (1 - gg * gg)], 1) * m
                gw[:INPUT] += x[t].T @ dz
                gw[INPUT:] += h.T @ dz
                gb += dz.sum(0)
                dh = dz @ w[INPUT:].T + (1 - m) * dh
                dc = m * dct * f + (1 - m) * dct
            g[d], g[d + "_b"] = gw, gb
        loss = -(np.log(np.where(target > 0.5, p, 1 - p) + 1e-9) * mask).sum() / total
        return g, float(loss)


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(map(len, rows))
    x, mask = np.zeros((n, len(rows), INPUT), np.float32), np.zeros((n, len(rows)))
    for j, r in enumerate(rows):
        x[: len(r), j], mask[: len(r), j] = r, 1
    return x, mask


#: Places of furniture that further copies of the sampled pages get (paths under the body).
OTHER_FURNITURE = (
    ("header", "div", "p"), ("aside", "ul", "li"), ("aside", "p"), ("div", "class=sidebar", "p"), ("div", "id=comments", "div", "p"), ("section", "class=comments", "p"), ("ul", "class=comment", "li"), ("div", "class=cookie", "p"), ("div", "class=newsletter", "form", "p"),
    ("form", "p"), ("div", "class=related", "ul", "li"), ("div", "class=menu", "ul", "li"), ("div", "role=navigation", "ul", "li"), ("div", "class=share", "ul", "li"), ("div", "class=promo", "p"), ("div", "id=footer", "p"), ("div", "class=notice"), ("div", "class=advert"),
)


#: Article elements, and what stands in their place where a page has none.
ARTICLES = (("article",), ("main",), ("div", "role=main"), ("main", "article"))
PLAIN = ((), ("div",), ("section",), ("div", "id=content"), ("div", "class=content"), ("div", "class=post"), ("div", "class=entry-content"), ("div", "id=page", "div", "class=text"), ("table", "tr", "td"))
#: What may stand around a title inside the article.
TITLES = (("header",), ("div", "class=post-header"), ("div", "class=entry-header"))


def varied(page: list[Block], labels: list[bool], pool: list[str], rng: np.random.Generator, article: bool) -> tuple[list[Block], list[bool]]:
    """A copy of the page with other furniture before, after and inside the article, and another article element or, without `article`, none.

    Beside an article element text without a furniture name is furniture, too.
    """
    made = f"class={''.join(chr(97 + c) for c in rng.integers(26, size=6))}"
    name = ARTICLES[rng.integers(len(ARTICLES))] if article else (*PLAIN, ("div", made), ("div", made, "div"))[rng.integers(len(PLAIN) + 2)]
    title = TITLES[rng.integers(len(TITLES))] if rng.random() < 0.3 else ()
    out, marks = [], []

    def furniture(under: tuple[str, ...], kinds: tuple[tuple[str, ...], ...]) -> None:
        path = kinds[rng.integers(len(kinds))]
        for _ in range(rng.integers(1, 4)):
            out.append((under + path, pool[rng.integers(len(pool))], float(rng.random() < 0.3)))
            marks.append(False)

    def outside() -> None:
        plain = article and rng.random() < 0.5
        furniture(("html", "body"), beside if plain else OTHER_FURNITURE)

    beside = tuple((*p, *q) for p in (*PLAIN, ("div", made)) for q in (("p",), ("div",), ("h2",), ("ul", "li")))
    outside()
    before = -1
    for (path, text, links), good in zip(page, labels, strict=True):
        i = next((k for k, s in enumerate(path) if s in ARTICLE), -1)
        if min(i, before) < 0 and rng.random() < 0.2:
            outside()
        before = i
        if i >= 0:
            start = path[: i - (path[i].startswith("role="))]
            path = start + name + (title if good else ()) + tuple(s for s in path[i + 1 :] if s not in ARTICLE)
        out.append((path, text, links))
        marks.append(good)
        if good:
            title = ()
            if rng.random() < 0.06:
                furniture(start + name, OTHER_FURNITURE[1:])
    outside()
    return out, marks


#: A page's share of the training: characters of text and paths, parts of a longer page, and blocks and characters of such a part.
WHOLE, PARTS, PART_BLOCKS, PART_CHARS = 200_000, 4, 200, 50_000
Part = tuple[int, bool, list[Block]]


def parts_of(page: list[Block]) -> list[Part]:
    """(blocks before, whether the page has an article element, blocks) of the page, or of parts of a long one.

    A page whose texts and paths have more than WHOLE characters is cut into parts, and PARTS of these, spread evenly
    over the page, are taken. Of a single block longer than a part its first PART_CHARS characters are.
    """
    article = has_article(page)
    sizes = [len(text) + sum(map(len, path)) for path, text, _ in page]
    if sum(sizes) <= WHOLE:
        return [(0, article, page)] if page else []
    starts, size = [0], 0
    for t, own in enumerate(sizes):
        if t > starts[-1] and (t - starts[-1] >= PART_BLOCKS or size + own > PART_CHARS):
            starts.append(t)
            size = 0
        size += own
    ends = [*starts[1:], len(page)]
    take = sorted({round(k) for k in np.linspace(0, len(starts) - 1, PARTS)})
    return [(starts[k], article, [(path, text[:PART_CHARS], links) for path, text, links in page[starts[k] : ends[k]]]) for k in take]


def train(pages: list[str] | list[Part], epochs: int = 14, batch: int = 32, longest: int = 200, seed: int = 5, least_steps: int = 300) -> Labeller | None:
    """A labeller taught on `pages` (html, or parts of pages); of more than `longest` blocks, that many in a row make a training sequence.

    Pages without an article element are left out, unless all are such: then what is plausible is taught. There are
    at least `least_steps` steps, however few the pages; without any block there is nothing to train on: None."""
    rng, model = np.random.default_rng(seed), Labeller()
    parsed: list[Part] = [x for p in pages for x in ([p] if isinstance(p, tuple) else parts_of(blocks(p)))]
    pool = [text for _, _, b in parsed for _, text, _ in b if len(text) < 300] or ["x"]
    seqs = []
    known = [x for x in parsed if x[1]]
    for start, article, b in known or parsed:
        marks = [taught(path) if known else plausible(path, links) for path, _, links in b]
        seqs.append((b, marks, article, start))
        if known and any(marks):
            seqs += [(*varied(b, marks, pool, rng, kind), kind, start) for kind in (True, True, False)]
    rows = [(v[a : a + longest], np.array(m[a : a + longest], float)) for b, m, article, start in seqs for v in [vectors(b, article, start)] for a in range(0, len(b), longest)]
    if not rows:
        return None
    epochs = max(epochs, -(-least_steps // -(-len(rows) // batch)))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.w.items()}
    step, total = 0, epochs * -(-len(rows) // batch) + 1
    for _ in range(epochs):
        order = sorted(range(len(rows)), key=lambda i: (len(rows[i][0]), rng.random()))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for j in rng.permutation(len(groups)):
            x, mask = padded([rows[i][0] for i in groups[j]])
            target = np.zeros(mask.shape)
            for c, i in enumerate(groups[j]):
                target[: len(rows[i][1]), c] = rows[i][1]
            g, _ = model.gradients(x, mask, target)
            step += 1
            for k, v in g.items():
                m1, m2 = moment[k]
                m1 += 0.1 * (v - m1)
                m2 += 0.01 * (v * v - m2)
                model.w[k] -= 0.02 * (1 - step / total) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return model


def labelled(model: Labeller | None, pages: list[list[Block]]) -> list[np.ndarray]:
    """Probabilities of all blocks, page by page; pages of about equal length are read together. Without a labeller, what the teacher says."""
    if model is None:
        known = [has_article(b) for b in pages]
        return [np.array([taught(path) if k else plausible(path, links) for path, _, links in b], float) for b, k in zip(pages, known, strict=True)]
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        size = max(1, min(64, 20_000 // len(pages[order[at]])))
        group = order[at : at + size]
        if len(pages[group[-1]]) > 2 * len(pages[group[0]]) + 8:
            group = [i for i in group if len(pages[i]) <= 2 * len(pages[group[0]]) + 8]
        p, _ = model.forward(*padded([vectors(pages[i]) for i in group]))
        for j, i in enumerate(group):
            out[i] = p[: len(pages[i]), j]
        at += len(group)
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 300, least: float = 0.5) -> DataFrame:
    """`pages` with `text` (the article's blocks joined by two line ends; empty if none) and `n_chars` (its code points).

    The labeller is trained on the `sample` pages with the least id hashes (of several with one id the least), read on the driver as blocks, of long pages
    as a bounded number of parts; all pages are labelled, from their whole html. If the sample has no text, the
    teacher's word is taken. A null or empty html gives an empty text. Columns of these two names in
    `pages` are replaced. Rows are independent; any may be repeated. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    small_batches(spark, 200)
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    chosen = sampled(rows.filter("html is not null").select("id").distinct(), "id", sample)

    def cut(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(parts_of(blocks(p))) for p in batch.column(0).to_pylist()], pa.string())], ["parts"])

    own = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("html").alias("html")).orderBy("id").select("html").mapInArrow(cut, "parts string")
    taken = [(start, article, [(tuple(path), text, links) for path, text, links in b]) for r in own.collect() for start, article, b in json.loads(r["parts"])]  # `sample` rows, each of bounded size
    model = train(taken)
    shared = spark.sparkContext.broadcast(model and model.w)
    clean = pages.drop("text", "n_chars")
    names, at = clean.columns, clean.columns.index(html_col)

    def extracted(batches):
        m = Labeller() if shared.value else None
        if m:
            m.w = shared.value
        for batch in batches:
            parsed = [blocks(p) for p in batch.column(at).to_pylist()]
            texts = ["\n\n".join(text for (_, text, _), p in zip(b, ps, strict=True) if p >= least) for b, ps in zip(parsed, labelled(m, parsed), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])

    return clean.mapInArrow(extracted, T.StructType([*clean.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
