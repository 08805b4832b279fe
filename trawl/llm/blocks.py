"""Operator 8, main text of pages by a recurrent block labeller.

A page is the sequence of its leaf blocks (text between block-level tags).
Each block is read as hashed tag-path items, hashed words and a few
lengths; a bidirectional LSTM, written and trained in numpy, runs over the whole
page, so each block is judged with everything before and after it, and says
whether it belongs to the main text.

The network learns from a bounded sample of pages whose own markup tells
(an ``article`` or ``main`` element), under two changes that keep it from relying
on that one mark: the mark is hidden in some pages, and blocks from outside the
article are repeated in other places under the usual names of page furniture.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import sample_rows
from trawl.llm.ngramjoin import CHUNK, WordHasher

# HTML's elements by kind.
BLOCK_TAGS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                 "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
                 "nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
DEAD_TAGS = "script|style|noscript|iframe|textarea|title|noframes|xmp"  # raw text up to the end tag, else to the end of the page
UNSHOWN = set("template svg object canvas".split())  # these hold elements and end where the element does
ITEMS = set("li dt dd tr td th option".split())
ENDS_P = BLOCK_TAGS - {"body", "html", "head"}
#: Usual names of page furniture, which reader and training share.
FURNITURE = set("ad ads advert advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent "
                "cookie cookies disclaimer disqus footer form header login masthead menu modal nav navbar navigation "
                "newsletter notice popup promo promoted related replies reply respond search share sharing sidebar "
                "signup social sponsor sponsored subscribe tags toolbar topbar widget".split())
CONTENT = set("article main content post entry story text body".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:%s)(?=[\t\n\f\r />])[^<>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+|[^<>]*)>|<[!?][^<>]*>" % DEAD_TAGS,
                    re.S | re.I | re.A)
_DEAD = re.compile(r"<(%s)(?=[\t\n\f\r />])" % DEAD_TAGS, re.I | re.A)
_UNSHOWN = re.compile(r"<(?:%s)(?=[\t\n\f\r />])" % "|".join(sorted(UNSHOWN)), re.I | re.A)
_DEAD_END = {t: re.compile(r"</%s(?=[\t\n\f\r />])" % t, re.I | re.A) for t in DEAD_TAGS.split("|")}
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_NAME = re.compile(r"[A-Za-z]+")

PATHS, WORDS, DENSE = 512, 512, 8
BLOCKS_AT_ONCE = 1024


def dead_end(page: str, tag: str, pos: int) -> tuple[int, int]:
    """(start, end) of the end tag from ``pos`` on; the end of the page if it has none."""
    m = _DEAD_END[tag].search(page, pos)
    stop = page.find(">", m.end()) if m else -1
    return (m.start(), stop + 1) if stop >= 0 else (len(page), len(page))


def unshown(page: str) -> dict[int, int]:
    """Where each element of UNSHOWN starts and where its own end tag ends. One that is never closed, or only by the
    end of an element around it, is not among them: nothing tells what belongs to it."""
    ends, stack, opened, pos = {}, [], Counter(), 0
    if not _UNSHOWN.search(page):
        return ends
    while m := _TOKEN.search(page, pos):
        pos = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            dead = _DEAD.match(m[0])
            if not dead or m[0].endswith("/>"):
                continue
            tag = dead[1].lower()
            if not (tag in ("title", "style") and opened["svg"]):  # elements like others in there
                pos = dead_end(page, tag, pos)[1]
                continue
        if m[1]:
            while opened[tag]:
                t, start = stack.pop()
                opened[t] -= 1
                if t == tag:
                    if t in UNSHOWN:
                        ends[start] = pos
                    break
        elif tag not in VOID_TAGS and not m[0].endswith("/>"):
            stack.append((tag, m.start()))
            opened[tag] += 1
    return ends


def leaf_blocks(page: str) -> list[tuple[str, tuple[str, ...], int, int]]:
    """(text, path items, characters inside links, level) of the leaf blocks in page order.

    Path items are the open elements' tags and the letters-only parts of their class,
    id and role. Scripts, styles, comments and other markup without text are gone.
    """
    out, stack, parts = [], [], []  # stack: (tag, items of all open elements)
    opened = Counter()
    link_chars = 0

    def flush():
        nonlocal link_chars
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, stack[-1][1] if stack else (), min(link_chars, len(text)), min(len(stack), 99)))
            parts.clear()
        link_chars = 0

    def close_from(i):
        opened.subtract(t for t, _ in stack[i:])
        del stack[i:]

    pos, n = 0, len(page)
    in_link = 0
    ends = unshown(page)
    while pos < n:
        m = _TOKEN.search(page, pos)
        end = m.start() if m else n
        if end > pos:
            parts.append(page[pos:end])
            if in_link:
                link_chars += end - pos
        if not m:
            break
        pos = m.end()
        tag = m[2]
        if tag is None:
            dead = _DEAD.match(m[0])
            if dead and not m[0].endswith("/>"):
                close, stop = dead_end(page, dead[1].lower(), pos)
                if dead[1].lower() == "xmp":  # shown as it is
                    flush()
                    parts.append(html.escape(page[pos:close]))
                    flush()
                pos = stop
            continue
        if m.start() in ends:
            pos = ends[m.start()]
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCK_TAGS
        if m[1]:
            if block:
                flush()
            if tag == "a" and in_link:
                in_link -= 1
            if opened[tag] > 0:
                close_from(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag == "a":
            in_link += 1
        if block:
            flush()
            in_link = 0
            # a block element ends an open paragraph, an item the item before it
            if stack and tag in ENDS_P and (stack[-1][0] == "p" or (stack[-1][0] == tag and tag in ITEMS)):
                close_from(len(stack) - 1)
            if tag in VOID_TAGS:
                continue
            items = [tag]
            if "=" in m[3]:
                for a in _ATTR.finditer(m[3]):
                    items += [x.lower() for x in _NAME.findall(a[1] or a[2] or a[3] or "")]
            if m[3] and _HIDDEN.search(m[3]):
                items.append("hidden")
            above = stack[-1][1] if stack else ()
            stack.append((tag, above if set(items) <= set(above) else tuple(dict.fromkeys((*above, *items)))))
            opened[tag] += 1
    flush()
    return out


# ---- features ----------------------------------------------------------------

def item_slots(items) -> list[int]:
    """Slots of a block's path items: one each, and one that all furniture or content names share."""
    own = [3 + zlib.crc32(i.encode("utf-8", "replace")) % (PATHS - 3) for i in items]
    return own + [1] * bool(FURNITURE.intersection(items)) + [2] * bool(CONTENT.intersection(items))


class Features:
    """Input of the network for blocks: which path they lie on, how often each word slot occurs, dense values."""

    def __init__(self, hasher: WordHasher | None = None):
        self.hasher, self.paths, self.slots = hasher or WordHasher(), {}, []

    def path(self, items) -> int:
        at = self.paths.get(items)
        if at is None:
            at = self.paths[items] = len(self.slots)
            self.slots.append(item_slots(items))
        return at

    def pages(self, pages):
        """(path of each block, word slots, block of each word, words of each block, dense) of many pages."""
        if len(self.slots) > 20_000:
            self.paths, self.slots = {}, []
        blocks = [b for page in pages for b in page]
        n_words = np.array([t.count(" ") + 1 for t, *_ in blocks], np.int64)  # texts hold single blanks only
        slots, at = [], 0
        while at < len(blocks):  # hashed in pieces of about a megabyte
            end, room = at, CHUNK
            while end < len(blocks) and (room > 0 or end == at):
                room -= len(blocks[end][0])
                end += 1
            slots.append((self.hasher.words("\n".join(t for t, *_ in blocks[at:end]).encode("utf-8", "replace")) >> np.uint64(20)) % np.uint64(WORDS))
            at = end
        paths = np.array([self.path(i) for _, i, _, _ in blocks], np.int64)
        chars = np.array([len(t) for t, *_ in blocks], np.float64)
        place = np.concatenate([np.arange(len(p)) / max(1, len(p)) for p in pages])
        size = np.concatenate([np.full(len(p), np.log1p(len(p)) / 4) for p in pages])
        dense = np.stack([np.ones(len(blocks)), np.log1p(n_words) / 4, np.log1p(chars) / 6, np.array([k for _, _, k, _ in blocks]) / np.maximum(1, chars),
                          np.array([t[-1] in ".!?:;\"'»”" for t, *_ in blocks], float), np.array([v for *_, v in blocks]) / 8, place, size], axis=1)
        return paths, np.concatenate(slots).astype(np.int64), np.repeat(np.arange(len(blocks)), n_words), n_words, dense.astype(np.float32)

    def path_counts(self) -> np.ndarray:
        """(paths, PATHS) how often each path holds each slot."""
        out = np.zeros((len(self.slots), PATHS), np.float32)
        for i, s in enumerate(self.slots):
            np.add.at(out[i], s, 1)
        return out


def word_counts(slots, owner, n_words, a: int, b: int) -> np.ndarray:
    """(b - a, WORDS) word slots of blocks a to b, scaled by the root of their number."""
    lo, hi = np.searchsorted(owner, [a, b])
    flat = np.bincount((owner[lo:hi] - a) * WORDS + slots[lo:hi], minlength=(b - a) * WORDS)
    return flat.reshape(b - a, WORDS).astype(np.float32) / np.sqrt(n_words[a:b, None]).astype(np.float32)


# ---- the network -------------------------------------------------------------

def sigma(v):
    return 0.5 * np.tanh(0.5 * v) + 0.5


def new_weights(hidden: int, seed: int):
    rng = np.random.default_rng(seed)
    g = lambda *s, k: (rng.normal(size=s) * k).astype(np.float32)
    w = {"o": g(2 * hidden, k=0.3), "ob": np.zeros(1, np.float32)}
    for d in "fb":
        w["u" + d] = g(hidden, 4 * hidden, k=0.3)
    # the inputs of both directions side by side
    w["p"], w["w"], w["x"] = g(PATHS, 8 * hidden, k=0.1), g(WORDS, 8 * hidden, k=0.1), g(DENSE, 8 * hidden, k=0.3)
    w["x"][0, hidden:2 * hidden] += 1.0  # remember by default
    w["x"][0, 5 * hidden:6 * hidden] += 1.0
    return w


def project(w, feats, inp):
    """(blocks, 8H) input of the gates, forward then backward."""
    paths, slots, owner, n_words, dense = inp
    out = dense @ w["x"] + (feats.path_counts() @ w["p"])[paths]
    for a in range(0, len(n_words), BLOCKS_AT_ONCE):
        b = min(a + BLOCKS_AT_ONCE, len(n_words))
        out[a:b] += word_counts(slots, owner, n_words, a, b) @ w["w"]
    return out


def run_direction(x, u, lens, keep=None):
    """States (T, B, H) over padded (T, B, 4H) input; lanes sorted by falling length."""
    steps, lanes, _ = x.shape
    hid = u.shape[0]
    states = np.zeros((steps, lanes, hid), np.float32)
    h, c = np.zeros((lanes, hid), np.float32), np.zeros((lanes, hid), np.float32)
    live = np.searchsorted(-lens, -np.arange(steps), side="left")
    for t in range(steps):
        k = live[t]
        g = x[t, :k] + h[:k] @ u
        i, f, o = sigma(g[:, :hid]), sigma(g[:, hid:2 * hid]), sigma(g[:, 2 * hid:3 * hid])
        z = np.tanh(g[:, 3 * hid:])
        c_old, h_old = c[:k].copy(), h[:k].copy()
        c[:k] = f * c_old + i * z
        tc = np.tanh(c[:k])
        h[:k] = o * tc
        states[t, :k] = h[:k]
        if keep is not None:
            keep.append((k, i, f, o, z, c_old, tc, h_old))
    return states


def run_direction_back(u, keep, dstates):
    hid = u.shape[0]
    steps, lanes, _ = dstates.shape
    dx, du = np.zeros((steps, lanes, 4 * hid), np.float32), np.zeros_like(u)
    dh, dc = np.zeros((lanes, hid), np.float32), np.zeros((lanes, hid), np.float32)
    for t in range(steps - 1, -1, -1):
        k, i, f, o, z, c_old, tc, h_old = keep[t]
        dht = dh[:k] + dstates[t, :k]
        dct = dc[:k] + dht * o * (1 - tc * tc)
        g = np.concatenate([dct * z * i * (1 - i), dct * c_old * f * (1 - f), dht * tc * o * (1 - o), dct * i * (1 - z * z)], axis=1)
        dx[t, :k] = g
        du += h_old.T @ g
        dh[:k] = g @ u.T
        dc[:k] = dct * f
    return dx, du


def lay_out(lens: np.ndarray):
    """Lane order by falling length, and for both directions the (t, lane) place of each block."""
    order = np.argsort(-lens, kind="stable")
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    lane = np.empty(len(lens), np.int64)
    lane[order] = np.arange(len(lens))
    page = np.repeat(np.arange(len(lens)), lens)
    t = np.arange(lens.sum()) - starts[page]
    return order, lane[page], t, lens[page] - 1 - t


def logits(w, feats, inp, lens, keep=None):
    order, lane, tf, tb = lay_out(lens)
    steps, lanes = int(lens.max()), len(lens)
    hid = w["uf"].shape[0]
    both = project(w, feats, inp)
    states = []
    for d, t, part in (("f", tf, both[:, :4 * hid]), ("b", tb, both[:, 4 * hid:])):
        x = np.zeros((steps, lanes, 4 * hid), np.float32)
        x[t, lane] = part
        k = [] if keep is not None else None
        states.append(run_direction(x, w["u" + d], lens[order], k)[t, lane])
        if keep is not None:
            keep.append((k, t, lane, steps, lanes))
    both = np.concatenate(states, axis=1)
    return both @ w["o"] + w["ob"], both


def train(pages, labels, *, hidden: int = 12, steps: int = 240, batch: int = 24, rate: float = 0.02, seed: int = 5):
    """Adam on the mean cross-entropy of all blocks; ``pages`` are block lists, ``labels`` 0/1 lists."""
    rng, w, hasher = np.random.default_rng(seed), new_weights(hidden, seed), WordHasher()
    m, v = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    for step in range(1, steps + 1):
        some, ys = [], []
        for i in rng.integers(0, len(pages), batch):
            b, y = disturb(pages[i], labels[i], pages, labels, rng)
            some.append(b)
            ys.append(y)
        lens = np.array([len(b) for b in some])
        feats = Features(hasher)  # paths anew: disturbed pages have ever new ones
        inp, y, keep = feats.pages(some), np.concatenate(ys).astype(np.float32), []
        z, both = logits(w, feats, inp, lens, keep)
        err = ((sigma(z) - y) / len(y)).astype(np.float32)
        g = {"o": both.T @ err, "ob": err.sum(keepdims=True)}
        dboth = err[:, None] * w["o"]
        dins = []
        for d, (k, t, lane, n_steps, lanes), part in zip("fb", keep, (dboth[:, :hidden], dboth[:, hidden:]), strict=True):
            ds = np.zeros((n_steps, lanes, hidden), np.float32)
            ds[t, lane] = part
            dx, g["u" + d] = run_direction_back(w["u" + d], k, ds)
            dins.append(dx[t, lane])
        dp = np.concatenate(dins, axis=1)
        paths, slots, owner, n_words, dense = inp
        by_path = np.zeros((len(feats.slots), dp.shape[1]), np.float32)
        np.add.at(by_path, paths, dp)
        g["x"], g["p"] = dense.T @ dp, feats.path_counts().T @ by_path
        g["w"] = word_counts(slots, owner, n_words, 0, len(n_words)).T @ dp
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            w[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return w


INSIDE_TAGS = {"article", "main"}
OUTSIDE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "menu", "search", "dialog", "hidden"}


def page_labels(blocks) -> list[int] | None:
    """1 for blocks inside the page's article or main element and no furniture; None if it has no such element."""
    if not any(INSIDE_TAGS.intersection(items) for _, items, _, _ in blocks):
        return None
    out = []
    for _, items, _, _ in blocks:
        inside = INSIDE_TAGS.intersection(items) or "article" in items
        bad = OUTSIDE_TAGS.intersection(items) or (FURNITURE.intersection(items) - {"header", "tags"})
        out.append(int(bool(inside) and not bad))
    return out


def disturb(blocks, labels, pages, all_labels, rng):
    """A training variant of a page (see the module's text)."""
    blocks, labels = list(blocks), list(labels)
    hide = rng.random() < 0.35
    if hide:  # the article's mark goes, or turns into a container's name
        to = rng.choice(["div", "section", "content", "post", "entry", "story", ""])
        swap = lambda its: tuple(dict.fromkeys(x for i in its for x in (("div", to) if i in INSIDE_TAGS else (i,)) if x))
        blocks = [(t, swap(i), k, v) for t, i, k, v in blocks]
    names = sorted(FURNITURE - {"tags", "header"})
    for _ in range(rng.integers(0, 4)):  # furniture, inside the article as well as around it
        other = rng.integers(0, len(pages))
        pool = pages[other]
        a = int(rng.integers(0, len(pool)))
        some = pool[a: a + int(rng.integers(1, 4))]
        name = names[rng.integers(0, len(names))]
        tag = name if name in ("nav", "footer", "aside", "form") and rng.random() < 0.7 else rng.choice(["div", "section", "ul", "aside"])
        at = int(rng.integers(0, len(blocks) + 1))
        around = blocks[min(at, len(blocks) - 1)][1]
        clean = tuple(i for i in around if i not in FURNITURE and i not in ("p", "li", "h1", "h2"))
        leaf = str(rng.choice(["p", "li", "div", "span"]))
        new = [(t, tuple(dict.fromkeys((*clean, str(tag), name, leaf))), k, v + 1) for t, _, k, v in some]
        blocks[at:at] = new
        labels[at:at] = [0] * len(new)
    return blocks, labels


# ---- Spark -------------------------------------------------------------------

#: Characters of pages parsed before the network runs, and blocks (padding included) it runs at once.
GROUP_CHARS, PADDED = 400_000, 20_000


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = 400, max_blocks: int = 200,
        max_chars: int = 200_000, **options):
    """Weights learned from at most ``sample`` pages (first by hash, each no longer than
    ``max_chars``, the first ``max_blocks`` blocks of each) whose markup tells their article; None if there is none."""
    h = F.col(f"`{html_col}`").cast("string")
    told = pages.select(h.alias("html"), F.col(f"`{id_col}`").alias("id")).where(F.lower("html").rlike("<(article|main)\\b") & (F.length("html") <= max_chars))
    rows = sample_rows(told, F.xxhash64("id", "html"), sample)
    seqs, labels = [], []
    for r in rows:
        b = leaf_blocks(r["html"])[:max_blocks]
        y = page_labels(b)
        if y:
            seqs.append(b)
            labels.append(y)
    return train(seqs, labels, **options) if seqs else None


def extract(pages: DataFrame, weights, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks), one row per page, from the whole html.

    A null or empty html, a page without text blocks, or a page without a main block gives the empty
    text. Without a network (no page to learn from) the blocks inside article
    or main elements, else all blocks outside furniture, are the text. Null ids and urls stay; repeated rows give
    equal results; other columns are not read.
    """
    def run(batches):
        feats = Features()
        for b in batches:
            texts, counts = [], []
            htmls = b.column(2)
            i = 0
            while i < len(htmls):
                group, room = [], GROUP_CHARS  # a page that does not fit any more waits; a longer one goes alone
                while i < len(htmls):
                    page = htmls[i].as_py() or ""
                    if group and len(page) > room:
                        break
                    group.append(leaf_blocks(page))
                    room -= len(page)
                    i += 1
                kept = judge(weights, feats, group)
                texts += ["\n".join(t for (t, *_), k in zip(bl, ks, strict=True) if k) for bl, ks in zip(group, kept, strict=True)]
                counts += [len(g) for g in group]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"])

    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")


def judge(weights, feats, group):
    """For each page's blocks whether they are main text."""
    full = [g for g in group if g]
    if not full:
        return [[] for _ in group]
    if weights is None:
        marks = []
        for g in group:
            y = page_labels(g) if g else []
            marks.append(y if y is not None else [int(not (OUTSIDE_TAGS | FURNITURE).intersection(i)) for _, i, _, _ in g])
        return marks
    out: list = [[] for _ in group]
    order = sorted((i for i, g in enumerate(group) if g), key=lambda i: -len(group[i]))
    while order:
        # pages of like length run side by side: their lanes, padded to the longest, stay under PADDED places
        take = max(1, PADDED // len(group[order[0]]))
        some, order = order[:take], order[take:]
        z, _ = logits(weights, feats, feats.pages([group[i] for i in some]), np.array([len(group[i]) for i in some]))
        at = 0
        for i in some:
            out[i] = (z[at: at + len(group[i])] > 0).tolist()
            at += len(group[i])
    return out
