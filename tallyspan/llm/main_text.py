"""Main text of web pages: boosted trees score the DOM's blocks, a decoder makes ancestors and descendants agree.

A block's features: its tag, the tags and attribute words around it, text, tag
and link density of its subtree, depth, place and siblings. The decoder picks
the labelling with the largest sum of scores in which no block is kept below a
dropped one.

The model is fitted on the driver, on a bounded sample: `sample` pages of up to
`page_chars` characters, the first by a hash of their id. Pages have no labels,
so they are labelled by their own markup where it is explicit (an article or
main element, less what stands for navigation and the like in it), and each is
rebuilt `copies` times with other, less explicit containers around the same
texts. Everything else covers all rows whole: one pass without a shuffle.

Defined cases: null and empty pages have an empty text; pages without any
explicit main element are still extracted, they only teach nothing; a null id
is kept; repeated rows are extracted alike; an empty table gives no row. Extra
columns are ignored. Broken markup never fails a task.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.boosting import Boosted, boost
from tallyspan.llm.common import in_batches, sampled, slices
from tallyspan.llm.dom import HIDDEN, Page, parse

TAGS = ["nav", "header", "footer", "aside", "form", "article", "main", "section", "ul", "li", "p", "div", "h1", "h2", "table", "blockquote", "pre", "figure", "body"]
_SAME = {"ol": "ul", "menu": "ul", "dl": "ul", "dt": "li", "dd": "li", "td": "table", "th": "table", "tr": "table", "tbody": "table", "thead": "table", "h3": "h2", "h4": "h2", "h5": "h2", "h6": "h2", "figcaption": "figure", "fieldset": "form", "html": "body", "#root": "body"}
_TAG = {t: i for i, t in enumerate(TAGS)} | {k: TAGS.index(v) for k, v in _SAME.items()}
NUMBERS = ["depth", "own", "sub", "tags", "density", "links", "share", "siblings", "place", "before", "after", "of_parent", "marks", "sibling_mean", "start", "blocks", "paragraphs", "same", "words"]
_MARKS = re.compile(r"[.!?,;:]")

# Names that pages commonly give their parts.
CONTENT = [("article", ""), ("main", ""), ("div", 'class="{}"'), ("div", 'id="{}"'), ("section", 'class="{}"'), ("div", 'itemprop="articleBody"'), ("div", 'role="main"')]
CONTENT_NAMES = ["content", "main-content", "article", "article-body", "post", "post-content", "entry", "entry-content", "story", "story-body", "text", "body-text", "page-content", "blog-post"]
WRAPPER_NAMES = ["wrapper", "container", "page", "row", "col", "layout", "site", "inner", "outer", "main-wrapper", "content-wrapper", "grid"]
MENU_NAMES = ["nav", "menu", "navbar", "navigation", "main-menu", "breadcrumb", "breadcrumbs", "topbar", "site-nav", "links", "tabs", "pagination", "pager"]
HEADER_NAMES = ["header", "site-header", "masthead", "page-header", "top", "logo", "branding", "banner"]
FOOTER_NAMES = ["footer", "site-footer", "copyright", "legal", "bottom", "colophon", "credits"]
SIDE_NAMES = ["sidebar", "side", "widget", "widgets", "related", "related-posts", "recommended", "popular", "trending", "secondary", "rail", "tags", "share", "social", "author-box", "teaser"]
NOTICE_NAMES = ["notice", "cookie", "cookie-notice", "consent", "gdpr", "alert", "popup", "modal", "overlay", "toast", "newsletter", "subscribe", "paywall", "disclaimer", "message"]
ADVERT_NAMES = ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner-ad", "dfp", "adsense", "outbrain"]
COMMENT_NAMES = ["comments", "comment", "comment-list", "commentlist", "responses", "replies", "discussion", "disqus", "respond", "user-comments"]


#: Per block: tags and numbers; its own attribute words; its parent.
Shape = tuple[np.ndarray, list[tuple[str, ...]], list[int]]
#: Blocks whose features are spread out at once.
ROWS = 4096


def shape(page: Page) -> Shape:
    """What the trees see of a page's blocks."""
    n = len(page.tag)
    own, marks, words = [0] * n, [0] * n, [0] * n
    start = [-1] * n  # characters before a block
    seen = 0
    for node, run in page.runs:
        size = len(run.strip())
        if start[node] < 0:
            start[node] = seen
        if size:
            own[node] += size
            marks[node] += len(_MARKS.findall(run))
            words[node] += run.count(" ") + 1
            seen += size
    parent = page.parent
    sub, link, tag_sum, mark_sum, blocks, paragraphs, word_sum = own[:], page.linked[:], [1 + i for i in page.inline], marks[:], [1] * n, [int(t == "p") for t in page.tag], words[:]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        sub[p] += sub[i]
        link[p] += link[i]
        tag_sum[p] += tag_sum[i]
        mark_sum[p] += mark_sum[i]
        blocks[p] += blocks[i]
        paragraphs[p] += paragraphs[i]
        word_sum[p] += word_sum[i]
        children[p].append(i)
    depth, above = [0] * n, [0] * n
    x = np.zeros((n, 2 * len(TAGS) + len(NUMBERS)), np.float32)
    total = max(1, sub[0])
    rank, count = [0] * n, [1] * n
    before, after, same, mean = [0] * n, [0] * n, [1] * n, [0.0] * n
    for p in range(n):
        kids = children[p][::-1]
        if not kids:
            continue
        kinds = Counter(page.tag[k] for k in kids)
        mean_p = sum(sub[k] for k in kids) / len(kids)
        for r, k in enumerate(kids):
            rank[k], count[k], same[k], mean[k] = r, len(kids), kinds[page.tag[k]], mean_p
            before[k] = sub[kids[r - 1]] if r else 0
            after[k] = sub[kids[r + 1]] if r + 1 < len(kids) else 0
    base = 2 * len(TAGS)
    rows = []
    for i in range(n):
        t = _TAG.get(page.tag[i], -1)
        if i:
            p = parent[i]
            depth[i] = depth[p] + 1
            tp = _TAG.get(page.tag[p], -1)
            above[i] = above[p] | (1 << tp if tp >= 0 else 0)
        if t >= 0:
            x[i, t] = 1
        rows.append(
            (depth[i], own[i], sub[i], tag_sum[i], sub[i] / tag_sum[i], link[i] / max(1, sub[i]), sub[i] / total, count[i], rank[i] / count[i], before[i], after[i],
             sub[i] / max(1, sub[parent[i]] if i else sub[i]), 100 * mark_sum[i] / max(1, sub[i]), mean[i], max(0, start[i]) / total, blocks[i], paragraphs[i], same[i], word_sum[i])
        )
    x[:, base:] = rows
    bits = np.array(above, np.int64)
    for t in range(len(TAGS)):
        x[:, len(TAGS) + t] = bits >> t & 1
    return x, page.names, parent


@dataclass
class Extractor:
    """The trees, and the attribute words they know."""

    model: Boosted
    names: dict[str, int]

    def matrices(self, shaped: Shape) -> Iterator[np.ndarray]:
        """The features of all blocks, ROWS of them at a time. Ancestors' words are one number of bits per block."""
        x, names, parent = shaped
        own, above = [0] * len(x), [0] * len(x)
        for i, words in enumerate(names):
            own[i] = sum(1 << k for w in set(words) if (k := self.names.get(w)) is not None)
            if i:
                above[i] = above[parent[i]] | own[parent[i]]
        size = len(self.names)
        for lo in range(0, len(x), ROWS):
            part = x[lo : lo + ROWS]
            spread = np.zeros((len(part), 2 * size), np.float32)
            for r in range(len(part)):
                bits = own[lo + r] | above[lo + r] << size
                while bits:
                    low = bits & -bits
                    spread[r, low.bit_length() - 1] = 1
                    bits ^= low
            yield np.concatenate([part, spread], axis=1)

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [parse(s or "") for s in sources]
        out = []
        held, waiting, n = [], [], 0
        for page in pages:
            waiting.append(page)
            for part in self.matrices(shape(page)):
                held.append(part)
                n += len(part)
            if n >= ROWS:
                out += self._decoded(waiting, held)
                held, waiting, n = [], [], 0
        return out + self._decoded(waiting, held)

    def _decoded(self, pages: list[Page], parts: list[np.ndarray]) -> list[str]:
        if not pages:
            return []
        small = parts if max(map(len, parts)) >= ROWS else [np.concatenate(parts)]
        scores, out, at = np.concatenate([self.model.logits(p) for p in small]), [], 0
        for page in pages:
            n = len(page.tag)
            out.append(page.text(decode(page, scores[at : at + n])))
            at += n
        return out


def decode(page: Page, scores: np.ndarray) -> list[bool]:
    """The best consistent labelling: kept blocks only below kept blocks. The root is kept, hidden elements never are."""
    n = len(page.tag)
    scores = np.clip(scores, -6, 6).tolist()
    scores[0] = 6.0
    drop, below = [0.0] * n, [0.0] * n  # of the subtree without i; of the best choice for all children
    keep_best = [False] * n
    for i in range(n - 1, -1, -1):
        hidden = page.tag[i] in HIDDEN
        keep, leave = scores[i] + below[i], -scores[i] + drop[i]
        keep_best[i] = not hidden and (keep > leave or i == 0)
        if i:
            p = page.parent[i]
            below[p] += keep if keep_best[i] else leave
            drop[p] += leave
    out = [False] * n
    for i in range(n):
        out[i] = keep_best[i] and (i == 0 or out[page.parent[i]])
    return out


# --- teaching ------------------------------------------------------------------

_BOILER_TAGS = {"nav", "footer", "aside", "form", "header"}
_BOILER_WORDS = {w for names in (MENU_NAMES, FOOTER_NAMES, SIDE_NAMES, NOTICE_NAMES, ADVERT_NAMES, COMMENT_NAMES) for n in names for w in n.split("-")} - {"main", "top", "text", "share", "message", "box", "list", "user", "author"}


def explicit(page: Page) -> list[bool] | None:
    """Labels from explicit markup: what stands in an article or main element, less navigation and the like, and what holds it."""
    n = len(page.tag)
    inside, keep = [False] * n, [False] * n
    found = False
    for i in range(1, n):
        p = page.parent[i]
        boiler = page.tag[i] in _BOILER_TAGS or page.tag[i] in HIDDEN or bool(_BOILER_WORDS.intersection(page.names[i]))
        main = page.tag[i] in ("article", "main") or "articlebody" in "".join(page.names[i])
        inside[i] = (inside[p] or main) and not boiler
        found |= main
        keep[i] = inside[i]
    if not found:
        return None
    for i in range(n - 1, 0, -1):
        if keep[i]:
            keep[page.parent[i]] = True
    keep[0] = True
    return keep


def _blocks(page: Page, keep: list[bool], want: bool) -> list[tuple[str, str]]:
    texts: dict[int, list[str]] = {}
    for node, run in page.runs:
        if keep[node] == want and page.tag[node] not in HIDDEN:
            texts.setdefault(node, []).append(run)
    return [(page.tag[i], t) for i, r in texts.items() if (t := " ".join("".join(r).split()))]


def rebuilt(page: Page, keep: list[bool], rng: random.Random) -> str:
    """The same texts in other containers; content carries the attribute data-kept."""
    content, rest = _blocks(page, keep, True), [t for _, t in _blocks(page, keep, False)]
    words = " ".join(t for _, t in content).split() or ["word"]

    def phrase(low: int, high: int) -> str:
        k = rng.randrange(low, high)
        at = rng.randrange(0, max(1, len(words) - k))
        return " ".join(words[at : at + k]).replace("<", "").replace("&", "")

    def named(tag: str, names: list[str], inner: str) -> str:
        how = rng.random()
        name = rng.choice(names)
        if how < 0.15:
            return f"<{tag}>{inner}</{tag}>"
        name = name if how < 0.75 else f"{name}-{rng.randrange(9)} {rng.choice(WRAPPER_NAMES)}"
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{name}">{inner}</{tag}>'

    def listed(low: int, high: int) -> str:
        return "<ul>" + "".join(f'<li><a href="#">{phrase(1, 4)}</a></li>' for _ in range(rng.randrange(low, high))) + "</ul>"

    def prose(paragraphs: int) -> str:
        return "".join(f"<p>{phrase(4, 40)}</p>" for _ in range(paragraphs))

    def some(text: str | None, low: int, high: int) -> str:
        return text.replace("<", "").replace("&", "") if text and rng.random() < 0.5 else phrase(low, high)

    if rng.random() < 0.25:  # short articles are as true as long ones
        content = [(tag, " ".join(text.split()[: rng.randrange(2, 12)])) for tag, text in content[: rng.randrange(1, 4)]]
    spare = rest[-1] if rest else None
    parts = {
        "menu": lambda: named(*rng.choice([("nav", MENU_NAMES), ("div", MENU_NAMES), ("nav", MENU_NAMES)]), listed(3, 9)),
        "header": lambda: named(rng.choice(["header", "header", "div"]), HEADER_NAMES, f"{rng.choice(['<div>', '<p>', '<h2>'])}{phrase(1, 8)}" + listed(0, 4)),
        "side": lambda: named(rng.choice(["aside", "aside", "div", "section"]), SIDE_NAMES, f"<h3>{phrase(1, 4)}</h3>" + rng.choice([listed(2, 7), prose(1), listed(1, 4) + prose(1)])),
        "notice": lambda: f'<div {rng.choice(["class", "id"])}="{rng.choice(NOTICE_NAMES)}">{rng.choice(["<p>", ""])}{phrase(4, 25)}</div>',
        "advert": lambda: f'<{(t := rng.choice(["div", "div", "section", "aside"]))} {rng.choice(["class", "id"])}="{rng.choice(ADVERT_NAMES)}">{some(spare, 3, 20)}</{t}>',
        "form": lambda: f"<form>{rng.choice(['<p>', '<div>', ''])}<label>{phrase(1, 4)}</label><input><div>{phrase(1, 6)}</div></form>",
        "comments": lambda: f'<{(t := rng.choice(["section", "div", "ol"]))} {rng.choice(["class", "id"])}="{rng.choice(COMMENT_NAMES)}">'
        + "".join(f'<{(c := rng.choice(["div", "li", "article"]))} class="{rng.choice(["comment", "reply", "comment-body", "response"])}"><p>{phrase(1, 3)}</p>{prose(rng.randrange(1, 3))}</{c}>' for _ in range(rng.randrange(1, 5)))
        + f"</{t}>",
        "footer": lambda: named(rng.choice(["footer", "footer", "div"]), FOOTER_NAMES, rng.choice(["", "<p>"]) + "&copy; " + some(spare, 2, 15) + rng.choice(["", listed(1, 5)])),
    }
    body = []
    for tag, text in content:
        text = text.replace("<", "&lt;")
        kind = tag if tag in ("h1", "h2", "h3", "li", "blockquote", "pre") else "p"
        if kind == "li":
            body.append(f"<ul data-kept><li data-kept>{text}</li></ul>")
        elif rng.random() < 0.06:
            body.append(f"<blockquote data-kept><p data-kept>{text}</p></blockquote>")
        elif rng.random() < 0.05 and len(text) > 40:
            k = len(text) // 2
            body.append(f"<ul data-kept><li data-kept>{text[:k]}</li><li data-kept>{text[k:]}</li></ul>")
        elif rng.random() < 0.05:
            body.append(f"<h2 data-kept>{phrase(2, 7)}</h2><p data-kept>{text}</p>")
        else:
            body.append(f"<{kind} data-kept>{text}</{kind}>")
        if rng.random() < 0.04:
            body.append(parts[rng.choice(["advert", "side", "notice", "form"])]())
    tag, attribute = rng.choice(CONTENT + CONTENT[:1] * 3)
    main = f"<{tag} {attribute.format(rng.choice(CONTENT_NAMES))} data-kept>" + "".join(body)
    main += (parts["comments"]() if rng.random() < 0.3 else "") + f"</{tag}>"
    head = [parts[k]() for k in ("header", "menu", "notice", "advert", "side", "form") if rng.random() < 0.4]
    tail = [parts[k]() for k in ("comments", "side", "advert", "form", "notice", "menu", "footer") if rng.random() < 0.4]
    rng.shuffle(head)
    inner = "".join([*head, main, *tail])
    for _ in range(rng.randrange(0, 3)):
        inner = f'<div class="{rng.choice(WRAPPER_NAMES)}" data-kept>{inner}</div>'
    return f"<html><body>{inner}</body></html>"


def _kept_names(source: str) -> tuple[Page, list[bool]]:
    """A rebuilt page with its labels: the attribute data-kept marks them and is not seen by features."""
    page = parse(source.replace(" data-kept", ' name="datakept"'))
    keep = [i == 0 or t in ("html", "body") or "datakept" in names for i, (t, names) in enumerate(zip(page.tag, page.names, strict=True))]
    page.names = [tuple(w for w in names if w != "datakept") for names in page.names]
    return page, keep


def teach(sources: list[str], copies: int = 3, names: int = 192, seed: int = 11) -> Extractor:
    """An extractor from page sources: their explicit markup and rebuilt pages."""
    rng = random.Random(seed)
    shaped, labels = [], []
    for source in sources:
        page = parse(source)
        keep = explicit(page)
        if keep is None:
            continue
        lessons = [(page, keep), *(_kept_names(rebuilt(page, keep, rng)) for _ in range(copies))]
        for p, k in lessons:
            shaped.append(shape(p))
            labels += k
    if not shaped:
        filler = "<html><body><article>" + "<p>Some words of a text, and some more.</p>" * 5 + "</article></body></html>"
        return teach([filler] * 50, copies, names, seed)
    seen = Counter(w for _, own, _ in shaped for s in own for w in s)
    known = {w: i for i, (w, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:names])}
    extractor = Extractor(Boosted(0.0, []), known)
    x = np.concatenate([part for s in shaped for part in extractor.matrices(s)])
    extractor.model = boost(x, np.array(labels, float))
    return extractor


def learned(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 240, page_chars: int = 20_000) -> Extractor:
    sized = pages.select(F.col(id_col).alias("i"), F.length(html_col).alias("size"), F.col(html_col).alias("source")).where(F.col("size").between(1, page_chars))
    rows = sampled(sized, sample, "i", "size").select("source").collect()
    return teach([r.source for r in rows])


def extracted(pages: DataFrame, extractor: Extractor | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    extractor = extractor or learned(pages, id_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = extractor.texts(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("source"))
    return in_batches(rows, run, "page_id long, url string, text string, n_chars long")
