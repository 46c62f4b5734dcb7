"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text. A classifier gives each block the cost of
calling it content and of calling it boilerplate; these are the capacities of its
edges to the two terminals. Blocks that follow each other and blocks that hang on
the same element are joined by smoothness edges. The maximum flow's cut labels all
blocks of the page at once; a block that could go either way is boilerplate.

The costs are log-odds of one logistic model: what the text is like (length, links,
punctuation, kind of element; together at most ``TEXT_MOST`` either way) and what
the elements around it say by tag and by class. No feature decides: what a tag or
class weighs is less than what a block's neighbours can weigh together. Weights
are fitted on the table itself in two views that hold back what gives the labels:
tags label blocks to fit texts and classes, classes label them to fit texts and
tags. Both are drawn to ``PRIOR``, which alone counts where no block is labelled.
Edges are fitted on pairs of labelled blocks, up to ``EDGE_MOST``.

The fit takes at most ``sample`` pages, those whose id and text have the least
hashes, and of each at most ``FIT_BLOCKS`` blocks, evenly apart; only their
features reach the driver. Every page is labelled, whole.

Edge cases: a null or empty page gives an empty text; so does one without
content; cut-off pages, unclosed elements and stray ``<`` are read as browsers do,
but an unclosed script or the like ends at the next tag; pages of any length are
read whole; repeated rows are read alike; an empty table gives an empty result;
pages with equal hashes are equal pages, so ties change nothing.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SAMPLE = 1000
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|</?[a-zA-Z](?:[^>"']++|"[^"]*"|'[^']*')*+(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<""", re.S
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
LABELS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is text and no markup; what an ``xmp`` holds is shown.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements that go with all they hold.
DROPPED = frozenset("noscript template svg select button annotation annotation-xml".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var ruby rt rp object canvas".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption address summary td th".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
GOOD_TAGS = frozenset("article main".split())
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs masthead header footer foot sidebar aside widget related recommended recommendations share sharing social comment comments reply replies disqus cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup login search form copyright legal pagination pager toolbar skip contentinfo complementary dialog".split()
)
GOOD_WORDS = frozenset("article content main story entry post body text".split())
#: A class name with one of these tells the page's state and not what the element is: has-sidebar, comments-open.
STATE_WORDS = frozenset("has is with without no not open opened closed enabled disabled on off active inactive visible hidden".split())
TITLE_WORDS = frozenset(["header", "masthead"])

#: An element that holds so much of a page's text, with a block of so many characters, is the page's and no part of it.
WHOLE_PERCENT, RUNNING_TEXT = 90, 100
BAD, HEADER, GOOD = -1, -2, 1
#: What texts weigh: one, log of words, share of links, end of a sentence, commas a word, heading, cell, paragraph of five words or more.
TEXT_PRIOR = (-2.0, 0.75, -2.5, 0.8, 1.0, 0.8, -0.6, 0.4)
#: What elements around weigh: bad tag, header, good tag; bad class, good class, bad class of the block's own element.
TAG_PRIOR, CLASS_PRIOR = (-4.0, -3.0, 3.0), (-4.0, 0.7, -1.5)
PRIOR = np.array(TEXT_PRIOR + TAG_PRIOR + CLASS_PRIOR)
N_TEXT, N_TAGS, N_FEATURES = len(TEXT_PRIOR), len(TAG_PRIOR), len(PRIOR)
TEXT_MOST = 2.0
#: Edges between blocks: one follows the other, same parent, same grandparent. Two of each meet a block.
EDGE_MOST = (0.8, 0.9, 0.4)
FIT_BLOCKS = 200
#: The model where nothing can be fitted.
DEFAULT = np.concatenate([PRIOR, EDGE_MOST])


class Block:
    __slots__ = ("text", "link", "tag", "by_tag", "by_class", "own", "parent", "grandparent")

    def __init__(self, text, link, tag, by_tag, by_class, own, parent, grandparent):
        self.text, self.link, self.tag, self.by_tag, self.by_class, self.own, self.parent, self.grandparent = text, link, tag, by_tag, by_class, own, parent, grandparent


def _words(raw: str) -> set[str]:
    """Words of an element's class, id and role, without names that tell a state."""
    if "=" not in raw:
        return set()
    names = (re.findall("[a-z]+", name) for m in LABELS.findall(raw) for name in m.lower().split())
    return {w for name in names if STATE_WORDS.isdisjoint(name) for w in name}


def _around(tag: str, words: set[str], by_tag: int, by_class: int, wrapper: bool = False) -> tuple[int, int, bool]:
    """What tags and classes say below an element, given what they say above it, and whether its own class is bad.

    What is bad stays so further down; what is good ends where something bad begins.
    wrapper: the element holds the page's content, so bad labels of its own do not count.
    """
    bad, good = set() if wrapper or tag in ("html", "body") else words & BAD_WORDS, words & GOOD_WORDS
    own = bool(bad) and not (good and bad <= TITLE_WORDS)
    if tag in BAD_TAGS and not wrapper:
        by_tag = BAD
    elif tag in GOOD_TAGS and by_tag != BAD and not own:  # an article that is a comment is none
        by_tag = GOOD
    elif tag == "header" and not by_tag and by_class != GOOD:
        by_tag = HEADER
    if own:
        by_class, by_tag = BAD, min(by_tag, 0)
    elif good and by_class != BAD and by_tag >= 0:
        by_class = GOOD
    return by_tag, by_class, own


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in order, white space made one space, references decoded.

    A form or an element with a bad label that holds over half of the page's text and in it an element that is
    labelled as content (or says so itself, as an article or main) is a wrapper: what it says of itself does not count.
    So is one that holds all but a little of the page's text, a block of running text among it: it tells no part from another.
    """
    out, wrappers = _read(page, frozenset())
    return _read(page, wrappers)[0] if wrappers else out


def _read(page: str, wrappers: frozenset[int]) -> tuple[list[Block], frozenset[int]]:
    """Blocks, given the nodes that are wrappers, and the nodes that look like ones."""
    out: list[Block] = []
    doubtful: dict[int, list] = {}  # node: characters below, whether it holds content, characters of its longest block
    total = 0
    stack = [("html", 0, 0, 0, False)]  # tag, node, by tag, by class, own class is bad
    unclosed: set[str] = set()  # elements without an end from here on
    math = False
    nodes, parts, linked, anchors = 0, [], 0, 0

    def flush():
        nonlocal parts, linked, total
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                total += len(text)
                for e in stack if doubtful else ():
                    if e[1] in doubtful:
                        doubtful[e[1]][0] += len(text)
                        doubtful[e[1]][2] = max(doubtful[e[1]][2], len(text))
                k = len(stack) - 1
                tag = stack[k][0]
                if tag in LEAF and k:
                    k -= 1
                out.append(Block(text, linked, tag, *stack[-1][2:], stack[k][1], stack[k - 1][1] if k else -1))
        parts, linked = [], 0

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        raw, at = m[0], m.end()
        if raw[0] != "<" or len(raw) == 1:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if anchors:
                linked += len(text.strip())
            continue
        got = NAME.match(raw)
        if not got:
            continue  # comment, doctype or the like
        tag, closing = got[1].lower(), raw[1] == "/"
        if tag in RAW or tag in DROPPED:
            if not closing and not (raw.endswith("/>") and tag not in RAW):
                close = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if close:
                    if tag == "xmp":
                        parts.append(page[at : close.start()])
                    at = close.end()
                else:
                    unclosed.add(tag)
                    if tag in RAW:  # a script that never ends: what stands before the next tag goes
                        at = page.find("<", at)
                        at = end if at < 0 else at
            if tag != "button":
                parts.append(" ")
            continue
        if tag == "math":
            math = not closing and not raw.endswith("/>")
            continue
        if math and (tag[0] == "m" or tag == "semantics"):
            continue  # the parts of a formula are one text
        if tag == "a":
            anchors = max(0, anchors - 1) if closing else 1
            continue
        if tag in INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        anchors = 0
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in ("p", "li", "dt", "dd", "td", "th") or stack[-1][0] == "p":
            # what browsers close by themselves
            ends = {"p"} if tag not in ("li", "dt", "dd", "td", "th") else {"p", tag} | ({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else set())
            while len(stack) > 1 and stack[-1][0] in ends:
                stack.pop()
        nodes += 1
        words = _words(raw)
        bad = not words.isdisjoint(BAD_WORDS)
        if not bad and tag not in BAD_TAGS and (tag in GOOD_TAGS or not words.isdisjoint(GOOD_WORDS)):
            for e in stack if doubtful else ():
                if e[1] in doubtful:
                    doubtful[e[1]][1] = True
        if tag == "form" or bad and tag not in BAD_TAGS:
            doubtful[nodes] = [0, tag in GOOD_TAGS and not words.isdisjoint(GOOD_WORDS), 0]
        stack.append((tag, nodes, *_around(tag, words, *stack[-1][2:4], nodes in wrappers)))
    flush()
    # what marks all of a page's text marks nothing, if that is running text
    whole = lambda n, longest: longest >= RUNNING_TEXT and 100 * n >= WHOLE_PERCENT * total
    return out, frozenset(k for k, (n, holds, longest) in doubtful.items() if (holds and 2 * n > total) or whole(n, longest))


def features(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), N_FEATURES))
    for i, b in enumerate(page):
        n, words = len(b.text), b.text.count(" ") + 1
        x[i] = (
            1, np.log1p(words), min(1.0, b.link / n), b.text[-1] in ".!?:;\"'", sum(map(b.text.count, ",;")) / words, b.tag in HEADING, b.tag in ("li", "td", "th"), b.tag == "p" and words >= 5,
            b.by_tag == BAD, b.by_tag == HEADER, b.by_tag == GOOD, b.by_class == BAD, b.by_class == GOOD, b.own,
        )
    return x


def logits(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-odds of content: what the text says, up to a bound, and what the elements say."""
    return np.clip(x[:, :N_TEXT] @ weights[:N_TEXT], -TEXT_MOST, TEXT_MOST) + x[:, N_TEXT:] @ weights[N_TEXT:N_FEATURES]


def edges_of(page: list[Block]) -> list[tuple[int, int, int]]:
    """Pairs of blocks and what joins them: 0 one follows the other, 1 same parent, 2 same grandparent."""
    out, parent, grandparent = [], {}, {}
    for i, b in enumerate(page):
        if i:
            out.append((i - 1, i, 0))
        for kind, seen, key in ((1, parent, b.parent), (2, grandparent, b.grandparent)):
            if key in seen:
                out.append((seen[key], i, kind))
            seen[key] = i
    return out


def evidence(page: str | None) -> tuple[np.ndarray, np.ndarray]:
    """What fitting needs of a page: features of some blocks, and by kind of edge how many pairs have the same label by tag and how many have not."""
    got = blocks(page) if page else []
    pairs = np.zeros((len(EDGE_MOST), 2), np.int64)
    for i, j, kind in edges_of(got):
        a, b = got[i].by_tag, got[j].by_tag
        if a and b:
            pairs[kind, int((a > 0) != (b > 0))] += 1
    some = [got[k] for k in np.unique(np.linspace(0, len(got) - 1, FIT_BLOCKS).astype(int))] if len(got) > FIT_BLOCKS else got
    return features(some).astype(np.float32), pairs


def _newton(x: np.ndarray, y: np.ndarray, prior: np.ndarray, rounds: int = 12, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic model by Newton's method, drawn to ``prior`` by ``ridge`` a row; it is kept if all labels are the same."""
    w, ridge = prior.copy(), max(1.0, ridge * len(y))
    if len(np.unique(y)) < 2:
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(hess, x.T @ (y - p) - ridge * (w - prior))
    return w


def fit(pages) -> np.ndarray:
    """Weights of the features and of the edges from the evidence of some pages."""
    xs, pairs = [], np.zeros((len(EDGE_MOST), 2))
    for x, n in pages:
        xs.append(np.asarray(x, float))
        pairs += n
    x = np.concatenate(xs) if xs else np.zeros((0, N_FEATURES))
    text, tags, classes = x[:, :N_TEXT], x[:, N_TEXT : N_TEXT + N_TAGS], x[:, N_TEXT + N_TAGS :]
    by_tag, by_class = tags.any(1), classes[:, :2].any(1)
    of_text, of_tags, of_classes = (np.array(v) for v in (TEXT_PRIOR, TAG_PRIOR, CLASS_PRIOR))
    first = _newton(np.hstack([text, classes])[by_tag], tags[by_tag, 2], np.concatenate([of_text, of_classes]))
    second = _newton(np.hstack([text, tags])[by_class], classes[by_class, 1], np.concatenate([of_text, of_tags]))
    share = by_tag.sum() / max(by_tag.sum() + by_class.sum(), 1)
    # a tag or class keeps its sign and weighs at most as much as before
    bound = lambda w, p: np.clip(w, np.minimum(p, 0), np.maximum(p, 0))
    weights = np.concatenate([first[:N_TEXT] * share + second[:N_TEXT] * (1 - share) if len(x) else of_text, bound(second[N_TEXT:], of_tags), bound(first[N_TEXT:], of_classes)])
    joined = np.clip(np.log((pairs[:, 0] + 5) / (pairs[:, 1] + 1)) / 2, 0.1, EDGE_MOST)
    return np.concatenate([weights, joined])


def min_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes fall on the content side. unary: content's log-odds, the capacity
    of the edge to one terminal; edges: undirected, with capacities.

    Flow goes from each node with a surplus to the nearest with a deficit. A region
    from which none can be reached will never reach one, so it is left out after.
    """
    n = len(unary)
    excess, to = list(unary), [{} for _ in range(n)]
    for i, j, c in edges:
        to[i][j] = to[i].get(j, 0.0) + c
        to[j][i] = to[j].get(i, 0.0) + c
    content = [False] * n
    for s in range(n):
        while excess[s] > 1e-9 and not content[s]:
            came, queue, sink = {s: -1}, deque([s]), -1
            while queue:
                i = queue.popleft()
                if excess[i] < -1e-9:
                    sink = i
                    break
                for j, c in to[i].items():
                    if c > 1e-9 and j not in came and not content[j]:
                        came[j] = i
                        queue.append(j)
            if sink < 0:
                for i in came:
                    content[i] = True
                break
            flow, i = min(excess[s], -excess[sink]), sink
            while came[i] >= 0:
                flow, i = min(flow, to[came[i]][i]), came[i]
            i = sink
            while came[i] >= 0:
                h = came[i]
                to[h][i] -= flow
                to[i][h] += flow
                i = h
            excess[s] -= flow
            excess[sink] += flow
    return content


def label(page: list[Block], weights: np.ndarray) -> list[bool]:
    """Which blocks are content."""
    if not page:
        return []
    return min_cut(logits(features(page), weights).tolist(), [(i, j, float(weights[N_FEATURES + kind])) for i, j, kind in edges_of(page)])


def main_text(page: str | None, weights: np.ndarray) -> str:
    got = blocks(page) if page else []
    return "\n".join(b.text for b, keep in zip(got, label(got, weights), strict=True) if keep)


def fitted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> np.ndarray:
    """Weights fitted on at most ``sample`` pages; what the driver gets of each are its features, at most some 12 KB."""

    @F.pandas_udf("struct<x:binary,n:binary>")
    def of(pages: pd.Series) -> pd.DataFrame:
        got = [evidence(p) for p in pages]
        return pd.DataFrame({"x": [x.tobytes() for x, _ in got], "n": [n.tobytes() for _, n in got]})

    step = max(1, -(-2 * pages.count() // sample))  # about half the bound are read, so the bound seldom cuts
    keyed = pages.select(F.xxhash64(F.col(id_col), F.col(html_col)).alias("h"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = keyed.filter(F.pmod("h", F.lit(step)) == 0).select("h", of("html").alias("e")).orderBy("h", "e.x").limit(sample).collect()
    return fit((np.frombuffer(r["e"]["x"], np.float32).reshape(-1, N_FEATURES), np.frombuffer(r["e"]["n"], np.int64).reshape(-1, 2)) for r in rows)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    weights = fitted(pages, id_col, html_col, sample)

    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: main_text(p, weights))

    got = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(F.coalesce(F.col(html_col), F.lit(""))).alias("text"))
    return got.withColumn("n_chars", F.char_length("text").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
