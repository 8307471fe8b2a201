"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes a row of text blocks. What a classifier thinks of each block, and what its place
says (inside an article, a menu, an advert ..), are capacities to two terminals; neighbours are
tied by capacities that shrink with their distance in the document tree. The minimum cut, found by
maximum flow, is the labelling of least total cost.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?=[\s/>])(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)"
    r"|([^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
#: Tags that begin and end blocks; all others are part of the text around them.
BLOCK_TAGS = frozenset(
    "html head body p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article "
    "main header footer nav aside form fieldset blockquote pre figure figcaption hr address details summary menu dialog center".split()
)
#: Tags that are left out with all they hold, where they are closed.
HIDDEN_TAGS = frozenset("noscript template svg iframe select button object canvas audio video".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu head dialog".split())
#: Words of a class, id or role; a name with a word in it that is in none of these lists says nothing.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent notice alert "
    "sidebar widget menu nav navigation navbar breadcrumb breadcrumbs comment comments respond reply replies disqus share "
    "sharing social related recommended newsletter subscribe subscription signup login footer masthead toolbar popup modal "
    "pagination pager copyright disclaimer search complementary contentinfo".split()
)
CONTENT_NAMES = frozenset("article main content post entry story body text".split())
#: Of these, what is no part of the article even in an ``article`` of its own.
ASIDE_NAMES = frozenset("comment comments respond reply replies disqus related recommended".split())
#: Words that say how much or where, beside those of boilerplate: ``comment-list``, ``ad-slot``.
HOLDER_NAMES = CONTENT_NAMES | frozenset(
    "area articles bar block bottom box button buttons column container count footer group header icon icons inner item "
    "items left link links list meta module outer page panel posts reader region right row section site slot stories "
    "thread title top tree unit user wrap wrapper zone".split()
)
FEATURES = 8
#: Weights of the features where no page tells its content from the rest: long blocks with stops and without links.
PRIOR = (-1.5, 0.3, -3.0, 2.0, -0.25, 0.5, -0.5, 1.0)
#: Capacities below this are none.
_LEAST = 1e-9


@dataclass(frozen=True)
class Rule:
    """Capacities: of a place that says much, of the classifier at most, between neighbours; the
    pages at most, by hash, whose blocks the classifier is fitted on."""

    place: float = 8.0
    shape: float = 3.0
    tie: float = 1.0
    sample: int = 400
    steps: int = 300


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    tag: str
    kind: int  # over 0 inside content, under 0 inside boilerplate, 0 not known
    linked: int  # characters within links
    features: list[float] = field(default_factory=list)


def _hidden(tokens: list[re.Match]) -> dict[int, int]:
    """Start to end of what is left out, as places in ``tokens``. A tag that closes itself, or is
    not closed within the block it stands in, hides nothing."""
    out: dict[int, int] = {}
    opened: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    for i, m in enumerate(tokens):
        tag = (m.group(3) or "").lower()
        if tag not in HIDDEN_TAGS and tag not in BLOCK_TAGS:
            continue
        if not m.group(2):
            if tag in BLOCK_TAGS or not m.group(4).endswith("/"):
                opened.append((tag, i))
                count[tag] += 1
            continue
        while count[tag]:
            last, at = opened.pop()
            count[last] -= 1
            if last == tag:
                if tag in HIDDEN_TAGS:
                    out[at] = i
                break
    return out


def _named(attributes: str) -> int:
    """1 if a class, id or role is made of words for content; -1 if one has a word for boilerplate
    and else only such or words for holders of it, -2 if that word is in ``ASIDE_NAMES``."""
    kind = 0
    for names in _NAMES.findall(attributes):
        for name in names.lower().split():
            words = set(_WORD.findall(name))
            if words & BOILERPLATE_NAMES and words <= BOILERPLATE_NAMES | HOLDER_NAMES:
                kind = min(kind, -2 if words & ASIDE_NAMES else -1)
            elif words == {"site", "header"}:
                kind = min(kind, -1)
            elif words and words <= CONTENT_NAMES:
                kind = kind or 1
    return kind


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order; scripts, styles and comments are none.

    An ``article`` or ``main`` is content wherever it stands, unless its own names say otherwise or
    it stands in comments or in what is related.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # tag, number, kind
    text: list[str] = []
    linked, in_link, number = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if whole:
                out.append(Block(whole, tuple(s[1] for s in stack), stack[-1][0], stack[-1][2], min(linked, len(whole))))
        linked = 0

    tokens = list(_TOKEN.finditer(page or ""))
    hidden, resume = _hidden(tokens), 0
    for i, m in enumerate(tokens):
        if i < resume:
            continue
        if i in hidden:
            resume = hidden[i] + 1
            continue
        words = m.group(5)
        if words is not None:
            text.append(words)
            if in_link:
                linked += len(words)
            continue
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCK_TAGS:
            if tag == "a":
                in_link = not m.group(2)
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if m.group(2):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        if tag == "hr":
            continue
        # A paragraph or item that was never closed ends where the next block begins.
        while stack[-1][0] == "p" or (tag in ("li", "tr", "td", "th", "dt", "dd") and stack[-1][0] == tag):
            stack.pop()
        number += 1
        kind = stack[-1][2]
        attributes = m.group(4)
        named = _named(attributes) if attributes and tag not in ("html", "body") else 0
        if kind == -2 or named == -2:
            kind = -2
        elif tag in ("article", "main"):
            kind = 1 if named >= 0 else -1
        elif kind >= 0:
            if tag in BOILERPLATE_TAGS or (tag == "header" and kind == 0):
                kind = -1
            else:
                kind = named or kind
        stack.append((tag, number, kind))
    flush()
    for b in out:
        n = len(b.text)
        words = b.text.count(" ") + 1
        b.features = [
            1.0,
            min(np.log1p(n), 8.0),
            b.linked / n,
            min(b.text.count(".") + b.text.count(","), 10) / 10,
            float(words < 5),
            float(b.tag == "p"),
            float(b.tag in ("li", "td", "th", "dd", "dt")),
            float(b.tag[:1] == "h" and b.tag[1:].isdigit()),
        ]
    return out


def minimum_cut(content: list[float], boilerplate: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which blocks lie on the content side of a minimum cut.

    ``content[i]`` is what it costs to call block i boilerplate, ``boilerplate[i]`` to call it
    content, a tie what it costs to part two blocks. Maximum flow in rounds, each of which fills all
    shortest ways from the source to the sink; what runs straight through one block is settled
    first. Of equal cuts, the one with the fewest blocks of content.
    """
    n = len(content)
    excess = [a - b for a, b in zip(content, boilerplate)]  # over 0: from the source, under: to the sink
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in ties:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    while True:
        sources = [i for i in range(n) if excess[i] > _LEAST]
        away = [-1] * n
        for i in sources:
            away[i] = 0
        queue, nearest = list(sources), n
        for i in queue:
            for j, w in near[i].items():
                if w > _LEAST and away[j] < 0:
                    away[j] = away[i] + 1
                    queue.append(j)
                    if excess[j] < -_LEAST:
                        nearest = min(nearest, away[j])
        if nearest == n:
            return [steps >= 0 for steps in away]
        untried = [iter(list(ends)) for ends in near]
        at: list[int | None] = [next(ends, None) for ends in untried]
        for source in sources:
            while excess[source] > _LEAST:
                path = [source]
                while path and excess[path[-1]] >= -_LEAST:
                    i = path[-1]
                    j = at[i] if away[i] < nearest else None
                    if j is None:
                        path.pop()
                        if path:
                            at[path[-1]] = next(untried[path[-1]], None)
                    elif away[j] == away[i] + 1 and near[i][j] > _LEAST:
                        path.append(j)
                    else:
                        at[i] = next(untried[i], None)
                if not path:
                    break
                pairs = list(zip(path, path[1:]))
                flow = min([excess[source], -excess[path[-1]], *[near[i][j] for i, j in pairs]])
                excess[source] -= flow
                excess[path[-1]] += flow
                for i, j in pairs:
                    near[i][j] -= flow
                    near[j][i] += flow


def main_text(page: str | None, weights: np.ndarray, rule: Rule) -> str:
    found = blocks(page)
    if not found:
        return ""
    kinds = {b.kind for b in found}
    shape = np.clip(np.array([b.features for b in found]) @ weights, -rule.shape, rule.shape).tolist()
    if 1 in kinds:
        # Where a page marks its content, what lies outside is more likely none.
        shape = [s if b.kind else s - rule.shape for b, s in zip(found, shape)]
    content = [max(s, 0.0) + rule.place * (b.kind > 0) for b, s in zip(found, shape)]
    boilerplate = [max(-s, 0.0) + rule.place * (b.kind < 0) for b, s in zip(found, shape)]
    ties = []
    for i in range(len(found)):
        for j in range(i + 1, min(i + 3, len(found))):
            a, b = found[i].path, found[j].path
            same = 0
            for x, y in zip(a, b):
                if x != y:
                    break
                same += 1
            ties.append((i, j, rule.tie / (j - i) * 0.5 ** (len(a) + len(b) - 2 * same)))
    keep = minimum_cut(content, boilerplate, ties)
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def _sample_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(b.kind > 0, b.features) for page in batch.column(0).to_pylist() for b in blocks(page) if b.kind]
        columns = [pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))]
        yield pa.record_batch(columns, names=["content", "features"])


def fit(pages: DataFrame, rule: Rule) -> np.ndarray:
    """Weights of a logistic regression of blocks' shapes, on the blocks of at most
    ``rule.sample`` pages whose places tell which they are; ``PRIOR`` without such."""
    sample = pages.orderBy(F.xxhash64("page_id", "html"), "page_id").limit(rule.sample).select("html")
    rows = sample.mapInArrow(_sample_blocks, "content boolean, features array<double>").toPandas()
    y = rows["content"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return np.array(PRIOR)
    weights = np.zeros(FEATURES)
    x = np.stack(rows["features"].to_numpy())
    # Both kinds weigh the same, however many blocks each has.
    each = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for _ in range(rule.steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (each * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(FEATURES)
        step = np.linalg.solve(hessian, x.T @ (each * (y - p)) - 1e-3 * weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _extract(model, rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, model.value, rule) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html, any more).

    NULL or empty html, and a page without content, have empty text. Rows that repeat come back
    one by one; an empty table gives no rows. Each page is read whole and on its own.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    model = pages.sparkSession.sparkContext.broadcast(fit(pages, rule))
    return pages.mapInArrow(_extract(model, rule), "page_id long, url string, text string, n_chars long")
