"""Main text of HTML pages by minimum-cut labelling.

A page becomes a sequence of text blocks. A classifier gives each block a logit: what its length, links,
punctuation and place say, by weights learned from the pages themselves, plus what the elements and names
around it say. Positive logits are capacities from the source (content), negative ones to the sink
(boilerplate); blocks next to each other and blocks near in the DOM are joined by smoothness edges. The
minimum cut is the labelling; the text of the content blocks, joined by one space, is the result.

The classifier is a logistic regression on a bounded sample (``SAMPLE_PAGES`` pages by a hash of the id,
``SAMPLE_BLOCKS`` blocks of each). Its labels are the blocks inside ``article`` or ``main`` against those
in ``nav``, ``footer``, ``aside`` and the like; its inputs leave these elements out. Where a sample lacks
either kind, the weights are zero and the surroundings decide.

Defined cases: null or empty html gives an empty text, as does a page without content; unclosed tags end
where HTML ends them; repeated pages give equal rows; empty input gives no rows. Other columns are not
read. White space is what Unicode calls so, non-breaking spaces included.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import dom

SAMPLE_PAGES, SAMPLE_BLOCKS = 2_000, 40
#: Logits of the surroundings: per unit of ``dom.Block.prior``, outside of a marked article; the bound of the learned part.
SURROUNDINGS, OUTSIDE, LEARNED = 3.0, 2.5, 2.0
#: Share of the text from which a marked article speaks in full against what is outside; a teaser says little.
MOST = 0.5
#: Smoothness between neighbours: of one parent, and per step of distance in the DOM.
SIBLINGS, NEIGHBOURS = 1.2, 0.8


def features(blocks: list[dom.Block]) -> np.ndarray:
    """One row per block: constant, log words, link share, sentence end, commas, list item, heading, place."""
    n, rows = max(1, len(blocks) - 1), []
    for k, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        rows.append((1.0, np.log1p(words), min(1.0, b.link_chars / len(b.text)), float(b.text[-1] in ".!?…。"),
                     b.text.count(",") / words, float(b.tag in ("li", "td", "th", "option")), float(b.tag[:1] == "h" and b.tag[1:].isdigit()),
                     abs(2 * k / n - 1)))
    return np.array(rows).reshape(len(blocks), 8)


def learn(pages: DataFrame, html: str, page_id: str) -> np.ndarray:
    """Weights of the logistic regression, fitted on the driver from the bounded sample."""
    share = min(1.0, SAMPLE_PAGES / max(1, pages.count()))
    chosen = pages.filter(F.pmod(F.xxhash64(F.lit(3), page_id), F.lit(1_000_003)) < share * 1_000_003).select(F.col(html).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch["html"]:
                blocks = dom.blocks(page)
                step = max(1, -(-len(blocks) // SAMPLE_BLOCKS))
                marked = [k for k in range(0, len(blocks), step) if abs(blocks[k].prior) == 2]
                if marked:
                    x = features(blocks)[marked]
                    yield pd.DataFrame({"x": list(x), "y": [float(blocks[k].prior > 0) for k in marked]})

    rows = chosen.mapInPandas(run, "x array<double>, y double").toArrow().to_pandas()
    if rows["y"].nunique() < 2:
        return np.zeros(8)
    x, y = np.stack(rows["x"]), rows["y"].to_numpy()
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(8)
    for _ in range(25):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (balance * (p - y)) / len(y) + 0.01 * w
        hessian = (x * (balance * p * (1 - p))[:, None]).T @ x / len(y) + 0.01 * np.eye(8)
        w -= np.linalg.solve(hessian, gradient)
    return w


def logits(blocks: list[dom.Block], weights: np.ndarray) -> np.ndarray:
    learned = np.clip(features(blocks) @ weights, -LEARNED, LEARNED)
    open_ = sum(len(b.text) for b in blocks if b.prior > -2)
    inside = sum(len(b.text) for b in blocks if b.prior == 2) / max(1, open_)
    # Elements and names decide where they speak clearly; the learned part decides the rest.
    unknown = -OUTSIDE * min(1.0, inside / MOST)
    return learned + np.array([SURROUNDINGS * b.prior if b.prior else unknown for b in blocks])


def smoothness(blocks: list[dom.Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in the page and between neighbouring blocks of one parent."""
    edges, last = [], {}
    for k, b in enumerate(blocks):
        holder = b.path[-2] if len(b.path) > 1 else 0
        if k:
            a = blocks[k - 1]
            common = next((i for i, (x, y) in enumerate(zip(a.path, b.path)) if x != y), min(len(a.path), len(b.path)))
            edges.append((k - 1, k, NEIGHBOURS / (1 + len(a.path) + len(b.path) - 2 * common)))
        if holder in last:
            edges.append((last[holder], k, SIBLINGS))
        last[holder] = k
    return edges


def min_cut(logit: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (True: content) of a minimum cut. A block whose own capacity outweighs its terminal on the
    other side and all its open edges is on that side in some minimum cut: such blocks are settled first,
    and augmenting paths decide the rest."""
    n = len(logit)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    pull, label = [float(x) for x in logit], [None] * n
    todo = deque(range(n))
    while todo:
        k = todo.popleft()
        if label[k] is None and abs(pull[k]) >= sum(w for j, w in near[k] if label[j] is None):
            label[k] = pull[k] > 0
            for j, w in near[k]:
                if label[j] is None:
                    pull[j] += w if label[k] else -w
                    todo.append(j)
    rest = [k for k in range(n) if label[k] is None]
    if rest:
        for k, side in zip(rest, max_flow({k: pull[k] for k in rest}, [(a, b, w) for a, b, w in edges if label[a] is None and label[b] is None])):
            label[k] = side
    return np.array(label, bool)


def max_flow(pull: dict[int, float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each key of ``pull``: whether it is still reached from the source when no path is left."""
    residual: dict[int, dict[int, float]] = {k: {} for k in (*pull, -1, -2)}
    for k, p in pull.items():
        if p > 0:
            residual[-1][k], residual[k][-1] = p, 0.0
        elif p < 0:
            residual[k][-2], residual[-2][k] = -p, 0.0
    for a, b, w in edges:
        residual[a][b] = residual[a].get(b, 0.0) + w
        residual[b][a] = residual[b].get(a, 0.0) + w
    while True:
        came, queue = {-1: -1}, deque([-1])
        while queue and -2 not in came:
            k = queue.popleft()
            for j, room in residual[k].items():
                if room > 1e-9 and j not in came:
                    came[j] = k
                    queue.append(j)
        if -2 not in came:
            return [k in came for k in pull]
        path, k = [], -2
        while k != -1:
            path.append((came[k], k))
            k = came[k]
        flow = min(residual[a][b] for a, b in path)
        for a, b in path:
            residual[a][b] -= flow
            residual[b][a] = residual[b].get(a, 0.0) + flow


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks = dom.blocks(page)
    if not blocks:
        return ""
    keep = min_cut(logits(blocks, weights), smoothness(blocks))
    return " ".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """``page_id``, ``url`` and the main text of every page."""
    weights = learn(pages, html, page_id)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, weights) for page in batch], dtype=object)

    return pages.select(F.col(page_id).alias("page_id"), "url", run(F.col(html)).alias("text"))
