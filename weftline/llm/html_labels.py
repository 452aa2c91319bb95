"""A recurrent labeller of text blocks: which blocks of a page are its main text.

Every block becomes a vector: the mean of the vectors of the tags and class words on its path, the mean of the vectors of
its words (both looked up by hash, so that no vocabulary is kept), and a few numbers such as length and share of links. A
bidirectional LSTM reads the vectors of all blocks of a page in both directions, so each block is judged with the whole
document around it. All of it is numpy.

It is trained here, on pages made by rule from a seed (`html_layouts`), whose labels are known; training takes some seconds, always on the
same pages, whatever the table.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa

from weftline.llm.html_blocks import Block, blocks
from weftline.llm.html_layouts import MAIN, pages
from weftline.llm.words import words

BUCKETS = 1 << 12
PATH, WORD, PLAIN, HIDDEN = 24, 12, 8, 24
#: Bytes of block text hashed at once.
HASH_BYTES = 1 << 18
TRAIN_PAGES, EPOCHS, BATCH, RATE = 900, 8, 24, 0.01

Model = dict[str, np.ndarray]


@lru_cache(maxsize=1 << 15)
def _bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def _sentence_marks(text: str) -> int:
    return sum(map(text.count, ".!?,;。、"))


class Features:
    """What the labeller sees of the blocks of several pages in a row."""

    def __init__(self, of_pages: list[list[Block]]):
        flat = [b for page in of_pages for b in page]
        self.sizes = np.array([len(p) for p in of_pages], np.int64)
        paths = [[_bucket(t) for t in b.path] for b in flat]
        self.path_sizes = np.array([len(p) for p in paths], np.int64)
        self.paths = np.array([t for p in paths for t in p], np.int64)
        self.words, self.word_sizes = _word_buckets([b.text for b in flat])
        chars = np.array([len(b.text) for b in flat], float)
        n = np.maximum(self.word_sizes, 1)
        marks = np.array([_sentence_marks(b.text) for b in flat], float)
        place = np.concatenate([np.arange(s) / max(s, 1) for s in self.sizes.tolist()] or [np.zeros(0)])
        self.plain = np.stack(
            [
                np.log1p(chars) / 8,
                np.minimum(chars, 20) / 20,
                np.array([b.linked for b in flat], float) / np.maximum(chars, 1),
                np.minimum(marks / n, 1),
                np.array([b.text[-1:] in tuple(".!?:。\"") for b in flat], float),
                np.array([any(c in b.text for c in "©|·»") for b in flat], float),
                place,
                np.array([min(len(b.path), 24) / 24 for b in flat]),
            ],
            axis=1,
        ).astype(np.float32) if flat else np.zeros((0, PLAIN), np.float32)


def _word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the lower-cased words of all texts, and the number of words of each."""
    found, sizes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) <= HASH_BYTES // 2):
            held += len(texts[to])
            to += 1
        some = words(pa.array(texts[at:to], pa.string()), lower=True)
        found.append((some.hashes % np.uint64(BUCKETS)).astype(np.int64))
        sizes.append(some.counts)
        at = to
    return np.concatenate(found), np.concatenate(sizes)


def _mean(vectors: np.ndarray, index: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per block, the mean of the vectors of its tokens, a bounded number of tokens at a time."""
    out = np.zeros((len(sizes), vectors.shape[1]), np.float32)
    bounds = np.r_[0, np.cumsum(sizes)]
    at = 0
    while at < len(sizes):
        to = max(int(np.searchsorted(bounds, bounds[at] + (1 << 16), side="right")) - 1, at + 1)
        held = np.flatnonzero(sizes[at:to]) + at
        if len(held):
            if to == at + 1:  # one long block: its tokens in counts per bucket
                counts = np.bincount(index[bounds[at] : bounds[to]], minlength=len(vectors))
                out[at] = counts @ vectors
            else:
                out[held] = np.add.reduceat(vectors[index[bounds[at] : bounds[to]]], bounds[held] - bounds[at])
        at = to
    return out / np.maximum(sizes, 1)[:, None].astype(np.float32)


def _inputs(model: Model, f: Features) -> np.ndarray:
    # the path is a sum that grows slowly with its depth, so that one telling class is not lost among many tags
    scale = np.sqrt(np.maximum(f.path_sizes, 1))[:, None].astype(np.float32)
    return np.concatenate(
        [_mean(model["path"], f.paths, f.path_sizes) * scale, _mean(model["word"], f.words, f.word_sizes), f.plain], axis=1
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _gates(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    s = _sigmoid(z[:, : 3 * HIDDEN])
    return s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])


def _steps(sizes: np.ndarray, back: bool) -> list[np.ndarray]:
    """Which rows each step reads: the pages run side by side, longest first, each over its own length."""
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    alive = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    first = starts + sizes - 1 if back else starts
    return [first[:k] + (-t if back else t) for t, k in enumerate(alive.tolist())]


def probabilities(model: Model, of_pages: list[list[Block]]) -> np.ndarray:
    """For each block of all pages in a row, how likely it is main text."""
    f = Features(of_pages)
    x = _inputs(model, f)
    score = np.full(len(x), model["out_b"][0], np.float32)
    for way, back in (("f", False), ("b", True)):
        out = model["out"][:HIDDEN] if way == "f" else model["out"][HIDDEN:]
        rows = _steps(f.sizes, back)
        h = c = np.zeros((len(rows[0]) if rows else 0, HIDDEN), np.float32)
        for at in rows:
            z = x[at] @ model[f"{way}_x"] + h[: len(at)] @ model[f"{way}_h"] + model[f"{way}_b"]
            i, keep, o, g = _gates(z)
            c = keep * c[: len(at)] + i * g
            h = o * np.tanh(c)
            score[at] += h @ out
    return _sigmoid(score)


# --- training ----------------------------------------------------------------------


def _start(rng: np.random.Generator) -> Model:
    size = PATH + WORD + PLAIN
    model = {
        "path": rng.normal(0, 0.1, (BUCKETS, PATH)),
        "word": rng.normal(0, 0.02, (BUCKETS, WORD)),
        "out": rng.normal(0, 0.2, 2 * HIDDEN),
        "out_b": np.zeros(1),
    }
    for way in "fb":
        model[f"{way}_x"] = rng.normal(0, size**-0.5, (size, 4 * HIDDEN))
        model[f"{way}_h"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        model[f"{way}_b"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
    return {k: v.astype(np.float32) for k, v in model.items()}


def gradients(model: Model, f: Features, labels: np.ndarray) -> tuple[float, Model]:
    """Mean cross entropy over the blocks, and its derivative by every parameter."""
    x = _inputs(model, f)
    score = np.full(len(x), model["out_b"][0], np.float32)
    runs = {}
    for way, back in (("f", False), ("b", True)):
        rows, saved = _steps(f.sizes, back), []
        h = c = np.zeros((len(rows[0]) if rows else 0, HIDDEN), np.float32)
        out = model["out"][:HIDDEN] if way == "f" else model["out"][HIDDEN:]
        for at in rows:
            before_h, before_c = h[: len(at)], c[: len(at)]
            gates = _gates(x[at] @ model[f"{way}_x"] + before_h @ model[f"{way}_h"] + model[f"{way}_b"])
            c = gates[1] * before_c + gates[0] * gates[3]
            h = gates[2] * np.tanh(c)
            score[at] += h @ out
            saved.append((at, before_h, before_c, gates, c, h))
        runs[way] = saved
    p = _sigmoid(score)
    n = max(len(x), 1)
    loss = float(-np.mean(np.log(np.where(labels, p, 1 - p) + 1e-7))) if len(x) else 0.0
    d_score = ((p - labels) / n).astype(np.float32)
    grad = {k: np.zeros_like(v) for k, v in model.items()}
    grad["out_b"][0] = d_score.sum()
    d_x = np.zeros_like(x)
    for way in "fb":
        half = slice(0, HIDDEN) if way == "f" else slice(HIDDEN, 2 * HIDDEN)
        later_h = later_c = np.zeros((0, HIDDEN), np.float32)
        for at, before_h, before_c, (i, keep, o, g), c, h in reversed(runs[way]):
            grad["out"][half] += d_score[at] @ h
            d_h = d_score[at][:, None] * model["out"][half]
            d_h[: len(later_h)] += later_h
            tanh_c = np.tanh(c)
            d_c = d_h * o * (1 - tanh_c**2)
            d_c[: len(later_c)] += later_c
            d_z = np.concatenate(
                [d_c * g * i * (1 - i), d_c * before_c * keep * (1 - keep), d_h * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1
            )
            grad[f"{way}_x"] += x[at].T @ d_z
            grad[f"{way}_h"] += before_h.T @ d_z
            grad[f"{way}_b"] += d_z.sum(axis=0)
            d_x[at] += d_z @ model[f"{way}_x"].T
            later_h, later_c = d_z @ model[f"{way}_h"].T, d_c * keep
    owner = np.repeat(np.arange(len(x)), f.path_sizes)
    np.add.at(grad["path"], f.paths, d_x[owner, :PATH] / np.sqrt(f.path_sizes[owner])[:, None].astype(np.float32))
    owner = np.repeat(np.arange(len(x)), f.word_sizes)
    np.add.at(grad["word"], f.words, d_x[owner, PATH : PATH + WORD] / f.word_sizes[owner][:, None].astype(np.float32))
    return loss, grad


def labelled(page: str) -> tuple[list[Block], np.ndarray]:
    """Blocks of a made page without their marks, and whether each is main text."""
    found = blocks(page)
    labels = np.array([b.text.startswith(MAIN) for b in found])
    return [b._replace(text=b.text[1:].strip()) for b in found], labels


@lru_cache(maxsize=2)
def trained(seed: int = 1, n_pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> Model:
    """The labeller after some passes over the made pages, by Adam."""
    rng = np.random.default_rng(seed)
    made = [labelled(p) for p in pages(seed, n_pages)]
    model = _start(rng)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    batches = []
    by_size = sorted(range(len(made)), key=lambda k: len(made[k][0]))
    for at in range(0, len(made), BATCH):
        some = [made[k] for k in by_size[at : at + BATCH]]
        batches.append((Features([b for b, _ in some]), np.concatenate([y for _, y in some])))
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for k in rng.permutation(len(batches)).tolist():
            _, grad = gradients(model, *batches[k])
            norm = float(np.sqrt(sum(float((g**2).sum()) for g in grad.values())))
            step += 1
            for name, g in grad.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-6))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g**2 - second[name])
                unbiased = first[name] / (1 - 0.9**step)
                model[name] -= rate * unbiased / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return model
