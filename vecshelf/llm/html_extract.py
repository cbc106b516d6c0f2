"""Main text of web pages by a recurrent block labeller.

A page is a sequence of text blocks. A bidirectional LSTM in numpy reads each block's hashed tag
path and hashed words and labels it content or not, so every label draws on the whole page. It is
trained here: a bounded sample of pages gives blocks whose place in the markup tells what they are,
and copies of these pages with blocks planted from named kinds of boilerplate teach the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import bounded_sample, coded, hashes, text_of, text_rows, text_slices, tidy
from vecshelf.llm.html_blocks import blocks

PATH, WORDS, OTHER, HIDDEN = 384, 32, 6, 24
INPUT = PATH + WORDS + OTHER
TRAIN_PAGES = 300  # bound of the sample
TRAIN_BLOCKS = 150  # of a sampled page that training reads
RUNNING_WORDS = 8  # of a block that is taken for content where the markup does not say
EPOCHS, BATCH, RATE = 14, 16, 0.01
SEED = 41

#: Kinds of boilerplate that are planted: fixed values, element names and words of classes and ids.
BOILERPLATE_TAGS = "nav header footer aside form button dialog menu select fieldset label noscript iframe object textarea".split()
BOILERPLATE_WORDS = (
    "ad ads advert advertisement sponsor sponsored promo banner cookie cookies consent notice gdpr popup modal "
    "newsletter subscribe signup sidebar side widget related recommended share social comment comments reply "
    "replies discussion disqus respond menu nav navbar navigation breadcrumb breadcrumbs header masthead footer "
    "foot copyright legal login search pagination pager toolbar skip alert form"
).split()
CONTENT_TAGS = "article main".split()
CONTENT_WORDS = "article content main post entry story body text".split()


class Page(NamedTuple):
    paths: list[tuple[str, ...]]
    texts: list[str]


def place_says(path: tuple[str, ...]) -> bool | None:
    """What a block's place in the markup says: content, boilerplate, or nothing."""
    words = {w[1:] if w[0] == "." else w for w in path}
    if words & {*BOILERPLATE_TAGS, *BOILERPLATE_WORDS}:
        return False
    if words & {*CONTENT_TAGS} or {w for w in path if w[0] == "."} & {"." + w for w in CONTENT_WORDS}:
        return True
    return None


def path_rows(paths: list[tuple[str, ...]]) -> np.ndarray:
    """Hashed tag-path vectors: two places per word of the path."""
    rows = np.zeros((len(paths), PATH), np.float32)
    for i, path in enumerate(paths):
        for word in path:
            h = xxhash.xxh3_64_intdigest(word)
            rows[i, [h % PATH, (h >> 32) % PATH]] = 1
    return rows


def block_parts(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all blocks of all pages, in order: distinct path vectors, which one each has, and the other inputs."""
    texts = [t for p in pages for t in p.texts]
    distinct_paths: dict[tuple[str, ...], int] = {}
    path = [distinct_paths.setdefault(p, len(distinct_paths)) for page in pages for p in page.paths]
    split = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    codes, distinct = coded([w for ws in split for w in ws])
    out = np.zeros((len(texts), WORDS + OTHER), np.float32)
    if distinct:
        bucket = (hashes(distinct) % np.uint64(WORDS)).astype(np.int64)[codes]
        owner = np.repeat(np.arange(len(texts)), sizes)
        counts = np.bincount(owner * WORDS + bucket, minlength=len(texts) * WORDS).reshape(-1, WORDS)
        out[:, :WORDS] = counts / np.maximum(1, np.sqrt((counts**2).sum(axis=1, keepdims=True)))
    n = [len(p.texts) for p in pages]
    place = np.concatenate([np.arange(k) / max(1, k - 1) for k in n]) if texts else np.zeros(0)
    chars = np.array([len(t) for t in texts], np.float32)
    ends = np.array([t[-1] in ".!?:;…" for t in texts], np.float32)
    anchors = np.array([float("a" in p) for page in pages for p in page.paths], np.float32)
    other = (np.log1p(chars) / 6, np.log1p(sizes) / 4, ends, anchors, place, np.ones(len(texts)))
    for i, column in enumerate(other):
        out[:, WORDS + i] = column
    return path_rows(list(distinct_paths)), np.array(path, np.int64), out


class Labeller(NamedTuple):
    """Weights of both directions, [input + hidden, 4 * hidden], their biases, and the output layer."""

    w: np.ndarray  # [2, INPUT + HIDDEN, 4 * HIDDEN]
    b: np.ndarray  # [2, 4 * HIDDEN]
    v: np.ndarray  # [2 * HIDDEN + 1]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _pass(given: np.ndarray, alive: np.ndarray, recurrent: np.ndarray, keep: bool):
    """One direction over the weighted inputs [time, page, 4 * hidden]; `alive` marks steps within a page.

    Returns the hidden states of all steps and, if asked, what the gradient needs.
    """
    steps, n = alive.shape
    h = c = np.zeros((n, HIDDEN), np.float32)
    hs, held = np.zeros((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        z = given[t] + h @ recurrent
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        on = alive[t][:, None]
        fresh = np.where(on, f * c + i * g, c)
        squashed = np.tanh(fresh)
        if keep:
            held.append((h, c, i, f, o, g, squashed))
        c, h = fresh, np.where(on, o * squashed, h)
        hs[t] = h
    return hs, held


def _reversed(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each page's steps in reverse order, padding left at the end."""
    steps = np.arange(len(x))[:, None]
    at = np.where(steps < lengths, lengths - 1 - steps, steps)
    return np.take_along_axis(x, at.reshape(at.shape + (1,) * (x.ndim - 2)), axis=0)


def probabilities(given: tuple[np.ndarray, np.ndarray], lengths: np.ndarray, model: Labeller) -> np.ndarray:
    """[time, page] chance that a block is content, from the weighted inputs of both directions."""
    alive = np.arange(len(given[0]))[:, None] < lengths
    ahead, _ = _pass(given[0], alive, model.w[0][INPUT:], False)
    back, _ = _pass(_reversed(given[1], lengths), alive, model.w[1][INPUT:], False)
    return _sigmoid(ahead @ model.v[:HIDDEN] + _reversed(back, lengths) @ model.v[HIDDEN:-1] + model.v[-1])


def _gradients(x: np.ndarray, lengths: np.ndarray, y: np.ndarray, known: np.ndarray, model: Labeller) -> Labeller:
    alive = np.arange(len(x))[:, None] < lengths
    inputs = (x, _reversed(x, lengths))
    states, helds = zip(*(
        _pass(inputs[d] @ model.w[d][:INPUT] + model.b[d], alive, model.w[d][INPUT:], True) for d in (0, 1)
    ))
    ahead, back = states[0], _reversed(states[1], lengths)
    p = _sigmoid(ahead @ model.v[:HIDDEN] + back @ model.v[HIDDEN:-1] + model.v[-1])
    e = ((p - y) * known / max(1, known.sum())).astype(np.float32)
    gv = np.concatenate([np.einsum("tn,tnh->h", e, ahead), np.einsum("tn,tnh->h", e, back), [e.sum()]])
    gw, gb = np.zeros_like(model.w), np.zeros_like(model.b)
    outer = (e[:, :, None] * model.v[:HIDDEN], _reversed(e[:, :, None] * model.v[HIDDEN:-1], lengths))
    for d in (0, 1):
        recurrent = model.w[d][INPUT:]
        dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, squashed = helds[d][t]
            on = alive[t][:, None]
            up = (dh + outer[d][t]) * on
            inner = dc * on + up * o * (1 - squashed**2)
            dz = np.concatenate(
                [inner * g * i * (1 - i), inner * c * f * (1 - f), up * squashed * o * (1 - o), inner * i * (1 - g**2)],
                axis=1,
            )
            gw[d][:INPUT] += inputs[d][t].T @ dz
            gw[d][INPUT:] += h.T @ dz
            gb[d] += dz.sum(axis=0)
            dh = np.where(on, dz @ recurrent.T, dh + outer[d][t] * 0)
            dc = np.where(on, inner * f, dc)
    return Labeller(gw, gb, gv.astype(np.float32))


def _planted(page: Page, labels: list[bool | None], rng: np.random.Generator) -> tuple[Page, list[bool | None]]:
    """A copy of a page with boilerplate of named kinds planted, and its content container renamed."""
    rename = rng.random()
    holder = None
    if rename < 0.5:
        holder = (str(rng.choice(CONTENT_TAGS)),) if rename < 0.2 else ("div", "." + str(rng.choice(CONTENT_WORDS)))
    paths, texts, said = [], [], []
    for path, text, label in zip(page.paths, page.texts, labels):
        if holder and label:
            path = tuple(w for p in path for w in (holder if p in CONTENT_TAGS else (p,)))
        paths.append(path)
        texts.append(text)
        said.append(label)
    for _ in range(rng.integers(1, 5)):
        at = int(rng.integers(0, len(paths)))
        word = str(rng.choice(BOILERPLATE_WORDS))
        named = ("." + word, *(("~" + word[:6],) if len(word) > 6 else ()))
        tag = str(rng.choice(["div", "section", "ul", "article", "p", "span"]))
        holder_ = (str(rng.choice(BOILERPLATE_TAGS)),) if rng.random() < 0.35 else (tag, *named)
        inside = (*paths[at], *holder_, *(("p",) if rng.random() < 0.6 else ()))
        k = int(rng.integers(1, 4))
        sources = rng.integers(0, len(texts), k)
        paths[at + 1 : at + 1] = [inside] * k
        texts[at + 1 : at + 1] = [texts[s] for s in sources]
        said[at + 1 : at + 1] = [False] * k
    return Page(paths, texts), said


def train(pages: list[Page], epochs: int = EPOCHS) -> Labeller:
    """Weights after Adam steps over the pages and planted copies of them; the same for the same pages."""
    rng = np.random.default_rng(SEED)
    model = Labeller(
        (rng.standard_normal((2, INPUT + HIDDEN, 4 * HIDDEN)) * 0.08).astype(np.float32),
        np.concatenate([np.zeros((2, HIDDEN)), np.ones((2, HIDDEN)), np.zeros((2, 2 * HIDDEN))], axis=1).astype(np.float32),
        (rng.standard_normal(2 * HIDDEN + 1) * 0.2).astype(np.float32),
    )
    examples = []
    for page in pages:
        page = Page(page.paths[:TRAIN_BLOCKS], page.texts[:TRAIN_BLOCKS])
        labels = [place_says(p) for p in page.paths]
        if True not in labels:  # no container that says so: running text is content
            labels = [
                True if said is None and "a" not in path and len(text.split()) >= RUNNING_WORDS else said
                for said, path, text in zip(labels, page.paths, page.texts)
            ]
        if any(label is not None for label in labels):
            examples += [(page, labels), _planted(page, labels, rng), _planted(page, labels, rng)]
    ready = []
    for page, labels in examples:
        paths, path, others = block_parts([page])
        said, sure = np.array([x is True for x in labels]), np.array([x is not None for x in labels])
        ready.append((np.concatenate([paths[path], others], axis=1), said, sure))
    moments = [(np.zeros_like(m), np.zeros_like(m)) for m in model]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(ready))
        # Pages of like length share a batch.
        order = order[np.argsort([len(ready[i][0]) // 8 for i in order], kind="stable")]
        batches = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            group = [ready[i] for i in batches[k]]
            lengths = np.array([len(g[0]) for g in group])
            x = np.zeros((lengths.max(), len(group), INPUT), np.float32)
            y, known = np.zeros(x.shape[:2], np.float32), np.zeros(x.shape[:2], np.float32)
            for i, (rows, said, sure) in enumerate(group):
                x[: len(rows), i], y[: len(rows), i], known[: len(rows), i] = rows, said, sure
            step += 1
            for m, g, (first, second) in zip(model, _gradients(x, lengths, y, known, model), moments):
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                m -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return model


def fit(pages: DataFrame, id: str = "page_id", html: str = "html", rows: int = TRAIN_PAGES) -> Labeller:
    """A labeller from about `rows` pages, chosen by a hash of the id; null ids and pages teach nothing.

    The driver gets the blocks of the sample, TRAIN_BLOCKS per page at most.
    """
    whole = pages.select(F.col(id).alias("id"), F.col(html).cast("string").alias("html")).where("id is not null and html is not null")
    sample = bounded_sample(whole, "id", rows, SEED)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(x)[:TRAIN_BLOCKS] for x in batch.column(1).to_pylist()]
            paths = pa.array([[list(p) for p, _ in f] for f in found], pa.list_(pa.list_(pa.string())))
            texts = pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), paths, texts], names=["id", "paths", "texts"])

    rows_ = sample.mapInArrow(read, "id long, paths array<array<string>>, texts array<string>").collect()
    return train([Page([tuple(p) for p in r["paths"]], r["texts"]) for r in sorted(rows_) if r["texts"]])


def content_chances(pages: list[Page], model: Labeller) -> list[np.ndarray]:
    """For each page the chance of each block; pages of like length are read side by side."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    lengths = np.array([len(p.texts) for p in pages], np.int64)
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        # As many pages as keep the padded input small, whatever their length.
        n = 1
        while at + n < len(order) and (n + 1) * lengths[order[at + n]] <= 8192 and lengths[order[at + n]] <= 2 * lengths[order[at]] + 8:
            n += 1
        group = order[at : at + n]
        paths, path, others = block_parts([pages[i] for i in group])
        given = []
        for w, b in zip(model.w, model.b):
            weighted = (paths @ w[:PATH])[path] + others @ w[PATH:INPUT] + b
            x = np.zeros((lengths[group[-1]], n, 4 * HIDDEN), np.float32)
            first = 0
            for k, i in enumerate(group):
                x[: lengths[i], k] = weighted[first : first + lengths[i]]
                first += lengths[i]
            given.append(x)
        p = probabilities(tuple(given), lengths[group], model)
        for k, i in enumerate(group):
            out[i] = p[: lengths[i], k]
        at += n
    return out


def extracted(pages: DataFrame, model: Labeller, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_blocks, n_kept.

    The text is that of all blocks labelled content, in page order, joined by one space; blocks have
    their character references decoded and white space made single. A null, empty or blank page has
    an empty text. Ids and urls may be null or repeat; other columns are not read; an empty table
    gives an empty result. Pages are read whole, however long.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 2):
                found = [Page([p for p, _ in f], [t for _, t in f]) for f in map(blocks, part.column(2).to_pylist())]
                texts, kept = [], []
                for page, chance in zip(found, content_chances(found, sent.value)):
                    chosen = [t for t, p in zip(page.texts, chance) if p >= 0.5]
                    texts.append(" ".join(chosen))
                    kept.append(len(chosen))
                columns = [pa.array(texts, pa.string()), pa.array([len(f.texts) for f in found], pa.int32()), pa.array(kept, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns], names=["page_id", "url", "text", "n_blocks", "n_kept"]
                )

    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(html).alias("html"))
    return text_rows(rows).mapInArrow(tidy(run), "page_id long, url string, text string, n_blocks int, n_kept int")
