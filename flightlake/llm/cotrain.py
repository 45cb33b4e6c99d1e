"""Co-training of a text view and a metadata view, for quality and for toxicity.

The model starts from a bounded sample of labelled documents; everything else reads all documents. The text view
knows which words of a selected vocabulary stand in a text, and how it is written (letter case, symbols, repetition, length).
The metadata view knows language, source and stored length. Over several rounds each view labels all documents that it is
sure of for the other one: what they would change is summed up for each feature where they are read. On labelled documents held back from training both are calibrated into one probability.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import ALNUM, LOWER, SPACED, arrow_batch, batches_of, flat, mixed, stage, unstage, word_bounds, word_hashes

HEADS = ("quality", "toxic")
META = ("lang", "source", "n_chars")
#: Bytes of text that are looked at together.
BATCH = 2 << 20
#: Bytes at the beginning of a word that are features too.
STEMS = (4, 5)
_LETTERS_UP = np.zeros(256, bool)
_LETTERS_UP[65:91] = True
_SIGNS = np.zeros(256, bool)
_SIGNS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True


def tag(name: int, values: np.ndarray) -> np.ndarray:
    """A 64-bit feature for each value of one kind."""
    with np.errstate(over="ignore"):
        return mixed(values.astype(np.int64).view(np.uint64) + np.uint64(name + 1) * np.uint64(0x9FB21C651E98DF25))


def _distinct(docs: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((features, docs))
    d, f = docs[order], features[order]
    new = np.ones(len(f), bool)
    new[1:] = (d[1:] != d[:-1]) | (f[1:] != f[:-1])
    return d[new], f[new]


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all texts in a row, and where those of each text begin (and the last end)."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    lowered = LOWER[data]
    starts, ends, counts = word_bounds(lowered, offsets, ALNUM)
    # Words, and by their first bytes families of words.
    whole = word_hashes(lowered, starts, ends)
    stems = (tag(200 + k, word_hashes(lowered, starts, np.minimum(ends, starts + k)).view(np.int64)) for k in STEMS)
    doc = np.repeat(np.arange(n), np.diff(counts))
    once = [_distinct(doc, f) for f in (whole, *stems)]
    d, w = (np.concatenate(x) for x in zip(*once))
    total, distinct = np.diff(counts), np.bincount(once[0][0], minlength=n)
    length = np.maximum(np.diff(offsets), 1)
    part = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets]) / length
    again = np.concatenate([[False], whole[1:] == whole[:-1]]) if len(whole) else np.zeros(0, bool)
    repeated = np.diff(np.concatenate([[0], np.cumsum(again)])[counts])
    _, _, raw_counts = word_bounds(data, offsets, SPACED)
    styles = [
        part(_LETTERS_UP), part(_SIGNS), part(_DIGITS), part(~SPACED),
        distinct / np.maximum(total, 1), np.log2(total + 1) / 16, np.diff(raw_counts) / np.maximum(total, 1) / 2,
        np.minimum(length / np.maximum(np.diff(raw_counts), 1) / 40, 1), repeated / np.maximum(total, 1),
    ]
    bins = np.concatenate([tag(i, np.floor(np.clip(s, 0, 1) * 20)) for i, s in enumerate(styles)]) if n else np.zeros(0, np.uint64)
    docs = np.concatenate([d, np.tile(np.arange(n), len(styles))])
    features = np.concatenate([w, bins])
    order = np.argsort(docs, kind="stable")
    return features[order], np.searchsorted(docs[order], np.arange(n + 1))


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Features of the metadata, one row per document; null is a value of its own."""
    hashed = lambda values: word_hashes(*_bytes([str(v) for v in values]))
    size = np.array([-1 if v is None else int(np.log2(max(v, 1)) * 2) for v in n_chars], np.int64)
    return np.stack([tag(100, hashed(lang).view(np.int64)), tag(101, hashed(source).view(np.int64)), tag(102, size)], 1) if len(lang) else np.zeros((0, 3), np.uint64)


def _bytes(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = flat(pa.array(values, pa.large_string()))
    return data, offsets[:-1], offsets[1:]


@dataclass
class Linear:
    """A logistic model over features that are there or not; unknown ones count nothing."""

    vocabulary: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def grow(self) -> None:
        if len(self.weights) != len(self.vocabulary) + 1:
            self.weights = np.zeros(len(self.vocabulary) + 1)

    def columns(self, features: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and vocabulary place of the known features."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.vocabulary, features)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == features
        return np.repeat(np.arange(len(begins) - 1), np.diff(begins))[known], at[known]

    def logits(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(rows, self.weights[columns], n) + self.weights[-1]

    def fit(self, rows: np.ndarray, columns: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int, penalty: float = 1.0, pull: Pull | None = None) -> None:
        """Gradient steps with rates that follow each weight's own gradients; goes on from the present weights.

        ``pull`` stands for documents that are not here: their loss is bounded, weight by weight, by a parabola around the weights it was summed up at.
        """
        n, k = len(target), len(self.vocabulary)
        self.grow()
        use = weight[rows] > 0
        rows, columns, seen, total = rows[use], columns[use], np.zeros(k + 1), max(weight.sum(), 1e-9)
        begin = self.weights.copy()
        if pull is not None:
            total += pull.total
        for _ in range(steps):
            error = (1 / (1 + np.exp(-np.clip(self.logits(rows, columns, n), -30, 30))) - target) * weight
            gradient = np.append(np.bincount(columns, error[rows], k) + penalty * self.weights[:-1], error.sum())
            if pull is not None:
                gradient = gradient + pull.gradient + pull.curve * (self.weights - begin)
            gradient = gradient / total
            seen += gradient * gradient
            self.weights -= 0.3 * gradient / np.sqrt(seen + 1e-12)


@dataclass
class Pull:
    """Sums over documents, for each weight of a view (the last is the constant): gradient and a bound of the curvature; and the documents' weight."""

    gradient: np.ndarray
    curve: np.ndarray
    total: float

    @staticmethod
    def of(gradient: np.ndarray, curve: np.ndarray) -> Pull:
        """From sums as ``pulls`` makes them."""
        return Pull(gradient[:-1] / UNIT, curve[:-1] / UNIT, gradient[-1] * 0.5)


def without_rare(features: np.ndarray, begins: np.ndarray, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The features that at least ``least`` of the documents have, and where each document's begin. Sorts one copy and holds no other."""
    ordered = np.sort(features)
    # A value stands ``least`` times in a row where it equals the one so many places on.
    often = ordered[: max(len(ordered) - least + 1, 0)]
    often = np.unique(often[often == ordered[least - 1 :]])
    del ordered
    kept = np.zeros(len(features), bool)
    for a in range(0, len(features), 1 << 20):
        part = features[a : a + (1 << 20)]
        at = np.minimum(np.searchsorted(often, part), max(len(often) - 1, 0))
        kept[a : a + (1 << 20)] = often[at] == part if len(often) else False
    return features[kept], np.concatenate([[0], np.cumsum(kept)])[begins]


def select(features: np.ndarray, begins: np.ndarray, target: np.ndarray, size: int, least: int = 5, certain: float = 30.0) -> np.ndarray:
    """The features of at least ``least`` documents that tell most about the target; at most ``size``.

    A feature whose chi-square is below ``certain`` would be one of many that only seem to tell something, and is left out.
    """
    vocabulary = np.unique(features)
    at = np.searchsorted(vocabulary, features).astype(np.int32)
    rows = np.repeat(np.arange(len(begins) - 1, dtype=np.int32), np.diff(begins))
    ok = ~np.isnan(target)
    have = ok[rows]
    n, pos = max(ok.sum(), 1), np.nansum(target)
    df = np.bincount(at[have], minlength=len(vocabulary)).astype(float)
    hits = np.bincount(at[have], target[rows[have]], len(vocabulary))
    spread = df * pos / n * (1 - pos / n) * (1 - df / n)
    best = np.where(df >= least, (hits - df * pos / n) ** 2 / np.maximum(spread, 1e-9), 0)
    return vocabulary[np.sort(np.argsort(-best, kind="stable")[: min(size, int((best >= certain).sum()))])]


@dataclass
class Head:
    text: Linear
    meta: Linear
    mix: np.ndarray  # weights of both logits and a constant

    def probability(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(text * self.mix[0] + meta * self.mix[1] + self.mix[2], -30, 30)))


def _mix(views: np.ndarray, target: np.ndarray, steps: int = 50) -> np.ndarray:
    """Calibration: a small logistic model of both views' logits, by Newton's method; no view may count against itself."""
    x = np.column_stack([np.clip(views, -30, 30), np.ones(len(views))])
    prior = w = np.array([1.0, 0.0, 0.0])
    loss = lambda v: np.logaddexp(0, np.where(target > 0, -(x @ v), x @ v)).sum() + ((v - prior) ** 2).sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2 * np.eye(3), x.T @ (p - target) + 2 * (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return np.array([max(w[0], 0.0), max(w[1], 0.0), w[2]])


def train(features: np.ndarray, begins: np.ndarray, meta: np.ndarray, targets: dict[str, np.ndarray], held: np.ndarray, rounds: int = 3, sure: float = 0.97, vocabulary: int = 20_000) -> dict[str, Head]:
    """Heads from documents at hand; a target is 1, 0 or NaN where it is not known. ``held`` documents calibrate only."""
    n = len(begins) - 1
    meta_begins = np.arange(0, 3 * n + 1, 3)
    state, told = State({}, {}, {}), None
    for turn in range(rounds):
        one_round(state, features, begins, meta, targets, held, told, turn == rounds - 1, vocabulary)
        views = [[(text, text.columns(features, begins)), (about, about.columns(meta.ravel(), meta_begins))] for text, about in state.views.values()]
        busy = [held | ~np.isnan(targets[h]) for h in state.views]
        told = {(list(state.views)[h], v): Pull.of(*sums) for h, v, *sums in pulls(views, busy, n, sure)}
    return state.heads


#: Sums are in whole units of this size, so they do not depend on the order of documents or on how they are dealt.
UNIT = 1 << 20
_PULLS = "head int, view int, place int, gradient long, curve long"


def pulls(views: list[list], targets_known: list[np.ndarray], n: int, sure: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """What each view would learn from documents the other one is sure of: head, view, and for each weight gradient and curvature in units; last, their number.

    ``views`` has for each head its two pairs of model and known features of the documents, ``targets_known`` which documents have a label.
    """
    limit = np.log(sure / (1 - sure))
    for h, pair in enumerate(views):
        logits = [view.logits(rows, columns, n) for view, (rows, columns) in pair]
        for v, (view, (rows, columns)) in enumerate(pair):
            certain = ~targets_known[h] & (np.abs(logits[1 - v]) > limit)
            # A label of another view counts half.
            error = (1 / (1 + np.exp(-np.clip(logits[v], -30, 30))) - (logits[1 - v] > 0)) * certain * 0.5
            # The logistic curvature is a quarter at most; it is shared out among the weights a document has.
            bound = certain * 0.125 * (np.bincount(rows, minlength=n) + 1)
            units = [np.rint(x * UNIT) for x in (error, bound)]
            k = len(view.vocabulary)
            sums = [np.concatenate([np.bincount(columns, u[rows], k), [u.sum()], [certain.sum() if i == 0 else 0]]) for i, u in enumerate(units)]
            yield h, v, *(x.astype(np.int64) for x in sums)


def _known(batch: pa.RecordBatch, vocabulary: np.ndarray) -> Iterator[tuple[pa.RecordBatch, object, object]]:
    """Notes of some documents at a time, with functions that give a text or metadata view the row and place of its known features."""
    lists = batch.column("places")
    ends = np.cumsum(lists.value_lengths().to_numpy())
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + BATCH, "right")))
        part = batch.slice(at, to - at)
        rows = np.repeat(np.arange(to - at), part.column("places").value_lengths().to_numpy())
        places = part.column("places").flatten().to_numpy()
        meta = part.column("meta").flatten().to_numpy().view(np.uint64)

        def text(view: Linear, rows: np.ndarray = rows, places: np.ndarray = places) -> tuple[np.ndarray, np.ndarray]:
            own = np.full(len(vocabulary), -1, np.int64)
            own[np.searchsorted(vocabulary, view.vocabulary)] = np.arange(len(view.vocabulary))
            found = own[places]
            return rows[found >= 0], found[found >= 0]

        def about(view: Linear, meta: np.ndarray = meta) -> tuple[np.ndarray, np.ndarray]:
            return view.columns(meta, np.arange(0, len(meta) + 1, len(META)))

        yield part, text, about
        at = to


def _pulls(batches: Iterator[pa.RecordBatch], model, vocabulary, sure: float) -> Iterator[pa.RecordBatch]:
    """The sums of ``pulls`` over all rows of a task."""
    state: State = pickle.loads(model.value)
    sums: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for part, text, about in _known(batch, vocabulary.value):
            views = [[(t, text(t)), (m, about(m))] for t, m in state.views.values()]
            ids = part.column("doc_id").fill_null(0).to_numpy()
            have = ~part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            labelled = [np.isin(ids, state.labelled[h]) & have for h in state.views]
            for h, v, *parts in pulls(views, labelled, part.num_rows, sure):
                sums[h, v] = [a + b for a, b in zip(sums[h, v], parts)] if (h, v) in sums else parts
    schema = pa.schema([("head", pa.int32()), ("view", pa.int32()), ("place", pa.int32()), ("gradient", pa.int64()), ("curve", pa.int64())])
    for (h, v), (gradient, curve) in sums.items():
        at = np.flatnonzero((gradient != 0) | (curve != 0))
        yield arrow_batch(schema, np.full(len(at), h, np.int32), np.full(len(at), v, np.int32), at.astype(np.int32), gradient[at], curve[at])


@dataclass
class State:
    """Where training stands between rounds: both views of each head that can be trained, ids with a known label, and finished heads."""

    views: dict[str, tuple[Linear, Linear]]
    labelled: dict[str, np.ndarray]
    heads: dict[str, Head]


_SCORES = "doc_id long, _quality double, _toxic double, _score double, _keep boolean"
_SCORE_NAMES = ("doc_id", "quality", "toxic", "score", "keep")
_SAMPLED = "doc_id long, features array<long>, meta array<long>, quality double, toxic double"


def _columns_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    features, begins = text_features(batch.column("text"))
    return features, begins, meta_features(*(batch.column(c).to_pylist() for c in META))


def _noted(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """What the views can use of each document: places of its features in the vocabulary, and its metadata's features."""
    words = Linear(vocabulary.value)
    for batch in batches_of(batches, limit=BATCH):
        features, begins, meta = _columns_of(batch)
        rows, places = words.columns(features, begins)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))])
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(places, pa.int32()))
        about = pa.ListArray.from_arrays(pa.array(np.arange(0, meta.size + 1, len(META)), pa.int32()), pa.array(meta.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, about], names=["doc_id", "places", "meta"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.int64())), ("meta", pa.list_(pa.int64())), ("quality", pa.float64()), ("toxic", pa.float64())])
    for batch in batches_of(batches, limit=BATCH):
        features, begins, meta = _columns_of(batch)
        yield arrow_batch(schema, batch.column("doc_id"), np.split(features.view(np.int64), begins[1:-1]), list(meta.view(np.int64)), batch.column("quality"), batch.column("toxic"))


def _train_task(batches: Iterator[pa.RecordBatch], before: bytes | None = None, told: dict | None = None, last: bool = True) -> Iterator[pa.RecordBatch]:
    """One round on the whole sample, sorted by id, in one task; the sample is bounded by its parameter.

    ``before`` is the state after the round before and ``told`` what all documents tell each view since then.
    """
    parts, ends, meta, ids, targets = [np.zeros(0, np.uint64)], [], [], [], {h: [] for h in HEADS}
    for batch in batches:
        lists = batch.column("features")
        parts.append(lists.flatten().to_numpy().view(np.uint64).copy())
        ends.append(lists.value_lengths().to_numpy())
        meta.append(batch.column("meta").flatten().to_numpy().reshape(-1, len(META)).view(np.uint64).copy())
        ids.append(batch.column("doc_id").to_numpy())
        for h in HEADS:
            targets[h].append(batch.column(h).to_numpy(zero_copy_only=False).astype(float))
    joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    features, begins = np.concatenate(parts), np.concatenate([[0], np.cumsum(joined(ends, np.int64))])
    del parts
    features, begins = without_rare(features, begins)
    ids = joined(ids, np.int64).astype(np.int64)
    held = mixed(ids.view(np.uint64)) % np.uint64(5) == 0
    metas = np.concatenate(meta) if meta else np.zeros((0, len(META)), np.uint64)
    known = {h: joined(t, float) for h, t in targets.items()}
    state = pickle.loads(before) if before else State({}, {h: np.unique(ids[~np.isnan(t)]) for h, t in known.items()}, {})
    one_round(state, features, begins, metas, known, held, told if before else None, last)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], names=["model"])


def one_round(state: State, features: np.ndarray, begins: np.ndarray, meta: np.ndarray, targets: dict[str, np.ndarray], held: np.ndarray, told: dict | None, last: bool, vocabulary: int = 20_000) -> None:
    """Fit both views of each head to the labelled documents and to what they are told; ``told`` is None in the first round. ``held`` documents calibrate only."""
    n = len(begins) - 1
    meta_begins = np.arange(0, 3 * n + 1, 3)
    for h, known in targets.items():
        shown = np.where(held, np.nan, known)
        own = ~np.isnan(shown)
        if told is None:
            words = select(features, begins, shown, vocabulary)
            if own.sum() < 2 or not len(words):
                state.heads[h] = Head(Linear(np.zeros(1, np.uint64), np.zeros(2)), Linear(np.zeros(1, np.uint64), np.zeros(2)), np.array([0.0, 0.0, 4.0 if h == "quality" else -4.0]))
                continue
            state.views[h] = Linear(words), Linear(np.unique(meta))
        elif h not in state.views:
            continue
        views = state.views[h]
        places = [views[0].columns(features, begins), views[1].columns(meta.ravel(), meta_begins)]
        for v, (view, place) in enumerate(zip(views, places)):
            view.fit(*place, np.where(own, shown, 0.0), own.astype(float), 250 if told is None else 50, pull=told.get((h, v)) if told else None)
        if last:
            check = held & ~np.isnan(known)
            both = np.column_stack([view.logits(*place, n) for view, place in zip(views, places)])
            state.heads[h] = Head(*views, _mix(both[check], known[check]) if check.sum() >= 2 else np.array([1.0, 0.0, 0.0]))


def _judged(heads: dict[str, Head], n: int, text, about) -> list[np.ndarray]:
    """Quality, toxicity, score and whether to keep, of ``n`` documents whose known features the two functions give."""
    p = {h: head.probability(*(v.logits(*known(v), n) for v, known in ((head.text, text), (head.meta, about)))) for h, head in heads.items()}
    return [p["quality"], p["toxic"], p["quality"] * (1 - p["toxic"]), (p["quality"] >= 0.5) & (p["toxic"] < 0.5)]


def _score(batches: Iterator[pa.RecordBatch], model, more: list[str]) -> Iterator[pa.RecordBatch]:
    heads: dict[str, Head] = pickle.loads(model.value)
    for batch in batches_of(batches, limit=BATCH):
        features, begins, meta = _columns_of(batch)
        meta_begins = np.arange(0, meta.size + 1, 3)
        out = _judged(heads, batch.num_rows, lambda v: v.columns(features, begins), lambda v: v.columns(meta.ravel(), meta_begins))  # noqa: B023
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in more), *map(pa.array, out)], names=[*more, "_quality", "_toxic", "_score", "_keep"])


def _score_notes(batches: Iterator[pa.RecordBatch], model, vocabulary) -> Iterator[pa.RecordBatch]:
    heads: dict[str, Head] = pickle.loads(model.value)
    for batch in batches:
        for part, text, about in _known(batch, vocabulary.value):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, _judged(heads, part.num_rows, text, about))], names=["doc_id", "_quality", "_toxic", "_score", "_keep"])


def _share(key: Column, of: int, wanted: int) -> Column:
    """A fixed share of all keys, about ``wanted`` of ``of``."""
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 20)) < int(min(1.0, wanted / max(of, 1)) * (1 << 20))


@dataclass
class Notes:
    """Known features of every document, staged, and the vocabulary their places are in."""

    table: DataFrame
    vocabulary: np.ndarray


def _trained(docs: DataFrame, labels: DataFrame, max_labelled: int, rounds: int, sure: float) -> tuple[bytes, Notes | None]:
    spark = docs.sparkSession
    vote = lambda c: F.signum(F.sum(F.when(labels[c] > 0, 1).when(labels[c] <= 0, -1)))
    known = labels.filter(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("label_id")).agg(*(F.when(vote(h) > 0, 1.0).when(vote(h) < 0, 0.0).alias(h) for h in HEADS))
    sample = stage(known.filter(_share(F.col("label_id"), labels.count(), max_labelled)))
    # The sample is bounded by its parameter, so it may be broadcast; texts are not shuffled.
    texts = _view(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    features = stage(texts.select("doc_id", "text", *META, *HEADS).mapInArrow(_sampled, _SAMPLED))
    state, told, notes = None, None, None
    for turn in range(max(rounds, 1)):
        last = turn >= rounds - 1
        row = features.repartition(1).sortWithinPartitions("doc_id").mapInArrow(partial(_train_task, before=state, told=told, last=last), "model binary").first()
        # Without a sample Spark starts no task; the model that knows nothing keeps everything.
        state = bytes(row["model"]) if row else next(_train_task(iter([]))).column("model")[0].as_py()
        views = pickle.loads(state).views
        if last or not views:
            break
        if notes is None:
            # The first round has fixed the vocabularies: texts are looked at once more, and never again between rounds.
            words = np.unique(np.concatenate([text.vocabulary for text, _ in views.values()]))
            shared = spark.sparkContext.broadcast(words)
            notes = Notes(stage(_view(docs).mapInArrow(partial(_noted, vocabulary=shared), "doc_id long, places array<int>, meta array<long>")), words)
        told = _told(notes, state, sure)
    unstage(sample, features)
    return pickle.dumps(pickle.loads(state).heads), notes


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 10_000, rounds: int = 3, sure: float = 0.97) -> bytes:
    """The model, of a size that does not depend on the tables.

    About ``max_labelled`` labelled documents, chosen by a hash of their id, are the sample; a fifth of them is held back to calibrate.
    Several labels of a document count as their majority, ties and null as unknown. Between rounds every row of ``docs`` whose label for a head is not in the
    sample is scored by both views, and what one is sure of counts half as a label for the other.
    """
    model, notes = _trained(docs, labels, max_labelled, rounds, sure)
    if notes:
        unstage(notes.table)
    return model


def fitted_scores(docs: DataFrame, labels: DataFrame, max_labelled: int = 10_000, rounds: int = 3, sure: float = 0.97) -> DataFrame:
    """``scores`` of the documents that the model is fitted with; their texts are not looked at again."""
    model, notes = _trained(docs, labels, max_labelled, rounds, sure)
    if notes is None:
        return scores(docs, model)
    share = docs.sparkSession.sparkContext.broadcast
    out = notes.table.mapInArrow(partial(_score_notes, model=share(model), vocabulary=share(notes.vocabulary)), _SCORES)
    return out.toDF(*_SCORE_NAMES)


def _told(notes: Notes, state: bytes, sure: float) -> dict[tuple[str, int], Pull]:
    """What all documents that one view is sure of tell the other one. Sums come for the fixed vocabularies only, so they fit the driver."""
    share = notes.table.sparkSession.sparkContext.broadcast
    shared, words = share(state), share(notes.vocabulary)
    each = notes.table.mapInArrow(partial(_pulls, model=shared, vocabulary=words, sure=sure), _PULLS)
    sums = each.groupBy("head", "view", "place").agg(F.sum("gradient").alias("gradient"), F.sum("curve").alias("curve")).toPandas()
    out = {}
    for i, (h, views) in enumerate(pickle.loads(state).views.items()):
        for v, view in enumerate(views):
            k = len(view.vocabulary)
            own = sums[(sums["head"] == i) & (sums["view"] == v)]
            gradient, curve = np.zeros(k + 2), np.zeros(k + 2)
            gradient[own["place"]], curve[own["place"]] = own["gradient"], own["curve"]
            out[h, v] = Pull.of(gradient, curve)
    shared.unpersist()
    words.unpersist()
    return out


def _view(docs: DataFrame) -> DataFrame:
    """What both views look at; a metadata column that is not there counts as null."""
    meta = [docs[c] if c in docs.columns else F.lit(None) for c in META]
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), *(m.cast("string" if c != "n_chars" else "long").alias(c) for m, c in zip(meta, META)))


def scores(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, quality, toxic, score, keep`` of every row.

    ``quality`` and ``toxic`` are probabilities, ``score`` that of both good quality and no toxicity; ``keep`` holds if quality is
    more likely than not and toxicity is not. A null text is scored like an empty one. Other columns are not read.
    """
    kept = ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return _view(docs).mapInArrow(partial(_score, model=shared, more=kept), _SCORES).toDF(*_SCORE_NAMES)


def accepted(docs: DataFrame, model: bytes) -> DataFrame:
    """The documents with ``keep``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    view = {f"__view_{c}": (docs[c] if c in docs.columns else F.lit(None)).cast("long" if c == "n_chars" else "string") for c in META}
    wide = docs.withColumns(view)
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    out = wide.mapInArrow(partial(_filter, model=shared, columns=docs.columns), kinds)
    return out


def _filter(batches: Iterator[pa.RecordBatch], model, columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, limit=BATCH):
        view = pa.RecordBatch.from_arrays([batch.column("text"), *(batch.column(f"__view_{c}") for c in META)], names=["text", *META])
        keep = next(_score(iter([view]), model, [])).column("_keep")
        yield batch.select(columns).filter(keep)
