import random

import brute
import numpy as np
import pyarrow as pa

from flightlake.llm import cotrain


def labelled(spark, n=600, seed=0):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randrange(20, 80))]
        bad, toxic = i % 4 == 0, i % 7 == 0
        if bad:
            w = [w[0].upper() + "!!"] * len(w)
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["moron", "idiot"])
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, int(not bad), int(toxic)))
    docs += [(n, None), (n + 1, ""), (None, "word1 word2"), (n + 2, "word3 " * 20000)]
    return docs, brute.frame(spark, docs), spark.createDataFrame([*labels, (None, 1, 0), (1, None, None), (10**9, 1, 1)], "doc_id long, quality int, toxic int")


def test_unlabelled_documents_are_judged(spark):
    rows, docs, labels = labelled(spark)
    model = cotrain.fit(docs, labels)
    got = [r for r in cotrain.scores(docs, model).collect()]
    assert len(got) == len(rows)
    own = {r["doc_id"]: r for r in got}
    free = range(0, 600, 3)
    assert np.mean([(own[i]["quality"] >= 0.5) == (i % 4 != 0) for i in free]) > 0.95
    assert np.mean([(own[i]["toxic"] >= 0.5) == (i % 7 == 0) for i in free]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = cotrain.accepted(docs, model)
    assert kept.dtypes == docs.dtypes
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(r["doc_id"]) for r in got if r["keep"])


def test_the_sample_is_bounded(spark):
    _, docs, labels = labelled(spark)
    assert abs(docs.join(labels.filter(cotrain._share(labels["doc_id"], 400, 100)), "doc_id").count() - 100) < 40
    assert cotrain.fit(docs, labels, max_labelled=150, rounds=2)


def test_all_unlabelled_documents_take_part(spark, monkeypatch):
    rows, docs, labels = labelled(spark)
    seen, told_by = [], cotrain._told

    def told(notes, state, sure):
        out = told_by(notes, state, sure)
        again = told_by(cotrain.Notes(notes.table.repartition(7), notes.vocabulary), state, sure)
        assert all((out[k].gradient == again[k].gradient).all() and (out[k].curve == again[k].curve).all() for k in out)
        seen.append(max(p.total for p in out.values()) * 2)
        return out

    monkeypatch.setattr(cotrain, "_told", told)
    cotrain.fit(docs, labels)
    assert len(seen) == 2 and min(seen) > 100


def test_scores_from_notes_equal_scores_from_texts(spark):
    """Also with repeated rows, ids that repeat with other texts, ties among labels, and ids without a number."""
    rows, docs, labels = labelled(spark, 300)
    more = [*rows, *rows[:5], (7, "another text " * 30), (7, None)]
    docs = brute.frame(spark, more)
    labels = labels.unionByName(spark.createDataFrame([(2, 1, 1), (2, 0, 0), (4, 0, 1)], "doc_id long, quality int, toxic int"))
    plain = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    got = plain(cotrain.fitted_scores(docs, labels))
    assert len(got) == len(more)
    assert got == plain(cotrain.scores(docs, cotrain.fit(docs, labels)))


def test_nothing_to_learn_from(spark):
    docs = brute.frame(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["keep"] for r in cotrain.scores(docs, cotrain.fit(docs, none)).collect())
    empty = brute.frame(spark, [])
    assert cotrain.scores(empty, cotrain.fit(empty, none)).collect() == []
    assert cotrain.fitted_scores(empty, none).collect() == [] and all(r["keep"] for r in cotrain.fitted_scores(docs, none).collect())


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    n = 400
    y = rng.integers(0, 2, n).astype(float)
    text, begins = cotrain.text_features(pa.array([f"{'good' if t else 'poor'}{rng.integers(3)} x{i % 5}" for i, t in enumerate(y)]))
    meta = cotrain.meta_features(["en"] * n, [f"s{int(t)}" for t in y], [10] * n)
    known = np.where(np.arange(n) < 60, y, np.nan)
    heads = cotrain.train(text, begins, meta, {"quality": known}, np.arange(n) % 5 == 0)
    h = heads["quality"]
    p = h.probability(h.text.logits(*h.text.columns(text, begins), n), h.meta.logits(*h.meta.columns(meta.ravel(), np.arange(0, 3 * n + 1, 3)), n))
    assert ((p > 0.5) == (y > 0)).mean() > 0.97
