import hashlib
import re

import brute
import numpy as np
import pytest

from flightlake.llm import infill

HOSTILE = ["<P>", "a<S>b", "<", "<<P", "P><S", "<P", "S>", "<M", "M><", "x" * 5 + "<", "é<Mé>", "日本<S", "🙂" * 7, "<P\n>", "\x00a", "a", "  ", "<p>", "<" * 9, "P>" * 5]


def plain_infill(doc_id, text, rate=90, spm=20, seed=1):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(t)
    if not t or re.search("<[PSM]>", t) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < spm:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rule", [infill.Rule(), infill.Rule(seed=7, rate=100, spm=50), infill.Rule(rate=0)])
def test_transform_and_restore(spark, rows, rule):
    corpus = brute.corpus() + [(1000 + i, HOSTILE[i % len(HOSTILE)]) for i in range(400)]
    out = infill.transform(brute.frame(spark, corpus), rule)
    assert rows(out) == sorted((plain_infill(d, t, rule.rate, rule.spm, rule.seed) for d, t in corpus), key=repr)
    assert rows(infill.restore(out)) == sorted(((d, t or "") for d, t in corpus), key=repr)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert rows(infill.digests(brute.frame(spark, corpus), rule)) == sorted(((*(p := plain_infill(d, t, rule.rate, rule.spm, rule.seed))[:5], sha(p[5]), sha(t)) for d, t in corpus), key=repr)


def test_empty_table(spark):
    assert infill.transform(brute.frame(spark, [])).collect() == []
    assert infill.digests(brute.frame(spark, [])).collect() == []


def test_shifts_follow_the_last_of_equal_starts():
    assert infill.shifts(4, np.array([0, 0, 2, 4]), np.array([9, 1, 5, 7])).tolist() == [1, 1, 5, 5]
