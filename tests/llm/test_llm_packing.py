import zlib

import brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from flightlake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, size):
    by = {}
    for r in pieces:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_pieces_and_sequences(spark):
    corpus = brute.corpus(0) + [(200, "<|endoftext|> x"), (201, "\x1f\x85 　 日本 ١٢  \n\n  end ")]
    docs = brute.frame(spark, corpus)
    got = packing.packed_documents(docs, PATH, size=64, ids=True).collect()
    k = Tokenizer.from_file(PATH)
    wanted = []
    for d, t in corpus:
        ids = [*k.encode(t or "", add_special_tokens=False).ids, 2]
        for i, (a, b) in enumerate(packing.cut(len(ids), 64)):
            wanted.append((d, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]))
    assert sorted(map(repr, wanted)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], list(r["ids"]))) for r in got)
    n = check(got, 64)
    assert n <= sum(w[3] for w in wanted) / 64 * 1.1 + 2


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 5)]
    assert packing.cut(8, 4) == [(0, 4), (4, 8)]
    assert packing.cut(3, 4) == [(0, 3)]
    assert packing.cut(0, 4) == []


def test_few_sequences_are_wasted():
    lengths = np.random.default_rng(0).integers(1, 1025, 8000)
    bins, offsets = packing.place(lengths, 1024)
    fill = np.bincount(bins, lengths)
    # No two of the lengths above half a sequence fit together, so this is near the least there is.
    assert fill.max() <= 1024 and len(fill) <= max(lengths.sum() / 1024, (lengths > 512).sum()) * 1.03
    order = np.lexsort((offsets, bins))
    ends = (offsets + lengths)[order]
    same = bins[order][1:] == bins[order][:-1]
    assert (offsets[order][1:][same] == ends[:-1][same]).all()


def test_empty_table(spark):
    assert packing.packed_documents(brute.frame(spark, []), PATH).collect() == []


def test_many_shards(spark):
    cut = spark.range(3000).selectExpr("id AS doc_id", "cast(0 AS int) AS piece", "id * 37 % 100 + 1 AS length")
    assert check(packing.pack(cut, size=100, shard=200).collect(), 100) < 3000 * 0.505 * 1.1
