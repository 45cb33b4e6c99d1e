"""N-gram Jaccard join by grouped prefixes, with connected components.

Two sets as similar as asked share a token among the first few of each, in any order common to all. Tokens come in the order of
how full their bucket is in a fixed table of counts over all documents, then of their hash: frequent ones come last. Documents with the same prefix and size form one group, and only
groups are listed under tokens. Lists with one group alone are dropped; the others are opened into the members' distinct sets,
each with a histogram of its tokens over 256 buckets. The difference of two histograms never exceeds that of the
sets, which rules out almost all pairs that are not links. Whole sets are fetched for the rest only.

Links are verified first between the members of each list and the most central one of them. What that joins needs no further
look; pairs of different components are then tried in full, long lists in blocks. So a group of near copies costs about one link per
member, yet no link between components is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import (
    BATCH_BYTES, LOWER, SPACED, arrow_batch, batches_of, components, flat, keyed, mixed, on_key, packed, prefix_sums, signed, span_hash, stage, text_key,
    unpacked, unstage, word_bounds, word_hashes,
)

#: Buckets that tokens are counted in; fixed, whatever the corpus.
SKETCH_BITS = 18
SKETCH = 1 << SKETCH_BITS
#: Buckets of a set's histogram, a byte each.
BINS = 256
#: Sets of more than ``LARGE`` tokens have another one of ``FINE`` buckets, looked at before the whole set is.
LARGE, FINE = 1000, 2048
#: Members of a list that are compared at a time.
BLOCK = 1024
#: Pairs that are compared at a time.
PAIRS = 1 << 15


def shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words, or of all its words if fewer."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, counts = word_bounds(data, offsets, SPACED)
    sums = prefix_sums(word_hashes(data, starts, ends))
    for a, b in zip(counts[:-1], counts[1:]):
        n = min(size, b - a)
        first = np.arange(a, b - n + 1) if n else np.zeros(0, np.int64)
        yield np.unique(span_hash(sums, first, first + n))


def prefix_length(n: int, percent: int) -> int:
    """How many first tokens two sets of similarity ``percent`` must share one of."""
    return n - -(-percent * n // 100) + 1 if n else 0


def histogram(tokens: np.ndarray, bins: int = BINS) -> bytes:
    return np.minimum(np.bincount((tokens & np.uint64(bins - 1)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def _count(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SKETCH, np.int64)
    for batch in batches_of(batches, limit=BATCH_BYTES // 2):
        for tokens in shingles(batch.column("text"), size):
            counts += np.bincount((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=SKETCH)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])


_SETS = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("g", pa.int64()), ("hist", pa.binary()), ("prefix", pa.list_(pa.int64()))])


def _sets(batches: Iterator[pa.RecordBatch], size: int, percent: int, level) -> Iterator[pa.RecordBatch]:
    seed = np.uint64(0x8CB92BA72F3D8DD7)
    for batch in batches_of(batches, limit=BATCH_BYTES // 2):
        out: list[list] = [[] for _ in range(6)]
        for tokens in shingles(batch.column("text"), size):
            order = np.argsort(level.value[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
            prefix = tokens[order[: prefix_length(len(tokens), percent)]]
            with np.errstate(over="ignore"):
                sums = [int(mixed(tokens ^ seed).sum().view(np.int64)), int(mixed(mixed(tokens) + seed).sum().view(np.int64)), int(mixed(prefix).sum().view(np.int64))]
            for column, x in zip(out, (len(tokens), *sums, histogram(tokens), signed(prefix))):
                column.append(x)
        yield arrow_batch(_SETS, batch.column(0), batch.column(1), *out)


def bound_passes(hist: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and histograms allow each pair: 100 |x & y| >= p |x | y| needs (100 + p) |x ^ y| <= (100 - p) (|x| + |y|)."""
    sizes_ok = np.minimum(sizes[a], sizes[b]) * 100 >= percent * np.maximum(sizes[a], sizes[b])
    out = np.zeros(len(a), bool)
    at = np.flatnonzero(sizes_ok)
    apart = np.abs(hist[a[at]].astype(np.int16) - hist[b[at]].astype(np.int16)).sum(1, dtype=np.int64)
    out[at] = (100 + percent) * apart <= (100 - percent) * (sizes[a[at]] + sizes[b[at]])
    return out


def _run_ends(new: np.ndarray) -> np.ndarray:
    """For each place the end of its run; ``new`` marks where runs begin."""
    runs = np.flatnonzero(new)
    ends = np.append(runs[1:], len(new))
    return np.repeat(ends, ends - runs)


def _pairs(partners: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each place with those from ``partners`` to ``ends``, some pairs at a time."""
    rest = ends - partners
    done = np.cumsum(rest)
    at = 0
    while at < len(rest):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, "right")))
        n = rest[at:to]
        yield np.repeat(np.arange(at, to), n), np.repeat(partners[at:to] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = to


def _opened(packed: pa.Array) -> np.ndarray:
    """One row of counts for each packed histogram."""
    return np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(-1, BINS)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Whole lists of one partition sorted by list: the columns with histograms opened, some lists at a time."""
    names = ("token", "lo", "hi", "b", "sid", "n", "comp")
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = [*(batch.column(c).to_numpy(zero_copy_only=False) for c in names), _opened(batch.column("hist"))]
        if held is not None:
            t = [np.concatenate(x) for x in zip(held, t)]
        same = (t[0] == t[0][-1]) & (t[1] == t[1][-1]) & (t[2] == t[2][-1])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield [c[:cut] for c in t]
        held = [c[cut:] for c in t]
    if held is not None:
        yield held


def _close(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of each list the pairs in different components that sizes and histograms allow; pairs within a component are not formed."""
    for token, lo, hi, b, sid, n, comp, hist in _lists(batches):
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        other = new.copy()
        other[1:] |= comp[1:] != comp[:-1]
        found: list[np.ndarray] = []
        for x, y in _pairs(_run_ends(other), _run_ends(new)):
            maybe = (lo[x] == hi[x]) | (b[x] != b[y])
            x, y = x[maybe], y[maybe]
            ok = bound_passes(hist, n, x, y, percent)
            found.append(np.unique(np.stack([np.minimum(sid[x], sid[y])[ok], np.maximum(sid[x], sid[y])[ok]], 1), axis=0))
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _shapes(lists: DataFrame) -> DataFrame:
    """``token, core, cores, others`` of the lists ``token, sid, n, comp`` with several components: blocks of the core and of the other members.

    A component with more than a block of a list's members is its core. It meets the other members only, so a list
    of a million copies and a few strangers costs a million rows, not their square.
    """
    parts = lists.groupBy("token", "comp").agg(F.count("*").alias("c"))
    shape = parts.groupBy("token").agg(F.count("*").alias("kinds"), F.sum("c").alias("members"), F.max(F.struct("c", "comp")).alias("most")).filter("kinds > 1")
    core = F.when(F.col("most.c") > BLOCK, F.col("most.c")).otherwise(0)
    return shape.select(
        "token", F.when(core > 0, F.col("most.comp")).alias("core"), F.ceil(core / BLOCK).alias("cores"), F.ceil((F.col("members") - core) / BLOCK).alias("others"),
    )


def _blocks(lists: DataFrame, shapes: DataFrame, member: DataFrame) -> DataFrame:
    """Rows of the lists, dealt to the pairs of blocks they are compared in and sorted for ``_lists``."""
    at = F.xxhash64("sid")
    inner = F.col("comp").eqNullSafe(F.col("core"))
    own = lists.join(shapes, "token").withColumn("b", F.when(inner, F.col("others") + F.pmod(at, F.greatest("cores", F.lit(1)))).otherwise(F.pmod(at, "others")))
    last = F.when(inner, F.col("others")).otherwise(F.col("others") + F.col("cores")) - 1
    met = own.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    keyed_lists = met.select("token", F.least("b", "k").alias("lo"), F.greatest("b", "k").alias("hi"), "b", "sid", "n", "comp").join(member.select("sid", "hist"), "sid")
    return keyed_lists.select("token", "lo", "hi", "b", "sid", "n", "comp", "hist").repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "comp")


def _whole(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, "packed", BATCH_BYTES // 4):
        sets = list(shingles(unpacked(batch.column("packed")), size))
        fine = [histogram(t, FINE) if len(t) > LARGE else b"" for t in sets]
        yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array([len(t) for t in sets], pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary()), pa.array(fine, pa.binary())], names=["sid", "n", "tokens", "fine"])


def _allowed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hist = np.concatenate([_opened(batch.column(c)) for c in ("hist_a", "hist_b")])
        sizes = np.concatenate([batch.column(c).to_numpy() for c in ("n_a", "n_b")])
        at = np.arange(batch.num_rows)
        yield batch.select(["a", "b"]).filter(pa.array(bound_passes(hist, sizes, at, at + batch.num_rows, percent)))


def allowed(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that sizes and histograms allow."""
    both = pairs
    for end in "ab":
        both = both.join(members.select(F.col("sid").alias(end), F.col("n").alias(f"n_{end}"), F.col("hist").alias(f"hist_{end}")), end)
    return both.select("a", "b", "n_a", "n_b", "hist_a", "hist_b").mapInArrow(partial(_allowed, percent=percent), "a long, b long")


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, "tokens_a"):
        keep = []
        for x, y in zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _finely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y, n in zip(batch.column("fine_a").to_pylist(), batch.column("fine_b").to_pylist(), batch.column("n").to_pylist()):
            apart = int(np.abs(np.frombuffer(x, np.uint8).astype(np.int16) - np.frombuffer(y, np.uint8)).sum()) if x and y else 0
            keep.append((100 + percent) * apart <= (100 - percent) * n)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that link: by the fine histograms of large sets, then by the whole sets ``sid, n, tokens, fine``."""
    ends = pairs
    for end in "ab":
        ends = ends.join(sets.select(F.col("sid").alias(end), F.col("n").alias(f"n_{end}"), F.col("fine").alias(f"fine_{end}")), end)
    pairs = stage(ends.select("a", "b", "fine_a", "fine_b", (F.col("n_a") + F.col("n_b")).alias("n")).mapInArrow(partial(_finely, percent=percent), "a long, b long"))
    left = pairs.join(sets.select(F.col("sid").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    full = left.join(sets.select(F.col("sid").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    return full.select("a", "b", "tokens_a", "tokens_b").mapInArrow(partial(_linked, percent=percent), "a long, b long")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, _h, n_shingles, component_id, label`` of every row.

    A document's set holds its distinct runs of ``size`` words; words are runs of anything but ASCII white space, with A-Z in lower
    case. A text of fewer words has the run of all of them, one without words (or null) no run, and links with nothing. Two documents link if
    their sets' intersection is at least ``percent`` hundredths of their union; ``component_id`` is the smallest id that links lead to, and
    ``label`` a number of the component, null without words.
    Rows with equal sets are one member of the join, however many they are. Of null ids in a component the others decide.
    """
    spark = docs.sparkSession
    texts = keyed(docs)
    counts = np.zeros(SKETCH, np.int64)
    # At most SKETCH rows, whatever the corpus.
    for batch in texts.select("text").mapInArrow(partial(_count, size=size), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():
        counts[batch.column("bucket").to_numpy()] = batch.column("n").to_numpy()
    level = spark.sparkContext.broadcast(counts)
    rows = stage(texts.mapInArrow(partial(_sets, size=size, percent=percent, level=level), "doc_id long, _h long, n long, s1 long, s2 long, g long, hist binary, prefix array<long>"))
    same = ["s1", "s2", "n"]
    members_of = stage(rows.select("doc_id", "_h", *same))
    sets = stage(
        rows.filter("n > 0").groupBy(*same).agg(F.min(F.struct("doc_id", "_h")).alias("rep"), F.min("doc_id").alias("least"), F.first("g").alias("g"), F.first("hist").alias("hist"))
        .withColumn("sid", F.monotonically_increasing_id())
    )

    # Lists of groups under each prefix token; a list with one group alone pairs nothing but that group's members.
    postings = rows.select(F.explode("prefix").alias("token"), "g", "n").repartition("token")
    shared = postings.groupBy("token").agg((F.min("g") != F.max("g")).alias("g2"), (F.min("n") != F.max("n")).alias("n2")).filter("g2 OR n2").select("token")
    listed = stage(postings.join(shared, "token").dropDuplicates(["token", "g", "n"]))
    unstage(rows)
    # Within a group its own key is the list.
    inside = sets.groupBy("g", "n").agg(F.count("*").alias("members")).filter("members > 1").select(F.xxhash64("g", "n").alias("token"), "g", "n")
    groups = listed.select("token", "g", "n").unionByName(inside)
    member = sets.select("sid", "n", "hist")
    lists = stage(groups.join(sets.select("g", "n", "sid"), ["g", "n"]).select("token", "sid", "n"))
    moved = packed(texts)

    def tokens_of(needed: DataFrame) -> DataFrame:
        """Whole sets of the ``sid`` needed, out of their texts."""
        fetched = sets.join(needed, "sid").select("sid", "rep.doc_id", "rep._h")
        return stage(moved.join(fetched, on_key(moved, fetched)).select("sid", "packed").mapInArrow(partial(_whole, size=size), "sid long, n long, tokens binary, fine binary").dropDuplicates(["sid"]))

    ends_of = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()

    # Stars: every member of a list with its most central one, the one with the most company over all its lists.
    company = lists.groupBy("token").agg(F.count("*").alias("c"))
    central = lists.join(company, "token").groupBy("sid").agg(F.sum("c").alias("weight"))
    placed = lists.join(central, "sid")
    pivots = placed.groupBy("token").agg(F.max(F.struct("weight", "sid", "n")).alias("p")).select("token", F.col("p.sid").alias("pivot"), F.col("p.n").alias("pivot_n"))
    fits = (F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent) & (F.col("sid") != F.col("pivot"))
    stars = placed.join(pivots, "token").filter(fits).select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")).distinct()
    near = stage(allowed(stars, member, percent))
    starred = stage(ends_of(near))
    whole = tokens_of(starred)
    first = stage(verified(near, whole, percent))
    # Pairs are formed only now, and only between what the stars left apart.
    joined = components(first)
    apart = stage(lists.join(joined.select(F.col("node").alias("sid"), "label"), "sid", "left").select("token", "sid", "n", F.coalesce("label", "sid").alias("comp")))
    shapes = stage(_shapes(apart))
    rest = stage(_blocks(apart, shapes, member).mapInArrow(partial(_close, percent=percent), "a long, b long").distinct())
    later = tokens_of(ends_of(rest).join(starred, "sid", "left_anti"))
    links = first.unionByName(verified(rest, whole.unionByName(later), percent))
    final = components(links)

    labelled = sets.join(final.select(F.col("node").alias("sid"), "label"), "sid", "left").select(*same, "least", F.coalesce("label", "sid").alias("label"))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = stage(labelled.join(named, "label").select(*same, "label", "component_id"))
    result = members_of.join(of_set, same, "left")
    unstage(sets, listed, lists, whole, near, starred, first, apart, shapes, rest, later)
    return result.select("doc_id", "_h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all columns, and of each component only the row with the smallest id (null before any; then by text).

    Rows without words are all kept, but for equal rows, of which one stays.
    """
    found = jaccard_components(docs, size, percent)
    least = F.coalesce("doc_id", F.lit(-(1 << 63)))
    parts = found.select(least.alias("__id"), F.col("_h").alias("__h"), "label")
    first = parts.filter("label IS NOT NULL").groupBy("label").agg(F.min(F.struct("__id", "__h")).alias("f")).select("f.*")
    keep = stage(first.unionByName(parts.filter("label IS NULL").select("__id", "__h")).distinct())
    marked = docs.withColumns({"__id": F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))), "__h": text_key(docs["text"])})
    return marked.join(keep, ["__id", "__h"], "left_semi").dropDuplicates(["__id", "__h"]).select(*(marked[f"`{c}`"] for c in docs.columns))
