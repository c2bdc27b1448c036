"""Suffix-array dedup: common-prefix interval trees over sampled suffixes of bytes.

In every run of SPREAD positions the one with the smallest hash of its GRAM
bytes is an anchor, so each window of WINDOW bytes has an anchor with SEED bytes
after it inside the window, and equal windows have it at the same place. The
suffixes at the anchors are sorted, bucket by bucket: suffixes meet in a bucket
by the hash of their first SEED bytes (the depth from which on an interval can
hold a repeat). In a bucket the enhanced suffix array (sorted suffixes with the
lengths of their common prefixes) is scanned with a stack, which yields the
intervals of the common-prefix tree. For each interval the left contexts of its
members are compared: sorted from the anchor back, each member's neighbours
give how far it extends to the left with another member. Where that differs
among the members (left-extension diversity) or ends, prefix and left extension
make a maximal repeat, output with all occurrences. Suffixes and left contexts
reach as far as an anchor's own windows do; longer repeats are the union of the
repeats at their anchors.

Two shortcuts keep the work in proportion. If the whole reach of an anchor (all
of its windows) occurs twice, it is a repeat at once, and one occurrence stands
for all in the tree. A bucket with more than CROWD different reaches, such as a
passage that a third of all documents share, is never gathered: its windows are
compared by hash over all tasks instead, which gives the same repeats.

A byte goes if a window over it starts anywhere else, in the same document
too. Null texts are empty. Rows with the same id, repeated rows and rows
without an id are documents of their own. Texts shorter than a window stay
whole. An empty table gives an empty result. Only the id and the text are read.
Grouping keys have 64 bits; bytes are compared in the tree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import shared_keys as sk
from ticklake.llm.common import stored

#: Bytes of a window: the shortest repeat.
WINDOW = 400
SPREAD = 200
SEED = WINDOW - SPREAD + 1
GRAM = 8
#: Different reaches that one bucket's tree holds at most.
CROWD = 2048

_MOST = np.uint64((1 << 64) - 1)


def grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on (of windows that have them inside)."""
    n = len(data) - GRAM + 1
    out = np.empty(n, np.uint64)
    raw = data.tobytes()
    for r in range(min(GRAM, n)):
        out[r::GRAM] = np.frombuffer(raw, "<u8", (n - r + GRAM - 1) // GRAM, r)
    return sk.mix64(out)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each full run of ``width`` values the place of its smallest, the first of equal ones.

    Blocks of ``width``: a run is the end of a block and the start of the next.
    """
    n = len(values)
    blocks = -(-n // width)
    v = np.full(blocks * width, _MOST)
    v[:n] = values
    v = v.reshape(blocks, width)
    at = np.arange(blocks * width).reshape(blocks, width)
    least = np.minimum.accumulate(v, axis=1)
    fresh = np.ones(v.shape, bool)
    fresh[:, 1:] = v[:, 1:] < least[:, :-1]
    start = np.maximum.accumulate(np.where(fresh, at, -1), axis=1).ravel()
    least = least.ravel()
    back = v[:, ::-1]
    end_least = np.minimum.accumulate(back, axis=1)
    fresh[:, 1:] = back[:, 1:] <= end_least[:, :-1]
    place = at[:, ::-1]
    # From the right, a later find is further left: carry the smallest place so far.
    end = np.minimum.accumulate(np.where(fresh, place, blocks * width), axis=1)[:, ::-1].ravel()
    end_least = end_least[:, ::-1].ravel()
    i = np.arange(n - width + 1)
    j = i + width - 1
    return np.where(end_least[i] <= least[j], end[i], start[j])


class Anchors:
    """Anchors of a stretch of bytes, with the windows they stand for."""

    def __init__(self, data: np.ndarray, prefix: sk.Prefix):
        n = len(data) - WINDOW + 1
        self.data, self.prefix = data, prefix
        self.sums = prefix.sums(sk.BYTE[data])
        at = leftmost_least(grams(data)[:n + SPREAD - 1], SPREAD)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        #: Windows first[k] to last[k] have anchor at[k].
        self.at, self.first, self.last = at[first], first, np.append(first[1:], n) - 1
        self.reach = prefix.hash(self.sums, self.first, self.last + WINDOW)

    def seeds(self) -> np.ndarray:
        return self.prefix.hash(self.sums, self.at, self.at + SEED)


def anchors(data: bytes, prefix: sk.Prefix):
    """(first byte, Anchors) of the pieces of a text."""
    whole = np.frombuffer(data, np.uint8)
    for lo, hi in sk.pieces(len(whole), WINDOW):
        yield lo, Anchors(whole[lo:hi], prefix)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Mask of the entries at which some column differs from the entry before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _sorted(seed, reach, owner):
    order = np.lexsort((owner, reach, seed))
    return seed[order], reach[order], owner[order]


def _seeds(rows: DataFrame, n: int) -> DataFrame:
    """(owner, whole, open, stand): reaches that occur twice, reaches whose seed occurs twice, and
    reaches that occur twice and stand for their copies among the latter."""

    def flush(got):
        seed, reach, owner = _sorted(*(np.concatenate(x) for x in zip(*got)))
        new = _heads(seed, reach)
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(seed)))
        # Of a reach one entry goes on, marked if there are more; all owners of more have their answer.
        twice = (size > 1)[np.cumsum(new) - 1]
        done = twice & _heads(seed, reach, owner)
        return sk.pack({"ask": (sk.bucket_of(seed[new], n), (seed[new], reach[new], size > 1, owner[new])),
                        "done": (sk.bucket_of(owner[done], n), (reach[done], owner[done]))})

    def blocks(batches):
        prefix = sk.Prefix()
        got, size = [], 0
        for b in batches:
            for owner, data in zip(b.column("owner").to_pylist(), b.column("data").to_pylist()):
                for _, a in anchors(data, prefix):
                    got.append((a.seeds(), a.reach, np.full(len(a.at), owner, np.int64)))
                    size += len(a.at)
                    if size >= sk.GATHER // 2:
                        yield flush(got)
                        got, size = [], 0
        if got:
            yield flush(got)

    def resolve(block: pa.Table) -> pa.Table:
        seed, reach = (sk.unpack(block[f"ask_{j}"], np.uint64) for j in (0, 1))
        more, owner = sk.unpack(block["ask_2"], bool), sk.unpack(block["ask_3"], np.int64)
        order = np.lexsort((owner, reach, seed))
        seed, reach, owner, more = seed[order], reach[order], owner[order], more[order]
        new_seed, new = _heads(seed), _heads(seed, reach)
        of_reach, of_seed = np.cumsum(new) - 1, np.cumsum(new_seed) - 1
        size = np.bincount(of_reach, minlength=1) + np.bincount(of_reach, more, minlength=1)
        whole = (size > 1)[of_reach] if len(seed) else new
        others = (np.bincount(of_seed, new, minlength=1) > 1)[of_seed] if len(seed) else new
        is_open = ~whole & others
        some_open = (np.bincount(of_seed, is_open, minlength=1) > 0)[of_seed] if len(seed) else new
        tables = [(np.concatenate([reach[whole], sk.unpack(block["done_0"], np.uint64)]),
                   np.concatenate([owner[whole], sk.unpack(block["done_1"], np.int64)])),
                  (reach[is_open], owner[is_open]), (reach[whole & new & some_open], owner[whole & new & some_open])]
        return pa.concat_tables([t.append_column("kind", pa.array([k] * len(t), pa.int32()))
                                 for k, t in enumerate(sk.by_owner(*sk.distinct_pairs(*x)) for x in tables)])

    sent = rows.mapInArrow(blocks, sk.packed(ask=4, done=2))
    found = sent.groupBy("bucket").applyInArrow(resolve, "owner long, keys array<long>, kind int")
    return found.groupBy("owner").agg(*[F.flatten(F.collect_list(F.when(F.col("kind") == k, F.col("keys")))).alias(c)
                                        for k, c in enumerate(("whole", "open", "stand"))])


def _contexts(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, owner, reach, left, bytes, open) of the open reaches and those that stand for copies: ``left`` bytes before the anchor."""

    def run(batches):
        prefix = sk.Prefix()
        for b in batches:
            out = []
            for owner, data, wanted, stand in zip(b.column("owner").to_pylist(), b.column("data").to_pylist(),
                                                  sk.lists(b.column("open")), sk.lists(b.column("stand"))):
                seen = set()
                for _, a in anchors(data, prefix):
                    is_open = sk.member(a.reach, wanted)
                    which = np.flatnonzero(is_open | sk.member(a.reach, stand))
                    seed = a.seeds()
                    for k in which:
                        if (r := int(a.reach[k])) not in seen:
                            seen.add(r)
                            out.append((int(seed[k].view(np.int64)), owner, int(a.reach[k].view(np.int64)), int(a.at[k] - a.first[k]),
                                        a.data[a.first[k]:a.last[k] + WINDOW].tobytes(), bool(is_open[k])))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["seed", "owner", "reach", "left", "data", "open"])

    at_ends = rows.hint("merge").join(seeds.filter("size(open) > 0 or size(stand) > 0").select("owner", "open", "stand"), "owner")
    return at_ends.mapInArrow(run, "seed long, owner long, reach long, left int, data binary, open boolean")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """(depth, first, last) of the intervals of the common-prefix tree, children before parents, by a stack scan."""
    out, stack = [], []
    for k, d in enumerate([*lcp, -1]):
        first = k
        while stack and stack[-1][0] > d:
            depth, first = stack.pop()
            out.append((depth, first, k))
        if d >= 0 and (not stack or stack[-1][0] < d):
            stack.append((d, first))
    return out


def tree_repeats(lefts: list[bytes], rights: list[bytes]) -> list[tuple[int, int, int, int]]:
    """(node, member, left, right): maximal repeats of WINDOW bytes at least among suffixes.

    ``lefts`` run back from the anchor, ``rights`` on from it. A member's repeat
    at a node has its longest left extension with any other member. Repeats that
    a member has at a deeper node already, as long to the left, are left out.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(len(lefts)), key=lefts.__getitem__)
    rank = [0] * len(lefts)
    for k, m in enumerate(by_left):
        rank[m] = k
    reached = [-1] * len(lefts)
    out = []
    for node, (depth, first, last) in enumerate(intervals(lcp)):
        members = sorted((order[k] for k in range(first, last + 1)), key=rank.__getitem__)
        steps = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for k, m in enumerate(members):
            longest = max(steps[k - 1] if k else 0, steps[k] if k < len(steps) else 0)
            if longest > reached[m]:
                reached[m] = longest
                if longest + depth >= WINDOW:
                    out.append((node, m, longest, depth))
    return out


def _tree(contexts: DataFrame, n: int) -> DataFrame:
    """(owner, reach, lo, hi, repeat) from the trees of the buckets that are not crowded."""

    def scan(block: pa.Table) -> pa.Table:
        seed = block["seed"].to_numpy()
        order = np.argsort(seed, kind="stable")
        starts = np.flatnonzero(_heads(seed[order]))
        owner, reach, left, data, is_open = (block[c].to_pylist() for c in ("owner", "reach", "left", "data", "open"))
        out = []
        for lo, hi in zip(starts, np.append(starts[1:], len(order))):
            rows = order[lo:hi]
            cut = [left[r] for r in rows]
            found = tree_repeats([data[r][:c][::-1] for r, c in zip(rows, cut)], [data[r][c:] for r, c in zip(rows, cut)])
            for _, m, before, after in found:
                r, c = rows[m], cut[m]
                if is_open[r]:
                    text = data[r][c - before:c + after]
                    out.append((owner[r], reach[r], c - before, c + after,
                                int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)))
        cols = list(zip(*out)) if out else [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))],
                        names=["owner", "reach", "lo", "hi", "repeat"])

    rows = contexts.withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(n)).cast("int"))
    return rows.groupBy("bucket").applyInArrow(scan, "owner long, reach long, lo int, hi int, repeat long")


def _crowded(contexts: DataFrame, n: int) -> DataFrame:
    """The same from the windows of crowded buckets, compared by hash."""
    rows = contexts.withColumn("context", F.xxhash64("owner", "reach", "data"))

    def windows(prefix, data):
        raw = np.frombuffer(data, np.uint8)
        at = np.arange(len(raw) - WINDOW + 1)
        return prefix.hash(prefix.sums(sk.BYTE[raw]), at, at + WINDOW)

    def keys_of(batch):
        prefix = sk.Prefix()
        for context, data in zip(batch.column("context").to_pylist(), batch.column("data").to_pylist()):
            yield context, windows(prefix, data)

    shared = sk.shared(rows.select("context", "data"), keys_of, sk.SHARED, n).withColumnRenamed("owner", "context")

    def spans(batches):
        prefix = sk.Prefix()
        for b in batches:
            out = []
            for owner, reach, data, keys in zip(*(b.column(c).to_pylist() for c in ("owner", "reach", "data")), sk.lists(b.column("keys"))):
                own = windows(prefix, data)
                hit = np.flatnonzero(sk.member(own, keys))
                out += [(owner, reach, int(k), int(k) + WINDOW, int(own[k].view(np.int64))) for k in hit]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))],
                                             names=["owner", "reach", "lo", "hi", "repeat"])

    hits = rows.filter("open").join(shared, "context").select("owner", "reach", "data", "keys")
    return hits.mapInArrow(spans, "owner long, reach long, lo int, hi int, repeat long")


def repeats(rows: DataFrame, n: int, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """What repeats in ``rows`` (owner, data): whole reaches, and parts [lo, hi) of reaches at a repeat's ends.

    Both are groups of occurrences: rows with one reach, or one ``repeat``.
    """
    seeds = stored(_seeds(rows, n), "suffix-seeds")
    contexts = stored(_contexts(rows, seeds), "suffix-contexts")
    crowded = contexts.groupBy("seed").count().filter(F.col("count") > crowd).select("seed")
    crowded = stored(crowded, "suffix-crowded")
    parts = _tree(contexts.join(crowded, "seed", "left_anti"), n)
    if not crowded.isEmpty():
        parts = parts.unionByName(_crowded(contexts.join(crowded, "seed", "left_semi"), n))
    return seeds.select("owner", "whole"), stored(parts, "suffix-parts")


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """id, kept (remaining bytes), n_bytes, n_removed, spans (removed runs of bytes, end exclusive)."""
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data")
    # What is found goes back to rows by id and text: rows without an id, or with one id, do not meet each other's.
    owner = F.xxhash64(F.col(id_col).cast("long"), data).alias("owner")
    rows = docs.select(owner, data)
    n = sk.buckets(docs, F.col(text_col))
    whole, parts = repeats(rows, n, crowd)
    parts = parts.groupBy("owner").agg(F.collect_list("reach").alias("reach"), F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    known = whole.join(parts, "owner", "full")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), owner, data).hint("merge").join(known, "owner", "left")

    def run(batches):
        prefix = sk.Prefix()
        for b in batches:
            sizes, kept, removed, spans = [], [], [], []
            for data, whole, reach, los, his in zip(b.column("data").to_pylist(), *(sk.lists(b.column(c)) for c in ("whole", "reach", "lo", "hi"))):
                edge = np.zeros(len(data) + 1, np.int64)
                some = (whole is not None and len(whole)) or (reach is not None and len(reach))
                for lo, a in anchors(data if some else b"", prefix):
                    hit = sk.member(a.reach, whole)
                    np.add.at(edge, lo + a.first[hit], 1)
                    np.add.at(edge, lo + a.last[hit] + WINDOW, -1)
                    if reach is not None and len(reach):
                        # Parts name their reach; each place of the reach takes all of its parts.
                        order = np.argsort(a.reach, kind="stable")
                        own, r = a.reach[order], reach.view(np.uint64)
                        left, right = np.searchsorted(own, r, "left"), np.searchsorted(own, r, "right")
                        for k in np.flatnonzero(right > left):
                            for place in a.first[order[left[k]:right[k]]]:
                                edge[lo + place + los[k]] += 1
                                edge[lo + place + his[k]] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                bounds = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(bounds[::2], bounds[1::2])])
                sizes.append(len(data))
                removed.append(int(gone.sum()))
                kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes() if removed[-1] else data)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "spans"])

    rows = rows.select("doc_id", "data", "whole", "reach", "lo", "hi")
    out = rows.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>")
    return out.withColumnRenamed("doc_id", id_col)


def op5_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return suffix_array_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
