"""N-gram Jaccard join: exact similarity join in the metric space of word-shingle sets.

The distance d = 1 - J of two sets is a metric. Documents whose shingles are
mostly their own are at distance over 1 - THRESHOLD from all others, and pivots
cannot tell them apart (they are all about 1 away), so they are set aside first
by an exact bound. A fixed part of the hash space selects shingles; a shingle
selected in one set is selected in every set that has it. If more of x's selected
shingles occur nowhere else than a similar pair may have in difference, x has
no partner. The few sets with too few selected shingles for the bound select
with a larger part, among themselves too. The rest is read again with all
shingles: the bound then holds for whole sets, among the rest. Of what is left,
a similar pair must share one of the rarest shingles of each (as many as may
differ, and one more; rarest by exact counts over what is left, one order for
all), and its sizes are in one band or in two adjacent ones, which limits how
many may differ. Sets linked through those are a family; similar sets are in one
family. A line that many documents have makes no family of them by itself.

A family is a region. A region of more than LEAF sets takes pivots; each set
goes to the Voronoi cell of its nearest pivot, and also to every cell whose
pivot is at most 2r further (r = 1 - THRESHOLD): by the triangle inequality a
partner of a member of that cell cannot be further. Cells are joined
recursively; a cell that does not shrink is joined in blocks. Sets within r of
one pivot are linked through it and need no comparison with each other. A small region
compares all its sets exactly, by sizes of intersections.

A family of more than CROWD shingles is not gathered into one task. Its sets
meet the family's pivots in chunks, and cells are cut along the distance to
their pivot into chunks too: a set visits only those chunks of a cell whose
distances are within r of its own (the same window), unless it is linked to the
pivot already.

Equal sets are one node, found by a 128-bit digest; links and components are
computed between different sets, and copies follow their set. Shingles are
compared as 64-bit hashes. Two documents link when 100 * intersection >= 80 *
union. Null and empty texts, and texts without words, have no shingle and no
link; texts of fewer than NGRAM words are one shingle. Repeated rows and rows
with the same id are nodes by their sets; a null id counts as the largest.
An empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import shared_keys as sk
from ticklake.llm.common import drop_space, stored
from ticklake.llm.components import components

NGRAM = 5
#: Percent.
THRESHOLD = 80
RADIUS = 1 - THRESHOLD / 100
#: Parts of the hash space that select shingles, the last all of it.
PARTS = (0.4, 0.7, 1.0)
#: Sets that are compared at once, and pivots of a region.
LEAF = 192
PIVOTS = 8
#: Names that are found shared at a time.
MOST_NAMES = 4096
#: Shingles of whole sets that a task gathers before it sends them: most are answered there, which takes more memory.
GATHER = sk.GATHER // 2
#: Shingles of a family (or a chunk of one) that one task holds.
CROWD = 3_000_000


def shingles(text: str | None, prefix: sk.Prefix) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    w = sk.word_hashes(text.encode("utf-8", "surrogatepass").lower(), prefix) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    size = min(NGRAM, len(w))
    at = np.arange(len(w) - size + 1)
    return np.unique(prefix.hash(prefix.sums(w), at, at + size))


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def named(d: bytes, clash: frozenset[int]) -> int:
    """The 64-bit name of a set: half of its digest, the other half where different sets share the first."""
    name = int.from_bytes(d[:8], "little", signed=True)
    return int.from_bytes(d[8:], "little", signed=True) if name in clash else name


def _name(s: np.ndarray, clash: frozenset[int]) -> int:
    return named(digest(s), clash)


def slack(n: int) -> int:
    """Shingles of a set of n that a similar set may lack."""
    return n * (100 - THRESHOLD) // 100


def selections(s: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(part, selected shingles): the first part, and larger ones until more than the slack are selected."""
    out = []
    for k, part in enumerate(PARTS):
        own = s[:np.searchsorted(s, np.uint64(min(part * 2.0**64, 2.0**64 - 2048)), "right")] if part < 1 else s
        out.append((k, own))
        if len(own) > slack(len(s)):
            break
    return out


def part_key(part: int, s: np.ndarray) -> np.ndarray:
    """Keys of the selected shingles; parts do not meet."""
    return sk.mix64(s ^ sk.mix64(np.array([part + 1], np.uint64))[0])


def _profiles(rows: DataFrame, n: int, clash: frozenset[int]) -> tuple[DataFrame, DataFrame]:
    """(owner, digest, id, n, chosen) of each row with shingles, and (owner, keys) of the selected shingles that other sets have."""

    def flush(meta, keys, owners):
        ids, ns, chosen, os = (np.array([m[k] for m in meta], np.int64) for k in (0, 1, 2, 4))
        names = np.frombuffer(b"".join(m[3] for m in meta), "V16")
        block = sk.send(np.concatenate(keys), np.concatenate(owners), sk.SHARED, n)
        own = sk.pack({"row": (sk.bucket_of(os, n), (ids, ns, chosen, names, os))})
        return block, own

    def blocks(batches):
        prefix = sk.Prefix()
        meta, keys, owners, size = [], [], [], 0

        def out():
            block, own = flush(meta, keys, owners)
            for b, have in ((block, ("ask", "done")), (own, ("row",))):
                cols = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
                empty = pa.array([b""] * b.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([cols.get(c, empty) for c in NAMES], names=NAMES)

        for b in batches:
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                s = shingles(text, prefix)
                if not len(s):
                    continue
                d = digest(s)
                owner = named(d, clash)
                parts = selections(s)
                # Sets with one part only can be set aside by what they do not share of it.
                meta.append((i, len(s), len(parts[0][1]) if len(parts) == 1 else 0, d, owner))
                for part, own in parts:
                    keys.append(part_key(part, own))
                    owners.append(np.full(len(own), owner, np.int64))
                    size += len(own)
                if size >= sk.GATHER:
                    yield from out()
                    meta, keys, owners, size = [], [], [], 0
        if meta:
            yield from out()

    def resolve(block: pa.Table) -> pa.Table:
        k, o, answered = sk.settle(sk.unpack(block["ask_0"], np.uint64), sk.unpack(block["ask_1"], np.int64), sk.SHARED)
        k = np.concatenate([k[answered], sk.unpack(block["done_0"], np.uint64)])
        o = np.concatenate([o[answered], sk.unpack(block["done_1"], np.int64)])
        t = sk.by_owner(*sk.distinct_pairs(k, o))
        none = lambda kind: pa.nulls(len(t), kind)
        for c, kind in (("id", pa.int64()), ("n", pa.int64()), ("chosen", pa.int64()), ("digest", pa.binary())):
            t = t.append_column(c, none(kind))
        who = sk.unpack(block["row_4"], np.int64)
        rows = pa.table({"owner": who, "keys": pa.nulls(len(who), pa.list_(pa.int64())), "id": sk.unpack(block["row_0"], np.int64),
                         "n": sk.unpack(block["row_1"], np.int64), "chosen": sk.unpack(block["row_2"], np.int64), "digest": pa.array([x.tobytes() for x in sk.unpack(block["row_3"], "V16")], pa.binary())})
        return pa.concat_tables([t, rows])

    schema = sk.packed(ask=2, done=2, row=5)
    NAMES = [c.split(" ")[0] for c in schema.split(", ")]
    found = rows.mapInArrow(blocks, schema).groupBy("bucket").applyInArrow(
        resolve, "owner long, keys array<long>, id long, n long, chosen long, digest binary")
    found = stored(found, "jaccard-profiles")
    # A pair that its batch has answered may be answered by its bucket too.
    keys = found.filter("keys is not null").groupBy("owner").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))
    return found.filter("keys is null").select("owner", "digest", "id", "n", "chosen"), keys


def _whole(members: DataFrame, n: int, clash: frozenset[int]) -> DataFrame:
    """(owner, keys): all shingles of the sets of ``members`` that other sets there have.

    What a bucket of keys finds goes on in one block for each bucket of owners, not
    in a row for each owner.
    """

    def blocks(batches):
        prefix = sk.Prefix()
        keys, owners, size = [], [], 0
        for b in batches:
            for owner, text in zip(b.column("owner").to_pylist(), b.column("text").to_pylist()):
                s = shingles(text, prefix)
                if _name(s, clash) != owner:  # rows may share an id
                    continue
                keys.append(s)
                owners.append(np.full(len(s), owner, np.int64))
                size += len(s)
                if size >= GATHER:
                    yield sk.send(np.concatenate(keys), np.concatenate(owners), sk.SHARED, n)
                    keys, owners, size = [], [], 0
        if size:
            yield sk.send(np.concatenate(keys), np.concatenate(owners), sk.SHARED, n)

    def resolve(block: pa.Table) -> pa.Table:
        k, o, answered = sk.settle(sk.unpack(block["ask_0"], np.uint64), sk.unpack(block["ask_1"], np.int64), sk.SHARED)
        k = np.concatenate([k[answered], sk.unpack(block["done_0"], np.uint64)])
        o = np.concatenate([o[answered], sk.unpack(block["done_1"], np.int64)])
        return pa.Table.from_batches([sk.pack({"own": (sk.bucket_of(o, n), (k, o))})])

    def gather(block: pa.Table) -> pa.Table:
        # A pair that its batch has answered may be answered by its bucket too.
        return sk.by_owner(*sk.distinct_pairs(sk.unpack(block["own_0"], np.uint64), sk.unpack(block["own_1"], np.int64)))

    sent = members.select("owner", "text").mapInArrow(blocks, sk.packed(ask=2, done=2))
    found = sent.groupBy("bucket").applyInArrow(resolve, sk.packed(own=2))
    return found.groupBy("bucket").applyInArrow(gather, "owner long, keys array<long>")


def _survivors(sets: DataFrame) -> DataFrame:
    """(owner, id, n, keys): sets that may have a partner, with the shingles that can prove it.

    ``sets`` has the shingles that are in other sets too. Sets that keep too many
    to themselves go. Those that stay keep their rarest ones: if x may lack s of
    its shingles in a similar set, then one of any s + 1 is shared, and with one
    order for all sets one is among the s + 1 first of both. Shingles that no
    other set has come first in that order, so they take places but need not be
    kept.
    """
    slack = f"n * {100 - THRESHOLD} div 100"
    sets = stored(sets.filter(f"n - size(keys) <= {slack}"), "jaccard-sets")
    rows = sets.select("owner", F.explode("keys").alias("key"))
    # Counts are combined before the shuffle; a key of many sets stays spread in the join.
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    ranked = rows.join(many, "key").groupBy("owner").agg(F.array_sort(F.collect_list(F.struct("sets", "key"))).alias("keys"))
    alive = sets.drop("keys").join(ranked, "owner").filter(f"n - size(keys) <= {slack}")
    first = F.expr(f"int({slack} + 1 - (n - size(keys)))")
    keys = F.transform(F.slice("keys", F.lit(1), first), lambda k: k["key"])
    return stored(alive.withColumn("keys", keys), "jaccard-alive")


def bands(most: int) -> np.ndarray:
    """Least sizes of the bands up to ``most``; similar sets are in one band or in two adjacent ones."""
    lo = [1]
    while lo[-1] <= most:
        lo.append(lo[-1] * 100 // THRESHOLD + 1)
    return np.array(lo, np.int64)


def sized_keys(n: np.ndarray, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the set, key) for each pair of size bands that a set of n shingles may meet a partner in.

    ``keys`` are the ``lengths`` kept rarest ones of each set, in their order. A
    partner of m shingles at least shares THRESHOLD / (100 + THRESHOLD) of n + m;
    fewer than the slack may differ if it is not much smaller, so fewer keys count.
    """
    lo = bands(int(n.max(initial=0)) * 100 // THRESHOLD)
    own = n * (100 - THRESHOLD) // 100 + 1 - lengths  # shingles that no other set has: they come first
    band = np.searchsorted(lo, n, "right") - 1
    row = np.repeat(np.arange(len(n)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows, out = [], []
    for d in (-1, 0, 1):
        other = np.clip(band + d, 0, len(lo) - 2)
        least = np.maximum(lo[other], -(-n * THRESHOLD // 100))
        meets = (other == band + d) & (least < lo[other + 1]) & (least <= n * 100 // THRESHOLD)
        lacks = n + (-THRESHOLD * (n + least) // (100 + THRESHOLD))
        count = np.where(meets, np.maximum(0, lacks + 1 - own), 0)
        take = place < count[row]
        kind = sk.mix64((2 * np.minimum(band, other) + abs(d) + 1).astype(np.uint64))
        rows.append(row[take])
        out.append(sk.mix64(keys[take] ^ kind[row[take]]))
    return np.concatenate(rows), np.concatenate(out)


def _leaders(sets: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) from each set to the least set of its size bands with the same key, one row a pair."""

    def blocks(batches):
        for b in batches:
            owners, keys = b.column("owner").to_pylist(), sk.lists(b.column("keys"))
            if owners:
                lengths = np.array([len(x) for x in keys], np.int64)
                at, k = sized_keys(b.column("n").to_numpy(), np.concatenate(keys).view(np.uint64), lengths)
                o = np.array(owners, np.int64)[at]
                order = np.lexsort((o, k))
                k, o = k[order], o[order]
                first = np.append(True, k[1:] != k[:-1])[:len(k)]
                # Here each owner is linked to the least one of the batch; that one goes on.
                least = o[first][np.cumsum(first) - 1]
                own = least != o
                a, c = sk.distinct_pairs(o[own].view(np.uint64), least[own])
                yield sk.pack({"ask": (sk.bucket_of(k[first], n), (k[first], o[first])),
                               "done": (sk.bucket_of(a, n), (a, c))})

    def resolve(block: pa.Table) -> pa.Table:
        k, o = sk.distinct_pairs(sk.unpack(block["ask_0"], np.uint64), sk.unpack(block["ask_1"], np.int64))
        first = np.append(True, k[1:] != k[:-1])[:len(k)]
        least = o[first][np.cumsum(first) - 1] if len(k) else o
        a = np.concatenate([o[least != o], sk.unpack(block["done_0"], np.int64)])
        b = np.concatenate([least[least != o], sk.unpack(block["done_1"], np.int64)])
        a, b = sk.distinct_pairs(a.view(np.uint64), b)
        return pa.table({"a": a.view(np.int64), "b": b})

    sent = sets.mapInArrow(blocks, sk.packed(ask=2, done=2))
    return sent.groupBy("bucket").applyInArrow(resolve, "a long, b long").distinct()


class Links:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def similar(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * common >= THRESHOLD * (n + m - common)


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b."""
    words = np.unique(np.concatenate(a))
    out = np.zeros((len(a), len(b)), np.int64)
    step = max(64, (1 << 23) // max(1, len(a) + len(b)))  # shingles whose columns are multiplied at a time
    for lo in range(0, len(words), step):
        part = words[lo:lo + step]

        def rows(sets):
            m = np.zeros((len(sets), len(part)), np.float32)
            for k, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, s)
                m[k, at[part[np.minimum(at, len(part) - 1)] == s]] = 1
            return m
        out += np.rint(rows(a) @ rows(b).T).astype(np.int64)
    return out


def _compare(sets, sizes, one, two, links: Links) -> None:
    """Links between the sets ``one`` and ``two`` (positions), in blocks."""
    for lo in range(0, len(one), LEAF):
        for at in range(0, len(two), LEAF):
            a, b = one[lo:lo + LEAF], two[at:at + LEAF]
            if len({links.root(int(k)) for k in (*a, *b)}) == 1:
                continue
            hit = similar(intersections([sets[k] for k in a], [sets[k] for k in b]), sizes[a][:, None], sizes[b][None, :])
            for x, y in zip(*np.nonzero(hit)):
                links.join(int(a[x]), int(b[y]))


def region_join(sets: list[np.ndarray], links: Links, home: np.ndarray | None = None, guests: np.ndarray | None = None) -> None:
    """Link the similar pairs within ``home`` and between ``home`` and ``guests`` (positions in ``sets``).

    Links that follow from others may be left out; components are exact.
    """
    sizes = np.array([len(s) for s in sets])
    todo = [(np.arange(len(sets)) if home is None else home, np.zeros(0, np.int64) if guests is None else guests)]
    while todo:
        home, guests = todo.pop()
        if not len(home):
            continue
        if len(home) <= LEAF:
            _compare(sets, sizes, home, np.concatenate([home, guests]), links)
            continue
        everyone = np.concatenate([home, guests])
        # Pivots spread over the sizes of the region.
        by_size = home[np.argsort(sizes[home], kind="stable")]
        pivots = by_size[np.linspace(0, len(by_size) - 1, PIVOTS).astype(int)]
        common = np.concatenate([intersections([sets[k] for k in everyone[lo:lo + LEAF]], [sets[k] for k in pivots])
                                 for lo in range(0, len(everyone), LEAF)])
        n, m = sizes[everyone][:, None], sizes[pivots][None, :]
        near = similar(common, n, m)
        dist = 1 - common / (n + m - common)
        for x, y in zip(*np.nonzero(near)):
            links.join(int(everyone[x]), int(pivots[y]))
        cell = dist.argmin(axis=1)
        own = dist[np.arange(len(everyone)), cell]
        for j in range(PIVOTS):
            inside = (cell == j)[:len(home)]
            members = home[inside]
            # Members within r of the pivot are linked to it; the rest are compared with all.
            far = members[~near[:len(home)][inside, j]]
            window = (dist[:, j] <= own + 2 * RADIUS + 1e-9) & (dist[:, j] <= dist[:len(home)][inside, j].max(initial=0) + RADIUS + 1e-9)
            outside = np.append(~inside, np.ones(len(guests), bool))
            visit = everyone[window & outside & ~near[:, j]]
            # A guest within r of the pivot is linked to the members that are; it visits the others.
            linked = everyone[window & outside & near[:, j]]
            close = members[near[:len(home)][inside, j]]
            if len(members) > 0.9 * len(home):
                _compare(sets, sizes, far, np.concatenate([members, visit, linked]), links)
                _compare(sets, sizes, close, visit, links)
            else:
                if len(far):
                    todo.append((far, np.concatenate([close, visit, linked])))
                if len(visit):
                    _compare(sets, sizes, close, visit, links)


def _family_links(members: DataFrame, n: int, clash: frozenset[int]) -> DataFrame:
    """Edges (a, b) of the families (cluster, owner, text, home): exact links within each cluster's home sets and with its guests."""

    def join(block: pa.Table) -> pa.Table:
        prefix = sk.Prefix()
        cluster = block["cluster"].to_numpy()
        order = np.argsort(cluster, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(cluster[order]) != 0))
        owner, text, home = block["owner"].to_pylist(), block["text"], block["home"].to_pylist()
        a, b = [], []
        for lo, hi in zip(starts, np.append(starts[1:], len(order))):
            seen = {}
            for r in order[lo:hi]:
                s = shingles(text[int(r)].as_py(), prefix)
                if _name(s, clash) == owner[r]:  # rows may share an id
                    seen.setdefault(owner[r], (s, home[r]))
            who, sets, at_home = list(seen), [s for s, _ in seen.values()], np.array([h for _, h in seen.values()], bool)
            if len(who) < 2:
                continue
            links = Links(len(who))
            region_join(sets, links, np.flatnonzero(at_home), np.flatnonzero(~at_home))
            for k in range(len(who)):
                if (r := links.root(k)) != k:
                    a.append(who[k])
                    b.append(who[r])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = members.withColumn("bucket", F.pmod(F.xxhash64("cluster"), F.lit(n)).cast("int"))
    return rows.select("bucket", "cluster", "owner", "text", "home").groupBy("bucket").applyInArrow(join, "a long, b long")


def _crowded_links(members: DataFrame, sizes: DataFrame, n: int, crowd: int, clash: frozenset[int]) -> DataFrame:
    """Edges of the families that are too large for a task: pivots, cells, chunks and windows as Spark joins.

    ``members``: cluster, owner, n, text; ``sizes``: cluster, shingles.
    """
    parts = F.ceil(F.col("shingles") / crowd).cast("int")
    sizes = sizes.select("cluster", parts.alias("parts"))
    rows = members.join(sizes, "cluster").withColumn("chunk", F.pmod(F.xxhash64("owner", F.lit(5)), F.col("parts")).cast("int"))
    # PIVOTS sets of each family: the least by hash of each residue, a grouped minimum.
    ranked = rows.select("cluster", "owner", F.xxhash64("owner", F.lit(7)).alias("h"))
    pivots = ranked.groupBy("cluster", F.pmod("h", F.lit(PIVOTS)).alias("slot")).agg(F.min_by("owner", "h").alias("owner"))
    pivots = rows.join(pivots.select("cluster", "owner"), ["cluster", "owner"], "left_semi")
    at_all = pivots.select("cluster", "owner", "text", F.lit(True).alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk"))
    meet = rows.select("cluster", "owner", "text", F.lit(False).alias("pivot"), "chunk").unionByName(at_all)

    def distances(block: pa.Table) -> pa.Table:
        prefix = sk.Prefix()
        owner, pivot = block["owner"].to_numpy(), block["pivot"].to_numpy()
        sets = [shingles(t.as_py(), prefix) for t in block["text"]]
        mine, theirs = np.flatnonzero(~pivot), np.flatnonzero(pivot)
        out = []
        for lo in range(0, len(mine), LEAF):
            some = mine[lo:lo + LEAF]
            common = intersections([sets[k] for k in some], [sets[k] for k in theirs])
            n, m = np.array([len(sets[k]) for k in some])[:, None], np.array([len(sets[k]) for k in theirs])[None, :]
            out.append(pa.table({"cluster": np.full(common.size, block["cluster"][0].as_py(), np.int64),
                                 "owner": np.repeat(owner[some], len(theirs)), "pivot": np.tile(owner[theirs], len(some)),
                                 "dist": (1 - common / (n + m - common)).ravel(), "near": similar(common, n, m).ravel()}))
        empty = pa.table({"cluster": pa.array([], pa.int64()), "owner": pa.array([], pa.int64()), "pivot": pa.array([], pa.int64()),
                          "dist": pa.array([], pa.float64()), "near": pa.array([], pa.bool_())})
        return pa.concat_tables([empty, *out])

    dist = stored(meet.groupBy("cluster", "chunk").applyInArrow(
        distances, "cluster long, owner long, pivot long, dist double, near boolean"), "jaccard-distances")
    ball = dist.filter("near and owner <> pivot").select(F.col("owner").alias("a"), F.col("pivot").alias("b"))
    nearest = dist.groupBy("cluster", "owner").agg(F.min(F.struct("dist", "pivot", "near")).alias("p")).select(
        "cluster", "owner", "p.pivot", "p.dist", "p.near")
    # A cell is cut by distance to its pivot into steps, and a step by hash into chunks that a task can hold.
    step = F.floor(F.col("dist") * 20).cast("int")
    homes = members.select("cluster", "owner", "n").join(nearest, ["cluster", "owner"]).withColumn("step", step)
    room = homes.groupBy("cluster", "pivot", "step").agg(F.ceil(F.sum("n") / crowd).cast("int").alias("rooms"))
    homes = homes.join(room, ["cluster", "pivot", "step"]).withColumn("room", F.pmod(F.xxhash64("owner", F.lit(3)), F.col("rooms")).cast("int"))
    rooms = homes.select("cluster", "pivot", "step", "room").distinct()
    key = F.xxhash64("cluster", "pivot", "step", "room").alias("cell")
    at_home = homes.select(key, "owner", F.lit(True).alias("home"))
    # A set visits the chunks within r of its distance, unless it is linked to the pivot and so is the chunk.
    window = ((F.col("step") + 1) / 20 + RADIUS >= F.col("dist") - 1e-9) & (F.col("step") / 20 - RADIUS <= F.col("dist") + 1e-9)
    inside = F.col("near") & ((F.col("step") + 1) / 20 <= RADIUS)
    visits = dist.join(rooms, ["cluster", "pivot"]).filter(window & ~inside)
    guests = visits.select(key, "owner").join(at_home.select("cell", "owner"), ["cell", "owner"], "left_anti")
    # Guests are cut into chunks as well; the chunk at home meets each of them.
    guests = guests.join(members.select("owner", "n"), "owner")
    tables = guests.groupBy("cell").agg(F.ceil(F.sum("n") / crowd).cast("int").alias("tables"))
    guests = guests.join(tables, "cell").select("cell", F.pmod(F.xxhash64("owner", F.lit(13)), F.col("tables")).cast("int").alias("table"),
                                                "owner", F.lit(False).alias("home"))
    hosts = at_home.join(tables, "cell", "left").select(
        "cell", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tables"), F.lit(1)) - 1)).alias("table"), "owner", "home")
    where = hosts.unionByName(guests).select(F.xxhash64("cell", "table").alias("cluster"), "owner", "home")
    return ball.unionByName(_family_links(where.join(members.select("owner", "text"), "owner"), n, clash))


def _same_set(members: DataFrame, clash: frozenset[int]) -> DataFrame:
    """One row for each owner, of those whose text has its set (rows may share an id)."""

    def own(batches):
        prefix = sk.Prefix()
        for b in batches:
            fits = [_name(shingles(t, prefix), clash) == o for o, t in zip(b.column("owner").to_pylist(), b.column("text").to_pylist())]
            yield b.filter(pa.array(fits, pa.bool_()))

    return members.mapInArrow(own, members.schema).dropDuplicates(["owner"])


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD,
          clash: frozenset[int] = frozenset()) -> tuple[DataFrame, DataFrame]:
    """(owner, id, n) of the rows with shingles, and edges (a, b) between owners (sets) that span the components.

    Where different sets share a name of 64 bits, their digests tell: sets of
    such names (``clash``, some n^2 / 2^65 of n sets) are named anew.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(sk.NO_ID)).alias("id"), F.col(text_col).alias("text"))
    n = sk.buckets(docs, F.col(text_col))
    while True:
        profiles, keys = _profiles(rows, n, clash)
        nodes = stored(profiles.groupBy("owner").agg(
            F.min("id").alias("id"), F.min("n").alias("n"), F.min("chosen").alias("chosen"),
            F.min("digest").alias("least"), F.max("digest").alias("most")), "jaccard-nodes")
        shared = [r.owner for r in nodes.filter("least <> most").select("owner").limit(MOST_NAMES).collect()]
        if not shared:
            break
        clash = clash.union(shared)
    # By the selected shingles most sets go; only the texts of the others are read again, and whole.
    near = nodes.drop("least", "most").join(keys, "owner").filter(f"chosen - size(keys) <= n * {100 - THRESHOLD} div 100")
    near = near.select("owner", "id", "n")
    members = stored(rows.hint("merge").join(near, "id").select("owner", "id", "n", "text"), "jaccard-members", "zstd")
    alive = _survivors(members.select("owner", "id", "n").distinct().join(_whole(members, n, clash), "owner"))
    family = components(_leaders(alive.select("owner", "n", "keys"), n)).select(F.col("node").alias("owner"), F.col("root").alias("cluster"))
    family = stored(alive.select("owner", "id", "n").join(family, "owner"), "jaccard-families")
    sizes = family.groupBy("cluster").agg(F.sum("n").alias("shingles"))
    crowded = stored(sizes.filter(F.col("shingles") > crowd), "jaccard-crowded")
    texts = members.select("owner", "text").hint("merge")
    small = texts.join(family.join(crowded, "cluster", "left_anti"), "owner")
    edges = _family_links(small.withColumn("home", F.lit(True)), n, clash)
    if not crowded.isEmpty():
        large = texts.join(family.join(crowded, "cluster", "left_semi"), "owner").select("cluster", "owner", "n", "text")
        edges = edges.unionByName(_crowded_links(stored(_same_set(large, clash), "jaccard-crowd", "zstd"), crowded, n, crowd, clash))
    return profiles.select("owner", "id", "n"), stored(edges, "jaccard-edges")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD,
                 clash: frozenset[int] = frozenset()) -> DataFrame:
    """id, n_shingles, component_id (the smallest id that links reach) of every row."""
    rows, edges = links(docs, id_col, text_col, crowd, clash)
    roots = components(edges)
    rows = rows.join(roots, rows["owner"] == roots["node"], "left").select("id", "n", F.coalesce("root", "owner").alias("root"))
    least = rows.groupBy("root").agg(F.min("id").alias("component"))
    linked = rows.join(least, "root").select("id", F.col("n").alias("n_shingles"), "component")
    blank = docs.filter(drop_space(F.coalesce(F.col(text_col), F.lit(""))) == "").select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(sk.NO_ID)).alias("id"), F.lit(0).cast("long").alias("n_shingles"))
    out = linked.unionByName(blank.withColumn("component", F.col("id")))
    back = lambda c: F.when(F.col(c) != sk.NO_ID, F.col(c))
    return out.select(back("id").alias(id_col), "n_shingles", back("component").alias("component_id"))


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return jaccard_join(table(spark, sf_dir, "documents"))
