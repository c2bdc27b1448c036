"""Which keys occur with more than one owner: a grouped lookup for millions of hashed keys.

Operators hash pieces of documents to 64-bit keys and ask which keys other
owners (documents) have too. Keys travel in blocks, one row for each batch of
documents and bucket of the key space, so the shuffle moves packed arrays, not a
row for each key. A batch settles what it can by itself before the shuffle: of
a key that it sees with many owners it sends two at most and answers the others
at once. So a key that a third of all documents have makes two entries a batch.

A bucket is one group; the number of buckets follows the size of the input
(``buckets``), so that a bucket keeps its size as tables grow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text for each bucket.
BUCKET_BYTES = 12 << 20
#: Entries that a task gathers before it settles and sends them.
GATHER = 1 << 21
#: Windows of a long document that are handled at a time.
PIECE = 1 << 18
#: Stands for a null id as an owner.
NO_ID = (1 << 63) - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
#: A random number for each byte, and the bytes that separate words.
BYTE = np.array([int.from_bytes(hashlib.blake2b(bytes([k]), digest_size=8).digest(), "little") for k in range(256)], np.uint64)
BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Bytes of text that are hashed at a time.
STRETCH = 1 << 21
#: Longer words are hashed by a digest: sums of powers modulo 2^64 can be equal for long words of close structure.
WORD_BYTES = 64
#: A key is answered if another owner has it, or a smaller owner.
SHARED, SMALLER = "shared", "smaller"


def buckets(docs: DataFrame, text: Column) -> int:
    """Number of buckets for the keys of ``docs``: from the bytes of its texts, the session's shuffle partitions at least."""
    n = docs.agg(F.sum(F.octet_length(text))).head()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_BYTES))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Hash of any stretch of a sequence of random numbers: sums of powers, taken back to the origin."""

    def __init__(self):
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self.power):
            n = max(len(values), 4096)
            back = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE))])
            self.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, back))])
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.power[:len(values)], out=out[1:])
        return out

    def hash(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of the stretches [lo, hi); the length is part of the hash."""
        return mix64((sums[hi] - sums[lo]) * self.inverse[lo] + mix64((hi - lo).astype(np.uint64)))


def word_hashes(data: bytes, prefix: Prefix) -> np.ndarray:
    """Hashes of the words of a text (UTF-8 bytes between blanks)."""
    out = []
    lo = 0
    while lo < len(data):
        hi = min(lo + STRETCH, len(data))
        while hi < len(data) and not BLANK[data[hi]]:  # words stay whole
            hi += 1
        raw = np.frombuffer(data, np.uint8, hi - lo, lo)
        edge = np.ones(len(raw) + 2, bool)
        edge[1:-1] = BLANK[raw]
        at = np.flatnonzero(edge[1:] != edge[:-1])
        starts, ends = at[::2], at[1::2]
        own = prefix.hash(prefix.sums(BYTE[raw]), starts, ends)
        for k in np.flatnonzero(ends - starts > WORD_BYTES):
            own[k] = int.from_bytes(hashlib.blake2b(raw[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
        out.append(own)
        lo = hi
    return np.concatenate(out) if len(out) > 1 else out[0] if out else np.zeros(0, np.uint64)


def pieces(n: int, window: int) -> list[tuple[int, int]]:
    """Stretches of a long sequence that have each of its windows in one of them."""
    return [(lo, min(n, lo + PIECE + window - 1)) for lo in range(0, n - window + 1, PIECE)]


def member(keys: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Mask of the keys that are among ``wanted`` (signed numbers, or None)."""
    if wanted is None or len(wanted) == 0:
        return np.zeros(len(keys), bool)
    w = np.sort(wanted.view(np.uint64))
    return w[np.minimum(np.searchsorted(w, keys), len(w) - 1)] == keys


def lists(column) -> list[np.ndarray | None]:
    """The arrays of an Arrow column of lists."""
    return [x.values.to_numpy(zero_copy_only=False) if x.is_valid else None for x in column]


def distinct_pairs(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by key, then owner, without repetitions."""
    order = np.lexsort((owners, keys))
    k, o = keys[order], owners[order]
    if len(k):
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
        k, o = k[new], o[new]
    return k, o


def _runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: index of each entry's run, and the starts of the runs."""
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    return np.cumsum(first) - 1, np.flatnonzero(first)


def settle(keys: np.ndarray, owners: np.ndarray, mode: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, owners, answered) of the distinct pairs; an answered pair meets the mode within these."""
    k, o = distinct_pairs(keys, owners)
    if not len(k):
        return k, o, np.zeros(0, bool)
    run, start = _runs(k)
    if mode == SMALLER:
        answered = np.ones(len(k), bool)
        answered[start] = False
    else:
        answered = (np.diff(np.append(start, len(k))) > 1)[run]
    return k, o, answered


def pack(parts: dict[str, tuple[np.ndarray, tuple[np.ndarray, ...]]]) -> pa.RecordBatch:
    """A row for each bucket; a part's arrays, cut by bucket, are its columns part_0, part_1 and so on.

    Within a bucket they are in the order of the last one (the owners): its
    repetitions then compress well in the shuffle.
    """
    out: dict[int, dict[str, list[bytes]]] = {}
    for part, (bucket, arrays) in parts.items():
        order = np.lexsort((arrays[-1], bucket))
        b, arrays = bucket[order], [x[order] for x in arrays]
        cut = np.flatnonzero(np.diff(b)) + 1
        for lo, hi in zip(np.append(0, cut), np.append(cut, len(b))):
            if hi > lo:
                out.setdefault(int(b[lo]), {})[part] = [x[lo:hi].tobytes() for x in arrays]
    names = [(part, j) for part, (_, arrays) in parts.items() for j in range(len(arrays))]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(out), pa.int32())]
        + [pa.array([v[part][j] if part in v else b"" for v in out.values()], pa.binary()) for part, j in names],
        names=["bucket", *[f"{part}_{j}" for part, j in names]])


def packed(**parts: int) -> str:
    """The schema of ``pack``: parts with their numbers of arrays."""
    return ", ".join(["bucket int", *[f"{part}_{j} binary" for part, n in parts.items() for j in range(n)]])


def send(keys: np.ndarray, owners: np.ndarray, mode: str, n: int) -> pa.RecordBatch:
    """Blocks of one batch: what other batches must see, and what is answered already."""
    k, o, answered = settle(keys, owners, mode)
    run, start = _runs(k)
    ask = np.arange(len(k)) - start[run] < (1 if mode == SMALLER else 2)
    return pack({"ask": (bucket_of(k[ask], n), (k[ask], o[ask])),
                 "done": (bucket_of(o[answered], n), (k[answered], o[answered]))})


def bucket_of(x: np.ndarray, n: int) -> np.ndarray:
    return (mix64(x.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def unpack(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def by_owner(keys: np.ndarray, owners: np.ndarray) -> pa.Table:
    """(owner, keys) with one row for each owner."""
    order = np.argsort(owners, kind="stable")
    k, o = keys[order].view(np.int64), owners[order]
    starts = np.flatnonzero(np.append(True, o[1:] != o[:-1])) if len(o) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(o)), pa.int32()), pa.array(k, pa.int64()))
    return pa.table({"owner": pa.array(o[starts], pa.int64()), "keys": lists})


def answers(sent: DataFrame, mode: str) -> DataFrame:
    """(owner, keys): for each owner the keys that meet the mode, from blocks of ``send``."""

    def resolve(block: pa.Table) -> pa.Table:
        k, o, answered = settle(unpack(block["ask_0"], np.uint64), unpack(block["ask_1"], np.int64), mode)
        k = np.concatenate([k[answered], unpack(block["done_0"], np.uint64)])
        o = np.concatenate([o[answered], unpack(block["done_1"], np.int64)])
        return by_owner(*distinct_pairs(k, o))

    found = sent.groupBy("bucket").applyInArrow(resolve, "owner long, keys array<long>")
    return found.groupBy("owner").agg(F.flatten(F.collect_list("keys")).alias("keys"))


def shared(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterable[tuple[int, np.ndarray]]], mode: str, n: int) -> DataFrame:
    """(owner, keys) for ``rows``; ``keys_of`` gives (owner, keys) of the rows of a batch."""

    def blocks(batches):
        ks, os, size = [], [], 0
        for b in batches:
            for owner, k in keys_of(b):
                ks.append(k)
                os.append(np.full(len(k), owner, np.int64))
                size += len(k)
                if size >= GATHER:
                    yield send(np.concatenate(ks), np.concatenate(os), mode, n)
                    ks, os, size = [], [], 0
        if size:
            yield send(np.concatenate(ks), np.concatenate(os), mode, n)

    return answers(rows.mapInArrow(blocks, packed(ask=2, done=2)), mode)
