"""Substring dedup by seed and extend, over words.

A text is cut into words at white space, unchanged. In every run of SPREAD
neighbouring grams (GRAM words) the gram with the smallest hash is an anchor
(winnowing), so each window of WINDOW words has one, and equal windows have it
at the same place. Documents are joined on anchors (seed). A seed that meets
another document is extended both ways, first to its reach: all the windows
that have it as their anchor. If a smaller document has the whole reach, it is
a repeat at once. What is left, where a repeat begins or ends, is extended
window by window. Repeats longer than a window are the union of their windows,
so they come out maximal: spans that cannot be made longer on either side.

Extension goes by hashes of the extended words, grouped over all documents, not
pair by pair, so a passage that a third of all documents share costs each of
them its own length (see shared_keys).

A word goes if a window over it starts in a document with a smaller id too. A
null text has no words; a null id counts as larger than any other and does not
tell rows apart; rows with the same id remove nothing from each other. Texts of
fewer words than a window stay whole. An empty table gives an empty result.
Only the id and the text are read. Keys have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm import shared_keys as sk
from ticklake.llm.common import stored

#: Words of a window: the shortest repeat.
WINDOW = 13
GRAM = 4
#: Grams of a window.
SPREAD = WINDOW - GRAM + 1


class Anchors:
    """Anchors of one document with their reach, and the hashes of both."""

    def __init__(self, values: np.ndarray, prefix: sk.Prefix):
        n = len(values) - WINDOW + 1
        self.prefix, self.sums = prefix, prefix.sums(values)
        at = np.arange(len(values) - GRAM + 1)
        grams = prefix.hash(self.sums, at, at + GRAM)
        anchor = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, SPREAD).argmin(axis=1)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        #: Windows first[k] to last[k] have anchor k.
        self.first, self.last = first, np.append(first[1:], n) - 1
        self.seed = grams[anchor[first]]
        self.reach = prefix.hash(self.sums, self.first, self.last + WINDOW)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of the anchors ``which``."""
        if not len(which):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        size = self.last[which] - self.first[which] + 1
        starts = np.repeat(self.first[which] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        return starts, self.prefix.hash(self.sums, starts, starts + WINDOW)


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def anchors(data: bytes, prefix: sk.Prefix):
    """(first word, Anchors) of the pieces of a text."""
    values = sk.word_hashes(data, prefix)
    for lo, hi in sk.pieces(len(values), WINDOW):
        yield lo, Anchors(values[lo:hi], prefix)


def _heads(x: np.ndarray) -> np.ndarray:
    """Mask of the entries that differ from the one before."""
    return np.append(True, x[1:] != x[:-1])[:len(x)]


def _by_reach(seed, reach, owner):
    """Sorted by seed, reach, owner; masks of the first entry of each seed and of each reach, and of owners after a reach's least."""
    order = np.lexsort((owner, reach, seed))
    seed, reach, owner = seed[order], reach[order], owner[order]
    new_seed = _heads(seed)
    new = new_seed | _heads(reach)
    late = owner != owner[new][np.cumsum(new) - 1] if len(owner) else new
    return seed, reach, owner, new_seed, new, late


def _seeds(rows: DataFrame, n: int) -> DataFrame:
    """(owner, resolved, open): reaches that a smaller document has, and others whose seed another document has."""

    def flush(got):
        seed, reach, owner, _, new, late = _by_reach(*(np.concatenate(x) for x in zip(*got)))
        # Of a reach only the least owner goes on; the others have their answer.
        return sk.pack({"ask": (sk.bucket_of(seed[new], n), (seed[new], reach[new], owner[new])),
                        "done": (sk.bucket_of(owner[late], n), (reach[late], owner[late]))})

    def blocks(batches):
        prefix = sk.Prefix()
        got, size = [], 0
        for b in batches:
            for owner, text in zip(b.column("owner").to_pylist(), b.column("text").to_pylist()):
                for _, a in anchors(encoded(text), prefix):
                    got.append((a.seed, a.reach, np.full(len(a.seed), owner, np.int64)))
                    size += len(a.seed)
                if size >= sk.GATHER // 2:
                    yield flush(got)
                    got, size = [], 0
        if got:
            yield flush(got)

    def resolve(block: pa.Table) -> pa.Table:
        seed, reach, owner, new_seed, _, late = _by_reach(
            sk.unpack(block["ask_0"], np.uint64), sk.unpack(block["ask_1"], np.uint64), sk.unpack(block["ask_2"], np.int64))
        if len(seed):
            run, start = np.cumsum(new_seed) - 1, np.flatnonzero(new_seed)
            met = (np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start))[run]
        else:
            met = late
        done = sk.by_owner(np.concatenate([reach[late], sk.unpack(block["done_0"], np.uint64)]),
                           np.concatenate([owner[late], sk.unpack(block["done_1"], np.int64)]))
        left = sk.by_owner(reach[met & ~late], owner[met & ~late])
        return pa.concat_tables([x.append_column("open", pa.array([v] * len(x), pa.bool_())) for x, v in ((done, False), (left, True))])

    sent = rows.mapInArrow(blocks, sk.packed(ask=3, done=2))
    found = sent.groupBy("bucket").applyInArrow(resolve, "owner long, keys array<long>, open boolean")
    return found.groupBy("owner").agg(
        F.flatten(F.collect_list(F.when(~F.col("open"), F.col("keys")))).alias("resolved"),
        F.flatten(F.collect_list(F.when(F.col("open"), F.col("keys")))).alias("open"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(owner, resolved, open) and (owner, keys): reaches and windows that repeat, as hashes."""
    owner = F.coalesce(F.col(id_col).cast("long"), F.lit(sk.NO_ID)).alias("owner")
    rows = docs.select(owner, F.col(text_col).alias("text"))
    n = sk.buckets(docs, F.col(text_col))
    seeds = stored(_seeds(rows, n), "substring-seeds")

    def keys_of(batch):
        prefix = sk.Prefix()
        for who, text, wanted in zip(batch.column("owner").to_pylist(), batch.column("text").to_pylist(), sk.lists(batch.column("open"))):
            for _, a in anchors(encoded(text), prefix):
                yield who, a.windows(np.flatnonzero(sk.member(a.reach, wanted)))[1]

    at_ends = rows.hint("merge").join(seeds.filter(F.size("open") > 0).select("owner", "open"), "owner")
    windows = stored(sk.shared(at_ends, keys_of, sk.SMALLER, n), "substring-windows")
    return seeds, windows


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text (kept words joined by a space), n_words, n_removed, spans (removed words, end exclusive)."""
    seeds, windows = repeats(docs, id_col, text_col)
    owner = F.coalesce(F.col(id_col).cast("long"), F.lit(sk.NO_ID)).alias("owner")
    known = seeds.select("owner", "resolved").join(windows, "owner", "full")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), owner, F.col(text_col).alias("text"))
    rows = rows.hint("merge").join(known, "owner", "left").select("doc_id", "text", "resolved", "keys")

    def run(batches):
        prefix = sk.Prefix()
        for b in batches:
            ids, texts, removed, spans, counts = b.column("doc_id"), [], [], [], []
            for text, resolved, keys in zip(b.column("text").to_pylist(), sk.lists(b.column("resolved")), sk.lists(b.column("keys"))):
                data = encoded(text)
                w = data.split()  # at the blanks of bytes: space and 0x09 to 0x0D
                counts.append(len(w))
                edge = np.zeros(len(w) + 1, np.int64)
                for lo, a in anchors(data if resolved is not None or keys is not None else b"", prefix):
                    whole = sk.member(a.reach, resolved)
                    np.add.at(edge, lo + a.first[whole], 1)
                    np.add.at(edge, lo + a.last[whole] + WINDOW, -1)
                    starts, own = a.windows(np.flatnonzero(~whole) if keys is not None else np.zeros(0, np.int64))
                    starts = lo + starts[sk.member(own, keys)]
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                bounds = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(bounds[::2], bounds[1::2])])
                removed.append(int(gone.sum()))
                texts.append(b" ".join(w if not removed[-1] else [x for x, g in zip(w, gone) if not g]).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "text", "n_words", "n_removed", "spans"])

    out = rows.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long, spans array<struct<start:long,end:long>>")
    return out.withColumnRenamed("doc_id", id_col).withColumnRenamed("text", text_col)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i, hash(ws[i:i + 12]) AS h1, md5(array_to_string(ws[i:i + 12], ' ')) AS h2
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
f AS (SELECT h1, h2, min(doc_id) AS least FROM s GROUP BY h1, h2 HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM s JOIN f USING (h1, h2), range(0, 13) r(k) WHERE doc_id > least),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
k AS (SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
             list_filter(ws, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
