"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A document is encoded by a byte-level BPE (A, space + text) and by a
sentencepiece model (B, which adds the space itself). Both cut the same bytes,
so each side is a token-byte incidence matrix in compressed rows. Gustavson row
products A x B' give the overlap links: a token of A and one of B that share
bytes, with the number of shared bytes. Byte offsets where tokens of both sides
end cut the tokens into groups; the products of the group incidences give the
shared-group links.

Corpus-wide counts of linked id pairs are Spark aggregates. Documents are
handled in blocks of BLOCK_BYTES of text: a block lists each of its id pairs
once, so what is shuffled is one row for a pair and block, not one for a link.
The counts go back to the blocks that hold the pair.

Texts that are null or empty, or whose tokens do not give space + text back,
have no tokens. Repeated rows and null ids are rows of their own. Texts are
encoded whole; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import csr
from ticklake.llm.common import stored, table

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
PIECE_BPE = f"{TOKENIZERS}/piece_bpe_32k.model"

#: Bytes of text that share one list of id pairs; bounds a task's memory and the rows per block.
BLOCK_BYTES = 16 << 20
#: Bytes of text whose matrices are built at once.
SLICE_BYTES = 1 << 20
#: Characters of words whose tokens a worker remembers before it starts anew; each word counts 50 more.
KNOWN_CHARS = 30_000_000
#: Id pairs in one row of a block's list.
PAIRS_A_ROW = 8192

#: Longest word that is encoded in one line with others, and the words of a line.
WORD_CHARS, LINE_WORDS = 200, 200

#: Fixed value: how byte-level BPE of this family cuts texts before merging.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Neither tokenizer joins over a single space between two other characters.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space that is not such a space.
_ODD = re.compile(r"\s\s|^\s|\s\Z")


class Tokens(NamedTuple):
    """Ids of many texts, end to end, and where each text's ids end."""
    ids: np.ndarray
    ends: np.ndarray


def byte_level() -> dict[str, int]:
    """The letters of byte-level vocabularies: printable Latin-1 is itself, the other bytes follow from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """The two tokenizers and the bytes of their ids."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        letters = byte_level()
        with open(byte_bpe, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary = model["vocab"]
        of_id = {i: bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode()
                 for t, i in vocabulary.items()}
        self.bytes_a = [of_id.get(i, b"") for i in range(max(of_id) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.by_rank = self._ranked(model)
        # Words can be encoded one by one if no piece holds a space behind another letter.
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)
        # Decimal ids with the mark that follows: inside a group, or at its end.
        self.marks = ([f"{i}{m}" for i in range(len(self.bytes_a)) for m in ",|"]
                      + [f"{i}{m}" for i in range(len(self.bytes_b)) for m in ",;"])
        self.forget()

    def _ranked(self, model: dict):
        """The byte-level BPE as ranks, which are faster to apply; None unless merges come in the order of their ids."""
        import tiktoken
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merged]
        if ids != sorted(ids):
            return None
        letters = byte_level().keys()
        single = {i for t, i in model["vocab"].items() if t in letters}
        ranks = {self.bytes_a[i]: i for i in single.union(ids)}
        return tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    def forget(self) -> None:
        """Start with no known words: numbers of words, their ids end to end, and whether their bytes come back."""
        self.numbers: dict[str, int] = {}
        self.known_chars = 0
        self.flat_a, self.flat_b = array("i"), array("i")
        self.ends_a, self.ends_b, self.exact = array("q", [0]), array("q", [0]), array("b")

    def learn(self, words: list[str]) -> None:
        """Encode new words: short ones many to a line, the others by themselves."""
        plain = [w for w in words if len(w) <= WORD_CHARS and not (w[0].isspace() or w[-1].isspace())]
        if self.by_rank is not None and plain:
            lines = [" ".join(plain[i:i + LINE_WORDS]) for i in range(0, len(plain), LINE_WORDS)]
            a = list(chain.from_iterable([self.by_rank.encode_ordinary(" " + x) for x in lines]))
            b = list(chain.from_iterable(self.b.encode(lines, num_threads=1)))
            raw = b" " + " ".join(lines).encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw:
                a, b = np.array(a, np.int32), np.array(b, np.int32)
                ends = np.cumsum([len(w.encode()) + 1 for w in plain])
                # The first token that ends behind a word's last byte, less one, closes the word.
                self._note(plain, a, np.searchsorted(np.cumsum(self.length_a[a]), ends, "right"),
                           b, np.searchsorted(np.cumsum(self.length_b[b]), ends, "right"), [1] * len(plain))
                words = list(set(words).difference(plain))
        if words:
            a = [x.ids for x in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
            b = self.b.encode(words, num_threads=1)
            exact = [b"".join(map(self.bytes_a.__getitem__, x)) == b" " + w.encode()
                     == b"".join(map(self.bytes_b.__getitem__, y)) for w, x, y in zip(words, a, b)]
            self._note(words, np.fromiter(chain.from_iterable(a), np.int32), np.cumsum([len(x) for x in a]),
                       np.fromiter(chain.from_iterable(b), np.int32), np.cumsum([len(y) for y in b]), exact)

    def _note(self, words, a, ends_a, b, ends_b, exact) -> None:
        self.numbers.update(zip(words, range(len(self.numbers), len(self.numbers) + len(words))))
        self.ends_a.frombytes((ends_a + len(self.flat_a)).astype(np.int64).tobytes())
        self.ends_b.frombytes((ends_b + len(self.flat_b)).astype(np.int64).tobytes())
        self.flat_a.frombytes(a.tobytes())
        self.flat_b.frombytes(b.tobytes())
        self.exact.extend(exact)
        self.known_chars += sum(map(len, words)) + 50 * len(words)

    def encode(self, texts: list[str]) -> tuple[list[int], Tokens, Tokens]:
        """The texts that both sides give back, and their ids."""
        if self.known_chars > KNOWN_CHARS:
            self.forget()
        cut = [_words(t) if self.by_word else [t] for t in texts]
        words = list(chain.from_iterable(cut))
        self.learn(list(set(words).difference(self.numbers)))
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        ends = np.cumsum([len(c) for c in cut], dtype=np.int64)
        starts = ends - np.array([len(c) for c in cut], np.int64)
        wrong = np.concatenate(([0], np.cumsum(np.frombuffer(self.exact, np.int8)[number] == 0)))
        kept = [i for i, n in enumerate((wrong[ends] - wrong[starts]).tolist()) if not n]
        if len(kept) < len(cut):
            number = np.concatenate([number[starts[i]:ends[i]] for i in kept] or [number[:0]])
            ends = np.cumsum((ends - starts)[kept], dtype=np.int64)
        return kept, _laid(self.flat_a, self.ends_a, number, ends), _laid(self.flat_b, self.ends_b, number, ends)


def _words(text: str) -> list[str]:
    words = text.split(" ")
    return _CUT.split(text) if words != text.split() and _ODD.search(text) else words


def _laid(flat: array, flat_ends: array, number: np.ndarray, ends: np.ndarray) -> Tokens:
    """The ids of the numbered words end to end; ``ends`` counts words up to the end of each text."""
    at = np.frombuffer(flat_ends, np.int64)
    start, n = at[number], at[number + 1] - at[number]
    upto = np.cumsum(n)
    ids = np.frombuffer(flat, np.int32)[np.repeat(start - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)]
    return Tokens(ids.astype(np.int64), upto[ends - 1] if len(ends) else ends)


@lru_cache(maxsize=2)
def pair(byte_bpe: str, piece_bpe: str) -> Pair:
    """Loaded once in each Python worker."""
    return Pair(byte_bpe, piece_bpe)


class Aligned(NamedTuple):
    """Texts whose bytes both sides give back, laid end to end."""
    kept: list[int]          # places of these texts in the input
    a: Tokens
    b: Tokens
    group_a: np.ndarray      # group of each token
    group_b: np.ndarray
    group_ends: np.ndarray   # number of groups up to the end of each text
    row: np.ndarray          # overlap links: token of A, token of B, shared bytes
    col: np.ndarray
    shared: np.ndarray


def align(p: Pair, texts: list[str | None]) -> Aligned:
    """Groups and overlap links of ``texts``."""
    at = [i for i, t in enumerate(texts) if t]
    kept, a, b = p.encode([texts[i] for i in at])
    rows_a, rows_b = csr.runs(p.length_a[a.ids]), csr.runs(p.length_b[b.ids])
    links = list(csr.row_products(rows_a, csr.transposed(rows_b)))
    row, col, shared = ((np.concatenate(x) for x in zip(*links)) if links else (np.zeros(0, np.int64),) * 3)
    ends_a, ends_b = rows_a.start[1:], rows_b.start[1:]
    ended = np.zeros((2, rows_a.width + 1), bool)
    ended[0, ends_a] = ended[1, ends_b] = True
    groups = np.cumsum(ended[0] & ended[1])
    text_ends = ends_a[a.ends - 1] if len(a.ends) else a.ends
    return Aligned([at[i] for i in kept], a, b, groups[ends_a - 1], groups[ends_b - 1], groups[text_ends], row, col, shared)


def group_links(found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shared-group links (token of A, token of B, 1), in slices of bounded size."""
    width = int(found.group_ends[-1]) if len(found.group_ends) else 0
    return csr.row_products(csr.one_each(found.group_a, width),
                            csr.transposed(csr.one_each(found.group_b, width)))


def group_strings(p: Pair, found: Aligned) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each kept text."""
    n_a, n_b = len(found.a.ids), len(found.b.ids)
    codes = np.empty(n_a + n_b, np.int64)
    last_a = np.append(found.group_a[1:] != found.group_a[:-1], True)[:n_a]
    last_b = np.append(found.group_b[1:] != found.group_b[:-1], True)[:n_b]
    # In the line of all groups, each group's tokens of A come before those of B.
    in_a, in_b = np.bincount(found.group_a), np.bincount(found.group_b)
    codes[np.arange(n_a) + (np.cumsum(in_b) - in_b)[found.group_a]] = 2 * found.a.ids + last_a
    codes[np.arange(n_b) + np.cumsum(in_a)[found.group_b]] = 2 * len(p.bytes_a) + 2 * found.b.ids + last_b
    ends = (found.a.ends + found.b.ends).tolist()
    return ["".join(map(p.marks.__getitem__, codes[s:e].tolist()))[:-1] for s, e in zip([0, *ends], ends)]


_LINKED = ("id long, n_a long, n_b long, groups string, a_ids array<int>, b_ids array<int>, "
           "links array<struct<a:int,b:int,bytes:int>>, group_links long")


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """One row a document with its ids, groups and overlap links.

    ``links`` holds places in ``a_ids`` and ``b_ids`` with the bytes that both
    tokens cover; ``group_links`` counts the pairs of a token of A and one of B
    that share a group.
    """
    def run(batches):
        p = pair(byte_bpe, piece_bpe)
        for ids, texts in _slices(batches):
            rows = [dict.fromkeys(("id", "n_a", "n_b", "groups", "a_ids", "b_ids", "links", "group_links")) for _ in ids]
            for r, i in zip(rows, ids):
                r.update(id=i, n_a=0, n_b=0, groups="", a_ids=[], b_ids=[], links=[], group_links=0)
            found = align(p, texts)
            shared = csr.product_sizes(*_group_matrices(found))
            a_of = np.searchsorted(found.a.ends, np.arange(len(found.a.ids)), "right")
            n_group = np.bincount(a_of, shared, len(found.kept)).astype(np.int64) if found.kept else []
            link_ends = np.searchsorted(found.row, found.a.ends, "left")
            for k, (i, text) in enumerate(zip(found.kept, group_strings(p, found))):
                sa, ea = (int(found.a.ends[k - 1]) if k else 0), int(found.a.ends[k])
                sb, eb = (int(found.b.ends[k - 1]) if k else 0), int(found.b.ends[k])
                ls, le = (int(link_ends[k - 1]) if k else 0), int(link_ends[k])
                rows[i].update(n_a=ea - sa, n_b=eb - sb, groups=text, group_links=int(n_group[k]),
                               a_ids=found.a.ids[sa:ea].tolist(), b_ids=found.b.ids[sb:eb].tolist(),
                               links=[{"a": x, "b": y, "bytes": z} for x, y, z in zip(
                                   (found.row[ls:le] - sa).tolist(), (found.col[ls:le] - sb).tolist(),
                                   found.shared[ls:le].tolist())])
            yield pa.RecordBatch.from_pylist(rows, schema=_LINKED_ARROW)
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, _LINKED).withColumnRenamed("id", id_col))


_LINKED_ARROW = pa.schema([
    ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("groups", pa.string()),
    ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())),
    ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())]))),
    ("group_links", pa.int64())])


def _group_matrices(found: Aligned) -> tuple[csr.Csr, csr.Csr]:
    width = int(found.group_ends[-1]) if len(found.group_ends) else 0
    return csr.one_each(found.group_a, width), csr.transposed(csr.one_each(found.group_b, width))


def _slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[tuple[list, list]]:
    """Ids and texts, some ``most`` characters of text at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py()
            ids.append(i)
            texts.append(t)
            size += len(t or "") + 8
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_ENCODED = pa.schema([
    ("block", pa.int64()), ("seq", pa.int32()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("places", pa.binary()), ("counts", pa.binary()),
    ("first", pa.int32()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])
_ENCODED_SQL = ("block long, seq int, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                "places binary, counts binary, first int, pairs array<long>, links array<long>")


class _Block:
    """Documents that share one list of id pairs."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.rows: list[dict] = []
        self.of_docs: list[tuple[np.ndarray, np.ndarray] | None] = []

    def add(self, p: Pair, ids: list, texts: list) -> None:
        found = align(p, texts)
        base = len(self.rows)
        for i in ids:
            self.rows.append({"block": self.number, "seq": len(self.rows), "id": i, "n_a": 0, "n_b": 0, "n_groups": 0,
                              "n_links": 0, "groups_sha256": ""})
            self.of_docs.append(None)
        link_ends = np.searchsorted(found.row, found.a.ends, "left").tolist()
        keys = (found.a.ids[found.row] << 32) | found.b.ids[found.col]
        ends = zip(found.a.ends.tolist(), found.b.ends.tolist(), found.group_ends.tolist(), link_ends)
        before = (0, 0, 0, 0)
        for k, (now, text) in enumerate(zip(ends, group_strings(p, found))):
            n_a, n_b, n_groups, n_links = (y - x for x, y in zip(before, now))
            i = base + found.kept[k]
            self.rows[i].update(n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links,
                                groups_sha256=hashlib.sha256(text.encode()).hexdigest())
            self.of_docs[i] = np.unique(keys[before[3]:now[3]], return_counts=True)
            before = now
        self.size += sum(len(t or "") for t in texts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row for each document, its pairs as places in the block's list, and the list itself."""
        some = [x for x in self.of_docs if x is not None]
        pairs = np.unique(np.concatenate([k for k, _ in some])) if some else np.zeros(0, np.int64)
        total = np.zeros(len(pairs), np.int64)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for row, x in zip(self.rows, self.of_docs):
            if x is not None:
                at = np.searchsorted(pairs, x[0])
                total[at] += x[1]
                row["places"] = squeeze(np.diff(at, prepend=0).astype("<u4").tobytes())
                row["counts"] = squeeze(x[1].astype("<u4").tobytes())
        for s in range(0, len(self.rows), 4096):
            yield pa.RecordBatch.from_pylist(self.rows[s:s + 4096], schema=_ENCODED)
        lists = [{"block": self.number, "first": s, "pairs": pairs[s:s + PAIRS_A_ROW].tolist(),
                  "links": total[s:s + PAIRS_A_ROW].tolist()} for s in range(0, len(pairs), PAIRS_A_ROW)]
        for s in range(0, len(lists), 64):
            yield pa.RecordBatch.from_pylist(lists[s:s + 64], schema=_ENCODED)


def _encoded(docs: DataFrame, byte_bpe: str, piece_bpe: str, block_bytes: int) -> DataFrame:
    """Rows of documents (``seq`` set) and rows of the lists of pairs (``first`` set)."""
    def run(batches):
        p = pair(byte_bpe, piece_bpe)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for ids, texts in _slices(batches, min(SLICE_BYTES, block_bytes)):
            block.add(p, ids, texts)
            if block.size >= block_bytes:
                yield from block.batches()
                number += 1
                block = _Block(number)
        yield from block.batches()
    return docs.mapInArrow(run, _ENCODED_SQL)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, links): corpus-wide count, and whether it is the highest of the pair's id of B."""
    totals = pairs.groupBy("pair").agg(F.sum("links").alias("total"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = totals.groupBy(b.alias("b")).agg(F.max("total").alias("highest"))
    return (totals.withColumn("b", b).join(best, "b")
            .select("pair", "total", (F.col("total") == F.col("highest")).alias("best")))


_COUNTED = ("id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string")


def _count(looked_up: pa.Table, docs: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    total = np.zeros(looked_up.num_rows, np.int64)
    best = np.zeros(looked_up.num_rows, bool)
    at = looked_up["place"].to_numpy()
    total[at] = looked_up["total"].to_numpy()
    best[at] = looked_up["best"].to_numpy(zero_copy_only=False)
    open_up = zstandard.ZstdDecompressor().decompress
    n_best, count_sum = [], []
    for places, counts in zip(docs["places"].to_pylist(), docs["counts"].to_pylist()):
        if places is None:
            n_best.append(0)
            count_sum.append(0)
            continue
        p = np.cumsum(np.frombuffer(open_up(places), "<u4").astype(np.int64))
        n = np.frombuffer(open_up(counts), "<u4").astype(np.int64)
        n_best.append(int(n[best[p]].sum()))
        count_sum.append(int((n * total[p]).sum()))
    named = docs.select(["id", "n_a", "n_b", "n_groups", "n_links"])
    return (named.append_column("n_best", pa.array(n_best, pa.int64()))
            .append_column("count_sum", pa.array(count_sum, pa.int64()))
            .append_column("groups_sha256", docs["groups_sha256"]))


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: its tokens, groups and links, and corpus-wide counts over its links."""
    encoded = stored(_encoded(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")),
                              byte_bpe, piece_bpe, block_bytes), "alignment", "zstd")
    lists = encoded.filter(F.col("first").isNotNull()).select("block", "first", "pairs", "links")
    each = (lists.select("block", "first", F.posexplode(F.arrays_zip("pairs", "links")).alias("at", "x"))
            .select("block", (F.col("first") + F.col("at")).alias("place"), F.col("x.pairs").alias("pair"),
                    F.col("x.links").alias("links")))
    looked_up = (each.select("block", "place", "pair").join(pair_counts(each.select("pair", "links")), "pair")
                 .select("block", "place", "total", "best"))
    rows = (encoded.filter(F.col("seq").isNotNull()).drop("seq", "first", "pairs", "links")
            .withColumnRenamed("block", "of_block"))
    return (looked_up.groupBy("block").cogroup(rows.groupBy("of_block")).applyInArrow(_count, _COUNTED)
            .withColumnRenamed("id", id_col))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the byte-level BPE of 50k ids and the piece model of 32k ids."""
    return token_alignment(table(spark, sf_dir, "documents"))
