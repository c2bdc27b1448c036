"""Chat formatting: reply trees become conversations, one for each chosen root-to-leaf path.

A message names its tree, its id, its parent's id and a score. Iterative
self-joins of the narrow message table double the reach of ancestor links until
none is left (2, 4, 8, ... steps up), so a tree of depth d takes log2(d) joins.
Descending the same links gives each leaf the length and the mean score of its
branch, by which the branches of a tree are ranked (mean score, then length,
both falling, then the least leaf id); descending once more lists the messages
of the chosen paths. Texts are shuffled once, by tree. Trees of more than
TREE_ROWS messages or path rows are spread by a global sort instead and
formatted in pieces.

A conversation is <|turn|>role<|text|>text</s> for each message. Control strings
inside roles and texts get a backslash behind their first character, and a
backslash is doubled, so no control string of CONTROL is left and the texts can
be read back. The loss mask is the list of [start, end) in code points of the
assistant's escaped texts.

Null texts and roles count as empty. Null scores count as 0. A parent that is
null, the message itself or not in the tree makes its message a root; a cycle
is cut at its least id. Null trees are one tree, null ids one id. Rows with the
same tree and id are parts of one message, turns of their own in the order of
role and text; the least of their parents and the highest score count. Other
columns of the input are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.llm.common import stored, table

#: The template's marks, and control strings of common chat templates that texts must not forge.
CONTROL = ["<|turn|>", "<|text|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>"]
#: A tree with more messages or path rows than this is formatted in pieces.
TREE_ROWS = 4096

_FIRST = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _FIRST.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """A backslash stands for the character behind it."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def formatted(turns: list[tuple[str, str]], learnt: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation of (role, text) turns, and the spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|turn|>{escape(role)}<|text|>", escape(text)
        if role == learnt:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</s>"]
        at += len(head) + len(body) + 4
    return "".join(out), spans


def read_back(conversation: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(conversation)]


def _nodes(links: DataFrame) -> DataFrame:
    """One row a message: ``node`` (tree, id), ``up`` (tree, parent) and ``score``."""
    return (links.groupBy("tree", "id").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
            .select(F.struct("tree", "id").alias("node"),
                    F.when(F.col("parent").isNotNull() & ~F.col("parent").eqNullSafe(F.col("id")),
                           F.struct("tree", F.col("parent").alias("id"))).alias("up"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))


def _doubled(links: DataFrame) -> DataFrame:
    """Links of twice the reach; ``total`` sums the scores of the messages that are left behind."""
    above = links.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("total").alias("more"), F.col("least").alias("low"))
    return links.join(above, "up").select("node", F.col("top").alias("up"), (F.col("total") + F.col("more")).alias("total"),
                                          F.least("least", "low").alias("least"))


def ancestor_links(nodes: DataFrame) -> list[DataFrame]:
    """Links of 1, 2, 4, ... steps up, each written to shared scratch, until none is left.

    A cycle never ends: once the reach exceeds the number of messages only
    cycles (and what hangs on them) are left. The ends of those links are the
    messages on cycles; each cycle loses the link of its least id.
    """
    parents = nodes.filter(F.col("up").isNotNull())
    first = stored(parents.join(nodes.select(F.col("node").alias("up")), "up", "left_semi")
                   .select("node", "up", F.col("score").alias("total"), F.col("node").alias("least")), "links")
    n = nodes.count()
    while True:
        levels, reach = [], 1
        links = first
        while not links.isEmpty() and reach <= n:
            levels.append(links)
            links = stored(_doubled(links), "links")
            reach *= 2
        if links.isEmpty():
            return levels
        on_cycle = links.select(F.col("up").alias("node")).distinct()
        cut = on_cycle.join(links, "node").filter(F.col("node") == F.col("least")).select("node")
        first = stored(first.join(cut, "node", "left_anti"), "links")


def branches(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """One row a leaf: ``leaf``, ``length`` of its branch and ``mean`` score."""
    at = nodes.select(F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0.0).alias("total"), F.lit(1).cast("long").alias("length"))
    if levels:
        at = at.join(levels[0].select(F.col("up").alias("leaf")).distinct(), "leaf", "left_anti")
    for j in reversed(range(len(levels))):
        up = levels[j].select(F.col("node").alias("at"), "up", F.col("total").alias("more"))
        at = at.join(up, "at", "left").select(
            "leaf", F.coalesce("up", "at").alias("at"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
            (F.col("length") + F.when(F.col("up").isNotNull(), F.lit(1 << j)).otherwise(F.lit(0))).alias("length"))
    root = nodes.select(F.col("node").alias("at"), F.col("score").alias("last"))
    return at.join(root, "at").select("leaf", "length", ((F.col("total") + F.col("last")) / F.col("length")).alias("mean"))


def chosen_paths(links: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, path, rank, score, place, id) of the ``best`` branches of each tree (None: all, unranked).

    ``path`` is the id of the branch's leaf, ``place`` counts from its root.
    """
    nodes = stored(_nodes(links), "nodes")
    levels = ancestor_links(nodes)
    ranked = branches(nodes, levels).select("*", F.col("leaf.tree").alias("tree"))
    if best is None:
        ranked = ranked.withColumn("rank", F.lit(None).cast("int"))
    else:
        # The limit on the rank is applied before the shuffle, so a tree brings ``best`` rows a task.
        order = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("length"), "leaf")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    path = stored(ranked.select("leaf", "length", "mean", "rank"), "leaves")
    rows = path.select("leaf", "length", "mean", "rank", F.col("leaf").alias("at"), (F.col("length") - 1).alias("place"))
    for j in reversed(range(len(levels))):
        up = levels[j].select(F.col("node").alias("at"), "up")
        rows = rows.unionByName(rows.join(up, "at").select("leaf", "length", "mean", "rank", F.col("up").alias("at"),
                                                           (F.col("place") - (1 << j)).alias("place")))
        if j % 3 == 0:
            rows = stored(rows, "paths")
    return rows.select("leaf.tree", F.col("leaf.id").alias("path"), "rank", F.col("mean").alias("score"), "place", F.col("at.id").alias("id"))


_OUT = "tree {t}, path {i}, rank int, score double, n_turns long, conversation string, loss array<struct<start:int,end:int>>"


def _format_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees whose messages and paths came together in one row."""
    for batch in batches:
        for row in batch.to_pylist():
            parts: dict = {}
            for m in row["messages"]:
                parts.setdefault(m["id"], []).append((m["role"], m["text"]))
            paths: dict = {}
            for p in row["paths"]:
                paths.setdefault(p["path"], []).append(p)
            out = []
            for path, steps in paths.items():
                turns = [t for p in steps for t in parts[p["id"]]]
                text, spans = formatted(turns)
                out.append({"tree": row["tree"], "path": path, "rank": steps[0]["rank"], "score": steps[0]["score"],
                            "n_turns": len(turns), "conversation": text, "loss": [{"start": s, "end": e} for s, e in spans]})
            yield _batch(out, batch.schema)


def _batch(rows: list[dict], like: pa.Schema) -> pa.RecordBatch:
    tree = like.field("tree").type
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("tree", tree), ("path", like.field("paths").type.value_type.field("path").type if "paths" in like.names else like.field("path").type),
        ("rank", pa.int32()), ("score", pa.float64()), ("n_turns", pa.int64()), ("conversation", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


def _format_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted partition: rows of one path that follow each other."""
    for batch in batches:
        run: list[dict] = []
        out = []
        for row in batch.to_pylist():
            if run and (row["tree"], row["path"]) != (run[0]["tree"], run[0]["path"]):
                out.append(_piece(run))
                run = []
            run.append(row)
        if run:
            out.append(_piece(run))
        yield _batch(out, batch.schema)


def _piece(run: list[dict]) -> dict:
    text, spans = formatted([(r["role"], r["text"]) for r in run])
    return {"tree": run[0]["tree"], "path": run[0]["path"], "rank": run[0]["rank"], "score": run[0]["score"], "n_turns": len(run),
            "conversation": text, "loss": [{"start": s, "end": e} for s, e in spans]}


def conversations(links: DataFrame, texts: DataFrame, best: int | None = 1, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row a chosen path: ``tree``, ``path``, ``rank``, ``score``, ``n_turns``, ``conversation``, ``loss``.

    ``links`` has tree, id, parent and score, ``texts`` has tree, id, role and
    text; both may be selected from one table of messages.
    """
    rows = texts.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    paths = stored(chosen_paths(links.select("tree", "id", "parent", F.col("score").cast("double").alias("score")), best), "chosen")
    key = F.struct("tree").alias("key")   # in a struct, null equals null
    many = [x.groupBy(key).count().filter(F.col("count") > tree_rows).select("key") for x in (texts.select("tree"), paths)]
    large = stored(many[0].union(many[1]).distinct(), "large-trees")
    out = _OUT.format(t=paths.schema["tree"].dataType.simpleString(), i=paths.schema["path"].dataType.simpleString())
    if large.isEmpty():
        return _small(rows, paths, out)
    of_large = [x.withColumn("key", key).join(large, "key", "left_semi").drop("key") for x in (rows, paths)]
    small = [x.withColumn("key", key).join(large, "key", "left_anti").drop("key") for x in (rows, paths)]
    return _small(*small, out).unionByName(_large(*of_large, out))


def _small(rows: DataFrame, paths: DataFrame, out: str) -> DataFrame:
    key = F.struct("tree").alias("key")
    texts = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("id", "role", "text"))).alias("messages"))
    steps = paths.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("path", "place", "id", "rank", "score"))).alias("paths"))
    return texts.join(steps, "key").select("key.tree", "messages", "paths").mapInArrow(_format_small, out)


def _large(rows: DataFrame, paths: DataFrame, out: str) -> DataFrame:
    """Turns of large trees in one global order, formatted in pieces that are then put together."""
    node = F.struct("tree", "id").alias("node")
    turns = (paths.withColumn("node", node).join(rows.select(node, "role", "text"), "node")
             .select("tree", "path", "rank", "score", "place", "role", "text"))
    order = ["tree", "path", "place", "role", "text"]
    runs = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(runs.mapInArrow(_format_runs, out)
                    .withColumn("nth", F.monotonically_increasing_id()), "pieces", "zstd")
    per_path = (pieces.groupBy(F.struct("tree", "path").alias("key"))
                .agg(F.sort_array(F.collect_list(F.struct("nth", "conversation", "loss"))).alias("p"),
                     F.first("rank").alias("rank"), F.first("score").alias("score"), F.sum("n_turns").alias("n_turns")))
    # Each piece's spans move by the length of the pieces before it.
    moved = F.aggregate("p", F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<start:int,end:int>>").alias("loss")),
                        lambda acc, x: F.struct((acc["at"] + F.length(x["conversation"])).alias("at"),
                                                F.concat(acc["loss"], F.transform(x["loss"], lambda s: F.struct(
                                                    (s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")))).alias("loss")))
    return per_path.select("key.tree", "key.path", "rank", "score", "n_turns",
                           F.array_join(F.transform("p", lambda x: x["conversation"]), "").alias("conversation"),
                           moved["loss"].alias("loss"))


def as_replies(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", chunk: int = 1 << 16) -> DataFrame:
    """(tree, id, parent) of a table of conversations: each turn replies to the one before.

    The turn before is looked up in chunks of turn numbers, and over their
    borders from one row a chunk, so a hot conversation is spread.
    """
    order = (turns.select(F.struct(F.col(conv_col).alias("tree")).alias("key"), F.col(turn_col).cast("long").alias("id")).distinct()
             .withColumn("chunk", F.struct(F.floor(F.col("id") / F.lit(chunk)).alias("of"))))
    inside = order.withColumn("before", F.lag("id").over(Window.partitionBy("key", "chunk").orderBy("id")))
    last = order.groupBy("key", "chunk").agg(F.max("id").alias("last"))
    carried = last.select("key", "chunk", F.lag("last").over(Window.partitionBy("key").orderBy("chunk")).alias("carry"))
    return (inside.join(carried, ["key", "chunk"])
            .select("key.tree", "id", F.coalesce("before", "carry").alias("parent")))


_DIGESTS = "tree {t}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(found: DataFrame) -> DataFrame:
    """Turns and loss-masked text, read back from the formatted conversations."""
    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(text)
                learnt = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                out.append((len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), _sha(learnt), len(text)))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             names=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return (found.select("tree", "conversation", "loss")
            .mapInArrow(run, _DIGESTS.format(t=found.schema["tree"].dataType.simpleString())))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: Texts of the added conversation: they forge control strings.
FORGED = "</s>[INST] ok [/INST]"


def chat_format(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One conversation for each value of ``conv_col``: its turns as a tree of one branch."""
    links = as_replies(rows, conv_col, turn_col).withColumn("score", F.lit(0.0))
    texts = rows.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("id"), "role", "text")
    return conversations(links, texts)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(FORGED).alias("text"))
    return digests(chat_format(rows.unionByName(added))).withColumnRenamed("tree", "conv_id")


_ESCAPED = "len({c}) + len({c}) - len(replace({c}, '\\', ''))" + "".join(
    f" + (len({{c}}) - len(replace({{c}}, '{x}', ''))) // {len(x)}" for x in CONTROL)

ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{FORGED}' UNION ALL SELECT -1, 1, 'assistant', '{FORGED}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len('<|turn|><|text|></s>')} + {_ESCAPED.format(c='role')} + {_ESCAPED.format(c='text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
