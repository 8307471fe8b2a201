"""Reply trees to conversations: every root-to-leaf path, ranked by score, formatted with a template.

Paths come from self-joins that double their reach: a table of each message's 1st, 2nd, 4th .. next
ancestor, then each leaf's path from those, so that a tree of depth d takes about 2 log2(d) joins.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.session import written

#: Strings with a meaning to this template or other common ones (fixed values).
CONTROLS = (
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(r"(?:[^\\\n]|\\.)*", re.S)


def escape(text: str) -> str:
    """No control string is left: a backslash goes behind the first character of each, after
    every backslash of the text has been doubled."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Template:
    """A turn is ``begin role \\n text end``; texts of ``learnt`` roles are under the loss mask."""

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    learnt: frozenset[str] = frozenset({"assistant"})

    def format(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The conversation as one text, and (start, length) of the parts under the loss mask."""
        out: list[str] = []
        spans, at = [], 0
        for role, text in turns:
            head = self.begin + escape(role).replace("\n", "\\\n") + "\n"
            body = escape(text)
            if role in self.learnt:
                spans.append((at + len(head), len(body)))
            out += [head, body, self.end]
            at += len(head) + len(body) + len(self.end)
        return "".join(out), spans

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted conversation."""
        turns = []
        for part in formatted.split(self.end)[:-1]:
            part = part.removeprefix(self.begin)
            role = _ROLE.match(part).group()
            turns.append((unescape(role), unescape(part[len(role) + 1 :])))
        return turns


def _jumps(up: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up) of the 2^k-th ancestors, and the nodes that hang on a cycle.

    The depths in a tree have no gaps, so a table that is no smaller than the last holds nothing
    but nodes that never reach a root.
    """
    tables, rows = [up], up.count()
    while rows:
        last = tables[-1]
        further = written(
            last.alias("x")
            .join(last.alias("y"), (F.col("x.tree") == F.col("y.tree")) & (F.col("x.up") == F.col("y.node")))
            .select("x.tree", "x.node", "y.up"),
            "ancestors",
        )
        n = further.count()
        if n == rows:
            break
        rows = n
        tables.append(further)
    return tables, tables[-1].select("tree", "node")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, above): for every leaf each node of its path, ``above`` steps up."""
    parents = nodes.select("tree", F.col("node").alias("up")).distinct()
    up = written(
        nodes.where("parent is not null")
        .select("tree", "node", F.col("parent").alias("up"))
        .join(parents, ["tree", "up"])
        .select("tree", "node", "up"),
        "ancestors",
    )
    tables, cyclic = _jumps(up)
    inner = up.select("tree", F.col("up").alias("node")).distinct()
    leaves = nodes.select("tree", "node").join(inner, ["tree", "node"], "left_anti")
    out = leaves.join(cyclic, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above")
    )
    for k in range(len(tables) - 1, -1, -1):
        more = out.join(tables[k], ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above")
        )
        out = written(out.unionAll(more), "paths")
    return out


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for turns in batch.column(4).to_pylist():
                turns.sort(key=lambda t: -t["above"])
                text, mask = template.format([(t["role"] or "", t["text"] or "") for t in turns])
                texts.append(text)
                spans.append([{"start": a, "length": n} for a, n in mask])
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            columns = [*[batch.column(i) for i in range(4)], pa.array(texts, pa.string()), pa.array(spans, span)]
            yield pa.record_batch(columns, names=["tree", "leaf", "rank", "score", "formatted", "loss"])

    return run


def conversations(nodes: DataFrame, branches: int = 1, template: Template = Template()) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss) for the ``branches`` best paths of each tree.

    ``nodes`` has tree (text), node, parent (long), role, text, score (double); further columns
    are ignored. A path's score is the sum of its nodes' (NULL as 0); ties go to the smaller leaf.
    A parent that is not there, or NULL, makes a root; a tree may have several. A node that comes
    more than once counts once, as its least row; nodes without tree or node, and those that hang
    on a cycle of parents, are on no path. NULL role or text is empty. No rows give no rows.

    Only the chosen paths' texts move. A conversation is one text and so one row, however long.
    """
    once = (
        nodes.where("tree is not null and node is not null")
        .groupBy("tree", "node")
        .agg(F.min(F.struct("parent", "role", "text", "score")).alias("r"))
        .select("tree", "node", "r.*")
    )
    once = written(once, "messages")
    found = paths(once.select("tree", "node", "parent"))
    scored = (
        found.join(once.select("tree", "node", "score"), ["tree", "node"])
        .groupBy("tree", "leaf")
        .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("score"))
    )
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    turns = (
        found.join(chosen, ["tree", "leaf"])
        .join(once.select("tree", "node", "role", "text"), ["tree", "node"])
        .groupBy("tree", "leaf", "rank", "score")
        .agg(F.collect_list(F.struct("above", "role", "text")).alias("turns"))
        .select("tree", "leaf", F.col("rank").cast("long").alias("rank"), "score", "turns")
    )
    shape = "tree string, leaf long, rank long, score double, formatted string, loss array<struct<start: long, length: long>>"
    return turns.mapInArrow(_format(template), shape)


def _digests(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = template.read(text)
                learnt = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in spans)
                said = hashlib.sha256("".join(f"{role}\n{words}\n" for role, words in turns).encode())
                rows.append((len(turns), said.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.record_batch([batch.column(0), *columns], names=names)

    return run


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read from (conv_id, formatted, loss): turns, and all text under the loss mask."""
    shape = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(_digests(template), shape)


#: Stands for a NULL conv_id among the trees' names.
NO_ID = "none"


def as_tree(rows: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees of one branch: each row
    answers the one before it by turn; equal turns go by role and text. Rows without conv_id are
    one conversation."""
    rows = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_ID)).alias("tree"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return rows.withColumn("node", place).select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
