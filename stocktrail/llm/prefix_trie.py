"""Prefix trie of conversations, by z-fast tries of ranges of conversations.

A prefix goes by a name of 128 bits: a chain of SHA-256 over its turns. The distinct conversations
are dealt by ranges in the order of their names, so that a range shares no more than two paths
with its neighbours. A range's trie is compacted; a node is found by the name of its handle, the
prefix whose length is the two-fattest number on the node's edge. Conversations come in batches:
each is led to its exit node by fat binary search over its own length, then all that leave at one
node are hung below it. Edges are expanded at the end, and what neighbours share is added up.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.session import shuffle_partitions, written

#: Turns of distinct conversations in one range, about.
RANGE_TURNS = 1 << 20
#: Conversations that are located together before any of them is inserted.
BATCH = 4096
#: Neighbouring ids whose decimal forms are joined before they go to the task of their node.
CHUNK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """A compacted trie of sequences of names, where the d-th name stands for the first d items.

    Node 0 is the root. A node's edge holds the depths from ``top`` + 1 to ``end``; its names are
    those of any sequence through it, ``through``. ``last`` is the sequence that ends at it, or -1.
    """

    def __init__(self) -> None:
        self.names: list[list[bytes]] = []
        self.top, self.end, self.up, self.through, self.last = [0], [0], [-1], [-1], [-1]
        self.by_handle: dict[bytes, int] = {}
        self.by_first: dict[bytes, int] = {}

    def name(self, node: int, depth: int) -> bytes:
        return self.names[self.through[node]][depth - 1]

    def _handle(self, node: int) -> bytes:
        return self.name(node, fattest(self.top[node], self.end[node]))

    def locate(self, names: list[bytes], node: int = 0) -> int:
        """The deepest node at or below ``node`` whose whole prefix starts ``names``: a binary
        search that asks for two-fattest lengths, and so only for such as can be handles."""
        low, high = self.end[node], len(names)
        while low < high:
            f = fattest(low, high)
            found = self.by_handle.get(names[f - 1])
            if found is not None and self.end[found] <= len(names) and names[self.end[found] - 1] == self.name(found, self.end[found]):
                node, low = found, self.end[found]
            else:
                high = f - 1
        return node

    def _hang(self, through: int, top: int, end: int, up: int) -> int:
        node = len(self.end)
        for column, value in zip((self.top, self.end, self.up, self.through, self.last), (top, end, up, through, -1)):
            column.append(value)
        self.by_handle[self._handle(node)] = node
        self.by_first[self.name(node, top + 1)] = node
        return node

    def _split(self, node: int, depth: int) -> int:
        """A new node above ``node``, where the first ``depth`` items end."""
        del self.by_handle[self._handle(node)]
        middle = self._hang(self.through[node], self.top[node], depth, self.up[node])
        self.top[node], self.up[node] = depth, middle
        self.by_handle[self._handle(node)] = node
        self.by_first[self.name(node, depth + 1)] = node
        return middle

    def _insert(self, names: list[bytes], start: int) -> None:
        """Add a sequence that begins with the prefix of node ``start``."""
        me = len(self.names)
        self.names.append(names)
        node = self.locate(names, start)
        at = self.end[node]
        if at < len(names):
            below = self.by_first.get(names[at])
            if below is not None:
                # It leaves on this edge: the last depth at which the names agree.
                low, high = at + 1, min(len(names), self.end[below] - 1)
                while low < high:
                    middle = (low + high + 1) // 2
                    if names[middle - 1] == self.name(below, middle):
                        low = middle
                    else:
                        high = middle - 1
                node, at = self._split(below, low), low
            if at < len(names):
                node = self._hang(me, at, len(names), node)
        self.last[node] = me

    def insert(self, batch: list[list[bytes]]) -> None:
        """Add distinct sequences: exit nodes of all first, then those of one exit together."""
        exits = [self.locate(names) for names in batch]
        for i in sorted(range(len(batch)), key=exits.__getitem__):
            self._insert(batch[i], exits[i])


def _starts(whole: list[bytes], name: bytes, depth: int) -> bool:
    return len(whole) >= depth and (depth == 0 or whole[depth - 1] == name)


#: A node within one range: what the whole table holds of it unless ``shared``.
LOCAL = pa.schema(
    [
        ("part", pa.int64()),
        ("name", pa.binary()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("above", pa.binary()),
        ("parent_conv_id", pa.int64()),
        ("shared", pa.bool_()),
        ("parent_shared", pa.bool_()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("member_bytes", pa.int64()),
        ("node_bytes", pa.int64()),
        ("ends_sha256", pa.string()),
    ]
)
LOCAL_DDL = (
    "part long, name binary, depth long, conv_id long, above binary, parent_conv_id long, shared boolean, "
    "parent_shared boolean, n_convs long, n_children long, n_leaves long, member_bytes long, node_bytes long, "
    "ends_sha256 string"
)


def expanded(part: int, rows: list[tuple], before: list[bytes] | None, after: list[bytes] | None) -> Iterator[tuple]:
    """The nodes of one range, every depth of every edge.

    ``rows``: distinct (names, sizes, members, least conv_id, ends_sha256); ``before`` and ``after``
    the names of the sequences next to the range. A node that the range before holds too is counted
    there, as somebody's child and by its own bytes.
    """
    trie = ZFastTrie()
    for i in range(0, len(rows), BATCH):
        trie.insert([names for names, *_ in rows[i : i + BATCH]])
    by_name = {row[0][-1] if row[0] else b"": row for row in rows}

    def of(node: int, depth: int) -> bytes:
        return trie.name(node, depth) if depth else b""

    count = len(trie.end)
    members, least = [0] * count, [None] * count
    children, leaves, member_bytes, node_bytes = [0] * count, [0] * count, [0] * count, [0] * count
    inner = [False] * count
    for up in trie.up[1:]:
        inner[up] = True
    seen_before = lambda name, depth: before is not None and _starts(before, name, depth)
    seen_after = lambda name, depth: after is not None and _starts(after, name, depth)
    out = []
    for v in sorted(range(count), key=lambda v: -trie.end[v]):
        end, name = trie.end[v], of(v, trie.end[v])
        ends = None
        if trie.last[v] >= 0:
            _, _, n, first, ends = by_name[name]
            members[v] += n
            least[v] = first if least[v] is None else min(first, least[v])
            if not inner[v] and not seen_after(name, end):
                leaves[v] += 1
        up = trie.up[v]
        if v:
            least[up] = least[v] if least[up] is None else min(least[up], least[v])
            members[up] += members[v]
            leaves[up] += leaves[v]
        sizes = by_name[trie.names[trie.through[v]][-1]][1] if v else []
        for depth in range(end, trie.top[v] if v else -1, -1):
            name = of(v, depth)
            mine = not seen_before(name, depth)
            if depth:
                member_bytes[v] += members[v] * sizes[depth - 1]
                node_bytes[v] += mine * sizes[depth - 1]
            out.append((v, depth, name, mine, mine and not seen_after(name, depth), children[v] if depth == end else below, ends if depth == end else None, member_bytes[v], node_bytes[v]))
            below = int(mine)
        if v:
            member_bytes[up] += member_bytes[v]
            node_bytes[up] += node_bytes[v]
            children[up] += below
    for v, depth, name, _, own, kids, ends, total, each in out:
        above = of(v, depth - 1) if depth else None
        up = v if depth - 1 > trie.top[v] or depth == 0 else trie.up[v]
        parent_own = depth > 0 and not seen_before(above, depth - 1) and not seen_after(above, depth - 1)
        yield (
            part, name, depth, least[v], above, least[up] if depth else None, not (own and depth), not parent_own,
            members[v], kids, leaves[v], total, each, ends,
        )


def _nodes(sequences: pa.Table, bounds: pa.Table) -> pa.Table:
    rows = list(zip(*[sequences.column(c).to_pylist() for c in ("names", "sizes", "members", "conv_id", "ends_sha256")]))
    if not rows:
        return LOCAL.empty_table()
    before, after = bounds.column("before")[0].as_py(), bounds.column("after")[0].as_py()
    made = expanded(sequences.column("part")[0].as_py(), rows, before, after)
    return pa.table([pa.array(c, kind) for c, kind in zip(zip(*made), LOCAL.types)], schema=LOCAL)


def prefix_names(turns: list[tuple[str, bytes]]) -> list[bytes]:
    """Names of the first 1, 2 .. turns, each a (role, digest of the text)."""
    out, name = [], b""
    for role, digest in turns:
        said = role.encode()
        name = hashlib.sha256(b"%s%d:%s%s" % (name, len(said), said, digest)).digest()[:16]
        out.append(name)
    return out


def borrowed_turns(conv_id: int) -> int:
    """How many of its turns a conversation takes from the first one of its five."""
    return zlib.crc32(str(conv_id).encode()) % 9


def _rebuilt(borrow: Callable[[int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for base, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns: dict[int, list] = {}
                for r in rows:
                    turns.setdefault(r["conv_id"], []).append((r["role"], r["digest"], r["size"]))
                for conv, own in turns.items():
                    h = borrow(conv)
                    mine = turns.get(base, [])[:h] + own[h:]
                    made.append((conv, prefix_names([t[:2] for t in mine]), [t[2] for t in mine]))
            kinds = (pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch(columns, names=["conv_id", "names", "sizes"])

    return run


def rebuilt(rows: DataFrame, borrow: Callable[[int], int] = borrowed_turns) -> DataFrame:
    """(conv_id, names, sizes): each conversation's prefixes and the bytes of its turns' texts, its
    first turns taken from the conversation conv_id - conv_id % 5. Texts do not move: their
    digests do. Five conversations are one row of 60 bytes a turn, however long."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    turn = F.struct(
        conv.alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    fives = (
        rows.where(conv.isNotNull())
        .select((conv - F.pmod(conv, F.lit(5))).alias("base"), turn.alias("t"))
        .groupBy("base")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    return fives.mapInArrow(_rebuilt(borrow), "conv_id long, names array<binary>, sizes array<long>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (last, members, least, ids), in order of last and ids, to one row per last."""
    now, members, least, state = None, 0, None, None
    shape = pa.schema([("members", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for last, n, first, ids in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if last != now:
                if now is not None:
                    done.append((members, least, state.hexdigest()))
                now, members, least, state = last, 0, first, hashlib.sha256()
            else:
                state.update(b",")
            members += n
            state.update(ids.encode())
        yield pa.record_batch([pa.array([d[i] for d in done], kind) for i, kind in enumerate(shape.types)], schema=shape)
    if now is not None:
        yield pa.record_batch([pa.array([x], kind) for x, kind in zip((members, least, state.hexdigest()), shape.types)], schema=shape)


def distinct_sequences(whole: DataFrame) -> DataFrame:
    """(names, sizes, members, conv_id, ends_sha256): equal conversations as one, by the least id.

    Copies are joined to text in chunks of neighbouring ids first, so a conversation with a third
    of all copies is a few rows for the one task that must digest its ids in order.
    """
    last = F.expr("if(size(names) = 0, X'', element_at(names, -1))")
    ends = (
        whole.select("conv_id", last.alias("last"), F.floor(F.col("conv_id") / CHUNK).alias("chunk"))
        .groupBy("last", "chunk")
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("last", "chunk", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("least"), F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))
        .repartition("last")
        .sortWithinPartitions("last", "chunk")
        .select("last", "n", "least", "ids")
        .mapInArrow(_digests, "members long, conv_id long, ends_sha256 string")
    )
    return whole.join(ends, "conv_id").select("names", "sizes", "members", "conv_id", "ends_sha256")


def trie_nodes(whole: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    per distinct prefix of the sequences in ``whole`` (conv_id, names, sizes).

    ``saved_tokens`` of a node sums (n_convs - 1) times the last turn's bytes over its subtree.
    """
    spark = whole.sparkSession
    whole = written(whole, "rebuilt-conversations")
    turns = whole.agg(F.sum(F.size("names"))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-turns // range_turns))
    sequences = written(
        distinct_sequences(whole).repartitionByRange(parts, "names").withColumn("part", F.spark_partition_id().cast("long")),
        "distinct-conversations",
    )
    # A row per range.
    order = Window.orderBy("part")
    bounds = (
        sequences.groupBy("part")
        .agg(F.min("names").alias("low"), F.max("names").alias("high"))
        .select("part", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    )
    local = written(
        sequences.groupBy("part").cogroup(bounds.groupBy("part")).applyInArrow(_nodes, LOCAL_DDL), "trie-nodes"
    )
    # Nodes in more than one range: two paths per range at most, and the root.
    shared = written(
        local.where("shared")
        .groupBy("name")
        .agg(
            F.min("part").alias("part"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("above").alias("above"),
            F.first("parent_shared").alias("parent_shared"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "member_bytes", "node_bytes")],
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "shared-nodes",
    )
    said = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "member_bytes", "node_bytes", "ends_sha256"]
    settled = local.where("not shared and not parent_shared").select(*said)
    rest = ["part", "above", *[c for c in said if c != "parent_conv_id"]]
    asking = local.where("not shared and parent_shared").select(*rest).unionAll(shared.select(*rest))
    # A range asks once for each parent, so no parent is a hot key.
    wanted = asking.where("above is not null").select("part", "above").distinct()
    parents = wanted.join(shared.select(F.col("name").alias("above"), F.col("conv_id").alias("parent_conv_id")), "above")
    found = asking.join(parents, ["part", "above"], "left").select(*said)
    return settled.unionAll(found).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("member_bytes") - F.col("node_bytes")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def conversation_trie(rows: DataFrame, borrow: Callable[[int], int] = borrowed_turns) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations; see ``trie_nodes``.

    ``rows`` has conv_id, turn, role and text; further columns are ignored. Turns go by ``turn``,
    NULL first, equal ones by role and then the digest of the text; NULL role or text is empty, and
    repeated rows are turns of their own. Rows without conv_id belong to no conversation. A
    conversation that is left without turns is a member of the root alone. An empty table gives no rows.
    """
    return trie_nodes(rebuilt(rows, borrow))
