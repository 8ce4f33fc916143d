"""The prefix trie of conversations, by digests of blocks of turns that are refined only where siblings diverge."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm.common import look_up, map_rows
from terrier.sources.scratch import settle

#: Turns of a block, and ids of one chunk of a member list.
BLOCK = 4
CHUNK = 4096
#: Digest of the root, the empty sequence.
ROOT = bytes(16)


def digest_turns(messages: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, said (a 128-bit digest of role and text), chars: texts don't move any further."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return messages.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.unhex(F.substring(F.sha2(framed, 256), 1, 32)).alias("said"),
        F.length(text).cast("long").alias("chars"),
    )


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), said, chars: turns in order, nulls first, ties by role and digest."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "said", "chars")


def with_roots(numbered: DataFrame) -> DataFrame:
    """``numbered`` and, for every conversation, a row at position 0, so that one without turns is there too."""
    root = numbered.filter("pos = 1").select(
        "conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("said"), F.lit(0).cast("long").alias("chars")
    )
    return numbered.union(root)


def shared_heads(numbered: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Conversations rebuilt on the first turns of another one, with rows at position 0.

    The first ``head`` turns (at most ``most``) come from the conversation ``base``, the others are its
    own after as many. Only first turns of bases are joined, each to the conversations that name it.
    """
    numbered = settle(numbered, "turns")
    convs = numbered.filter("pos = 1").select("conv_id", base.alias("base"), head.alias("head"))
    heads = numbered.filter(F.col("pos") <= most).withColumnRenamed("conv_id", "base")
    taken = convs.join(heads, "base").filter("pos <= head").select("conv_id", "pos", "said", "chars")
    own = numbered.filter(F.col("pos") > head)
    return with_roots(numbered).filter("pos = 0").union(taken).union(own)


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """A row for each block of each conversation; block 0 is the root.

    conv_id, level, parent (last node of the block before), nodes (the chained digest after every turn of
    the block), chars (of its turns), upto (all chars to its end), last (nothing follows). Each digest
    covers its predecessor, so it stands for the whole prefix. Rows stream: no conversation is held whole.
    """

    def rows(batches) -> Iterator[tuple]:
        conv, node, parent, level, upto = None, ROOT, None, 0, 0
        nodes: list[bytes] = []
        sizes: list[int] = []

        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])

            def close(last, out=out):
                for column, value in zip(out, (conv, level, parent, nodes, sizes, upto, last), strict=True):
                    column.append(value)

            columns = (batch[c].to_pylist() for c in ("conv_id", "said", "chars"))
            for c, said, chars in zip(*columns, strict=True):
                if said is None:  # position 0: a conversation begins
                    if conv is not None:
                        close(True)
                    conv, level, parent, node, nodes, sizes, upto = c, 0, None, ROOT, [ROOT], [0], 0
                    continue
                if level == 0 or len(nodes) == block:
                    close(False)
                    level, parent, nodes, sizes = level + 1, node, [], []
                node = hashlib.sha256(node + said).digest()[:16]
                nodes.append(node)
                sizes.append(chars)
                upto += chars
            yield out
        if conv is not None:
            yield tuple([v] for v in (conv, level, parent, nodes, sizes, upto, True))

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return map_rows(
        dealt, rows, "conv_id long, level long, parent binary, nodes array<binary>, chars array<long>, upto long, last boolean"
    )


def _member_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: the digest of the comma-joined ids that end at each node, ascending.

    Ids are sorted over all partitions and joined into chunks; the digest runs over a node's chunks, so
    a node with a third of all conversations is a few rows for the task that hashes it, never a list.
    """

    def chunks(batches):
        for batch in batches:
            nodes, ids = batch["node"].to_numpy(zero_copy_only=False), batch["conv_id"].to_numpy()
            if not len(ids):
                continue
            edge = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
            cuts = np.unique(np.concatenate((edge, np.arange(0, len(ids), CHUNK)))).tolist()
            spans = list(zip(cuts, [*cuts[1:], len(ids)], strict=True))
            yield [nodes[a] for a, _ in spans], [int(ids[a]) for a, _ in spans], [
                ",".join(map(str, ids[a:b].tolist())) for a, b in spans
            ]

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            done, found = [], []
            for n, text in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if n != node:
                    if node is not None:
                        done.append(node)
                        found.append(state.hexdigest())
                    node, state = n, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield done, found
        if node is not None:
            yield [node], [state.hexdigest()]

    ordered = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = map_rows(ordered, chunks, "node binary, first long, ids string")
    return map_rows(joined.repartition("node").sortWithinPartitions("node", "first"), hashed, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (conv_id, pos, said, chars; ``with_roots``).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (childless
    nodes of the subtree, itself included), saved_tokens (over the subtree, (members - 1) times the
    characters of a node's last turn), ends_sha256 (of the ids that end here, ascending, comma-joined).

    Conversations are first grouped by the digests of whole blocks of turns, so equal blocks collapse to
    one row before turns are looked at. A block without siblings is a chain, written down as it is; only
    blocks that share their parent with others are taken apart into turns and counted again by node.

    Sums over subtrees need no walk: of the conversations with the same turns, one stands for all, and a
    node counts as distinct where its smallest member's conversation passes. What follows a block is then a
    sum over the conversations that pass it, and inside a block at most ``block`` turns remain.

    No conversations, no rows; one without turns is a member of the root alone.
    """
    rows = settle(_blocks(turns, block), "blocks")
    node = F.element_at("nodes", -1)
    blocks = settle(
        rows.groupBy("level", "parent", "nodes", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")),
        "distinct_blocks",
    )
    ends = rows.filter("last").select(node.alias("node"), "conv_id", F.col("upto").alias("total"))
    # Blocks that share their parent. The parent's own row is found from many blocks, so that lookup is salted.
    siblings = blocks.filter("level > 0").groupBy("parent").agg(F.count("*").alias("siblings"))
    blocks = settle(
        look_up(blocks, siblings.filter("siblings > 1"), ["parent"], ["nodes"]).withColumn("fork", F.col("siblings").isNotNull()).drop("siblings"),
        "marked_blocks",
    )
    first = F.greatest(F.lit(0), (F.col("level") - 1) * block + 1)
    placed = blocks.select("*", F.posexplode("nodes").alias("at", "node")).select(
        "node",
        F.when(F.col("at") == 0, F.col("parent")).otherwise(F.get("nodes", F.col("at") - 1)).alias("above"),
        (first + F.col("at")).alias("depth"),
        "level",
        F.get("chars", "at").alias("size"),
        F.expr("aggregate(slice(chars, at + 1, size(chars)), 0L, (s, v) -> s + v)").alias("below"),
        "n",
        "conv_id",
        "fork",
        F.element_at("nodes", -1).alias("block_end"),
        F.col("conv_id").alias("block_conv"),
    )
    counted = ["node", "above", "depth", "level", "size"]
    single = placed.filter("not fork").select(*counted, "n", "conv_id")
    merged = placed.filter("fork").groupBy(*counted).agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    nodes = settle(single.union(merged), "nodes")

    owned = settle(nodes.groupBy("conv_id", "level").agg(F.sum("size").alias("own")), "owned")
    stood = ends.groupBy("node", "total").agg(F.count("*").alias("copies"), F.min("conv_id").alias("conv_id"))
    stood = stood.join(nodes.select("node", "n"), "node").select(
        "conv_id", "total", "copies", (F.col("n") == F.col("copies")).cast("long").alias("leaf")
    )
    stood = stood.join(owned.groupBy("conv_id").agg(F.sum("own").alias("own")), "conv_id", "left").fillna(0, ["own"])
    rest = F.col("total") - F.col("upto")
    after = (
        rows.join(stood, "conv_id")
        .groupBy(node.alias("block_end"))
        .agg(
            F.sum(F.col("copies") * rest - F.least(rest, "own")).alias("after"),
            F.sum("leaf").alias("leaves"),
        )
    )
    own = owned.select(F.col("conv_id").alias("block_conv"), "level", "own")
    summed = placed.join(after, "block_end").join(own, ["block_conv", "level"], "left").select(
        "node",
        (F.col("after") + F.col("n") * F.col("below") - F.least("below", F.coalesce("own", F.lit(0)))).alias("saved_tokens"),
        F.col("leaves").alias("n_leaves"),
        "fork",
    )
    sums = summed.filter("not fork").drop("fork").union(
        summed.filter("fork").groupBy("node").agg(F.sum("saved_tokens"), F.sum("n_leaves"))
    )
    children = nodes.filter("above is not null").groupBy(F.col("above").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    whole = (
        nodes.join(sums, "node")
        .join(children, "node", "left")
        .join(_member_digests(ends), "node", "left")
    )
    return look_up(whole, above, ["above"], ["node"], nodes).select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(
    messages: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``prefix_trie`` of a table of messages as they are.

    Turns are ordered by number, nulls first; equal numbers by role and then by a digest of role and text,
    and repeated rows are all turns. Null roles and texts count as empty. Rows with a null id belong to
    no conversation and are left out. Other columns are ignored.
    """
    numbered = settle(numbered_turns(digest_turns(messages, id_col, turn_col, role_col, text_col)), "turns")
    return prefix_trie(with_roots(numbered), block)


def rebuilt_trie(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of conversations of which each has the first turns of another one, as the digest query states."""
    numbered = numbered_turns(digest_turns(messages, "conv_id", "turn", "role", "text"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie(shared_heads(numbered, F.col("conv_id") - F.col("conv_id") % 100, head, 5), block)


#: CRC-32 byte by byte: DuckDB has no function for it.
SQL = """with recursive steps as (select unnest(range(256))::bigint as b),
bits as (select b, list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8]::bigint[],
  lambda c, i: xor(c // 2, case when c % 2 = 1 then 3988292384 else 0 end)) as v from steps),
tab as (select list(v order by b) as t from bits),
ids as (select distinct conv_id from conversations where conv_id is not null),
crc as (select conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
    [ascii(x)::bigint for x in string_split(conv_id::varchar, '')]),
    lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1]))) % 6 as h from ids, tab),
turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
  partition by conv_id order by turn nulls first, coalesce(role, ''),
    substr(sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) as pos
  from conversations where conv_id is not null),
built as (select c.conv_id, pos, role, text from crc c join turns t on t.conv_id = c.conv_id - c.conv_id % 100 and pos <= h
  union all select c.conv_id, pos, role, text from crc c join turns t on t.conv_id = c.conv_id and pos > h),
convs as (select conv_id, coalesce(list(length(role)::varchar || ':' || role || text order by pos) filter (pos is not null), []) as said,
  coalesce(list(length(text) order by pos) filter (pos is not null), []) as chars
  from ids left join built using (conv_id) group by 1),
pre as (select conv_id, said, d, said[1:d] as path, case when d = 0 then 0 else chars[d] end as size
  from (select *, unnest(range(0, len(said) + 1)) as d from convs)),
nodes as (select path, d, any_value(size) as size, count(*) as n, min(conv_id) as conv_id,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(said) = d), '')) as ends_sha256
  from pre group by 1, 2),
kids as (select path[1:d - 1] as path, count(*) as k from nodes where d > 0 group by 1),
full_ as (select n.*, coalesce(k, 0) as n_children from nodes n left join kids using (path)),
sums as (select p as path, sum((n - 1) * size)::bigint as saved_tokens, count(*) filter (n_children = 0)::bigint as n_leaves
  from (select n, size, n_children, path[1:unnest(range(0, d + 1))] as p from full_) group by 1)
select f.conv_id, f.d::bigint as depth, u.conv_id as parent_conv_id, f.n as n_convs, f.n_children, n_leaves, saved_tokens,
  f.ends_sha256
from full_ f join sums s on s.path = f.path left join nodes u on f.d > 0 and u.path = f.path[1:f.d - 1]"""
