"""The trie of conversation prefixes, read off sorted conversations by range minima over their common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketstrata.llm.common import parts_for
from marketstrata.session import stored

#: Turns (and one more for each conversation) of a range; a task holds one range.
RANGE_TURNS = 60_000
#: Candidate prefixes searched at a time, and conversation ids in one piece of a list that crosses ranges.
BLOCK = 500_000
CHUNK_IDS = 512

_EMPTY = hashlib.sha256(b"").hexdigest()
_WORD = r"[^\x20\x09-\x0D]+"
_FIGURES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_OUT = (
    "kind int, part int, seq long, key binary, parent_key binary, "
    + ", ".join(f"{c} long" for c in _FIGURES)
    + ", ends string"
)


def turn_lists(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: int = 20
) -> DataFrame:
    """One row a conversation: ``base`` (its id less its remainder by ``every``), ``conv``, ``turns``.

    A turn is a 128-bit digest of role and text, and the text's number of words; the texts are not gathered. Turns
    are in ``turn`` order, NULL first; ties go by role, then by digest. NULL roles and texts are empty; repeated
    rows are turns of their own. Rows without a conversation id are no conversation's and are left out.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said), 256)
    rows = messages.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            who.alias("role"),
            F.unhex(F.substring(digest, 1, 32)).alias("digest"),
            F.regexp_count(said, F.lit(_WORD)).cast("long").alias("words"),
        ).alias("turn"),
    )
    rows = rows.withColumn("base", F.col("conv") - F.col("conv") % every).repartition("base")
    return rows.groupBy("base", "conv").agg(
        F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")
    )


def shared_starts(lists: DataFrame, most: int = 4) -> DataFrame:
    """``conv, turns`` with the first turns of each conversation taken from the conversation ``base``.

    Their number is the CRC-32 of the decimal id modulo ``most``; fewer if the base has fewer, none without it. At most
    ``every`` conversations have one base, so a group is small, and all steps use one shuffle.
    """
    start = F.max(F.when(F.col("conv") == F.col("base"), F.slice("turns", 1, most)))
    groups = lists.groupBy("base").agg(start.alias("start"), F.collect_list(F.struct("conv", "turns")).alias("members"))
    one = groups.select("start", F.inline("members"))
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    one = one.withColumn("n", taken.cast("int"))
    own = F.slice("turns", F.col("n") + 1, F.size("turns"))
    first = F.slice(F.coalesce("start", F.slice("turns", 1, 0)), F.lit(1), F.col("n"))
    return one.select("conv", F.concat(first, own).alias("turns"))


def _common(a: list[bytes], b: list[bytes]) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def neighbour_lcps(codes: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each sequence with the one before it; -1 for the first."""
    lcp = np.zeros(len(lens), np.int64)
    lcp[:1] = -1
    open_ = np.arange(1, len(lens))
    k = 0
    while len(open_):
        open_ = open_[np.minimum(lens[open_], lens[open_ - 1]) > k]
        open_ = open_[codes[starts[open_] + k] == codes[starts[open_ - 1] + k]]
        lcp[open_] = k = k + 1
    return lcp


class RangeMinimum:
    """A sparse table: minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each range, both ends included."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] + 1 - (1 << k)])
        return out

    def reach(self, at: np.ndarray, depth: np.ndarray, right: bool) -> np.ndarray:
        """Binary search: how far from each place all neighbours to one side share at least ``depth`` items."""
        n, at = len(self.levels[0]), at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            span, table = 1 << k, self.levels[k]
            room = at + span < n if right else at - span >= 0
            first = np.clip(at + 1 if right else at - span + 1, 0, len(table) - 1)
            at += np.where(room & (table[first] >= depth), span if right else -span, 0)
        return at


def range_nodes(rows: pd.DataFrame, before_keys: list[bytes] | None, after_keys: list[bytes] | None) -> pd.DataFrame:
    """Nodes of one sorted range, and the parts of the nodes that its neighbours share.

    Every prefix of every sequence that its left neighbour lacks is a candidate; it finds the extents of its members by
    two searches of its own. Over an interval of members all figures are differences of running sums, so those of a
    node that crosses ranges add up.
    """
    rows = rows.sort_values("place")
    n = len(rows)
    conv = rows.conv.to_numpy(np.int64)
    keys = [[bytes(k) for k in seq] for seq in rows["keys"]]
    lens = np.array([len(k) for k in keys], np.int64)
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    codes = pd.factorize(np.array([k for seq in keys for k in seq] + [b""], dtype=object))[0][:-1]
    words = np.concatenate([[0], *[np.asarray(w, np.int64) for w in rows.words]]).cumsum()
    spoken = lambda i, d: words[starts[i] + np.maximum(d, 0)] - words[starts[i]]

    lcp = neighbour_lcps(codes, starts, lens)
    before = -1 if before_keys is None else _common(before_keys, keys[0])
    after = -1 if after_keys is None else _common(keys[-1], after_keys)
    minima, least = RangeMinimum(lcp), RangeMinimum(conv)

    born = lens - lcp
    at = np.concatenate(([0], np.cumsum(born)))
    place = np.repeat(np.arange(n), born)
    depth = np.arange(at[-1]) - at[place] + lcp[place] + 1
    node = lambda i, d: at[i] + d - lcp[i] - 1
    last, parent = np.empty_like(place), np.empty_like(place)
    for a in range(0, len(place), BLOCK):
        b = a + BLOCK
        last[a:b] = minima.reach(place[a:b], depth[a:b], right=True)
        up = np.maximum(depth[a:b] - 1, 0)
        parent[a:b] = node(minima.reach(place[a:b], up, right=False), up)

    from_left = (place == 0) & (depth <= before)
    open_ = from_left | ((last == n - 1) & (depth <= after))
    children = np.bincount(parent[(depth > 0) & ~from_left], minlength=len(place))
    leaf_ends = np.concatenate(([0], np.cumsum(np.append(lcp[1:], after) < lens)))
    shared = np.where(np.arange(n) > 0, spoken(np.arange(n), lcp), 0).cumsum()
    saved = shared[last] - shared[place] - (last - place) * spoken(place, depth - 1)
    saved += np.where(from_left, spoken(0, before) - spoken(place, depth - 1), 0)
    # The members that end here stand first among a node's members.
    ends = np.bincount(node(minima.reach(np.arange(n), lens, right=False), lens), minlength=len(place))
    smallest = least.between(place, last)

    edge: dict[tuple[bool, int], bytes] = {}
    for side, seq, common in ((True, keys[0], before), (False, keys[-1], after)):
        running = hashlib.sha256()
        for d in range(common + 1):
            edge[side, d] = running.digest()
            running.update(seq[d] if d < len(seq) else b"")
    name = lambda k, d: edge[bool(from_left[k]), d]

    listed = lambda k, a=0, b=None: ",".join(map(str, conv[place[k] : place[k] + ends[k]][a:b].tolist()))
    upper = np.where(depth > 0, parent, -1)
    closed_parent = (upper >= 0) & ~open_[upper]
    table = pd.DataFrame(
        {
            "kind": open_.astype(np.int32),
            "part": np.int32(rows.part.iloc[0]),
            "seq": np.int64(0),
            "key": None,
            "parent_key": None,
            "conv_id": smallest,
            "depth": depth,
            "parent_conv_id": pd.array(np.where(closed_parent, smallest[upper], 0), "Int64"),
            "n_convs": last - place + 1,
            "n_children": children,
            "n_leaves": leaf_ends[last + 1] - leaf_ends[place],
            "saved_tokens": saved,
            "ends": [None if o else hashlib.sha256(listed(k).encode()).hexdigest() if e else _EMPTY for k, (o, e) in enumerate(zip(open_, ends, strict=True))],
        }
    )
    table.loc[~closed_parent, "parent_conv_id"] = pd.NA
    table["key"] = [name(k, d) if o else None for k, (o, d) in enumerate(zip(open_, depth.tolist(), strict=True))]
    table["parent_key"] = [
        name(u, d - 1) if u >= 0 and open_[u] else None for u, d in zip(upper.tolist(), depth.tolist(), strict=True)
    ]
    pieces = [
        {"kind": 2, "part": int(rows.part.iloc[0]), "seq": a, "key": name(k, int(depth[k])), "ends": listed(k, a, a + CHUNK_IDS)}
        for k in np.flatnonzero(open_ & (ends > 0)).tolist()
        for a in range(0, int(ends[k]), CHUNK_IDS)
    ]
    if pieces:
        more = pd.DataFrame(pieces).reindex(columns=table.columns)
        for c in _FIGURES:
            more[c], table[c] = more[c].astype("Int64"), table[c].astype("Int64")
        table = pd.concat([table, more], ignore_index=True)
    return table


def _hash_lists(pieces: DataFrame) -> DataFrame:
    """``key, ends``: digests of lists that come in ordered pieces. A list streams through a task; it is never held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, hashlib.sha256()
        for pdf in batches:
            done = []
            for k, text in zip(pdf["key"], pdf["ends"], strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, running.hexdigest()))
                    key, running = k, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(text.encode())
            yield pd.DataFrame(done, columns=["key", "ends"])
        if key is not None:
            yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "ends"])

    ordered = pieces.select("key", "part", "seq", "ends").repartition("key").sortWithinPartitions("key", "part", "seq")
    return ordered.mapInPandas(run, "key binary, ends string")


def prefix_trie(lists: DataFrame) -> DataFrame:
    """One row a node of the trie of all prefixes of ``turns`` in ``conv, turns``, the empty prefix (root) included.

    ``conv_id`` is a node's smallest member, ``parent_conv_id`` its parent's (NULL for the root), ``n_convs`` its
    members, ``n_children`` and ``n_leaves`` its children and the childless nodes of its subtree (itself included),
    ``saved_tokens`` the words that members of its subtree share beyond their first, ``ends_sha256`` the SHA-256 of the
    comma-joined ids of the members that end there.

    Conversations are sorted over the cluster by their turns, then id, and cut into ranges, so a common first turn or a
    conversation copied very often is dealt over many tasks. A range returns its own nodes, and one row for each prefix
    shared with a neighbouring range; those rows add up. Ids of one node's ends stream through one task in pieces.
    A conversation's digests (24 bytes a turn) must fit into one row, as Spark's sort keys do. A conversation without
    turns is a member of the root only. Equal conversations share all nodes. An empty table gives no node.
    """
    rows = stored(lists.select("conv", F.col("turns.digest").alias("keys"), F.col("turns.words").alias("words")), "trie-lists")
    size = rows.agg(F.sum(F.size("keys") + 1)).first()[0] or 0
    parts = parts_for(size, RANGE_TURNS, rows.sparkSession)
    ranged = rows.repartitionByRange(parts, "keys", "conv").sortWithinPartitions("keys", "conv")
    ranged = ranged.withColumn("place", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("part", F.shiftrightunsigned("place", 33).cast("int")), "trie-ranges")
    # One row a range: its neighbours' nearest sequences.
    ends = ranged.groupBy("part").agg(F.min_by("keys", "place").alias("first"), F.max_by("keys", "place").alias("last"))
    along = Window.orderBy("part")
    edges = ends.select("part", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))

    def nodes(key, left: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        near = [None if x is None else [bytes(k) for k in x] for x in (edge.before.iloc[0], edge.after.iloc[0])]
        return range_nodes(left, *near)

    found = stored(ranged.groupBy("part").cogroup(edges.groupBy("part")).applyInPandas(nodes, _OUT), "trie-nodes")
    shared = found.filter("kind = 1")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = stored(
        shared.groupBy("key").agg(F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *sums),
        "trie-shared",
    )
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    crossing = merged.join(names, "parent_key", "left").join(_hash_lists(found.filter("kind = 2")), "key", "left")
    # Many nodes may have one crossing parent; by range and parent the groups are no larger than a range.
    known = shared.select("part", F.col("key").alias("parent_key")).join(names, "parent_key")
    whole = found.filter("kind = 0").join(known, ["part", "parent_key"], "left")
    columns = [
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    ]
    crossing = crossing.withColumn("parent_conv_id", F.lit(None).cast("long"))
    return whole.select(*columns).unionByName(crossing.select(*columns))
