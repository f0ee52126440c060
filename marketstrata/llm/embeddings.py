"""Near-duplicate vectors through robust-pruned flat graphs over overlapping cluster shards."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.common import local_components
from marketstrata.llm.components import connected_components
from marketstrata.session import stored

log = logging.getLogger(__name__)

SHARD_ROWS = 1500
SAMPLE_PER_CENTRE = 24
MAX_CENTRES = 256
OVERLAP = 3
DEGREE = 24
AUDIT_QUERIES = 256
AUDIT_LINKS = 50  # true links of audited vectors from which a recall is judged
SLACK = 0.04  # so far below the threshold a search still expands
SEARCH_EDGES = 200_000
UNSEEN = -2.0  # in place of a cosine


def _units(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)


def _normalise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Usable vectors as unit doubles; those that link with nothing get NULL."""
    for pdf in batches:
        out = []
        for value in pdf.embedding:
            unit = None
            if value is not None and len(value):
                v = np.array([np.nan if x is None else x for x in value], dtype=np.float64)
                size = np.abs(v).max()
                if np.isfinite(v).all() and size > 0:
                    v = v / size
                    unit = v / np.sqrt(v @ v)
            out.append(unit)
        yield pd.DataFrame({"vec_id": pdf.vec_id, "label": pdf.label, "unit": pd.Series(out, index=pdf.index, dtype=object)})


def robust_prune(order: np.ndarray, near: np.ndarray, vectors: np.ndarray, degree: int, alpha: float = 1.2) -> list[list[int]]:
    """Out-neighbours of each row: nearest first, leaving out those that a kept neighbour is clearly closer to.

    ``order`` has candidates by falling cosine ``near``; -1 marks none.
    """
    rows, width = order.shape
    alive = order >= 0
    base = 1 - near  # half the squared distance of unit vectors
    chosen: list[list[int]] = [[] for _ in range(rows)]
    for w in range(width):
        pick = np.flatnonzero(alive[:, w])
        pick = pick[[len(chosen[r]) < degree for r in pick.tolist()]] if len(pick) else pick
        if not len(pick):
            continue
        for r in pick.tolist():
            chosen[r].append(int(order[r, w]))
        if w + 1 < width:
            rest = vectors[order[pick, w + 1 :]]
            gap = 1 - np.einsum("rwd,rd->rw", rest, vectors[order[pick, w]])
            alive[pick, w + 1 :] &= alpha * gap > base[pick, w + 1 :]
    return chosen


def build_graph(vectors: np.ndarray, degree: int = DEGREE, pool: int = 48) -> list[list[int]]:
    """A flat graph over the vectors of one shard, with reverse edges so that all nodes can be reached."""
    n = len(vectors)
    pool = min(pool, n)
    edges: list[set[int]] = [set() for _ in range(n)]
    for at in range(0, n, 512):
        sims = vectors[at : at + 512] @ vectors.T
        order = np.argpartition(-sims, pool - 1, axis=1)[:, :pool] if pool < n else np.tile(np.arange(n), (len(sims), 1))
        near = np.take_along_axis(sims, order, 1)
        rank = np.argsort(-near, axis=1, kind="stable")
        order, near = np.take_along_axis(order, rank, 1), np.take_along_axis(near, rank, 1)
        order[order == np.arange(at, at + len(sims))[:, None]] = -1
        for r, out in enumerate(robust_prune(order, near, vectors, degree), at):
            edges[r].update(out)
    for r in range(n):
        for t in list(edges[r]):
            edges[t].add(r)
    return [sorted(e) for e in edges]


def entry_points(vectors: np.ndarray, degrees: np.ndarray, links: np.ndarray, near: float) -> np.ndarray:
    """The middle of every connected part of the graph, and of every part of two or more that its edges of cosine >= ``near`` form."""
    n = len(vectors)
    a, b = np.repeat(np.arange(n), degrees), links
    close = np.zeros(len(a), bool)
    for at in range(0, len(a), 20_000):
        close[at : at + 20_000] = np.einsum("pd,pd->p", vectors[a[at : at + 20_000]], vectors[b[at : at + 20_000]]) >= near
    entries = []
    for least, keep in ((1, np.ones(len(a), bool)), (2, close)):
        part = local_components(n, a[keep], b[keep])
        sums = np.zeros_like(vectors)
        np.add.at(sums, part, vectors)
        order = np.lexsort((np.einsum("nd,nd->n", vectors, sums[part]), part))
        last = np.concatenate((part[order][1:] != part[order][:-1], [True]))
        middle = order[last]
        entries.append(middle[np.bincount(part, minlength=n)[part[middle]] >= least])
    return np.unique(np.concatenate(entries))


def range_search(
    vectors: np.ndarray, degrees: np.ndarray, links: np.ndarray, medoids: np.ndarray, queries: np.ndarray, own: np.ndarray, threshold: float, beam: int = 24, slack: float = SLACK
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(query, node)`` pairs of cosine >= ``threshold``, by greedy search that widens once it is in range.

    ``links`` has the neighbours of all nodes one after the other, ``degrees`` how many each has. Each query walks from the medoids, and from its
    node ``own`` where that is not -1, to its best ``beam`` nodes; then every node within ``threshold - slack`` is expanded until none is new, so the number
    of results has no bound. Every reported pair has been compared in double precision. ``SEARCH_EDGES`` edges are followed at a time,
    so a node of very many neighbours costs no memory.
    """
    n = len(vectors)
    starts = np.cumsum(degrees) - degrees
    block = max(16, min(512, 2_000_000 // max(n, 1)))
    for at in range(0, len(queries), block):
        q = queries[at : at + block]
        rows = np.arange(len(q))
        sims = np.full((len(q), n), UNSEEN)
        sims[:, medoids] = q @ vectors[medoids].T
        open_ = np.zeros((len(q), n), bool)
        open_[:, medoids] = True
        self = np.flatnonzero(own[at : at + block] >= 0)
        node = own[at : at + block][self]
        sims[self, node] = np.einsum("pd,pd->p", q[self], vectors[node])
        open_[self, node] = True
        while True:
            # Greedy part: the best beam of all seen nodes; range part: everything near the threshold.
            floor = np.partition(sims, max(0, n - beam), axis=1)[:, max(0, n - beam)]
            expand = open_ & (sims >= np.minimum(floor, threshold - slack)[:, None])
            i, u = np.nonzero(expand)
            if not len(i):
                break
            open_[expand] = False
            steps = np.cumsum(degrees[u])
            part = 0
            while part < len(i):
                stop = max(part + 1, int(np.searchsorted(steps, (steps[part - 1] if part else 0) + SEARCH_EDGES, side="right")))
                ii, uu = i[part:stop], u[part:stop]
                out = degrees[uu]
                v = links[np.arange(out.sum()) + np.repeat(starts[uu] - (np.cumsum(out) - out), out)]
                open_[np.repeat(ii, out), v] |= sims[np.repeat(ii, out), v] == UNSEEN
                part = stop
            # An open node without a cosine is new in this round, however many neighbours led to it.
            qi, v = np.nonzero(open_ & (sims == UNSEEN))
            for part in range(0, len(qi), 20_000):
                qq, vv = qi[part : part + 20_000], v[part : part + 20_000]
                sims[qq, vv] = np.einsum("pd,pd->p", q[qq], vectors[vv])
        i, v = np.nonzero(sims >= threshold)
        yield rows[i] + at, v


def _centres(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spherical k-means on one class's bounded sample."""
    pdf = pdf.sort_values("vec_id")
    points, k = _units(pdf.unit), int(pdf.k.iloc[0])
    rng = np.random.default_rng(7)
    centres = points[rng.permutation(len(points))[: min(k, len(points))]]
    for _ in range(8):
        owner = np.argmax(points @ centres.T, axis=1)
        for c in range(len(centres)):
            mine = points[owner == c]
            if len(mine):
                total = mine.sum(axis=0)
                centres[c] = total / max(np.sqrt(total @ total), 1e-12)
    return pd.DataFrame({"group": pdf.group.iloc[0], "centre": range(len(centres)), "unit": list(centres)})


def link_vectors(vectors: DataFrame, threshold: float = 0.98) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)`` of a table with ``vec_id``, ``embedding`` and ``label``.

    ``rows`` has ``vec_id, rep``: equal vectors of one label share a representative. ``links`` has
    ``rep, n, edge``: over all blocks of a vector the copies-weighted count ``n`` of the other representatives
    linked with it, and ``edge``, representatives that connect its component.

    Each label is clustered on a bounded sample (``SAMPLE_PER_CENTRE`` vectors a centre, at most
    ``MAX_CENTRES`` centres); every vector enters the ``OVERLAP`` nearest shards. A shard beyond ``SHARD_ROWS``
    is dealt into pieces by hash. A graph is built on every piece, a vector's adjacency lists are united over
    its shards, and all vectors of a shard search each of its pieces, so no piece is skipped and no hot
    label or hot cluster meets in one task. A search enters at its own vector and at every part of the graph. A pair is counted in the least shard both are in.
    """
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = stored(
        kept.mapInPandas(_normalise, "vec_id long, label string, unit array<double>").withColumn(
            "group",
            F.when(F.col("unit").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.concat_ws(":", F.size("unit"), "label")),
        ),
        "units",
    )
    usable = units.filter("group IS NOT NULL")
    reps = stored(usable.groupBy("group", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    rows = units.join(reps.select("group", "unit", "rep", "copies"), ["group", "unit"], "left").select("vec_id", "rep", "copies")

    sizes = reps.groupBy("group").agg(F.count("*").alias("size"))
    sizes = sizes.select(
        "group",
        F.least(F.lit(MAX_CENTRES), F.ceil(F.col("size") / (SHARD_ROWS / OVERLAP))).cast("int").alias("k"),
        F.ceil(F.col("size") / 4096).cast("int").alias("salts"),
        "size",
    )
    # About SAMPLE_PER_CENTRE vectors a centre, chosen by hash; the expected number is bounded for each label.
    sample = (
        reps.join(sizes, "group")
        .filter(F.pmod(F.xxhash64("rep"), F.lit(1_000_003)) < F.col("k") * F.lit(float(SAMPLE_PER_CENTRE * 1_000_003)) / F.col("size") + 1)
        .select("group", F.col("rep").alias("vec_id"), "unit", "k")
    )
    centres = stored(sample.groupBy("group").applyInPandas(_centres, "group string, centre int, unit array<double>"), "centres")
    salted = reps.join(sizes, "group").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int"))
    spread = centres.join(sizes, "group").select("group", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "centre", "unit")

    def assign(points: pd.DataFrame, mids: pd.DataFrame) -> pd.DataFrame:
        columns = ["group", "shards", "rep", "copies", "unit"]
        if not len(points):
            return pd.DataFrame(columns=columns)
        mids = mids.sort_values("centre")
        if len(mids):
            sims = _units(points.unit) @ _units(mids.unit).T
            wide = min(OVERLAP, sims.shape[1])
            near = np.argpartition(-sims, wide - 1, axis=1)[:, :wide] if wide < sims.shape[1] else np.tile(np.arange(wide), (len(sims), 1))
        else:
            near = np.zeros((len(points), 1), int)  # no sampled vector: the label is one shard
        points = points.assign(shards=[sorted(map(int, x)) for x in near])
        return points[columns]

    placed = stored(
        salted.groupBy("group", "salt").cogroup(spread.groupBy("group", "salt")).applyInPandas(
            assign, "group string, shards array<int>, rep long, copies long, unit array<double>"
        ),
        "placed",
    )
    members = placed.select("group", F.explode("shards").alias("shard"), "shards", "rep", "copies", "unit")
    pieces = members.groupBy("group", "shard").agg(F.ceil(F.count("*") / (2 * SHARD_ROWS)).cast("int").alias("pieces"))
    members = members.join(pieces, ["group", "shard"]).withColumn("piece", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("pieces")).cast("int"))

    def lists(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep").reset_index(drop=True)
        names = pdf.rep.to_numpy()
        graph = build_graph(_units(pdf.unit))
        return pd.DataFrame({"rep": names, "links": [names[e] for e in graph]})

    keys = ["group", "shard", "piece"]
    graphs = members.groupBy(*keys).applyInPandas(lists, "rep long, links array<long>")
    united = stored(graphs.groupBy("rep").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("links")))).alias("links")), "graph")
    nodes = members.join(united, "rep")
    nodes = nodes.toDF(*nodes.columns)  # own column identities: both sides of the cogroup come from one table
    asked = members.select("group", "shard", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "rep", "shards", "unit")
    asked = asked.toDF(*asked.columns)

    def search(node: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(node) or not len(ask):
            return pd.DataFrame({"rep": [], "n": [], "edge": []})
        node = node.sort_values("rep").reset_index(drop=True)
        names, points = node.rep.to_numpy(), _units(node.unit)
        shard = int(node["shard"].iloc[0])
        # Of the united lists the neighbours in this piece.
        owners, whole = np.repeat(np.arange(len(node)), node.links.map(len)), np.concatenate(node.links.to_numpy()).astype(np.int64)
        at = np.minimum(np.searchsorted(names, whole), len(names) - 1)
        inside = names[at] == whole
        degrees, links = np.bincount(owners[inside], minlength=len(node)), at[inside]
        centre = points.sum(axis=0)
        medoid = int(np.argmax(points @ centre))
        # Spread entry points: the medoid, and the nodes farthest from those chosen before.
        entries, gap = [medoid], points @ points[medoid]
        for _ in range(min(15, len(points) - 1)):
            entries.append(int(np.argmin(gap)))
            gap = np.maximum(gap, points @ points[entries[-1]])
        copies = node.copies.to_numpy()
        sets = np.full((len(node), OVERLAP), -1)
        for r, s in enumerate(node.shards):
            sets[r, : len(s)] = s
        ask = ask.sort_values("rep").reset_index(drop=True)
        own = np.full((len(ask), OVERLAP), -2)
        for r, s in enumerate(ask.shards):
            own[r, : len(s)] = s
        every = np.unique(np.concatenate((names, ask.rep.to_numpy())))
        home = np.minimum(np.searchsorted(names, ask.rep.to_numpy()), len(names) - 1)
        home = np.where(names[home] == ask.rep.to_numpy(), home, -1)
        entries = np.union1d(entries, entry_points(points, degrees, links, threshold - SLACK))
        of_node, of_ask = np.searchsorted(every, names), np.searchsorted(every, ask.rep.to_numpy())
        count, root = np.zeros(len(ask), np.int64), np.arange(len(every))
        for q, v in range_search(points, degrees, links, entries, _units(ask.unit), home, threshold):
            other = ask.rep.to_numpy()[q] != names[v]
            q, v = q[other], v[other]
            both = (own[q][:, :, None] == sets[v][:, None, :]).any(axis=2)
            first = np.where(both, own[q], np.iinfo(np.int64).max).min(axis=1) == shard
            np.add.at(count, q[first], copies[v[first]])
            root = local_components(len(every), np.concatenate((root[of_ask[q]], np.arange(len(every)))), np.concatenate((root[of_node[v]], root)))
        return pd.DataFrame({"rep": ask.rep, "n": count, "edge": every[root[of_ask]]})

    found = nodes.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "rep long, n long, edge long")
    return rows, stored(found, "vector-links")


def audit_links(vectors: DataFrame, rows: DataFrame, threshold: float, queries: int = AUDIT_QUERIES) -> DataFrame:
    """``(vec_id, audit_links)``: true link counts of at most ``queries`` vectors, by comparing them with all rows.

    Of rows that repeat a ``vec_id`` one is asked, and the others are vectors it can link with.
    """
    chosen = (
        vectors.join(rows.filter("rep IS NOT NULL").select("vec_id"), "vec_id", "left_semi")
        .select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>").alias("embedding"))
        .orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id")
        .limit(queries)
        .toPandas()
    )
    asked = next(_normalise(iter([chosen]))) if len(chosen) else chosen
    if len(asked):
        asked = asked[asked.unit.notna() & asked.label.notna()].drop_duplicates("vec_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, int] = {}
        for pdf in _normalise(batches):
            pdf = pdf[pdf.unit.notna() & pdf.label.notna() & pdf.vec_id.notna()]
            for (label, wide), ask in (asked.groupby(["label", asked.unit.map(len)]) if len(asked) else ()):
                mine = pdf[(pdf.label == label) & (pdf.unit.map(len) == wide)] if len(pdf) else pdf
                if len(mine):
                    hits = _units(ask.unit) @ _units(mine.unit).T >= threshold
                    for name, n in zip(ask.vec_id, hits.sum(axis=1), strict=True):
                        total[name] = total.get(name, 0) + int(n)
        yield pd.DataFrame({"vec_id": pd.Series(list(total), dtype="int64"), "n": pd.Series(list(total.values()), dtype="int64")})

    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    # Every asked vector has met itself once.
    return kept.mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg(F.greatest(F.sum("n") - 1, F.lit(0)).alias("audit_links"))


def require_recall(found: DataFrame, least: float, enough: int = AUDIT_LINKS) -> float | None:
    """Recall of the audited vectors of ``near_vectors``: the share of their true links that was found, NULL if they have none.

    ``ValueError`` where it is below ``least``; fewer than ``enough`` true links are too few for that verdict and are only logged.
    """
    seen = found.filter("audit_links is not null").agg(F.sum(F.least("n_links", "audit_links")).alias("found"), F.sum("audit_links").alias("true")).first()
    if not seen["true"]:
        return None
    recall = seen["found"] / seen["true"]
    log.info("recall of links: %.4f of %d", recall, seen["true"])
    if recall < least:
        lost = f"{seen['found']} of {seen['true']} audited links were found, below {least}"
        if seen["true"] >= enough:
            raise ValueError(lost)
        log.warning("%s", lost)
    return recall


def near_vectors(vectors: DataFrame, threshold: float = 0.98, audit: bool = True) -> DataFrame:
    """One row a vector: ``vec_id, n_links, component_id, kept`` and, with ``audit``, ``audit_links`` of audited vectors.

    Vectors are compared only within equal non-NULL labels and lengths. A vector that is NULL, empty, zero, or
    holds NULL or non-finite components links with nothing and is its own component; a NULL id likewise, with
    a NULL component, and is kept. Rows that repeat a ``vec_id`` are separate vectors that share its component.
    Recall is measured on a bounded sample against brute force and returned, never used to change a result. Other
    columns are not read, whatever their names. An empty table gives an empty one.
    """
    rows, links = link_vectors(vectors, threshold)
    totals = links.groupBy("rep").agg(F.sum("n").alias("others"))
    groups = connected_components(links.select(F.col("rep").alias("src"), F.col("edge").alias("dst")))
    # The representative is the least id of its copies, so the least representative is the least id.
    joined = rows.join(totals, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
    if audit:
        joined = joined.join(audit_links(vectors, rows, threshold), "vec_id", "left")
    component = F.coalesce("component", "rep", "vec_id")
    return joined.select(
        "vec_id",
        F.when(F.col("rep").isNotNull(), F.coalesce("others", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
        *(["audit_links"] if audit else []),
    )
