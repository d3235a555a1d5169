"""Parent-child rows to full hierarchies: roots, depths, paths, descendants, cycles.

Trees are ranked where their rows lie together. A slim first pass (64-bit ids
only) groups the rows by their ``group`` column, cutting large groups into
chunks, and finds which trees cross a chunk border; those few trees get a common
label through pointer doubling over chunk-local tops. The second pass moves the
full rows by label and, in each task, peels leaves until only cycles remain,
threads an Euler tour through the rest and ranks it by pointer jumping over
numpy arrays. Trees larger than ``task_rows`` never meet in one task: they are
ranked by the same two steps (peeling through doubling, list ranking by pointer
jumping) as joins over their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.runtime import checked_broadcast, materialize, partitions_for

SEP = " > "
#: state of a node: in a tree; on a cycle; leading into a cycle; its parent is missing; below such a node
STATES = ("tree", "cycle", "below_cycle", "orphan", "below_orphan")
TREE, CYCLE, BELOW_CYCLE, ORPHAN, BELOW_ORPHAN = range(5)


def parent_of(col: Column) -> Column:
    """The parent id; null for a root (null or empty text)."""
    return F.nullif(col, F.lit(""))


def latest(df: DataFrame, key: str, at: str, keep: list[str]) -> DataFrame:
    """The row with the greatest ``at`` of each key; of equal times the greatest kept columns."""
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.struct(F.col(at).alias("at"), *cols)).alias("m"))
        .select("id", *[F.col(f"m.c{i}").alias(c) for i, c in enumerate(keep)])
    )


# ---------------------------------------------------------------- arrays

def peel(parent: np.ndarray) -> np.ndarray:
    """True for nodes on a cycle. ``parent``: position of the parent, -1 for none."""
    n = len(parent)
    alive = np.ones(n, dtype=bool)
    has = parent >= 0
    kids = np.bincount(parent[has], minlength=n)
    leaves = np.flatnonzero(kids == 0)
    while len(leaves):
        alive[leaves] = False
        up = parent[leaves]
        up = up[up >= 0]
        if not len(up):
            break
        np.subtract.at(kids, up, 1)
        up = np.unique(up)
        leaves = up[kids[up] == 0]
    # what peeling leaves over: cycles and the chains from them to nowhere cannot exist, as each node has one parent
    return alive & has


def cycle_least(parent: np.ndarray, on: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For nodes on a cycle the node of least ``order`` on it (pointer doubling), else -1."""
    out = np.full(len(parent), -1)
    at = np.flatnonzero(on)
    if len(at):
        local = np.full(len(parent), -1)
        local[at] = np.arange(len(at))
        jump, best = local[parent[at]], at.copy()
        span = 1
        while span < len(at):
            other = best[jump]
            best = np.where(order[other] < order[best], other, best)
            jump, span = jump[jump], span * 2
        other = best[jump]
        out[at] = np.where(order[other] < order[best], other, best)
    return out


def euler(parent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(entry, exit, depth, root)`` of a forest; children in the order of ``rank``.

    Elements 2v (entry) and 2v + 1 (exit) form one list a tree; the list is
    ranked by pointer jumping, log2(2n) rounds over whole arrays. Entry and exit
    count from 0 in each tree; the sums of +1 and -1 along the list give depths.
    """
    n = len(parent)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z
    by = np.lexsort((rank, parent))
    grouped = parent[by]
    first = np.ones(n, dtype=bool)
    first[1:] = grouped[1:] != grouped[:-1]
    nxt = np.full(2 * n, -1, dtype=np.int64)
    nxt[0::2] = np.arange(n) * 2 + 1  # a leaf's entry leads to its exit
    child = first & (grouped >= 0)
    nxt[grouped[child] * 2] = by[child] * 2
    sibling = np.flatnonzero(~first & (grouped >= 0))
    nxt[by[sibling - 1] * 2 + 1] = by[sibling] * 2
    last = np.ones(n, dtype=bool)
    last[:-1] = grouped[1:] != grouped[:-1]
    ends = last & (grouped >= 0)
    nxt[by[ends] * 2 + 1] = grouped[ends] * 2 + 1
    # distance to the end of the list, the number of levels still to close, and the end itself
    stop = nxt < 0
    jump = np.where(stop, np.arange(2 * n), nxt)
    left = np.where(stop, 0, 1)
    level = np.where(np.arange(2 * n) % 2 == 0, 1, -1)
    level[stop] = 0
    while True:
        far = jump[jump]
        if np.array_equal(far, jump):
            break
        left, level, jump = left + left[jump], level + level[jump], far
    root = jump // 2
    size = left[root * 2]
    entry, out = size[0::2] - left[0::2], size[1::2] - left[1::2]
    # the list from v's entry closes all levels down to the root's exit
    depth = 1 - level[1::2]
    return entry, out, depth, root[0::2]


def resolve_block(ids: np.ndarray, parents: np.ndarray, rank: np.ndarray) -> dict[str, np.ndarray]:
    """All of a block's trees: state, top node, depth, entry, exit of each row (positions, -1 for none)."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    index = pd.Index(ids)
    named = ~pd.isna(parents)
    parent = np.full(n, -1, dtype=np.int64)
    if named.any():
        parent[named] = index.get_indexer(parents[named])
    on = peel(parent)
    least = cycle_least(parent, on, place)
    # cut cycles: their nodes become tops of the forest that hangs on them
    cut = np.where(on, -1, parent)
    entry, out, depth, top = euler(cut, np.lexsort((place, rank)).argsort())
    state = np.full(n, TREE)
    lost = named & (parent < 0)
    state[lost[top]] = BELOW_ORPHAN
    state[lost] = ORPHAN
    below = on[top]
    state[below] = BELOW_CYCLE
    state[on] = CYCLE
    anchor = np.where(below, least[top], top)
    return {"state": state, "anchor": anchor, "top": top, "depth": depth, "entry": entry, "exit": out, "parent": parent}


def paths(titles: np.ndarray, entry: np.ndarray, depth: np.ndarray, top: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Path texts of the wanted rows, along the tour; null titles count as empty text."""
    out = np.full(len(titles), None, dtype=object)
    stack: list[str] = []
    for v in np.lexsort((entry, top)):
        del stack[depth[v] - 1 :]
        stack.append(titles[v] or "")
        if wanted[v]:
            out[v] = SEP.join(stack)
    return out


# ---------------------------------------------------------------- blocks

def _tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunk-local tops of slim rows: each row's top and that top's missing parent, if it names one."""
    parts = list(batches)
    if parts:
        pdf = pd.concat(parts, ignore_index=True)
        ids = pdf["i"].to_numpy()
        named, up = pdf["named"].to_numpy(), pdf["p"].to_numpy()
        parent = np.full(len(ids), -1, dtype=np.int64)
        parent[named] = pd.Index(ids).get_indexer(up[named])
        jump = np.where(parent < 0, np.arange(len(ids)), parent)
        for _ in range(int(len(ids)).bit_length() + 1):
            far = jump[jump]
            if np.array_equal(far, jump):
                break
            jump = far
        # on local cycles the doubling ends on a node of the cycle; its least id stands for all
        on = peel(parent)
        least = cycle_least(parent, on, ids)
        top = np.where(on[jump], least[jump], jump)
        away = (parent < 0) & named
        yield pd.DataFrame({"i": ids, "top": ids[top], "up": up[top], "away": away[top]})


class Blocks:
    """Where each row's tree is resolved: first by group (large groups in chunks), then by the tree's label."""

    def __init__(self, slim: DataFrame, task_rows: int):
        """``slim``: ``i`` (id), ``p`` (parent or null), ``g`` (group), ``o`` (order in the group), one row a node."""
        spark = slim.sparkSession
        slim = materialize(slim, "slim")
        self.rows, self.task_rows = slim.count(), task_rows
        self.parts = partitions_for(self.rows, task_rows, spark)
        # at most rows / task_rows groups are large; the list is broadcast while it is short
        self.large = checked_broadcast(slim.groupBy("g").count().where(F.col("count") > task_rows).select("g", F.lit(True).alias("large")))
        # a chunk holds task_rows consecutive orders; where orders repeat, a chunk is cut further by id
        chunk = slim.join(self.large, "g").groupBy("g", self._chunk().alias("s")).count()
        self.dense = checked_broadcast(chunk.where(F.col("count") > 2 * task_rows).select("g", "s", F.ceil(F.col("count") / task_rows).alias("cuts")))
        placed = self.assign(slim).repartition(self.parts, "b")
        self.tops = materialize(placed.select("i", F.coalesce("p", F.lit(0)).alias("p"), F.col("p").isNotNull().alias("named")).mapInPandas(_tops, "i long, top long, up long, away boolean"), "tops")
        self.labels, self.giant = self._labels(), None
        if self.labels is not None:
            huge = self.labels.groupBy("label").count().where(F.col("count") > task_rows).select("label")
            giant = materialize(self.labels.join(checked_broadcast(huge), "label").select("i", "label"), "giant")
            self.giant = None if giant.isEmpty() else giant

    def _chunk(self) -> Column:
        return F.floor(F.col("o") / self.task_rows)

    def assign(self, rows: DataFrame) -> DataFrame:
        """Adds the block ``b`` to rows with ``i``, ``g`` and ``o``."""
        found = rows.withColumn("s", self._chunk()).join(self.large, "g", "left").join(self.dense, ["g", "s"], "left")
        chunk = F.xxhash64("g", "s", F.when(F.col("cuts").isNotNull(), F.pmod(F.col("i"), F.col("cuts"))))
        return found.withColumn("b", F.when(F.col("large"), chunk).otherwise(F.xxhash64("g"))).drop("s", "large", "cuts")

    def _labels(self) -> DataFrame | None:
        """``(i, label)`` of the rows of trees that cross blocks; None if no tree does."""
        tops = self.tops
        away = tops.where("away and i = top").select("top", "up")
        # parents that exist, but in another block
        links = materialize(away.join(tops.select(F.col("i").alias("up"), F.col("top").alias("to")), "up").select("top", "to"), "links")
        if links.isEmpty():
            return None
        ends = links.select(F.col("to").alias("top")).distinct().join(links, "top", "left_anti").select("top", F.col("top").alias("to"))
        state = double(links.select("top", "to").union(ends).withColumn("least", F.least("top", "to")), "top", "to", {"least": lambda a, b: F.least(a, b)})
        # a final top points to itself; on a cycle of tops the least one passed stands for all
        least = state.select(F.col("top").alias("to"), F.col("least").alias("on"))
        label = state.join(ends.select("to", F.lit(True).alias("final")), "to", "left").join(least, "to")
        label = label.select("top", F.when(F.col("final"), F.col("to")).otherwise(F.col("on")).alias("label"))
        return materialize(tops.join(label, "top").select("i", "label"), "labels")


def double(state: DataFrame, key: str, to: str, fold: dict) -> DataFrame:
    """Pointer jumping: after the loop ``to`` is as many steps away as there are rows, or null (ended).

    ``fold`` combines each further column of a row with that of the row it points to.
    """
    state = materialize(state, "jump")
    count, span = state.count(), 1
    while span < count:
        far = state.select(F.col(key).alias(to), F.col(to).alias("_to"), *[F.col(c).alias(f"_{c}") for c in fold])
        open_rows = state.where(F.col(to).isNotNull()).join(far, to)
        moved = open_rows.select(key, F.col("_to").alias(to), *[f(F.col(c), F.col(f"_{c}")).alias(c) for c, f in fold.items()])
        state = materialize(moved.unionByName(state.where(F.col(to).isNull())), "jump")
        span *= 2
        if state.where(F.col(to).isNotNull()).isEmpty():
            break
    return state


def _resolved(pdf: pd.DataFrame, all_paths: bool) -> pd.DataFrame:
    """The rows of one task, which hold whole trees."""
    ids, parents = pdf["id"].to_numpy(dtype=object), pdf["parent"].to_numpy(dtype=object)
    r = resolve_block(ids, parents, pdf["o"].to_numpy())
    tree, depth = r["state"] == TREE, r["depth"]
    titles = pdf["title"].fillna("").to_numpy(dtype=object)
    old = pdf["old_path"]
    given = old.notna().to_numpy()
    lengths = _path_lengths(np.fromiter(map(len, titles), dtype=np.int64, count=len(titles)), r)
    same = given & tree & (old.str.len().fillna(-1).to_numpy() == lengths)
    # a path of another length differs; only the others are built and compared
    made = paths(titles, r["entry"], depth, r["top"], (tree if all_paths else same))
    equal = same.copy()
    equal[same] = made[same] == old.to_numpy(dtype=object)[same]
    anchor = ids[r["anchor"]]
    lost = r["state"] == ORPHAN
    anchor[lost] = parents[lost]
    old_depth = pdf["old_depth"]
    return pd.DataFrame({
        "id": ids, "parent": parents, "depth": pd.array(depth, dtype="Int64").copy(), "root": np.where(tree, anchor, None), "state": r["state"].astype(np.int32), "anchor": anchor,
        "path": made if all_paths else None, "entry": r["entry"], "exit": r["exit"], "n_descendants": (r["exit"] - r["entry"]) // 2,
        "depth_differs": tree & old_depth.notna().to_numpy() & (old_depth.fillna(-1).to_numpy() != depth), "path_differs": given & tree & ~equal,
    })


def _path_lengths(size: np.ndarray, r: dict[str, np.ndarray]) -> np.ndarray:
    """Length of each row's path text: sums over ancestors by pointer doubling."""
    parent = np.where(r["state"] == CYCLE, -1, r["parent"])
    total, at = size.astype(np.int64), parent
    while (at >= 0).any():
        live = at >= 0
        total = total + np.where(live, total[at], 0)
        at = np.where(live, at[at], -1)
    return total + len(SEP) * (r["depth"] - 1)


#: moduli and base of the rolling hashes that compare path texts of giant trees; products stay below 2 ** 63
_MODULI, _BASE = (2_147_483_647, 2_147_483_629), 1_000_003


def _rolled(text: Column, modulus: int) -> Column:
    """``struct(h, p)``: polynomial hash of a text's characters and the base to its length."""
    step = lambda acc, c: F.struct(((acc["h"] * _BASE + F.ascii(c).cast("long")) % modulus).alias("h"), (acc["p"] * _BASE % modulus).alias("p"))
    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(1).cast("long").alias("p"))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step)


def _joined(above: Column, below: Column, modulus: int) -> Column:
    """The hash of two texts one after the other."""
    return F.struct(((above["h"] * below["p"] + below["h"]) % modulus).alias("h"), (above["p"] * below["p"] % modulus).alias("p"))


def _giant(nodes: DataFrame, all_paths: bool) -> DataFrame:
    """Trees too large for a task: the same results from joins over their rows alone.

    Nodes are told apart first, with pointers of fixed size; only what lies in trees is then
    folded into path texts, so a cycle folds nothing. Where no path is asked for, stored paths
    are compared by length and two rolling hashes, and no text longer than a stored one is made.
    """
    nodes = materialize(nodes, "giant")
    known = nodes.select(F.col("i").alias("to"), F.lit(True).alias("there"))
    start = nodes.withColumn("to", F.when(F.col("parent").isNotNull(), F.xxhash64("parent"))).join(known, "to", "left").withColumn("to", F.when(F.col("there"), F.col("to")))
    start = materialize(start.select("i", "to", F.col("id"), F.coalesce("parent", F.lit("")).alias("lost"), F.coalesce("title", F.lit("")).alias("title")), "giant")
    state = double(
        start.select("i", "to", F.lit(1).cast("long").alias("depth"), F.col("id").alias("least"), F.struct("id", "lost").alias("top")),
        "i", "to", {"depth": lambda a, b: a + b, "least": lambda a, b: F.least(a, b), "top": lambda a, b: b},
    )
    landed = state.where("to is not null").select(F.col("to").alias("i")).distinct().withColumn("on", F.lit(True))
    cycle = state.join(landed, "i", "left").withColumn("on", F.coalesce("on", F.lit(False)))
    base = cycle.select(F.col("i").alias("to"), F.col("least").alias("on_least"))
    ends = cycle.join(base, "to", "left").select("i", "to", "depth", "top", "on", "on_least")
    full = nodes.select("i", "id", "parent", "old_depth", "old_path", "o").join(ends, "i")
    lost = F.col("top.lost") != ""
    kind = F.when(F.col("on"), CYCLE).when(F.col("to").isNotNull(), BELOW_CYCLE).when(lost & (F.col("top.id") == F.col("id")), ORPHAN).when(lost, BELOW_ORPHAN).otherwise(TREE)
    full = materialize(full.withColumn("state", kind), "giant")
    tree = F.col("state") == TREE
    # trees alone go on: every node of a tree has its parent in it
    grown = start.join(full.where(tree).select("i"), "i", "left_semi")
    if all_paths:
        join = lambda a, b: F.concat(b, F.lit(SEP), a)
        told = double(grown.select("i", "to", F.col("title").alias("path")), "i", "to", {"path": join}).select("i", "path")
    else:
        first, second = _MODULI
        own = F.when(F.col("to").isNull(), F.col("title")).otherwise(F.concat(F.lit(SEP), "title"))
        rolled = grown.select("i", "to", F.length(own).cast("long").alias("size"), _rolled(own, first).alias("r1"), _rolled(own, second).alias("r2"))
        told = double(rolled, "i", "to", {"size": lambda a, b: a + b, "r1": lambda a, b: _joined(b, a, first), "r2": lambda a, b: _joined(b, a, second)}).select("i", "size", "r1", "r2")
    full = full.join(told, "i", "left")
    if all_paths:
        same = F.col("old_path") == F.col("path")
    else:
        alike = F.length("old_path") == F.col("size")
        stored = F.when(alike, F.col("old_path"))
        same = alike & (_rolled(stored, _MODULI[0])["h"] == F.col("r1.h")) & (_rolled(stored, _MODULI[1])["h"] == F.col("r2.h"))
    anchor = F.when(F.col("state").isin(CYCLE, BELOW_CYCLE), F.col("on_least")).when(F.col("state") == ORPHAN, F.col("parent")).otherwise(F.col("top.id"))
    tour = _ranked(full.select("i", "id", "o", F.when(F.col("state") != CYCLE, F.col("parent")).alias("parent")))
    return full.join(tour, "i", "left").select(
        "id", "parent", "depth", F.when(tree, anchor).alias("root"), F.col("state").cast("int").alias("state"), anchor.alias("anchor"),
        (F.when(tree, F.col("path")) if all_paths else F.lit(None).cast("string")).alias("path"), "entry", "exit", F.floor((F.col("exit") - F.col("entry")) / 2).alias("n_descendants"),
        (tree & F.coalesce(F.col("old_depth") != F.col("depth"), F.lit(False))).alias("depth_differs"), (tree & F.col("old_path").isNotNull() & ~F.coalesce(same, F.lit(False))).alias("path_differs"),
    )


def _ranked(nodes: DataFrame) -> DataFrame:
    """``(i, entry, exit)``: the Euler tour as a linked list of rows, ranked by pointer jumping."""
    from pyspark.sql.window import Window

    up = F.when(F.col("parent").isNotNull(), F.xxhash64("parent"))
    named = nodes.select("i", "id", "o", up.alias("p"))
    there = named.select(F.col("i").alias("p"), F.lit(True).alias("there"))
    named = named.join(there, "p", "left").withColumn("p", F.when(F.col("there"), F.col("p")))
    kids = named.where("p is not null")
    w = Window.partitionBy("p").orderBy("o", "id")
    next_of = kids.select("i", F.lead("i").over(w).alias("sibling"))
    first = kids.groupBy("p").agg(F.min(F.struct("o", "id", "i")).alias("f")).select(F.col("p").alias("i"), F.col("f.i").alias("child"))
    wide = named.select("i", "p").join(next_of, "i", "left").join(first, "i", "left")
    item = lambda c, s: F.when(F.col(c).isNotNull(), F.concat(F.col(c).cast("string"), F.lit(s)))
    steps = wide.select(
        F.explode(F.array(
            F.struct(item("i", "e").alias("e"), F.coalesce(item("child", "e"), item("i", "x")).alias("to")),
            F.struct(item("i", "x").alias("e"), F.coalesce(item("sibling", "e"), item("p", "x")).alias("to")),
        )).alias("s")
    ).select("s.e", "s.to")
    ranked = double(steps.select("e", "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("left"), F.col("e").alias("last")), "e", "to", {"left": lambda a, b: a + b, "last": lambda a, b: b})
    ends = ranked.select(F.expr("substring(e, 1, length(e) - 1)").cast("long").alias("i"), F.right("e", F.lit(1)).alias("side"), "left", F.expr("substring(last, 1, length(last) - 1)").cast("long").alias("root"))
    each = ends.groupBy("i", "root").agg(F.max(F.when(F.col("side") == "e", F.col("left"))).alias("le"), F.max(F.when(F.col("side") == "x", F.col("left"))).alias("lx"))
    size = each.where("i = root").select("root", F.col("le").alias("size"))
    return each.join(size, "root").select("i", (F.col("size") - F.col("le")).alias("entry"), (F.col("size") - F.col("lx")).alias("exit"))


def hierarchy(
    df: DataFrame, *, key: str, parent: str, title: str, group: str, order: str, at: str,
    compare_depth: str | None = None, compare_path: str | None = None,
    task_rows: int = 60_000, all_paths: bool = True,
) -> DataFrame:
    """One row a node: ``id, parent, depth, root, state, anchor, path, entry, exit, n_descendants, depth_differs, path_differs``.

    ``root`` is the root's id for nodes in trees; ``anchor`` the least id of the
    cycle for ``cycle`` and ``below_cycle``, the missing parent for ``orphan``,
    else the top of the tree. Descendants of ``a`` are the nodes of the same
    ``root`` with ``a.entry < entry < a.exit``. Null or empty parents make a root,
    a node that names itself is a cycle of one, null keys are no node, of rows of
    one key the latest counts (of equal times the greatest values), ``group`` and
    ``order`` only place rows and may hold anything. Null titles are empty in
    paths. An empty table gives no rows; further columns are ignored. With
    ``all_paths`` false, ``path`` stays null and only the comparison is made.
    """
    keep = [c for c in (parent, title, compare_depth, compare_path, group, order) if c]
    order_of = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    slim = latest(df, key, at, keep).select(F.xxhash64("id").alias("i"), F.when(parent_of(F.col(parent)).isNotNull(), F.xxhash64(parent)).alias("p"), F.xxhash64(group).alias("g"), order_of(order).alias("o"))
    blocks = Blocks(slim, task_rows)
    full = latest(df, key, at, keep).select(
        "id", parent_of(F.col(parent)).alias("parent"), F.col(title).alias("title"), F.xxhash64("id").alias("i"), F.xxhash64(group).alias("g"), order_of(order).alias("o"),
        (F.col(compare_depth).cast("long") if compare_depth else F.lit(None).cast("long")).alias("old_depth"),
        (F.col(compare_path) if compare_path else F.lit(None).cast("string")).alias("old_path"),
    )
    placed = blocks.assign(full)
    if blocks.labels is not None:
        placed = placed.join(blocks.labels, "i", "left").withColumn("b", F.coalesce("label", "b"))
    if blocks.giant is not None:
        placed = placed.join(blocks.giant.select("i"), "i", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            yield _resolved(pd.concat(parts, ignore_index=True), all_paths)

    schema = "id string, parent string, depth long, root string, state int, anchor string, path string, entry long, exit long, n_descendants long, depth_differs boolean, path_differs boolean"
    done = placed.repartition(blocks.parts, "b").select("id", "parent", "title", "old_depth", "old_path", "o").mapInPandas(run, schema)
    if blocks.giant is not None:
        done = done.unionByName(_giant(full.join(blocks.giant.select("i"), "i"), all_paths))
    return done.withColumn("state", F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("state") + 1))


def hierarchy_defects(nodes: DataFrame) -> DataFrame:
    """``(id, defect, anchor_id)``, one row a node and defect, from :func:`hierarchy` with comparisons."""
    kinds = F.array_compact(F.array(
        F.when(F.col("state").isin("cycle", "below_cycle", "orphan"), F.col("state")),
        F.when(F.col("depth_differs"), F.lit("depth")),
        F.when(F.col("path_differs"), F.lit("path")),
    ))
    return nodes.select("id", F.explode(kinds).alias("defect"), F.col("anchor").alias("anchor_id"))


def descendants(nodes: DataFrame, slice_rows: int = 1 << 12) -> DataFrame:
    """``(ancestor, id, distance)``: every node below every ancestor, by its entry in the ancestor's interval.

    Intervals are cut into slices of entries and meet the nodes of their slice alone, so a
    large tree is many small joins and no node meets a whole tree. An interval that
    covers a slice meets all its nodes, which are all its descendants: what is joined is what comes out.
    """
    tree = nodes.where("state = 'tree'")
    slot = lambda c: F.floor(F.col(c) / slice_rows)
    a = tree.where("n_descendants > 0").select("root", F.col("id").alias("ancestor"), F.col("entry").alias("a0"), F.col("exit").alias("a1"), F.col("depth").alias("ad"))
    a = a.withColumn("slice", F.explode(F.sequence(slot("a0"), slot("a1"))))
    d = tree.where("depth > 1").select("root", "id", "entry", "depth", slot("entry").alias("slice"))
    return a.join(d, ["root", "slice"]).where("entry > a0 and entry < a1").select("ancestor", "id", (F.col("depth") - F.col("ad")).alias("distance"))
