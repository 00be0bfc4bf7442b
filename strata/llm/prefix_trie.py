"""The trie of conversation prefixes: nodes from prefix digests, subtree sums from flat arrays behind minimal perfect hash tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, map_arrow
from strata.llm.components import components

#: ASCII white space ends a word; anything else is part of one.
WORD = r"[^\x20\x09-\x0D]+"
#: A prefix digest is a pair of polynomials over its turns' digests, modulo this prime: digests of parts of a conversation can be joined.
PRIME = (1 << 61) - 1
BASES = (0x1B8A5C9D3E7F1241, 0x0D6F3A8B29C4E573)
#: Conversation c takes over up to FEWEST - 1 turns of the first of its group of GROUP conversations.
GROUP, TAKEN = 20, 4
#: Subtrees of so many members at most go into tables together; larger ones are put together from their parts. Grows with the root of the input.
MEMBERS = 1024
#: Entries of one table, about; ids of one piece of a node's list of ends.
ENTRIES, IDS = 1 << 16, 4096

NODE = "depth int, a long, b long"


def _add(x: int, y: int) -> int:
    return (x + y) % PRIME


def _powers(exponent: int) -> tuple[int, int]:
    return pow(BASES[0], exponent, PRIME), pow(BASES[1], exponent, PRIME)


def _batch(rows: list[tuple], names: str, types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names.split())


_LONG, _INT = pa.int64(), pa.int32()


# --- turns in order, with digests of everything before ----------------------------------------------------------------------------


def turn_digests(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, ta and tb (a digest of role and text) and words of every row with a conversation. Texts are read here and go no further."""
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    rows = rows.select("conv_id", "turn", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("d"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    half = lambda start: F.conv(F.substring("d", start, 15), 16, 10).cast("long")  # noqa: E731 - 60 bits, below the prime
    return rows.select("conv_id", "turn", half(1).alias("ta"), half(16).alias("tb"), "words", F.monotonically_increasing_id().alias("at"))


LINE = "conv_id long, part int, i long, ta long, tb long, words long, ga long, gb long, gw long"


def _cumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and cumulated digest and words of each turn among those of its conversation in this task."""
    from pyspark import TaskContext

    part, now, i, ga, gb, gw, pa_, pb_ = TaskContext.get().partitionId(), None, 0, 0, 0, 0, 1, 1
    names = [x.split()[0] for x in LINE.split(", ")]
    for batch in batches:
        rows = []
        for conv, ta, tb, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ta", "tb", "words"))):
            if conv != now:
                now, i, ga, gb, gw, pa_, pb_ = conv, 0, 0, 0, 0, 1, 1
            ga, gb, gw = (ga + ta * pa_) % PRIME, (gb + tb * pb_) % PRIME, gw + words
            rows.append((conv, part, i, ta, tb, words, ga, gb, gw))
            i, pa_, pb_ = i + 1, pa_ * BASES[0] % PRIME, pb_ * BASES[1] % PRIME
        yield _batch(rows, " ".join(names), [_LONG, _INT, *[_LONG] * 7])


def ordered_turns(digests: DataFrame) -> DataFrame:
    """conv_id, i (place of the turn from 0), ta, tb, words, and ga, gb, gw cumulated over the conversation up to the turn.

    Turns are dealt in ranges of (conversation, turn), so a conversation of any length is spread over tasks. Each task cumulates what it
    has; what a conversation brings along from the tasks before is added afterwards. Only conversations at the border of two
    tasks need that: at most one a task, whose sums come to the driver (a few numbers a task).
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("ta"), F.col("tb"), F.col("at")]
    lines = keep(map_arrow(digests.repartitionByRange(*order).sortWithinPartitions(*order), _cumulate, LINE), "turns")
    borders = lines.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"))
    cut = borders.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("conv_id")).groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1")
    ids = [r.conv_id for r in cut.collect()]
    if not ids:
        return lines.drop("part")
    ends = lines.filter(F.col("conv_id").isin(ids)).groupBy("conv_id", "part").agg(F.max_by(F.struct("i", "ga", "gb", "gw"), "i").alias("e"))
    carried, now = {}, None
    for r in ends.orderBy("conv_id", "part").collect():
        if r.conv_id != now:
            now, n, ga, gb, gw = r.conv_id, 0, 0, 0, 0
        carried[r.conv_id, r.part] = (n, ga, gb, gw)
        qa, qb = _powers(n)
        n, ga, gb, gw = n + r.e.i + 1, (ga + r.e.ga * qa) % PRIME, (gb + r.e.gb * qb) % PRIME, gw + r.e.gw

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, part, i, ta, tb, words, ga, gb, gw in zip(*(c.to_pylist() for c in batch.columns)):
                n, xa, xb, xw = carried.get((conv, part), (0, 0, 0, 0))
                qa, qb = _powers(n) if n else (1, 1)
                rows.append((conv, i + n, ta, tb, words, (xa + ga * qa) % PRIME, (xb + gb * qb) % PRIME, xw + gw))
            yield _batch(rows, "conv_id i ta tb words ga gb gw", [_LONG] * 8)

    # a task that holds none of the cut conversations' later parts changes nothing
    return keep(map_arrow(lines, join, "conv_id long, i long, ta long, tb long, words long, ga long, gb long, gw long"), "turns")


# --- rebuilt conversations as paths -----------------------------------------------------------------------------------------------


def taken_turns(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % TAKEN).cast("int")


SHIFT = "conv_id long, h int, m int, total long, ca long, cb long, cw long, xa long, xb long, xw long"
PATH = "conv_id long, depth int, a long, b long, ua long, ub long, words long, sum_words long, last boolean"


def _rebuilt(lines: DataFrame) -> DataFrame:
    """A row a conversation: its own number of turns n, h, and up to h first turns of its own and of the first conversation of its group."""
    firsts = [F.max(F.when(F.col("i") == k, F.struct("ta", "tb", "words"))).alias(f"t{k}") for k in range(TAKEN - 1)]
    own = keep(lines.groupBy("conv_id").agg(F.count("*").alias("n"), *firsts), "conversations")
    heads = [f"t{k}" for k in range(TAKEN - 1)]
    base = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.array_compact(F.array(*heads)).alias("from"))
    plan = own.select("conv_id", "n", taken_turns(F.col("conv_id")).alias("h"), F.array_compact(F.array(*heads)).alias("own"))
    plan = plan.join(base, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base"), "left")
    some = lambda c: F.slice(F.coalesce(F.col(c), F.col("own").cast("array<struct<ta:long,tb:long,words:long>>")), 1, F.col("h"))
    return keep(plan.select("conv_id", "n", "h", some("own").alias("own"), F.when(F.col("base").isNull(), F.slice("own", 1, 0)).otherwise(some("from")).alias("taken")), "rebuilt")


def _fold(turns: list[dict], start: int = 0) -> tuple[int, int, int]:
    a = b = w = 0
    for k, t in enumerate(turns, start):
        qa, qb = _powers(k)
        a, b, w = (a + t["ta"] * qa) % PRIME, (b + t["tb"] * qb) % PRIME, w + t["words"]
    return a, b, w


def paths(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables. Shifts, a row a conversation: how many turns it took over (m) and has in all (total). Paths, a row a rebuilt turn: the node
    it leads to (depth, a, b), the node above (depth - 1, ua, ub), its words, those of the whole prefix, and whether the conversation ends."""
    plan = _rebuilt(lines)

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                m = len(r["taken"])
                rows.append((r["conv_id"], r["h"], m, m + max(r["n"] - r["h"], 0), *_fold(r["own"]), *_fold(r["taken"])))
            yield _batch(rows, " ".join(x.split()[0] for x in SHIFT.split(", ")), [_LONG, _INT, _INT, *[_LONG] * 7])

    def first_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                total = len(r["taken"]) + max(r["n"] - r["h"], 0)
                before = (0, 0, 0)
                for k, turn in enumerate(r["taken"]):
                    here = _fold(r["taken"][: k + 1])
                    rows.append((r["conv_id"], k + 1, *here[:2], *before[:2], turn["words"], here[2], k + 1 == total))
                    before = here
            yield _path_batch(rows)

    def own_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                qa, qb = _powers(r["m"] - r["h"])
                depth = r["m"] + r["i"] - r["h"] + 1
                a, b = (r["xa"] + (r["ga"] - r["ca"]) * qa) % PRIME, (r["xb"] + (r["gb"] - r["cb"]) * qb) % PRIME
                qa, qb = _powers(depth - 1)
                above = (a - r["ta"] * qa) % PRIME, (b - r["tb"] * qb) % PRIME
                rows.append((r["conv_id"], depth, a, b, *above, r["words"], r["xw"] + r["gw"] - r["cw"], depth == r["total"]))
            yield _path_batch(rows)

    shifts = keep(map_arrow(plan, shift, SHIFT), "shifts")
    own = lines.join(shifts, "conv_id").filter("i >= h")
    return shifts, keep(map_arrow(plan, first_nodes, PATH).union(map_arrow(own, own_nodes, PATH)), "paths")


def _path_batch(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, " ".join(x.split()[0] for x in PATH.split(", ")), [_LONG, _INT, *[_LONG] * 6, pa.bool_()])


# --- node tables ------------------------------------------------------------------------------------------------------------------


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class NodeTable:
    """A minimal perfect hash over digests: n digests have the slots 0 to n - 1. Each slot holds its digest, so a lookup is verified.

    Digests that fall alone into a place of the first bit array stay there, the others go on to the next one; a digest's slot is the
    number of places taken before its own. Equal digests raise.
    """

    def __init__(self, keys: np.ndarray):
        if len(np.unique(keys, axis=0)) < len(keys):
            raise ValueError("two nodes have one digest")
        self.bits: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        taken, left = 0, keys
        while len(left):
            size = max(64, 2 * len(left))
            place = self._place(left, len(self.bits), size)
            alone = np.bincount(place, minlength=size) == 1
            self.bits.append(alone)
            self.before.append(taken + np.cumsum(alone) - alone)
            taken += int(alone.sum())
            left = left[~alone[place]]
        self.digests = np.zeros((len(keys), keys.shape[1]), np.int64)
        self.digests[self._slots(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = np.zeros(len(keys), np.uint64)
        for k in range(keys.shape[1]):
            mixed = _mixed(mixed ^ keys[:, k].astype(np.int64).view(np.uint64), 3 * level + k + 1)
        return (mixed % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1)
        open_ = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            place = self._place(keys[open_], level, len(bits))
            here = bits[place]
            slots[open_[here]] = before[place[here]]
            open_ = open_[~here]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that are not in the table."""
        slots = self._slots(keys)
        known = slots >= 0
        known[known] = (self.digests[slots[known]] == keys[known]).all(axis=1)
        return np.where(known, slots, -1)


def accumulate(keys: np.ndarray, above: np.ndarray, saved: np.ndarray, leaves: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves and saved words under each node: `leaves` and `below` as given plus what the nodes under it in the table add.

    keys and above: (depth, a, b) of nodes and of what they hang on. Counts are scattered into flat arrays by slot; the deepest nodes
    are added to their parents' slots first.
    """
    table = NodeTable(keys)
    slot, parent = table.slots(keys), table.slots(above)
    n_leaves, n_below, own = (np.zeros(len(keys), np.int64) for _ in range(3))
    n_leaves[slot], n_below[slot], own[slot] = leaves, below, saved
    order = np.argsort(-keys[:, 0], kind="stable")
    ends = np.flatnonzero(np.diff(keys[order, 0])) + 1
    for level in np.split(order, ends):
        hanging = level[parent[level] >= 0]
        np.add.at(n_leaves, parent[hanging], n_leaves[slot[hanging]])
        np.add.at(n_below, parent[hanging], n_below[slot[hanging]] + own[slot[hanging]])
    return n_leaves[slot], n_below[slot]


RUN = "conv_id long, n_convs long, depth int, a long, b long, up int, ua long, ub long, saved long, leaves long, below long, tree long"
SUMS = "conv_id long, n_convs long, up int, ua long, ub long, saved long, leaves long, below long, tree long"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole trees (column tree, sorted) gathered into tables of about ENTRIES nodes."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None

    def done() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        column = lambda c: whole.column(c).to_numpy()
        keys, above = (np.stack([column(c).astype(np.int64) for c in cs], axis=1) for cs in (("depth", "a", "b"), ("up", "ua", "ub")))
        leaves, below = accumulate(keys, above, column("saved"), column("leaves"), column("below"))
        names = [x.split()[0] for x in SUMS.split(", ")]
        new = {"leaves": pa.array(leaves), "below": pa.array(below)}
        return pa.RecordBatch.from_arrays([new.get(c, whole.column(c).combine_chunks()) for c in names], names)

    for batch in batches:
        trees = batch.column("tree").to_numpy(zero_copy_only=False)
        start = 0
        borders = [0] if last is not None and len(trees) and trees[0] != last else []
        for at in [*borders, *(np.flatnonzero(np.diff(trees)) + 1).tolist()]:
            if size + at - start >= ENTRIES:
                if at > start:
                    held.append(batch.slice(start, at - start))
                if held:
                    yield done()
                held, size, start = [], 0, at
        if start < batch.num_rows:
            held.append(batch.slice(start))
            size += batch.num_rows - start
        last = trees[-1] if len(trees) else last
    if held:
        yield done()


def _nodes(shifts: DataFrame, path: DataFrame) -> DataFrame:
    """A row a node: depth, a, b, its parent's ua and ub, words, sum_words, conv_id (smallest member), n_convs. Two prefixes of one digest raise."""
    same = [F.when(F.min(c) == F.max(c), F.max(c)).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long")).alias(c) for c in ("ua", "ub", "words", "sum_words")]
    inner = path.groupBy("depth", "a", "b").agg(*same, F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("a", "b", "ua", "ub", "words", "sum_words")]
    root = shifts.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    return keep(inner.unionByName(root.select(F.lit(0).alias("depth"), *zero, "conv_id", "n_convs")), "nodes")


def _runs(nodes: DataFrame) -> DataFrame:
    """Nodes below each other with the same members, as one row each: identified by the smallest member and their number.

    Members of a node are members of the one above, so both together tell the member set along a path. A run hangs on the last
    node of another (up, ua, ub), of members pc and pn. Its last node's digest is (depth, a, b); saved are its own nodes' words.
    """
    runs = nodes.groupBy("conv_id", "n_convs").agg(
        F.min_by(F.struct(F.col("depth").alias("top"), "ua", "ub", (F.col("sum_words") - F.col("words")).alias("before")), "depth").alias("t"),
        F.max_by(F.struct("depth", "a", "b", "sum_words"), "depth").alias("e"),
    )
    runs = keep(
        runs.select(
            "conv_id", "n_convs", "t.top", (F.col("t.top") - 1).alias("up"), "t.ua", "t.ub", "e.depth", "e.a", "e.b", "e.sum_words",
            ((F.col("n_convs") - 1) * (F.col("e.sum_words") - F.col("t.before"))).alias("saved"),
        ),
        "runs",
    )
    # a run ends where others hang on it, so only last nodes are joined
    last = runs.select(F.col("depth").alias("up"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("conv_id").alias("pc"), F.col("n_convs").alias("pn"))
    return keep(runs.join(last, ["up", "ua", "ub"], "left"), "runs")


def _subtree_sums(runs: DataFrame, members: int) -> DataFrame:
    """conv_id, n_convs, leaves, below (words saved under the run) and kids (runs that hang on it) of every run.

    Runs of one member are leaves and save nothing, so they are only counted. Trees of at most `members` members lie whole in one
    table; the runs above, at most conversations / members for each level, are one more table, on which these trees' sums hang.
    """
    hung = runs.filter("up >= 0").groupBy(F.col("pc").alias("conv_id"), F.col("pn").alias("n_convs")).agg(
        F.count("*").alias("kids"), F.count_if(F.col("n_convs") == 1).alias("single")
    )
    counted = runs.join(hung, ["conv_id", "n_convs"], "left").na.fill(0, ["kids", "single"])
    shared = keep(counted.filter("n_convs > 1").withColumn("leaves", F.when(F.col("kids") == 0, 1).otherwise(F.col("single"))), "shared")
    light = shared.filter(F.col("n_convs") <= members)
    # a tree is named by the owner of its top; owners that hang on another light owner belong to that one's tree
    tops = light.filter(~(F.coalesce(F.col("pn"), F.lit(members + 1)) <= members) | (F.col("pc") != F.col("conv_id")))
    links = tops.filter(F.col("pn") <= members).select(F.col("conv_id").alias("a"), F.col("pc").alias("b"))
    trees = keep(components(links), "trees")
    placed = light.join(trees.withColumnRenamed("node", "conv_id"), "conv_id", "left")
    columns = [x.split()[0] for x in RUN.split(", ")]
    zero = F.lit(0).cast("long").alias("below")
    rows = placed.select("*", F.coalesce("root", "conv_id").alias("tree"), zero).select(*columns)
    low = keep(map_arrow(rows.repartition("tree").sortWithinPartitions("tree"), _tables, SUMS), "light")

    heavy = shared.filter(F.col("n_convs") > members)
    tips = low.join(tops.filter(~(F.coalesce(F.col("pn"), F.lit(members + 1)) <= members)).select("conv_id", "n_convs", "pc", "pn"), ["conv_id", "n_convs"])
    brought = tips.filter("pc is not null").groupBy(F.col("pc").alias("conv_id"), F.col("pn").alias("n_convs")).agg(
        F.sum("leaves").alias("more"), F.sum(F.col("below") + F.col("saved")).alias("below")
    )
    rows = heavy.join(brought, ["conv_id", "n_convs"], "left").na.fill(0, ["more", "below"])
    rows = rows.withColumns({"leaves": F.col("leaves") + F.col("more"), "tree": F.lit(0).cast("long")}).select(*columns)
    high = keep(map_arrow(rows.repartition(1), _tables, SUMS), "heavy")
    sums = low.union(high).select("conv_id", "n_convs", "leaves", "below")
    return keep(counted.join(sums, ["conv_id", "n_convs"], "left").select(
        "conv_id", "n_convs", "top", "depth", "pc", "kids", "sum_words", F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("below", F.lit(0)).alias("below")
    ), "sums")


# --- ends -------------------------------------------------------------------------------------------------------------------------

PIECE = "depth int, a long, b long, part int, k int, ids string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order as texts of up to IDS numbers of one node."""
    from pyspark import TaskContext

    part, now, k, ids = TaskContext.get().partitionId(), None, 0, []
    types = [_INT, _LONG, _LONG, _INT, _INT, pa.string()]
    names = " ".join(x.split()[0] for x in PIECE.split(", "))
    for batch in batches:
        rows = []
        for depth, a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "conv_id"))):
            if (depth, a, b) != now or len(ids) == IDS:
                if ids:
                    rows.append((*now, part, k, ",".join(ids)))
                k = k + 1 if (depth, a, b) == now else 0
                now, ids = (depth, a, b), []
            ids.append(str(conv))
        yield _batch(rows, names, types)
    yield _batch([(*now, part, k, ",".join(ids))] if ids else [], names, types)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = sha = None
    for batch in batches:
        rows = []
        for depth, a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "ids"))):
            if (depth, a, b) == now:
                sha.update(b",")
            else:
                if now:
                    rows.append((*now, sha.hexdigest()))
                now, sha = (depth, a, b), hashlib.sha256()
            sha.update(ids.encode())
        yield _batch(rows, "depth a b ends_sha256", [_INT, _LONG, _LONG, pa.string()])
    yield _batch([(*now, sha.hexdigest())] if now else [], "depth a b ends_sha256", [_INT, _LONG, _LONG, pa.string()])


def _ends(shifts: DataFrame, path: DataFrame) -> DataFrame:
    """depth, a, b and ends_sha256 of nodes at which conversations end. Ids are put in order in ranges, so a node of any number of ends is
    spread; what one task hashes in the end is a piece for IDS of them."""
    ends = path.filter("last").select("depth", "a", "b", "conv_id")
    nowhere = shifts.filter("total = 0").select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id")
    order = ["depth", "a", "b", "conv_id"]
    pieces = keep(map_arrow(ends.union(nowhere).repartitionByRange(*order).sortWithinPartitions(*order), _pieces, PIECE), "ends")
    whole = pieces.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "part", "k")
    return map_arrow(whole, _hashes, f"{NODE}, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, members: int | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie of all rebuilt conversations, a row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns of a conversation go by turn, null first, those of one number by a digest of role and text; a null role or text is empty.
    Conversation c is rebuilt from the first h = crc32(c) % 4 turns of conversation c - c % 20 and its own turns after its first h. A
    node is a distinct sequence of first turns; the root, of none, is a node as soon as there is a conversation. conv_id is a
    node's smallest member, which with the depth names it. saved_tokens: words of last turns that other members repeat, summed over
    the subtree. ends_sha256: of the ids of conversations that end there, in order, joined by commas. Repeated rows are
    turns of their own. Rows without a conversation take no part. Other columns are not read. Empty in, empty out.

    No task holds a conversation, a node's members or a subtree whole; tables hold subtrees of at most `members` members (1,024 or
    the root of the number of conversations, whatever is more).
    """
    lines = ordered_turns(keep(turn_digests(turns, conv_col, turn_col, role_col, text_col), "digests"))
    shifts, path = paths(lines)
    nodes = _nodes(shifts, path)
    limit = members or max(MEMBERS, isqrt(shifts.count()))
    sums = _subtree_sums(_runs(nodes), limit).select(
        "conv_id", "n_convs", "top", F.col("depth").alias("bottom"), "pc", "kids", F.col("sum_words").alias("run_words"), "leaves", "below"
    )
    whole = nodes.join(sums, ["conv_id", "n_convs"]).join(_ends(shifts, path), ["depth", "a", "b"], "left")
    saved = (F.col("n_convs") - 1) * (F.col("run_words") - F.col("sum_words") + F.col("words")) + F.col("below")
    return whole.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("pc"))).alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("depth") < F.col("bottom"), F.lit(1).cast("long")).otherwise(F.col("kids")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
