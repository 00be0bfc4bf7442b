"""Near copies by SimHash: fingerprints of word shingles, linked where few bits differ, found by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ROW_KEY, keep, map_arrow, row_key, utf8, with_decisions
from strata.llm.components import components

SEED = 42
HALF = 32
#: Members of one signature that are compared with each other; larger groups are cut into finer signatures first.
GROUP = 256
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one UTF-8 text: bit i is set where more than half of its shingles' hashes have it. No words: 0."""
    words = text.lower().split()  # of bytes: lowers A-Z only, cuts at space and \t to \r only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ones = np.zeros(64, np.int64)
    n = len(words) - shingle + 1
    for start in range(0, n, BLOCK):
        part = words[start : start + BLOCK + shingle - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in joined], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (a hash of the whole row) and fp (the 64 bits as a signed long) of every row. A null or blank text has fingerprint 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t, shingle) for t in utf8(batch)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(bits.view(np.int64))], ["doc_id", "key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), row_key(docs).alias("key"))
    return map_arrow(rows, work, f"doc_id long, key {ROW_KEY}, fp long")


def _signatures(df: DataFrame, level: int) -> DataFrame:
    """A row for each half of the level's bits and each bit of it left out; column s<level> holds half, bit and what remains.

    Level 1 halves the whole fingerprint, level 2 the half that level 1 left open, level 3 the quarter that level 2 left open.
    """
    width, base = HALF >> (level - 1), _base(level)
    mask = (1 << width) - 1
    signs = ", ".join(
        f"shiftleft({k * width + i}L, {width}) | (shiftrightunsigned(fp, {base} + {k * width}) & {mask ^ (1 << i)}L)"
        for k in range(2)
        for i in range(width)
    )
    return df.withColumn(f"s{level}", F.explode(F.expr(f"array({signs})")))


def _base(level: int) -> str:
    """SQL for the lowest of the bits that a level cuts, from the signatures of the levels above."""
    if level == 1:
        return "0"
    above = HALF >> (level - 2)
    half = f"cast(shiftrightunsigned(s{level - 1}, {above + above.bit_length() - 1}) as int)"
    return f"({_base(level - 1)} + (1 - {half}) * {above})"


def _first_sign(level: int) -> str:
    """SQL: of all signatures of a level that a pair shares, this is the first, so that each pair comes once."""
    width, base = HALF >> (level - 1), _base(level)
    sign = f"shiftrightunsigned(s{level}, {width})"
    part = lambda k: f"(shiftrightunsigned(x, {base} + {k}) & {(1 << width) - 1}L)"
    own = f"(shiftrightunsigned(x, {base} + cast({sign} div {width} as int) * {width}) & {(1 << width) - 1}L)"
    return f"({own} <> 0 or {sign} % {width} = 0) and ({sign} < {width} or bit_count({part(0)}) > 1)"


def _shuffled(rows: DataFrame) -> DataFrame:
    """`rows` as the side of a join that is never broadcast, for tables that grow with the documents. Spark takes exploded rows for as large
    as they were before, and written ones for as large as their compressed files, and would broadcast many times its limit."""
    return rows.hint("merge")


def near_pairs(prints: DataFrame, max_bits: int = 3, group: int = GROUP) -> DataFrame:
    """a < b, distinct fingerprints that differ in at most `max_bits` (3 or less) bits, each pair once. Column in: fp, distinct.

    Of two halves one differs in at most one bit, so the pair shares a signature: that half without that bit. Signatures are
    joined on equality and pairs verified. A signature with more than `group` fingerprints is not joined: its members agree in
    31 bits and are cut further in the same way, by the bits still open. On the third level at most 2,048 fingerprints can
    share a signature, so no group of any input grows beyond that.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments need max_bits of 3 or less")
    pairs, members, signs = None, prints.select("fp"), []
    for level in (1, 2, 3):
        members, signs = _signatures(members, level), [*signs, f"s{level}"]
        sizes = members.groupBy(*signs).agg(F.count("*").alias("size")).filter("size > 1")
        shared = keep(members.join(_shuffled(sizes), signs), "signatures")
        small = shared if level == 3 else shared.filter(F.col("size") <= group)
        left, right = (small.select(*signs, F.col("fp").alias(c)) for c in ("a", "b"))
        met = left.join(_shuffled(right), [left[s] == right[s] for s in signs] + [left["a"] < right["b"], F.bit_count(left["a"].bitwiseXOR(right["b"])) <= max_bits])
        met = met.select(*(left[s] for s in signs), "a", "b", left["a"].bitwiseXOR(right["b"]).alias("x"))
        met = met.filter(" and ".join(_first_sign(k) for k in range(1, level + 1))).select("a", "b")
        pairs = met if pairs is None else pairs.union(met)
        members = shared.filter(F.col("size") > group).select("fp", *signs)
        if level == 3 or members.isEmpty():
            return pairs


def simhash_groups(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every row of `docs`.

    component_id is the smallest doc_id reachable over links of at most `max_bits` differing bits. Rows with equal
    fingerprints are one node of the graph, so a group of copies of any size costs one. A null or blank text has fingerprint
    zero and links like any other. Rows with a null id keep a row; their component is that of their fingerprint, null when it
    holds no id. Repeated rows stay. Other columns are not read. Empty in, empty out.
    """
    columns = dict.fromkeys((id_col, text_col))
    prints, rooted = _rooted(docs.select(*columns), shingle, max_bits, group, id_col, text_col)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = keep(rooted.join(_shuffled(smallest), "root").select("fp", "component_id"), "placed")
    return prints.join(_shuffled(placed), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(docs: DataFrame, shingle: int, max_bits: int, group: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows; and fp, least (its smallest id) and root (the fingerprint that stands for its component) of each distinct one."""
    prints = keep(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(near_pairs(nodes, max_bits, group)).withColumnRenamed("node", "fp")
    return prints, keep(nodes.join(_shuffled(roots), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")


def one_of_each_group(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns kept, but one of each group of simhash_groups: that with the smallest id, ids before null.

    Of rows that share that id the one with the smallest hash of all columns stays, of fully repeated rows one.
    """
    prints, rooted = _rooted(docs, shingle, max_bits, group, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    chosen = prints.join(_shuffled(rooted.select("fp", "root")), "fp").groupBy("root").agg(F.min(order)["key"].alias("key"))
    often = prints.groupBy("key").agg(F.count("*").alias("rows"))
    chosen = keep(chosen.select("key").distinct().join(_shuffled(often), "key"), "chosen")
    kept = with_decisions(docs, row_key(docs), chosen, "rows")
    return kept.filter("decision = 1").select("row.*").union(kept.filter("decision > 1").dropDuplicates(["key"]).select("row.*"))
