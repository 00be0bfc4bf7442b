"""Documents whose sets of word n-grams are alike, found by a grouped prefix join, as components of their links."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import keep, map_arrow, utf8
from strata.llm.components import components
from strata.session import broadcast_if_small

SHINGLE, PERCENT = 5, 80
#: Members of a list that all others are compared with in one round, and rounds of that; what is left is compared in full.
HUBS, ROUNDS = 16, 3
#: Members of a list that travel together, about.
BLOCK = 256
#: Shingles held before they are counted, those of one block of documents, and those of one bucket, about.
COUNTED, TOGETHER, BUCKET = 1 << 22, 1 << 20, 1 << 22
#: Parts of a bucket, so that a shingle of a third of all documents does not meet in one task.
SALTS = 4
#: Bytes whose words are hashed at once.
SPAN = 1 << 18
#: Bytes of hubs, or of pairs, that are broadcast: so few are met sooner by the tasks that hold the other side than by a shuffle of both.
NEAR = 8 << 20
#: Least bits of a shingle's hash by which shingles are counted; more for larger inputs, so that hardly two share them.
BITS = 40
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.frombuffer(hashlib.shake_256(b"bytes of a word").digest(8 * 256), "<u8")
_STEP = 0x9E3779B97F4A7C13  # 3 modulo 4, so differences of its powers have few factors of two


def _series(step: int, length: int) -> np.ndarray:
    """1, step, step ** 2 and so on, modulo 2 ** 64."""
    out = np.ones(length, np.uint64)
    done = 1
    while done < length:
        more = min(done, length - done)
        out[done : done + more] = out[:more] * np.uint64(pow(step, done, 1 << 64))
        done += more
    return out


_POWERS, _INVERSES = _series(_STEP, SPAN), _series(pow(_STEP, -1, 1 << 64), SPAN)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and a 64-bit hash of each: words are cut at ASCII white space.

    A word's hash is a polynomial over its bytes, as a difference of running sums, so that all words of a span are hashed at once.
    Spans end at white space; a word of SPAN bytes or more is hashed by itself.
    """
    whole = np.frombuffer(text, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(whole):
        part = whole[at : at + SPAN]
        blank = _SPACE[part]
        if at + SPAN < len(whole):
            blanks = np.flatnonzero(blank)
            if not len(blanks):
                after = [i for i in (text.find(c, at) for c in (b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b" ")) if i >= 0]
                end = min(after, default=len(text))
                starts.append(np.array([at]))
                hashes.append(np.array([xxhash.xxh3_64_intdigest(text[at:end])], np.uint64))
                at = end
                continue
            part, blank = part[: blanks[-1] + 1], blank[: blanks[-1] + 1]
        edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        first, last = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _POWERS[: len(part)], dtype=np.uint64)])
        starts.append(first + at)
        hashes.append(_mixed((sums[last] - sums[first]) * _INVERSES[first] + (last - first).astype(np.uint64)))
        at += len(part)
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.empty(0, np.int64), np.empty(0, np.uint64))


def _joined(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` words."""
    total = np.full(len(hashes) - length + 1, length, np.uint64)
    for k in range(length):
        total = (total ^ (total >> np.uint64(29))) * _ODD[k % len(_ODD)] + hashes[k : len(hashes) - length + 1 + k]
    return _mixed(total)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes. A-Z are lowered; fewer words than a shingle has are one of all of them."""
    starts, hashes = word_hashes(b" ".join(texts).lower())
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]) if texts else np.zeros(1, np.int64)
    borders = np.searchsorted(starts, offsets)
    joined = _joined(hashes, shingle) if len(hashes) >= shingle else np.empty(0, np.uint64)
    sets = []
    for first, last in zip(borders[:-1], borders[1:]):
        if last - first >= shingle:
            sets.append(_distinct(np.sort(joined[first : last - shingle + 1])))
        else:
            sets.append(_joined(hashes[first:last], last - first) if last > first else np.empty(0, np.uint64))
    return sets


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]


def prefix_length(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Of two sets that are alike each has one of its first so many, in any order of all shingles, among the other's."""
    return n - (-(-percent * n // 100)) + 1


def _pack(values: np.ndarray) -> bytes:
    """Numbers as bytes: all first bytes, all second ones and so on, compressed; small differences cost little."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(raw.T).reshape(-1).view("<u8")


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data), dtype=np.uint64)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _class(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


# --- classes of equal sets --------------------------------------------------------------------------------------------------------

CENSUS = "doc_id long, text_key long, n long, cls binary"


def census(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (a hash of the text), n (size of the set) and cls of every row; rows of one cls have equal sets. No words: n 0, cls null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(utf8(batch), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_class(s) for s in sets], pa.binary())],
                ["doc_id", "text_key", "n", "cls"],
            )

    return map_arrow(docs, work, CENSUS)


# --- rarest first -----------------------------------------------------------------------------------------------------------------


class Cut:
    """How shingles are dealt to buckets: by the highest of the bits that they are counted by."""

    def __init__(self, total: int):
        self.bits = min(63, max(BITS, total.bit_length() + 14))
        self.deal = max(4, (total // BUCKET).bit_length())

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        return tokens >> np.uint64(64 - self.bits)

    def parts(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Buckets of sorted keys and where they lie."""
        buckets = (keys >> np.uint64(self.bits - self.deal)).astype(np.int64)
        starts = np.flatnonzero(np.diff(buckets, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            yield int(buckets[start]), slice(int(start), int(end))


COUNTS = "bucket int, keys binary, counts binary"


def shared_keys(docs: DataFrame, cut: Cut, shingle: int = SHINGLE) -> DataFrame:
    """Keys of shingles that occur in several sets, and in how many: a packed row a bucket. One of a set that occurs once only has no part.

    Each task counts what it reads first, equal sets once, so a frequent shingle costs a number a task. A set of which copies lie
    in several tasks is counted for each of these: the counts serve as an order, any one does.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def done() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return _rows([(b, _pack_sorted(keys[at]), _pack(counts[at])) for b, at in cut.parts(keys)], COUNTS)

        for batch in batches:
            for tokens in shingle_sets(utf8(batch), shingle):
                cls = _class(tokens)
                if cls is None or cls in seen:
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(cls)
                held.append(_distinct(cut.keys(tokens)))
                size += len(tokens)
                if size >= COUNTED:
                    yield done()
                    held, size = [], 0
        if held:
            yield done()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, size = None, [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            known, place = np.unique(np.concatenate(keys), return_inverse=True)
            return known, np.bincount(place, np.concatenate(counts), len(known)).astype(np.uint64)

        def done() -> pa.RecordBatch:
            known, often = merged()
            several = often > 1
            return _rows([(now, _pack_sorted(known[several]), _pack(often[several]))], COUNTS)

        for batch in batches:
            for bucket, k, c in zip(*(batch.column(x).to_pylist() for x in ("bucket", "keys", "counts"))):
                if bucket != now:
                    if now is not None:
                        yield done()
                    now, keys, counts, size = bucket, [], [], 0
                keys.append(_unpack_sorted(k))
                counts.append(_unpack(c))
                size += len(keys[-1])
                if size >= 2 * BUCKET:  # put together what has come so far, so that a bucket is held as its distinct keys
                    known, often = merged()
                    keys, counts, size = [known], [often], 0
        if now is not None:
            yield done()

    parts = map_arrow(docs.select("text"), count, COUNTS)
    return map_arrow(parts.repartition("bucket").sortWithinPartitions("bucket"), merge, COUNTS)


PIECES = "block string, bucket int, salt int, keys binary, refs binary"
HITS = "block string, bucket int, keys binary, refs binary, counts binary"
PREFIXES = "cls binary, n long, keys array<long>"


def prefixes(docs: DataFrame, counts: DataFrame, cut: Cut, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """cls, n and the keys of the prefix that other sets have too, for each set with such keys: rarest first, ties by key.

    Shingles in one set only come first in that order and meet nothing, so they are left out. Blocks of documents send their keys, with
    the places of the documents, to the counts of each bucket; the shared ones come back to the block.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen, held, size, block = set(), [], 0, 0
        task = TaskContext.get().partitionId()

        def done() -> pa.RecordBatch:
            name = f"{task}-{block}"
            keys = np.concatenate([k for _, _, k in held])
            refs = np.repeat(np.arange(len(held), dtype=np.uint64), [len(k) for _, _, k in held])
            order = np.argsort(keys, kind="stable")
            keys, refs = keys[order], refs[order]
            spread = xxhash.xxh32_intdigest(name)
            own = (name, -1 - spread % (1 << 20), 0, _pack(np.array([n for _, n, _ in held], np.uint64)), b"".join(c for c, _, _ in held))
            return _rows([own, *((name, b, spread % SALTS, _pack_sorted(keys[at]), _pack(refs[at])) for b, at in cut.parts(keys))], PIECES)

        for batch in batches:
            for tokens in shingle_sets(utf8(batch), shingle):
                cls = _class(tokens)
                if cls is None or cls in seen:
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(cls)
                held.append((cls, len(tokens), cut.keys(tokens)))
                size += len(tokens)
                if size >= TOGETHER:
                    yield done()
                    held, size, block = [], 0, block + 1
        if held:
            yield done()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = known = often = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["bucket"] < 0:
                    rows.append((r["block"], r["bucket"], r["keys"], r["refs"], b""))
                elif r["block"] is None:  # the counts come before the pieces
                    here, known, often = (r["bucket"], r["salt"]), _unpack_sorted(r["keys"]), _unpack(r["refs"])
                elif here == (r["bucket"], r["salt"]) and len(known):
                    keys, refs = _unpack_sorted(r["keys"]), _unpack(r["refs"])
                    place = np.searchsorted(known, keys)
                    place[place == len(known)] = 0
                    hit = known[place] == keys
                    if hit.any():
                        rows.append((r["block"], r["bucket"], _pack_sorted(keys[hit]), _pack(refs[hit]), _pack(often[place[hit]])))
            yield _rows(rows, HITS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sizes, names, held = None, None, None, []

        def done() -> pa.RecordBatch:
            if not held:
                return _rows([], PREFIXES)
            keys, refs, often = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((keys, often, refs))
            keys, refs = keys[order], refs[order]
            hits = np.bincount(refs.astype(np.int64), minlength=len(sizes))
            starts = np.cumsum(hits) - hits
            need = prefix_length(sizes, percent) - (sizes - hits)
            return _rows([(names[16 * d : 16 * d + 16], int(sizes[d]), keys[starts[d] : starts[d] + need[d]].astype(np.int64).tolist()) for d in np.flatnonzero(need > 0)], PREFIXES)

        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] < 0:  # the first row of a block
                    if now is not None:
                        yield done()
                    now, sizes, names, held = r["block"], _unpack(r["keys"]).astype(np.int64), r["refs"], []
                else:
                    held.append((_unpack_sorted(r["keys"]), _unpack(r["refs"]), _unpack(r["counts"])))
        if now is not None:
            yield done()

    pieces = map_arrow(docs.select("text"), deal, PIECES)
    salts = F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("salt")
    known = counts.select(F.lit(None).cast("string").alias("block"), "bucket", salts, "keys", F.col("counts").alias("refs"))
    # counts and pieces of a bucket come together as a stream: a task holds the counts of one bucket and one piece
    met = pieces.union(known).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", F.col("block").asc_nulls_first())
    hits = map_arrow(met, match, HITS)
    found = map_arrow(hits.repartition("block").sortWithinPartitions("block", "bucket"), gather, PREFIXES)
    return found.dropDuplicates(["cls"])


# --- lists of sets that share a key -----------------------------------------------------------------------------------------------


def lists(prefix: DataFrame) -> DataFrame:
    """list, size, cls and n: sets that are compared with each other, since they share a key of their prefixes.

    Sets with equal prefixes and size are one group, which takes part in lists as one; keys that lead to the same groups are one list.
    Then groups are expanded to their members; those of a group of several are a list too, if no other list has the group.
    """
    group = F.md5(F.concat_ws(",", F.col("n").cast("string"), F.col("keys").cast("array<string>")))
    members = keep(prefix.select("cls", "n", "keys", group.alias("g")), "groups")
    once = members.groupBy("g").agg(F.first("keys").alias("keys"), F.count("*").alias("own"))
    entries = keep(once.select("g", "own", F.explode("keys").alias("key")), "entries")
    sign = [F.sum(F.xxhash64("g").cast("decimal(38,0)")).alias("s1"), F.bit_xor(F.xxhash64("g", F.lit(1))).alias("s2")]
    heads = entries.groupBy("key").agg(F.count("*").alias("groups"), F.sum("own").alias("size"), *sign).filter("size > 1")
    chosen = keep(heads.groupBy("groups", "size", "s1", "s2").agg(F.min("key").alias("key")).select("key", "size"), "lists")
    met = entries.join(chosen, "key").select(F.col("key").alias("list"), "size", "g")
    return keep(met.join(members.select("g", "cls", "n"), "g").select("list", "size", "cls", "n"), "members")


SETS = "cls binary, n long, marks binary, tokens binary"


def _marks(tokens: np.ndarray) -> bytes:
    """A bit for the parity of the shingles at each place: two sets differ in at least as many shingles as marks. Four places a shingle at least."""
    places = 1 << max(6, (4 * len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1, bitorder="little").tobytes()


def involved_sets(docs: DataFrame, counted: DataFrame, members: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """cls, n, marks and tokens of each set that is in a list; their texts are read once more, one of each set's."""
    wanted = keep(members.select("cls").distinct(), "involved")
    chosen = counted.join(wanted, "cls").groupBy("cls").agg(F.min("text_key").alias("text_key"))
    texts = docs.select("text", "text_key").join(broadcast_if_small(keep(chosen.select("text_key").distinct(), "texts")), "text_key", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows, new = [], []
            for key, text in zip(batch.column("text_key").to_pylist(), utf8(batch)):
                if key not in seen:
                    if len(seen) >= 1 << 20:
                        seen.clear()
                    seen.add(key)
                    new.append(text)
            for tokens in shingle_sets(new, shingle):
                if len(tokens):
                    rows.append((_class(tokens), len(tokens), _marks(tokens), tokens.tobytes()))
            yield _rows(rows, SETS)

    return map_arrow(texts, work, SETS).join(wanted, "cls", "left_semi").dropDuplicates(["cls"])


# --- links ------------------------------------------------------------------------------------------------------------------------


def _alike(percent: int, n: np.ndarray | int, differing: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of n shingles together, `differing` of them in one only, are `percent` alike: shared x 100 >= percent x union."""
    return (100 + percent) * differing <= (100 - percent) * n


def _survivors(left: list[dict], right: list[dict], percent: int, once: bool) -> list[tuple[bytes, bytes]]:
    """Pairs of different components, from left and right, whose sizes and marks don't tell that they are unlike; once: for each of right
    the first such pair only."""
    found = []
    by_width: dict[int, tuple] = {}
    for width in {len(r["marks"]) for r in right}:
        rows = [r for r in right if len(r["marks"]) == width]
        by_width[width] = (
            np.frombuffer(b"".join(r["marks"] for r in rows), np.uint8).reshape(-1, width),
            np.array([r["n"] for r in rows]), [r["cls"] for r in rows], [r["comp"] for r in rows], np.ones(len(rows), bool),
        )
    for x in left:
        own = np.frombuffer(x["marks"], np.uint8)
        for width, (marks, n, names, comps, wanted) in by_width.items():
            a, b = own, marks
            if width > 2 * len(own) or len(own) > 2 * width:
                continue  # one set is more than twice as large as the other: less than 50 % alike
            if width > len(own):
                b = b[:, : len(own)] ^ b[:, len(own) :]
            elif len(own) > width:
                a = a[:width] ^ a[width:]
            differing = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            near = _alike(percent, n + x["n"], np.maximum(differing, np.abs(n - x["n"])))
            for k in np.flatnonzero(near & wanted):
                if comps[k] != x["comp"]:
                    found.append((min(x["cls"], names[k]), max(x["cls"], names[k])))
                    wanted[k] = not once
    return found


def _meet(left: DataFrame, right: DataFrame, percent: int, star: int | None = None, turn: int = 0) -> DataFrame:
    """a and b: distinct pairs out of lists, left members with right ones, that may be alike. In: list, part, held (members).

    star: where there are so many left members, each right one is paired with the first only that it may be alike, in an order that
    is the same in all lists of a turn.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = set()
            for lefts, rights in zip(batch.column("lefts").to_pylist(), batch.column("rights").to_pylist()):
                lefts.sort(key=lambda x: xxhash.xxh64_intdigest(x["cls"], turn))
                pairs.update(_survivors(lefts, rights, percent, star is not None and len(lefts) >= star))
            yield _rows(sorted(pairs), "a binary, b binary")

    near = broadcast_if_small(left.select("list", F.col("held").alias("lefts")), size=NEAR)
    met = right.select("list", F.col("held").alias("rights")).join(near, "list")
    return keep(map_arrow(met.select("lefts", "rights"), work, "a binary, b binary").distinct(), "pairs")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets, compared in full, are alike."""
    x = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                left, right = np.frombuffer(r["x"], np.uint64), np.frombuffer(r["y"], np.uint64)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * shared >= percent * (len(left) + len(right) - shared):
                    rows.append((r["a"], r["b"]))
            yield _rows(rows, "a binary, b binary")

    near = broadcast_if_small(pairs, size=NEAR)
    return keep(map_arrow(x.join(near, "a").join(y, "b").select("a", "b", "x", "y"), work, "a binary, b binary"), "links")


def _blocks(rows: DataFrame, spread: Column) -> DataFrame:
    """Members of a list in blocks of bounded size: list, part, held."""
    return rows.groupBy("list", spread.alias("part")).agg(F.collect_list(F.struct("cls", "n", "marks", "comp")).alias("held"))


def links(members: DataFrame, sets: DataFrame, percent: int = PERCENT, hubs: int = HUBS, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Links that connect what is alike, and node and root of every set that has one.

    Members of a list of fewer than `hubs` are all compared with each other. In larger ones each is compared with `hubs` of them and
    linked to one, round by round with new hubs; what has become one component needs no more comparing. In the end members outside a
    list's largest component are compared with all members of other components, block by block. No link between components
    is missed, and a group's pairs are never all made. A pair is compared by sizes and marks, then in full.
    """
    rows = members.join(sets.select("cls", "marks"), "cls")
    found, roots = None, None
    turn = 0
    while turn <= rounds:
        if found is None:
            now = keep(rows.withColumn("comp", F.col("cls")), "compared")
        else:
            large = members.filter(F.col("size") >= hubs)
            placed = large.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
            mixed = placed.groupBy("list").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("list")
            placed = placed.join(keep(mixed, "mixed"), "list", "left_semi").join(sets.select("cls", "marks"), "cls")
            now = keep(placed.select("list", "size", "cls", "n", "marks", "comp"), "compared")
            if now.isEmpty():
                break
        many = F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / BLOCK))
        whole = keep(_blocks(now, many), "blocks")
        if turn < rounds:
            order = Window.partitionBy("list").orderBy(F.xxhash64("cls", F.lit(turn)), "cls")
            first = now.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= hubs)
            left = keep(_blocks(first, F.lit(0)), "hubs")
        else:
            often = now.groupBy("list", "comp").agg(F.count("*").alias("often"))
            most = keep(often.groupBy("list").agg(F.max_by("comp", F.struct("often", "comp")).alias("most")), "largest")
            left = keep(_blocks(now.join(most, "list").filter("comp <> most"), many), "outside")
        new = _verified(_meet(left, whole, percent, hubs if turn < rounds else None, turn), sets, percent)
        nothing = new.isEmpty()
        if found is None or not nothing:
            found = new if found is None else found.union(new)
            roots = keep(components(found), "roots")
        turn = rounds if nothing and turn < rounds else turn + 1  # hubs that find nothing new: on to the full comparison
    return found, roots


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs`.

    Lower-cased (A-Z) texts are cut at ASCII white space; a set holds the distinct shingles of `shingle` words, or, with fewer words, all of
    them as one. Two documents link when 100 * shared >= `percent` * union, 50 <= percent <= 100; component_id is the smallest
    doc_id that links lead to, itself included. Without words a set is empty, links with nothing, and the component is the row's own
    id. Rows with equal sets, repeated rows among them, are one class, which is compared once. Rows with a null id keep a row; their
    component is that of their set, null when it holds no id. Shingles stand for 64-bit hashes of their words. Other columns are
    not read. Empty in, empty out.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    counted = keep(census(rows, shingle), "census")
    classes = keep(counted.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"), F.first("n").alias("n")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    cut = Cut(total)
    texts = rows.select("text", "text_key").filter("text is not null")
    shared = keep(shared_keys(texts, cut, shingle), "counts")
    members = lists(prefixes(texts, shared, cut, shingle, percent))
    sets = keep(involved_sets(texts, counted, members, shingle), "sets")
    _, roots = links(members, sets, percent)
    placed = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = keep(placed.join(smallest, "root").select("cls", "component_id"), "placed")
    return counted.join(ids, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
