"""Operators against plain Python written from their descriptions, row by row."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from strata.llm import bigru, imatch, licenses, mixing, nbsvm, prefix_join, prefix_trie, simhash, warc, whitening
from test_llm_advice import _examples

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = ["n", "cls", "keys", "depth", "words", "i", "e", "w", "comp", "list", "a", "b", "part", "root", "node"]


def clashing(df):
    return df.withColumns({c: F.lit(c) for c in CLASHING if c not in df.columns})


# --- conversation tries -----------------------------------------------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    nodes, ends, kids = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = sum(saved[k] for k in kids[n]) + ((len(nodes[n]) - 1) * len(WORD.findall(n[-1][1])) if n else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], sha(ends[n])) for n, m in nodes.items())


def tree_of(df, **options):
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(df, **options).collect())


def test_trie_of_the_given_conversations(spark):
    df = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert tree_of(clashing(df)) == plain_trie(rows)


def test_trie_of_hot_long_empty_and_repeated_conversations(spark):
    draw = random.Random(3)
    rows = [(c, t, draw.choice("ab"), draw.choice(["x", "y z", None, ""])) for c in range(-30, 150) for t in range(draw.randrange(0, 6))]
    rows += [(500, t, "a", "w " * (t % 5)) for t in range(1500)] + [(501, t, "a", "w " * (t % 5)) for t in range(1400)]  # dealt over several tasks
    rows += [(c, 0, "u", "same start") for c in range(1000, 1200)] + [(c, 1, "u", f"own {c % 90}") for c in range(1000, 1200)]
    rows += [(None, 1, "a", "lost"), (7, None, None, None), (700, 1, "a", "again"), (700, 1, "a", "again"), (701, 3, None, "L " * 60_000)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6))
    expected = plain_trie(rows)
    for members in (1, 4, None):  # with few members a table, most of the tree is put together from parts
        assert tree_of(df, members=members) == expected, members
    assert tree_of(df.filter("false")) == [] == tree_of(df.filter("conv_id is null"))


def test_node_tables_are_minimal_perfect_and_verified():
    draw = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 20_000):
        keys = draw.integers(-(1 << 62), 1 << 62, (n, 3))
        table = prefix_trie.NodeTable(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(n))
        others = draw.integers(-(1 << 62), 1 << 62, (500, 3))
        assert (table.slots(others) == -1).all()
    with pytest.raises(ValueError, match="one digest"):
        prefix_trie.NodeTable(np.array([[1, 2, 3], [4, 5, 6], [1, 2, 3]]))


# --- n-gram Jaccard join ----------------------------------------------------------------------------------------------------------


def plain_sets(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        words = (text or "").encode().lower().split()
        if words:
            sets[k] = frozenset({tuple(words)} if len(words) < 5 else zip(*(words[j:] for j in range(5))))
    return sets


def plain_components(rows, percent=80):
    sets, up = plain_sets(rows), list(range(len(rows)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    holding = defaultdict(list)
    for k, s in sets.items():
        shared = Counter(o for gram in s for o in holding[gram])
        for o, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                up[find(k)] = find(o)
        for gram in s:
            holding[gram].append(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if k in sets and i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets.get(k, ())), least.get(find(k)) if k in sets else i) for k, (i, _) in enumerate(rows)), key=repr)


def test_join_of_the_given_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = prefix_join.jaccard_components(clashing(df)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(rows)


def test_join_of_large_groups_passages_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(prefix_join, "BLOCK", 16)  # several blocks a list
    monkeypatch.setattr(prefix_join, "TOGETHER", 5_000)  # several blocks of documents a task
    monkeypatch.setattr(prefix_join, "COUNTED", 7_000)
    draw = random.Random(2)
    base, rows = [str(draw.random()) for _ in range(120)], []
    for n in range(150):  # near copies, some of which are linked through others only
        words = list(base)
        for k in draw.sample(range(120), draw.randrange(1, 5)):
            words[k] = str(draw.random())
        rows.append((n, " ".join(words)))
    passage = [f"p{k}" for k in range(60)]  # one that many documents share, alike or not
    rows += [(n, " ".join([*(str(draw.random()) for _ in range(draw.randrange(0, 40))), *passage])) for n in range(150, 260)]
    rows += [(None, rows[0][1]), (600, None), (601, " \t"), (602, "A b"), (603, "a B"), (604, "a b c d"), (605, rows[3][1]), (606, "a b c d e")] * 2
    rows += [(607, "long " * 50_000), (608, "x" * 600_000), (609, "x" * 600_000 + "y")]
    df = clashing(spark.createDataFrame(draw.sample(rows, len(rows)), "doc_id long, text string").repartition(5))
    for percent in (80, 60):
        got = sorted(map(tuple, prefix_join.jaccard_components(df, percent=percent).collect()), key=repr)
        assert got == plain_components(rows, percent), percent
    assert prefix_join.jaccard_components(df.filter("false")).collect() == []
    with pytest.raises(ValueError, match="percent"):
        prefix_join.jaccard_components(df, percent=30)


def test_words_and_shingles_of_a_batch(monkeypatch):
    monkeypatch.setattr(prefix_join, "SPAN", 64)
    draw = random.Random(4)
    texts = [b"", b"  ", b"one", b"\x1cone\x85 two", "É ü".encode(), b"w" * 63 + b" " + b"w" * 64 + b"\n" + b"w" * 200]
    texts += [" ".join(draw.choice(["a", "bb", "ccc", "\xa0", "Ä"]) for _ in range(draw.randrange(60))).encode() for _ in range(200)]
    known = {}
    for text, tokens in zip(texts, prefix_join.shingle_sets(texts)):
        words = text.lower().split()
        grams = {tuple(words)} if 0 < len(words) < 5 else set(zip(*(words[j:] for j in range(5))))
        starts, hashes = prefix_join.word_hashes(text.lower())
        assert [text.lower()[s : s + len(w)] for s, w in zip(starts, words)] == words
        assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes.tolist()))
        assert len(tokens) == len(grams) and (np.diff(tokens.astype(object)) > 0).all()
        assert known.setdefault(frozenset(grams), tokens.tobytes()) == tokens.tobytes()
    names = [k for k in known if isinstance(k, bytes)]
    assert len({known[k] for k in names}) == len(names)


# --- whitening --------------------------------------------------------------------------------------------------------------------


def test_whitening_equals_a_dense_solver(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    held = df.toPandas()
    x = np.floor(64 * np.array(held.embedding.tolist(), float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = whitening.whiten(clashing(df)).toPandas()
    assert len(got) == 32 * n and (got.n == n).all() and (got.identity_error < 1e-9).all() and got.identity_error.nunique() == 1
    deviation = dict(zip(held.vec_id, (int(v) for v in ((n * x - total).astype(object) ** 2).sum(axis=1))))
    assert (got.deviation == got.vec_id.map(deviation)).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[held.vec_id].to_numpy()
    expected = centred @ vectors[:, :32] / np.sqrt(values[:32])
    assert np.abs(np.abs(wide) - np.abs(expected)).max() < 1e-7
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, values[:32] / values.sum(), rtol=1e-10)
    again = whitening.whiten(df).toPandas()
    assert again.sort_values(["vec_id", "component"]).whitened.tolist() == got.sort_values(["vec_id", "component"]).whitened.tolist()


def test_inertia_counts_and_clustered_eigenvalues():
    draw = np.random.default_rng(1)
    for d in (1, 2, 7, 40):
        matrix = draw.standard_normal((d, d))
        matrix = matrix + matrix.T
        for shift in (-3.0, 0.0, 0.4):
            assert whitening.positive_pivots(matrix - shift * np.eye(d)) == (np.linalg.eigvalsh(matrix) > shift).sum()
    assert whitening.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1 and whitening.positive_pivots(np.zeros((3, 3))) == 0
    turn, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    for values in (np.r_[[5.0] * 12, [3.0] * 20, [1.0] * 8], 10.0 ** np.linspace(-9, 4, 40), np.r_[np.zeros(36), 1, 1, 2, 2 + 1e-13], np.full(40, 1e-300)):
        matrix = turn @ np.diag(values) @ turn.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = whitening.leading_pairs(matrix, 32)
        assert len(found) == min(32, int((values > 1e-12 * values.max()).sum()))
        assert np.abs(found - np.sort(values)[::-1][: len(found)]).max() < 1e-13 * values.max()
        assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-13
        assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-11 * values.max()


def test_whitening_of_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0]), (None, [0.5, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0])]
    rows += [(7, []), (8, [1.0, 2.0, 3.0]), (9, [2.0, 2.0, 2.0])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = whitening.whiten(df).toPandas()
    pairs = got[got.n == 4]
    assert sorted(pairs.vec_id.fillna(-1)) == [-1, -1, 1, 1, 1, 1, 2, 2] and sorted(set(pairs.component)) == [1, 2] and (pairs.identity_error < 1e-12).all()
    # two vectors of another length vary in one direction only
    assert sorted(got[got.n == 2].vec_id) == [8, 9] and set(got[got.n == 2].component) == {1}
    assert np.allclose(np.abs(got[got.n == 2].whitened), 1)
    assert whitening.whiten(df.filter("false")).collect() == [] == whitening.whiten(df.filter("vec_id = 2")).collect()
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()


# --- I-Match ----------------------------------------------------------------------------------------------------------------------


def x64(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def plain_imatch(texts: dict[int, str]):
    """Fingerprints and likenesses of all documents, from the description in imatch.py and the README."""
    terms = lambda t: list(dict.fromkeys(regex.findall(r"[\p{L}\p{N}]+", t.lower())))
    distinct = {t.lower() for t in texts.values()}
    df = Counter(term for t in distinct for term in terms(t))
    low, high = 0.0005 * len(distinct), max(0.002 * len(distinct), 2)

    def mask(term):
        bits = 0
        for j in range(32):
            if x64(struct.pack("<i", j), x64(term.encode())) & ((1 << (j // 4 + 1)) - 1) == 0:
                bits |= 1 << j
        return bits

    class Masks(dict):
        def __missing__(self, term):  # an edit may cut a term in two
            return self.setdefault(term, mask(term))

    masks = Masks()

    def parts(entries):
        out = []
        for j in range(32):
            own, seed = [e for e in entries if e[1] >> j & 1], 42
            for name, bits in own:
                seed = x64(struct.pack("<q", bits), x64(name, seed))
            out.append(f"{seed & 0xFFFFFFFF:08x}" if own else "-" * 8)
        return out

    def look(text):
        found = sorted((df[t] if df[t] >= low else 0, t.encode(), t) for t in terms(text))
        own = [(name, masks[t]) for n, name, t in found if low <= df[t] <= high]
        most = 2 * found[(len(found) - 1) // 2][0] if found else 0
        wide = [(struct.pack("<q", signed(x64(name))), masks[t]) for n, name, t in found if n <= most]
        a, b = parts(own), parts(wide)
        if set(a) != {"-" * 8}:
            return "".join(a), a, b
        if set(b) != {"-" * 8}:
            return "~" + "".join(b), [], b
        return f"={x64(text.lower().encode()):016x}", [], b

    def likeness(x, y):
        if x[0] == y[0]:
            return 1.0
        if "=" in (x[0][0], y[0][0]):
            return 0.0
        share = lambda p, q, more: sum(s == t != "-" * 8 for s, t in zip(p, q)) / (sum(s != "-" * 8 or t != "-" * 8 for s, t in zip(p, q)) + more)
        if "~" in (x[0][0], y[0][0]):
            return share(x[2], y[2], sum(p != "-" * 8 for z in (x, y) for p in z[1]))
        return share(x[1], y[1], 0)

    ids = sorted(texts, reverse=True)
    looks = {i: look(t) for i, t in texts.items()}
    out = {}
    for own, after in zip(ids, ids[1:] + ids[:1]):
        third = len(texts[own]) // 3
        edited = look(texts[own][: len(texts[own]) - third] + texts[after][:third])
        out[own] = (looks[own][0], edited[0], likeness(looks[own], edited), likeness(looks[own], looks[after]))
    return out


def test_imatch_equals_plain_python(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    extra = {-1: "", -2: "?!", -3: "Zweimal zweimal", -4: texts[min(texts)].upper()}
    rows = spark.createDataFrame(list(extra.items()), "doc_id long, text string")
    got = imatch.edited_fingerprints(df.select("doc_id", "text").union(rows)).collect()
    expected = plain_imatch(texts | extra)
    assert len(got) == len(expected)
    for r in got:
        own = expected[r.doc_id]
        assert (r.fingerprint, r.edited_fingerprint) == own[:2] and (r.near_edited, r.near_next) == pytest.approx(own[2:]), r.doc_id


# --- others -----------------------------------------------------------------------------------------------------------------------


def test_simhash_of_all_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in simhash.simhash_groups(df).collect():
        words = texts[r.doc_id].encode().lower().split()
        grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [x64(g) for g in grams]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert r.fingerprint == f"{bits:016x}", r.doc_id


def test_every_license_rule_wins_on_its_own_examples():
    rules = licenses.read_rules(licenses.RULES)
    scanner = licenses.Scanner(rules)
    for rule in rules:
        for text in _examples(re._parser.parse(rule.pattern.pattern)):
            *_, spans = scanner.scan(text.encode() + b" ")
            assert rule.label in {label for label, *_ in spans}, (rule.label, text)
    labels = lambda t: {label for label, *_ in scanner.scan(t)[-1]}
    assert labels(b"SPDX-License-Identifier: MIT-0") == {"mit-0"} and labels(b"SPDX-License-Identifier: MIT and more") == {"mit"}


def test_mix_with_a_third_of_a_source_in_one_row(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(1, "w " * 400, "a")] * 30 + [(n, "v " * draw.randrange(1, 60), "a") for n in range(2, 260)] + [(n, "v " * draw.randrange(1, 90), "b") for n in range(300, 900)]
    rows += [(None, "x y", "b")] * 40 + [(5000, None, "a"), (5001, "u", None), (5001, "u", None)]
    df = spark.createDataFrame(draw.sample(rows, len(rows)), "doc_id long, text string, source string")
    whole = None
    for repeats in (10_000, 7):  # one repeated row made by one task, by several
        monkeypatch.setattr(mixing, "REPEATS", repeats)
        got = mixing.mix_sources(df).toPandas()
        assert len(got) == len(rows) and got.copies.between(0, 3).all()
        for source, own in got.groupby("source", dropna=False):
            off = own.taken.sum() - own.target.iloc[0]
            open_ = own[(own.copies < 3) if off < 0 else (own.copies > 0)]["size"]
            assert abs(off) <= max(own.target.iloc[0] / 4096, open_[open_ > 0].min() if (open_ > 0).any() else np.inf), (source, off)
        same = got[got.doc_id == 1].copies
        assert same.max() - same.min() <= 1
        documents = mixing.mixed_documents(df)
        assert documents.count() == got.copies.sum() and documents.filter("doc_id = 1").count() == same.sum()
        ordered = got.sort_values(["doc_id", "source", "copies"]).taken.tolist()
        assert whole in (None, ordered)
        whole = ordered


def test_newton_steps_converge_quadratically(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(mixing, "keep", lambda df, label, real=mixing.keep: (steps.append(label), real(df, label))[1])
    mixing.mix_sources(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    assert steps.count("tilts") <= 20


def test_a_step_of_the_mix_is_one_write_and_few_tasks(spark, conf, monkeypatch):
    conf("spark.sql.shuffle.partitions", "60")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tracker, kept, count = spark.sparkContext.statusTracker(), [], []

    def tasks(group):
        found = {s: tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
        return sum(s.numCompletedTasks for s in found.values() if s)

    def counted(df, label, real=mixing.keep):
        kept.append(label)
        spark.sparkContext.setJobGroup(f"{label} {len(kept)} of the mix", "")
        try:
            return real(df, label)
        finally:
            count.append((label, tasks(f"{label} {len(kept)} of the mix")))
            spark.sparkContext.setJobGroup("beside the mix", "")

    monkeypatch.setattr(mixing, "keep", counted)
    draw = random.Random(7)
    rows = [(n, "v " * draw.randrange(1, 400), draw.choice("aabc")) for n in range(600)]
    spark.sparkContext.setJobGroup("beside the mix", "")
    try:
        final = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(2))
        steps = [n for label, n in count if label == "tilts"]
        assert len(steps) > 2 and max(steps) < 60
        assert tasks("beside the mix") == 0
        assert len(final.collect()) == 600
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    rows = [(n, f"u{n}", bytearray(f"page {n} ".encode() * 50)) for n in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, uri string, payload binary").coalesce(1)
    return warc.write_archives(warc.with_revisits(pages), str(tmp_path_factory.mktemp("whole")))


def test_streams_that_end_early_raise(spark, archives, tmp_path):
    [archive] = archives.collect()
    data = open(archive.archive, "rb").read()
    whole = list(warc.split_records(warc.inflate(io.BytesIO(data))))
    assert len(whole) == 8
    for gone in range(1, 9):  # the trailer
        with pytest.raises(ValueError, match="cut off"):
            list(warc.split_records(warc.inflate(io.BytesIO(data[:-gone]))))
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    flushed = pack.compress(b"".join(whole[:4])) + pack.flush(zlib.Z_SYNC_FLUSH)  # ends between two records
    with pytest.raises(ValueError, match="cut off"):
        list(warc.split_records(warc.inflate(io.BytesIO(flushed))))
    # a good stream of fewer records than were written
    short = tmp_path / "short.warc.gz"
    short.write_bytes(gzip.compress(b"".join(whole[:4])))
    listed = spark.createDataFrame([(str(short), 8)], "archive string, records long")
    with pytest.raises(Exception, match="holds 4 records, not 8"):
        warc.normalise(listed, str(tmp_path / "members"))
    assert warc.normalise(listed.drop("records"), str(tmp_path / "members")).count() == 4
    assert list(warc.inflate(io.BytesIO(b""))) == []


def test_archives_of_any_number_are_few_partitions(spark):
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hundred_tb = 100 << 40
    assert warc.parts(spark, hundred_tb // warc.ARCHIVE_BYTES) == warc.parts(spark, hundred_tb // warc.SPAN) == warc.TASKS * shuffle
    assert warc.parts(spark, 3) == 3 and warc.parts(spark, 0) == 1


def test_a_folder_without_scheme_is_where_spark_puts_it(spark):
    assert warc.qualified(spark, "/tmp/x") == "file:///tmp/x" and warc.qualified(spark, "file:///tmp/x") == "file:///tmp/x"


def test_dual_descent_solves_the_dual():
    """Against projected gradient steps on the same box-constrained problem."""
    draw = np.random.default_rng(8)
    x, y = draw.standard_normal((60, 12)), np.where(draw.random(60) < 0.5, -1, 1)
    x[:, 0] += 0.7 * y
    cost = np.where(y == 1, 0.8, 0.3)
    rows = [(np.arange(12), v) for v in x]
    w = nbsvm.dual_descent(rows, y, cost, 12, passes=3000)
    signed_rows = x * y[:, None]
    gram = signed_rows @ signed_rows.T
    alpha = np.zeros(60)
    for _ in range(200_000):
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.eigvalsh(gram)[-1] if _ == 0 else alpha - (gram @ alpha - 1) * step, 0, cost)
        step = 1 / np.linalg.eigvalsh(gram)[-1] if _ == 0 else step
        if _ % 1000 == 999 and np.abs(np.clip(alpha - (gram @ alpha - 1) * step, 0, cost) - alpha).max() < 1e-9:
            break
    assert np.abs(w - alpha @ signed_rows).max() < 2e-3
    primal = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    assert primal(w) <= primal(alpha @ signed_rows) * (1 + 1e-3)


def test_windows_scored_one_at_a_time():
    draw = random.Random(9)
    words = [f"w{n}" for n in range(60)]
    texts, marks = [], []
    for n in range(60):
        own = [draw.choice(words) for _ in range(draw.randrange(5, 120))]
        if n % 3 == 0:
            own.insert(draw.randrange(len(own)), "vile")
        texts.append(" ".join(own).encode())
        marks.append(int(n % 3 == 0))
    model = bigru.fit(texts, np.array(marks))
    together = model.best(texts)
    for text, best in zip(texts, together):
        own = text.split()
        count = 1 + max(0, -(-(len(own) - bigru.WINDOW) // bigru.STRIDE))
        pieces = [b" ".join(own[k * bigru.STRIDE : k * bigru.STRIDE + bigru.WINDOW]) for k in range(count)]
        assert max(model.best([p])[0] for p in pieces) == pytest.approx(best, abs=1e-4)
    scores = model.scores(texts)
    assert (np.argsort(scores, kind="stable") == np.argsort(together, kind="stable")).all() or np.all(np.diff(scores[np.argsort(together)]) >= -1e-9)
    assert isinstance(pd.Series(scores).mean(), float)
