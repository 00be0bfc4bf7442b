"""Every operator on nulls, empty and very long texts, repeated rows, no rows, and further columns with names it uses itself."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from strata.llm import bigru, bpe, imatch, licenses, mixing, nbsvm, simhash, threshold, token_counts, warc
from strata.llm.components import components

LONG = "lorem ipsum dolor " * 40_000
TEXTS = [None, "", "  \t\n", "one", "one two three four five", LONG, "Ünïcödé 漢字 text", "MIT License", "<|endoftext|> x"]
CLASHING = ["fp", "key", "row", "size", "k", "part", "place", "term", "score", "decision", "copies", "rate", "h", "ids"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "en", ("a", "b", None)[n % 3]) for n, t in enumerate(TEXTS)]
    rows += [(3, "one", "en", "a"), (3, "one", "en", "a"), (None, "one", None, None), (None, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return table.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(n, n % 2, n % 2) for n in range(9)] + [(None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


def by_id(df):
    return sorted(map(tuple, df.collect()), key=repr)


TEXT_OPERATORS = {
    "mixing": lambda d, x: mixing.mix_sources(d),
    "tokens": lambda d, x: token_counts.count_tokens(d, public_tokenizers.path("byte_bpe_50k.json"), 1024),
    "imatch": lambda d, x: imatch.edited_fingerprints(d),
    "bpe": lambda d, x: bpe.encode_documents(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    "quality": lambda d, x: nbsvm.quality_scores(d, x),
    "simhash": lambda d, x: simhash.simhash_groups(d),
    "licenses": lambda d, x: licenses.scan_licenses(d),
    "toxicity": lambda d, x: bigru.toxicity_scores(d, x),
}


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_a_row_for_each_row_and_none_for_none(docs, none, labels, name):
    got = TEXT_OPERATORS[name](docs, labels)
    ids = sorted((r.doc_id for r in got.select("doc_id").collect()), key=repr)
    assert ids == sorted((r.doc_id for r in docs.select("doc_id").collect()), key=repr)
    empty = TEXT_OPERATORS[name](none, labels.filter("false"))
    assert empty.columns == got.columns and empty.collect() == []


def test_repeated_rows_and_null_texts_have_equal_results(docs, labels):
    tokens = {(r.doc_id, r.n_bytes, r.n_tokens) for r in TEXT_OPERATORS["tokens"](docs, labels).filter("doc_id in (0, 1, 3)").collect()}
    assert tokens == {(0, 0, 0), (1, 0, 0), (3, 3, 1)}
    prints = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).filter("doc_id is not null").collect()}
    assert prints[0] == prints[1] == prints[2] == ("0" * 16, 0)
    scanned = {r.doc_id: r for r in licenses.scan_licenses(docs).filter("doc_id is not null").collect()}
    assert (scanned[0].n_words, scanned[0].first_word, scanned[0].labels, scanned[0].score) == (0, None, "", 0.0)
    assert (scanned[7].base_labels, scanned[7].n_base, scanned[7].first_word) == ("mit", 1, 0)


def test_row_filters_keep_all_columns(docs, none, labels):
    for stage in (lambda d: nbsvm.good_documents(d, labels), lambda d: bigru.clean_documents(d, labels), simhash.one_of_each_group, mixing.mixed_documents):
        assert stage(docs).columns == docs.columns
        stage(docs).collect()
        assert stage(none).collect() == []


def test_one_row_of_each_group_stays(docs):
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each_group(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(0, None), *((n, t) for n, t in enumerate(TEXTS) if n > 2)], key=repr)


def test_null_source_is_the_last(docs):
    rows = mixing.mix_sources(docs).collect()
    target = {r.source: r.target for r in rows}
    size = {r.source: r.source_size for r in rows}
    assert set(target) == {"a", "b", None} and sum(target.values()) == pytest.approx(sum(size.values()))
    assert all(target[s] <= 3 * size[s] + 1e-9 for s in target)


def test_pages(spark):
    big = "x" * 2000
    rows = [(1, "u", big), (2, None, big), (2, None, big), (None, "u\n", big), (3, "v", None), (4, "w", ""), (5, "é ü", "y" * 999), (6, "", "y" * 999), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("n", F.lit(2))
    got = by_id(warc.warc_round_trip(pages, archive_bytes=3000).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    expected = [(i, len(h or ""), sha(h), *(("revisit", 2) if h == big and i != 2 else ("response", None))) for i, _, h in rows]
    assert got == sorted(expected, key=repr)
    assert warc.warc_round_trip(pages.filter("false")).collect() == []


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0])]
    rows += [(6, [float("inf"), 0.0]), (7, [1.0]), (None, [9.0, 9.0]), (8, []), (50, []), (51, []), (9, [1e10, 1.0]), (10, [600000.0, 1.0]), (11, [-600000.0, 1.0])]
    rows += [(12, [0.0, -1.0]), (13, [1e30, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("s")).withColumn("v", F.lit(0))

    def plain(wanted, among):
        held = [(i, [math.floor(256 * x) for x in e]) for i, e in among if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
        out = []
        for a, (q, x) in enumerate(held):
            if q in wanted:
                others = sorted((-sum(s * t for s, t in zip(x, y)), j) for b, (j, y) in enumerate(held) if b != a and len(x) == len(y))
                out += [(q, k + 1, j, -s) for k, (s, j) in enumerate(others[:5])]
        return sorted(out, key=repr)

    finite = vectors.filter("vec_id <> 13 or vec_id is null")
    for ids in ((0, 8, 50, 51), (7,), (1, 2), (12,)):
        got = by_id(threshold.top_k(finite, finite.filter(F.col("vec_id").isin(*ids)), k=5))
        assert got == plain(ids, rows[:-1]) and (ids == (7,)) == (got == [])
    assert (0, 1, 9, 655360000000000) in by_id(threshold.top_k(finite, finite.filter("vec_id = 0"), k=5))
    # a component of any size takes part; only a result that is beyond a long raises
    assert by_id(threshold.top_k(vectors, vectors.filter("vec_id = 12"), k=5)) == plain((12,), rows)
    with pytest.raises(Exception, match="beyond a long"):
        threshold.top_k(vectors, vectors.filter("vec_id = 0"), k=5).collect()
    few = vectors.filter("vec_id in (11, 13)")
    with pytest.raises(Exception, match="beyond a long"):
        threshold.top_k(few, few.filter("vec_id = 11"), k=5).collect()
    assert threshold.top_k(vectors.filter("false"), vectors.filter("false")).collect() == []


def test_stages_keep_all_rows_where_labels_lack_a_class(docs, labels):
    for marks in (labels.filter("false"), labels.filter("quality = 0 and toxic = 0")):
        for stage in (nbsvm.good_documents, bigru.clean_documents):
            assert stage(docs, marks).count() == docs.count()


def test_components(spark):
    chain = spark.range(60).selectExpr("id as a", "id + 1 as b")
    loops = spark.createDataFrame([(100, 100), (102, 101), (102, 101), (103, 102)], "a long, b long")
    got = {r.node: r.root for r in components(chain.union(loops)).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 101: 101, 102: 101, 103: 101}
    assert components(chain.filter("false")).collect() == []


def test_groups_beyond_the_limit_are_cut_further(spark):
    """Fingerprints around one centre, many more than `group`: the finer signatures find the same pairs."""
    from itertools import combinations

    centre = 0x0123456789ABCDEF
    near = {centre} | {centre ^ (1 << i) for i in range(60)} | {centre ^ (1 << i) ^ (1 << j) for i, j in combinations(range(20), 2)}
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    prints = spark.createDataFrame([(x,) for x in signed], "fp long")
    expected = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    for group in (4, 1000):
        pairs = simhash.near_pairs(prints, 3, group).collect()
        assert len(pairs) == len(set(pairs)) and {tuple(p) for p in pairs} == expected
