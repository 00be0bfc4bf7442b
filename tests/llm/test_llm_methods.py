"""The operators' methods against other ways to the same result."""

from __future__ import annotations

import gzip
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from strata.llm import bigru, bpe, labelled, licenses, nbsvm, simhash, threshold, token_counts, warc

PIECES = st.lists(st.sampled_from(["a", "aa", "b", "the", " ", "  ", "\n", "'s", "'", "re", "1", "é", "漢", "!!", "<|endoftext|>", "<|", "|>", "Zz", "\U0001f600"]), max_size=120)
RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN, memory=50)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
COUNTER = token_counts.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES.map("".join), max_size=4))
def test_bpe_equals_the_library_and_decodes(texts):
    for text, packed in zip(texts, ENCODER.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == REFERENCE.encode_ordinary(text)
        assert ENCODER.decode(packed) == text.encode()


def test_bpe_of_very_long_pieces():
    draw = random.Random(3)
    for text in ("a" * 50_000, "".join(draw.choice("abcdefgh") for _ in range(50_000)), "x y " * 800_000):
        [packed] = ENCODER.encode([text])
        assert np.frombuffer(packed, "<u4").tolist() == REFERENCE.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(PIECES.map("".join).filter(bool), st.sampled_from([5, 11, 30]), st.sampled_from([1, 3, 5]))
def test_spliced_counts_equal_whole_ones(text, chunk, overlap):
    whole = len(LIBRARY.encode(text, add_special_tokens=False))
    assert token_counts.spliced_count(text, COUNTER, chunk, overlap)[0] == whole
    assert COUNTER.counts([text]) == [whole]


def test_overlaps_widen_over_a_piece_longer_than_chunks():
    text = "word " * 500 + "a" * 5000 + " tail" * 300
    count, widened = token_counts.spliced_count(text, COUNTER, 256, 16)
    assert widened and count == len(LIBRARY.encode(text, add_special_tokens=False))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 6), st.integers(0, 10_000), st.booleans())
def test_threshold_algorithm_equals_scoring_all(n, dims, seed, few):
    draw = np.random.default_rng(seed)
    vectors = draw.integers(-3 if few else -9999, 4 if few else 9999, (n, dims))
    ids = draw.permutation(n).astype(np.int64)
    lists, query = threshold.Lists(ids, vectors), draw.integers(-5, 6, dims)
    expected = sorted((-int(v @ query), int(i)) for v, i in zip(vectors, ids))[:5]
    assert [(s, i) for s, i, _ in lists.top(query, 5)] == [(-s, i) for s, i in expected]
    # the same with products beyond a long
    far = threshold.Lists(ids, vectors.astype(float) * 2.0**70)
    assert [(s, i) for s, i, _ in far.top(query, 5)] == [(-s << 70, i) for s, i in expected]


def test_threshold_algorithm_stops_early():
    """One vector far ahead of the others in all dimensions: few rows of the lists are read."""
    n, met = 5000, []
    vectors = np.random.default_rng(0).integers(-3, 4, (n, 4))
    vectors[:6] = 100
    lists = threshold.Lists(np.arange(n), vectors)

    class Counted(np.ndarray):
        def __getitem__(self, item):
            if isinstance(item, np.ndarray) and item.dtype.kind == "i":
                met.append(len(item))
            return super().__getitem__(item)

    _, held, values = lists._exact(np.ones(4))
    lists.held = {"f8": (held.view(Counted), values)}
    assert [i for _, i, _ in lists.top(np.ones(4), 5)] == [0, 1, 2, 3, 4]
    assert sum(met) < 100


def test_normaliser_reads_any_gzip_and_refuses_damage(tmp_path):
    records = [warc.record("response", k, b"u", bytes([k]) * (k * 5000), "d", None) for k in range(1, 9)]
    one, many = tmp_path / "one.gz", tmp_path / "many.gz"
    one.write_bytes(gzip.compress(b"".join(records)))
    many.write_bytes(b"".join(map(gzip.compress, records)))
    for path in (one, many):
        with path.open("rb") as stream:
            assert list(warc.split_records(warc.inflate(stream))) == records
    (tmp_path / "cut.gz").write_bytes(one.read_bytes()[:-20])
    with (tmp_path / "cut.gz").open("rb") as stream, pytest.raises(Exception):
        list(warc.split_records(warc.inflate(stream)))


def test_index_leads_to_single_members(spark, tmp_path):
    import pathlib
    import zlib

    pages = spark.createDataFrame([(n, f"u{n}", chr(65 + n) * 3000) for n in range(12)], "page_id long, url string, html string")
    rows = warc.warc_round_trip(pages, str(tmp_path / "w"), archive_bytes=10_000).collect()
    assert len(rows) == 12 and len({r.archive for r in rows}) > 1
    for r in rows:
        data = pathlib.Path(r.archive.removeprefix("file://")).read_bytes()[r.offset : r.offset + r.length]
        unzip = zlib.decompressobj(31)
        _, block = warc.parse(unzip.decompress(data))
        assert unzip.eof and not unzip.unused_data and block == bytes(r.payload)
        assert f"{r.page_id} response {r.offset} {r.length}" in pathlib.Path(r.archive.removeprefix("file://") + ".cdx").read_text()


def test_fingerprint_in_blocks_equals_bit_counting(monkeypatch):
    import xxhash

    words = [f"w{k % 50}" for k in range(1000)]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(998)]
    slow = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 998)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(" ".join(words).upper().encode()) == slow
    assert simhash.fingerprint(b"a b") == xxhash.xxh64_intdigest(b"a b", 42)


def test_rules_are_hundreds_and_contained_hits_go():
    rules = licenses.read_rules(licenses.RULES)
    assert len(rules) > 200
    scanner = licenses.Scanner(rules)
    *_, labels, spans = scanner.scan(b"Licensed under the Apache License, Version 2.0 (the License)")
    assert labels == ["apache"] and spans[0] == ("apache-2.0", 95, 0, 8) and len(spans) == 1
    assert scanner.scan(b"apachelicense smithlicense")[5] == []


def test_dual_descent_separates():
    draw = np.random.default_rng(1)
    rows, y = [], []
    for k in range(200):
        label = 1 if k % 2 else -1
        places = np.array([0 if label > 0 else 1, *draw.choice(np.arange(2, 50), 5, replace=False)])
        rows.append((places, np.ones(6)))
        y.append(label)
    w = nbsvm.dual_descent(rows, np.array(y), np.ones(200), 50)
    assert all(label * w[p].sum() > 0 for (p, _), label in zip(rows, y))
    assert w[0] > abs(w[2:]).max() and w[1] < -abs(w[2:]).max()


def test_calibration_is_monotone_and_fits():
    margins = np.concatenate([np.random.default_rng(0).normal(-2, 1, 500), np.random.default_rng(1).normal(2, 1, 500)])
    y = np.repeat([0, 1], 500)
    a, b = labelled.calibrate(margins, y, np.ones(1000))
    p = labelled.sigmoid(a * margins + b)
    assert a > 0 and abs(p.mean() - 0.5) < 0.02 and ((p > 0.5) == y).mean() > 0.95


def test_slopes_of_the_network_are_those_of_its_loss():
    words = [b"alpha", b"beta", b"gamma", b"delta", b"a"]
    trainer = bigru.Trainer(words, (np.zeros(1 << bigru.BITS, np.float32), np.zeros(1 << bigru.BITS, np.float32)))
    trainer.p = {k: v.astype(np.float64) for k, v in trainer.p.items()}
    rows = np.zeros((3, bigru.WINDOW), np.int64)
    rows[0, :5], rows[1, :2], rows[2, 0] = [1, 2, 3, 4, 5], [2, 2], 3
    y, weights = np.array([1, 0, 1]), np.array([1.0, 2.0, 1.0])
    model = bigru.Network(trainer.p)

    def loss() -> float:
        model.known, model.table = {}, None
        model.numbers([words])
        gates = np.concatenate([np.zeros((1, 6 * bigru.HIDDEN)), model.inputs(words) @ trainer.p["in"] + trainer.p["in_bias"]])
        model.table = gates.astype(np.float32)
        chance = labelled.sigmoid(model.logits(rows).astype(np.float64))
        return float(-(weights * np.log(np.where(y == 1, chance, 1 - chance))).mean())

    kept = {k: v.copy() for k, v in trainer.p.items()}
    before = loss()
    step = trainer.step(rows, y, weights)
    assert step == pytest.approx(before, rel=1e-3)
    slopes = {k: trainer.first[k] / 0.1 for k in trainer.first}
    for name in ("out", "forward", "backward", "look", "see", "in", "in_bias"):
        place = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        trainer.p.update({k: v.copy() for k, v in kept.items()})
        model.p = trainer.p
        around = []
        for way in (1, -1):
            trainer.p[name] = kept[name].copy()
            trainer.p[name][place] += way * 1e-2
            around.append(loss())
        assert (around[0] - around[1]) / 2e-2 == pytest.approx(slopes[name][place], rel=0.05, abs=2e-4)


def test_windows_overlap_and_cover():
    for n in (0, 1, 48, 49, 80, 200):
        found = bigru.windows(np.arange(1, n + 1))
        assert found.shape[1] == bigru.WINDOW and set(found.ravel()) - {0} == set(range(1, n + 1))
    assert (bigru.windows(np.arange(1, 201))[1] == np.arange(bigru.STRIDE + 1, bigru.STRIDE + 1 + bigru.WINDOW)).all()
