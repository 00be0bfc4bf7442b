"""What a second reading of the operators found to be left out."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm import imatch, labelled, licenses


def _words(seed, n, of):
    draw = random.Random(seed)
    return [f"{of}{draw.randrange(10_000)}" for _ in range(n)]


def test_imatch_of_large_groups_of_copies_and_near_copies(spark):
    others = [" ".join(_words(n, 30, "w") + _words(-n, 30, "v")) for n in range(600)]
    copy = " ".join(_words("copy", 80, "w"))
    near = [" ".join([*_words("near", 80, "x"), f"own{n}"]) for n in range(300)]
    rows = [*enumerate(others), *((1000 + n, copy) for n in range(300)), *((2000 + n, t) for n, t in enumerate(near))]
    docs = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.edited_fingerprints(docs, band=(0.002, 0.01)).collect()}
    assert not any(r.fingerprint.startswith("=") for r in got.values())
    assert len({got[1000 + n].fingerprint for n in range(300)}) == 1
    alike = [got[2000 + n].near_next for n in range(1, 300)]
    assert sum(x > 0.3 for x in alike) > 0.95 * len(alike)
    # the first of each group goes before a text of another kind
    assert got[1000].near_edited > 0 and got[2000].near_edited > 0
    assert got[1000].near_next < 0.1 and got[2000].near_next < 0.1


def test_imatch_counts_a_text_once(spark):
    docs = spark.createDataFrame([("same Words",)] * 50 + [("SAME words",)] * 50 + [(f"other{n}",) for n in range(20)], "text string")
    df = {r.term: (r.df, r.banded) for r in imatch.lexicon(docs, band=(0.01, 0.1)).collect()}
    assert df["same"] == df["words"] == (1, True) and len(df) == 22


def test_imatch_orders_ranges_without_their_texts(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(imatch, "keep", lambda df, label, real=imatch.keep: kept.setdefault(label, df) and real(df, label))
    docs = spark.createDataFrame([(n, f"text of {n} here") for n in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in imatch.edited_fingerprints(docs, range_rows=5).collect()}
    for n in range(40):
        text, after = f"text of {n} here", f"text of {(n - 1) % 40} here"
        assert got[n] == hashlib.sha256((text[: len(text) - len(text) // 3] + after[: len(text) // 3]).encode()).hexdigest()
    windows = {label for label, df in kept.items() if "Window" in df._jdf.queryExecution().optimizedPlan().toString()}
    assert windows == {"behind"} and kept["behind"].columns == ["part", "behind"]


def _examples(parsed):
    """Texts that a parsed pattern matches: every branch, optional parts once and not at all, gaps as short as they may be."""
    texts = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            more = [chr(v) for o, v in value if str(o) == "LITERAL"]
        elif name == "BRANCH":
            more = [x for branch in value[1] for x in _examples(branch)]
        elif name == "SUBPATTERN":
            more = _examples(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            more = ["x" * value[0]] if str(value[2][0][0]) == "ANY" else [x * n for n in {value[0], min(1, value[1])} for x in _examples(value[2])]
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
            more = [""]
        texts = [a + b for a in texts for b in dict.fromkeys(more)]
    return texts


def test_license_keywords_stand_in_all_that_their_patterns_match():
    for rule in licenses.read_rules(licenses.RULES):
        for text in _examples(re._parser.parse(rule.pattern.pattern)):
            text = " ".join(text.split()).encode()
            assert rule.keyword in text.split(), (rule.label, rule.keyword, text)
            assert rule.pattern.search(b" " + text + b" "), (rule.label, text)


def test_licenses_found_without_the_word_of_the_other_wording():
    scanner = licenses.Scanner(licenses.read_rules(licenses.RULES))
    found = lambda text: {label for label, *_ in scanner.scan(text)[-1]}
    assert "gpl-classpath-exception" in found(b"As a special exception, the holders give you permission to link this library with independent modules.")
    assert found(b"The Beerware License") == found(b"the beer-ware license") == {"beerware"}


def test_sample_takes_each_id_once_and_only_those_at_hand(spark):
    marks = spark.createDataFrame([(n, n % 2) for n in range(200)] * 3, "doc_id long, toxic int")
    rows = [(n, f"text {n}") for n in range(100)] + [(n, "x" * 50) for n in range(100, 150)]
    docs = spark.createDataFrame(rows * 4 + [(n, f"a text {n}") for n in range(100)], "doc_id long, text string")
    held = {r.id for r in spark.range(200).filter(labelled.held_out(F.col("id"))).collect()}
    for most in (10, 1000):
        got = [(r.id, r.y, bytes(r.text)) for r in labelled.training_sample(docs, marks, "toxic", most, 40).collect()]
        for y in (0, 1):
            free = [n for n in range(100) if n % 2 == y and n not in held]
            own = [r for r in got if r[1] == y]
            assert len(own) == len({r[0] for r in own}) == min(most, len(free)) and {r[0] for r in own} <= set(free)
        assert all(text == f"a text {n}".encode() for n, _, text in got)


def test_rounds_over_few_edges_take_few_tasks(spark, conf):
    from strata.llm.components import components

    conf("spark.sql.shuffle.partitions", "50")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40) if k != 20], "a long, b long")
    roots = components(edges)
    assert roots.rdd.getNumPartitions() == 1
    assert {r.node: r.root for r in roots.collect()} == {k: 1 if k <= 20 else 21 for k in range(1, 41)}
