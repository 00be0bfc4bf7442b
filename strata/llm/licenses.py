"""License scans: base phrases by word position, and ordered signature rules behind a keyword filter, overlaps resolved by priority."""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import doc_ids_and_text, map_arrow, utf8
from strata.llm.license_rules import RULES

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Every byte that is part of no word, once A-Z are lower-case: ASCII but digits and letters.
_APART = bytes(b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else 0x20 for b in range(256))


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    weight: int
    keyword: bytes
    pattern: re.Pattern[bytes]


def read_rules(text: str) -> list[Rule]:
    """Rules of a table as in license_rules, one a line; a pattern matches whole words."""
    rules = []
    for line in filter(None, map(str.strip, text.splitlines())):
        label, weight, keyword, pattern = (x.strip() for x in line.split("|", 3))
        rules.append(Rule(len(rules), label, int(weight), keyword.encode(), re.compile(rb"(?<= )(?:" + pattern.encode() + rb")(?= )")))
    return rules


class Scanner:
    """Scans words for base phrases and rules; the rules of a keyword are tried only on texts with that word."""

    def __init__(self, rules: list[Rule], base: dict[str, str] = BASE):
        self.base = [(b" " + phrase.encode() + b" ", label) for phrase, label in base.items()]
        self.by_keyword: dict[bytes, list[Rule]] = {}
        for rule in rules:
            self.by_keyword.setdefault(rule.keyword, []).append(rule)
        self.keywords = frozenset(self.by_keyword)

    def detections(self, line: bytes, words: list[bytes]) -> list[tuple[int, int, Rule]]:
        """Start, end (bytes of `line`) and rule of what stands after suppression, best rules first.

        Rules are taken by weight, then in order; what lies within an interval already taken is dropped.
        """
        rules = [r for k in self.keywords.intersection(words) for r in self.by_keyword[k]]
        found = [(m.start(), m.end(), r) for r in rules for m in r.pattern.finditer(line)]
        kept, taken, longest = [], [], 0
        for start, end, rule in sorted(found, key=lambda x: (-x[2].weight, x[2].order, x[0])):
            at = bisect_right(taken, (start, len(line)))
            inside = False
            while at and not inside and taken[at - 1][0] >= end - longest:  # no interval that begins before can reach `end`
                at -= 1
                inside = taken[at][1] >= end
            if not inside:
                kept.append((start, end, rule))
                insort(taken, (start, end))
                longest = max(longest, end - start)
        return kept

    def scan(self, text: bytes) -> tuple[int, int, int | None, int | None, list[str], list[tuple[str, int, int, int]]]:
        """n_words, n_base, first and last base place, base labels, and detections as (label, weight, first word, words)."""
        words = text.lower().translate(_APART).split()
        line = b" " + b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, label in self.base:
            at = line.find(phrase)
            while at >= 0:
                places.append(at)
                labels.add(label)
                at = line.find(phrase, at + 1)
        ends = [min(places), max(places)] if places else []
        hits = self.detections(line, words)
        marks = _word_numbers(line, [*ends, *(p for start, end, _ in hits for p in (start - 1, end))])
        spans = [(r.label, r.weight, marks[start - 1], marks[end] - marks[start - 1]) for start, end, r in hits]
        return len(words), len(places), marks[ends[0]] if ends else None, marks[ends[1]] if ends else None, sorted(labels), spans


def _word_numbers(line: bytes, places: list[int]) -> dict[int, int]:
    """How many words come before each place, a space of `line`; one pass over it."""
    out, count, at = {}, 0, 0
    for place in sorted(set(places)):
        count += line.count(b" ", at, place)
        out[place], at = count, place
    return out


def scan_licenses(docs: DataFrame, rules: str = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License phrases and signatures of every row of `docs`.

    Columns: doc_id, n_words, n_base (all places where a base phrase stands), first_word and last_word (the smallest and largest of
    them, words from 0, null if none), base_labels, labels (both kinds), both distinct, sorted and comma-joined, score (the
    certainty of at least one detection, 0 to 1) and detections (label, weight, first_word, words), best first. A null or empty text has
    no words and no labels. Null ids and repeated rows stay. Other columns are not read. Whole texts, in one pass each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(read_rules(rules))
        for batch in batches:
            found = [scanner.scan(t) for t in utf8(batch)]
            labels = [sorted({*base, *(s[0] for s in spans)}) for *_, base, spans in found]
            scores = []
            for *_, base, spans in found:
                miss = 0.4 if base else 1.0  # a base phrase alone is a name
                for _, weight, _, _ in spans:
                    miss *= 1 - weight / 100
                scores.append(1 - miss)
            spans = [[dict(zip(("label", "weight", "first_word", "words"), s)) for s in spans] for *_, spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([f[k] for f in found], pa.int64()) for k in range(4)),
                    pa.array([",".join(f[4]) for f in found]),
                    pa.array(map(",".join, labels), pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(spans, pa.list_(pa.struct([("label", pa.string()), ("weight", pa.int32()), ("first_word", pa.int64()), ("words", pa.int64())]))),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
            )

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "detections array<struct<label: string, weight: int, first_word: long, words: long>>"
    )
    return map_arrow(doc_ids_and_text(docs, id_col, text_col), work, schema)
