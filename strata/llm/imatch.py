"""Document fingerprints by I-Match: distinct terms of a band of document frequencies, hashed over several random parts of the lexicon."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import keep
from strata.session import broadcast_if_small

TERM = r"[\p{L}\p{N}]+"
#: Terms kept are in this part of the documents at least and at most: idf from 6.2 to 7.6.
BAND = (0.0005, 0.002)
#: Terms of so few documents are never above the band: in a small table the upper share alone would leave no term.
FEW = 2
#: Random parts of the lexicon: level l holds a term with probability 2**-l; so many parts a level. 62 parts at most.
LEVELS, PARTS = 8, 4
#: The band bounds the lexicon by terms a document / BAND[0], whatever the number of documents; beyond this it is shuffled.
LEXICON_ROWS = 1_000_000
#: Documents of one range of ids, and ranges at most.
RANGE_ROWS, RANGES = 512, 65_536
_NONE = "-" * 8


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), 0))


def _mask(term: Column, levels: int = LEVELS, parts: int = PARTS) -> Column:
    """Bit j: the term belongs to part j."""
    bits = [
        F.when(F.xxhash64(term, F.lit(level * parts + part)).bitwiseAND((1 << (level + 1)) - 1) == 0, F.lit(1 << (level * parts + part)).cast("long")).otherwise(F.lit(0).cast("long"))
        for level in range(levels)
        for part in range(parts)
    ]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND, levels: int = LEVELS, parts: int = PARTS) -> DataFrame:
    """term, mask (bit j: the term belongs to part j), df and banded of the terms that are in as many documents as the band begins with, or more.

    banded: df is within the band. Document frequencies and their total are over the distinct texts among all (case aside), so that
    copies raise neither. In: column text. Written to the shared folder.
    """
    distinct = texts.groupBy(F.xxhash64(F.lower("text")).alias("h")).agg(F.first("text").alias("text"))
    # the outer form of explode, as for the plain one Spark adds a filter that works out all terms once more
    seen = distinct.select(F.explode_outer(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    total = distinct.count()
    most = max(band[1] * total, FEW)
    kept = seen.filter(F.col("term").isNotNull() & (F.col("df") >= band[0] * total))
    return keep(kept.select("term", _mask(F.col("term"), levels, parts).alias("mask"), "df", (F.col("df") <= most).alias("banded")), "lexicon")


def _parts(terms: Column, count: int) -> Column:
    """Of each part the 32-bit hash of its terms in order, '-' where it has none."""

    def of_part(j: int) -> Column:
        own = F.filter(terms, lambda t: F.getbit(t["mask"], F.lit(j)) == 1)
        return F.when(F.size(own) == 0, F.lit(_NONE)).otherwise(F.lpad(F.hex(F.xxhash64(own).bitwiseAND(0xFFFFFFFF)), 8, "0"))

    return F.lower(F.concat(*map(of_part, range(count))))


def _rarer(terms: Column) -> Column:
    """Of a text's terms in order of df those of at most twice the df of the middle one, so that what is taken stays much the same when a part of the text is another.

    The rarest few would not: in a large group of near copies all terms of the group are commoner than most of what replaces a part.
    """
    most = 2 * F.get(terms, F.floor((F.size(terms) - 1) / 2).cast("int"))["df"]
    return F.filter(terms, lambda t: t["df"] <= most)


def _compact(terms: Column) -> Column:
    """Terms as numbers, to travel with a row."""
    return F.transform(terms, lambda t: F.struct(F.xxhash64(t["term"]).alias("h"), t["mask"].alias("mask")))


def _signature(own: Column, wide: Column, whole: Column) -> Column:
    """The parts of the terms in the band; of a text without any '~' and those of its rarer terms; without these '=' and a hash of all of it."""
    some = lambda x: F.regexp_like(x, F.lit("[^-]"))
    return F.when(some(own), own).when(some(wide), F.concat(F.lit("~"), wide)).otherwise(F.concat(F.lit("="), F.lower(F.lpad(F.hex(whole), 16, "0"))))


def fingerprint_texts(df: DataFrame, keys: list[str], texts: dict[str, str], lexicon: DataFrame, count: int = LEVELS * PARTS) -> DataFrame:
    """Adds a fingerprint of each of one or two text columns: texts maps the column's name to the fingerprint's. Text columns are dropped.

    Beside each fingerprint stands what a likeness needs where one of two texts has no term in the band: with _wide added to its
    name the rarer of the text's terms (see _rarer), be they above, in or below the band, and with _parts their parts, null where
    each text of the row has a term in the band. keys tell rows apart; where `df`
    is partitioned by some of them, nothing is shuffled. Terms are looked up in the lexicon as rows.
    """
    names = list(texts)
    held = [c for c in df.columns if c not in names and c not in keys]
    filled = [F.coalesce(F.col(n), F.lit("")) for n in names]
    wholes = [F.xxhash64(F.lower(t)).alias(f"whole{i}") for i, t in enumerate(filled)]
    cut = df.select(*keys, *held, *wholes, *[_terms(t).alias(n) for n, t in zip(names, filled)])
    # place 0 holds an empty term that stands for the row, then come the first text's terms, then the second's
    cut = cut.select(*keys, *held, *[f"whole{i}" for i in range(len(names))], F.size(names[0]).alias("first"), F.concat(F.array(F.lit("")), *names).alias("terms"))
    rows = cut.select(*keys, *held, *[f"whole{i}" for i in range(len(names))], "first", F.posexplode_outer("terms").alias("place_of", "term"))
    found = rows.join(broadcast_if_small(lexicon, LEXICON_ROWS), "term", "left")
    of = F.when(F.col("place_of") == 0, -1).when(F.col("place_of") <= F.col("first"), 0).otherwise(1)
    # below the band a term's df is not known: 0
    term = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term", F.coalesce("mask", _mask(F.col("term"))).alias("mask"), F.coalesce("banded", F.lit(False)).alias("banded"))
    found = found.select(*keys, *held, *[f"whole{i}" for i in range(len(names))], of.alias("of"), term.alias("entry"))
    grouped = found.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in held],
        *[F.first(f"whole{i}").alias(f"whole{i}") for i in range(len(names))],
        *[F.sort_array(F.collect_list(F.when(F.col("of") == i, F.col("entry")))).alias(n) for i, n in enumerate(names)],
    )
    same = [*keys, *held, *[f"whole{i}" for i in range(len(names))]]
    split = grouped.select(*same, *[c for n in names for c in (F.transform(F.filter(n, lambda t: t["banded"]), lambda t: F.struct(t["term"].alias("term"), t["mask"].alias("mask"))).alias(f"own_{n}"), _compact(_rarer(F.col(n))).alias(f"wide_{n}"))])
    # parts of rarer terms cost more than all else: they are worked out only for rows in which a text has no term in the band
    lone = reduce(lambda x, y: x | y, [~F.exists(f"own_{n}", lambda t: t["mask"] != 0) for n in names])
    parts = split.select(*same, *[c for n in names for c in (
        _parts(F.col(f"own_{n}"), count).alias(f"own_{n}"), F.when(lone, _parts(F.col(f"wide_{n}"), count)).alias(f"parts_{n}"), F.col(f"wide_{n}")
    )])
    return parts.select(*keys, *held, *[
        c for i, n in enumerate(names) for c in (
            _signature(F.col(f"own_{n}"), F.col(f"parts_{n}"), F.col(f"whole{i}")).alias(texts[n]), F.col(f"parts_{n}").alias(f"{texts[n]}_parts"), F.col(f"wide_{n}").alias(f"{texts[n]}_wide")
        )
    ])


def likeness(a: Column, b: Column, a_parts: Column, b_parts: Column, count: int = LEVELS * PARTS) -> Column:
    """Of the parts in which either text has terms, the share in which both have the same; 1 for equal fingerprints.

    Where a text has no term in the band, the parts are those of the rarer terms of both; terms in the band that the other has
    count as parts in which they differ.
    """
    part = lambda x, j: F.substring(x, j * 8 + 1, F.lit(8))
    places = F.sequence(F.lit(0), F.lit(count - 1))

    def share(x: Column, y: Column, more: Column | int = 0) -> Column:
        either = F.size(F.filter(places, lambda j: (part(x, j) != _NONE) | (part(y, j) != _NONE)))
        both = F.size(F.filter(places, lambda j: (part(x, j) == part(y, j)) & (part(x, j) != _NONE)))
        return both / (either + more)

    lone = lambda x: x.startswith("~")
    filled = lambda x: F.when(lone(x), 0).otherwise(F.size(F.filter(places, lambda j: part(x, j) != _NONE)))
    nothing = a.startswith("=") | b.startswith("=")
    return F.when(a == b, F.lit(1.0)).when(nothing, F.lit(0.0)).when(lone(a) | lone(b), share(a_parts, b_parts, filled(a) + filled(b))).otherwise(share(a, b))


def _ranges(docs: DataFrame, range_rows: int, ranges: int) -> Column:
    """The number of the range of ids that a row lies in, larger ids first, null ids last: an expression over doc_id and h.

    Borders are approximate quantiles, so that ranges are about equally full. An id that fills a range by itself, and null,
    are split further by the hash of the text.
    """
    n = min(ranges, ceil(docs.count() / range_rows))
    borders = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(n - 1, 0, -1)], 100 * n)).first()[0] if n > 1 else None
    borders = sorted(borders or [], reverse=True)
    group = max(1, ceil(len(borders) / 64))
    parts = [borders[i : i + group] for i in range(0, len(borders), group)]
    longs = lambda xs: "array(" + ", ".join(f"{x}L" for x in xs) + ")" if xs else "cast(array() as array<bigint>)"
    whole = f"size(filter({longs([p[-1] for p in parts])}, x -> x > doc_id))"
    nested = "array(" + ", ".join(map(longs, [*parts, []])) + ")"
    before = f"{whole} * {group} + size(filter(element_at({nested}, {whole} + 1), x -> x > doc_id))" if borders else "0"
    hot = sorted({a for a, b in zip(borders, borders[1:]) if a == b})
    split = f"doc_id is null{' or doc_id in (' + ', '.join(f'{x}L' for x in hot) + ')' if hot else ''}"
    return F.expr(f"if(doc_id is null, {len(borders) + 1}, {before}) * 128L + if({split}, 32 - shiftright(h, 58), 0)")


def _behind(parts: DataFrame) -> DataFrame:
    """part and behind, the range before it, of the first one the last. All meet in one task, so they come without their texts."""
    along = Window.orderBy("part")
    return keep(parts.select("part", F.coalesce(F.lag("part").over(along), F.last("part").over(along.rowsBetween(0, Window.unboundedFollowing))).alias("behind")), "behind")


def edited_fingerprints(
    docs: DataFrame,
    band: tuple[float, float] = BAND,
    range_rows: int = RANGE_ROWS,
    ranges: int = RANGES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of all texts and of edited ones: the last third replaced by the beginning of the next document.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (likeness to
    the edited text's fingerprint and to the next document's). One row for each row of `docs`. Next is the next smaller id,
    null ids coming last; rows of one id are in order of a hash of their text; after the last comes the first, also where it is
    the row itself. A null text is empty; its edited text too. Texts are shuffled once, by ranges of ids, in which the next row
    is found; the first text of each range goes to the range before. Equal texts have equal fingerprints. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    words = lexicon(named, band)
    hashed = named.withColumn("h", F.xxhash64("text"))
    ranged = hashed.withColumn("part", _ranges(named.select("doc_id"), range_rows, ranges))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    # one row a range: its first text, and which range comes before it
    top = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.col("doc_id").isNotNull().alias("has"), F.col("h"))
    firsts = keep(ranged.groupBy("part").agg(F.max_by("text", top).alias("first_text")), "firsts")
    firsts = firsts.join(_behind(firsts.select("part")), "part").select(F.col("behind").alias("part"), "first_text")
    signs = keep(fingerprint_texts(firsts.withColumnRenamed("first_text", "t"), ["part"], {"t": "first_sign"}, words), "signs")
    own = Window.partitionBy("part").orderBy(*order)
    placed = ranged.select("part", "doc_id", "text", F.row_number().over(own).alias("place"), F.lead("text").over(own).alias("after"))
    placed = placed.join(firsts, "part").withColumn("after", F.coalesce("after", "first_text"))
    chars = F.length("text")
    third = F.floor(chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), chars - third), F.substring("after", F.lit(1), third))
    texts = placed.select("part", "place", "doc_id", chars.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    texts = texts.withColumn("edited_sha256", F.sha2("edited", 256))
    signed = fingerprint_texts(texts, ["part", "place"], {"text": "fingerprint", "edited": "edited_fingerprint"}, words)
    following = Window.partitionBy("part").orderBy("place")
    signed = signed.withColumns({"next_sign": F.lead("fingerprint").over(following), "next_wide": F.lead("fingerprint_wide").over(following)}).join(signs, "part")
    signed = signed.withColumns({"next_sign": F.coalesce("next_sign", "first_sign"), "next_wide": F.coalesce("next_wide", "first_sign_wide")})
    lone = F.col("fingerprint").startswith("~") | F.col("next_sign").startswith("~")
    signed = signed.withColumns({c: F.when(lone, _parts(F.col(x), LEVELS * PARTS)) for c, x in (("own_parts", "fingerprint_wide"), ("next_parts", "next_wide"))})
    return signed.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(*map(F.col, ("fingerprint", "edited_fingerprint", "fingerprint_parts", "edited_fingerprint_parts"))).alias("near_edited"),
        likeness(*map(F.col, ("fingerprint", "next_sign", "own_parts", "next_parts"))).alias("near_next"),
    )
