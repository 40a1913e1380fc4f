"""How far the term frequencies of sources lie apart, with terms as digests until the end.

Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. Each
language keeps the terms of at least ``LEAST`` of its documents. A group is a
(lang, source); its frequency of a kept term, smoothed by one, is a whole
number p of parts in ``SCALE``, and f(p, q) = floor((p - q)^2 / q) tells how
far p lies from q.

Strings come late. Texts are read once; what is counted and shuffled are rows
of fixed width, a group number and a 64-bit digest with its counts, combined
before every shuffle. Each part of a task writes a term's spelling once, in a
column of its own that counting does not read. The least and the greatest
spelling of a kept digest tell whether several terms share it; only those are
counted anew by their spelling and go on as numbered parts of the digest. Text
is joined back to the rows that the report keeps.

Sums over all kept terms of all pairs of sources are not sums over all kept
terms: with p0 and q0 for a term that a group lacks,

  sum f(p, q) = sum over s of f(p, q0) + sum over t of f(p0, q)
              + sum over both of (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
              + (V - terms of s - terms of t) f(p0, q0);

the first two come from how many terms of a group have which p, the third from
terms that sources share, summed inside tasks, and the last from counts.
Everything is done in whole numbers.

* null text, lang and source count as '';
* a group without kept terms has distances to the other sources and no terms,
  a language without kept terms has distances of 0;
* every row is a document, repeated rows as often as they occur;
* ties go to the item that is smaller in UTF-8;
* an empty table gives an empty report; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtrail.llm.byte_text import lower_ascii, numbered_words, slices, word_bytes, word_spans
from logtrail.llm.components import stored

#: Documents of a language that a kept term occurs in, and terms reported per group.
LEAST, TOP = 3, 200
#: Parts that frequencies are counted in.
SCALE = 1_000_000_000
#: Bytes of text that are counted at once.
COUNT_BYTES = 8 << 20
#: Rows of shared terms that one group of the pair sums has, about.
PAIR_ROWS = 200_000

_TERM = np.zeros(256, bool)
_TERM[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True

COUNTS = "lang string, source string, digest bigint, n bigint, df bigint, term string"


def term_counts(docs: DataFrame, bits: int = 64, every_spelling: bool = False) -> DataFrame:
    """Occurrences and documents of terms per group, for each part of a task.

    ``term`` is given on the first row of a term in a part, or on every row.
    """
    mask = (1 << bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, limit=COUNT_BYTES):
            starts, ends, doc = word_spans(data, offsets, _TERM)
            if not len(starts):
                continue
            word, terms = numbered_words(word_bytes(lower_ascii(data), _TERM), ends - starts)
            digests = np.array([xxhash.xxh3_64_intdigest(t) & mask for t in terms.to_pylist()], np.uint64).view(np.int64)
            langs, sources = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
            width = len(sources.dictionary)
            groups, of_doc = np.unique(np.asarray(langs.indices, np.int64) * width + np.asarray(sources.indices, np.int64), return_inverse=True)
            # Occurrences per document first, then sums over the documents of a group.
            key, n = np.unique(doc * len(terms) + word, return_counts=True)
            order = np.argsort(of_doc[key // len(terms)] * len(terms) + key % len(terms), kind="stable")
            key = (of_doc[key // len(terms)] * len(terms) + key % len(terms))[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            counts = np.add.reduceat(n[order], first)
            group, code = key[first] // len(terms), key[first] % len(terms)
            spelled = terms.take(pa.array(code)).cast(pa.string())
            if not every_spelling:
                seen = np.zeros(len(code), bool)
                seen[np.unique(code, return_index=True)[1]] = True
                spelled = pa.compute.if_else(pa.array(seen), spelled, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(groups[group] // width)),
                    sources.dictionary.take(pa.array(groups[group] % width)),
                    pa.array(digests[code]),
                    pa.array(counts),
                    pa.array(np.diff(np.append(first, len(key)))),
                    spelled,
                ],
                names=["lang", "source", "digest", "n", "df", "term"],
            )

    return docs.mapInArrow(run, COUNTS)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances of a group to the other sources of its language (part
    ``pair``), and the terms that it has more of than its language (part ``term``), farthest first."""
    columns = {c.lower(): c for c in docs.columns} if not {"text", "lang", "source"} <= set(docs.columns) else {}
    names = [columns.get(c, c) for c in ("text", "lang", "source")]
    docs = docs.select(*[F.coalesce(F.col(n), F.lit("")).alias(c) for n, c in zip(names, ("text", "lang", "source"), strict=True)])
    groups = stored(docs.select("lang", "source").distinct().withColumn("gid", F.monotonically_increasing_id()), "groups")
    counts = stored(term_counts(docs, bits), "terms")
    totals = _totals(counts, groups, "digest").withColumn("part", F.lit(0).cast("bigint"))
    kept = stored(_kept(totals, groups, least), "kept")
    spelled = _spelled(counts, kept)
    shared = spelled.where("low <> high").select("digest")
    if shared.isEmpty():
        spelled = spelled.select("digest", F.lit(0).cast("bigint").alias("part"), F.col("low").alias("term"))
    else:
        parts = _parts(term_counts(docs, bits, every_spelling=True), shared, groups)
        totals = totals.join(shared, "digest", "left_anti").unionByName(parts.drop("term"))
        kept = stored(_kept(totals, groups, least), "kept")
        alone = spelled.where("low = high").select("digest", F.lit(0).cast("bigint").alias("part"), F.col("low").alias("term"))
        spelled = alone.unionByName(parts.select("digest", "part", "term").distinct())
    stats = stored(_statistics(kept, groups), "groups")
    return _report(pair_values(kept, stats), stats).unionByName(_terms(kept, stats, spelled, top))


def _totals(counts: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Counts per group number and term."""
    numbered = counts.join(groups, ["lang", "source"]).select("gid", *keys, "n", "df")
    return numbered.groupBy("gid", *keys).agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _kept(totals: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """Rows of terms that enough documents of the language have, with the count of the language."""
    rows = totals.join(groups.select("gid", "lang"), "gid")
    term = Window.partitionBy("lang", "digest", "part")
    every = rows.withColumns({"lang_n": F.sum("n").over(term), "lang_df": F.sum("df").over(term), "least_gid": F.min("gid").over(term)})
    # One row of each term stands for it where terms of a language are counted.
    return every.where(F.col("lang_df") >= least).select("gid", "lang", "digest", "part", "n", "lang_n", (F.col("gid") == F.col("least_gid")).alias("stands"))


def _spelled(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """The least and the greatest spelling of every kept digest."""
    wanted = counts.where("term is not null").select("digest", "term").join(kept.select("digest").distinct(), "digest", "left_semi")
    return stored(wanted.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "spelled")


def _parts(counts: DataFrame, shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Counts by spelling of digests that several terms share; ``part`` tells the terms of a digest apart."""
    split = stored(_totals(counts.join(shared, "digest", "left_semi"), groups, "digest", "term"), "split")
    # Numbers of rows of a written table: unique, and the same whenever they are read.
    terms = stored(split.select("digest", "term").distinct().withColumn("part", F.monotonically_increasing_id() + 1), "parts")
    return split.join(terms, ["digest", "term"])


def _statistics(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group: its occurrences and terms, the occurrences and kept terms of its language, and p of a term that it lacks."""
    sums = kept.groupBy("gid").agg(F.sum("n").alias("occurrences"), F.count("*").alias("terms"), F.sum(F.col("stands").cast("bigint")).alias("standing"))
    rows = groups.join(sums, "gid", "left").fillna(0, ["occurrences", "terms", "standing"])
    totals = rows.groupBy("lang").agg(F.sum("standing").alias("vocabulary"), F.sum("occurrences").alias("lang_occurrences"))
    return rows.join(totals, "lang").select("gid", "lang", "source", "occurrences", "terms", "vocabulary", "lang_occurrences", _parts_of(F.lit(0), F.col("occurrences"), F.col("vocabulary")).alias("p0"))


def _parts_of(n: Column, occurrences: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (occurrences + vocabulary)), without overflow; a language without terms has no use for it."""
    wide = "decimal(20,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast(wide)
    return F.call_function("div", above, F.greatest(occurrences + vocabulary, F.lit(1)).cast(wide)) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pair_values(kept: DataFrame, stats: DataFrame) -> DataFrame:
    """``gid, other, value``: the summed distances of every group to every other group of its language."""
    known = kept.join(stats.select("gid", "occurrences", "vocabulary", "p0"), "gid")
    rows = known.select("gid", "lang", "digest", "part", "p0", _parts_of(F.col("n"), F.col("occurrences"), F.col("vocabulary")).alias("p"))
    others = stats.select("lang", F.col("gid").alias("other"), F.col("p0").alias("q0"), F.col("terms").alias("other_terms"))
    apart = F.col("gid") != F.col("other")
    of_lacking = stats.join(others, "lang").where(apart)
    lacking = (F.col("vocabulary") - F.col("terms") - F.col("other_terms")) * _distance(F.col("p0"), F.col("q0"))
    values = [of_lacking.select("gid", "other", lacking.alias("value"))]
    # How many terms of a group have which p: few rows, whatever the number of terms.
    same_p = rows.groupBy("gid", "lang", "p").agg(F.count("*").alias("times"))
    against = same_p.join(others, "lang").where(apart)
    one = against.groupBy("gid", "other").agg(
        F.sum(F.col("times") * _distance(F.col("p"), F.col("q0"))).alias("value"), F.sum(F.col("times") * _distance(F.col("q0"), F.col("p"))).alias("back")
    )
    values += [one.select("gid", "other", "value"), one.select(F.col("other").alias("gid"), F.col("gid").alias("other"), F.col("back").alias("value"))]
    total = stats.agg(F.sum("terms")).first()[0] or 0
    split = F.pmod(F.xxhash64("digest", "part"), F.lit(total // PAIR_ROWS + 1)).alias("split")
    both = rows.select("lang", split, "digest", "part", "gid", "p", "p0").groupBy("lang", "split").applyInArrow(_shared_terms, "gid bigint, other bigint, value bigint")
    parts = values[0].unionByName(values[1]).unionByName(values[2]).unionByName(both)
    return parts.groupBy("gid", "other").agg(F.sum("value").alias("value"))


def _shared_terms(table: pa.Table) -> pa.Table:
    """Sums over terms that two groups both have, for all ordered pairs of groups that share one."""
    digest, part, gid, p, p0 = (np.asarray(table.column(c)) for c in ("digest", "part", "gid", "p", "p0"))
    order = np.lexsort((part, digest))
    digest, part, gid, p, p0 = (a[order] for a in (digest, part, gid, p, p0))
    gids, local = np.unique(gid, return_inverse=True)
    pairs, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The k-th row behind each row, while it is of the same term.
    step, rows = 1, np.arange(len(gid) - 1)
    while len(rows):
        rows = rows[rows + step < len(gid)]
        rows = rows[(digest[rows] == digest[rows + step]) & (part[rows] == part[rows + step])]
        a, b = np.concatenate((rows, rows + step)), np.concatenate((rows + step, rows))
        value = _f(p[a], p[b]) - _f(p[a], p0[b]) - _f(p0[a], p[b]) + _f(p0[a], p0[b])
        pairs, sums = _summed(np.concatenate((pairs, local[a] * len(gids) + local[b])), np.concatenate((sums, value)))
        step += 1
    return pa.table({"gid": gids[pairs // len(gids)], "other": gids[pairs % len(gids)], "value": sums})


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values[order], first)


def _report(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """All distances of each group, ranked."""
    names = stats.select("gid", "lang", "source")
    items = stats.select(F.col("gid").alias("other"), F.col("source").alias("item"))
    rows = pairs.join(names, "gid").join(items, "other")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(kept: DataFrame, stats: DataFrame, spelled: DataFrame, top: int) -> DataFrame:
    """The terms that a group has more of than its language, farthest first, with their text."""
    rows = kept.withColumnRenamed("part", "number").join(stats.drop("lang"), "gid")
    p = _parts_of(F.col("n"), F.col("occurrences"), F.col("vocabulary"))
    q = _parts_of(F.col("lang_n"), F.col("lang_occurrences"), F.col("vocabulary"))
    more = rows.select("gid", "lang", "source", "digest", "number", p.alias("p"), q.alias("q")).where("p > q")
    valued = more.select("gid", "lang", "source", "digest", "number", _distance(F.col("p"), F.col("q")).alias("value"))
    # With ties at the last place, which only the text can part.
    best = valued.withColumn("place", F.rank().over(Window.partitionBy("gid").orderBy(F.desc("value")))).where(F.col("place") <= top)
    named = best.join(spelled.select("digest", F.col("part").alias("number"), F.col("term").alias("item")), ["digest", "number"])
    rank = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "item"))
    ranked = named.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
