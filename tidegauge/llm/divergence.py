"""Divergence of the sources of a language, over a quadtree of their term counts.

Per language there is a matrix with a row per source and a column per kept term (in at least
``min_docs`` of the language's documents). A count n gives the rate
``p = 1 + floor(10**9 * (n + 2) / (N + 2 V))``, N the row's sum and V the number of columns, and two rates
differ by ``floor((p - q)**2 / (p + q))``.

1. Tasks count the terms of many documents at once and give a row per source and term.
2. Columns are dealt to bundles of about ``BUNDLE`` columns of like frequency, rows to blocks of
   ``BLOCK``, so that a unit of work is two blocks and a bundle, whatever the corpus.
3. In a unit, a pyramid of flags tells which squares hold a count (side ``LEAF``, doubled per level up
   to ``BLOCK``). Pairs of row squares descend together while one of the two holds a count; a square
   that is empty in both is left. Leaves are compared rate by rate.
4. What was left, in a unit or because no unit holds it, is uniform: both sources have their rate of
   no count there. A pair's value is the sum over its leaves and, for all other columns, their number
   times that one difference.

Whole numbers throughout: rates are taken in decimals, differences fit 64 bits.

Defined cases: null text, language and source read as ''; repeated rows count each; a source without
terms has rates of no count; a language that keeps no term gives pairs of value 0 and no terms; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.llm.common import table
from tidegauge.session import materialize

MIN_DOCS = 10
TOP_TERMS = 10
#: Rows of a block, columns of a bundle on average, side of a leaf.
BLOCK, BUNDLE, LEAF = 256, 3072, 16
#: Words that a task holds before it gives their counts.
FLUSH_WORDS = 1 << 23
#: Pairs of leaves that are compared at once.
LEAF_PAIRS = 256

#: A-Z to a-z, other ASCII that is no letter to a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


class Numbers(dict):
    """Numbers words from 0 as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of what a task has read so far, whenever it holds enough."""
    numbers, held, size = Numbers(), {}, 0

    def counts() -> Iterator[pa.RecordBatch]:
        terms = pa.array(list(numbers), pa.binary())
        for (lang, source), docs in held.items():
            words = np.concatenate(docs)
            n = np.bincount(words, minlength=len(numbers))
            owner = np.repeat(np.arange(len(docs), dtype=np.int64), [len(d) for d in docs])
            once = np.unique(owner * len(numbers) + words) % len(numbers)
            seen = np.bincount(once, minlength=len(numbers))
            some = np.flatnonzero(n)
            names = [pa.array([name], pa.string()).take(pa.array(np.zeros(len(some), np.int32))) for name in (lang, source)]
            yield pa.RecordBatch.from_arrays(
                [*names, terms.take(pa.array(some)), pa.array(n[some], pa.int64()), pa.array(seen[some], pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, data in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("data")):
            words = data.as_py().translate(_LETTERS).split()
            if words:
                held.setdefault((lang, source), []).append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                size += len(words)
            if size >= FLUSH_WORDS:
                yield from counts()
                numbers, held, size = Numbers(), {}, 0
    if held:
        yield from counts()


def rate(n: Column, total: Column, columns: Column) -> Column:
    """``1 + floor(10**9 * (n + 2) / (total + 2 columns))``, exact for any long."""
    whole = lambda c: c.cast("decimal(20,0)")
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (whole(n) + 2)
    below = F.greatest(whole(total) + 2 * whole(columns), F.lit(1).cast("decimal(20,0)"))
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that have the term."""
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).cast("binary").alias("data"))
    partial = rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def quadtree(counted: np.ndarray) -> list[np.ndarray]:
    """Flags of the squares that hold a count: from leaves to squares of ``BLOCK`` rows. Sides are multiples of it."""
    rows, columns = counted.shape
    flags = [counted.reshape(rows // LEAF, LEAF, columns // LEAF, LEAF).any(axis=(1, 3))]
    while flags[-1].shape[0] > rows // BLOCK:
        r, c = flags[-1].shape
        flags.append(flags[-1].reshape(r // 2, 2, c // 2, 2).any(axis=(1, 3)))
    return flags


def leaf_pairs(flags: list[np.ndarray], roots: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The triples (row leaf, row leaf, column leaf) reached from two blocks of rows; of equal blocks each pair once."""
    columns = flags[-1].shape[1]
    a, b, c = np.full(columns, roots[0]), np.full(columns, roots[1]), np.arange(columns)
    for level in reversed(range(len(flags))):
        live = flags[level][a, c] | flags[level][b, c]
        a, b, c = a[live], b[live], c[live]
        if level:
            step = np.array([(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)])
            a, b, c = ((2 * x[:, None] + step[None, :, n]).ravel() for n, x in enumerate((a, b, c)))
            once = a <= b
            a, b, c = a[once], b[once], c[once]
    return a, b, c


def pair_sums(rates: np.ndarray, counted: np.ndarray, columns: int, apart: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per pair of rows: the differences summed over the leaves that were reached, and how many columns these have.

    ``rates`` and ``counted`` have one block of rows, or two if ``apart``, then pairs are of one row of
    each. Sides are multiples of ``BLOCK``; the first ``columns`` are real. Other pairs are left at 0.
    """
    rows = rates.shape[0]
    a, b, c = leaf_pairs(quadtree(counted), (0, int(apart)))
    leaves = rates.reshape(rows // LEAF, LEAF, rates.shape[1] // LEAF, LEAF).transpose(0, 2, 1, 3)
    sums = np.zeros((rows // LEAF, rows // LEAF, LEAF, LEAF), np.int64)
    reached = np.zeros((rows // LEAF, rows // LEAF), np.int64)
    for at in range(0, len(a), LEAF_PAIRS):
        i, j, k = (x[at:at + LEAF_PAIRS] for x in (a, b, c))
        p, q = leaves[i, k][:, :, None, :], leaves[j, k][:, None, :, :]
        np.add.at(sums, (i, j), ((p - q) ** 2 // (p + q)).sum(axis=-1))
        np.add.at(reached, (i, j), np.minimum(LEAF, columns - k * LEAF))
    flat = sums.transpose(0, 2, 1, 3).reshape(rows, rows)
    return flat, np.repeat(np.repeat(reached, LEAF, 0), LEAF, 1)


def _padded(n: int) -> int:
    return max(1, -(-n // BLOCK)) * BLOCK


def _unit(top: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Pair sums of one unit, and of one block the ``top`` terms of each row above the language's rate."""
        lang, apart = key[0].as_py(), key[1].as_py() != key[2].as_py()
        own = rows["term"].is_null().to_numpy(zero_copy_only=False)
        place = rows["side"].to_numpy().astype(np.int64) * BLOCK + rows["place"].to_numpy()
        p, q = rows["p"].to_numpy(), rows["q"].to_numpy()
        cells = np.flatnonzero(~own)
        coded = rows["term"].take(pa.array(cells)).combine_chunks().dictionary_encode()
        terms, code = [t.encode() for t in coded.dictionary.to_pylist()], coded.indices.to_numpy()
        common = np.zeros(len(terms), np.int64)
        common[code] = q[cells]
        by_name = np.argsort(np.argsort(np.array(terms, object)))
        column = np.empty(len(terms), np.int64)
        column[np.lexsort((by_name, -common))] = np.arange(len(terms))  # frequent first, so that empty squares are large
        shape = (BLOCK * (1 + apart), _padded(len(terms)))
        rates, counted = np.ones(shape, np.int64), np.zeros(shape, bool)
        rates[place[own], :len(terms)] = p[own][:, None]
        rates[place[cells], column[code]] = p[cells]
        counted[place[cells], column[code]] = True
        sums, reached = pair_sums(rates, counted, len(terms), apart)
        ones = np.unique(place[own])
        left, right = (ones[ones < BLOCK], ones[ones >= BLOCK]) if apart else (ones, ones)
        x, y = (g.ravel() for g in np.meshgrid(left, right, indexing="ij"))
        wanted = (x < y) & (reached[x, y] > 0)
        x, y = x[wanted], y[wanted]
        first, second = key[1].as_py() * BLOCK + x, key[2].as_py() * BLOCK + y - apart * BLOCK
        total, width, names = sums[x, y], reached[x, y], [None] * len(x)
        if not apart and len(cells):
            gain = np.where(p[cells] > q[cells], (p[cells] - q[cells]) ** 2 // (p[cells] + q[cells]), -1)
            order = np.lexsort((by_name[code], -gain, place[cells]))
            order = order[gain[order] >= 0]
            owner = place[cells][order]
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
            rank = np.arange(len(owner)) - np.repeat(starts, np.diff([*starts, len(owner)]))
            order = order[rank < top]
            first = np.concatenate([first, key[1].as_py() * BLOCK + place[cells][order]])
            second = np.concatenate([second, np.full(len(order), -1)])
            total = np.concatenate([total, gain[order]])
            width = np.concatenate([width, np.zeros(len(order), np.int64)])
            names += [terms[i].decode() for i in code[order]]
        return pa.table({
            "lang": pa.array([lang] * len(first), pa.string()), "x": pa.array(first, pa.int64()), "y": pa.array(second, pa.int64()),
            "term": pa.array(names, pa.string()), "total": pa.array(total, pa.int64()), "width": pa.array(width, pa.int64())})

    return run


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by divergence (``pair``), terms over the language's rate (``term``)."""
    cells = materialize(term_counts(docs, text_col, lang_col, source_col), "term-cells")
    terms = cells.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    terms = materialize(terms.select("lang", "term", "all_n", F.floor(F.log2(F.col("all_n").cast("double"))).alias("band")), "kept-terms")
    bands = terms.groupBy("lang", "band").agg(F.count(F.lit(1)).alias("columns"), F.sum("all_n").alias("words"))
    bands = materialize(bands.withColumn("bundles", F.ceil(F.col("columns") / BUNDLE)), "term-bands")
    langs = bands.groupBy("lang").agg(F.sum("columns").alias("v"), F.sum("words").alias("all_total"))
    kept = terms.join(bands.select("lang", "band", "bundles"), ["lang", "band"]).join(langs, "lang").select(
        "lang", "term", "band", F.pmod(F.xxhash64("term"), F.col("bundles")).alias("bundle"),
        rate(F.col("all_n"), F.col("all_total"), F.col("v")).alias("q"))
    kept_cells = materialize(cells.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-cells")

    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    groups = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source")).distinct()
    sums = kept_cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(sums, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang", "left").fillna(0, ["total", "v"])
    by_size = W.partitionBy("lang").orderBy(F.desc("total"), "source")  # the result has a row for each two sources
    groups = groups.withColumn("at", (F.row_number().over(by_size) - 1).cast("long"))
    groups = groups.withColumn("blocks", F.ceil(F.count(F.lit(1)).over(W.partitionBy("lang")) / BLOCK))
    groups = materialize(groups.withColumn("p0", rate(F.lit(0).cast("long"), F.col("total"), F.col("v"))), "source-groups")

    bundles = bands.select("lang", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bundles") - 1)).alias("bundle"))
    none = lambda kind: F.lit(None).cast(kind)
    own = groups.join(bundles, "lang").select("lang", "band", "bundle", "at", "blocks", none("string").alias("term"),
                                              F.col("p0").alias("p"), F.lit(0).cast("long").alias("q"))
    counted = kept_cells.join(groups, ["lang", "source"]).select(
        "lang", "band", "bundle", "at", "blocks", "term", rate(F.col("n"), F.col("total"), F.col("v")).alias("p"), "q")
    block = F.floor(F.col("at") / BLOCK)
    units = own.unionByName(counted).withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = units.select(
        "lang", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "band", "bundle",
        (F.col("block") > F.col("with")).cast("long").alias("side"), (F.col("at") % BLOCK).alias("place"), "term", "p", "q")
    found = units.groupBy("lang", "a", "b", "band", "bundle").applyInArrow(
        _unit(top), "lang string, x long, y long, term string, total long, width long")
    found = materialize(found, "divergence-units")

    leaves = found.where("term IS NULL").groupBy("lang", "x", "y").agg(F.sum("total").alias("total"), F.sum("width").alias("width"))
    one, two = groups.alias("g"), groups.alias("h")
    pairs = one.join(two, (F.col("g.lang") == F.col("h.lang")) & (F.col("g.at") != F.col("h.at"))).select(
        F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), F.col("h.source").alias("item"), F.col("g.v").alias("v"),
        F.least("g.at", "h.at").alias("x"), F.greatest("g.at", "h.at").alias("y"), difference(F.col("g.p0"), F.col("h.p0")).alias("uniform"))
    pairs = pairs.join(leaves, ["lang", "x", "y"], "left").fillna(0, ["total", "width"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        F.when(F.col("v") > 0, F.col("total") + (F.col("v") - F.col("width")) * F.col("uniform")).otherwise(0).alias("value"))
    over = found.where("term IS NOT NULL").select("lang", F.col("x").alias("at"), F.col("term").alias("item"), F.col("total").alias("value"))
    over = over.join(groups.select("lang", "source", "at"), ["lang", "at"]).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(over).where(F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents),
words AS (
    SELECT row_no, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT row_no) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, sum(c.n) AS total FROM counts c JOIN kept k USING (lang, term) GROUP BY ALL),
cells AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
    FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
pairs AS (
    SELECT g.lang, g.source, h.source AS item, sum((g.p - h.p) * (g.p - h.p) // (g.p + h.p)) AS value
    FROM cells g JOIN cells h ON g.lang = h.lang AND g.term = h.term AND g.source <> h.source GROUP BY ALL),
found AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM sources g JOIN sources h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM cells WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
