"""Collocations: frequent phrases of two to four words, scored at their weakest cut.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words at
blanks and tabs. All counts are per language, f(phrase) over all its places within pieces.

1. Tasks write blocks of up to ``BLOCK_WORDS`` words of one language: the block's words with their
   counts, and the text as numbers of these words, with a gap after each piece.
2. Words are dealt to buckets by a hash, where the packed counts of all blocks are summed. Those of at
   least ``least`` occurrences are ranked by frequency, and each block gets the ranks of its own words
   back from the buckets; no dictionary is broadcast.
3. In a block, neighbours are a pair of ranks. Pairs are dealt to square tiles of ranks. A tile near
   the corner of the frequent ranks that is well filled is counted by address in a dense table, all
   others as sorted coordinates. A block has at most one count of a pair, dealt to buckets by a hash of
   the pair; a bucket sums the packed counts of all blocks. Buckets grow in number with the words.
4. Frequent pairs are ranked again, and each block gets the ranks of its own pairs back from the buckets;
   a rank takes the place of the pair's first member in the block. Two such
   neighbours overlap in all but their ends, so pairs of pairs are three words, pairs of these four.
   A phrase that is frequent has frequent parts, so nothing is lost.
5. A phrase keeps its ends' counts from rank to rank, so every cut is scored without counting again. A
   phrase goes if a longer one around it has nearly as many occurrences; one word more is enough to
   look at, since a longer one has no more.

Whole numbers throughout; products are taken in decimals.

Defined cases: null text reads as '', null language as ``und``; repeated rows count each; an empty
table, or one without a frequent pair, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.llm.common import table
from tidegauge.llm.divergence import Numbers
from tidegauge.session import materialize, remove_folder, shared_path

LEAST = 30
MOST_WORDS = 4
TOP_PHRASES = 2000
#: A phrase goes if a longer one has this percentage of its occurrences.
INSIDE_PERCENT = 80
SCORE_UNIT = 2_000_000
UNKNOWN_LANG = "und"
BLOCK_WORDS = 1 << 22
#: Ranks on a tile's side, and tiles from the corner on each side that may be dense.
TILE, DENSE_TILES = 1024, 4
#: Pairs for each cell of a tile from which it is dense.
FILLED = 1 / 16
#: Places of pairs for each bucket that counts are summed in, on average.
BUCKET_PAIRS = 1 << 21
#: Blocks are shuffled and written once for each length of phrases, so their size counts for more than packing them.
STREAM_LEVEL = 6
GAP = b"."

#: The characters that end a piece (fixed values) all become the gap.
_PIECES = bytes(GAP[0] if chr(b) in ".,;:!?\n\x0b\f\r" else b for b in range(256))


def numbered(text: bytes, numbers: Numbers) -> np.ndarray:
    """The words of a text as numbers, a gap (the number of ``GAP``) after each piece."""
    words = (text.lower().translate(_PIECES).replace(GAP, b" . ") + b" .").split()
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def _stream(ids: np.ndarray) -> bytes:
    """Ranks packed as the sorted ranks that occur, and the place of each among them."""
    names, place = np.unique(ids, return_inverse=True)
    raw = np.array([len(names)], np.int64).tobytes() + np.diff(names, prepend=0).astype(np.int64).tobytes() + place.astype(np.int32).tobytes()
    return zstandard.ZstdCompressor(level=STREAM_LEVEL).compress(raw)


def _streamed(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size = int(np.frombuffer(raw, np.int64, 1)[0])
    names = np.cumsum(np.frombuffer(raw, np.int64, size, 8))
    return names[np.frombuffer(raw, np.int32, offset=8 * (size + 1))]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, lang, words, counts, data``; the gap is word 0 of every block."""
    part, made, size = TaskContext.get().partitionId(), 0, 0
    held: dict[str, tuple[Numbers, list[np.ndarray]]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        nonlocal made
        for lang, (numbers, texts) in held.items():
            ids = np.concatenate(texts)
            counts = np.bincount(ids, minlength=len(numbers))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([lang], pa.string()), pa.array([list(numbers)], pa.list_(pa.binary())),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([_stream(ids)], pa.binary())],
                ["block", "lang", "words", "counts", "data"])
            made += 1

    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data")):
            if lang not in held:
                held[lang] = (Numbers({GAP: 0}), [])
            numbers, texts = held[lang]
            texts.append(numbered(data.as_py(), numbers))
            size += len(texts[-1])
            if size >= BLOCK_WORDS:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def pair_counts(ids: np.ndarray, tile: int = TILE, filled: float = FILLED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``x, y, n``: how often rank y follows rank x directly; -1 is a gap.

    Ranks are first made dense within the block, in their order. Pairs of the most frequent ranks fall
    into at most ``DENSE_TILES`` squared tiles; those well filled are counted by address, the rest, and
    all pairs beyond, by sorting.
    """
    names, place = np.unique(ids, return_inverse=True)
    place = place - int(len(names) > 0 and names[0] < 0)
    names = names[names >= 0]
    x, y = place[:-1], place[1:]
    both = (x >= 0) & (y >= 0)
    x, y = x[both], y[both]
    corner = tile * DENSE_TILES
    far = DENSE_TILES * DENSE_TILES
    of = np.where((x < corner) & (y < corner), x // tile * DENSE_TILES + y // tile, far).astype(np.uint8)
    order = np.argsort(of, kind="stable")
    x, y = x[order], y[order]
    ends = np.cumsum(np.bincount(of, minlength=far + 1))
    found = []
    for t, (begin, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        a, b = x[begin:end], y[begin:end]
        if t < far and len(a) >= filled * tile * tile:
            counts = np.bincount(a % tile * tile + b % tile, minlength=tile * tile)
            at = np.flatnonzero(counts)
            found.append((at // tile + t // DENSE_TILES * tile, at % tile + t % DENSE_TILES * tile, counts[at]))
        elif len(a):
            codes, counts = np.unique(a * len(names) + b, return_counts=True)
            found.append((codes // len(names), codes % len(names), counts))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    x, y, n = (np.concatenate(part) for part in zip(*found, strict=True))
    return names[x], names[y], n


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, sorted by the first, byte by byte: the high bytes are nearly all alike."""
    first, *rest = columns
    values = np.concatenate([np.diff(first, prepend=0), *rest]).astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(rows: pa.ChunkedArray) -> list[np.ndarray]:
    """The three columns of all packed rows, one after another."""
    unpack, parts = zstandard.ZstdDecompressor(), [np.zeros((3, 0), np.int64)]
    for row in rows:
        planes = np.frombuffer(unpack.decompress(row.as_py()), np.uint8).reshape(8, -1)
        part = np.ascontiguousarray(planes.T).view(np.int64).reshape(3, -1)
        parts.append(np.vstack([np.cumsum(part[0]), part[1:]]))
    return list(np.concatenate(parts, axis=1))


def _bucket(x: np.ndarray, y: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + y.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def _counted(renumber: Callable[[np.ndarray, pa.Table], np.ndarray], last: bool):
    """Of a block and the ranks it gets: a row per bucket of its pair counts, and without bucket its ranks in place."""

    def run(blocks: pa.Table, ranks: pa.Table) -> pa.Table:
        block, lang, buckets = (blocks[c][0].as_py() if blocks.num_rows else None for c in ("block", "lang", "buckets"))
        numbers, data = [], []
        if blocks.num_rows:
            ids = renumber(_streamed(blocks["data"][0].as_py()), ranks)
            x, y, n = pair_counts(ids)
            of = _bucket(x, y, buckets)
            order = np.lexsort((y, x, of))
            x, y, n, of = x[order], y[order], n[order], of[order]
            cuts = [*np.flatnonzero(np.diff(of, prepend=-1)), len(of)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                numbers.append(int(of[begin]))
                data.append(_packed(x[begin:end], y[begin:end], n[begin:end]))
            if not last:
                numbers.append(None)
                data.append(_stream(ids))
        same = lambda value, kind: pa.array([value] * len(data), kind)
        return pa.table({"block": same(block, pa.int64()), "lang": same(lang, pa.string()), "buckets": same(buckets, pa.int64()),
                         "bucket": pa.array(numbers, pa.int64()), "data": pa.array(data, pa.binary())})

    return run


def _codes(names: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One number per pair of ranks that are among the sorted ``names``, -1 for others."""
    if not len(names):
        return np.full(len(x), -1, np.int64)
    i, j = (np.minimum(np.searchsorted(names, v), len(names) - 1) for v in (x, y))
    return np.where((names[i] == x) & (names[j] == y), i * len(names) + j, -1)


def _summed(least: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """The frequent pairs of a bucket: ``lang, x, y, bucket, a``."""
        x, y, n = _unpacked(rows["data"])
        codes = _codes(np.unique(np.concatenate([x, y])), x, y)
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        total = np.add.reduceat(n[order], starts) if len(starts) else n
        often = total >= least
        at = order[starts[often]]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(at), pa.string()), "x": x[at], "y": y[at],
                         "bucket": pa.array([key[1].as_py()] * len(at), pa.int64()), "a": total[often]})

    return run


def _placed(blocks: pa.Table, frequent: pa.Table) -> pa.Table:
    """For each block's row of a bucket, the ranks of its frequent pairs: ``of, ranks``."""
    fx, fy, rank = (frequent[c].to_numpy() for c in ("x", "y", "id"))
    names = np.unique(np.concatenate([fx, fy]))
    codes = _codes(names, fx, fy)
    order = np.argsort(codes)
    codes, rank = codes[order], rank[order]
    block, data = [], []
    for i in range(blocks.num_rows if len(rank) else 0):
        x, y, _ = _unpacked(blocks["data"].slice(i, 1))
        mine = _codes(names, x, y)
        at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
        hit = codes[at] == mine
        if hit.any():
            block.append(blocks["block"][i].as_py())
            data.append(_packed(x[hit], y[hit], rank[at[hit]]))
    return pa.table({"of": pa.array(block, pa.int64()), "ranks": pa.array(data, pa.binary())})


def _word_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each block dealt to buckets: ``block, lang, bucket, words, data``, the last their places and counts."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for block, lang, buckets, words, counts in zip(*(batch.column(c) for c in ("block", "lang", "buckets", "words", "counts")), strict=True):
            words, counts = words.as_py(), counts.values.to_numpy()
            of = np.fromiter(map(crc32, words), np.int64, len(words)) % buckets.as_py()
            of[0] = -1  # the gap is no word
            order = np.argsort(of, kind="stable")[1:]
            cuts = [*np.flatnonzero(np.diff(of[order], prepend=-1)), len(order)]
            parts = [order[begin:end] for begin, end in zip(cuts[:-1], cuts[1:], strict=True)]
            same = lambda value, kind: pa.array([value.as_py()] * len(parts), kind)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [same(block, pa.int64()), same(lang, pa.string()), pa.array([int(of[p[0]]) for p in parts], pa.int64()),
                 pa.array([pack.compress(b"\n".join([words[i] for i in p])) for p in parts], pa.binary()),
                 pa.array([_packed(p, counts[p], counts[p] * 0) for p in parts], pa.binary())],
                ["block", "lang", "bucket", "words", "data"])


def _words_of(rows: pa.ChunkedArray) -> pa.Array:
    """All words of packed rows, one after another; a line end is in no word."""
    unpack = zstandard.ZstdDecompressor()
    return pa.array([word for row in rows for word in unpack.decompress(row.as_py()).split(b"\n")], pa.binary())


def _summed_words(least: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """The frequent words of a bucket: ``lang, word, bucket, a``."""
        words = _words_of(rows["words"]).dictionary_encode()
        total = np.zeros(len(words.dictionary), np.int64)
        np.add.at(total, words.indices.to_numpy(), _unpacked(rows["data"])[1])
        often = np.flatnonzero(total >= least)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(often), pa.string()), "word": words.dictionary.take(pa.array(often)),
                         "bucket": pa.array([key[1].as_py()] * len(often), pa.int64()), "a": total[often]})

    return run


def _placed_words(blocks: pa.Table, frequent: pa.Table) -> pa.Table:
    """For each block's row of a bucket, the places and ranks of its frequent words: ``of, ranks``."""
    known, rank = frequent["word"].combine_chunks(), frequent["id"].to_numpy()
    block, data = [], []
    for i in range(blocks.num_rows if len(rank) else 0):
        found = pc.index_in(_words_of(blocks["words"].slice(i, 1)), value_set=known)
        hit = found.is_valid().to_numpy(zero_copy_only=False)
        if hit.any():
            ids = rank[found.drop_null().to_numpy()]
            block.append(blocks["block"][i].as_py())
            data.append(_packed(_unpacked(blocks["data"].slice(i, 1))[0][hit], ids, ids * 0))
    return pa.table({"of": pa.array(block, pa.int64()), "ranks": pa.array(data, pa.binary())})


def _from_words(ids: np.ndarray, ranks: pa.Table) -> np.ndarray:
    known = np.full(int(ids.max(initial=0)) + 1, -1, np.int64)
    at, rank, _ = _unpacked(ranks["ranks"])
    known[at] = rank
    return known[ids]


def _from_pairs(ids: np.ndarray, ranks: pa.Table) -> np.ndarray:
    """A frequent pair's rank in the place of its first member, gaps elsewhere."""
    x, y, rank = _unpacked(ranks["ranks"])
    again = np.full(len(ids), -1, np.int64)
    if not len(rank):
        return again
    names = np.unique(np.concatenate([x, y]))
    codes = _codes(names, x, y)
    order = np.argsort(codes)
    codes, rank = codes[order], rank[order]
    mine = _codes(names, ids[:-1], ids[1:])
    at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
    hit = np.flatnonzero(codes[at] == mine)
    again[hit] = rank[at[hit]]
    return again


_LEVEL = "block long, lang string, buckets long, bucket long, data binary"


def ranked(counts: DataFrame, name: str, *keys: str) -> DataFrame:
    """``counts`` (``lang, a`` and the keys) with ``id``, which rises with falling ``a`` within the language.

    Rows are sorted in ranges and numbered on within each; numbers leave gaps between ranges, which a
    block closes for its own words.
    """
    order = ["lang", F.desc("a"), *keys]
    sorted_ = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(sorted_.select("lang", *keys, "a", F.monotonically_increasing_id().alias("id")), name)


class Step:
    """A written table that is removed when the next step is written."""

    def __init__(self, rows: DataFrame, name: str) -> None:
        self.spark, self.path = rows.sparkSession, shared_path(rows.sparkSession, name)
        rows.write.parquet(self.path)
        self.rows = self.spark.read.schema(rows.schema).parquet(self.path)

    def remove(self) -> None:
        remove_folder(self.spark, self.path)


def _frequent_pairs(coded: DataFrame, least: int, name: str) -> DataFrame:
    """``lang, x, y, bucket, a, id`` from the blocks' counts."""
    counted = coded.where("bucket IS NOT NULL").select("lang", "bucket", "data")
    frequent = counted.groupBy("lang", "bucket").applyInArrow(_summed(least), "lang string, x long, y long, bucket long, a long")
    return ranked(frequent, name, "x", "y", "bucket")


def _described(frequent: DataFrame, shorter: DataFrame, name: str) -> DataFrame:
    """Phrases with their text, their last word, and the counts of what they begin and end with."""
    first, rest = shorter.alias("f"), shorter.alias("r")
    both = frequent.alias("p").join(first, (F.col("p.lang") == F.col("f.lang")) & (F.col("p.x") == F.col("f.id")))
    both = both.join(rest, (F.col("p.lang") == F.col("r.lang")) & (F.col("p.y") == F.col("r.id")))
    return materialize(both.select(
        F.col("p.lang").alias("lang"), F.col("p.id").alias("id"), F.col("p.a").alias("a"),
        F.concat_ws(" ", F.col("f.phrase"), F.col("r.last")).alias("phrase"), F.col("r.last").alias("last"),
        F.concat(F.col("f.begins"), F.array(F.col("f.a"))).alias("begins"),
        F.concat(F.col("r.ends"), F.array(F.col("r.a"))).alias("ends")), name)


def _scored(phrases: DataFrame, words: int, longer: DataFrame | None) -> DataFrame:
    """``lang, phrase, a, l, r, score`` at the weakest cut, without phrases that a longer one stands for."""
    whole = lambda c: c.cast("decimal(20,0)")
    unit = F.lit(SCORE_UNIT).cast("decimal(10,0)")

    def cut(k: int):
        left, right = F.get("begins", F.lit(k - 1)), F.get("ends", F.lit(words - k - 1))
        score = F.call_function("div", unit * whole(F.col("a")), whole(left) + whole(right))
        return F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    if longer is not None:
        around = longer.select("lang", F.explode(F.array("x", "y")).alias("id"), F.col("a").alias("around"))
        around = around.groupBy("lang", "id").agg(F.max("around").alias("around"))
        phrases = phrases.join(around, ["lang", "id"], "left").where(
            F.col("around").isNull() | (100 * whole(F.col("around")) < INSIDE_PERCENT * whole(F.col("a"))))
    weakest = F.array_min(F.array(*[cut(k) for k in range(1, words)]))
    return phrases.withColumn("cut", weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, top: int = TOP_PHRASES,
         text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    read = Step(rows.mapInArrow(_blocks, "block long, lang string, words array<binary>, counts array<bigint>, data binary"), "word-blocks")
    gap = F.get("counts", F.lit(0))
    totals = read.rows.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda n, m: n + m) - gap).alias("n")).where("n > 0")
    totals = materialize(totals, "word-totals")
    blocks = read.rows.join(totals.select("lang", F.ceil(F.col("n") / BUCKET_PAIRS).alias("buckets")), "lang")
    entries = Step(blocks.select("block", "lang", "buckets", "words", "counts").mapInArrow(
        _word_buckets, "block long, lang string, bucket long, words binary, data binary"), "word-buckets")
    counts = entries.rows.drop("block").groupBy("lang", "bucket").applyInArrow(
        _summed_words(least), "lang string, word binary, bucket long, a long")
    words = ranked(counts, "ranked-words", "word", "bucket")

    text = F.col("word").cast("string")
    none = F.array().cast("array<bigint>")
    shorter = words.select("lang", "id", "a", text.alias("phrase"), text.alias("last"), none.alias("begins"), none.alias("ends"))
    known = words.select("lang", "bucket", "word", "id")
    ranks = entries.rows.groupBy("lang", "bucket").cogroup(known.groupBy("lang", "bucket")).applyInArrow(_placed_words, "of long, ranks binary")
    stream, renumber, done = blocks.select("block", "lang", "buckets", "data"), _from_words, [read, entries]
    levels = []
    for size in range(2, most_words + 1):
        coded = stream.groupBy("block").cogroup(ranks.groupBy("of")).applyInArrow(_counted(renumber, size == most_words), _LEVEL)
        step = Step(coded, f"words-{size}-blocks")
        for earlier in done:
            earlier.remove()
        frequent = _frequent_pairs(step.rows, least, f"words-{size}-pairs")
        shorter = _described(frequent, shorter, f"phrases-{size}")
        levels.append((size, frequent, shorter))
        known = frequent.select("lang", "bucket", "x", "y", "id")
        counted = step.rows.where("bucket IS NOT NULL").select("block", "lang", "bucket", "data")
        ranks = counted.groupBy("lang", "bucket").cogroup(known.groupBy("lang", "bucket")).applyInArrow(_placed, "of long, ranks binary")
        stream, renumber, done = step.rows.where("bucket IS NULL").drop("bucket"), _from_pairs, [step]
    for step in done:
        step.remove()

    found = None
    for i, (size, _, phrases) in enumerate(levels):
        scored = _scored(phrases, size, levels[i + 1][1] if i + 1 < len(levels) else None)
        found = scored if found is None else found.unionByName(scored)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
cut AS (SELECT d, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS parts FROM docs),
pieces AS (SELECT d, lang, unnest(parts) AS piece, unnest(range(len(parts))) AS j FROM cut),
worded AS (SELECT d, j, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT d, j, lang, unnest(w) AS w1, unnest(range(len(w))) AS i FROM worded),
totals AS (SELECT lang, count(*)::BIGINT AS n FROM words GROUP BY lang),
runs AS (
    SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
    FROM words WINDOW p AS (PARTITION BY d, j ORDER BY i)),
f1 AS (SELECT lang, w1, count(*)::BIGINT AS a FROM words GROUP BY ALL HAVING count(*) >= 30),
f2 AS (SELECT lang, w1, w2, count(*)::BIGINT AS a FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
f3 AS (SELECT lang, w1, w2, w3, count(*)::BIGINT AS a FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
f4 AS (SELECT lang, w1, w2, w3, w4, count(*)::BIGINT AS a FROM runs WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
    SELECT p.lang, concat_ws(' ', p.w1, p.w2) AS phrase, p.a, 1 AS k, x.a AS l, y.a AS r
    FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
    UNION ALL
    SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3), p.a, 1, x.a, y.a
    FROM f3 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f2 y ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3
    UNION ALL
    SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3), p.a, 2, x.a, y.a
    FROM f3 p JOIN f2 x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w3
    UNION ALL
    SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3, p.w4), p.a, 1, x.a, y.a
    FROM f4 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1
    JOIN f3 y ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3 AND y.w3 = p.w4
    UNION ALL
    SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3, p.w4), p.a, 2, x.a, y.a
    FROM f4 p JOIN f2 x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 JOIN f2 y ON y.lang = p.lang AND y.w1 = p.w3 AND y.w2 = p.w4
    UNION ALL
    SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3, p.w4), p.a, 3, x.a, y.a
    FROM f4 p JOIN f3 x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 AND x.w3 = p.w3 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w4),
inside AS (
    SELECT lang, concat_ws(' ', w1, w2) AS phrase, a FROM f3 UNION ALL SELECT lang, concat_ws(' ', w2, w3), a FROM f3
    UNION ALL SELECT lang, concat_ws(' ', w1, w2), a FROM f4 UNION ALL SELECT lang, concat_ws(' ', w2, w3), a FROM f4
    UNION ALL SELECT lang, concat_ws(' ', w3, w4), a FROM f4
    UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3), a FROM f4 UNION ALL SELECT lang, concat_ws(' ', w2, w3, w4), a FROM f4),
around AS (SELECT lang, phrase, max(a) AS around FROM inside GROUP BY ALL),
scored AS (SELECT *, (2000000::HUGEINT * a // (l + r))::BIGINT AS score FROM cuts),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT w.* FROM weakest w LEFT JOIN around o USING (lang, phrase) WHERE o.around IS NULL OR 100 * o.around < 80 * w.a),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""
