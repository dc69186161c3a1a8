"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds the hashes of its distinct word n-grams; documents with equal sets collapse
into one set with members.

1. Each set gets ``BANDS`` bands of ``BAND_ROWS`` least values of independent hashes. Sets that share
   a band are candidates; at a similarity of 0.85 a pair shares none with a probability of 7e-9. Only
   bands that several documents have go on. A band is led by its smallest set, and the sets of all
   bands with one leader form its group, so copies meet once and not once per band.
2. In a group, a set's signature is compared with those of the sets that are not linked to it yet, a
   batch of values at a time. After each batch the pairs go whose posterior probability (uniform
   prior) of being as similar as asked for is under ``MISS``.
3. Survivors are verified on their whole sets. A group gives a spanning forest of its links, never
   all pairs.
4. A group of more than ``group_bytes`` is dealt to several parts, each with the leader. When the
   components so far are known, every set outside the group's largest component meets every set of
   the group in blocks of bounded bytes; pairs are never written.
5. Components of the links, by alternating stars, give each document its class.

Joins read written tables, so adaptive execution can split hot keys. The driver holds single sums.
Grams are 64-bit hashes; sets are compared exactly on them.

Defined cases: null text and text without words has an empty set, linked with nothing; a text of
fewer than n words is one gram; rows equal in id and text have the same set and one class; null ids
never name a class unless all of its ids are null, and are not kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import table, text_hash
from tidegauge.llm.components import components
from tidegauge.llm.ngram_join import gram_hashes
from tidegauge.session import materialize

GRAM = 5
PERCENT = 85
BANDS, BAND_ROWS = 32, 5
HASHES = BANDS * BAND_ROWS
#: Signature values that are compared before the next decision.
BATCH = 32
#: The posterior probability of a similarity as asked for, below which a pair is dropped.
MISS = 1e-9
GROUP_BYTES = 1 << 22
TASK_BYTES = 1 << 23
#: Values of a matrix that is worked on at once.
CHUNK = 1 << 20

_rng = np.random.default_rng(1303)
_MULTIPLIERS = _rng.integers(0, 1 << 31, HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_BAND_SEEDS = _rng.integers(1, 1 << 63, BANDS, np.uint64)


def signature(grams: np.ndarray) -> np.ndarray:
    """The least value of each hash over the grams. Grams are random already, so odd multipliers shuffle them."""
    short = (grams >> np.uint64(32)).astype(np.uint32)
    step = CHUNK // HASHES
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), step):
        np.minimum(least, (_MULTIPLIERS[:, None] * short[None, at:at + step]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of a signature."""
    rows = least.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    keys = _BAND_SEEDS.copy()
    for j in range(BAND_ROWS):
        keys = (keys ^ rows[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """After each batch, the fewest equal values that leave the asked similarity a posterior of ``miss`` or more.

    Of m values k are equal, so with a uniform prior the similarity is Beta(k + 1, m - k + 1), and it
    exceeds s with the probability that a binomial of m + 1 draws at s is at most k.
    """
    share, limits = percent / 100, []
    for seen in range(BATCH, HASHES + 1, BATCH):
        total, k = 0.0, -1
        while total < miss:
            k += 1
            total += math.comb(seen + 1, k) * share**k * (1 - share) ** (seen + 1 - k)
        limits.append(k)
    return limits


def _signed(gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, bands = [], [], []
            for value in batch.column("data"):
                grams = gram_hashes(value.as_py(), gram)
                names.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                sizes.append(len(grams))
                bands.append(band_keys(signature(grams)) if len(grams) else np.zeros(0, np.int64))
            offsets = pa.array(np.cumsum([0, *map(len, bands)]).astype(np.int32), pa.int32())
            values = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("hash"), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, values)], ["id", "hash", "set_id", "n", "bands"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([pack.compress(value.as_py()) for value in batch.column("data")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), packed], ["id", "hash", "packed"])


def _fetched(gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sets = [gram_hashes(unpack.decompress(value.as_py()), gram) for value in batch.column("packed")]
            # Half of each value is enough to compare: a chance match only delays the decision.
            short = [signature(grams).astype(np.uint16).tobytes() for grams in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(short, pa.binary())],
                ["node", "tokens", "signature"])

    return run


class _Sets:
    """Sets of one task, their tokens numbered, for exact comparisons of one set with many."""

    def __init__(self, sets: Sequence[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        numbers, self.tokens = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(len(numbers), bool)

    def similar(self, one: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Which of ``others`` share ``percent`` of their union with ``one``; no set is empty."""
        mine = self.tokens[self.starts[one]:self.starts[one + 1]]
        self.marked[mine] = True
        shared = np.zeros(len(others), np.int64)
        ends = np.cumsum(self.sizes[others])
        begin = 0
        while begin < len(others):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
            some = others[begin:end]
            lengths = self.sizes[some]
            places = np.cumsum(lengths) - lengths
            flat = np.repeat(self.starts[some] - places, lengths) + np.arange(int(lengths.sum()))
            shared[begin:end] = np.add.reduceat(self.marked[self.tokens[flat]], places, dtype=np.int64)
            begin = end
        self.marked[mine] = False
        return 100 * shared >= percent * (len(mine) + self.sizes[others] - shared)


def bayes_links(sets: Sequence[np.ndarray], signatures: Sequence[np.ndarray], percent: int = PERCENT,
                known: Sequence | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` that no batch of their signatures rules out.

    Sets of equal ``known`` (not None) are linked already.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    held = _Sets([sets[i] for i in order])
    values = np.stack([signatures[i] for i in order])
    label = np.arange(len(order))
    first: dict = {}
    for i, j in enumerate(order if known else []):
        if known[j] is not None:
            label[i] = first.setdefault(known[j], i)
    limits, links, roots = least_matches(percent), [], len(np.unique(label))
    for i in range(len(order)):
        if roots == 1:
            break
        # Sets that differ more in size cannot be as similar as asked for.
        last = int(np.searchsorted(held.sizes, held.sizes[i] * 100 // percent, "right"))
        near = np.flatnonzero(label[i + 1:last] != label[i]) + i + 1
        matches = np.zeros(len(near), np.int64)
        for batch, limit in enumerate(limits):
            if not len(near):
                break
            part = slice(batch * BATCH, (batch + 1) * BATCH)
            matches += np.count_nonzero(values[near, part] == values[i, part], axis=1)
            alive = matches >= limit
            near, matches = near[alive], matches[alive]
        if not len(near):
            continue
        for j in near[held.similar(i, near, percent)]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                roots -= 1
                links.append((order[i], order[int(j)]))
    return links


def _linked(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        groups: dict[tuple, dict[bytes, int]] = {}
        names, known = rows["node"].to_pylist(), rows["known"].to_pylist()
        for i, key in enumerate(zip(rows["center"].to_pylist(), rows["part"].to_pylist(), strict=True)):
            groups.setdefault(key, {}).setdefault(names[i], i)
        a, b = [], []
        for members in groups.values():
            ids, places = list(members), list(members.values())
            sets = [np.frombuffer(rows["tokens"][i].as_py(), np.uint64) for i in places]
            signatures = [np.frombuffer(rows["signature"][i].as_py(), np.uint16) for i in places]
            # A component's links all lead to its first name, which keeps the paths between groups short.
            heads = {name: name for name in ids}

            def head(name: bytes) -> bytes:
                while heads[name] != name:
                    heads[name] = name = heads[heads[name]]
                return name

            for x, y in bayes_links(sets, signatures, percent, [known[i] for i in places]):
                x, y = head(ids[x]), head(ids[y])
                heads[max(x, y)] = min(x, y)
            for name in ids:
                if head(name) != name:
                    a.append(name)
                    b.append(head(name))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _walk(rows: DataFrame, sets: DataFrame, total: int, percent: int) -> DataFrame:
    """Links found within each ``center, part`` of ``rows`` (and ``node, known``), of ``total`` bytes together."""
    tasks = max(1, math.ceil(total / TASK_BYTES))
    filled = rows.join(sets, "node").select("center", "part", "node", "tokens", "signature", "known",
                                            F.pmod(F.xxhash64("center", "part"), F.lit(tasks)).alias("task"))
    return materialize(filled.groupBy("task").applyInArrow(_linked(percent), "a binary, b binary"), "minhash-links")


def candidate_groups(named: DataFrame) -> DataFrame:
    """``center, node``: the groups of sets that share a band, the leader among them.

    ``named`` has ``set_id, n, bands``. The center is a hash of the leading set.
    """
    keyed = named.where("n > 0").select(F.col("set_id").alias("node"), F.explode("bands").alias("band"))
    common = materialize(keyed.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("band"), "common-bands")
    met = materialize(keyed.join(common, "band").select("band", "node").distinct(), "common-band-sets")
    leaders = met.groupBy("band").agg(F.min(F.xxhash64("node")).alias("center"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    leaders = materialize(leaders.select("band", "center"), "band-leaders")
    return materialize(met.join(leaders, "band").select("center", "node").distinct(), "minhash-groups")


def _sets_of(groups: DataFrame, named: DataFrame, rows: DataFrame, gram: int) -> tuple[DataFrame, DataFrame]:
    """The sets of the groups, each from one of its documents: ``node, tokens, signature`` and ``node, n``."""
    needed = groups.select(F.col("node").alias("set_id")).distinct()
    chosen = named.join(needed, "set_id").groupBy(F.col("set_id").alias("node")).agg(
        F.min(F.struct("id", "hash")).alias("place"), F.max("n").alias("n"))
    chosen = materialize(chosen, "minhash-sets")
    # The same plan at every size: packed texts meet the chosen places in a shuffle that can be split.
    packed = rows.mapInArrow(_packed, f"id {rows.schema['id'].dataType.simpleString()}, hash long, packed binary").hint("merge")
    found = packed.alias("r").join(chosen.alias("c"), F.col("r.id").eqNullSafe(F.col("c.place.id")) & (F.col("r.hash") == F.col("c.place.hash")))
    fetched = found.select("c.node", "r.packed").mapInArrow(_fetched(gram), "node binary, tokens binary, signature binary")
    return materialize(fetched, "minhash-tokens"), chosen.select("node", "n")


def _blocks(apart: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    """``center, part, node, known``: every set of ``other`` shares a block with every set of its group; also their bytes.

    Both sides are dealt to parts of at most about half of ``group_bytes``; a block is a part of either.
    """
    size = F.col("n") * 8
    parts = lambda total: F.greatest(F.ceil(2 * total / group_bytes), F.lit(1))
    dealt = apart.groupBy("center").agg(parts(F.sum(F.when(F.col("other"), size))).alias("down"), parts(F.sum(size)).alias("across"))
    rows = apart.join(materialize(dealt, "block-parts"), "center")
    place = F.xxhash64("node", F.lit(1))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    asked = rows.where("other").withColumn("at", every(F.col("across"))).select(
        "center", (F.pmod(place, F.col("down")) * F.col("across") + F.col("at")).alias("part"), "node", "known", "n")
    met = rows.withColumn("at", every(F.col("down"))).select(
        "center", (F.col("at") * F.col("across") + F.pmod(place, F.col("across"))).alias("part"), "node", "known", "n")
    blocks = materialize(asked.unionByName(met).distinct(), "minhash-blocks")
    return blocks.select("center", "part", "node", "known"), blocks.agg(F.sum(size)).first()[0] or 0


def _links(groups: DataFrame, sets: DataFrame, sized: DataFrame, percent: int, group_bytes: int) -> DataFrame:
    """All links within the groups, up to those that others imply: ``a, b``."""
    bytes_ = groups.join(sized, "node").groupBy("center").agg((F.sum("n") * 8).alias("bytes"))
    parts = materialize(bytes_.select("center", "bytes", F.greatest(F.ceil(F.col("bytes") / group_bytes), F.lit(1)).alias("parts")), "group-parts")
    total, most = parts.agg(F.sum("bytes"), F.max("parts")).first()
    leads = F.xxhash64("node") == F.col("center")
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)  # the leader is in every part
    own = F.array(F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")))
    rows = groups.join(parts, "center").select("center", "node", F.explode(F.when(leads, every).otherwise(own)).alias("part"))
    rows = materialize(rows.withColumn("known", F.lit(None).cast("long")), "group-rows")
    links = _walk(rows, sets, total or 0, percent)
    if (most or 1) == 1:
        return links
    labels = components(links).withColumn("known", F.xxhash64("label")).select("node", "known")
    split = parts.where("parts > 1").select("center")
    dealt = groups.join(split, "center").join(labels, "node", "left").join(sized, "node")
    dealt = materialize(dealt.select("center", "node", "n", F.coalesce("known", F.xxhash64("node")).alias("known")), "group-labels")
    main = dealt.groupBy("center", "known").agg(F.count(F.lit(1)).alias("sets")).groupBy("center").agg(
        F.max(F.struct("sets", "known")).alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    main = materialize(main.select("center", F.col("main.known").alias("main")), "group-main")
    apart = materialize(dealt.join(main, "center").select(
        "center", "node", "n", "known", (F.col("known") != F.col("main")).alias("other")), "groups-apart")
    blocks, total = _blocks(apart, group_bytes)
    return links.unionByName(_walk(blocks, sets, total, percent))


def classes(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, group_bytes: int = GROUP_BYTES,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, n_shingles, component_id, kept``, a row per row of ``docs``; ``kept`` marks the smallest id of a class."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("hash"), F.coalesce(text, F.lit("")).cast("binary").alias("data"))
    id_type = rows.schema["id"].dataType.simpleString()
    named = materialize(rows.mapInArrow(_signed(gram), f"id {id_type}, hash long, set_id binary, n long, bands array<bigint>"), "minhash-bands")
    groups = candidate_groups(named)
    sets, sized = _sets_of(groups, named, rows, gram)
    labels = components(_links(groups, sets, sized, percent, group_bytes)).withColumnRenamed("node", "set_id")
    labelled = named.select("id", "hash", "n", "set_id").join(labels, "set_id", "left").select(
        "id", "hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("label", "set_id")).alias("label"))
    labelled = materialize(labelled, "minhash-labelled")
    named_rows = labelled.where(F.col("label").isNotNull())
    least = materialize(named_rows.groupBy("label").agg(F.min("id").alias("component_id")), "minhash-classes")
    linked = named_rows.join(least, "label").select("id", "hash", "n_shingles", "component_id")
    alone = labelled.where(F.col("label").isNull()).select("id", "hash", "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
