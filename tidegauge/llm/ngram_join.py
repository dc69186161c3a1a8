"""N-gram Jaccard self-join with prefix trees.

A document's set holds the hashes of its distinct word n-grams. Tokens are relabelled so that
their numeric order is the global order, rarest first (counts of 2**16 hash buckets over all
documents). Documents with equal sets collapse into one set with members. Two sets that link share a
token of their prefixes, so:

1. prefix tokens that only one set has are dropped; every other token is a bucket of sets for each
   size class, and a set is in its own class and the next. Prefixes are longer than one common token
   needs, so that linked sets share several;
2. buckets of few sets give pairs, which must share enough buckets; a larger bucket is led by its
   smallest set, and the members of the buckets with one leader form its group. Equal pairs of leader and member
   collapse, so that near copies meet once and not once per token;
3. a group's sets are fetched into a prefix tree of ordered tokens. A query walks it sharing the
   overlap of common paths and leaves a subtree when the tokens that remain cannot reach the bound.
   It only enters subtrees with a set whose prefix has enough in common with its own, counted
   for all sets of the tree at once.
   Sets that are linked already are not compared again: a group gives a spanning forest of its
   links, never all pairs;
4. a group of more than ``group_bytes`` is dealt to several trees, each with the leader; after the
   components so far are known, the sets of its buckets that are still apart meet again. Of two sets
   that link, the bucket of their first common token has both at places from which enough tokens
   follow; that bounds the size of a set's partners, so a bucket is split into cells by size that
   hold a smaller and a larger set each. Sets that share many buckets meet in one cell for all
   buckets of a leader and size class where that sends fewer bytes. Cells of more than
   ``group_bytes`` are compared block by block, every tree within that bound; pairs are never written;
5. components of the links, by alternating stars, give each document its class.

Joins read written tables, so adaptive execution can split hot keys. The driver holds the 2**16
bucket counts and single sums. Tokens are 64-bit hashes; sets are compared exactly on them.

Defined cases: null text and text without words has an empty set, linked with nothing; a text of
fewer than n words is one gram; rows equal in id and text have the same set and one class; null ids
never name a class unless all of its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import table, text_hash
from tidegauge.llm.components import components
from tidegauge.session import materialize

GRAM = 4
PERCENT = 85
#: The share of a set by which its prefix is longer than one common token needs.
MORE_PERCENT = 2
#: Sets of a bucket whose pairs are counted one by one.
FEW = 8
BUCKETS = 1 << 16
BLOCK = 1 << 20
GROUP_BYTES = 1 << 22
TASK_BYTES = 1 << 23

_rng = np.random.default_rng(60)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BASE = int(_rng.integers(1, 1 << 62)) * 2 + 1
_BACK = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < count:
        have = np.full(max(count, BLOCK + 1), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _POWERS[base] = have
    return have[:count]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words, case of A-Z aside; long texts are read in parts cut at blanks."""
    found, begin = [], 0
    while begin < len(text):
        end = min(begin + BLOCK, len(text))
        if end < len(text):
            cut = max(text.rfind(b, begin, end) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:
                nexts = [x for x in (text.find(b, end) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0]
                cut = min(nexts, default=len(text) - 1)
            end = cut + 1
        data = np.frombuffer(text, np.uint8, end - begin, begin)
        blank = np.concatenate([[True], _BLANK[data], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
            found.append(_mix((sums[ends] - sums[starts]) * _powers(_BACK, len(data))[starts] + (ends - starts).astype(np.uint64)))
        begin = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def gram_hashes(text: bytes, gram: int = GRAM) -> np.ndarray:
    words = word_hashes(text)
    size = min(gram, len(words))
    if not size:
        return words
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + words[i:i + count])
    return np.unique(total)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("data"):
        yield value.as_py() or b""


def bucket_ranks(docs: DataFrame, gram: int) -> np.ndarray:
    """The rank of each hash bucket by how many grams of all documents fall into it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in _texts(batch):
                np.add.at(total, (gram_hashes(text, gram) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counts = docs.select("data").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    weights = np.zeros(BUCKETS, np.int64)
    for row in counts.collect():  # at most BUCKETS rows, whatever the corpus
        weights[row["bucket"]] = row["n"]
    ranks = np.empty(BUCKETS, np.uint64)
    ranks[np.argsort(weights, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    return ranks


def ordered_set(text: bytes, ranks: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The tokens of a text in global order: bucket rank first, then the rest of the hash."""
    hashes = gram_hashes(text, gram)
    return np.sort((ranks[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)] << np.uint64(48)) | (hashes >> np.uint64(16)))


def _sets(ranks: np.ndarray, gram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, prefixes = [], [], []
            for text in _texts(batch):
                tokens = ordered_set(text, ranks, gram)
                n = len(tokens)
                names.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                sizes.append(n)
                prefixes.append(tokens[:n - -(-percent * n // 100) + 1 + MORE_PERCENT * n // 100 if n else 0].view(np.int64))
            lengths = pa.array(np.cumsum([0, *map(len, prefixes)]).astype(np.int32), pa.int32())
            values = pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("hash"), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(lengths, values)], ["id", "hash", "set_id", "n", "prefix"])

    return run


def _partners(sets: list[np.ndarray], percent: int):
    """A function of ``i``: the places above ``i`` in ``sets``, ascending, that may link with it.

    Two sets that link have at least ``percent`` of either in common, so the first common token is in both
    prefixes. What the prefix that ends first does not share, or what follows it, bounds the overlap.
    """
    if len(sets) <= FEW:
        return lambda i: range(i + 1, len(sets))
    none = np.full(1, np.iinfo(np.uint64).max, np.uint64)  # stands for the token that empty sets share
    prefixes = [s[:len(s) - -(-percent * len(s) // 100) + 1] if len(s) else none for s in sets]
    sizes, final = np.array([len(s) for s in sets]), np.array([p[-1] for p in prefixes], np.uint64)
    ends = np.cumsum([0, *map(len, prefixes)])
    rest = sizes - np.diff(ends)
    tokens = np.concatenate(prefixes)
    order = np.argsort(tokens, kind="stable")  # a token's places ascend
    owners = np.repeat(np.arange(len(sets)), np.diff(ends))[order]
    last = np.flatnonzero(np.concatenate([tokens[order][1:] != tokens[order][:-1], [True]])) + 1
    after, stop = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    after[order] = np.arange(1, len(order) + 1)
    stop[order] = np.repeat(last, np.diff(last, prepend=0))

    def above(i: int) -> list[int]:
        begin, end = after[ends[i]:ends[i + 1]], stop[ends[i]:ends[i + 1]]
        counts = end - begin
        met = np.bincount(owners[np.repeat(end - np.cumsum(counts), counts) + np.arange(counts.sum())])
        j = np.flatnonzero(met)
        need = -(-percent * (sizes[i] + sizes[j]) // (100 + percent))
        able = met[j] + np.where(final[i] <= final[j], rest[i], rest[j]) >= need
        return j[able & (100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))].tolist()

    return above


def trie_links(sets: list[np.ndarray], percent: int = PERCENT, known: list | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` (ordered tokens), by one walk of their tree per set.

    Sets of equal ``known`` (not None) are linked already. A walk only enters subtrees that hold a set
    whose prefix has enough in common with the query's.
    """
    if not sets:
        return []
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    ordered = [sets[i] for i in order]
    sizes = np.array([len(s) for s in ordered])
    shared = []  # tokens that neighbours in order have in common from the start
    for a, b in zip(ordered[:-1], ordered[1:], strict=True):
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        shared.append(int(differ[0]) if len(differ) else m)
    nodes: dict[tuple[int, int], tuple[int, list[int], int, int]] = {}

    def node(lo: int, hi: int) -> tuple[int, list[int], int, int]:
        """Of the sets from ``lo`` to ``hi``: depth to which their paths agree, cuts between subtrees, least and largest size."""
        if (lo, hi) not in nodes:
            if hi - lo == 1:
                nodes[lo, hi] = (int(sizes[lo]), [], int(sizes[lo]), int(sizes[lo]))
            else:
                depth = min(shared[lo:hi - 1])
                cuts = [lo, *(i + 1 for i in range(lo, hi - 1) if shared[i] == depth), hi]
                nodes[lo, hi] = (depth, cuts, int(sizes[lo:hi].min()), int(sizes[lo:hi].max()))
        return nodes[lo, hi]

    parent = list(range(len(ordered)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict = {}
    for i, j in enumerate(order if known else []):
        if known[j] is not None:
            parent[i] = first.setdefault(known[j], i)
    links, roots, partners = [], len({find(i) for i in range(len(ordered))}), _partners(ordered, percent)
    for i, query in enumerate(ordered):
        size = len(query)
        if roots == 1:
            break
        root = find(i)
        asked = [j for j in partners(i) if find(j) != root]
        stack = [(0, len(ordered), 0, 0, 0, 0, len(asked))] if asked else []
        while stack:
            lo, hi, depth, overlap, passed, begin, end = stack.pop()
            if hi - lo == 1 and find(lo) == find(i):
                continue
            deep, cuts, least, most = node(lo, hi)
            low, high = max(least, -(-percent * size // 100)), min(most, size * 100 // percent)
            need = -(-percent * (size + low) // (100 + percent))
            if low > high or overlap + min(size - passed, high - depth) < need:
                continue
            run = ordered[lo][depth:deep]
            if len(run):
                at = np.searchsorted(query, run)
                overlap += int(np.count_nonzero(query[np.minimum(at, size - 1)] == run)) if size else 0
                passed = int(at[-1])
                if size and passed < size and query[passed] == run[-1]:
                    passed += 1
                if overlap + min(size - passed, high - deep) < need:
                    continue
            if hi - lo == 1:
                if 100 * overlap >= percent * (size + int(sizes[lo]) - overlap):
                    parent[find(lo)] = find(i)
                    roots -= 1
                    links.append((order[i], order[lo]))
            else:
                while begin < end:
                    k = bisect_right(cuts, asked[begin])
                    stop = bisect_left(asked, cuts[k], begin, end)
                    stack.append((cuts[k - 1], cuts[k], deep, overlap, passed, begin, stop))
                    begin = stop
    return links


def _tree_task(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        groups: dict[tuple, dict[bytes, int]] = {}
        tokens, names, known = rows["tokens"], rows["set_id"].to_pylist(), rows["known"].to_pylist()
        for i, key in enumerate(zip(rows["center"].to_pylist(), rows["part"].to_pylist(), strict=True)):
            groups.setdefault(key, {}).setdefault(names[i], i)
        a, b = [], []
        for members in groups.values():
            ids = list(members)
            sets = [np.frombuffer(tokens[members[s]].as_py(), np.uint64) for s in ids]
            for x, y in trie_links(sets, percent, [known[members[s]] for s in ids]):
                a.append(ids[x])
                b.append(ids[y])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _tree_links(pairs: DataFrame, sets: DataFrame, sized: DataFrame, percent: int, group_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Links (``a, b``) found in the groups of ``pairs`` (``center, node``), and the centers dealt to several trees.

    ``sets`` has ``node, set_id, tokens``, ``sized`` has ``node, n``.
    """
    members = pairs.join(sized, "node").groupBy("center").agg((F.sum("n") * 8).alias("bytes"))
    parts = materialize(members.select("center", F.greatest(F.ceil(F.col("bytes") / group_bytes), F.lit(1)).alias("parts"), "bytes"), "tree-parts")
    total = parts.agg(F.sum("bytes")).first()[0] or 0
    dealt = pairs.join(parts, "center").select("center", "node", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"))
    leaders = parts.select("center", F.col("center").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    rows = materialize(dealt.unionByName(leaders).withColumn("known", F.lit(None).cast("long")), "tree-rows")
    return _walk(rows, sets, total, percent), parts.where("parts > 1").select("center")


def _walk(rows: DataFrame, sets: DataFrame, total: int, percent: int) -> DataFrame:
    """Links found in the trees ``center, part`` of ``rows`` (and ``node, known``), of ``total`` bytes together."""
    tasks = max(1, math.ceil(total / TASK_BYTES))
    filled = rows.join(sets, "node").select("center", "part", "set_id", "tokens", "known",
                                            F.pmod(F.xxhash64("center", "part"), F.lit(tasks)).alias("task"))
    return materialize(filled.groupBy("task").applyInArrow(_tree_task(percent), "a binary, b binary"), "links")


def _fetch(ranks: np.ndarray, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sets = [ordered_set(unpack.decompress(p.as_py()), ranks, gram).tobytes() for p in batch.column("packed")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("set_id"), pa.array(sets, pa.binary())],
                                             ["node", "set_id", "tokens"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), pa.array([pack.compress(t) for t in _texts(batch)], pa.binary())],
                                         ["id", "hash", "packed"])


def classes(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, group_bytes: int = GROUP_BYTES,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, n_shingles, component_id``, a row per row of ``docs``."""
    labelled = _labelled(docs, gram, percent, group_bytes, id_col, text_col)
    least = materialize(labelled.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("component_id")), "class-ids")
    linked = labelled.where(F.col("label").isNotNull()).join(least, "label").select("id", "hash", F.col("n").alias("n_shingles"), "component_id")
    alone = labelled.where(F.col("label").isNull()).select("id", "hash", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def _labelled(docs: DataFrame, gram: int, percent: int, group_bytes: int = GROUP_BYTES,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, n, label``, a row per row of ``docs``; rows of a class share a label, which a row without words has not."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("hash"), F.coalesce(text, F.lit("")).cast("binary").alias("data"))
    id_type = rows.schema["id"].dataType.simpleString()
    ranks = bucket_ranks(rows, gram)
    named = materialize(rows.mapInArrow(
        _sets(ranks, gram, percent), f"id {id_type}, hash long, set_id binary, n long, prefix array<bigint>"), "gram-sets")
    tokens = named.select(F.posexplode("prefix").alias("pos", "token"), F.xxhash64("set_id").alias("node"), "n")
    common = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("token"), "common-tokens")
    common = materialize(tokens.join(common, "token").distinct(), "common-rows")
    pairs, led = _candidates(common, percent)
    places = named.where("n > 0").groupBy("set_id").agg(F.min(F.struct("id", "hash")).alias("place"), F.max("n").alias("n"))
    distinct = places.withColumn("node", F.xxhash64("set_id"))
    needed = pairs.select("node").unionByName(pairs.select(F.col("center").alias("node"))).distinct()
    chosen = materialize(distinct.select("node", "set_id", "n", "place").join(needed, "node"), "tree-sets")
    packed = rows.mapInArrow(_pack, f"id {id_type}, hash long, packed binary")
    fetched = packed.alias("p").join(chosen.alias("c"), F.col("p.id").eqNullSafe(F.col("c.place.id")) & (F.col("p.hash") == F.col("c.place.hash")))
    sets = materialize(fetched.select("c.node", "c.set_id", "p.packed").mapInArrow(
        _fetch(ranks, gram), "node long, set_id binary, tokens binary"), "ordered-sets")
    sized = chosen.select("node", "n")
    links, split = _tree_links(pairs, sets, sized, percent, group_bytes)
    if split.limit(1).count():
        apart = _apart(led.join(split, "center", "left_semi"), components(links), chosen, percent, group_bytes)
        blocks, total = _blocks(apart, group_bytes)
        links = links.unionByName(_walk(blocks, sets, total, percent))
    labels = components(links).withColumnRenamed("node", "set_id")
    return materialize(named.select("id", "hash", "n", "set_id").join(labels, "set_id", "left").select(
        "id", "hash", "n", F.when(F.col("n") > 0, F.coalesce("label", "set_id")).alias("label")), "labelled")


def _candidates(common: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``center, node`` that meet in a tree, and the buckets ``bucket, class, node, n, pos, center`` that have a leader.

    ``common`` has the common prefix tokens: ``token, node, n, pos``. Sets that link share at least as many
    of them as the smaller one's prefix is longer, and one. Buckets of few sets give their pairs, which
    are counted; a pair that its count, with all large buckets of either set, cannot bring to that
    number goes. Pairs that only meet in large buckets are found by the buckets' leaders, among sets
    that are in enough large buckets.
    """
    # Sets that link differ by less than a size class, so both are in the class of the larger, its own:
    # a bucket or pair without a set of its own class has met in the class below.
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / (percent - 1)))
    sized = common.select("token", "node", "n", "pos", F.explode(F.array(size_class, size_class + 1)).alias("class"))
    sized = sized.select(F.xxhash64("token", "class").alias("bucket"), "class", "node", "n", "pos", (F.col("class") == size_class).alias("own"))
    sizes = sized.groupBy("bucket").agg(F.count(F.lit(1)).alias("sets"), F.bool_or("own").alias("owned"))
    sizes = materialize(sizes.where("sets > 1 AND owned").drop("owned"), "bucket-sizes")
    buckets = materialize(sized.join(sizes, "bucket"), "buckets")
    large = buckets.where(F.col("sets") > FEW).drop("sets", "own")
    often = materialize(large.groupBy("node", "class").agg(F.count(F.lit(1)).alias("often"), F.max("n").alias("n")), "large-buckets-of-sets")
    few = buckets.where(F.col("sets") <= FEW).join(often.drop("n"), ["node", "class"], "left")
    member = F.struct("node", "n", F.coalesce("often", F.lit(0)).alias("often"), "own")
    groups = few.groupBy("bucket", "class").agg(F.sort_array(F.collect_list(member)).alias("sets"))
    each = F.flatten(F.transform("sets", lambda x, i: F.transform(
        F.slice("sets", i + 2, F.size("sets")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    met = groups.select("class", F.explode(each).alias("p")).select("class", "p.x", "p.y")
    least, most = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    met = met.where((F.col("x.own") | F.col("y.own")) & (100 * least >= percent * most)).groupBy(F.col("x.node").alias("center"), F.col("y.node").alias("node"), "class").agg(
        F.count(F.lit(1)).alias("tokens"), F.max(F.least("x.often", "y.often")).alias("more"), F.max(least).alias("n"))
    near = met.where(F.col("tokens") + F.col("more") >= 1 + F.floor(MORE_PERCENT * F.col("n") / 100)).select("center", "node")
    able = often.where(F.col("often") >= 1 + F.floor(MORE_PERCENT * F.ceil(percent * F.col("n") / 100) / 100)).select("node", "class")
    led = materialize(large.join(able, ["node", "class"]), "large-buckets")
    leaders = led.groupBy("bucket").agg(F.min("node").alias("center"))
    led = materialize(led.join(leaders, "bucket").select("bucket", "class", "node", "n", "pos", "center"), "led-buckets")
    pairs = near.unionByName(led.where("node <> center").select("center", "node"))
    return materialize(pairs.distinct(), "tree-pairs"), led


def _apart(buckets: DataFrame, labels: DataFrame, chosen: DataFrame, percent: int, group_bytes: int) -> DataFrame:
    """``center, node, n, known, other``: the cells in which sets of a bucket meet that are not linked yet but may be.

    If the bucket's token is the first that two sets share, what follows it in either bounds their
    overlap, and so the size of a set's partner. A set is in the cell of its own size as the smaller
    one of a pair and in those of all sizes that its smaller partner can have. Cells are sizes, from
    about a hundred tokens on ranges of 1 %. ``other`` tells that a set is outside the bucket's
    largest component, as one of two sets apart is.

    Sets apart may share any number of buckets and would meet in each; where the cells of all buckets of
    a leader and size class send more bytes than the sets of these buckets in a single cell, they get that one.
    """
    named = chosen.select("node", "set_id").join(labels.select(F.col("node").alias("set_id"), "label"), "set_id", "left")
    rows = materialize(buckets.select("bucket", F.xxhash64("center", "class").alias("whole"), "node", "n", "pos").join(
        named.select("node", F.xxhash64(F.coalesce("label", "set_id")).alias("known")), "node"), "labelled-buckets")
    main = _main(rows, "bucket", "main-components")
    cell = lambda n: F.floor(F.log(n.cast("double")) * 100)
    n = F.col("n")
    most = F.floor((n - F.col("pos")) * (100 + percent) / percent) - n
    least, top = F.ceil(percent * n / 100), F.least(n, most)
    placed = rows.join(main, "bucket").select(
        "whole", "bucket", "node", "n", "known", (F.col("known") != F.col("main")).alias("other"), (most >= n).alias("smaller"),
        cell(n).alias("own"), F.when(top >= least, F.sequence(cell(least), cell(top))).alias("cells"))
    larger = placed.select("whole", "bucket", "node", "n", "known", "other", F.explode("cells").alias("cell"), F.lit(False).alias("smaller"))
    smaller = placed.where("smaller").select("whole", "bucket", "node", "n", "known", "other", F.col("own").alias("cell"), "smaller")
    meets = materialize(larger.unionByName(smaller).withColumn("center", F.xxhash64("bucket", "cell")), "cells-apart")
    used = meets.groupBy("center").agg(
        F.bool_or("smaller").alias("a"), F.bool_and("smaller").alias("b"), F.min("known").alias("x"), F.max("known").alias("y"), F.bool_or("other").alias("o"))
    used = used.where(F.col("a") & ~F.col("b") & F.col("o") & (F.col("x") != F.col("y"))).select("center")
    cells = materialize(meets.join(used, "center").select("whole", "center", "node", "n", "known", "other").distinct(), "cells-used")
    wholes = rows.join(cells.select("whole").distinct(), "whole").select("whole", "node", "n", "known").distinct()
    wholes = wholes.join(_main(wholes, "whole", "main-components-of-wholes"), "whole").select(
        "whole", F.col("whole").alias("center"), "node", "n", "known", (F.col("known") != F.col("main")).alias("other"))
    wholes = materialize(wholes, "wholes-apart")
    sent = lambda frame: _parts(frame.groupBy("whole", "center"), group_bytes).groupBy("whole").agg(F.sum(_sent()).alias("sent"))
    once = sent(wholes).join(sent(cells).withColumnRenamed("sent", "often"), "whole").where("sent <= often").select("whole")
    once = materialize(once, "wholes-used")
    return materialize(cells.join(once, "whole", "left_anti").unionByName(wholes.join(once, "whole")).drop("whole"), "apart")


def _main(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``key, main``: the component with most sets of each ``key`` that holds several."""
    main = rows.groupBy(key, "known").agg(F.count(F.lit(1)).alias("sets")).groupBy(key).agg(
        F.max(F.struct("sets", "known")).alias("main"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    return materialize(main.select(key, F.col("main.known").alias("main")), name)


def _parts(cells: GroupedData, group_bytes: int) -> DataFrame:
    """The bytes of a cell's sets and of those outside its main component, and in how many parts either is dealt."""
    size = F.col("n") * 8
    parts = lambda total: F.greatest(F.ceil(2 * total / group_bytes), F.lit(1))
    sums = cells.agg(F.sum(F.when(F.col("other"), size)).alias("asked"), F.sum(size).alias("met"))
    return sums.withColumn("down", parts(F.col("asked"))).withColumn("across", parts(F.col("met")))


def _sent() -> Column:
    """Bytes of the sets in all blocks of a cell."""
    return F.coalesce("asked", F.lit(0)) * F.col("across") + F.col("met") * F.col("down")


def _blocks(cells: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    """``center, part, node, known``: every set outside the main component of a cell shares a block with every set of it.

    Both sides are dealt to parts of at most about half of ``group_bytes``; a block is a part of either. Also their bytes.
    """
    dealt = _parts(cells.groupBy("center"), group_bytes).select("center", "down", "across")
    rows = cells.join(materialize(dealt, "cell-parts"), "center")
    place = F.xxhash64("node", F.lit(1))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    asked = rows.where("other").withColumn("across_", every(F.col("across"))).withColumn("down_", F.pmod(place, F.col("down")))
    met = rows.withColumn("down_", every(F.col("down"))).withColumn("across_", F.pmod(place, F.col("across")))
    block = (F.col("down_") * F.col("across") + F.col("across_")).alias("part")
    blocks = asked.select("center", block, "node", "known", "n").unionByName(met.select("center", block, "node", "known", "n"))
    blocks = materialize(blocks.distinct(), "block-rows")
    return blocks.select("center", "part", "node", "known"), blocks.agg(F.sum(F.col("n") * 8)).first()[0] or 0


def dedup(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """One document of each class of ``docs``, that of the smallest id and hash (a null id last), and all without words."""
    labelled = _labelled(docs, gram, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "hash")).alias("first")
    named = labelled.where(F.col("label").isNotNull()).groupBy("label").agg(first).select("first.id", "first.hash")
    keep = named.unionByName(labelled.where(F.col("label").isNull()).select("id", "hash").distinct())
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_hash(F.col("text")).alias("hash"))
    kept = keyed.alias("d").join(keep.alias("k"), F.col("d.id").eqNullSafe(F.col("k.id")) & (F.col("d.hash") == F.col("k.hash")), "left_semi")
    return kept.select("row.*")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")

