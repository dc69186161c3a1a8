"""Substring dedup by longest previous factors in depth-limited suffix order.

A window is a string of ``length`` bytes. Windows that are equal have the same smallest gram hash
(minimizer), so the corpus is cut into pieces, maximal runs of windows with one minimizer, and only
pieces can match whose minimizers agree:

1. every document gives its pieces as hashes and places, without text;
2. minimizers that occur once anywhere are dropped; equal pieces collapse into one with a count,
   so a text copied a million times is one piece;
3. a minimizer with one distinct piece (and once in it) is settled by that count; the texts of the others are
   fetched and go, some megabytes of minimizers at a time, into a suffix array that sorts the suffixes by
   their first ``length`` bytes and keeps text order among ties. Within a run of equal suffixes the
   previous smaller position of a suffix in suffix order is its neighbour, the next smaller one
   shares fewer than ``length`` bytes: the longest previous factor reaches ``length`` exactly where
   there is a neighbour before it (a later match: after it);
4. the covered byte ranges return to all places of each piece, are merged per document and cut.

Texts of a minimizer that together exceed ``bucket_bytes`` do not go to one task: their windows are
hashed (128 bits) one by one and counted by partial sums, which settles them as exactly. Joins on
minimizers or pieces read written tables, so adaptive execution can split hot keys. Texts are shuffled packed.

``keep="first"`` keeps the first occurrence of each window (by id, text hash and place) and
removes later copies; ``keep="none"`` removes every byte that a window occurring twice covers.

Defined cases: null text is empty; shorter texts have no window and stay whole; rows equal in id and
text are copies of each other, and count as one place for "first"; windows never cross documents;
a null id is an id like others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import table, text_hash
from tidegauge.session import materialize

LENGTH = 400
GRAM = 64
#: Windows in a piece at most; longer runs (periodic text) are cut, which loses nothing.
PIECE = 4096
#: Bytes hashed at a time; longer documents are read in overlapping parts.
BLOCK = 1 << 20
#: Bytes of text in one suffix array, and bytes of one minimizer beyond which its windows are hashed instead.
ARRAY_BYTES = 1 << 21
BUCKET_BYTES = 1 << 24
#: Suffixes sorted at a time at most, but for larger classes.
STEP = 1 << 16

_MIX = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(data: np.ndarray, size: int, table_: np.ndarray = _MIX, factor: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position, by doubling."""
    hashes, width, done, power = table_[data], 1, None, factor
    taken = 0
    while True:
        if size & width:  # the result grows by blocks from the left
            if done is None:
                done, taken = hashes.copy(), width
            else:
                left = done[:len(hashes) - taken] if len(hashes) > taken else done[:0]
                done = left * np.uint64(power) + hashes[taken:taken + len(left)]
                taken += width
        if width * 2 > size:
            break
        hashes = hashes[:-width] * np.uint64(power) + hashes[width:]
        power, width = (power * power | 1) & 0xFFFFFFFFFFFFFFFF, width * 2
    return _mixed(done[:max(len(data) - size + 1, 0)].copy())


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach, least = 1, values
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def pieces_of(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, bool]]:
    """``start, windows, minimizer, inner`` of the pieces of a text; every window is in one of them.

    ``inner`` tells that the minimizer occurs twice in the piece, so that its own windows may repeat.
    """
    view = np.frombuffer(text, np.uint8)
    for begin in range(0, max(len(view) - length + 1, 0), BLOCK):
        part = view[begin:begin + BLOCK + length - 1]
        grams = gram_hashes(part, gram)
        least = sliding_min(grams, length - gram + 1)
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        edges = np.concatenate([[0], cuts, [len(least)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            inner = np.count_nonzero(grams[a:b + length - gram] == least[a]) > 1
            for at in range(a, b, PIECE):
                yield begin + at, min(PIECE, b - at), int(least[a]), inner


def _digest(data: bytes) -> tuple[int, int]:
    name = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True)


def _blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, bytes]]:
    for i, value in enumerate(batch.column(column)):
        yield i, value.as_py() or b""


def _cut(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, start, n, h, c1, c2, inside = [], [], [], [], [], [], []

            def out() -> pa.RecordBatch:
                rows = pa.array(owner, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("hash").take(rows), pa.array(start, pa.int64()), pa.array(n, pa.int32()),
                     pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                     pa.array(inside, pa.bool_())],
                    ["id", "hash", "start", "n", "h", "c1", "c2", "inner"])

            for i, text in _blocks(batch, "data"):
                for a, count, least, inner in pieces_of(text, length, gram):
                    one, two = _digest(text[a:a + count + length - 1])
                    owner.append(i)
                    start.append(a)
                    n.append(count)
                    h.append(least)
                    c1.append(one)
                    c2.append(two)
                    inside.append(inner)
                if len(owner) > 50_000:
                    yield out()
                    for column in (owner, start, n, h, c1, c2, inside):
                        column.clear()
            if owner:
                yield out()

    return run


def _whole_classes(order: np.ndarray, rank: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Cuts of ``order`` between classes, of at most ``step`` suffixes; a larger class is a cut of its own."""
    a = 0
    while a < len(order):
        b = a + step
        while True:
            base = rank[order[a:b + 1]]
            edges = np.flatnonzero(base[1:] != base[:-1]) + 1
            if b >= len(order) and (b == a + step or not len(edges)):
                b = len(order)
            elif len(edges):
                b = a + int(edges[-1] if b == a + step else edges[0])
            else:
                b += b - a
                continue
            break
        yield a, b
        a = b


def _by_two_bytes(padded: np.ndarray, size: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first one or two bytes, and the place where the class of each begins."""
    def keys(a: int) -> np.ndarray:
        b = min(a + STEP, size)
        key = padded[a:b].astype(np.uint16)
        return (key << 8) | padded[a + 1:b + 1] if width > 1 else key

    counts = sum((np.bincount(keys(a), minlength=1 << 16) for a in range(0, size, STEP)), np.zeros(1 << 16, np.int64))
    begins = np.cumsum(counts) - counts
    order, rank, free = np.empty(size, np.int32), np.empty(size, np.int32), begins.copy()
    for a in range(0, size, STEP):
        key = keys(a)
        rank[a:a + len(key)] = begins[key]
        here = np.argsort(key, kind="stable")
        key, many = key[here], np.bincount(key, minlength=1 << 16)
        order[free[key] + np.arange(len(key)) - (np.cumsum(many) - many)[key]] = here + a
        free += many
    return order, rank


def suffix_order(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes by their first ``length`` bytes, and those that may share theirs, by rank.

    A rank is the place in suffix order where the suffix's class begins. Suffixes are dealt by two
    bytes, sorted by six more, then by the ranks of two later suffixes, which makes the depth three
    times as large. Only classes of several suffixes are sorted on, some thousand suffixes at a time,
    so that an array takes about 16 bytes of memory per byte of text. Suffixes that run past the end
    are padded with zero bytes.
    """
    size = len(data) + length
    padded = np.concatenate([data, np.zeros(length + 16, np.uint8)])
    depth = min(2, length)
    order, rank = _by_two_bytes(padded, size, depth)
    eight = np.ndarray((size + 8,), ">u8", padded.data, strides=(1,))
    bits = size.bit_length()
    while depth < length and len(order):
        deeper = min(depth + 6 if depth == 2 else 3 * depth, length)
        # The number of a class within a cut and the key fit 64 bits.
        step = min(STEP, 1 << (16 if depth == 2 else max(64 - 2 * bits, 0)))
        fresh, shared = np.empty(len(order), np.int32), np.empty(len(order), bool)
        for a, b in _whole_classes(order, rank, step):
            at = order[a:b]
            base = rank[at]
            opens = np.concatenate([[True], base[1:] != base[:-1]])
            key = np.cumsum(opens, dtype=np.uint64) - np.uint64(1)
            if depth == 2:
                key <<= np.uint64(48)
                key |= eight[at + 2].astype(np.uint64) >> np.uint64(8 * (10 - deeper))
            else:
                for shift in (min(depth, deeper - depth), deeper - depth):
                    key <<= np.uint64(bits)
                    key |= rank[np.minimum(at + shift, size - 1)].astype(np.uint64)
            here = np.argsort(key)
            at, key = at[here], key[here]
            del here
            parts = np.concatenate([[True], key[1:] != key[:-1]])
            del key
            place = np.arange(b - a, dtype=np.int32)
            # Classes keep their places, so ``base`` and ``opens`` hold for the sorted suffixes too.
            fresh[a:b] = base + np.maximum.accumulate(np.where(parts, place, 0)) - np.maximum.accumulate(np.where(opens, place, 0))
            shared[a:b] = ~(parts & np.concatenate([parts[1:], [True]]))
            order[a:b] = at
        for a in range(0, len(order), STEP):
            rank[order[a:a + STEP]] = fresh[a:a + STEP]
        order, depth = order[shared], deeper
    return rank[:len(data)], order[order < len(data)]


def suffix_classes(data: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``length`` bytes; equal ranks where these bytes are equal."""
    return suffix_order(data, length)[0]


def matches(texts: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text two flags per window: it has an earlier match, it has a later one.

    Earlier is by order of the texts, then by place: the depth-limited longest previous factor
    from the neighbours in suffix order.
    """
    starts = np.cumsum([0, *map(len, texts)]).tolist()
    rank, order = suffix_order(np.frombuffer(b"".join(texts), np.uint8), length)
    window, previous, following = (np.zeros(len(rank), bool) for _ in range(3))
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        window[a:b - length + 1] = True
    for a, b in _whole_classes(order, rank, STEP):
        at = order[a:b][window[order[a:b]]]
        key = rank[at].astype(np.int64) << 32 | at
        key.sort()
        same, at = key[1:] >> 32 == key[:-1] >> 32, key & 0xFFFFFFFF
        previous[at[1:]] = same
        following[at[:-1]] = same
    return [(previous[a:b - length + 1], following[a:b - length + 1]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def ranges(flags: np.ndarray, length: int) -> list[int]:
    """Merged byte ranges that the flagged windows cover, as from, to, from, to ..."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > length)
    firsts, lasts = at[np.concatenate([[0], breaks + 1])], at[np.concatenate([breaks, [len(at) - 1]])] + length
    return np.stack([firsts, lasts], axis=1).ravel().tolist()


def _some_minimizers(rows: pa.Table) -> Iterator[pa.Table]:
    """Rows by minimizer and place, in tables of whole minimizers with some megabytes of text."""
    order = [(k, "ascending") for k in ("h", "id", "hash", "start")]
    at = pc.sort_indices(rows, sort_keys=order, null_placement="at_start").to_numpy()
    h, size = rows["h"].to_numpy()[at], pc.binary_length(rows["text"]).to_numpy()[at]
    ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))
    reach, a, before = np.cumsum(size, dtype=np.int64), 0, 0
    for b, more in zip(ends.tolist(), [*ends[1:].tolist(), None], strict=True):
        if more is None or reach[more - 1] - before > ARRAY_BYTES:
            yield rows.take(pa.array(at[a:b]))
            a, before = b, int(reach[b - 1])


def _suffix_arrays(length: int):
    def one_array(rows: pa.Table) -> pa.Table:
        one, two, many = (rows[k].to_pylist() for k in ("c1", "c2", "m"))
        # A repeated row has fetched its pieces twice; each piece counts once, by its first place.
        fresh = sorted({c: i for i, c in reversed([*enumerate(zip(one, two, strict=True))])}.values())
        found = matches([rows["text"][i].as_py() for i in fresh], length)
        return pa.table({
            "c1": pa.array([one[i] for i in fresh], pa.int64()), "c2": pa.array([two[i] for i in fresh], pa.int64()),
            "everywhere": pa.array([ranges(p | f | (many[i] > 1), length) for i, (p, f) in zip(fresh, found, strict=True)], pa.list_(pa.int64())),
            "again": pa.array([ranges(p, length) for p, _ in found], pa.list_(pa.int64()))})

    def run(rows: pa.Table) -> pa.Table:
        return pa.concat_tables(map(one_array, _some_minimizers(rows)))

    return run


def _fetch(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(len(batch)):
                text = unpack.decompress(batch.column("packed")[i].as_py())
                wanted = batch.column("wanted")[i].as_py()
                one = batch.slice(i, 1)
                many = pa.array([0] * len(wanted), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [one.column("id").take(many), one.column("hash").take(many), pa.array([w["start"] for w in wanted], pa.int64()),
                     *[pa.array([w[k] for w in wanted], pa.int64()) for k in ("h", "c1", "c2", "m", "bytes")],
                     pa.array([text[w["start"]:w["start"] + w["n"] + length - 1] for w in wanted], pa.binary())],
                    ["id", "hash", "start", "h", "c1", "c2", "m", "bytes", "text"])

    return run


def _windows(length: int):
    """Each window of the pieces with two 64-bit hashes."""
    other = np.random.default_rng(21).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in _blocks(batch, "text"):
                data = np.frombuffer(text, np.uint8)
                a, b = gram_hashes(data, length), gram_hashes(data, length, other, 0xA0761D6478BD642F)
                many = pa.array(np.zeros(len(a), np.int64))
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(k).take(many) for k in ("id", "hash", "start", "c1", "c2", "m")), pa.array(np.arange(len(a))),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                    ["id", "hash", "start", "c1", "c2", "m", "at", "w1", "w2"])

    return run


def _hashed_windows(texts: DataFrame, length: int, id_type: str) -> DataFrame:
    """What ``_suffix_arrays`` gives, from hashed windows counted by partial sums."""
    schema = f"id {id_type}, hash long, start long, c1 long, c2 long, m long, at long, w1 long, w2 long"
    windows = texts.select("id", "hash", "start", "c1", "c2", "m", "text").mapInArrow(_windows(length), schema)
    place = F.struct("id", "hash", (F.col("start") + F.col("at")).alias("byte"))
    repeated = materialize(
        windows.groupBy("w1", "w2").agg(F.sum("m").alias("all"), F.min(place).alias("first")).where("all > 1"), "repeated-windows")
    found = windows.join(repeated, ["w1", "w2"]).select("c1", "c2", "at", (~place.eqNullSafe(F.col("first"))).alias("again"))
    spans = lambda flag: F.coalesce(F.flatten(F.collect_list(F.when(flag, F.array("at", F.col("at") + length)))), F.array())
    return found.groupBy("c1", "c2").agg(spans(F.lit(True)).alias("everywhere"), spans(F.col("again")).alias("again"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data = [pack.compress(text) for _, text in _blocks(batch, "data")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), pa.array(data, pa.binary())], ["id", "hash", "packed"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows, size = [], 0
        for i in range(len(batch)):
            text = unpack.decompress(batch.column("packed")[i].as_py())
            flat = np.array(batch.column("covered")[i].as_py() or [], np.int64).reshape(-1, 2)
            spans = _merged(flat)
            edges = [0, *spans.ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((i, len(text), [{"start": a, "end": b} for a, b in spans.tolist()], kept))
            size += len(kept)
            if size > 1 << 23 or i + 1 == len(batch):
                places = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(places), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array([r[3] for r in rows], pa.binary())], ["id", "n_bytes", "spans", "kept"])
                rows, size = [], 0


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and adjoining ranges joined."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([first[1:], [True]])
    return np.stack([spans[first, 0], reach[last]], axis=1)


def covered_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "first",
                   bucket_bytes: int = BUCKET_BYTES, packed: DataFrame | None = None) -> DataFrame:
    """``id, hash, covered`` (from, to, from, to ...) of the documents ``id, hash, data`` that lose bytes."""
    id_type = docs.schema["id"].dataType.simpleString()
    pieces = materialize(docs.mapInArrow(
        _cut(length, gram), f"id {id_type}, hash long, start long, n int, h long, c1 long, c2 long, inner boolean"), "pieces")
    shared = materialize(pieces.groupBy("h").agg(F.count(F.lit(1)).alias("places"), F.max("inner").alias("inner")).where("places > 1 OR inner").select("h"), "shared-minimizers")
    pieces = materialize(pieces.join(shared, "h", "left_semi"), "shared-pieces")
    distinct = materialize(
        pieces.groupBy("h", "c1", "c2").agg(
            F.count(F.lit(1)).alias("m"), F.max("n").alias("n"), F.max("inner").alias("inner"), F.min(F.struct("id", "hash", "start")).alias("first")), "distinct-pieces")
    rivals = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("d"), F.max("inner").alias("inner"), F.sum(F.col("n") + (length - 1)).alias("bytes"))
    rivals = materialize(rivals.where("d > 1 OR inner").drop("inner"), "rivals")
    whole = F.array(F.lit(0).cast("long"), (F.col("n") + (length - 1)).cast("long"))
    settled = distinct.where("m > 1").join(rivals.select("h"), "h", "left_anti").select(
        "c1", "c2", "first", whole.alias("everywhere"), F.array().cast("array<bigint>").alias("again"))
    wanted = distinct.join(rivals, "h").select("h", "c1", "c2", "m", "n", "first", "bytes")
    per_doc = wanted.groupBy(F.col("first.id").alias("id"), F.col("first.hash").alias("hash")).agg(
        F.collect_list(F.struct("h", "c1", "c2", "m", "n", "bytes", F.col("first.start").alias("start"))).alias("wanted"))
    packed = packed if packed is not None else _packed(docs)
    chosen = packed.alias("p").join(per_doc.alias("w"), F.col("p.id").eqNullSafe(F.col("w.id")) & (F.col("p.hash") == F.col("w.hash")))
    chosen = chosen.select("p.id", "p.hash", "p.packed", "w.wanted")
    texts = materialize(chosen.mapInArrow(
        _fetch(length), f"id {id_type}, hash long, start long, h long, c1 long, c2 long, m long, bytes long, text binary"), "rival-texts")
    size = rivals.where(F.col("bytes") <= bucket_bytes).agg(F.sum("bytes")).first()[0] or 0
    groups = max(1, math.ceil(size / ARRAY_BYTES))
    # Minimizers are dealt into groups of some megabytes by hash; a larger one is a group of its own.
    group = F.when(F.col("bytes") > ARRAY_BYTES, F.col("h")).otherwise(F.pmod(F.xxhash64("h"), F.lit(groups)))
    arrays = texts.where(F.col("bytes") <= bucket_bytes).withColumn("group", group).groupBy("group")
    result = "c1 long, c2 long, everywhere array<bigint>, again array<bigint>"
    solved = arrays.applyInArrow(_suffix_arrays(length), result)
    hashed = _hashed_windows(texts.where(F.col("bytes") > bucket_bytes), length, id_type)
    firsts = wanted.select("c1", "c2", "first")
    verdicts = materialize(
        solved.unionByName(hashed).join(firsts, ["c1", "c2"]).unionByName(settled), "verdicts")
    place = F.struct("id", "hash", "start")
    if keep == "none":
        span = F.col("everywhere")
    else:
        full = F.array(F.lit(0).cast("long"), (F.col("n") + (length - 1)).cast("long"))
        span = F.when(place.eqNullSafe(F.col("first")), F.col("again")).otherwise(full)
    found = pieces.join(verdicts, ["c1", "c2"]).select("id", "hash", F.transform(span, lambda x: x + F.col("start")).alias("span"))
    return found.where(F.size("span") > 0).groupBy("id", "hash").agg(F.flatten(F.collect_list("span")).alias("covered"))


def _packed(docs: DataFrame) -> DataFrame:
    return docs.mapInArrow(_pack, f"id {docs.schema['id'].dataType.simpleString()}, hash long, packed binary")


def dedup(docs: DataFrame, length: int = LENGTH, keep: str = "first", gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, spans`` (removed, merged: start, end) and ``kept`` (the bytes that stay), a row per input row."""
    if gram > length:
        raise ValueError("a gram must fit a window")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("hash"), F.coalesce(text, F.lit("")).cast("binary").alias("data"))
    packed = _packed(rows)
    covered = covered_ranges(rows, length, gram, keep, bucket_bytes, packed)
    both = packed.alias("p").join(
        covered.alias("c"), F.col("p.id").eqNullSafe(F.col("c.id")) & (F.col("p.hash") == F.col("c.hash")), "left")
    id_type = rows.schema["id"].dataType.simpleString()
    return both.select("p.id", "p.packed", "c.covered").mapInArrow(
        _remove, f"id {id_type}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"), keep="none")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
