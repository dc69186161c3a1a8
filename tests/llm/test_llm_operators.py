"""The training-data operators on small hand-made tables: edge cases, brute force and round trips."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import (
    components,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    quality_rules,
    suffix_dedup,
    token_counts,
    warc,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 400
#: Null, empty and blank texts, ties, repeated rows, a null id, a very long text.
ODD = [
    (1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \n\n ", "en", "b", 4), (4, "A b c", "en", "a", 5),
    (4, "A b c", "en", "a", 5), (None, "A b c", "de", "b", 5), (5, LONG, "en", "a", len(LONG)), (6, "1 2 3 4", "en", None, 7),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def clashing(frame):
    """Extra columns with the names that operators use inside."""
    names = ["row", "id", "hash", "words", "at", "n", "copy", "label", "kept_text", "n_words", "win", "start", "size", "rank"]
    return frame.withColumns({name: F.lit("x") for name in names})


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


class TestLineDedup:
    def test_later_window_goes_and_first_stays(self, spark):
        docs = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\na\n\nb\nc\ny"), (3, "a\nb")], "doc_id long, text string")
        got = {r["row"]["doc_id"]: (r["n_removed"], r["kept_text"]) for r in line_dedup.dedup_lines(docs).collect()}
        assert got == {1: (0, "a\nb\nc\nd"), 2: (3, "x\n\ny"), 3: (0, "a\nb")}

    def test_overlapping_windows_merge(self, spark):
        docs = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "a\nb\nc\nd\ne\nz")], "doc_id long, text string")
        got = {r["row"]["doc_id"]: r["kept_text"] for r in line_dedup.dedup_lines(docs).collect()}
        assert got == {1: "a\nb\nc\nd\ne", 2: "z"}

    def test_odd_rows(self, odd, empty):
        rows = line_dedup.dedup_lines(clashing(odd)).collect()
        assert len(rows) == len(ODD) and all(r["n_removed"] == 0 for r in rows)
        assert [r["kept_text"] for r in rows if r["row"]["doc_id"] == 1] == [None]
        assert line_dedup.dedup_lines(empty).count() == 0


class TestSuffixDedup:
    @staticmethod
    def brute(rows, length, keep):
        counts, seen, out = Counter(), set(), {}
        data = [(i, (t or "").encode()) for i, t in rows]
        for _, t in data:
            counts.update(t[p:p + length] for p in range(len(t) - length + 1))
        for i, t in sorted(data):
            gone = bytearray(len(t))
            for p in range(len(t) - length + 1):
                w = t[p:p + length]
                if counts[w] > 1 and (keep == "none" or w in seen):
                    gone[p:p + length] = b"\1" * length
                seen.add(w)
            out[i] = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        return out

    @pytest.mark.parametrize("keep", ["first", "none"])
    @pytest.mark.parametrize("bucket_bytes", [1 << 24, 30])
    def test_like_brute_force(self, spark, keep, bucket_bytes):
        rnd = random.Random(5)
        share = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(20, 60))) for _ in range(4)]
        rows = [(i, "".join(rnd.choice([rnd.choice(share), "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 30)))])
                            for _ in range(rnd.randint(0, 6)))) for i in range(60)]
        rows += [(100, "ab" * 100), (101, None), (102, "x" * 19), (103, "y" * 21)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["id"]: bytes(r["kept"]) for r in suffix_dedup.dedup(docs, 20, keep, 8, bucket_bytes).collect()}
        assert got == self.brute(rows, 20, keep)

    def test_suffix_ranks(self):
        rnd = np.random.default_rng(3)
        data = rnd.integers(97, 99, 300).astype(np.uint8)
        rank = suffix_dedup.suffix_classes(data, 20)
        text = data.tobytes() + bytes(20)
        order = sorted(range(280), key=lambda i: text[i:i + 20])
        for a, b in zip(order[:-1], order[1:], strict=True):
            same = text[a:a + 20] == text[b:b + 20]
            assert rank[a] == rank[b] if same else rank[a] < rank[b]

    @pytest.mark.parametrize("step", [1, 3, 1 << 16])
    def test_matches_by_cuts(self, monkeypatch, step):
        monkeypatch.setattr(suffix_dedup, "STEP", step)
        rnd = random.Random(8)
        for length in (1, 2, 7, 8, 9, 25, 60):
            for letters in ("a", "ab", "abcdef\0"):
                texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(length, 3 * length))).encode() for _ in range(6)]
                texts += [texts[0] + texts[1], texts[0]]
                windows = [[t[p:p + length] for p in range(len(t) - length + 1)] for t in texts]
                flat = [w for ws in windows for w in ws]
                seen, left, got = Counter(), Counter(flat), suffix_dedup.matches(texts, length)
                for ws, (earlier, later) in zip(windows, got, strict=True):
                    for w, before, after in zip(ws, earlier, later, strict=True):
                        left[w] -= 1
                        assert (before, after) == (seen[w] > 0, left[w] > 0)
                        seen[w] += 1

    @pytest.mark.parametrize("letters", [b"abcdefgh ", b"ab"])
    def test_memory_of_suffix_order(self, letters):
        rnd = np.random.default_rng(4)
        part = rnd.choice(np.frombuffer(letters, np.uint8), 1000)
        texts = [np.concatenate([part, rnd.choice(part, 500)]).tobytes() for _ in range(600)]
        tracemalloc.start()
        found = suffix_dedup.matches(texts, 400)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # The shared part has 601 windows, and all of its copies match.
        assert all(f.sum() >= 601 for _, f in found[:-1]) and found[0][0].sum() == 0
        assert peak < 40 * sum(map(len, texts))

    def test_group_in_several_arrays(self, monkeypatch):
        monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 200_000)
        rnd = np.random.default_rng(6)
        part = rnd.integers(97, 123, 3000).astype(np.uint8).tobytes()
        rows = [{"id": i % 50, "hash": i, "start": 0, "h": i % 10 - 5, "c1": i, "c2": -i, "m": 1 + (i == 7), "bytes": 0,
                 "text": part + rnd.integers(97, 123, 1000).astype(np.uint8).tobytes()} for i in range(500)]
        rows = pa.Table.from_pylist([*rows, rows[9]])
        tracemalloc.start()
        got = {r["c1"]: r for r in suffix_dedup._suffix_arrays(400)(rows).to_pylist()}
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) == 500 and peak < 20 * 2_000_000
        # Each minimizer's texts match each other in the common part; its first text by place has no earlier match.
        assert all(r["everywhere"][0] == 0 and r["everywhere"][1] >= 3000 for r in got.values()) and got[7]["everywhere"] == [0, 4000]
        firsts = {min(i for i in range(500) if i % 50 == k) for k in range(10)}
        assert all((r["again"] == []) == (c in firsts) for c, r in got.items())

    def test_odd_rows(self, odd, empty):
        rows = suffix_dedup.dedup(clashing(odd).drop("id", "hash")).collect()
        assert len(rows) == len(ODD)
        assert suffix_dedup.dedup(empty).count() == 0


class TestDecontaminate:
    def test_whole_windows_only(self, spark):
        item = "one two three four five six seven eight nine ten eleven"
        docs = spark.createDataFrame([
            (1, "x " + item.upper() + " y"), (2, "one two three four five six seven eight nine"), (3, "short, Item!"), (4, "Éa éa"),
            (5, "éa éa")], "doc_id long, text string")
        items = spark.createDataFrame([("b", item), ("a", item), ("s", "short item"), ("e", "Éa éa"), ("n", None), ("z", "")],
                                      "item_id string, text string")
        got = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"])
               for r in decontaminate.decontaminate(docs, items).collect()}
        name = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got == {1: (13, 11, 2, name("a,b")), 2: (9, 0, 0, name("")), 3: (2, 2, 1, name("s")), 4: (2, 2, 1, name("e")),
                       5: (2, 0, 0, name(""))}

    def test_odd_rows(self, spark, odd, empty):
        items = spark.createDataFrame([("i", "a b c"), ("i", "a b c"), (None, None)], "item_id string, text string")
        rows = decontaminate.decontaminate(clashing(odd), items).collect()
        assert len(rows) == len(ODD) and sum(r["contaminated"] for r in rows) == 3
        assert decontaminate.decontaminate(empty, items).count() == 0
        assert not any(r["contaminated"] for r in decontaminate.decontaminate(odd, items.limit(0)).collect())


class TestMixing:
    def test_targets_and_caps(self, spark):
        docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
        rows = mixing.copies(docs).collect()
        size, taken, target = Counter(), Counter(), {}
        for r in rows:
            size[r["source"]] += r["size"]
            taken[r["source"]] += r["size"] * r["copies"]
            target[r["source"]] = r["target"]
            assert 0 <= r["copies"] <= 2
        assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
        assert target["a"] == 2 * size["a"]  # capped; the excess goes to the others by weight
        for s in "abc":
            assert taken[s] == pytest.approx(target[s], abs=20)

    def test_mix_emits_copies(self, spark):
        docs = spark.createDataFrame([(i, "w " * 5, "a") for i in range(100)], "doc_id long, text string, source string")
        mixed = mixing.mix(docs)
        assert mixed.count() in range(148, 153) and mixed.columns == ["doc_id", "text", "source", "copy"]
        assert {tuple(r) for r in mixing.mix(docs).collect()} == {tuple(r) for r in mixed.collect()}

    def test_odd_rows(self, odd, empty):
        rows = mixing.copies(clashing(odd)).collect()
        assert len(rows) == len(ODD)
        assert mixing.mix(clashing(odd)).columns[-1] == "_copy"
        assert mixing.copies(empty).count() == 0 and mixing.mix(empty).count() == 0


class TestWarc:
    PAGES = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, "other"), (4, "http://a/\r\n4", None), (5, "u", ""),
             (None, "u", "other"), (6, "u", "WARC/1.1\r\n\r\nx\r\n\r\n"), (7, "u", "z"), (7, "u", "z")]

    def test_round_trip(self, spark):
        pages = spark.createDataFrame(self.PAGES, "page_id long, url string, html string").repartition(3)
        first, second = warc.deduplicate(pages)
        original = {(r["page_id"], r["payload_digest"]): r for r in warc.read_headers(spark, first).collect()}
        rows = warc.read_headers(spark, second).collect()
        assert len(rows) == len(self.PAGES) and Counter(r["record_type"] for r in rows) == {"response": 5, "revisit": 4}
        for page_id, _, html in self.PAGES:
            payload = (html or "").encode()
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert original[page_id, digest]["payload_bytes"] == len(payload)
        assert {r["page_id"]: r["refers_to"] for r in rows if r["record_type"] == "revisit"} == {1: 2, None: 3, 4: 5, 7: 7}

    def test_payloads_come_back(self, spark):
        pages = spark.createDataFrame(self.PAGES, "page_id long, url string, html string").coalesce(1)
        _, second = warc.deduplicate(pages, min_bytes=2)
        found = {}
        for file in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(second).collect():
            for _, _, data in warc.members(bytes(file["content"])):
                fields, _, payload = warc.parse(data)
                found[fields.get("x-page-id")] = (fields["warc-type"], payload)
        assert found["6"] == ("response", b"WARC/1.1\r\n\r\nx\r\n\r\n") and found["1"] == ("revisit", b"")
        assert found["4"] == found["5"] == ("response", b"") and found["7"] == ("response", b"z")

    def test_long_member_ends_with_nul(self):
        assert warc._gzip(b"\0" * (1 << 24))[-1] == 0
        assert [len(d) for _, _, d in warc.members(warc._gzip(b"a" * (1 << 24)) + warc._gzip(b"b"))] == [1 << 24, 1]

    def test_empty(self, spark):
        _, second = warc.deduplicate(spark.createDataFrame([], "page_id long, url string, html string"))
        assert warc.read_headers(spark, second).count() == 0


class TestNgramJoin:
    @staticmethod
    def brute(rows):
        sets = {}
        for i, text in rows:
            w = words(text)
            sets[i] = {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
        parent = {i: i for i in sets}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in sets:
            for j in sets:
                if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
        return {i: (len(sets[i]), find(i)) for i in sets}

    @pytest.mark.parametrize("group_bytes", [1 << 22, 3000])
    def test_like_brute_force(self, spark, group_bytes):
        rnd = random.Random(11)
        rows = [(i, t) for i, t in enumerate([None, "", " ", "a", "A", "a b", "A B c", "a b c d"])]
        for _ in range(6):
            base = [f"w{rnd.randrange(500)}" for _ in range(rnd.choice([6, 40, 150]))]
            for _ in range(15):
                text = list(base)
                for _ in range(rnd.randint(0, 2)):
                    text[rnd.randrange(len(text))] = f"w{rnd.randrange(500)}"
                rows.append((len(rows), " ".join(text)))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(docs, group_bytes=group_bytes).collect()}
        assert got == self.brute(rows)

    def test_trie_links_are_a_spanning_forest(self):
        rnd = random.Random(2)
        base = list(range(0, 400, 2))
        sets = [np.array(sorted({*rnd.sample(base, 190), *rnd.sample(range(1, 400, 2), 3)}), np.uint64) for _ in range(30)]
        links = ngram_join.trie_links(sets)
        assert len(links) <= 29
        parent = list(range(30))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in links:
            assert find(a) != find(b)
            parent[find(a)] = find(b)
        for i in range(30):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    assert find(i) == find(j)

    @pytest.mark.parametrize("unlike", [2, 1])
    def test_hot_bucket_of_sets_apart_is_never_paired(self, spark, monkeypatch, unlike):
        """One text whose last words occur nowhere else: all sets share their buckets, and with two such words none link."""
        rnd, count, bytes_, written = random.Random(5), 150, 3000, {}
        base = [f"w{i}" for i in range(23 - unlike)]
        rows = [(i, " ".join([*base, *(f"x{i}y{k}" for k in range(unlike))])) for i in range(count)]
        rows += [(count + i, " ".join(f"w{rnd.randrange(500)}" for _ in range(30))) for i in range(50)]
        # Two of the hot bucket that link by a long common text behind it, and longer ones that link with neither.
        tail = [f"t{i}" for i in range(60)]
        rows += [(len(rows) + i, " ".join([*base, *tail, *(f"z{i}q{k}" for k in range(i))])) for i in range(4)]
        write = ngram_join.materialize

        def spy(frame, name):
            written.setdefault(name, []).append(write(frame, name))
            return written[name][-1]

        monkeypatch.setattr(ngram_join, "materialize", spy)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(docs, group_bytes=bytes_).collect()}
        assert got == self.brute(rows)
        assert "cells-apart" in written  # the group was dealt
        for name, frames in written.items():
            assert sum(f.count() for f in frames) < 30 * len(rows), name
        sizes = written["ordered-sets"][0].select("node", (F.length("tokens")).alias("b"))
        for name in ("tree-rows", "block-rows"):
            for frame in written.get(name, []):
                largest = frame.join(sizes, "node").groupBy("center", "part").agg(F.sum("b").alias("b")).agg(F.max("b")).first()[0]
                assert (largest or 0) < 2 * bytes_

    def test_sets_apart_are_not_walked(self, monkeypatch):
        """Sets that share too little are never compared token by token, however many a tree holds."""
        rnd, calls, search = random.Random(8), [], np.searchsorted
        sets = [np.array(sorted(rnd.sample(range(3000), 20)), np.uint64) for _ in range(300)]
        sets += [np.array(sorted({*range(5000, 5050), 6000 + i}), np.uint64) for i in range(12)]
        monkeypatch.setattr(np, "searchsorted", lambda *a, **k: (calls.append(1), search(*a, **k))[1])
        assert len(ngram_join.trie_links(sets)) == 11
        assert len(calls) < len(sets)

    def test_sets_apart_in_many_buckets_meet_once(self, spark, monkeypatch):
        """Texts of many common passages in other choices share most of their buckets and are sent once, not once per bucket."""
        rnd, written, bytes_ = random.Random(4), {}, 400_000
        passages = [[" ".join(f"p{k}o{o}w{i}" for i in range(6)) for o in range(2)] for k in range(100)]
        rows = [(i, " ".join(rnd.choice(options) for options in passages)) for i in range(120)]
        rows.append((len(rows), rows[7][1] + " end"))
        write = ngram_join.materialize

        def spy(frame, name):
            written[name] = write(frame, name)
            return written[name]

        monkeypatch.setattr(ngram_join, "materialize", spy)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(docs, group_bytes=bytes_).collect()}
        assert got == self.brute(rows)
        sent = written["block-rows"].agg(F.sum("n")).first()[0]
        assert sent < 50 * sum(n for n, _ in got.values())

    def test_blocks_hold_every_pair_apart(self, spark):
        rnd = random.Random(6)
        rows = [(c, 100 * c + i, 20, rnd.randrange(4), False) for c in range(3) for i in range(60)]
        rows = [(c, i, n, k, k > 0) for c, i, n, k, _ in rows]
        cells = spark.createDataFrame(rows, "center long, node long, n long, known long, other boolean")
        blocks, total = ngram_join._blocks(cells, 3000)
        held, found = defaultdict(set), blocks.collect()
        for r in found:
            held[r["center"], r["part"]].add(r["node"])
        assert total == 160 * len(found) and max(map(len, held.values())) * 160 < 2 * 3000
        pairs = {frozenset((x[1], y[1])) for x in rows for y in rows if x[0] == y[0] and x[3] != y[3]}
        assert all(any(pair <= block for block in held.values()) for pair in pairs)

    def test_components(self, spark):
        links = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (12, 11), (7, 7), (20, 9), (9, 20)]
        got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 9: 9, 20: 9}

    def test_odd_rows(self, odd, empty):
        rows = ngram_join.classes(clashing(odd).drop("id", "hash")).collect()
        assert len(rows) == len(ODD)
        assert {r["component_id"] for r in rows if r["n_shingles"] == 1 and r["id"] in (4, None)} == {4}
        assert ngram_join.classes(empty).count() == 0 and ngram_join.dedup(empty).count() == 0
        kept = ngram_join.dedup(odd)
        assert kept.columns == odd.columns and kept.where("text = 'A b c'").count() == 2  # the repeated row of id 4


class TestQualityRules:
    def test_repeated_words(self, spark):
        rnd = random.Random(9)
        rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60)))) for i in range(40)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
        got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.rule_figures(docs).collect()}
        for i, text in rows:
            w = text.split()
            at = defaultdict(list)
            for k in range(len(w) - 4):
                at[tuple(w[k:k + 5])].append(k)
            assert got[i] == len({p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 5)})

    def test_bad_host_is_rejected(self, spark):
        good = " ".join(f"word{i}" for i in range(20))
        rows = [(i, good if i % 10 else "x", "good") for i in range(400)] + [(1000 + i, good if i % 10 == 0 else "x", "bad") for i in range(400)]
        rows += [(2000, good, None), (2001, good, "new")]
        kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
        assert kept[1] and not kept[0] and not kept[1000] and kept[2000] and kept[2001]

    def test_odd_rows(self, odd, empty):
        rows = quality_rules.judge(clashing(odd)).collect()
        assert len(rows) == len(ODD) and not any(r["kept"] for r in rows)
        assert quality_rules.judge(empty).count() == 0


class TestTokenCounts:
    def test_automaton_like_greedy(self):
        rnd = random.Random(3)
        for _ in range(150):
            pieces = {bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 9))}
            pieces |= {p + b"\xff" for p in list(pieces) if rnd.random() < 0.4}
            automaton = token_counts.Automaton(pieces)
            for _ in range(40):
                word = bytes(rnd.choice(b"abcd") for _ in range(rnd.randint(0, 12)))
                assert automaton.count(word) == token_counts.greedy(pieces, word)

    def test_odd_rows(self, odd, empty):
        pieces = [bytes([b]) for b in range(256)] + [bytes([b, 255]) for b in range(255)]
        rows = {r["id"]: r for r in token_counts.count_tokens(clashing(odd).drop("id"), pieces).collect()}
        assert rows[1]["n_pieces"] == rows[2]["n_pieces"] == 0 and rows[4]["n_pieces"] == 3
        assert rows[5]["n_pieces"] == len(LONG.replace(" ", "")) and rows[5]["n_unknown"] == 0
        assert token_counts.count_tokens(empty, pieces).count() == 0


class TestLicenseScan:
    def test_verified_matches(self, spark):
        templates = spark.createDataFrame(license_scan.TEMPLATES, "template_id string, text string")
        filler = " ".join(f"word{i}" for i in range(37))
        docs = spark.createDataFrame([
            (1, f"{filler} Licensed under the APACHE License, version 2.0. {filler}"), (2, "released under the mit license"),
            (3, "released under the bsd license"), (4, filler),
            (5, f"{filler} Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions hold")], "doc_id long, text string")
        found, _ = license_scan.scan(docs, templates)
        assert {(r["id"], r["template_id"]) for r in found.collect()} == {(1, "apache-2.0"), (2, "mit"), (5, "bsd-3-clause")}

    def test_bands_find_short_and_long_templates(self, spark):
        """Random templates of 1 to 40 shingles, whole and with a fifth of their shingles gone."""
        rnd = random.Random(12)
        word = lambda: f"t{rnd.randrange(10**9)}"
        templates, docs, changed = [], [], set()
        for k, size in enumerate([1, 2, 3, 4, 5, 8, 12, 16, 25, 40] * 30):
            words = [word() for _ in range(size + 4)]
            templates.append((f"t{k}", " ".join(words)))
            if size >= 25 and k % 2:  # one word in the middle breaks five shingles
                words[size // 2] = word()
                changed.add(k)
            docs.append((k, " ".join([word() for _ in range(rnd.randrange(60))] + words + [word() for _ in range(rnd.randrange(60))])))
        found, _ = license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                     spark.createDataFrame(templates, "template_id string, text string"))
        got = {(r["id"], r["template_id"]) for r in found.select("id", "template_id").distinct().collect()}
        assert got == {(k, f"t{k}") for k, _ in docs} and changed

    def test_odd_rows(self, spark, odd, empty):
        templates = spark.createDataFrame([("a", "a b c"), (None, None), ("l", "amet consectetur adipiscing elit sed do")],
                                          "template_id string, text string")
        found, keyed = license_scan.scan(clashing(odd), templates)
        assert {r["id"] for r in found.collect()} == {5} and keyed.count() == len(ODD)
        assert license_scan.scan(empty, templates)[0].count() == 0
        assert license_scan.scan(odd, templates.limit(0))[0].count() == 0


class TestLanguageId:
    def test_gradient(self):
        rnd = np.random.default_rng(1)
        w = {k: v.astype("f8") for k, v in language_id.start_weights(3, hidden=3).items()}
        steps, live = rnd.integers(0, 4, (6, 5)), (rnd.random((6, 5)) > 0.2).astype("f8")
        labels = rnd.integers(0, 3, 5)
        _, grad = language_id.gradients(w, steps, live, labels)
        for name, place in [("x", (0, 1, 2)), ("x", (1, 2, 7)), ("h", (0, 1, 4)), ("h", (1, 2, 8)), ("b", (0, 1)), ("o", (4, 1)), ("ob", (2,))]:
            both = []
            for sign in (1, -1):
                w[name][place] += sign * 1e-2
                both.append(language_id.gradients(w, steps, live, labels)[0])
                w[name][place] -= sign * 1e-2
            assert grad[name][place] == pytest.approx((both[0] - both[1]) / 2e-2, rel=0.05, abs=2e-4)

    def test_forward_pass_like_plain_python(self):
        """Position by position, window by window, with windows of different lengths."""
        rnd = np.random.default_rng(2)
        w = {k: v.astype("f8") for k, v in language_id.start_weights(3, hidden=4).items()}
        w["b"] += rnd.standard_normal(w["b"].shape)
        texts = [bytes(rnd.integers(0, 256, n).astype(np.uint8)) for n in (1, 3, 7)]
        steps, live, owner = language_id.windows_of(texts, 7)
        got = language_id.label_positions(w, steps, live)
        sigma = lambda x: 1 / (1 + np.exp(-x))

        def states(side, data):
            state, out = np.zeros(4), []
            for byte in data:
                x, inner = w["x"][side][byte], state @ w["h"][side]
                z, r = sigma(x[:4] + inner[:4]), sigma(x[4:8] + inner[4:8])
                state = (1 - z) * state + z * np.tanh(x[8:] + r * (inner[8:] + w["b"][side]))
                out.append(state)
            return out

        for i, text in enumerate(texts):
            both = [np.concatenate(pair) for pair in zip(states(0, text), states(1, text[::-1])[::-1], strict=True)]
            for t, state in enumerate(both):
                scores = np.exp(state @ w["o"] + w["ob"])
                assert got[t, list(owner).index(i)] == pytest.approx(scores / scores.sum(), abs=1e-5)

    def test_no_label_is_lost(self, spark, monkeypatch):
        """Copies count once, and rare labels get as many texts as frequent ones."""
        seen = {}
        monkeypatch.setattr(language_id, "train", lambda texts, labels: seen.update(texts=texts, labels=Counter(labels)))
        copies = [(i, "the same english text", "en") for i in range(3000)] + [(9000 + i, f"ein deutscher text {i}", "de") for i in range(3000)]
        language_id.fit(spark.createDataFrame(copies, "doc_id long, text string, lang string").repartition(4), limit=100)
        assert seen["labels"] == {"en": 1, "de": 50}
        rare = [(i, f"some text {i}", "en") for i in range(4000)] + [(9000 + i, f"un texte {i}", "fr") for i in range(8)]
        language_id.fit(spark.createDataFrame(rare, "doc_id long, text string, lang string").repartition(4), limit=100)
        assert seen["labels"] == {"en": 50, "fr": 8}
        many = [(i, f"text {i}", f"l{i % 40}") for i in range(4000)]
        language_id.fit(spark.createDataFrame(many, "doc_id long, text string, lang string"), limit=100)
        assert set(seen["labels"].values()) == {language_id.LEAST_PER_LABEL} and len(seen["labels"]) == 40

    def test_windows_come_from_whole_texts(self, spark, monkeypatch):
        seen = {}
        monkeypatch.setattr(language_id, "train", lambda texts, labels: seen.update(texts=texts))
        text = "".join(f"{i:05d}a" for i in range(4000))
        language_id.fit(spark.createDataFrame([(1, text, "en"), (2, "short", "en")], "doc_id long, text string, lang string"))
        places = sorted(text.index(t.decode()) for t in seen["texts"] if t != b"short")
        assert places == [0, 6000, 12000, 18000] and all(len(t) == language_id.WINDOW for t in seen["texts"] if t != b"short")

    def test_held_out_accuracy(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        model = language_id.fit(docs, usable=language_id.fold() != language_id.HELD_OUT)
        held = language_id.predict(docs.where(language_id.fold() == language_id.HELD_OUT), model)
        rows = held.select("row.lang", "lang_pred").collect()
        assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)

    def test_odd_rows(self, odd, empty):
        model = language_id.train([b"the one and", b"der die das"], ["en", "de"], epochs=1)
        rows = language_id.predict(clashing(odd), model).collect()
        assert len(rows) == len(ODD)
        assert all((r["lang_pred"] == "und") == (not re.search("[a-zA-Z]", r["row"]["text"] or "")) for r in rows)
        assert language_id.fit(empty) is None and language_id.predict(empty, model).count() == 0
        assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}
