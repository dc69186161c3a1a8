"""Source divergence, collocations and MinHash near-duplicates against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import DOC, ODD, clashing

from tidegauge.llm import collocations, divergence, minhash_dedup


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rnd: random.Random, words: int, vocabulary: list[str], marks: str = " ") -> str:
    return "".join(min(rnd.choice(vocabulary), rnd.choice(vocabulary)) + rnd.choice(marks) for _ in range(words))


class TestDivergence:
    @staticmethod
    def brute(rows, min_docs, top):
        counts, docs, groups = defaultdict(Counter), defaultdict(Counter), {(r[2] or "", r[3] or "") for r in rows}
        for _, text, lang, source, _ in rows:
            terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
            counts[lang or "", source or ""].update(terms)
            docs[lang or ""].update(set(terms))
        out = set()
        for lang in {g[0] for g in groups}:
            kept = [t for t, n in docs[lang].items() if n >= min_docs]
            mine = {s: counts[lang, s] for at, s in groups if at == lang}

            def rates(count):
                total = sum(count[t] for t in kept) + 2 * len(kept)
                return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

            of, whole = {s: rates(c) for s, c in mine.items()}, rates(sum(mine.values(), Counter()))
            gap = lambda p, q: (p - q) ** 2 // (p + q)
            for s, p in of.items():
                pairs = [(-sum(gap(p[t], q[t]) for t in kept), o.encode(), o) for o, q in of.items() if o != s]
                terms = [(-gap(p[t], whole[t]), t.encode(), t) for t in kept if mine[s][t] and p[t] > whole[t]]
                for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                    out |= {(lang, s, part, item, -value, i) for i, (value, _, item) in enumerate(items, 1)}
        return out

    @pytest.mark.parametrize(("sources", "words"), [(3, 60), (40, 200)])
    def test_like_brute_force(self, spark, monkeypatch, sources, words):
        monkeypatch.setattr(divergence, "BUNDLE", 70)  # several bundles, of more columns than a block
        monkeypatch.setattr(divergence, "FLUSH_WORDS", 500)
        rnd = random.Random(sources)
        vocabulary = sorted(("É" if i % 7 == 0 else "") + "".join(rnd.choice("abXY") for _ in range(rnd.randint(1, 5))) for i in range(words))
        rows = [(i, prose(rnd, rnd.randint(0, 40), vocabulary[(i % sources) % 5:], " .7"), rnd.choice(["en", "de"]), f"s{i % sources}", 0)
                for i in range(8 * sources)]
        rows += [*ODD, (90, None, "xx", "a", 0), (91, "alone", "xx", "b", 0), rows[3]]
        docs = spark.createDataFrame(rows, DOC).repartition(3)
        got = divergence.audit(docs, min_docs=3, top=4)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == sorted(self.brute(rows, 3, 4))

    def test_blocks_of_rows(self, monkeypatch):
        """Two blocks of sources against each other, and one with itself, with empty squares of every size."""
        rnd = np.random.default_rng(5)
        rates, counted = np.ones((512, 512), np.int64), np.zeros((512, 512), bool)
        base = rnd.integers(1, 10**6, 512)
        rates[:, :300] = base[:, None]
        for r, c in zip(rnd.integers(0, 512, 200), rnd.integers(0, 300, 200), strict=True):
            rates[r, c], counted[r, c] = rnd.integers(1, 10**9), True
        sums, reached = divergence.pair_sums(rates, counted, 300, True)
        left = (base[:, None] - base[None, :]) ** 2 // (base[:, None] + base[None, :])
        for x, y in zip(rnd.integers(0, 256, 300), rnd.integers(256, 512, 300), strict=True):
            p, q = rates[x, :300], rates[y, :300]
            assert sums[x, y] + (300 - reached[x, y]) * left[x, y] == ((p - q) ** 2 // (p + q)).sum()
        assert reached.max() < 300 and sums[:256, :256].max() == 0

    def test_rates_beyond_64_bits(self, spark):
        rows = [(3 * 10**18, 4 * 10**18, 7), (0, 0, 0), (0, 5, 1)]
        got = [r[0] for r in spark.createDataFrame(rows, "n long, t long, v long").select(
            divergence.rate(F.col("n"), F.col("t"), F.col("v"))).collect()]
        assert got == [1 + 10**9 * (3 * 10**18 + 2) // (4 * 10**18 + 14), 1 + 2 * 10**9, 1 + 2 * 10**9 // 7]

    def test_odd_rows(self, spark):
        docs = spark.createDataFrame(ODD, DOC)
        rows = divergence.audit(clashing(docs).withColumns({"part": F.lit(1), "item": F.lit(1), "v": F.lit(1)}), min_docs=1).collect()
        assert {(r["lang"], r["source"], r["item"]) for r in rows if r["part"] == "pair"} >= {("en", "a", "b"), ("en", "b", "a"), ("en", "", "a")}
        assert divergence.audit(docs.limit(0)).count() == 0


class TestCollocations:
    @staticmethod
    def brute(rows, least, top):
        counts = defaultdict(Counter)
        for _, text, lang, _, _ in rows:
            for piece in re.split(r"[.,;:!?\n-\r]", lower(text)):
                w = re.findall(r"[^ \t]+", piece)
                for size in range(1, 5):
                    counts[lang or "und", size].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
        out = []
        for lang in {key[0] for key in counts}:
            f = {p: n for size in range(1, 5) for p, n in counts[lang, size].items()}
            often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
            found = []
            for p, a in often.items():
                longer = [n for q, n in often.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
                if not any(100 * n >= 80 * a for n in longer):
                    score, _, l, r = min((int(Fraction(2000000 * a, f[p[:k]] + f[p[k:]])), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
                    found.append((-score, -a, " ".join(p).encode(), " ".join(p), a, l, r, score))
            total = sum(counts[lang, 1].values())
            out += [(lang, i, p, a, l, r, total, score) for i, (_, _, _, p, a, l, r, score) in enumerate(sorted(found)[:top], 1)]  # noqa: E741
        return sorted(out)

    @pytest.mark.parametrize("block", [40, 1 << 22])
    def test_like_brute_force(self, spark, monkeypatch, block):
        monkeypatch.setattr(collocations, "BLOCK_WORDS", block)
        monkeypatch.setattr(collocations, "BUCKET_PAIRS", 100)
        rnd = random.Random(11)
        vocabulary = ["A", "b", "C-3", "é", "\x1c", "dd", "e"]
        rows = [(i, prose(rnd, rnd.randint(0, 40), vocabulary, " \t ., !\n\r  "), rnd.choice(["en", "de", None]), "s", 0) for i in range(120)]
        rows += [*ODD[:4], rows[5], rows[5]]
        docs = spark.createDataFrame(rows, DOC).repartition(3)
        got = collocations.mine(docs, least=4, top=50)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = self.brute(rows, 4, 50)
        assert sorted(map(tuple, got.collect())) == want and any(len(r[2].split(" ")) == 4 for r in want)

    @pytest.mark.parametrize("filled", [0.0, 0.05, 9.0])
    def test_tiles(self, filled):
        """All tiles dense, some, none: the same counts; ranks far apart, gaps."""
        rnd = np.random.default_rng(2)
        ids = rnd.zipf(1.3, 5000) % 90 * 10**11 + rnd.integers(0, 2, 5000)
        ids[rnd.random(5000) < 0.1] = -1
        want = Counter((int(a), int(b)) for a, b in zip(ids[:-1], ids[1:], strict=True) if a >= 0 and b >= 0)
        x, y, n = collocations.pair_counts(ids, tile=16, filled=filled)
        assert {(int(a), int(b)): int(c) for a, b, c in zip(x, y, n, strict=True)} == want and len(n) == len(want)
        for none in ([], [-1, -1], [3], [3, -1, 4]):
            assert not len(collocations.pair_counts(np.array(none, np.int64))[0])

    def test_scores_beyond_64_bits(self, spark):
        a, left, right = 5 * 10**18, 6 * 10**18, 7 * 10**18
        row = spark.createDataFrame([("en", 0, a, "x y", [left], [right])], "lang string, id long, a long, phrase string, begins array<long>, ends array<long>")
        assert collocations._scored(row, 2, None).first()["score"] == 2_000_000 * a // (left + right)

    def test_odd_rows(self, spark):
        docs = spark.createDataFrame(ODD, DOC)
        rows = collocations.mine(clashing(docs).withColumns({"block": F.lit(1), "phrase": F.lit(1), "data": F.lit(1)}), least=2).collect()
        assert {r["phrase"] for r in rows if r["lang"] == "en"} >= {"a b c"} and all(r["a"] >= 2 for r in rows)
        assert collocations.mine(docs.limit(0)).count() == 0 and collocations.mine(docs, least=10**6).count() == 0


class TestMinhashDedup:
    @staticmethod
    def brute(rows, percent=85):
        sets = {}
        for i, text in rows:
            w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
            sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        label = {i: i for i in sets}
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                    low, high = sorted((label[a], label[b]))
                    label = {i: low if x == high else x for i, x in label.items()}
        return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}

    @staticmethod
    def families(rnd: random.Random, families: int, copies: int, start: int = 0):
        rows = []
        for _ in range(families):
            words = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.choice([3, 30, 90, 150]))]
            for _ in range(copies):
                changed = [w if rnd.random() > rnd.choice([0, 0.01, 0.02, 0.04]) else "other" for w in words]
                rows.append((start + len(rows), " ".join(changed)))
        rnd.shuffle(rows)
        return rows

    @pytest.mark.parametrize("group_bytes", [1 << 22, 2000])
    def test_like_brute_force(self, spark, group_bytes):
        rnd = random.Random(3)
        rows = self.families(rnd, 12, 25) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "A b"), (1004, "a B"), (1005, "a b c")]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.classes(docs, group_bytes=group_bytes).collect()}
        assert got == self.brute(rows)

    def test_groups_apart_meet_in_bounded_blocks(self, spark, monkeypatch):
        """Many texts around one passage, few of them linked: the group is dealt, no pairs are written."""
        rnd, written, write = random.Random(8), {}, minhash_dedup.materialize
        passage = [f"p{i}" for i in range(40)]
        rows = [(i, " ".join(passage + [f"x{i // 3}y{k}" for k in range(rnd.choice([2, 5]))])) for i in range(150)]

        def spy(frame, name):
            written[name] = write(frame, name)
            return written[name]

        monkeypatch.setattr(minhash_dedup, "materialize", spy)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.classes(docs, percent=95, group_bytes=4000).collect()}
        assert got == self.brute(rows, 95)
        blocks = written["minhash-blocks"]
        assert blocks.groupBy("center", "part").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] * 8 < 2 * 4000
        for name, frame in written.items():
            assert frame.count() < 60 * len(rows), name

    @pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 20, 40, 400])
    def test_no_similar_pair_is_lost(self, size):
        """Random sets at the least similarity allowed share a band, and their signatures are never ruled out."""
        rnd, lost = np.random.default_rng(size), 0
        limits = minhash_dedup.least_matches(85)
        for _ in range(150):
            common = -(-85 * size // 100)
            grams = rnd.integers(0, 1 << 63, 2 * size, np.uint64) * np.uint64(2) + np.uint64(1)
            extra = size - common
            a, b = grams[:common + extra], grams[:common]  # similarity of at least 0.85
            sa, sb = minhash_dedup.signature(a), minhash_dedup.signature(b)
            shared = (minhash_dedup.band_keys(sa) == minhash_dedup.band_keys(sb)).any()
            matches = np.cumsum((sa == sb).reshape(-1, minhash_dedup.BATCH).sum(1))
            lost += not shared or bool((matches < limits).any())
        assert lost == 0

    def test_signatures_estimate_similarity(self):
        rnd = np.random.default_rng(1)
        shares = []
        for _ in range(200):
            grams = rnd.integers(0, 1 << 63, 300, np.uint64) * np.uint64(2)
            shares.append((minhash_dedup.signature(grams[:200]) == minhash_dedup.signature(grams[100:])).mean())
        assert abs(np.mean(shares) - 1 / 3) < 0.01
        assert 0.6 < np.std(shares) / np.sqrt(2 / 9 / minhash_dedup.HASHES) < 1.5  # as independent hashes would

    def test_posterior_limits(self):
        """The limit is the fewest matches whose posterior reaches the miss probability, by numeric integration."""
        s = np.linspace(0, 1, 200_001)[1:-1]
        for seen, limit in zip(range(32, 161, 32), minhash_dedup.least_matches(80, 1e-4), strict=True):
            def posterior(k, seen=seen):
                weight = np.exp(k * np.log(s) + (seen - k) * np.log1p(-s))
                return weight[s >= 0.8].sum() / weight.sum()

            assert posterior(limit) >= 1e-4 > posterior(limit - 1)

    def test_odd_rows(self, spark):
        docs = spark.createDataFrame(ODD, DOC)
        rows = minhash_dedup.classes(clashing(docs)).collect()
        assert len(rows) == len(ODD)
        assert {(r["component_id"], r["kept"]) for r in rows if r["n_shingles"] == 1 and r["id"] == 4} == {(4, True)}
        assert [(r["component_id"], r["kept"]) for r in rows if r["n_shingles"] == 1 and r["id"] is None] == [(4, False)]
        assert minhash_dedup.classes(docs.limit(0)).count() == 0
