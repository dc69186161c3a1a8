"""Stages of the pipeline against plain Python."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text: str, size: int = 5) -> set[tuple]:
    w = text.lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def copies_left(rows: list[tuple]) -> list[tuple]:
    """Of each class of texts that share 80 % of their shingles, the row of the smallest id."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label = [label[j] if x == label[i] else x for x in label]
    return [min(r for r, x in zip(rows, label, strict=True) if x == k) for k in set(label)]


class TestNearCopies:
    def test_five_words_at_eighty_percent(self, spark):
        rnd, rows = random.Random(4), []
        for case, replaced in enumerate([0, 4, 5, 6, 7, 8] * 3):  # six words make 86/106, seven 85/107
            words = [f"w{case}x{i}" for i in range(100)]
            other = [f"o{case}x{i}" if 50 <= i < 50 + replaced else w for i, w in enumerate(words)]
            rows += [(2 * case, " ".join(words)), (2 * case + 1, " ".join(other))]
        rnd.shuffle(rows)
        docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOC).repartition(3)
        got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
        want = copies_left(rows)
        assert sorted(got) == sorted(want) and len(want) == 18 + 6

    def test_null_and_repeated_ids(self, spark):
        text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
        rows = [(None, text(0)), (None, text(1)), (None, text(2)), (7, text(3)), (7, text(4)), (8, text(4)),
                (None, text(5)), (9, text(5)), (None, text(6)), (None, text(6) + " more"), (None, "\n"), (None, "\t\n"), (None, "\t\n")]
        docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOC).repartition(3)
        got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
        sure = [*rows[:5], rows[7], *rows[10:]]  # a row without words is near no other
        either = [row for row in got if row not in sure]
        assert sorted((r for r in got if r in sure), key=str) == sorted(sure, key=str)
        assert len(either) == 1 and either[0] in rows[8:10]


class TestLanguage:
    def test_limit_follows_the_number_of_languages(self):
        limits = [corpus_pipeline.least_score(k) for k in (1, 2, 4, 100)]
        assert limits == pytest.approx([0.0, 0.6, 0.4, 0.208])
        assert all(1 / k < corpus_pipeline.least_score(k) < 1 for k in range(2, 2000))

    def test_without_labels_documents_pass_unjudged(self, spark, tmp_path):
        rows = [(1, "some text", None, "a", 9), (2, "1 2 3", None, "a", 5), (3, None, None, "a", None), (None, "ein Text", None, "b", 8)]
        docs = spark.createDataFrame(rows, DOC)
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        kept = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and {r["text"] for r in kept.collect()} == {"some text", "ein Text"}


def lines_left(rows: list[tuple]) -> dict[int, str | None]:
    """Texts by id without the lines of three-line windows that occurred before, blank lines kept."""
    seen, left = set(), {}
    for doc_id, text in sorted(rows):
        lines = (text or "").split("\n")
        filled = [i for i, line in enumerate(lines) if line.strip()]
        gone = set()
        for a in range(len(filled) - 2):
            window = tuple(lines[i] for i in filled[a:a + 3])
            if window in seen:
                gone.update(filled[a:a + 3])
            seen.add(window)
        left[doc_id] = text if not gone else "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return left


def extra(docs: DataFrame) -> DataFrame:
    """Further columns with names that the stages use inside."""
    return docs.withColumns({name: F.lit("x") for name in ("row", "id", "hash", "words", "number", "copies", "win", "at", "label")})


def write_tables(spark, folder, docs: list[tuple], items: list[tuple]) -> DataFrame:
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(docs, DOC).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


class TestOtherStages:
    def test_lines_like_plain_python(self, spark):
        rnd, rows = random.Random(7), []
        for i in range(60):
            rows.append((i, "\n".join(rnd.choice(["a", "b", "c", " ", "", "d e"]) for _ in range(rnd.randint(0, 25)))))
        rows += [(100, None), (101, "a\nb\nc\n" * 4000), (102, "\n".join(f"line {i}" for i in range(3000)))]
        docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOC)
        cut = corpus_pipeline.dedup_lines(spark, extra(docs), "")
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
        assert cut.columns == extra(docs).columns
        assert got == {i: (t, None if t is None else len(t)) for i, t in lines_left(rows).items()}

    def test_contaminated_documents_go(self, spark, tmp_path):
        passage = " ".join(f"Q{i}" for i in range(12))
        texts = {1: f"start {passage.lower()}, end", 2: " ".join(passage.split()[:9]), 3: "w " * 20_000 + passage, 4: None,
                 5: "", 6: "Short, item?", 7: "no name here"}
        rows = [(i, t, "en", "s", 0) for i, t in texts.items()] * 2
        write_tables(spark, tmp_path, rows, [("a", passage), ("a", passage), ("b", "short item"), (None, "NO name"), ("c", None), ("d", "-")])
        docs = extra(spark.createDataFrame(rows, DOC).repartition(3))
        kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 2, 4, 4, 5, 5]

    def test_mix_with_one_row_for_a_third(self, spark):
        rows = [(None, "same words here", "en", "a", 15)] * 1000
        rows += [(i, "w " * (i % 9 + 1), "en", "ab"[i % 2], 0) for i in range(2000)] + [(9000, None, "en", None, 0)]
        docs = extra(spark.createDataFrame(rows, DOC).repartition(5))
        mixed = corpus_pipeline.mix_sources(spark, docs, "")
        assert mixed.columns == [*docs.columns, "copy"]
        got, sizes, taken = mixed.collect(), {}, {}
        for r in rows:
            sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
        for r in got:
            taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
        total = 1.5 * (sizes["a"] + sizes["b"])
        target_a = min(2 * sizes["a"], total * 3 / 4)  # sources "a", "b" and null weigh 3, 1 and 2; null has no words
        assert taken["a"] == pytest.approx(max(target_a, total - 2 * sizes["b"]), rel=0.01)
        assert sum(taken.values()) == pytest.approx(total, rel=0.01)
        assert max(r["copy"] for r in got) <= 2
        hot = sum(r["doc_id"] is None for r in got)
        assert hot == pytest.approx(1000 * taken["a"] / sizes["a"], abs=2)

    @pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[1:])
    def test_empty_table(self, spark, tmp_path, name, stage):
        docs = write_tables(spark, tmp_path, [], [("a", "some item")])
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns + (["copy"] if name == "mixing" else []) and out.count() == 0


def test_run_like_plain_python(spark, tmp_path):
    """All stages, without labels: stage by stage in plain Python, up to which copies the mix draws."""
    rnd, rows = random.Random(11), []
    vocabulary = [f"word{i}" for i in range(3000)]
    block = "\n".join(" ".join(rnd.sample(vocabulary, 8)) for _ in range(3))
    passage = " ".join(rnd.sample(vocabulary, 14))
    for i in range(40):
        lines = [" ".join(rnd.sample(vocabulary, 8)) for _ in range(6)]
        if i % 7 == 0:
            lines.insert(2, block)
        if i % 10 == 3:
            lines.append(passage)
        rows.append((i, "\n".join(lines), None, "xyz"[i % 3], 0))
    rows += [(100 + i, rows[i][1].replace("\n", " ") + " more", None, "x", 0) for i in range(0, 40, 5)] + [(200, None, None, "x", 0), (201, "1 2 3", None, None, 0)]
    rows += [(202, "", None, "x", 0), (203, block, None, "y", 0)]
    write_tables(spark, tmp_path, rows, [("p", passage), ("n", None)])
    lettered = [(r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or "")]
    left = [(i, t) for i, t in lines_left(lettered).items() if t.strip()]
    single = copies_left(left)
    kept = {i: t for i, t in single if passage not in t.replace("\n", " ")}
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in mixed} <= set(kept) and len(kept) < len(single) < len(left)
    assert all(r["text"] == kept[r["doc_id"]] for r in mixed)
    source = {r[0]: r[3] for r in rows}
    size = sum(len(t.split()) for t in kept.values())
    taken = sum(len(r["text"].split()) for r in mixed)
    assert taken == pytest.approx(1.5 * size, rel=0.1) and {source[i] for i in kept} == {"x", "y", "z"}
