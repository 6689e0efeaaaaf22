"""The pipeline on the smallest table, stage by stage."""

from collections import Counter

import os

import corpus_pipeline
import pytest
from strataframe.llm import jaccard, quality
from strataframe.llm.common import scratch, staged, table
from strataframe.session import shared_dir


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), "test-stage")
        seen[name] = (before, docs)
    assert list(seen) == ["quality rules", "n-gram Jaccard join", "secret scans", "mixing sources", "byte-level BPE"]
    before, after = seen["quality rules"]
    kept = [r.doc_id for r in quality.quality_rules(before, "doc_id").filter("kept").collect()]
    assert Counter(kept) == Counter(r.doc_id for r in after.collect())
    before, after = seen["n-gram Jaccard join"]
    groups = {r.component_id for r in jaccard.jaccard_components(before).collect()}
    assert {r.doc_id for r in after.collect()} == groups
    before, after = seen["secret scans"]
    assert before.count() == after.count() and not [r for r in after.collect() if 'token = "0' in r.text.lower()]
    before, after = seen["mixing sources"]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()} and after.columns == before.columns
    before, after = seen["byte-level BPE"]
    assert before.count() == after.count() and after.filter("n_tokens = 0").count() == 0


def test_near_duplicates_from_four_fifths_of_five_words(spark):
    base = " ".join(f"w{k}" for k in range(204))
    rows = [(1, base), (2, base + " " + " ".join(f"n{k}" for k in range(46))), (3, base + " " + " ".join(f"m{k}" for k in range(70)))]  # 200 of 246 and of 270
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert {r.doc_id for r in left.collect()} == {1, 3}


DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, id int, cuts string, content string"


def odd_rows():
    """Null in every column, empty, blank and very long texts, ties, repeated rows; extra columns that clash."""
    words = [f"word{i} lies in sentence {i * 7 % 90}" for i in range(60)]
    texts = [" ".join(words[k:] + words[:k]) for k in range(0, 40, 4)]
    rows = [(i, t, ["en", "de"][i % 2], ["web", None][i % 2], len(t)) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (1, texts[2], "en", "web", 9), (None, texts[3], "en", "web", None), (None, texts[3], "en", "web", None), (20, texts[4], None, None, None)]
    rows += [(21, None, "en", "web", None), (22, "", None, "b", 0), (23, " \n ", "en", "web", 3), (24, None, None, None, None), (None, None, None, None, None)]
    rows += [(25, " ".join(words) + ' api_key = "Zx8Kq2Lm9Pv4Rt7Wy1Nc5Bd3" ' + "tail of it " * 3, "en", "web", 1), (26, " ".join(f"x{i % 991}y{i}" for i in range(20_000)), "en", "long", 1)]
    return [(*r, "k", 5, "c", "d") for r in rows]


@pytest.mark.parametrize("place", range(5))
def test_stages_take_odd_rows(spark, place):
    name, stage = corpus_pipeline.STAGES[place]
    docs = spark.createDataFrame(odd_rows(), DOCS)
    out = stage(spark, docs, "")
    found = Counter((r.doc_id, r.text) for r in out.collect()) if "text" in out.columns else None
    given = Counter((r[0], r[1]) for r in odd_rows())
    assert stage(spark, docs.limit(0), "").count() == 0
    if found is not None:
        assert out.columns == corpus_pipeline.COLUMNS
    if name == "quality rules":
        assert found and all(given[k] == n for k, n in found.items()) and not any(k[1] is None or not k[1].strip() for k in found)
    elif name == "n-gram Jaccard join":
        assert found[1, odd_rows()[1][1]] <= 1 and sum(n for k, n in found.items() if k[0] is None) == 3
        assert {21, 22, 23, 24, 26} <= {k[0] for k in found}
    elif name == "secret scans":
        same = {k: n for k, n in given.items() if k[0] != 25}
        assert {k: n for k, n in found.items() if k[0] != 25} == same
        assert [k for k in found if k[0] == 25 and "[SECRET]" in k[1] and "Zx8Kq2Lm9Pv4Rt7Wy1Nc5Bd3" not in k[1]]
    elif name == "mixing sources":
        assert found and not any(k[1] is None or not k[1].strip() for k in found)
    else:
        assert out.count() == len(odd_rows()) and out.filter("doc_id in (21, 22, 24) and n_tokens > 0").isEmpty()


def folders(spark):
    return {f for f in os.listdir(shared_dir(spark).removeprefix("file://")) if "-" in f and not f.startswith("rdd")}


def test_a_run_leaves_one_table_and_a_failure_none(spark, monkeypatch):
    before = folders(spark)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[4]])
    corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    left = folders(spark) - before
    assert len([f for f in left if f.startswith("byte-level-BPE")]) == 1 == len([f for f in left if not f.count("-") == 4])
    before = folders(spark)

    def broken(spark, docs, sf_dir):
        staged(docs, "inner-table")
        raise RuntimeError("gone")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[0], ("broken", broken)])
    with pytest.raises(RuntimeError, match="gone"):
        corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert not [f for f in folders(spark) - before if not f.count("-") == 4]


def test_scratch_keeps_what_is_handed_on(spark):
    with scratch() as outer:
        with scratch() as inner:
            a, b = staged(spark.range(3), "scratch-a"), staged(spark.range(2), "scratch-b")
            inner.keep(a)
        assert a.count() == 3 and not [f for f in folders(spark) if f.startswith("scratch-b")]
        outer.keep(a)
    assert a.count() == 3
    with pytest.raises(Exception, match="scratch-b"):
        b.count()
