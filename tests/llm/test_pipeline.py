from __future__ import annotations

import corpus_pipeline
from tests.llm.test_packing import holds
from wattspindle.llm import langid, mixing, simhash, substring_dedup


def test_stages_take_effect(llm, sf_dir):
    """Each stage against its operator, on what its predecessor kept."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "substring_dedup", "mixing", "best_fit_packing"]
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(llm, docs, sf_dir).cache()
        if name == "language_id":
            known = langid.identify(docs, langid.learn(docs)).where("score > 0")
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in known.collect()}
        elif name == "simhash_near_dedup":
            groups = simhash.near_duplicates(docs).select("component_id").distinct()
            assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups.collect()}
        elif name == "substring_dedup":
            wanted = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == wanted
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "mixing":
            times = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect() if r.taken}
            assert {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()} == times
        else:
            holds(after.collect(), [(r.doc_id, r.text) for r in docs.collect()])
            continue
        assert after.columns == columns
        docs = after


def test_odd_documents_pass_through(llm, make, odd_texts, tmp_path):
    rows = [(i, t, ["en", None][i % 2], [None, "s"][i % 2], 1) for i, t in enumerate(odd_texts)]
    for frame in (make(*rows, *rows[:3], (None, "the words", "en", "s", 9)), make()):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(llm, docs, str(tmp_path)).cache()
        docs.collect()


def test_columns_named_like_results_are_kept(llm, make):
    rows = [(i, f"the house number {i} is on the road to the sea and the hills {i}", "en", "s", 1) for i in range(40)]
    docs = make(*rows, *[(100 + i, rows[i][1], "en", "s", 1) for i in range(9)])
    named = docs.drop("n_chars").selectExpr("*", "'KEEP' AS score", "doc_id AS Lang_Pred", "true AS n_words", "'r' AS n_removed")
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = stage(llm, named, "")
        assert after.columns == named.columns and after.dtypes == named.dtypes
        found = after.collect()
        assert found and all(r.score == "KEEP" and r.Lang_Pred == r.doc_id and r.n_words and r.n_removed == "r" for r in found)
        named = after
