"""The pipeline against a brute-force version of its stages."""

from brute import contamination, near_classes, pii

import corpus_pipeline as cp
from basketry.llm import language, queries

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_brute_force(spark):
    docs = queries.table(spark, SF, "documents")
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").collect()]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    model = language.fit(docs.filter(~language.held_out()))
    judged = language.judge([None if t is None else t.encode() for _, t in rows], model)
    rows = [r for r, (lang, score) in zip(rows, judged)
            if lang != "und" and score >= cp.MIN_LANGUAGE_SCORE]
    first = {}
    for (i, t), g in zip(rows, near_classes(rows)):
        first.setdefault(g, (i, t))
    rows = [r for r in first.values() if not contamination(r[1], items)[4]]
    want = {}
    for i, t in rows:
        out, at = "", 0
        for start, _, end, kind in pii(t):
            if start >= at:
                out += t[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        want[i] = out + t[at:]
    got = {r.doc_id: r for r in cp.run(spark, SF).collect()}
    assert set(got) == set(want)
    from basketry.llm import pieces
    lat = pieces._lattices(pieces.model_path(), 1.0)
    for i, r in got.items():
        assert lat.decode(r.piece_ids)[0].decode() == r.text
        # Disclosing terms go too; everything else stands as it was.
        if r.text != want[i]:
            left = r.text.replace("[TERM]", "").split()
            rest = iter(want[i].split())
            assert all(any(w == x for x in rest) for w in left)
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_duplicates",
                                         "benchmark_decontamination", "personal_data", "sentencepiece"]


def test_stages_keep_columns_and_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            extra = [] if name != "sentencepiece" else ["piece_ids"]
            assert out.columns == [c for c in docs.columns if c not in extra] + extra
            assert out.count() <= docs.count()
    texts = {r.text for r in odd_docs.collect()}
    assert {r.text for r in cp.sentencepiece(spark, odd_docs, SF).collect()} == texts


def test_labels_that_share_a_language_keep_their_texts(spark):
    from pyspark.sql import functions as F
    clean = queries.table(spark, SF, "documents").filter("lang = 'en'").select("doc_id", "text").cache()
    noise = spark.createDataFrame(
        [(-1, "".join(chr(0x4E00 + i * 7 % 5000) for i in range(3000)))], clean.schema)
    for labels in (["en"], ["en", "en-GB"], ["en", "en-GB", "en-US"]):
        train = clean.withColumn("lang", F.explode(F.array(*map(F.lit, labels))))
        kept = language.keep_identified(clean.unionByName(noise), language.fit(train),
                                        cp.MIN_LANGUAGE_SCORE)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in clean.collect())
