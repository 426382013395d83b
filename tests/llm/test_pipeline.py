from collections import Counter

import corpus_pipeline
from lodestack.llm import decontaminate, pieces, quality
from lodestack.session import table

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding",
    ]
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, kept = kept, stage(spark, kept, SF).cache()
        if k < 4:
            assert kept.columns == docs.columns
            assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in before.collect()}
        if k == 0:
            good = {r.id for r in quality.quality(before).collect() if r.kept}
            assert {r.doc_id for r in kept.collect()} == good
        if k == 1:
            lines = Counter(x for r in before.collect() for x in {y.strip(" \t\n\x0b\x0c\r").lower() for y in r.text.split("\n")} if len(x) >= 40)
            after = Counter(x for r in kept.collect() for x in {y.strip(" \t\n\x0b\x0c\r").lower() for y in r.text.split("\n")} if len(x) >= 40)
            assert all(after[x] == 1 for x, n in lines.items() if n >= 5) and kept.count() == before.count()
            assert all(r.n_chars == len(r.text) for r in kept.collect())
        if k == 2:
            texts = [r.text for r in kept.collect()]
            assert len(texts) == len(set(texts))
        if k == 3:
            items = decontaminate.Items([(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect() if not items.matches(r.text)}
    encoder = pieces.Encoder(pieces.Vocabulary())
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = kept.collect()
    assert len(rows) == len(texts)
    assert all(r.tokens == encoder.encode(texts[r.doc_id]).tolist() for r in rows)
