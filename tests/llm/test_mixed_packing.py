"""The order that mixing decides holds in the packed sequences."""

import random

import pytest

import corpus_pipeline
from sigweave.llm import mixing, packing
from sigweave.llm.common import stored
from sigweave.llm.queries import MIX_REST, MIX_WEIGHTS

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("reread", [True, False])
@pytest.mark.parametrize("one_file", [True, False])
def test_sequences_follow_the_weights(spark, sf_dir, reread, one_file, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_BYTES", 20_000)
    rng = random.Random(5)
    rows = [
        (i, " ".join(rng.choices("alpha beta gamma delta".split(), k=rng.randint(1, 60))), "en", s, 9)
        for i, s in enumerate(["src0"] * 700 + ["src1"] * 700 + ["src2"] * 700)
    ]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(one_file).lower())
    try:
        docs = spark.createDataFrame(rows, DOCS)
        position = {
            r.doc_id: r.position for r in mixing.mixed(docs, MIX_WEIGHTS, MIX_REST).collect()
        }
        mix = corpus_pipeline.mixed_by_source(spark, docs, sf_dir)
        if reread:
            mix = stored(mix, "test-mixing")
        pieces = corpus_pipeline.packed(spark, mix, sf_dir).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    first = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        first.setdefault(r.doc_id, len(first))
    assert len(first) == len(rows)
    assert len({r.sequence_id >> 32 for r in pieces}) > 1
    assert all(abs(first[i] - p) < packing.WINDOW_DOCS for i, p in position.items())
    # src0 has 25 of 33 slots as long as it lasts: 512 documents hold 388 of it, give or take a block.
    source = {r[0]: r[3] for r in rows}
    share = sum(source[i] == "src0" for i, n in first.items() if n < 512)
    assert abs(share - 512 * 25 / 33) <= 2 * mixing.BLOCK_DOCS + (0 if one_file else packing.WINDOW_DOCS)
