"""The pipeline against a plain computation of each stage on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from .test_exact_dedup import digest_of
from .test_near_dedup import wanted as components
from pulseframe.llm import mixing, quality
from pulseframe.llm.common import saved, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = saved(stage(spark, docs, SF), name)
        after = docs.collect()
        if number < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert set(after) <= set(before)
        ids = sorted(r["doc_id"] for r in after)
        if number == 0:
            ratio_kept = quality.resample(table(spark, SF, "documents"), table(spark, SF, "labels"), quality.SHARPENED)
            assert ids == sorted(r["doc_id"] for r in ratio_kept.collect()) and 0.5 * len(before) < len(ids) <= len(before)
        elif number == 1:
            first = {}
            for r in before:
                first[digest_of(r["text"])] = min(r["doc_id"], first.get(digest_of(r["text"]), r["doc_id"]))
            assert ids == sorted(first.values())
        elif number == 2:
            assert ids == sorted(i for i, _, c in components([(r["doc_id"], r["text"]) for r in before]) if i == c)
        elif number == 3:
            plan = mixing.mix_plan(spark.createDataFrame(before, docs.schema)).collect()
            assert ids == sorted(r["doc_id"] for r in plan for _ in range(r["copies"]))
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            tokens = sum(len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before)
            assert sum(r["length"] for r in after) == tokens
            filled = {}
            for r in after:
                filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            for items in filled.values():
                end = 0
                for offset, length in sorted(items):
                    assert offset == end
                    end += length
                assert end <= 2048
    assert sorted(map(str, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(
        str(r) for r in docs.drop("sequence_id", "offset").collect())
