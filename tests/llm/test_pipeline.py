"""The pipeline against a plain version, stage by stage."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import packing, secrets
from tidemark.llm.registry import tokenizer_path


def test_pipeline(spark, docs_of, tmp_path):
    rng = random.Random(12)
    items = [brute.prose(rng, 25) for _ in range(4)]
    rows = [(i, brute.prose(rng, rng.choice((55, 120, 500)))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(120 + i, rows[30 + i][1] + " end") for i in range(5)]
    rows += [(140 + i, f"{brute.prose(rng, 60)} {t}") for i, t in enumerate(items)]
    rows += [(160 + i, f"{brute.prose(rng, 60)} token = abcdef{i} {brute.prose(rng, 9)}") for i in range(5)]
    rows += [(180, None), (181, ""), (182, "too short"), (183, "la " * 200), (None, brute.prose(rng, 70)), (184, brute.prose(rng, 8000))]
    docs_of(rows).drop("row", "key", "kept").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t in rows if (f := brute.features(t))[0] >= 50 and 100 * f[4] <= 50 * f[0]]
    named = [(i, t) for i, t in left if i is not None]
    first = brute.near_classes(named)
    left = [(i, t) for i, t in named if first[i] == i] + [(i, t) for i, t in left if i is None]
    left = [(i, t) for i, t in left if not any(x in t for x in items)]
    assert {i for i, _ in rows if i and 140 <= i < 150}.isdisjoint(i for i, _ in left) and len(left) == 67

    def masked(t):
        for start, _, end in reversed(brute.secrets(t)):
            t = t[:start] + secrets.MASK + t[end:]
        return t

    whole = Tokenizer.from_file(tokenizer_path())
    want = {}
    for i, t in left:
        ids = np.array(whole.encode(masked(t), add_special_tokens=False).ids + [packing.END_ID], "<u4")
        want[i] = ids
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in got) == sum(map(len, want.values()))


def test_stages_keep_the_columns(spark, docs_of):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]
    docs = docs_of([(1, brute.prose(random.Random(1), 60)), (2, None)]).drop("row", "key", "kept")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 1
