"""The pipeline's stages, each on its own input, and the file round trip at its end."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import Row

import corpus_pipeline
from rowmill.llm.tokens import load_tokenizer


def folder(spark, path):
    draw = random.Random(1)
    vocabulary = [f"w{i}" for i in range(2000)]
    make = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [" ".join(make(25)) for _ in range(5)]
    rows = []
    for i in range(240):
        w = make(draw.randrange(20, 90))
        if i % 8 == 0:
            w[3] = w[-2] = draw.choice(["grumble", "snark"])
        if i % 30 == 7:
            w[5:5] = items[i % 5].split()
        if i % 20 == 11:
            w = [*rows[-1].text.split(), "x"]
        rows.append(Row(doc_id=i, text=" ".join(w), lang="en", source=f"s{i % 3}", n_chars=len(" ".join(w))))
    rows += [Row(doc_id=300, text=None, lang=None, source=None, n_chars=None), Row(doc_id=301, text="", lang="en", source="s1", n_chars=0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 8 == 0), 1) for i in range(240)], "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = folder(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = {r.doc_id for r in rows}
    gone = {
        "toxicity": {i for i in range(0, 240, 8)},
        "near_duplicates": {i for i in range(11, 240, 20)},
        "decontamination": {i for i in range(7, 240, 30)} | {i + 1 for i in ()},
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == [*gone, "mixing", "token_files"]
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == "token_files":
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name in gone:
            copied = {i - 1: i for i in range(11, 240, 20)}
            removed = gone[name]
            if name == "near_duplicates":  # a copy of a toxic document went with it, and is alone then
                removed = {c for o, c in copied.items() if o in want and c in want}
            if name == "decontamination":
                removed = {i for i in removed if i in want} | {c for o, c in copied.items() if o in removed and c in want}
            assert {r.doc_id for r in docs.collect()} == want - removed
            want -= removed
        else:
            for r in docs.collect():
                texts.setdefault(r.doc_id, []).append(r.text)
            assert set(texts) <= want - {300, 301}
    whole = load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(d, [*whole.encode(t, add_special_tokens=False).ids, 0]) for d, parts in texts.items() for t in parts]
    got = out.collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
