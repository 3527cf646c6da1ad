"""The pipeline's stages against plain versions, each on its own input, and the registered names."""

import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pressmill.llm import mixing
from pressmill.llm.common import forest
from tests.llm.test_operators import plain_shingles

SMALL = "/root/testdata/sf0.001"


def plain_lines(rows):
    seen, out = [], {}
    for doc, text in sorted(rows):
        keep = []
        for line in text.split("\n"):
            w = [x for x in re.split("[ \t\x0b\f\r]+", line) if x]
            s = set(w)
            again = bool(s) and any(100 * len(s & o) >= 80 * len(s | o) for o in seen)
            if s:
                seen.append(s)
            if not again:
                keep.append(line)
        if len(keep) == len(text.split("\n")) or "\n".join(keep).split():
            out[doc] = "\n".join(keep)
    return out


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 120").withColumn("extra", F.lit("keys"))
    columns, stages = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert k == 4 or sorted(docs.columns) == sorted(columns)
        stages.append({r.doc_id: r for r in docs.collect()})
        assert len(stages[-1]) == docs.count() > 0
    good, line, near, mixed, tokens = stages
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("doc_id < 120").collect()}
    assert sum(labels[k] == (k in good) for k in labels) >= 0.9 * len(labels)
    assert {k: r.text for k, r in line.items()} == plain_lines([(k, r.text) for k, r in good.items()])
    ids = sorted(line)
    sets = [plain_shingles(line[k].text) for k in ids]
    links = [(i, j) for i in range(len(ids)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = forest(len(ids), *(np.array(links, int).reshape(-1, 2).T))
    assert set(near) == {k for n, k in enumerate(ids) if root[n] == n}
    again = mixing.mix(spark.read.parquet(str(tmp_path / "2")), budget=corpus_pipeline.MIX_BUDGET)
    assert set(mixed) == {r.id for r in again.where("sampled").collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {k: np.frombuffer(r.ids, "<u4").tolist() for k, r in tokens.items()} == {
        k: tok.encode(r.text, add_special_tokens=False).ids for k, r in mixed.items()}


def test_foreign_columns_and_a_table_without_counts(spark):
    rows = [(1, "one line here\nagain and again", "en", "s"), (2, "again and again\nanother one", "en", "s"), (3, None, None, None)]
    clash = ["_id", "_gone", "_cell_source", "n_lines", "n_removed", "id", "gone", "key", "row", "kept", "of_topic", "ratio", "chance"]
    docs = spark.createDataFrame([(*r, *(f"{c} {r[0]}" for c in clash)) for r in rows], ["doc_id", "text", "lang", "source", *clash])
    out = corpus_pipeline.drop_repeated_lines(spark, docs, SMALL)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "one line here\nagain and again", 2: "another one", 3: None}
    mixed = mixing.sample(out, budget=1.0, rounds=2)
    assert mixed.columns == docs.columns
    for df in (out, mixed):
        for r in df.collect():
            assert [r[c] for c in clash] == [f"{c} {r.doc_id}" for c in clash]


def test_names():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
