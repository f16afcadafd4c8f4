"""The corpus pipeline, stage by stage, and its registration."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from mapflow.llm.common import stored, tokenizer_path
from tests.llm.test_models import secret_rows, toxic_table
from tests.llm.texts import prose

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


@pytest.fixture(scope="module")
def corpus(spark, documents, odd_rows, tmp_path_factory):
    """Toxic documents, copies, near copies, secrets and odd rows in a folder of tables."""
    toxic, labels = toxic_table(200)
    hidden, planted = secret_rows()
    base = prose(77, 200)
    near = base.split()
    near[100] = "altered"
    rows = [*toxic, *((1000 + n, t) for n, t in hidden)]
    rows += [(2000, base), (2001, base), (2002, " ".join(near)), *((3000 + i if i is not None else None, t) for i, t in odd_rows)]
    folder = tmp_path_factory.mktemp("corpus")
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, dict(labels), planted


def test_stages_take_effect(spark, corpus):
    folder, rows, labels, planted = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns
        after[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    ids = {name: {i for i, _ in kept} for name, kept in after.items()}
    assert not ids["toxicity"] & {i for i, bad in labels.items() if bad}
    assert len(after["toxicity"]) == len(rows) - sum(labels.values())
    plain = [(t or "").translate(BLANK) for _, t in after["exact dedup"]]
    assert sorted(plain) == sorted({(t or "").translate(BLANK) for _, t in after["toxicity"]})
    assert {2000, 2001, 2002} & ids["near dedup"] == {2000}
    assert ids["secrets"] == ids["near dedup"] and len(after["secrets"]) == len(after["near dedup"])
    assert {1000 + n for n in planted} <= ids["secrets"]
    assert not any(value in (t or "") for _, t in after["secrets"] for value in planted.values())


def test_run_packs_what_was_kept(spark, corpus):
    folder, *_ = corpus
    got = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "test-stage")
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    expected = []
    for r in docs.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        expected += [(r["doc_id"], at, zlib.crc32(ids[at : at + 4096]), len(ids)) for at in range(0, len(ids), 4096)]
    assert sorted(map(str, expected)) == sorted(str((r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"])) for r in got)


def test_stages_keep_columns_of_any_name(spark, corpus, odd_rows):
    """Documents may bring columns named like those that the stages use themselves."""
    folder, rows, *_ = corpus
    names = (
        "secret_key secrets __secret_key __secrets text_sha __sha found_id found_sha text_sha256 keep_id gone node component component_id "
        "kept n n_shingles set_a set_b minima row_id hash key rank label fold toxic word words before after place value near candidate "
        "occurrences score secret a.b group_size slot plain bits id"
    ).split()
    given = [(i, t, "src/a.txt", *(f"{name} {n}" for name in names)) for n, (i, t) in enumerate([*rows[::3], *odd_rows])]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names)).repartition(3)
    bare = docs.select("doc_id", "text", "source")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs, bare = stored(stage(spark, docs, folder), "test-named"), stored(stage(spark, bare, folder), "test-bare")
        assert docs.columns == columns
        key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
        got = sorted(docs.collect(), key=key)
        assert [key(r) for r in got] == sorted(map(key, bare.collect())), name
        assert all(len({r[n].removeprefix(n) for n in names}) == 1 for r in got)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_empty_corpus(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_has_its_query():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5
