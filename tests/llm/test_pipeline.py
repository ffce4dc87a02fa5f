"""The pipeline stage by stage, each held against its input."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_groups import LOWER, Union, plain_fingerprint
from wardlight.llm import mixing, tokens
from wardlight.llm.queries import WEIGHTS

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rnd = random.Random(9)
    path = tmp_path_factory.mktemp("sf")
    vocabulary = [f"w{k}" for k in range(500)]
    words = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [words(14) for _ in range(4)]
    texts = [words(rnd.choice([20, 60, 120, 300])) for _ in range(120)]
    texts += [texts[k] for k in range(0, 120, 9)] + [t + " more" for t in texts[100:110]]
    texts += [words(60) + " " + i + " " + words(60) for i in items] + [None, "", "a b " * 200]
    rows = [(k, t, "en", rnd.choice(["src0", "src0", "src1", "src2", "other", None]), None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[30], (None, texts[5], "en", "src0", 5), (None, words(90), None, None, None)]
    write = lambda name, table: pq.write_table(table, path / f"{name}.parquet")
    write("documents", pa.Table.from_pylist([dict(zip(DOCS.names, r)) for r in rows], DOCS))
    write("benchmark", pa.table({"item_id": [str(k) for k in range(4)], "text": items}))
    write("labels", pa.table({"doc_id": list(range(0, 120, 2)), "quality": [k % 4 > 0 for k in range(60)], "toxic": [0] * 60}).cast(
        pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])))
    return str(path), rows, items


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*DOCS.names).collect())


def test_stages(spark, folder, tmp_path):
    path, rows, items = folder
    docs, tables = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, path)
        out.write.parquet(str(tmp_path / name))
        tables[name] = docs, spark.read.parquet(str(tmp_path / name))
        docs = tables[name][1]
    for name in list(tables)[:-1]:
        before, after = tables[name]
        assert after.columns == DOCS.names and not rows_of(after) - rows_of(before)

    kept = rows_of(tables["quality"][1])
    assert kept and all(len((r[1] or "").split()) >= 50 for r in kept)

    before, after = (list(rows_of(t).elements()) for t in tables["near_duplicates"])
    prints = [plain_fingerprint(r[1], 3) for r in before]
    union = Union(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                union.join(i, j)
    first = {}
    for k, r in enumerate(before):
        first[union.find(k)] = min(first.get(union.find(k), (True, 0)), (r[0] is None, r[0] or 0))
    assert len(before) > len(after) == len(first)
    assert Counter((r[0] is None, r[0] or 0) for r in after) == Counter(first.values())

    found = lambda text: any(" ".join(w[k:k + 10]) in text for w in (i.split() for i in items) for k in range(5))
    before, after = (rows_of(t) for t in tables["decontamination"])
    assert after == Counter({r: n for r, n in before.items() if not found((r[1] or "").translate(LOWER))})
    assert before - after

    before, after = (rows_of(t) for t in tables["mix"])
    assert before == after
    mixed = tables["mix"][1].select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    order = [(r.doc_id, r.text) for r in sorted(mixed, key=lambda r: (int(r.file_name[5:10]), r.row_index))]
    placed = sorted(mixing.mix(tables["mix"][0], WEIGHTS).collect(), key=lambda r: r.position)
    assert order == [(r.doc_id, r.text) for r in placed]

    tokenizer, at = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER)), 0
    result = sorted(tables["token_ids"][1].collect(), key=lambda r: r.start)
    assert len(result) == len(order)
    for r, (doc_id, text) in zip(result, order):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_run_and_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    assert corpus_pipeline.run(spark, path).count() > 50
    none = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES[:4]:
        assert step(spark, none, path).count() == 0


def test_part_files_are_ordered_by_number(spark, tmp_path):
    """`part-100000` comes after `part-99999`; files without a number are an error."""
    for number, ids in ((99999, [1, 2]), (100000, [3]), (7, [4, 5])):
        pq.write_table(pa.table({"doc_id": ids, "text": [f"t {i}" for i in ids]}), tmp_path / f"part-{number:05d}-x.parquet")
    out = corpus_pipeline.token_ids(spark, spark.read.parquet(str(tmp_path)), "")
    assert [r.doc_id for r in sorted(out.collect(), key=lambda r: r.start)] == [4, 5, 1, 2, 3]
    pq.write_table(pa.table({"doc_id": [6], "text": ["t"]}), tmp_path / "other.parquet")
    with pytest.raises(Exception, match="no part number"):
        corpus_pipeline.token_ids(spark, spark.read.parquet(str(tmp_path)), "").where(F.lit(True)).count()
