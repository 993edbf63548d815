"""Token files: ids by the tokenizer on whole texts, offsets by select, and exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from civicflow.llm import token_files as K
from civicflow.llm.queries import op13_token_files, vocabulary_path

from .helpers import SCHEMA, awkward, empty, frame

PATH = vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def plain(tokenizer, rows):
    """(doc_id, n_tokens, crc) in file order; rows of one id in any order."""
    out = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def test_units_give_the_tokenizers_ids(tokenizer):
    random.seed(3)
    marks = ["a", "b", "the", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", "é", "ß", "漢字", "1", "22", ".", "'s", "don't", "\xa0", " ", "\x85", "\x1c", "<|endoftext|>", "<|", "…", "“", "”", "😀", "​", "　", "﻿", " ", "᠎", " "]
    texts = [None, "", " ", "\n \n"] + ["".join(random.choice(marks if random.random() < 0.2 else marks[:16]) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    ids, at = K.UnitIds(PATH).documents(pa.array(texts, pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize("n, universe", [(0, 1), (1, 0), (5000, 10**6), (3000, 3000), (700, 2**40)])
def test_offsets_by_select(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe + 1, n))
    values[: n // 3] = values[0] if n else 0
    own = K.Offsets(K.Offsets.arrays(values, universe))
    assert (own.get(np.arange(n)) == values).all()
    some = rng.integers(0, max(n, 1), 50 if n else 0)
    assert (own.get(some) == values[some]).all()
    low = max(0, (universe // max(n, 1)).bit_length() - 1)
    # low bits, three bits at most for the upper ones, half a bit for the samples, and what rounding adds
    assert 8 * own.nbytes <= n * (low + 3.5) + 8 * 64


def test_a_files_documents():
    sizes, docs = np.array([3, 1, 1, 4]), np.array([-5, 7, 7])
    ids = np.arange(9, dtype=np.uint16)
    own = K.TokenFile(K.file_bytes(2, 1, ids, sizes, docs, 1) + b"\n")
    assert (own.task, own.number, own.n) == (2, 1, 4)
    assert own.doc_ids().to_pylist() == [-5, 7, 7, None]
    assert [own.ids(i).tolist() for i in range(4)] == [[0, 1, 2], [3], [4], [5, 6, 7, 8]]
    wide = K.TokenFile(K.file_bytes(0, 0, ids, np.array([4, 5]), np.array([-(2**62), 2**62]), 0))
    assert wide.doc_ids().to_pylist() == [-(2**62), 2**62]


def test_round_trip(spark, tokenizer, tmp_path):
    rows = [(i, t) for i, t, *_ in awkward([(-4, "below zero"), (9, "x <|endoftext|> y"), (None, None)])]
    path = str(tmp_path / "tokens")
    K.write_tokens(frame(spark, [(-4, "below zero"), (9, "x <|endoftext|> y"), (None, None)]).repartition(3), path, PATH, file_ids=40)
    got = sorted(K.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(i), n, c) for i, n, c in plain(tokenizer, rows))
    order = [(r["doc_id"] is None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()


def test_many_files_of_a_task(spark, tokenizer, tmp_path):
    rows = [(i, " ".join(f"Wort{k % 977} x{k % 7}" for k in range(9_000 + i)), "en", "s", 1, "", "", 0) for i in range(80)]
    path = str(tmp_path / "tokens")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        K.write_tokens(spark.createDataFrame(rows, SCHEMA), path, PATH, file_ids=1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = sorted(K.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got] == plain(tokenizer, [(i, t) for i, t, *_ in rows])
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    assert max(r["number"] for r in got) >= 1


def test_one_id_is_dealt_to_many_tasks(spark, tmp_path):
    rows = [(7, f"text {i % 50}", "en", "s", 1, "", "", 0) for i in range(4000)]
    path = str(tmp_path / "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(4), path, PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in K.read_documents(spark, path).groupBy("task").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    K.write_tokens(empty(spark), path, PATH)
    assert K.read_documents(spark, path).count() == 0
    with pytest.raises(TypeError):
        K.write_tokens(empty(spark), path, PATH, id_col="text")


def test_query(spark, sf_dir, tokenizer):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    want = plain(tokenizer, rows)
    starts = np.cumsum([0, *[n for _, n, _ in want]])[:-1].tolist()
    got = op13_token_files(spark, sf_dir).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == [(i, s, n, c) for (i, n, c), s in zip(want, starts)]
