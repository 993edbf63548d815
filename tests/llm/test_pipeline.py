import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd

import corpus_pipeline
from civicflow.llm.queries import QUERIES, vocabulary_path
from civicflow.llm.sql import ORACLE_SQL

from .helpers import awkward, chains, similar_pairs
from .test_pii import all_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_quality(rows):
    """The rows that the SQL of the quality rules keeps; rows are told apart by their place."""
    c = duckdb.connect()
    documents = pd.DataFrame([(i, t, s) for i, (_, t, _, s, _) in enumerate(rows)], columns=["doc_id", "text", "source"])
    c.register("documents", documents)
    return [rows[i] for i in sorted(r[0] for r in c.sql(f"select doc_id from ({ORACLE_SQL['op9_quality_rules']}) where kept").fetchall())]


def plain_near_dedup(rows):
    """One row of each group of similar texts: the least id, nulls last."""
    texts = sorted({r[1] for r in rows if r[1] is not None})
    root = dict(zip(texts, chains(len(texts), similar_pairs(texts))))
    first = {}
    for r in rows:
        if r[1] is not None:
            own = (r[0] is None, r[0] or 0)
            if root[r[1]] not in first or own < first[root[r[1]]][0]:
                first[root[r[1]]] = (own, r)
    return [r for _, r in first.values()] + [r for r in rows if r[1] is None]


def plain_mask(rows):
    out = []
    for r, spans in zip(rows, all_spans([r[1] or "" for r in rows])):
        text, at, parts = r[1] or "", 0, []
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= at:
                parts += [text[at:a], f"<{kind.upper()}>"]
            at = max(at, b)
        text = None if r[1] is None else "".join(parts) + text[at:]
        out.append((r[0], text, r[2], r[3], None if text is None else len(text)))
    return out


def plain_pieces(rows):
    from tokenizers import Tokenizer

    t, out = Tokenizer.from_file(vocabulary_path()), Counter()
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            out[r[0], p, a, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))] += 1
    return out


def test_pipeline_against_a_plain_version(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    base = " ".join(f"w{i} of" for i in range(60))
    near = [(9_000 + i, base.replace("w7 of", f"n{i} in"), "en", "s0", 1) for i in range(9)]
    secret = [(9_100 + i, " ".join(f"v{i}x{k} is" for k in range(40)) + f" api token: {zlib.crc32(str(i).encode()):08x}{i:024x} end", "en", "s1", 1) for i in range(8)]
    rows = docs + near + secret + [(7, near[0][1], "en", "s0", 1), (7, near[0][1], "en", "s0", 1), (None, secret[0][1] + " more", "en", None, 1)] + [r[:5] for r in awkward()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    good = plain_quality(rows)
    unique = plain_near_dedup(good)
    assert 0 < len(unique) < len(good) < len(rows)
    clean = plain_mask(unique)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == plain_pieces(clean)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 4096


def test_stages_keep_their_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs.select("*"), sf_dir)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)


def test_stages_of_awkward_and_of_empty_tables(spark, tmp_path):
    wide = spark.createDataFrame(awkward(), "doc_id long, text string, lang string, source string, n_chars long, __text string, key string, id int")
    for k, df in enumerate((wide, wide.limit(0), wide.select("doc_id", "text", "lang", "source", "n_chars").where("text is null"))):
        df.write.parquet(str(tmp_path / str(k) / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / str(k)))
        assert {"doc_id", "piece", "sequence_id"} <= set(out.columns) and (out.count() > 0) == (k == 0)


def test_every_query_is_registered():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q.startswith("op")}
