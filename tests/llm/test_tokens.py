import random
import zlib
from collections import defaultdict

import pytest

from civicflow.llm import packing, token_counts
from civicflow.llm.queries import vocabulary_path

from .helpers import empty, frame, sf_rows

PATH = vocabulary_path()


def greedy(word, pieces, longest):
    """Symbols of a word, the last one marked, cut greedily."""
    raw = list(word.encode())
    symbols = raw[:-1] + [raw[-1] + 256]
    at = n = 0
    while at < len(symbols):
        for k in range(min(longest, len(symbols) - at), 0, -1):
            if tuple(symbols[at : at + k]) in pieces:
                at += k
                n += 1
                break
        else:
            return 1
    return n


def split(text):
    import re

    return re.findall("[a-z\x80-\U0010ffff]+|[0-9]|[^\x00-\x200-9a-z\x7f-\U0010ffff]+", text)


def test_token_counts_against_greedy(spark):
    vocabulary = token_counts.read_vocabulary(PATH)
    pieces, longest = set(vocabulary), max(map(len, vocabulary))
    extra = [(100 + i, t) for i, t in sf_rows(spark, 60)]
    df = frame(spark, extra)
    got = sorted(((r["doc_id"] is not None, r["doc_id"]), r["n_words"], r["n_tokens"]) for r in token_counts.token_counts(df, token_counts.LongestMatch(vocabulary)).collect())
    import pyarrow as pa
    import pyarrow.compute as pc

    want = []
    for r in df.collect():
        ws = split(pc.utf8_lower(pa.array([r["text"] or ""]))[0].as_py())
        want.append(((r["doc_id"] is not None, r["doc_id"]), len(ws), sum(greedy(w, pieces, longest) for w in ws)))
    assert got == sorted(want)
    assert token_counts.token_counts(empty(spark), token_counts.LongestMatch(vocabulary)).count() == 0


def test_failure_links_pop_right_counts():
    pieces = [tuple(s.encode()) for s in ("a", "b", "c", "ab", "abcd", "bc", "cde", "d", "e")] + [(*s.encode()[:-1], s.encode()[-1] + 256) for s in ("c", "e", "d")]
    m = token_counts.LongestMatch(pieces)
    import pyarrow as pa

    words = ["abc", "abcde", "abcdabcc", "zz", "abcd", "bce"]
    want = [greedy(w, set(pieces), 5) for w in words]
    assert m.lengths(pa.array([w.encode() for w in words], pa.large_binary())).tolist() == want


def test_very_long_words():
    import time

    import pyarrow as pa

    vocabulary = token_counts.read_vocabulary(PATH)
    m, pieces, longest = token_counts.LongestMatch(vocabulary), set(vocabulary), max(map(len, vocabulary))
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 63, 64, 65, 66, 200, 5000)] + ["é" * 400, "ab" * 90 + "\u0378"]
    assert m.lengths(pa.array([w.encode() for w in words], pa.large_binary())).tolist() == [greedy(w, pieces, longest) for w in words]
    began = time.time()
    assert m.lengths(pa.array([b"ab" * (1 << 20)], pa.large_binary()))[0] > 1000
    assert time.time() - began < 20


@pytest.fixture(scope="module")
def packed(spark):
    extra = [(100 + i, t) for i, t in sf_rows(spark)]
    df = frame(spark, extra)
    return df, packing.pack_documents(df, PATH).collect()


def test_pieces_are_the_tokenizers(packed):
    from tokenizers import Tokenizer

    df, rows = packed
    t = Tokenizer.from_file(PATH)
    want = []
    for r in df.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            want.append((str(r["doc_id"]), p, a, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)


def test_sequences_have_no_gaps_and_are_few(packed):
    _, rows = packed
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // 4096) * 1.03 + 1


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    b = packing.BestFit(10, open_bins=2)
    assert [b.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    b = packing.BestFit(10, open_bins=2)
    assert [b.place(n)[0] for n in (8, 7, 9, 3, 2)] == [0, 1, 2, 1, 3]  # 9 closes bin 0, then 2 finds only bin 2 with 1 free


def test_pack_empty(spark):
    assert packing.pack_documents(empty(spark), PATH).count() == 0


def test_pieces_of_few_long_texts_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_TASK", 20)
    rows = [(i, " ".join(f"x{k % 97} q{k % 31}" for k in range(90_000))) for i in range(2)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    assert len(got) > 60 and len({r["sequence_id"] >> 36 for r in got}) > 2
