import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm import words as W

from .helpers import lower, words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b\x1c\u2003ß9.-", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_split_words_matches_regex(rows):
    w = W.split_words(pa.array(rows, pa.string()), lower=True)
    vocab = [v.decode() for v in w.vocab_list()]
    for i, row in enumerate(rows):
        got = [vocab[c] for c in w.codes[w.doc_start[i] : w.doc_start[i + 1]]]
        assert got == words(lower(row or ""))


def test_slices_cover_all_rows_and_bound_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 900, 20, 20, 3000, 1)])], names=["t"])
    parts = list(W.slices(iter([batch]), "t", 1000))
    assert sum(p.num_rows for p in parts) == 6 and len(parts) > 1


def test_sums_by_doc():
    assert W.sums_by_doc(np.array([1, 2, 3]), np.array([0, 2, 2, 3])).tolist() == [3, 0, 3]
