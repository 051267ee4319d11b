import re

import numpy as np
import pyarrow as pa
import pytest
from odd_texts import ODD

from roadpulse.llm.common import slices, text_buffers
from roadpulse.llm.words import Words

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("lower", [False, True])
def test_words_and_hashes(lower):
    texts = ODD + ["the cat", "THE cat", "the", " cat the cat"]
    words = Words(*text_buffers(pa.array(texts)), lower=lower)
    raw = b"".join((t or "").encode() for t in texts)
    flat = []
    for i, t in enumerate(texts):
        own = [raw[s:e].decode() for s, e in zip(words.starts, words.ends, strict=True)][words.first[i] : words.first[i + 1]]
        assert own == SPLIT.findall(t or "")
        flat += [re.sub("[A-Z]", lambda m: m.group().lower(), w) if lower else w for w in own]
    by = {}
    for w, h in zip(flat, words.hashes.tolist(), strict=True):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_spans_do_not_depend_on_place():
    words = Words(*text_buffers(pa.array(["x y a b c z", "a b c", "c b a"])))
    h = words.spans(np.array([2, 6, 9]), np.array([5, 9, 12]))
    assert h[0] == h[1] != h[2]


def test_windows_stay_inside_texts():
    words = Words(*text_buffers(pa.array(["a b c", "", "d e", "f g h i"])))
    start, first = words.windows(3)
    assert start.tolist() == [0, 5, 6] and first.tolist() == [0, 1, 1, 1, 3]


def test_slices_are_bounded_and_complete():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "cdef", "", "ghijklmnop", "q"])], ["text"])
    parts = list(slices(iter([batch]), "text", 4))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 4 for p in parts)
