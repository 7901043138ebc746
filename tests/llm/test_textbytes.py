import random

import numpy as np
import pyarrow as pa

from sievemill.llm import textbytes as tb
from tests.llm.helpers import words


def test_words_and_hashes_across_chunks():
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "Bc", " ", "\n", "\t", "é", "\xa0", "日本", "  ", "\x1c"]) for _ in range(r.randint(0, 60))) for _ in range(300)] + ["", "x" * 5000, " " * 50]
    seen: dict[bytes, int] = {}
    for size in (64, 1 << 21):
        row = 0
        for c in tb.chunks(pa.array(texts), tb.SPACE, size=size):
            h = c.hashes()
            for k in range(c.rows):
                got = [bytes(c.buf[a:b]) for a, b in zip(c.starts[c.row_ptr[k] : c.row_ptr[k + 1]], c.ends[c.row_ptr[k] : c.row_ptr[k + 1]], strict=True)]
                assert got == words(texts[row])
                for w, x in zip(got, h[c.row_ptr[k] : c.row_ptr[k + 1]], strict=True):
                    assert seen.setdefault(w, int(x)) == int(x)
                row += 1
        assert row == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_long_chunk_is_hashed_in_slices(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    c = next(tb.chunks(pa.array([text]), tb.SPACE))
    whole = c.hashes()
    monkeypatch.setattr(tb, "CHUNK_BYTES", 16)
    assert (c.hashes() == whole).all()


def test_ngrams_depend_on_their_words_only():
    h = np.array([1, 2, 3, 1, 2, 3, 4], tb.U64)
    for k in (1, 2, 3):
        g = tb.ngram_hashes(h, k)
        assert g[0] == g[3] and len(set(g[:3].tolist())) == 3
    x = np.arange(100, dtype=tb.U64) ** 3
    for k in range(1, 23):
        power = [pow(0xD6E8FEB86659FD93, k - 1 - j, 1 << 64) for j in range(k)]
        want = [sum(int(x[i + j]) * power[j] for j in range(k)) % (1 << 64) for i in range(100 - k)]
        assert tb.ngram_hashes(x, k)[: 100 - k].tolist() == want


def test_empty_column_and_slices():
    assert [c.rows for c in tb.chunks(pa.array([], pa.string()), tb.SPACE)] == []
    sliced = pa.array(["a b", "c", "d e f"]).slice(1)
    assert [len(c.starts) for c in tb.chunks(sliced, tb.SPACE)] == [4]
