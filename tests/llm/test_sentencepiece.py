import hashlib
import random

import pytest

from sievemill.llm import sentencepiece_codec as codec
from tests.llm.helpers import docs

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("piece_bpe_32k.model")
ALPHABET = [" ", "  ", "a", "the", "ing", "\n", "\t", "▁", "é", "日", "𝕏", "\x00", "<0x41>", "</s>", "00", "--", "ﬁ", "​", "́", "\xa0", "tion", "aa", "e", " " * 20]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n):
    r = random.Random(5)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["", "a" * 3000, "ab" * 2000, " " * 999, "=-" * 900, "日" * 99]


def test_encodes_and_decodes_as_the_library(library):
    c = codec.codec(PATH)
    for t in texts(2000):
        ids = library.encode(t, add_eos=True)
        assert c.encode(t) == ids
        assert c.decode(ids) == library.decode(ids)


def test_decodes_any_ids(library):
    c, r = codec.codec(PATH), random.Random(6)
    for _ in range(500):
        ids = [r.randrange(library.vocab_size()) if r.random() < 0.5 else r.randrange(3, 259) for _ in range(r.randint(0, 12))]
        assert c.decode(ids) == library.decode(ids)


def test_documents(spark, library, monkeypatch):
    monkeypatch.setattr(codec, "KEPT_UNITS", 10)
    monkeypatch.setattr(codec, "CHUNK_BYTES", 200)
    rows = [*enumerate(texts(40)), (1000, None), (None, "x"), (1, "again")]
    got = codec.encode_documents(docs(spark, rows), PATH, with_ids=True).collect()
    want = sorted((str(i), t or "") for i, t in rows)
    assert len(got) == len(rows)
    for r, (i, t) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.decoded)), sorted(want, key=lambda w: (w[0], library.decode(library.encode(w[1])))), strict=True):
        ids = library.encode(t, add_eos=True)
        assert (str(r.doc_id), r.ids, r.n_tokens, r.decoded) == (i, ids, len(ids), library.decode(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert codec.digests(docs(spark, []), PATH).count() == 0


def test_long_texts_without_spaces(library):
    c, r = codec.codec(PATH), random.Random(7)
    prose = "".join(r.choice(["the", "tion", "internal", "er", "qu", "x", "ing", "日本", "zz", "0"]) for _ in range(60_000))
    letters = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    for text in (prose, letters, "a" * 100_000):
        assert c.encode(text) == library.encode(text, add_eos=True)


def test_long_texts_go_in_slices(library, monkeypatch):
    monkeypatch.setattr(codec, "CHUNK_BYTES", 50)
    e, r = codec.Encoder(codec.codec(PATH)), random.Random(8)
    for n in range(300):
        t = "".join(r.choice(ALPHABET) for _ in range(r.randint(150, 400))) + r.choice(["", " ", "▁", "  "])
        ids = library.encode(t, add_eos=True)
        n_tokens, sha, back, every = e.digested_long(t, True)
        assert len(list(codec.slices(t))) > 2
        assert (n_tokens, every[0].tolist(), back) == ([len(ids)], ids, [library.decode(ids)])
        assert sha == [hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()]


@pytest.mark.parametrize("old,new", [(b"identity\x12\x00\x18\x01", b"identity\x12\x00\x18\x00"), (b"identity\x12\x00\x18\x01 \x00", b"identity\x12\x00\x18\x01 \x01")])
def test_other_models_are_refused(tmp_path, old, new):
    model = open(PATH, "rb").read()
    assert old in model  # no dummy prefix; extra white space removed
    path = tmp_path / "other.model"
    path.write_bytes(model.replace(old, new))
    with pytest.raises(ValueError, match="no BPE model"):
        codec.BpeCodec(str(path))


def test_caches_stay_bounded(monkeypatch):
    monkeypatch.setattr(codec, "KEPT_UNITS", 50)
    e = codec.Encoder(codec.codec(PATH))
    for k in range(20):
        e.ids_of([f"unit{k}x{i}" for i in range(40)] + ["y" * 100 + str(k)])
        assert len(e.seen) <= 50 and max(map(len, e.seen)) <= codec.KEPT_LENGTH
