import random

import pytest
from pyspark.sql import functions as F

from sievemill.llm import substring_dedup as substring_dedup_module
from sievemill.llm.substring_dedup import substring_dedup
from tests.llm.helpers import docs, words


def brute(rows, window=20):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def result(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect())


@pytest.mark.parametrize("seed,least", [(1, 50), (2, 50), (3, 50), (4, 2), (5, 5)])
def test_equals_brute_force(spark, seed, least, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(substring_dedup_module, "HOT_LEAST", least)  # with few runs an anchor counts as hot
    passages = [" ".join(r.choice("abcdefgh") + str(r.randint(0, 40)) for _ in range(n)) for n in (19, 20, 21, 35, 120)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(0, 4)):
            kind = r.random()
            parts.append(r.choice(passages) if kind < 0.5 else "For " * r.randint(1, 60) if kind < 0.6 else "A B " * r.randint(1, 40) if kind < 0.7 else " ".join(str(r.random()) for _ in range(r.randint(1, 30))))
        rows.append((i * 3, r.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(1000, rows[5][1]), (1001, rows[5][1] + " end"), (1002, None), (1003, "")]
    assert result(substring_dedup(docs(spark, rows).repartition(7))) == sorted(brute(rows))


@pytest.mark.parametrize("window", [9, 22])
def test_other_windows(spark, window):
    r = random.Random(window)
    base = [str(r.randint(0, 3)) for _ in range(400)]
    rows = [(i, " ".join(base[i * 7 : i * 7 + 60])) for i in range(40)]
    assert result(substring_dedup(docs(spark, rows), window=window)) == sorted(brute(rows, window))


def test_a_text_keeps_its_white_space(spark):
    w = [f"w{i}" for i in range(25)]
    rows = [(1, "\n " + " ".join(w) + "\n"), (2, "one\ttwo\n" + "\n".join(w) + "\n\nlast  x ")]
    got = {r.doc_id: r.kept for r in substring_dedup(docs(spark, rows), one_space=False, carry=["id", "x"]).collect()}
    assert got == {1: rows[0][1], 2: "one\ttwo\nlast  x "}


def test_repeated_rows_null_ids_and_empty(spark):
    t = " ".join(f"v{i}" for i in range(30))
    got = sorted(((r.doc_id, r.n_removed) for r in substring_dedup(docs(spark, [(1, t), (1, t), (1, t + " more"), (None, t)])).collect()), key=str)
    # the null id comes first; equal rows of one id are one document; with one id and another text it is another
    assert got == [(1, 30), (1, 30), (1, 30), (None, 0)]
    assert substring_dedup(docs(spark, [])).count() == 0
    assert substring_dedup(docs(spark, [(1, t)]), carry=["x", "id"]).columns == ["doc_id", "n_words", "n_removed", "kept", "x", "id"]


@pytest.mark.parametrize("least", [50, 2])
@pytest.mark.parametrize("parts", [1, 7])
def test_equal_rows_are_one_place(spark, parts, least, monkeypatch):
    monkeypatch.setattr(substring_dedup_module, "HOT_LEAST", least)
    r = random.Random(parts)
    passage = " ".join(f"p{r.randint(0, 9999)}" for _ in range(40))
    own = lambda: " ".join(f"o{r.randint(0, 9999)}" for _ in range(25))
    once = [(i, " ".join([own(), passage, own(), "For " * 30, own()])) for i in range(8)] + [(None, own() + " " + passage)]
    rows = once + [row for row in once for _ in range(2)]
    # every copy of a row loses what the row loses where it stands once, and the first documents lose only what they repeat themselves
    expected = sorted(brute([(i if i is not None else -1, t) for i, t in once]) * 3)
    got = sorted((-1 if i is None else i, *rest) for i, *rest in ((x.doc_id, x.n_words, x.n_removed, x.kept) for x in substring_dedup(docs(spark, rows).repartition(parts)).collect()))
    assert got == expected
    assert expected[0][2] == 0 and expected[3][2] < expected[3][1]


def test_window_limits(spark):
    with pytest.raises(ValueError):
        substring_dedup(docs(spark, []), window=23)


def _sorted(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_texts_of_one_id_are_told_apart(spark, monkeypatch):
    """Null ids, and ids with several texts: the order among them is that of their marks, and each loses only what it repeats."""
    r = random.Random(3)
    new = lambda n: " ".join(f"n{r.randint(0, 10**9)}" for _ in range(n))
    passage = new(20)
    rows = [(None, new(40)) for _ in range(30)] + [(7, new(30)) for _ in range(10)] + [(None, f"{new(5)} {passage} {new(40)}"), (None, f"{new(30)} {passage}"), (7, new(30) + " " + passage), (9, passage)]
    got = _sorted(substring_dedup(docs(spark, rows).repartition(5)))
    removed = {k: n for _, n_words, n, k in got if n}
    assert sum(removed.values()) == 60 and len(got) == len(rows)  # the first of four places stays
    # a 64-bit hash that is the same for all texts changes nothing
    old = substring_dedup_module._marks
    monkeypatch.setattr(substring_dedup_module, "_marks", lambda text: (F.lit(5).cast("long"), old(text)[1]))
    weak = _sorted(substring_dedup(docs(spark, rows).repartition(5)))
    assert sum(n for _, _, n, _ in weak) == 60 and len(weak) == len(rows)


def test_very_long_text(spark):
    r = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    long_ = [str(r.randint(0, 10**9)) for _ in range(300_000)]
    text = " ".join([*long_[:100_000], *passage, *long_[100_000:200_000], *passage, *long_[200_000:]])
    got = {x.doc_id: (x.n_words, x.n_removed) for x in substring_dedup(docs(spark, [(1, text), (2, " ".join(long_[5:300])), (3, "x" * 3_000_000)])).collect()}
    assert got == {1: (300_120, 60), 2: (295, 295), 3: (1, 0)}
