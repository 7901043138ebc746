import random
import re

import pytest

from sievemill.llm import licences
from tests.llm.helpers import docs


def brute_matches(text, template, seed):
    """Maximal matches (start, at, length) of two word lists."""
    out = set()
    for i in range(len(text)):
        for j in range(len(template)):
            if text[i] == template[j] and (i == 0 or j == 0 or text[i - 1] != template[j - 1]):
                n = 0
                while i + n < len(text) and j + n < len(template) and text[i + n] == template[j + n]:
                    n += 1
                if n >= seed:
                    out.add((i, j, n))
    return sorted(out)


@pytest.mark.parametrize("seed", range(8))
def test_automaton_gives_maximal_matches(seed):
    r = random.Random(seed)
    sequences = [[r.randint(0, 3) for _ in range(r.randint(1, 12))] for _ in range(5)]
    text = [r.randint(0, 4) for _ in range(60)]
    for least in (1, 2, 3):
        got = licences.SuffixAutomaton(sequences, least).matches(text)
        for t, sequence in enumerate(sequences):
            assert sorted((m.start, m.at, m.length) for m in got.get(t, [])) == brute_matches(text, sequence, least)


def brute_chains(matches, gap, need):
    """All chains, one by one; of those the ones that cover most, and do not overlap."""
    ordered, ends = sorted(matches), []

    def follow(k, covered, first):
        i, j, n = ordered[k]
        ends.append((-covered, first, i + n, k))
        for q in range(k + 1, len(ordered)):
            i2, j2, n2 = ordered[q]
            cut = max(0, i + n - i2, j + n - j2)
            if cut < n2 and i2 + cut - (i + n) <= gap:
                follow(q, covered + n2 - cut, first)

    for k, (i, _, n) in enumerate(ordered):
        follow(k, n, i)
    best = {}
    for e in sorted(ends):
        best.setdefault(e[3], e)  # one chain for each last match
    taken = []
    for n, first, end, _ in sorted(best.values()):
        if -n >= need and all(end <= a or b <= first for a, b, _ in taken):
            taken.append((first, end, -n))
    return sorted(taken)


@pytest.mark.parametrize("seed", range(40))
def test_chains_equal_brute_force(seed):
    r = random.Random(seed)
    template = [r.randint(0, 3) for _ in range(r.randint(4, 14))]
    text = []
    for _ in range(r.randint(1, 3)):  # copies with words put in, left out and changed
        for w in template:
            text += r.choice([[w]] * 8 + [[], [9], [w, 9], [r.randint(0, 3)]])
    scanner = licences.Scanner({"t": [" ".join(f"w{w}" for w in template)]}, {}, seed=2, gap=2, coverage=0.6)
    ids = scanner.numbers(next(licences.tb.chunks(licences.pa.array([" ".join(f"w{w}" for w in text)]), licences.tb.PUNCT)))
    want = brute_chains(brute_matches(text, template, 2), 2, 0.6 * len(template))
    assert [(first, last + 1, n) for _, first, last, n in scanner.spans(ids)] == want


def test_chain_survives_a_repeated_trigram(spark):
    df = docs(spark, [(1, "a b c q x a b c y"), (2, "a b c x a b c y"), (3, "a b c a b c"), (4, "a b c " * 20)])
    got = {r.doc_id: r for r in licences.license_scan(df, templates={"t": ["a b c x a b c y"]}, phrases={}).collect()}
    assert [(s.first, s.last, s.covered) for s in got[1].spans] == [(0, 8, 8)] and got[1].score == 1.0
    assert [(s.first, s.last, s.covered) for s in got[2].spans] == [(0, 7, 8)]
    assert got[3].spans == [] and got[3].labels == "" and got[4].spans == []


def test_whole_licences(spark):
    r = random.Random(1)
    rows, labels = [], []
    for label, texts in licences.TEMPLATES.items():
        words = max(texts, key=len).split()
        if len(words) < 40:
            continue
        for k in range(3):
            changed = [w if r.random() > 0.02 * k else r.choice(["some", "", f"{w} other"]) for w in words]
            rows.append((len(rows), " ".join(["Intro text."] * 5 + changed + ["and more"] * 50 + words)))
            labels.append(label)
    got = {x.doc_id: x for x in licences.license_scan(docs(spark, rows)).collect()}
    for i, label in enumerate(labels):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
        assert len([s for s in got[i].spans if s.label == label]) >= 2
    assert [x.label for x in got[0].spans] != []


def test_no_templates_no_phrases_and_long_texts(spark):
    df = docs(spark, [(1, "all rights reserved"), (2, None), (3, "word " * 400_000 + "all rights reserved " * 50_000)])
    none = {r.doc_id: r for r in licences.license_scan(df, templates={}, phrases={}).collect()}
    assert [(none[i].n_words, none[i].labels, none[i].n_base) for i in (1, 2, 3)] == [(3, "", 0), (0, "", 0), (550_000, "", 0)]
    some = {r.doc_id: r for r in licences.license_scan(df, templates={"e": ["", "..."]}).collect()}
    assert (some[3].n_base, some[3].first_word, some[3].last_word, some[3].labels) == (50_000, 400_000, 549_997, "reserved")
    assert len({r.doc_id: r for r in licences.license_scan(df).collect()}[3].spans) == 50_000


def brute_places(words):
    return sorted((i, label) for p, label in licences.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())


def test_query_equals_brute_force(spark):
    """Words, places and spans of the registered query on a whole test table."""
    from sievemill.llm.queries import queries
    from tests.conftest import SMALL

    cut = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    templates = [(label, [w.decode() for w in licences.words_of(t)]) for label, ts in licences.TEMPLATES.items() for t in ts]
    got = {r.doc_id: r for r in queries()["op10_license_scan"](spark, SMALL).collect()}
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    found = 0
    for i, text in texts:
        words = [w.decode() for w in cut.findall((text or "").encode().lower())]
        places = brute_places(words)
        base = sorted({label for _, label in places})
        more, score = set(base), 1.0 if places else 0.0
        near = [w for w in range(len(words)) if words[w] in {x for _, t in templates for x in t}]
        if near:
            low, high = near[0], near[-1] + 1
            for label, t in templates:
                for _, _, n in brute_chains_fast(brute_matches(words[low:high], t, 3), 4, 0.8 * len(t)):
                    more.add(label)
                    score = max(score, n / len(t))
        found += len(more)
        starts = [p for p, _ in places]
        g = got[i]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert (g.base_labels, g.labels, round(g.score, 9)) == (",".join(base), ",".join(sorted(more)), round(score, 9))
    assert found


def brute_chains_fast(matches, gap, need):
    return licences.chains([licences.Match(*m) for m in matches], gap, need)  # equal to all chains by the test above


def test_documents(spark):
    mit = licences.TEMPLATES["mit"][0]  # the notice
    rows = [
        (1, "Intro. All Rights  Reserved! CC-BY here"), (2, f"x {mit} y"), (3, None), (4, ""), (5, "general public\nlicense general-public-license"), (6, "all rights  and reserved"), (None, "cc by"),
        (7, "Permission is hereby granted free of charge to anyone person obtaining a copy of this software and associated documentation files"), (8, "ééall rights reserved"),
    ]
    got = {r.doc_id: r for r in licences.license_scan(docs(spark, rows)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (7, 2, 1, 4, "cc-by,reserved")
    assert got[2].base_labels == "" and got[2].labels == "mit" and got[2].score == 1.0 and (got[2].spans[0].first, got[2].spans[0].last) == (1, 5)
    assert (got[3].n_words, got[3].n_base, got[3].first_word, got[3].score, got[4].n_words) == (0, 0, None, 0.0, 0)
    assert (got[5].n_base, got[5].first_word, got[5].last_word) == (2, 0, 3)
    assert got[6].n_base == 0 and got[None].n_base == 1
    assert got[7].labels == "mit" and 0.8 <= got[7].score < 1  # one word differs: two matches in a chain
    assert got[8].n_base == 0  # letters beyond ASCII belong to words
    assert licences.license_scan(docs(spark, [])).count() == 0
