import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from simtrail.llm import collocation
from simtrail.llm.queries import op11_collocation

SCHEMA = "doc_id long, text string, lang string, gram int, n string, rank int"


def brute(rows, least=10, top=2000, percent=50):
    """rows: (lang, text)."""
    counts = {}
    for lang, text in rows:
        c = counts.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                c.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, c in counts.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        found = []
        for p, a in c.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(100 * v >= percent * a for q, v in c.items() if len(q) == 3 and v >= least and p in (q[:2], q[1:])):
                continue
            cuts = [(10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def frame(spark, rows, parts=5):
    made = [(i, text, lang, 1, "x", 2) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def prose(rng, n_docs, words, weights, langs=("en", "de", None)):
    texts = []
    for _ in range(n_docs):
        some = rng.choices(words, weights, k=rng.randrange(0, 120))
        texts.append((rng.choice(langs), "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!? "]) for w in some)))
    return texts


def test_query_against_brute_force(spark, sf):
    t = pq.read_table(f"{sf}/documents.parquet")
    rows = list(zip(t["lang"].to_pylist(), t["text"].to_pylist(), strict=True))
    assert got(op11_collocation(spark, sf)) == brute(rows)


@pytest.mark.parametrize("run", [1, 50, collocation.RUN])
def test_random_prose_in_runs_of_any_size(spark, run):
    rng = random.Random(run)
    words = ["the", "The", "of", "a", "and\x01", "an", "and", "é", "日本", "x\x1cy", "\x00", "zz-top", "it's", "ende", "a\x01"]
    rows = prose(rng, 300, words, [30, 9, 12, 8, 5, 3, 6, 4, 2, 2, 2, 1, 1, 1, 3])
    df = frame(spark, rows)
    assert got(collocation.collocations(df, run=run)) == brute(rows)
    assert got(collocation.collocations(df, least=3, top=7, percent=80, run=run)) == brute(rows, 3, 7, 80)


def test_hot_phrase_and_copies(spark):
    """A third of all words in one phrase, copies of one text, one text much longer than the rest."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = prose(rng, 60, words, [1] * 60, ("en",))
    rows += [("en", "the hot phrase the hot phrase the hot end")] * 200
    rows += [("en", " ".join(rng.choices(words, k=9000)))]
    assert got(collocation.collocations(frame(spark, rows), run=700)) == brute(rows)


def test_edges(spark):
    odd = [
        ("en", None), ("en", ""), ("en", " \t ..,\n!"), (None, "a b " * 12), ("und", "a b " * 3), ("", "q r " * 11), ("x y%+", "k l m " * 15),
        ("a\tb", "same same " * 20), ("de", "ß" * 70000 + " lang " + "ß" * 70000), ("de", "eins"), ("fr", "UN\x0bdeux\x0cTrois Quatre\r" * 10),
    ]
    rows = odd + [("fr", "ÉT É " * 10)]
    assert got(collocation.collocations(frame(spark, rows))) == brute(rows)
    assert got(collocation.collocations(frame(spark, [("en", "one")]))) == set()
    empty = frame(spark, [("en", "x")]).limit(0)
    assert got(collocation.collocations(empty)) == set()


def test_numbers_beyond_64_bits():
    big = 3 * 10**12
    parts = [
        (b"en a b ", big, big + 7, None, None, False), (b"en a b ", big, big + 1, None, None, True),
    ]
    batch = collocation._parts(parts)
    found = [r for b in collocation._scored(50)(iter([batch])) for r in b.to_pylist()]
    assert found == [{"lang": "en", "phrase": "a b", "a": big, "l": big + 7, "r": big + 1,
                      "score": 10**6 * big * big // ((big + 7) * (big + 1))}]


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choices("abc \t.,\nÄ", k=4000)).encode()
    whole = [w for some in collocation.words_of(text) for w in some]
    monkeypatch.setattr(collocation, "SPAN", 17)
    assert [w for some in collocation.words_of(text) for w in some] == whole
