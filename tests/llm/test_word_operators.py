"""Spelling variants, periodic runs and toxicity: whole queries against plain code, and the cases their docstrings define."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from walkgrid.llm import periodic, spelling, toxicity
from walkgrid.llm.queries import QUERIES

LONG = " ".join(f"w{i * i % 977}" for i in range(400))
ODD = [
    (1, LONG, "en", "a", 5), (1, LONG, "en", "a", 5), (2, LONG.upper(), "en", "a", 5), (None, None, None, None, None), (3, None, "en", "a", None),
    (4, "", "en", None, 0), (5, " \n\t ", "fr", "b", 4), (7, "x" * 300_000, None, "a", 1), (None, "tick tock " * 200_000, "en", "b", 9),
    (8, "-- 12", "en", "b", 5), (9, "é" * 250 + " Œ中😀 colour colours colour colour colour colours colours", "fr", "b", 5),
]
#: With columns that are named like outputs and inner columns.
SCHEMA = "doc_id long, text string, word string, runs string, score long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def rows(sf_dir):
    return duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet' order by 1").fetchall()


# 11


def plain_counts(rows, noise):
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def plain_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(count):
    near = {w: [] for w in count}
    by = {}
    for w in count:
        for i in range(len(w) + 1):
            by.setdefault((w[:i], w[i:]), []).append(w)  # not of the operator's method: all words that share a cut or one with a gap
            if i < len(w):
                by.setdefault((w[:i], w[i + 1 :]), []).append(w)
    for group in by.values():
        for a in group:
            near[a] += [b for b in group if plain_near(a, b)]
    form = {}
    for w, found in near.items():
        near[w] = set(found)
        best = min(found, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, count[w], len(near[w]), form[w], count.get(form[w]), root))
    return out


def test_spelling_query(spark, sf_dir, rows):
    got = QUERIES["op11_spelling"](spark, sf_dir).select("word", "n", "n_near", "form", "form_n", "root").collect()
    want = plain_variants(plain_counts(rows, 97))
    assert len(got) == len(want) and set(map(tuple, got)) == want and any(r["form"] for r in got)


@pytest.mark.parametrize("sizes", [(40_000, 100_000), (5, 3)])
def test_variants_in_parts_and_blocks(spark, sizes, monkeypatch):
    monkeypatch.setattr(spelling, "PART", sizes[0])
    monkeypatch.setattr(spelling, "BLOCK", sizes[1])
    monkeypatch.setattr(spelling, "PAIRS", 50)
    rng = random.Random(4)
    words = {"".join(rng.choice("eentaéèzk") for _ in range(rng.randint(5, 7))) for _ in range(700)}
    words |= {"long" * 30, "long" * 30 + "e", "long" * 29 + "lung", "e" * 300, "e" * 301, "e" * 299 + "n"}
    count = {w: rng.randint(3, 60) for w in words} | {"chain": 3, "chaine": 6, "chainee": 12, "chaineee": 24}
    got = spelling.group_variants(spark.createDataFrame(list(count.items()), "word string, n long")).collect()
    assert len(got) == len(count) and {tuple(r) for r in got} == plain_variants(count)


def test_word_counts_of_odd_texts(spark, odd, none, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 40)
    monkeypatch.setattr(spelling, "HELD", 2)
    got = {r["word"]: r["n"] for r in spelling.word_counts(odd, noise=3).collect()}
    assert got == plain_counts([(d, t) for d, t, *_ in ODD if d is not None], 3)  # the null id's words are shorter
    plain = {r["word"]: r["n"] for r in spelling.word_counts(odd, shortest=1, least=1).collect()}
    assert (plain["colour"], plain["colours"], plain["tock"], plain["x" * 300_000], plain["é" * 250]) == (4, 3, 200_000, 1, 1)
    assert spelling.group_variants(spelling.word_counts(none)).count() == 0


# 12


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(d, words):
    n, h = len(words), zlib.crc32(str(d).encode())
    if d is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_row(d, text):
    words = looped(d, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (d, len(runs), *best, best[1] and 1000 * best[1] // best[2], digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(kept), len(words))


def test_run_query(spark, sf_dir, rows):
    got = QUERIES["op12_runs"](spark, sf_dir).collect()
    want = {plain_row(d, t) for d, t in rows}
    assert len(got) == len(rows) and {tuple(r) for r in got} == want and sum(r["n_runs"] for r in got) > 5


def test_runs_of_short_alphabets():
    rng, texts = random.Random(7), []
    for _ in range(600):
        n, k = rng.randint(0, 60), rng.randint(1, 4)
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        texts.append(words)
    assert periodic.repetitions(texts) == [plain_runs(w) for w in texts]
    fib = ["a", "b"]
    for _ in range(12):
        fib.append(fib[-1] + fib[-2])
    every = {(s, m, p) for s, m, p in periodic.runs_of(np.array([ord(c) - 97 for c in fib[9]])).tolist()}
    assert len(every) > 20 and all(m >= 2 * p for _, m, p in every)  # a Fibonacci word is full of squares, none has exponent 4
    assert periodic.repetitions([list(fib[9])]) == [[]]


def test_runs_of_odd_texts(spark, odd, none, monkeypatch):
    monkeypatch.setattr(periodic, "SLICE_BYTES", 1)
    got = periodic.find_runs(odd).collect()
    assert len(got) == len(ODD) and got[0].asDict().keys() == {*odd.columns, "n_words", "collapsed_text"}
    by = Counter((r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed_text"][:9]) for r in got)
    assert by[(None, 400_000, 1, "tick tock")] == by[(None, 0, 0, "")] == by[(4, 0, 0, "")] == 1 and by[(1, 400, 0, LONG[:9])] == 2
    assert next(tuple(r["runs"][0]) for r in got if r["n_words"] == 400_000) == (0, 400_000, 2)
    assert periodic.find_runs(none).count() == 0 == periodic.with_loops(none).count()


# 13


def test_folding():
    assert toxicity.fold("Ｉd1οt, 1D10T! idi​ot trа$h 42 4th ẃord RÉ") == ["idiot", "idiot", "idiot", "trash", "ath", "word", "ré"]


def test_lexicon_weights_stems_and_exceptions():
    lexicon = toxicity.Lexicon({" idiot ": 3.0, " idio": 1.0, " scum": 2.0}, [" white scum ", " scummery "])
    found = lambda t: [(a, w) for a, w in toxicity.hits(lexicon.automaton(), f" {' '.join(toxicity.fold(t))} ")]
    assert found("an idiot") == [(3, 3.0)] and found("idioms") == [(0, 1.0)] and found("SCUMMY sc0m") == [(0, 2.0)]
    assert found("white scum, scummery") == [] and found("white scum scum") == [(11, 2.0)]
    kept = toxicity.closed_patterns([(" tra", 5.0, 20), (" trash", 5.0, 20), (" trash ", 4.9, 18), (" low", 4.0, 30), (" lowe", 4.1, 29), (" lowei ", 4.0, 3)])
    assert kept == {" trash": 5.0, " lowe": 4.1}


def test_toxicity_of_held_out_documents(spark, rows, sf_dir):
    sf = "/root/testdata/sf0.1"  # the smaller tables hold out six toxic documents or fewer
    got = {r["doc_id"]: r for r in QUERIES["op13_toxicity"](spark, sf).collect()}
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    out = [(toxic[d], r["predicted"]) for d, r in got.items() if r["held_out"] and d in toxic]
    hit = Counter(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert hit[(1, 1)] >= 0.9 * (hit[(1, 1)] + hit[(1, 0)]) and hit[(0, 1)] <= 0.02 * (hit[(0, 0)] + hit[(0, 1)])


def test_lexicon_of_planted_words(spark, none):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rest = [word() for _ in range(200)]
    text = lambda *extra: " ".join([*rng.choices(rest, k=40), *extra, *rng.choices(rest, k=40)])
    docs = [(i, text(f"zorkel{rng.choice('xyz')}", rng.choice(["vile", "nasty fish"]))) for i in range(60)] + [(100 + i, text("nasty storm") if i % 2 else text()) for i in range(120)]
    docs += [(300, None), (301, ""), (302, text("Z0RKELX", "vilе")), (303, text("nasty storm")), (304, text("zorkels vile")), (304, text("zorkels vile"))]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as words", "3 as total")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(220)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(table, labels)
    got = toxicity.score(table, lexicon)
    assert set(got.columns) == {"doc_id", "text", "words", "total", "n_matched", "score"}
    scores = {}
    for r in got.collect():
        scores.setdefault(r["doc_id"], set()).add((r["n_matched"], r["score"] >= 0.5))
    assert {scores[d].copy().pop()[1] for d in range(60)} == {True} and {scores[d].copy().pop()[1] for d in [*range(100, 220), 300, 301, 303]} == {False}
    assert scores[302] == {(2, True)} and scores[304] == {(2, True)} and len(docs) == got.count()
    assert toxicity.learn(table, labels.limit(0)) is None and toxicity.learn(none, labels) is None
    assert {(r["n_matched"], r["score"]) for r in toxicity.score(table, None).collect()} == {(0, 0.0)} and toxicity.score(none, lexicon).count() == 0


def test_toxicity_of_odd_texts(odd, monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 50)
    lexicon = toxicity.Lexicon({" colour": 2.0, " tock": 1.0})
    got = {(r["doc_id"], r["n_matched"]) for r in toxicity.score(odd, lexicon).collect()}
    assert (9, 7) in got and (None, 200_000) in got and (None, 0) in got and (4, 0) in got
