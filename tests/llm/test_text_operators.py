"""The text operators: whole queries against plain code, and the cases their docstrings define."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from brute import near_components, removed_repeats, roots, shingles
from compare import difference, oracle_connection
from pyspark.sql import functions as F

import corpus_pipeline
from walkgrid.llm import chat, common, decontam, graph, imatch, langid, licences, line_dedup, near_dedup, packing, paragraph_dedup, suffix_dedup
from walkgrid.llm.oracle import ORACLE
from walkgrid.llm.queries import QUERIES

LONG = " ".join(f"w{i * i % 977}" for i in range(400))
#: Nulls, empty and very long texts, ties and repeated rows; a column that is named like an output.
ODD = [
    (1, LONG, "en", "a", 5), (1, LONG, "en", "a", 5), (2, LONG.upper(), "en", "a", 5), (None, None, None, None, None), (3, None, "en", "a", None),
    (4, "", "en", None, 0), (5, " \n\t ", "fr", "b", 4), (6, "one two", "fr", "b", 7), (7, "x" * 300_000, None, "a", 1), (None, "null id " + LONG, "en", "b", 9),
    (8, "no letters 12".replace("no letters", "--"), "en", "b", 5), (9, "é" * 250 + " <|end|> \\[INST]</s>", "fr", "b", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, score long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def rows(sf_dir):
    return duckdb.sql(f"select doc_id, text, lang from '{sf_dir}/documents.parquet' order by 1").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, sf_dir):
    assert difference(QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), ORACLE[name]) is None


# 1


def test_decontamination_maps_spans_and_splits_into_blocks(spark, none, odd, monkeypatch):
    bench = spark.createDataFrame([(10, "Alpha, beta! Gamma-delta"), (9, "gamma delta"), (7, None), (8, "..."), (None, "zeta"), (9, "gamma delta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "é ALPHA beta (gamma) delta; eta zeta"), (2, "alpha beta"), (3, None)], "doc_id long, text string")
    plain = {r["doc_id"]: r for r in decontam.find_benchmark_text(docs, bench).collect()}
    assert (plain[1]["n_words"], plain[1]["n_hit"], plain[1]["item_ids"]) == (7, 5, ["10", "9"])
    assert [(s["start"], s["end"]) for s in plain[1]["spans"]] == [(2, 26), (32, 36)]
    assert (plain[2]["n_hit"], plain[3]["n_words"]) == (0, 0)
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 1)
    assert {r["doc_id"]: r for r in decontam.find_benchmark_text(docs, bench).collect()} == plain
    assert decontam.find_benchmark_text(odd, bench).count() == len(ODD)
    assert decontam.find_benchmark_text(none, bench).count() == 0 == decontam.find_benchmark_text(docs, bench.limit(0)).filter("n_hit > 0").count()


# 2


def test_fingerprints(spark, sf_dir, rows, odd, none):
    got = {r["doc_id"]: r for r in QUERIES["op2_fingerprint"](spark, sf_dir).collect()}
    for (d, t, _), (_, after, _) in zip(rows, rows[1:] + rows[:1], strict=True):
        q = len(t) // 4
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()
        assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
    of = {}
    for d, t, _ in rows:
        assert of.setdefault(t, got[d]["fingerprint"]) == got[d]["fingerprint"]
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.3 > 0.1 > mean("near_next")
    made = imatch.fingerprint_edits(odd).collect()
    assert len(made) == len(ODD) and {r["n_chars"] for r in made if r["doc_id"] in (3, 4)} == {0}
    assert imatch.fingerprint_edits(none).count() == 0


# 3


def test_line_dedup_counts_pages_of_a_host(spark, odd, none):
    docs = spark.createDataFrame([(i, f"menu\nown {i}\n\nmenu", "h") for i in range(6)] + [(10, "menu\nx", "g"), (11, None, "h")], "id long, text string, source string")
    got = {r["id"]: r for r in line_dedup.drop_boilerplate(docs, ratio=0.5, min_pages=3).collect()}
    assert (got[0]["kept_text"], got[0]["n_lines"], got[0]["n_dropped"]) == ("own 0\n", 4, 2)
    assert got[10]["kept_text"] == "menu\nx" and got[11]["kept_text"] is None and got[11]["n_lines"] == 0
    assert line_dedup.drop_boilerplate(odd).count() == len(ODD) and line_dedup.drop_boilerplate(none).count() == 0


def test_line_dedup_splits_a_hot_host_and_keeps_columns(spark, monkeypatch):
    """With salts a hot host's pages meet its lines in many tasks; columns that clash with inner names stay."""
    rows = [(i, f"menu\nown {i}", "hot" if i % 3 else f"h{i % 5}", i, "x") for i in range(600)]
    docs = spark.createDataFrame(rows, "id long, text string, source string, found long, host_key string").withColumn("salt", F.col("id")).withColumn("_kept", F.lit(1))
    plain = line_dedup.drop_boilerplate(docs, ratio=0.5)
    monkeypatch.setattr(line_dedup, "LINES", 0)
    salted = line_dedup.drop_boilerplate(docs, ratio=0.5)
    assert sorted(plain.collect()) == sorted(salted.collect()) and set(docs.columns) < set(salted.columns)
    assert {r["kept_text"] for r in salted.collect()} == {f"own {i}" for i in range(600)}
    parts = docs.filter("source = 'hot'").groupBy(F.pmod(F.xxhash64("text"), F.lit(line_dedup.SALTS))).count().agg(F.max("count")).first()[0]
    assert parts < 400 / 8


# 4


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("bucket", [2048, 1])
def test_suffix_dedup(spark, sf_dir, rows, keep_first, bucket, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    some = [(d, t) for d, t, _ in rows][:120] + [(9000, "ab" * 700), (9001, "z" * 500), (9002, None), (9003, "")]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in suffix_dedup.remove_repeats(docs, keep_first=keep_first).collect()}
    assert got == removed_repeats(some, keep_first)


def test_suffix_dedup_odd(odd, none):
    got = suffix_dedup.remove_repeats(odd, keep_first=False).collect()
    assert len(got) == len(ODD) and all(r["n_removed"] == len(LONG) for r in got if r["doc_id"] == 1)
    assert suffix_dedup.remove_repeats(none).count() == 0


# 5


def test_packing(spark, sf_dir, rows):
    encode = packing.Encoder(packing.tokenizer_path())
    got = [r.asDict() for r in QUERIES["op5_pack"](spark, sf_dir).collect()]
    total = 0
    for d, t, _ in rows:
        own = sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["piece"])
        ids = np.array([*encode.whole.encode(t, add_special_tokens=False).ids, 0], "<u4")
        n = len(ids)
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own]
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == n and all(r["length"] == 2048 for r in own[1:])
        total += n
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert len(by) <= -(-total // 2048) + 1


def test_encoder_gives_the_tokenizers_ids():
    encode = packing.Encoder(packing.tokenizer_path())
    for t in ("a<|endoftext|>b", "  x\n\n y ", "it's 12²½  x", "日本 語 😀  ok\x1c\x85z", "I'll'd've'RE 'd", LONG, "\n\n a \n", " "):
        assert encode(t) == b"".join(i.to_bytes(4, "little") for i in encode.whole.encode(t, add_special_tokens=False).ids)


def test_local_search_beats_best_fit():
    assert len(packing.pack_lengths([6, 5, 4, 4, 4, 3, 2, 2], 10)) == 3
    rng = random.Random(5)
    for _ in range(30):
        sizes = [rng.randint(1, 60) for _ in range(80)]
        bins = packing.pack_lengths(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(80)) and all(sum(sizes[i] for i in b) <= 100 for b in bins)
        assert len(bins) <= -(-sum(sizes) // 100) + 1


def test_packing_odd(odd, none, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 3)
    assert sum(1 for r in packing.pack_documents(odd).collect() if r["piece"] == 0) == len(ODD)
    assert packing.pack_documents(none).count() == 0


def test_repeated_rows_are_dealt_and_clashing_names_stay(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    seen = []
    deal = packing._packer
    monkeypatch.setattr(packing, "_packer", lambda *a: seen.append(a[3]) or deal(*a))
    same = spark.range(600).select(F.lit(1).alias("group"), F.lit("x").alias("open"), F.lit(2).alias("row"), F.lit(700).alias("length"))
    got = packing.pack(same, 2048)
    assert set(got.columns) == {"group", "open", "row", "length", "sequence_id", "offset"} and got.count() == 600
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert got.groupBy(F.shiftright("sequence_id", 24)).count().agg(F.max("count")).first()[0] < 150  # of each group its share


def test_search_goes_on_past_a_bin_that_withstands():
    rng = random.Random(3)
    lengths = [rng.randint(400, 1000) for _ in range(600)]
    bins = packing.pack_lengths(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(600)) and all(sum(lengths[i] for i in b) <= 2048 for b in bins)


# 6


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\\\<|end|>\n", "<", "[", "a\\<|b", "<<SYS>>x<</SYS>>", "", None, "[\\INST]", "<|user|>\n"]
    turns = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)] + [(2, 0, "tool", "x|>\n"), (2, 1, None, "y"), (3, 0, "system", "s"), (3, 1, "assistant", "a"), (None, None, "user", "n"), (None, None, "user", "n")]
    made = chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in made.withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    assert [(b["role"], b["text"]) for b in got[1]["back"]] == [(r, t or "") for _, _, r, t in turns[: len(texts)]]
    assert got[1]["loss"] == "".join(t or "" for t in texts[1::2]) and got[1]["valid"] and not got[1]["complete"]
    assert [(b["role"], b["text"]) for b in got[2]["back"]] == [("tool", "x|>\n"), ("", "y")] and not got[2]["valid"]
    assert not got[3]["valid"] and len(got[None]["back"]) == 2
    assert "".join(s["text"] for s in got[1]["segments"]) == got[1]["formatted"]
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# 7


@pytest.mark.parametrize("block", [(1 << 19, 1 << 16), (600, 300)])
def test_near_duplicates(spark, rows, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block[0])
    monkeypatch.setattr(near_dedup, "PIVOTS", block[1])
    rng = random.Random(3)
    base = [f"u{rng.randrange(5000)}" for _ in range(150)]
    family = [(5000 + i, " ".join(w if rng.random() > 0.012 else f"n{rng.randrange(9)}" for w in base)) for i in range(40)]
    some = [(d, t) for d, t, _ in rows] + family + [(9000, None), (9001, ""), (9002, "one two"), (9003, "ONE  two")]
    got = near_dedup.near_duplicates(spark.createDataFrame(some, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_components(some)


def test_common_passage_makes_no_cluster(spark):
    """Thousands of documents share a passage that makes them half alike: none is linked, so none needs comparing; planted pairs of
    likeness just above the bound among them are all found."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**9)}"
    passage = [word() for _ in range(110)]
    docs = [(i, [*passage, *(word() for _ in range(60))]) for i in range(3000)]
    for i in range(60):
        text = list(docs[i * 7][1])
        for k in rng.sample(range(len(text)), 4):  # each changed word changes five shingles
            text[k] = word()
        docs.append((10_000 + i, text))
    rows = [(d, " ".join(t)) for d, t in docs]
    some = {d: shingles(t) for d, t in rows}
    alike = lambda a, b: len(some[a] & some[b]) / len(some[a] | some[b])
    assert 0.45 < alike(1, 2) < 0.5 and sum(alike(i * 7, 10_000 + i) >= 0.75 for i in range(60)) > 50
    signed = near_dedup.signed(spark.createDataFrame(rows, "doc_id long, text string"), "text")
    asked = []
    labels = near_dedup.links(signed.select("node", "sig", "n_shingles"), lambda nodes: asked.append(nodes.count()) or signed.join(nodes, "node").select("node", "text"))
    of = {r["node"]: r["doc_id"] for r in signed.collect()}
    pairs = {}
    for r in labels.collect():
        pairs.setdefault(r["component"], []).append(of[r["node"]])
    want = sorted((i * 7, 10_000 + i) for i in range(60) if 100 * len(some[i * 7] & some[10_000 + i]) >= 75 * len(some[i * 7] | some[10_000 + i]))
    assert sorted(tuple(sorted(p)) for p in pairs.values()) == want
    assert asked[0] < 400  # of 3,060 texts; the clusters are the pairs and a few more


def test_long_texts_are_signed_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(50)}" * rng.randint(1, 3) for _ in range(3000)).encode()
    whole = common.text_shingles(text)
    monkeypatch.setattr(common, "_PIECE", 100)
    assert (common.text_shingles(text) == whole).all() and (common.words(text)[1] == common._words(text)[1]).all()
    for short in (b"", b" ", b"a b", b"x" * 1000 + b" y", b"a " * 300):
        assert (common.text_shingles(short) == common.shingle_hashes(common._words(short)[0])).all()
    sets = np.arange(1, 1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert (near_dedup.signature(sets) == np.array([((sets * s).min() >> np.uint64(32)) for s in near_dedup._SEEDS], np.uint32)).all()


def test_short_texts_are_hashed_together(monkeypatch):
    """Paragraphs and shingles of many texts at once are those of each alone, and a batch takes few passes over its words, not one a text."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)] + ["End.", "what?", "x\n", "\n\n", "É", "Stop!"]
    texts = [" ".join(rng.choices(words, k=rng.choice((0, 1, 4, 5, 12, 90)))) for _ in range(600)]
    texts = [t.encode() for t in ["", " ", "\n", "a", "a b c d", *texts, "w1 " * 300, ""]]
    many = paragraph_dedup.paragraphs_of(texts)
    for i, text in enumerate(texts):
        own, start, stop, _, _, n = paragraph_dedup.paragraphs(text)
        here = many[5] == i
        assert (many[0][here] == own).all() and (many[1][here] == start).all() and (many[2][here] == stop).all() and many[6][i] == n
    for got, text in zip(common.shingle_sets([None, *texts]), [b"", *texts], strict=True):
        want = common.shingle_hashes(common._words(text)[0])
        assert got.dtype == want.dtype and len(got) == len(want) and (got == want).all()

    passes, hashed = [], common._words
    monkeypatch.setattr(common, "_words", lambda text: passes.append(len(text)) or hashed(text))
    rows = pa.RecordBatch.from_pydict({"k2": range(len(texts)), "k1": range(len(texts)), "text": [t.decode() for t in texts]})
    for step in (paragraph_dedup._places, paragraph_dedup._banded):
        list(step([rows]))
    pairs = pa.RecordBatch.from_pydict({"a": range(len(texts)), "b": range(len(texts)), "xa": texts, "xb": texts[::-1]})
    list(paragraph_dedup._loosely_alike([pairs]))
    assert len(passes) < 20  # 600 a step, if text by text


def test_near_duplicates_odd(odd, none):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    kept = [r["doc_id"] for r in near_dedup.drop_near_duplicates(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, None, 3, 4, 5, 6, 7, 8, 9], key=str)
    assert near_dedup.near_duplicates(none).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert got == roots({n for e in real for n in e}, real)


# 8


def test_licences(spark, odd, none):
    mit = licences.TEXTS["MIT"].replace("<year> <copyright holders>", "2024 Some One").replace("\n\n", "\n  \n").upper()
    docs = spark.createDataFrame([(1, mit), (2, "x\nlicenced under  CC-BY 4.0\nLicensed under the MIT License.\nno licence"), (3, mit + " more"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    assert got[1]["licence"] == "MIT" and got[3]["licence"] is None and got[4]["canonical_sha256"] is None
    assert (got[2]["n_notices"], got[2]["licences"]) == (2, ["CC-BY-4.0", "MIT"])
    assert licences.scan(odd).count() == len(ODD) and licences.scan(none).count() == 0
    known = spark.createDataFrame([("CC0-1.0", "CC0 1.0 Universal"), ("X", "Some Licence\nof two lines"), ("Y", None)], "licence string, text string")
    docs = spark.createDataFrame([(1, "a\n cc0 1.0  UNIVERSAL!\n"), (2, "some license: of two lines"), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["licence"], r["licences"]) for r in licences.scan(docs, known).collect()}
    assert got == {1: (None, ["CC0-1.0"]), 2: ("X", ["X"]), 3: (None, [])}


# 9


def test_paragraph_dedup(spark, rows, odd, none):
    some = [(d, t) for d, t, _ in rows[:150]]
    cut = [(d, t.encode()[a:b].decode(), a) for d, t in some for a, b in zip(*paragraph_dedup.paragraphs(t.encode())[1:3], strict=True)]
    names = {}
    for _, p, _ in cut:
        names.setdefault(tuple(p.lower().split()), len(names))
    sets = {i: shingles(" ".join(w)) for w, i in names.items()}
    both = Counter()
    at = {}
    for i, s in sets.items():
        for x in s:
            both.update((j, i) for j in at.setdefault(x, []))
            at[x].append(i)
    group = roots(names.values(), [e for e, n in both.items() if 100 * n >= 75 * (len(sets[e[0]]) + len(sets[e[1]]) - n)])
    of = [(d, group[names[tuple(p.lower().split())]]) for d, p, _ in cut]
    size = Counter(g for _, g in of)
    seen, want = set(), Counter()
    for d, g in of:
        want[d] += g in seen
        seen.add(g)
    repeated = Counter(d for d, g in of if size[g] > 1)
    got = paragraph_dedup.remove_repeated_paragraphs(spark.createDataFrame(some, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_repeated"], r["n_removed"]) for r in got} == {d: (repeated[d], want[d]) for d, _ in some}
    assert paragraph_dedup.remove_repeated_paragraphs(odd).count() == len(ODD) and paragraph_dedup.remove_repeated_paragraphs(none).count() == 0


def test_families_of_near_paragraphs_are_found_whole(spark):
    """Copies of 60 words with a few of them replaced: of all linked paragraphs nearly all are in one group with a linked one."""
    rng = random.Random(9)
    found = linked = 0
    for share in (0.02, 0.03, 0.05):
        base = [f"b{rng.randrange(10**6)}" for _ in range(60)]
        family = [" ".join(w if rng.random() > share else f"n{rng.randrange(50)}" for w in base) for _ in range(400)]
        rest = [" ".join(f"r{rng.randrange(300)}" for _ in range(60)) for _ in range(100)]
        texts = family + rest
        sets = [shingles(t) for t in texts]
        at, both = {}, Counter()
        for i, s in enumerate(sets):
            for x in s:
                both.update((j, i) for j in at.setdefault(x, []))
                at[x].append(i)
        edges = [e for e, n in both.items() if 100 * n >= 75 * (len(sets[e[0]]) + len(sets[e[1]]) - n)]
        group = roots(range(len(texts)), edges)
        size = Counter(group.values())
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: r["n_repeated"] for r in paragraph_dedup.remove_repeated_paragraphs(docs).collect()}
        linked += sum(size[g] > 1 for g in group.values())
        found += sum(size[g] > 1 and got[i] == 1 for i, g in group.items())
        assert not any(got[i] for i, g in group.items() if size[g] == 1)
    assert linked > 600 and found >= 0.98 * linked


def test_paragraphs_that_meet_only_in_crowded_bands_are_linked(spark):
    """Pairs of likeness 0.75 among hundreds that share 40 of 60 words (likeness 0.47) and their bands: all that meet are found."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(40)]
    texts = []
    for i in range(200):
        own = [f"o{rng.randrange(10**7)}" for _ in range(20)]
        texts += [" ".join(common + own), " ".join(common + own[:12] + [f"x{i}x{k}" for k in range(8)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bands = {}
    for batch in paragraph_dedup._banded([pa.RecordBatch.from_pydict({"text": texts})]):
        for band, h in zip(*batch.to_pydict().values(), strict=True):
            bands.setdefault(h, set()).add(band)
    node = [int(paragraph_dedup.paragraphs(t.encode())[0].view("int64")[0]) for t in texts]
    meet = {i for i in range(0, len(texts), 2) if bands[node[i]] & bands[node[i + 1]]}
    got = {r["doc_id"]: r["n_removed"] for r in paragraph_dedup.remove_repeated_paragraphs(docs).collect()}
    assert len(meet) > 190
    assert all(got[i] + got[i + 1] == 1 for i in meet)


# 10


def test_language_of_held_out_documents(spark, sf_dir, rows, odd, none):
    got = {r["doc_id"]: r for r in QUERIES["op10_language"](spark, sf_dir).collect()}
    lang = {d: la for d, _, la in rows}
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.95 * len(out) and all(0 <= r["score"] <= 1 for r in got.values())
    model = langid.fit(odd)
    found = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["rejected"] and found[i]["score"] == 0 for i in (3, 4, 5, 8))
    assert langid.fit(none) is None and {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


# pipeline


def test_pipeline_stages_keep_their_promises(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = oracle_connection(sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, sf_dir).cache()
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == corpus_pipeline.COLUMNS and set(after) <= set(before)
        if name == "language":
            assert len(after) > 0.98 * len(before)
        if name == "near_dedup":
            assert set(after) == {c for _, c in near_components([(d, r["text"]) for d, r in before.items()]).values()}
        if name == "decontaminate":
            hit = {r[0] for r in con.execute(f"select doc_id from ({ORACLE['op1_decontaminate']}) where contaminated").fetchall()}
            assert {d for d in before if before[d]["text"] == texts[d]} - set(after) == {d for d in hit if d in before and before[d]["text"] == texts[d]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(after)


def test_nothing_else_imports_the_text_operators():
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    others = [p for p in (root / "walkgrid").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in others if re.search(r"walkgrid\.llm|corpus_pipeline", p.read_text())] and json.dumps(len(others))
