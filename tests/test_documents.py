"""Large JSON documents read in byte ranges, against the whole document parsed at once."""

import json
import random

import pytest

from walkgrid.sources import documents, files


def tree(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.4:
        return rng.choice([1, -2.5, None, True, "", "plain", 'a"b', "\\", '\\"', "{[", "]}", "é中😀", '"elements": [', "\\\\" * rng.randint(0, 5), "\n"])
    if kind < 0.7:
        return [tree(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["k", "elements", 'q"', "\\", "z{"]): tree(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def values(rows):
    return [json.loads(r["value"]) for r in sorted(rows, key=lambda r: (r["file"], r["position"]))]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_objects_of_any_nesting_at_any_cut(spark, tmp_path, size, monkeypatch):
    monkeypatch.setattr(documents, "MORE", 40)
    rng = random.Random(size)
    want = []
    for i in range(2):
        elements = [tree(rng) for _ in range(12)] + [{"i": i, "s": '}]"'}, 3, [{"no": 1}], {}]
        document = {"crs": {"deep": {"er": {}}}, "elements2": [{"not": "this"}], "elements": elements, "more": {"elements": [{"no": 2}]}, "tail": [{"no": 3}]}
        text = json.dumps(document, ensure_ascii=i == 0, indent=[None, 1][i])
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
        want += [e for e in elements if isinstance(e, dict)]
    if size < 64:  # one file is enough for so many ranges
        text = (tmp_path / "0.json").read_text(encoding="utf-8")
        want = [e for e in json.loads(text)["elements"] if isinstance(e, dict)]
        ranges = [documents.Range(str(tmp_path / "0.json"), a, min(a + size, len(text.encode()))) for a in range(0, len(text.encode()), size)]
        quoted, depth, wanted, got = False, 0, False, []
        for r in ranges:  # the states as a plain reader of one byte after the other would know them
            own = documents.Range(r.file, r.start, r.end, quoted, depth, wanted)
            file = documents.File(r.file)
            got += documents.elements_of(file, own, "elements")
            raw = file.read(r.start, r.end)
            quotes, _ = documents._marks(raw, file.escaped(r.start))
            brackets, depths = own.outside(raw, file.escaped(r.start))
            _, open_ = own.arrays(raw, file.read(r.start - 64, r.start), brackets, depths, "elements")
            quoted, depth, wanted = quoted ^ (len(quotes) % 2 == 1), int(depths[-1]) if len(depths) else depth, open_[-1] if open_ else wanted
        assert [json.loads(t) for _, t in got] == want
        return
    monkeypatch.undo()
    assert values(documents.read_array(spark, str(tmp_path), "elements", size).collect()) == want


def test_ranges_become_tasks(spark, tmp_path):
    rows = [{"id": i, "text": "{" * (i % 50) + '"' * (i % 7)} for i in range(30_000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text("")
    found = documents.read_array(spark, str(tmp_path), size=1 << 18)
    assert found.rdd.getNumPartitions() >= 5
    assert values(found.collect()) == rows
    used = found.selectExpr("spark_partition_id() as p").distinct().count()
    assert used >= 4
    assert documents.read_array(spark, str(tmp_path / "b.json"), "x").count() == 0


def test_a_document_that_ends_too_early_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"elements": [{"a": 1}, {"b": ')
    with pytest.raises(Exception, match="ends within"):
        documents.read_array(spark, str(tmp_path), "elements").collect()


def test_whole_and_split_readers_agree(spark, tmp_path):
    feature = lambda i: {"type": "Feature", "properties": {"NOM": f"n{i}", "TYPE": None}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i, 1]]]}}
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature(i) for i in range(50)]}, indent=2))
    read = lambda split: files.read_features(spark, str(tmp_path / "f.json"), "polygon", files.BOUNDARY_PROPERTIES, multiline=True, split=split).collect()
    assert sorted(read(1000)) == sorted(read(None)) and len(read(1000)) == 50
    (tmp_path / "e.json").write_text(json.dumps({"elements": [{"type": "node", "id": i, "lon": 1.5, "tags": {"a": "]"}} for i in range(9)]}))
    got = [files.read_elements(spark, str(tmp_path / "e.json"), multiline=True, split=s).orderBy("position").drop("position").collect() for s in (100, None)]
    assert got[0] == got[1] and len(got[0]) == 9
