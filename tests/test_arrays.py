"""Arrays in any layout, cut over tasks, against reading each file as one text."""

import json
import random

import pytest
from pyspark.sql import functions as F

from moonstride.sources import landing
from moonstride.sources.arrays import array_elements

SCHEMA = "array<struct<id: bigint, name: string, part: struct<a: array<bigint>>>>"
ODD_NAMES = ['}', '{"', 'a\\', '\\"}', "[]", '"', "x},{", "é \U0001f600", "\\\\", ",", "", "]}"]


def records(n, seed=0):
    rng = random.Random(seed)
    return [{"id": i, "name": rng.choice(ODD_NAMES), "part": {"a": [i, {"b": {}}][: rng.randrange(3)]}, "more": [{}, [{"c": "}"}]]} for i in range(n)]


@pytest.fixture
def small_chunks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield use
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def compare(spark, folder, texts):
    """Same records and same sound files by both ways."""
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.json").write_text(text)
    paths = [str(folder / f"{i}.json") for i in range(len(texts))]
    found = array_elements(spark, paths).select("value", F.col("_file").alias("file"))
    plain = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    out = []
    for parts in (found, plain):
        read = parts.select("file", landing._is_array(F.col("value")).alias("ok"), F.from_json("value", SCHEMA).alias("r"))
        rows = {}
        for row in read.collect():
            ok, ids = rows.get(row.file, (True, []))
            ids = ids + [(r.id, r.name, r.part and r.part.a) for r in row.r or [] if r is not None]
            rows[row.file] = (ok and row.ok, ids)
        out.append({f.rsplit("/", 1)[1]: (ok, sorted(ids, key=str) if ok else None) for f, (ok, ids) in rows.items() if ok or texts[int(f.rsplit("/", 1)[1][:-5])].strip()})
    assert out[0] == out[1]
    return out[0]


@pytest.mark.parametrize("size", [7, 40, 173])
def test_any_layout_and_any_chunk(spark, tmp_path, small_chunks, size):
    data = records(9, size)
    texts = [json.dumps(data), json.dumps(data, indent=1), json.dumps(data, ensure_ascii=False, separators=(",", ":")), json.dumps(data, indent=4)]
    texts += ["[]", " [ ] ", "[1, 2]", "\n" + json.dumps(data[:1]) + " \n\n", "[{}]", "[{},{}]"]
    small_chunks(size)
    got = compare(spark, tmp_path / "a", texts)
    assert all(ok for ok, _ in got.values()) and len(got) == len(texts)
    assert len(got["0.json"][1]) == 9


def test_an_array_of_other_things_is_named(spark, tmp_path, small_chunks):
    data = records(3)
    (tmp_path / "a.json").write_text(json.dumps([1, data[0], "}", data[1]]))
    (tmp_path / "b.json").write_text(json.dumps([data[0], None, data[1], None]))
    small_chunks(30)
    landed = landing.land(spark, str(tmp_path), "id bigint, name string")
    assert sorted((r.id, r.name) for r in landed.records.collect()) == sorted((r["id"], r["name"]) for r in data[:2])
    assert [f.sound for f in landed.files] == [f.sound for f in landing.landing_files(spark, str(tmp_path))] == [False, True]


def test_damaged_anywhere(spark, tmp_path, small_chunks):
    text = json.dumps([{"id": 1, "name": "}{", "part": {"a": [1]}}, {"id": 2, "name": "a\\"}])
    places = [i for i, c in enumerate(text) if c in '{}[]",:\\']
    texts = [text[:i] + text[i + 1 :] for i in places] + [text[:i] + text[i] * 2 + text[i + 1 :] for i in places]
    texts += [text + "}", "}" + text, text + text, text + "," + text, "[" + text, text + "]", text[:-1] + ",]", "[," + text[1:], text + "x", "[}", "}", "{}", "]["]
    texts += [text[:i] for i in range(1, len(text), 4)]
    small_chunks(16)
    got = compare(spark, tmp_path / "b", texts)
    assert sum(ok for ok, _ in got.values()) < 15


def test_one_line_is_read_by_many_tasks(spark, tmp_path, small_chunks, monkeypatch):
    monkeypatch.setattr(landing, "LONGEST_LINE", 1000)
    data = [{"id": i, "name": "}" * (i % 5)} for i in range(3000)]
    (tmp_path / "one.json").write_text(json.dumps(data))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in data[:5]))
    (tmp_path / "cut.json").write_text(json.dumps(data)[:-5])
    small_chunks(8192)
    files = {f.path.rsplit("/", 1)[1]: (f.form, f.sound) for f in landing.landing_files(spark, str(tmp_path))}
    assert files == {"one.json": ("array", True), "lines.json": ("lines", True), "cut.json": ("array", False)}
    elements = array_elements(spark, [f"{tmp_path}/one.json"])
    assert elements.count() == 3001  # each record, and the bracket at the end
    assert spark.read.option("lineSep", "}").text(f"{tmp_path}/one.json").rdd.getNumPartitions() > 8
    got = landing.read_landing(spark, str(tmp_path), "id bigint, name string")
    want = [(r["id"], r["name"]) for r in data] + [(r["id"], r["name"]) for r in data[:5]]
    assert sorted((r.id, r.name) for r in got.collect()) == sorted(want)


def test_json_is_parsed_once_for_all_readings(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    landed = landing.land(spark, str(tmp_path), "id bigint", origin=True)
    plan = landed.records._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "lineSep" not in plan
    assert sorted(r.id for r in landed.records.collect()) == [1, 2]
