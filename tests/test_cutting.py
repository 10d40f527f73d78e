"""Records cut from blocks of files: any cut of a file into blocks gives the records of the whole file."""

import csv
import gzip
import io
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import example, given, settings, strategies as st

from heliolake.sources import cutting as C, files as FS


def fragments(data: bytes, separator: bytes, bounds: list[int]) -> pa.RecordBatch:
    """As a line reader deals them: a fragment belongs to the block in which it begins (or whose end it touches)."""
    rows, at, edges = [], 0, [0, *bounds]
    for piece in data.split(separator):
        if at < len(data) or not data:
            block = max(e for e in edges if e < at or e == 0)
            rows.append({"value": piece, "path": "f", "block": block, "last": block == edges[-1], "size": len(data)})
        at += len(piece) + 1
    schema = pa.schema([("value", pa.binary()), ("path", pa.string()), ("block", pa.int64()), ("last", pa.bool_()), ("size", pa.int64())])
    return pa.RecordBatch.from_pylist(rows if data else [], schema=schema)


class Known:
    def __init__(self, value):
        self.value = value


def records(data: bytes, kind: str, bounds: list[int] = (), batch: int = 3) -> list[tuple[bytes, bool]]:
    if kind == "csv":
        return records_at(data, kind, b"\n", bounds, batch)
    found = records_at(data, kind, b"}", bounds, batch)
    assert found == records_at(data, kind, b",", bounds, batch)
    return found


def records_at(data, kind, separator, bounds, batch):
    # a block without a fragment of its own gives no rows; the last one with rows then stands for the end in the test only
    table = fragments(data, separator, sorted(bounds))
    used = sorted(set(table.column("block").to_pylist()))
    if used:
        last = [b == used[-1] for b in table.column("block").to_pylist()]
        table = table.set_column(3, "last", pa.array(last))
    batches = [table.slice(i, batch) for i in range(0, table.num_rows, batch)]
    known = None
    if len(used) > 1:
        summaries = pa.Table.from_batches(list(C._summarise(kind, separator)(iter(batches))), schema=C._SUMMARY)
        known = Known({(r["path"], r["block"]): C.State(r["mode"], r["inside"], r["depth"], r["tail_lines"], r["separator"]) for r in C.block_states(summaries, separator).to_pylist()})
    out, open_text = [], None
    for b in C._cut(kind, separator, known)(iter(batches)):
        for r in b.to_pylist():
            open_text = r["text"] if r["starts"] else open_text + r["text"]
            if r["ends"]:
                out.append((open_text, r["line"]))
    return [(t.strip(b" \t\r\n"), line) for t, line in out if t.strip(b" \t\r\n")]


values = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-99, 99), st.text('ab",[]{}:\\\n é', max_size=8)),
                      lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(st.text('k,"\\', max_size=3), v, max_size=3)), max_leaves=8)


@settings(max_examples=int(os.environ.get("EXAMPLES", "300")), deadline=None)
@given(st.lists(values, max_size=6), st.sampled_from([None, 1]), st.lists(st.integers(1, 300), max_size=5), st.sampled_from(["", "\n", "\n{\"x\":1}\n[2]\n", " junk"]))
def test_arrays_cut_anywhere(elements, indent, bounds, rest):
    data = (json.dumps(elements, indent=indent, ensure_ascii=False) + rest).encode()
    got = records(data, "json", bounds)
    assert [json.loads(t) for t, line in got if not line] == elements
    assert [t for t, line in got if line] == [x.strip().encode() for x in rest.split("\n") if x.strip()]


@settings(max_examples=int(os.environ.get("EXAMPLES", "300")), deadline=None)
@given(st.binary(max_size=120).map(lambda b: bytes(b'[]{}",\\:\n 1a'[x % 12] for x in b)), st.sampled_from([b"[", b"{", b'[{"a":', b'{"a":"x\n', b""]), st.lists(st.integers(1, 130), max_size=5))
@example(b'{"a":1},\n{"b":2}', b"[", [3, 9])
def test_torn_files_do_not_depend_on_the_cuts(tail, head, bounds):
    data = head + tail
    assert records(data, "json", bounds) == records(data, "json")


@pytest.mark.parametrize("data, want", [
    (b'[{"a":1},\n{"a":2}\n', [(b'{"a":1}', False), (b'{"a":2}', True)]),
    (b'{"l":1}\nbad\n\n{"l":2} \n{"l":9} junk\n', [(b'{"l":1}', True), (b"bad", True), (b'{"l":2}', True), (b'{"l":9} junk', True)]),
    (b'{"a":{"p":"xxx"}\n,"b":2}\n', [(b'{"a":{"p":"xxx"}\n,"b":2}', False)]),
    (b'{\n{"a":1}\n{"b":2}\n', [(b"{", True), (b'{"a":1}', True), (b'{"b":2}', True)]),
    (b'[1,2]\n{"a":1}\n', [(b"1", False), (b"2", False), (b'{"a":1}', True)]),
    (b"[]", []), (b"", []), (b" \n ", []), (b"[,]", []), (b'{"a":1},', [(b'{"a":1},', True)]), (b'[{"a":"\xff, ]"}]', [(b'{"a":"\xff, ]"}', False)]),
    (b'[{"a":"broken},\n{"b":1},\n{"c":2}]', [(b'{"a":"broken},', True), (b'{"b":1},', True), (b'{"c":2}]', True)]),
])
def test_kinds_of_json_files(data, want):
    assert records(data, "json") == want
    for bounds in ([4], [9, 17], [2, 5, 12, 20]):
        assert records(data, "json", bounds) == want


cells = st.text('ab",\n\r 1é', max_size=6)


@settings(max_examples=int(os.environ.get("EXAMPLES", "300")), deadline=None)
@given(st.lists(st.lists(cells, min_size=2, max_size=3), min_size=1, max_size=8), st.lists(st.integers(1, 200), max_size=5), st.sampled_from(["\n", "\r\n"]))
def test_csv_cut_anywhere(rows, bounds, end):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    data = out.getvalue().encode()
    got = records(data, "csv", bounds)
    assert got == records(data, "csv")
    blank = [r for r in rows if not "".join(r).strip(" \r\n")]
    if not blank:
        read = [next(csv.reader(io.StringIO(t.decode(), newline=""))) for t, _ in got]
        assert [[c.strip(" \r\n") for c in r] for r in read] == [[c.strip(" \r\n") for c in r] for r in rows]


def test_empty_and_missing_csv_fields(spark, scratch):
    with open(os.path.join(scratch, "a.csv"), "w") as f:
        f.write('a,,b,c\n,x,"",1\n1,2\n"q",,,,extra\n')
    rows = [tuple(r) for r in FS.read_csv(spark, scratch, {"a": ("string", "-"), "b": ("string", "-"), "c": ("int", 7), "d": ("string", "-")}).collect()]
    assert rows == [("", "", 1, "-", "a.csv", None), ("1", None, None, "-", "a.csv", "short_row_b"), ("q", "", None, "-", "a.csv", "bad_c")]


def test_csv_quote_inside_an_unquoted_field():
    data = b'a,b\n5" pipe,1\n6" pipe,"x\n""y"\n'
    for bounds in ([], [6], [5, 20], [9, 17, 25]):
        assert [t for t, _ in records(data, "csv", bounds)] == [b"a,b", b'5" pipe,1', b'6" pipe,"x\n""y"']


@pytest.fixture()
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "40000", "spark.sql.files.openCostInBytes": "5000"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _element(i, r):
    return {"a": i, "t": r.choice(["x", 'q"}],[{', "é,\\", "line\nbreak"]) * r.randrange(60), "n": {"d": [i, None, {"e": 1.5}]}}


def test_large_json_files_through_many_tasks(spark, scratch, small_blocks, monkeypatch):
    r = random.Random(4)
    elements = [_element(i, r) for i in range(3000)]
    elements[700] = _element(700, r) | {"t": "y,[" * 40_000}          # longer than some blocks
    bad = ["3", "null", '"{}"', "[{}]", '{"a":1} {"a":2}', "{a}", ""]
    compact = ",".join(json.dumps(e, ensure_ascii=False) for e in elements[:2000]) + "," + ",".join(bad) + "," + ",".join(json.dumps(e) for e in elements[2000:])
    for name, text in (("compact.json", "[" + compact + "]"), ("torn.json", "[" + compact + '\n{"a":"last"}'), ("pretty.json", json.dumps(elements, indent=2)),
                       ("lines.json", "".join(json.dumps(e) + "\n" for e in elements)), ("object.json", json.dumps({"a": elements[:500]}, indent=1) + "\n"),
                       ("small.json", '[{"a":-1}]')):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    fragments_seen = FS.read_records(spark, scratch, "json", "json")
    assert fragments_seen.rdd.getNumPartitions() > 8
    for states in (C.MOST_STATES, 50):
        monkeypatch.setattr(C, "MOST_STATES", states)
        rows = FS.read_json(spark, scratch).collect()
        good = {}
        for x in rows:
            if x._reject is None:
                good.setdefault(x.source_file, []).append(json.loads(x.value))

        def same(name, want):
            assert sorted(map(str, (json.dumps(e, sort_keys=True) for e in good.pop(name)))) == sorted(json.dumps(e, sort_keys=True) for e in want)
        same("compact.json", elements)
        same("torn.json", elements + [{"a": "last"}])
        same("pretty.json", elements)
        same("lines.json", elements)
        same("object.json", [{"a": elements[:500]}])
        same("small.json", [{"a": -1}])
        assert not good
        reasons = sorted((x.source_file, x._reject) for x in rows if x._reject)
        assert reasons == sorted((f, x) for f in ("compact.json", "torn.json") for x in ["not_an_object"] * 4 + ["invalid_json_element"] * 2)


def test_long_stretches_without_braces_and_compressed_files(spark, scratch, small_blocks, monkeypatch):
    monkeypatch.setattr(C, "LONGEST_FRAGMENT", 30_000)
    numbers = list(range(20_000))
    files = {"numbers x%20[1].json": json.dumps(numbers), "mixed.json": "[" + json.dumps({"a": "é" * 25_000}) + "," + json.dumps(numbers)[1:-1] + ',{"a":2}]',
             "plain.json": json.dumps([{"a": i} for i in range(9000)])}
    for name, text in files.items():
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    for name, text in (("a.json.gz", '[{"a":1},{"a":2}]'), ("b.json.gz", '{"a":3}\n{"a":4}'), ("c.json.gz", json.dumps([{"a": i} for i in range(9000)]))):
        with gzip.open(os.path.join(scratch, name), "wt") as f:
            f.write(text)
    for most in (C.MOST_NAMED, 1):
        monkeypatch.setattr(C, "MOST_NAMED", most)
        rows = {(r.source_file, r._reject): r.n for r in FS.read_json(spark, scratch, extension=None).groupBy("source_file", "_reject").agg(F.count("*").alias("n")).collect()}
        assert rows == {("numbers x%20[1].json", "not_an_object"): 20_000, ("mixed.json", None): 2, ("mixed.json", "not_an_object"): 20_000, ("plain.json", None): 9000,
                        ("a.json.gz", None): 2, ("b.json.gz", None): 2, ("c.json.gz", None): 9000}


def test_blocks_are_the_same_in_both_scans(spark, scratch):
    # sizes at which Spark's split size follows from the bytes of the files that it reads
    for i in range(6):
        with open(os.path.join(scratch, f"small{i}.json"), "w") as f:
            f.write("[" + ",".join('{"a":%d,"t":"%s"}' % (j, "x" * 90) for j in range(30_000)) + "]")
    for i, n in enumerate((160_000, 60_000)):
        with open(os.path.join(scratch, f"large{i}.json"), "w") as f:
            f.write("[" + ",".join('{"a":%d,"t":"%s"}' % (j, "y" * 90) for j in range(n)) + "]")
    rows = {r.source_file: (r.n, r.s) for r in FS.read_json(spark, scratch).selectExpr("source_file", "cast(get_json_object(value, '$.a') as long) a").groupBy("source_file")
            .agg(F.count("a").alias("n"), F.sum("a").alias("s")).collect()}
    assert rows == {f"small{i}.json": (30_000, 29_999 * 15_000) for i in range(6)} | {"large0.json": (160_000, 159_999 * 80_000), "large1.json": (60_000, 59_999 * 30_000)}


def test_schema_names_the_fields_to_keep(spark, scratch):
    with open(os.path.join(scratch, "a.json"), "w") as f:
        f.write('[{"a":1,"b c":{"x":[1]},"z":null},{"b c":"t"},3]')
    rows = [(r.value, r._reject) for r in FS.read_json(spark, scratch, schema="a int, `b c` string").collect()]
    assert rows == [('{"a":1,"b c":{"x":[1]}}', None), ('{"b c":"t"}', None), ("3", "not_an_object")]


@pytest.mark.parametrize("size", [1000, 1 << 20, 3 << 20])
def test_first_line_of_any_length(spark, scratch, size):
    with open(os.path.join(scratch, "a.json"), "w") as f:
        f.write('{"a":{"p":"%s"}\n,"b":2}' % ("x" * size))
    with open(os.path.join(scratch, "b.json"), "w") as f:
        f.write('{"a":"%s"}\n{"a":2}' % ("x" * size))
    rows = FS.read_json(spark, scratch).selectExpr("source_file", "_reject", "length(value) AS n").collect()
    assert sorted((r.source_file, r._reject, r.n) for r in rows) == [("a.json", None, size + 20), ("b.json", None, 7), ("b.json", None, size + 8)]


def test_a_record_beyond_the_limit_is_rejected_alone(spark, scratch, small_blocks, monkeypatch):
    monkeypatch.setattr(C, "LONGEST", 200_000)
    with open(os.path.join(scratch, "a.json"), "w") as f:
        f.write('[{"a":1},{"t":"%s"},{"a":2}]' % ("x,y" * 100_000))
    rows = FS.read_json(spark, scratch).collect()
    assert sorted((r.value, r._reject) for r in rows if r.value) == [('{"a":1}', None), ('{"a":2}', None)]
    assert [r._reject for r in rows if r.value is None] == ["beyond_variant_limit"]


def test_large_csv_equals_the_multiline_reader(spark, scratch, small_blocks):
    r = random.Random(8)
    with open(os.path.join(scratch, "a.csv"), "w", newline="") as f:
        w = csv.writer(f, lineterminator="\r\n")
        w.writerow(["id", "two\nlines", "c"])
        for i in range(8000):
            w.writerow([i, r.choice(["plain", 'he said "hi", ok', "a\nb", "\n\n", 'x"', "", "é\r\ny"]) * r.randrange(1, 4), r.random()])
    columns = {"id": ("int", 0), "two\nlines": ("string", "none"), "c": ("double", 0.0)}
    got = FS.read_csv(spark, scratch, columns)
    assert FS.read_records(spark, scratch, "csv", "csv").rdd.getNumPartitions() > 4
    want = spark.read.csv(scratch, header=True, schema="id int, t string, c double", multiLine=True, quote='"', escape='"', emptyValue="", nullValue="\x00")
    assert sorted(tuple(x)[:3] for x in got.collect()) == sorted((i, t or "", c) for i, t, c in want.collect())
    assert got.filter("_reject is not null").count() == 0
