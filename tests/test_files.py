import os

import pytest

from heliolake.sources import files as FS

PRINTER = {"timestamp": ("string", ""), "hotend_temperature": ("double", 0.0), "bed_temperature": ("double", 0.0),
           "ambient_temperature": ("double", 0.0), "fluctuated_ambient_temperature": ("double", 0.0)}


@pytest.fixture()
def bucket(scratch):
    root = os.path.join(scratch, "bucket", "logs")
    os.makedirs(os.path.join(root, "sub"))
    files = {
        "a.csv": b"timestamp,hotend_temperature,bed_temperature,ambient_temperature,fluctuated_ambient_temperature\r\n"
                 b"t0,200.5,60.1,21.0,21.3\r\nt1,,60.2,21.0,21.4\r\nt2,abc,60.3,21.1,21.5\r\nt3,201.0,60.4,21.1,21.6\r\n",
        "sub/B.CSV": b"timestamp,bed_temperature,extra,hotend_temperature\nu0,55.0,x,190.0\nu1,56.0,y\n",
        "arr.json": b'[{"a":1},{"a":2},3]',
        "arr_pretty.json": b'[\n  {"a": 10},\n  {"a": 11}\n]\n',
        "obj.json": b'{"o": 1, "source_file": "x"}',
        "obj_pretty.json": b'{\n "o": 2\n}\n',
        "lines.json": b'{"l":1}\nbad\n\n{"l":2} \n{"l":9} junk\n',
        "lines_badfirst.json": b'bad first\n{"l":3}\n{"l":4}\n',
        "t1.txt": b"hello  \r\n\n  world\r\n\t\n",
        "bin.txt": b"ok line\n\xff\xfe bad bytes\n",
    }
    for name, data in files.items():
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    os.makedirs(os.path.join(scratch, "empty"))
    return root


def test_csv_by_header_with_rejects(spark, bucket):
    rows = sorted((tuple(r) for r in FS.read_csv(spark, bucket, PRINTER).collect()), key=lambda r: r[0])
    assert rows == [
        ("t0", 200.5, 60.1, 21.0, 21.3, "a.csv", None),
        ("t1", None, 60.2, 21.0, 21.4, "a.csv", "bad_hotend_temperature"),    # empty value
        ("t2", None, 60.3, 21.1, 21.5, "a.csv", "bad_hotend_temperature"),    # not a number
        ("t3", 201.0, 60.4, 21.1, 21.6, "a.csv", None),                       # rows after a bad one are kept
        ("u0", 190.0, 55.0, 0.0, 0.0, "sub/B.CSV", None),                     # absent columns -> defaults
        ("u1", None, 56.0, 0.0, 0.0, "sub/B.CSV", "bad_hotend_temperature"),  # short row
    ]


def test_json_large_array_with_a_bad_element(spark, scratch):
    root = os.path.join(scratch, "large")
    os.makedirs(root)
    n, text = 140, "x" * (1 << 20)
    with open(os.path.join(root, "a.json"), "w") as f:      # more than one variant holds, in one line
        f.write("[" + ",".join(f'{{"a":{i},"t":"{text}"}}' for i in range(n)) + ',3,null,"{}",[{}]]')
    rows = FS.read_json(spark, root, schema="a bigint, t string").selectExpr("get_json_object(value, '$.a') AS a", "length(value) AS n", "_reject").collect()
    assert sorted(int(r.a) for r in rows if r._reject is None) == list(range(n))
    assert all(r.n > len(text) for r in rows if r._reject is None)
    assert [r._reject for r in rows if r._reject] == ["not_an_object"] * 4


def test_json_classification(spark, bucket):
    rows = [(r.source_file, r.value, r._reject) for r in FS.read_json(spark, bucket).collect()]
    good = sorted((f, v) for f, v, rej in rows if rej is None)
    assert good == [("arr.json", '{"a":1}'), ("arr.json", '{"a":2}'), ("arr_pretty.json", '{"a":10}'),
                    ("arr_pretty.json", '{"a":11}'), ("lines.json", '{"l":1}'), ("lines.json", '{"l":2}'),
                    ("lines_badfirst.json", '{"l":3}'), ("lines_badfirst.json", '{"l":4}'),
                    ("obj.json", '{"o":1,"source_file":"x"}'), ("obj_pretty.json", '{"o":2}')]
    bad = sorted((f, rej) for f, v, rej in rows if rej is not None)
    assert bad == [("arr.json", "not_an_object"), ("lines.json", "invalid_json_line"),
                   ("lines.json", "invalid_json_line"), ("lines_badfirst.json", "invalid_json_line")]
    merged = FS.read_json(spark, bucket).filter("source_file = 'obj.json'")
    assert merged.select(FS.with_source(merged)).first()[0] == '{"o":1,"source_file":"obj.json"}'


def test_text_strip_blank_and_binary(spark, bucket):
    rows = sorted(tuple(r) for r in FS.read_text(spark, bucket, "txt").collect())
    assert rows == [("hello", "t1.txt"), ("world", "t1.txt")]


def test_empty_and_missing(spark, bucket, scratch):
    assert FS.read_text(spark, os.path.join(scratch, "empty")).count() == 0
    with pytest.raises(FS.MissingSource):
        FS.read_text(spark, os.path.join(scratch, "nope"))


def test_folder_stats_and_preview(spark, bucket):
    s = FS.folder_stats(spark, bucket, "json").first()
    assert s.files == 6
    df = spark.range(1000)
    assert [r.id for r in FS.preview(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_csv_preview(spark, bucket):
    cols, rows, stats = FS.csv_preview(spark, bucket, n=2)
    assert cols[:2] == ["timestamp", "hotend_temperature"]          # first file by name: a.csv
    assert [r.timestamp for r in rows.collect()] == ["t0", "t1"]
    assert stats.first().files == 2                                  # a.csv and sub/B.CSV


def test_read_folder_dispatch_and_cap(spark, bucket):
    assert FS.read_folder(spark, bucket, "csv").count() == 6
    assert FS.read_folder(spark, bucket, "JSON").filter("_reject IS NULL").count() == 10
    assert sorted(r.content for r in FS.read_folder(spark, bucket, "txt").collect()) == ["hello", "world"]
    assert FS.read_folder(spark, bucket, "csv", max_rows=2).count() == 2
    everything = FS.read_folder(spark, bucket, "none")          # every file as text lines
    assert everything.filter("source_file = 'a.csv'").count() == 5


def _write(root, files):
    os.makedirs(root, exist_ok=True)
    for name, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)


def test_names_with_blanks_brackets_and_repeated_folders(spark, scratch):
    root = os.path.join(scratch, "my data[1]", "data")
    _write(root, {"a b.json": b'[{"x":1}]', "a[1].json": b'{"x":2}\n{"x":3}', "data/c%20d+e.json": b'{"x":4}', "q u.csv": b"h,i\n1,2\n", "t{1}.txt": b"hi"})
    got = sorted((r.source_file, r.value, r._reject) for r in FS.read_json(spark, root).collect())
    assert got == [("a b.json", '{"x":1}', None), ("a[1].json", '{"x":2}', None), ("a[1].json", '{"x":3}', None), ("data/c%20d+e.json", '{"x":4}', None)]
    assert [tuple(r) for r in FS.read_csv(spark, root, {"i": ("int", 0)}).collect()] == [(2, "q u.csv", None)]
    cols, rows, stats = FS.csv_preview(spark, root)
    assert cols == ["h", "i"] and [tuple(r) for r in rows.collect()] == [("1", "2")] and stats.first().files == 1
    assert [tuple(r) for r in FS.read_text(spark, root, "txt").collect()] == [("hi", "t{1}.txt")]


def test_csv_quotes(spark, scratch):
    root = os.path.join(scratch, "csv")
    _write(root, {"a.csv": b'a,"b, unit",c\r\n1,"x\ny",3\r\n2,"he said ""hi"", ok",4\r\n\r\n5,plain,6\r\n', "b.csv": b'"c","a","b, unit"\n7,8,z\n'})
    rows = sorted(tuple(r) for r in FS.read_csv(spark, root, {"a": ("int", 0), "b, unit": ("string", ""), "c": ("int", 0)}).collect())
    assert rows == [(1, "x\ny", 3, "a.csv", None), (2, 'he said "hi", ok', 4, "a.csv", None), (5, "plain", 6, "a.csv", None), (8, "z", 7, "b.csv", None)]
    _write(root, {"c.csv": b'"a","two\nlines",c\n9,w,10\n'})
    rows = FS.read_csv(spark, root, {"a": ("int", 0), "two\nlines": ("string", "none"), "c": ("int", 0)})
    assert (9, "w", 10, "c.csv", None) in {tuple(r) for r in rows.collect()} and rows.count() == 5


def test_json_keeps_nulls_types_and_broken_files(spark, scratch):
    root = os.path.join(scratch, "json")
    _write(root, {"n.json": b'[{"a":null,"b":1.50,"c":{"d":[1,"x",null]}},{"b":"t"}]', "torn.json": b'[{"a":1},\n{"a":2}\n', "mix.json": b'[{"a":1}, 3, {"a":4}]', "e.json": b"[]"})
    got = sorted(((r.source_file, r.value, r._reject) for r in FS.read_json(spark, root).collect()), key=str)
    assert ("n.json", '{"a":null,"b":1.5,"c":{"d":[1,"x",null]}}', None) in got or ("n.json", '{"a":null,"b":1.50,"c":{"d":[1,"x",null]}}', None) in got
    assert ("n.json", '{"b":"t"}', None) in got
    assert [(v, r) for f, v, r in got if f == "mix.json" and r is None] == [('{"a":1}', None), ('{"a":4}', None)]
    assert [r for f, v, r in got if f == "mix.json" and r] == ["not_an_object"]
    # every element of a torn array is judged by itself; what never ends is read as lines
    assert sorted((v, r) for f, v, r in got if f == "torn.json") == [('{"a":1}', None), ('{"a":2}', None)]
    assert not [f for f, *_ in got if f == "e.json"]


def test_json_array_beyond_the_variant_limit(spark, scratch):
    root = os.path.join(scratch, "big")
    os.makedirs(root)
    n, pad = 150_000, "p" * 930
    with open(os.path.join(root, "big.json"), "w") as f:
        f.write("[")
        for i in range(n):
            f.write(("," if i else "") + '{"i":%d,"pad":"%s"}' % (i, pad))
        f.write("]")
    assert os.path.getsize(os.path.join(root, "big.json")) > 134_217_728
    df = FS.read_json(spark, root, schema="i int, pad string")
    assert df.filter("_reject is null").count() == n and df.filter("_reject is not null").count() == 0


def test_folder_to_topic(spark, bucket):
    messages, rejected = FS.folder_topic(spark, bucket, "files", "json")
    rows = sorted((r.key.decode(), r.value) for r in messages.select("key", "value").collect())
    assert len(rows) == 10 and ("obj.json", '{"o":1,"source_file":"obj.json"}') in rows
    assert all(f'"source_file":"{k}"' in v for k, v in rows) and rejected.count() == 4
    text, none = FS.folder_topic(spark, bucket, "files", "txt")
    assert sorted(r.value for r in text.collect())[0] == '{"content":"hello","source_file":"t1.txt"}' and none.count() == 0
