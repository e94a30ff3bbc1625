"""Published tables, loads by header line and their ledger."""

import pytest
from pyspark.sql import functions as F

from taxaweave.sources import ingest as I
from taxaweave.sources import loads as L
from taxaweave.sources import tables
from taxaweave.sources.tables import Table
from taxaweave.streaming import incremental as S


def _values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_write_that_fails_half_way_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    I.materialize(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), path)
    rows = spark.range(1000, numPartitions=8)
    broken = rows.select(F.when(F.col("id") == 900, F.raise_error("boom")).otherwise(F.col("id")).cast("int").alias("id"), F.lit("x").alias("v"))
    with pytest.raises(Exception, match="boom"):
        I.materialize(broken, path)
    t = Table(spark, path)
    assert _values(t.read()) == [(1, "a"), (2, "b")] and t.commit().number == 1
    dead = t.vacuum()
    assert len(dead) == 1 and _values(t.read()) == [(1, "a"), (2, "b")]  # the failed load's folder goes


def test_a_load_of_other_rows_than_written_is_not_committed(spark, tmp_path, monkeypatch):
    t = Table(spark, str(tmp_path / "t"))
    t.refresh(spark.range(5))
    whole = Table._stored
    monkeypatch.setattr(Table, "_stored", lambda self, *a: whole(self, *a).limit(3))
    with pytest.raises(tables.Incomplete):
        t.refresh(spark.range(10))
    monkeypatch.undo()
    assert t.read().count() == 5


def test_refresh_from_itself_and_old_versions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    assert t.read().count() == 0
    t.refresh(spark.range(4))
    t.refresh(t.read().select((F.col("id") * 10).alias("id")))
    t.append(t.read())
    assert _values(t.read()) == [(0,), (0,), (10,), (10,), (20,), (20,), (30,), (30,)]
    assert _values(t.read(1)) == [(0,), (1,), (2,), (3,)] and t.read(2).count() == 4
    t.vacuum(keep=2)
    assert t.read().count() == 8 and t.read(2).count() == 4
    t.refresh(t.read())  # one load again
    assert len(t.commit().rows) == 1 and len(t.vacuum()) == 2 and t.read().count() == 8


def test_two_writers_of_one_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = Table(spark, path), Table(spark, path)
    one.refresh(spark.range(3))
    old = two.commit()
    one.append(spark.range(2))
    monkeypatch.setattr(two, "commit", lambda number=None: old)
    with pytest.raises(tables.Conflict):
        two.append(spark.range(50))
    assert one.read().count() == 5


def test_columns_by_name_and_types(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.append(spark.createDataFrame([(1, "x")], "a int, b string"), "first")
    t.append(spark.createDataFrame([("y", True)], "B string, c boolean"), "second")
    t.append(spark.createDataFrame([("z", True)], "B string, c boolean"), "second")
    assert t.read().columns == ["a", "b", "c"] and _values(t.read()) == [(1, "x", None), (None, "y", True)]
    with pytest.raises(TypeError):
        t.append(spark.createDataFrame([("no",)], "a string"))
    assert _values(t.read(loads=["second"])) == [(None, "y", True)]


def _put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_a_retried_batch_adds_no_row(spark, tmp_path, monkeypatch):
    src, raw, ckpt = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ckpt")
    _put(src, "a.csv", "id,name\n1,one\n2,two\n")
    run = lambda: S.load_increment(spark, str(src), raw, ckpt)
    assert run() == 1
    _put(src, "b.csv", "name,id,more\nthree,3,x\nbad line,4\n")
    _put(src / "deep", "c.tsv", "id\tname\n5\tfive\n")
    put = Table._put

    def before(self, state):
        raise OSError("lost before the commit")

    monkeypatch.setattr(Table, "_put", before)
    with pytest.raises(Exception, match="lost"):
        run()
    assert _values(L.kept_rows(spark, raw)) == [("1", "one"), ("2", "two")]

    def after(self, state):
        put(self, state)
        raise OSError("lost after the commit")

    monkeypatch.setattr(Table, "_put", after)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    assert run() == 1 and run() == 0
    got = L.kept_rows(spark, raw).select("id", "name", "more")
    assert _values(got) == [("1", "one", None), ("2", "two", None), ("3", "three", "x"), ("5", "five", None)]
    assert [r["raw_line"] for r in L.quarantined_lines(spark, raw).collect()] == ["bad line,4"]
    figures = {r["source_file"].rsplit("/")[-1]: (r["original_rows"], r["kept_rows"], r["quarantined_rows"], r["filtered_rows"]) for r in L.ledger(spark, raw).collect()}
    assert figures == {"a.csv": (2, 2, 0, 0), "b.csv": (2, 1, 1, 0), "c.tsv": (1, 1, 0, 0)}


def test_ledger_counts_files_without_rows_and_filtered_rows(spark, tmp_path):
    src, raw = tmp_path / "in", str(tmp_path / "raw")
    _put(src, "none.csv", "id,kind\n")
    _put(src, "some file+1.csv", "kind,id\nx,1\ny,2\n,3\n")
    L.load_files(spark, str(src), raw, key="k", condition="kind = 'x'")
    L.load_files(spark, str(src), raw, key="k", condition="kind = 'x'")
    figures = {r["source_file"].rsplit("/")[-1]: (r["original_rows"], r["kept_rows"], r["quarantined_rows"], r["filtered_rows"]) for r in L.ledger(spark, raw).collect()}
    assert figures == {"none.csv": (0, 0, 0, 0), "some file+1.csv": (3, 1, 0, 2)}
    assert L.kept_rows(spark, raw).select("id", "kind").collect() == [("1", "x")]
    _put(tmp_path / "more", "b.csv", "id\n9\n")  # lacks the filter's column: nothing is kept
    L.load_files(spark, str(tmp_path / "more"), raw, condition="kind = 'x'")
    assert L.kept_rows(spark, raw).count() == 1 and L.ledger(spark, raw).count() == 3


def test_delimiters_by_their_histogram(spark, tmp_path):
    files = {
        "tabs.txt": "id\tname\n1\ta, b, c\n2\td\n",
        "semi.csv": 'id;name\n1;"a; b"\n2;"c, d"\n',
        "pipes.txt": "a|b|c\n1|2|3\n",
        "quoted.csv": '"x, y, z"\n"only one, column"\n',
        "prose.txt": "one line, of text\nanother\nand; a third\nfourth\n",
        "tie.tsv": "a,b\tc\n1,2\t3\n",  # two fields either way: the suffix decides
        "tie.csv": "a,b\tc\n1,2\t3\n",
        "more.txt": "a;b|c|d\n",  # alike even, neither usual: more fields
        "blank.csv": "\n\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = {r["path"].rsplit("/")[-1]: r["delimiter"] for r in I.file_forms(spark, [str(tmp_path / n) for n in files]).collect()}
    assert got == {"tabs.txt": "\t", "semi.csv": ";", "pipes.txt": "|", "quoted.csv": ",", "prose.txt": ",", "tie.tsv": "\t", "tie.csv": ",", "more.txt": "|", "blank.csv": ","}
    (tmp_path / "blank.csv").write_text("")
    rows = I.read_delimited(spark, [str(tmp_path / n) for n in ("tabs.txt", "semi.csv")])
    assert _values(rows) == [("1", "a, b, c"), ("1", "a; b"), ("2", "c, d"), ("2", "d")]


def test_encodings_by_byte_counts(spark, tmp_path):
    texts = {
        "utf8.csv": ("k,v\n1,„é”\n", "utf-8"),
        "ascii.csv": ("k,v\n2,plain\n", "ascii"),
        "latin.csv": ("k,v\n3,Größe\n", "latin-1"),
        "windows.csv": ("k,€\n4,“Œuvre” Größe\n", "cp1252"),
        "marked.csv": ("k,v\n5,é日\n", "utf-16"),
        "le.csv": ("k,v\n6,é日\n7,b\n", "utf-16-le"),
        "be.csv": ("k,v\r\n8,é日\r\n9,b\r\n", "utf-16-be"),
        "le_without_end.csv": ("k,v\n10,c", "utf-16-le"),
    }
    for name, (text, encoding) in texts.items():
        (tmp_path / name).write_bytes(text.encode(encoding))
    kinds = {r["path"].rsplit("/")[-1]: r["encoding"] for r in I.file_encodings(spark, str(tmp_path)).collect()}
    assert kinds == {
        "utf8.csv": "UTF-8", "ascii.csv": "UTF-8", "latin.csv": "ISO-8859-1", "windows.csv": I.WINDOWS,
        "marked.csv": "UTF-16", "le.csv": "UTF-16LE", "be.csv": "UTF-16BE", "le_without_end.csv": "UTF-16LE",
    }
    lines = {}
    for r in I.decode_lines(spark, str(tmp_path)).collect():
        lines.setdefault(r["path"].rsplit("/")[-1], []).append(r["value"])
    assert {k: sorted(v) for k, v in lines.items()} == {k: sorted(t.split()) if k != "windows.csv" else ["4,“Œuvre” Größe", "k,€"] for k, (t, _) in texts.items()}
    rows = I.read_with_fallback(spark, [str(tmp_path / n) for n in texts if n != "windows.csv"])
    assert _values(rows) == sorted([("1", "„é”"), ("2", "plain"), ("3", "Größe"), ("5", "é日"), ("6", "é日"), ("7", "b"), ("8", "é日"), ("9", "b"), ("10", "c")], key=str)
    assert I.read_with_fallback(spark, str(tmp_path / "windows.csv")).first().asDict() == {"k": "4", "€": "“Œuvre” Größe"}


def test_repair_reads_malformed_lines_under_their_own_header(spark, tmp_path):
    src = tmp_path / "in"
    _put(src, "a.csv", 'id,name\n1,plain\n  2,"b, c"\n\0"3, x","d"\n4,too,many\n  \n\0\n')
    _put(src, "b.csv", 'more,name,id\nx,"f",5\n \t"y, z","g",6\nshort,line\n')
    df = I.read_delimited(spark, str(src), repair=True)
    good, bad = I.split_quarantine(df)
    assert _values(good.select("id", "name", "more")) == [("  2", "b, c", None), ("1", "plain", None), ("3, x", "d", None), ("5", "f", "x"), ("6", "g", "y, z")]
    assert _values(bad) == [("4,too,many",), ("short,line",)]
    raw = str(tmp_path / "raw")
    L.load_files(spark, str(src), raw, repair=True)
    assert L.kept_rows(spark, raw).count() == 5 and sorted(r["quarantined_rows"] for r in L.ledger(spark, raw).collect()) == [1, 1]


def test_uniform_files_are_not_compared(spark, tmp_path, monkeypatch):
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text(f"id;name\n{k};a, b\n")
    monkeypatch.setattr(I, "file_forms", None)  # no scan of all files
    assert _values(I.read_delimited(spark, str(tmp_path), uniform=True)) == [(str(k), "a, b") for k in range(3)]
    L.load_files(spark, str(tmp_path), str(tmp_path / "raw"), uniform=True)
    assert L.ledger(spark, str(tmp_path / "raw")).count() == 3
