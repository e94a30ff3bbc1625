"""Operator-level tests: one per semantic trap, plus invariants."""

import os
import tempfile

from pyspark.sql import functions as F

from taxaweave import functions as N
from taxaweave.operators import dedupe as D
from taxaweave.operators import fill as FL
from taxaweave.operators import merge as M
from taxaweave.operators import numbering as R
from taxaweave.operators import quality as QC
from taxaweave.sources import ingest as I


def test_mode_ties_and_all_null(spark):
    df = spark.createDataFrame(
        [("g", "b"), ("g", "a"), ("g", "a"), ("g", "b"), ("g", None), ("g", None), ("g", None), ("h", None)],
        "k string, v string",
    )
    out = {r["k"]: r["best_v"] for r in FL.mode_by_key(df, "k", ["v"]).collect()}
    assert out == {"g": "a", "h": None}


def test_null_keys_are_never_duplicates(spark):
    df = spark.createDataFrame(
        [(1, None, "s", "i", ["x"]), (2, None, "s", "i", ["y"]), (3, "g", "s", "i", ["b"]), (4, "g", "s", "i", ["a"])],
        "id int, g string, s string, i string, ids array<string>",
    )
    rows, links = D.resolve_duplicates(df, ["g", "s", "i"], [D.asc("id")], "id")
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    assert sorted(map(tuple, links.collect())) == [(3, 3), (3, 4)]


def test_top1_null_created_wins(spark):
    df = spark.createDataFrame([("n", "2024-01-01", "b"), ("n", None, "c"), ("n", "2020-01-01", "a")], "k string, created string, id string")
    out = D.top1_per_key(df, ["k"], [D.desc("created", nulls_first=True), D.asc("id")]).collect()
    assert [r["id"] for r in out] == ["c"]


def test_dense_id_is_gap_free_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 13).alias("g"))
    out = R.dense_id(df, ["g", "k"], out="rid", num_partitions=7).orderBy("rid").collect()
    assert [r["rid"] for r in out] == list(range(1, 5001))
    keys = [(r["g"] is None, r["g"], r["k"]) for r in out]
    assert keys == sorted(keys, key=lambda t: (t[0], t[1] if t[1] is not None else 0, t[2]))


def test_sequence_in_group_matches_window(spark):
    from pyspark.sql import Window

    df = spark.range(0, 3000).select((F.col("id") % 5).alias("g"), (F.col("id") * 31 % 3000).alias("o"))
    ours = R.sequence_in_group(df, ["g"], ["o"], out="seq", num_partitions=6)
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    assert ours.select("g", "o", "seq").exceptAll(ref).count() == 0
    assert ref.exceptAll(ours.select("g", "o", "seq")).count() == 0


def test_merge_keeps_null_ids_aligned(spark):
    df = spark.createDataFrame([("n", "r", None, "WFO", "x"), ("n", "r", "b", "GBIF", None)], "name string, rank string, id string, data_source string, family string")
    row = M.merge_records(df, ["name", "rank"], ["family"]).first()
    assert row["external_ids"] == [None, "b"] and row["data_sources"] == ["WFO", "GBIF"] and row["family"] == "x"


def test_fill_preserves_rows_and_values(spark):
    df = spark.createDataFrame(
        [("G1", None, "F1"), ("G1", "T1", None), ("G1", "T1", "F1"), ("G2", None, None)],
        "genus string, tribe string, family string",
    )
    out = FL.hierarchical_fill(df, {"tribe": ["genus", "family"], "family": ["genus", "tribe"]}).collect()
    assert len(out) == 4
    assert sorted((r["genus"], r["tribe"], r["family"]) for r in out) == [
        ("G1", "T1", "F1"), ("G1", "T1", "F1"), ("G1", "T1", "F1"), ("G2", None, None)]


def test_name_functions(spark):
    df = spark.createDataFrame([("Cattleya labiata subsp. alba sect. Hadrolaelia",), (None,)], "n string")
    r = df.select(
        N.normalize_names("n").alias("norm"),
        N.extract_rank("n", "sect").alias("sect"),
        N.concat_skip_null(F.lit("a"), F.col("n"), F.lit("b")).alias("cat"),
    ).collect()
    assert r[0]["norm"] == "Cattleya labiata ssp. alba" and r[0]["sect"] == "Hadrolaelia"
    assert r[1]["norm"] is None and r[1]["sect"] is None and r[1]["cat"] == "ab"


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (2, None)], "k int, v string")
    assert QC.unique(df, "k").count() == 1
    assert QC.not_null(df, "v").count() == 1
    assert QC.single_word(df, ["v"]).count() == 1
    assert QC.accepted_values(df, "v", ["c"]).count() == 1
    assert QC.equal_rowcount(df, df).count() == 0


def _tmp():
    return tempfile.mkdtemp(prefix="tw-test-")


def test_malformed_rows_are_flagged(spark):
    d = _tmp()
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("a,b,c\n1,x,P\n2,y\n4,z,P,extra\n\n5,w,Q\n")
    df = I.read_delimited(spark, d, schema=I.T.StructType([I.T.StructField(c, I.T.StringType()) for c in "abc"]), keep_corrupt=True)
    good, bad = I.split_quarantine(df)
    assert sorted(r["a"] for r in good.collect()) == ["1", "5"]
    assert sorted(r["raw_line"] for r in bad.collect()) == ["2,y", "4,z,P,extra"]


def test_encoding_fallback_keeps_every_row(spark):
    d = _tmp()
    with open(os.path.join(d, "u.csv"), "wb") as f:
        f.write("k,v\n1,café\n".encode("utf-8"))
    with open(os.path.join(d, "l.csv"), "wb") as f:
        f.write("k,v\n2,café\n3,x\n".encode("iso-8859-1"))
    rows = sorted((r["k"], r["v"]) for r in I.read_with_fallback(spark, d).collect())
    assert rows == [("1", "café"), ("2", "café"), ("3", "x")]


def test_header_sanitising_and_folder_names(spark):
    assert I.sanitize_name("Scientific Name (full)") == "scientific_name_full"
    d = _tmp()
    os.makedirs(os.path.join(d, "Orchidaceae_wfo-7000000429"))
    os.makedirs(os.path.join(d, "nomatch"))
    with open(os.path.join(d, "Orchidaceae_wfo-7000000429", "classification.csv"), "w") as f:
        f.write("Taxon ID,Name\n1,A\n")
    out = I.sanitize_headers(I.read_family_folders(spark, d)).collect()
    assert [(r["taxon_id"], r["family_name"], r["wfo_id"]) for r in out] == [("1", "Orchidaceae", "7000000429")]


def test_line_repair(spark):
    d = _tmp()
    with open(os.path.join(d, "r.txt"), "w") as f:
        f.write("a\x00b\r\n\n  c  \n")
    out = [r["value"] for r in I.repair_lines(spark.read.text(d)).collect()]
    assert out == ["ab", "c"]


def test_source_key_rule(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("My file",)], "stem string")
    assert tuple(df.select(I.source_key("A-Key", "stem", 1), I.source_key("A-Key", "stem", 2)).first()) == ("a_key", "a_key_my_file")
    assert df.select(I.clean_key(F.lit("My-Source file"))).first()[0] == "my_source_file"


def _put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data.encode() if isinstance(data, str) else data)
    return path


def test_single_odd_suffix_and_missing_path(spark):
    d = _tmp()
    odd = _put(d, "table.dat", "a,b\n1,2\n")
    assert [r["file_name"] for r in I.list_files(spark, odd).collect()] == ["table.dat"]
    assert I.list_files(spark, d).count() == 0 and I.list_files(spark, d + "/none").count() == 0
    assert [tuple(r) for r in I.read_delimited(spark, odd).collect()] == [("1", "2")]


def test_columns_go_by_header_and_delimiter_by_suffix(spark):
    d = _tmp()
    _put(d, "x.csv", "a,b\n1,2\n")
    _put(d, "y.csv", "b,a\n4,3\n")
    _put(d, "deep/z.TSV", "a\tc\n5\t6\n")
    rows = {tuple(r) for r in I.read_delimited(spark, d).select("a", "b", "c").collect()}
    assert rows == {("1", "2", None), ("3", "4", None), ("5", None, "6")}


def test_utf16_and_quoted_line_breaks(spark):
    d = _tmp()
    _put(d, "le.csv", "k,v\n1,é\n".encode("utf-16"))
    _put(d, "plain.csv", "k,v\n2,b\n")
    _put(d, "quoted.csv", 'k,v\n3,"two\nlines"\n')
    kinds = {r["path"].rsplit("/")[-1]: (r["encoding"], r["multiline"]) for r in I.file_encodings(spark, d).collect()}
    assert kinds == {"le.csv": ("UTF-16", True), "plain.csv": ("UTF-8", False), "quoted.csv": ("UTF-8", True)}
    assert sorted(map(tuple, I.read_with_fallback(spark, d).collect())) == [("1", "é"), ("2", "b"), ("3", "two\nlines")]


def test_csv_keeps_blanks_and_quotes(spark):
    d = _tmp() + "/out"
    rows = [("  a ", 'he said ""hi"", ok'), ("b", '"'), ("\tc", "x")]
    I.write_csv(spark.createDataFrame(rows, "k string, v string"), d)
    assert sorted(map(tuple, I.read_delimited(spark, d).collect())) == sorted(rows)


def test_stream_counts_batches_and_quarantines(spark):
    from taxaweave.sources import loads as L
    from taxaweave.streaming import incremental as S

    d = _tmp()
    for k in range(3):
        _put(d, f"in/{k}.csv", f'a,b\n{k},"he said ""hi"", ok"\n{k},x,extra\n')
    run = lambda: S.load_increment(spark, d + "/in", d + "/raw", d + "/ckpt", max_files_per_trigger=1)
    assert (run(), run()) == (3, 0)
    assert sorted(map(tuple, L.kept_rows(spark, d + "/raw").collect())) == [(str(k), 'he said "hi", ok') for k in range(3)]
    assert sorted(r["raw_line"] for r in L.quarantined_lines(spark, d + "/raw").collect()) == [f"{k},x,extra" for k in range(3)]


def test_neighbours_across_ranges(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 2).alias("v")).where("v <> 500").repartition(7)
    bad = QC.sequential_values(df, "v", ["g"], interval=6).collect()
    assert [(r["g"], r["v"], r["previous_value"]) for r in bad] == [(1, 506, 494)]
    assert QC.mutually_exclusive_ranges(df.withColumn("w", F.col("v") + 1), "v", "w", ["g"]).count() == 0


def test_family_groups(spark):
    from taxaweave.sources.groups import load_family_groups, tag_family_group

    text = """
a:
  description: first
  families: [F1, F2]
b:
  groups:
    sub: [F2, F3]
meta:
  description: not a group
  notes: [x]
"""
    groups = load_family_groups(spark, text)
    assert groups.count() == 4
    df = spark.createDataFrame([("t1", "F2"), ("t2", "F9")], "id string, family string")
    out = sorted((r["id"], r["group"], r["subgroup"]) for r in tag_family_group(df, groups).collect())
    assert out == [("t1", "a", None), ("t1", "b", "sub"), ("t2", None, None)]


def test_sequential_and_ranges_match_brute_force(spark):
    import random

    rng = random.Random(7)
    rows = []
    for i in range(600):
        p = "hot" if i % 3 == 0 else f"p{i % 11}"
        rows.append((p, i * 2 + (1 if rng.random() < 0.2 else 0), i * 10, i * 10 + rng.choice([5, 10, 45, 200])))
    df = spark.createDataFrame(rows, "p string, v long, lo long, hi long")
    got = sorted((r["p"], r["v"], r["previous_value"]) for r in QC.sequential_values(df, "v", ["p"], interval=6).collect())
    exp = []
    by = {}
    for p, v, lo, hi in rows:
        by.setdefault(p, []).append((v, lo, hi))
    for p, vals in by.items():
        vs = sorted(v for v, _, _ in vals)
        exp += [(p, b, a) for a, b in zip(vs, vs[1:]) if b != a + 6]
    assert got == sorted(exp)
    got_r = sorted((r["p"], r["lo"], r["next_lower"]) for r in QC.mutually_exclusive_ranges(df, "lo", "hi", ["p"]).collect())
    exp_r = []
    for p, vals in by.items():
        rs = sorted((lo, hi) for _, lo, hi in vals)
        exp_r += [(p, a[0], b[0]) for a, b in zip(rs, rs[1:]) if b[0] < a[1]]
    assert got_r == sorted(exp_r) and len(exp_r) > 0


def test_fallback_encodings_match_columns_by_name(spark, tmp_path):
    for encoding in ("utf-8", "latin-1", "utf-16"):
        for name, text in (("a", "k,größe\n1,é\n"), ("b", "größe,k,more\nü,2,x\n"), ("c", "k\n3\n")):
            (tmp_path / f"{encoding}-{name}.csv").write_bytes(text.encode(encoding))
    out = I.read_with_fallback(spark, str(tmp_path))
    assert sorted(out.columns) == ["größe", "k", "more"]
    rows = sorted(out.select("k", "größe", "more").collect(), key=str)
    assert [tuple(r) for r in rows] == [("1", "é", None)] * 3 + [("2", "ü", "x")] * 3 + [("3", None, None)] * 3
