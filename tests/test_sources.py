import pytest

from staylens.session import keep, scratch_root
from staylens.sources import export_csv, load_projected, load_raw_table, load_raw_tables, write_report


def write(path, text):
    path.write_text(text)
    return str(path)


def test_typed_load_with_quoted_newline(spark, tmp_path):
    path = write(tmp_path / "d.csv", 'row_id,itemid,label,fluid,category,loinc\n1,50,"a\nb",Blood,Chem,x\n2,51,"say ""hi""",,,\n')
    df = load_raw_table(spark, "d_labitems", path)
    assert df.columns[:3] == ["ROW_ID", "ITEMID", "LABEL"] and dict(df.dtypes)["ITEMID"] == "bigint"
    assert [(r["ITEMID"], r["LABEL"], r["FLUID"]) for r in df.collect()] == [(50, "a\nb", "Blood"), (51, 'say "hi"', None)]


def test_malformed_row_fails(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a,b,c,d,e,f\nx,50,l,f,c,l\n")
    with pytest.raises(Exception):
        load_raw_table(spark, "d_labitems", path).collect()


def test_selective_load(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a,b,c,d,e,f\n1,50,l,f,c,l\n")
    with pytest.raises(ValueError, match="nope"):
        load_raw_tables(spark, {"d_labitems": path}, str(tmp_path / "out"), only=["nope"])
    with pytest.raises(ValueError, match="no schema"):
        load_raw_table(spark, "services", path)
    loaded = load_raw_tables(spark, {"d_labitems": path, "d_items": "missing.csv"}, str(tmp_path / "out"), only=["d_labitems"])
    assert list(loaded) == ["d_labitems"] and loaded["d_labitems"].count() == 1


def test_projected_load(spark, tmp_path):
    path = write(tmp_path / "p.csv", " subject_id ,gender,extra\n1,M,z\n")
    df = load_projected(spark, path, ["SUBJECT_ID", "GENDER", "DOB"], required=["SUBJECT_ID"])
    assert df.columns == ["SUBJECT_ID", "GENDER"]
    with pytest.raises(ValueError, match="DOB"):
        load_projected(spark, path, ["SUBJECT_ID"], required=["DOB"], name="PATIENTS")


def test_csv_export_and_report(spark, tmp_path):
    df = spark.range(10).repartition(3)
    export_csv(df, str(tmp_path / "x"))
    parts = [p.read_text() for p in (tmp_path / "x").glob("*.csv")]
    assert len(parts) == 3 and all(p.startswith("id\n") for p in parts)
    write_report(df, str(tmp_path / "r"), "json")
    assert len(list((tmp_path / "r").glob("*.json"))) == 1


def test_kept_table_is_a_file_scan_in_the_named_folder(spark):
    kept = keep(spark.range(5), "five")
    assert kept.count() == 5
    assert all(scratch_root(spark).split(":")[-1] in f for f in kept.inputFiles())
