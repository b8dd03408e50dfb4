import gzip

import pytest
from pyspark.sql import functions as F

from lotwise.operators.cleaning import aggregate_by_sale
from lotwise.operators.pricing import time_based_split
from lotwise.schemas import LOT_ORDER, RAW_LOT
from lotwise.sources import tables
from lotwise.sources.raw_files import load_years, raw_file_path, read_raw_file, write_raw_file
from lotwise.sources.scratch import FILE_CLEANUP, shared_folder, stored

HEADER = [*RAW_LOT.fieldNames(), "adresse_nom_voie", "numero_disposition"]


def write(folder, year, rows, header=HEADER):
    path = folder / f"sales_33_{year}.csv.gz"
    defaults = {
        "id_mutation": "A", "date_mutation": f"{year}-03-15", "nature_mutation": "Vente",
        "valeur_fonciere": "200000", "nom_commune": "Bordeaux", "code_postal": "33000.0",
        "type_local": "Appartement", "surface_reelle_bati": "60", "numero_disposition": "1",
        "nombre_pieces_principales": "3", "surface_terrain": "", "longitude": "-0.57",
        "latitude": "44.83", "adresse_nom_voie": '"RUE ""X"",\nBIS"',
    }
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write(",".join(header) + "\n")
        for row in rows:
            cells = {**defaults, **row}
            file.write(",".join(cells[name] for name in header) + "\n")
    return str(path)


def test_path_convention():
    assert raw_file_path("/data/", "sales", "2A", 2023) == "/data/sales_2A_2023.csv.gz"


def test_columns_are_found_by_name_and_typed(spark, tmp_path):
    path = write(tmp_path, 2024, [{}], header=HEADER[::-1])
    df = read_raw_file(spark, path)
    assert df.columns == [*RAW_LOT.fieldNames(), LOT_ORDER]
    assert [f.dataType for f in df.schema][:12] == [f.dataType for f in RAW_LOT]
    row = df.first()
    assert (row.valeur_fonciere, row.code_postal, row.surface_terrain) == (200000.0, 33000.0, None)


def test_only_needed_columns_are_parsed(spark, tmp_path):
    path = write(tmp_path, 2024, [{}])
    plan = read_raw_file(spark, path).select("id_mutation")._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<id_mutation:string>" in plan.toString()


def test_full_width_read_keeps_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path, 2024, [{}, {"id_mutation": "B"}])
    df = read_raw_file(spark, path, all_columns=True)
    assert df.columns == [*HEADER, LOT_ORDER]
    rows = df.collect()
    assert [row.id_mutation for row in rows] == ["A", "B"]
    assert rows[0].adresse_nom_voie == 'RUE "X",\nBIS'


@pytest.mark.parametrize("token", ["", '""', "NA", "NaN", "nan", "null", "None", "N/A", "#N/A"])
def test_missing_tokens_are_null(spark, tmp_path, token):
    path = write(tmp_path, 2024, [{"valeur_fonciere": token, "type_local": token}])
    row = read_raw_file(spark, path).first()
    assert (row.valeur_fonciere, row.type_local) == (None, None)


def test_years_are_united_by_name(spark, tmp_path, caplog):
    write(tmp_path, 2022, [{}, {"id_mutation": "B"}])
    write(tmp_path, 2024, [{"id_mutation": "C"}], header=HEADER[::-1])
    df = load_years(spark, str(tmp_path), "sales", "33", (2022, 2023, 2024))
    found = sorted((r.id_mutation, r.source_year, r.nom_commune) for r in df.collect())
    assert found == [("A", 2022, "Bordeaux"), ("B", 2022, "Bordeaux"), ("C", 2024, "Bordeaux")]
    assert "2023" in caplog.text


def test_no_file_at_all_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_years(spark, str(tmp_path), "sales", "33", (2022, 2023))


def test_first_follows_the_order_of_the_years(spark, tmp_path):
    write(tmp_path, 2022, [{"nom_commune": "Pessac"}, {"nom_commune": "Talence"}])
    write(tmp_path, 2023, [{"nom_commune": "Cenon"}] * 50)
    for years, commune in (((2022, 2023), "Pessac"), ((2023, 2022), "Cenon")):
        df = load_years(spark, str(tmp_path), "sales", "33", years)
        assert aggregate_by_sale(df).first().nom_commune == commune


def test_bad_number_fails_loudly(spark, tmp_path):
    path = write(tmp_path, 2024, [{"valeur_fonciere": "12x"}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_raw_file(spark, path).collect()


def test_parquet_tables_and_views(spark, sales, tmp_path):
    df = sales({}, {})
    tables.write_parquet(df, str(tmp_path / "sales"))
    tables.write_parquet(df, str(tmp_path / "sales"))
    again = tables.read_parquet(spark, str(tmp_path / "sales"))
    assert sorted(again.collect()) == sorted(df.collect())
    assert tables.publish_view(again, "seen_sales").count() == 2
    assert tables.read_table(spark, "seen_sales").count() == 2


def test_stored_frames_are_cut_from_their_source(spark, sales):
    df = stored(sales({}, {}).repartition(3))
    assert df.count() == 2
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert shared_folder(spark).removeprefix("file:") in df.inputFiles()[0]


def test_lineage_names_file_and_malformed_cells(spark, tmp_path):
    path = write(tmp_path, 2024, [{}, {"id_mutation": "B", "valeur_fonciere": "12x", "longitude": "-"}, {"id_mutation": "C", "code_postal": "NA"}])
    with gzip.open(path, "at", encoding="utf-8") as file:
        file.write("D,2024-03-15,Vente\n")
        file.write(",".join(["E", *["1"] * len(HEADER)]) + "\n")
    write(tmp_path, 2023, [{"id_mutation": "Z"}], header=HEADER[::-1])
    df = load_years(spark, str(tmp_path), "sales", "33", (2023, 2024), lineage=True)
    rows = {r.id_mutation: r for r in df.collect()}
    assert {k: r.malformed for k, r in rows.items()} == {
        "A": [], "B": ["valeur_fonciere", "longitude"], "C": [], "D": ["row"], "E": ["row"], "Z": [],
    }
    assert {r.source_file for k, r in rows.items() if k != "Z"} == {"sales_33_2024.csv.gz"}
    assert rows["Z"].source_file == "sales_33_2023.csv.gz" and rows["Z"].source_year == 2023
    assert (rows["B"].valeur_fonciere, rows["B"].code_postal, rows["D"].nature_mutation) == (None, 33000.0, "Vente")
    orders = [r[LOT_ORDER] for r in df.filter("source_year = 2024").orderBy(LOT_ORDER).collect()]
    assert len(set(orders)) == 5
    plain = {r.id_mutation: r for r in read_raw_file(spark, path, all_columns=True, lineage=True).collect()}
    assert plain["A"].adresse_nom_voie == 'RUE "X",\nBIS' and plain["A"].malformed == []


def test_without_lineage_a_malformed_cell_fails(spark, tmp_path):
    path = write(tmp_path, 2024, [{"valeur_fonciere": "12x"}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_raw_file(spark, path).collect()


def test_raw_files_written_by_the_library_read_back(spark, lots, tmp_path):
    table = lots({"id_mutation": "A", "nom_commune": 'L\'"Île",\nHaute'}, {"id_mutation": "B", "longitude": None}).drop(LOT_ORDER)
    path = raw_file_path(str(tmp_path), "sales", "33", 2023)
    write_raw_file(table.repartition(2), path)
    found = load_years(spark, str(tmp_path), "sales", "33", (2023,), lineage=True)
    assert sorted(map(tuple, found.select(*RAW_LOT.fieldNames()).collect())) == sorted(map(tuple, table.collect()))
    assert {(r.source_file, len(r.malformed)) for r in found.collect()} == {("sales_33_2023.csv.gz", 0)}


def test_a_rebuilt_year_leaves_the_others(spark, sales, tmp_path):
    path = str(tmp_path / "by_year")
    rows = [{"id_mutation": f"{y}{i}", "date_mutation": f"{y}-05-0{1 + i}"} for y in (2021, 2022, 2023) for i in range(3)]
    tables.publish_years(sales(*rows), path)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "by_year").rglob("*.parquet")}
    tables.publish_years(sales({"id_mutation": "new", "date_mutation": "2022-12-31"}), path)
    found = tables.read_years(spark, path)
    assert sorted((r.annee, r.id_mutation) for r in found.collect()) == [
        (2021, "20210"), (2021, "20211"), (2021, "20212"), (2022, "new"), (2023, "20230"), (2023, "20231"), (2023, "20232"),
    ]
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "by_year").rglob("*.parquet")}
    untouched = {n for n, t in before.items() if after.get(n) == t}
    assert untouched == {f.name for y in (2021, 2023) for f in (tmp_path / "by_year" / f"annee={y}").glob("*.parquet")}
    assert not [f for f in tmp_path.rglob("*") if "_temporary" in f.name or ".spark-staging" in f.name]


def test_the_split_reads_its_years_only(spark, sales, tmp_path):
    path = str(tmp_path / "by_year")
    days = [f"{y}-0{m}-15" for y in (2021, 2022, 2023, 2024) for m in (3, 8)]
    tables.publish_years(sales(*({"id_mutation": d, "date_mutation": d} for d in days)), path)
    published = tables.read_years(spark, path)
    for date, years in (("2023-01-01", ({2021, 2022}, {2023, 2024})), ("2022-07-01", ({2021, 2022}, {2022, 2023, 2024}))):
        parts = time_based_split(published, date)
        for part, wanted, keep in zip(parts, years, (lambda d: d < date, lambda d: d >= date), strict=True):
            assert sorted(r.id_mutation for r in part.collect()) == [d for d in days if keep(d)]
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert "annee" in plan.split("PartitionFilters: [")[1].split("]")[0]
            read = {r[0] for r in part.select("_metadata.file_path").distinct().collect()}
            assert {int(f.split("annee=")[1][:4]) for f in read} <= wanted


def test_storing_leaves_no_shuffle_files_and_no_setting(spark):
    before = spark.conf.get(FILE_CLEANUP, "false")
    grouped = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count()
    first = stored(grouped)
    assert spark.conf.get(FILE_CLEANUP, "false") == before
    # The same frame can be stored and read again: its shuffle is made anew.
    assert first.count() == stored(grouped).count() == grouped.count() == 7
