import gzip

import pytest

from lotwise.operators.quality import CleaningReport, DataQualityError
from lotwise.plans import training
from lotwise.plans.build import build_clean_table, exact_medians
from lotwise.plans.build import main as build_main
from lotwise.schemas import RAW_LOT


def test_gate_comes_before_the_write(lots, sales, tmp_path, spark):
    target = str(tmp_path / "clean")
    good = lots({"id_mutation": "A"}, {"id_mutation": "B"}, {"id_mutation": "B"})
    assert build_clean_table(good, target) == CleaningReport(3, 1)
    bad = lots(*({"id_mutation": f"s{i}", "valeur_fonciere": 1.0} for i in range(20)))
    with pytest.raises(DataQualityError):
        build_clean_table(bad, target)
    with pytest.raises(DataQualityError, match="empty"):
        build_clean_table(bad.limit(0), target)
    assert [r.id_mutation for r in spark.read.parquet(target).collect()] == ["A"]


def test_from_files_to_clean_table(spark, tmp_path):
    names = RAW_LOT.fieldNames()
    for year in (2022, 2023):
        with gzip.open(tmp_path / f"sales_33_{year}.csv.gz", "wt") as file:
            file.write(",".join(names) + "\n")
            for i in range(5):
                file.write(
                    f"{year}-{i},{year}-01-0{i + 1},Vente,{100000 + i},Pessac,33600,Maison,"
                    f"{50 + i},3,,-0.6,44.8\n"
                )
    build_main(
        ["--folder", str(tmp_path), "--dataset", "sales", "--destination", str(tmp_path / "clean")]
    )
    sales = spark.read.parquet(str(tmp_path / "clean"))
    assert sales.count() == 10
    assert tuple(exact_medians(sales).first()) == (100002.0, 52.0)


@pytest.mark.slow
def test_training_from_the_clean_table(spark, sales, tmp_path):
    years = ("2022-05-01", "2023-05-01", "2024-05-01")
    rows = [
        {"date_mutation": years[i % 3], "surface_bati": 20.0 + i, "prix": 3000.0 * (20 + i)}
        for i in range(45)
    ]
    sales(*rows).write.parquet(str(tmp_path / "clean"))
    training.main(
        ["--sales", str(tmp_path / "clean"), "--folder", str(tmp_path / "out"),
         "--max-iter", "3", "--max-depth", "3"]
    )
    card = spark.read.json(str(tmp_path / "out" / "model_card")).first()
    assert (card.training_sales, card.test_sales) == (30, 15)
