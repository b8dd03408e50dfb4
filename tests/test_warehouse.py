import datetime as dt
import hashlib

from lotwise.operators.warehouse import dim_commune, dim_date, fact_sales, stage_sales
from lotwise.plans.marts import build_star_schema
from lotwise.schemas import STAGED_SALE


def test_staging_types(sales):
    staged = stage_sales(
        sales(
            {"code_postal": 1000.0, "nb_pieces": 2.5},
            {"code_postal": None, "nb_pieces": 4.0},
            {"code_postal": 33000.0, "nb_pieces": 0.0},
        )
    )
    assert [(f.name, f.dataType) for f in staged.schema] == [
        (f.name, f.dataType) for f in STAGED_SALE
    ]
    rows = staged.orderBy("id_mutation").collect()
    assert [r.code_postal for r in rows] == ["01000", None, "33000"]
    assert [r.nb_pieces for r in rows] == [3, 4, 0]
    assert rows[0].date_mutation == dt.date(2023, 10, 6)


def test_staging_keeps_one_row_per_key(sales):
    staged = stage_sales(sales({"id_mutation": "A"}, {"id_mutation": "A"}, {"id_mutation": "B"}))
    assert staged.count() == 2


def test_staging_refuses_a_malformed_date(sales):
    try:
        stage_sales(sales({"date_mutation": "15/03/2024"})).collect()
    except Exception as error:
        assert "2024" in str(error)
    else:
        raise AssertionError("a malformed date must fail")


def test_communes_merge_by_name(sales):
    staged = stage_sales(
        sales({"code_postal": 33100.0}, {"code_postal": 33000.0}, {"nom_commune": None})
    )
    rows = {r.nom_commune: r for r in dim_commune(staged).collect()}
    assert rows["Nantes"].code_postal == "33000"
    assert rows["Nantes"].commune_id == hashlib.md5(b"Nantes").hexdigest()
    marker = hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    assert rows[None].commune_id == marker


def test_calendar_covers_whole_years(sales):
    staged = stage_sales(sales({"date_mutation": "2022-05-10"}, {"date_mutation": "2024-02-01"}))
    days = dim_date(staged).orderBy("date_id").collect()
    assert len(days) == 365 + 365 + 366
    assert tuple(days[0]) == (dt.date(2022, 1, 1), 2022, 1, 1, "janvier", 7)
    assert tuple(days[-1]) == (dt.date(2024, 12, 31), 2024, 4, 12, "décembre", 3)
    assert [d.nom_mois for d in days if d.date_id == dt.date(2023, 8, 20)] == ["août"]
    assert [d.jour_semaine for d in days if d.date_id == dt.date(2023, 8, 20)] == [1]


def test_no_sales_no_calendar(sales):
    assert dim_date(stage_sales(sales({}).limit(0))).count() == 0


def test_fact_keeps_every_sale(sales):
    staged = stage_sales(sales({}, {"nom_commune": None}, {"surface_bati": 0.0}))
    communes = dim_commune(staged)
    facts = fact_sales(staged, communes).orderBy("id_mutation").collect()
    assert [f.commune_id is None for f in facts] == [False, True, False]
    assert [f.prix_m2 for f in facts] == [240_000 / 75, 240_000 / 75, None]
    assert facts[0].date_id == dt.date(2023, 10, 6)


def test_star_schema_is_published(spark, sales):
    df = sales({}, {}, {"nom_commune": "Pessac"})
    for _ in range(2):
        built = build_star_schema(df, marts="test_marts")
    try:
        assert spark.table("stg_ventes").count() == 3
        assert spark.table("test_marts.fct_ventes").count() == 3
        assert spark.table("test_marts.dim_commune").count() == 2
        assert spark.table("test_marts.dim_date").count() == 365
        assert built["fct_ventes"].join(built["dim_commune"], "commune_id").count() == 3
    finally:
        spark.sql("DROP SCHEMA test_marts CASCADE")


def test_small_dimension_is_broadcast_by_its_size(spark, sales):
    from lotwise.sources.scratch import stored

    staged = stored(stage_sales(sales({}, {"nom_commune": "Pessac"})))
    facts = fact_sales(staged, stored(dim_commune(staged)))
    assert "BroadcastHashJoin" in facts._jdf.queryExecution().executedPlan().toString()
