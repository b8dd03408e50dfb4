"""Clean sales to the star schema."""

from pyspark.sql import DataFrame

from lotwise.operators.warehouse import dim_commune, dim_date, fact_sales, stage_sales
from lotwise.sources.scratch import stored
from lotwise.sources.tables import publish_table, publish_view


def build_star_schema(
    sales: DataFrame, staging: str = "stg_ventes", marts: str = "marts"
) -> dict[str, DataFrame]:
    """Publish the staging view and the three mart tables; return them by name.

    The staged sales feed three models and are stored once under the view. The
    commune dimension is a table before the fact joins it, so its size is known.
    """
    staged = publish_view(stored(stage_sales(sales)), staging)
    communes = publish_table(dim_commune(staged), f"{marts}.dim_commune")
    dates = publish_table(dim_date(staged), f"{marts}.dim_date")
    facts = publish_table(fact_sales(staged, communes), f"{marts}.fct_ventes")
    return {staging: staged, "dim_commune": communes, "dim_date": dates, "fct_ventes": facts}
