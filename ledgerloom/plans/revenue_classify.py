"""Type, format and classify revenue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.config import ClassifyConfig
from ledgerloom.functions import invoice
from ledgerloom.functions.columns import currency_text, day
from ledgerloom.operators.lookups import lookup_join
from ledgerloom.sources.tables import DocumentTables


def revenue_classify(
    revenue: DataFrame,
    tables: DocumentTables,
    null_currency: str | None = "$nu",
    unique_lookups: bool = False,
    cfg: ClassifyConfig = ClassifyConfig(),
) -> DataFrame:
    """Add texts, keys, pass-through flags, entity and category to a revenue mart."""
    company, customer = F.col("cmpcode"), F.col("el3")
    typed = revenue.withColumns({
        "InvoiceDate": day(F.col("InvoiceDate")),
        "valuedoc": F.col("valuedoc").cast("double"),
        "valuehome": F.col("valuehome").cast("double"),
    })
    flagged = typed.withColumns({
        "valuedoc_formatted": currency_text(F.col("valuedoc"), null_currency),
        "valuehome_formatted": currency_text(F.col("valuehome"), null_currency),
        "Key_global_identifier": F.concat("SiteID", "InvoiceNumber", "el3"),
        "Pass_Through_Flag": invoice.pass_through_flag(cfg=cfg),
        "Site_GL_CODE": F.upper(F.concat(company, customer)),
    }).withColumn("Pass_Through_Flag2", invoice.pass_through_class(cfg=cfg))
    spread_by = ("Global_Identifier", "docnum", "el2", "CustomerNumber")
    entities = tables.map_entity.select("CODA", F.col("CODA").alias("MAP_Entity_CODA"))
    mapped = lookup_join(
        flagged, entities, {"cmpcode": "CODA"}, spread_by=spread_by, unique=unique_lookups
    )
    code = F.col("`Facility|GLCode-CPQREF`")
    categories = tables.category.select(
        code.alias("__code"),
        code,
        F.col("AI Enhanced - CPQ Category").alias("CPQ Category"),
        F.col("AI Enhanced - CPQ SubCategory").alias("CPQ SubCategory"),
    )
    named = lookup_join(
        mapped, categories, {"Site_GL_CODE": "__code"}, spread_by=spread_by, unique=unique_lookups
    )
    return named.select(
        *revenue.columns,
        "valuedoc_formatted",
        "valuehome_formatted",
        "Key_global_identifier",
        "Pass_Through_Flag",
        "Pass_Through_Flag2",
        "MAP_Entity_CODA",
        "Site_GL_CODE",
        code,
        "CPQ Category",
        "CPQ SubCategory",
        F.lit(cfg.source_name).alias("Source"),
    )
