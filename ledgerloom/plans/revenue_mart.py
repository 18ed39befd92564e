"""Revenue mart: amounts per revenue line attributes and paying customer.

A result row is a group of revenue lines of one document paired with one
customer element of that document.  Every side of that pairing is aggregated
first and carries the number of rows it stands for, so that a document with
very many lines, headers or customer lines never multiplies out row by row;
the sums are multiplied instead.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.config import CDC_DELETE, RevenueConfig
from ledgerloom.functions import invoice
from ledgerloom.functions.columns import since, summed_amount
from ledgerloom.operators.aggregates import earliest_value, with_copies
from ledgerloom.operators.grid import BLOCK, grid_join
from ledgerloom.operators.keys import KEY, RAW_KEY, document_columns, document_join, with_document_key
from ledgerloom.operators.lookups import SPREAD, is_small, lookup_join, planned_bytes
from ledgerloom.operators.reduction import likely_in
from ledgerloom.sources.tables import DocumentTables

ACCOUNT_LEVEL = 2
CUSTOMER_LEVEL = 3

LINE_KEYS = [
    *RAW_KEY, "global_identifier", "statpay", "docdate", "curdoc", "el3",
    "invoice_number", "po_value", "protocol_value", "el2", "el4",
]


def names_customer(cfg: RevenueConfig = RevenueConfig()) -> Column:
    """Whether a line is an unpaid receivable, which names a customer of its document."""
    account = F.col("el2")
    extra = F.col("cmpcode").isin(*cfg.customer_extra_companies) & (
        account == cfg.customer_extra_account
    )
    return (account.startswith(cfg.customer_prefix) | extra) & (F.col("statpay") != cfg.paid_status)


def customer_lines(
    tables: DocumentTables,
    cfg: RevenueConfig = RevenueConfig(),
    dedup: bool = False,
    drop_cdc_deletes: bool = True,
    check_heads: bool = True,
) -> DataFrame:
    """(document, customer element) of the receivable lines and their multiplicity.

    ``ar_copies`` is how many line-header pairs stand behind a row; with
    ``dedup`` it is 1.  ``check_heads=False`` says that the caller already
    requires a header in the date range; the header join is then left out where
    it would add nothing else.
    """
    lines = tables.docline.filter(names_customer(cfg))
    grouped = with_document_key(with_copies(lines, [*document_columns(lines), "el3"], "line_copies"))
    once = F.lit(1).cast("long")
    customer = F.col("el3").alias("customer_el3")
    if dedup and not drop_cdc_deletes and not check_heads:
        return grouped.select(*RAW_KEY, customer, once.alias("ar_copies"))
    heads = since(tables.dochead, "docdate", cfg.first_day)
    if drop_cdc_deletes:
        heads = heads.filter(F.col("cdc_operation_type") != CDC_DELETE)
    heads = with_document_key(heads)
    if dedup:
        found = document_join(grouped, heads.select(*KEY), "left_semi")
        return found.select(*RAW_KEY, customer, once.alias("ar_copies"))
    # Counted by day as well, so that the join below has an exchange on both sides
    # and Spark can divide a document with very many customer elements.
    per_day = with_copies(heads, [*KEY, "docdate"], "head_copies")
    return (
        document_join(grouped, per_day)
        .groupBy(*RAW_KEY, customer)
        .agg(F.sum(F.col("line_copies") * F.col("head_copies")).alias("ar_copies"))
    )


def is_revenue(cfg: RevenueConfig = RevenueConfig()) -> Column:
    """Whether a line is on a revenue account; all conditions are on the line."""
    company, account = F.col("cmpcode"), F.col("el2")
    on_account = (
        account.startswith(cfg.account_prefix)
        | account.between(*cfg.account_range)
        | (company.isin(*cfg.extra_companies) & (account == cfg.extra_account))
    )
    recharge = (company == cfg.recharge_company) & F.col("ref2").contains(cfg.recharge_text)
    foreign_job = company.isin(*cfg.foreign_job_companies) & F.col("el4").startswith(
        cfg.foreign_job_prefix
    )
    excluded = F.col("doccode").isin(*cfg.excluded_codes)
    return on_account & ~recharge & ~foreign_job & ~excluded


def revenue_lines(docline: DataFrame, cfg: RevenueConfig = RevenueConfig()) -> DataFrame:
    """Lines on revenue accounts; the conditions reach the scan."""
    return docline.filter(is_revenue(cfg))


def head_rows(dochead: DataFrame) -> DataFrame:
    """Headers reduced to what revenue needs, each once with its number of copies."""
    slim = with_document_key(dochead).select(
        *KEY,
        F.col("cmpcode").alias("head_company"),
        F.ltrim("docnum").alias("head_number"),
        "docdate",
        "curdoc",
    )
    return with_copies(slim, slim.columns, "head_copies")


def with_line_fields(lines: DataFrame, heads: DataFrame, cfg: RevenueConfig) -> DataFrame:
    """Lines joined to their headers, with the four derived text fields."""
    return document_join(with_document_key(lines), heads).withColumns({
        "global_identifier": invoice.revenue_global_identifier(cfg),
        "invoice_number": invoice.revenue_invoice_number(cfg),
        "po_value": invoice.revenue_purchase_order(cfg),
        "protocol_value": invoice.revenue_protocol(cfg),
    })


def revenue_groups(tables: DocumentTables, cfg: RevenueConfig = RevenueConfig()) -> DataFrame:
    """Scaled sums per line attributes, before any customer is attached."""
    heads = head_rows(since(tables.dochead, "docdate", cfg.first_day))
    base = with_line_fields(revenue_lines(tables.docline, cfg), heads, cfg)
    amounts = [
        summed_amount(name, f"{name}_dp", "raw", cfg.exact_amounts, copies="head_copies").alias(name)
        for name in ("valuehome", "valuedoc")
    ]
    return base.groupBy(*LINE_KEYS).agg(*amounts)


def crowded(tables: DocumentTables, cfg: RevenueConfig = RevenueConfig(), block: int = BLOCK) -> DocumentTables:
    """The tables cut to documents that may make more than block * block pairs of a revenue group and a customer.

    A document has no more groups than revenue lines times headers, and no more customers than
    lines that name one times the names of an element.  Documents are counted by a
    hash: those that share one are kept together.  Mostly none is left, and the cut tables are
    then not read at all.
    """
    document = F.xxhash64(*KEY).alias("document")
    no, of_revenue, names = F.lit(False), is_revenue(cfg), names_customer(cfg)
    lines = with_document_key(tables.docline.filter(of_revenue | names))
    heads = with_document_key(since(tables.dochead, "docdate", cfg.first_day))
    rows = lines.select(document, of_revenue.alias("revenue"), names.alias("customer"), no.alias("head")).unionByName(
        heads.select(document, no.alias("revenue"), no.alias("customer"), F.lit(True).alias("head"))
    )
    counts = rows.groupBy("document").agg(*[F.count_if(c).cast("double").alias(c) for c in ("revenue", "customer", "head")])
    per_element = with_copies(_customers(tables.el3_element), ["el3_cmpcode", "el3_code"], "names")
    pairs = F.col("revenue") * F.col("head") * F.col("customer") * F.col("most_names")
    many = counts.join(F.broadcast(per_element.agg(F.max("names").alias("most_names")))).filter(pairs > block * block)

    def cut(df: DataFrame) -> DataFrame:
        keyed = with_document_key(df)
        return likely_in(keyed.withColumn("document", document), many, ["document"]).select(*df.columns)

    return DocumentTables(docline=cut(tables.docline), dochead=cut(tables.dochead), el3_element=tables.el3_element)


def job_defaults(
    tables: DocumentTables,
    nulls: str = "ignore",
    needed: Column | None = None,
    reduced: bool | None = None,
) -> DataFrame:
    """Job element of the earliest document per company.

    Lines and headers are both brought to one row per document first; the
    earliest job of a document is its smallest on the earliest header day.

    ``reduced`` first finds for each company a day by which its default must have
    come up (``_last_possible_day``) and shuffles only documents up to that day
    (``_early``); by default where the lines are larger than ``REDUCE_FROM``, as it costs
    another pass over lines and headers.  ``needed`` is a condition on lines: companies
    without such a line may then be left out.
    """
    lines, heads = tables.docline.filter(F.col("el4") != ""), with_document_key(tables.dochead)
    if is_large(tables.docline) if reduced is None else reduced:
        lines, heads = _early(tables, lines, heads, nulls, F.lit(True) if needed is None else needed)
    jobs = lines.groupBy(*document_columns(lines)).agg(F.min("el4").alias("el4"))
    days = heads.groupBy(*KEY).agg(
        F.min("docdate").alias("docdate"),
        F.count(F.when(F.col("docdate").isNull(), 1)).alias("undated"),
    )
    dated = document_join(with_document_key(jobs), days).select(
        "cmpcode",
        "el4",
        F.when(F.lit(nulls == "first") & (F.col("undated") > 0), None)
        .otherwise(F.col("docdate"))
        .alias("docdate"),
    )
    return earliest_value(dated, ["cmpcode"], "docdate", "el4", "default_el4", nulls)


#: Lines of so many bytes, by Spark's estimate, are worth another pass.
REDUCE_FROM = 1024**3


def is_large(docline: DataFrame) -> bool:
    size = planned_bytes(docline)
    return size is not None and size > REDUCE_FROM


#: Documents looked up for each company, and days kept for all companies together.
LOOKED_UP, DAYS = 32, 4096
NEVER = date(9999, 12, 31)


def _day_slot(company: Column) -> Column:
    return F.pmod(F.xxhash64(company), F.lit(DAYS))


def _last_possible_day(
    tables: DocumentTables, heads: DataFrame, needed: Column
) -> DataFrame:
    """(slot, last_day): the default of a company in a slot comes up by that day.

    One document with a job out of every slice of a company's numbers, the smallest of
    each, is looked up; the default cannot come after the earliest day of
    these.  Companies without a dated one have no such day.  A slot holds the
    companies that share a hash, so the table has at most ``DAYS`` rows whatever the
    number of companies, and a last day that is too late only leaves more rows.
    """
    has_job = F.col("el4") != ""
    wanted = F.coalesce(needed, F.lit(False))
    picked = (
        with_document_key(tables.docline.filter(has_job | wanted))
        .groupBy("cmpcode", F.pmod(F.xxhash64("docnum"), F.lit(LOOKED_UP)).alias("slice"))
        .agg(F.min(F.when(has_job, F.struct(*KEY))).alias("document"), F.max(wanted).alias("needed"))
    )
    named = picked.select("cmpcode", "needed", "document.*")
    found = likely_in(heads.filter("docdate is not null").select(*KEY, "docdate"), named.filter("key_number is not null"), list(KEY))
    days = document_join(named, found, "left").groupBy("cmpcode").agg(
        F.max("needed").alias("needed"), F.min("docdate").alias("docdate")
    )
    slot = _day_slot(F.trim("cmpcode")).alias("day_slot")
    return days.filter("needed").groupBy(slot).agg(F.max(F.coalesce("docdate", F.lit(NEVER))).alias("last_day"))


def _early(
    tables: DocumentTables, lines: DataFrame, heads: DataFrame, nulls: str, needed: Column
) -> tuple[DataFrame, DataFrame]:
    """Lines and headers of the documents that can give a default."""
    bounds = F.broadcast(_last_possible_day(tables, heads, needed))
    by_day = F.col("docdate") <= F.col("last_day")
    undated = F.col("docdate").isNull() & (F.lit(nulls == "first") | (F.col("last_day") == F.lit(NEVER)))
    early = (
        heads.select(*KEY, "docdate")
        .join(bounds, _day_slot(F.col("key_company")) == F.col("day_slot"))
        .filter(by_day | undated)
        .select(*KEY, "docdate")
    )
    keyed = with_document_key(lines.select(*RAW_KEY, "el4"))
    return likely_in(keyed, early.select(*KEY).distinct(), list(KEY)).select(*RAW_KEY, "el4"), early


def _customers(el3_element: DataFrame) -> DataFrame:
    level = el3_element.filter(F.col("el3_elmlevel") == CUSTOMER_LEVEL)
    return with_copies(level, ["el3_cmpcode", "el3_code", "el3_name"], "el3_copies")


def _accounts(el2_element: DataFrame) -> DataFrame:
    level = el2_element.filter(F.col("el2_elmlevel") == ACCOUNT_LEVEL)
    return with_copies(level, ["el2_cmpcode", "el2_code", "el2_name"], "el2_copies")


def _companies(tables: DocumentTables, defaults: DataFrame) -> DataFrame:
    """Company rows with their default job.

    Defaults are first cut to known companies, so they have no more rows than
    the company table, and that table's size decides for both.
    """
    companies = with_copies(tables.company, ["code", "homecur"], "company_copies")
    codes = tables.company.select(F.col("code").alias("cmpcode")).distinct()
    small = is_small(tables.company)
    known = defaults.join(F.broadcast(codes) if small else codes, "cmpcode", "left_semi")
    known = known.withColumnRenamed("cmpcode", "default_company")
    return companies.join(
        F.broadcast(known) if small else known,
        F.col("code") == F.col("default_company"),
        "left",
    ).drop("default_company")


def revenue_mart(
    tables: DocumentTables,
    cfg: RevenueConfig = RevenueConfig(),
    dedup_ar_lines: bool = False,
    drop_cdc_deletes: bool = True,
    default_nulls: str = "ignore",
    unique_lookups: bool = False,
    reduce_history: bool | None = None,
    deal_hot_documents: bool | None = None,
) -> DataFrame:
    """The mart in either published form.

    Defaults: customer lines count as often as they occur, deleted headers give
    no customer, undated documents give no default job.  The other form is
    ``dedup_ar_lines=True, drop_cdc_deletes=False, default_nulls="first"``.
    ``reduce_history`` is ``reduced`` of ``job_defaults``.  ``deal_hot_documents`` deals
    a document with many revenue groups and many customers in a grid, by default
    where the lines are larger than ``REDUCE_FROM``.
    """
    blank_job = F.coalesce(F.col("el4") == "", F.lit(True))

    def sides(t: DocumentTables, unique: bool = False) -> tuple[DataFrame, DataFrame]:
        # A revenue group comes from a dated header of the same document already.
        customers = lookup_join(
            customer_lines(t, cfg, dedup_ar_lines, drop_cdc_deletes, check_heads=False),
            _customers(t.el3_element),
            {"cmpcode": "el3_cmpcode", "customer_el3": "el3_code"},
            how="inner",
            spread_by=RAW_KEY,
            unique=unique,
        )
        return revenue_groups(t, cfg), customers

    groups, customers = sides(tables, unique_lookups)
    grid = is_large(tables.docline) if deal_hot_documents is None else deal_hot_documents
    if grid:
        grouped = grid_join(groups, customers, list(RAW_KEY), counted=sides(crowded(tables, cfg)))
    else:
        grouped = groups.join(customers, list(RAW_KEY))
    spread_by = (*RAW_KEY, "el2", "el3", "customer_el3")
    with_account = lookup_join(
        grouped,
        _accounts(tables.el2_element),
        {"cmpcode": "el2_cmpcode", "el2": "el2_code"},
        how="inner",
        spread_by=spread_by,
        unique=unique_lookups,
    )
    complete = lookup_join(
        with_account,
        _companies(tables, job_defaults(tables, default_nulls, is_revenue(cfg) & blank_job, reduce_history)),
        {"cmpcode": "code"},
        how="inner",
        spread=SPREAD,
        spread_by=spread_by,
        sized_by=tables.company,
        unique=unique_lookups,
    )
    copies = reduce(
        lambda a, b: a * b,
        [F.col(c) for c in ("ar_copies", "el3_copies", "el2_copies", "company_copies")],
    )
    return complete.select(
        invoice.site_id(site_ids=cfg.site_ids).alias("SiteID"),
        "cmpcode",
        F.col("global_identifier").alias("Global_Identifier"),
        "statpay",
        F.col("docdate").alias("InvoiceDate"),
        (F.col("valuehome") * copies).cast("double").alias("valuehome"),
        F.col("homecur").alias("ValueHomeCurrency"),
        (F.col("valuedoc") * copies).cast("double").alias("valuedoc"),
        "curdoc",
        F.col("customer_el3").alias("CustomerNumber"),
        F.col("el3_name").alias("CustomerName"),
        "el3",
        F.col("invoice_number").alias("InvoiceNumber"),
        F.col("po_value").alias("PO"),
        F.col("protocol_value").alias("Protocol"),
        invoice.job_or_default(F.col("el4"), F.col("default_el4")).alias("JobNumber"),
        "docnum",
        "doccode",
        "el2",
        F.col("el2_name").alias("name"),
    )
