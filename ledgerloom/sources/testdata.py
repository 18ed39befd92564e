"""Derive the document model from the order and line-item test tables.

Headers come from orders, lines from line items, and the lookups from the small
tables.  All rows of a table take part; every value is a function of its row.
"""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import INVOICE_FIELD, SITE_FIELD
from ledgerloom.functions.rules import any_of, literal
from ledgerloom.sources.tables import DocumentTables

# The columns used of each test table; declared, so that no job reads a footer first.
STORED = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT",
}

# Fixed values of the derived data.
COMPANIES = (
    "ALLENTOWN", "MAI", "MP", "BAS", "WAR", "CLINTRAK", "SINGAPORE",
    "INDY", "HEG", "SUZHOU", "CHINA", "JAPAN", "KOREA", "OTHERCO",
)
DOCUMENT_CODES = ("SINV", "SCRN", "SCANCEL", "PINV", "SINV2")
CURRENCIES = ("USD", "EUR", "GBP")
ACCOUNTS = ("0211", "0212", "40100", "23170", "24300", "28020")
CUSTOMER_PREFIXES = ("ICOM", "X", "IF", "D", "C")
REF1_COMPANIES = ("ALLENTOWN", "MAI", "CHINA", "SINGAPORE", "CLINTRAK", "MP")


def _array(values: tuple[str, ...]) -> str:
    return f"array({', '.join(literal(v) for v in values)})"


def _pick(values: tuple[str, ...], number: str) -> str:
    """The value at ``number`` modulo the count of values."""
    return f"{_array(values)}[int({number} % {len(values)})]"


def dochead(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{_pick(COMPANIES, 'o_orderkey')} AS cmpcode",
        f"{_pick(DOCUMENT_CODES, 'o_orderkey')} AS doccode",
        "concat('  ', o_orderkey) AS docnum",
        "date_add(date(o_orderdate), 8401) AS docdate",
        f"{_pick(CURRENCIES, 'o_orderkey')} AS curdoc",
        "CASE WHEN o_orderkey % 17 = 0 THEN 'D' WHEN o_orderkey % 19 != 0 THEN 'I' END"
        " AS cdc_operation_type",
    )


def docline(lineitem: DataFrame) -> DataFrame:
    site_ref = "concat('PT', lpad(string(l_suppkey), 4, '0'), '-', l_orderkey)"

    def places(number: str) -> str:
        return f"CASE {number} % 5 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 2 END"

    return lineitem.selectExpr(
        f"{_pick(COMPANIES, 'l_orderkey')} AS cmpcode",
        f"{_pick(DOCUMENT_CODES, 'l_orderkey')} AS doccode",
        "string(l_orderkey) AS docnum",
        "CASE l_returnflag WHEN 'R' THEN 665 WHEN 'A' THEN 84 ELSE 85 END AS statpay",
        "floor(l_extendedprice * 100 + 0.5D) AS valuedoc",
        "floor(l_extendedprice * l_quantity + 0.5D) AS valuehome",
        f"{places('l_partkey')} AS valuedoc_dp",
        f"{places('l_suppkey')} AS valuehome_dp",
        f"CASE WHEN l_linenumber <= {len(ACCOUNTS)} THEN {_pick(ACCOUNTS, '(l_linenumber - 1)')} END"
        " AS el2",
        f"concat({_pick(CUSTOMER_PREFIXES, 'l_partkey')}, l_suppkey % 20) AS el3",
        "CASE l_partkey % 4 WHEN 1 THEN '' WHEN 2 THEN concat('X', l_suppkey)"
        " WHEN 3 THEN concat('J', l_partkey) END AS el4",
        "concat(if(l_orderkey % 4 = 0, 'CN', 'R1'), l_orderkey) AS ref1",
        "if(l_partkey % 11 = 0, 'Recharges Q1', concat('R2', l_partkey)) AS ref2",
        f"if(l_partkey % 3 = 0, {site_ref}, concat('R3', l_suppkey)) AS ref3",
        "concat('PO', l_partkey) AS ref4",
        "CASE WHEN l_suppkey % 13 = 0 THEN concat('PT0001-Reimb', l_orderkey)"
        " WHEN l_suppkey % 17 = 0 THEN 'Consolidated'"
        f" WHEN l_partkey % 3 = 1 THEN {site_ref}"
        " WHEN l_partkey % 7 = 0 THEN NULL"
        " WHEN l_partkey % 9 = 0 THEN concat('R5', l_orderkey, 'A')"
        " ELSE concat('R5', l_orderkey) END AS ref5",
    )


def company(nation: DataFrame) -> DataFrame:
    number = f"(n_nationkey % {len(COMPANIES)})"
    return nation.selectExpr(
        f"{_pick(COMPANIES, number)} AS code", f"{_pick(CURRENCIES, number)} AS homecur"
    ).distinct()


def customer_numbers(supplier: DataFrame) -> DataFrame:
    """Customer elements of all companies."""
    numbers = supplier.selectExpr("s_suppkey % 20 AS number").distinct()
    return numbers.selectExpr("number", f"explode({_array(COMPANIES)}) AS code").selectExpr(
        "number", "code", f"explode({_array(CUSTOMER_PREFIXES)}) AS prefix"
    )


def el2_element(nation: DataFrame) -> DataFrame:
    """Each account on levels 1 and 2; one level-2 account is stored twice."""
    accounts = f"if(code = 'BAS', {_array((*ACCOUNTS, '40100'))}, {_array(ACCOUNTS)})"
    rows = company(nation).selectExpr("code", f"explode({accounts}) AS account")
    return rows.selectExpr("code", "account", "explode(array(1, 2)) AS level").selectExpr(
        "code AS el2_cmpcode",
        "account AS el2_code",
        "level AS el2_elmlevel",
        "concat('Account ', account, ' level ', level) AS el2_name",
    )


def el3_element(supplier: DataFrame) -> DataFrame:
    """Each customer on levels 2 and 3; two numbers have an old code, some of MAI two names."""
    levels = "if(code = 'MAI' AND number = 3, array(2, 3, 3), array(2, 3))"
    rows = customer_numbers(supplier).selectExpr(
        "code", "prefix", "number", f"posexplode({levels}) AS (pos, level)"
    )
    return rows.selectExpr(
        "code AS el3_cmpcode",
        "concat(if(number IN (6, 13), 'old', ''), prefix, number) AS el3_code",
        "level AS el3_elmlevel",
        "concat('Customer ', prefix, number, '/', pos) AS el3_name",
    )


def client_master(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "string(c_custkey) AS m_code",
        "string(c_nationkey) AS client_ultimate_parent_id",
        "c_mktsegment AS global_ultimate_business_name",
    )


def client_xref(orders: DataFrame) -> DataFrame:
    """Orders of one status are those of a client; the others have a code that no client has."""
    return orders.selectExpr(
        "concat(if(o_orderstatus = 'F', '', '-'), o_custkey) AS m_code",
        "if(o_orderkey % 10 = 0, concat('S', o_orderkey), concat(o_orderkey % 40, 'S')) AS site_id",
        "string(o_orderkey) AS c_code",
    )


def ref_correction(orders: DataFrame) -> DataFrame:
    """Corrections of urgent and high-priority orders, some with two; the others name another field."""
    site, number = literal(SITE_FIELD), literal(INVOICE_FIELD)
    fields = (
        "CASE concat(o_orderpriority, o_orderstatus)"
        f" WHEN '1-URGENTP' THEN array({site}, {number}) WHEN '1-URGENTF' THEN array({site})"
        f" WHEN '2-HIGHP' THEN array({site}, {site}) WHEN '2-HIGHF' THEN array({number}, {number})"
        " ELSE array('Remark') END"
    )
    rows = orders.selectExpr(
        "o_orderkey AS k",
        f"{_pick(COMPANIES, 'o_orderkey')} AS Instance",
        f"{_pick(DOCUMENT_CODES, 'o_orderkey')} AS DocCode",
        f"posexplode({fields}) AS (pos, Field)",
    )
    return rows.selectExpr(
        "Instance",
        "DocCode",
        f"CASE WHEN NOT {any_of('Instance', REF1_COMPANIES)} THEN string(k)"
        " WHEN k % 4 = 0 THEN concat('CN', k) ELSE concat('R1', k) END AS Title",
        "Field",
        f"CASE WHEN Field = {site} THEN if(k % 8 = 0, NULL, concat('PT00', k % 7, pos))"
        " WHEN k % 5 = 0 THEN concat('Reimb-', k) ELSE concat('C', k) END AS FieldValue",
    )


def map_entity(nation: DataFrame) -> DataFrame:
    """One company has another name, one has two sites."""
    sites = "explode(if(code = 'JAPAN', array('1', '2'), array('1'))) AS n"
    return company(nation).selectExpr("code", sites).selectExpr(
        "if(code = 'HEG', 'HEG old', code) AS CODA",
        "concat('Site ', code, ' ', n) AS gpm_site",
        "if(code != 'INDY', concat(left(code, 3), '-'), NULL) AS cForia",
    )


def map_ic_entity(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Partners of delivering sites; those of the last nations' suppliers deliver nothing."""
    by_site = [f"concat('{c}PT', lpad(string(s_suppkey), 4, '0'))" for c in ("BAS", "WAR", "MAI")]
    by_code = [f"concat('{c}X', s_suppkey)" for c in ("ALLENTOWN", "MP", "CLINTRAK")]
    partners = supplier.selectExpr(
        "*", f"explode(array({', '.join(by_site + by_code)})) AS site"
    ).selectExpr(
        "if(s_nationkey < 20, site, concat('old', site)) AS `InvoiceCmp-OriginatingIC`",
        "concat('Omni ', s_suppkey % 9) AS `IC_Partner-OMNI`",
        "if(s_suppkey % 10 != 0, concat('partner', s_suppkey % 5), NULL) AS `IC_Partner-CODA`",
    )
    own = company(nation).selectExpr(
        "concat(code, code) AS `InvoiceCmp-OriginatingIC`",
        "concat('Omni ', code) AS `IC_Partner-OMNI`",
        "code AS `IC_Partner-CODA`",
    )
    return partners.unionByName(own)


def category(supplier: DataFrame) -> DataFrame:
    """Categories; those of some customer prefixes have an old key, one key is stored twice."""
    copies = "if(code = 'BAS' AND number = 4, array('a', 'b'), array('a'))"
    rows = customer_numbers(supplier).selectExpr(
        "code", "prefix", "number", f"explode({copies}) AS copy"
    )
    return rows.selectExpr(
        "concat(if(prefix IN ('ICOM', 'X', 'D'), '', 'old'), code, prefix, number) AS `Facility|GLCode-CPQREF`",
        "concat('Category ', prefix) AS `AI Enhanced - CPQ Category`",
        "concat('Sub ', number % 4, copy) AS `AI Enhanced - CPQ SubCategory`",
    )


SOURCES = {
    docline: ("lineitem",),
    dochead: ("orders",),
    company: ("nation",),
    el2_element: ("nation",),
    el3_element: ("supplier",),
    client_master: ("customer",),
    client_xref: ("orders",),
    ref_correction: ("orders",),
    map_entity: ("nation",),
    map_ic_entity: ("supplier", "nation"),
    category: ("supplier",),
}


def load(spark: SparkSession, sf_dir: str) -> DocumentTables:
    """All document tables over the test tables in ``sf_dir``."""

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.schema(STORED[name]).parquet(f"{sf_dir}/{name}.parquet")

    def derived(build, names: tuple[str, ...]) -> DataFrame:
        return build(*[table(name) for name in names])

    return DocumentTables(
        **{build.__name__: partial(derived, build, names) for build, names in SOURCES.items()}
    )
