"""Independent SQL for every registered query, in DuckDB's dialect.

Written from the definitions of the fields, in the plainest form (joins on
trimmed keys, OR joins, windows), so that the rewritten plans are compared with
something that shares none of their structure.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTES[name] = (needs, body)


def with_ctes(needs: tuple[str, ...], body: str, given: tuple[str, ...] = ()) -> str:
    """``body`` after the clauses it needs; names in ``given`` exist as tables already."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered or name in given:
            return
        for other in CTES[name][0]:
            visit(other)
        ordered.append(name)

    for name in needs:
        visit(name)
    clauses = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    return f"WITH {clauses}\n{body}" if clauses else body


# Fixed values of the test tables.
_COMPANIES = (
    "['ALLENTOWN','MAI','MP','BAS','WAR','CLINTRAK','SINGAPORE',"
    "'INDY','HEG','SUZHOU','CHINA','JAPAN','KOREA','OTHERCO']"
)
_CODES = "['SINV','SCRN','SCANCEL','PINV','SINV2']"
_CURRENCIES = "['USD','EUR','GBP']"

# document model ------------------------------------------------------------

_cte("dochead", (), f"""
SELECT ({_COMPANIES})[o_orderkey % 14 + 1] AS cmpcode,
       ({_CODES})[o_orderkey % 5 + 1] AS doccode,
       '  ' || o_orderkey::varchar AS docnum,
       (CAST(o_orderdate AS date) + 8401) AS docdate,
       ({_CURRENCIES})[o_orderkey % 3 + 1] AS curdoc,
       CASE WHEN o_orderkey % 17 = 0 THEN 'D' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'I' END
         AS cdc_operation_type
FROM orders""")

_cte("docline", (), f"""
SELECT ({_COMPANIES})[l_orderkey % 14 + 1] AS cmpcode,
       ({_CODES})[l_orderkey % 5 + 1] AS doccode,
       l_orderkey::varchar AS docnum,
       CASE l_returnflag WHEN 'R' THEN 665 WHEN 'A' THEN 84 ELSE 85 END AS statpay,
       CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS valuedoc,
       CAST(floor(l_extendedprice * l_quantity + 0.5) AS BIGINT) AS valuehome,
       CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 2 END AS valuedoc_dp,
       CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 2 END AS valuehome_dp,
       CASE l_linenumber WHEN 1 THEN '0211' WHEN 2 THEN '0212' WHEN 3 THEN '40100'
            WHEN 4 THEN '23170' WHEN 5 THEN '24300' WHEN 6 THEN '28020' END AS el2,
       (['ICOM','X','IF','D','C'])[l_partkey % 5 + 1] || (l_suppkey % 20)::varchar AS el3,
       CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'X' || l_suppkey
            ELSE 'J' || l_partkey END AS el4,
       CASE WHEN l_orderkey % 4 = 0 THEN 'CN' ELSE 'R1' END || l_orderkey AS ref1,
       CASE WHEN l_partkey % 11 = 0 THEN 'Recharges Q1' ELSE 'R2' || l_partkey END AS ref2,
       CASE WHEN l_partkey % 3 = 0 THEN 'PT' || lpad(l_suppkey::varchar, 4, '0') || '-' || l_orderkey
            ELSE 'R3' || l_suppkey END AS ref3,
       'PO' || l_partkey AS ref4,
       CASE WHEN l_suppkey % 13 = 0 THEN 'PT0001-Reimb' || l_orderkey
            WHEN l_suppkey % 17 = 0 THEN 'Consolidated'
            WHEN l_partkey % 3 = 1 THEN 'PT' || lpad(l_suppkey::varchar, 4, '0') || '-' || l_orderkey
            WHEN l_partkey % 7 = 0 THEN NULL
            WHEN l_partkey % 9 = 0 THEN 'R5' || l_orderkey || 'A'
            ELSE 'R5' || l_orderkey END AS ref5
FROM lineitem""")

_cte("company", (), f"""
SELECT DISTINCT ({_COMPANIES})[n_nationkey % 14 + 1] AS code,
       ({_CURRENCIES})[(n_nationkey % 14) % 3 + 1] AS homecur
FROM nation""")

_cte("el2_element", ("company",), """
SELECT code AS el2_cmpcode, account AS el2_code, lvl AS el2_elmlevel,
       'Account ' || account || ' level ' || lvl AS el2_name
FROM (SELECT code, unnest(CASE WHEN code = 'BAS'
               THEN ['0211','0212','40100','23170','24300','28020','40100']
               ELSE ['0211','0212','40100','23170','24300','28020'] END) AS account FROM company),
     (SELECT unnest([1, 2]) AS lvl)""")

_cte("customer_numbers", (), f"""
SELECT number, code, prefix
FROM (SELECT DISTINCT s_suppkey % 20 AS number FROM supplier),
     (SELECT unnest({_COMPANIES}) AS code),
     (SELECT unnest(['ICOM','X','IF','D','C']) AS prefix)""")

_cte("el3_element", ("customer_numbers",), """
SELECT code AS el3_cmpcode, CASE WHEN number IN (6, 13) THEN 'old' ELSE '' END || prefix || number AS el3_code, lvl AS el3_elmlevel,
       'Customer ' || prefix || number || '/' || pos AS el3_name
FROM customer_numbers, (VALUES (2, 0), (3, 1), (3, 2)) AS levels(lvl, pos)
WHERE pos < 2 OR (code = 'MAI' AND number = 3)""")

_cte("client_master", (), """
SELECT c_custkey::varchar AS m_code, c_nationkey::varchar AS client_ultimate_parent_id,
       c_mktsegment AS global_ultimate_business_name
FROM customer""")

_cte("client_xref", (), """
SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey::varchar ELSE '-' || o_custkey END AS m_code,
       CASE WHEN o_orderkey % 10 = 0 THEN 'S' || o_orderkey ELSE (o_orderkey % 40) || 'S' END AS site_id,
       o_orderkey::varchar AS c_code
FROM orders""")

_cte("ref_correction", (), f"""
SELECT Instance, DocCode, Title, Field,
       CASE WHEN Field = 'ServiceDeliverySite'
            THEN CASE WHEN k % 8 = 0 THEN NULL ELSE 'PT00' || (k % 7) || pos END
            WHEN k % 5 = 0 THEN 'Reimb-' || k ELSE 'C' || k END AS FieldValue
FROM (
  SELECT o_orderkey AS k, ({_COMPANIES})[o_orderkey % 14 + 1] AS Instance,
         ({_CODES})[o_orderkey % 5 + 1] AS DocCode,
         CASE WHEN ({_COMPANIES})[o_orderkey % 14 + 1]
                   IN ('ALLENTOWN','MAI','CHINA','SINGAPORE','CLINTRAK','MP')
              THEN CASE WHEN o_orderkey % 4 = 0 THEN 'CN' ELSE 'R1' END || o_orderkey
              ELSE o_orderkey::varchar END AS Title,
         Field, pos
  FROM orders JOIN (VALUES
      ('1-URGENT', 'P', 'ServiceDeliverySite', 0),
      ('1-URGENT', 'P', 'ServiceDeliverySiteInvoiceNumber', 1),
      ('1-URGENT', 'F', 'ServiceDeliverySite', 0),
      ('2-HIGH', 'P', 'ServiceDeliverySite', 0),
      ('2-HIGH', 'P', 'ServiceDeliverySite', 1),
      ('2-HIGH', 'F', 'ServiceDeliverySiteInvoiceNumber', 0),
      ('2-HIGH', 'F', 'ServiceDeliverySiteInvoiceNumber', 1)) AS f(prio, status, Field, pos)
    ON o_orderpriority = prio AND o_orderstatus = status
  UNION ALL
  SELECT o_orderkey, ({_COMPANIES})[o_orderkey % 14 + 1], ({_CODES})[o_orderkey % 5 + 1],
         CASE WHEN ({_COMPANIES})[o_orderkey % 14 + 1]
                   IN ('ALLENTOWN','MAI','CHINA','SINGAPORE','CLINTRAK','MP')
              THEN CASE WHEN o_orderkey % 4 = 0 THEN 'CN' ELSE 'R1' END || o_orderkey
              ELSE o_orderkey::varchar END,
         'Remark', 0
  FROM orders
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR o_orderstatus NOT IN ('P', 'F'))""")

_cte("map_entity", ("company",), """
SELECT CASE WHEN code = 'HEG' THEN 'HEG old' ELSE code END AS CODA, 'Site ' || code || ' ' || n AS gpm_site,
       CASE WHEN code <> 'INDY' THEN left(code, 3) || '-' END AS cForia
FROM company, (VALUES ('1'), ('2')) AS v(n)
WHERE n = '1' OR code = 'JAPAN'""")

_cte("map_ic_entity", ("company",), """
SELECT CASE WHEN s_nationkey < 20 THEN '' ELSE 'old' END || c || CASE WHEN c IN ('BAS','WAR','MAI') THEN 'PT' || lpad(s_suppkey::varchar, 4, '0')
                 ELSE 'X' || s_suppkey END AS "InvoiceCmp-OriginatingIC",
       'Omni ' || (s_suppkey % 9) AS "IC_Partner-OMNI",
       CASE WHEN s_suppkey % 10 <> 0 THEN 'partner' || (s_suppkey % 5) END AS "IC_Partner-CODA"
FROM supplier, (VALUES ('BAS'),('WAR'),('MAI'),('ALLENTOWN'),('MP'),('CLINTRAK')) AS v(c)
UNION ALL
SELECT code || code, 'Omni ' || code, code FROM company""")

_cte("category", ("customer_numbers",), """
SELECT CASE WHEN prefix IN ('ICOM','X','D') THEN '' ELSE 'old' END || code || prefix || number AS "Facility|GLCode-CPQREF",
       'Category ' || prefix AS "AI Enhanced - CPQ Category",
       'Sub ' || (number % 4) || c AS "AI Enhanced - CPQ SubCategory"
FROM customer_numbers, (VALUES ('a'), ('b')) AS v(c)
WHERE c = 'a' OR (code = 'BAS' AND number = 4)""")

# receivables ---------------------------------------------------------------

# The document codes that are left out, and the number of each company's site.
_EXCLUDED = (
    "('DISPERSE','MATCHING','PCANCEL','PINV','PINVDBT','RECEIPTS','Y/E-PROC-BS','CPAY','CREC',"
    "'OBAL','PCRN','REVAL','REVALR','YE-PROC-BS','PINV_XL','PINVDBT_XL','PINV2','PINV1','ACCLTBI',"
    "'ACCLTBIREV','ACCREV','ACCRUAL','CORRECTIVE','PCRNIC','PINVIC','RECLASS','REVACC','REVERSAL',"
    "'JGEN','JGENREV','JREVGEN')"
)
_SITE = (
    "CASE {0} WHEN 'ALLENTOWN' THEN '0' WHEN 'BAS' THEN '1' WHEN 'MAI' THEN '2' "
    "WHEN 'SINGAPORE' THEN '3' WHEN 'MP' THEN '4' WHEN 'CHINA' THEN '7' WHEN 'WAR' THEN '13' "
    "WHEN 'JAPAN' THEN '15' WHEN 'INDY' THEN '20' WHEN 'SUZHOU' THEN '31' WHEN 'KOREA' THEN '33' "
    "WHEN 'HEG' THEN '38' WHEN 'CLINTRAK' THEN '99' ELSE 'Unknown' END"
)

_cte("totals", ("docline",), """
SELECT cmpcode, doccode, docnum, statpay,
       sum(CASE WHEN valuedoc_dp IS NULL OR valuedoc_dp = 0 THEN 0
                ELSE valuedoc / pow(10, valuedoc_dp - 2) END) AS valuedoc,
       sum(CASE WHEN valuehome_dp IS NULL OR valuehome_dp = 0 THEN 0
                ELSE valuehome / pow(10, valuehome_dp - 2) END) AS valuehome,
       max(el2) AS el2, max(el3) AS el3, max(ref1) AS ref1, max(ref2) AS ref2,
       max(ref3) AS ref3, max(ref4) AS ref4, max(ref5) AS ref5
FROM docline WHERE el2 LIKE '021%' GROUP BY ALL""")

_cte("jobs", ("docline",), """
SELECT cmpcode, doccode, docnum, max(el4) AS el4
FROM docline WHERE el2 NOT LIKE '021%' AND el4 <> '' GROUP BY ALL""")

_cte("ar_joined", ("dochead", "totals", "jobs", "company", "el3_element"), f"""
SELECT dh.cmpcode, dh.doccode, dh.docnum, dh.docdate, dh.cdc_operation_type,
       dl.statpay, dl.valuedoc, dl.valuehome, dl.el3, dl.ref1, dl.ref2, dl.ref3, dl.ref4, dl.ref5,
       dl2.el4, ele.el3_name
FROM dochead dh
LEFT JOIN totals dl ON trim(dl.cmpcode) = trim(dh.cmpcode)
     AND trim(dl.doccode) = trim(dh.doccode) AND trim(dl.docnum) = trim(dh.docnum)
LEFT JOIN jobs dl2 ON trim(dl2.cmpcode) = trim(dl.cmpcode)
     AND trim(dl2.doccode) = trim(dl.doccode) AND trim(dl2.docnum) = trim(dl.docnum)
LEFT JOIN company comp ON comp.code = dl.cmpcode
LEFT JOIN el3_element ele ON ele.el3_cmpcode = dl.cmpcode AND ele.el3_code = dl.el3
     AND ele.el3_elmlevel = 3
WHERE dh.cmpcode IN ('ALLENTOWN','MAI','MP','BAS','WAR','CLINTRAK','SINGAPORE','INDY','HEG',
                     'SUZHOU','CHINA','JAPAN','KOREA')
  AND dl.statpay <> 665 AND dh.docdate >= DATE '2019-01-01'
  AND dh.doccode NOT IN {_EXCLUDED}""")

_cte("ar_fields", ("ar_joined",), f"""
SELECT *, {_SITE.format('cmpcode')} AS SiteID,
  CASE WHEN cmpcode IN ('ALLENTOWN','MAI','CHINA','SINGAPORE','CLINTRAK','MP') THEN ref1
       WHEN cmpcode IN ('JAPAN','SUZHOU') THEN ref5 ELSE ltrim(docnum) END AS InvoiceNumber,
  CASE WHEN doccode LIKE '%CR%' THEN 'Credit Note' ELSE 'Invoice' END AS DocType,
  upper(CASE
    WHEN cmpcode IN ('BAS','WAR') AND ref5 LIKE 'PT%' THEN substring(ref5, 1, 6)
    WHEN cmpcode IN ('BAS','WAR') AND ref5 NOT LIKE 'PT%' THEN cmpcode
    WHEN cmpcode IN ('ALLENTOWN','MP','CLINTRAK') AND el4 LIKE 'X%' THEN el4
    WHEN cmpcode IN ('ALLENTOWN','MP','CLINTRAK') AND el4 NOT LIKE 'X%' THEN cmpcode
    WHEN cmpcode = 'MAI' AND ref3 LIKE 'PT%' THEN substring(ref3, 1, 6)
    WHEN cmpcode = 'MAI' AND ref3 NOT LIKE 'PT%' THEN cmpcode
    ELSE 'Unknown' END) AS ServiceDeliverySite,
  CASE
    WHEN cmpcode IN ('BAS','WAR') AND ref5 LIKE 'PT%' THEN substring(ref5, 8)
    WHEN cmpcode IN ('BAS','WAR') AND ref5 NOT LIKE 'PT%' THEN ltrim(docnum)
    WHEN cmpcode IN ('ALLENTOWN','MP','CLINTRAK') AND el4 LIKE 'X%' THEN ref5
    WHEN cmpcode IN ('ALLENTOWN','MP','CLINTRAK') AND el4 NOT LIKE 'X%' THEN ref1
    WHEN cmpcode = 'MAI' AND ref3 LIKE 'PT%' THEN substring(ref3, 8)
    WHEN cmpcode = 'MAI' AND ref3 NOT LIKE 'PT%' THEN ref1
    ELSE 'Unknown' END AS ServiceDeliverySiteInvoiceNumber,
  CASE
    WHEN cmpcode IN ('BAS','WAR') AND el3 LIKE 'ICOM%' THEN 'IC'
    WHEN cmpcode IN ('BAS','WAR') AND ref5 LIKE 'PT%' THEN '3PD-PT'
    WHEN cmpcode IN ('ALLENTOWN','MP','CLINTRAK') AND el3 LIKE 'X%' THEN 'IC'
    WHEN cmpcode IN ('ALLENTOWN','MP','CLINTRAK') AND el4 LIKE 'X%' THEN '3PD-PT'
    WHEN cmpcode = 'MAI' AND el3 LIKE 'IF%' THEN 'IC'
    WHEN cmpcode = 'MAI' AND ref3 LIKE 'PT%' THEN '3PD-PT'
    ELSE '3PD-OWN' END AS InvoiceType
FROM ar_joined""")

_AR_COLUMNS = """SiteID, cmpcode, doccode, docdate AS InvoiceDate, InvoiceNumber, DocType,
  ServiceDeliverySite, ServiceDeliverySiteInvoiceNumber, InvoiceType,
  upper(cmpcode || ServiceDeliverySite) AS ICEntityMapKey, SiteID || '-' || el3 AS _keyClientID,
  el3 AS CustomerNumber, el3_name AS CustomerName,
  CASE cmpcode WHEN 'CHINA' THEN ref2 WHEN 'WAR' THEN ref3 ELSE ref4 END AS PO,
  CASE WHEN cmpcode IN ('JAPAN','SUZHOU') THEN ref3 ELSE ref2 END AS Protocol,
  CASE WHEN cmpcode = 'BAS' AND ref5 LIKE 'PT%' THEN ref3 ELSE coalesce(el4, '') END AS JobNumber,
  statpay, round(valuehome, 2) AS valuehome, round(valuedoc, 2) AS valuedoc"""
_KEEP = (
    "upper(coalesce({0}, '[]')) NOT LIKE '%REIMB%' AND lower(coalesce({0}, '[]')) NOT LIKE '%olidated%'"
)

_cte("ar_mart", ("ar_fields",), f"""
SELECT DISTINCT {_AR_COLUMNS} FROM ar_fields
WHERE cdc_operation_type <> 'D' AND {_KEEP.format('ServiceDeliverySiteInvoiceNumber')}""")

_cte("ar_open_mart", ("ar_fields",), f"SELECT DISTINCT {_AR_COLUMNS} FROM ar_fields")

_cte("correction_keys", ("ar_open_mart",), """
SELECT *, concat_ws('-', cmpcode, doccode, trim(InvoiceNumber), 'ServiceDeliverySite')
            AS InterimKey_SVCDVSite,
       concat_ws('-', cmpcode, doccode, trim(InvoiceNumber), 'ServiceDeliverySiteInvoiceNumber')
            AS InterimKey_SVCDVSiteIN
FROM ar_open_mart""")

_cte("corrections", ("ref_correction",), """
SELECT concat_ws('-', Instance, DocCode, Title, Field) AS InterimKey, FieldValue FROM ref_correction""")

_cte("ar_corrections", ("correction_keys", "corrections"), f"""
SELECT DISTINCT * FROM (
  SELECT *, cmpcode || New_ServiceDeliverySite AS _InvoiceSite_DeliverySite FROM (
    SELECT k.*, c.InterimKey, c.FieldValue, c.FieldValue AS Corrected_Originating_Invoice,
      c.FieldValue AS Corrected_OriginatingSite,
      CASE WHEN c.FieldValue IS NULL THEN ServiceDeliverySite ELSE c.FieldValue END
        AS New_ServiceDeliverySite,
      CASE WHEN c.FieldValue IS NULL AND ServiceDeliverySiteInvoiceNumber = '' THEN InvoiceNumber
           WHEN c.FieldValue IS NULL THEN ServiceDeliverySiteInvoiceNumber
           ELSE c.FieldValue END AS New_ServiceDeliverySiteInvoiceNumber
    FROM correction_keys k LEFT JOIN corrections c
      ON k.InterimKey_SVCDVSite = c.InterimKey OR k.InterimKey_SVCDVSiteIN = c.InterimKey))
WHERE {_KEEP.format('New_ServiceDeliverySiteInvoiceNumber')}""")

_OWN_KEY = "coalesce(company_display, '') || '-' || coalesce(InvoiceNumber, '')"
_cte("ar_keys", ("ar_corrections", "map_entity", "map_ic_entity"), f"""
SELECT SiteID, regexp_replace(company_display, 'MAI', 'HORSHAM', 'g') AS "AR Billing Site", doccode,
  InvoiceDate AS Invoice_Date, InvoiceNumber AS AR_Invoice_Number, DocType AS AR_Doc_Type,
  InvoiceType AS AR_Invoice_Type, ICEntityMapKey, _keyClientID,
  CustomerNumber AS AR_Customer_Number, CustomerName AS AR_Customer_Name, PO AS AR_PO,
  Protocol AS AR_Protocol, JobNumber AS AR_Job_Number, statpay AS Stat_Pay, valuehome, valuedoc,
  regexp_replace(ServiceDeliverySite, 'MAI', 'HORSHAM', 'g') AS "AR Originating Site",
  ServiceDeliverySiteInvoiceNumber AS AR_Originating_Invoice, _InvoiceSite_DeliverySite,
  gpm_site, cForia, IC_Partner_OMNI, partner AS IC_Partner_CODA,
  CASE WHEN lower(doccode) LIKE '%cancel%' THEN doccode || 'c'
       ELSE coalesce(cForia, '') || coalesce(InvoiceNumber, '') END AS _keyCforia,
  CASE WHEN right(coalesce(ServiceDeliverySiteInvoiceNumber, ''), 1) = 'A' THEN {_OWN_KEY}
       WHEN ServiceDeliverySiteInvoiceNumber = 'Unknown' THEN {_OWN_KEY}
       WHEN ICEntityMapKey = 'WARWAR' THEN 'WAR-' || coalesce(ServiceDeliverySiteInvoiceNumber, '')
       WHEN InvoiceType = 'IC' THEN {_OWN_KEY}
       ELSE upper(partner) || '-' || coalesce(ServiceDeliverySiteInvoiceNumber, '') END
    AS _key_global_identifier,
  coalesce(SiteID, '') || '-' || coalesce(InvoiceNumber, '') AS _key_AR_CODA
FROM (
  SELECT r.*, e.gpm_site, e.cForia, p."IC_Partner-OMNI" AS IC_Partner_OMNI,
         coalesce(p."IC_Partner-CODA", 'Unknown') AS partner,
         CASE WHEN cmpcode = 'KOREA' THEN 'SOUTH KOREA' ELSE cmpcode END AS company_display
  FROM ar_corrections r
  LEFT JOIN map_entity e ON r.cmpcode = e.CODA
  LEFT JOIN map_ic_entity p ON r._InvoiceSite_DeliverySite = p."InvoiceCmp-OriginatingIC"
  WHERE r.InvoiceNumber IS NOT NULL AND r.InvoiceNumber <> '')""")

_cte("keyed_invoices", ("ar_keys",), """
SELECT * REPLACE (CASE WHEN AR_Invoice_Type = '3PD-PT' THEN 'pass-through' ELSE AR_Invoice_Type END
                  AS AR_Invoice_Type) FROM ar_keys""")

for _name, _source in (("flagged", "keyed_invoices"), ("flagged_as_written", "ar_keys")):
    _cte(_name, (_source,), f"""
SELECT *, CASE WHEN AR_Invoice_Type = 'pass-through' AND dup_count > 1 AND numbers > 1
               THEN 'Y' ELSE 'N' END AS Flag
FROM (SELECT *, count(*) OVER (PARTITION BY _key_global_identifier) AS dup_count,
             count(AR_Invoice_Number) OVER (PARTITION BY _key_global_identifier) AS numbers
      FROM {_source})""")


def _rekeyed(source: str) -> str:
    return f"""
SELECT * EXCLUDE (dup_count, numbers, Flag), _key_global_identifier AS new_key_global_identifier
FROM {source} WHERE dup_count = 1
UNION ALL
SELECT * EXCLUDE (dup_count, numbers, Flag),
       coalesce("AR Billing Site", 'null') || '-' || coalesce(AR_Invoice_Number, 'null')
FROM {source} WHERE Flag = 'Y'"""


# revenue -------------------------------------------------------------------

_LINE_HEAD = """docline dl JOIN dochead dh ON trim(dl.cmpcode) = trim(dh.cmpcode)
     AND trim(dl.doccode) = trim(dh.doccode) AND trim(dl.docnum) = trim(dh.docnum)"""
_cte("ar_lines", ("docline", "dochead"), f"""
SELECT dl.cmpcode, dl.doccode, dl.docnum, dl.el3
FROM {_LINE_HEAD}
WHERE (dl.el2 LIKE '021%' OR (dl.cmpcode IN ('ALLENTOWN','MP','CLINTRAK','INDY') AND dl.el2 = '28020'))
  AND dl.statpay <> 665 AND dh.docdate >= DATE '2019-01-01' AND dh.cdc_operation_type <> 'D'""")
_cte("ar_lines_once", ("docline", "dochead"), f"""
SELECT DISTINCT dl.cmpcode, dl.doccode, dl.docnum, dl.el3
FROM {_LINE_HEAD}
WHERE (dl.el2 LIKE '021%' OR (dl.cmpcode IN ('ALLENTOWN','MP','CLINTRAK','INDY') AND dl.el2 = '28020'))
  AND dl.statpay <> 665 AND dh.docdate >= DATE '2019-01-01'""")

_cte("base", ("docline", "dochead"), f"""
SELECT dl.*, dh.docdate, dh.curdoc,
  upper(dl.cmpcode) || '-' ||
    CASE WHEN dl.cmpcode IN ('ALLENTOWN','MAI','CHINA','SINGAPORE','CLINTRAK','MP') THEN dl.ref1
         WHEN dl.cmpcode IN ('JAPAN','SUZHOU') THEN dl.ref5 ELSE ltrim(dl.docnum) END
    AS global_identifier,
  CASE WHEN dh.cmpcode IN ('ALLENTOWN','MAI','CHINA','CLINTRAK','MP','INDY') THEN dl.ref1
       WHEN dh.cmpcode IN ('BAS','WAR','HEG') THEN ltrim(dh.docnum)
       WHEN dh.cmpcode = 'SINGAPORE' AND dl.ref1 LIKE 'CN%' THEN substring(dl.ref1, 3)
       WHEN dh.cmpcode IN ('KOREA','JAPAN','SUZHOU') THEN dl.ref1 ELSE 'Unknown' END AS invoice_number,
  CASE WHEN dh.cmpcode = 'SUZHOU' THEN dl.ref2
       WHEN dh.cmpcode = 'WAR' AND dh.docdate >= DATE '2020-11-10' THEN dl.ref3
       WHEN dh.cmpcode = 'KOREA' AND dh.docdate <= DATE '2024-07-12' THEN dl.ref2
       WHEN dh.cmpcode = 'KOREA' AND dh.docdate = DATE '2024-07-23' THEN dl.ref3
       WHEN dh.cmpcode = 'JAPAN' AND (dh.docdate <= DATE '2024-07-31'
            OR dh.docdate = DATE '2024-08-20') THEN dl.ref2
       ELSE dl.ref4 END AS po_value,
  CASE WHEN dh.cmpcode = 'SUZHOU' THEN dl.ref3
       WHEN dh.cmpcode = 'KOREA' AND dh.docdate <= DATE '2024-07-12' THEN dl.ref3
       WHEN dh.cmpcode = 'JAPAN' AND (dh.docdate <= DATE '2024-07-31'
            OR dh.docdate = DATE '2024-08-20') THEN dl.ref3
       ELSE dl.ref2 END AS protocol_value
FROM {_LINE_HEAD}""")

_REVENUE_FILTER = f"""(el2 LIKE '4%' OR (el2 >= '23160' AND el2 <= '23180')
       OR (cmpcode IN ('BAS','WAR') AND el2 = '24300'))
  AND NOT (cmpcode = 'MAI' AND ref2 LIKE '%Recharges%')
  AND NOT (cmpcode IN ('ALLENTOWN','MP','INDY','CLINTRAK') AND el4 LIKE 'X%')
  AND doccode NOT IN {_EXCLUDED}"""

# Ties on the earliest day go to the smallest job, as in the plans.  An arg-min
# skips rows without a date, so a company with no other rows has no default.
_cte("job_defaults", ("base",), """
SELECT cmpcode, CASE WHEN docdate IS NOT NULL THEN el4 END AS default_el4 FROM (
  SELECT cmpcode, el4, docdate, row_number() OVER (PARTITION BY cmpcode ORDER BY docdate NULLS LAST, el4) AS rn
  FROM base WHERE el4 IS NOT NULL AND el4 <> '') WHERE rn = 1""")
_cte("job_defaults_first", ("base",), """
SELECT cmpcode, el4 AS default_el4 FROM (
  SELECT cmpcode, el4, row_number() OVER (PARTITION BY cmpcode ORDER BY docdate NULLS FIRST, el4) AS rn
  FROM base WHERE el4 IS NOT NULL AND el4 <> '') WHERE rn = 1""")

for _name, _lines, _defaults in (
    ("revenue_a", "ar_lines", "job_defaults"),
    ("revenue_b", "ar_lines_once", "job_defaults_first"),
):
    _cte(_name, ("base", _lines, _defaults, "company", "el2_element", "el3_element"), f"""
SELECT {_SITE.format('g.cmpcode')} AS SiteID, g.cmpcode, global_identifier AS Global_Identifier, statpay,
  docdate AS InvoiceDate, round(valuehome, 2) AS valuehome, homecur AS ValueHomeCurrency,
  round(valuedoc, 2) AS valuedoc, curdoc, customer_el3 AS CustomerNumber, el3_name AS CustomerName,
  el3, invoice_number AS InvoiceNumber, po_value AS PO, protocol_value AS Protocol,
  coalesce(nullif(el4, ''), default_el4) AS JobNumber, docnum, doccode, el2, el2_name AS name
FROM (
  SELECT b.cmpcode, global_identifier, statpay, docdate, curdoc, b.el3, a.el3 AS customer_el3,
         invoice_number, po_value, protocol_value, b.docnum, b.doccode, b.el2, b.el4, homecur,
         el2_name, el3_name,
         sum(CASE WHEN valuehome_dp = 0 THEN valuehome
                  ELSE valuehome / pow(10, valuehome_dp - 2) END) AS valuehome,
         sum(CASE WHEN valuedoc_dp = 0 THEN valuedoc
                  ELSE valuedoc / pow(10, valuedoc_dp - 2) END) AS valuedoc
  FROM (SELECT * FROM base WHERE {_REVENUE_FILTER} AND docdate >= DATE '2019-01-01') b
  JOIN {_lines} a ON a.cmpcode = b.cmpcode AND a.doccode = b.doccode AND a.docnum = b.docnum
  JOIN company ON code = b.cmpcode
  JOIN el2_element ON el2_cmpcode = b.cmpcode AND el2_code = b.el2 AND el2_elmlevel = 2
  JOIN el3_element ON el3_cmpcode = a.cmpcode AND el3_code = a.el3 AND el3_elmlevel = 3
  GROUP BY ALL) g
LEFT JOIN {_defaults} d ON d.cmpcode = g.cmpcode""")

_cte("revenue_flags", ("revenue_a",), """
SELECT *, CASE WHEN el3 IS NULL THEN 'Other' WHEN cmpcode = 'ALLENTOWN' THEN left(el3, 1)
               WHEN cmpcode IN ('MAI','BAS') THEN cmpcode || el3 ELSE 'Other' END AS Pass_Through_Flag,
       upper(cmpcode || el3) AS Site_GL_CODE
FROM revenue_a""")

_cte("client_joined", ("client_master", "client_xref"), """
SELECT m.*, x.m_code AS xref_code, x.site_id, x.c_code
FROM client_master m LEFT JOIN client_xref x ON m.m_code = x.m_code""")
_cte("parent_counts", ("client_joined",), """
SELECT DISTINCT client_ultimate_parent_id AS parent_id, global_ultimate_business_name AS parent_name,
  count(c_code) OVER (PARTITION BY client_ultimate_parent_id, global_ultimate_business_name)
    AS parent_row_count
FROM client_joined""")
_cte("ranked", ("parent_counts",), """
SELECT *, dense_rank() OVER (PARTITION BY parent_id ORDER BY parent_row_count DESC) AS parent_row_rank
FROM parent_counts""")
_CLIENT = """CAST(m_code AS INTEGER) AS m_code,
  CAST(client_ultimate_parent_id AS INTEGER) AS client_ultimate_parent_id,
  regexp_extract(site_id, '^([0-9]+)', 1) || '-' || c_code AS ClientKey, global_ultimate_business_name"""

# queries -------------------------------------------------------------------

_TOTALS = "cmpcode, doccode, docnum, statpay, round(valuedoc, 2) AS valuedoc, round(valuehome, 2) AS valuehome"

BODIES: dict[str, tuple[tuple[str, ...], str]] = {
    "document_lines": (("docline",), "SELECT * FROM docline"),
    "document_heads": (("dochead",), "SELECT * FROM dochead"),
    "line_aggregate_scaled_zero": (
        ("totals",), f"SELECT {_TOTALS}, el2, el3, ref1, ref2, ref3, ref4, ref5 FROM totals"),
    "line_scaled_raw": (("docline",), """
SELECT cmpcode, doccode, el2, el3,
  round(sum(CASE WHEN valuehome_dp = 0 THEN valuehome
                 ELSE valuehome / pow(10, valuehome_dp - 2) END), 2) AS valuehome,
  round(sum(CASE WHEN valuedoc_dp = 0 THEN valuedoc
                 ELSE valuedoc / pow(10, valuedoc_dp - 2) END), 2) AS valuedoc
FROM docline GROUP BY ALL"""),
    "doc_attr_max": (("jobs",), "SELECT * FROM jobs"),
    "site_map": (("dochead",), f"""
SELECT cmpcode, {_SITE.format('cmpcode')} AS SiteID, count(*) AS documents FROM dochead GROUP BY ALL"""),
    "doc_type": (("dochead",), """
SELECT doccode, CASE WHEN contains(doccode, 'CR') THEN 'Credit Note' ELSE 'Invoice' END AS DocType,
  count(*) AS documents FROM dochead GROUP BY ALL"""),
    "delivery_site": (("ar_fields",), """
SELECT cmpcode, ServiceDeliverySite, upper(cmpcode || ServiceDeliverySite) AS ICEntityMapKey,
  ServiceDeliverySiteInvoiceNumber, count(*) AS documents
FROM (SELECT DISTINCT cmpcode, doccode, ltrim(docnum), statpay, ServiceDeliverySite,
             ServiceDeliverySiteInvoiceNumber FROM ar_fields) GROUP BY ALL"""),
    "invoice_type": (("ar_fields",), """
SELECT cmpcode, InvoiceType, count(*) AS documents
FROM (SELECT DISTINCT cmpcode, doccode, ltrim(docnum), statpay, InvoiceType FROM ar_fields) GROUP BY ALL"""),
    "trimmed_key_left_join": (("dochead", "totals"), """
SELECT dh.cmpcode, dh.doccode, ltrim(dh.docnum) AS docnum, dh.docdate, dl.statpay, dl.el3,
       round(dl.valuehome, 2) AS valuehome
FROM dochead dh LEFT JOIN totals dl ON trim(dl.cmpcode) = trim(dh.cmpcode)
     AND trim(dl.doccode) = trim(dh.doccode) AND trim(dl.docnum) = trim(dh.docnum)"""),
    "trimmed_key_inner_join": (("docline", "dochead"), f"""
SELECT dh.cmpcode, dh.doccode, dh.docdate, dh.curdoc, dl.el2, count(*) AS lines,
       CAST(sum(dl.valuedoc) AS BIGINT) AS raw_value
FROM {_LINE_HEAD} GROUP BY ALL"""),
    "lookup_with_level": (("docline", "el3_element"), """
SELECT l.cmpcode, l.el3, e.el3_name, count(*) AS lines
FROM docline l LEFT JOIN el3_element e
  ON e.el3_cmpcode = l.cmpcode AND e.el3_code = l.el3 AND e.el3_elmlevel = 3 GROUP BY ALL"""),
    "lookup_inner_level": (("docline", "el2_element", "company"), """
SELECT l.cmpcode, l.el2, e.el2_name, c.homecur, count(*) AS lines
FROM docline l JOIN el2_element e
  ON e.el2_cmpcode = l.cmpcode AND e.el2_code = l.el2 AND e.el2_elmlevel = 2
JOIN company c ON c.code = l.cmpcode GROUP BY ALL"""),
    "ar_mart_core": (("ar_fields",), """
SELECT DISTINCT SiteID, cmpcode, doccode, docdate AS InvoiceDate, InvoiceNumber, DocType, statpay,
  round(valuehome, 2) AS valuehome, round(valuedoc, 2) AS valuedoc
FROM ar_fields WHERE cdc_operation_type <> 'D'"""),
    "ar_mart": (("ar_mart",), "SELECT * FROM ar_mart"),
    "correction_keys": (("correction_keys",), "SELECT * FROM correction_keys"),
    "either_key_join": (("correction_keys", "corrections"), """
SELECT k.cmpcode, k.doccode, k.InvoiceNumber, k.statpay, k.PO, c.InterimKey, c.FieldValue
FROM correction_keys k LEFT JOIN corrections c
  ON k.InterimKey_SVCDVSite = c.InterimKey OR k.InterimKey_SVCDVSiteIN = c.InterimKey"""),
    "ar_corrections": (("ar_corrections",), "SELECT * FROM ar_corrections"),
    "ar_keys": (("ar_keys",), "SELECT * FROM ar_keys"),
    "ar_lines": (("ar_lines",), """
SELECT cmpcode, doccode, docnum, el3 AS customer_el3, count(*) AS ar_copies FROM ar_lines GROUP BY ALL"""),
    "ar_lines_dedup": (("ar_lines_once",), """
SELECT cmpcode, doccode, docnum, el3 AS customer_el3 FROM ar_lines_once"""),
    "revenue_base": (("base",), """
SELECT cmpcode, doccode, docnum, statpay, el2, el3, el4, docdate, curdoc, global_identifier,
  invoice_number, po_value, protocol_value FROM base"""),
    "revenue_filter": (("docline",), f"""
SELECT cmpcode, doccode, docnum, el2, el3, el4, ref2 FROM docline WHERE {_REVENUE_FILTER}"""),
    "job_default_min_by": (("job_defaults",), "SELECT * FROM job_defaults"),
    "job_default_row_number": (("job_defaults_first",), "SELECT * FROM job_defaults_first"),
    "revenue_mart_a": (("revenue_a",), "SELECT * FROM revenue_a"),
    "revenue_mart_b": (("revenue_b",), "SELECT * FROM revenue_b"),
    "job_default_reduced": (("job_defaults",), "SELECT * FROM job_defaults"),
    "revenue_mart_dealt": (("revenue_a",), "SELECT * FROM revenue_a"),
    "revenue_mart_reduced": (("revenue_a",), "SELECT * FROM revenue_a"),
    "ar_mart_by_document": (("ar_mart",), "SELECT * FROM ar_mart"),
    "ar_mart_listed": (("ar_mart", "company"), "SELECT * FROM ar_mart WHERE cmpcode IN (SELECT code FROM company WHERE homecur = 'USD')"),
    "revenue_mart_by_document": (("revenue_a",), "SELECT * FROM revenue_a"),
    "revenue_classify": (("revenue_flags", "map_entity", "category"), """
SELECT r.* EXCLUDE (Pass_Through_Flag, Site_GL_CODE),
  CASE WHEN valuedoc IS NULL THEN '$nu' ELSE printf('$%,.2f', valuedoc) END AS valuedoc_formatted,
  CASE WHEN valuehome IS NULL THEN '$nu' ELSE printf('$%,.2f', valuehome) END AS valuehome_formatted,
  SiteID || InvoiceNumber || el3 AS Key_global_identifier, Pass_Through_Flag,
  CASE WHEN Pass_Through_Flag LIKE '%X%' THEN 'PT' WHEN left(Pass_Through_Flag, 3) = 'BAS' THEN 'PT'
       WHEN Pass_Through_Flag IN ('BASD4199','MAID4400') THEN 'PT'
       WHEN Pass_Through_Flag LIKE '%x%' THEN 'PT' ELSE 'Not classified as PT' END
    AS Pass_Through_Flag2,
  e.CODA AS MAP_Entity_CODA, Site_GL_CODE, c."Facility|GLCode-CPQREF",
  c."AI Enhanced - CPQ Category" AS "CPQ Category",
  c."AI Enhanced - CPQ SubCategory" AS "CPQ SubCategory", 'CODA' AS Source
FROM revenue_flags r LEFT JOIN map_entity e ON r.cmpcode = e.CODA
LEFT JOIN category c ON r.Site_GL_CODE = c."Facility|GLCode-CPQREF\""""),
    "client_keys": (("client_joined",), f"SELECT DISTINCT {_CLIENT} FROM client_joined"),
    "client_keys_dominant": (("client_joined", "ranked"), f"""
SELECT DISTINCT {_CLIENT} FROM client_joined c JOIN ranked r
  ON c.client_ultimate_parent_id IS NOT DISTINCT FROM r.parent_id
 AND c.global_ultimate_business_name IS NOT DISTINCT FROM r.parent_name
WHERE parent_row_rank = 1"""),
    "parent_counts": (("parent_counts",), "SELECT * FROM parent_counts"),
    "ranked_parents": (("ranked",), "SELECT * FROM ranked"),
    "dominant_parent": (("ranked",), """
SELECT parent_id, parent_name, parent_row_count FROM ranked WHERE parent_row_rank = 1"""),
    "dup_flag": (("flagged",), "SELECT * EXCLUDE (numbers) FROM flagged"),
    "rekey_duplicates": (("flagged",), _rekeyed("flagged")),
    "rekey_as_written": (("flagged_as_written",), _rekeyed("flagged_as_written")),
    "duplicate_report": (("flagged",), f"""
SELECT new_key_global_identifier, count(*) AS "count" FROM ({_rekeyed('flagged')})
GROUP BY 1 HAVING count(*) > 1"""),
    "full_row_duplicates": (("ar_keys",), """
SELECT *, count(*) AS "count" FROM ar_keys GROUP BY ALL HAVING count(*) > 1"""),
    "lookup_csv": (("category",), "SELECT * FROM category"),
    "sink_roundtrip": (("ar_mart",), "SELECT * FROM ar_mart"),
    "sink_checked": (("ar_mart",), "SELECT * FROM ar_mart"),
    "sink_schema_evolution": (("ar_mart",), """
SELECT *, CAST(NULL AS VARCHAR) AS RetiredColumn FROM ar_mart"""),
    "sanitize_columns": (("ar_keys",), """
SELECT * EXCLUDE ("AR Billing Site", "AR Originating Site"),
  "AR Billing Site" AS AR_Billing_Site, "AR Originating Site" AS AR_Originating_Site FROM ar_keys"""),
    "row_count": (("ar_mart",), """
SELECT count(*) AS mart_rows FROM ar_mart"""),
}


def sql(name: str, given: tuple[str, ...] = ()) -> str:
    needs, body = BODIES[name]
    return with_ctes(needs, body, given)


QUERIES: dict[str, str] = {name: sql(name) for name in BODIES}
