"""The driver's tables seen as the retailer's source tables.

Each overlay is a query in the SQL both engines share, so the Spark job and its SQL check start from the same
rows.  ``{name}`` stands for a table or another overlay.  Overlays define whole scenarios (which orders have a
finance title, which suppliers are branches); no table is cut to make a check cheap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillstone.plans.session import planned, settled

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations")

AS_OF = date(2001, 8, 31)
START = date(1995, 1, 1)
CARDS_AS_OF = date(2001, 1, 31)

INTERCOMPANY = "90000000000001"
COMPANY_TAX_ID = "00.000.000/0000-01"
BANK_ACCOUNT = "MAIN ACCOUNT"
COST_CENTRE = "GENERAL"
CARD_FORMS = tuple(range(20, 80))
TRANSFER_FORM = 90


def _money(name: str) -> str:
    return f"CAST({name} AS DECIMAL(18,2))"


def _tax_id(digits: str) -> str:
    parts = ((1, 2, ""), (3, 3, "."), (6, 3, "."), (9, 4, "/"), (13, 2, "-"))
    return " || ".join((f"'{sep}' || " if sep else "") + f"substr({digits}, {at}, {n})" for at, n, sep in parts)


def _quoted(text: str) -> str:
    """A JSON string, or JSON null."""
    return f"coalesce('\"' || {text} || '\"', 'null')"


def _plain(value: str) -> str:
    """A JSON number or boolean, or JSON null."""
    return f"coalesce(CAST({value} AS STRING), 'null')"


def _json(**fields: str) -> str:
    body = " || ',".join(f"\"{name}\":' || {value}" for name, value in fields.items())
    return "'{" + body + " || '}'"


def _line(kind: str, competence: str, centre: str, plan: str, value: str) -> str:
    return _json(
        Tipo=_quoted(kind),
        Competencia=_quoted(competence),
        CentroDeCusto=_quoted(centre),
        PlanoDeContas=_quoted(plan),
        Valor=_plain(value),
    )


_SHIFTED_DAY = "CAST(CAST(ts AS DATE) - INTERVAL 276 MONTH AS DATE)"
_KEY_TEXT = "CAST(o_orderkey AS STRING)"
_GROSS = _money("l_extendedprice")
_RATE = "CAST(l_{} AS DECIMAL(4,2))"
_ITEM_BRANCH = "CAST(l_suppkey % 5 + 1 AS INT)"
_PAYABLE_LINE_VALUE = "CAST(value * 0.60 AS DECIMAL(18,2))"

OVERLAYS = {
    # -- registers ---------------------------------------------------------------------------------------------
    "branch": """
        SELECT r_regionkey + 1 AS branch_code, r_name AS trade_name, r_name || ' LTD' AS legal_name,
               lpad(CAST(r_regionkey AS STRING), 14, '0') AS tax_id
        FROM {region}""",
    "supplier_register": """
        SELECT lpad(CAST(s_suppkey AS STRING), 14, '0') AS supplier_code, s_name AS supplier_name,
               s_suppkey, n_regionkey + 1 AS branch_code
        FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
    "operation": "SELECT n_nationkey AS operation_code, n_name AS operation_name FROM {nation} WHERE n_nationkey < 3",
    "tax_code": """
        SELECT r_regionkey AS tax_code, CASE WHEN r_regionkey = 3 THEN '1' ELSE '0' END AS substituted
        FROM {region} WHERE r_regionkey < 4""",
    "purchase_order": "SELECT o_orderkey AS order_number FROM {orders} WHERE o_orderkey % 4 = 0",
    "customer_register": """
        SELECT c_custkey AS customer_number, CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE c_name END AS trade_name,
               CASE WHEN c_custkey % 3 <> 0 THEN '0.' || CAST(c_custkey AS STRING) END AS customer_code
        FROM {customer}""",
    "payment_form": "SELECT n_nationkey AS form_code, n_name AS form_name FROM {nation}",
    # -- products ----------------------------------------------------------------------------------------------
    "product": """
        SELECT p_partkey AS product_code, CAST(p_partkey AS INT) AS internal_code, p_name AS short_name,
               'PK' || CAST(p_size % 3 AS STRING) AS package, CAST(p_size AS DECIMAL(18,2)) AS units_per_package,
               CASE p_size % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS online_flag,
               CASE WHEN p_partkey % 11 = 0 THEN DATE '2001-01-15' END AS deactivated_at,
               CASE WHEN p_partkey % 13 = 0 THEN DATE '2001-02-15' END AS deleted_at,
               DATE '1995-01-01' + p_size AS created_at
        FROM {part} WHERE p_partkey % 4 <> 0""",
    "product_master": """
        SELECT CAST(p_partkey AS INT) AS internal_code, p_partkey - p_partkey % 2 AS default_code,
               p_name || ' ' || p_brand AS full_name, p_type || '|' || p_brand || '|' || p_name AS group_code,
               p_size AS subgroup_code, p_size % 5 AS centre_code, CAST(p_partkey % 3 AS INT) AS unit_code,
               CASE p_size % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS scale_flag,
               CASE WHEN p_size % 2 = 0 THEN 'V' ELSE 'F' END AS weight_flag,
               DATE '2001-03-01' AS changed_at
        FROM {part} WHERE p_partkey % 9 <> 1""",
    "product_group": """
        SELECT DISTINCT p_type || '|' || p_brand || '|' || p_name AS group_code, p_name AS group_name,
               p_type || '|' || p_brand AS section_code
        FROM {part}""",
    "product_section": """
        SELECT DISTINCT p_type || '|' || p_brand AS section_code, p_brand AS section_name, p_type AS department_code
        FROM {part}""",
    "product_department": "SELECT DISTINCT p_type AS department_code, p_type AS department_name FROM {part}",
    "product_subgroup": """
        SELECT DISTINCT p_size AS subgroup_code, 'SG' || CAST(p_size AS STRING) AS subgroup_name,
               CASE WHEN p_size % 10 <> 0 THEN p_size * 0.5 END AS margin
        FROM {part}""",
    "cost_centre": "SELECT r_regionkey AS centre_code, r_name AS centre_name FROM {region} WHERE r_regionkey < 4",
    "unit": "SELECT r_regionkey AS unit_code, substr(r_name, 1, 2) AS unit_symbol FROM {region} WHERE r_regionkey < 3",
    "crosswalk": """
        SELECT p_partkey AS legacy_code, p_partkey AS product_code FROM {part} WHERE p_partkey % 3 = 0""",
    "legacy_product": """
        SELECT p_partkey AS legacy_code, p_name || '  ' AS short_name, ' ' || p_name || ' ' || p_brand AS full_name,
               CASE WHEN p_size % 4 <> 0 THEN 'UN ' END AS unit_symbol,
               CASE WHEN p_size % 5 = 0 THEN 'CENTRE ' END AS centre_name, p_type || ' ' AS department_name,
               p_brand AS section_name, p_name AS group_name, 'SG' || CAST(p_size AS STRING) AS subgroup_name,
               CASE WHEN p_size % 10 <> 0 THEN p_size * 0.5 END AS margin, p_size % 2 = 0 AS scale_flag,
               CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS online_flag,
               CASE WHEN p_size % 7 = 0 THEN DATE '1900-01-01' ELSE DATE '1994-01-01' + p_size END AS created_on,
               DATE '2001-04-01' AS changed_at
        FROM {part}""",
    "section_register": """
        SELECT DISTINCT ascii(p_type) * 100000 + ascii(substr(p_type, 2)) * 1000 + CAST(substr(p_brand, 7) AS INT)
                   AS section_id, p_brand AS section, p_type AS department
        FROM {part}""",
    "reclass_rule": """
        SELECT 'PROMO' AS source_department, section_id AS source_section_id, 'ECONOMY' AS target_department
        FROM {section_register} WHERE department = 'PROMO' AND section = 'Brand#1'
        UNION ALL
        SELECT DISTINCT 'PROMO', CAST(NULL AS INT), 'MEDIUM' FROM {part} WHERE p_type = 'PROMO'""",
    # -- sales -------------------------------------------------------------------------------------------------
    "receipt": f"""
        SELECT o_orderkey AS receipt_id, o_orderdate AS issued_at, n_regionkey + 1 AS branch_code,
               CAST(o_orderkey % 10 AS INT) AS terminal, {_KEY_TEXT} AS sequence_text,
               CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END END AS cancelled,
               CASE WHEN c_mktsegment <> 'MACHINERY' AND o_orderkey % 4 <> 0
                    THEN CAST(c_custkey AS STRING) END AS person_document,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN '{INTERCOMPANY}' END AS company_document
        FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey JOIN {{nation}} ON n_nationkey = c_nationkey""",
    "receipt_item": f"""
        SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS receipt_id, l_shipdate AS registered_at,
               l_linenumber AS sequence, l_partkey AS product_code,
               CASE WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS cancelled,
               CAST(l_quantity AS DECIMAL(18,4)) AS quantity, {_GROSS} AS unit_price,
               CAST({_GROSS} * {_RATE.format("discount")} AS DECIMAL(18,4)) AS item_discount,
               CASE WHEN l_linenumber % 2 = 0 THEN CAST(0.10 AS DECIMAL(18,4)) END AS payment_discount,
               CAST(CASE WHEN l_linenumber % 3 = 0 THEN 0.05 ELSE 0 END AS DECIMAL(18,4)) AS item_surcharge,
               CASE WHEN l_linenumber <> 7 THEN CAST(0 AS DECIMAL(18,4)) END AS payment_surcharge,
               {_GROSS} AS total, CAST({_GROSS} * {_RATE.format("tax")} AS DECIMAL(18,4)) AS icms,
               CAST(NULL AS DECIMAL(18,4)) AS fcp, CAST({_GROSS} * 0.0165 AS DECIMAL(18,4)) AS pis,
               CASE WHEN l_linestatus = 'F' THEN CAST({_GROSS} * 0.0760 AS DECIMAL(18,4)) END AS cofins
        FROM {{lineitem}}""",
    "consumer_invoice": f"""
        SELECT o_orderkey AS receipt_id, o_orderkey + 500000 AS invoice_number, '1' AS invoice_series,
               CASE WHEN o_orderkey % 9 <> 1 THEN 'C' || lpad({_KEY_TEXT}, 10, '0') END AS access_key,
               CASE WHEN o_orderkey % 25 = 1 THEN '0' WHEN o_orderkey % 50 <> 2 THEN '1' END AS cancelled_flag,
               CASE WHEN o_orderkey % 25 = 1 THEN 'returned' END AS cancel_reason
        FROM {{orders}} WHERE o_orderkey % 3 <> 0""",
    "company_invoice": f"""
        SELECT o_orderkey AS receipt_id, o_orderkey + 700000 AS invoice_number, '2' AS invoice_series,
               'E' || lpad({_KEY_TEXT}, 10, '0') AS access_key
        FROM {{orders}} WHERE o_orderkey % 6 = 0""",
    "legacy_receipt": """
        SELECT o_orderkey AS receipt_id, CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 5 AS INT) AS branch_key,
               CAST(o_orderkey % 4 AS INT) AS terminal, o_orderkey * 7 AS receipt_number,
               o_orderstatus = 'P' AS receipt_reversed
        FROM {orders}""",
    "legacy_item": f"""
        SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS receipt_id, l_partkey AS goods_id,
               l_linenumber AS item, '10:00:00' AS time, CAST(l_linenumber % 7 AS INT) AS class_id,
               CAST(l_quantity AS DECIMAL(18,4)) AS quantity, {_GROSS} AS unit_price,
               CAST({_GROSS} * {_RATE.format("discount")} AS DECIMAL(18,4)) AS discount,
               CAST(0 AS DECIMAL(18,4)) AS surcharge, {_GROSS} AS total, l_returnflag = 'A' AS item_reversed
        FROM {{lineitem}}""",
    "legacy_branch": "SELECT r_regionkey AS branch_key, r_name AS branch_name FROM {region}",
    "legacy_goods": """
        SELECT p_partkey AS goods_id, p_partkey * 10 AS goods_code, p_name AS description,
               CAST(p_partkey % 4 AS INT) AS unit_id
        FROM {part}""",
    "legacy_unit": "SELECT r_regionkey AS unit_id, substr(r_name, 1, 3) AS symbol FROM {region} WHERE r_regionkey < 3",
    "legacy_class": """
        SELECT n_nationkey AS class_id, n_nationkey * 100 AS class_code, n_name AS class_name
        FROM {nation} WHERE n_nationkey < 5""",
    # -- purchases ---------------------------------------------------------------------------------------------
    "purchase_line": f"""
        SELECT s.branch_code, s.supplier_code, lpad(CAST(l_orderkey AS STRING), 9, '0') AS document, '1' AS series,
               l_orderkey * 10 + l_linenumber AS line_id, l_linenumber AS sequence, l_partkey AS product_code,
               CAST(l_quantity AS DECIMAL(18,4)) AS boxes,
               CAST(1 + l_linenumber % 2 AS DECIMAL(9,2)) AS units_per_box,
               CAST({_GROSS} * 0.01 AS DECIMAL(18,4)) AS box_price,
               CASE WHEN l_discount > 0
                    THEN CAST({_money("l_quantity")} * {_RATE.format("discount")} AS DECIMAL(18,4)) END AS discount,
               CASE WHEN l_linenumber <> 7 THEN CAST(0.10 AS DECIMAL(18,4)) END AS calculated_discount,
               CAST({_GROSS} * {_RATE.format("tax")} AS DECIMAL(18,4)) AS icms, CAST(NULL AS DECIMAL(18,4)) AS fcp,
               CAST({_GROSS} * 0.0165 AS DECIMAL(18,4)) AS pis_credit,
               CASE WHEN l_linestatus = 'F' THEN CAST({_GROSS} * 0.0760 AS DECIMAL(18,4)) END AS cofins_credit,
               CAST(l_linenumber % 4 AS INT) AS tax_code, l_linestatus AS item_status, l_shipdate AS changed_at,
               l_orderkey, l_suppkey, CAST(l_shipdate AS DATE) AS shipped, {_GROSS} AS gross
        FROM {{lineitem}} JOIN {{supplier_register}} s ON s.s_suppkey = l_suppkey
        WHERE l_returnflag = 'R'""",
    "purchase_header": """
        SELECT branch_code, supplier_code, document, series, l_orderkey, l_suppkey, min(shipped) AS issued_at,
               min(shipped) + CAST(l_orderkey % 7 AS INT) AS entered_at,
               CASE WHEN l_orderkey % 17 = 0 THEN min(shipped) END AS cancelled_at,
               CASE WHEN l_orderkey % 19 = 0 THEN '1' WHEN l_orderkey % 2 = 0 THEN '0' END AS bonus_flag,
               CAST(CASE WHEN l_orderkey % 10 = 9 THEN 2 ELSE 3 END AS INT) AS invoice_status,
               CAST(l_suppkey % 3 AS INT) AS operation_code,
               CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey END AS order_number,
               'A' || document AS access_key, CAST(sum(gross) AS DECIMAL(18,2)) AS total
        FROM {purchase_line}
        GROUP BY branch_code, supplier_code, document, series, l_orderkey, l_suppkey""",
    "payable": f"""
        SELECT substr(supplier_code, 1, 8) || '/' || substr(supplier_code, 9) AS supplier_code, document,
               n AS number, issued_at + CAST(30 * n AS INT) AS due_at,
               CASE WHEN n = 1 THEN CAST(total * 0.50 AS DECIMAL(18,2))
                    ELSE CAST(total - CAST(total * 0.50 AS DECIMAL(18,2)) AS DECIMAL(18,2)) END AS value,
               CASE WHEN l_orderkey % 4 = 1 THEN '  ' WHEN l_orderkey % 4 = 2 THEN 'L' || document END AS payment_line,
               CASE WHEN l_orderkey % 3 = 0 THEN 'B' || document END AS barcode,
               CASE WHEN l_orderkey % 23 = 0 THEN issued_at END AS cancelled_at
        FROM (SELECT *, 1 AS n FROM {{purchase_header}} UNION ALL SELECT *, 2 AS n FROM {{purchase_header}}) x
        WHERE l_orderkey % 3 <> 1""",
    # -- stock -------------------------------------------------------------------------------------------------
    "daily_stock_source": f"""
        SELECT CAST(l_shipdate AS DATE) AS moved_at, {_ITEM_BRANCH} AS branch_code, l_partkey AS product_code,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS quantity,
               CAST(max(CASE WHEN l_returnflag = 'R' THEN 0 ELSE {_GROSS} END) AS DECIMAL(18,4)) AS cost,
               CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,4)) END) AS DECIMAL(18,4))
                   AS breakage_quantity,
               CAST(sum(CASE WHEN l_linestatus = 'O' THEN {_GROSS} END) AS DECIMAL(18,2)) AS breakage_value
        FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "inventory_source": f"""
        SELECT {_ITEM_BRANCH} AS branch_code, l_orderkey AS inventory, l_linenumber AS sequence,
               l_partkey AS product_code, l_shipdate, l_returnflag, l_linestatus,
               CASE WHEN l_tax >= 0.03 THEN CAST(l_quantity AS DECIMAL(18,4)) END AS store_quantity,
               CASE WHEN l_tax >= 0.02 AND l_linenumber % 2 = 0 THEN CAST(1 AS DECIMAL(18,4)) END AS deposit_quantity,
               {_GROSS} AS cost
        FROM {{lineitem}}""",
    "inventory_header": """
        SELECT branch_code, inventory, min(l_shipdate) AS updated_at,
               min(CASE WHEN l_returnflag <> 'N' THEN l_shipdate END) AS processed_at,
               CAST(inventory % 3 AS INT) AS selection_kind,
               CASE WHEN inventory % 2 = 0 THEN '  ' ELSE ' ' || CAST(inventory AS STRING) END AS selection_code,
               max(CASE WHEN l_linestatus = 'F' THEN '1' END) AS zero_uncounted
        FROM {inventory_source} GROUP BY branch_code, inventory""",
    "transformation_line": f"""
        SELECT {_ITEM_BRANCH} AS branch_code, l_orderkey AS number, l_partkey AS product_code,
               CAST(l_quantity AS DECIMAL(18,4)) AS product_quantity, l_partkey + 1 AS output_code,
               CAST(l_quantity AS DECIMAL(18,4)) AS output_quantity, l_shipdate
        FROM {{lineitem}}""",
    "transformation_header": """
        SELECT branch_code, number, min(l_shipdate) AS transformed_at, max(l_shipdate) AS processed_at
        FROM {transformation_line} GROUP BY branch_code, number""",
    "current_stock": f"""
        SELECT {_ITEM_BRANCH} AS branch_code, l_partkey AS product_code,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS quantity, max({_GROSS}) AS cost,
               max({_GROSS}) AS price, min({_GROSS}) AS average_cost, min(l_returnflag) AS abc_class,
               max(l_shipdate) AS last_sale, max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS last_purchase,
               max({_RATE.format("tax")}) AS entry_tax_rate, min({_RATE.format("tax")}) AS exit_tax_rate
        FROM {{lineitem}} GROUP BY 1, 2""",
    "movement": f"""
        SELECT {_ITEM_BRANCH} AS branch_code, l_partkey AS product_code, l_shipdate AS operated_at,
               CAST(CASE l_linenumber WHEN 1 THEN 101 WHEN 2 THEN 201 WHEN 3 THEN NULL ELSE 210 END AS INT)
                   AS operation_code,
               CAST(l_quantity AS DECIMAL(18,4)) AS quantity, {_GROSS} AS balance,
               CASE WHEN l_linenumber <= 2 THEN CAST(l_quantity AS DECIMAL(18,4)) END AS inventory_quantity,
               {_GROSS} AS price, {_GROSS} AS cost,
               CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS cancelled_at,
               CAST(l_orderkey AS STRING) AS document
        FROM {{lineitem}}""",
    "butcher_feed": f"""
        SELECT CAST(year(l_shipdate) AS STRING) AS year, CAST(month(l_shipdate) AS STRING) AS month,
               l_partkey AS scale_code,
               CAST(max(CASE WHEN l_tax > 0.02 THEN {_GROSS} WHEN l_tax > 0 THEN 0 END) AS DECIMAL(18,4)) AS unit_value,
               CAST(max(l_shipdate) AS DATE) AS last_cost
        FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey WHERE p_type = 'LARGE' GROUP BY 1, 2, 3""",
    # -- finance titles ----------------------------------------------------------------------------------------
    "order_title": f"""
        SELECT o_orderkey, 'T' || {_KEY_TEXT} AS installment_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Receita' ELSE 'Despesa' END AS type,
               CAST(o_orderdate AS DATE) + 30
                   + CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_custkey % 80 AS INT) ELSE 0 END AS due_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 20 END AS settled_date,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Liquidado'
                    WHEN o_orderstatus = 'P' THEN 'Baixado' ELSE 'Aberto' END AS status,
               CAST({_money("o_totalprice")}
                    + CASE WHEN o_orderkey % 14 = 0 THEN 5.00 WHEN o_orderkey % 20 = 0 THEN 0.01
                           WHEN o_orderkey % 30 = 0 THEN 0.02 ELSE 0.00 END AS DECIMAL(14,2)) AS value,
               CASE WHEN o_orderkey % 20 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN NULL
                    WHEN o_orderkey % 2 = 0 THEN lpad({_KEY_TEXT}, 8, '0') || '  '
                    WHEN o_orderkey % 7 = 0 THEN '' ELSE 'N' || {_KEY_TEXT} END AS number,
               CASE WHEN o_orderkey % 53 <> 0 THEN 'T' || {_KEY_TEXT} END AS title_id,
               CASE WHEN o_orderkey % 20 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN NULL
                    WHEN o_orderkey % 2 = 0 THEN lpad({_KEY_TEXT}, 8, '0')
                    ELSE 'D' || {_KEY_TEXT} END AS title_number,
               CAST(o_orderdate AS DATE) AS issue_date, {_money("o_totalprice")} AS title_value,
               r_name AS company, {_tax_id("lpad(CAST(r_regionkey AS STRING), 14, '0')")} AS company_tax_id,
               c_name AS party_name, lpad(CAST(c_custkey AS STRING), 11, '0') AS party_document,
               CASE WHEN o_orderkey % 29 = 0 THEN true WHEN o_orderkey % 3 <> 0 THEN false END AS cancelled,
               CASE WHEN o_orderkey % 37 = 0 THEN 'absent' WHEN o_orderkey % 37 = 1 THEN 'null' ELSE 'list' END
                   AS lines,
               'Despesa' AS first_type, CASE WHEN o_orderkey % 5 = 0 THEN 'Receita' ELSE 'Despesa' END AS second_type,
               c_mktsegment || ' ' AS first_centre, 'GENERAL' AS second_centre, o_orderpriority AS first_plan,
               CASE WHEN o_orderkey % 3 = 0 THEN 'Grupo Compra de Mercadorias' ELSE o_orderpriority END AS second_plan
        FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey JOIN {{nation}} ON n_nationkey = c_nationkey
             JOIN {{region}} ON r_regionkey = n_regionkey
        WHERE o_orderkey % 22 <> 0""",
    "invoice_title": f"""
        SELECT l_orderkey AS o_orderkey,
               'P' || supplier_code || '-' || document || '-' || CAST(copy AS STRING) || CAST(n AS STRING)
                   AS installment_id,
               'Despesa' AS type, issued_at + CAST(30 * n AS INT) AS due_date,
               CASE WHEN l_orderkey % 3 = 0 OR n = 1 THEN issued_at + 20 END AS settled_date, 'Aberto' AS status,
               CAST(total AS DECIMAL(14,2)) AS value, document AS number,
               'P' || supplier_code || '-' || document || '-' || CAST(copy AS STRING) AS title_id,
               'NF ' || document AS title_number, issued_at AS issue_date,
               CAST(total + CASE WHEN l_orderkey % 7 = 0 THEN 5.00 ELSE 0.00 END AS DECIMAL(18,2)) AS title_value,
               b.trade_name AS company, {_tax_id("b.tax_id")} AS company_tax_id,
               'Supplier ' || CAST(l_suppkey AS STRING) AS party_name,
               substr(supplier_code, 1, 8) || '/' || substr(supplier_code, 9) AS party_document,
               CASE WHEN l_orderkey % 31 = 0 THEN true END AS cancelled, 'list' AS lines, 'Despesa' AS first_type,
               'Despesa' AS second_type, 'BUILDING ' AS first_centre, 'GENERAL' AS second_centre,
               'Compra de Mercadorias' AS first_plan, '1-URGENT' AS second_plan
        FROM (SELECT *, 1 AS n, 1 AS copy FROM {{posted_invoice}}
              UNION ALL SELECT *, 2, 1 FROM {{posted_invoice}} WHERE l_orderkey % 2 = 0
              UNION ALL SELECT *, 1, 2 FROM {{posted_invoice}} WHERE l_orderkey % 13 = 0
              UNION ALL SELECT *, 2, 2 FROM {{posted_invoice}} WHERE l_orderkey % 26 = 0) p
             JOIN {{branch}} b ON b.branch_code = p.branch_code""",
    "posted_invoice": f"""
        SELECT branch_code, supplier_code, document, l_orderkey, l_suppkey, issued_at, total
        FROM {{purchase_header}} WHERE l_orderkey % 5 <> 0
        UNION ALL
        SELECT min(s.branch_code), s.supplier_code, lpad(CAST(l_orderkey AS STRING), 9, '0'), l_orderkey, l_suppkey,
               CAST(min(l_shipdate) AS DATE), CAST(sum({_GROSS}) AS DECIMAL(18,2))
        FROM {{lineitem}} l JOIN {{supplier_register}} s ON s.s_suppkey = l_suppkey
        WHERE l_returnflag = 'N' AND l_orderkey % 11 = 0
              AND NOT EXISTS (SELECT 1 FROM {{purchase_header}} h
                              WHERE h.supplier_code = s.supplier_code AND h.l_orderkey = l.l_orderkey)
        GROUP BY s.supplier_code, l_orderkey, l_suppkey""",
    "title_source": "SELECT * FROM {order_title} UNION ALL SELECT * FROM {invoice_title}",
    "title_document": "SELECT issue_date AS seen_at, "
    + "'{"
    + " || ',".join(
        f"\"{name}\":' || {value}"
        for name, value in {
            "ParcelaId": _quoted("installment_id"),
            "Tipo": _quoted("type"),
            "Vencimento": _quoted("CAST(due_date AS STRING) || 'T00:00:00'"),
            "Liquidacao": _quoted("coalesce(CAST(settled_date AS STRING) || 'T00:00:00', '')"),
            "Status": _quoted("status"),
            "ValorBruto": _plain("value"),
            "Numero": _quoted("number"),
            "Conta": "'\"MAIN\"'",
            "MeioDePagamento": _quoted("CASE WHEN issue_date > due_date - 40 THEN 'boleto' ELSE 'dda' END"),
            "Cancelada": _plain("cancelled"),
            "DadosDoTitulo": _json(
                TituloId=_quoted("title_id"),
                NumeroDoTitulo=_quoted("title_number"),
                Emissao=_quoted("CAST(issue_date AS STRING) || 'T00:00:00'"),
                Valor=_plain("title_value"),
                Empresa=_json(Nome=_quoted("company"), Inscricao=_quoted("company_tax_id")),
                ClienteFornecedor=_json(Nome=_quoted("party_name"), Inscricao=_quoted("party_document")),
            ),
        }.items()
    )
    + " || CASE lines WHEN 'absent' THEN '' WHEN 'null' THEN ',\"Rateio\":null' ELSE ',\"Rateio\":[' || "
    + _line("first_type", "substr(CAST(issue_date AS STRING), 1, 7)", "first_centre", "first_plan", _PAYABLE_LINE_VALUE)
    + " || ',' || "
    + _line(
        "second_type",
        "substr(CAST(issue_date AS STRING), 1, 7)",
        "second_centre",
        "second_plan",
        f"CAST(value - {_PAYABLE_LINE_VALUE} AS DECIMAL(18,2))",
    )
    + " || ']' END || '}' AS payload FROM {title_source}",
    "plan_group": """
        SELECT DISTINCT o_orderpriority AS account_plan,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'PESSOAS' WHEN '2' THEN 'ADMINISTRATIVAS'
                    WHEN '3' THEN 'OCUPACAO' WHEN '4' THEN 'FINANCEIRA' END AS expense_group
        FROM {orders} WHERE substr(o_orderpriority, 1, 1) <> '5'""",
    "centre_department": """
        SELECT DISTINCT c_mktsegment AS cost_centre,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'PROMO' WHEN 'FURNITURE' THEN 'ECONOMY' END AS department
        FROM {customer}""",
    "slip": f"""
        SELECT lpad({_KEY_TEXT}, 8, '0') || ' ' AS slip_number, 'B' || {_KEY_TEXT} AS bank_number,
               o_orderdate AS issued_at, CAST(o_orderdate AS DATE) + 30 AS due_at,
               {_money("o_totalprice")} AS value, CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS cancelled_at,
               o_custkey AS customer_number
        FROM {{orders}} WHERE o_orderkey % 2 = 0""",
    # -- cards and till receipts -------------------------------------------------------------------------------
    "card_source": f"""
        SELECT event_id, 'C' || CAST(event_id AS STRING) AS installment_id,
               'K' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING) AS card_id,
               CASE WHEN event_id % 23 = 0 THEN 'Despesa' WHEN event_id % 2 = 0 THEN 'Receita' END AS type,
               CASE WHEN event_id % 19 = 0 THEN 'Baixados' WHEN event_id % 31 <> 0 THEN 'Aberto' END AS status,
               {_SHIFTED_DAY} AS sale_date,
               lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') || ':00'
                   AS sale_time,
               {_money("value")} AS gross, CAST({_money("value")} * 0.03 AS DECIMAL(18,2)) AS fee,
               CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_type = 'click' THEN 'Pix QR' ELSE 'Credit' END
                   AS modality,
               CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN true WHEN event_id % 3 = 0 THEN false END
                   AS item_cancelled,
               CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'True' WHEN event_id % 5 = 0 THEN 'false' END
                   AS card_cancelled,
               CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '?' END AS reconciled,
               CASE WHEN event_id % 6 = 0 THEN 'x' ELSE CAST(1 + event_id % 3 AS STRING) END AS installment,
               CASE WHEN event_id % 7 = 0 THEN 'many' ELSE '3' END AS installments,
               r_name AS company, {_tax_id("lpad(CAST(r_regionkey AS STRING), 14, '0')")} AS company_tax_id,
               'ACQ' || CAST(user_id % 3 AS STRING) AS acquirer,
               CASE WHEN event_id % 13 <> 0 THEN 'BR' || CAST(user_id % 4 AS STRING) END AS brand,
               CASE event_id % 6 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
                    WHEN 3 THEN '4-NOT SPECIFIED' ELSE 'Card fees' END AS plan,
               CASE event_id % 3 WHEN 0 THEN 'BUILDING ' WHEN 1 THEN 'HOUSEHOLD' ELSE 'GENERAL' END AS centre
        FROM {{events}} JOIN {{region}} ON r_regionkey = user_id % 5
        WHERE event_type IN ('purchase', 'click', 'error') AND NOT (user_id % 5 + 1 = 2 AND day(ts) % 7 = 0)""",
    "card_document": "SELECT sale_date AS seen_at, "
    + _json(
        ParcelaId=_quoted("installment_id"),
        Tipo=_quoted("type"),
        Status=_quoted("status"),
        Vencimento=_quoted("CAST(sale_date + 30 AS STRING) || 'T00:00:00'"),
        Liquidacao="CASE WHEN event_id % 2 = 0 THEN '\"\"' ELSE 'null' END",
        Modalidade=_quoted("modality"),
        Numero=_quoted("installment"),
        ValorBruto=_plain("gross"),
        ValorLiquido=_plain("CAST(gross - fee AS DECIMAL(18,2))"),
        Taxa=_plain("fee"),
        Cancelada=_plain("item_cancelled"),
        DadosDoCartao=_json(
            CartaoId=_quoted("card_id"),
            DataDaVenda=_quoted("CASE WHEN event_id % 2 = 0 THEN CAST(sale_date AS STRING) ELSE '' END"),
            Hora=_quoted("CASE WHEN event_id % 2 = 0 THEN sale_time END"),
            Empresa=_json(Nome=_quoted("company"), Inscricao=_quoted("company_tax_id")),
            Adquirente=_quoted("acquirer"),
            Bandeira=_quoted("brand"),
            MeioDeCaptura="'\"POS\"'",
            TotalDeParcelas=_quoted("installments"),
            Cancelado=_quoted("card_cancelled"),
            ConciliadoComPDV=_quoted("reconciled"),
            Vendas="'[' || "
            + _json(
                DataDaVenda=_quoted("CAST(sale_date AS STRING) || 'T10:00:00'"),
                HoraDaVenda=_quoted("sale_time"),
                NSU=_plain("CASE WHEN event_id % 8 <> 0 THEN event_id END"),
                CodigoAutorizacao=_quoted("'A' || CAST(event_id AS STRING)"),
            )
            + " || ']'",
        ),
        Rateio="'[' || "
        + _line("'Receita'", "substr(CAST(sale_date AS STRING), 1, 7)", "centre", "'Card sales'", "gross")
        + " || ',' || "
        + _line("'Despesa'", "substr(CAST(sale_date AS STRING), 1, 7)", "centre", "plan", "fee")
        + " || ']'",
    )
    + " AS payload FROM {card_source}",
    "till_receipt": """
        SELECT event_id AS receipt_id, ts - INTERVAL 276 MONTH AS issued_at, CAST(user_id % 5 + 1 AS INT) AS branch_code,
               CAST(user_id % 4 AS INT) AS terminal, CASE WHEN event_id % 16 = 0 THEN 1 ELSE 0 END AS cancelled
        FROM {events}
        WHERE event_type IN ('view', 'signup') AND NOT (user_id % 5 + 1 = 3 AND day(ts) % 7 = 0)""",
    "till_payment": f"""
        SELECT event_id AS payment_id, event_id AS receipt_id,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS form_code, {_money("value")} AS amount,
               CASE WHEN event_id % 4 = 0 THEN CAST(0.50 AS DECIMAL(18,2)) END AS change,
               CAST(1 + event_id % 3 AS INT) AS installments
        FROM {{events}} WHERE event_type IN ('view', 'signup')""",
    # -- landing and synchronisation ---------------------------------------------------------------------------
    "load": """
        SELECT CASE event_type WHEN 'view' THEN 'products' ELSE event_type END AS table_name, ts AS started_at, ts AS ended_at,
               event_id AS rows, CASE WHEN event_id % 5 = 0 THEN 'failed' END AS error
        FROM {events}""",
    "served_by_dates": """
        SELECT o_orderkey, o_custkey, o_orderpriority,
               CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) + 20 END AS settled
        FROM {orders}""",
    "landed_event": """
        SELECT event_id, CAST(floor(event_id / 500) AS BIGINT) AS page, user_id, event_type,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, event_id % 211 = 0 AS lost
        FROM {events}""",
    "detail_response": """
        SELECT '{"id":' || CAST(event_id AS STRING) || '}' AS parameters,
               CASE WHEN event_id % 7 = 0 THEN '{"_http_error":500}' ELSE props END AS payload
        FROM {events} WHERE event_id % 3 <> 0""",
    "old_title": f"""
        SELECT o_orderkey AS title, o_custkey AS customer, {_money("o_totalprice")} AS value,
               CAST(o_orderdate AS DATE) AS due, DATE '2001-08-30' AS seen_at
        FROM {{orders}} WHERE o_orderkey % 3 <> 0""",
    "title_batch": f"""
        SELECT CASE WHEN o_orderkey % 101 <> 0 THEN o_orderkey END AS title, o_custkey AS customer,
               CAST({_money("o_totalprice")} + n AS DECIMAL(18,2)) AS value, CAST(o_orderdate AS DATE) AS due,
               n AS delivery
        FROM (SELECT *, 1 AS n FROM {{orders}}
              UNION ALL SELECT *, 2 AS n FROM {{orders}} WHERE o_orderkey % 10 = 0) x
        WHERE o_orderkey % 3 <> 1""",
    "finance_state": f"""
        SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'income' WHEN 1 THEN 'expense' ELSE 'card' END AS kind,
               CAST(o_orderdate AS DATE) AS issued, CAST(o_orderdate AS DATE) + 25 AS due,
               {_money("o_totalprice")} AS value, DATE '2001-08-30' AS seen_at
        FROM {{orders}} WHERE o_orderkey % 4 <> 1""",
    "finance_read": f"""
        SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS id, read,
               CASE o_orderkey % 3 WHEN 0 THEN 'income' WHEN 1 THEN 'expense' ELSE 'card' END AS kind,
               CAST(o_orderdate AS DATE) AS issued, CAST(o_orderdate AS DATE) + 25 AS due,
               CAST({_money("o_totalprice")} + n AS DECIMAL(18,2)) AS value, n AS delivery
        FROM (SELECT *, 'due' AS read, 1 AS n FROM {{orders}} WHERE o_orderkey % 3 <> 2 AND o_orderkey % 4 <> 2
              UNION ALL SELECT *, 'due', 2 FROM {{orders}} WHERE o_orderkey % 3 <> 2 AND o_orderkey % 20 = 0
              UNION ALL SELECT *, 'issue', 3 FROM {{orders}} WHERE o_orderkey % 3 = 1 AND o_orderkey % 5 <> 2
              UNION ALL SELECT *, 'sale', 4 FROM {{orders}} WHERE o_orderkey % 3 = 2 AND o_orderkey % 4 <> 3) x""",
    "old_customer": """
        SELECT c_custkey AS code, CASE WHEN c_custkey % 5 = 0 THEN c_name || ' old' ELSE c_name END AS name,
               c_mktsegment AS segment, DATE '2001-01-01' AS touched_at
        FROM {customer} WHERE c_custkey % 3 <> 0""",
    "new_customer": """
        SELECT c_custkey AS code, CASE WHEN c_custkey % 7 = 0 THEN '  ' ELSE ' ' || c_name || ' ' END AS name,
               CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS segment
        FROM {customer} WHERE c_custkey % 4 <> 0""",
    "queued": """
        SELECT o_custkey AS customer, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority,
               o_orderkey AS title
        FROM {orders} WHERE o_orderkey % 3 = 0""",
    "proposed": """
        SELECT o_custkey AS customer, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority,
               o_orderkey AS title
        FROM {orders} WHERE o_orderkey % 3 <> 0""",
}

# Documents the finance system delivers.  They are landed before anything reads them, as the platform does.
LANDED = ("title_document", "card_document")

_NAME = re.compile(r"\{([a-z_]+)\}")


def needs(template: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(template)))


class Sources:
    """Tables and overlays over one data folder as DataFrames: ``sources.receipt`` and so on.

    Each is a temporary view, defined on first use and kept for the session, so that a job naming an overlay
    twenty times reads file footers and resolves its query once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = planned(spark), folder
        self._prefix = "tillstone_" + hashlib.md5(folder.encode()).hexdigest()[:10]

    def query(self, name: str) -> str:
        return _NAME.sub(lambda m: self._view(m[1]), OVERLAYS[name])

    def _view(self, name: str) -> str:
        view = f"{self._prefix}_{name}"
        if not self.spark.catalog.tableExists(view):
            if name in TABLES:
                rows = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                rows = self.spark.sql(self.query(name))
                if name in LANDED:
                    rows = settled(rows, name, splits=True, wide=True)
            rows.createOrReplaceTempView(view)
        return view

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in TABLES and name not in OVERLAYS):
            raise AttributeError(name)
        return self.spark.table(self._view(name))

    def kept(self, name: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        """A table the platform stores between jobs, in folders by one column: settled on first use."""
        view = f"{self._prefix}_{name}"
        if not self.spark.catalog.tableExists(view):
            settled(build(), name, by).createOrReplaceTempView(view)
        return self.spark.table(view)
