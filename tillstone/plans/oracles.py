"""The SQL side of the correctness check: each step restated as plain SQL over the same overlays.

Steps are written from the definitions (range joins, windows, correlated subqueries), not from the Spark plans.
"""

from __future__ import annotations

from functools import cache

from tillstone.plans import overlays as ov
from tillstone.plans.overlays import OVERLAYS, TABLES, needs

A = f"DATE '{ov.AS_OF}'"
S = f"DATE '{ov.START}'"
K = f"DATE '{ov.CARDS_AS_OF}'"

Z = "coalesce({}, 0)".format


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


def _tax(*names: str) -> str:
    return "CAST(round(" + " + ".join(Z(n) for n in names) + ", 2) AS DECIMAL(18,2))"


def _best(cost: str, positive: str) -> str:
    return f"CASE WHEN {cost} <> 0 THEN {cost} ELSE {positive} END"


_BRANCH_NAME = "(SELECT trade_name FROM {branch} b WHERE b.branch_code = "
_CHAIN = """
    LEFT JOIN {product} p ON p.product_code = x.product_code
    LEFT JOIN {product_master} m ON m.internal_code = p.internal_code
    LEFT JOIN {product_group} g ON g.group_code = m.group_code
    LEFT JOIN {product_section} c ON c.section_code = g.section_code"""

_GROUPS = ("PESSOAS", "ADMINISTRATIVAS", "EMBALAGEM", "FINANCEIRA", "INTERVENIENCIA", "MANUTENCAO", "MARKETING", "OCUPACAO")
_CASCADE = "occupancy people administrative packaging maintenance marketing intermediation".split()
_AMOUNTS = (
    "bought_quantity bought_value purchase_tax internal_quantity internal_gross internal_net sold_quantity sold_gross "
    "sold_net sales_discount sales_tax transformed_quantity breakage_quantity breakage_value"
).split()


STEPS = {
    # -- staging -----------------------------------------------------------------------------------------------
    "o_branch": """
        SELECT CAST(branch_code AS INT) AS branch_id, trade_name AS branch_name, legal_name, tax_id,
               substr(t, 1, 2) || '.' || substr(t, 3, 3) || '.' || substr(t, 6, 3) || '/' || substr(t, 9, 4) || '-'
                   || substr(t, 13, 2) AS tax_id_formatted
        FROM (SELECT *, lpad(tax_id, 14, '0') AS t FROM {branch}) x""",
    "o_sales": """
        SELECT i.item_id AS id, r.receipt_id AS sale_id, CAST(b.branch_code AS INT) AS branch_id,
               b.trade_name AS branch_name, r.sequence_text, r.cancelled = 1 AS sale_cancelled, r.issued_at,
               i.registered_at, coalesce(r.person_document, r.company_document) AS customer_document,
               coalesce(n.invoice_number, c.invoice_number) AS invoice_number,
               coalesce(n.invoice_series, c.invoice_series) AS invoice_series,
               coalesce(n.access_key, c.access_key) AS access_key,
               coalesce(CAST(n.cancelled_flag AS INT), 1) AS invoice_status, n.cancel_reason,
               CASE WHEN n.access_key IS NOT NULL THEN 'NFCe' WHEN c.access_key IS NOT NULL THEN 'NFe'
                    ELSE 'N/A' END AS invoice_type,
               i.sequence AS item, i.product_code, CAST(i.cancelled AS INT) = 1 AS item_cancelled, i.quantity,
               i.unit_price, i.item_discount, i.payment_discount, i.item_surcharge, i.payment_surcharge, i.total,
               i.icms, i.fcp, i.pis, i.cofins
        FROM {receipt_item} i JOIN {receipt} r ON r.receipt_id = i.receipt_id
             JOIN {branch} b ON b.branch_code = r.branch_code
             LEFT JOIN {consumer_invoice} n ON n.receipt_id = r.receipt_id
             LEFT JOIN {company_invoice} c ON c.receipt_id = r.receipt_id""",
    "o_purchases": """
        SELECT l.line_id AS id, CAST(h.branch_code AS INT) AS branch_id, b.trade_name AS branch_name,
               o.order_number, h.operation_code AS operation_id, p.operation_name,
               h.supplier_code AS supplier_document, s.supplier_name, h.access_key,
               CAST(h.document AS INT) AS invoice_number, h.series AS invoice_series, h.issued_at, h.entered_at,
               l.sequence AS item, l.product_code, l.boxes AS quantity, l.units_per_box, l.box_price AS unit_price,
               l.discount, l.calculated_discount,
               CAST(l.boxes * l.units_per_box * l.box_price - (coalesce(l.discount, 0) + l.calculated_discount)
                    AS DECIMAL(24,6)) AS total,
               CASE WHEN t.substituted = '0' THEN l.icms ELSE 0 END AS icms, l.fcp, l.pis_credit AS pis,
               l.cofins_credit AS cofins, l.item_status, h.invoice_status, l.changed_at
        FROM {purchase_line} l
             JOIN {purchase_header} h ON h.branch_code = l.branch_code AND h.supplier_code = l.supplier_code
                  AND h.document = l.document AND h.series = l.series
             JOIN {branch} b ON b.branch_code = h.branch_code
             JOIN {supplier_register} s ON s.supplier_code = h.supplier_code
             JOIN {operation} p ON p.operation_code = h.operation_code
             JOIN {tax_code} t ON t.tax_code = l.tax_code
             LEFT JOIN {purchase_order} o ON o.order_number = h.order_number""",
    "o_daily": """
        SELECT moved_at AS date, branch_code AS branch_id, product_code, quantity, cost, breakage_quantity,
               breakage_value
        FROM {daily_stock_source}""",
    "o_inventory": """
        SELECT h.branch_code AS branch_id, CAST(h.inventory AS INT) AS inventory_id,
               CAST(h.updated_at AS DATE) AS reference_date, h.processed_at, h.processed_at IS NOT NULL AS processed,
               h.selection_kind, nullif(trim(h.selection_code), '') AS selection_code,
               h.zero_uncounted IS NOT NULL AS zeroes_uncounted, l.product_code, l.store_quantity, l.deposit_quantity,
               CASE WHEN l.store_quantity IS NULL THEN l.deposit_quantity
                    ELSE l.store_quantity + coalesce(l.deposit_quantity, 0) END AS counted_quantity,
               coalesce(l.store_quantity, l.deposit_quantity) IS NOT NULL AS counted, l.cost
        FROM {inventory_header} h
             JOIN (SELECT DISTINCT ON (branch_code, inventory, product_code) *
                   FROM {inventory_source}
                   ORDER BY branch_code, inventory, product_code, sequence DESC NULLS FIRST,
                            store_quantity DESC NULLS LAST, deposit_quantity DESC NULLS LAST, cost DESC NULLS LAST) l
             ON l.branch_code = h.branch_code AND l.inventory = h.inventory""",
    "o_movements": """
        SELECT branch_code AS branch_id, product_code, operated_at, operation_code AS operation_id,
               operation_code = 101 OR operation_code = 201 AS inventory_adjustment, quantity, balance,
               inventory_quantity, price, cost, cancelled_at, document
        FROM {movement}""",
    "o_prices": """
        SELECT k.branch_code AS branch_id, b.trade_name AS branch_name, k.product_code, p.short_name AS description,
               k.quantity, k.cost, k.price AS sale_price, k.entry_tax_rate AS entry_tax, k.exit_tax_rate AS exit_tax
        FROM {current_stock} k JOIN {product} p USING (product_code) JOIN {branch} b USING (branch_code)""",
    "o_transformations": """
        SELECT h.branch_code AS branch_id, h.number AS transformation_id, h.processed_at, h.transformed_at,
               l.product_code AS source_product, l.product_quantity AS source_quantity,
               l.output_code AS target_product, l.output_quantity AS target_quantity
        FROM {transformation_header} h JOIN {transformation_line} l USING (branch_code, number)""",
    "o_butcher": """
        SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month_number, scale_code AS product_code,
               unit_value AS unit_cost, last_cost AS last_cost_date
        FROM {butcher_feed}""",
    "o_titles": """
        SELECT payload->>'$.ParcelaId' AS installment_id, payload->>'$.Tipo' AS type,
               CAST(left(nullif(payload->>'$.Vencimento', ''), 10) AS DATE) AS due_date,
               CAST(left(nullif(payload->>'$.Liquidacao', ''), 10) AS DATE) AS settled_date,
               payload->>'$.Status' AS status, CAST(payload->>'$.ValorBruto' AS DECIMAL(14,2)) AS value,
               trim(coalesce(nullif(payload->>'$.Numero', ''), payload->>'$.DadosDoTitulo.NumeroDoTitulo')) AS number,
               payload->>'$.DadosDoTitulo.ClienteFornecedor.Nome' AS party_name,
               payload->>'$.DadosDoTitulo.ClienteFornecedor.Inscricao' AS party_document,
               payload->>'$.DadosDoTitulo.Empresa.Nome' AS company,
               payload->>'$.DadosDoTitulo.Empresa.Inscricao' AS company_tax_id, payload->>'$.Conta' AS account,
               payload->>'$.MeioDePagamento' AS payment_means,
               CAST(payload->>'$.Cancelada' AS BOOLEAN) AS cancelled, payload, seen_at
        FROM {title_document}""",
    "o_cards": """
        SELECT payload->>'$.ParcelaId' AS installment_id, payload->>'$.DadosDoCartao.CartaoId' AS card_id,
               CAST(left(coalesce(nullif(payload->>'$.DadosDoCartao.DataDaVenda', ''),
                                  payload->>'$.DadosDoCartao.Vendas[0].DataDaVenda'), 10) AS DATE) AS sale_date,
               coalesce(nullif(payload->>'$.DadosDoCartao.Hora', ''),
                        nullif(payload->>'$.DadosDoCartao.Vendas[0].HoraDaVenda', '')) AS sale_time,
               CAST(left(nullif(payload->>'$.Vencimento', ''), 10) AS DATE) AS due_date,
               CAST(left(nullif(payload->>'$.Liquidacao', ''), 10) AS DATE) AS settled_date,
               payload->>'$.DadosDoCartao.Empresa.Nome' AS company,
               payload->>'$.DadosDoCartao.Empresa.Inscricao' AS company_tax_id,
               payload->>'$.DadosDoCartao.Adquirente' AS acquirer, payload->>'$.DadosDoCartao.Bandeira' AS brand,
               payload->>'$.Modalidade' AS modality, payload->>'$.DadosDoCartao.MeioDeCaptura' AS capture,
               TRY_CAST(payload->>'$.Numero' AS INT) AS installment,
               TRY_CAST(payload->>'$.DadosDoCartao.TotalDeParcelas' AS INT) AS installments,
               CAST(payload->>'$.ValorBruto' AS DECIMAL(14,2)) AS gross_value,
               CAST(payload->>'$.ValorLiquido' AS DECIMAL(14,2)) AS net_value,
               CAST(payload->>'$.Taxa' AS DECIMAL(14,2)) AS fee, payload->>'$.DadosDoCartao.Vendas[0].NSU' AS nsu,
               payload->>'$.DadosDoCartao.Vendas[0].CodigoAutorizacao' AS authorization_code,
               coalesce(lower(payload->>'$.Cancelada') = 'true', false)
                   OR coalesce(lower(payload->>'$.DadosDoCartao.Cancelado') = 'true', false) AS cancelled,
               CASE lower(payload->>'$.DadosDoCartao.ConciliadoComPDV') WHEN 'true' THEN true WHEN 'false' THEN false
                    END AS reconciled,
               payload, seen_at
        FROM {card_document}""",
    "o_title_lines": """
        SELECT *, unnest(CASE WHEN json_type(payload, '$.Rateio') = 'ARRAY'
                              THEN CAST(json_extract(payload, '$.Rateio') AS JSON[]) ELSE [] END) AS line
        FROM {o_titles}""",
    "o_title_allocations": """
        SELECT installment_id, payload->>'$.DadosDoTitulo.TituloId' AS title_id, type AS installment_type, status,
               coalesce(cancelled, false) AS cancelled,
               CAST(left(payload->>'$.DadosDoTitulo.Emissao', 10) AS DATE) AS issue_date, due_date, settled_date,
               company_tax_id, party_name AS party, line->>'$.Tipo' AS line_type,
               line->>'$.Competencia' AS competence, trim(line->>'$.CentroDeCusto') AS cost_centre,
               line->>'$.PlanoDeContas' AS account_plan, CAST(line->>'$.Valor' AS DECIMAL(18,2)) AS value
        FROM {o_title_lines}""",
    "o_card_allocations": """
        SELECT installment_id, card_id, payload->>'$.Tipo' AS installment_type, payload->>'$.Status' AS status,
               cancelled, sale_date, due_date, settled_date, company_tax_id, acquirer, brand,
               line->>'$.Tipo' AS line_type, line->>'$.Competencia' AS competence,
               trim(line->>'$.CentroDeCusto') AS cost_centre, line->>'$.PlanoDeContas' AS account_plan,
               CAST(line->>'$.Valor' AS DECIMAL(18,2)) AS value
        FROM (SELECT *, unnest(CAST(json_extract(payload, '$.Rateio') AS JSON[])) AS line FROM {o_cards}) x""",
    # -- stock -------------------------------------------------------------------------------------------------
    "o_calendar": f"""
        SELECT CAST(m AS DATE) AS month, least(last_day(CAST(m AS DATE)), {A}) AS month_end
        FROM generate_series({S}, date_trunc('month', {A}), INTERVAL 1 MONTH) t(m)""",
    "o_segment_months": f"""
        SELECT segment, CAST(m AS DATE) AS month, least(last_day(CAST(m AS DATE)), {A}) AS month_end
        FROM (SELECT c_custkey AS segment, min(o_orderdate) AS first FROM {{orders}} JOIN {{customer}}
              ON c_custkey = o_custkey GROUP BY 1) x,
             generate_series(date_trunc('month', first), date_trunc('month', {A}), INTERVAL 1 MONTH) t(m)""",
    # the row after, and the last row with a cost above zero, each looked up by date
    "o_validity": """
        SELECT d.branch_id, d.product_code, d.date, later.date AS next_date, d.quantity, d.cost,
               paid.cost AS positive_cost
        FROM {o_daily} d
             ASOF LEFT JOIN {o_daily} later
                  ON later.branch_id = d.branch_id AND later.product_code = d.product_code AND later.date > d.date
             ASOF LEFT JOIN (FROM {o_daily} WHERE cost > 0) paid
                  ON paid.branch_id = d.branch_id AND paid.product_code = d.product_code AND paid.date <= d.date""",
    "o_before_month": """
        SELECT month, branch_id, product_code, date AS position_date, quantity, cost, positive_cost
        FROM {o_calendar} JOIN {o_validity} ON date < month AND (next_date IS NULL OR next_date >= month)""",
    "o_closing": """
        SELECT month, branch_id, product_code, date AS position_date, quantity, cost, positive_cost
        FROM {o_calendar} JOIN {o_validity} ON date <= month_end AND (next_date IS NULL OR next_date > month_end)""",
    "o_first_inventory": f"""
        SELECT DISTINCT ON (month, branch_id, product_code) month, branch_id, product_code, inventory_id,
               reference_date, coalesce(counted_quantity, 0) AS counted_quantity
        FROM (SELECT *, CAST(date_trunc('month', reference_date) AS DATE) AS month FROM {{o_inventory}}) x
        WHERE processed AND day(reference_date) <= 5 AND (counted OR zeroes_uncounted) AND reference_date >= {S}
        ORDER BY month, branch_id, product_code, reference_date, inventory_id""",
    "o_opening": """
        WITH counted AS (
            SELECT f.month, f.branch_id, f.product_code, 'inventory' AS origin, f.reference_date AS stock_date,
                   f.counted_quantity AS quantity, f.inventory_id,
                   (SELECT v.cost FROM {o_validity} v
                    WHERE v.branch_id = f.branch_id AND v.product_code = f.product_code
                          AND f.reference_date BETWEEN v.date AND coalesce(v.next_date - 1, DATE '9999-01-01')) AS cost
            FROM {o_first_inventory} f
        ), offered AS (
            FROM counted
            UNION ALL BY NAME
            SELECT month, branch_id, product_code, 'position' AS origin, month - 1 AS stock_date, quantity, cost,
                   quantity AS position_quantity, position_date
            FROM {o_before_month}
        )
        SELECT month, branch_id, product_code, origin, stock_date, quantity, cost, inventory_id,
               max(position_quantity) OVER same AS position_quantity, max(position_date) OVER same AS position_date
        FROM offered
        WINDOW same AS (PARTITION BY month, branch_id, product_code)
        QUALIFY row_number() OVER (PARTITION BY month, branch_id, product_code ORDER BY origin) = 1""",
    "o_opening_cost": f"""
        SELECT o.*, {_best("o.cost", "v.positive_cost")} AS effective_cost
        FROM {{o_opening}} o LEFT JOIN {{o_validity}} v
             ON v.branch_id = o.branch_id AND v.product_code = o.product_code AND v.date <= o.stock_date
                AND (v.next_date IS NULL OR v.next_date > o.stock_date)""",
    "o_asof_cost": f"""
        SELECT c.id, c.branch_id, c.product_code, c.issued_at, v.cost, v.positive_cost,
               {_best("v.cost", "v.positive_cost")} AS asof_cost
        FROM {{o_purchases}} c LEFT JOIN {{o_validity}} v
             ON v.branch_id = c.branch_id AND v.product_code = c.product_code AND v.date <= c.issued_at
                AND (v.next_date IS NULL OR v.next_date > c.issued_at)""",
    "o_reference_cost": """
        SELECT month, product_code, arg_max(positive_cost, date) FILTER (WHERE date < month) AS start_cost,
               arg_max(positive_cost, date) AS end_cost
        FROM {o_validity} JOIN {o_calendar} ON date <= month_end
        WHERE branch_id = 1 GROUP BY ALL""",
    # -- profitability -----------------------------------------------------------------------------------------
    "o_current_product": f"""
        SELECT x.product_code, p.internal_code, m.default_code, p.short_name, m.full_name, p.package,
               p.units_per_package, u.unit_symbol, cc.centre_name, d.department_name, c.section_name, g.group_name,
               sg.subgroup_name, sg.margin, m.scale_flag, m.weight_flag, p.online_flag, p.deactivated_at,
               p.deleted_at, p.created_at, m.changed_at
        FROM {{product}} x {_CHAIN}
             LEFT JOIN {{product_department}} d ON d.department_code = c.department_code
             LEFT JOIN {{product_subgroup}} sg ON sg.subgroup_code = m.subgroup_code
             LEFT JOIN {{cost_centre}} cc ON cc.centre_code = m.centre_code
             LEFT JOIN {{unit}} u ON u.unit_code = m.unit_code""",
    "o_pairs": "SELECT w.* FROM {crosswalk} w WHERE w.product_code IN (SELECT product_code FROM {product})",
    "o_catalog": """
        SELECT p.product_code AS id, 'current' AS origin, p.product_code, w.legacy_code, p.internal_code,
               p.default_code, p.product_code = p.default_code AS is_default, p.short_name AS description,
               p.full_name AS full_description, p.package, p.units_per_package, p.unit_symbol AS unit,
               coalesce(p.centre_name, p.department_name) AS cost_centre, p.centre_name AS own_cost_centre,
               p.department_name AS department, p.section_name AS section, p.group_name, p.subgroup_name,
               CAST(coalesce(p.margin, 0) AS DECIMAL(18,4)) AS subgroup_margin, p.scale_flag = '1' AS sold_by_scale,
               p.weight_flag = 'V' AS variable_weight, coalesce(p.online_flag = '1', false) AS sold_online,
               p.deactivated_at IS NULL AND p.deleted_at IS NULL AS active, p.created_at AS created_on,
               p.deactivated_at AS deactivated_on, CAST(p.changed_at AS TIMESTAMP) AS changed_at,
               (SELECT max(ended_at) FROM {load} WHERE table_name = 'products' AND error IS NULL) AS refreshed_at
        FROM {o_current_product} p LEFT JOIN {o_pairs} w ON w.product_code = p.product_code
        UNION ALL
        SELECT -legacy_code, 'legacy', NULL, legacy_code, NULL, NULL, NULL, trim(short_name), trim(full_name), NULL,
               NULL, trim(unit_symbol), coalesce(trim(centre_name), trim(department_name)), trim(centre_name),
               trim(department_name), trim(section_name), trim(group_name), trim(subgroup_name),
               CAST(coalesce(margin, 0) AS DECIMAL(18,4)), scale_flag, NULL, coalesce(online_flag = 1, false), false,
               CASE WHEN created_on <> DATE '1900-01-01' THEN created_on END, NULL, CAST(changed_at AS TIMESTAMP), NULL
        FROM {legacy_product} l WHERE NOT EXISTS (SELECT 1 FROM {o_pairs} w WHERE w.legacy_code = l.legacy_code)""",
    "o_products": """
        SELECT product_code, coalesce(target_department, department) AS department,
               CASE WHEN target_department IS NULL THEN section ELSE department END AS section,
               department AS original_department, group_name, subgroup_name, description, full_description, unit, active
        FROM (SELECT p.*, r.target_department,
                     row_number() OVER (PARTITION BY p.product_code ORDER BY r.source_section_id NULLS LAST) AS place
              FROM (SELECT * FROM {o_catalog} WHERE origin = 'current') p
                   LEFT JOIN (SELECT u.*, s.section AS rule_section, s.department AS rule_department
                              FROM {reclass_rule} u LEFT JOIN {section_register} s
                                   ON s.section_id = u.source_section_id) r
                   ON r.source_department = p.department
                      AND (r.source_section_id IS NULL
                           OR (r.rule_section = p.section AND r.rule_department = p.department))) x
        WHERE place = 1""",
    "o_sold_lines": f"""
        SELECT CAST(issued_at AS DATE) AS day, branch_id, product_code, quantity, total,
               CASE WHEN customer_document = '{ov.INTERCOMPANY}' THEN 'in' ELSE 'out' END AS way,
               coalesce(item_discount, 0) + coalesce(payment_discount, 0) AS off,
               {_tax("icms", "pis", "cofins", "fcp")} AS tax
        FROM {{o_sales}}
        WHERE issued_at >= {S} AND invoice_status = 1 AND NOT (sale_cancelled OR item_cancelled)""",
    "o_sold_days": """
        SELECT day, branch_id, product_code, way, sum(quantity) AS quantity, sum(total) AS gross, sum(off) AS off,
               sum(tax) AS tax
        FROM {o_sold_lines} GROUP BY ALL""",
    "o_monthly_sales": """
        SELECT last_day(day) - (day(last_day(day)) - 1)::INT AS month, branch_id, product_code,
               sum(if(way = 'in', quantity, NULL)) AS internal_quantity, sum(if(way = 'in', gross, NULL)) AS internal_gross,
               sum(if(way = 'in', gross - off, NULL)) AS internal_net, sum(if(way = 'out', quantity, NULL)) AS sold_quantity,
               sum(if(way = 'out', gross, NULL)) AS sold_gross, sum(if(way = 'out', gross - off, NULL)) AS sold_net,
               sum(off) AS sales_discount, sum(tax) AS sales_tax
        FROM {o_sold_days} GROUP BY ALL""",
    "o_monthly_purchases": f"""
        SELECT CAST(date_trunc('month', issued_at) AS DATE) AS month, branch_id, product_code,
               sum(CAST(quantity * units_per_box AS DECIMAL(24,4))) AS bought_quantity, sum(total) AS bought_value,
               sum({_tax("icms", "pis", "cofins", "fcp")}) AS purchase_tax
        FROM {{o_purchases}} WHERE invoice_status = 3 AND issued_at >= {S} GROUP BY 1, 2, 3""",
    "o_monthly_transformations": f"""
        SELECT CAST(date_trunc('month', transformed_at) AS DATE) AS month, branch_id, target_product AS product_code,
               sum(target_quantity) AS transformed_quantity
        FROM {{o_transformations}} WHERE transformed_at >= {S} GROUP BY 1, 2, 3""",
    "o_monthly_breakage": f"""
        SELECT CAST(date_trunc('month', date) AS DATE) AS month, branch_id, product_code,
               sum(breakage_quantity) AS breakage_quantity, sum(breakage_value) AS breakage_value
        FROM {{o_daily}} WHERE date >= {S} GROUP BY 1, 2, 3""",
    "o_keys": """
        SELECT month, branch_id, product_code FROM {o_monthly_sales}
        UNION SELECT month, branch_id, product_code FROM {o_monthly_purchases}
        UNION SELECT month, branch_id, product_code FROM {o_monthly_transformations}
        UNION SELECT month, branch_id, product_code FROM {o_monthly_breakage}
        UNION SELECT month, branch_id, product_code FROM {o_opening} WHERE quantity <> 0
        UNION SELECT month, branch_id, product_code FROM {o_closing} WHERE quantity <> 0""",
    "o_item_facts": f"""
        SELECT *, true AS moved FROM {{o_monthly_sales}}
        UNION ALL BY NAME SELECT *, true AS moved FROM {{o_monthly_purchases}}
        UNION ALL BY NAME SELECT *, true AS moved FROM {{o_monthly_transformations}}
        UNION ALL BY NAME SELECT *, true AS moved FROM {{o_monthly_breakage}}
        UNION ALL BY NAME
        SELECT month, branch_id, product_code, quantity AS opening_quantity, effective_cost AS opening_best,
               stock_date AS opening_date, origin AS opening_origin, quantity <> 0 AS moved FROM {{o_opening_cost}}
        UNION ALL BY NAME
        SELECT month, branch_id, product_code, quantity AS closing_quantity,
               {_best("cost", "positive_cost")} AS closing_best, position_date AS closing_date, quantity <> 0 AS moved
        FROM {{o_closing}}""",
    "o_item_months": f"""
        SELECT month, branch_id, product_code, {", ".join(f"coalesce(max({c}), 0) AS {c}" for c in _AMOUNTS)},
               coalesce(max(opening_quantity), 0) AS opening_quantity, coalesce(max(closing_quantity), 0) AS closing_quantity,
               nullif(max(opening_best), 0) AS opening_best, nullif(max(closing_best), 0) AS closing_best,
               coalesce(max(opening_date), month) AS opening_date, max(closing_date) AS closing_date,
               max(opening_origin) AS opening_origin
        FROM {{o_item_facts}} GROUP BY month, branch_id, product_code HAVING bool_or(moved)""",
    "o_base": """
        SELECT i.* EXCLUDE (opening_best, closing_best), p.* EXCLUDE (product_code, section, department), p.section,
               p.department, r.entry_tax, r.exit_tax, r.sale_price,
               CAST(coalesce(meat.unit_cost, opening_best, own.start_cost, 0) AS DECIMAL(18,4)) AS opening_cost,
               CAST(coalesce(meat.unit_cost, closing_best, own.end_cost, 0) AS DECIMAL(18,4)) AS closing_cost
        FROM {o_item_months} i
             LEFT JOIN {o_products} p USING (product_code)
             LEFT JOIN {o_prices} r USING (branch_id, product_code)
             LEFT JOIN {o_reference_cost} own USING (month, product_code)
             LEFT JOIN {o_butcher} meat
                  ON p.department = 'LARGE' AND meat.unit_cost > 0 AND meat.product_code = i.product_code
                     AND meat.year = year(i.month) AND meat.month_number = month(i.month)""",
    "o_rates": """
        WITH due AS (
            SELECT competence, sum(value) AS tax FROM {o_title_allocations}
            WHERE company_tax_id = '00.000.000/0000-01' AND account_plan ILIKE '2-high' GROUP BY competence
        ), sold AS (
            SELECT strftime(month, '%Y-%m') AS competence, sum(sold_net) AS net FROM {o_monthly_sales}
            WHERE branch_id = 2 GROUP BY ALL HAVING net <> 0
        )
        SELECT month, if(tax IS NULL OR net IS NULL, 0.04, tax::DOUBLE / net::DOUBLE) AS rate
        FROM (SELECT month, strftime(month, '%Y-%m') AS competence FROM {o_calendar})
             NATURAL LEFT JOIN due NATURAL LEFT JOIN sold""",
    "o_measures": """
        SELECT b.*, opening_quantity + bought_quantity AS stock_and_purchases_quantity,
               CAST(opening_quantity AS DECIMAL(18,4)) * opening_cost + CAST(bought_value AS DECIMAL(30,6))
                   AS stock_and_purchases_value,
               internal_quantity + sold_quantity AS total_sold_quantity, internal_net + sold_net AS total_sales,
               CAST(internal_quantity + sold_quantity AS DECIMAL(18,4)) * closing_cost AS cogs,
               CASE branch_id WHEN 1 THEN CAST(sales_tax AS DOUBLE) WHEN 2 THEN CAST(sold_net AS DOUBLE) * rate
                    ELSE 0 END AS sales_tax_due,
               CASE WHEN branch_id = 1 THEN purchase_tax ELSE 0 END AS purchase_tax_credit,
               CAST(breakage_quantity AS DECIMAL(18,4)) * closing_cost AS restated_breakage
        FROM {o_base} b JOIN {o_rates} r ON r.month = b.month""",
    # -- marts -------------------------------------------------------------------------------------------------
    "o_spent_lines": """
        SELECT 'title' AS source, installment_id, company_tax_id, issue_date AS date, cost_centre, account_plan, party,
               if(line_type = 'Receita', -1, 1) * value AS value
        FROM {o_title_allocations}
        WHERE installment_type = 'Despesa' AND status NOT IN ('Baixado', 'Renegociados')
              AND account_plan IN (SELECT account_plan FROM {plan_group})
        UNION ALL
        SELECT 'card', installment_id, company_tax_id, sale_date, cost_centre, account_plan,
               acquirer || ' [' || brand || ']', value
        FROM {o_card_allocations} WHERE line_type = 'Despesa' AND status <> 'Baixados'""",
    "o_expenses": """
        WITH maps AS (
            SELECT (SELECT map_from_entries(list((account_plan, expense_group))) FROM {plan_group}) AS groups,
                   (SELECT map_from_entries(list((cost_centre, department))) FROM {centre_department}) AS departments,
                   (SELECT map_from_entries(list((tax_id_formatted, branch_id))) FROM {o_branch}) AS branches
        )
        SELECT source, installment_id, branches[company_tax_id] AS branch_id, company_tax_id, date, year(date) AS year,
               month(date) AS month_number, groups[account_plan] AS expense_group, account_plan, party, cost_centre,
               departments[cost_centre] AS department, departments[cost_centre] IS NOT NULL AS direct,
               coalesce(value, 0) AS value
        FROM {o_spent_lines}, maps""",
    "o_weights": """
        WITH sums AS (
            SELECT month, branch_id, department, grouping(department) AS whole, sum(total_sales)::DOUBLE AS sales
            FROM {o_measures} GROUP BY GROUPING SETS ((month, branch_id, department), (month, branch_id))
        )
        SELECT part.month, part.branch_id, part.department,
               if(total.sales > 0, round(part.sales / total.sales, 8), 0)::DECIMAL(18,8) AS department_share
        FROM sums part JOIN sums total USING (month, branch_id) WHERE part.whole = 0 AND total.whole = 1""",
    # every expense with the departments that bear it and their parts: its own with all of it, or those of its branch
    "o_allocated": f"""
        WITH bearers AS (
            SELECT month, branch_id, list({{'department': department, 'part': department_share}}) AS shares
            FROM {{o_weights}} GROUP BY month, branch_id
        ), dated AS (
            SELECT *, date - (day(date) - 1)::INT AS month FROM {{o_expenses}}
        ), borne AS (
            SELECT dated.*, unnest(if(direct, [{{'department': department, 'part': 1::DECIMAL(18,8)}}], shares)) AS bearer
            FROM dated LEFT JOIN bearers USING (month, branch_id)
        )
        SELECT month, branch_id, expense_group, account_plan, bearer.department AS department, party,
               if(direct, value, round(value * bearer.part, 4))::DECIMAL(22,4) AS allocated
        FROM borne WHERE month >= {S} AND month <= {A}""",
    "o_expense_mart": """
        SELECT md5(concat_ws('|', CAST(month AS VARCHAR), CAST(branch_id AS VARCHAR), expense_group, account_plan,
                             department, party)) AS id,
               month, year(month) AS year, month(month) AS month_number, branch_id, expense_group, account_plan,
               department, party, sum(allocated) AS allocated
        FROM {o_allocated} GROUP BY month, branch_id, expense_group, account_plan, department, party""",
    "o_expense_pivot": "SELECT month, branch_id, department, "
    + ", ".join(f"sum(allocated) FILTER (WHERE expense_group = '{g}') AS {g.lower()}" for g in _GROUPS)
    + " FROM {o_expense_mart} GROUP BY 1, 2, 3",
    "o_weighted": """
        SELECT i.*, total_sales - cogs AS gross_margin,
               sales_tax_due - CAST(purchase_tax_credit AS DOUBLE) AS net_tax,
               CASE WHEN sum(total_sales) OVER d > 0
                    THEN CAST(total_sales AS DOUBLE) / CAST(sum(total_sales) OVER d AS DOUBLE) ELSE 0 END AS item_share
        FROM {o_measures} i WINDOW d AS (PARTITION BY month, branch_id, department)""",
    "o_items_with_expenses": "SELECT w.*, CAST(gross_margin AS DOUBLE) - net_tax AS margin_after_tax, "
    + ", ".join(f"coalesce(CAST({g.lower()} AS DOUBLE), 0) * item_share AS cost_{g.lower()}" for g in _GROUPS)
    + " FROM {o_weighted} w LEFT JOIN {o_expense_pivot} d ON d.month = w.month AND d.branch_id = w.branch_id"
    + " AND d.department IS NOT DISTINCT FROM w.department",
    # the cascade: after breakage, one cost after the other comes off, in this order
    "o_margin_steps": """
        SELECT *, [cost_ocupacao, cost_pessoas, cost_administrativas, cost_embalagem, cost_manutencao, cost_marketing,
                   cost_interveniencia] AS steps,
               margin_after_tax - CAST(restated_breakage AS DOUBLE) AS margin_after_breakage,
               list_reduce([cost_pessoas, cost_administrativas, cost_embalagem, cost_financeira, cost_interveniencia,
                            cost_manutencao, cost_marketing, cost_ocupacao], lambda a, b: a + b) AS cost_total
        FROM {o_items_with_expenses}""",
    "o_item_margin": f"""
        SELECT strftime(x.month, '%Y-%m') || '-' || x.branch_id || '-' || x.product_code AS id, year(x.month) AS year,
               month(x.month) AS month_number, b.branch_name, x.* EXCLUDE (steps),
               {", ".join(f"coalesce(CAST({m} AS DOUBLE) / nullif(CAST(total_sales AS DOUBLE), 0), 0) AS {m}_pct"
                          for m in ("gross_margin", "margin_after_tax", "margin_after_breakage"))},
               {", ".join(f"list_reduce([margin_after_breakage] || steps[:{k}], lambda a, b: a - b) AS margin_{name}"
                          for k, name in enumerate(_CASCADE, 1))},
               margin_after_breakage - cost_total AS margin_final
        FROM {{o_margin_steps}} x LEFT JOIN {{o_branch}} b USING (branch_id)""",
    # -- served views and reconciliations ----------------------------------------------------------------------
    "o_stock_position": f"""
        SELECT CAST(x.branch_code AS BIGINT) * 1000000000 + x.product_code AS id,
               {_BRANCH_NAME}x.branch_code) AS branch_name, x.product_code, m.full_name AS product, p.package,
               g.group_name, c.section_name, x.quantity, x.average_cost, x.price, x.abc_class, x.last_sale,
               x.last_purchase
        FROM {{current_stock}} x {_CHAIN}""",
    "o_receipt_payments": f"""
        SELECT x.payment_id AS id, CAST(r.issued_at AS DATE) AS date, {_BRANCH_NAME}r.branch_code) AS branch_name,
               r.terminal, x.receipt_id, x.form_code, f.form_name, x.amount, x.change, x.installments
        FROM {{till_payment}} x JOIN {{till_receipt}} r ON r.receipt_id = x.receipt_id
             LEFT JOIN {{payment_form}} f ON f.form_code = x.form_code
        WHERE r.cancelled = 0""",
    "o_sales_item_current": f"""
        SELECT x.item_id AS id, CAST(r.issued_at AS DATE) AS date, strftime(r.issued_at, '%H:%M:%S') AS time,
               {_BRANCH_NAME}r.branch_code) AS branch_name, r.terminal, x.receipt_id, x.sequence AS item,
               x.product_code, m.full_name AS product, p.package, g.group_name, c.section_name, x.quantity,
               x.unit_price, x.item_discount + x.payment_discount AS discount,
               x.item_surcharge + x.payment_surcharge AS surcharge, x.total,
               x.total - (x.item_discount + x.payment_discount) + (x.item_surcharge + x.payment_surcharge) AS net
        FROM {{receipt_item}} x JOIN {{receipt}} r ON r.receipt_id = x.receipt_id {_CHAIN}
        WHERE r.cancelled = 0 AND x.cancelled = '0'""",
    "o_sales_item_legacy": """
        SELECT i.item_id AS id, r.date, i.time, b.branch_name, r.terminal, r.receipt_number, i.item, g.goods_code,
               g.description AS goods, u.symbol AS unit, c.class_code, c.class_name, i.quantity, i.unit_price,
               i.discount, i.surcharge, i.total, r.receipt_id, g.goods_id
        FROM {legacy_item} i JOIN {legacy_receipt} r ON r.receipt_id = i.receipt_id
             JOIN {legacy_branch} b ON b.branch_key = r.branch_key JOIN {legacy_goods} g ON g.goods_id = i.goods_id
             LEFT JOIN {legacy_unit} u ON u.unit_id = g.unit_id LEFT JOIN {legacy_class} c ON c.class_id = i.class_id
        WHERE NOT r.receipt_reversed AND NOT i.item_reversed""",
    # titles a cent less, as much and a cent more, of each slip the least by days and id
    "o_tolerance": """
        WITH nearest AS (
            SELECT slip_number, min({'days': abs(due_date - due_at)::INT, 'id': installment_id, 'due': due_date,
                                     'status': status}) AS title
            FROM (SELECT slip_number, due_at, value + unnest([-0.01, 0, 0.01])::DECIMAL(4,2) AS value FROM {slip})
                 JOIN (FROM {o_titles} WHERE type = 'Receita' AND length(coalesce(number, '')) = 0) USING (value)
            WHERE due_date >= due_at - 60 AND due_date <= due_at + 60 GROUP BY slip_number
        )
        SELECT slip_number, title.id AS title_installment, title.due AS title_due_date, title.status AS title_status,
               title.days AS days_apart
        FROM nearest""",
    "o_tolerance_wide": """
        SELECT slip_number, t.id AS title_installment, t.due AS title_due_date, t.status AS title_status, t.days AS days_apart
        FROM (
            SELECT slip_number, min({'days': abs(due_date - due_at)::INT, 'id': installment_id, 'due': due_date,
                                     'status': status}) AS t
            FROM {slip} s JOIN (FROM {o_titles} WHERE type = 'Receita' AND length(coalesce(number, '')) = 0) b
                 ON b.value >= s.value - 50 AND b.value <= s.value + 50 AND due_date >= due_at - 60 AND due_date <= due_at + 60
            GROUP BY slip_number)""",
    # the title of each number, and then the first rule that holds
    "o_slips": f"""
        WITH numbered AS (
            SELECT number, arg_min({{'customer': party_name, 'status': status, 'settled': settled_date, 'value': value}},
                       {{'live': coalesce(cancelled::INT, 2), 'age': coalesce(-epoch_us(seen_at::TIMESTAMP), -9e18::BIGINT),
                         'id': installment_id}}) AS title
            FROM {{o_titles}} WHERE type = 'Receita' GROUP BY number
        ), faced AS (
            SELECT trim(slip_number) AS id, bank_number, issued_at::DATE AS issue_date, due_at AS due_date, s.value,
                   cancelled_at IS NOT NULL AS cancelled, title, title IS NOT NULL AS numbered,
                   title IS NOT NULL AND title.settled IS NULL AS open,
                   slip_number IN (SELECT slip_number FROM {{o_tolerance}}) AS near
            FROM {{slip}} s LEFT JOIN numbered ON number = trim(slip_number)
        ), ruled AS (
            SELECT *, [
                {{'says': 'test slip', 'holds': value < 2000}},
                {{'says': 'cancelled in ERP, open in finance', 'holds': cancelled AND open}},
                {{'says': 'ok', 'holds': cancelled}},
                {{'says': 'in finance without the slip number', 'holds': NOT numbered AND near}},
                {{'says': 'no title in finance', 'holds': NOT numbered AND due_date >= {A} - 180}},
                {{'says': 'outside the window read from finance', 'holds': NOT numbered}},
                {{'says': 'value differs', 'holds': title.value NOT BETWEEN value - 0.01 AND value + 0.01}},
                {{'says': 'overdue and open in finance', 'holds': open AND due_date < {A}}},
                {{'says': 'ok', 'holds': true}}] AS rules
            FROM faced
        )
        SELECT * EXCLUDE (title, rules), title.customer AS customer, title.status AS title_status,
               title.settled AS title_settled, title.value AS title_value, list_filter(rules, lambda r: r.holds)[1].says AS outcome
        FROM ruled""",
    "o_title": """
        WITH documents AS (
            SELECT t.*, json_transform(payload, '{"DadosDoTitulo": {"TituloId": "VARCHAR", "NumeroDoTitulo": "VARCHAR",
                                                   "Emissao": "VARCHAR", "Valor": "DECIMAL(18,2)"}}').DadosDoTitulo AS d
            FROM {o_titles} t WHERE type = 'Despesa' AND cancelled IS DISTINCT FROM true
        ), goods AS (
            SELECT DISTINCT installment_id FROM {o_title_lines}
            WHERE contains(lower(line->>'$.PlanoDeContas'), 'compra de mercadorias')
        )
        SELECT d.TituloId AS title_id, max(party_document) AS supplier_document,
               max(coalesce(d.NumeroDoTitulo, number)) AS number, max(party_name) AS supplier, max(company) AS company,
               max(company_tax_id) AS company_tax_id, max(d.Emissao)[:10]::DATE AS issue_date, max(d.Valor) AS value,
               count(*) = count(settled_date) AS paid, min(if(settled_date IS NULL, due_date, NULL)) AS next_due,
               bool_or(g.installment_id IS NOT NULL) AS merchandise
        FROM documents t LEFT JOIN goods g USING (installment_id) GROUP BY d.TituloId""",
    "o_title_rollup": f"""
        WITH posting AS (
            FROM {{branch}} SEMI JOIN (FROM {{purchase_header}} WHERE entered_at >= {A} - 30) USING (branch_code)
        ), booked AS (
            SELECT *, {_digits("supplier_document")} AS supplier_digits, {_digits("company_tax_id")} AS tax_id,
                   ltrim({_digits("number")}, '0') AS invoice
            FROM {{o_title}}
        )
        SELECT supplier_digits, invoice, max(supplier) AS supplier, max(company) AS company,
               min(issue_date) AS issue_date, sum(value) AS value, count(*) AS titles, bool_and(paid) AS paid,
               min(next_due) AS next_due, bool_or(merchandise) AS merchandise
        FROM booked SEMI JOIN posting USING (tax_id) WHERE invoice > '' GROUP BY supplier_digits, invoice""",
    # what either system says of a supplier's invoice, stacked and grouped once; then the first rule that holds
    "o_invoices": f"""
        WITH said AS (
            SELECT {_digits("supplier_code")} AS supplier_document, ltrim(document, '0') AS invoice, issued_at AS booked_on,
                   entered_at AS entry_date, total AS erp_value, true AS in_erp
            FROM {{purchase_header}}
            WHERE entered_at >= {A} - 120 AND cancelled_at IS NULL AND bonus_flag IS DISTINCT FROM '1'
            UNION ALL BY NAME
            SELECT * RENAME (supplier_digits AS supplier_document, value AS finance_value), true AS in_finance
            FROM {{o_title_rollup}}
        ), met AS (
            SELECT supplier_document, invoice, coalesce(bool_or(in_erp), false) AS in_erp,
                   coalesce(bool_or(in_finance), false) AS in_finance, min(booked_on) AS booked_on,
                   min(issue_date) AS titled_on, min(entry_date) AS entry_date, sum(erp_value) AS erp_value,
                   max(finance_value) AS finance_value, max(supplier) AS titled, max(company) AS company,
                   max(titles) AS titles, bool_and(paid) AS paid, min(next_due) AS next_due, bool_or(merchandise) AS goods
            FROM said GROUP BY supplier_document, invoice
        ), named AS (
            SELECT {_digits("party_document")} AS supplier_document,
                   arg_min({{'name': party_name}}, {{'age': coalesce(-epoch_us(seen_at::TIMESTAMP), -9e18::BIGINT),
                                                     'id': installment_id}}).name AS known
            FROM {{o_titles}} WHERE type = 'Despesa' AND party_document IS NOT NULL GROUP BY ALL
        ), ruled AS (
            SELECT *, abs(erp_value - finance_value) > 1 AS apart, [
                {{'says': 'recent, waiting for ERP', 'holds': NOT in_erp AND titled_on > {A} - 3}},
                {{'says': 'only in finance', 'holds': NOT in_erp}},
                {{'says': 'recent, waiting for finance', 'holds': NOT in_finance AND entry_date > {A} - 3}},
                {{'says': 'only in ERP', 'holds': NOT in_finance}},
                {{'says': 'duplicate title in finance', 'holds': titles > 1 AND abs(titles * erp_value - finance_value) <= 1}},
                {{'says': 'value differs', 'holds': apart}},
                {{'says': 'ok', 'holds': true}}] AS rules
            FROM met NATURAL LEFT JOIN named
        )
        SELECT supplier_document || '-' || invoice AS id, coalesce(titled, known) AS supplier, supplier_document, invoice,
               coalesce(booked_on, titled_on) AS issue_date, entry_date, erp_value, finance_value, company, titles, paid,
               next_due, list_filter(rules, lambda r: r.holds)[1].says AS outcome
        FROM ruled WHERE in_erp OR (goods AND titled_on >= {A} - 120)""",
    "o_card_facts": f"""
        SELECT CAST(r.issued_at AS DATE) AS date, b.tax_id AS company, b.trade_name AS store, 'till' AS side,
               CASE WHEN form_code = 90 THEN 'transfer' WHEN form_code BETWEEN 20 AND 79 THEN 'card' END AS way,
               amount - coalesce(change, 0) AS amount, NULL AS fee, NULL AS card_id, NULL AS open
        FROM {{till_payment}} JOIN {{till_receipt}} r USING (receipt_id) LEFT JOIN {{branch}} b USING (branch_code)
        WHERE r.cancelled = 0
        UNION ALL
        SELECT sale_date, {_digits("company_tax_id")}, NULL, 'acquirer',
               CASE WHEN contains(lower(modality), 'pix') THEN 'transfer' WHEN modality IS NOT NULL THEN 'card' END,
               gross_value, fee, card_id, reconciled IS DISTINCT FROM true
        FROM {{o_cards}} WHERE NOT cancelled AND coalesce(payload->>'$.Tipo', 'Receita') = 'Receita'""",
    "o_card_sums": f"""
        SELECT date, company, max(store) AS store, count(*) FILTER (side = 'acquirer') AS reported,
               coalesce(sum(amount) FILTER (side = 'till' AND way = 'card'), 0) AS erp_card,
               coalesce(sum(amount) FILTER (side = 'till' AND way = 'transfer'), 0) AS erp_transfer,
               coalesce(sum(amount) FILTER (side = 'acquirer' AND way = 'card'), 0) AS finance_card,
               coalesce(sum(amount) FILTER (side = 'acquirer' AND way = 'transfer'), 0) AS finance_transfer,
               sum(fee) AS fees, nullif(count(DISTINCT card_id), 0) AS card_sales, count(*) FILTER (open) AS unreconciled
        FROM {{o_card_facts}} WHERE date >= {K} - 45 GROUP BY date, company""",
    "o_card_days": f"""
        SELECT date || '-' || company AS id, date, coalesce(store, company) AS store, erp_card, finance_card,
               finance_card - erp_card AS card_difference, erp_transfer, finance_transfer, fees,
               if(reported > 0, coalesce(card_sales, 0), NULL) AS card_sales,
               if(reported > 0, unreconciled, NULL) AS unreconciled,
               CASE WHEN date >= {K} - 1 THEN 'waiting for acquirer'
                    WHEN reported = 0 AND erp_card > 0 THEN 'no acquirer file'
                    ELSE CASE WHEN abs(finance_card - erp_card) <= 1 THEN 'ok'
                              ELSE 'finance ' || if(finance_card < erp_card, 'below', 'above') || ' ERP' END END AS outcome
        FROM {{o_card_sums}}""",
    "o_latest_order": """
        SELECT c.c_custkey AS customer, l.o_orderkey AS title, CAST(l.o_orderdate AS DATE) AS ordered_on
        FROM {customer} c JOIN LATERAL (SELECT o_orderkey, o_orderdate FROM {orders} o WHERE o.o_custkey = c.c_custkey
             ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) l ON true""",
    # -- approval queue ----------------------------------------------------------------------------------------
    "o_pending_invoices": """
        SELECT supplier_document, invoice, supplier, issue_date, erp_value AS value, outcome FROM {o_invoices}
        WHERE outcome LIKE 'only in ERP%' AND supplier_document NOT IN (SELECT tax_id FROM {branch})""",
    "o_parts": f"""
        SELECT i.supplier_document, i.invoice, row_number() OVER (PARTITION BY i.supplier_document, i.invoice
                   ORDER BY x.due_at, x.number) AS n, x.due_at AS due, x.value,
               nullif(trim(coalesce(x.payment_line, x.barcode, '')), '') AS barcode
        FROM {{o_pending_invoices}} i JOIN {{payable}} x
             ON {_digits("x.supplier_code")} = i.supplier_document AND ltrim(x.document, '0') = i.invoice
        WHERE x.cancelled_at IS NULL""",
    "o_installments": """
        SELECT * FROM {o_parts}
        UNION ALL
        SELECT supplier_document, invoice, 1, issue_date + 30, value, NULL FROM {o_pending_invoices} i
        WHERE NOT EXISTS (SELECT 1 FROM {o_parts} p WHERE p.supplier_document = i.supplier_document
                          AND p.invoice = i.invoice)""",
    "o_history": f"""
        SELECT supplier_document, account_plan, cost_centre, uses
        FROM (SELECT *, row_number() OVER (PARTITION BY supplier_document
                         ORDER BY uses DESC, account_plan NULLS LAST, cost_centre NULLS LAST) AS place
              FROM (SELECT {_digits("party_document")} AS supplier_document, line->>'$.PlanoDeContas' AS account_plan,
                           line->>'$.CentroDeCusto' AS cost_centre, count(*) AS uses
                    FROM {{o_title_lines}} WHERE type = 'Despesa' GROUP BY 1, 2, 3) y) x
        WHERE place = 1""",
    "o_purchase_queue": f"""
        SELECT 'pagar:' || i.supplier_document || ':' || i.invoice AS queue_key, 'purchase without title' AS origin,
               i.outcome AS reason, 'pagar' AS kind, '{ov.COMPANY_TAX_ID}' AS company_tax_id, i.supplier AS party_name,
               i.supplier_document AS party_document, i.invoice AS title_number, 'nota fiscal' AS document_type,
               i.issue_date, i.value, p.parts, p.parts_total, p.last_due, p.part_list, '{ov.BANK_ACCOUNT}' AS bank_account,
               'boleto' AS payment_means, h.account_plan, h.cost_centre, strftime(i.issue_date, '%m-%Y') AS competence,
               'Purchase invoice ' || i.invoice || ' without a title in finance' AS note
        FROM {{o_pending_invoices}} i
             JOIN (SELECT supplier_document, invoice, count(*) AS parts, sum(value) AS parts_total, max(due) AS last_due,
                          list({{'n': n, 'due': CAST(due AS DATE), 'value': CAST(value AS DECIMAL(18,2)), 'code': barcode}}
                               ORDER BY n) AS part_list
                   FROM {{o_installments}} GROUP BY 1, 2) p USING (supplier_document, invoice)
             LEFT JOIN {{o_history}} h ON h.supplier_document = i.supplier_document""",
    "o_slip_queue": f"""
        SELECT 'receber:boleto:' || b.id AS queue_key, 'slip without title' AS origin, b.outcome AS reason,
               'receber' AS kind, '{ov.COMPANY_TAX_ID}' AS company_tax_id,
               CASE WHEN trim(coalesce(c.trade_name, '')) = '' THEN 'Cliente ' || d.customer_number
                    ELSE trim(c.trade_name) END AS party_name,
               nullif({_digits("coalesce(c.customer_code, '')")}, '') AS party_document, b.id AS title_number,
               'boleto' AS document_type, b.issue_date, b.value, 1 AS parts, b.value AS parts_total,
               b.due_date AS last_due,
               [{{'n': 1, 'due': b.due_date, 'value': CAST(b.value AS DECIMAL(18,2)), 'code': NULL}}] AS part_list,
               '{ov.BANK_ACCOUNT}' AS bank_account, 'boleto' AS payment_means,
               'Vendas de Mercadorias' AS account_plan, '{ov.COST_CENTRE}' AS cost_centre,
               strftime(b.issue_date, '%m-%Y') AS competence,
               'Slip ' || b.id || ' (bank number ' || b.bank_number || ') without a title in finance' AS note
        FROM {{o_slips}} b JOIN {{slip}} d ON trim(d.slip_number) = b.id
             LEFT JOIN {{customer_register}} c ON c.customer_number = d.customer_number
        WHERE b.outcome = 'no title in finance' AND b.issue_date <= {A} - 2""",
    "o_queue": "SELECT * FROM {o_purchase_queue} UNION ALL SELECT * FROM {o_slip_queue}",
    "o_reviewed": f"""
        SELECT * REPLACE (CASE WHEN n % 9 <> 0 THEN account_plan END AS account_plan,
                          CASE WHEN n % 8 = 0 THEN 'pix' ELSE payment_means END AS payment_means,
                          CASE WHEN n % 7 = 0 THEN 'recibo' ELSE document_type END AS document_type,
                          CAST(CASE WHEN n % 17 = 0 THEN NULL WHEN n % 5 = 0 THEN value + 1 ELSE value END AS DECIMAL(18,2))
                              AS value,
                          CASE WHEN n % 6 = 0 THEN 0 ELSE parts END AS parts),
               n % 11 = 0 AS no_amount, n % 13 = 0 AND n % 11 <> 0 AS no_date,
               CASE WHEN n % 10 < 5 THEN 'approved' WHEN n % 10 < 8 THEN 'sent' ELSE 'pending' END AS status,
               CASE WHEN n % 10 BETWEEN 5 AND 7 THEN {A} - CAST(n % 4 AS INT) END AS sent_at
        FROM (SELECT *, CAST(title_number AS BIGINT) AS n FROM {{o_queue}}) x""",
    "o_payload": """
        SELECT *, CASE WHEN account_plan IS NULL THEN 'missing fields: account_plan'
                    WHEN payment_means <> 'boleto' THEN 'payment means not accepted: ' || payment_means
                    WHEN document_type NOT IN ('nota fiscal', 'boleto')
                         THEN 'document type not accepted: ' || document_type
                    WHEN parts = 0 THEN 'no installments'
                    WHEN value IS NULL THEN 'no title value'
                    WHEN no_amount THEN 'an installment has no value'
                    WHEN no_date THEN 'an installment has no due date'
                    WHEN abs(parts_total - value) > 0.01
                         THEN 'installments sum to ' || CAST(parts_total AS DECIMAL(18,2)) || ', title value is ' || value
                    END AS problem,
               CASE WHEN length(party_document) IN (11, 14) THEN party_document ELSE coalesce(party_name, '') END
                   AS party,
               CASE WHEN length(party_document) IN (11, 14) THEN party_name || '/' || party_document END AS details
        FROM {o_reviewed}""",
    "o_finance_after": """
        SELECT type, number, party_document, cancelled FROM {o_titles}
        UNION ALL
        SELECT CASE kind WHEN 'pagar' THEN 'Despesa' ELSE 'Receita' END, '00' || title_number || 'X',
               party_document || '-', CAST(title_number AS BIGINT) % 3 = 0
        FROM {o_queue} WHERE CAST(title_number AS BIGINT) % 4 < 2""",
    "o_present": f"""
        SELECT q.*, EXISTS (SELECT 1 FROM (SELECT type, ltrim({_digits("coalesce(number, '')")}, '0') AS number,
                                                  {_digits("coalesce(party_document, '')")} AS document
                                           FROM {{o_finance_after}} WHERE NOT coalesce(cancelled, false)) t
                            WHERE t.type = CASE q.kind WHEN 'pagar' THEN 'Despesa' ELSE 'Receita' END
                              AND t.number = ltrim(q.title_number, '0')
                              AND (coalesce(q.party_document, '') = '' OR t.document = q.party_document)) AS present
        FROM {{o_payload}} q""",
    "o_dispatch": """
        SELECT queue_key, CASE WHEN status <> 'approved' THEN status WHEN present THEN 'confirmed'
                    WHEN problem IS NOT NULL THEN 'error' ELSE 'ready' END AS status,
               CASE WHEN status = 'approved' THEN CASE WHEN present THEN 'already in finance, not sent' ELSE problem END
                    END AS error,
               status = 'approved' AND NOT present AND problem IS NULL AS has_payload
        FROM {o_present}""",
    "o_confirm": f"""
        SELECT queue_key, CASE WHEN status <> 'sent' THEN status WHEN present THEN 'confirmed'
                    WHEN sent_at < {A} - 2 THEN 'error' ELSE status END AS status,
               CASE WHEN status = 'sent' AND NOT present AND sent_at < {A} - 2 THEN 'not in finance after 2 days' END
                   AS error,
               CASE WHEN status = 'sent' THEN CASE WHEN present THEN 'confirmed' ELSE 'no sign' END END AS result
        FROM {{o_present}}""",
    # -- landing and synchronisation ---------------------------------------------------------------------------
    "o_load_audit": """
        SELECT table_name, max(ended_at) FILTER (WHERE error IS NULL) AS latest_good,
               sum(rows) FILTER (WHERE error IS NULL) AS rows, count(*) FILTER (WHERE error IS NOT NULL) AS failures
        FROM {load} GROUP BY 1""",
    "o_order_spans": """
        SELECT o_custkey AS customer, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last
        FROM {orders} GROUP BY 1""",
    "o_windows": """
        SELECT customer, CAST(d AS DATE) AS window_start, least(CAST(d AS DATE) + 29, last) AS window_end
        FROM {o_order_spans}, generate_series(first, last, INTERVAL 30 DAY) t(d)""",
    "o_incomplete_pages": """
        SELECT page, count(*) FILTER (WHERE NOT lost) AS landed, count(*) AS announced FROM {landed_event}
        GROUP BY 1 HAVING count(*) FILTER (WHERE lost) > 0""",
    "o_incomplete_ids": """
        SELECT event_type, count(DISTINCT event_id) FILTER (WHERE NOT lost) AS distinct_ids, count(*) AS announced
        FROM {landed_event} GROUP BY 1 HAVING count(*) FILTER (WHERE lost) > 0""",
    "o_window_sync": f"""
        SELECT title, customer, value, due, seen_at FROM {{old_title}} o
        WHERE NOT (due BETWEEN {A} - 180 AND {A} + 120)
              AND title NOT IN (SELECT title FROM {{title_batch}} WHERE title IS NOT NULL)
        UNION ALL
        SELECT title, customer, value, due, {A} FROM {{title_batch}} b
        WHERE title IS NOT NULL AND delivery = (SELECT max(delivery) FROM {{title_batch}} c WHERE c.title = b.title)""",
    "o_refresh": """
        SELECT event_id AS id FROM {events} e
        WHERE event_type IN ('view', 'click')
              OR NOT EXISTS (SELECT 1 FROM {detail_response} d WHERE d.parameters->>'$.id' = CAST(e.event_id AS VARCHAR)
                             AND d.payload->>'$._http_error' IS NULL)""",
    "o_insert_absent": """
        SELECT customer, priority, title, true AS old FROM {queued}
        UNION ALL
        SELECT customer, priority, title, false FROM
            (SELECT DISTINCT ON (customer, priority) * FROM {proposed} WHERE priority IS NOT NULL
             ORDER BY customer, priority, title) p
        WHERE NOT EXISTS (SELECT 1 FROM {queued} q WHERE q.customer = p.customer AND q.priority = p.priority)
        UNION ALL
        SELECT customer, priority, title, false FROM {proposed} WHERE priority IS NULL""",
    "o_insert_absent_nulls": """
        SELECT customer, priority, title, true AS old FROM {queued}
        UNION ALL
        SELECT customer, priority, title, false FROM
            (SELECT DISTINCT ON (customer, priority) * FROM {proposed} ORDER BY customer, priority, title) p
        WHERE NOT EXISTS (SELECT 1 FROM {queued} q WHERE q.customer = p.customer
                          AND q.priority IS NOT DISTINCT FROM p.priority)""",
    "o_dim_sync": f"""
        SELECT coalesce(d.code, s.code) AS code,
               CASE WHEN s.code IS NULL THEN d.name ELSE trim(s.name) END AS name,
               CASE WHEN s.code IS NULL THEN d.segment ELSE trim(s.segment) END AS segment,
               CASE WHEN d.code IS NULL OR (s.code IS NOT NULL AND (d.name IS DISTINCT FROM trim(s.name)
                         OR d.segment IS DISTINCT FROM trim(s.segment))) THEN {A} ELSE d.touched_at END AS touched_at
        FROM {{old_customer}} d FULL JOIN (SELECT * FROM {{new_customer}} WHERE trim(coalesce(name, '')) <> '') s
             ON s.code = d.code""",
    # -- access ------------------------------------------------------------------------------------------------
    "o_served": """
        SELECT o_orderkey AS id, o_custkey AS customer, o_orderpriority AS priority, o_orderstatus AS status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS value, o_orderdate AS ordered_at,
               CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) + 20 END AS settled
        FROM {orders}""",
    "o_dept_sales": """
        SELECT md5(p_type || p_brand) AS id, p_type AS department, p_brand AS brand, count(*) AS parts FROM {part}
        GROUP BY 2, 3""",
}


def _check_rows(*checks: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, ({sql}) AS violations" for name, severity, sql in checks
    )


def _repeated(table: str, *names: str) -> str:
    key = ", ".join(names)
    kept = f" WHERE {key} IS NOT NULL" if len(names) == 1 else ""
    return f"SELECT count(*) FROM (SELECT 1 FROM {table}{kept} GROUP BY {key} HAVING count(*) > 1) c"


# Reads of the finance system applied one after the other: kind, read, and the scope the read covered.
_READS = [
    ("income", "due", f"due BETWEEN {A} - 180 AND {A} + 120"),
    ("expense", "due", f"due BETWEEN {A} - 180 AND {A} + 120"),
    ("expense", "issue", f"issued BETWEEN {A} - 120 AND {A}"),
    ("card", "sale", f"issued BETWEEN {A} - 45 AND {A}"),
]
STEPS |= {"o_sync_before": "SELECT id, kind, issued, due, value, seen_at FROM {finance_state}"}
_STEP_NAMES = ["before", "first", "second", "third", "last"]
for _was, _now, (_kind, _read, _scope) in zip(_STEP_NAMES, _STEP_NAMES[1:], _READS, strict=False):
    STEPS[f"o_read_{_now}"] = f"""
        SELECT id, kind, issued, due, value, {A} AS seen_at FROM {{finance_read}}
        WHERE read = '{_read}' AND kind = '{_kind}' AND id IS NOT NULL
        QUALIFY delivery = max(delivery) OVER (PARTITION BY id)"""
    STEPS[f"o_sync_{_now}"] = f"""
        SELECT * FROM {{o_sync_{_was}}} o ANTI JOIN {{o_read_{_now}}} n USING (id) WHERE NOT (kind = '{_kind}' AND {_scope})
        UNION ALL SELECT * FROM {{o_read_{_now}}}"""
    STEPS[f"o_count_{_now}"] = f"""
        SELECT {_STEP_NAMES.index(_now)} AS step, inserted, replaced, before + inserted - after AS deleted
        FROM (SELECT count(*) AS inserted FROM {{o_read_{_now}}} ANTI JOIN {{o_sync_{_was}}} USING (id)),
             (SELECT count(*) AS replaced FROM {{o_read_{_now}}} SEMI JOIN {{o_sync_{_was}}} USING (id)),
             (SELECT count(*) AS before FROM {{o_sync_{_was}}}), (SELECT count(*) AS after FROM {{o_sync_{_now}}})"""
STEPS |= {
    "o_sync_counts": " UNION ALL ".join(f"SELECT * FROM {{o_count_{name}}}" for name in _STEP_NAMES[1:]),
    "o_touched": f"""
        SELECT DISTINCT strftime(issued, '%Y-%m') AS month FROM (
            SELECT issued FROM {{o_read_third}}
            UNION ALL SELECT issued FROM {{finance_state}}
            WHERE id IN (SELECT id FROM {{o_read_third}}) OR (kind = 'expense' AND {_READS[2][2]})) x""",
    "o_register": f"""
        SELECT c_custkey AS code, c_name AS name,
               if(o.code IS NOT NULL AND o.name = c_name, o.touched_at, {A}) AS touched_at
        FROM {{customer}} LEFT JOIN {{old_customer}} o ON o.code = c_custkey""",
}

# Steps that belong to one query each.
STEPS |= {
    "o_payload_columns": """
        SELECT queue_key, NULL AS problem, company_tax_id, kind, title_number, party, details,
               CAST(issue_date AS VARCHAR) AS issued, value, document_type, bank_account, payment_means,
               left(note, 500) AS history,
               list_aggregate(list_transform(part_list, lambda p: p.n || '|' || p.due || '|' || p.value || '|' || coalesce(p.code, '')),
                              'string_agg', ';') AS parts,
               list_aggregate(list_transform(part_list, lambda p: competence || '|' || account_plan || '|' || p.n || '|'
                                             || p.value || '|' || coalesce(cost_centre, '')), 'string_agg', ';') AS lines
        FROM {o_payload} WHERE problem IS NULL
        UNION ALL BY NAME SELECT queue_key, problem FROM {o_payload} WHERE problem IS NOT NULL""",
    "o_confirm_counts": "SELECT result, count(*) AS rows FROM {o_confirm} WHERE result IS NOT NULL GROUP BY 1",
    # what was queued before stays as it was, under whatever status; the rest is added once, as pending
    "o_enqueued": """
        WITH before AS (
            SELECT *, if(CAST(title_number AS BIGINT) % 4 = 0, 'discarded', 'pending') AS status
            FROM {o_purchase_queue} WHERE CAST(title_number AS BIGINT) % 2 = 0
        ), added AS (
            SELECT DISTINCT ON (queue_key) *, 'pending' AS status FROM {o_purchase_queue} q
            WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.queue_key = q.queue_key) ORDER BY queue_key, title_number
        )
        FROM before UNION ALL FROM added""",
    "o_filter_compare": """
        SELECT * FROM {o_served}
        WHERE value >= 100000 AND value < 400000.5 AND (settled IS NULL OR status = 'O') AND customer > 10""",
    "o_filter_text": """
        SELECT * FROM {o_served}
        WHERE priority LIKE '%H_G%' OR priority LIKE '%LOW' OR priority LIKE '1-U%'""",
    "o_filter_date": """
        SELECT * FROM {o_served}
        WHERE ordered_at >= TIMESTAMP '1998-03-01' AND month(ordered_at) <= 6 AND day(ordered_at) > 9
              AND CAST(ordered_at AS DATE) <> DATE '2000-05-20' AND year(ordered_at) < 2001""",
    "o_page_by_offset": """
        SELECT * FROM {o_served} ORDER BY settled DESC NULLS FIRST, value ASC NULLS LAST, id LIMIT 150 OFFSET 70""",
    "o_page_by_offset_deep": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (ORDER BY settled DESC NULLS FIRST, value ASC NULLS LAST, id) - 1 AS place FROM {o_served})
        WHERE place - (SELECT count(*) // 2 FROM {orders}) BETWEEN 0 AND 149""",
    "o_page_by_key": "SELECT * FROM {o_dept_sales} ORDER BY id LIMIT 20 OFFSET 20",
    "o_preview": """
        SELECT *, (SELECT count(*) > 200 FROM {o_served} WHERE status = 'P') AS truncated
        FROM {o_served} WHERE status = 'P' ORDER BY id LIMIT 200""",
    "o_wire": """
        SELECT id, customer, priority, status, value, strftime(ordered_at, '%Y-%m-%dT%H:%M:%SZ') AS ordered_at,
               strftime(settled, '%Y-%m-%d') AS settled, md5(priority) AS digest
        FROM {o_served}""",
    "o_dq_unique": _check_rows(
        ("unique:o_orderkey", "error", _repeated("{orders}", "o_orderkey")),
        ("unique:o_custkey", "error", _repeated("{orders}", "o_custkey")),
        ("unique:company_document", "warn", _repeated("{receipt}", "company_document")),
    ),
    "o_dq_not_null": _check_rows(
        ("not_null:o_orderkey", "error", "SELECT count(*) FROM {orders} WHERE o_orderkey IS NULL"),
        ("not_null:unit_cost", "warn", "SELECT count(*) FROM {o_butcher} WHERE unit_cost IS NULL"),
    ),
    "o_dq_combo": _check_rows(
        ("unique_combo:date,branch_id,product_code", "error", _repeated("{o_daily}", "date", "branch_id", "product_code")),
        ("unique_combo:l_orderkey,l_linenumber", "error", _repeated("{lineitem}", "l_orderkey", "l_linenumber")),
        ("unique_combo:month,branch_id,product_code", "error", _repeated("{o_opening}", "month", "branch_id", "product_code")),
    ),
    "o_dq_accepted": _check_rows(
        ("accepted_values:origin", "error",
         "SELECT count(DISTINCT origin) FROM {o_opening} WHERE origin NOT IN ('inventory', 'position')"),
        ("accepted_values:o_orderpriority", "warn",
         "SELECT count(DISTINCT o_orderpriority) FROM {orders} WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"),
    ),
    "o_dq_in_one_pass": _check_rows(
        ("unique_combo:l_orderkey,l_linenumber", "error", _repeated("{lineitem}", "l_orderkey", "l_linenumber")),
        ("unique:l_orderkey", "warn", _repeated("{lineitem}", "l_orderkey")),
        ("not_null:l_partkey", "error", "SELECT count(*) FROM {lineitem} WHERE l_partkey IS NULL"),
        ("accepted_values:l_returnflag", "error",
         "SELECT count(DISTINCT l_returnflag) FROM {lineitem} WHERE l_returnflag NOT IN ('A', 'N')"),
        ("unique:o_orderkey", "error", _repeated("{orders}", "o_orderkey")),
        ("not_null:settled", "warn", "SELECT count(*) FROM {served_by_dates} WHERE settled IS NULL"),
        ("unique_combo:o_custkey,settled", "warn", _repeated("{served_by_dates}", "o_custkey", "settled")),
        ("accepted_values:o_orderpriority", "warn",
         "SELECT count(DISTINCT o_orderpriority) FROM {orders} WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"),
    ),
    "o_dq_key": _check_rows(
        ("unique:o_orderkey", "error", _repeated("{orders}", "o_orderkey")),
        ("not_null:o_orderkey", "error", "SELECT count(*) FROM {orders} WHERE o_orderkey IS NULL"),
        ("unique:title", "error", _repeated("{title_batch}", "title")),
        ("not_null:title", "error", "SELECT count(*) FROM {title_batch} WHERE title IS NULL"),
    ),
}


def _query(name: str) -> str:
    return STEPS[name] if name in STEPS else OVERLAYS[name]


@cache
def _order(name: str) -> tuple[str, ...]:
    """Steps and overlays ``name`` builds on, dependencies first, itself last."""
    done: dict[str, None] = {}
    for other in needs(_query(name)):
        if other not in TABLES:
            done.update(dict.fromkeys(_order(other)))
    return (*done, name)


def _bare(template: str) -> str:
    for other in needs(template):
        template = template.replace("{" + other + "}", other)
    return template


def oracle(step: str, select: str) -> str:
    """WITH the steps behind ``step``, SELECT ``select`` FROM it."""
    parts = [f"{n} AS MATERIALIZED ({_bare(_query(n)).strip()})" for n in _order(step)]
    return "WITH " + ",\n".join(parts) + f"\nSELECT {select} FROM {step}"
