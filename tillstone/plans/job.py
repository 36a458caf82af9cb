"""The whole platform wired once over a set of source tables.

Every step is a lazy DataFrame, built on first use.  Steps that several later steps read in full are computed once
and written to the shared folder (``settled_*``), which also cuts the lineage there.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.operators import expenses as ex
from tillstone.operators import margin as mg
from tillstone.operators import profit as pf
from tillstone.operators import queue as qu
from tillstone.operators import reconcile as rc
from tillstone.operators import staging as st
from tillstone.operators import stock as sk
from tillstone.plans import overlays as ov
from tillstone.plans.session import dealt, laid_out, parts, settled
from tillstone.sources import finance

REFERENCE_BRANCH = 1  # its cost stands in for a missing one, and it pays its own sales tax
SIMPLES_BRANCH = 2
SIMPLES_COMPANY = "00.000.000/0000-01"
SIMPLES_ACCOUNT = "2-High"
BUTCHER_DEPARTMENT = "LARGE"
TEST_SLIP_LIMIT = 2000


class Job:
    def __init__(self, sources: ov.Sources, start: date = ov.START, as_of: date = ov.AS_OF):
        self.s, self.start, self.as_of = sources, start, as_of

    # -- staging -----------------------------------------------------------------------------------------------

    @cached_property
    def branches(self) -> DataFrame:
        return st.stg_branch(self.s.branch)

    @cached_property
    def sales(self) -> DataFrame:
        s = self.s
        return st.stg_sales_item(s.receipt_item, s.receipt, s.branch, s.consumer_invoice, s.company_invoice)

    @cached_property
    def purchases(self) -> DataFrame:
        s = self.s
        return st.stg_purchase_item(
            s.purchase_line.select(
                "branch_code", "supplier_code", "document", "series", "line_id", "sequence", "product_code", "boxes",
                "units_per_box", "box_price", "discount", "calculated_discount", "icms", "fcp", "pis_credit",
                "cofins_credit", "tax_code", "item_status", "changed_at",
            ),
            s.purchase_header, s.branch, s.supplier_register, s.operation, s.tax_code, s.purchase_order,
        )

    @cached_property
    def daily(self) -> DataFrame:
        return st.stg_daily_stock(self.s.daily_stock_source)

    @cached_property
    def inventory(self) -> DataFrame:
        lines = self.s.inventory_source.select(
            "branch_code", "inventory", "sequence", "product_code", "store_quantity", "deposit_quantity", "cost"
        )
        return st.stg_inventory_item(
            self.s.inventory_header, lines, tie_break=("store_quantity", "deposit_quantity", "cost")
        )

    @cached_property
    def movements(self) -> DataFrame:
        return st.stg_stock_movement(self.s.movement)

    @cached_property
    def prices(self) -> DataFrame:
        return st.stg_price(self.s.current_stock, self.s.product, self.s.branch)

    @cached_property
    def transformations(self) -> DataFrame:
        return st.stg_transformation(self.s.transformation_header, self.s.transformation_line)

    @cached_property
    def butcher_cost(self) -> DataFrame:
        return st.stg_butcher_cost(self.s.butcher_feed)

    @cached_property
    def flattened_titles(self) -> DataFrame:
        return finance.flatten_titles(self.s.title_document, keep=["seen_at"])

    @cached_property
    def flattened_cards(self) -> DataFrame:
        return finance.flatten_cards(self.s.card_document, keep=["seen_at"])

    @cached_property
    def titles(self) -> DataFrame:
        """Kept without the documents they were parsed from: those are of no use to what reads columns, and several times as
        large as the columns."""
        return self.s.kept("titles", lambda: self.flattened_titles.drop("payload"), by="issue_month")

    @cached_property
    def cards(self) -> DataFrame:
        return self.s.kept("cards", lambda: self.flattened_cards.drop("payload"), by="sale_month")

    @cached_property
    def title_allocations(self) -> DataFrame:
        return st.stg_title_allocation(self.titles)

    @cached_property
    def card_allocations(self) -> DataFrame:
        return st.stg_card_allocation(self.cards)

    # -- stock -------------------------------------------------------------------------------------------------

    @cached_property
    def settled_daily(self) -> DataFrame:
        """Read by the validity and by the breakage."""
        return settled(self.daily, "daily")

    @cached_property
    def settled_inventory(self) -> DataFrame:
        """Read by the opening stock and, where the item base is built, by the spans of what is stocked."""
        wanted = [*sk.ITEM, "inventory_id", "reference_date", "processed", "counted", "zeroes_uncounted", "counted_quantity"]
        return settled(self.inventory.select(*wanted), "inventory")

    def at_hand(self, name: str) -> DataFrame:
        """A step as another one has settled it, else as it is: then no more is computed than what is asked of it."""
        return self.__dict__.get(f"settled_{name}") or getattr(self, name)

    @cached_property
    def calendar(self) -> DataFrame:
        return sk.month_calendar(self.s.spark, self.start, self.as_of)

    @cached_property
    def validity(self) -> DataFrame:
        return sk.stock_validity(self.daily)

    @cached_property
    def laid_validity(self) -> DataFrame:
        """Opening (twice), closing and the reference branch (twice) read it as it lies, by product: a product has at most a
        row per branch and day."""
        return laid_out(sk.stock_validity(self.by_product(self.settled_daily)), "validity", "product_code", self.product_parts)

    @cached_property
    def product_parts(self) -> int:
        """So many that the months of a part's positions are grouped in memory."""
        return parts(self.daily)

    def by_product(self, df: DataFrame) -> DataFrame:
        return dealt(df, "product_code", count=self.product_parts)

    @cached_property
    def before_month(self) -> DataFrame:
        return sk.position_before_month(self.validity, self.start, self.as_of)

    @cached_property
    def closing(self) -> DataFrame:
        return sk.closing_stock(self.validity, self.start, self.as_of)

    @cached_property
    def laid_closing(self) -> DataFrame:
        return sk.closing_stock(self.laid_validity, self.start, self.as_of)

    @cached_property
    def first_inventory(self) -> DataFrame:
        return sk.first_inventory_of_month(self.inventory, self.start)

    @cached_property
    def opening(self) -> DataFrame:
        return sk.opening_stock(self.inventory, self.laid_validity, self.start, self.as_of, deal=self.by_product)

    @cached_property
    def opening_sides(self) -> DataFrame:
        return sk.opening_sides(self.settled_inventory, self.laid_validity, self.start, self.as_of, deal=self.by_product)

    @cached_property
    def stocked(self) -> DataFrame:
        return sk.stocked_spans(self.at_hand("inventory"), self.laid_validity, self.start, self.as_of, deal=self.by_product)

    @cached_property
    def reference_cost(self) -> DataFrame:
        return sk.reference_branch_cost(self.laid_validity, REFERENCE_BRANCH, self.start, self.as_of)

    # -- profitability -----------------------------------------------------------------------------------------

    @cached_property
    def catalog(self) -> DataFrame:
        s = self.s
        return rc.product_catalog(
            s.product, s.product_master, s.product_group, s.product_section, s.product_department,
            s.product_subgroup, s.cost_centre, s.unit, s.crosswalk, s.load, s.legacy_product,
        )

    @cached_property
    def products(self) -> DataFrame:
        wanted = [
            "product_code", "department", "section", "group_name", "subgroup_name", "description",
            "full_description", "unit", "active", "origin",
        ]
        return pf.product_reclass(self.catalog.select(*wanted), self.s.reclass_rule, self.s.section_register)

    @cached_property
    def settled_products(self) -> DataFrame:
        """A published table, like the prices below: joins against them are planned on their real sizes."""
        return settled(self.products, "products")

    @cached_property
    def settled_prices(self) -> DataFrame:
        return settled(self.prices, "prices")

    @cached_property
    def monthly_sales(self) -> DataFrame:
        return pf.sales_by_month(self.sales, self.start, ov.INTERCOMPANY)

    @cached_property
    def settled_sales(self) -> DataFrame:
        """Read by the item base and by the tax rate."""
        return settled(self.monthly_sales, "monthly-sales")

    @cached_property
    def monthly_purchases(self) -> DataFrame:
        return pf.purchases_by_month(self.purchases, self.start)

    @cached_property
    def monthly_transformations(self) -> DataFrame:
        return pf.transformations_by_month(self.transformations, self.start)

    @cached_property
    def monthly_breakage(self) -> DataFrame:
        return pf.breakage_by_month(self.at_hand("daily"), self.start)

    # Read by the item base and, where that is built, by the department sales.
    @cached_property
    def settled_monthly_purchases(self) -> DataFrame:
        return settled(self.monthly_purchases, "monthly-purchases")

    @cached_property
    def settled_monthly_transformations(self) -> DataFrame:
        return settled(self.monthly_transformations, "monthly-transformations")

    @cached_property
    def settled_monthly_breakage(self) -> DataFrame:
        return settled(pf.breakage_by_month(self.settled_daily, self.start), "monthly-breakage")

    @cached_property
    def active_keys(self) -> DataFrame:
        facts = [self.monthly_sales, self.monthly_purchases, self.monthly_transformations, self.monthly_breakage]
        return pf.active_keys(facts, self.stocked, self.by_product)

    @cached_property
    def item_facts(self) -> DataFrame:
        flows = [
            self.settled_sales, self.settled_monthly_purchases, self.settled_monthly_transformations, self.settled_monthly_breakage,
        ]
        return pf.item_facts(flows, pf.stock_facts(self.opening_sides, self.laid_closing), self.by_product)

    @cached_property
    def base(self) -> DataFrame:
        return pf.item_base(
            self.settled_products, self.settled_prices, self.butcher_cost, self.reference_cost, self.item_facts,
            BUTCHER_DEPARTMENT,
        )

    @cached_property
    def rates(self) -> DataFrame:
        return pf.simples_rate(
            self.calendar, self.title_allocations, self.settled_sales, SIMPLES_COMPANY, SIMPLES_ACCOUNT, SIMPLES_BRANCH
        )

    @cached_property
    def measures(self) -> DataFrame:
        return pf.item_measures(self.base, self.rates, REFERENCE_BRANCH, SIMPLES_BRANCH)

    @cached_property
    def department_sales(self) -> DataFrame:
        """A few rows that the expense marts and the item shares both need, computed before either: from the monthly
        sales and the keys of what else makes an item, without the item base."""
        stocked = self.stocked  # settles the daily positions, which the breakage reads too
        present = [self.at_hand(f"monthly_{name}") for name in ("purchases", "transformations", "breakage")]
        return settled(
            ex.department_sales_of(self.settled_sales, present, self.settled_products, self.start, self.as_of, stocked),
            "department-sales",
        )

    # -- marts -------------------------------------------------------------------------------------------------

    # Small by nature, but made from large tables, whose size the planner would take for theirs.
    @cached_property
    def settled_plan_group(self) -> DataFrame:
        return settled(self.s.plan_group, "plan-group")

    @cached_property
    def settled_centre_department(self) -> DataFrame:
        return settled(self.s.centre_department, "centre-department")

    @cached_property
    def settled_branches(self) -> DataFrame:
        return settled(self.branches, "branches")

    @cached_property
    def settled_posting(self) -> DataFrame:
        return settled(rc.posting_companies(self.s.purchase_header, self.s.branch, self.as_of), "posting")

    @cached_property
    def expenses(self) -> DataFrame:
        return ex.expenses(
            self.title_allocations, self.card_allocations, self.settled_plan_group, self.settled_centre_department,
            self.settled_branches,
        )

    @cached_property
    def weights(self) -> DataFrame:
        return ex.department_weights(self.department_sales)

    @cached_property
    def allocated_expenses(self) -> DataFrame:
        return ex.allocate_expenses(self.expenses, self.weights, self.start, self.as_of)

    @cached_property
    def dealt_expenses(self) -> DataFrame:
        """The same, dealt for the mart: as booked, before a row becomes one per department."""
        return ex.allocate_expenses(self.expenses, self.weights, self.start, self.as_of, dealt)

    @cached_property
    def expense_mart(self) -> DataFrame:
        return ex.expense_mart(self.dealt_expenses)

    @cached_property
    def expense_pivot(self) -> DataFrame:
        return ex.expense_pivot(self.expense_mart)

    @cached_property
    def settled_pivot(self) -> DataFrame:
        """A row per month, branch and department.  Settled, it can be broadcast instead of shuffling the items."""
        return settled(self.expense_pivot, "expense-pivot")

    @cached_property
    def weighted_items(self) -> DataFrame:
        return mg.item_weight(self.measures, self.department_sales)

    @cached_property
    def items_with_expenses(self) -> DataFrame:
        return mg.allocate_to_items(self.weighted_items, self.settled_pivot)

    @cached_property
    def item_margin(self) -> DataFrame:
        return mg.item_margin(self.items_with_expenses, self.branches)

    # -- reconciliation and queue ------------------------------------------------------------------------------

    @cached_property
    def slips(self) -> DataFrame:
        return rc.slip_reconciliation(self.s.slip, self.titles, self.as_of, test_limit=TEST_SLIP_LIMIT)

    @cached_property
    def title_rollup(self) -> DataFrame:
        return rc.title_rollup(
            self.titles, self.s.purchase_header, self.s.branch, self.as_of, posting=self.settled_posting
        )

    @cached_property
    def invoices(self) -> DataFrame:
        return rc.purchase_reconciliation(
            self.s.purchase_header, self.titles, self.s.branch, self.as_of, posting=self.settled_posting
        )

    @cached_property
    def published_invoices(self) -> DataFrame:
        """The reconciliations are published tables; the queue starts from those."""
        return settled(self.invoices, "invoices", wide=True)

    @cached_property
    def published_slips(self) -> DataFrame:
        return settled(self.slips, "slips")

    @cached_property
    def card_days(self) -> DataFrame:
        return rc.card_reconciliation(
            self.s.till_payment, self.s.till_receipt, self.s.branch, self.cards, ov.CARDS_AS_OF, ov.CARD_FORMS,
            ov.TRANSFER_FORM,
        )

    @cached_property
    def purchase_queue(self) -> DataFrame:
        return qu.queue_from_purchases(
            self.published_invoices, self.s.payable, self.titles, self.s.branch, ov.COMPANY_TAX_ID, ov.BANK_ACCOUNT
        )

    @cached_property
    def slip_queue(self) -> DataFrame:
        return qu.queue_from_slips(
            self.published_slips, self.s.slip, self.s.customer_register, self.as_of, ov.COMPANY_TAX_ID, ov.BANK_ACCOUNT,
            ov.COST_CENTRE,
        )

    @cached_property
    def queued(self) -> DataFrame:
        return settled(self.purchase_queue.unionByName(self.slip_queue), "queue")

    @cached_property
    def reviewed_queue(self) -> DataFrame:
        """Both queues as people left them: some rows edited badly, some approved, some already sent.

        What happens to a row follows from its number, so the SQL check can repeat it.
        """
        rows = self.queued

        def without_first(field: str) -> Column:
            """The installments, the first one lacking a field."""
            parts = F.from_json("installments", qu.INSTALLMENTS)
            cut = F.transform(parts, lambda p, i: p.withField(field, F.when(i > 0, p[field])))
            return F.to_json(cut, {"ignoreNullFields": "false"})

        n = F.regexp_replace("title_number", r"\D", "").try_cast("bigint")
        last = n % 10
        return rows.withColumns(
            {
                "account_plan": F.when(n % 9 != 0, F.col("account_plan")),
                "payment_means": F.when(n % 8 == 0, F.lit("pix")).otherwise(F.col("payment_means")),
                "document_type": F.when(n % 7 == 0, F.lit("recibo")).otherwise(F.col("document_type")),
                "value": F.when(n % 17 != 0, F.when(n % 5 == 0, F.col("value") + 1).otherwise(F.col("value"))).cast("decimal(18,2)"),
                "installments": F.when(n % 6 == 0, F.lit("[]"))
                .when(n % 11 == 0, without_first("valor"))
                .when(n % 13 == 0, without_first("vencimento"))
                .otherwise(F.col("installments")),
                "status": F.when(last < 5, "approved").when(last < 8, "sent").otherwise("pending"),
                "sent_at": F.when((last >= 5) & (last < 8), F.date_sub(F.lit(self.as_of), (n % 4).cast("int"))),
                "error": F.lit(None).cast("string"),
            }
        )

    @cached_property
    def finance_after(self) -> DataFrame:
        """Live and cancelled titles as read after some queue rows were entered in finance by hand."""
        n = F.regexp_replace("title_number", r"\D", "").try_cast("bigint")
        entered = self.queued.where(n % 4 < 2).select(
            F.when(F.col("kind") == qu.PAYABLE, "Despesa").otherwise("Receita").alias("type"),
            F.concat(F.lit("00"), "title_number", F.lit("X")).alias("number"),
            F.concat(F.col("party_document"), F.lit("-")).alias("party_document"),
            (n % 3 == 0).alias("cancelled"),
        )
        return self.titles.select("type", "number", "party_document", "cancelled").unionByName(entered)
