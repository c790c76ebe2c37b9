"""Why a contract was billed as it was: billing tags, exemptions and the tag of the billing screen.

All three are ordered rules over rows ``contract_id, invoice_id, status, invoice_class, activated, cycle_end,
cycle_days, suspended_days, percent, amount, price, net_value, invoice_month, migrated, consolidated, campaign,
marker, item_type, item_name``.  A contract may have many rows (its campaigns and items); the first rule that
holds on any of them counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.functions.text import strip_accents
from tidemark.operators.rules import Rule, first_rule_per_key
from tidemark.plans.billing import EQUIPMENT_FINE, EQUIPMENT_ITEM, LOYALTY_FINE, LOYALTY_TYPE

# States, classes and markers of the billing system.
CANCELLED = "ST_CONT_CANCELADO"
FIRST_BILL, LAST_BILL, BY_HAND = "INICIAL", "FINAL", "MANUAL"
REGULAR = ["PERIODICO", "REFATURAMENTO", BY_HAND, "PEDIDO"]
ADJUSTMENTS = ["AJUSTE COMERCIAL", "AJUSTE FINANCEIRO"]
BARTER, COURTESY = "%PERMUTA%", "%CORTESIA%"

# The billing tags, in the order in which they count.
NEW_NOW = "novas altas que geraram fatura - ativação em M0"
NEW_LAST_MONTH = "novas altas que geraram fatura - ativação em M1"
NEW_BEFORE = "novas altas que geraram fatura - ativação em outros meses"
STAFF_HALF = "colaboradores: desconto 1% a 50%"
STAFF_FULL = "colaboradores: desconto 51% a 100%"
ABOVE = "faturado a maior ao definido"
NO_DISCOUNT = "faturado 0% de desconto"
SMALL_DISCOUNT = "faturado 1% a 49% de desconto"
LARGE_DISCOUNT = "faturado 50% a 100% de desconto"
CONSOLIDATED = "contrato consolidado"
PARTLY_SUSPENDED = "suspensão parcial"
MIGRATED = "migração de outros planos"
ADJUSTED = "faturados com valores de ajuste"
DIVERGENT = "divergência"
NOT_YET = "não faturados até o momento"
AFTER_CYCLE = "altas pós ciclo"
EXEMPT_COURTESY = "isenções - cortesias e permutas"
EXEMPT_STAFF = "isenções - colaborador alloha"
EXEMPT_DISCOUNT = "isenções - desconto 100%"
SUSPENDED = "suspenso total"
OTHER_UNBILLED = "outros não faturados"
GONE_FINE, GONE_FINE_AND_BILL, GONE_BILL = (
    "cancelados - faturado no mês - multa de equipamento",
    "cancelados - faturado no mês - multa de equipamento e last bill",
    "cancelados - faturado no mês - somente last bill",
)
LATER_FINE, LATER_FINE_AND_BILL, LATER_BILL = (
    "cancelados - faturado outros meses - multa de equipamento",
    "cancelados - faturado outros meses - multa de equipamento e last bill",
    "cancelados - faturado outros meses - somente last bill",
)
GONE_UNBILLED = "cancelados - não faturados"

# The exemption tags.
COURTESY_TAG, STAFF_TAG, DISCOUNT_TAG = "cortesias e permutas", "colaborador alloha", "Desconto 100%"

# The tags of the billing screen, in the order in which they count.
SCREEN = [
    "Suspensão Integral M1", "Suspensão Integral M2", "Suspensão Integral M3+", "Suspensão Parcial - Retorno", "Suspensão Parcial",
    "Nova Ativação", "Entrante Pós Ciclo", "Multas e Last Bill", "Multas - Equipamento", "Multas - Fidelidade", "Last Bill M1",
    "Last Bill M0", "Desconto 100%", "Downgrade", "Upgrade", "Migração Compulsória", "Reajuste", "Adição de Produto",
    "Alteração de Vencimento", "Aplicação de Desconto", "Fim do Desconto", "Duplicado",
]
UNCLASSED = "sem classificação"
# The natures of migrations.
DOWN, UP, FORCED = "VN_MIGRACAO_DOWN", "VN_MIGRACAO_UP", "VN_MIGRACAO_COMPULSORIA"


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _all(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, map(_yes, conditions))


def _class_in(classes: list[str]) -> Column:
    return F.upper(strip_accents("invoice_class")).isin(classes)


def billing_rules(month: Column, as_of: Column) -> list[Rule]:
    """The billing tags of one month as seen on ``as_of``."""
    first = F.trunc(month, "MM")
    in_month = lambda column, n: F.trunc(column, "MM") == F.add_months(first, n)
    billed, unbilled = F.col("invoice_id").isNotNull(), F.col("invoice_id").isNull()
    gone = F.upper("status") == CANCELLED
    regular, opening = _class_in(REGULAR), _class_in([FIRST_BILL, *REGULAR])
    campaign = F.upper("campaign")
    staff, barter = campaign.isNotNull() & ~campaign.like(BARTER), campaign.like(BARTER)
    courtesy = F.upper("marker").like(BARTER) | F.upper("marker").like(COURTESY)
    above = F.col("amount") - F.col("price")
    share = F.col("amount") * 100 / F.col("price")
    as_agreed = (F.col("amount") - F.col("net_value") >= -3) & (above < 0)
    short = F.col("amount") < F.col("net_value")
    served = F.col("cycle_days") - F.col("suspended_days")
    fined = _yes(F.upper("item_name").like(EQUIPMENT_ITEM)) | _yes(F.upper("item_type") == LOYALTY_TYPE)

    on_bill = [
        (NEW_NOW, [opening, in_month("activated", 0)]),
        (NEW_LAST_MONTH, [opening, in_month("activated", -1)]),
        (NEW_BEFORE, [_class_in([FIRST_BILL, "PEDIDO"]), F.col("activated") < F.add_months(first, -1)]),
        (STAFF_HALF, [regular, staff, F.col("percent").between(1, 50)]),
        (STAFF_FULL, [regular, staff, F.col("percent").between(51, 100)]),
        (ABOVE, [regular, above > 0]),
        (NO_DISCOUNT, [regular, above.between(-3, 3)]),
        (SMALL_DISCOUNT, [regular, as_agreed, share.between(51, 99)]),
        (LARGE_DISCOUNT, [regular, as_agreed, share.between(1, 50.9999)]),
        (CONSOLIDATED, [regular, short, F.col("consolidated")]),
        (PARTLY_SUSPENDED, [regular, short, F.col("suspended_days") > 0, F.col("suspended_days") < F.col("cycle_days")]),
        (MIGRATED, [regular, short, F.col("migrated")]),
        (ADJUSTED, [regular, short, F.upper("item_type").isin(ADJUSTMENTS)]),
        (DIVERGENT, [regular]),
    ]
    off_bill = [
        (NOT_YET, [as_of < F.col("cycle_end")]),
        (AFTER_CYCLE, [in_month("activated", 0), days_between("activated", "cycle_end") < 9]),
        (EXEMPT_COURTESY, [courtesy]),
        (EXEMPT_COURTESY, [barter]),
        (EXEMPT_STAFF, [staff]),
        (EXEMPT_DISCOUNT, [F.col("percent") == 100]),
        (SUSPENDED, [F.col("suspended_days") > 0, served < 20]),
        (OTHER_UNBILLED, [served > 10]),
    ]
    ended = [
        (tag, [*conditions, F.col("invoice_month") == F.add_months(first, n)])
        for n, names in ((0, (GONE_FINE, GONE_FINE_AND_BILL, GONE_BILL)), (1, (LATER_FINE, LATER_FINE_AND_BILL, LATER_BILL)))
        for tag, conditions in zip(
            names, ([_class_in([BY_HAND]), fined], [_class_in([LAST_BILL, "REFATURAMENTO"]), fined], [_class_in([FIRST_BILL, LAST_BILL, *REGULAR])])
        )
    ]
    rules = [Rule(tag, _all(billed, ~gone, *more)) for tag, more in on_bill]
    rules += [Rule(tag, _all(unbilled, ~gone, *more)) for tag, more in off_bill]
    rules += [Rule(tag, _all(billed, gone, *more)) for tag, more in ended]
    return [*rules, Rule(GONE_UNBILLED, _all(unbilled, gone))]


def exemption_rules() -> list[Rule]:
    """Why a contract without an invoice owes none."""
    unbilled, campaign, marker = F.col("invoice_id").isNull(), F.upper("campaign"), F.upper("marker")
    courtesy = _yes(marker.like(BARTER)) | _yes(marker.like(COURTESY)) | _yes(campaign.like(BARTER))
    return [
        Rule(COURTESY_TAG, _all(unbilled, courtesy)),
        Rule(STAFF_TAG, _all(unbilled, ~campaign.like(BARTER))),
        Rule(DISCOUNT_TAG, _all(unbilled, F.col("percent") == 100)),
    ]


def screen_rules(month: Column) -> list[Rule]:
    """The tags of the billing screen, over the billing tag and these further columns.

    ``past`` (months since the newest earlier invoice of a suspended contract), ``billed_next`` (whether it has an
    invoice of the next month), ``fine``, ``nature`` of the migration, ``repriced``, ``added``, ``due_changed``,
    ``discount_begun``, ``discount_ended`` and ``paid_invoices`` (paid ones of the next month).
    """
    tag, past, alive = F.col("billing_tag"), F.col("past"), F.upper("status") != CANCELLED
    billed = F.col("invoice_id").isNotNull()
    in_month = lambda column: F.trunc(column, "MM") == F.trunc(month, "MM")
    fined, last_bills = tag.like(f"%{GONE_FINE.rsplit(' - ', 1)[-1]}%"), tag.like("%e last bill%")
    nature = lambda n: F.upper("nature") == n
    conditions = [
        [tag == SUSPENDED, past == 1], [tag == SUSPENDED, past == 2], [tag == SUSPENDED, past > 2],
        [tag == PARTLY_SUSPENDED, ~_yes(F.col("billed_next"))], [tag == PARTLY_SUSPENDED],
        [tag.isin(NEW_NOW, NEW_LAST_MONTH, NEW_BEFORE)], [tag == AFTER_CYCLE],
        [fined, last_bills, F.col("fine") == EQUIPMENT_FINE], [fined, F.col("fine") == EQUIPMENT_FINE], [fined, F.col("fine") == LOYALTY_FINE],
        [tag.isin(LATER_FINE, LATER_FINE_AND_BILL, LATER_BILL)], [tag.isin(GONE_FINE, GONE_FINE_AND_BILL, GONE_BILL)],
        [tag == EXEMPT_DISCOUNT],
        [alive, nature(DOWN)], [alive, nature(UP)], [alive, nature(FORCED)],
        [alive, F.col("repriced")], [alive, F.col("added")], [alive, F.col("due_changed")],
        [billed, alive, in_month("discount_begun")], [billed, alive, in_month("discount_ended")],
        [billed, alive, F.col("paid_invoices") > 1, F.col("amount") < F.col("net_value")],
    ]
    return [Rule(name, _all(*more)) for name, more in zip(SCREEN, conditions, strict=True)]


def billing_tags(rows: DataFrame, month: Column, as_of: Column) -> DataFrame:
    """One row per contract: billing tag, exemption tag and screen tag (contract_id, billing_tag, exemption_tag, screen_tag)."""
    keys = ["contract_id"]
    tags = first_rule_per_key(rows, keys, billing_rules(month, as_of), "billing_tag")
    exempt = first_rule_per_key(rows, keys, exemption_rules(), "exemption_tag")
    screen = first_rule_per_key(rows.join(tags, keys), keys, screen_rules(month), "screen_tag", UNCLASSED)
    return tags.join(exempt, keys).join(screen, keys)
