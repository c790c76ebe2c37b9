from pyspark.sql import functions as F

from tidemark.operators.aggregates import cents
from tidemark.operators.rules import rule_counts
from tidemark.plans import billing, billing_tags
from tidemark.queries.registry import query
from tidemark.queries.testbed import ACC, CON, INV, accounts, contracts, day, invoices


def _billed(t):
    return invoices(t).withColumn("contract_id", F.col("client_id")).drop("client_id")


def _suspensions(t):
    """A client is suspended from five days after the due day until it pays."""
    begun = F.date_add("due", 5)
    late = _billed(t).where(F.col("paid_on").isNull() | (F.col("paid_on") > begun))
    return late.select("contract_id", begun.alias("begun"), F.col("paid_on").alias("ended"))


SUSP = "susp AS (SELECT client_id AS contract_id, due + 5 AS begun, paid_on AS ended FROM inv WHERE paid_on IS NULL OR paid_on > due + 5)"


def _lines(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _sold_lines(t):
    """Every line is a discount over some days and an extra service of its first day."""
    begun = F.to_date("l_shipdate")
    return _lines(t).select(
        F.col("o_custkey").alias("contract_id"),
        begun.alias("begun"),
        F.date_add(begun, F.col("l_quantity").cast("int")).alias("ended"),
        cents("l_discount").alias("percent"),
        (F.col("l_tax") * 100).alias("price"),
    )


def _migrations(t):
    return t.orders.select(
        F.col("o_custkey").alias("contract_id"), F.col("o_orderkey").alias("migration_id"), F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("new_value"), (F.col("o_totalprice") - (F.col("o_orderkey") % 3 - 1) * 1000).alias("old_value"),
        (F.col("o_orderstatus") != "P").alias("accepted"),
    )


def _items(t):
    kind = F.when(F.col("l_linenumber") == 2, "AJUSTE COMERCIAL").when(F.col("l_linenumber") == 3, "MULTA DE FIDELIDADE").otherwise("SERVICO")
    name = F.when(F.col("l_linenumber") == 4, "Reposicao ONU").otherwise("PLANO")
    return t.lineitem.select(F.col("l_orderkey").alias("invoice_id"), kind.alias("item_type"), name.alias("item_name"), F.col("l_extendedprice").alias("price"))


ITEMS = """items AS (SELECT l_orderkey AS invoice_id, CASE l_linenumber WHEN 2 THEN 'AJUSTE COMERCIAL' WHEN 3 THEN 'MULTA DE FIDELIDADE' ELSE 'SERVICO' END AS item_type,
  CASE l_linenumber WHEN 4 THEN 'Reposicao ONU' ELSE 'PLANO' END AS item_name, l_extendedprice AS price FROM lineitem)"""
DISC = """disc AS (SELECT o_custkey AS contract_id, CAST(l_shipdate AS DATE) AS begun, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS ended,
  CAST(l_discount AS DECIMAL(18,2)) * 100 AS percent FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(
    "billing_base",
    f"""WITH {ACC}, {INV}, {SUSP}, {DISC}, {ITEMS},
       part AS (SELECT *, CASE WHEN cancelled <= cycle_end THEN 'CANCELLED' ELSE 'ACTIVE' END AS contract_status FROM (
           SELECT *, least(DATE '2001-05-01' + CAST(contract_id % 31 AS INTEGER), DATE '2001-05-31') AS cycle_end,
             least(DATE '2001-04-01' + CAST(contract_id % 31 AS INTEGER), DATE '2001-04-30') + 1 AS cycle_start FROM acc)
         WHERE activated <= cycle_end AND (cancelled IS NULL OR cancelled >= cycle_start)),
       stop AS (SELECT contract_id, CAST(sum(greatest(0, least(coalesce(ended, DATE '9999-12-31'), cycle_end + 1) - greatest(begun, cycle_start))) AS BIGINT) AS sd
                FROM susp JOIN part USING (contract_id) GROUP BY 1),
       dsc AS (SELECT contract_id, count(*) AS n, CAST(sum(percent) AS DOUBLE) AS pct FROM disc JOIN part USING (contract_id) WHERE begun <= cycle_end AND ended >= cycle_start GROUP BY 1),
       ext AS (SELECT contract_id, count(*) AS n, CAST(sum(CAST(l_tax * 100 AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON o_custkey = contract_id
               WHERE CAST(l_shipdate AS DATE) BETWEEN cycle_start AND cycle_end GROUP BY 1),
       mig AS (SELECT contract_id, o_orderkey AS migration_id, CAST(o_orderdate AS DATE) AS migrated_on, CASE o_orderkey % 3 WHEN 2 THEN 'UP' WHEN 0 THEN 'DOWN' ELSE 'SAME' END AS migration
               FROM orders JOIN part ON o_custkey = contract_id WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) BETWEEN cycle_start AND cycle_end
               QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1),
       fin AS (SELECT invoice_id, CASE WHEN bool_or(item_name LIKE 'Repos%') AND bool_or(item_type LIKE 'MULTA%') THEN 'Equipamento e Fidelidade' WHEN bool_or(item_name LIKE 'Repos%') THEN 'Equipamento' ELSE 'Fidelidade' END AS fine,
                 CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS fine_value FROM items WHERE item_name LIKE 'Repos%' OR item_type LIKE 'MULTA%' GROUP BY 1),
       w AS (SELECT inv.invoice_id, p.contract_id, unit_id, contract_status, kind, amount, issued, cycle_start, cycle_end,
         cycle_end - cycle_start + 1 AS cycle_days, least(coalesce(sd, 0), cycle_end - cycle_start + 1) AS suspended_days, coalesce(dsc.n, 0) AS discounts,
         least(coalesce(pct, 0), 100) AS discount_percent, coalesce(ext.n, 0) AS extra_services, coalesce(ext.v, 0) AS extra_value,
         migration_id, migrated_on, migration, fine, coalesce(fine_value, 0) AS fine_value
        FROM inv JOIN part p ON inv.client_id = p.contract_id LEFT JOIN stop ON stop.contract_id = p.contract_id
        LEFT JOIN dsc ON dsc.contract_id = p.contract_id LEFT JOIN ext ON ext.contract_id = p.contract_id
        LEFT JOIN mig ON mig.contract_id = p.contract_id LEFT JOIN fin ON fin.invoice_id = inv.invoice_id
        WHERE issued BETWEEN DATE '2001-05-01' AND DATE '2001-05-31')
       SELECT *, amount * (cycle_days - suspended_days) / cycle_days * (1 - discount_percent / 100) + extra_value AS net_value FROM w""",
)
def _(t):
    billed_by = accounts(t).withColumn("closing_day", (F.col("contract_id") % 31 + 1).cast("int"))
    return billing.billing_base(_billed(t), billed_by, _suspensions(t), _sold_lines(t), _migrations(t), _items(t), day("2001-05-15"))


CLASSES = ["3-MEDIUM", "1-URGENT", "2-HIGH", "5-LOW"]


@query(
    "billing_tree",
    f"""WITH {INV} SELECT client_id AS contract_id, invoice_id, kind, due FROM inv WHERE kind <> '4-NOT SPECIFIED'
       QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY CASE kind WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 3 ELSE 4 END, due, invoice_id) = 1""",
)
def _(t):
    return billing.billing_tree(_billed(t), CLASSES).select("contract_id", "invoice_id", "kind", "due")


def _tag_rows(t):
    """Orders as contracts of a billing month, one row per item; every attribute follows from the key."""
    k = F.col("o_orderkey")
    pick = lambda n, *names: F.element_at(F.array(*[F.lit(x) for x in names]), (n + 1).cast("int"))
    flag = lambda n, r=0: k % n == r
    items = _items(t).withColumnRenamed("invoice_id", "item_of").drop("price")
    rows = t.orders.select(
        k.alias("contract_id"),
        F.when(~flag(4), k).alias("invoice_id"),
        F.when((F.col("o_orderstatus") == "F") & flag(3), "ST_CONT_CANCELADO").otherwise("ST_CONT_HABILITADO").alias("status"),
        pick(F.floor(k / 4) % 6, "Inicial", "PERIÓDICO", "REFATURAMENTO", "MANUAL", "PEDIDO", "FINAL").alias("invoice_class"),
        F.date_sub(day("2001-05-31"), (k * 7 % 120).cast("int")).alias("activated"),
        F.date_add(day("2001-05-01"), (k * 11 % 40).cast("int")).alias("cycle_end"),
        F.lit(30).alias("cycle_days"),
        F.when(flag(5), k * 3 % 31).otherwise(0).alias("suspended_days"),
        F.when(flag(7) | flag(28, 8), F.when(flag(28, 8), 100).otherwise(k * 13 % 101)).alias("percent"),
        (k * 17 % 130).cast("double").alias("amount"), F.lit(100.0).alias("price"),
        pick(F.floor(k / 3) % 3, "2001-04-01", "2001-05-01", "2001-06-01").cast("date").alias("invoice_month"),
        flag(11).alias("migrated"), flag(13).alias("consolidated"),
        F.when(flag(6), "CAMPANHA COLABORADOR").when(flag(10, 1) | flag(20, 4), "Permuta Radio").alias("campaign"),
        F.when(flag(17), "cortesia").alias("marker"),
        (F.floor(k / 5) % 5).alias("past"), flag(2, 1).alias("billed_next"), pick(k % 2, "Fidelidade", "Equipamento").alias("fine"),
        F.when(k % 8 < 3, pick(k % 8 % 3, "VN_MIGRACAO_DOWN", "VN_MIGRACAO_UP", "VN_MIGRACAO_COMPULSORIA")).alias("nature"),
        flag(9).alias("repriced"), flag(14).alias("added"), flag(15).alias("due_changed"),
        F.date_add(day("2001-04-01"), (k % 90).cast("int")).alias("discount_begun"),
        F.date_add(day("2001-05-01"), (k % 200).cast("int")).alias("discount_ended"), (k % 4).alias("paid_invoices"),
    )
    net = F.col("price") * (100 - F.coalesce("percent", F.lit(0))) / 100
    return rows.withColumn("net_value", net).join(items, F.col("contract_id") == F.col("item_of"), "left").drop("item_of")


TAG_ROWS = f"""{ITEMS}, rows_ AS (SELECT o_orderkey AS contract_id, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END AS invoice_id, o_orderstatus = 'F' AND o_orderkey % 3 = 0 AS gone,
   ['INICIAL', 'PERIODICO', 'REFATURAMENTO', 'MANUAL', 'PEDIDO', 'FINAL'][CAST(o_orderkey // 4 % 6 + 1 AS INTEGER)] AS cls, DATE '2001-05-31' - CAST(o_orderkey * 7 % 120 AS INTEGER) AS activated,
   DATE '2001-05-01' + CAST(o_orderkey * 11 % 40 AS INTEGER) AS cycle_end, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey * 3 % 31 ELSE 0 END AS susp,
   CASE WHEN o_orderkey % 28 = 8 THEN 100 WHEN o_orderkey % 7 = 0 THEN o_orderkey * 13 % 101 END AS pct, CAST(o_orderkey * 17 % 130 AS DOUBLE) AS amount,
   ['2001-04-01', '2001-05-01', '2001-06-01'][CAST(o_orderkey // 3 % 3 + 1 AS INTEGER)]::DATE AS im, o_orderkey % 11 = 0 AS migrated, o_orderkey % 13 = 0 AS child,
   CASE WHEN o_orderkey % 6 = 0 THEN 'staff' WHEN o_orderkey % 10 = 1 OR o_orderkey % 20 = 4 THEN 'barter' ELSE '' END AS camp, o_orderkey % 17 = 0 AS courtesy,
   o_orderkey AS k FROM orders),
 r AS (SELECT *, 100 * (100.0 - coalesce(pct, 0)) / 100 AS net, cls IN ('PERIODICO', 'REFATURAMENTO', 'MANUAL', 'PEDIDO') AS reg, invoice_id IS NOT NULL AS billed,
   coalesce(item_name LIKE 'Repos%' OR item_type LIKE 'MULTA%', FALSE) AS fined, coalesce(item_type LIKE 'AJUSTE%', FALSE) AS adj FROM rows_ LEFT JOIN (SELECT invoice_id AS item_of, item_type, item_name FROM items) ON item_of = contract_id),
 held AS (SELECT *, [
   billed AND NOT gone AND (reg OR cls = 'INICIAL') AND activated BETWEEN DATE '2001-05-01' AND DATE '2001-05-31',
   billed AND NOT gone AND (reg OR cls = 'INICIAL') AND activated BETWEEN DATE '2001-04-01' AND DATE '2001-04-30',
   billed AND NOT gone AND cls IN ('INICIAL', 'PEDIDO') AND activated < DATE '2001-04-01',
   billed AND NOT gone AND reg AND camp = 'staff' AND coalesce(pct BETWEEN 1 AND 50, FALSE), billed AND NOT gone AND reg AND camp = 'staff' AND coalesce(pct BETWEEN 51 AND 100, FALSE),
   billed AND NOT gone AND reg AND amount > 100, billed AND NOT gone AND reg AND amount BETWEEN 97 AND 103,
   billed AND NOT gone AND reg AND amount - net >= -3 AND amount < 100 AND amount BETWEEN 51 AND 99, billed AND NOT gone AND reg AND amount - net >= -3 AND amount < 100 AND amount BETWEEN 1 AND 50.9999,
   billed AND NOT gone AND reg AND amount < net AND child, billed AND NOT gone AND reg AND amount < net AND susp > 0 AND susp < 30,
   billed AND NOT gone AND reg AND amount < net AND migrated, billed AND NOT gone AND reg AND amount < net AND adj, billed AND NOT gone AND reg,
   NOT billed AND NOT gone AND DATE '2001-05-20' < cycle_end, NOT billed AND NOT gone AND activated >= DATE '2001-05-01' AND cycle_end - activated < 9,
   NOT billed AND NOT gone AND courtesy, NOT billed AND NOT gone AND camp = 'barter', NOT billed AND NOT gone AND camp = 'staff', NOT billed AND NOT gone AND coalesce(pct = 100, FALSE),
   NOT billed AND NOT gone AND susp > 0 AND 30 - susp < 20, NOT billed AND NOT gone AND 30 - susp > 10,
   billed AND gone AND cls = 'MANUAL' AND fined AND im = DATE '2001-05-01', billed AND gone AND cls IN ('FINAL', 'REFATURAMENTO') AND fined AND im = DATE '2001-05-01', billed AND gone AND im = DATE '2001-05-01',
   billed AND gone AND cls = 'MANUAL' AND fined AND im = DATE '2001-06-01', billed AND gone AND cls IN ('FINAL', 'REFATURAMENTO') AND fined AND im = DATE '2001-06-01', billed AND gone AND im = DATE '2001-06-01',
   NOT billed AND gone] AS h FROM r),
 names AS (SELECT ['novas altas que geraram fatura - ativação em M0', 'novas altas que geraram fatura - ativação em M1', 'novas altas que geraram fatura - ativação em outros meses',
   'colaboradores: desconto 1% a 50%', 'colaboradores: desconto 51% a 100%', 'faturado a maior ao definido', 'faturado 0% de desconto', 'faturado 1% a 49% de desconto', 'faturado 50% a 100% de desconto',
   'contrato consolidado', 'suspensão parcial', 'migração de outros planos', 'faturados com valores de ajuste', 'divergência', 'não faturados até o momento', 'altas pós ciclo',
   'isenções - cortesias e permutas', 'isenções - cortesias e permutas', 'isenções - colaborador alloha', 'isenções - desconto 100%', 'suspenso total', 'outros não faturados',
   'cancelados - faturado no mês - multa de equipamento', 'cancelados - faturado no mês - multa de equipamento e last bill', 'cancelados - faturado no mês - somente last bill',
   'cancelados - faturado outros meses - multa de equipamento', 'cancelados - faturado outros meses - multa de equipamento e last bill', 'cancelados - faturado outros meses - somente last bill',
   'cancelados - não faturados'] AS tags),
 ruled AS (SELECT *, list_position(h, TRUE) AS no FROM held),
 tagged AS (SELECT contract_id, any_value(k) AS k, bool_or(gone) AS gone, bool_or(billed) AS billed, any_value(amount) AS amount, any_value(net) AS net, min(no) AS no,
    any_value(CASE WHEN NOT billed THEN CASE WHEN courtesy OR camp = 'barter' THEN 'cortesias e permutas' WHEN camp = 'staff' THEN 'colaborador alloha' WHEN pct = 100 THEN 'Desconto 100%' END END) AS exemption_tag FROM ruled GROUP BY 1)"""


@query(
    "billing_tag",
    f"""WITH {TAG_ROWS} SELECT contract_id, tags[no] AS billing_tag, exemption_tag,
     CASE WHEN no = 21 AND k // 5 % 5 = 1 THEN 'Suspensão Integral M1' WHEN no = 21 AND k // 5 % 5 = 2 THEN 'Suspensão Integral M2' WHEN no = 21 AND k // 5 % 5 > 2 THEN 'Suspensão Integral M3+'
       WHEN no = 11 AND k % 2 = 0 THEN 'Suspensão Parcial - Retorno' WHEN no = 11 THEN 'Suspensão Parcial' WHEN no <= 3 THEN 'Nova Ativação' WHEN no = 16 THEN 'Entrante Pós Ciclo'
       WHEN no IN (24, 27) AND k % 2 = 1 THEN 'Multas e Last Bill' WHEN no IN (23, 26) AND k % 2 = 1 THEN 'Multas - Equipamento' WHEN no IN (23, 24, 26, 27) THEN 'Multas - Fidelidade'
       WHEN no = 28 THEN 'Last Bill M1' WHEN no = 25 THEN 'Last Bill M0' WHEN no = 20 THEN 'Desconto 100%'
       WHEN NOT gone AND k % 8 = 0 THEN 'Downgrade' WHEN NOT gone AND k % 8 = 1 THEN 'Upgrade' WHEN NOT gone AND k % 8 = 2 THEN 'Migração Compulsória'
       WHEN NOT gone AND k % 9 = 0 THEN 'Reajuste' WHEN NOT gone AND k % 14 = 0 THEN 'Adição de Produto' WHEN NOT gone AND k % 15 = 0 THEN 'Alteração de Vencimento'
       WHEN NOT gone AND billed AND k % 90 BETWEEN 30 AND 60 THEN 'Aplicação de Desconto' WHEN NOT gone AND billed AND k % 200 <= 30 THEN 'Fim do Desconto'
       WHEN NOT gone AND billed AND k % 4 > 1 AND amount < net THEN 'Duplicado' ELSE 'sem classificação' END AS screen_tag
     FROM tagged, names""",
)
def _(t):
    return billing_tags.billing_tags(_tag_rows(t), day("2001-05-15"), day("2001-05-20"))


@query(
    "billing_rule_counts",
    f"""WITH {TAG_ROWS}, n AS (SELECT CAST(i AS INTEGER) AS rule, tags[i] AS tag FROM names, range(1, 30) AS g(i))
       SELECT rule, tag, count(*) FILTER (WHERE no = rule) AS taken, count(*) FILTER (WHERE h[rule] AND no <> rule) AS shadowed FROM n, ruled GROUP BY ALL""",
)
def _(t):
    return rule_counts(_tag_rows(t), billing_tags.billing_rules(day("2001-05-15"), day("2001-05-20")))


@query(
    "past_months_waterfall",
    f"""WITH {INV}, h AS (SELECT client_id AS contract_id, invoice_id, issued, amount, CASE WHEN issued >= DATE '2001-05-01' THEN 1 WHEN issued >= DATE '2001-04-01' THEN 2
           WHEN issued >= DATE '2001-03-01' THEN 3 ELSE 4 END AS months_ago FROM inv
         WHERE paid_on IS NULL AND issued < DATE '2001-06-01' AND client_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000))
       SELECT * FROM h QUALIFY months_ago = min(months_ago) OVER (PARTITION BY contract_id)""",
)
def _(t):
    suspended = t.customer.where("c_acctbal < 5000").select(F.col("c_custkey").alias("contract_id"))
    return billing.past_months(_billed(t), suspended, day()).select(
        "contract_id", "invoice_id", "issued", "amount", "months_ago"
    )


KINDS = {"view": "discount", "click": "migration", "signup": "price_rise", "purchase": "add_on", "error": "due_change"}


@query(
    "month_events",
    "SELECT user_id AS contract_id, "
    + ", ".join(
        f"count(*) FILTER (event_type = '{k}') AS {v}_count, CAST(sum(CASE WHEN event_type = '{k}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS {v}_value"
        for k, v in KINDS.items()
    )
    + " FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY 1",
)
def _(t):
    log = t.events.select(F.col("user_id").alias("contract_id"), F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), "value")
    return billing.month_events(log, KINDS, day("2024-01-31"))


@query(
    "discounts_expiring",
    """WITH d AS (SELECT l_orderkey AS contract_id, l_returnflag AS category, coalesce(CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN CAST(l_shipdate AS DATE) + 30 END,
           CAST(l_shipdate AS DATE) + CAST(l_quantity * 6 AS INTEGER)) AS e FROM lineitem)
       SELECT contract_id, max(CASE WHEN category = 'A' THEN e END) AS plan_until, max(CASE WHEN category = 'N' THEN e END) AS campaign_until,
         max(CASE WHEN category = 'R' THEN e END) AS retention_until FROM d WHERE e BETWEEN DATE '2001-06-30' AND DATE '2001-12-30' GROUP BY 1""",
)
def _(t):
    shipped = F.to_date("l_shipdate")
    by_hand = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7)
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("contract_id"), F.col("l_returnflag").alias("category"),
        F.when(by_hand, F.date_add(shipped, 30)).alias("removed"),
        F.date_add(shipped, (F.col("l_quantity") * 6).cast("int")).alias("ended"),
    )
    return billing.discounts_expiring(rows, day(), {"A": "plan", "N": "campaign", "R": "retention"})


@query(
    "prorata_billing",
    f"""WITH {CON}, d AS (SELECT *, greatest(least(coalesce(cancelled - 1, DATE '2001-06-30'), DATE '2001-06-30') - greatest(activated, DATE '2001-06-01') + 1, 0) AS n FROM con)
       SELECT contract_id, plan, n AS billed_days, CASE WHEN n = 0 THEN 'NOT BILLED' WHEN n = 30 THEN 'FULL' ELSE 'PRO RATA' END AS billing, price * n / 30 AS billed_value FROM d""",
)
def _(t):
    return billing.prorata_billing(contracts(t), day())


@query(
    "component_totals",
    """SELECT l_orderkey, count(*) AS components, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS net FROM lineitem GROUP BY 1""",
)
def _(t):
    parts = t.lineitem.select("l_orderkey", F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("share"))
    return billing.component_totals(parts, ["l_orderkey"])


@query(
    "fiscal_components",
    """WITH x AS (SELECT l_orderkey AS note_id, l_returnflag AS kind, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY ALL)
       SELECT r_name AS region, CAST(sum(CASE WHEN kind = 'A' THEN v END) AS DOUBLE) AS icms, CAST(sum(CASE WHEN kind = 'N' THEN v END) AS DOUBLE) AS pis,
         CAST(sum(CASE WHEN kind = 'R' THEN v END) AS DOUBLE) AS cofins, CAST(sum(v) AS DOUBLE) AS total, count(DISTINCT note_id) AS notes
       FROM x JOIN orders ON note_id = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("note_id"), F.col("l_returnflag").alias("kind"), F.col("l_extendedprice").alias("value"))
    notes = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("note_id"), F.col("c_nationkey").alias("unit_id"))
    units = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("unit_id"), F.col("r_name").alias("region"))
    return billing.fiscal_components(lines, notes, units, {"A": "icms", "N": "pis", "R": "cofins"})


@query(
    "last_migration",
    """WITH m AS (SELECT o_custkey AS contract_id, o_orderkey AS migration_id, CAST(o_orderdate AS DATE) AS day, o_totalprice AS new_value,
           o_totalprice - (o_orderkey % 3 - 1) * 1000 AS old_value FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate BETWEEN TIMESTAMP '2001-06-01' AND TIMESTAMP '2001-06-30')
       SELECT contract_id, migration_id, day, old_value, new_value, CASE WHEN new_value > old_value THEN 'UP' WHEN new_value < old_value THEN 'DOWN' ELSE 'SAME' END AS direction
       FROM m QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY day DESC, migration_id DESC) = 1""",
)
def _(t):
    return billing.last_migration(_migrations(t), day())
