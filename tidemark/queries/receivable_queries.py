from pyspark.sql import functions as F

from tidemark.operators.joins import tiered_match
from tidemark.plans import collections, receivables
from tidemark.queries.registry import query
from tidemark.sources.lake import Lake, work_dir
from tidemark.queries.scalar_queries import PHONE_SQL, raw_phones
from tidemark.queries.testbed import ACC, AS_OF, INV, accounts, day, invoices

BAND = """CASE WHEN aging <= 0 THEN 'A VENCER' WHEN aging <= 30 THEN '1-30' WHEN aging <= 60 THEN '31-60' WHEN aging <= 90 THEN '61-90'
  WHEN aging <= 120 THEN '91-120' WHEN aging <= 150 THEN '121-150' WHEN aging <= 180 THEN '151-180' WHEN aging <= 210 THEN '181-210'
  WHEN aging <= 240 THEN '211-240' WHEN aging <= 270 THEN '241-270' WHEN aging <= 300 THEN '271-300' WHEN aging <= 330 THEN '301-330'
  WHEN aging <= 365 THEN '331-365' ELSE '366+' END"""
BAND_NO = """CASE WHEN aging <= 0 THEN 0 WHEN aging <= 30 THEN 1 WHEN aging <= 60 THEN 2 WHEN aging <= 90 THEN 3 WHEN aging <= 120 THEN 4
  WHEN aging <= 150 THEN 5 WHEN aging <= 180 THEN 6 WHEN aging <= 210 THEN 7 WHEN aging <= 240 THEN 8 WHEN aging <= 270 THEN 9
  WHEN aging <= 300 THEN 10 WHEN aging <= 330 THEN 11 WHEN aging <= 365 THEN 12 ELSE 13 END"""
PDD = f"""WITH {INV}, a AS (SELECT invoice_id, client_id, amount, due, DATE '{AS_OF}' - due AS aging FROM inv WHERE paid_on IS NULL),
  c AS (SELECT *, {BAND} AS band, {BAND_NO} AS band_order,
        CASE WHEN aging > 90 THEN 'PDD' WHEN aging <= 0 THEN 'A VENCER' ELSE 'VENCIDO DE 1 A 90' END AS own_class FROM a)"""


def _units(t):
    return t.nation.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit"))


@query("pdd_aging", f"{PDD} SELECT * FROM c")
def _(t):
    return receivables.pdd_aging(invoices(t), day())


@query(
    "pdd_drag",
    f"""{PDD} SELECT *, CASE WHEN own_class = 'PDD' THEN 'PDD' WHEN client_id IN (SELECT client_id FROM c WHERE own_class = 'PDD')
         THEN 'PDD ARRASTO' ELSE own_class END AS debt_class FROM c""",
)
def _(t):
    return receivables.pdd_drag(invoices(t), day())


def _behave(late):
    return f"CASE WHEN {late} <= 0 THEN 'BOM PAGADOR' WHEN {late} <= 5 THEN 'BAIXO RISCO' WHEN {late} <= 15 THEN 'MEDIO RISCO' ELSE 'ALTO RISCO' END"


PROFILE = f"""WITH {INV}, m AS (SELECT strftime(due, '%m/%Y') AS period, client_id, invoice_id, kind, due, paid_on, amount, paid_on - due AS late_days,
    CASE WHEN kind <> '4-NOT SPECIFIED' THEN {_behave('(paid_on - due)')} END AS behaviour
  FROM inv WHERE due BETWEEN DATE '2001-06-01' AND DATE '2001-06-30')"""


@query("payer_profile_month", f"{PROFILE} SELECT * FROM m")
def _(t):
    return receivables.payer_profile_month(invoices(t), day(), ["4-NOT SPECIFIED"])


@query(
    "payer_profile_recurrent",
    f"""{PROFILE}, pick AS (SELECT * FROM m WHERE behaviour IS NOT NULL QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY
          CASE kind WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 5 ELSE 7 END
          + CASE WHEN paid_on IS NULL AND kind <> '5-LOW' THEN 1 ELSE 0 END, due, invoice_id) = 1),
       past AS (SELECT client_id, {_behave('(paid_on - due)')} AS b FROM inv
                WHERE due >= DATE '2000-12-01' AND due < DATE '2001-06-01' AND kind <> '4-NOT SPECIFIED'),
       n AS (SELECT client_id, count(*) FILTER (b = 'BOM PAGADOR') AS g, count(*) FILTER (b = 'BAIXO RISCO') AS l,
                    count(*) FILTER (b = 'MEDIO RISCO') AS m, count(*) FILTER (b = 'ALTO RISCO') AS h FROM past GROUP BY 1)
       SELECT pick.*, CASE WHEN g >= 5 THEN 'BOM PAGADOR' WHEN g = 4 OR (g = 3 AND l >= 1 AND h = 0) OR l >= 4 THEN 'BAIXO RISCO'
         WHEN (g = 3 AND m >= 1 AND h = 0) OR m >= 4 THEN 'MEDIO RISCO' WHEN (g = 3 AND h >= 1) OR h >= 4 THEN 'ALTO RISCO'
         WHEN h > 0 THEN 'ALTO RISCO' WHEN m > 0 THEN 'MEDIO RISCO' WHEN l > 0 THEN 'BAIXO RISCO' WHEN g > 0 THEN 'BOM PAGADOR'
         ELSE behaviour END AS recurrent_profile FROM pick LEFT JOIN n USING (client_id)""",
)
def _(t):
    return receivables.payer_profile_recurrent(
        invoices(t), day(), ["1-URGENT", "2-HIGH", "3-MEDIUM"], ["4-NOT SPECIFIED"]
    )


@query(
    "invoice_current",
    f"""WITH {INV} SELECT invoice_id, client_id, CAST(1 + invoice_id % 3 AS INTEGER) AS version, amount + invoice_id % 3 AS amount, due, paid_on,
         c_mktsegment AS segment, n_name AS unit,
         coalesce(paid_on IS NULL AND due < DATE '{AS_OF}' AND amount + invoice_id % 3 >= 100000, FALSE) AS collectable
       FROM inv LEFT JOIN customer ON client_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t):
    versions = invoices(t).select(
        "*", F.explode(F.sequence(F.lit(1), (1 + F.col("invoice_id") % 3).cast("int"))).alias("version")
    )
    versions = versions.withColumn("amount", F.col("amount") + F.col("version") - 1)
    clients = t.customer.select(
        F.col("c_custkey").alias("client_id"), F.col("c_nationkey").alias("unit_id"), F.col("c_mktsegment").alias("segment")
    )
    return receivables.invoice_current(versions, clients, _units(t), day(), 100000)


@query(
    "invoice_client_match",
    """WITH inv AS (SELECT o_orderkey AS invoice_id, o_custkey % 40 AS contract_id, CASE WHEN o_orderkey % 19 <> 0 THEN '0' || CAST(o_custkey % 40 AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '-1' ELSE '.1' END END AS tax_id, o_orderdate AS created FROM orders),
       cli AS (SELECT c_custkey AS client_id, '0' || CAST(c_custkey % 50 AS VARCHAR) || '/1' AS tax_id, TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey // 4 * 37 % 2400 AS INTEGER)) AS created, c_custkey % 5 = 0 AS excluded FROM customer),
       con AS (SELECT contract_id, client_id, CASE WHEN client_id % 2 = 0 THEN 'CLICK' ELSE 'GIGA' END AS brand FROM (SELECT client_id % 40 AS contract_id, client_id FROM cli)),
       j AS (SELECT inv.*, client_id, cli.created AS since, count(client_id) OVER (PARTITION BY invoice_id) AS n,
               row_number() OVER (PARTITION BY invoice_id ORDER BY CASE WHEN cli.created <= inv.created THEN 1 ELSE 2 END, cli.created DESC, excluded, client_id DESC) AS r
             FROM inv LEFT JOIN cli ON regexp_replace(inv.tax_id, '[^0-9]', '', 'g') = regexp_replace(cli.tax_id, '[^0-9]', '', 'g'))
       SELECT invoice_id, j.contract_id, tax_id, created, j.client_id, CASE WHEN since <= created THEN 'CREATED BEFORE' WHEN since > created THEN 'CREATED LATER' END AS matched,
         greatest(n - 1, 0) AS rivals, brand FROM j LEFT JOIN con ON con.contract_id = j.contract_id AND con.client_id = j.client_id WHERE r = 1""",
)
def _(t):
    last = F.when(F.col("o_orderkey") % 2 == 0, "-1").otherwise(".1")
    tax = F.concat(F.lit("0"), F.col("o_custkey") % 40, last)
    billed = t.orders.select(
        F.col("o_orderkey").alias("invoice_id"), (F.col("o_custkey") % 40).alias("contract_id"),
        F.when(F.col("o_orderkey") % 19 != 0, tax).alias("tax_id"), F.col("o_orderdate").alias("created"),
    )
    key = F.col("c_custkey")
    since = F.date_add(day("1995-01-01"), (F.floor(key / 4) * 37 % 2400).cast("int")).cast("timestamp_ntz")
    clients = t.customer.select(
        key.alias("client_id"), F.concat(F.lit("0"), key % 50, F.lit("/1")).alias("tax_id"), since.alias("created"), (key % 5 == 0).alias("excluded")
    )
    owned = t.customer.select((key % 40).alias("contract_id"), key.alias("client_id"), F.when(key % 2 == 0, "CLICK").otherwise("GIGA").alias("brand"))
    return receivables.invoice_clients(billed, clients, owned)


def _tier_key(n, of):
    """Some keys are shared by two or more, others single."""
    shared = F.concat(F.lit("s"), F.floor(of / (2 * n)))
    return F.when(of % n == 0, shared).otherwise(F.concat(F.lit("u"), of))


def _tier_sql(n, of):
    return f"CASE WHEN {of} % {n} = 0 THEN 's' || CAST({of} // {2 * n} AS VARCHAR) ELSE 'u' || CAST({of} AS VARCHAR) END"


@query(
    "client_match_tiers",
    f"""WITH p AS (SELECT c_custkey AS client_id, c_name AS client, {_tier_sql(3, 'c_custkey')} AS tax, {_tier_sql(4, 'c_custkey')} AS mail, CASE WHEN c_custkey % 5 <> 0 THEN {_tier_sql(2, 'c_custkey')} END AS phone FROM customer),
       b AS (SELECT o_orderkey AS bill, {_tier_sql(3, 'o_custkey')} AS tax, {_tier_sql(4, '(o_custkey + 1)')} AS mail, {_tier_sql(2, '(o_custkey + 2)')} AS phone FROM orders),
       """
    + ", ".join(f"{k} AS (SELECT {k} AS key, count(*) AS n, min((client_id, client)) AS who FROM p WHERE {k} IS NOT NULL GROUP BY 1)" for k in ("tax", "mail", "phone"))
    + """, j AS (SELECT b.bill, tax.n AS n1, tax.who AS w1, mail.n AS n2, mail.who AS w2, phone.n AS n3, phone.who AS w3 FROM b
           LEFT JOIN tax ON tax.key = b.tax LEFT JOIN mail ON mail.key = b.mail LEFT JOIN phone ON phone.key = b.phone),
       k AS (SELECT *, CASE WHEN n1 = 1 THEN 1 WHEN n2 = 1 THEN 2 WHEN n3 = 1 THEN 3 END AS hit FROM j)
       SELECT bill, CASE hit WHEN 1 THEN w1[1] WHEN 2 THEN w2[1] WHEN 3 THEN w3[1] END AS client_id, CASE hit WHEN 1 THEN w1[2] WHEN 2 THEN w2[2] WHEN 3 THEN w3[2] END AS client,
         CASE hit WHEN 1 THEN 'tax id' WHEN 2 THEN 'e-mail' WHEN 3 THEN 'phone' END AS match_tier,
         greatest(0, CASE WHEN coalesce(hit > 1, TRUE) AND n1 > 1 THEN n1 END, CASE WHEN coalesce(hit > 2, TRUE) AND n2 > 1 THEN n2 END, CASE WHEN hit IS NULL AND n3 > 1 THEN n3 END) AS rivals FROM k""",
)
def _(t):
    key, owner = F.col("c_custkey"), F.col("o_custkey")
    people = t.customer.select(
        key.alias("client_id"), F.col("c_name").alias("client"), _tier_key(3, key).alias("tax"), _tier_key(4, key).alias("mail"),
        F.when(key % 5 != 0, _tier_key(2, key)).alias("phone"),
    )
    bills = t.orders.select(
        F.col("o_orderkey").alias("bill"), _tier_key(3, owner).alias("tax"), _tier_key(4, owner + 1).alias("mail"), _tier_key(2, owner + 2).alias("phone")
    )
    tiers = [(name, [F.col(c)], [F.col(c)]) for name, c in (("tax id", "tax"), ("e-mail", "mail"), ("phone", "phone"))]
    matched = tiered_match(bills, people, tiers, {"client_id": "client_id", "client": "client"})
    return matched.drop("tax", "mail", "phone")


SYSTEMS = ("air", "sydle")


@query(
    "cadastre",
    """WITH con AS (SELECT c_custkey AS contract_id, c_custkey // 2 AS client_id, c_nationkey AS unit_id, CASE WHEN c_custkey % 2 = 0 THEN 'São João' ELSE 'niteroi' END AS city, CASE WHEN c_custkey % 3 = 0 THEN 'sp' ELSE 'RJ' END AS state FROM customer),
       x AS (SELECT o_custkey // 2 AS client_id, CASE WHEN o_orderkey % 2 = 0 THEN 'air' ELSE 'sydle' END AS system, CASE WHEN o_orderkey % 5 < 3 THEN 'phone' ELSE 'email' END AS kind,
               CASE WHEN o_orderkey % 5 < 3 THEN '2199' || CAST(o_orderkey % 900 AS VARCHAR) WHEN o_orderkey % 11 = 0 THEN 'naotem@x.br' WHEN o_orderkey % 13 = 0 THEN 'none' ELSE 'c' || CAST(o_orderkey % 700 AS VARCHAR) || '@mail.br' END AS contact, o_orderdate AS recorded FROM orders),
       u AS (SELECT client_id, system, kind, contact, min(recorded) AS recorded FROM x WHERE kind = 'phone' OR (contact LIKE '%@%' AND contact NOT LIKE 'naotem%') GROUP BY ALL),
       r AS (SELECT *, row_number() OVER (PARTITION BY client_id, system, kind ORDER BY recorded, contact) AS n FROM u),
       s AS (SELECT client_id, """
    + ", ".join(
        f"max(CASE WHEN system = '{s}' AND kind = '{k}' AND n = {i} THEN contact END) AS {k}_{i}_{s}"
        for s in SYSTEMS for k, m in (("phone", 3), ("email", 2)) for i in range(1, m + 1)
    )
    + """ FROM r GROUP BY 1)
       SELECT contract_id, con.client_id, n_name AS brand, CASE WHEN n_name LIKE 'A%' THEN 'NORTH' WHEN n_name LIKE '%IN%' THEN 'SOUTH' END AS hub,
         CASE WHEN city = 'niteroi' AND state = 'RJ' THEN 'R1' WHEN city LIKE 'S%' AND state = 'sp' THEN 'R2' END AS region, s.* EXCLUDE (client_id)
       FROM con LEFT JOIN nation ON unit_id = n_nationkey LEFT JOIN s ON s.client_id = con.client_id""",
)
def _(t):
    key, order = F.col("c_custkey"), F.col("o_orderkey")
    owned = t.customer.select(
        key.alias("contract_id"), F.floor(key / 2).alias("client_id"), F.col("c_nationkey").alias("unit_id"),
        F.when(key % 2 == 0, "São João").otherwise("niteroi").alias("city"), F.when(key % 3 == 0, "sp").otherwise("RJ").alias("state"),
    )
    units = t.nation.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("brand"))
    is_phone = order % 5 < 3
    mail = F.when(order % 11 == 0, "naotem@x.br").when(order % 13 == 0, "none").otherwise(F.concat(F.lit("c"), order % 700, F.lit("@mail.br")))
    contacts = t.orders.select(
        F.floor(F.col("o_custkey") / 2).alias("client_id"), F.when(order % 2 == 0, "air").otherwise("sydle").alias("system"),
        F.when(is_phone, "phone").otherwise("email").alias("kind"),
        F.when(is_phone, F.concat(F.lit("2199"), order % 900)).otherwise(mail).alias("contact"), F.col("o_orderdate").alias("recorded"),
    )
    places = t.spark.createDataFrame([("Niterói", "RJ", "R1"), ("SAO JOAO", "SP", "R2")], "city string, state string, region string")
    return collections.cadastre(owned, units, places, contacts, [("A%", "NORTH"), ("%IN%", "SOUTH")], ["naotem%"], SYSTEMS)


@query(
    "collected_month",
    f"""WITH {INV} SELECT CAST(date_trunc('month', paid_on) AS DATE) AS period, kind, CASE WHEN paid_on - due <= 0 THEN 'on time' WHEN paid_on - due <= 5 THEN '1-5'
         WHEN paid_on - due <= 15 THEN '6-15' WHEN paid_on - due <= 30 THEN '16-30' ELSE '31+' END AS paid_band,
         count(*) AS invoices, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS collected
       FROM inv WHERE paid_on BETWEEN DATE '2001-05-01' AND DATE '2001-06-30' GROUP BY ALL""",
)
def _(t):
    return receivables.collected_months(invoices(t), day())


@query(
    "negotiation_reversal",
    f"""WITH {INV}, x AS (SELECT client_id, CAST(date_trunc('month', issued) AS DATE) AS month,
           sum(CASE WHEN kind <> '5-LOW' THEN CAST(amount AS DECIMAL(18,2)) END) AS b, sum(CASE WHEN kind = '5-LOW' THEN CAST(amount AS DECIMAL(18,2)) END) AS a,
           max(CASE WHEN kind <> '5-LOW' THEN DATE '{AS_OF}' - due END) AS age FROM inv GROUP BY ALL)
       SELECT client_id, month, CAST(b AS DOUBLE) AS debt_before, CAST(a AS DOUBLE) AS agreed_value, 1 - CAST(a AS DOUBLE) / CAST(b AS DOUBLE) AS discount_share,
         CASE WHEN age <= 30 THEN 'up to 30' WHEN age <= 90 THEN '31-90' WHEN age <= 365 THEN '91-365' ELSE '366+' END AS age_band
       FROM x WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def _(t):
    return receivables.negotiation_reversal(invoices(t), F.col("kind") == "5-LOW", day())


COHORT = f"""{ACC}, {INV}, ovd AS (SELECT * FROM inv WHERE paid_on IS NULL AND amount >= 30 AND due < DATE '{AS_OF}'),
 elig AS (SELECT *, CASE WHEN cancelled IS NULL THEN 'ATIVO' ELSE 'INATIVO' END AS mailing_status FROM acc WHERE segment <> 'BUILDING' AND balance >= -500),
 led AS (SELECT client_id, invoice_id AS motivating_invoice, due AS oldest_due, DATE '{AS_OF}' - due AS aging FROM ovd
         QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY due, invoice_id) = 1),
 facts AS (SELECT client_id, max(paid_on) AS last_payment, max(CAST(kind = '5-LOW' AS INTEGER)) AS negotiated FROM inv GROUP BY 1),
 debts AS (SELECT client_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS debt, count(*) AS open_invoices FROM ovd GROUP BY 1),
 cohort AS (SELECT contract_id, elig.client_id, unit_id, segment, mailing_status, motivating_invoice, oldest_due, CAST(date_trunc('month', oldest_due) AS DATE) AS due_month, aging,
   CASE WHEN aging <= 30 THEN '1-30' WHEN aging <= 60 THEN '31-60' WHEN aging <= 90 THEN '61-90' WHEN aging <= 180 THEN '91-180' ELSE '181+' END AS age_band,
   aging >= 180 AS last_chance, debt, open_invoices, last_payment, negotiated, DATE '2001-06-01' AS reference
  FROM elig JOIN led USING (client_id) JOIN facts USING (client_id) JOIN debts USING (client_id))"""


def _billed(t):
    return invoices(t).withColumn("contract_id", F.col("client_id")).drop("client_id")


def _cohort(t):
    acc = accounts(t)
    banned = [acc.where("segment = 'BUILDING'"), acc.where("balance < -500")]
    return collections.mailing_cohort(acc, _billed(t), banned, day(), F.col("kind") == "5-LOW")


def _stored_cohort(t):
    """The cohort as the month's table, the way the follow-up runs find it."""
    lake = Lake(t.spark, work_dir(t.spark, "mailing"))
    return lake.materialize("mailing", _cohort(t), "table")


@query("mailing_cohort", f"WITH {COHORT} SELECT * FROM cohort")
def _(t):
    return _cohort(t)


@query(
    "mailing_open_list",
    f"""WITH {INV}, n AS (SELECT client_id AS contract_id, invoice_id, row_number() OVER (PARTITION BY client_id ORDER BY due, invoice_id) AS p
           FROM inv WHERE paid_on IS NULL AND amount >= 30 AND due < DATE '{AS_OF}')
       SELECT contract_id, CAST((p - 1) // 1000 + 1 AS BIGINT) AS part, string_agg(CAST(invoice_id AS VARCHAR), ', ' ORDER BY p) AS open_list FROM n GROUP BY ALL""",
)
def _(t):
    return collections.open_list(_billed(t), day())


@query(
    "bureau_list",
    f"""WITH {COHORT} SELECT contract_id, cohort.client_id, reference, invoice_id, due, amount FROM cohort JOIN ovd USING (client_id)""",
)
def _(t):
    return collections.bureau_list(_cohort(t), _billed(t), day())


# a month later half of the open invoices were paid
LATER = "DATE '2001-07-31'"
EXITS = f"""{COHORT}, later AS (SELECT invoice_id, kind, CASE WHEN paid_on IS NOT NULL THEN paid_on WHEN invoice_id % 4 <> 0 THEN DATE '2001-07-15' END AS paid_on FROM inv),
 why AS (SELECT motivating_invoice, 'CANCELAMENTO' AS exit_reason, cancelled AS reason_day, 1 AS priority FROM cohort JOIN acc USING (contract_id) WHERE cancelled <= {LATER}
  UNION ALL SELECT motivating_invoice, 'NEGOCIACAO', coalesce(paid_on, {LATER}), 2 FROM cohort JOIN later ON motivating_invoice = invoice_id WHERE kind = '5-LOW'
  UNION ALL SELECT motivating_invoice, 'PAGAMENTO', paid_on, 3 FROM cohort JOIN later ON motivating_invoice = invoice_id WHERE paid_on <= {LATER}),
 reason AS (SELECT * FROM why QUALIFY row_number() OVER (PARTITION BY motivating_invoice ORDER BY priority) = 1)"""


def _reasons(t, cohort):
    paid = F.when(F.col("paid_on").isNotNull(), F.col("paid_on")).when(F.col("invoice_id") % 4 != 0, day("2001-07-15"))
    later = _billed(t).withColumn("paid_on", paid)
    return collections.exit_reasons(cohort, accounts(t), later, day("2001-07-31"), F.col("kind") == "5-LOW")


@query("mailing_exit_reason", f"WITH {EXITS} SELECT motivating_invoice, exit_reason, reason_day, priority FROM reason")
def _(t):
    return _reasons(t, _stored_cohort(t))


NO_EXIT = {"exit_reason": "string", "reason_day": "date", "left_on": "date"}


def _stored(cohort):
    slim = cohort.select("contract_id", "unit_id", "motivating_invoice", "reference", "age_band", "debt")
    return slim.withColumns({n: F.lit(None).cast(k) for n, k in NO_EXIT.items()})


@query(
    "mailing_upsert",
    f"""WITH {EXITS} SELECT contract_id, unit_id, motivating_invoice, reference, age_band, debt, r.exit_reason, r.reason_day,
         CASE WHEN r.exit_reason IS NOT NULL THEN {LATER} END AS left_on FROM cohort LEFT JOIN reason r USING (motivating_invoice)
       UNION ALL SELECT contract_id, unit_id, motivating_invoice, DATE '2001-07-01', age_band, debt, NULL, NULL, NULL FROM cohort WHERE mailing_status = 'ATIVO'""",
)
def _(t):
    cohort = _stored_cohort(t)
    fresh = cohort.where("mailing_status = 'ATIVO'").withColumn("reference", day("2001-07-01"))
    return collections.monthly_mailing(_stored(cohort), _reasons(t, cohort), fresh, day("2001-07-31"))


@query(
    "mailing_summary",
    f"""WITH {EXITS} SELECT n_name AS unit, age_band, count(*) AS contracts, CAST(sum(CAST(debt AS DECIMAL(18,2))) AS DOUBLE) AS debt, count(exit_reason) AS left_mailing
       FROM cohort LEFT JOIN reason USING (motivating_invoice) LEFT JOIN nation ON unit_id = n_nationkey GROUP BY ALL""",
)
def _(t):
    cohort = _stored_cohort(t)
    now = collections.apply_exits(_stored(cohort), _reasons(t, cohort), day("2001-07-31"))
    return collections.mailing_summary(now, _units(t), day("2001-06-01"))


@query(
    "contact_sheet",
    """WITH c AS (SELECT o_custkey AS client_id, CASE WHEN o_orderkey % 3 = 0 THEN 'phone' WHEN o_orderkey % 3 = 1 THEN 'mail' ELSE 'sms' END AS kind,
                         'c' || CAST(o_orderkey AS VARCHAR) AS contact, o_totalprice AS v FROM orders),
       r AS (SELECT *, row_number() OVER (PARTITION BY client_id, kind ORDER BY v DESC, contact) AS n FROM c)
       SELECT client_id, """
    + ", ".join(f"max(CASE WHEN kind = 'phone' AND n = {i} THEN contact END) AS phone_{i}" for i in range(1, 7))
    + ", max(CASE WHEN kind = 'mail' AND n = 1 THEN contact END) AS mail_1, max(CASE WHEN kind = 'sms' AND n = 1 THEN contact END) AS sms_1 FROM r GROUP BY 1",
)
def _(t):
    third = F.col("o_orderkey") % 3
    contacts = t.orders.select(
        F.col("o_custkey").alias("client_id"),
        F.when(third == 0, "phone").when(third == 1, "mail").otherwise("sms").alias("kind"),
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("contact"),
        F.col("o_totalprice").alias("rank_value"),
    )
    return collections.contact_sheet(contacts, {"phone": 6, "mail": 1, "sms": 1})


@query(
    "contact_priority",
    """WITH a AS (SELECT o_custkey AS client_id, 'p' || CAST(o_orderkey % 500 AS VARCHAR) AS contact, o_orderdate AS updated, 0 AS s FROM orders WHERE o_orderstatus = 'F'),
            b AS (SELECT o_custkey AS client_id, 'p' || CAST(o_orderkey % 500 AS VARCHAR) AS contact, o_orderdate AS updated, 1 AS s FROM orders WHERE o_orderstatus = 'O'),
            x AS (SELECT client_id, contact, min(s) AS s, max(updated) AS u FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2),
            r AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY s, u DESC, contact) AS n FROM x)
       SELECT client_id, max(CASE WHEN n = 1 THEN contact END) AS contact_1, max(CASE WHEN n = 2 THEN contact END) AS contact_2,
         max(CASE WHEN n = 3 THEN contact END) AS contact_3 FROM r WHERE n <= 3 GROUP BY 1""",
)
def _(t):
    cols = [
        F.col("o_custkey").alias("client_id"),
        F.concat(F.lit("p"), F.col("o_orderkey") % 500).alias("contact"),
        F.col("o_orderdate").alias("updated"),
    ]
    pick = lambda s: t.orders.where(F.col("o_orderstatus") == s).select(*cols)
    return collections.contact_priority([pick("F"), pick("O")], 3)


@query(
    "phone_dimension",
    f"""WITH {PHONE_SQL}, x AS (SELECT DISTINCT c_custkey AS client_id, cleaned FROM clean WHERE cleaned IS NOT NULL),
       y AS (SELECT c_custkey AS client_id, '3199' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS cleaned FROM customer)
       SELECT client_id, cleaned, 'main' AS source FROM x
       UNION ALL SELECT y.client_id, y.cleaned, 'other' FROM y ANTI JOIN x ON x.client_id = y.client_id""",
)
def _(t):
    from tidemark.plans.contacts import phone_dimension

    main = raw_phones(t).select(F.col("c_custkey").alias("client_id"), "phone")
    other = t.customer.select(
        F.col("c_custkey").alias("client_id"),
        F.concat(F.lit("(31) 99"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("phone"),
    )
    return phone_dimension(main, other).select("client_id", "cleaned", "source")
