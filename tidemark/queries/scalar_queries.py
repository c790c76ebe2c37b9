from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, staging, text
from tidemark.operators.aggregates import money
from tidemark.queries.registry import query
from tidemark.queries.testbed import AS_OF, INV, day, invoices

# completed months up to the run date
MONTHS = f"""(date_diff('month', o_orderdate, DATE '{AS_OF}')
  - CASE WHEN o_orderdate <= DATE '{AS_OF}' AND day(o_orderdate) > day(DATE '{AS_OF}') THEN 1
         WHEN o_orderdate > DATE '{AS_OF}' AND day(o_orderdate) < day(DATE '{AS_OF}') THEN -1 ELSE 0 END)"""
FOLD = """translate({}, 'ÁÉÍÓÚáéíóúÂÊÎÔÛâêîôûÀÈÌÒÙàèìòùÄËÏÖÜäëïöüÇçÑñÃãõÕ', 'AEIOUaeiouAEIOUaeiouAEIOUaeiouAEIOUaeiouCcNnAaoO')"""


@query("strip_accents", f"SELECT doc_id, md5({FOLD.format('text')}) AS folded FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(text.strip_accents("text")).alias("folded"))


# line breaks and apostrophes go; Spark writes the capital of the German sharp s as SS
FLAT = FOLD.format("translate(text, chr(13) || chr(10) || chr(39), '')")


@query(
    "clean_text_key",
    f"SELECT conv_id, turn, md5(replace(upper(trim({FLAT})), 'ẞ', 'SS')) AS folded FROM conversations",
)
def _(t):
    return t.conversations.select("conv_id", "turn", F.md5(text.clean_text_key("text")).alias("folded"))


@query("digits_only", "SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents")
def _(t):
    return t.documents.select("doc_id", text.digits_only("text").alias("digits"))


@query(
    "extract_after_marker",
    """SELECT doc_id, CASE WHEN strpos(text, ' the ') > 0 THEN substring(text, strpos(text, ' the ') + 5, 12) END AS after_marker
       FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", text.extract_after("text", " the ", 12).alias("after_marker"))


@query(
    "like_any_flags",
    """SELECT doc_id, text LIKE '%password%' OR text LIKE '%@%' AS sensitive,
         text ILIKE '%LICENSE%' OR text ILIKE '%copyright%' AS licence FROM documents""",
)
def _(t):
    return t.documents.select(
        "doc_id",
        text.like_any("text", ["%password%", "%@%"]).alias("sensitive"),
        text.like_any("text", ["%LICENSE%", "%copyright%"], ignore_case=True).alias("licence"),
    )


@query("ilike_brand", "SELECT p_partkey, p_brand FROM part WHERE p_brand ILIKE 'bRAND#1%'")
def _(t):
    return t.part.where(F.col("p_brand").ilike("bRAND#1%")).select("p_partkey", "p_brand")


@query(
    "hms_to_seconds",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS INTEGER) * 3600
         + CAST(minute(ts) AS INTEGER) * 60 + CAST(floor(second(ts)) AS INTEGER) END AS seconds FROM events""",
)
def _(t):
    clock = F.concat_ws(":", F.floor("value"), F.lpad(F.minute("ts").cast("string"), 2, "0"), F.lpad(F.second("ts").cast("string"), 2, "0"))
    spoken = F.when(F.col("event_type") == "error", "n/a").otherwise(clock)
    return t.events.select("event_id", text.hms_to_seconds(spoken).alias("seconds"))


@query(
    "lenient_int",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_id + 16777217 END AS n FROM events""",
)
def _(t):
    written = F.when(F.col("event_type") == "error", "n/a").otherwise(F.concat((F.col("event_id") + 16777217).cast("string"), F.lit(".0")))
    return t.events.select("event_id", text.to_int_lenient(written).alias("n"))


@query(
    "null_markers",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL ELSE event_type END AS kind FROM events""",
)
def _(t):
    kind = F.col("event_type")
    raw = F.when(kind == "error", "nan").when(kind == "view", "[None]").otherwise(kind)
    return t.events.select("event_id", text.null_markers(raw).alias("kind"))


@query(
    "safe_cast_projection",
    """SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS level, TRY_CAST(o_orderpriority AS INTEGER) AS broken,
         TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day, TRY_CAST(o_orderstatus AS DATE) AS no_day FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("level"),
        F.col("o_orderpriority").try_cast("int").alias("broken"),
        F.date_format("o_orderdate", "yyyy-MM-dd").try_cast("date").alias("day"),
        F.col("o_orderstatus").try_cast("date").alias("no_day"),
    )


@query(
    "to_bool",
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS flag FROM customer""",
)
def _(t):
    raw = F.element_at(F.array(F.lit("true"), F.lit("F"), F.lit(" 1"), F.lit("0"), F.lit("?")), (F.col("c_custkey") % 5 + 1).cast("int"))
    return t.customer.select("c_custkey", text.to_bool(raw).alias("flag"))


PHONE_SQL = """phones AS (SELECT c_custkey, lpad(CAST((c_custkey * 7919) % 10000000 AS VARCHAR), 7, '0') AS d FROM customer),
 raw AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '+55 (11) 98' || d WHEN 1 THEN '0218' || d WHEN 2 THEN '(31) 3' || d
   WHEN 3 THEN 'abc' || d WHEN 4 THEN '1199999999' WHEN 5 THEN '5511' || '3' || d END AS phone FROM phones),
 bare AS (SELECT c_custkey, phone, regexp_replace(regexp_replace(phone, '[() .+-]', '', 'g'), '^[^1-9]*', '') AS b FROM raw),
 loc AS (SELECT *, CASE WHEN length(b) BETWEEN 12 AND 13 AND b LIKE '55%' THEN substring(b, 3) ELSE b END AS l FROM bare),
 clean AS (SELECT c_custkey, phone, CASE WHEN regexp_matches(phone, '[A-Za-z]') THEN NULL
   WHEN length(l) = 10 AND substring(l, 3, 1) IN ('6', '7', '8', '9') THEN left(l, 2) || '9' || right(l, 8) ELSE l END AS cleaned FROM loc)"""


def raw_phones(t):
    d = F.lpad(((F.col("c_custkey") * 7919) % 10000000).cast("string"), 7, "0")
    forms = F.array(
        F.concat(F.lit("+55 (11) 98"), d), F.concat(F.lit("0218"), d), F.concat(F.lit("(31) 3"), d),
        F.concat(F.lit("abc"), d), F.lit("1199999999"), F.concat(F.lit("55113"), d),
    )
    return t.customer.select("c_custkey", F.element_at(forms, (F.col("c_custkey") % 6 + 1).cast("int")).alias("phone"))


@query(
    "phone_clean_classify",
    f"""WITH {PHONE_SQL} SELECT c_custkey, phone, cleaned, CASE WHEN cleaned IS NULL THEN 'UNKNOWN'
         WHEN length(replace(right(cleaned, 8), left(right(cleaned, 8), 1), '')) = 0 AND length(cleaned) >= 8 THEN 'UNKNOWN'
         WHEN length(cleaned) = 11 AND substring(cleaned, 3, 1) = '9' THEN 'MOBILE' WHEN length(cleaned) = 10 THEN 'FIXED' ELSE 'UNKNOWN' END AS class
       FROM clean""",
)
def _(t):
    cleaned = raw_phones(t).withColumn("cleaned", text.clean_phone("phone"))
    return cleaned.withColumn("class", text.phone_class("cleaned"))


@query(
    "valid_contact_filter",
    r"""WITH e AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'client' || c_custkey || '@example.com' WHEN 1 THEN 'atualize@example.com'
         WHEN 2 THEN 'no mail' ELSE 'Naotem' || c_custkey || '@example.org' END AS email FROM customer)
       SELECT * FROM e WHERE regexp_matches(lower(email), '^[^@\s]+@[^@\s]+\.[^@\s]+$')
         AND lower(email) NOT LIKE 'atualize%' AND lower(email) NOT LIKE 'naotem%'""",
)
def _(t):
    key = F.col("c_custkey")
    mail = (
        F.when(key % 4 == 0, F.concat(F.lit("client"), key, F.lit("@example.com")))
        .when(key % 4 == 1, "atualize@example.com")
        .when(key % 4 == 2, "no mail")
        .otherwise(F.concat(F.lit("Naotem"), key, F.lit("@example.org")))
    )
    listed = t.customer.select("c_custkey", mail.alias("email"))
    return listed.where(text.valid_email("email", ["atualize%", "naotem%", "%@teste%", "sem@%"]))


@query("first_token", "SELECT c_custkey, split_part(replace(c_name, '#', ' '), ' ', 1) AS first_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", text.first_token(F.replace("c_name", F.lit("#"), F.lit(" "))).alias("first_name"))


@query(
    "parse_rate_units",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN CAST(p_size AS DOUBLE)
         WHEN 2 THEN CAST(p_size AS DOUBLE) / 1000 ELSE CAST(p_size AS DOUBLE) * 1000 END AS mbps FROM part""",
)
def _(t):
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    label = (
        F.when(kind == 0, F.concat(size, F.lit("M/50M")))
        .when(kind == 1, F.concat(F.lit("RES "), size, F.lit(" mbps UP")))
        .when(kind == 2, F.concat(size, F.lit("KBPS")))
        .otherwise(F.concat(size, F.lit(" GB")))
    )
    return t.part.select("p_partkey", text.speed_mbps(label).alias("mbps"))


@query(
    "channel_rules",
    """SELECT p_partkey, CASE WHEN p_name ILIKE '%RING%' THEN 'store' WHEN p_name ILIKE 'small%' THEN 'partner' WHEN p_name ILIKE '%widget' THEN 'digital'
         ELSE 'other' END AS channel FROM part""",
)
def _(t):
    rules = [("%RING%", "store"), ("small%", "partner"), ("%widget", "digital")]
    return t.part.select("p_partkey", text.first_match("p_name", rules, "other").alias("channel"))


@query(
    "code_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", text.code_map("o_orderstatus", {"F": "finished", "O": "open"}, "unknown").alias("status"))


@query(
    "segment_flags",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B2B' WHEN c_acctbal > 5000 THEN 'PME' ELSE 'B2C' END AS segment FROM customer""",
)
def _(t):
    return t.customer.select("c_custkey", text.segment(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 5000).alias("segment"))


@query(
    "contains_flag",
    """SELECT c_custkey, contains('pw' || CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 ELSE c_custkey + 7 END AS VARCHAR), CAST(c_custkey AS VARCHAR)) AS weak FROM customer""",
)
def _(t):
    key = F.col("c_custkey")
    secret = F.concat(F.lit("pw"), F.when(key % 3 == 0, key * 10).otherwise(key + 7).cast("string"))
    return t.customer.select("c_custkey", text.weak_secret(secret, key.cast("string")).alias("weak"))


@query(
    "surrogate_key",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, md5(CAST(l_orderkey AS VARCHAR) || '-' || coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')
         || '-' || CAST(l_partkey AS VARCHAR)) AS row_key FROM lineitem""",
)
def _(t):
    flag = F.nullif("l_returnflag", F.lit("N"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text.surrogate_key("l_orderkey", flag, "l_partkey").alias("row_key"))


@query(
    "url_parts",
    """SELECT page_id, split_part(split_part(regexp_replace(url, '^(https?|android-app)://', ''), '/', 1), '?', 1) AS host,
         regexp_extract(regexp_replace(url, '^https?://', ''), '^[^/?]*/?([^?]*)', 1) AS path,
         nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page_no FROM pages""",
)
def _(t):
    return t.pages.select(
        "page_id", text.url_host("url").alias("host"), text.url_path("url").alias("path"), text.url_parameter("url", "page").alias("page_no")
    )


@query(
    "empty_to_null",
    "SELECT o_orderkey, nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '') AS status, o_orderpriority FROM orders",
)
def _(t):
    blanked = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"), "o_orderpriority")
    return text.empty_to_null(blanked)


@query("period_key", "SELECT o_orderkey, strftime(o_orderdate, '%m/%Y') AS period FROM orders")
def _(t):
    return t.orders.select("o_orderkey", dates.period_key("o_orderdate").alias("period"))


@query(
    "event_time_from_parts",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) - INTERVAL 3 HOUR END AS at FROM events",
)
def _(t):
    clock = F.when(F.col("event_type") == "error", "late").otherwise(F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", dates.ts_from_parts(F.date_format("ts", "yyyy-MM-dd"), clock, -3).alias("at"))


@query(
    "discounted_price",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - least(greatest(l_discount * 100 * 15, 0), 100) / 100) AS net FROM lineitem",
)
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", numbers.discounted_value("l_extendedprice", F.col("l_discount") * 100 * 15).alias("net"))


@query(
    "weighted_ticket",
    """SELECT o_orderkey, (o_totalprice * (1 - CAST(10 AS DOUBLE) / 100) * least(o_orderkey % 20, 12) + o_totalprice * (12 - least(o_orderkey % 20, 12))) / 12 AS ticket FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", numbers.weighted_ticket("o_totalprice", F.lit(10.0), F.col("o_orderkey") % 20).alias("ticket"))


@query(
    "haversine",
    """WITH p AS (SELECT c_custkey, radians(CAST(c_custkey % 179 - 89 AS DOUBLE)) AS a, radians(CAST(c_custkey % 359 - 179 AS DOUBLE)) AS b,
         radians(CAST(c_nationkey AS DOUBLE)) AS c, radians(CAST(c_nationkey * 2 AS DOUBLE)) AS d FROM customer)
       SELECT c_custkey, round(2 * 3961.0 * asin(sqrt(pow(sin((c - a) / 2), 2) + cos(a) * cos(c) * pow(sin((d - b) / 2), 2))) * 1.60934, 4) AS km FROM p""",
)
def _(t):
    f = lambda c: c.cast("double")
    km = numbers.haversine(f(F.col("c_custkey") % 179 - 89), f(F.col("c_custkey") % 359 - 179), f(F.col("c_nationkey")), f(F.col("c_nationkey") * 2), "km")
    return t.customer.select("c_custkey", F.round(km, 4).alias("km"))


@query(
    "width_bucket",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 40 THEN 9
         ELSE CAST(floor(l_quantity / 5) AS BIGINT) + 1 END AS bucket FROM lineitem""",
)
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.width_bucket("l_quantity", F.lit(0.0), F.lit(40.0), F.lit(8)).alias("bucket"))


@query(
    "safe_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0) AS added,
         coalesce(l_quantity, 0) - coalesce(nullif(l_tax, 0), 0) AS taken, CASE WHEN l_tax <> 0 THEN l_discount / l_tax END AS divided FROM lineitem""",
)
def _(t):
    d, x = F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.safe_add(d, x).alias("added"),
        numbers.safe_subtract("l_quantity", x).alias("taken"), numbers.safe_divide("l_discount", "l_tax").alias("divided"),
    )


@query(
    "aging_buckets",
    f"""WITH {INV} SELECT invoice_id, CASE WHEN DATE '{AS_OF}' - due <= 0 THEN 'not due' WHEN DATE '{AS_OF}' - due <= 30 THEN '1-30'
         WHEN DATE '{AS_OF}' - due <= 60 THEN '31-60' WHEN DATE '{AS_OF}' - due <= 90 THEN '61-90' ELSE 'over 90' END AS band
       FROM inv""",
)
def _(t):
    age = dates.days_between("due", day())
    return invoices(t).select("invoice_id", text.bucketize(age, [0, 30, 60, 90], ["not due", "1-30", "31-60", "61-90", "over 90"]).alias("band"))


@query(
    "tenure_buckets",
    f"""SELECT o_orderkey, CASE WHEN m <= 3 THEN 'up to 3' WHEN m <= 6 THEN '4 to 6' WHEN m <= 12 THEN '7 to 12' WHEN m <= 24 THEN '13 to 24' ELSE 'over 24' END AS tenure
       FROM (SELECT o_orderkey, {MONTHS} AS m FROM orders)""",
)
def _(t):
    months = dates.whole_months_between(F.to_date("o_orderdate"), day())
    return t.orders.select("o_orderkey", text.bucketize(months, [3, 6, 12, 24], ["up to 3", "4 to 6", "7 to 12", "13 to 24", "over 24"]).alias("tenure"))


@query(
    "price_buckets",
    """SELECT o_orderkey, CASE WHEN p IS NULL THEN 'unknown' WHEN p <= 59999.99 THEN 'A' WHEN p <= 99999.99 THEN 'B' WHEN p <= 249999.99 THEN 'C' ELSE 'D' END AS band
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS p FROM orders)""",
)
def _(t):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return t.orders.select("o_orderkey", text.bucketize(price, [59999.99, 99999.99, 249999.99], ["A", "B", "C", "D"], "unknown").alias("band"))


@query(
    "threshold_flags",
    f"""WITH {INV} SELECT invoice_id, """
    + ", ".join(f"CAST(coalesce(paid_on, DATE '{AS_OF}') - due >= {n} AS INTEGER) AS late_{n}d" for n in (1, 5, 10, 15, 20, 30))
    + " FROM inv",
)
def _(t):
    late = dates.days_between("due", F.coalesce("paid_on", day()))
    return invoices(t).select("invoice_id", *[(late >= n).cast("int").alias(f"late_{n}d") for n in (1, 5, 10, 15, 20, 30)])


@query(
    "scalar_strings",
    """SELECT event_id, upper(event_type) AS up, event_type || '-' || CAST(user_id AS VARCHAR) AS joined, replace(event_type, 'e', '3') AS replaced,
         translate(event_type, 'aeiou', 'AEIOU') AS translated, left(event_type, 2) AS l2, right(event_type, 2) AS r2, length(event_type) AS len,
         substring(event_type, 2, 3) AS mid, strpos(event_type, 'r') AS at, regexp_replace(props, '[^0-9]', '', 'g') AS digits,
         trim('  ' || event_type || ' ') AS trimmed, split_part(props, ':', 1) AS head, regexp_matches(props, '[0-9]{2}') AS two_digits
       FROM events""",
)
def _(t):
    e = F.col("event_type")
    return t.events.select(
        "event_id", F.upper(e).alias("up"), F.concat_ws("-", e, "user_id").alias("joined"), F.replace(e, F.lit("e"), F.lit("3")).alias("replaced"),
        F.translate(e, "aeiou", "AEIOU").alias("translated"), F.left(e, F.lit(2)).alias("l2"), F.right(e, F.lit(2)).alias("r2"),
        F.length(e).cast("bigint").alias("len"), F.substring(e, 2, 3).alias("mid"), F.instr(e, "r").cast("bigint").alias("at"),
        F.regexp_replace("props", "[^0-9]", "").alias("digits"), F.trim(F.concat(F.lit("  "), e, F.lit(" "))).alias("trimmed"),
        F.substring_index("props", ":", 1).alias("head"), F.col("props").rlike("[0-9]{2}").alias("two_digits"),
    )


@query(
    "scalar_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 45 AS plus_45, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS plus_2m,
         CAST(last_day(o_orderdate) AS DATE) AS month_end, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, year(o_orderdate) AS y, month(o_orderdate) AS m,
         day(o_orderdate) AS d, strftime(o_orderdate, '%d/%m/%Y') AS written, DATE '2001-06-30' - CAST(o_orderdate AS DATE) AS days,
         @MONTHS AS months, CAST(epoch(o_orderdate) AS BIGINT) AS unix,
         o_orderdate + INTERVAL 90 MINUTE AS later FROM orders""".replace("@MONTHS", MONTHS),
)
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.date_add(d, 45).alias("plus_45"), F.add_months(d, 2).alias("plus_2m"), F.last_day(d).alias("month_end"),
        F.trunc(d, "MM").alias("month_start"), F.year(d).cast("bigint").alias("y"), F.month(d).cast("bigint").alias("m"), F.dayofmonth(d).cast("bigint").alias("d"),
        F.date_format(d, "dd/MM/yyyy").alias("written"), dates.days_between(d, day()).alias("days"), dates.whole_months_between(d, day()).alias("months"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("unix"), (F.col("o_orderdate") + F.expr("interval 90 minutes")).alias("later"),
    )


@query(
    "scalar_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, greatest(l_discount, l_tax) AS hi, least(l_discount, l_tax) AS lo, abs(l_discount - 0.05) AS gap,
         CAST(floor(l_extendedprice / 100) AS BIGINT) AS hundreds, CASE WHEN l_tax <> 0 THEN l_discount / l_tax END AS ratio,
         coalesce(nullif(l_tax, 0), l_discount) AS filled, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 2 AS DOUBLE) AS twice FROM lineitem""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.greatest("l_discount", "l_tax").alias("hi"), F.least("l_discount", "l_tax").alias("lo"),
        F.abs(F.col("l_discount") - 0.05).alias("gap"), F.floor(F.col("l_extendedprice") / 100).alias("hundreds"),
        F.try_divide("l_discount", "l_tax").alias("ratio"), F.coalesce(F.nullif("l_tax", F.lit(0.0)), "l_discount").alias("filled"),
        (money("l_extendedprice") * 2).cast("double").alias("twice"),
    )


@query(
    "scalar_json",
    """SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, coalesce(props ->> '$.missing', 'none') AS missing,
         CASE WHEN CAST(props ->> '$.k' AS INTEGER) > 50 THEN 'high' ELSE 'low' END AS band FROM events""",
)
def _(t):
    k = F.from_json("props", "k int").getField("k")
    return t.events.select(
        "event_id", k.alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing"),
        F.when(k > 50, "high").otherwise("low").alias("band"),
    )


@query(
    "stage_view",
    """SELECT user_id AS client_id, event_id AS last_event, CASE WHEN event_type IN ('error') THEN NULL ELSE event_type END AS status,
         CAST(floor(value) AS BIGINT) AS amount, CAST(ts AS DATE) AS updated FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    raw = t.events.select(
        "user_id", "event_id", "ts", "event_type",
        F.when(F.col("event_type") == "error", "nan").otherwise(F.col("event_type")).alias("status"),
        F.floor("value").cast("string").alias("amount"),
    )
    spec = staging.StageSpec(
        columns={
            "user_id": ("client_id", None), "event_id": ("last_event", None), "status": ("status", None),
            "amount": ("amount", "bigint"), "ts": ("updated", "date"),
        },
        keys=["user_id", "event_type"],
        newest_by=["ts", "event_id"],
        marked_null=["status"],
    )
    return staging.stage(raw, spec)
