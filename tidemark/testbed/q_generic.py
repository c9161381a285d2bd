"""Generic table operators, scalar functions and provider mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import scalars, web
from tidemark.operators import reshape
from tidemark.operators.mapping import Context, apply_mapping, contract_issues
from tidemark.sources import bank_feed, listing_feed, market_feed
from tidemark.testbed.ctes import pick
from tidemark.testbed.registry import count_rows, query
from tidemark.testbed.views import Views



def at():
    return F.lit("2024-06-01 12:00:00").cast("timestamp")


# ---- A22–A23, U: reshaping ---------------------------------------------------------------------
@query(
    "a22_pivot",
    """SELECT l_linenumber, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::BIGINT AS n_A_lines,
      sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END)::BIGINT AS n_N_lines,
      sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS n_R_lines,
      sum(CASE WHEN l_returnflag = 'it''s' THEN 1 ELSE 0 END)::BIGINT AS "n_it's_lines",
      max(CASE WHEN l_quantity >= 25 THEN l_tax ELSE -1 END) AS max_25,
      count(DISTINCT CASE WHEN l_linestatus <> 'O' THEN l_suppkey ELSE 0 END) AS suppliers_o
      FROM lineitem GROUP BY 1""",
)
def _(v):
    lines = v.table("lineitem")
    flags = reshape.pivot_columns(
        "l_returnflag", ["A", "N", "R", "it's"], prefix="n_", suffix="_lines"
    )
    big = reshape.pivot_columns(
        "l_quantity", [25], agg="max", cmp=">=", prefix="max_", then_value=F.col("l_tax"),
        else_value=-1.0,
    )
    suppliers = reshape.pivot_columns(
        "l_linestatus", ["O"], agg="count", cmp="<>", prefix="suppliers ", quote_identifiers=False,
        then_value=F.col("l_suppkey"), distinct=True,
    )
    return lines.groupBy("l_linenumber").agg(*flags, *big, *suppliers)


@query(
    "a23_column_values",
    "SELECT event_type AS value, count(*) AS count FROM events WHERE value > 5 GROUP BY 1",
)
def _(v):
    return reshape.column_values(v.table("events"), "event_type", where="value > 5")


@query(
    "a23_values_into_pivot",
    """SELECT user_id % 10 AS bucket, count(*) FILTER (event_type = 'click') AS click,
      count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase,
      count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'view') AS view
      FROM events GROUP BY 1""",
)
def _(v):
    rows = v.table("events")
    values = reshape.pivot_values(rows, "event_type", limit=50)
    bucket = (F.col("user_id") % 10).alias("bucket")
    return rows.groupBy(bucket).agg(*reshape.pivot_columns("event_type", values))


_U1 = {
    "people": "SELECT 'customer' AS src, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer",
    "firms": "SELECT 'supplier' AS src, s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment, NULL::VARCHAR AS brand FROM supplier",
    "goods": "SELECT 'part' AS src, p_partkey AS id, p_name AS name, NULL::DOUBLE AS balance, NULL::VARCHAR AS segment, p_brand AS brand FROM part",
}


def _relations(v: Views) -> dict[str, DataFrame]:
    return {
        "customer": v.table("customer").selectExpr(
            "c_custkey id", "c_name name", "c_acctbal balance", "c_mktsegment segment"),
        "supplier": v.table("supplier").selectExpr(
            "s_suppkey id", "s_name name", "s_acctbal balance"),
        "part": v.table("part").selectExpr("p_partkey id", "p_name name", "p_brand brand"),
    }


@query(
    "u01_union_relations",
    """SELECT src AS source_relation, CAST(id AS VARCHAR) AS id, name, balance, segment, brand FROM
      (SELECT * FROM people UNION ALL SELECT * FROM firms UNION ALL SELECT * FROM goods)
      WHERE id > 10""",
    _U1,
)
def _(v):
    return reshape.union_relations(_relations(v), {"id": "string"}, where="id > 10")


@query(
    "u01_union_excluding",
    """SELECT id, name, segment, brand FROM
      (SELECT * FROM people UNION ALL SELECT * FROM firms UNION ALL SELECT * FROM goods)""",
    _U1,
)
def _(v):
    return reshape.union_relations(_relations(v), exclude=["BALANCE"], source_column=None)


@query(
    "u02_union_by_pattern",
    """SELECT replace(src, 'customer', 'customer') AS kind, count(*) AS n, count(balance) AS balances FROM
      (SELECT * FROM people UNION ALL SELECT * FROM firms) GROUP BY 1""",
    _U1,
)
def _(v):
    for name, df in _relations(v).items():
        df.createOrReplaceTempView(f"party_{name}" if name != "part" else "goods_part")
    found = reshape.relations_by_prefix(v.spark, "party_")
    rows = reshape.union_relations(found, source_column="src")
    kind = F.replace("src", F.lit("party_"), F.lit("")).alias("kind")
    return rows.groupBy(kind).agg(count_rows(), F.count("balance").alias("balances"))


@query(
    "u05_distinct",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
)
def _(v):
    return v.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "u06_unpivot",
    """SELECT o_orderkey, 'o_custkey' AS prop, CAST(o_custkey AS VARCHAR) AS val FROM orders
    UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'urgent', CAST(o_orderpriority = '1-URGENT' AS VARCHAR) FROM orders""",
)
def _(v):
    rows = v.table("orders").withColumn("urgent", F.col("o_orderpriority") == "1-URGENT")
    return reshape.unpivot(
        rows, "string", exclude=["o_orderkey"], remove=["o_totalprice", "o_orderdate"],
        field_name="prop", value_name="val",
    )


@query(
    "u07_generate_series",
    """SELECT g AS generated_number, count(l_orderkey) AS n
      FROM generate_series(1, (SELECT max(l_linenumber) + 3 FROM lineitem)) t(g)
      LEFT JOIN lineitem ON l_linenumber = g GROUP BY 1""",
)
def _(v):
    lines = v.table("lineitem")
    upper = lines.agg(F.max("l_linenumber")).head()[0] + 3
    counts = lines.groupBy(F.col("l_linenumber").cast("bigint").alias("generated_number")).agg(
        F.count("*").alias("_n")
    )
    series = reshape.generate_series(v.spark, upper)
    return series.join(counts, "generated_number", "left").select(
        "generated_number", F.coalesce("_n", F.lit(0)).alias("n")
    )


def _spine(name: str, part: str, sql_step: str) -> None:
    trunc = {"day": "day", "week": "week", "month": "month"}[part]

    @query(
        name,
        f"""SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date_{part}, count(o_orderkey) AS n FROM
          (SELECT unnest(generate_series(lo, hi, INTERVAL {sql_step})) AS d, hi FROM
            (SELECT date_trunc('{trunc}', min(o_orderdate)) AS lo, max(o_orderdate) + INTERVAL 1 DAY AS hi
             FROM orders)) LEFT JOIN orders ON date_trunc('{trunc}', o_orderdate) = d
          WHERE d < hi GROUP BY 1""",
    )
    def _(v):
        orders = v.table("orders")
        bounds = orders.agg(
            F.to_date(F.date_trunc(trunc, F.min("o_orderdate"))).alias("start_date"),
            F.date_add(F.to_date(F.max("o_orderdate")), 1).alias("end_date"),
        )
        per = orders.groupBy(F.to_date(F.date_trunc(trunc, "o_orderdate")).alias(f"date_{part}")).agg(
            F.count("*").alias("_n")
        )
        spine = reshape.date_spine(bounds, part)
        return spine.join(per, f"date_{part}", "left").select(
            f"date_{part}", F.coalesce("_n", F.lit(0)).alias("n")
        )


_spine("u08_date_spine_day", "day", "1 DAY")
_spine("u08_date_spine_week", "week", "7 DAY")
_spine("u08_date_spine_month", "month", "1 MONTH")


# ---- F: functions ------------------------------------------------------------------------------
@query(
    "f01_salted_hash",
    """SELECT c_custkey, sha256('salt-1:' || c_name) AS h,
      sha256('pepper:' || c_name) AS p FROM customer""",
)
def _(v):
    return v.table("customer").select(
        "c_custkey", scalars.salted_hash("c_name", "salt-1").alias("h"),
        scalars.salted_hash("c_name", "pepper").alias("p"),
    )


_MAIL = """CASE c_custkey % 5 WHEN 0 THEN 'no-domain' WHEN 1 THEN 'ab@x.org' WHEN 2 THEN 'c@x.org'
  ELSE lower(replace(c_name, '#', '')) || '@example.com' END"""


@query(
    "f02_mask_email",
    f"""SELECT c_custkey, CASE WHEN strpos(m, '@') = 0 THEN '***'
      WHEN strpos(m, '@') <= 3 THEN repeat('*', strpos(m, '@') - 1) || substr(m, strpos(m, '@'))
      ELSE left(m, 1) || repeat('*', strpos(m, '@') - 3) || substr(m, strpos(m, '@') - 1) END AS masked
      FROM (SELECT c_custkey, {_MAIL} AS m FROM customer)""",
)
def _(v):
    k = F.col("c_custkey") % 5
    mail = (
        F.when(k == 0, "no-domain").when(k == 1, "ab@x.org").when(k == 2, "c@x.org").otherwise(
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit(""))), F.lit("@example.com"))
        )
    )
    return v.table("customer").select("c_custkey", scalars.mask_email(mail).alias("masked"))


@query(
    "f03_protected_export",
    """SELECT sha256('salt-1:' || customer_id) AS customer_id,
      sha256('salt-1:' || full_name) AS full_name,
      sha256('salt-1:' || email) AS email, country_code, risk_score, created_at
      FROM customers""",
)
def _(v):
    return scalars.protect(v.customers, "salt-1", "exports")


@query(
    "f04_surrogate_key",
    """SELECT event_id, md5(coalesce(CAST(user_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
      coalesce(CASE WHEN event_type <> 'error' THEN event_type END, '_dbt_utils_surrogate_key_null_'))
      AS key, md5(coalesce(CASE WHEN event_type <> 'error' THEN event_type END, '') || '-' || event_id)
      AS empty_key FROM events""",
)
def _(v):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return v.table("events").select(
        "event_id", scalars.surrogate_key("user_id", kind).alias("key"),
        scalars.surrogate_key(kind, "event_id", nulls_as_empty=True).alias("empty_key"),
    )


@query(
    "f05_f06_safe_arithmetic",
    """SELECT o_orderkey, coalesce(a, 0) + coalesce(b, 0) AS added,
      coalesce(a, 0) - coalesce(b, 0) AS subtracted, CAST(a AS DOUBLE) / nullif(b, 0) AS divided FROM
      (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS a,
        CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 7 END AS b FROM orders)""",
)
def _(v):
    rows = v.table("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("a"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 7).alias("b"),
    )
    return rows.select(
        "o_orderkey", scalars.safe_add("a", "b").alias("added"),
        scalars.safe_subtract("a", "b").alias("subtracted"),
        scalars.safe_divide(F.col("a").cast("double"), "b").alias("divided"),
    )


@query(
    "f07_width_bucket",
    """SELECT o_orderkey, CAST(CASE WHEN CAST(o_totalprice AS DECIMAL(28,6)) % CAST(25000 AS DECIMAL(28,6)) = 0
      THEN 1 ELSE 0 END + least(ceil((o_totalprice - 100000) / 25000.0), 13) AS INT) AS bucket FROM
      (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN (o_orderkey % 20) * 25000.0::DOUBLE
        ELSE o_totalprice END AS o_totalprice FROM orders)""",
)
def _(v):
    price = F.when(F.col("o_orderkey") % 10 == 0, (F.col("o_orderkey") % 20) * 25000.0).otherwise(
        F.col("o_totalprice")
    )
    return v.table("orders").select(
        "o_orderkey", scalars.width_bucket(price, 100000, 400000, 12).alias("bucket")
    )


_GEO = """(c_custkey % 170 - 85)::DOUBLE AS la, (c_custkey * 7 % 350 - 175)::DOUBLE AS lo,
  (c_custkey * 3 % 170 - 85)::DOUBLE AS lb, (c_custkey * 11 % 350 - 175)::DOUBLE AS lp"""
_MILES = """2 * 3961 * asin(sqrt(pow(sin(radians((lb - la) / 2)), 2) + cos(radians(la)) * cos(radians(lb))
  * pow(sin(radians((lp - lo) / 2)), 2)))"""


@query(
    "f08_haversine",
    f"""SELECT c_custkey, CAST(round({_MILES}) AS BIGINT) AS mi, CAST(round({_MILES} * 1.60934) AS BIGINT) AS km
      FROM (SELECT c_custkey, {_GEO} FROM customer)""",
)
def _(v):
    k = F.col("c_custkey")
    points = [
        (k % 170 - 85).cast("double"), (k * 7 % 350 - 175).cast("double"),
        (k * 3 % 170 - 85).cast("double"), (k * 11 % 350 - 175).cast("double"),
    ]
    return v.table("customer").select(
        "c_custkey",
        F.round(scalars.haversine(*points)).cast("bigint").alias("mi"),
        F.round(scalars.haversine(*points, unit="km")).cast("bigint").alias("km"),
    )


_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"
_CUT = f"coalesce(nullif(strpos({_BARE}, '/'), 0), strpos({_BARE}, '?') - 1)"


@query(
    "f09_f11_url_parts",
    f"""SELECT page_id,
      split_part(split_part(replace({_BARE}, 'android-app://', ''), '/', 1), '?', 1) AS host,
      split_part(right({_BARE}, length({_BARE}) - {_CUT}), '?', 1) AS path,
      nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
      nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source FROM pages""",
)
def _(v):
    return v.table("pages").select(
        "page_id", web.url_host("url").alias("host"), web.url_path("url").alias("path"),
        web.url_parameter("url", "page").alias("page"),
        web.url_parameter("url", "utm_source").alias("utm_source"),
    )


@query(
    "f12_date_functions",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, date_trunc('minute', ts) AS m,
      date_trunc('hour', ts) AS h, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS t FROM events""",
)
def _(v):
    ts = F.col("ts").cast("timestamp")
    return v.table("events").select(
        "event_id", F.to_date(ts).alias("d"), F.date_trunc("minute", ts).alias("m"),
        F.date_trunc("hour", ts).alias("h"), ts.cast("string").cast("timestamp").alias("t"),
    )


@query(
    "f15_json_round_trip",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type FROM events""",
)
def _(v):
    packed = v.table("events").select(
        "event_id",
        F.to_json(F.struct(F.from_json("props", "k int").alias("p"), "event_type")).alias("j"),
    )
    back = F.from_json("j", "p struct<k: int>, event_type string")
    return packed.select("event_id", back.alias("r")).select("event_id", "r.p.k", "r.event_type")


# ---- M: provider payloads derived from the tables ----------------------------------------------
def bank_bundles(v: Views) -> DataFrame:
    """One bundle per order: the customer's account and a response page with one or two records."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.coalesce(
        F.element_at(F.array(*[F.lit(w) for w in _NAMES]), (k % len(_NAMES)).cast("int") + 1)
    )
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    account = F.concat(F.lit("ACCT-"), c.cast("string"))

    def record(suffix: str):
        return F.struct(
            F.concat(F.lit("BTX-"), k.cast("string"), F.lit(suffix)).alias("transaction_id"),
            account.alias("account_id"),
            F.when(k % 9 == 0, -F.col("o_totalprice") / 100).otherwise(
                F.col("o_totalprice") / 64).alias("amount"),
            F.when(k % 4 != 0, "EUR").alias("iso_currency_code"),
            (k % 5 == 0).alias("pending"),
            F.when(k % 3 == 0, F.concat(date, F.lit("T10:15:00Z"))).alias("authorized_datetime"),
            F.lit("").alias("datetime"),
            date.alias("date"),
            F.when(k % 2 == 0, name).alias("merchant_name"),
            name.alias("name"),
            F.lit(None).cast("string").alias("original_description"),
            F.struct(
                F.when(k % 6 == 1, "general_merchandise").when(k % 6 == 2, "transfer_out")
                .when(k % 6 == 3, "payroll").alias("primary")
            ).alias("personal_finance_category"),
            F.struct(F.when(k % 7 < 3, "US").when(k % 7 < 5, "DE").alias("country")).alias("location"),
        )

    pages = F.array(
        F.struct(F.array(record("")).alias("added")),
        F.struct(F.when(k % 50 == 0, F.array(record("-b"))).otherwise(
            F.array().cast(f"array<{bank_feed.TRANSACTION_PAYLOAD}>")).alias("added")),
    )
    accounts = F.array(F.struct(
        account.alias("account_id"),
        F.when(c % 3 == 0, "depository").when(c % 3 == 1, "Investment").otherwise("other").alias("type"),
        F.when(c % 4 == 0, "high-yield savings").otherwise("checking").alias("subtype"),
        F.struct(
            F.when(c % 5 != 0, (c * 10).cast("string")).alias("current"),
            F.when(c % 6 != 0, "GBP").alias("iso_currency_code"),
        ).alias("balances"),
    ))
    return v.table("orders").select(
        F.concat(F.lit("CUST-"), c.cast("string")).alias("customer_id"),
        F.lit("US").alias("country_code"), accounts.alias("accounts"), pages.alias("responses"),
    )


_NAMES = [
    "Acme Payroll", "Corner Grocery", "City Fuel", "Utility Electric Bill", "Blue Cafe",
    "Service Charge", "Refund Desk", "Plain Shop", "ACH Batch", "Family Clinic", "Transfer Hub",
]
_BANK = {
    "btx0": f"""SELECT *, o_orderkey AS k, {pick(_NAMES, f'o_orderkey % {len(_NAMES)}')} AS nm FROM orders""",
    "btx1": """SELECT *, '' AS sfx FROM btx0 UNION ALL SELECT *, '-b' FROM btx0 WHERE k % 50 = 0""",
    "btx": """SELECT 'BTX-' || k || sfx AS transaction_id, 'ACCT-' || o_custkey AS account_id,
      'CUST-' || o_custkey AS customer_id,
      CASE WHEN k % 9 = 0 THEN -o_totalprice / 100 ELSE o_totalprice / 64 END AS amount,
      CASE WHEN k % 4 <> 0 THEN 'EUR' ELSE 'USD' END AS currency_code, k % 5 = 0 AS pending,
      CASE WHEN k % 3 = 0 THEN date_trunc('day', o_orderdate) + INTERVAL 615 MINUTE
        ELSE date_trunc('day', o_orderdate) END AS event_timestamp,
      upper(CASE WHEN k % 2 = 0 THEN nm ELSE '' END || ' ' || nm || '  ' || coalesce(cat, '')) AS txt,
      nm, upper(cat) AS cat, CASE WHEN k % 7 < 3 THEN 'US' WHEN k % 7 < 5 THEN 'DE' END AS loc FROM
      (SELECT *, CASE k % 6 WHEN 1 THEN 'general_merchandise' WHEN 2 THEN 'transfer_out'
        WHEN 3 THEN 'payroll' END AS cat FROM btx1)""",
    "btx_mapped": """SELECT transaction_id, account_id, customer_id,
      CASE WHEN contains(coalesce(cat, ''), 'PAYROLL') THEN 'CREDIT'
        WHEN regexp_matches(coalesce(cat, ''), 'TRANSFER|LOAN') THEN 'WIRE'
        WHEN regexp_matches(txt, 'PAYROLL|REFUND|REVERSAL|REWARD|REIMBURSEMENT') THEN 'CREDIT'
        WHEN regexp_matches(txt, 'TRANSFER|WIRE|ACH') THEN 'WIRE'
        WHEN regexp_matches(txt, 'FEE|SERVICE CHARGE') THEN 'FEE'
        WHEN amount < 0 THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type,
      currency_code, CASE WHEN pending THEN 'PENDING' ELSE 'POSTED' END AS transaction_status,
      event_timestamp, CASE WHEN cat IS NOT NULL THEN cat WHEN contains(txt, 'PAYROLL') THEN 'PAYROLL'
        WHEN contains(txt, 'GROCERY') THEN 'GROCERY' WHEN contains(txt, 'FUEL') THEN 'TRAVEL'
        WHEN contains(txt, 'UTILITY') THEN 'UTILITIES' WHEN contains(txt, 'ELECTRIC') THEN 'UTILITIES'
        WHEN contains(txt, 'CAFE') THEN 'DINING' WHEN contains(txt, 'CLINIC') THEN 'HEALTHCARE'
        WHEN contains(txt, 'TRANSFER') THEN 'BROKERAGE' ELSE upper(nm) END AS merchant_category,
      coalesce(loc, 'US') AS country_code,
      CAST(least(100, 20 + CASE WHEN abs(amount) > 1000 THEN 20 ELSE 0 END
        + CASE WHEN abs(amount) > 5000 THEN 20 ELSE 0 END + CASE WHEN pending THEN 10 ELSE 0 END
        + CASE WHEN loc <> 'US' THEN 15 ELSE 0 END) AS INT) AS risk_score FROM btx""",
}
_MAPPED = """SELECT transaction_id, account_id, customer_id, transaction_type, currency_code,
  transaction_status, event_timestamp, merchant_category, country_code, risk_score FROM btx_mapped"""
_MAPPED_COLUMNS = [
    "transaction_id", "account_id", "customer_id", "transaction_type", "currency_code",
    "transaction_status", "event_timestamp", "merchant_category", "country_code", "risk_score",
]


@query(
    "m01_bank_accounts",
    """SELECT 'ACCT-' || o_custkey AS account_id, 'CUST-' || o_custkey AS customer_id,
      CASE WHEN o_custkey % 4 = 0 THEN 'SAVINGS' WHEN o_custkey % 3 = 1 THEN 'BROKERAGE'
        ELSE 'CHECKING' END AS account_type,
      CASE WHEN o_custkey % 6 <> 0 THEN 'GBP' ELSE 'USD' END AS currency_code,
      CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey * 10 AS VARCHAR) ELSE '0' END AS current_balance,
      TIMESTAMP '2024-06-01 12:00:00' AS opened_at, 'OPEN' AS status FROM orders""",
)
def _(v):
    return bank_feed.map_accounts(bank_feed.bundle_accounts(bank_bundles(v)), at())


@query("m02_m08_bank_transactions", _MAPPED, _BANK)
def _(v):
    """All records of the paged responses, mapped; the owner comes from the account table."""
    records = bank_feed.bundle_transactions(bank_bundles(v))
    mapped = bank_feed.map_transactions(records, v.accounts, at())
    return mapped.select(*_MAPPED_COLUMNS)


@query("m08_bundles", _MAPPED, _BANK)
def _(v):
    """Bundles that repeat accounts: every record comes out once, with its bundle's customer."""
    return bank_feed.map_bundles(bank_bundles(v), at())["transactions"].select(*_MAPPED_COLUMNS)


@query(
    "m02_bank_amounts",
    """SELECT transaction_id, CAST(CAST(abs(amount) AS DECIMAL(38,12)) AS DOUBLE) AS amount FROM btx""",
    _BANK,
)
def _(v):
    """Amounts keep all their digits."""
    mapped = bank_feed.map_transactions(bank_feed.bundle_transactions(bank_bundles(v)))
    return mapped.select("transaction_id", F.col("transaction_amount").cast("double").alias("amount"))


@query(
    "m09_lineage",
    """SELECT 'bank' AS source_system, 'batch' AS source_mode, 'CUST-' || o_custkey AS source_record_id,
      'bank-CUST-' || o_custkey || '-20240601T120000Z' AS ingestion_id, 64 AS checksum_length,
      TIMESTAMP '2024-06-01 12:00:00' AS ingestion_timestamp, 1 AS schema_version FROM orders""",
)
def _(v):
    rows = bank_feed.lineage(
        bank_bundles(v), "bank", "accounts + transactions", F.col("customer_id"), at()
    )
    return rows.select(
        "source_system", "source_mode", "source_record_id", "ingestion_id",
        F.length("raw_payload_checksum").alias("checksum_length"), "ingestion_timestamp",
        "schema_version",
    )


def trade_messages(v: Views) -> DataFrame:
    """The events table as JSON market messages; one type in five is no trade."""
    k = F.col("event_id")
    conditions = F.when(k % 3 == 0, F.lit(', "c": ["@", "b1"]')).when(
        k % 3 == 1, F.lit(', "c": ["@"]')).otherwise("")

    def text(key: str, value):
        return F.concat(F.lit(f', "{key}": "'), value, F.lit('"'))

    message = F.concat(
        F.lit('{"T": "'), F.when(F.col("event_type") == "error", "q").otherwise("t"), F.lit('"'),
        F.when(k % 19 != 0, text("S", F.concat(F.lit(" sym"), (k % 50).cast("string")))).otherwise(""),
        F.lit(', "i": '), F.when(k % 4 != 0, k.cast("string")).otherwise("0"),
        F.when(k % 6 != 0, F.lit(', "x": "k"')).otherwise(""),
        F.lit(', "p": '), F.col("value").cast("string"),
        F.lit(', "s": '), (k % 300).cast("string"),
        text("t", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        conditions,
        text("z", F.when(k % 5 != 0, "a").otherwise("?")),
        F.when(k % 8 == 0, F.lit(', "tks": "b"')).when(k % 8 == 1, F.lit(', "tks": "S"')).otherwise(""),
        F.lit("}"),
    )
    rows = v.table("events").select(
        F.concat(F.lit("ACCT-"), F.col("user_id").cast("string")).alias("account"),
        message.alias("message"),
    )
    return market_feed.parse_messages(rows, "message")


@query(
    "m10_m13_market_trades",
    """SELECT 'EVT-ALPACA-' || sym || '-' || ex || '-' || ky AS event_id,
      'ALPACA-' || sym || '-' || ex || '-' || ky AS trade_id,
      CASE WHEN event_id % 19 <> 0 THEN 'SEC-' || sym END AS security_id, account_id, side,
      date_trunc('second', ts) AS event_timestamp, CAST(least(100, 40 + CASE WHEN q >= 100 THEN 10 ELSE 0 END
        + CASE WHEN value * q >= 10000 THEN 15 ELSE 0 END
        + CASE WHEN event_id % 5 = 0 THEN 5 ELSE 0 END) AS INT) AS risk_score FROM
      (SELECT *, CASE WHEN event_id % 19 <> 0 THEN 'SYM' || (event_id % 50) ELSE 'UNKNOWN' END AS sym,
        CASE WHEN event_id % 6 <> 0 THEN 'K' ELSE 'UNK' END AS ex,
        CASE WHEN event_id % 4 <> 0 THEN CAST(event_id AS VARCHAR)
          ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS ky,
        event_id % 300 AS q, 'ACCT-' || user_id AS account_id,
        CASE WHEN event_id % 8 = 0 THEN 'BUY' WHEN event_id % 8 = 1 THEN 'SELL'
          WHEN event_id % 3 = 0 THEN 'BUY' ELSE 'SELL' END AS side FROM events
        WHERE event_type <> 'error')""",
)
def _(v):
    mapped = market_feed.map_trade_messages(
        trade_messages(v), F.col("account"), F.lit("CUST-1"), F.lit("US"), F.lit(40), at()
    )
    return mapped.select(
        "event_id", "trade_id", "security_id", "account_id", "side", "event_timestamp", "risk_score"
    )


@query(
    "m10_market_amounts",
    """SELECT CASE WHEN event_id % 4 <> 0 THEN CAST(event_id AS VARCHAR)
          ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS message_key,
      CAST(CAST(value AS DECIMAL(18,6)) * CAST(event_id % 300 + CASE WHEN event_id % 4 <> 0 THEN (event_id % 8) * 0.125 ELSE 0 END AS DECIMAL(18,6))
        AS DOUBLE) AS amount,
      CAST(event_id % 300 + CASE WHEN event_id % 4 <> 0 THEN (event_id % 8) * 0.125 ELSE 0 END AS DOUBLE) AS quantity FROM events
      WHERE event_type <> 'error'""",
)
def _(v):
    """Fractional shares keep their digits, in the quantity and in the amount."""
    shares = F.col("size") + (F.regexp_extract("message_id", r"(\d+)", 1).try_cast("bigint") % 8) * 0.125
    messages = trade_messages(v).withColumn("size", F.when(
        F.col("message_id").isin("", "0"), F.col("size")).otherwise(shares))
    mapped = market_feed.map_trade_messages(
        messages, F.col("account"), F.lit("CUST-1"), F.lit("US"), F.lit(40), at()
    )
    return mapped.select(
        F.regexp_extract("trade_id", r"^[^-]*-[^-]*-[^-]*-(.*)$", 1).alias("message_key"),
        F.col("transaction_amount").cast("double").alias("amount"),
        F.col("quantity").cast("double").alias("quantity"),
    )


def listings(v: Views) -> DataFrame:
    k = F.col("p_partkey")
    return v.table("part").select(
        F.when(k % 23 != 0, F.concat(F.lit(" tk"), k.cast("string"), F.lit(" "))).otherwise(" ").alias("symbol"),
        F.when(k % 5 != 0, F.col("p_name")).otherwise("").alias("name"),
        F.when(k % 7 != 0, "nyse ").alias("exchange"),
        F.when(k % 4 == 0, "Stock").when(k % 4 == 1, "mutual fund").when(k % 4 == 2, "ETF").alias(
            "assetType"),
    )


_TYPE = """CASE p_partkey % 4 WHEN 1 THEN 'MUTUAL_FUND' WHEN 2 THEN 'ETF' ELSE 'EQUITY' END"""


@query(
    "m14_m15_m18_securities",
    f"""SELECT 'SEC-TK' || p_partkey AS security_id, 'TK' || p_partkey AS ticker,
      CASE WHEN p_partkey % 5 <> 0 THEN p_name ELSE 'TK' || p_partkey END AS security_name,
      {_TYPE} AS security_type, CASE WHEN p_partkey % 7 <> 0 THEN 'NYSE' ELSE 'UNKNOWN' END AS exchange_code,
      'USD' AS currency_code FROM part WHERE p_partkey % 23 <> 0""",
)
def _(v):
    return listing_feed.map_securities(listings(v))


@query(
    "m16_security_overviews",
    """SELECT 'SEC-TK' || p_partkey AS security_id, 'TK' || p_partkey AS ticker, p_name AS security_name,
      '' AS description, 'NASDAQ' AS exchange_code, 'USD' AS currency_code, 'US' AS country,
      p_type AS sector, 'UNKNOWN' AS industry, CAST(p_size AS VARCHAR) AS market_cap,
      CASE WHEN p_partkey % 3 = 0 THEN '0' ELSE '12.5' END AS pe_ratio, '0' AS dividend_yield,
      '0' AS beta, '' AS fiscal_year_end, '' AS latest_quarter FROM part""",
)
def _(v):
    k = F.col("p_partkey")
    pairs = {
        "Name": F.col("p_name"), "Exchange": F.lit(" nasdaq"), "Sector": F.col("p_type"),
        "MarketCapitalization": F.col("p_size").cast("string"),
        "PERatio": F.when(k % 3 == 0, "None").otherwise("12.5"), "Beta": F.lit(""),
    }
    fields = F.create_map(*[x for name, c in pairs.items() for x in (F.lit(name), c)])
    rows = v.table("part").select(
        F.concat(F.lit("tk"), k.cast("string")).alias("symbol"), fields.alias("fields")
    )
    return listing_feed.map_overviews(rows)


@query(
    "m17_daily_prices",
    """SELECT 'SEC-TK' || p_partkey AS security_id, 'TK' || p_partkey AS ticker, d AS price_date,
      CAST(p_size AS VARCHAR) AS open_price, CAST(p_size + 1 AS VARCHAR) AS high_price,
      '0' AS low_price, CAST(p_size AS VARCHAR) AS close_price, p_partkey AS volume,
      'alpha_vantage' AS source_system FROM part CROSS JOIN (VALUES ('2024-01-02'), ('2024-01-03')) t(d)""",
)
def _(v):
    size = F.col("p_size")
    bar = {
        "1. open": size.cast("string"), "2. high": (size + 1).cast("string"), "3. low": F.lit("None"),
        "4. close": size.cast("string"), "5. volume": F.col("p_partkey").cast("string"),
    }
    day = F.create_map(*[x for name, c in bar.items() for x in (F.lit(name), c)])
    days = F.create_map(F.lit("2024-01-02"), day, F.lit("2024-01-03"), day)
    rows = v.table("part").select(
        F.concat(F.lit("tk"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.struct(days.alias(listing_feed.SERIES_KEY)).alias("payload"),
    )
    return listing_feed.map_daily_prices(rows)


# ---- M19, M20 ----------------------------------------------------------------------------------
@query("m19_bank_mapping", _MAPPED, _BANK)
def _(v):
    records = bank_feed.bundle_transactions(bank_bundles(v)).withColumn(
        "owner", F.struct(F.col("customer_id"))
    )
    context = Context(loaded_at=at(), country_code=F.col("country_code"))
    return apply_mapping(records, "bank", "transactions", context).select(*_MAPPED_COLUMNS)


@query(
    "m19_listing_mapping",
    f"""SELECT CASE WHEN p_partkey % 23 <> 0 THEN 'SEC-TK' || p_partkey END AS security_id,
      {_TYPE} AS security_type, 'USD' AS currency_code FROM part""",
)
def _(v):
    context = Context(loaded_at=at())
    mapped = apply_mapping(listings(v), "listing", "securities", context)
    return mapped.select("security_id", "security_type", "currency_code")


@query(
    "m19_market_mapping",
    f"""SELECT 'T' || event_id AS trade_id, 'SEC-SYM' || (event_id % 50) AS security_id,
      CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, 'USD' AS currency_code,
      CAST(CAST(CAST(value AS DECIMAL(18,2)) * (event_id % 300) AS DECIMAL(18,2)) AS VARCHAR)
        AS transaction_amount, 'ACCT-' || user_id AS account_id, ts AS event_timestamp FROM events""",
)
def _(v):
    k = F.col("event_id")
    rows = v.table("events").select(
        F.concat(F.lit("T"), k.cast("string")).alias("id"),
        F.concat(F.lit("sym"), (k % 50).cast("string")).alias("symbol"),
        (k % 300).alias("size"), F.col("value").alias("price"),
        F.lit("").alias("currency"), F.when(k % 2 == 0, "b").otherwise("sell").alias("side"),
        F.lit(None).cast("string").alias("trade_condition"), F.col("ts").alias("timestamp"),
        F.lit("K").alias("exchange"), F.lit("a").alias("tape"),
        F.concat(F.lit("ACCT-"), F.col("user_id").cast("string")).alias("account"),
    )
    context = Context(at(), F.col("account"), F.lit("CUST-1"), F.lit("US"), F.lit(40))
    return apply_mapping(rows, "market", "trades", context).select(
        "trade_id", "security_id", "side", "currency_code", "transaction_amount", "account_id",
        "event_timestamp",
    )


_VENUES = ["K", "nyse ", "LSE", "XETRA", "TSX", "ASX", "JPX", "nowhere", None]


@query(
    "m19_market_countries",
    """SELECT 'T' || event_id AS trade_id, CASE event_id % 9 WHEN 0 THEN 'US' WHEN 1 THEN 'US' WHEN 2 THEN 'GB'
      WHEN 3 THEN 'DE' WHEN 4 THEN 'CA' WHEN 5 THEN 'AU' WHEN 6 THEN 'JP'
      ELSE CASE WHEN user_id % 2 = 0 THEN 'GB' ELSE 'US' END END AS country_code FROM events""",
)
def _(v):
    """The country follows the exchange; unknown and missing ones give the account's country."""
    k = F.col("event_id")
    venue = F.element_at(F.array(*[F.lit(x) for x in _VENUES]), (k % 9 + 1).cast("int"))
    rows = v.table("events").select(
        F.concat(F.lit("T"), k.cast("string")).alias("id"), F.lit("S").alias("symbol"),
        F.lit(1).alias("size"), F.col("value").alias("price"), F.lit("USD").alias("currency"),
        F.lit("buy").alias("side"), F.lit(None).cast("string").alias("trade_condition"),
        F.col("ts").alias("timestamp"), venue.alias("exchange"), F.lit("a").alias("tape"),
        F.when(F.col("user_id") % 2 == 0, "GB").otherwise("US").alias("home"),
    )
    context = Context(at(), F.lit("A"), F.lit("C"), F.col("home"), F.lit(40))
    return apply_mapping(rows, "market", "trades", context).select("trade_id", "country_code")


@query(
    "m19_market_securities",
    f"""SELECT 'SEC-' || p_partkey AS security_id, 'TK' || p_partkey AS ticker, p_name AS security_name,
      {_TYPE} AS security_type, 'NYSE' AS exchange_code,
      CASE WHEN p_partkey % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency_code FROM part""",
)
def _(v):
    k = F.col("p_partkey")
    rows = v.table("part").select(
        F.concat(F.lit("SEC-"), k.cast("string")).alias("id"),
        F.concat(F.lit("TK"), k.cast("string")).alias("symbol"), F.col("p_name").alias("name"),
        F.when(k % 4 == 0, "Stock").when(k % 4 == 1, "mutual fund").when(k % 4 == 2, "ETF").alias(
            "class"),
        F.lit("NYSE").alias("exchange"), F.when(k % 3 == 0, "EUR").otherwise("").alias("currency"),
    )
    return apply_mapping(rows, "market", "securities", Context(loaded_at=at()))


@query(
    "m19_bank_accounts",
    """SELECT 'ACCT-' || c_custkey AS account_id, 'CUST-' || c_custkey AS customer_id,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS current_balance,
      CASE WHEN c_custkey % 4 = 0 THEN 'USD' ELSE 'GBP' END AS currency_code,
      CASE WHEN c_custkey % 5 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS status FROM customer""",
)
def _(v):
    k = F.col("c_custkey")
    rows = v.table("customer").select(
        F.concat(F.lit("ACCT-"), k.cast("string")).alias("account_id"),
        F.struct(F.concat(F.lit("CUST-"), k.cast("string")).alias("customer_id")).alias("owner"),
        F.lit("depository").alias("type"),
        F.struct(
            F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("current"),
            F.when(k % 4 == 0, None).otherwise("GBP").alias("iso_currency_code")).alias("balances"),
        F.lit(None).cast("string").alias("created_at"),
        F.when(k % 5 == 0, None).otherwise("CLOSED").alias("status"),
    )
    return apply_mapping(rows, "bank", "accounts", Context(loaded_at=at())).select(
        "account_id", "customer_id", "current_balance", "currency_code", "status")


@query(
    "m19_filings_mapping",
    """SELECT 'SEC-CIK-' || s_suppkey AS customer_id, s_name AS full_name,
      CASE WHEN s_suppkey % 2 = 0 THEN 'ir@firm.example' ELSE 'investor-relations@example.com' END AS email,
      'US' AS country_code, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 7 ELSE 35 END AS INT) AS risk_score,
      TIMESTAMP '2024-06-01 12:00:00' AS created_at FROM supplier""",
)
def _(v):
    k = F.col("s_suppkey")
    rows = v.table("supplier").select(
        k.alias("cik"), F.col("s_name").alias("entityName"),
        F.when(k % 2 == 0, "ir@firm.example").alias("investorRelationsEmail"),
        F.lit(" us").alias("country"),
        F.struct(F.when(k % 3 == 0, 7).alias("public_filer_score")).alias("risk_model"),
        F.lit(None).cast("string").alias("created_at"),
    )
    return apply_mapping(rows, "filings", "customers", Context(at(), base_risk=F.lit(35)))


@query(
    "m20_contract_issues",
    """SELECT 'transaction_id' AS field_name, 'null in required field' AS issue,
      count(*) FILTER (o_orderkey % 97 = 0) AS row_count FROM orders_sent
    UNION ALL SELECT 'transaction_amount', 'not a decimal', count(*) FILTER (o_custkey % 11 = 0) FROM orders_sent
    UNION ALL SELECT 'customer_id', 'required field missing and derivation not allowed', count(*) FROM orders_sent
    UNION ALL SELECT 'channel', 'field not in canonical contract', count(*) FROM orders_sent""",
)
def _(v):
    bad = F.when(F.col("account_id").isNotNull() & (
        F.element_at(F.split("account_id", "-"), -1).cast("bigint") % 11 == 0), "n/a")
    rows = v.transactions_raw.withColumns(
        {"transaction_amount": bad.otherwise(F.col("transaction_amount")), "channel": F.lit("web")}
    ).drop("customer_id")
    return contract_issues(rows, "transactions")


@query(
    "m20_clean_contract",
    f"""SELECT 'customers' AS entity, count(*) AS n, 0::BIGINT AS issues FROM customers""",
)
def _(v):
    issues = contract_issues(v.customers, "customers").agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("issues"))
    from tidemark.operators.recon import one_row

    return one_row(v.customers.agg(count_rows()), issues).select(F.lit("customers").alias("entity"), "n", "issues")


