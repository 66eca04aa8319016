"""The queries of ``queries.py`` in SQL, over the plain tables, for checking results."""

from __future__ import annotations

from tellerloom.specs import JOINED_COLUMNS, MASTER, SPECS

_TEXTS = [
    field.name for field in MASTER.schema
    if field.name not in ("Number", "NationalID", "Country", "State", "Gender", "Birthday")
]

TX = """
tx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "TransactionID", CAST(o_custkey AS VARCHAR) AS "CustomerID",
         o_totalprice AS "Montant", o_orderdate AS "DateTransaction",
         o_orderpriority AS "MoyenPaiement",
         'BS' || o_custkey AS "BICsender", 'BR' || o_custkey AS "BICreceiver"
  FROM orders)
"""
ACC = """
acc AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customerid,
         o_custkey || '-' || o_orderstatus AS account_number, o_orderstatus AS account_type,
         CAST(min(o_orderdate) AS DATE) AS creation_date
  FROM orders GROUP BY o_custkey, o_orderstatus)
"""
MAS = f"""
mas AS (
  SELECT CAST(c_custkey AS INTEGER) AS "Number", c_name AS "NationalID", r_name AS "Country",
         n_name AS "State",
         CASE c_custkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' END AS "Gender",
         CAST(NULL AS DATE) AS "Birthday",
         {", ".join(f'CAST(NULL AS VARCHAR) AS "{name}"' for name in _TEXTS)}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
HOT_TX = """
hot_tx AS (
  SELECT "TransactionID", "Montant", "MoyenPaiement",
         CASE WHEN "MoyenPaiement" IN ('1-URGENT', '2-HIGH') THEN '7' ELSE "CustomerID" END
           AS "CustomerID"
  FROM tx)
"""
HOT_ACC = """
hot_acc AS (
  SELECT CASE WHEN account_type = 'F' THEN '7' ELSE customerid END AS customerid,
         account_number, account_type
  FROM acc)
"""

MOVED = """
moved AS (
  SELECT * FROM mas
  UNION ALL BY NAME SELECT * REPLACE ('OCEANIA' AS "Country") FROM mas WHERE "Gender" = 'male')
"""

INPUTS = f"WITH {TX}, {ACC}, {MAS}"
MOVED_INPUTS = f"{INPUTS}, {MOVED}"
HOT_INPUTS = f"{INPUTS}, {HOT_TX}, {HOT_ACC}"


def _join(tx: str = "tx", acc: str = "acc", mas: str = "mas") -> str:
    return (
        f"FROM {tx} t JOIN (SELECT * RENAME (customerid AS holder) FROM {acc}) a "
        f'ON t."CustomerID" = a.holder '
        f'JOIN {mas} m ON t."CustomerID" = CAST(m."Number" AS VARCHAR)'
    )


CENTS = 'CAST(sum(CAST("Montant" AS DECIMAL(18,2))) AS DOUBLE)'


def _mart(dims: str, inputs: str = INPUTS, join: str | None = None) -> str:
    return f"""{inputs}
        SELECT {dims}, count(DISTINCT t."CustomerID") AS nb_clients, {CENTS} AS total_montant
        {join or _join()} GROUP BY {dims}"""


def _stats(column: str) -> str:
    return f"""quantile_disc({column}, 0.5) AS mediane, quantile_disc({column}, 0.25) AS p25,
        quantile_disc({column}, 0.5) AS p50, quantile_disc({column}, 0.75) AS p75"""


def _distribution(inputs: str = INPUTS, join: str | None = None, by: str = '"Country"') -> str:
    return f"""{inputs}
        SELECT {by + "," if by else ""} {CENTS} / count(*) AS moyenne, {_stats('"Montant"')}
        {join or _join()} {"GROUP BY " + by if by else ""}"""


ACCOUNT_DIMS = '"Country", "Gender", account_type'
PAYMENT_DIMS = '"Country", "State", "MoyenPaiement"'
HOT_JOIN = _join("hot_tx", "hot_acc")

def _default_mart(dims: str) -> str:
    return f"""{INPUTS}
        SELECT {dims}, count(DISTINCT t."CustomerID") AS nb_clients,
               round(sum("Montant"), 2) AS total_montant
        {_join()} GROUP BY {dims}"""


_DEFAULT_DISTRIBUTION = f"""{INPUTS}
    SELECT "Country", round(avg("Montant"), 2) AS moyenne, 3 AS n_quantiles, {_stats('"Montant"')}
    {_join()} GROUP BY "Country" """

_DEFAULT_TOTALS = f"""{INPUTS}, totals AS (
        SELECT "Country", round(sum("Montant"), 2) AS total {_join()} GROUP BY "Country")
    SELECT round(avg(total), 2) AS moyenne, 3 AS n_quantiles, {_stats("total")} FROM totals"""

_CLOSE = """true AS mediane_is_close, true AS p25_is_close, true AS p50_is_close, true AS p75_is_close"""

# Where every group has fewer rows than its sketch, the ranks of the estimates are those of the quantiles.
_RANK_COUNTS = ", ".join(
    f"""count(*) FILTER ("Montant" < {name}) AS below_{name},
        count(*) FILTER ("Montant" <= {name}) AS upto_{name}"""
    for name in ("mediane", "p25", "p50", "p75")
)
_RANKED = f"""{INPUTS}, joined AS (SELECT "Country", "Montant" {_join()}),
    stats AS (
      SELECT "Country", round(avg("Montant"), 2) AS moyenne, 3 AS n_quantiles, {_stats('"Montant"')}
      FROM joined GROUP BY "Country"),
    ranks AS (
      SELECT "Country", count(*) AS rows_counted, {_RANK_COUNTS}
      FROM joined JOIN stats USING ("Country") GROUP BY "Country")
"""
_RANKS = f"""{_RANKED} SELECT *, {_CLOSE} FROM ranks"""

_TOTALS = f"""{INPUTS}, totals AS (
        SELECT "Country", sum(CAST("Montant" AS DECIMAL(18,2))) AS cents,
               CAST(sum(CAST("Montant" AS DECIMAL(18,2))) AS DOUBLE) AS total
        {_join()} GROUP BY "Country")
    SELECT CAST(sum(cents) AS DOUBLE) / count(*) AS moyenne, {_stats("total")} FROM totals"""

GAPS = """
gaps AS (
  SELECT "TransactionID", "CustomerID",
         CASE WHEN "Montant" < 50000 THEN CAST('NaN' AS DOUBLE) ELSE "Montant" END AS "Montant",
         "DateTransaction", nullif("MoyenPaiement", '5-LOW') AS "MoyenPaiement",
         "BICsender", "BICreceiver"
  FROM tx)
"""

VALIDITY = """true AS valid_flag, DATE '2025-08-28' AS valid_from, CAST(NULL AS DATE) AS valid_until"""


def _key(first: str, second: str) -> str:
    return f"sha256(concat_ws('||', {first}, {second}))"


def _keyed(dataset: str, table: str, first: str, second: str, hashed: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, key_0, key_1, {hashed} AS pk_hash FROM (
        SELECT CAST({first} AS VARCHAR) AS key_0,
               CASE WHEN NOT ends_with(CAST({first} AS VARCHAR), '7')
                    THEN CAST({second} AS VARCHAR) END AS key_1
        FROM {table})"""


def _hashes(hashed: str) -> str:
    return INPUTS + " UNION ALL ".join([
        _keyed("transactions", "tx", '"TransactionID"', '"CustomerID"', hashed),
        _keyed("comptes_bancaires", "acc", "customerid", "account_number", hashed),
        _keyed("info_global", "mas", '"NationalID"', '"Number"', hashed),
    ])


def _length_prefixed(name: str) -> str:
    return f"coalesce(length({name}) || ':' || {name}, '-')"


_NO_STATS = ", ".join(
    f"CAST(NULL AS DOUBLE) AS {name}" for name in ("moyenne", "mediane", "p25", "p50", "p75")
)
_STORED_MARTS = f"""{INPUTS}, joined AS (SELECT * {_join()})
    SELECT 'df_agg_country_gender_account' AS mart, "Country" AS first, "Gender" AS second,
           account_type AS third, count(DISTINCT "CustomerID") AS nb_clients,
           {CENTS} AS total_montant, {_NO_STATS}
    FROM joined GROUP BY {ACCOUNT_DIMS}
    UNION ALL
    SELECT 'df_agg_country_department_payment', "Country", "State", "MoyenPaiement",
           count(DISTINCT "CustomerID"), {CENTS}, {_NO_STATS}
    FROM joined GROUP BY {PAYMENT_DIMS}
    UNION ALL
    SELECT 'df_stats_transact', "Country", NULL, NULL, NULL, NULL,
           round({CENTS} / count(*), 2), {_stats('"Montant"')}
    FROM joined GROUP BY "Country" """

_MASTER_COLUMNS = ", ".join(f'"{field.name}"' for field in MASTER.schema)
_FULL_MASTER_COLUMNS = ", ".join(
    f"""coalesce("{name}", '-') AS "{name}" """ for name in (*_TEXTS, "NationalID", "Country", "State")
)

_DESCRIBED = INPUTS + " UNION ALL ".join(
    f"""SELECT '{name}' AS dataset, {position} AS position, '{field.name}' AS "column",
        '{field.dataType.simpleString()}' AS type, count("{field.name}") AS filled,
        count(*) - count("{field.name}") AS empty FROM {table}"""
    for name, table in (("transactions", "tx"), ("comptes_bancaires", "acc"), ("info_global", "mas"))
    for position, field in enumerate(SPECS[name].schema, 1)
)

_QUALITY = f"""{INPUTS},
    raw_tx AS (
      SELECT * FROM tx
      UNION ALL
      SELECT * REPLACE ('0-OTHER' AS "MoyenPaiement") FROM tx WHERE "MoyenPaiement" = '2-HIGH'),
    kept_tx AS (SELECT * FROM raw_tx WHERE "MoyenPaiement" <> '1-URGENT'),
    kept_mas AS (SELECT * FROM mas WHERE "Country" <> 'ASIA'),
    n AS (SELECT (SELECT count(*) FROM raw_tx) AS tx, (SELECT count(*) FROM kept_tx) AS kept,
                 (SELECT count(*) - count(DISTINCT ("TransactionID", "CustomerID"))
                  FROM kept_tx) AS repeated,
                 (SELECT count(*) FROM acc) AS acc, (SELECT count(*) FROM kept_mas) AS mas,
                 (SELECT count(*) FROM kept_tx WHERE "CustomerID" IN
                   (SELECT CAST("Number" AS VARCHAR) FROM kept_mas)
                   AND "CustomerID" IN (SELECT customerid FROM acc)) AS matched,
                 (SELECT count(*) {_join("kept_tx", "acc", "kept_mas")}) AS joined),
    measures AS (
      SELECT unnest([
        {{'d': 'transactions', 'm': 'rows_read', 'v': 2.0 * tx}},
        {{'d': 'transactions', 'm': 'unparsed_Montant', 'v': 2.0 * (tx - kept)}},
        {{'d': 'transactions', 'm': 'rows_incomplete', 'v': 2.0 * (tx - kept)}},
        {{'d': 'transactions', 'm': 'rows_kept', 'v': 1.0 * kept}},
        {{'d': 'transactions', 'm': 'repeated_keys', 'v': 1.0 * repeated}},
        {{'d': 'comptes_bancaires', 'm': 'rows_read', 'v': 1.0 * acc}},
        {{'d': 'comptes_bancaires', 'm': 'rows_incomplete', 'v': 0.0}},
        {{'d': 'comptes_bancaires', 'm': 'rows_kept', 'v': 1.0 * acc}},
        {{'d': 'comptes_bancaires', 'm': 'repeated_keys', 'v': 0.0}},
        {{'d': 'info_global', 'm': 'rows_read', 'v': 1.0 * mas}},
        {{'d': 'info_global', 'm': 'rows_incomplete', 'v': 0.0}},
        {{'d': 'info_global', 'm': 'rows_kept', 'v': 1.0 * mas}},
        {{'d': 'info_global', 'm': 'repeated_keys', 'v': 0.0}},
        {{'d': 'joined', 'm': 'transactions', 'v': 1.0 * kept}},
        {{'d': 'joined', 'm': 'unmatched', 'v': 1.0 * (kept - matched)}},
        {{'d': 'joined', 'm': 'joined_rows', 'v': 1.0 * joined}},
        {{'d': 'joined', 'm': 'fan_out', 'v': CAST(joined AS DOUBLE) / matched}}]) AS x FROM n)
    SELECT x.d AS dataset, x.m AS measure, CAST(x.v AS DOUBLE) AS value FROM measures"""

ORACLE: dict[str, str] = {
    "mart_country_gender_account": _mart(ACCOUNT_DIMS),
    "mart_country_department_payment": _mart(PAYMENT_DIMS),
    "distribution_by_country": _distribution(),
    "mart_country_gender_account_default": _default_mart(ACCOUNT_DIMS),
    "mart_country_department_payment_default": _default_mart(PAYMENT_DIMS),
    "distribution_by_country_default": _DEFAULT_DISTRIBUTION,
    "distribution_of_country_totals_default": _DEFAULT_TOTALS,
    "distribution_by_country_in_passes": _distribution(),
    "distribution_of_country_totals": _TOTALS,
    "joined_detail": f"{INPUTS} SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in JOINED_COLUMNS)} {_join()}",
    "joined_country_gender_account": _mart(ACCOUNT_DIMS),
    "joined_country_department_payment": _mart(PAYMENT_DIMS),
    "joined_country_gender_account_default": _default_mart(ACCOUNT_DIMS),
    "joined_country_department_payment_default": _default_mart(PAYMENT_DIMS),
    "joined_distribution": _DEFAULT_DISTRIBUTION,
    "joined_distribution_by_segment": f"""{INPUTS}
        SELECT {PAYMENT_DIMS}, round(avg("Montant"), 2) AS moyenne, 3 AS n_quantiles,
               {_stats('"Montant"')}
        {_join()} GROUP BY {PAYMENT_DIMS}""",
    "joined_distribution_error": _RANKS,
    "joined_distribution_exact": _distribution(),
    "joined_distribution_overall": _distribution(by=""),
    "joined_totals_distribution": _TOTALS,
    "joined_text_keys": f"""{INPUTS}, padded AS (
          SELECT "TransactionID", CASE WHEN "MoyenPaiement" = '5-LOW' THEN '0' || "CustomerID"
                                       ELSE "CustomerID" END AS "CustomerID"
          FROM tx)
        SELECT "TransactionID", "CustomerID", account_number, "Country" {_join("padded")}""",
    "moved_country_gender_account": _mart(ACCOUNT_DIMS, MOVED_INPUTS, _join(mas="moved")),
    "moved_distribution": _distribution(MOVED_INPUTS, _join(mas="moved"), '"Gender"'),
    "unmatched_transactions": f"""{INPUTS}
        SELECT * FROM tx
        WHERE "CustomerID" NOT IN (
                SELECT CAST("Number" AS VARCHAR) FROM mas WHERE "Country" <> 'ASIA')
           OR "CustomerID" NOT IN (SELECT customerid FROM acc)""",
    "fan_out": f"""{INPUTS}, kept AS (SELECT * FROM mas WHERE "Country" <> 'ASIA'),
        counts AS (
          SELECT (SELECT count(*) FROM tx) AS transactions,
                 (SELECT count(*) FROM tx WHERE "CustomerID" IN
                   (SELECT CAST("Number" AS VARCHAR) FROM kept)) AS matched,
                 (SELECT count(*) {_join(mas="kept")}) AS joined_rows)
        SELECT transactions, transactions - matched AS unmatched, joined_rows,
               joined_rows / matched AS fan_out
        FROM counts""",
    "hot_customer_country_gender_account": _mart(ACCOUNT_DIMS, HOT_INPUTS, HOT_JOIN),
    "hot_customer_country_department_payment": _mart(PAYMENT_DIMS, HOT_INPUTS, HOT_JOIN),
    "hot_customer_distribution": _distribution(HOT_INPUTS, HOT_JOIN),
    "hot_customer_detail": f"""{HOT_INPUTS}
        SELECT "TransactionID", "CustomerID", "Montant", account_number, "Country" {_join("hot_tx")}""",
    "typed_ingest_transactions": f"WITH {TX} SELECT * FROM tx",
    "typed_ingest_folder": f"WITH {TX} SELECT * FROM tx",
    "typed_ingest_accounts": f"WITH {ACC} SELECT * FROM acc",
    "described_datasets": _DESCRIBED,
    "typed_ingest_master": f"WITH {MAS} SELECT {_MASTER_COLUMNS} FROM mas",
    "typed_stored_transactions": f"""WITH {TX}
        SELECT * REPLACE (date_trunc('day', "DateTransaction") AS "DateTransaction") FROM tx""",
    "typed_stored_master": f"""WITH {MAS}
        SELECT * REPLACE (CASE WHEN "Country" <> 'ASIA' THEN "Number" END AS "Number") FROM mas""",
    "cast_malformed_transactions": f"""WITH {TX}
        SELECT "TransactionID", "CustomerID",
               CASE WHEN "MoyenPaiement" NOT IN ('1-URGENT', '2-HIGH') THEN "Montant" END AS "Montant",
               CASE WHEN "MoyenPaiement" NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')
                    THEN date_trunc('day', "DateTransaction") END AS "DateTransaction",
               "MoyenPaiement", "BICsender", "BICreceiver"
        FROM tx""",
    "cast_malformed_master": f"""WITH {MAS}
        SELECT "NationalID", "Country",
               CASE "Country" WHEN 'AFRICA' THEN "Number" WHEN 'AMERICA' THEN -"Number"
                              WHEN 'EUROPE' THEN 0 END AS "Number",
               CASE WHEN "Country" NOT IN ('AFRICA', 'ASIA') THEN DATE '2025-08-03' END AS "Birthday"
        FROM mas""",
    "drop_any_null": f"""WITH {TX}, {GAPS}
        SELECT * FROM gaps WHERE "MoyenPaiement" IS NOT NULL AND NOT isnan("Montant")""",
    "drop_required_null": f"""WITH {TX}, {GAPS}
        SELECT * REPLACE (CASE WHEN isnan("Montant") THEN -1.0 ELSE "Montant" END AS "Montant")
        FROM gaps WHERE "MoyenPaiement" IS NOT NULL""",
    "dedup_rows": "SELECT DISTINCT o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders",
    "dedup_subset": """
        SELECT o_custkey, o_orderpriority, count(*) AS rows_of_key, CAST(1 AS BIGINT) AS rows_chosen,
               CAST(1 AS BIGINT) AS chosen_from_input
        FROM orders GROUP BY o_custkey, o_orderpriority""",
    "dedup_latest": f"""WITH {TX}
        SELECT * EXCLUDE (position) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY "CustomerID" ORDER BY "DateTransaction" DESC, "TransactionID") AS position
          FROM tx)
        WHERE position = 1""",
    "hash_keys": _hashes("sha256(concat_ws('||', key_0, key_1))"),
    "hash_keys_null_safe": _hashes(
        f"sha256({_length_prefixed('key_0')} || {_length_prefixed('key_1')})"
    ),
    "hash_key_of_numbers": f"""WITH {MAS}
        SELECT "NationalID", "Number",
               {_key('"NationalID"', 'CAST("Number" AS VARCHAR)')} AS global_pk FROM mas""",
    "validity": f"WITH {ACC} SELECT *, {VALIDITY} FROM acc",
    "prepared_transactions": f"""WITH {TX}, {GAPS}
        SELECT *, {_key('"TransactionID"', '"CustomerID"')} AS transaction_pk, {VALIDITY}
        FROM gaps WHERE "MoyenPaiement" IS NOT NULL AND NOT isnan("Montant")""",
    "prepared_accounts": f"""WITH {ACC}
        SELECT *, {_key("customerid", "account_number")} AS account_pk, {VALIDITY} FROM acc""",
    "prepared_master": f"""WITH {MAS}
        SELECT {_MASTER_COLUMNS}, {_key('"NationalID"', 'CAST("Number" AS VARCHAR)')} AS global_pk,
               {VALIDITY}
        FROM mas WHERE "State" <> 'NATION_0'""",
    "prepared_master_any_null": f"""WITH {MAS}
        SELECT "Number", "Gender", DATE '2025-08-28' AS "Birthday", {_FULL_MASTER_COLUMNS},
               {_key('"NationalID"', 'CAST("Number" AS VARCHAR)')} AS global_pk, {VALIDITY}
        FROM mas WHERE "Gender" IS NOT NULL""",
    "batch_marts": _STORED_MARTS,
    "batch_marts_default": _STORED_MARTS,
    "batch_distribution_estimated": f"""{_RANKED}
        SELECT * FROM stats JOIN ranks USING ("Country")""",
    "staged_marts": _STORED_MARTS,
    "staged_joined": f"""{INPUTS}
        SELECT "TransactionID", account_number, "Country", "State" {_join()}""",
    "written_rows": f"""{INPUTS}
        SELECT 'transactions' AS dataset, 2 * count(*) AS rows_reported, 2 * count(*) AS rows_stored
        FROM tx
        UNION ALL SELECT 'comptes_bancaires', 2 * count(*), 2 * count(*) FROM acc
        UNION ALL SELECT 'info_global', 2 * count(*), 2 * count(*) FROM mas""",
    "quality_report": _QUALITY,
    "quality_report_of_raw": _QUALITY,
}
