"""Every rejection rule, over contacts derived from customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldspan.functions.taxid import STATE_LENGTHS
from goldspan.jobs.base import Tables, job
from goldspan.operators.rules import EMAIL, Rule, errors_of, fires

CONTACTS_SQL = """
contacts AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal,
    CASE WHEN c_nationkey % 3 = 0 THEN lower(c_mktsegment) || c_custkey || '@mail.example.com'
         WHEN c_nationkey % 3 = 1 THEN lower(c_mktsegment) || ' at example' END AS email,
    CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN '   ' ELSE c_mktsegment END AS note,
    CASE WHEN c_acctbal < 2000 THEN c_custkey || '-' || c_nationkey ELSE lpad(CAST(c_custkey * 37 AS VARCHAR), 8, '0') END AS phone,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN lpad(CAST(c_custkey * 7919 AS VARCHAR), 12, '5') ELSE lpad(CAST(c_custkey * 7919 AS VARCHAR), 9, '3') END
      || lpad(CAST(c_nationkey * 4 AS VARCHAR), 2, '0') AS tax_id,
    CASE c_nationkey % 6 WHEN 0 THEN 'AC' WHEN 1 THEN 'sp' WHEN 2 THEN 'RJ' WHEN 3 THEN 'BA' WHEN 4 THEN 'RN' ELSE 'XX' END AS state,
    lpad(CAST(c_custkey AS VARCHAR), CAST(8 + c_custkey % 6 AS INTEGER), '1') AS registration
  FROM customer)"""


def contacts(t: Tables):
    n, segment = F.col("c_nationkey"), F.col("c_mktsegment")

    def padded(number, length, fill):
        return F.lpad(number.cast("string"), length, fill)

    serial = F.col("c_custkey") * 7919
    states = F.create_map(*[F.lit(x) for pair in enumerate(["AC", "sp", "RJ", "BA", "RN", "XX"]) for x in pair])
    return t.customer.select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal",
        F.when(n % 3 == 0, F.concat(F.lower(segment), "c_custkey", F.lit("@mail.example.com")))
         .when(n % 3 == 1, F.concat(F.lower(segment), F.lit(" at example"))).alias("email"),
        F.when(segment == "BUILDING", "").when(segment == "MACHINERY", F.lit(None))
         .when(segment == "FURNITURE", "   ").otherwise(segment).alias("note"),
        F.when(F.col("c_acctbal") < 2000, F.concat_ws("-", "c_custkey", n))
         .otherwise(padded(F.col("c_custkey") * 37, 8, "0")).alias("phone"),
        F.concat(F.when(segment == "MACHINERY", padded(serial, 12, "5")).otherwise(padded(serial, 9, "3")),
                 padded(n * 4, 2, "0")).alias("tax_id"),
        F.element_at(states, n % 6).alias("state"),
        F.lpad(F.col("c_custkey").cast("string"), (8 + F.col("c_custkey") % 6).cast("int"), F.lit("1")).alias("registration"))


def rule_job(name: str, rule: Rule, sql: str) -> None:
    where = f"coalesce({sql}, false)"

    @job(name, f"WITH {CONTACTS_SQL} SELECT c_custkey, {where} AS rejected FROM contacts")
    def _(t: Tables):
        return contacts(t).select("c_custkey", fires(rule).alias("rejected"))


rule_job("rule_contains", Rule("CONTAINS", "c_mktsegment", ("NIT",)), "contains(c_mktsegment, 'NIT')")
rule_job("rule_contains_array", Rule("CONTAINS_ARRAY", "c_name", (["77", "0001"],)),
         "contains(c_name, '77') OR contains(c_name, '0001')")
rule_job("rule_starts_with", Rule("STARTS_WITH", "phone", ("000",)), "starts_with(phone, '000')")
rule_job("rule_ends_with", Rule("ENDS_WITH", "email", (".com",)), "ends_with(email, '.com')")
rule_job("rule_equals", Rule("EQUALS", "note", ("HOUSEHOLD",)), "note = 'HOUSEHOLD'")
rule_job("rule_matches", Rule("MATCHES", "phone", ("^[0-9]{8}$",), negate=True), "NOT regexp_matches(phone, '^[0-9]{8}$')")
rule_job("rule_is_empty", Rule("IS_EMPTY", "note"), "note IS NULL OR trim(note) = ''")
rule_job("rule_is_email", Rule("IS_EMAIL", "email", negate=True), f"NOT regexp_matches(email, '{EMAIL}')")
rule_job("rule_length_compare", Rule("LENGTH_COMPARE", "registration", (">", 10)), "length(registration) > 10")
rule_job("rule_length_range", Rule("LENGTH_RANGE", "registration", (9, 11)), "length(registration) NOT BETWEEN 9 AND 11")
rule_job("rule_is_not_number_only", Rule("IS_NOT_NUMBER_ONLY", "phone"), "NOT regexp_full_match(phone, '[0-9]+')")
rule_job("rule_value_compare", Rule("VALUE_COMPARE", "c_acctbal", ("<", 1500.0)), "c_acctbal < 1500")


def check_digit_sql(text: str, weights: list[int]) -> str:
    total = " + ".join(f"CAST(substr({text}, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights))
    return f"((({total}) * 10) % 11 % 10 = CAST(substr({text}, {len(weights) + 1}, 1) AS INTEGER))"


_PERSON = " AND ".join([check_digit_sql("tax_id", list(range(10, 1, -1))), check_digit_sql("tax_id", list(range(11, 1, -1)))])
_COMPANY = " AND ".join([check_digit_sql("tax_id", [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]),
                         check_digit_sql("tax_id", [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])])
rule_job("rule_is_invalid_brazil_tax_id", Rule("IS_INVALID_BRAZIL_TAX_ID", "tax_id"),
         f"NOT CASE length(tax_id) WHEN 11 THEN {_PERSON} WHEN 14 THEN {_COMPANY} ELSE false END")

_STATES = " OR ".join(f"(upper(state) = '{s}' AND length(registration) IN ({', '.join(map(str, n))}))" for s, n in STATE_LENGTHS.items())
rule_job("rule_is_invalid_brazil_state_tax_id", Rule("IS_INVALID_BRAZIL_STATE_TAX_ID", "registration", ("state",)),
         f"NOT ({_STATES})")


def lookup_job(name: str, rule, sql: str) -> None:
    @job(name, f"WITH {CONTACTS_SQL} SELECT c_custkey, {sql} AS rejected FROM contacts")
    def _(t: Tables):
        checked = errors_of(contacts(t), [rule(t)])
        return checked.select("c_custkey", (F.size("mdmErrors") > 0).alias("rejected"))


def _rich(t: Tables):
    return t.supplier.where("s_acctbal > 6000")


def _pairs(t: Tables):
    segment = F.when(F.col("s_suppkey") % 2 == 0, "MACHINERY").otherwise("BUILDING")
    return t.supplier.select(F.col("s_nationkey").alias("nation"), segment.alias("segment"))


lookup_job("rule_lookup", lambda t: Rule("LOOKUP", "c_nationkey", ("s_nationkey",), table=_rich(t)),
           "NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 6000 AND s_nationkey = c_nationkey)")
lookup_job("rule_lookup_found", lambda t: Rule("LOOKUP_FOUND", "c_nationkey", ("s_nationkey",), table=_rich(t)),
           "EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 6000 AND s_nationkey = c_nationkey)")
lookup_job("rule_lookup_multiple",
           lambda t: Rule("LOOKUP_MULTIPLE", ("c_nationkey", "c_mktsegment"), (["nation", "segment"],), table=_pairs(t)),
           """NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey
              AND CASE WHEN s_suppkey % 2 = 0 THEN 'MACHINERY' ELSE 'BUILDING' END = c_mktsegment)""")
