"""The ledger relations, derived from whole generated tables.

An order plays the account, a customer the person, line items the bills, plan rows and
ledger entries, and nations the banks. Each relation is one SELECT that Spark and DuckDB
read the same way, so that both engines see the same ledger; nothing here is under test. Spark
takes some sums of one by another expression of the same value.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from types import MappingProxyType

from pyspark.sql import DataFrame

from checks.registry import Tables
from debtlens.sources import Ledger, normalize
from debtlens.sources.relations import ADDRESS

AS_OF = datetime.date(1998, 1, 1)
SNAPSHOT_DATE = datetime.date(2026, 1, 24)


@dataclass(frozen=True)
class Derivation:
    table: str
    columns: dict[str, str]
    where: str = "TRUE"
    group_by: str = ""
    # Of some columns, what Spark computes the same values by in less time.
    faster: dict[str, str] = field(default_factory=dict)

    def sql(self, source: str, changed: Mapping[str, str] = MappingProxyType({})) -> str:
        columns = ", ".join(f"{e} AS {c}" for c, e in {**self.columns, **changed}.items())
        grouped = f" GROUP BY {self.group_by}" if self.group_by else ""
        return f"SELECT {columns} FROM {source} WHERE {self.where}{grouped}"

    def frame(self, t: Tables) -> DataFrame:
        return t.spark.sql(self.sql("{source}", self.faster), source=getattr(t, self.table))


def amount(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,2))"


def cents_summed(expression: str) -> str:
    """The sum of amounts, taken in whole cents: an aggregation holds a 64-bit sum in place, where one
    of DECIMAL(28,2) is made anew for every row and is twice as wide in the shuffle."""
    cents = f"SUM(CAST(({expression}) * 100 AS BIGINT))"
    return amount(f"CAST({cents} AS DECIMAL(19,0)) * 0.01BD")


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def when(condition: str, value: str, otherwise: str = "NULL") -> str:
    return f"CASE WHEN {condition} THEN {value} ELSE {otherwise} END"


ACCOUNT, PERSON = text("o_orderkey"), text("o_custkey")
LINE_ACCOUNT = text("l_orderkey")
LINE_VERSION = "CASE WHEN l_linenumber <= 3 THEN 1 WHEN l_linenumber <= 6 THEN 2 ELSE 3 END"
PRICE, QUANTITY, TAX, DISCOUNT = (
    amount(c) for c in ("l_extendedprice", "l_quantity", "l_tax", "l_discount")
)
OPEN_PRICE = when("l_linestatus = 'O'", PRICE)
A_QUANTITY = when("l_returnflag = 'A'", QUANTITY)
N_DISCOUNT = when("l_returnflag = 'N'", DISCOUNT)
R_TAX = when("l_returnflag = 'R'", TAX)

# Several derivations of one relation are its UNION ALL.
DERIVATIONS: dict[str, list[Derivation]] = {
    "list_account_f69_117": [Derivation("orders", {"acc_no": ACCOUNT, "cid": PERSON})],
    "list_acc_broken_contract": [
        Derivation("orders", {"acc_no": ACCOUNT, "cid": PERSON, "cif": f"'F' || {PERSON}"}),
        # Suppliers are listed accounts that no other relation knows.
        Derivation(
            "supplier",
            {"acc_no": f"'S' || {text('s_suppkey')}", "cid": "NULL", "cif": "'none'"},
        ),
    ],
    "report_summary_month": [
        Derivation(
            "orders",
            {
                "acc_no": ACCOUNT,
                "cid": PERSON,
                "group_flag": "substr(o_orderpriority, 1, 1)",
                "no_of_late_bill": "CAST(o_orderkey % 90 AS INT)",
                "loan_type": when("o_orderstatus = 'F'", "o_orderpriority"),
                "sta_code": when("o_orderkey % 11 < 10", f"'0' || {text('o_orderkey % 11')}"),
                "loan_acc_status": "CASE o_orderkey % 10 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 9 THEN NULL"
                f" ELSE '9' || {text('o_orderkey % 10 - 2')} END",
                "end_contract_date": "o_orderdate",
                "last_payment_date": when("o_orderstatus = 'F'", "o_orderdate"),
                "entity": "CASE o_custkey % 4 WHEN 0 THEN 'KTB' WHEN 1 THEN 'IBANK' WHEN 2 THEN 'OTHER' END",
                "loan_classification": f"'A' || {text('o_orderkey % 10')}",
            },
            where="o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'",
        )
    ],
    "dms_trn_input_for_recal": [
        Derivation(
            "orders",
            {
                "acc_no": ACCOUNT,
                "restructure_flag": "CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END",
            },
            where="o_orderpriority <> '3-MEDIUM'",
        )
    ],
    "dms_trn_bills": [
        Derivation(
            "lineitem",
            {
                "acc_no": LINE_ACCOUNT,
                "version": LINE_VERSION,
                "status": when("l_linestatus = 'O'", "'1'", "'0'"),
                "closed_date": when("l_returnflag = 'R'", "l_shipdate"),
                "due_period": "l_shipdate",
                "installment_cal_amount": PRICE,
                "interest_cal_amount": when("l_returnflag = 'A'", QUANTITY),
                "fine_cal_amount": when("l_returnflag <> 'A'", DISCOUNT),
            },
        )
    ],
    "dms_mst_installments": [
        Derivation(
            "lineitem",
            {
                "acc_no": LINE_ACCOUNT,
                "version": LINE_VERSION,
                "periods": when("l_linenumber <> 4 OR l_returnflag <> 'R'", "CAST(l_quantity AS INT)"),
                "period_installment_amount": PRICE,
            },
        )
    ],
    "dms_trn_bill_summary": [
        Derivation(
            "lineitem",
            {
                "acc_no": LINE_ACCOUNT,
                "version": LINE_VERSION,
                "capital_remain": amount(f"SUM({PRICE})"),
                "accrued_installment": amount(f"SUM({OPEN_PRICE})"),
                "accrued_interest": amount(f"SUM({A_QUANTITY})"),
                "accrued_fine": amount(f"SUM({N_DISCOUNT})"),
                "carry_interest": f"MAX({QUANTITY})",
                "carry_fine": f"MAX({R_TAX})",
            },
            group_by=f"l_orderkey, {LINE_VERSION}",
            faster={
                "capital_remain": cents_summed(PRICE),
                "accrued_installment": cents_summed(OPEN_PRICE),
                "accrued_interest": cents_summed(A_QUANTITY),
                "accrued_fine": cents_summed(N_DISCOUNT),
            },
        )
    ],
    "account_statement": [
        Derivation(
            "lineitem",
            {
                "acc_no": LINE_ACCOUNT,
                "tran_type": "CASE WHEN l_linenumber <= 3 THEN '4' WHEN l_linenumber <= 6 THEN '2' ELSE '1' END",
                "tran_code": "CASE l_suppkey % 8 WHEN 0 THEN 'ADJMON' WHEN 1 THEN 'XADJMON1' WHEN 2 THEN 'ADJMONR'"
                " WHEN 3 THEN 'REPAY' WHEN 4 THEN 'PAYOFF' WHEN 5 THEN 'OTHER' WHEN 6 THEN 'DEPTER_FEE' END",
                "remark": "CASE l_partkey % 6 WHEN 0 THEN 'จ่าย ค่าทนายความ' WHEN 1 THEN 'ค่าฤชา ศาล'"
                " WHEN 2 THEN 'ชำระ ค่าทนายความ' WHEN 3 THEN '' WHEN 4 THEN 'อื่น ๆ' END",
                "tran_userid": "CASE l_partkey % 5 WHEN 0 THEN 'FIX_LES01' WHEN 1 THEN 'FIXxLES'"
                " WHEN 2 THEN 'ADMSFIX' WHEN 3 THEN 'OPERATOR' END",
                "tran_flag": when("l_returnflag = 'R'", "'Y'", "'N'"),
                "ec_revert_flag": when("l_linenumber = 5", "'Y'", "'N'"),
                "fee1": when("l_linestatus = 'O'", f"-{QUANTITY}", QUANTITY),
                "fee2": when("l_linestatus = 'F'", f"-{TAX}"),
                "fee3": f"-{DISCOUNT}",
                "fee4": TAX,
            },
        )
    ],
    "contract": [
        Derivation(
            "orders",
            {
                "cid": PERSON,
                "stu_bank_code": when("o_orderstatus <> 'P'", text("o_orderkey % 40")),
                "contract_seq": "o_orderkey",
            },
            where="o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'",
        )
    ],
    "rdbbank": [
        Derivation(
            "nation",
            {"bank_code": text("n_nationkey"), "bank_name_th": when("n_regionkey <> 3", "n_name")},
        )
    ],
    "dms_log_cal": [
        Derivation("events", {"acc_no": text("user_id"), "cal_date": "ts"}),
        Derivation("lineitem", {"acc_no": LINE_ACCOUNT, "cal_date": when("l_returnflag = 'A'", "l_shipdate")}),
    ],
    "mv_dms_acc_report": [
        Derivation(
            "orders",
            {
                "acc_no": ACCOUNT,
                # Some accounts belong to persons without any contract.
                "cid": when("o_orderstatus = 'P'", f"'X' || {PERSON}", PERSON),
                "loan_type": when("o_orderstatus = 'O'", "'L' || o_orderpriority"),
                "title_name": when("o_orderstatus = 'F'", "'T'"),
                "hr_name": when("o_orderstatus <> 'P'", f"'N' || {ACCOUNT}"),
                "hr_surname": when("o_orderstatus <> 'F'", f"'S' || {ACCOUNT}"),
                "org": "o_orderpriority",
            },
            where="o_orderpriority <> '4-NOT SPECIFIED'",
        )
    ],
    "loan_account": [
        Derivation(
            "orders",
            {
                "acc_no": ACCOUNT,
                "total_amt": amount("o_totalprice"),
                "fee_amt1": when("o_orderstatus = 'F'", amount("o_totalprice")),
                "fee_amt2": amount("o_custkey"),
                "fee_amt3": amount("NULL"),
                "fee_amt4": amount("1"),
            },
            where="o_orderstatus <> 'O' OR o_orderpriority <> '1-URGENT'",
        )
    ],
    "dms_trn_cal_int_add_day": [
        Derivation(
            "orders",
            {
                "acc_no": ACCOUNT,
                "interest": amount("o_totalprice"),
                "fine": when("o_orderstatus <> 'P'", amount("o_custkey")),
            },
            where="o_orderpriority <> '2-HIGH'",
        )
    ],
    "mv_ktb_day": [
        Derivation(
            "orders",
            {
                "acc_no": ACCOUNT,
                "snapshot_date": when("o_orderstatus = 'F'", "DATE '2026-01-15'", "DATE '2026-01-24'"),
                "o_bs_capital_remain": amount("o_totalprice"),
                "o_bs_accrued_interest": when("o_orderpriority <> '5-LOW'", amount("o_custkey")),
                "o_bs_accrued_fine": amount("o_orderkey"),
                "o_bs_lawyer_fee": amount("NULL"),
            },
        )
    ],
    "person": [
        Derivation(
            "customer",
            {
                "cif": f"'F' || {text('c_custkey')}",
                "hr_title": "c_mktsegment",
                "hr_name": "c_name",
                "hr_surname": when("c_nationkey <> 7", "c_name"),
                **{c: f"'{c} ' || {text('c_nationkey')}" for c in ADDRESS},
                "ha_postal_code": text("c_nationkey"),
            },
            where="c_mktsegment <> 'BUILDING'",
        )
    ],
}


def repeated(name: str, every: int, **changed: str) -> None:
    """Repeat every so many-th row of a relation's first derivation, some columns changed."""
    first = DERIVATIONS[name][0]
    key = {"customer": "c_custkey", "nation": "n_nationkey", "orders": "o_orderkey"}[first.table]
    rows = Derivation(first.table, {**first.columns, **changed}, f"({first.where}) AND {key} % {every} = 0")
    DERIVATIONS[name].append(rows)


# Keys that should occur once and don't, so that every survivor is chosen by its order; and list
# rows without an account. Different primes keep the products of repeats small.
repeated("list_account_f69_117", 7, cid=f"'0' || {PERSON}")
repeated("list_acc_broken_contract", 7, cid=f"'0' || {PERSON}", cif=f"'F0' || {PERSON}")
for listed in ("list_account_f69_117", "list_acc_broken_contract"):
    nobody = {"acc_no": "CAST(NULL AS STRING)", "cid": f"'Z' || {text('s_suppkey')}", "cif": "'none'"}
    columns = {c: nobody[c] for c in DERIVATIONS[listed][0].columns}
    DERIVATIONS[listed].append(Derivation("supplier", columns))
repeated("mv_dms_acc_report", 11, cid=f"'0' || {PERSON}", loan_type="'A'", hr_name="CAST(NULL AS STRING)")
repeated("report_summary_month", 13, cid="CAST(NULL AS STRING)", group_flag="'0'", loan_type="'1'", entity="'KTB'")
repeated("dms_trn_input_for_recal", 17, restructure_flag="CASE o_orderstatus WHEN 'F' THEN 'N' WHEN 'O' THEN 'Y' END")
repeated("loan_account", 19, total_amt=amount("o_totalprice - 1"), fee_amt1=amount("2"))
repeated("mv_ktb_day", 23, o_bs_capital_remain=amount("o_totalprice + 1"), o_bs_lawyer_fee=amount("3"))
repeated("dms_trn_cal_int_add_day", 29, interest=amount("o_totalprice - 2"))
repeated("contract", 31, stu_bank_code=text("o_orderkey % 37"))
repeated("rdbbank", 5, bank_name_th="'A ' || n_name")
repeated("person", 3, hr_title="'A'", hr_name="CAST(NULL AS STRING)")


def ledger(t: Tables) -> Ledger:
    def relation(name: str) -> DataFrame:
        rows = reduce(DataFrame.unionByName, (d.frame(t) for d in DERIVATIONS[name]))
        return normalize(rows, name)

    return Ledger(relation)


def ledger_sql(*names: str) -> str:
    """``WITH`` clause that defines the named relations."""
    bodies = (
        (name, " UNION ALL ".join(d.sql(d.table) for d in DERIVATIONS[name])) for name in names
    )
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in bodies)
