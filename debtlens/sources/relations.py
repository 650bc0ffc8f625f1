"""The 16 source relations: the columns reports read, with their types.

``key`` is the column a relation is restricted and reduced by. Accounts are ``acc_no``
here whichever spelling the source uses. Relations of one row per account say so only by
convention in the source systems, so reports reduce them by ``key`` before joining.
"""

from __future__ import annotations

from dataclasses import dataclass

from debtlens.functions.scalars import MONEY

NTZ = "timestamp_ntz"

ADDRESS = (
    "ha_no",
    "ha_building",
    "ha_floor",
    "ha_roomno",
    "ha_village",
    "ha_moo",
    "ha_trong",
    "ha_soi",
    "ha_road",
    "ha_tamname",
    "ha_ampname",
    "ha_provname",
    "ha_moicode",
)


@dataclass(frozen=True)
class Relation:
    name: str
    key: str
    columns: dict[str, str]


def _relation(name: str, key: str, **columns: str) -> Relation:
    return Relation(name, key, {key: "string"} | columns)


RELATIONS: dict[str, Relation] = {
    r.name: r
    for r in (
        _relation("list_account_f69_117", "acc_no", cid="string"),
        _relation("list_acc_broken_contract", "acc_no", cid="string", cif="string"),
        _relation(
            "report_summary_month",
            "acc_no",
            cid="string",
            group_flag="string",
            no_of_late_bill="int",
            loan_type="string",
            sta_code="string",
            loan_acc_status="string",
            end_contract_date=NTZ,
            last_payment_date=NTZ,
            entity="string",
            loan_classification="string",
        ),
        _relation("dms_trn_input_for_recal", "acc_no", restructure_flag="string"),
        _relation(
            "dms_trn_bills",
            "acc_no",
            version="int",
            status="string",
            closed_date=NTZ,
            due_period=NTZ,
            installment_cal_amount=MONEY,
            interest_cal_amount=MONEY,
            fine_cal_amount=MONEY,
        ),
        _relation("dms_mst_installments", "acc_no", version="int", periods="int", period_installment_amount=MONEY),
        _relation(
            "dms_trn_bill_summary",
            "acc_no",
            version="int",
            capital_remain=MONEY,
            accrued_installment=MONEY,
            accrued_interest=MONEY,
            accrued_fine=MONEY,
            carry_interest=MONEY,
            carry_fine=MONEY,
        ),
        _relation(
            "account_statement",
            "acc_no",
            tran_type="string",
            tran_code="string",
            remark="string",
            tran_userid="string",
            tran_flag="string",
            ec_revert_flag="string",
            fee1=MONEY,
            fee2=MONEY,
            fee3=MONEY,
            fee4=MONEY,
        ),
        # contract_seq stands in for the physical row id: a larger one is newer.
        _relation("contract", "cid", stu_bank_code="string", contract_seq="bigint"),
        _relation("rdbbank", "bank_code", bank_name_th="string"),
        _relation("dms_log_cal", "acc_no", cal_date=NTZ),
        _relation(
            "mv_dms_acc_report",
            "acc_no",
            cid="string",
            loan_type="string",
            title_name="string",
            hr_name="string",
            hr_surname="string",
            org="string",
        ),
        _relation(
            "loan_account",
            "acc_no",
            total_amt=MONEY,
            fee_amt1=MONEY,
            fee_amt2=MONEY,
            fee_amt3=MONEY,
            fee_amt4=MONEY,
        ),
        _relation("dms_trn_cal_int_add_day", "acc_no", interest=MONEY, fine=MONEY),
        # One relation for all days; the source system keeps a view per day.
        _relation(
            "mv_ktb_day",
            "acc_no",
            snapshot_date="date",
            o_bs_capital_remain=MONEY,
            o_bs_accrued_interest=MONEY,
            o_bs_accrued_fine=MONEY,
            o_bs_lawyer_fee=MONEY,
        ),
        _relation(
            "person",
            "cif",
            hr_title="string",
            hr_name="string",
            hr_surname="string",
            **dict.fromkeys((*ADDRESS, "ha_postal_code"), "string"),
        ),
    )
}
