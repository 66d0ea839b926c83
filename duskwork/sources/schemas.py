"""Columns of the tables the jobs read and write, as Spark DDL.

Money and units are decimals, ids longs, moments timestamps without zone, and
date keys yyyymmdd integers. Jobs use columns by name, so tables may have more.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_AUDITED = "created_by string, dt_created timestamp_ntz, updated_by string, dt_updated timestamp_ntz"
_MONEY = "decimal(18,6)"
_BENEFICIARY = (
    "beneficial_name string, beneficial_name_2 string, beneficial_nric string, beneficial_nric_2 string, "
    "beneficial_relationship string, beneficial_relationship_2 string, branch_name string"
)
_APPROVAL = (
    "pending_approval_id bigint, pending_type string, pending_status string, submitted_by string, "
    "dt_submitted timestamp_ntz, updated_by string, dt_updated timestamp_ntz, ref_pending_approval_id bigint, "
    "next_approver_id1 bigint, next_approver_id2 bigint"
)
_APPROVAL_HISTORY = "pending_approval_id bigint, seq bigint, note string"
_TRX = (
    "trx_ut_id bigint, reference_id string, new_account_flag string, account_id bigint, trx_type string, "
    "trx_status string, full_redemption_flag string, dt_trx timestamp_ntz, msg_to_cust string, msg_to_fam string, "
    f"pending_approval_id bigint, total_amount {_MONEY}, fee_switching {_MONEY}, dt_created timestamp_ntz, "
    "frequency string, dt_start timestamp_ntz, payment_method string, same_switching_fee_flag string, "
    "created_by string, {fee} string, dt_updated timestamp_ntz, updated_by string, allocation_method string, "
    f"ongoing_fee {_MONEY}, deferred_fee {_MONEY}, rejection_reason_fam string, easy_save_deactivation_flag string, "
    "e_reference_number string, rejection_reason_cust string, same_upfront_fee_flag string, "
    f"switch_to_account_id bigint, upfront_fee {_MONEY}, bor string, workflow string, approval_reason_fam string, "
    "approval_reason_cust1 string, approval_reason_cust2 string"
)
_TRX_DETAIL = (
    f"trx_ut_detail_id bigint, trx_ut_id bigint, trx_ut_detail_type string, fund_id string, amount {_MONEY}, "
    f"unit {_MONEY}, allocation {_MONEY}, fee_upfront {_MONEY}, fee_establishment {_MONEY}, fee_switching {_MONEY}, "
    f"redemption_method string, {_AUDITED}"
)
_ADDRESS = "cltaddr01 string, cltaddr02 string, cltaddr03 string, cltaddr04 string, cltaddr05 string"
_PORTFOLIO = f"portfolio_id bigint, risk_category_nm string, exp_return {_MONEY}, status string, "
_TARGET = f"aa_class_id bigint, portfolio_id bigint, percentage {_MONEY}"
_COVERAGE = "crtable string, chdrcoy string, coverage string, rider string"

SCHEMAS: dict[str, str] = {
    # parameters, log, audit
    "r_sysparam": "param_code string, value string",
    "eod_log": "eod_proc_name string, eod_date timestamp_ntz, status string, dt_created timestamp_ntz, "
               "created_by string, remarks string",
    "audit_trail": "audit_id bigint, action string, table_nm string, dt_created timestamp_ntz, created_by string, "
                   "audit_type string, data1 string, data2 string",
    # approvals and transactions
    "pending_approval": _APPROVAL,
    "pending_approval_hist": _APPROVAL,
    "pending_approval_history": _APPROVAL_HISTORY,
    "pending_approval_history_hist": _APPROVAL_HISTORY,
    "trx_ut": _TRX.replace("{fee}", "fee_stucture_type"),
    "trx_ut_hist": _TRX.replace("{fee}", "fee_structure_type"),
    "trx_ut_detail": _TRX_DETAIL,
    "trx_ut_detail_hist": _TRX_DETAIL,
    # mail
    "mail": "mail_id bigint, owner_id bigint, `from` string, `to` string, message string, mail_type string, "
            "subject string, dt_mail timestamp_ntz, created_by string, dt_created timestamp_ntz, status string, "
            "new_mail_flag string",
    "mail_dtl": "mail_id bigint, attachment_id bigint",
    "mail_dtl_content": "mail_id bigint",
    "mail_temp": "mail_temp_id bigint, status string, message string",
    "mail_temp_file": "mail_temp_id bigint, attachment_id bigint",
    "mail_temp_rcpt": "mail_temp_id bigint, clntnum string",
    # alerts and prices
    "fund_alert": f"fund_alert_id bigint, user_id bigint, floor {_MONEY}, ceiling {_MONEY}",
    "acct_alert": f"acct_id bigint, user_id bigint, floor {_MONEY}, ceiling {_MONEY}",
    "account_value": f"acct_id bigint, effdate int, ubidpr {_MONEY}",
    "ifsdmvprcpf": f"vrtfnd string, ubidpr {_MONEY}, effdate int",
    # users and roles
    "r_user": "user_id bigint, login_id string, status string, dt_last_login timestamp_ntz, pwd_regen_flag string, "
              f"email_notify_flag string, dt_reset_password_updated timestamp_ntz, {_AUDITED}",
    "r_user_info": "user_info_id bigint, user_id bigint, user_type string, clntnum string, status string, "
                   "created_by string, dt_created timestamp_ntz",
    "r_user_role": f"user_role_id bigint, user_id bigint, role_id bigint, status string, {_AUDITED}",
    "r_role": "role_id bigint, role_nm string, role_type string",
    "v_userrole": "user_id bigint, role_id bigint",
    "r_agt_cl_role_map": "zlfagtcl string, role_id bigint",
    "r_user_process": f"user_id string, login_id string, email string, genpass string, {_ADDRESS}",
    # customers, accounts, portfolios
    "r_customer": "entityid bigint, customer_type string, auth_type string, dt_created timestamp_ntz, created_by string",
    "r_custuser_matrix": "entity_id bigint, relationship string, user_info_id bigint",
    "plan_acct": f"acctid bigint, chdrcoy string, chdrnum string, status string, entity_id bigint, {_BENEFICIARY}, "
                 f"{_AUDITED}",
    "tmp_account": f"account_temp_id bigint, {_BENEFICIARY}",
    "tmp_portfolio": f"{_PORTFOLIO}account_temp_id bigint, portfolio_model_id bigint, portfolio_builder_type string",
    "portfolio": f"{_PORTFOLIO}acct_id bigint, portfolio_model_id bigint, portfolio_builder_type string, {_AUDITED}",
    "tmp_portfolio_target": _TARGET,
    "portfolio_target": _TARGET,
    # mirrored core tables
    "ifsdmclntpf": "clntnum string, datime timestamp_ntz, cltmchg string, zemailadd string, clttype string, "
                   f"race string, surname string, givname string, {_ADDRESS}",
    "ifsdmchdrpf": "chdrcoy string, chdrnum string, cownnum string, jownnum string, statcode string, modidate int, "
                   "dueflg string, cnttype string, servagnt string, validflag string",
    "ifsdmutrnpf": "ztranref string, chdrcoy string, chdrnum string, trdt int, fdbkind string, batctrcde string, "
                   "sacstyp string, vrtfnd string",
    "ifsdmaglfpf": "clntnum string, agntnum string, agntcoy string, zlfagtcl string, dtetrm int",
    "ifsvwclnt_mst_ifs": "clnt_num string",
    "ifsvwadv_mst": "clnt_num string, termination_date string",
    # notes and descriptions
    "ifsdmcovrpf": f"{_COVERAGE}, validflag string",
    "ifsdmcovtpf": _COVERAGE,
    "ifsdmt3590": "itemitem string",
    "ifsdmt5687": "itemcoy string, itemitem string, itmto string, sp_ind string",
    "ifsdmt9065": "itempfx string, itemcoy string, itemitem string, longdesc string, trandesc string",
    "ifsdmt1688": "itempfx string, itemcoy string, itemitem string, longdesc string",
    "ifsdmlzubpf": "chdrcoy string, chdrnum string, unityp string, vrtfnd string",
    "ifsdmlzsdpf": "chdrcoy string, chdrnum string, unityp string, batctrcde string, sacstyp string",
    "r_explanatory_notes": "chdrcoy string, billfreq string, crtable string, noteitem string, notedesc string",
    "r_trx_description": "cnttype string, unityp string, batctrcde string, sacstyp string, trandesc string",
}


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def make_table(spark: SparkSession, name: str, rows: Iterable[Mapping[str, Any]] = ()) -> DataFrame:
    """A small table from dictionaries; columns left out are NULL."""
    schema = schema_of(name)
    unknown = {c for row in rows for c in row} - set(schema.names)
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    return spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in rows], schema)
